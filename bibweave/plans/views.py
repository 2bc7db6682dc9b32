"""The driver's tables seen as catalogues, so that every operator has rows to work on.

``articles`` has the standard columns; the others have the shape of a
catalogue's own tables, nested as those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.sources.files import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Title: the first line; the year and the DOI come from the length, the names from the language."""
    return spread(table(spark, sf, "documents")).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"),
        F.concat("source", F.lit("/"), F.col("n_chars").cast("string")).alias("clean_doi"), (F.col("n_chars") % 50).alias("year"), F.array("lang").alias("last_names"),
        F.concat("source", F.lit(","), "lang", F.lit(","), (F.col("n_chars") % 40).cast("string")).alias("references"), F.col("source").alias("dataset"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their parts, coarsened, as references."""
    cited = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.sort_array(F.collect_set(F.col("l_partkey") % 20)).cast("array<string>"), ",").alias("references"))
    none = F.lit(None).cast("string")
    return table(spark, sf, "orders").join(cited, "o_orderkey", "left").select(
        F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")).alias("id"), none.alias("title"), none.alias("abstract"), none.alias("clean_doi"), F.year("o_orderdate").cast("long").alias("year"),
        F.array().cast("array<string>").alias("last_names"), "references", F.lit("orders").alias("dataset"),
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).unionByName(orders(spark, sf))


def _lines(spark: SparkSession, sf: str, key: str, **lists) -> DataFrame:
    """Lists of a key's lines, in the order of part and line."""
    order = F.sort_array(F.collect_list(F.struct("l_partkey", "l_linenumber", "l_orderkey", "l_suppkey", "l_returnflag")))
    rows = table(spark, sf, "lineitem").groupBy(key).agg(order.alias("_l"))
    return rows.select(key, *(F.expr(e).alias(n) for n, e in lists.items()))


def openalex(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf, "l_orderkey", authorships="transform(_l, x -> struct(struct(if(x.l_linenumber = 3, null, concat('Supplier ', x.l_suppkey)) as display_name) as author))", referenced_works="transform(_l, x -> concat('W', x.l_partkey))")
    return table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        "concat('https://openalex.org/', o_orderkey) AS id", "o_orderpriority AS title", "concat(o_orderstatus, ' ', o_orderpriority) AS abstract", "concat('https://doi.org/10.1/', o_orderstatus, o_custkey) AS doi",
        "year(o_orderdate) AS publication_year", "CASE o_orderpriority WHEN '1-URGENT' THEN 'dataset' WHEN '2-HIGH' THEN 'letter' WHEN '3-MEDIUM' THEN null ELSE 'article' END AS type", "authorships", "referenced_works",
        "named_struct('oa_url', CASE o_orderkey % 5 WHEN 0 THEN concat('https://arxiv.org/pdf/', o_custkey, '.pdf') WHEN 1 THEN concat('http://export.arxiv.org/abs/', o_custkey) WHEN 2 THEN concat('http://ARXIV.org/ftp/arxiv/papers/99/', o_custkey, 'v2.pdf') WHEN 3 THEN concat('https://x.org/arxiv.org/', o_custkey) END) AS open_access",
    )


def s2_papers(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf, "l_orderkey", authors="transform(_l, x -> struct(concat('Supplier ', x.l_suppkey) as name))", publicationtypes="array_distinct(transform(_l, x -> CASE x.l_returnflag WHEN 'A' THEN 'Review' WHEN 'R' THEN 'News' ELSE 'JournalArticle' END))")
    return table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        "o_orderkey AS corpusid", "o_orderpriority AS title", "o_orderdate AS publicationdate", "named_struct('DOI', concat('https://doi.org/10.1/', o_orderstatus, o_custkey)) AS externalids", "authors", "publicationtypes"
    )


def s2_abstracts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_custkey % 3 = 0").selectExpr("o_orderkey AS corpusid", "concat(o_orderstatus, ' ', o_orderpriority) AS abstract")


def s2_citations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr("l_orderkey AS citingcorpusid", "l_partkey AS citedcorpusid")


def lens(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(
        spark, sf, "l_partkey", external_ids="transform(_l, x -> struct(CASE x.l_returnflag WHEN 'A' THEN 'doi' WHEN 'N' THEN 'openalex' ELSE 'pmid' END as type, concat('V', x.l_orderkey) as value))",
        authors="transform(_l, x -> struct(if(x.l_linenumber = 3, null, concat('Supplier ', x.l_suppkey)) as last_name))", references="transform(_l, x -> struct(concat('L', x.l_suppkey) as lens_id))",
    )
    return table(spark, sf, "part").join(lines, F.col("p_partkey") == F.col("l_partkey"), "left").selectExpr(
        "concat('L', p_partkey) AS lens_id", "p_name AS title", "p_type AS abstract", "1990 + p_size AS year_published", "CASE p_type WHEN 'ECONOMY' THEN 'editorial' WHEN 'SMALL' THEN null ELSE 'article' END AS publication_type",
        "external_ids", "authors", "`references`", "CASE WHEN p_size % 7 = 0 THEN array(concat('L', p_partkey + 1)) END AS alias_lens_ids",
    )


def arxiv(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderpriority")).alias("_k"))
    return table(spark, sf, "customer").join(names, F.col("c_custkey") == F.col("o_custkey"), "left").selectExpr(
        "concat('A', c_custkey) AS id", "c_name AS title", "c_mktsegment AS abstract", "concat('https://doi.org/10.2/', c_mktsegment) AS doi", "make_date(2000 + c_nationkey, 1, 1) AS created", "named_struct('author', transform(_k, x -> struct(x as keyname))) AS authors"
    )


def pwc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "concat('http://p/', s_suppkey) AS paper_url", "s_name AS title", "concat('n', s_nationkey) AS abstract", "make_date(2001 + s_nationkey, 2, 1) AS date", "array(s_name, concat('Nation ', s_nationkey)) AS authors",
        "CASE WHEN s_nationkey % 2 = 1 THEN concat('A', s_suppkey * 3) END AS arxiv_id",
    )


def previous(spark: SparkSession, sf: str) -> DataFrame:
    """A mapping as a last run might have left it: documents that share source and language, in runs of three ids."""
    return table(spark, sf, "documents").where("doc_id % 11 != 0").selectExpr("format_string('carticle_%010d', doc_id div 3 + 1) AS merged_id", "concat('doc_', doc_id) AS orig_id", "source AS dataset")


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    """The same for all documents: what judges are shown samples of."""
    return table(spark, sf, "documents").selectExpr("format_string('carticle_%010d', doc_id div 3 + 1) AS merged_id", "concat('doc_', doc_id) AS orig_id", "source AS dataset")


def notices(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose first line ends in a copyright notice, and pages with letters in compatibility forms."""
    lines = table(spark, sf, "documents").selectExpr(
        "concat('doc_', doc_id) AS id", "concat(substring_index(text, '\\n', 1), CASE doc_id % 4 WHEN 0 THEN ' Copyright 2019 by all' WHEN 1 THEN ' COPYRIGHT (c) 2020 Press' WHEN 2 THEN ' (C)  1999' ELSE ' copyright 12' END, '\\nmore ', source) AS abstract",
        "concat(' 10.', n_chars, '/ABC ', CASE doc_id % 2 WHEN 0 THEN '\\t' ELSE '' END) AS doi",
    )
    wide = lines.select("id", F.concat("abstract", F.lit(" \ufb01ne \u2460 \uff21\uff22 \u00bd e\u0301")).alias("abstract"), "doi")
    return wide


def unlink(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring ids of the labelled documents, kept apart by hand."""
    return table(spark, sf, "labels").where("quality = 0 AND doc_id IS NOT NULL").selectExpr("concat('doc_', doc_id) AS id1", "concat('doc_', doc_id + 1) AS id2").distinct()


#: The same views for the SQL oracle, as common table expressions.
SQL = {
    "docs_v": """SELECT 'doc_' || doc_id AS id, split_part(text, chr(10), 1) AS title, text AS abstract, source || '/' || n_chars AS clean_doi, (n_chars % 50)::BIGINT AS year,
        [lang] AS last_names, source || ',' || lang || ',' || (n_chars % 40) AS refs, source AS dataset FROM documents""",
    "order_refs": """SELECT l_orderkey, string_agg(p::VARCHAR, ',' ORDER BY p) AS refs FROM (SELECT DISTINCT l_orderkey, l_partkey % 20 AS p FROM lineitem) GROUP BY l_orderkey""",
    "orders_v": """SELECT 'ord_' || o_orderkey AS id, NULL::VARCHAR AS title, NULL::VARCHAR AS abstract, NULL::VARCHAR AS clean_doi, year(o_orderdate)::BIGINT AS year,
        []::VARCHAR[] AS last_names, refs, 'orders' AS dataset FROM orders LEFT JOIN order_refs ON l_orderkey = o_orderkey""",
    "articles_v": "SELECT * FROM docs_v UNION ALL SELECT * FROM orders_v",
    "lines_by_order": """SELECT l_orderkey, list({'p': l_partkey, 'n': l_linenumber, 's': l_suppkey, 'r': l_returnflag} ORDER BY l_partkey, l_linenumber, l_orderkey, l_suppkey, l_returnflag) AS l FROM lineitem GROUP BY l_orderkey""",
    "openalex_v": """SELECT 'https://openalex.org/' || o_orderkey AS id, o_orderpriority AS title, o_orderstatus || ' ' || o_orderpriority AS abstract, 'https://doi.org/10.1/' || o_orderstatus || o_custkey AS doi,
        year(o_orderdate)::BIGINT AS publication_year, CASE o_orderpriority WHEN '1-URGENT' THEN 'dataset' WHEN '2-HIGH' THEN 'letter' WHEN '3-MEDIUM' THEN NULL ELSE 'article' END AS type,
        list_transform(l, lambda x: CASE WHEN x.n = 3 THEN NULL ELSE 'Supplier ' || x.s END) AS names, list_transform(l, lambda x: 'W' || x.p) AS works,
        CASE o_orderkey % 5 WHEN 0 THEN 'https://arxiv.org/pdf/' || o_custkey || '.pdf' WHEN 1 THEN 'http://export.arxiv.org/abs/' || o_custkey WHEN 2 THEN 'http://ARXIV.org/ftp/arxiv/papers/99/' || o_custkey || 'v2.pdf' WHEN 3 THEN 'https://x.org/arxiv.org/' || o_custkey END AS oa_url
        FROM orders LEFT JOIN lines_by_order ON l_orderkey = o_orderkey""",
    "s2_types": """SELECT l_orderkey, bool_or(l_returnflag NOT IN ('A', 'R')) AS good FROM lineitem GROUP BY l_orderkey""",
    "lens_v": """SELECT 'L' || p_partkey AS lens_id, p_partkey, p_name AS title, p_type AS abstract, (1990 + p_size)::BIGINT AS year_published, p_size,
        CASE p_type WHEN 'ECONOMY' THEN 'editorial' WHEN 'SMALL' THEN NULL ELSE 'article' END AS publication_type FROM part""",
    "previous_v": """SELECT 'carticle_' || lpad((doc_id // 3 + 1)::VARCHAR, 10, '0') AS merged_id, 'doc_' || doc_id AS orig_id, source AS dataset FROM documents WHERE doc_id % 11 <> 0""",
    "mapped_v": """SELECT 'carticle_' || lpad((doc_id // 3 + 1)::VARCHAR, 10, '0') AS merged_id, 'doc_' || doc_id AS orig_id, source AS dataset FROM documents""",
    "notices_v": """SELECT 'doc_' || doc_id AS id, split_part(text, chr(10), 1) || CASE doc_id % 4 WHEN 0 THEN ' Copyright 2019 by all' WHEN 1 THEN ' COPYRIGHT (c) 2020 Press' WHEN 2 THEN ' (C)  1999' ELSE ' copyright 12' END || chr(10) || 'more ' || source AS abstract,
        ' 10.' || n_chars || '/ABC ' || CASE doc_id % 2 WHEN 0 THEN chr(9) ELSE '' END AS doi FROM documents""",
    "unlink_v": """SELECT DISTINCT 'doc_' || doc_id AS id1, 'doc_' || (doc_id + 1) AS id2 FROM labels WHERE quality = 0""",
}
_KEY = lambda c: f"nullif(lower(regexp_replace(strip_accents(regexp_replace({c}, '<([^>]+)>', '', 'g')), '[^\\p{{L}}\\p{{N}}]|[0-9]', '', 'g')), '')"
SQL["norm_v"] = f"SELECT *, {_KEY('title')} AS title_norm, {_KEY('abstract')} AS abstract_norm, {_KEY('last_names[1]')} AS last_names_norm FROM articles_v"
SQL["filt_v"] = "SELECT id, title, abstract, " + ", ".join(f"CASE WHEN count(DISTINCT id) OVER (PARTITION BY {k}) < 11 THEN {k} END AS {k}" for k in ("clean_doi", "title_norm", "abstract_norm")) + ', year, last_names, refs AS "references", dataset, last_names_norm FROM norm_v'


def with_sql(body: str, *names: str) -> str:
    """``body`` after the views of these names and those they read; one that starts with a comma adds its own."""
    needed: list[str] = []

    def take(n: str) -> None:
        for other in SQL:
            if other != n and other in SQL[n].replace(",", " ").replace("(", " ").replace(")", " ").split():
                take(other)
        if n not in needed:
            needed.append(n)

    for n in names:
        take(n)
    views = ", ".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in needed)
    return f"WITH RECURSIVE {views}{body if body.startswith(',') else ' ' + body}"
