"""The registered queries of the linkage, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions import text as T
from bibweave.functions.describe import article_desc
from bibweave.functions.language import learn, tag
from bibweave.operators import checks, identity, match, sampling, simhash
from bibweave.operators.keys import FILTERED, RULES, STRONG, WEAK, drop_frequent, hashed_keys, stacked
from bibweave.plans import linkage, views
from bibweave.plans.views import table, with_sql
from bibweave.scratch import Scratch, small_batches
from bibweave.sources import catalogues as C
from bibweave.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, *needed: str):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = with_sql(sql, *needed) if needed else sql
        return f

    return add


def _filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised once and written, as in a run; the frequent keys gone."""
    return drop_frequent(Scratch(spark).save(T.normalise(views.articles(spark, sf)).drop("title", "abstract", "last_names")))


#: The columns that match keys are made of, where they are not there already.
_MADE_OF = {f"{c}_norm": c for c in T.CLEANERS}


def _keys(spark: SparkSession, sf: str, rules: tuple[tuple[str, ...], ...] = RULES, listed: bool = True, **instead) -> DataFrame:
    """Stacked keys of these rules: only what they need is normalised, only hashes are written; the frequent keys gone."""
    wanted, scratch = tuple(k for k in (*STRONG, *WEAK) if any(k in r for r in rules)), Scratch(spark)
    rows = T.normalise(views.articles(spark, sf), tuple(_MADE_OF[k] for k in wanted if k in _MADE_OF)).withColumns(instead)
    slim = scratch.save(hashed_keys(rows, wanted, listed=listed))
    filtered = tuple(k for k in FILTERED if k in wanted)
    return stacked(drop_frequent(slim, filtered, hashed=True, scratch=scratch) if filtered else slim, rules, hashed=True)


# Ids that take part


@query("SELECT DISTINCT id FROM openalex_v WHERE type IS NULL OR type NOT IN ('dataset', 'peer-review', 'grant', 'supplementary-materials', 'editorial', 'letter')", "openalex_v")
def ids_null_or_not_in(spark, sf):
    return C.openalex_ids(views.openalex(spark, sf))


@query("SELECT DISTINCT o_orderkey::VARCHAR AS id FROM orders LEFT JOIN s2_types ON l_orderkey = o_orderkey WHERE coalesce(good, true)", "s2_types")
def ids_any_type_allowed(spark, sf):
    return C.s2_ids(views.s2_papers(spark, sf))


@query("SELECT DISTINCT lens_id AS id FROM lens_v WHERE publication_type IS NULL OR publication_type <> 'editorial'", "lens_v")
def ids_lens(spark, sf):
    return C.lens_ids(views.lens(spark, sf))


@query("SELECT DISTINCT 'A' || c_custkey AS id FROM customer")
def ids_arxiv(spark, sf):
    return C.arxiv_ids(views.arxiv(spark, sf))


@query("SELECT DISTINCT 'http://p/' || s_suppkey AS id FROM supplier")
def ids_pwc(spark, sf):
    return C.pwc_ids(views.pwc(spark, sf))


_UNION = """SELECT 'A' || c_custkey AS id FROM customer UNION ALL SELECT 'http://p/' || s_suppkey FROM supplier
UNION ALL SELECT id FROM openalex_v WHERE type IS NULL OR type NOT IN ('dataset', 'letter')
UNION ALL SELECT o_orderkey::VARCHAR FROM orders LEFT JOIN s2_types ON l_orderkey = o_orderkey WHERE coalesce(good, true)
UNION ALL SELECT lens_id FROM lens_v WHERE publication_type IS NULL OR publication_type <> 'editorial'"""


@query(_UNION, "openalex_v", "s2_types", "lens_v")
def union_ids(spark, sf):
    return C.union_ids(*(f(spark, sf) for f in (ids_arxiv, ids_pwc, ids_null_or_not_in, ids_any_type_allowed, ids_lens)))


@query(f"SELECT 'unique_input_ids' AS check_name, count(*) = count(DISTINCT id) AS passed, count(*) - count(DISTINCT id) AS found FROM ({_UNION})", "openalex_v", "s2_types", "lens_v")
def check_unique_ids(spark, sf):
    return checks.unique_input_ids(union_ids(spark, sf))


# Standard columns


def _shown(df: DataFrame) -> DataFrame:
    """Lists as text, so that they can be compared."""
    return df.withColumn("last_names", F.array_join(F.sort_array("last_names"), "|"))


@query(
    """SELECT 'A' || c_custkey AS id, c_name AS title, c_mktsegment AS abstract, lower('https://doi.org/10.2/' || c_mktsegment) AS clean_doi, (2000 + c_nationkey)::BIGINT AS year,
    coalesce((SELECT string_agg(o_orderpriority, '|' ORDER BY o_orderpriority) FROM orders WHERE o_custkey = c_custkey), '') AS last_names, NULL::VARCHAR AS "references", 'arxiv' AS dataset FROM customer"""
)
def standardise_arxiv(spark, sf):
    return _shown(C.arxiv_metadata(views.arxiv(spark, sf)))


@query(
    """SELECT 'http://p/' || s_suppkey AS id, s_name AS title, 'n' || s_nationkey AS abstract, NULL::VARCHAR AS clean_doi, (2001 + s_nationkey)::BIGINT AS year,
    array_to_string(list_sort([s_name, 'Nation ' || s_nationkey]), '|') AS last_names, NULL::VARCHAR AS "references", 'pwc' AS dataset FROM supplier"""
)
def standardise_pwc(spark, sf):
    return _shown(C.pwc_metadata(views.pwc(spark, sf)))


@query(
    """SELECT id, title, abstract, replace(lower(doi), 'https://doi.org/', '') AS clean_doi, publication_year AS year,
    nullif(array_to_string(list_sort(list_filter(names, lambda x: x IS NOT NULL)), '|'), '') AS last_names, coalesce(array_to_string(list_sort(works), ','), '') AS "references", 'openalex' AS dataset
    FROM openalex_v WHERE type IS NULL OR type NOT IN ('dataset', 'letter')""", "openalex_v",
)
def standardise_openalex(spark, sf):
    return _shown(C.openalex_metadata(views.openalex(spark, sf)))


@query(
    """SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS title, CASE WHEN o_custkey % 3 = 0 THEN o_orderstatus || ' ' || o_orderpriority END AS abstract, lower('10.1/' || o_orderstatus || o_custkey) AS clean_doi,
    year(o_orderdate)::BIGINT AS year, array_to_string(list_sort(list_transform(l, lambda x: 'Supplier ' || x.s)), '|') AS last_names,
    array_to_string(list_transform(list_sort(list_transform(l, lambda x: x.p)), lambda x: x::VARCHAR), ',') AS "references", 's2' AS dataset
    FROM orders LEFT JOIN s2_types t ON t.l_orderkey = o_orderkey LEFT JOIN lines_by_order b ON b.l_orderkey = o_orderkey WHERE coalesce(good, true)""", "s2_types", "lines_by_order",
)
def standardise_s2(spark, sf):
    return _shown(C.s2_metadata(views.s2_papers(spark, sf), views.s2_abstracts(spark, sf), views.s2_citations(spark, sf)))


@query(
    """, d AS (SELECT l_partkey, lower('V' || l_orderkey) AS clean_doi FROM lineitem WHERE l_returnflag = 'A'),
    a AS (SELECT l_partkey, string_agg('Supplier ' || l_suppkey, '|' ORDER BY 'Supplier ' || l_suppkey) FILTER (WHERE l_linenumber <> 3) AS last_names, string_agg('L' || l_suppkey, ',' ORDER BY 'L' || l_suppkey) AS refs FROM lineitem GROUP BY l_partkey)
    SELECT lens_id AS id, title, abstract, clean_doi, year_published AS year, last_names, refs AS "references", 'lens' AS dataset FROM lens_v LEFT JOIN d ON d.l_partkey = p_partkey LEFT JOIN a ON a.l_partkey = p_partkey
    WHERE publication_type IS NULL OR publication_type <> 'editorial'""", "lens_v",
)
def standardise_lens(spark, sf):
    # names are put in order before a record becomes a row for each of its DOIs
    return C.by_doi(_shown(C.lens_records(views.lens(spark, sf))))


@query("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey) AS \"references\" FROM lineitem GROUP BY l_orderkey")
def references_sorted_numeric(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(C.sorted_list(F.collect_list("l_partkey")).alias("references"))


@query("SELECT l_orderkey, string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) AS \"references\" FROM lineitem GROUP BY l_orderkey")
def references_distinct_sorted(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(C.sorted_list(F.collect_set(F.col("l_partkey").cast("string"))).alias("references"))


@query("SELECT 'L' || l_partkey AS lens_id, lower('V' || l_orderkey) AS clean_doi FROM lineitem WHERE l_returnflag = 'A' AND l_partkey IN (SELECT p_partkey FROM part)")
def exploded_external_ids(spark, sf):
    return views.lens(spark, sf).select("lens_id", F.explode("external_ids").alias("e")).where("e.type = 'doi'").select("lens_id", F.lower("e.value").alias("clean_doi"))


@query(
    """, s AS (SELECT DISTINCT (l_partkey % 20)::VARCHAR AS orig_id, 'm' || (l_partkey % 20 % 15) AS merged_id FROM lineitem),
    m AS (SELECT id, string_agg(DISTINCT merged_id, ',' ORDER BY merged_id) AS mapped FROM articles_v, unnest(string_split(refs, ',')) u(r) JOIN s ON u.r = orig_id GROUP BY id)
    SELECT id, year, dataset, refs AS "references" FROM articles_v UNION ALL
    SELECT id, year, dataset, mapped FROM articles_v JOIN m USING (id) WHERE len(string_split(refs, ',')) = len(string_split(mapped, ','))""", "articles_v",
)
def union_metadata_remapped(spark, sf):
    known = table(spark, sf, "lineitem").selectExpr("cast(l_partkey % 20 as string) AS orig_id", "concat('m', l_partkey % 20 % 15) AS merged_id").distinct()
    return C.union_metadata(known, views.documents(spark, sf), views.orders(spark, sf)).select("id", "year", "dataset", "references")


# Text normalisation


@query("SELECT id, title_norm FROM norm_v", "norm_v")
def clean_title(spark, sf):
    return T.normalise(views.articles(spark, sf), ("title",)).select("id", "title_norm")


@query("SELECT id, abstract_norm FROM norm_v", "norm_v")
def clean_abstract(spark, sf):
    return T.normalise(views.articles(spark, sf), ("abstract",)).select("id", "abstract_norm")


_CUT = lambda c: f"trim(regexp_replace(regexp_replace(lower({c}), 'copyright\\s+\\d{{4}}.*', '', 'g'), '(copyright)?\\s+\\(c\\)\\s+\\d{{4}}.*', '', 'g'))"
_TAGS = "regexp_replace(strip_accents(abstract), '<([^>]+)>', '', 'g')"
_KEEP = lambda c: f"nullif(lower(regexp_replace(strip_accents({c}), '[^\\p{{L}}\\p{{N}}]|[0-9]', '', 'g')), '')"


@query(f"SELECT id, {_KEEP(_CUT(_TAGS))} || 'fineabe' AS abstract_norm, trim(lower(doi), ' ' || chr(9)) AS doi FROM notices_v", "notices_v")
def clean_notices(spark, sf):
    """Copyright notices go to the end of their line, compatibility forms (a ligature, wide letters, a circled digit, a fraction) are taken apart, DOIs are trimmed and lower-cased."""
    return T.normalise(views.notices(spark, sf), ("abstract", "doi")).select("id", "abstract_norm", "doi")


@query(f"SELECT page_id, {views._KEY('html')} AS html_norm FROM pages")
def clean_html(spark, sf):
    small_batches(spark)
    return files.spread(table(spark, sf, "pages")).select("page_id", T.title_key(F.col("html")).alias("html_norm"))


@query(
    """, n AS (SELECT p_size, lower(list_extract(regexp_split_to_array(p_name, '\\s+'), -1)) AS w FROM part)
    SELECT p_size::BIGINT AS p_size, string_agg(w, ' ' ORDER BY w) AS last_names_norm FROM n GROUP BY p_size""", "lens_v",
)
def clean_last_names(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_size").cast("long").alias("p_size")).agg(F.collect_list("p_name").alias("last_names")).select("p_size", T.names_key(F.col("last_names")).alias("last_names_norm"))


@query("SELECT id, clean_doi, title_norm, abstract_norm, last_names_norm, year, \"references\" FROM filt_v", "filt_v")
def freq_filter(spark, sf):
    return _filtered(spark, sf).select("id", "clean_doi", "title_norm", "abstract_norm", "last_names_norm", "year", "references")


@query("SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name, p_brand) < 11 THEN p_name || p_brand END AS named, CASE WHEN count(*) OVER (PARTITION BY p_brand) < 11 THEN p_brand END AS brand FROM part")
def freq_filter_parts(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("named"), F.col("p_brand").alias("brand"))
    return drop_frequent(parts, ("named", "brand"), id_="p_partkey")


# Matches


def _ok(key: str, at: str) -> str:
    out = f'{at}."{key}" IS NOT NULL' + ("" if key == "year" else f" AND {at}.\"{key}\" <> ''")
    return out + (f" AND len(string_split({at}.\"{key}\", ',')) > 2" if key == "references" else "")


def _match_sql(s: str, o: str) -> str:
    # each id has one row here, so the join alone gives what DISTINCT would
    return f'SELECT a.id AS all1_id, m.id AS all2_id FROM filt_v a JOIN filt_v m ON a."{s}" = m."{s}" AND a."{o}" = m."{o}" AND {_ok(s, "a")} AND {_ok(o, "a")}'


def _rule(s: str, o: str) -> Query:
    def run(spark, sf):
        return match.key_pairs(_keys(spark, sf, ((s, o),)))

    run.__name__ = f"match_{s}_{o}"
    return run


for _s, _o in RULES:
    query(_match_sql(_s, _o), "filt_v")(_rule(_s, _o))


@query(
    """SELECT a.id AS all1_id, m.id AS all2_id FROM docs3 a JOIN docs3 m ON a.last_names_norm = m.last_names_norm AND a."references" = m."references" AND a.clean_doi = m.clean_doi
    AND a.last_names_norm <> '' AND a."references" <> '' AND a.clean_doi <> ''""".replace("docs3", "(SELECT id, last_names_norm, clean_doi, dataset || ',' || year AS \"references\" FROM filt_v)"), "filt_v",
)
def match_three_keys(spark, sf):
    references = F.concat("dataset", F.lit(","), F.col("year").cast("string"))
    return match.key_pairs(_keys(spark, sf, (match.THREE_KEYS,), listed=False, references=references))


_METADATA_MATCH = " UNION ".join(_match_sql(s, o) for s, o in RULES)


@query(f"SELECT DISTINCT all1_id, all2_id FROM ({_METADATA_MATCH})", "filt_v")
def metadata_match(spark, sf):
    return match.key_pairs(_keys(spark, sf))


@query("SELECT 'A' || s_suppkey * 3 AS id1, 'http://p/' || s_suppkey AS id2 FROM supplier WHERE s_nationkey % 2 = 1 AND s_suppkey * 3 IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'http://p/' || s_suppkey, 'A' || s_suppkey * 3 FROM supplier WHERE s_nationkey % 2 = 1 AND s_suppkey * 3 IN (SELECT c_custkey FROM customer)")
def arxiv_id_match(spark, sf):
    return C.arxiv_pwc_links(views.arxiv(spark, sf), views.pwc(spark, sf))


@query(
    """, p AS (SELECT 'L' || l_partkey AS id1, 'https://openalex.org/V' || l_orderkey AS id2 FROM lineitem WHERE l_returnflag = 'N' AND 'L' || l_partkey IN (SELECT lens_id FROM lens_v WHERE publication_type IS NULL OR publication_type <> 'editorial')
    UNION ALL SELECT lens_id, 'L' || (p_partkey + 1) FROM lens_v WHERE p_size % 7 = 0) SELECT id1, id2 FROM p UNION ALL SELECT id2, id1 FROM p""", "lens_v",
)
def vendor_link_pairs(spark, sf):
    records = views.lens(spark, sf)
    return C.lens_links(records, C.lens_ids(records))


@query(
    """, p AS (SELECT id AS id1, replace(regexp_replace(oa_url, '.*(/ftp/arxiv/papers/|/pdf/|/abs/)', ''), '.pdf', '') AS id2 FROM openalex_v WHERE lower(oa_url) LIKE '%/arxiv.org%')
    SELECT id1, id2 FROM p UNION ALL SELECT id2, id1 FROM p""", "openalex_v",
)
def url_id_extract(spark, sf):
    return C.openalex_arxiv_links(views.openalex(spark, sf))


def _label_links(spark, sf):
    return C.both_ways(table(spark, sf, "labels").where("quality = 1").selectExpr("concat('doc_', doc_id) AS id1", "concat('lab_', doc_id % 300) AS id2"))


_LINKS = "l AS (SELECT 'doc_' || doc_id AS id1, 'lab_' || (doc_id % 300) AS id2 FROM labels WHERE quality = 1 UNION ALL SELECT 'lab_' || (doc_id % 300), 'doc_' || doc_id FROM labels WHERE quality = 1)"


@query(f", m AS ({_METADATA_MATCH}), {_LINKS} SELECT id AS id1, id AS id2 FROM filt_v WHERE id NOT IN (SELECT all1_id FROM m) AND id NOT IN (SELECT id1 FROM l)", "filt_v")
def self_pairs(spark, sf):
    # an id with a key matches itself, so it is first in a pair
    return match.self_pairs(views.articles(spark, sf), _keys(spark, sf).select("id"), _label_links(spark, sf))


@query(
    f""", m AS ({_METADATA_MATCH}), {_LINKS} SELECT DISTINCT id1, id2 FROM (SELECT id AS id1, id AS id2 FROM filt_v WHERE id NOT IN (SELECT all1_id FROM m) AND id NOT IN (SELECT id1 FROM l)
    UNION ALL SELECT all1_id, all2_id FROM m UNION ALL SELECT id1, id2 FROM l)""", "filt_v",
)
def all_match_pairs(spark, sf):
    return match.every_pair(views.articles(spark, sf), _keys(spark, sf), _label_links(spark, sf))


# Groups and merged ids


def _run(spark: SparkSession, sf: str, unlink: bool = False, previous: bool = False) -> linkage.Linkage:
    return linkage.link(spark, views.articles(spark, sf), links=(_label_links(spark, sf),), unlink=views.unlink(spark, sf) if unlink else None, previous=views.previous(spark, sf) if previous else None)


#: All pairs less the unlinked ones, and the least id that each id reaches.
def _groups_sql(unlink: bool) -> str:
    cut = "WHERE (id1, id2) NOT IN (SELECT (id1, id2) FROM unlink_v) AND (id2, id1) NOT IN (SELECT (id1, id2) FROM unlink_v)" if unlink else ""
    return f""", m AS MATERIALIZED ({_METADATA_MATCH}), {_LINKS}, e AS MATERIALIZED (SELECT DISTINCT id1, id2 FROM (SELECT all1_id AS id1, all2_id AS id2 FROM m UNION ALL SELECT id1, id2 FROM l) {cut}),
    n AS (SELECT id FROM filt_v UNION SELECT id1 FROM l), reach AS (SELECT id AS orig_id, id AS other FROM n UNION SELECT orig_id, id2 FROM reach JOIN e ON other = id1),
    g AS MATERIALIZED (SELECT min(other) AS root, orig_id FROM reach GROUP BY orig_id)"""


@query(f"{_groups_sql(False)} SELECT root, orig_id FROM g", "filt_v")
def connected_components(spark, sf):
    return _run(spark, sf).groups


@query(f"{_groups_sql(True)} SELECT root, orig_id FROM g", "filt_v", "unlink_v")
def components_unlinked(spark, sf):
    return _run(spark, sf, unlink=True).groups


_NAMED = "'carticle_' || lpad({}::VARCHAR, 10, '0')"
_FIRST = f"{_groups_sql(False)}, ids AS (SELECT {_NAMED.format('dense_rank() OVER (ORDER BY root)')} AS merged_id, orig_id FROM g)"


@query(f"{_FIRST} SELECT merged_id, orig_id FROM ids", "filt_v")
def merged_ids_first_run(spark, sf):
    return _run(spark, sf).mapping


_NEXT = f"""{_groups_sql(True)},
    dropped AS (SELECT DISTINCT merged_id FROM previous_v WHERE orig_id IN (SELECT id1 FROM unlink_v)), held AS (SELECT merged_id, count(*) AS members FROM previous_v GROUP BY merged_id),
    agg AS (SELECT root, count(DISTINCT p.merged_id) AS kinds, max(p.merged_id) AS only_, count(p.merged_id) AS have FROM g LEFT JOIN previous_v p USING (orig_id) GROUP BY root),
    kept AS (SELECT root, only_ FROM agg JOIN held ON held.merged_id = only_ WHERE kinds = 1 AND have = members AND only_ NOT IN (SELECT merged_id FROM dropped)),
    fresh AS (SELECT root, (SELECT max(substr(merged_id, 10)::BIGINT) FROM previous_v) + row_number() OVER (ORDER BY root) AS n FROM agg WHERE root NOT IN (SELECT root FROM kept)),
    ids AS (SELECT coalesce(only_, {_NAMED.format('n')}) AS merged_id, orig_id FROM g LEFT JOIN kept USING (root) LEFT JOIN fresh USING (root))"""


@query(f"{_NEXT} SELECT merged_id, orig_id FROM ids", "filt_v", "unlink_v", "previous_v")
def merged_ids_incremental(spark, sf):
    return _run(spark, sf, unlink=True, previous=True).mapping


@query("SELECT a.s_name AS id1, b.s_name AS id2 FROM (SELECT DISTINCT s_nationkey, s_name FROM supplier) a, (SELECT DISTINCT s_nationkey, s_name FROM supplier) b WHERE a.s_nationkey <> b.s_nationkey")
def unlink_pairs(spark, sf):
    return identity.unlink_pairs(table(spark, sf, "supplier").selectExpr("cast(s_nationkey as string) AS manual_id", "s_name AS orig_id"))


@query("SELECT DISTINCT merged_id FROM previous_v WHERE orig_id IN (SELECT id1 FROM unlink_v)", "previous_v", "unlink_v")
def ids_to_drop(spark, sf):
    return identity.ids_to_drop(views.previous(spark, sf), views.unlink(spark, sf))


@query(f"{_FIRST} SELECT DISTINCT merged_id, orig_id, dataset FROM ids JOIN articles_v ON orig_id = id", "filt_v")
def sources(spark, sf):
    return _run(spark, sf).sources


def _citing(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders that cite parts, and parts merged by name."""
    orders = views.orders(spark, sf)
    parts = table(spark, sf, "part").selectExpr("concat('m_', p_partkey % 7) AS merged_id", "cast(p_partkey as string) AS orig_id")
    own = orders.selectExpr("concat('m_', substring(id, -2)) AS merged_id", "id AS orig_id")
    return orders, parts.unionByName(own)


_CITING = """, s AS (SELECT 'm_' || (p_partkey % 7) AS merged_id, p_partkey::VARCHAR AS orig_id FROM part UNION ALL SELECT 'm_' || right(id, 2), id FROM orders_v),
    r AS (SELECT DISTINCT a.merged_id, b.merged_id AS ref_id FROM orders_v, unnest(string_split(refs, ',')) u(ref) JOIN s a ON a.orig_id = id JOIN s b ON b.orig_id = u.ref)"""


@query(f"{_CITING} SELECT merged_id, ref_id FROM r", "orders_v")
def references(spark, sf):
    return identity.references(*_citing(spark, sf))


# Gates


@query(f"{_FIRST}, s AS (SELECT DISTINCT merged_id, orig_id, dataset FROM ids JOIN articles_v ON orig_id = id) SELECT 'unique_sources' AS check_name, count(*) = count(DISTINCT orig_id) AS passed, count(*) - count(DISTINCT orig_id) AS found FROM s", "filt_v")
def check_unique_sources(spark, sf):
    return checks.unique_sources(_run(spark, sf).sources)


@query("SELECT 'all_ids_survived' AS check_name, count(*) = 0 AS passed, count(*) AS found FROM docs_v WHERE id NOT IN (SELECT orig_id FROM previous_v)", "docs_v", "previous_v")
def check_all_ids_survived(spark, sf):
    return checks.all_ids_survived(views.documents(spark, sf), views.previous(spark, sf))


@query(
    f""", m AS ({_METADATA_MATCH}) SELECT 'all_matches_survived' AS check_name, count(*) = 0 AS passed, count(*) AS found FROM m LEFT JOIN previous_v a ON all1_id = a.orig_id LEFT JOIN previous_v b ON all2_id = b.orig_id
    LEFT JOIN unlink_v u ON all1_id = u.id1 AND all2_id = u.id2 WHERE u.id1 IS NULL AND (a.merged_id IS NULL OR b.merged_id IS NULL OR a.merged_id <> b.merged_id)""", "filt_v", "previous_v", "unlink_v",
)
def check_matches_survived(spark, sf):
    return checks.keys_survived(_run(spark, sf).usable, views.previous(spark, sf), views.unlink(spark, sf))


@query("SELECT 'not_shrunk_events' AS check_name, count(*) FILTER (WHERE event_type <> 'click') >= 0.8 * count(*) AS passed, count(*) FILTER (WHERE event_type <> 'click') AS found FROM events")
def check_not_shrunk(spark, sf):
    events = table(spark, sf, "events")
    return checks.not_shrunk(events.where("event_type != 'click'"), events, "not_shrunk_events")


@query(f"{_CITING} SELECT 'no_null_references' AS check_name, count(*) = 0 AS passed, count(*) AS found FROM r WHERE merged_id IS NULL OR ref_id IS NULL", "orders_v")
def check_no_null_references(spark, sf):
    return checks.no_nulls(references(spark, sf), ("merged_id", "ref_id"), "no_null_references")


@query("SELECT 'no_null_datasets' AS check_name, count(*) = 0 AS passed, count(*) AS found FROM previous_v WHERE dataset IS NULL", "previous_v")
def check_no_null_datasets(spark, sf):
    return checks.no_nulls(views.previous(spark, sf), ("dataset",), "no_null_datasets")


#: A first run over all documents and orders, each gate on its own tables.
_GATES = f"""{_FIRST}, s AS MATERIALIZED (SELECT DISTINCT merged_id, orig_id, dataset FROM ids JOIN articles_v ON orig_id = id),
    refd AS (SELECT DISTINCT a.merged_id, b.merged_id AS ref_id FROM articles_v, unnest(string_split(refs, ',')) u(ref) JOIN s a ON a.orig_id = id JOIN s b ON b.orig_id = u.ref),
    bad AS (SELECT 'unique_input_ids' AS check_name, count(*) - count(DISTINCT id) AS found FROM (SELECT DISTINCT id FROM articles_v) UNION ALL SELECT 'unique_sources', count(*) - count(DISTINCT orig_id) FROM s
    UNION ALL SELECT 'all_ids_survived', count(*) FROM (SELECT DISTINCT id FROM articles_v) WHERE id NOT IN (SELECT orig_id FROM s)
    UNION ALL SELECT 'all_matches_survived', count(*) FROM m LEFT JOIN s a ON all1_id = a.orig_id LEFT JOIN s b ON all2_id = b.orig_id WHERE a.merged_id IS NULL OR b.merged_id IS NULL OR a.merged_id <> b.merged_id
    UNION ALL SELECT 'no_null_references', count(*) FROM refd WHERE merged_id IS NULL OR ref_id IS NULL UNION ALL SELECT 'no_null_datasets', count(*) FROM s WHERE dataset IS NULL)
    SELECT check_name, found = 0 AS passed, found FROM bad"""


@query(_GATES, "filt_v", "articles_v")
def check_all_gates(spark, sf):
    """All gates of a first run."""
    return _run(spark, sf).checks


# Language


@query()
def lid_documents(spark, sf):
    """The tags of a detector fitted to the documents' own languages: no SQL says what they are, a test measures them on others."""
    docs = views.documents(spark, sf).select("id", "title", "abstract", F.element_at("last_names", 1).alias("lang"))
    return tag(docs.select("id", "title", "abstract"), detector=learn(docs, "abstract", "lang")).drop("title", "abstract")


@query('SELECT id, title, abstract, clean_doi, year, dataset, refs AS "references" FROM articles_v', "articles_v")
def lid_input(spark, sf):
    return T.normalise(views.articles(spark, sf)).select("id", "title", "abstract", "clean_doi", "year", "dataset", "references")


# Samples for judges

_DESC = "'title: ' || coalesce({0}title, '') || chr(10) || 'year: ' || coalesce({0}year::VARCHAR, '') || chr(10) || 'doi: ' || coalesce({0}doi, '') || chr(10) || 'authors: ' || coalesce({0}authors, '') || chr(10) || 'abstract: ' || coalesce({0}abstract, '')"


@query(f"SELECT id, {_DESC.format('')} AS metadata FROM (SELECT id, title, abstract, year, 'https://doi.org/' || clean_doi AS doi, last_names[1] AS authors FROM docs_v)", "docs_v")
def eval_article_desc(spark, sf):
    d = views.documents(spark, sf)
    return d.select("id", article_desc(F.col("title"), F.col("abstract"), F.col("year"), F.concat(F.lit(C.DOI_LINK), F.col("clean_doi")), F.get("last_names", F.lit(0))).alias("metadata"))


_BINS = "CASE " + " ".join(f"WHEN n BETWEEN {a} AND {b} THEN '{x}'" for x, a, b, _ in sampling.BINS) + " END"
_QUOTA = "CASE " + " ".join(f"WHEN n BETWEEN {a} AND {b} THEN {q}" for _, a, b, q in sampling.BINS) + " END"
_STRATA = f"""sizes AS (SELECT 'ord_' || l_orderkey AS merged_id, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY l_orderkey),
    strata AS (SELECT merged_id, {_BINS} AS bin FROM sizes WHERE {_BINS} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_BINS} ORDER BY md5('1:' || merged_id), merged_id) <= {_QUOTA})"""


def _order_sources(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("concat('ord_', l_orderkey) AS merged_id", "concat('ord_', l_orderkey, '_', l_linenumber) AS orig_id")


@query(f"WITH {_STRATA} SELECT merged_id, bin FROM strata")
def eval_stratified(spark, sf):
    return sampling.stratified(_order_sources(spark, sf))


@query(f"WITH {_STRATA}, c AS (SELECT 'ord_' || l_partkey AS merged_id, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_partkey) SELECT merged_id, 'high_citation' AS bin FROM c WHERE merged_id NOT IN (SELECT merged_id FROM strata) ORDER BY n DESC, merged_id LIMIT {sampling.TOP_CITED}")
def eval_top_cited(spark, sf):
    cites = table(spark, sf, "lineitem").selectExpr("concat('x_', l_orderkey) AS merged_id", "concat('ord_', l_partkey) AS ref_id")
    return sampling.top_cited(cites, sampling.stratified(_order_sources(spark, sf)))


_PREV_SAMPLE = f"""psizes AS (SELECT merged_id, count(DISTINCT orig_id) AS n FROM mapped_v GROUP BY merged_id),
    sample AS (SELECT merged_id, {_BINS} AS bin FROM psizes WHERE {_BINS} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_BINS} ORDER BY md5('1:' || merged_id), merged_id) <= {_QUOTA}),
    raw AS (SELECT merged_id, bin, orig_id, {_DESC.format('')} AS metadata FROM (SELECT merged_id, bin, orig_id, title, abstract, year, 'https://doi.org/' || clean_doi AS doi, last_names[1] AS authors FROM sample JOIN mapped_v USING (merged_id) JOIN docs_v ON id = orig_id))"""


@query(f", {_PREV_SAMPLE} SELECT merged_id, bin, orig_id, metadata FROM raw", "mapped_v", "docs_v")
def eval_positive_matches(spark, sf):
    known = views.mapped(spark, sf)
    return sampling.positive_matches(sampling.stratified(known), known, views.documents(spark, sf))


@query(f", {_PREV_SAMPLE} SELECT merged_id, a.orig_id AS orig_id1, b.orig_id AS orig_id2, a.metadata AS metadata1, b.metadata AS metadata2 FROM raw a JOIN raw b USING (merged_id) WHERE a.orig_id > b.orig_id", "mapped_v", "docs_v")
def eval_match_pairs(spark, sf):
    return sampling.pairs_within(eval_positive_matches(spark, sf))


@query(
    f""", s AS (SELECT id AS orig_id, merged_id, substr(abstract, 1, 100) AS p, {_DESC.format('')} AS meta FROM (SELECT id, title, abstract, year, 'https://doi.org/' || clean_doi AS doi, last_names[1] AS authors FROM docs_v) JOIN mapped_v ON id = orig_id WHERE length(abstract) > 100)
    SELECT a.orig_id AS orig_id1, b.orig_id AS orig_id2, a.meta AS metaset1, b.meta AS metaset2 FROM s a JOIN s b USING (p) WHERE a.orig_id <> b.orig_id AND a.merged_id <> b.merged_id ORDER BY ALL LIMIT {sampling.PREFIX_PAIRS}""", "docs_v", "mapped_v",
)
def eval_abstract_prefix(spark, sf):
    return sampling.prefix_pairs(views.documents(spark, sf), views.mapped(spark, sf))


@query(
    f""", s AS (SELECT id AS orig_id, refs, {_DESC.format('')} AS meta FROM (SELECT id, refs, title, abstract, year, NULL::VARCHAR AS doi, 'one' AS authors FROM orders_v) WHERE refs IS NOT NULL)
    SELECT a.orig_id AS orig_id1, b.orig_id AS orig_id2, a.meta AS metadata1, b.meta AS metadata2 FROM s a JOIN s b USING (refs) WHERE a.orig_id > b.orig_id ORDER BY ALL LIMIT {sampling.REFERENCE_PAIRS}""", "orders_v",
)
def eval_mapped_references(spark, sf):
    return sampling.reference_pairs(views.orders(spark, sf).withColumn("last_names", F.array(F.lit("one"))))


# Near copies of titles, indexes, and files


@query()
def simhash_near_dups(spark, sf):
    """Fingerprints of texts: tested against brute force instead."""
    return simhash.linked(files.spread(table(spark, sf, "documents")), "doc_id", "text")


@query("SELECT title, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM docs_v WHERE title IS NOT NULL GROUP BY title", "docs_v")
def multimap_index(spark, sf):
    return files.multimap(views.documents(spark, sf), "title").select("title", F.array_join("ids", ",").alias("ids"))


@query('SELECT id, title, year, last_names[1] AS name, refs AS "references" FROM articles_v', "articles_v")
def json_round_trip(spark, sf):
    """Lines of JSON, written in batches and read with the given schema."""
    path = Scratch(spark).path()
    files.write_json(views.articles(spark, sf), path, batch_rows=5000)
    from bibweave.schemas import METADATA

    return files.read_json(spark, path, METADATA).select("id", "title", "year", F.get("last_names", F.lit(0)).alias("name"), "references")


@query("SELECT DISTINCT s_nationkey::VARCHAR AS manual_id, s_name AS orig_id FROM supplier")
def csv_manual_groups(spark, sf):
    path = Scratch(spark).path()
    table(spark, sf, "supplier").select(F.col("s_nationkey").alias("manual_id"), F.col("s_name").alias("orig_id")).write.option("header", True).csv(path)
    return files.read_manual_groups(spark, path)


@query("SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey + 100, r_name FROM region")
def table_overwrite_and_snapshot(spark, sf):
    """A table that is replaced by one read from itself, then copied under a date."""
    root = Scratch(spark).path()
    at = f"{root}/production/regions"
    first = files.overwrite_table(table(spark, sf, "region"), at, "Regions of the world.", {"r_name": "Its name."})
    files.overwrite_table(first.unionByName(first.withColumn("r_regionkey", F.col("r_regionkey") + 100)), at)
    return files.snapshot(spark, at, f"{root}/backups", "2024-05-01")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
