"""The catalogues' own tables -> one schema (``schemas.METADATA``).

Each ``*_ids`` gives the ids that take part, each ``*_metadata`` their rows.
References are lists of ids in a fixed order, joined by commas: they serve as a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of publication that do not take part.
OPENALEX_LEFT_OUT = ("dataset", "peer-review", "grant", "supplementary-materials", "editorial", "letter")
S2_LEFT_OUT = ("Dataset", "Editorial", "LettersAndComments", "News", "Review")
LENS_LEFT_OUT = ("dataset", "editorial", "letter", "news", "review")
#: Fixed value: how DOIs are written as links.
DOI_LINK = "https://doi.org/"
OPENALEX_LINK = "https://openalex.org/"

COLUMNS = ("id", "title", "abstract", "clean_doi", "year", "last_names", "references", "dataset")


def allowed(kind: Column, left_out: tuple[str, ...]) -> Column:
    """True for null and for what is not in the list."""
    return kind.isNull() | ~kind.isin(*left_out)


def any_allowed(kinds: Column, left_out: tuple[str, ...]) -> Column:
    """True for null, for an empty array, and if any element is allowed."""
    return kinds.isNull() | (F.size(kinds) == 0) | F.exists(kinds, lambda k: allowed(k, left_out))


def bare_doi(doi: Column) -> Column:
    return F.replace(F.lower(doi), F.lit(DOI_LINK), F.lit(""))


def sorted_list(items: Column) -> Column:
    """Items in their own order (numbers by size), then as text, comma-joined; empty for null."""
    return F.coalesce(F.array_join(F.sort_array(items).cast("array<string>"), ","), F.lit(""))


def arxiv_ids(papers: DataFrame) -> DataFrame:
    return papers.select("id").distinct()


def pwc_ids(papers: DataFrame) -> DataFrame:
    return papers.select(F.col("paper_url").alias("id")).distinct()


def openalex_ids(works: DataFrame) -> DataFrame:
    return works.where(allowed(F.col("type"), OPENALEX_LEFT_OUT)).select("id").distinct()


def s2_ids(papers: DataFrame) -> DataFrame:
    return papers.where(any_allowed(F.col("publicationtypes"), S2_LEFT_OUT)).select(F.col("corpusid").cast("string").alias("id")).distinct()


def lens_ids(records: DataFrame) -> DataFrame:
    return records.where(allowed(F.col("publication_type"), LENS_LEFT_OUT)).select(F.col("lens_id").alias("id")).distinct()


def union_ids(*ids: DataFrame) -> DataFrame:
    """All ids, repeats kept: that there are none is what is checked next."""
    return reduce(DataFrame.unionByName, (d.select(F.col("id").cast("string").alias("id")) for d in ids))


def _standard(df: DataFrame, dataset: str, *more: str) -> DataFrame:
    kinds = {"year": "bigint", "last_names": "array<string>"}
    have = {c: F.col(c) if c in df.columns else F.lit(None) for c in COLUMNS}
    have["dataset"] = F.lit(dataset)
    return df.select(*(have[c].cast(kinds.get(c, "string")).alias(c) for c in COLUMNS), *more)


def arxiv_metadata(papers: DataFrame) -> DataFrame:
    """``authors.author[].keyname`` are the last names (none: an empty array); the DOI is only lower-cased."""
    return _standard(papers.select("id", "title", "abstract", F.lower("doi").alias("clean_doi"), F.year("created").alias("year"), F.coalesce(F.col("authors.author.keyname"), F.array().cast("array<string>")).alias("last_names")), "arxiv")


def pwc_metadata(papers: DataFrame) -> DataFrame:
    """Full names: the last name is taken when they are normalised."""
    return _standard(papers.select(F.col("paper_url").alias("id"), "title", "abstract", F.year("date").alias("year"), F.col("authors").alias("last_names")), "pwc")


def _present(names: Column) -> Column:
    """Without nulls; null if nothing is left."""
    kept = F.filter(names, lambda n: n.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def openalex_metadata(works: DataFrame) -> DataFrame:
    rows = works.where(allowed(F.col("type"), OPENALEX_LEFT_OUT))
    return _standard(rows.select("id", "title", "abstract", bare_doi(F.col("doi")).alias("clean_doi"), F.col("publication_year").alias("year"), _present(F.col("authorships.author.display_name")).alias("last_names"), sorted_list(F.col("referenced_works")).alias("references")), "openalex")


def s2_metadata(papers: DataFrame, abstracts: DataFrame, citations: DataFrame) -> DataFrame:
    """Cited ids are sorted as numbers. ``citations`` is summed by citing paper before it is joined."""
    cited = citations.groupBy(F.col("citingcorpusid").alias("corpusid")).agg(F.collect_list("citedcorpusid").alias("_cited"))
    cited = cited.select("corpusid", sorted_list(F.col("_cited")).alias("references"))
    rows = papers.where(any_allowed(F.col("publicationtypes"), S2_LEFT_OUT)).join(abstracts.select("corpusid", "abstract"), "corpusid", "left").join(cited, "corpusid", "left")
    return _standard(rows.select(F.col("corpusid").alias("id"), "title", "abstract", bare_doi(F.col("externalids.DOI")).alias("clean_doi"), F.year("publicationdate").alias("year"), _present(F.col("authors.name")).alias("last_names"), "references"), "s2")


def lens_records(records: DataFrame) -> DataFrame:
    """One row for each record, with its DOIs as an array ``_dois``; lists are put in order here, once for each record."""
    rows = records.where(allowed(F.col("publication_type"), LENS_LEFT_OUT))
    dois = F.transform(F.filter("external_ids", lambda e: e["type"] == "doi"), lambda e: F.lower(e["value"]))
    refs = F.array_join(F.sort_array(F.col("references.lens_id")), ",")
    out = rows.select(F.col("lens_id").alias("id"), "title", "abstract", F.col("year_published").alias("year"), _present(F.col("authors.last_name")).alias("last_names"), F.nullif(refs, F.lit("")).alias("references"), dois.alias("_dois"))
    return _standard(out, "lens", "_dois")


def by_doi(rows: DataFrame) -> DataFrame:
    """A row for each of ``_dois``; one with none gives one row."""
    return rows.select(*(F.explode_outer("_dois").alias(c) if c == "clean_doi" else c for c in COLUMNS))


def lens_metadata(records: DataFrame) -> DataFrame:
    """A record with several DOIs gives a row for each; one with none gives one row."""
    return by_doi(lens_records(records))


def remapped(meta: DataFrame, sources: DataFrame) -> DataFrame:
    """A second copy of each row whose references all map, one to one, to merged ids of the last run."""
    cited = meta.select("id", F.explode(F.split("references", ",")).alias("orig_id")).join(sources.select("orig_id", "merged_id"), "orig_id")
    mapped = cited.groupBy("id").agg(F.collect_set("merged_id").alias("_mapped"))
    both = meta.join(mapped, "id").where(F.size(F.split("references", ",")) == F.size("_mapped"))
    return both.withColumn("references", F.array_join(F.array_sort("_mapped"), ",")).select(*COLUMNS)


def union_metadata(sources: DataFrame | None, *catalogues: DataFrame) -> DataFrame:
    """All catalogues' rows and, given the last run's sources, the remapped copies."""
    meta = reduce(DataFrame.unionByName, (c.select(*COLUMNS) for c in catalogues))
    return meta if sources is None else meta.unionByName(remapped(meta, sources))


# Links that the catalogues themselves give


def both_ways(pairs: DataFrame) -> DataFrame:
    a, b = pairs.columns[:2]
    return pairs.select(F.col(a).alias("id1"), F.col(b).alias("id2")).unionByName(pairs.select(F.col(b).alias("id1"), F.col(a).alias("id2")))


def lens_links(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Lens to OpenAlex (of ids that take part) and lens to its aliases (of all), both ways."""
    ext = records.select("lens_id", F.explode("external_ids").alias("e")).where(F.col("e.type") == "openalex").join(ids.select(F.col("id").alias("lens_id")), "lens_id", "left_semi")
    to_works = ext.select(F.col("lens_id").alias("id1"), F.concat(F.lit(OPENALEX_LINK), F.col("e.value")).alias("id2"))
    aliases = records.select(F.col("lens_id").alias("id1"), F.explode("alias_lens_ids").alias("id2"))
    return both_ways(to_works.unionByName(aliases))


def arxiv_id_of(url: Column) -> Column:
    """What follows the last of the known folders, without ``.pdf``; the version stays."""
    return F.replace(F.regexp_replace(url, ".*(/ftp/arxiv/papers/|/pdf/|/abs/)", ""), F.lit(".pdf"), F.lit(""))


def openalex_arxiv_links(works: DataFrame) -> DataFrame:
    url = F.col("open_access.oa_url")
    return both_ways(works.where(F.lower(url).like("%/arxiv.org%")).select(F.col("id").alias("id1"), arxiv_id_of(url).alias("id2")))


def arxiv_pwc_links(arxiv: DataFrame, pwc: DataFrame) -> DataFrame:
    """Papers with an arXiv id, both ways; the linkage takes them in only if asked to."""
    known = arxiv.select(F.col("id").alias("arxiv_id"))
    return both_ways(pwc.select("arxiv_id", F.col("paper_url").alias("id2")).join(known, "arxiv_id").select(F.col("arxiv_id").alias("id1"), "id2"))
