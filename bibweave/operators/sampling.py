"""Samples of merged articles and of pairs for human judges.

Every order is total, so that a sample can be drawn again: where chance is
wanted, ids are ordered by a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibweave.functions.describe import article_desc
from bibweave.sources.catalogues import DOI_LINK

#: Fixed values: (label, least size, greatest size, articles to draw).
BINS = (
    ("count_2", 2, 2, 25), ("count_3", 3, 3, 25), ("count_4", 4, 4, 25), ("count_5", 5, 5, 25), ("count_6", 6, 6, 5), ("count_7", 7, 7, 5),
    ("count_8", 8, 8, 5), ("count_9", 9, 9, 5), ("count_10", 10, 10, 5), ("count_11_15", 11, 15, 50),
)
TOP_CITED = 50
PREFIX_CHARS, PREFIX_PAIRS, REFERENCE_PAIRS = 100, 3000, 1000


def by_chance(key: Column, seed: int = 1) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def stratified(sources: DataFrame, bins=BINS, seed: int = 1) -> DataFrame:
    """(merged_id, bin): so many articles of each size. A bin's rows are first cut to its share in each task."""
    sizes = sources.select("merged_id", "orig_id").distinct().groupBy("merged_id").agg(F.count(F.lit(1)).alias("_n"))
    label, quota = F.lit(None).cast("string"), F.lit(0)
    for name, low, high, n in bins:
        inside = F.col("_n").between(low, high)
        label, quota = F.when(inside, F.lit(name)).otherwise(label), F.when(inside, F.lit(n)).otherwise(quota)
    rows = sizes.select("merged_id", label.alias("bin"), quota.alias("_quota"), by_chance(F.col("merged_id"), seed).alias("_h")).where("bin is not null")
    # of each of 256 parts of a bin, no more than the bin's quota can be drawn
    order = [F.col("_h"), F.col("merged_id")]
    part = Window.partitionBy("bin", F.substring("_h", 1, 2)).orderBy(*order)
    rows = rows.withColumn("_k", F.row_number().over(part)).where("_k <= _quota")
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy("bin").orderBy(*order))).where("_k <= _quota").select("merged_id", "bin")


def top_cited(references: DataFrame, taken: DataFrame, n: int = TOP_CITED) -> DataFrame:
    """(merged_id, bin): the most cited articles that are not taken yet."""
    counts = references.select(F.col("ref_id").alias("merged_id"), F.col("merged_id").alias("citing")).distinct().groupBy("merged_id").agg(F.count(F.lit(1)).alias("_n"))
    rest = counts.join(taken.select("merged_id"), "merged_id", "left_anti")
    return rest.orderBy(F.desc("_n"), "merged_id").limit(n).select("merged_id", F.lit("high_citation").alias("bin"))


def _authors(names: Column) -> Column:
    return F.array_join(F.reverse(F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull())))), ", ")


def _link(doi: Column) -> Column:
    return F.concat(F.lit(DOI_LINK), doi)


def positive_matches(sample: DataFrame, sources: DataFrame, metadata: DataFrame) -> DataFrame:
    """(merged_id, bin, orig_id, metadata) of the members of sampled articles; those without a name are left out."""
    rows = sample.join(sources.select("merged_id", "orig_id").distinct(), "merged_id").join(metadata.withColumnRenamed("id", "orig_id").where("size(last_names) > 0"), "orig_id")
    one = rows.groupBy("orig_id").agg(
        F.max("merged_id").alias("merged_id"), F.max("bin").alias("bin"), F.max("title").alias("title"), F.max("abstract").alias("abstract"), F.max("year").alias("year"),
        F.max(_link(F.col("clean_doi"))).alias("doi"), _authors(F.flatten(F.collect_set("last_names"))).alias("authors"),
    )
    return one.select("merged_id", "bin", "orig_id", article_desc(F.col("title"), F.col("abstract"), F.col("year"), F.col("doi"), F.col("authors")).alias("metadata"))


def pairs_within(rows: DataFrame, key: str = "merged_id") -> DataFrame:
    """Pairs of described articles of one sampled group, each once."""
    a = rows.select(key, F.col("orig_id").alias("orig_id1"), F.col("metadata").alias("metadata1"))
    b = rows.select(key, F.col("orig_id").alias("orig_id2"), F.col("metadata").alias("metadata2"))
    return a.join(b, key).where("orig_id1 > orig_id2")


def _spread(col: str) -> Column:
    """A part, of 256, for ranking a large group in two steps."""
    return F.pmod(F.xxhash64(col), F.lit(256))


def prefix_pairs(metadata: DataFrame, sources: DataFrame, n: int = PREFIX_PAIRS, chars: int = PREFIX_CHARS) -> DataFrame:
    """The first ``n`` pairs, by their ids, of articles whose abstracts start alike but that are not merged.

    A row has as many partners as its prefix has rows of other merged ids. Of
    each prefix only those first rows are paired whose partners add up to
    ``n``, so that a prefix of a third of all rows gives about as many pairs as rows.
    """
    rows = metadata.where((F.char_length("abstract") > chars) & (F.size("last_names") > 0)).select(
        F.col("id").alias("orig_id"), F.substring("abstract", 1, chars).alias("_p"),
        article_desc(F.col("title"), F.col("abstract"), F.col("year"), _link(F.col("clean_doi")), F.array_join("last_names", ", ")).alias("meta"),
    ).distinct().join(sources.select("orig_id", "merged_id").distinct(), "orig_id").withColumn("_p", F.md5(F.col("_p").cast("binary")))
    own = rows.groupBy("_p", "merged_id").agg(F.count(F.lit(1)).alias("_own"))
    whole = own.groupBy("_p").agg(F.sum("_own").alias("_whole"))
    many = own.join(whole, "_p").select("_p", "merged_id", (F.col("_whole") - F.col("_own")).alias("_partners")).where("_partners > 0")
    first = rows.join(many, ["_p", "merged_id"])
    order = ["orig_id", "meta"]
    first = first.withColumn("_k", F.row_number().over(Window.partitionBy("_p", _spread("orig_id")).orderBy(*order))).where(F.col("_k") <= n)
    before = F.coalesce(F.sum("_partners").over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.withColumn("_before", before).where(F.col("_before") < n)
    a = first.select("_p", F.col("orig_id").alias("orig_id1"), F.col("merged_id").alias("_m1"), F.col("meta").alias("metaset1"))
    b = rows.select("_p", F.col("orig_id").alias("orig_id2"), F.col("merged_id").alias("_m2"), F.col("meta").alias("metaset2"))
    out = a.join(b, "_p").where("orig_id1 != orig_id2 and _m1 != _m2").select("orig_id1", "orig_id2", "metaset1", "metaset2")
    return out.orderBy("orig_id1", "orig_id2", "metaset1", "metaset2").limit(n)


def reference_pairs(metadata: DataFrame, n: int = REFERENCE_PAIRS) -> DataFrame:
    """The first ``n`` pairs, by their ids, of articles with equal (remapped) references, each once.

    The first m ids of a group make m * (m - 1) / 2 pairs: no more are needed than give ``n``.
    """
    rows = metadata.where("size(last_names) > 0 and references is not null").groupBy("id", "title", "abstract", "year", "clean_doi", "references").agg(_authors(F.flatten(F.collect_set("last_names"))).alias("authors"))
    rows = rows.select(F.col("id").alias("orig_id"), F.md5(F.col("references").cast("binary")).alias("_r"), article_desc(F.col("title"), F.col("abstract"), F.col("year"), _link(F.col("clean_doi")), F.col("authors")).alias("metadata"))
    m = int((2 * n) ** 0.5) + 2
    for keys in (["_r", _spread("orig_id")], ["_r"]):
        rows = rows.withColumn("_k", F.dense_rank().over(Window.partitionBy(*keys).orderBy("orig_id"))).where(F.col("_k") <= m).drop("_k")
    return pairs_within(rows, "_r").drop("_r").orderBy("orig_id1", "orig_id2", "metadata1", "metadata2").limit(n)
