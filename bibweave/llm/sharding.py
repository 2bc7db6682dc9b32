"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled by a seeded hash within each source; the i-th of n rows gets
the fractional rank (i + phase) / n, with a phase of the source's own, so that
each source is spread evenly over [0, 1). Rows sorted by fractional rank are cut
into equal runs, and each run holds the sources in the proportions of the whole,
give or take a row.  The law is ``rows``: counts differ by one at most.

Both ranks are running counts over cells of the order (see ``ranking``), so no
source and no shard is ever gathered into one task.

Defined cases: a null text has size 1 (its one separator) and checksum 0, as an
empty one; null sources form one source; repeated rows each get a slot; an empty
table gives an empty table; rows without an id are ordered by their text. Only
doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.ranking import digits_for, hashed, running, source_key

SHARDS = 8
SEED = 17


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = docs.count()
    digits = digits_for(rows)
    raw = F.encode(F.col("text"), "UTF-8")
    base = docs.select(
        "doc_id", source_key().alias("source_key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"), F.lit(1).cast("long").alias("one"),
        hashed(str(seed)).alias("h"), F.md5(F.coalesce(raw, F.lit("").cast("binary"))).alias("tie"),
    ).withColumn("cell", F.substring("h", 1, digits))
    totals = base.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(base, ["source_key"], "cell", digits, ["h", "tie"], "one", "i").join(totals, "source_key")
    # 2**48 steps, in decimals of 38 digits: exact for any number of rows, so that every task sorts alike
    phase = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), "source_key").cast("binary")), 1, 12), 16, 10).cast("decimal(15,0)")
    at = F.expr(f"(cast(i AS decimal(19,0)) * {1 << 48} + phase) div n")
    ranked = ranked.withColumn("phase", phase).withColumn("at", F.least(at, F.lit((1 << 48) - 1)))
    ranked = ranked.withColumn("reach", F.substring(F.lpad(F.hex("at"), 12, "0"), 1, digits))
    placed = running(ranked.select("doc_id", "size", "text_crc32", "one", "h", "source_key", "at", "reach", "tie"), [], "reach", digits, ["at", "source_key", "h", "tie"], "one", "rank")
    placed = placed.withColumn("shard", F.expr(f"(rank * {shards}) div {max(rows, 1)}").cast("int"))
    first = F.expr(f"(shard * {max(rows, 1)}L + {shards - 1}) div {shards}")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
