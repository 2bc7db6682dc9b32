"""Groups of ids and merged ids that stay from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.operators.components import connected_components
from bibweave.operators.match import MOST_TASKS
from bibweave.scratch import Scratch

#: Fixed value: how merged ids are written, before ten digits or more.
PREFIX = "carticle_"
#: Rows of one block of the hand-made list; pairs are made block by block.
BLOCK_ROWS = 4096
#: A short list is cut into up to so many blocks of at least so many rows, to give every core work.
SHORT_BLOCKS, SHORT_ROWS = 8, 256


def symmetric(unlink: DataFrame) -> DataFrame:
    a, b = unlink.columns[:2]
    return unlink.select(F.col(a).alias("id1"), F.col(b).alias("id2")).unionByName(unlink.select(F.col(b).alias("id1"), F.col(a).alias("id2"))).distinct()


def match_groups(pairs: DataFrame, unlink: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """(root, orig_id): connected components of the pairs, ``root`` the least id.

    An unlinked pair only takes that edge away; both of its ids stay, and may
    still meet through a third.
    """
    scratch = scratch or Scratch(pairs.sparkSession)
    a, b = pairs.columns[:2]
    edges = pairs.select(F.least(a, b).alias("id1"), F.greatest(a, b).alias("id2")).where(f"`{a}` is not null and `{b}` is not null")
    return grouped(edges.where("id1 != id2"), edges.select(F.explode(F.array("id1", "id2")).alias("id")), unlink, scratch)


def grouped(edges: DataFrame, ids: DataFrame, unlink: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """The same from edges (id1, id2) and all ids: those without an edge take no part in the rounds."""
    scratch = scratch or Scratch(edges.sparkSession)
    edges = edges.where("id1 is not null and id2 is not null").select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"))
    cut = edges if unlink is None else edges.join(symmetric(unlink), ["id1", "id2"], "left_anti")
    found = connected_components(cut, scratch)
    every = ids.select(F.col(ids.columns[0]).alias("node")).where("node is not null").distinct()
    return every.join(found, "node", "left").select(F.coalesce("component", "node").alias("root"), F.col("node").alias("orig_id"))


def numbered(df: DataFrame, by: str, out: str, scratch: Scratch | None = None) -> DataFrame:
    """Adds 1, 2, ... in the order of ``by``, whose values are distinct, without one task for all rows.

    Rows are dealt by range and numbered within each part; the parts' counts
    (one row for each part) give what to add.
    """
    scratch = scratch or Scratch(df.sparkSession)
    parts = scratch.save(df.repartitionByRange(by).sortWithinPartitions(by).withColumn("_at", F.monotonically_increasing_id()))
    counts = parts.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    out_ = parts.withColumn("_part", F.shiftright("_at", 33)).join(counts, "_part")
    return out_.withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).select(*df.columns, out)


def written(number, prefix: str = PREFIX):
    return F.format_string(f"{prefix}%010d", number)


def assign_ids(groups: DataFrame, previous: DataFrame | None = None, dropped: DataFrame | None = None, prefix: str = PREFIX, highest: int = 0, scratch: Scratch | None = None) -> DataFrame:
    """(merged_id, orig_id). A group keeps a merged id if its members had just this one, it is not
    dropped, and none of its former members is missing; other groups get new ids, in the order of their roots.

    New numbers follow the highest one of ``previous``, or ``highest`` if that
    is greater: without it, a number that vanished with the last run can be
    given out again. Raises ValueError if ``previous`` lists an id twice.
    """
    scratch = scratch or Scratch(groups.sparkSession)
    if previous is None:
        previous = groups.sparkSession.createDataFrame([], "merged_id string, orig_id string")
    previous = previous.select("merged_id", "orig_id")
    if not previous.groupBy("orig_id").count().where("count > 1").isEmpty():
        raise ValueError("the previous mapping lists an id twice")
    most = previous.agg(F.max(F.substring(F.col("merged_id"), len(prefix) + 1, 30).cast("long"))).first()[0]
    held = previous.groupBy("merged_id").agg(F.count(F.lit(1)).alias("members"))
    if dropped is not None:
        held = held.join(dropped.select("merged_id"), "merged_id", "left_anti")
    prior = groups.join(previous, "orig_id", "left").groupBy("root").agg(F.min("merged_id").alias("merged_id"), F.max("merged_id").alias("last"), F.count("merged_id").alias("have"))
    kept = prior.where("merged_id = last").join(held, "merged_id").where("have = members").select("root", F.col("merged_id").alias("kept_id"))
    roots = scratch.save(prior.select("root").join(kept, "root", "left"))
    fresh = numbered(roots.where("kept_id is null").select("root"), "root", "n", scratch)
    new = fresh.select("root", written(F.col("n") + F.lit(max(most or 0, highest)), prefix).alias("merged_id"))
    named = roots.where("kept_id is not null").select("root", F.col("kept_id").alias("merged_id")).unionByName(new)
    return groups.join(named, "root").select("merged_id", "orig_id")


def unlink_pairs(groups: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id1, id2) of all ids that a person put in different groups (manual_id, orig_id), both ways.

    The result is quadratic by its meaning, as every id is told apart from those of all
    other groups. The list is cut into blocks of about ``block_rows`` by a hash of the row; each
    pair of blocks is a key of its own, so a task holds two blocks however long the list is.
    The blocks are small in bytes and their pairs are many, so they are dealt to a given number
    of tasks, which Spark doesn't merge by size.
    """
    groups = groups.select("manual_id", "orig_id").distinct()
    rows = groups.count()
    blocks = max(1, -(-rows // block_rows), min(SHORT_BLOCKS, rows // SHORT_ROWS))
    tasks = min(MOST_TASKS, 2 * blocks * blocks)
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    own = F.pmod(F.xxhash64("manual_id", "orig_id"), F.lit(blocks)).cast("int")
    left = groups.select(own.alias("a"), F.explode(every).alias("b"), F.col("manual_id").alias("own"), F.col("orig_id").alias("id1"))
    right = groups.select(F.explode(every).alias("a"), own.alias("b"), F.col("manual_id").alias("other"), F.col("orig_id").alias("id2"))
    return left.repartition(tasks, "a", "b").join(right.repartition(tasks, "a", "b").hint("merge"), ["a", "b"]).where("own != other").select("id1", "id2")


def ids_to_drop(sources: DataFrame, unlink: DataFrame) -> DataFrame:
    """Merged ids with a member that is first in an unlinked pair; they are never used again."""
    return sources.join(unlink.select(F.col("id1").alias("orig_id")), "orig_id", "left_semi").select("merged_id").distinct()


def sources(mapping: DataFrame, metadata: DataFrame) -> DataFrame:
    """(merged_id, orig_id, dataset) of ids that a catalogue has; ids known from links alone go."""
    return mapping.join(metadata.select(F.col("id").alias("orig_id"), "dataset").distinct(), "orig_id").select("merged_id", "orig_id", "dataset")


def references(metadata: DataFrame, sources_: DataFrame) -> DataFrame:
    """Distinct (merged_id, ref_id): citations with both ends in ``sources_``."""
    known = sources_.select("merged_id", "orig_id").distinct()
    cited = metadata.select("id", F.explode(F.split("references", ",")).alias("ref")).distinct()
    out = cited.join(known.select(F.col("orig_id").alias("ref"), F.col("merged_id").alias("ref_id")), "ref").join(known.select(F.col("orig_id").alias("id"), "merged_id"), "id")
    return out.select("merged_id", "ref_id").distinct()
