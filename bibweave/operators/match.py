"""Pairs of ids that match, and the edges that group them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.operators.keys import RULES, stacked
from bibweave.scratch import Scratch

THREE_KEYS = ("last_names_norm", "references", "clean_doi")
#: Tasks that pairs are dealt to, at most, and pairs of one task.
MOST_TASKS, TASK_PAIRS = 8192, 4_000_000
#: Ids of one block of a large group; groups of up to so many ids don't weigh in the number of tasks.
BLOCK, LEAST_CROWD = 2048, 64


def match(df: DataFrame, strong: str, other: str) -> DataFrame:
    """All distinct (all1_id, all2_id) with equal values of both keys, an id with itself included.

    The result is the pairs themselves; for groups alone, ``group_edges`` needs far fewer.
    """
    return key_pairs(stacked(df, ((strong, other),)))


def match_three(df: DataFrame) -> DataFrame:
    """Names, references and DOI alike; references of any length. Not among the rules of the linkage."""
    return key_pairs(stacked(df, (THREE_KEYS,), listed=False))


def metadata_match(df: DataFrame, rules=RULES) -> DataFrame:
    """Distinct pairs of all rules, in both orders, ids with themselves included."""
    return key_pairs(stacked(df, rules))


def key_pairs(keys: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The same from stacked keys; the keys are written, the pairs are not.

    Each row of a key carries the keys of its id that come before (the last
    rules first: references, which are not filtered, have the largest groups).
    Of the keys that two ids share only the first gives their pair, so pairs
    are distinct without being shuffled.  A group of more than ``BLOCK`` ids
    is cut into blocks, and each pair of blocks is a key of its own, so a task
    holds two blocks; the tasks are as many as the pairs ask for.
    """
    scratch = scratch or Scratch(keys.sparkSession)
    keys = scratch.save(keys.select("rule", "key", "id"))
    crowds = scratch.save(keys.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LEAST_CROWD))
    pairs = crowds.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0
    spark = keys.sparkSession
    tasks = min(MOST_TASKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(pairs // TASK_PAIRS)))
    if keys.select("rule").distinct().limit(2).count() > 1:
        of_id = keys.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("rule")).alias("at"), "key", F.xxhash64("rule", "key").alias("h")))).alias("own"))
        rows = of_id.select("id", F.posexplode("own").alias("pos", "k"), F.col("own.h").alias("hashes"))
        rows = rows.select("id", (-F.col("k.at")).alias("rule"), "k.key", F.slice("hashes", F.lit(1), F.col("pos")).alias("before"))
    else:
        # of one rule, only an id with several rows has keys before
        several = keys.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("own")).where(F.size("own") > 1)
        held = keys.join(several.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left")
        before = F.when(F.col("own").isNull(), F.array().cast("array<bigint>")).otherwise(F.transform(F.filter("own", lambda x: x < F.col("key")), lambda x: F.xxhash64(x)))
        rows = held.select("id", "rule", "key", before.alias("before"))
    large = crowds.where(F.col("n") > BLOCK).select("rule", "key", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("_parts"))
    rows = rows.join(large, ["rule", "key"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    every, own = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)), F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")
    by = ["rule", "key", "a", "b"]
    left = rows.select("rule", "key", own.alias("a"), every.alias("b"), F.col("id").alias("all1_id"), F.col("before").alias("before1")).repartition(tasks, *by)
    right = rows.select("rule", "key", every.alias("a"), own.alias("b"), F.col("id").alias("all2_id"), F.col("before").alias("before2")).repartition(tasks, *by)
    n1, n2 = F.size("before1"), F.size("before2")
    first = F.when((n1 == 0) | (n2 == 0), True).when((n1 == 1) & (n2 == 1), F.get("before1", F.lit(0)) != F.get("before2", F.lit(0))).otherwise(~F.arrays_overlap("before1", "before2"))
    return left.join(right.hint("merge"), by).where(first).select("all1_id", "all2_id")


def self_pairs(df: DataFrame, *pairs: DataFrame) -> DataFrame:
    """(id, id) for each row whose id is first in none of the pairs; null ids there are passed over."""
    out = df.select(F.col("id").alias("id1"))
    for p in pairs:
        out = out.join(p.select(F.col(p.columns[0]).alias("id1")), "id1", "left_anti")
    return out.select("id1", F.col("id1").alias("id2"))


def all_match_pairs(df: DataFrame, matches: DataFrame, *links: DataFrame) -> DataFrame:
    """Distinct (id1, id2): matches, the catalogues' links (both ways), and ids on their own."""
    out = self_pairs(df, matches, *links).unionByName(matches.toDF("id1", "id2"))
    for x in links:
        out = out.unionByName(x.toDF("id1", "id2"))
    return out.distinct()


def every_pair(df: DataFrame, keys: DataFrame, *links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The same as ``all_match_pairs`` from stacked keys: only ids on their own and links are shuffled, no matches.

    An id with a key matches itself, so ids on their own are those without key and link.
    """
    scratch = scratch or Scratch(keys.sparkSession)
    keys = scratch.save(keys.select("rule", "key", "id"))
    rest = self_pairs(df, keys.select("id"), *links)
    rest = rest.join(keys.where("id is null").select(F.col("id").alias("_id")).distinct(), F.col("id1").eqNullSafe(F.col("_id")), "left_anti")
    linked = [x.toDF("id1", "id2") for x in links]
    if linked:
        linked = reduce(DataFrame.unionByName, linked).distinct()
        ends = [keys.select(F.col("id").alias(f"_id{i}"), "rule", "key") for i in (1, 2)]
        found = linked.join(ends[0], F.col("id1").eqNullSafe(F.col("_id1"))).join(ends[1].withColumnsRenamed({"rule": "_rule", "key": "_key"}), F.col("id2").eqNullSafe(F.col("_id2")) & (F.col("rule") == F.col("_rule")) & (F.col("key") == F.col("_key")))
        found = found.select(F.col("id1").alias("_a"), F.col("id2").alias("_b")).distinct()
        rest = rest.unionByName(linked.join(found, F.col("id1").eqNullSafe(F.col("_a")) & F.col("id2").eqNullSafe(F.col("_b")), "left_anti"))
    return rest.distinct().unionByName(key_pairs(keys, scratch).toDF("id1", "id2"))


def group_edges(keys: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Edges (id1, id2) that group ids as all pairs of each (rule, key) would, less the unlinked pairs.

    Every member is tied to one hub: the least member that is unlinked from no
    other member. Such a hub ties the whole group together as all its pairs
    would. Only a group in which each member is unlinked from another is
    written out in full; it has at most as many members as the list of
    unlinked pairs has ids.  ``unlinked`` must be symmetric. Keys may be repeated.
    """
    if unlinked.isEmpty():
        marked = keys.withColumn("torn", F.lit(None).cast("boolean"))
    else:
        partners = keys.join(unlinked.select(F.col("id1").alias("id"), F.col("id2").alias("partner")), "id")
        torn = partners.join(keys.withColumnRenamed("id", "partner"), ["rule", "key", "partner"]).select("rule", "key", "id").distinct().withColumn("torn", F.lit(True))
        marked = keys.join(torn, ["rule", "key", "id"], "left")
    hubs = marked.groupBy("rule", "key").agg(F.min(F.when(F.col("torn").isNull(), F.col("id"))).alias("hub"), F.min("id").alias("least"), F.max("id").alias("last")).where("least != last").select("rule", "key", "hub")
    tied = keys.join(hubs, ["rule", "key"])
    stars = tied.where("hub is not null and hub != id").select(F.col("id").alias("id1"), F.col("hub").alias("id2"))
    if unlinked.isEmpty():
        return stars
    full = tied.where("hub is null").select("rule", "key", "id")
    pairs = full.select("rule", "key", F.col("id").alias("id1")).join(full.select("rule", "key", F.col("id").alias("id2")), ["rule", "key"]).where("id1 < id2").select("id1", "id2")
    return stars.unionByName(pairs.join(unlinked.select("id1", "id2"), ["id1", "id2"], "left_anti"))


def every_pair(df: DataFrame, keys: DataFrame, *links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The same as ``all_match_pairs`` from stacked keys: only ids on their own and links are shuffled, no matches.

    An id with a key matches itself, so ids on their own are those without key and link.
    """
    scratch = scratch or Scratch(keys.sparkSession)
    keys = scratch.save(keys.select("rule", "key", "id"))
    rest = self_pairs(df, keys.select("id"), *links)
    rest = rest.join(keys.where("id is null").select(F.col("id").alias("_id")).distinct(), F.col("id1").eqNullSafe(F.col("_id")), "left_anti")
    linked = [x.toDF("id1", "id2") for x in links]
    if linked:
        linked = reduce(DataFrame.unionByName, linked).distinct()
        ends = [keys.select(F.col("id").alias(f"_id{i}"), "rule", "key") for i in (1, 2)]
        found = linked.join(ends[0], F.col("id1").eqNullSafe(F.col("_id1"))).join(ends[1].withColumnsRenamed({"rule": "_rule", "key": "_key"}), F.col("id2").eqNullSafe(F.col("_id2")) & (F.col("rule") == F.col("_rule")) & (F.col("key") == F.col("_key")))
        found = found.select(F.col("id1").alias("_a"), F.col("id2").alias("_b")).distinct()
        rest = rest.unionByName(linked.join(found, F.col("id1").eqNullSafe(F.col("_a")) & F.col("id2").eqNullSafe(F.col("_b")), "left_anti"))
    return rest.distinct().unionByName(key_pairs(keys, scratch).toDF("id1", "id2"))


def group_edges(keys: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Edges (id1, id2) that group ids as all pairs of each (rule, key) would, less the unlinked pairs.

    Every member is tied to one hub: the least member that is unlinked from no
    other member. Such a hub ties the whole group together as all its pairs
    would. Only a group in which each member is unlinked from another is
    written out in full; it has at most as many members as the list of
    unlinked pairs has ids.  ``unlinked`` must be symmetric.
    """
    partners = keys.join(unlinked.select(F.col("id1").alias("id"), F.col("id2").alias("partner")), "id")
    torn = partners.join(keys.withColumnRenamed("id", "partner"), ["rule", "key", "partner"]).select("rule", "key", "id").distinct().withColumn("torn", F.lit(True))
    marked = keys.join(torn, ["rule", "key", "id"], "left")
    hubs = marked.groupBy("rule", "key").agg(F.min(F.when(F.col("torn").isNull(), F.col("id"))).alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    tied = keys.join(hubs, ["rule", "key"])
    stars = tied.where("hub is not null and hub != id").select(F.col("id").alias("id1"), F.col("hub").alias("id2"))
    full = tied.where("hub is null").select("rule", "key", "id")
    pairs = full.select("rule", "key", F.col("id").alias("id1")).join(full.select("rule", "key", F.col("id").alias("id2")), ["rule", "key"]).where("id1 < id2").select("id1", "id2")
    return stars.unionByName(pairs.join(unlinked.select("id1", "id2"), ["id1", "id2"], "left_anti"))
