"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target (in words) and a weight schedule over training time
t in [0, 1]: density ``1 - slope + 2 * slope * t``, whose integral
``F(t) = (1 - slope) * t + slope * t * t`` is the share of the target that is
due by t.  Documents of a source stand in a seeded order and are walked through
as often as the target asks; a document whose middle word is the u-th part of
the target is due where ``F(t) = u``, found by inverting F.  Sorting all
documents by t (a range sort) gives the training order.

Texts are read once, for the number of their words; the schedule is made of rows
of some fifty bytes, and texts are moved only to where the order puts them.

Defined cases: null, empty and blank texts have size 0, are never taken and
have no position. Rows with a null source form one source, the last. Repeated
rows count each for itself; rows without an id are ordered by their text. An
empty table gives an empty table. Of further columns of the input none is read;
``mix`` hands them on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibweave.llm.ranking import digits_for, hashed, running, source_key
from bibweave.scratch import Scratch
from bibweave.sources.files import numbered_rows

#: Weights of the sources in code-point order, repeated as needed.
WEIGHTS = (5, 2, 1)
#: Slopes of their schedules: the first wanes, the last grows.
SLOPES = (-0.5, 0.0, 0.5)
#: Words to draw as a share of all words, and times a source may be walked through.
SHARE, MOST = 1.5, 2
SEED = "mix-1"


def words(col: str = "text") -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit("[^\\x20\\x09-\\x0D]++")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Rows (source_key, source_size) -> the same with weight, slope index and target.

    One row per source. Water-filling: sources are sorted by how soon their cap
    (``most`` times their size) is reached, and the level is the first at which
    what is left over, dealt by weight, stays below all other caps. Only this
    table of per-source sums is ordered as a whole.
    """
    every = Window.partitionBy(F.lit(0))
    r = sizes.withColumn("n", F.row_number().over(every.orderBy("source_key")) - 1)
    r = r.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("n") % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * most
    by_ratio = every.orderBy((cap / F.col("weight")), "n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("cap", cap)
    r = r.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    r = r.withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    r = r.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - F.col("capped")) / F.col("open"))
    r = r.withColumn("at", F.row_number().over(by_ratio))
    r = r.withColumn("final", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("at", "level"))).over(every)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce("final", F.lit(float("inf"))) * F.col("weight"))
    return r.select("source_key", "n", "source_size", target.alias("target"))


def schedule(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, slopes=SLOPES, seed: str = SEED, row: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, positions.

    ``positions`` are the training positions of its takes (empty if there is none); ``copies`` says how often it is taken. The column
    named ``row`` follows as ``row``, as does ``h``, the hash that orders the source.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    base = scratch.save(docs.select(F.col("doc_id").alias("doc_id"), source_key().alias("source_key"), words().alias("size"), hashed(seed).alias("h"), *([F.col(row).alias("row")] if row else [])))
    sources = base.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    goal = targets(sources, weights, share, most)
    digits = digits_for(base.count())
    base = base.withColumn("cell", F.substring("h", 1, digits))
    at = running(base, ["source_key"], "cell", digits, ["h", "size"], "size", "start").join(goal, "source_key")
    slope = F.element_at(F.array(*map(F.lit, slopes)), (F.col("n") % len(slopes) + 1).cast("int"))

    def due(cycle: int) -> Column:
        middle = F.col("start") + F.col("source_size") * cycle + F.col("size") / F.lit(2.0)
        u = middle / F.col("target")
        b = F.lit(1.0) - slope
        t = F.when(slope == 0, u).otherwise((F.sqrt(b * b + 4 * slope * u) - b) / (2 * slope))
        return F.when((F.col("size") > 0) & (middle < F.col("target")), t)

    times = F.filter(F.array(*(due(c) for c in range(most))), lambda t: t.isNotNull())
    return at.select("doc_id", "size", "source_size", "target", F.size(times).cast("long").alias("copies"), times.alias("positions"), "h", *(["row"] if row else []))


def in_order(plan: DataFrame, position: str, *ties: str) -> DataFrame:
    """Range-partitioned and sorted by position.

    Positions lie in [0, 1), and schedules integrate to the same demand
    everywhere, give or take their slopes; so equal steps hold about equal
    numbers of words, and no sample is needed to find the ranges. Rows without
    a position are dealt to all parts by their hash.
    """
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.least(F.floor(F.col(position) * parts), F.lit(parts - 1))
    rest = F.pmod(F.xxhash64(*ties), F.lit(parts))
    return plan.repartitionById(parts, F.when(F.col(position).isNull(), rest).otherwise(own).cast("int")).sortWithinPartitions(position, *ties)


def mix(docs: DataFrame, position: str | None = None, take: str | None = None, scratch: Scratch | None = None, **options) -> DataFrame:
    """The documents in training order, one row per take, with all their columns.

    A document is emitted as often as it is taken; those not taken go. Rows are
    range-partitioned and sorted by position, so a table written of them lists
    them in training order. ``position`` and ``take`` name columns to add, if these are wanted.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    inner = docs.select(*(F.col(f"`{c}`").alias(f"_c_{i}") for i, c in enumerate(docs.columns)))  # input columns keep clear of the ones made here
    own = {c: F.col(f"_c_{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text", "source")}
    rows = numbered_rows(inner, "_row", scratch)
    plan = schedule(rows.select(*own.values(), "_row"), row="_row", scratch=scratch, **options)
    takes = plan.select(F.col("row").alias("_row"), F.posexplode("positions").alias("_take", "_position"))
    out = in_order(rows.join(takes, "_row"), "_position", "_row", "_take")
    more = [F.col(x).alias(name) for x, name in (("_position", position), ("_take", take)) if name]
    return out.select(*(F.col(f"_c_{i}").alias(c) for i, c in enumerate(docs.columns)), *more)
