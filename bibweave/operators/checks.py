"""Data-quality gates: each gives one row (check_name, passed, found), found being what speaks against it."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.operators.keys import RULES, stacked
from bibweave.scratch import Scratch

#: Share of the last run's rows that a table must have at least.
LEAST_SHARE = 0.8


def _row(df: DataFrame, name: str, passed, found) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), passed.alias("passed"), found.cast("long").alias("found"))


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """No value of ``key`` twice; nulls do not count. ``found`` is the number of surplus rows."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n"))
    return _row(per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), name, F.col("n") == 0, F.col("n"))


def none_of(bad: DataFrame, name: str) -> DataFrame:
    return _row(bad.agg(F.count(F.lit(1)).alias("n")), name, F.col("n") == 0, F.col("n"))


def not_shrunk(new: DataFrame, old: DataFrame, name: str, share: float = LEAST_SHARE) -> DataFrame:
    """``found`` is the number of rows."""
    both = new.select(F.lit(1).alias("new"), F.lit(0).alias("old")).unionByName(old.select(F.lit(0).alias("new"), F.lit(1).alias("old")))
    sums = both.agg(F.coalesce(F.sum("new"), F.lit(0)).alias("new"), F.coalesce(F.sum("old"), F.lit(0)).alias("old"))
    return _row(sums, name, F.col("new") >= F.col("old") * F.lit(share), F.col("new"))


def unique_input_ids(ids: DataFrame) -> DataFrame:
    return unique(ids, "id", "unique_input_ids")


def unique_sources(sources: DataFrame) -> DataFrame:
    return unique(sources, "orig_id", "unique_sources")


def all_ids_survived(ids: DataFrame, sources: DataFrame) -> DataFrame:
    return none_of(ids.select(F.col("id").alias("orig_id")).join(sources, "orig_id", "left_anti"), "all_ids_survived")


def all_matches_survived(matches: DataFrame, sources: DataFrame, unlink: DataFrame) -> DataFrame:
    """Each matched pair has one merged id, unless it is unlinked."""
    own = lambda c: sources.select(F.col("orig_id").alias(f"all{c}_id"), F.col("merged_id").alias(f"_m{c}"))
    held = unlink.select(F.col(unlink.columns[0]).alias("all1_id"), F.col(unlink.columns[1]).alias("all2_id"))
    apart = matches.join(own(1), "all1_id", "left").join(own(2), "all2_id", "left").where("_m1 is null or _m2 is null or _m1 != _m2")
    return none_of(apart.join(held, ["all1_id", "all2_id"], "left_anti"), "all_matches_survived")


def _weights(rules: tuple[tuple[str, ...], ...]) -> dict[tuple[str, ...], int]:
    """By inclusion and exclusion, for sets of keys: a pair of rows that agree in just the keys E is matched by a rule
    if and only if the weights of the sets within E sum up to 1, and else they sum up to 0."""
    keys = tuple(dict.fromkeys(k for r in rules for k in r))
    weight: dict[tuple[str, ...], int] = {}
    for n in range(1, len(keys) + 1):
        for s in combinations(keys, n):
            weight[s] = int(any(set(r) <= set(s) for r in rules)) - sum(w for t, w in weight.items() if set(t) < set(s))
    return {s: w for s, w in weight.items() if w}


def keys_survived(rows: DataFrame, sources: DataFrame, unlink: DataFrame, rules=RULES, scratch: Scratch | None = None) -> DataFrame:
    """``all_matches_survived`` of the pairs that ``rules`` give, without making them.

    ``rows`` has id and hashed keys, as ``hashed_keys`` gives them. Pairs that agree in a set of
    keys are counted as squares of the sizes of its groups, less those with one
    merged id, and the rules are summed up by inclusion and exclusion. Only ids
    with several rows are matched pair by pair.
    """
    scratch = scratch or Scratch(rows.sparkSession)
    weights = _weights(rules)
    keys = [k for k in dict.fromkeys(k for r in rules for k in r)]
    rows = rows.select("id", *keys)
    several = scratch.save(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("_id")))
    repeated = not several.isEmpty()
    merged = sources.select(F.col("orig_id").alias("_id"), F.col("merged_id").alias("_m"))
    one = rows.join(several, F.col("id").eqNullSafe(F.col("_id")), "left_anti") if repeated else rows
    one = scratch.save(one.join(merged, F.col("id") == F.col("_id"), "left").drop("_id"))
    # the sets of a row are found by bits, and only then hashed
    bit = {k: 1 << n for n, k in enumerate(keys)}
    sets = F.array(*(F.struct(F.lit(sum(bit[k] for k in s)).alias("set"), F.lit(w).alias("w")) for s, w in weights.items()))
    own = reduce(Column.bitwiseOR, (F.when(F.col(k).isNotNull(), F.lit(bit[k])).otherwise(F.lit(0)) for k in keys))
    in_sets = one.withColumn("_own", own).where("_own != 0").select("_m", "_own", *keys, F.explode(sets).alias("g")).where(F.col("_own").bitwiseAND(F.col("g.set")) == F.col("g.set"))
    values = [F.when(F.col("g.set").bitwiseAND(F.lit(bit[k])) != 0, F.col(k)) for k in keys]
    in_sets = in_sets.select("_m", "g.w", F.col("g.set").alias("i"), F.xxhash64("g.set", *values).alias("h1"), F.xxhash64(*values, F.col("g.set") + 1000).alias("h2"))
    together_ = in_sets.groupBy("w", "i", "h1", "h2", "_m").agg(F.count(F.lit(1)).alias("n"))
    sizes = together_.groupBy("w", "i", "h1", "h2").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_m").isNotNull(), F.col("n") * F.col("n")).otherwise(0)).alias("same"))
    counted = sizes.select((F.col("w") * (F.col("n") * F.col("n") - F.col("same"))).alias("n"))

    def end(n: int) -> DataFrame:
        return one.select(*(F.col(c).alias(f"{c}{n}") for c in one.columns))

    apart = F.col("_m1").isNull() | F.col("_m2").isNull() | (F.col("_m1") != F.col("_m2"))
    held = unlink.select(F.col(unlink.columns[0]).alias("id1"), F.col(unlink.columns[1]).alias("id2")).distinct()
    matched = reduce(Column.__or__, (reduce(Column.__and__, (F.col(f"{k}1") == F.col(f"{k}2") for k in r)) for r in rules))
    spared = held.join(end(1), "id1").join(end(2), "id2").where(matched & apart).select(F.lit(-1).cast("long").alias("n"))
    total = counted.unionByName(spared)
    if repeated:
        stack = scratch.save(stacked(rows, rules, hashed=True))
        some = stack.join(several, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
        ends = some.select("rule", "key", F.col("id").alias("id1")).join(stack.select("rule", "key", F.col("id").alias("id2")), ["rule", "key"]).select("id1", "id2").distinct()
        # pairs whose second id has one row are there in one order only
        twice = ends.join(several, F.col("id2").eqNullSafe(F.col("_id")), "left_anti").select(F.col("id2").alias("id1"), F.col("id1").alias("id2"))
        pairs = ends.unionByName(twice)
        m = lambda n: merged.select(F.col("_id").alias(f"id{n}"), F.col("_m").alias(f"_m{n}"))
        bad = pairs.join(m(1), "id1", "left").join(m(2), "id2", "left").where(apart).join(held, ["id1", "id2"], "left_anti")
        total = total.unionByName(bad.select(F.lit(1).cast("long").alias("n")))
    return _row(total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "all_matches_survived", F.col("n") == 0, F.col("n"))


def no_nulls(df: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    return none_of(df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))), name)


def together(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


class GateError(RuntimeError):
    pass


def enforce(results: DataFrame) -> None:
    """Raises GateError with the names of the gates that failed (one row each)."""
    failed = [f"{r.check_name} ({r.found})" for r in results.where("not passed").collect()]
    if failed:
        raise GateError(", ".join(failed))
