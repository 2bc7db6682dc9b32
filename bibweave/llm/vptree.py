"""Approximate nearest neighbours by vantage-point trees, one per shard.

Nearness is the cosine; the trees work on chords of the unit sphere, a metric,
so a subtree can be skipped if the triangle inequality puts it further away than
the best found so far.  ``factor`` relaxes the test: 1 keeps the search exact,
less skips more.

Equal vectors are one class that keeps its few smallest ids (others cannot come
before them).  Classes are dealt to shards by the nearest of some pivots, fitted
on a bounded sample; large cells are split by a hash.  Each query first searches
its own cell, then all shards that the bound found there does not rule out.
Queries of a shard are dealt in blocks, so no task gets more than a shard and a
block.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors are compared with
those of their own length only; ties go to the smaller id; rows that repeat an
id count once (the least vector for a query); with fewer candidates than asked
for all are returned; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.scratch import Scratch

#: Share of the best distance at which a subtree is skipped; see the README for the recall.
FACTOR = 0.75
SHARD_ROWS, QUERY_BLOCK, LEAF = 8192, 4096, 96
#: Bounds of what is fitted on the driver and sent to all tasks.
SAMPLE_ROWS, PIVOTS, SHARDS = 4096, 128, 65_536


def _matrix(column) -> np.ndarray:
    """A list column of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.empty((0, 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by powers of two, so that the largest component is near one: exact, and no product overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    y = _scaled(x)
    return y / np.sqrt((y * y).sum(axis=1, keepdims=True))


class Tree:
    """A vantage-point tree over the rows of ``x``; ``rank`` breaks ties (smaller first)."""

    def __init__(self, x: np.ndarray, rank: np.ndarray, leaf: int = LEAF):
        self.x, self.rank, self.leaf = _scaled(x), rank, leaf
        x = self.x
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        self.unit = _unit(x)
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        centre = self.unit[rows].mean(axis=0)
        top = rows[np.argmax(((self.unit[rows] - centre) ** 2).sum(axis=1))]  # a far point parts best
        d = np.sqrt(((self.unit[rows] - self.unit[top]) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        inner, outer = order[:half], order[half:]
        return (top, d[order[half]], (d[inner].min(), d[inner].max(), self._build(rows[inner])), (d[outer].min(), d[outer].max(), self._build(rows[outer])))

    def search(self, q: np.ndarray, k: int, factor: float, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows (-1: none) of the k nearest. bound: scores known to be reached."""
        q = _scaled(q)
        self.q, self.q_norm, self.q_unit, self.k, self.factor = q, np.sqrt(np.einsum("ij,ij->i", q, q)), _unit(q), k, factor
        self.best = np.full((len(q), k), -np.inf)
        self.row = np.full((len(q), k), -1, np.int64)
        self.floor = np.full(len(q), -np.inf) if bound is None else bound
        self._visit(self.root, np.arange(len(q)))
        return self.best, self.row

    def _reach(self, who: np.ndarray) -> np.ndarray:
        s = np.maximum(self.best[who, -1], self.floor[who])
        return self.factor * np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.maximum(s, -1.0)))

    def _visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if not isinstance(node, tuple):
            score = np.einsum("ik,jk->ij", self.q[who], self.x[node]) / (self.q_norm[who][:, None] * self.norm[node][None, :])
            score = np.concatenate([self.best[who], score], axis=1)
            row = np.concatenate([self.row[who], np.broadcast_to(node, (len(who), len(node)))], axis=1)
            rank = np.where(row >= 0, self.rank[row], np.iinfo(np.int64).max)
            order = np.lexsort((rank, -score), axis=-1)[:, : self.k]
            self.best[who] = np.take_along_axis(score, order, 1)
            self.row[who] = np.take_along_axis(row, order, 1)
            return
        top, cut, inner, outer = node
        d = np.sqrt(((self.q_unit[who] - self.unit[top]) ** 2).sum(axis=1))
        near = d < cut
        for first in (True, False):
            for child, own in ((inner, near), (outer, ~near)):
                if first:
                    pick = own
                else:
                    pick = ~own
                    lo, hi, _ = child
                    pick = pick & (np.maximum(d - hi, lo - d) <= self._reach(who) + 1e-9)
                self._visit(child[2], who[pick])


def _usable(column: str):
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(c, lambda x: x != 0)


def _pivots(sample: pa.Table, wanted: int) -> dict[int, np.ndarray]:
    """Unit pivots by vector length: a few rounds of spherical k-means from the first rows."""
    out = {}
    vectors = sample.sort_by("id").column("v").to_pylist()
    for dim in sorted({len(v) for v in vectors}):
        x = _unit(np.array([v for v in vectors if len(v) == dim], np.float64))
        p = x[: max(1, round(wanted * len(x) / len(vectors)))]
        for _ in range(6):
            own = np.argmax(x @ p.T, axis=1)
            p = np.array([x[own == i].mean(axis=0) if (own == i).any() else p[i] for i in range(len(p))])
            p = p / np.maximum(1e-12, np.sqrt((p * p).sum(axis=1, keepdims=True)))
        out[dim] = p
    return out


def _to_pivots(v: list, pivots: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and the distance to it, 0 and 0 for lengths without pivots."""
    cell, dist = np.zeros(len(v), np.int64), np.zeros(len(v))
    dims = np.array([len(x) for x in v])
    for dim in np.unique(dims):
        if dim in pivots:
            at = np.nonzero(dims == dim)[0]
            x = _unit(np.array([v[i] for i in at], np.float64))
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots[dim].T)))
            cell[at], dist[at] = d.argmin(axis=1), d.min(axis=1)
    return cell, dist


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vector_col: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest of other ids for each query row."""
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)

    def clean(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & _usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("exists(v, x -> x != 0)")

    first = Window.partitionBy("v").orderBy("id")
    points = clean(vectors).distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    points = points.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))  # k + 1 at most
    points = scratch.save(points.select(F.element_at("ids", 1).alias("id"), "ids", "v"))
    n = points.count()
    asked = scratch.save(clean(queries).groupBy("id").agg(F.min("v").alias("v")))
    shard_rows = max(shard_rows, n // (SHARDS // 2) + 1)
    share = min(1.0, SAMPLE_ROWS / max(1, n))
    sample = points.where(F.pmod(F.xxhash64("id", F.lit(10)), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "v").toArrow()
    pivots = _pivots(sample, min(PIVOTS, max(1, n // shard_rows)))
    shared = spark.sparkContext.broadcast(pivots)

    def dealt(batches):
        for b in batches:
            cell, dist = _to_pivots(b.column(b.schema.names.index("v")).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(dist)], [*b.schema.names, "cell", "dist"])

    points = points.mapInArrow(dealt, "id long, ids array<bigint>, v array<double>, cell long, dist double").withColumn("dim", F.size("v"))
    parts = points.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).alias("parts"))
    points = points.join(parts, ["dim", "cell"])
    points = points.withColumn("shard", F.concat_ws("/", "dim", "cell", F.pmod(F.xxhash64("id"), F.col("parts"))))
    points = scratch.save(points.select("id", "ids", "v", "dim", "cell", "dist", "shard"))
    shards = points.groupBy("shard", "dim", "cell").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.count(F.lit(1)).alias("rows")).toArrow().to_pylist()
    table: dict[int, list] = {}
    for s in sorted(shards, key=lambda s: (s["cell"], s["shard"])):
        table.setdefault(s["dim"], []).append((s["shard"], s["cell"], s["lo"], s["hi"]))
    columns = {dim: (np.array([x[0] for x in rows], object), *(np.array([x[i] for x in rows]) for i in (1, 2, 3))) for dim, rows in table.items()}
    routes = spark.sparkContext.broadcast((pivots, columns))  # at most SHARDS rows

    def routed(batches):
        """(id, v, reach) -> (id, v, floor, shard); reach null: only the first shard of the nearest cell that has rows."""
        for b in batches:
            where, names = [], []
            cells, by_dim = routes.value
            ids, vs, floors, homes = (b.column(i).to_pylist() for i in range(4))
            for i, v in enumerate(vs):
                if len(v) not in by_dim:
                    continue
                shard, cell, lo, hi = by_dim[len(v)]
                p = cells.get(len(v))
                d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (_unit(np.array([v], np.float64)) @ p.T)))[0] if p is not None else np.zeros(1)
                if homes[i] is None:
                    where.append(i)
                    names.append(shard[d[cell].argmin()])  # shards are in the order of cell and name
                    continue
                reach = factor * np.sqrt(max(0.0, 2.0 - 2.0 * max(-1.0, floors[i]))) if floors[i] is not None else np.inf
                near = np.nonzero((np.maximum(d[cell] - hi, lo - d[cell]) <= reach + 1e-9) & (shard != homes[i]))[0]
                where += [i] * len(near)
                names += shard[near].tolist()
            at = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(names, pa.string())], ["id", "v", "floor", "shard"])

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        """Points of a shard, queries of a block -> (query_id, shard, score, ids)."""
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("id")
            rank = left.column("id").to_numpy()
            tree = Tree(_matrix(left.column("v")), rank)
            floor = right.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
            score, row = tree.search(_matrix(right.column("v")), k + 1, factor, np.where(np.isnan(floor), -np.inf, floor))
            who, j = np.nonzero(row >= 0)
            out = [right.column("id").to_numpy()[who], np.repeat(right.column("shard")[0].as_py(), len(who)), score[who, j], left.column("ids").combine_chunks().take(pa.array(row[who, j]))]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "shard": pa.array(out[1], pa.string()), "score": pa.array(out[2], pa.float64()), "ids": pa.array(out[3], pa.list_(pa.int64())) if isinstance(out[3], list) else out[3].cast(pa.list_(pa.int64()))})

    def search(to: DataFrame) -> DataFrame:
        blocks = to.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_BLOCK)).cast("long").alias("blocks"))
        q = to.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).select("shard", "block", "id", "v", "floor")
        p = points.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "id", "ids", "v")
        got = p.groupBy("shard", "block").cogroup(q.groupBy("shard", "block")).applyInArrow(searched, "query_id long, shard string, score double, ids array<bigint>")
        got = got.select("query_id", "shard", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
        best = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        return scratch.save(got.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n"))

    schema = "id long, v array<double>, floor double, shard string"
    home = scratch.save(asked.select("id", "v", F.lit(None).cast("double").alias("floor"), F.lit(None).cast("string").alias("home")).mapInArrow(routed, schema))
    found = search(home)
    floor = found.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    again = home.select("id", "v", F.col("shard").alias("home")).join(floor, F.col("id") == F.col("query_id"), "left")
    again = again.select("id", "v", F.when(F.col("n") >= k, F.col("floor")).alias("floor"), "home").mapInArrow(routed, schema)
    both = found.unionByName(search(scratch.save(again))).select("query_id", "score", "vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
