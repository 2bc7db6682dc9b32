"""Connected components by repeated contraction.

Each round gives every node of the current graph its smallest neighbour (or
itself) as parent, follows parents twice more, and renames both ends of every
edge.  Edges inside one group vanish, so the edge table shrinks each round; the
loop ends when none is left, or when so few are (``SMALL_EDGES``, whatever the
input) that one task settles them at once.  All other steps are joins and partial
aggregations: nothing is collected, and a hub with many edges only meets ``min``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bibweave.scratch import Scratch

#: Edges that one task takes on: some tens of MB.
SMALL_EDGES = 100_000


def _settled(batches):
    """All edges (u, v) -> (u, p) for each node, p the smallest that it reaches."""
    up: dict = {}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(u, u)
            up.setdefault(v, v)
            a, b = root(u), root(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    if up:
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)], ["u", "p"])


def connected_components(edges: DataFrame, scratch: Scratch | None = None, small: int = SMALL_EDGES, distinct: bool = False) -> DataFrame:
    """Rows (node, component) for each end of ``edges`` (its first two columns).

    ``component`` is the smallest node of the group. Edges with a null end are
    ignored; an edge from a node to itself keeps that node as a group of one.
    ``distinct`` says that no edge is repeated, which spares a shuffle; with repeats the result is the same.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    a, b = edges.columns[:2]
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    pairs = scratch.save(pairs if distinct else pairs.distinct())
    kind = pairs.schema["u"].dataType
    labels = None
    graph = pairs
    while True:
        few = graph.count() <= small
        if few:
            jumped = graph.repartition(1).mapInArrow(_settled, StructType([StructField("u", kind), StructField("p", kind)]))
        else:
            both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
            parent = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p"))
            parent = scratch.save(parent)
            hop = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
            two = parent.join(hop, "p").select("u", F.col("q").alias("p"))
            jumped = scratch.save(two.join(hop, "p").select("u", F.col("q").alias("p")))
        rename = jumped.select(F.col("u").alias("component"), F.col("p"))
        fresh = (
            jumped.select(F.col("u").alias("node"), F.col("p").alias("component"))
            if labels is None
            else labels.join(rename, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
        )
        fresh = scratch.save(fresh)
        if few:
            scratch.drop(labels, graph)
            return fresh
        left = jumped.select("u", F.col("p").alias("pu"))
        right = jumped.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        moved = graph.join(left, "u").join(right, "v").where("pu != pv")
        moved = scratch.save(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        scratch.drop(parent, jumped, labels, graph)
        labels, graph = fresh, moved
