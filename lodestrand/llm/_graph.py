"""Connected components of an edge table, by alternating star contractions.

Each round hooks every neighbour of a node to the smallest node nearby (first the larger neighbours, then the smaller
ones), which halves distances; when a round changes nothing, every edge points at its component's smallest node.  All
steps are grouped minima with map-side partial results and equi-joins, which adaptive execution splits where a node is
hot; each round is written to the shared folder, which cuts the lineage.

Rounds over many shuffle partitions cost the same however few the edges are.  A caller may let the driver join up to a stated number of edges
instead; the result is the same.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _store


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _joined(pairs: DataFrame) -> DataFrame:
    """The components of few edges u, v, found by the driver."""
    edges = pairs.toArrow()
    own = pa.chunked_array([*edges["u"].chunks, *edges["v"].chunks], edges["u"].type).combine_chunks().dictionary_encode()
    order = pc.sort_indices(own.dictionary)  # binaries and strings by their bytes, as Spark orders them
    rank = pc.sort_indices(order).to_numpy()[own.indices.to_numpy()].tolist()
    root = list(range(len(order)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for u, v in zip(rank[: len(edges)], rank[len(edges) :], strict=True):
        u, v = find(u), find(v)
        root[max(u, v)] = min(u, v)
    nodes = own.dictionary.take(order)
    table = pa.table({"node": nodes, "component": nodes.take(pa.array([find(x) for x in range(len(root))], pa.int64()))})
    kind = pairs.schema["u"].dataType.simpleString()
    return pairs.sparkSession.createDataFrame(table, f"node {kind}, component {kind}")


def components(edges: DataFrame, a: str = "a", b: str = "b", few: int = 0) -> DataFrame:
    """node, component (the smallest node reachable), one row for every node of an edge; loops add nothing.

    Up to ``few`` edges are sent to the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs = _store.materialize(pairs, "edges")
    state = _state(pairs)
    if 0 < state[0] <= few:
        return _joined(pairs)
    while state[0]:
        # Large star: of u's neighbours and u itself, the larger neighbours are hooked to the smallest.
        both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: of u and its smaller neighbours, all are hooked to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
        after = _store.materialize(small, "edges")
        new = _state(after)
        _store.discard(pairs)
        pairs, done = after, new == state
        state = new
        if done:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select(F.col("v"), F.col("v")).distinct())
