"""Connected components over an edge table, without collecting anything to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch


def _local_forest(batches):
    """Replaces the edges of a task by as many as span the same components, each to its smallest id."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        at = x
        while (up := parent.setdefault(at, at)) != at:
            at = up
        while parent[x] != at:
            parent[x], x = at, parent[x]
        return at

    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def flush():
        edges = [(x, r) for x in parent if (r := root(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], schema=schema)

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:
            yield flush()
    if parent:
        yield flush()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id of edges (u, v); component: the smallest id reachable.

    Alternating star contraction: a large-star and a small-star step a round, each a grouped
    minimum (combined before its shuffle) and a join on it (whose hot keys Spark may split). The
    number of rounds grows with the logarithm of the components' diameter. Edges with a null end
    and loops are ignored; no edges give no rows.
    """
    e = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    e = scratch.store(e.mapInArrow(_local_forest, "u long, v long"), "edges")
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.store(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = scratch.store(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        scratch.drop(large)
        scratch.drop(e)
        e = small
        # Done when all edges are spokes: each id has one edge upwards at most, and no edge ends where another begins.
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(e.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not ends.filter("out > 1 or (out > 0 and into > 0)").limit(1).count():
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())
