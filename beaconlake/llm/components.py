"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.session import written

ROUNDS = 60
BUFFERED = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (vertex, smallest vertex known to be joined to it) that join what a task's edges join."""
    above: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := above.get(v, v)) != v:
            above[v] = above.get(up, up)
            v = up
        return v

    def flush() -> pa.RecordBatch:
        pairs = [(v, root(v)) for v in list(above)]
        above.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
        if len(above) > BUFFERED:
            yield flush()
    yield flush()


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each vertex's larger neighbours to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each vertex and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every vertex that has an edge to another; a component's name is its smallest vertex.

    ``edges`` has long columns ``a`` and ``b``. Tasks first join what they can on their own; then stars of larger and of
    smaller neighbours alternate until nothing changes. All state is tables; only a count and a checksum reach the driver.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    current = written(pairs.mapInArrow(_forest, "a long, b long").where("a > b").distinct(), "components")
    mark = None
    for _ in range(ROUNDS):
        found = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark or not found[0]:
            break
        mark = found
        current = written(_small_star(_large_star(current)), "components")
    else:
        raise RuntimeError("components have not settled")
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
