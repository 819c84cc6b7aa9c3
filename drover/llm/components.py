"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.session import materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one partition as stars around the least node of each local component."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, find(x)) for x in parent if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges with long ids; root is the least node of
    the component. Edges are first reduced to a forest within each partition, then stars
    are moved to smaller centres until nothing changes; every round is written to the
    shared folder. Work per round is in proportion to the edges left, and a node with many
    edges is combined before it is shuffled. Self-edges are ignored."""
    forest = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    now = materialize(forest.mapInArrow(_forest, "u long, v long"), "forest")
    mark = None
    while True:
        # Large star: larger neighbours move to the least node around u, u included.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u (the larger end) and its smaller neighbours move to the least of them.
        large = materialize(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        ).filter("u <> v").distinct()
        now = materialize(small, "stars")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = seen
