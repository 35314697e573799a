"""Connected components of a large edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, staged


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges; yields (node, smallest node of its tree)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 1 << 16):
        part = nodes[i:i + (1 << 16)]
        yield pa.record_batch([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())],
                              names=["a", "b"])


def _stars(e: DataFrame) -> bool:
    """Whether every node of the edges (a, b) with b below a is either the middle of its tree or has one edge, to the middle."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); the component is its smallest node.

    Each partition is first contracted by union-find, which leaves at most one
    row per node and partition. Alternating large-star and small-star rounds
    then join the partitions' trees; every step is an aggregate to one minimum
    per node and a join, so that a node with very many neighbours is split like
    any skewed join. Rounds end when every tree is a star, which a further round
    would leave as it is.
    """
    prepare(edges.sparkSession)
    e = staged(edges.select("a", "b").mapInArrow(_forest, "a long, b long"), "forest")
    while True:
        # large star: each node's larger neighbours move to the least of its neighbourhood
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = staged(e.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                           F.col("m").alias("b")).distinct(), "stars")
        if _stars(e):
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
