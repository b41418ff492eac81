"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

MAX_ROUNDS = 60


class Forest:
    """Union-find over small integers; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out edges that join what earlier edges of the batch have joined."""
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(names))
        keep = [forest.join(x, y) for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of an edge (``a``, ``b``).

    Rounds of contraction: every node joins the neighbour of the smallest hash, hashed anew each
    round, so paths shrink by a constant share; a node with many edges is met by partial sums only.
    """
    left = materialise(edges.filter("a != b").select("a", "b").mapInArrow(_thin, "a long, b long"), "edges")
    named = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = named.withColumn("rep", F.col("node"))
    for turn in range(MAX_ROUNDS):
        if left.isEmpty():
            return labels.join(
                labels.groupBy("rep").agg(F.min("node").alias("component")), "rep"
            ).select("node", "component")
        both = left.union(left.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best")).withColumn("own", rank("a"))
        parents = materialise(
            best.select(F.col("a").alias("node"), F.least("own", "best")["x"].alias("parent")), "parents"
        )
        at_a, at_b = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in "ab")
        moved = left.join(at_a, "a").join(at_b, "b").filter("pa != pb")
        pairs = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        left = materialise(pairs.distinct().mapInArrow(_thin, "a long, b long"), "edges")
        up = parents.select(F.col("node").alias("rep"), F.col("parent"))
        labels = materialise(
            labels.join(up, "rep", "left").select("node", F.coalesce("parent", "rep").alias("rep")), "labels"
        )
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
