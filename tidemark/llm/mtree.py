"""Exact top-k inner-product search with M-trees.

A vector becomes integers, floor(1024 x). With one more coordinate, sqrt(M^2 - |v|^2) for the largest
norm M of the table, the distance to a query (whose extra coordinate is 0) falls as the inner product
rises, so the k nearest in that metric are the k highest scores.

Vectors are dealt to the nearest of at most PIVOTS pivots, a sample by hash of the id; a cell keeps its
covering radius, and one of more than BLOCK rows is split by hash. Queries first search one block of their nearest
cell, which gives each a distance beyond which nothing counts; then they go only to cells whose ball
reaches within it. A block is a tree of pages: an entry stores its object, a covering radius and the
distance to the page's parent object. Search is best-first for all queries of a group together: the page
with the lowest possible distance of any query comes next, with the queries it may still serve; stored
parent distances exclude entries by the triangle inequality before a distance is computed. Scores are
integers, so the result is exact, ties included.

What the bounds exclude depends on the vectors. In tight clusters it is nearly everything; vectors spread
evenly over a sphere of many dimensions have all about the same distance, and no such bound excludes any.

Vectors that are null or hold null or non-finite components, and rows without id, take no part;
vectors of other lengths than the query's are no candidates. A repeated id is never its own candidate; a
repeated query row is answered each time by itself; a repeated vector is a candidate each time. Columns
other than the two named are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialise

PAGE = 64
BLOCK = 8192
QUERY_BLOCK = 4096
PIVOTS = 1024
SCALE = 1024
SLACK = 1e-6  # of the largest distances: what rounding may do to a bound


class MTree:
    """Bulk-loaded pages over the rows of ``points``."""

    def __init__(self, points: np.ndarray, page: int = PAGE, seed: int = 1):
        self.points, self.page, self.rng = points, page, np.random.default_rng(seed)
        # page -> (leaf, objects, children, radii, distances to the page's parent object)
        self.pages: list[tuple] = []
        self.computed = self.excluded = 0
        everything = np.arange(len(points))
        self.top = everything[0] if len(points) else None
        self.root = self._build(everything, self.top) if len(points) else None

    def _distance(self, rows: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[row]) ** 2).sum(axis=1))

    def _build(self, rows: np.ndarray, parent: int) -> int:
        number = len(self.pages)
        self.pages.append(())
        if len(rows) <= self.page:
            self.pages[number] = (True, rows, None, np.zeros(len(rows)), self._distance(rows, parent))
            return number
        heads = self.rng.choice(rows, min(self.page, -(-len(rows) // self.page)), replace=False)
        nearest = np.stack([self._distance(rows, h) for h in heads]).argmin(axis=0)
        if np.bincount(nearest).max() == len(rows):  # all alike: cut evenly
            nearest = np.arange(len(rows)) * len(heads) // len(rows)
        objects, children, radii = [], [], []
        for i, head in enumerate(heads):
            own = rows[nearest == i]
            if len(own):
                objects.append(head)
                radii.append(self._distance(own, head).max())
                children.append(self._build(own, head))
        objects = np.array(objects)
        self.pages[number] = (False, objects, children, np.array(radii), self._distance(objects, parent))
        return number

    def search(self, queries: np.ndarray, limit: np.ndarray, slack: np.ndarray, offer) -> None:
        """Best-first for all queries: ``offer(rows, asked)`` takes candidates and lowers ``limit`` (a distance for each)."""
        if self.root is None or not len(queries):
            return
        squares, own = (queries**2).sum(axis=1), (self.points**2).sum(axis=1)

        def distances(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
            self.computed += len(rows) * len(asked)
            return np.sqrt(np.maximum(squares[asked, None] + own[rows] - 2 * (queries[asked] @ self.points[rows].T), 0))

        everyone = np.arange(len(queries))
        top = distances(np.array([self.top]), everyone)[:, 0]
        queue = [(0.0, 0, self.root, everyone, np.zeros(len(queries)), top)]
        order = 0
        while queue:
            _, _, number, asked, bounds, to_parent = heapq.heappop(queue)
            alive = bounds <= limit[asked] + slack[asked]
            asked, bounds, to_parent = asked[alive], bounds[alive], to_parent[alive]
            leaf, objects, children, radii, parent = self.pages[number]
            near = np.abs(to_parent[:, None] - parent) - radii <= (limit + slack)[asked, None]
            wanted, rows = near.any(axis=1), near.any(axis=0)
            self.excluded += near.size - int(wanted.sum()) * int(rows.sum())
            if not rows.any():
                continue
            asked, bounds = asked[wanted], bounds[wanted]
            if leaf:
                self.computed += int(rows.sum()) * len(asked)
                offer(objects[rows], asked)
                continue
            found = distances(objects[rows], asked)
            lowest = np.maximum(bounds[:, None], found - radii[rows])
            for i, child in enumerate(np.flatnonzero(rows).tolist()):
                go = lowest[:, i] <= limit[asked] + slack[asked]
                if go.any():
                    order += 1
                    heapq.heappush(queue, (float(lowest[go, i].min()), order, children[child], asked[go], lowest[go, i], found[go, i]))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that gives all of them the same length."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(longest - squares, 0))]).astype(np.float64)


def block_top(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, longest: float, limits: np.ndarray | None = None
) -> tuple[list[list[tuple[int, int]]], MTree]:
    """For each query the k best of a block within its limit, (score, -id) in any order; and the tree."""
    tree = MTree(lifted(vectors, longest))
    squares = (queries.astype(np.float64) ** 2).sum(axis=1)
    limit = np.full(len(queries), np.inf) if limits is None else limits.copy()
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]
    floor = np.full(len(queries), -math.inf)  # the k-th best score, where k are known
    spread = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    kind = np.float64 if spread < 1 << 53 else np.int64  # sums below 2^53 are exact in float64
    data, asks = vectors.astype(kind), queries.astype(kind)

    def offer(rows: np.ndarray, asked: np.ndarray) -> None:
        scores = asks[asked] @ data[rows].T
        hits = (scores >= floor[asked, None]) & (query_ids[asked, None] != ids[rows])
        for i, j in zip(*(x.tolist() for x in np.nonzero(hits))):
            q, entry = int(asked[i]), (int(scores[i, j]), -int(ids[rows[j]]))
            own = best[q]
            if len(own) < k:
                heapq.heappush(own, entry)
            elif entry > own[0]:
                heapq.heapreplace(own, entry)
            else:
                continue
            if len(own) == k:
                floor[q] = own[0][0]
                limit[q] = min(limit[q], math.sqrt(max(squares[q] + longest - 2 * own[0][0], 0.0)))

    slack = SLACK * (np.sqrt(squares) + math.sqrt(longest) + 1)
    tree.search(np.column_stack([queries, np.zeros(len(queries))]).astype(np.float64), limit, slack, offer)
    return best, tree


def integer_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """Columns ``id``, ``v`` (array of long) and ``dim`` of the rows that take part."""
    raw = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    rows = raw.filter(F.col("id").isNotNull() & F.col("raw").isNotNull()).filter(finite)
    whole = F.transform("raw", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return rows.select("id", whole.cast("array<bigint>").alias("v"), F.size("raw").alias("dim"))


def _matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def _placed(rows: DataFrame, pivots: dict[int, np.ndarray], longest: float, lift: bool) -> DataFrame:
    """``cell`` (the nearest pivot) and ``away`` (distances to all pivots of the length for queries, else to the cell's)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                vectors = _matrix(part.column("v"))
                points = lifted(vectors, longest) if lift else np.column_stack([vectors, np.zeros(len(vectors))]).astype(np.float64)
                centres = pivots.get(dim, np.zeros((1, dim + 1)))
                away = np.sqrt(np.maximum((points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * (points @ centres.T), 0))
                cell = away.argmin(axis=1)
                seen = pa.array(list(away), pa.list_(pa.float64())) if not lift else pa.array(away[np.arange(len(away)), cell])
                columns = [*part.columns, pa.array(cell, pa.int32()), seen]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "cell", "away"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(place, f"{fields}, cell int, away {'double' if lift else 'array<double>'}")


def _searched(blocks: DataFrame, asked: DataFrame, k: int, longest: float) -> DataFrame:
    """Blocks (``dim, cell, part, ask``) and the queries that came to them -> ``q, query_id, vec_id, score``."""

    def search(data: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(data) and len(questions):
            names = questions["q"].to_numpy(np.int64), questions["id"].to_numpy(np.int64)
            best, _ = block_top(
                data["id"].to_numpy(np.int64),
                np.stack(data["v"].to_numpy()).astype(np.int64),
                names[1],
                np.stack(questions["v"].to_numpy()).astype(np.int64),
                k,
                longest,
                questions["limit"].to_numpy(np.float64),
            )
            found = [(q, i, -negative, score) for q, i, own in zip(names[0].tolist(), names[1].tolist(), best) for score, negative in own]
        return pd.DataFrame(found, columns=["q", "query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "cell", "part", "ask"]
    here = blocks.groupBy(*(f"to_{key}" for key in keys))
    return here.cogroup(asked.groupBy(*keys)).applyInPandas(search, "q long, query_id long, vec_id long, score long")


def exact_top_k(
    table: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """For every row of ``queries`` the k rows of ``table`` with the highest integer inner product."""
    rows, asked = (integer_vectors(x, id_column, vector_column) for x in (table, queries))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest")).first()
    longest = float(whole["longest"] or 0.0)
    wanted = max(1, min(PIVOTS, -(-whole["n"] // (BLOCK // 2))))
    sample = rows.select("id", "v", "dim").orderBy(F.xxhash64("id"), "v").limit(wanted).collect()  # at most PIVOTS rows
    pivots: dict[int, list] = {}
    for row in sample:
        pivots.setdefault(row["dim"], []).append(row["v"])
    centres = {dim: lifted(np.array(own, np.int64), longest) for dim, own in pivots.items()}

    placed = materialise(_placed(rows.filter("dim > 0"), centres, longest, lift=True), "placed_vectors")
    sizes = placed.groupBy("dim", "cell").agg(F.max("away").alias("radius"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    cells = materialise(sizes, "cells")  # a row for each pivot and each other length
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    vectors = placed.join(cells.drop("radius"), ["dim", "cell"]).select("dim", "cell", block.alias("part"), "id", "v")

    numbered = asked.filter("dim > 0").withColumn("q", F.monotonically_increasing_id())
    located = materialise(_placed(numbered, centres, longest, lift=False), "placed_queries")
    groups = -(-located.count() // QUERY_BLOCK)  # neighbouring cells share a group of queries, a full group is split
    there = located.withColumn("near", F.floor(F.col("cell") * groups / wanted))
    home = materialise(there.groupBy("dim", "near").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("asks")), "query_groups")
    salt = F.pmod(F.xxhash64("q"), F.col("asks")).cast("int")
    ready = there.join(home, ["dim", "near"]).select("q", "id", "v", "dim", F.concat_ws("-", "near", salt).alias("ask"), "away")

    # one block of the nearest cell that has vectors gives a first limit
    options = ready.select("q", "dim", F.posexplode("away").alias("cell", "distance")).join(cells, ["dim", "cell"])
    nearest = options.groupBy("q").agg(F.min_by("cell", "distance").alias("cell"))
    first = ready.join(nearest, "q").select("q", "id", "v", "dim", "cell", F.lit(0).alias("part"), "ask", F.lit(math.inf).alias("limit"))
    seeds = _searched(_copied(vectors, first), first, k, longest)
    kth = seeds.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")).filter(F.col("n") >= k)
    reach = F.sqrt(F.greatest(square + longest - 2 * F.col("worst"), F.lit(0.0)))
    limits = materialise(
        ready.select("q", "v").join(kth, "q", "left").select("q", F.when(F.col("worst").isNull(), math.inf).otherwise(reach).alias("limit"), square.alias("square")), "limits"
    )

    slack = SLACK * (F.sqrt("square") + math.sqrt(longest) + 1)
    reached = options.join(limits, "q").filter(F.col("distance") - F.col("radius") <= F.col("limit") + slack)
    parts = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part")
    visits = ready.drop("away", "dim").join(reached.select("q", "dim", "cell", "limit", parts), "q")
    found = _searched(_copied(vectors, visits), visits, k, longest)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _copied(vectors: DataFrame, visits: DataFrame) -> DataFrame:
    """The vectors of each block, once for each group of queries that comes to it."""
    where = visits.select("dim", "cell", "part", "ask").distinct().toDF("to_dim", "to_cell", "to_part", "to_ask")
    met = (F.col("dim") == F.col("to_dim")) & (F.col("cell") == F.col("to_cell")) & (F.col("part") == F.col("to_part"))
    return vectors.join(where, met).select("to_dim", "to_cell", "to_part", "to_ask", "id", "v")
