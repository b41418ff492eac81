from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import mtree

SCHEMA = "vec_id long, embedding array<float>, id long, v string, dim long, cell string, ask string, q long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 7, "v", 8, "c", "a", 9) for i, v in rows], SCHEMA)


def plain(rows, asked, k):
    """(query_id, rank, vec_id, score) of every query row against all rows."""
    whole = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows if usable(i, v)]
    out = []
    for i, v in asked:
        if usable(i, v):
            query = np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)
            scores = sorted((-int(query @ w), j) for j, w in whole if j != i and len(w) == len(query))
            out += [(i, rank + 1, j, -score) for rank, (score, j) in enumerate(scores[:k])]
    return sorted(out)


def usable(i, v):
    return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture
def rows():
    rng = np.random.default_rng(3)
    out = [(i, rng.normal(size=6)) for i in range(400)]
    out += [(i, out[5][1]) for i in range(400, 430)]  # ties
    out += [out[100], out[100], out[7]]  # repeated rows, a query among them
    out += [(500, None), (600, [np.nan] * 6), (700, [1.0, None, 2, 3, 4, 5]), (None, out[0][1]), (800, [np.inf] * 6), (900, [])]
    out += [(1000 + i, rng.normal(size=3)) for i in range(5)] + [((1 << 60) + i, 100 * rng.normal(size=6)) for i in range(200)]
    return out


@pytest.mark.parametrize(("block", "query_block"), [(mtree.BLOCK, mtree.QUERY_BLOCK), (40, 3)])
def test_awkward_rows(spark, rows, block, query_block, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK", block)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(mtree, "PAGE", 8)
    asked = [r for r in rows if r[0] is not None and r[0] % 100 == 0]
    found = mtree.exact_top_k(frame(spark, rows).repartition(3), frame(spark, asked), 10)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, asked, 10)
    few = mtree.exact_top_k(frame(spark, rows[:4]), frame(spark, rows[:2]), 10)
    assert sorted(tuple(r) for r in few.collect()) == plain(rows[:4], rows[:2], 10)


def test_empty_tables(spark, rows):
    table = frame(spark, rows[:20])
    assert mtree.exact_top_k(table.limit(0), table).collect() == []
    assert mtree.exact_top_k(table, table.limit(0)).collect() == []


def clustered(n, clusters, width, rng):
    centres = rng.normal(size=(clusters, 32)) * 1000
    return (centres[rng.integers(0, clusters, n)] + width * rng.normal(size=(n, 32))).astype(np.int64)


def test_bounds_exclude_most_distances_on_clusters():
    rng = np.random.default_rng(8)
    vectors = clustered(5000, 50, 20, rng)
    longest = float((vectors.astype(float) ** 2).sum(axis=1).max())
    asked = np.arange(0, 5000, 100)
    best, tree = mtree.block_top(np.arange(5000), vectors, asked, vectors[asked], 10, longest)
    for q, own in zip(asked, best):
        scores = vectors @ vectors[q]
        wanted = sorted(((int(s), -i) for i, s in enumerate(scores) if i != q), reverse=True)[:10]
        assert sorted(own, reverse=True) == wanted
    assert tree.computed < 0.5 * 5000 * len(asked)


def test_a_limit_known_before_excludes_whole_pages():
    rng = np.random.default_rng(9)
    vectors = clustered(3000, 30, 5, rng)
    longest = float((vectors.astype(float) ** 2).sum(axis=1).max())
    query = vectors[:1] + 1
    best, free = mtree.block_top(np.arange(3000), vectors, np.array([-1]), query, 10, longest)
    near = np.sqrt((query.astype(float) ** 2).sum() + longest - 2 * min(best[0])[0])
    again, bound = mtree.block_top(np.arange(3000), vectors, np.array([-1]), query, 10, longest, np.array([near]))
    assert sorted(again[0]) == sorted(best[0]) and bound.computed <= free.computed < 3000
