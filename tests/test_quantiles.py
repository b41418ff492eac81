from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import quantiles
from tidemark.operators.quantiles import group_percentile

ACCURACY = quantiles.ACCURACY


def expected(df: pd.DataFrame, p: float) -> dict:
    known = df.dropna(subset=["x"])
    return {k: float(np.percentile(v, p * 100)) for k, v in known.groupby("k")["x"]}


def groups(rng) -> pd.DataFrame:
    """A hot group over the sketch's size, heavy tails, ties and groups of every small size."""
    parts = {
        "hot": rng.exponential(50, 6 * ACCURACY),
        "tail": np.concatenate([rng.random(2 * ACCURACY), [1e300, -1e300]]),
        "ties": rng.integers(0, 3, 3 * ACCURACY).astype(float),
        "one value": np.full(2 * ACCURACY, 7.0),
        "edge": rng.normal(size=ACCURACY + 1),
        **{f"n{n}": rng.normal(size=n) for n in range(1, 12)},
    }
    frame = pd.concat([pd.DataFrame({"k": k, "x": v}) for k, v in parts.items()])
    return frame.sample(frac=1, random_state=1)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.8, 1.0])
def test_equals_the_exact_percentile(spark, p):
    frame = groups(np.random.default_rng(7))
    got = group_percentile(spark.createDataFrame(frame).repartition(6), "k", "x", p, "v")
    actual = {r.k: r.v for r in got.collect()}
    want = expected(frame, p)
    assert actual.keys() == want.keys()
    for key in want:
        assert actual[key] == pytest.approx(want[key], rel=1e-12, abs=1e-12), key


def test_null_values_are_ignored_and_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), ("b", None)], "k string, x double")
    assert {r.k: r.v for r in group_percentile(df, "k", "x", 0.5, "v").collect()} == {"a": 2.0, None: 5.0}


def test_many_rounds_give_the_exact_percentile(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "VALUES", 20)
    frame = groups(np.random.default_rng(8))
    got = group_percentile(spark.createDataFrame(frame).repartition(6), "k", "x", 0.8, "v")
    assert {r.k: pytest.approx(r.v, rel=1e-12, abs=1e-12) for r in got.collect()} == expected(frame, 0.8)


def test_a_bracket_that_misses_the_rank_is_widened(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "VALUES", 500)
    monkeypatch.setattr(quantiles, "ACCURACY", 3)  # a sketch far too coarse for its steps
    df = spark.range(30_000).selectExpr("'a' as k", "cast(id as double) as x")
    assert group_percentile(df, "k", "x", 0.5, "v").first().v == 14_999.5


def test_no_more_than_the_bracket_is_ranked(spark):
    """The values that reach the last step are a small share of a large group."""
    df = spark.range(500_000).selectExpr("'a' as k", "cast(id as double) as x")
    result = group_percentile(df, "k", "x", 0.8, "v")
    assert result.first().v == pytest.approx(0.8 * 499_999)
    plan = result._jdf.queryExecution().executedPlan().toString()
    ranked = plan[: plan.index("Window")]
    assert "HashAggregate" in plan[plan.index("Window") :] and "Scan" not in ranked
