"""Exact percentile per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialise

# A rank found by percentile_approx is off by at most 1/ACCURACY of the rows it saw.
ACCURACY = 10_000
STEPS = 1_000  # quantiles taken of a bracket; a round narrows it to about two of these steps
VALUES = 50_000  # different values a group's bracket may hold when the ranks are picked
ROUNDS = 8


def group_percentile(
    df: DataFrame, key: str, value: str, p: float, alias: str = "percentile"
) -> DataFrame:
    """Continuous percentile ``p`` of ``value`` per ``key``, equal to ``percentile(value, p)``.

    ``percentile`` keeps every distinct value of a group in one buffer. Here each group has a bracket
    of values, at first its least and greatest, with the exact number of rows below and inside. Rounds
    narrow it: quantiles of the rows inside, from a mergeable sketch, name the next bracket, and a
    count decides whether that holds the wanted ranks; if not, the group keeps its bracket and the
    next round takes a wider one. When every bracket holds few different values, these are counted and
    the ranks picked. Rows are only ever aggregated; one flag a round reaches the driver.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(key).alias("g"), F.col(value).alias("x"))
    position = (F.col("n") - 1) * F.lit(p)
    lower, upper = F.floor(position), F.ceil(position)
    brackets = materialise(
        rows.groupBy(F.col("g").alias("key"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            F.approx_count_distinct("x").alias("different"),
        )
        .withColumns({"below": F.lit(0).cast("long"), "inside": F.col("n")}),
        "brackets",
    )
    for slack in (2**i for i in range(ROUNDS)):
        if brackets.filter(F.col("different") > VALUES).isEmpty():
            break
        brackets = materialise(_narrowed(rows, brackets, lower, upper, slack), "brackets")

    counted = _inside(rows, brackets).groupBy("g", "n", "below", "x").agg(F.count(F.lit(1)).alias("copies"))
    running = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("upto", F.col("below") + F.sum("copies").over(running))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("upto") - F.col("copies")) & (rank < F.col("upto")), F.col("x")))

    picked = ranked.groupBy("g", "n").agg(at(lower).alias("at_lower"), at(upper).alias("at_upper"))
    interpolated = F.when(F.col("at_lower") == F.col("at_upper"), F.col("at_lower")).otherwise(
        (upper - position) * F.col("at_lower") + (position - lower) * F.col("at_upper")
    )
    return picked.select(F.col("g").alias(key), interpolated.alias(alias))


def _inside(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    own = F.col("g").eqNullSafe(F.col("key"))
    return rows.join(brackets, own).filter((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")))


def _narrowed(rows: DataFrame, brackets: DataFrame, lower: Column, upper: Column, slack: int) -> DataFrame:
    """Brackets with fewer values for the groups that have too many; the others as they are."""
    open_ = brackets.filter(F.col("different") > VALUES)
    grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    quantiles = (
        _inside(rows, open_)
        .groupBy(*brackets.columns)
        .agg(F.percentile_approx("x", grid, F.lit(ACCURACY)).alias("q"))
    )
    step = F.col("inside") / F.lit(STEPS)
    first = F.floor((lower - F.col("below")) / step).cast("int") - slack
    last = F.ceil((upper - F.col("below") + 1) / step).cast("int") + slack
    proposed = materialise(
        quantiles.withColumns(
            {
                "low": F.when(first > 0, F.try_element_at("q", first + 1)).otherwise(F.col("low")),
                "high": F.when(last < STEPS, F.try_element_at("q", last + 1)).otherwise(F.col("high")),
            }
        ).drop("q"),
        "proposed",
    )
    is_inside = (F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high"))
    checked = (
        rows.join(proposed.drop("below", "inside", "different"), F.col("g").eqNullSafe(F.col("key")))
        .groupBy("key", "n", "low", "high")
        .agg(
            F.count_if(F.col("x") < F.col("low")).alias("below"),
            F.count_if(is_inside).alias("inside"),
            F.approx_count_distinct(F.when(is_inside, F.col("x"))).alias("different"),
        )
        .filter((lower >= F.col("below")) & (upper < F.col("below") + F.col("inside")))
        .select(brackets.columns)
    )
    found = materialise(checked, "checked")
    kept = brackets.join(found.select(F.col("key").alias("done")), F.col("key").eqNullSafe(F.col("done")), "left_anti")
    return found.unionByName(kept)
