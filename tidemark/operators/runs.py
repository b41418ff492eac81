"""Analysis of run results: best run, effect of settings, success rate, slow runs, audit records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import group_percentile
from tidemark.scratch import materialise


@dataclass(frozen=True)
class RunColumns:
    """Names of the columns of a run table."""

    run_id: str = "run_id"
    mode: str = "processing_mode"
    status: str = "status"
    seconds: str = "seconds"
    files: str = "files_processed"
    error: str = "error"


RUNS = RunColumns()

# The two run states.
STATUS_OK = "ok"
STATUS_FAILED = "failed"


def successful(df: DataFrame, c: RunColumns = RUNS) -> DataFrame:
    return df.filter(F.col(c.status) == STATUS_OK)


def best_run_per_group(df: DataFrame, group: str, c: RunColumns = RUNS) -> DataFrame:
    """Fastest successful run of each group; the lower run id wins a tie."""
    by_time = F.struct(F.col(c.seconds), F.col(c.run_id))
    return (
        successful(df, c)
        .groupBy(group)
        .agg(F.min(by_time).alias("best"))
        .select(
            group,
            F.col("best")[c.run_id].alias("best_run_id"),
            F.col("best")[c.seconds].alias("best_seconds"),
        )
    )


def factor_marginals(df: DataFrame, factors: Sequence[str], c: RunColumns = RUNS) -> DataFrame:
    """Effect of each setting on its own: run times per value of each factor in turn.

    One grouping set per factor; the other factors are NULL in its rows and ``factor_set``
    (the grouping id) tells the sets apart.
    """
    return successful(df, c).groupingSets([[factor] for factor in factors], *factors).agg(
        F.grouping_id().alias("factor_set"),
        F.count(F.lit(1)).alias("runs"),
        F.avg(c.seconds).alias("mean_seconds"),
        F.min(c.seconds).alias("min_seconds"),
        F.max(c.seconds).alias("max_seconds"),
    )


def success_rate(df: DataFrame, group: str, c: RunColumns = RUNS) -> DataFrame:
    ok = F.col(c.status) == STATUS_OK
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("ok_runs"),
        F.avg(F.when(ok, 1.0).otherwise(0.0)).alias("success_rate"),
    )


def run_regressions(
    df: DataFrame, group: str, p: float = 0.8, factor: float = 2.0, c: RunColumns = RUNS
) -> DataFrame:
    """Runs slower than ``factor`` times the typical run (percentile ``p``) of their group."""
    typical = materialise(group_percentile(df, group, c.seconds, p, "typical_seconds"), "typical")
    limits = typical.withColumnRenamed(group, "limit_group")
    return (
        df.join(limits, F.col(group).eqNullSafe(F.col("limit_group")))
        .drop("limit_group")
        .filter(F.col(c.seconds) > F.col("typical_seconds") * factor)
    )


def audit_json(df: DataFrame, fields: dict[str, Column], column: str = "record") -> DataFrame:
    """One JSON object per row; fields that are NULL are left out."""
    members = [value.alias(name) for name, value in fields.items()]
    return df.select(F.to_json(F.struct(*members)).alias(column))


def audit_fields(
    logged_at: str, level: Column, message: Column, context: dict[str, Column], origin: dict[str, Column] | None = None
) -> dict[str, Column]:
    """Fields of a structured log record in their fixed order.

    ``origin`` says where a record was made: ``logger``, ``module``, ``function`` and ``line``, each optional.
    ``context`` holds the optional fields behind them.
    """
    made = origin or {}
    unknown = set(made) - {"logger", "module", "function", "line"}
    if unknown:
        raise ValueError(f"no fields of a record's origin: {sorted(unknown)}")
    ordered = {
        "timestamp": F.date_format(logged_at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "level": level,
        "logger": made.get("logger"),
        "message": message,
        "module": made.get("module"),
        "function": made.get("function"),
        "line": made.get("line"),
    }
    return {**{name: value for name, value in ordered.items() if value is not None}, **context}
