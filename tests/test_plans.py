"""What the plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as register
from tidemark.operators import explore, quality, runs
from tidemark.plans import bronze, gold
from tidemark.plans.sinks import WriteOptions, write_table
from tidemark.scratch import materialise
from tidemark.sources import feeds


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lines(spark, data_dir):
    return feeds.read_trips(spark, data_dir, "lineitem")


def test_validity_filter_reaches_the_scan(lines):
    plan = physical(quality.keep_valid(lines))
    assert "GreaterThan(l_quantity,0.0)" in plan and "GreaterThan(l_linenumber,0)" in plan


def test_only_needed_columns_are_read(lines):
    plan = physical(explore.volume_by(lines, "hvfhs_license_num"))
    assert "ReadSchema: struct<l_returnflag:string>" in plan
    assert "ReadSchema: struct<>" in physical(explore.row_count(lines))


def test_overview_reads_no_column(spark, data_dir):
    assert "ReadSchema: struct<>" in physical(explore.dataset_overview(feeds.raw_table(spark, data_dir, "lineitem")))


def test_bronze_needs_no_shuffle(spark, data_dir):
    plan = physical(bronze.transform(feeds.read_trips(spark, data_dir, "lineitem", lineage=True)))
    assert "Exchange" not in plan and "PushedFilters: [IsNotNull" in plan


def test_tagging_stays_in_generated_code(lines):
    assert physical(quality.tag(lines, quality.TRIP_RULES)).lstrip().startswith("*(1) Project")


def test_metrics_take_one_pass(lines):
    assert physical(quality.metrics(lines, quality.TRIP_RULES)).count("FileScan") == 1


def test_month_slice_prunes_partitions(spark, data_dir, tmp_path):
    rows = bronze.transform(feeds.read_trips(spark, data_dir, "orders", lineage=True))
    write_table(rows, str(tmp_path), WriteOptions(refresh="table"))
    sliced = bronze.month_slice(bronze.read_bronze(spark, str(tmp_path)), ["1997-01"])
    plan = physical(sliced)
    assert "DataFilters: []" in plan and "PartitionFilters: [isnotnull(pickup_month" in plan
    assert all("pickup_month=1997-01" in path for path in sliced.inputFiles()) or sliced.count() > 0


@pytest.mark.parametrize("query", [explore.longest_trips_per_day, gold.location_month])
def test_top_per_group_is_limited_before_the_shuffle(query, lines):
    plan = physical(query(lines))
    assert "Final" in plan and "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_top_n_is_not_a_full_sort(lines):
    assert "TakeOrderedAndProject" in physical(explore.top_by_volume(lines, "PULocationID"))


def test_grid_needs_no_join(lines):
    assert "Join" not in physical(explore.demand_grid(lines))


def test_written_tables_are_joined_by_their_real_size(spark, lines):
    """Small tables are broadcast because their size is known; above the threshold Spark shuffles."""
    table = materialise(explore.volume_by(lines, "PULocationID").withColumnRenamed("PULocationID", "k"))
    joined = lines.join(table, lines.PULocationID == table.k)
    assert "BroadcastHashJoin" in physical(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in physical(lines.join(table, lines.PULocationID == table.k))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_regressions_without_broadcast_give_the_same_rows(spark, data_dir):
    def slow():
        return sorted(r.run_id for r in runs.run_regressions(register._run_results(spark, data_dir), "config_id").collect())

    want = slow()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert slow() == want and want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(register.core_queries()))
def test_no_python_in_plans_and_no_cross_join(name, spark, data_dir):
    plan = physical(register.core_queries()[name](spark, data_dir))
    for banned in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    # Whole metadata structs appear when lineage is read and then dropped.
    assert "row_index" not in plan
