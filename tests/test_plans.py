"""The physical plans stay the ones designed: pushed filters, few scans, no unbounded single task."""

from __future__ import annotations

import re

import pytest

from isograd.catalog import ACCUM_VARIABLES, INSTANT_VARIABLES, REGIONS
from isograd.operators import align, select
from isograd.plans import testgrids as grids
from isograd.plans.queries import QUERIES
from isograd.plans.regional import regional_daily
from isograd.sources.grid import read_grid

SMALL = "/root/testdata/sf0.001"


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    return initial(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"csv_roundtrip", "stored_grid", "kept_daily", "kept_refresh"}))
def test_no_pair_join_and_no_python(name, spark):
    plan = initial(QUERIES[name](spark, SMALL))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "CollectLimit"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name,scans",
    [
        ("daily_metrics", 2),
        ("monthly_climatology", 2),
        ("daily_anomaly", 2),
        ("annual_cycle", 2),
        ("monthly_energy", 2),
        ("rolling15", 2),
        ("rolling24", 1),
        ("daily_gap_filled", 1),
        ("calendar_month", 2),
        ("radiation_heatmap", 1),
        ("region_summary", 2),
        ("region_vs_global", 1),
        ("both_steps_means", 2),
        ("grid_shape", 1),
        ("season_compare", 1),
        ("consistency_daily", 2),
        ("consistency_anomaly", 2),
        ("validation_metrics", 2),
        ("validation_rollup", 2),
        ("packed_means", 1),
        ("regions_daily", 1),
    ],
)
def test_each_table_is_scanned_once(name, scans, spark):
    assert final(QUERIES[name](spark, SMALL)).count("FileScan") == scans


@pytest.mark.parametrize("name", ["daily_metrics", "daily_anomaly", "central_daily", "region_summary", "layout_balanced"])
def test_reductions_need_no_window_or_sort(name, spark):
    plan = initial(QUERIES[name](spark, SMALL))
    assert "Window" not in plan and "SortMergeJoin" not in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Grids as float32 files, the type weather files have."""
    root = str(tmp_path_factory.mktemp("f32"))
    for name, df in (("instant", grids.instant(spark, SMALL)), ("accum", grids.accum(spark, SMALL))):
        casts = [f"CAST({c} AS FLOAT) AS {c}" for c in df.columns if c != "valid_time"]
        df.selectExpr("valid_time", *casts).write.parquet(f"{root}/{name}")
    return root


def test_region_pipeline_on_files(spark, stored):
    instant = read_grid(spark, f"{stored}/instant", INSTANT_VARIABLES)
    accum = read_grid(spark, f"{stored}/accum", ACCUM_VARIABLES)
    plan = initial(regional_daily(instant, accum))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    formatted = regional_daily(instant, accum)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.findall(r"PushedFilters: (.*)", formatted)
    assert len(pushed) == 2
    for filters in pushed:
        for bound in (
            "GreaterThanOrEqual(latitude,5.0)",
            "LessThanOrEqual(latitude,35.0)",
            "GreaterThanOrEqual(longitude,65.0)",
            "LessThanOrEqual(longitude,100.0)",
        ):
            assert bound in filters
    # step shuffle of each grid, then one by day; the two series meet without another
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Exchange hashpartitioning(valid_time") == 2


def test_only_requested_columns_are_read(spark, stored):
    plan = initial(read_grid(spark, f"{stored}/accum", ["ttr"]))
    (schema,) = re.findall(r"ReadSchema: (.*)", plan)
    assert "ttr" in schema and "ssr" not in schema


def test_region_filter_passes_through_merging(spark):
    merged = align.merge_steps(grids.instant(spark, SMALL), grids.accum(spark, SMALL))
    plan = select.in_region(merged, REGIONS["south_asia"])._jdf.queryExecution().optimizedPlan().toString()
    union = plan.index("Union")
    assert plan.count("35.0", union) == 2 and "35.0" not in plan[:union]


def test_anomalies_move_no_row_by_its_month(spark):
    """Above the broadcast limit too: twelve means travel, not the rows."""
    from isograd.catalog import LATITUDE, LONGITUDE, TIME
    from isograd.operators import windows

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        cells = grids.instant(spark, SMALL).select(TIME, LATITUDE, LONGITUDE, "t2m")
        plan = initial(windows.anomaly(cells, ["t2m"], TIME))
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
        assert plan.count("Exchange hashpartitioning") == 1  # the partial means
        # Per cell the partial means and the means travel, and the rows once.
        split = initial(windows.anomaly(cells, ["t2m"], TIME, partition=[LATITUDE, LONGITUDE]))
        assert "Window" not in split and split.count("Exchange hashpartitioning") == 3 and split.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cells_are_numbered_from_their_keys(spark):
    """The sizes of a cell's months are counted over coordinates alone, by hash."""
    plan = initial(QUERIES["cell_rolling"](spark, SMALL))
    scans = re.findall(r"ReadSchema: (\S+)", plan)
    assert sorted(scans) == ["struct<event_id:bigint,value:double>", "struct<event_id:bigint>"]
    for name in ("cell_rolling", "rolling24", "rolling15", "calendar_month", "layout_overlay", "daily_gap_filled"):
        assert "SortAggregate" not in initial(QUERIES[name](spark, SMALL))


def test_stored_grid_filters_reach_the_files(spark):
    plan = initial(QUERIES["stored_grid"](spark, SMALL))
    (partitions,) = re.findall(r"PartitionFilters: (.*?)PushedFilters", plan.replace("\n", " "))
    assert "year" in partitions
    assert "GreaterThanOrEqual(latitude" in plan
