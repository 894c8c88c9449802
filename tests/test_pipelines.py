"""Pipelines from stored grids to result tables, on grids derived from the test tables."""

from __future__ import annotations

import json
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from isograd.__main__ import main
from isograd.catalog import COORDS, REGIONS, TIME
from isograd.operators import layout
from isograd.plans import pipelines
from isograd.plans import testgrids as grids
from isograd.plans.regional import regional_daily, sampled_regional_daily
from isograd.sources import tables
from isograd.sources.grid import as_grid, read_grid, read_grid_multi, write_grid

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("grids"))
    write_grid(grids.instant(spark, SMALL), f"{root}/instant", partitions=3)
    write_grid(grids.accum(spark, SMALL), f"{root}/accum", partitions=3)
    sampled = grids.sampled(spark, SMALL)
    write_grid(sampled.select(*COORDS, "t2m", "sp"), f"{root}/s_instant", partitions=3)
    write_grid(sampled.select(*COORDS, "tp"), f"{root}/s_accum", partitions=3)
    return root


def document(path):
    (name,) = glob.glob(f"{path}/*.json")
    with open(name) as f:
        return json.loads(f.read())


def near(a, b, places=1e-9):
    return abs(a - b) <= places * max(1.0, abs(a), abs(b))


def test_region_year(spark, stored, tmp_path):
    out = str(tmp_path)
    main(["region-year", "--instant", f"{stored}/instant", "--accum", f"{stored}/accum", "--out", out])
    daily = tables.read_time_table(spark, f"{out}/daily").orderBy("time").collect()
    want = regional_daily(grids.instant(spark, SMALL), grids.accum(spark, SMALL)).orderBy("time").collect()
    assert [r["time"] for r in daily] == [r["time"] for r in want]
    for got, full in zip(daily, want):
        for c in full.asDict():
            if c != "time" and full[c] is not None:
                assert abs(got[c] - full[c]) <= 0.5e-4 + 1e-9
    doc = document(f"{out}/summary")
    assert doc["region"]["north"] == 35.0
    assert doc["grid_shape"] == {"time_steps": 40, "lat_points": 3, "lon_points": 4} and doc["rows_daily"] == 15
    temps = [r["t2m_c"] for r in want if r["t2m_c"] is not None]
    assert doc["temperature"]["annual_mean_c"] == pytest.approx(sum(temps) / len(temps), abs=0.0051)
    assert doc["temperature"]["hottest_month"] == "Jan"
    for name in ("heat", "monthly", "anomaly", "annual_cycle", "monthly_energy", "anomaly_series"):
        assert glob.glob(f"{out}/{name}/*.csv")
    assert spark.read.csv(f"{out}/monthly_energy", header=True).count() == 12


def test_blocks_do_not_change_the_tables(spark, stored, tmp_path):
    out = str(tmp_path)
    common = ["region-year", "--instant", f"{stored}/instant", "--accum", f"{stored}/accum"]
    main([*common, "--out", f"{out}/a", "--sample-days", "4"])
    main([*common, "--out", f"{out}/b", "--sample-days", "4", "--blocks", "24", "30", "30"])
    a, b = (tables.read_time_table(spark, f"{out}/{run}/daily") for run in "ab")
    assert a.count() == 5 and a.exceptAll(b).isEmpty()


def test_sample_days_end_inclusive(spark):
    daily = regional_daily(grids.instant(spark, SMALL), grids.accum(spark, SMALL), days=2)
    assert daily.count() == 3


def test_sampled_region(spark, stored, tmp_path):
    out = str(tmp_path)
    pipelines.sampled_region(spark, f"{stored}/s_instant", f"{stored}/s_accum", out)
    doc = document(f"{out}/summary")
    want = sampled_regional_daily(grids.sampled(spark, SMALL))
    one = want.agg(F.avg("t2m_c_mean"), F.sum("tp_mm_total"), F.corr("t2m_c_mean", "sp_hpa_mean")).first()
    assert near(doc["temperature_summary"]["mean_t2m_c"], one[0])
    assert near(doc["precipitation_summary"]["total_tp_mm"], one[1])
    assert near(doc["correlations"]["temp_pressure"], one[2], 1e-6)
    assert doc["grid_shape"]["rows"] == 561
    assert (doc["grid_shape"]["latitude"], doc["grid_shape"]["longitude"]) == (3, 3)
    assert doc["dataset"] == "ERA5 Consistent Slice (464 MB)"
    seasons = spark.read.csv(f"{out}/season", header=True).collect()
    assert [r["season"] for r in seasons] == ["Monsoon sampled days", "Other sampled days"]
    assert [r["day_count"] for r in seasons] == ["0", "11"]


def test_empty_region_is_an_error(spark, stored, tmp_path):
    far = REGIONS["south_asia"].__class__("nowhere", north=-80.0, south=-85.0, west=0.0, east=1.0)
    with pytest.raises(ValueError, match="nowhere"):
        pipelines.region_year(spark, f"{stored}/instant", f"{stored}/accum", str(tmp_path), far)


def test_kept_tables_are_used_refreshed_and_fall_back(spark, tmp_path):
    path = str(tmp_path / "kept")
    calls = []

    def compute(value):
        def run():
            calls.append(value)
            return {"t": spark.range(2).withColumn("v", F.lit(value))}

        return run

    def missing():
        return {"t": spark.read.parquet(str(tmp_path / "nowhere"))}

    def wrong():
        raise ValueError("a key occurs twice")

    def values(kept):
        return [r["v"] for r in kept.tables["t"].collect()]

    def keep(identity, how, **kw):
        return tables.kept_tables(spark, path, identity, how, **kw)

    with pytest.raises(AnalysisException):
        keep({"a": 1}, missing)
    first, again = keep({"a": 1}, compute(1)), keep({"a": 1}, compute(2))
    assert calls == [1] and values(first) == values(again) == [1, 1]
    assert (first.source, again.source, again.run) == ("computed", "kept", first.run)
    assert values(keep({"a": 2}, compute(5))) == [5, 5]  # other parameters, another table
    fresh = keep({"a": 1}, compute(3), recompute=True)
    assert values(fresh) == [3, 3] and fresh.run != first.run
    old = keep({"a": 1}, missing, recompute=True)
    assert values(old) == [3, 3] and (old.source, old.run) == ("kept, inputs unreadable", fresh.run)
    with pytest.raises(ValueError, match="twice"):
        keep({"a": 1}, wrong, recompute=True)

    def half():
        spark.range(1).write.parquet(f"{path}/half")
        return {"t": spark.range(3).withColumn("v", F.lit(9)), "u": spark.read.parquet(str(tmp_path / "nowhere"))}

    assert values(keep({"a": 1}, half, recompute=True)) == [3, 3]  # a run without its mark is not read


def test_kept_daily_table_follows_its_parameters(spark, stored, tmp_path):
    run = ["region-year", "--instant", f"{stored}/instant", "--accum", f"{stored}/accum", "--out", str(tmp_path)]

    def days():
        return tables.read_time_table(spark, f"{tmp_path}/daily").count(), document(f"{tmp_path}/summary")

    main([*run, "--sample-days", "2"])
    rows, doc = days()
    assert rows == 3 and doc["grid_shape"]["time_steps"] == 9 and doc["sample"]["rows"] == 3 and doc["sample"]["sample_days"] == 2
    main(run)
    rows, doc = days()
    assert rows == 15 and doc["grid_shape"]["time_steps"] == 40 and doc["daily_table"]["source"] == "computed" and "sample" not in doc
    main(run)
    assert days()[1]["daily_table"]["source"] == "kept"
    whole = tables.read_time_table(spark, f"{tmp_path}/daily").collect()
    main([*run, "--region", "central_india"])
    rows, doc = days()
    assert doc["region"]["name"] == REGIONS["central_india"].name
    assert tables.read_time_table(spark, f"{tmp_path}/daily").collect() != whole


def rows_of(spark, path):
    return sorted(map(repr, spark.read.csv(path, header=True).collect()))


def test_refreshed_region_year_reads_changed_months(spark, tmp_path):
    """The same tables as a whole run, after a month was added and another mended."""
    instant, accum = grids.instant(spark, "/root/testdata/sf0.01"), grids.accum(spark, "/root/testdata/sf0.01")
    later, t = F.col("valid_time") >= F.lit("2024-02-01").cast("timestamp_ntz"), f"{tmp_path}/t"
    write_grid(instant.where(~later), f"{tmp_path}/instant")
    write_grid(accum.where(~later).withColumn("ssr", F.col("ssr") + 1.0), f"{tmp_path}/accum")
    run = lambda: pipelines.region_year_refreshed(spark, f"{tmp_path}/instant", f"{tmp_path}/accum", t)
    read = lambda: spark.read.json(f"{t}/summary").select("months_read.*").first().asDict()
    run()
    assert read() == {"instant": ["2024-01"], "accum": ["2024-01"]}
    write_grid(instant.where(later), f"{tmp_path}/instant", mode="append")
    write_grid(accum, f"{tmp_path}/accum", replace_months=True)
    run()
    assert read()["accum"][0] == "2024-01" and "2024-01" not in read()["instant"]
    pipelines.region_year(spark, f"{tmp_path}/instant", f"{tmp_path}/accum", f"{tmp_path}/whole")
    for name in ("daily", "heat", "monthly", "anomaly", "annual_cycle", "monthly_anomaly"):
        assert rows_of(spark, f"{t}/{name}") == rows_of(spark, f"{tmp_path}/whole/{name}")
    run()
    assert read() == {"instant": [], "accum": []}


def test_regions_merge_and_conflicts_commands(spark, stored, tmp_path):
    out = str(tmp_path)
    main(["regions", "--instant", f"{stored}/instant", "--out", f"{out}/regions"])
    daily = spark.read.parquet(f"{out}/regions/daily")
    assert {r.region for r in daily.select("region").distinct().collect()} == set(REGIONS)
    pipelines.region_year(spark, f"{stored}/instant", f"{stored}/accum", f"{out}/one")
    want = {r["time"]: float(r["t2m_c"]) for r in spark.read.csv(f"{out}/one/daily", header=True).where("t2m_c is not null").collect()}
    got = {str(r.time): round(r.t2m_c, 4) for r in daily.where("region = 'south_asia'").collect()}
    assert got == pytest.approx(want, abs=2e-4)
    for _ in range(2):  # the second run uses the stored cells
        main(["merge", "--instant", f"{stored}/instant", "--accum", f"{stored}/accum", "--out", f"{out}/m", "--buckets", "4"])
    merged = spark.read.parquet(f"{out}/m/merged")
    assert merged.count() == 1500 and merged.where("t2m is not null and ssr is not null").count() == 1000
    main(["conflicts", "--grid", f"{stored}/instant", f"{stored}/accum", "--out", f"{out}/c"])
    assert spark.read.parquet(f"{out}/c/conflicts").count() == 0 and spark.read.parquet(f"{out}/c/grid").count() == 1500


def test_stored_grid_prunes_columns_files_and_rows(spark, stored):
    from isograd.operators.select import in_region, time_between

    df = in_region(read_grid(spark, f"{stored}/instant", ["t2m"]), REGIONS["south_asia"])
    df = time_between(df, "2024-01-01 00:00:00", "2024-01-03 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(latitude,5.0)" in scan.replace(" ", "") or "PushedFilters" in scan
    assert "tcc" not in scan.split("ReadSchema")[1]
    assert "year" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_multi_open_by_time_and_by_variable(spark, stored, tmp_path):
    whole = grids.instant(spark, SMALL)
    cut = F.lit("2024-01-05").cast("timestamp_ntz")
    whole.where(F.col(TIME) < cut).write.parquet(str(tmp_path / "a"))
    whole.where(F.col(TIME) >= cut).write.parquet(str(tmp_path / "b"))
    parts = [str(tmp_path / "a"), str(tmp_path / "b")]
    for disjoint in (True, False):
        got = read_grid_multi(spark, parts, disjoint=disjoint)
        assert got.select(*whole.columns).exceptAll(whole).isEmpty() and got.count() == whole.count()
    both = read_grid_multi(spark, [f"{stored}/instant", f"{stored}/accum"])
    assert set(both.columns) == {*COORDS, "t2m", "tcc", "ssr", "str", "tisr", "tsr", "ttr"}
    assert both.count() == 1500


def test_layout_study_and_experiment(spark, stored, tmp_path):
    axes = grids.DENSE_AXES
    tiles = {
        "time_first": lambda df: layout.tile_time(df, axes, 24),
        "balanced": lambda df: layout.tile_blocks(df, axes, 120, 2, 2, partitions=4),
        "space_first": lambda df: layout.tile_space(df, axes, 2, 2),
    }
    out = str(tmp_path)
    runs = pipelines.monthly_layout_study(spark, [f"{stored}/instant", f"{stored}/accum"], f"{out}/m", tiles).collect()
    assert [r["name"] for r in runs] == list(tiles) and all(r["partitions"] > 0 for r in runs)
    agreement = spark.read.csv(f"{out}/m/agreement", header=True, inferSchema=True).collect()
    assert len(agreement) == 2 * 7 + 2 and all(r["passed"] for r in agreement)
    assert spark.read.csv(f"{out}/m/radiation", header=True).count() == 5
    assert spark.read.csv(f"{out}/m/overlay", header=True).columns == ["month", *tiles]

    runs = pipelines.run_experiment(
        spark, f"{stored}/instant", f"{stored}/accum", f"{out}/e", tiles, "space_first", "balanced"
    )
    assert document(f"{out}/e/speedup")["value_abs_diff"] == 0.0
    assert document(f"{out}/e/best_worst")["runs"] == 3


def test_validation_and_consistency_of_two_runs(spark, stored, tmp_path):
    out = str(tmp_path)
    for run in ("a", "b"):
        pipelines.region_year(spark, f"{stored}/instant", f"{stored}/accum", f"{out}/{run}")
    report = pipelines.validate(spark, f"{out}/a", f"{out}/b", f"{out}/v").collect()
    assert len(report) == 13 + 11 + 11 + 2
    assert all(r["passed"] for r in report)
    doc = document(f"{out}/v/validation_summary")
    assert doc["tables"] == ["daily_regional_means", "heat_extremes", "monthly_climatology", "temperature_anomalies"]
    assert doc["all_passed"] is True and doc["checks"] == len(report)
    assert doc["skipped"] == []
    import shutil

    shutil.copytree(f"{out}/b", f"{out}/part", ignore=shutil.ignore_patterns("heat"))
    pipelines.validate(spark, f"{out}/a", f"{out}/part", f"{out}/p")
    assert document(f"{out}/p/validation_summary")["skipped"] == ["heat_extremes"]
    daily, anomalies = pipelines.check_consistency(spark, f"{out}/a", f"{out}/b", f"{out}/c")
    assert {r["metric"] for r in daily.collect()} == set(pipelines.CONSISTENCY_COLUMNS)
    assert all(r["max_abs_diff"] == 0.0 for r in anomalies.collect())
    with pytest.raises(FileNotFoundError):
        pipelines.validate(spark, f"{out}/none", f"{out}/b", f"{out}/w")


def test_global_mean_command(spark, stored, tmp_path):
    out = str(tmp_path)
    main(["global-mean", "--variable", "ttr", "--grid", f"{stored}/accum", "--out", out])
    rows = spark.read.csv(f"{out}/rolling24", header=True, inferSchema=True).orderBy(TIME).collect()
    assert len(rows) == 60
    assert [r["ttr_global_rolling24"] is not None for r in rows] == [12 <= i <= 60 - 12 for i in range(60)]


def test_global_means_of_both_step_types(spark, stored, tmp_path):
    out = str(tmp_path)
    main(["global-mean", "--variable", "t2m", "ttr", "--grid", f"{stored}/instant", f"{stored}/accum", "--out", out])
    got = spark.read.parquet(f"{out}/series")
    assert got.columns == [TIME, "t2m_global", "t2m_region", "ttr_global", "ttr_region"] and got.count() == 60
    want = grids.instant(spark, SMALL).agg(F.avg("t2m")).first()[0] - 273.15
    assert got.where("t2m_global IS NOT NULL").agg(F.avg("t2m_global")).first()[0] == pytest.approx(want, abs=0.2)
    with pytest.raises(ValueError, match="sst"):
        pipelines.region_and_global(spark, [f"{stored}/instant"], ["sst"], out)


def test_times_are_read_in_utc_whatever_the_session(spark, tmp_path):
    spark.range(3).selectExpr(
        "timestamp_seconds(1704067200 + id * 21600) AS valid_time", "1704067200 + id * 21600 AS s", "10.0 AS latitude", "70.0 AS longitude", "id AS v"
    ).write.parquet(str(tmp_path / "g"))
    stored_rows = spark.read.parquet(str(tmp_path / "g"))
    seconds = stored_rows.drop("valid_time").withColumnRenamed("s", "valid_time")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            for df in (stored_rows.drop("s"), seconds):
                got = [str(r[TIME]) for r in as_grid(df).orderBy(TIME).collect()]
                assert got == ["2024-01-01 00:00:00", "2024-01-01 06:00:00", "2024-01-01 12:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError, match="string"):
        as_grid(seconds.withColumn("valid_time", F.lit("2024")))


def test_keyed_tables_are_sorted(spark, tmp_path):
    rows = [(f"2024-01-{d:02d}", float(d)) for d in (3, 1, 2)]
    tables.write_table(spark.createDataFrame(rows, "time string, v double").repartition(3), str(tmp_path / "t"))
    assert [r["v"] for r in tables.read_time_table(spark, str(tmp_path / "t")).collect()] == [1.0, 2.0, 3.0]
