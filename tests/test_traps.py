"""Hand-computed cases, one or more per semantic decision."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from isograd.catalog import REGIONS, TIME, VARIABLES, Region
from isograd.functions import calendar, columns, units
from isograd.operators import align, compare, figures, select, spatial, summary, temporal, windows
from isograd.sources import guards, tables
from isograd.sources.grid import as_grid, explode_grid

NAN = float("nan")


def ts(text):
    return dt.datetime.fromisoformat(text)


def grid(spark, rows, schema="valid_time timestamp_ntz, latitude double, longitude double, t2m double"):
    return spark.createDataFrame(rows, schema)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def days(spark, values, start="2024-01-01", name="v"):
    first = dt.date.fromisoformat(start)
    rows = [(first + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"time date, {name} double")


# --- Units and calendar -------------------------------------------------------


def test_flux_divisor_is_the_step_length(spark):
    r = one(
        spark.range(1).select(
            units.accum_to_flux(F.lit(43_200.0)).alias("six"),
            units.accum_to_flux(F.lit(43_200.0), units.STEP_SECONDS_1H).alias("one"),
        )
    )
    assert (r.six, r.one) == (2.0, 12.0)


def test_epoch_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = one(spark.range(1).select(calendar.epoch_to_ts(F.lit(1_704_067_200)).alias("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.t == ts("2024-01-01T00:00:00")


def test_calendar_keys_and_labels(spark):
    df = grid(spark, [(ts("2024-02-29T18:00:00"), 1.0, 1.0, 1.0)])
    r = one(
        calendar.with_calendar(df).select(
            "date", "month", "year", calendar.month_label(F.col("month")).alias("m"),
            calendar.month_end(F.col(TIME)).alias("e"), calendar.season(F.lit(6)).alias("s6"),
            calendar.season(F.lit(10)).alias("s10"),
        )
    )
    assert (r.date, r.month, r.year, r.m, r.e) == (dt.date(2024, 2, 29), 2, 2024, "Feb", dt.date(2024, 2, 29))
    assert (r.s6, r.s10) == ("Monsoon sampled days", "Other sampled days")


def test_unit_names_are_ascii():
    assert columns.unit_name("t2m", "°C") == "t2m_C"
    assert columns.unit_name("ssr", "W m⁻²") == "ssr_Wm2"
    assert columns.unit_name("tcc", "fraction") == "tcc_fraction"
    assert all(columns.unit_name(v.name, v.unit).isascii() for v in VARIABLES.values())


def test_rounding_is_half_up_without_negative_zero(spark):
    df = spark.createDataFrame([(0.00015, -0.00001)], "a double, b double")
    r = one(columns.round_columns(df, 4))
    assert r.a == 0.0002 and math.copysign(1.0, r.b) == 1.0


# --- Selection ----------------------------------------------------------------


def test_region_bounds_are_inclusive(spark):
    rows = [(ts("2024-01-01T00:00:00"), lat, lon, 1.0) for lat in (4.75, 5.0, 35.0, 35.25) for lon in (65.0, 100.0, 100.25)]
    got = select.in_region(grid(spark, rows), REGIONS["south_asia"]).collect()
    assert sorted((r.latitude, r.longitude) for r in got) == [(5.0, 65.0), (5.0, 100.0), (35.0, 65.0), (35.0, 100.0)]


def test_time_window_includes_its_end(spark):
    rows = [(ts("2024-01-01T00:00:00") + dt.timedelta(hours=6 * i), 0.0, 0.0, 1.0) for i in range(20)]
    df = grid(spark, rows)
    assert select.time_window(df, 2).count() == 9
    assert select.time_window(df, 2, "2024-01-02 00:00:00").count() == 9
    assert select.time_window(df, 0).count() == 20
    assert select.time_window(df, 2).select(F.to_date(TIME)).distinct().count() == 3


def test_preview_goes_north_to_south(spark):
    t = ts("2024-01-01T00:00:00")
    rows = [(t, 1.0, 2.0, 0.0), (t, 2.0, 1.0, 0.0), (t, 2.0, 2.0, 0.0), (t + dt.timedelta(hours=6), 9.0, 0.0, 0.0)]
    got = [(r.latitude, r.longitude) for r in select.preview(grid(spark, rows), 3).collect()]
    assert got == [(2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]


# --- Means over space ----------------------------------------------------------


def test_weighted_mean_of_two_latitudes(spark):
    t = ts("2024-01-01T00:00:00")
    df = grid(spark, [(t, 0.0, 0.0, 10.0), (t, 60.0, 0.0, 20.0)])
    assert one(spatial.weighted_spatial_mean(df, ["t2m"])).t2m == pytest.approx(13.33333333, abs=1e-8)
    assert one(spatial.spatial_mean(df, ["t2m"])).t2m == 15.0


def test_missing_cells_leave_their_weight_out(spark):
    t = ts("2024-01-01T00:00:00")
    df = as_grid(grid(spark, [(t, 0.0, 0.0, 10.0), (t, 60.0, 0.0, NAN), (t, 60.0, 1.0, None)]))
    assert one(spatial.weighted_spatial_mean(df, ["t2m"])).t2m == pytest.approx(10.0)
    all_missing = as_grid(grid(spark, [(t, 0.0, 0.0, NAN)]))
    assert one(spatial.weighted_spatial_mean(all_missing, ["t2m"])).t2m is None


def test_nan_is_not_hot_and_stays_in_the_denominator(spark):
    t = ts("2024-01-01T00:00:00")
    df = as_grid(grid(spark, [(t, 0.0, 0.0, 36.0), (t, 0.0, 1.0, NAN), (t, 0.0, 2.0, 35.0), (t, 0.0, 3.0, 41.0)]))
    df = df.withColumnRenamed("t2m", "t2m_c")
    r = one(spatial.area_fraction(df))
    assert (r.frac_above_35c, r.frac_above_40c) == (0.5, 0.25)
    r = one(spatial.area_fraction(df, denominator="present"))
    assert r.frac_above_35c == pytest.approx(2 / 3)


def test_heat_fraction_ignores_accum_only_steps(spark):
    t0, t1 = ts("2024-01-01T00:00:00"), ts("2024-01-02T00:00:00")
    inst = grid(spark, [(t0, 0.0, 0.0, 320.0, 0.5)], "valid_time timestamp_ntz, latitude double, longitude double, t2m double, tcc double")
    acc = spark.createDataFrame(
        [(t, 0.0, x, 1.0, 1.0, 1.0, 1.0, 1.0) for t in (t0, t1) for x in (0.0, 1.0)],
        "valid_time timestamp_ntz, latitude double, longitude double, ssr double, str double, tisr double, tsr double, ttr double",
    )
    rows = {r[TIME]: r for r in spatial.regional_series(inst, acc).collect()}
    assert rows[t0].frac_above_40c == 1.0
    assert rows[t1].frac_above_40c is None and rows[t1].t2m_c is None and rows[t1].ssr is not None


def test_region_and_global_from_one_pass(spark):
    t = ts("2024-01-01T00:00:00")
    df = grid(spark, [(t, 10.0, 70.0, 1.0), (t, 50.0, 70.0, 4.0)])
    r = one(spatial.region_vs_global(df, ["t2m"], REGIONS["south_asia"]))
    assert (r.t2m_global, r.t2m_region) == (2.5, 1.0)


# --- Means over time ------------------------------------------------------------


def test_daily_extremes_are_those_of_the_means(spark):
    base = {"tcc": 0.0, "ssr": 3.0, "str_nlw": -1.0, "tisr": 5.0, "tsr": 3.5, "ttr": 0.0}
    rows = [dict(valid_time=ts(f"2024-01-01T{h:02d}:00:00"), t2m_c=v, **base) for h, v in ((0, 1.0), (6, 5.0), (12, 3.0))]
    types = ", ".join(f"{c} double" for c in ("t2m_c", *base))
    r = one(temporal.daily_metrics(spark.createDataFrame(rows, f"valid_time timestamp_ntz, {types}")))
    assert (r.t2m_c, r.t2m_c_max, r.t2m_c_min, r.net_rad, r.reflected_solar) == (3.0, 5.0, 1.0, 2.0, 1.5)


def test_precipitation_is_summed_and_missing_days_are_zero(spark):
    rows = [
        (ts("2021-01-01T00:00:00"), 1.0), (ts("2021-01-01T04:00:00"), 2.0), (ts("2021-01-04T00:00:00"), 3.0),
        (ts("2021-01-05T00:00:00"), None),
    ]
    df = spark.createDataFrame(rows, "valid_time timestamp_ntz, tp_mm_mean double")
    daily = temporal.daily_precip(df)
    assert [r.tp_mm_total for r in daily.orderBy("date").collect()] == [3.0, 3.0, 0.0]


def test_resampling_fills_gaps_and_grouping_does_not(spark):
    rows = [(dt.date(2024, 1, 1), 1.5, 3.0), (dt.date(2024, 1, 4), 3.0, 3.0)]
    df = spark.createDataFrame(rows, "time date, mean double, total double")
    got = temporal.fill_calendar(df, "time", zero=["total"]).orderBy("time").collect()
    assert [(r["mean"], r["total"]) for r in got] == [(1.5, 3.0), (None, 0.0), (None, 0.0), (3.0, 3.0)]
    assert temporal.fill_calendar(df.where("false"), "time").count() == 0


def test_calendar_months_include_empty_ones(spark):
    rows = [(ts("2024-01-05T00:00:00"), 274.15, 0.001), (ts("2024-01-06T00:00:00"), None, 0.002), (ts("2024-03-01T00:00:00"), 276.15, 0.0)]
    df = spark.createDataFrame(rows, "valid_time timestamp_ntz, t2m double, tp double")
    got = temporal.calendar_month_agg(df).orderBy(TIME).collect()
    assert [r[TIME] for r in got] == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    assert [r.t2m_C for r in got] == [pytest.approx(1.0), None, pytest.approx(3.0)]
    assert [r.tp_mm for r in got] == [pytest.approx(3.0), 0.0, 0.0]
    assert [r.month_abbr for r in got] == ["Jan", "Feb", "Mar"]


def test_climatology_pools_years(spark):
    df = spark.createDataFrame(
        [(dt.date(2021, 1, 1), 1.0), (dt.date(2022, 1, 9), 3.0), (dt.date(2022, 2, 1), 7.0)], "time date, v double"
    )
    got = temporal.month_spine(temporal.monthly_climatology(df)).orderBy("month").collect()
    assert [r.v for r in got] == [2.0, 7.0] + [None] * 10


# --- Windows --------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 7, 16, 1000])
@pytest.mark.parametrize("before,after,need", [(7, 7, 7), (12, 11, 24), (0, 0, 1), (2, 0, 3)])
def test_rolling_in_blocks_matches_brute_force(spark, block, before, after, need):
    values = [None if i % 9 == 4 else math.sin(i) * 10 for i in range(40)]
    df = days(spark, values).repartition(5)
    got = windows.rolling_mean(df, {"v": "m"}, before, after, need, block_rows=block).orderBy("time").collect()
    assert len(got) == 40
    for i, r in enumerate(got):
        near = [v for v in values[max(0, i - before) : i + after + 1] if v is not None]
        want = sum(near) / len(near) if len(near) >= need else None
        assert (r.m is None) == (want is None)
        assert want is None or r.m == pytest.approx(want)


def test_even_window_is_twelve_before_eleven_after(spark):
    df = days(spark, [float(i) for i in range(40)]).withColumnRenamed("time", TIME)
    got = windows.rolling24(df, {"v": "m"}).orderBy(TIME).collect()
    assert [i for i, r in enumerate(got) if r.m is not None] == list(range(12, 29))
    assert got[12].m == 11.5


def test_short_series_keeps_its_ends(spark):
    got = windows.rolling15(days(spark, [float(i) for i in range(8)]), "v", "m").orderBy("time").collect()
    assert got[0].m == 3.5 and got[7].m == 3.5


def test_ordinals_are_dense_across_gaps(spark):
    rows = [(dt.date(2020, 11, 30),), (dt.date(2021, 1, 1),), (dt.date(2021, 1, 2),), (dt.date(2024, 6, 1),)]
    df = spark.createDataFrame(rows, "time date").repartition(3)
    assert [r.ordinal for r in windows.with_ordinal(df, "time").orderBy("time").collect()] == [0, 1, 2, 3]


def test_anomaly_is_zero_on_monthly_average(spark):
    df = days(spark, [float(i % 7) for i in range(70)], name="t2m_c")
    anom = windows.anomaly(df)
    got = anom.groupBy(F.month("time")).agg(F.sum("t2m_c_anom").alias("s")).collect()
    assert len(got) == 3 and all(abs(r.s) < 1e-9 for r in got)
    per_cell = df.crossJoin(spark.range(2).select(F.col("id").alias("cell"))).withColumn(
        "t2m_c", F.col("t2m_c") * (F.col("cell") + 1)
    )
    got = windows.anomaly(per_cell, ["t2m_c"], partition=["cell"]).where("cell = 0").drop("cell")
    assert got.exceptAll(anom).isEmpty() and got.count() == 70


def test_month_ticks_restart_each_month(spark):
    rows = [(dt.date(2021, 1, 30),), (dt.date(2021, 1, 31),), (dt.date(2021, 3, 1),)]
    got = windows.month_ticks(spark.createDataFrame(rows, "date date")).orderBy("date").collect()
    assert [(r.x, r.month_start, r.tick_label) for r in got] == [
        (0, True, "Jan 2021"), (1, False, None), (2, True, "Mar 2021")
    ]


def test_month_against_mean_of_days_not_of_months(spark):
    df = days(spark, [1.0] * 31 + [4.0], name="t")
    got = {r.month: r.t_vs_annual for r in windows.month_vs_annual(df, "t").collect()}
    annual = (31 + 4) / 32
    assert got == {1: pytest.approx(1 - annual), 2: pytest.approx(4 - annual)}


def test_minmax_of_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "month int, a double, b double")
    got = windows.minmax_scale(df, ["a", "b"]).orderBy("month").collect()
    assert [r.a for r in got] == [0.0, 0.0] and got[1].b == pytest.approx(1.0)


def test_sign_bands(spark):
    got = windows.sign_bands(spark.createDataFrame([(0.0,), (-1.0,), (2.0,), (None,)], "a double"), "a").collect()
    assert [(r.warm, r.cool) for r in got] == [(0.0, None), (None, -1.0), (2.0, None), (None, None)]


def test_radiation_matrix_scales_each_row(spark):
    rows = [(m, float(m), 10.0) for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, "month int, ssr double, ttr double")
    got = {r.variable: r for r in figures.radiation_matrix(df, ["ssr", "ttr"]).collect()}
    assert [got["ssr"][m] for m in ("Jan", "Feb", "Mar", "Apr")] == [0.0, pytest.approx(0.5), pytest.approx(1.0), None]
    assert got["ttr"]["Feb"] == 0.0


# --- Summaries --------------------------------------------------------------------


def test_first_month_wins_ties(spark):
    df = spark.createDataFrame([(3, 9.0), (7, 9.0), (1, 2.0), (12, None)], "month int, v double")
    r = one(summary.argmax_month(df, "v"))
    assert (r.month, r.month_abbr) == (3, "Mar")


def test_correlation_without_variance_is_null(spark):
    schema = "t2m_c_mean double, sp_hpa_mean double"
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], schema)
    assert one(summary.temp_pressure_corr(flat)).temp_pressure is None
    gaps = spark.createDataFrame([(1.0, 4.0), (2.0, 3.0), (3.0, 2.0), (90.0, None)], schema)
    assert one(summary.temp_pressure_corr(gaps)).temp_pressure == pytest.approx(-1.0)


def test_both_seasons_are_always_listed(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "month int, t2m_c_mean double, sp_hpa_mean double, tp_mm_total double")
    got = summary.season_compare(df).collect()
    assert [(r.season, r.day_count, r.t2m_c_mean) for r in got] == [
        ("Monsoon sampled days", 0, None), ("Other sampled days", 1, 2.0)
    ]


def test_grid_shape_counts(spark):
    t = ts("2024-01-01T00:00:00")
    df = grid(spark, [(t, y, x, 0.0) for y in (1.0, 2.0) for x in (3.0, 4.0, 5.0)])
    for approximate in (False, True):
        r = one(summary.grid_shape(df, approximate))
        assert (r.rows, r.time_steps, r.latitudes, r.longitudes) == (6, 1, 2, 3)
        assert (r.latitude_min, r.longitude_max, r.valid_time_min) == (1.0, 5.0, t)


# --- Comparing tables ---------------------------------------------------------------


def test_tolerance_of_near_equal_columns(spark):
    ref = days(spark, [1.0, 1.0, None, None])
    cand = days(spark, [1.0011, 1.0, None, 1.0])
    r = one(compare.compare_tables(ref, cand, label="t"))
    assert (r.rows_compared, r.pass_rate, r.passed) == (4, 0.75, False)
    assert r.mae == pytest.approx(0.00055) and r.max_rel == pytest.approx(0.0011)
    assert r.rmse == pytest.approx(0.0011 / math.sqrt(2))
    r = one(compare.compare_tables(days(spark, [1.0]), days(spark, [1.0021])))
    assert r.passed is False
    r = one(compare.compare_tables(days(spark, [0.0]), days(spark, [1e-4])))
    assert r.passed is True and r.max_rel == pytest.approx(1e8)


def test_compare_uses_common_days_and_numeric_columns(spark):
    a = days(spark, [1.0, 2.0, 3.0]).withColumn("label", F.lit("x"))
    b = days(spark, [2.0, 3.5], start="2024-01-02").withColumn("label", F.lit("y")).withColumn("w", F.lit(1.0))
    r = one(compare.consistency(a, b))
    assert (r.metric, r.rows_compared, r.max_abs_diff, r.mean_abs_diff) == ("v", 2, 0.5, 0.25)
    with pytest.raises(ValueError):
        compare.consistency(a, b, ["label"])
    with pytest.raises(ValueError):
        compare.compare_tables(a.select("time", "label"), b)


def test_rollup_and_runs(spark):
    rows = [("b", True, 1.0, 0.1, 2.0), ("a", False, 0.5, 0.3, 1.0), ("a", True, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "table string, passed boolean, pass_rate double, max_abs double, max_rel double")
    r = one(compare.validation_rollup(df))
    assert (r.checks, r.tables, r.all_passed, r.min_pass_rate, r.max_abs_overall, r.max_rel_overall) == (
        3, ["a", "b"], False, 0.5, 0.3, 2.0
    )
    assert [x[0] for x in compare.distinct_sorted(df, "table").collect()] == ["a", "b"]
    runs = spark.createDataFrame([("poor", 8.0, 1.5), ("good", 3.0, 1.25)], "name string, elapsed_s double, value double")
    r = one(compare.run_delta(runs, "poor", "good", "value"))
    assert (r.speedup, r.value_abs_diff) == (2.667, 0.25)
    r = one(compare.best_worst(runs))
    assert (r.best, r.worst) == ("good", "poor")


# --- Combining tables ----------------------------------------------------------------


def test_merge_fills_and_checks(spark):
    a = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5.0)], "k int, x double, y double")
    b = spark.createDataFrame([(1, 7.0), (3, 9.0)], "k int, y double")
    got = {r.k: (r.x, r.y) for r in align.merge_on_keys([a, b], ["k"]).collect()}
    assert got == {1: (1.0, 7.0), 2: (2.0, 5.0), 3: (None, 9.0)}
    assert [r.k for r in align.merge_on_keys([a, b], ["k"], "inner").collect()] == [1]
    assert {r.k for r in align.merge_on_keys([a, b], ["k"], "left").collect()} == {1, 2}
    kept = {r.k: r.y for r in align.merge_on_keys([a, b], ["k"], overlap="override").collect()}
    assert kept == {1: None, 2: 5.0, 3: None}
    clash = spark.createDataFrame([(2, 6.0)], "k int, y double")
    with pytest.raises(Exception, match="disagree"):
        align.merge_on_keys([a, clash], ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        align.merge_on_keys([a, b.union(b)], ["k"]).collect()


def test_common_keys_are_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert [r.k for r in align.common_keys(a, b, "k").collect()] == [1]


# --- Sources ---------------------------------------------------------------------------


def test_packed_grid_is_flattened_row_by_row(spark):
    packed = spark.createDataFrame(
        [(ts("2024-01-01T00:00:00"), [20.0, 10.0], [1.0, 2.0, 3.0], [0.0, 1.0, 2.0, 3.0, NAN, 5.0])],
        "valid_time timestamp_ntz, latitudes array<float>, longitudes array<float>, values array<float>",
    )
    got = [(r.latitude, r.longitude, r.t2m) for r in explode_grid(packed, "t2m").collect()]
    assert got == [(20.0, 1.0, 0.0), (20.0, 2.0, 1.0), (20.0, 3.0, 2.0), (10.0, 1.0, 3.0), (10.0, 2.0, None), (10.0, 3.0, 5.0)]


def test_packed_steps_lose_nothing_silently(spark):
    schema = "valid_time timestamp_ntz, latitudes array<float>, longitudes array<float>, values array<float>"
    step = ts("2024-01-01T00:00:00")
    empty = spark.createDataFrame([(step, [20.0, 10.0], [1.0], None)], schema)
    assert [(r.latitude, r.longitude, r.t2m) for r in explode_grid(empty, "t2m").collect()] == [(20.0, 1.0, None), (10.0, 1.0, None)]
    for row in (
        (step, [20.0], [1.0], [1.0, 2.0]), (step, [20.0, 10.0], [1.0], [1.0]), (step, None, [1.0], [1.0]), (step, None, [1.0], None),
    ):
        with pytest.raises(Exception, match="different size"):
            explode_grid(spark.createDataFrame([row], schema), "t2m").collect()


def test_a_repeated_order_is_an_error_in_rolling_means(spark):
    rows = [(ts("2024-01-01T00:00:00"), 1.0), (ts("2024-01-01T00:00:00"), 2.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, v double")
    with pytest.raises(Exception, match="more than once"):
        windows.rolling15(df, "v", "m").collect()


def test_hot_cell_is_rolled_in_blocks(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), c, float((h * 7 + c) % 11)) for c, n in ((0, 4000), (1, 30)) for h in range(n)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, cell int, v double")
    got = windows.rolling_mean(df, {"v": "m"}, 12, 11, 24, "time", partition=["cell"], block_rows=100)
    for cell, n in ((0, 4000), (1, 30)):
        v = [r[2] for r in rows if r[1] == cell]
        want = [sum(v[i - 12 : i + 12]) / 24 if i >= 12 and i + 12 <= n else None for i in range(n)]
        have = [r.m for r in got.where(F.col("cell") == cell).orderBy("time").collect()]
        assert have == [None if x is None else pytest.approx(x) for x in want]


def test_unpack_honours_fill(spark):
    df = spark.createDataFrame([(-5,), (100,), (None,)], "raw int")
    assert [r.v for r in df.select(units.unpack(F.col("raw"), 0.5, 10.0, -5).alias("v")).collect()] == [None, 60.0, None]


def test_scalar_coordinates_are_dropped(spark):
    df = grid(spark, [(ts("2024-01-01T00:00:00"), 0.0, 0.0, 1.0)]).withColumn("number", F.lit(0))
    assert "number" not in as_grid(df, ["t2m"]).columns
    with pytest.raises(ValueError, match="sp"):
        as_grid(df, ["sp"])


def test_guards(spark):
    df = days(spark, [1.0])
    assert guards.available(df, ["w", "v"]) == ["v"]
    with pytest.raises(ValueError, match="empty"):
        guards.require_nonempty(df.where("false"))
    with pytest.raises(ValueError, match="frac"):
        guards.require_columns(df, ["frac"])


def test_first_csv_column_is_the_key(spark, tmp_path):
    path = str(tmp_path / "t")
    df = days(spark, [1.23456, None]).withColumnRenamed("time", "valid_time")
    tables.write_table(df, path, sort="valid_time")
    got = tables.read_time_table(spark, path).orderBy("time").collect()
    assert got[0].asDict() == {"time": dt.date(2024, 1, 1), "v": 1.2346} and got[1].v is None
    tables.write_table(df.where("false"), path)
    with pytest.raises(ValueError, match="empty"):
        tables.read_time_table(spark, path)


# --- Relations between results ------------------------------------------------------------


def test_weighted_equals_plain_on_one_latitude(spark):
    t = ts("2024-01-01T00:00:00")
    df = grid(spark, [(t, 42.0, float(x), x * 1.7) for x in range(9)])
    a, b = one(spatial.weighted_spatial_mean(df, ["t2m"])).t2m, one(spatial.spatial_mean(df, ["t2m"])).t2m
    assert a == pytest.approx(b)


def test_two_regions_combine_to_their_union(spark):
    t = ts("2024-01-01T00:00:00")
    df = grid(spark, [(t, float(y), float(x), y * 3.0 + x) for y in range(10, 20) for x in range(4)])
    w = {y: math.cos(math.radians(y)) for y in range(10, 20)}
    south, north = (Region("r", n, s, 0.0, 9.0) for s, n in ((10.0, 14.0), (15.0, 19.0)))
    parts = [one(spatial.weighted_spatial_mean(select.in_region(df, r), ["t2m"])).t2m for r in (south, north)]
    weights = [sum(w[y] for y in range(10, 15)), sum(w[y] for y in range(15, 20))]
    whole = one(spatial.weighted_spatial_mean(df, ["t2m"])).t2m
    assert whole == pytest.approx(sum(p * v for p, v in zip(parts, weights)) / sum(weights))


def test_means_stay_two_level(spark):
    """With missing cells the mean of step means differs from the mean over all cells."""
    rows = [(ts("2021-01-01T00:00:00"), 1.0), (ts("2021-01-01T00:00:00"), 3.0), (ts("2021-01-01T04:00:00"), 8.0)]
    cells = [(t, 25.0, 80.0 + i, v + 273.15, 0.0, 0.0) for i, (t, v) in enumerate(rows)]
    df = grid(spark, cells, "valid_time timestamp_ntz, latitude double, longitude double, t2m double, sp double, tp double")
    assert one(temporal.sampled_daily(spatial.sampled_series(df))).t2m_c_mean == pytest.approx(5.0)
