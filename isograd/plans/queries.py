"""Registered queries: every operator on grids derived from the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd import catalog
from isograd.catalog import COORDS, LATITUDE, LONGITUDE, REGIONS, TIME
from isograd.functions import units
from isograd.functions.calendar import epoch_to_ts, with_calendar
from isograd.functions.columns import round_columns
from isograd.operators import align, cells, compare, exact, figures, layout, packed, partials, regions, select, spatial, summary, temporal, windows
from isograd.plans import testgrids as grids
from isograd.plans.regional import region_and_global_means, regional_daily, sampled_regional_daily
from isograd.session import shared_folder
from isograd.sources import cells as stored_cells
from isograd.sources import grid as source
from isograd.sources import blocks, conflicts, documents, guards, refresh, tables

SOUTH_ASIA, CENTRAL_INDIA = REGIONS["south_asia"], REGIONS["central_india"]
COMPARED = ("t2m_c", "tcc", "ssr", "str_nlw", "net_rad")
Query = Callable[[SparkSession, str], DataFrame]


def report(df: DataFrame, digits: int = 8) -> DataFrame:
    """Doubles rounded, calendar days as midnight timestamps like every other time key."""
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return round_columns(df.withColumns({d: F.col(d).cast("timestamp_ntz") for d in days}), digits)


# --- Shared inputs -----------------------------------------------------------


def series(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.regional_series(
        select.in_region(grids.instant(spark, sf), SOUTH_ASIA), select.in_region(grids.accum(spark, sf), SOUTH_ASIA)
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return regional_daily(grids.instant(spark, sf), grids.accum(spark, sf), with_heat=False)


def daily_heat_too(spark: SparkSession, sf: str) -> DataFrame:
    return regional_daily(grids.instant(spark, sf), grids.accum(spark, sf), with_heat=True)


def plain_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table from unweighted means, a second result to compare with."""
    inst = select.in_region(grids.instant(spark, sf), SOUTH_ASIA)
    acc = select.in_region(grids.accum(spark, sf), SOUTH_ASIA)
    cells = align.stack([spatial.instant_columns(inst), spatial.accum_columns(acc)])
    return temporal.daily_metrics(spatial.spatial_mean(cells, temporal.SERIES_MEANS))


def sampled_days(spark: SparkSession, sf: str) -> DataFrame:
    return sampled_regional_daily(grids.sampled(spark, sf))


def month_series(df_instant: DataFrame, df_accum: DataFrame) -> DataFrame:
    """Plain global step means of all seven stored variables."""
    variables = ("t2m", "tcc", "ssr", "str", "tisr", "tsr", "ttr")
    return spatial.spatial_mean(align.stack([df_instant, df_accum]), variables)


def calendar_months(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.calendar_month_agg(month_series(grids.instant(spark, sf), grids.accum(spark, sf)))


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/isograd/{name}-{uuid.uuid4().hex}"


# --- Sources -----------------------------------------------------------------


def grid_scan(spark, sf):
    return report(source.as_grid(grids.instant(spark, sf), ["t2m"]))


def _stored_parts(spark, parts: dict[str, DataFrame], name: str) -> list[str]:
    root = scratch(spark, name)
    for part, grid in parts.items():
        grid.write.parquet(f"{root}/{part}")
    return [f"{root}/{part}" for part in parts]


def multi_open(spark, sf):
    parts = {
        "some": grids.instant(spark, sf).select(*COORDS, "t2m"),
        "gaps": grids.instant_with_gaps(spark, sf),
        "accum": grids.accum(spark, sf).select(*COORDS, "ssr"),
    }
    return report(source.read_grid_multi(spark, _stored_parts(spark, parts, "parts")))


def open_conflicts(spark, sf):
    """Two files that differ by half a degree under thick cloud, and a third that agrees with the first."""
    gaps, thick = grids.instant_with_gaps(spark, sf), F.col("tcc") > 0.9
    parts = {
        "a": grids.instant(spark, sf),
        "b": gaps.withColumn("t2m", F.when(thick, F.col("t2m") + 0.5).otherwise(F.col("t2m"))),
        "c": grids.instant(spark, sf).select(*COORDS, "tcc"),
    }
    _, found = conflicts.open_conflicts(spark, _stored_parts(spark, parts, "conflicts"))
    part = {c: F.regexp_extract(c, "/([^/]+)/[^/]+$", 1) for c in ("low_file", "high_file")}
    return report(found.withColumns(part))


def open_agreeing(spark, sf):
    """The cells on which the same files agree."""
    gaps, thick = grids.instant_with_gaps(spark, sf), F.col("tcc") > 0.9
    parts = {"a": grids.instant(spark, sf), "b": gaps.withColumn("t2m", F.when(thick, F.col("t2m") + 0.5).otherwise(F.col("t2m")))}
    agreed, _ = conflicts.open_conflicts(spark, _stored_parts(spark, parts, "agreeing"))
    return report(agreed)


def guarded_open(spark, sf):
    """Of all catalogued variables those that a grid has, in their shown units; empty grids and missing columns are errors."""
    grid = grids.accum(spark, sf)
    names = guards.available(grid, catalog.VARIABLES)
    checked = guards.require_nonempty(guards.require_columns(grid, [*COORDS, *names], "grid"), "grid")
    return report(catalog.convert(source.as_grid(checked, names)))


def summary_diff(spark, sf):
    """Two written summaries, of all years and of the first, compared path by path."""
    days = sampled_days(spark, sf)
    whole = summary.sampled_summary(days).withColumn("range_c", F.array("temperature_summary.min_t2m_c", "temperature_summary.max_t2m_c"))
    paths = [scratch(spark, f"summary-{i}") for i in "ab"]
    tables.write_summary(whole, paths[0])
    tables.write_summary(summary.sampled_summary(select.first_year(days)).drop("correlations"), paths[1])
    a, b = (documents.read_document(spark, p) for p in paths)
    return report(documents.document_diff(a, b, atol=1e-6).select("path", "first", "second", "difference", "status"))


def ordered_table(spark, sf):
    """A table written in an order and read back: whether each row follows the one before it in its file."""
    path = scratch(spark, "ordered")
    tables.write_table(daily(spark, sf).select("time", "t2m_c"), path, digits=8, format="parquet", sort="t2m_c")
    placed = spark.read.parquet(path).withColumns({"file": F.input_file_name(), "row": F.monotonically_increasing_id()})
    before = F.lag("t2m_c").over(Window.partitionBy("file").orderBy("row"))
    return report(placed.select("time", "t2m_c", (before.isNull() | (before <= F.col("t2m_c"))).alias("follows")))


def distinct_months(spark, sf):
    months = grids.instant(spark, sf).select(F.trunc(F.col(TIME), "month").alias("month"))
    return report(compare.distinct_sorted(months, "month"))


def unpack_scale_offset(spark, sf):
    value = units.unpack(F.col("raw"), grids.PACK_SCALE, grids.PACK_OFFSET, grids.PACK_FILL)
    return report(grids.encoded(spark, sf).select(*COORDS, value.alias("t2m")))


def explode_grid(spark, sf):
    return report(source.explode_grid(grids.packed(spark, sf), "t2m"))


def epoch_decode(spark, sf):
    return grids.raw_epoch(spark, sf).select("event_id", epoch_to_ts(F.col("epoch_s")).alias(TIME))


def csv_roundtrip(spark, sf):
    path = scratch(spark, "daily-csv")
    tables.write_table(daily(spark, sf), path, digits=8)
    return report(tables.read_time_table(spark, path))


def stored_grid(spark, sf):
    path = scratch(spark, "grid")
    source.write_grid(grids.instant(spark, sf), path)
    box = select.in_region(source.read_grid(spark, path, ["t2m"]), SOUTH_ASIA)
    return report(select.time_between(box, "2024-01-03 00:00:00", "2024-01-20 12:00:00").drop("year", "month"))


def kept_daily(spark, sf):
    """The kept table of the full span, with that of a sample beside it under other parameters."""
    path, inputs = scratch(spark, "kept"), {"instant": f"{sf}/events", "accum": f"{sf}/orders"}

    def keep(days: int) -> tables.Kept:
        def compute():
            return {"daily": regional_daily(grids.instant(spark, sf), grids.accum(spark, sf), days=days, with_heat=False)}

        return tables.kept_tables(spark, path, {**inputs, "region": SOUTH_ASIA, "days": days}, compute)

    keep(2)
    keep(0)
    return report(keep(0).tables["daily"])


def _refreshed(spark, path: str, out: str) -> refresh.Refreshed:
    def days(cells: DataFrame) -> DataFrame:
        steps = spatial.weighted_spatial_mean(spatial.instant_columns(select.in_region(cells, SOUTH_ASIA)), ["t2m_c", "tcc"])
        return partials.daily_partials(steps, ["t2m_c", "tcc"])

    return refresh.refresh_months(spark, path, out, days, {"analysis": "days", "region": SOUTH_ASIA})


def kept_refresh(spark, sf):
    """Days kept from a grid of which one month was wrong and later ones were missing, after both are mended."""
    path, out = scratch(spark, "months"), scratch(spark, "days")
    cells, t = grids.instant(spark, sf), F.col(TIME)
    february, later = (F.year(t) == 2024) & (F.month(t) == 2), t >= F.lit("2024-04-01").cast("timestamp_ntz")
    wrong = cells.where(~later).withColumn("t2m", F.when(february, F.col("t2m") + 1.0).otherwise(F.col("t2m")))
    source.write_grid(wrong, path)
    _refreshed(spark, path, out)
    source.write_grid(cells.where(february | later), path, replace_months=True)
    return report(partials.merge_partials(_refreshed(spark, path, out).partials, ["t2m_c", "tcc"]))


# --- Filters, units, calendar ------------------------------------------------


def region_filter(spark, sf):
    return report(select.in_region(grids.instant(spark, sf), SOUTH_ASIA))


def time_window(spark, sf):
    return report(select.time_window(grids.instant(spark, sf), 5))


def unit_convert(spark, sf):
    s = catalog.convert(grids.sampled(spark, sf))
    a = grids.accum(spark, sf).select(
        *COORDS,
        units.accum_to_flux(F.col("ssr")).alias("ssr_6h"),
        units.accum_to_flux(F.col("ssr"), units.STEP_SECONDS_1H).alias("ssr_1h"),
    )
    return report(align.stack([s, a]))


def calendar_keys(spark, sf):
    return report(with_calendar(grids.sampled(spark, sf).select(*COORDS)))


def first_year(spark, sf):
    return report(select.first_year(sampled_days(spark, sf)))


def grid_preview(spark, sf):
    return report(select.preview(grids.instant(spark, sf), 5))


# --- Combining tables --------------------------------------------------------


def merge_steps_outer(spark, sf):
    return report(align.merge_steps(grids.instant(spark, sf), grids.accum(spark, sf), "full"))


def merge_steps_inner(spark, sf):
    return report(align.merge_steps(grids.instant(spark, sf), grids.accum(spark, sf), "inner"))


def merge_steps_indexed(spark, sf):
    """Float32 and double files of a tenth-degree grid, stored by position and merged without a shuffle."""
    parts = []
    for name, grid in (("instant", grids.fine_instant(spark, sf)), ("accum", grids.fine_accum(spark, sf))):
        path = scratch(spark, f"cells-{name}")
        stored_cells.write_cells(grid, grids.FINE_AXES, path, 8)
        parts.append(stored_cells.read_cells(spark, path))
    merged = cells.merge_indexed(parts[0].cells, parts[1].cells, checked=True)
    return report(cells.unsnap(merged, parts[0].axes))


def merge_packed(spark, sf):
    instant = grids.packed_by_cell(grids.instant(spark, sf), ["t2m", "tcc"])
    accum = grids.packed_by_cell(grids.accum(spark, sf), ["ssr", "str", "tisr", "tsr", "ttr"])
    both = packed.merge_packed(instant, accum)
    return report(packed.explode_packed(both, {c: packed.Packed(c) for c in ("t2m", "tcc", "ssr", "str", "tisr", "tsr", "ttr")}))


def pack_grid(spark, sf):
    """A grid with absent cells, packed in blocks of two rows and laid out again."""
    held = packed.pack_grid(grids.sparse_instant(spark, sf), ["t2m", "tcc"], AXES, 5, 5, block_rows=2)
    return report(packed.explode_packed(held, {c: packed.Packed(c) for c in ("t2m", "tcc")}))


def daily_with_heat(spark, sf):
    inst = select.in_region(grids.instant(spark, sf), SOUTH_ASIA)
    heat = temporal.daily_heat(spatial.area_fraction(spatial.instant_columns(inst)))
    return report(align.with_heat(daily(spark, sf), heat))


def common_keys(spark, sf):
    return report(align.common_keys(grids.instant(spark, sf), grids.accum(spark, sf), TIME))


def month_spine(spark, sf):
    return report(temporal.month_spine(temporal.monthly_climatology(daily(spark, sf))))


def daily_gap_filled(spark, sf):
    kept = sampled_days(spark, sf).drop("month", "year")
    return report(temporal.fill_calendar(kept, "date", zero=["tp_mm_total"]))


# --- Space -------------------------------------------------------------------


def spatial_mean(spark, sf):
    return report(spatial.spatial_mean(grids.instant_with_gaps(spark, sf), ["t2m", "tcc"]))


def weighted_mean(spark, sf):
    inst = select.in_region(grids.instant_with_gaps(spark, sf), SOUTH_ASIA)
    return report(spatial.weighted_spatial_mean(spatial.instant_columns(inst), ["t2m_c", "tcc"]))


PACKED_INSTANT = {
    "t2m_c": packed.Packed("t2m", offset=-units.KELVIN_OFFSET, fill=grids.PACK_FILL),
    "tcc": packed.Packed("tcc", fill=grids.PACK_FILL),
}


def packed_means(spark, sf):
    held = grids.packed_by_cell(grids.instant_with_gaps(spark, sf), ["t2m", "tcc"], fill=float(grids.PACK_FILL))
    return report(packed.packed_means(held, PACKED_INSTANT, SOUTH_ASIA))


def packed_heat(spark, sf):
    """Plain means and shares of hot cells of blocks of rows, whose sums are added for each step."""
    held = packed.pack_grid(grids.instant_with_gaps(spark, sf), ["t2m", "tcc"], AXES, 5, 5, block_rows=2)
    hot = {name: ("t2m_c", limit) for name, limit in spatial.HEAT_THRESHOLDS.items()}
    return report(packed.packed_means(held, PACKED_INSTANT, SOUTH_ASIA, weighted=False, hot=hot))


BOXES = {
    "south_asia": SOUTH_ASIA,
    "central_india": CENTRAL_INDIA,
    "north_west": catalog.Region("North-west", north=50.0, south=30.0, west=60.0, east=80.0),
    "globe": catalog.Region("Globe", north=90.0, south=-90.0, west=0.0, east=360.0),
}


def regions_daily(spark, sf):
    """Days of four regions, three of which overlap the first, from one scan."""
    gaps = grids.instant_with_gaps(spark, sf).withColumn("t2m_c", units.kelvin_to_c(F.col("t2m")))
    hot = {name: ("t2m_c", limit) for name, limit in spatial.HEAT_THRESHOLDS.items()}
    steps = regions.regions_series(gaps, AXES, BOXES, ["t2m_c", "tcc"], hot)
    return report(regions.regions_daily(steps, ["t2m_c", "tcc"], list(hot)))


def heat_fraction(spark, sf):
    inst = select.in_region(grids.instant_with_gaps(spark, sf), SOUTH_ASIA)
    return report(spatial.area_fraction(spatial.instant_columns(inst)))


def heat_fraction_present(spark, sf):
    inst = select.in_region(grids.instant_with_gaps(spark, sf), SOUTH_ASIA)
    return report(spatial.area_fraction(spatial.instant_columns(inst), denominator="present"))


def region_vs_global(spark, sf):
    cells = grids.instant_with_gaps(spark, sf)
    return report(spatial.region_vs_global(cells, ["t2m", "tcc"], SOUTH_ASIA))


def both_steps_means(spark, sf):
    both = [(grids.instant_with_gaps(spark, sf), ["t2m", "tcc"]), (grids.accum(spark, sf), ["tsr", "ttr"])]
    return report(region_and_global_means(both, SOUTH_ASIA))


def regional_step_series(spark, sf):
    return report(series(spark, sf))


def grid_shape(spark, sf):
    return report(summary.grid_shape(grids.sampled(spark, sf)))


# --- Days and months ---------------------------------------------------------


def daily_metrics(spark, sf):
    return report(daily(spark, sf))


def daily_metrics_gaps(spark, sf):
    return report(regional_daily(grids.instant_with_gaps(spark, sf), grids.accum(spark, sf), with_heat=True))


def daily_heat(spark, sf):
    inst = select.in_region(grids.instant(spark, sf), SOUTH_ASIA)
    return report(temporal.daily_heat(spatial.area_fraction(spatial.instant_columns(inst))))


def daily_precip(spark, sf):
    return report(temporal.daily_precip(spatial.sampled_series(grids.sampled(spark, sf))))


def central_daily(spark, sf):
    return report(sampled_days(spark, sf))


def monthly_climatology(spark, sf):
    return report(temporal.monthly_climatology(daily_heat_too(spark, sf)))


def central_climatology(spark, sf):
    return report(temporal.monthly_climatology(sampled_days(spark, sf), "date"))


def calendar_month(spark, sf):
    return report(calendar_months(spark, sf))


def calendar_month_sum(spark, sf):
    box = select.in_region(grids.sampled(spark, sf), CENTRAL_INDIA)
    steps = spatial.spatial_mean(box, ["t2m", "sp", "tp"])
    return report(temporal.calendar_month_agg(steps))


def season_compare(spark, sf):
    return report(summary.season_compare(sampled_days(spark, sf)))


def temp_pressure_corr(spark, sf):
    # temperature of the box against pressure of the whole grid, so that it is not exactly 1
    box = sampled_days(spark, sf).select("date", "t2m_c_mean")
    whole = temporal.sampled_daily(spatial.sampled_series(grids.sampled(spark, sf))).select("date", "sp_hpa_mean")
    return report(summary.temp_pressure_corr(align.merge_on_keys([box, whole], ["date"], "inner")))


def argmax_month(spark, sf):
    return report(summary.argmax_month(temporal.monthly_climatology(daily(spark, sf)), "ssr"))


def table_stats(spark, sf):
    return report(summary.table_stats(sampled_days(spark, sf), "tp_mm_total"))


def region_summary(spark, sf):
    return report(summary.flatten(summary.region_summary(daily_heat_too(spark, sf), rounded=False)))


def sampled_summary(spark, sf):
    return report(summary.flatten(summary.sampled_summary(sampled_days(spark, sf))))


# --- Windows -----------------------------------------------------------------


def daily_anomaly(spark, sf):
    return report(windows.anomaly(daily(spark, sf)))


def cell_anomaly(spark, sf):
    cells = grids.instant(spark, sf).select(*COORDS, "t2m")
    return report(windows.anomaly(cells, ["t2m"], TIME, partition=[LATITUDE, LONGITUDE]))


def rolling15(spark, sf):
    return report(windows.rolling15(daily(spark, sf).select("time", "t2m_c"), "t2m_c", "t2m_c_rolling15"))


def rolling24(spark, sf):
    steps = spatial.region_vs_global(grids.instant(spark, sf), ["t2m"], SOUTH_ASIA)
    celsius = steps.select(
        TIME, *[units.kelvin_to_c(F.col(f"t2m_{part}")).alias(f"t2m_c_{part}") for part in ("global", "region")]
    )
    names = ("t2m_c_global", "t2m_c_region")
    return report(windows.rolling24(celsius, {c: c + "_rolling24" for c in names}))


def cell_rolling(spark, sf):
    cells = grids.instant(spark, sf).select(*COORDS, "t2m")
    return report(
        windows.rolling_mean(cells, {"t2m": "t2m_rolling"}, 12, 11, 24, TIME, partition=[LATITUDE, LONGITUDE])
    )


def month_ticks(spark, sf):
    ticks = windows.month_ticks(select.first_year(sampled_days(spark, sf)))
    return report(ticks.select("date", "x", "month_start", "tick_label", "t2m_c_mean", "tp_mm_total"))


def month_vs_annual(spark, sf):
    return report(windows.month_vs_annual(daily(spark, sf), "t2m_c"))


def minmax_scale(spark, sf):
    monthly = temporal.monthly_climatology(sampled_days(spark, sf), "date")
    return report(windows.minmax_scale(monthly, ["t2m_c_mean", "sp_hpa_mean", "tp_mm_total"]))


# --- Figure tables -----------------------------------------------------------


def annual_cycle(spark, sf):
    return report(figures.annual_cycle(daily_heat_too(spark, sf)))


def monthly_energy(spark, sf):
    return report(figures.monthly_energy(daily(spark, sf)))


def anomaly_relations(spark, sf):
    return report(figures.anomaly_relations(windows.anomaly(daily(spark, sf))))


def anomaly_sign_bands(spark, sf):
    return report(figures.anomaly_series(windows.anomaly(daily(spark, sf))))


def monthly_anomaly(spark, sf):
    return report(figures.monthly_anomaly(windows.anomaly(daily(spark, sf))), 6)


def radiation_heatmap(spark, sf):
    steps = spatial.spatial_mean(grids.accum(spark, sf), figures.RADIATION)
    return report(figures.radiation_matrix(temporal.calendar_month_agg(steps, with_units=False)))


# --- Comparing results -------------------------------------------------------


def paired_on_time(spark, sf):
    return report(align.pair_on_time(plain_daily(spark, sf), daily(spark, sf), ["t2m_c", "tcc"]))


def compared_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days from plain (``_a``) and weighted (``_b``) means side by side; heat without and with gaps.

    Each source is scanned and reduced once, however many results are compared.
    """
    weight = spatial.latitude_weight()
    inst = select.in_region(grids.instant_twice(spark, sf), SOUTH_ASIA)
    inst = inst.select(TIME, weight.alias("w"), units.kelvin_to_c(F.col("t2m")).alias("t2m_c"), units.kelvin_to_c(F.col("t2m_gaps")).alias("gaps"), "tcc")
    acc = spatial.accum_columns(select.in_region(grids.accum(spark, sf), SOUTH_ASIA)).withColumn("w", weight)

    def means(columns) -> list:
        plain = [F.avg(c).alias(f"{c}_a") for c in columns]
        return plain + [spatial.weighted_mean(F.col(c), F.col("w")).alias(f"{c}_b") for c in columns]

    heat = [
        F.avg(units.heat_flag(F.col(c), limit)).alias(f"{name}_{side}") for name, limit in spatial.HEAT_THRESHOLDS.items() for side, c in (("a", "t2m_c"), ("b", "gaps"))
    ]
    steps = align.merge_on_keys(
        [inst.groupBy(TIME).agg(*means(("t2m_c", "tcc")), *heat), acc.groupBy(TIME).agg(*means(("ssr", "str_nlw", "tisr", "tsr", "ttr")))], [TIME]
    )
    return temporal.daily_metrics(steps, with_heat=True, suffixes=("_a", "_b"))


def consistency_daily(spark, sf):
    return report(compare.difference_report(compare.side_by_side(compared_days(spark, sf), COMPARED, "metric")))


def consistency_anomaly(spark, sf):
    both = windows.anomaly(compared_days(spark, sf), [f"{c}_{side}" for c in COMPARED for side in "ab"])
    pairs = compare.side_by_side(both, COMPARED, "metric", "_anom")
    return report(compare.difference_report(pairs.withColumn("metric", F.concat("metric", F.lit("_anom")))))


def _validation(spark, sf):
    """Both checks from the same days; heat is compared on days that have temperatures."""
    checks = (("daily", temporal.DAILY_METRICS, 0.5, 1e-2), ("heat", temporal.HEAT_COLUMNS, 0.02, 1e-3))
    labels = {c: {"table": name, "atol": atol, "rtol": rtol} for name, columns, atol, rtol in checks for c in columns}
    rows = [F.struct(F.col("time"), F.col("t2m_c_a").isNotNull().alias("warm"), *[F.lit(v).alias(k) for k, v in told.items()],
                     F.lit(c).alias("column"), F.col(f"{c}_a").alias("a"), F.col(f"{c}_b").alias("b")) for c, told in labels.items()]
    pairs = compared_days(spark, sf).select(F.inline(F.array(*rows)))
    return pairs.where((F.col("table") == "daily") | F.col("warm"))


def validation_metrics(spark, sf):
    return report(compare.tolerance_report(_validation(spark, sf)))


def validation_rollup(spark, sf):
    rolled = compare.validation_rollup(compare.tolerance_report(_validation(spark, sf)))
    return report(rolled.withColumn("tables", F.array_join("tables", ",")))


def melted_daily(spark, sf):
    return report(compare.melt(daily(spark, sf), ["time"], list(COMPARED)))


# --- Layouts -----------------------------------------------------------------

AXES = grids.DENSE_AXES
LAYOUTS = {
    "time_first": lambda df: layout.tile_time(df, AXES, 24),
    "balanced": lambda df: layout.tile_blocks(df, AXES, 120, 2, 2),
    "space_first": lambda df: layout.tile_space(df, AXES, 2, 2),
}


def _block_counts(df: DataFrame) -> DataFrame:
    blocks = [c for c in df.columns if c.startswith("block_")]
    return df.groupBy(*blocks).agg(F.count(F.lit(1)).alias("rows"), F.min(TIME).alias("first_time"))


def layout_time_first(spark, sf):
    return report(_block_counts(LAYOUTS["time_first"](grids.instant(spark, sf))))


def layout_balanced(spark, sf):
    return report(_block_counts(LAYOUTS["balanced"](grids.instant(spark, sf))))


def layout_space_first(spark, sf):
    return report(_block_counts(LAYOUTS["space_first"](grids.instant(spark, sf))))


def _months_of(df: DataFrame) -> DataFrame:
    return temporal.calendar_month_agg(spatial.spatial_mean(df, ["t2m", "tcc"])).drop("month", "month_abbr")


def layout_invariance(spark, sf):
    cells = grids.instant(spark, sf)
    return report(layout.layout_invariance(cells, LAYOUTS, _months_of, TIME).select("table", "column", "rows_compared", "pass_rate", "passed"))


def layout_stored(spark, sf):
    """Cells of three asked boxes and spans, two of which overlap, from a grid stored by blocks."""
    path = scratch(spark, "blocks")
    blocks.write_blocks(grids.instant(spark, sf), AXES, f"{path}/grid", kt=40, ky=2, kx=2)
    asked = blocks.store_asked(spark, ASKED_BOXES, f"{path}/asked")
    return report(blocks.read_asked(blocks.read_blocks(spark, f"{path}/grid"), asked))


#: name, first and last time, north, south, west, east
ASKED_BOXES = [
    ("early", datetime(2024, 1, 2), datetime(2024, 1, 8, 12), 40.0, 20.0, 70.0, 85.0),
    ("late", datetime(2024, 2, 1), datetime(2024, 3, 1), 35.0, 5.0, 65.0, 100.0),
    ("point", datetime(2024, 1, 5), datetime(2024, 1, 9), 30.0, 30.0, 80.0, 80.0),
]


def layout_exact(spark, sf):
    """Months of exact means, and whether all layouts give them to the last bit."""

    def months(df: DataFrame) -> DataFrame:
        steps = exact.exact_spatial_mean(df, ["t2m", "tcc"]).withColumn("month", F.last_day(F.col(TIME)))
        return exact.exact_means(exact.exact_sums(steps, {c: F.col(c) for c in ("t2m", "tcc")}, ["month"]), ["t2m", "tcc"], ["month"])

    return report(exact.same_under_layouts(grids.instant_with_gaps(spark, sf), LAYOUTS, months, "month"))


def layout_overlay(spark, sf):
    cells = grids.instant(spark, sf)
    results = {
        name: temporal.calendar_month_agg(spatial.spatial_mean(tile(cells), ["t2m"])) for name, tile in LAYOUTS.items()
    }
    return report(layout.layout_overlay(results, "t2m_C"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        grid_scan, multi_open, open_conflicts, open_agreeing, guarded_open, unpack_scale_offset, explode_grid, epoch_decode, csv_roundtrip, stored_grid, kept_daily, kept_refresh,
        summary_diff, ordered_table, distinct_months,
        region_filter, time_window, unit_convert, calendar_keys, first_year, grid_preview,
        merge_steps_outer, merge_steps_inner, merge_steps_indexed, merge_packed, pack_grid, daily_with_heat, common_keys, month_spine, daily_gap_filled,
        spatial_mean, weighted_mean, packed_means, packed_heat, heat_fraction, heat_fraction_present,
        regions_daily, region_vs_global, both_steps_means, regional_step_series, grid_shape,
        daily_metrics, daily_metrics_gaps, daily_heat, daily_precip, central_daily, monthly_climatology,
        central_climatology, calendar_month, calendar_month_sum, season_compare, temp_pressure_corr,
        argmax_month, table_stats, region_summary, sampled_summary,
        daily_anomaly, cell_anomaly, rolling15, rolling24, cell_rolling, month_ticks, month_vs_annual, minmax_scale,
        annual_cycle, monthly_energy, anomaly_relations, anomaly_sign_bands, monthly_anomaly, radiation_heatmap,
        paired_on_time, consistency_daily, consistency_anomaly, validation_metrics, validation_rollup, melted_daily,
        layout_time_first, layout_balanced, layout_space_first, layout_invariance, layout_overlay, layout_stored, layout_exact,
    )
}
