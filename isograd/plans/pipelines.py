"""End-to-end analyses: read stored grids, write result tables and summaries.

These functions run jobs.  The daily table and the shape of the grid are kept
first, and every later table is derived from what was kept.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.catalog import (
    ACCUM_VARIABLES,
    CONSISTENCY_COLUMNS,
    COORDS,
    DATASETS,
    GLOBAL_2024,
    INSTANT_VARIABLES,
    MONTH_BLOCKS,
    REGIONS,
    RUN_BLOCKS,
    STEP_BLOCKS,
    TIME,
    VALIDATION_TABLES,
    VARIABLES,
    Dataset,
    GridAxes,
    Region,
)
from isograd.functions import units
from isograd.operators import align, compare, figures, layout, select, spatial, summary, temporal, windows
from isograd.operators import cells as cells_by_position
from isograd.operators import regions as every_region
from isograd.operators.align import stack
from isograd.plans.regional import region_and_global_means, regional_daily, sampled_regional_daily
from isograd.sources.cells import read_cells, write_cells
from isograd.sources.conflicts import open_conflicts
from isograd.sources.documents import document_diff, read_document
from isograd.sources.grid import read_grid, read_grid_multi, write_grid
from isograd.sources.guards import available, require_columns, require_nonempty
from isograd.sources.refresh import refresh_months
from isograd.sources.tables import Kept, kept_tables, read_time_table, unreadable, write_summary, write_table

log = logging.getLogger(__name__)


def _with_region(df: DataFrame, dataset: str, region: Region) -> DataFrame:
    box = F.struct(*[F.lit(getattr(region, f)).alias(f) for f in ("name", "north", "south", "west", "east")])
    return df.select(F.lit(dataset).alias("dataset"), box.alias("region"), "*")


def _shape(facts: DataFrame, **names: str) -> DataFrame:
    """Shape facts as one struct, under the names the summary uses."""
    return facts.select(F.struct(*[F.col(c).alias(shown) for shown, c in names.items()]).alias("grid_shape"))


def region_year(
    spark: SparkSession,
    instant_path: str,
    accum_path: str,
    out: str,
    region: Region | None = None,
    dataset: Dataset = DATASETS["south_asia_2024"],
    days: int = 0,
    step_seconds: int = units.STEP_SECONDS_6H,
    recompute: bool = False,
    tile: layout.Layout | None = None,
) -> DataFrame:
    """Daily metrics, heat extremes, climatology, anomalies, figure tables and summary of a region.

    The daily table and the shape of the grid it came from, both of the region
    and the first ``days`` days only, are kept under all these parameters.
    """
    box = region or dataset.region

    def compute() -> dict[str, DataFrame]:
        instant = read_grid(spark, instant_path, dataset.instant)
        accum = read_grid(spark, accum_path, dataset.accum)
        cells = select.in_region(instant, box)
        require_nonempty(cells.select(TIME), f"region {box.name}")
        if days > 0:
            cells = select.time_window(cells, days, select.first_time(cells, select.in_region(accum, box)))
        if tile:
            instant, accum = tile(instant), tile(accum)
        daily = regional_daily(instant, accum, box, days, step_seconds, with_heat=True, gaps=True)
        return {"daily": daily, "grid_shape": summary.grid_shape(cells)}

    identity = {"analysis": "region-year", "region": box, "dataset": dataset, "days": max(days, 0), "step_seconds": step_seconds,
                "instant": instant_path, "accum": accum_path}
    kept = kept_tables(spark, f"{out}/kept", identity, compute, recompute)
    daily = kept.tables["daily"]
    require_columns(daily, temporal.HEAT_COLUMNS, "kept daily table")
    _write_region(daily, out)
    shape = _shape(kept.tables["grid_shape"], time_steps="time_steps", lat_points="latitudes", lon_points="longitudes")
    document = windows.with_scalar(summary.region_summary(daily), shape, "grid_shape")
    if days > 0:
        document = windows.with_scalar(document, _sample(daily, days), "sample")
    write_summary(_with_region(_with_source(document, kept), dataset.name, box), f"{out}/summary")
    return daily


def _write_region(daily: DataFrame, out: str) -> None:
    """The tables that follow from the daily table of a region-year."""
    metrics = daily.select("time", *temporal.DAILY_METRICS)
    anomaly = windows.anomaly(metrics)

    write_table(daily, f"{out}/daily", sort="time")
    write_table(daily.select("time", *temporal.HEAT_COLUMNS), f"{out}/heat", sort="time")
    write_table(temporal.monthly_climatology(metrics), f"{out}/monthly", sort="month")
    write_table(anomaly, f"{out}/anomaly", sort="time")
    write_table(figures.annual_cycle(daily), f"{out}/annual_cycle", sort="time")
    write_table(temporal.month_spine(figures.monthly_energy(daily)), f"{out}/monthly_energy", sort="month")
    write_table(figures.anomaly_series(anomaly), f"{out}/anomaly_series", sort="time")
    write_table(figures.anomaly_relations(anomaly), f"{out}/anomaly_relations", sort="time")
    write_table(figures.monthly_anomaly(anomaly), f"{out}/monthly_anomaly", digits=6, sort="month")


def region_year_refreshed(
    spark: SparkSession,
    instant_path: str,
    accum_path: str,
    out: str,
    region: Region | None = None,
    dataset: Dataset = DATASETS["south_asia_2024"],
    step_seconds: int = units.STEP_SECONDS_6H,
) -> DataFrame:
    """The tables of ``region_year`` for grids stored by month that go on growing or are corrected.

    The step series of the region is kept by month of the input.  Each call
    reduces only months of which a file is new, gone or changed, and derives
    days and all later tables from the kept series.  The summary names the
    months that were read.
    """
    box = region or dataset.region
    steps = {
        "instant": (instant_path, spatial.instant_series),
        "accum": (accum_path, lambda cells: spatial.accum_series(cells, step_seconds)),
    }
    series, read = [], []
    for name, (path, reduce_fn) in steps.items():

        def rows(cells: DataFrame, reduce_fn=reduce_fn) -> DataFrame:
            return reduce_fn(select.in_region(cells, box)).withColumns({"year": F.year(TIME), "month": F.month(TIME)})

        identity = {"analysis": "region-series", "step_type": name, "region": box, "step_seconds": step_seconds}
        found = refresh_months(spark, path, f"{out}/series/{name}", rows, identity)
        series.append(found.partials.drop("year", "month"))
        read.append(F.array(*[F.lit(f"{y}-{m:02d}") for y, m in found.computed]).cast("array<string>").alias(name))
    steps_kept = align.merge_on_keys(series, [TIME])
    require_nonempty(steps_kept, f"region {box.name}")
    write_table(temporal.fill_calendar(temporal.daily_metrics(steps_kept, with_heat=True)), f"{out}/daily_kept", digits=None, format="parquet")
    daily = spark.read.parquet(f"{out}/daily_kept")
    _write_region(daily, out)
    shape = steps_kept.agg(F.struct(F.count(F.lit(1)).alias("time_steps")).alias("grid_shape"))
    document = windows.with_scalar(summary.region_summary(daily), shape, "grid_shape").withColumn("months_read", F.struct(*read))
    write_summary(_with_region(document, dataset.name, box), f"{out}/summary")
    return daily


def all_regions(
    spark: SparkSession,
    instant_path: str,
    out: str,
    regions: Mapping[str, Region] = REGIONS,
    axes: GridAxes = GLOBAL_2024,
) -> DataFrame:
    """Daily temperature, cloud cover and heat extremes of every region, and their months, from one pass over the grid."""
    grid = read_grid(spark, instant_path, INSTANT_VARIABLES)
    cells = grid.select(*COORDS, units.kelvin_to_c(F.col("t2m")).alias("t2m_c"), "tcc")
    hot = {name: ("t2m_c", limit) for name, limit in spatial.HEAT_THRESHOLDS.items()}
    series = every_region.regions_series(cells, axes, regions, ["t2m_c", "tcc"], hot)
    every_region.regions_daily(series, ["t2m_c", "tcc"], list(hot)).write.mode("overwrite").partitionBy("region").parquet(f"{out}/daily")
    daily = spark.read.parquet(f"{out}/daily")
    names = [c for c in daily.columns if c not in ("region", "time")]
    monthly = daily.groupBy("region", F.month("time").alias("month")).agg(*[F.avg(c).alias(c) for c in names])
    write_table(monthly.orderBy("region", "month"), f"{out}/monthly")
    return daily


def merge_stored(
    spark: SparkSession, instant_path: str, accum_path: str, out: str, axes: GridAxes = GLOBAL_2024, buckets: int = 200, how: str = "full"
) -> DataFrame:
    """Both step types stored by cell, once, and merged without a shuffle.

    Cell tables already under ``out`` are used as they are.
    """
    held = []
    for name, path in (("instant", instant_path), ("accum", accum_path)):
        place = f"{out}/cells/{name}"
        try:
            held.append(read_cells(spark, place))
        except AnalysisException as problem:
            if not unreadable(problem):
                raise
            write_cells(read_grid(spark, path), axes, place, buckets)
            held.append(read_cells(spark, place))
    merged = cells_by_position.merge_indexed(held[0].cells, held[1].cells, how, checked=True)
    return cells_by_position.unsnap(merged, held[0].axes)


def report_conflicts(spark: SparkSession, paths: Sequence[str], out: str, variables: Sequence[str] | None = None) -> DataFrame:
    """Open grids as one: the agreeing cells, filed by month, and a table of the others with the files that disagree."""
    agreed, found = open_conflicts(spark, paths, variables)
    write_grid(agreed, f"{out}/grid", mode="overwrite")
    found.write.mode("overwrite").parquet(f"{out}/conflicts")
    return spark.read.parquet(f"{out}/conflicts")


def _sample(daily: DataFrame, days: int) -> DataFrame:
    """Rows, days asked for, and temperature of a sample run, as one struct."""
    t = F.col("t2m_c")
    return daily.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), F.lit(days).alias("sample_days"), F.round(F.avg(t), 4).alias("mean_c"),
            F.round(F.max(t), 4).alias("max_c"), F.round(F.min(t), 4).alias("min_c"),
        ).alias("sample")
    )


def _with_source(document: DataFrame, kept: Kept) -> DataFrame:
    """Which stored run the summary is of, and whether it was computed just now."""
    return document.withColumn("daily_table", F.struct(F.lit(kept.source).alias("source"), F.lit(kept.run).alias("run")))


def sampled_region(
    spark: SparkSession,
    instant_path: str,
    accum_path: str,
    out: str,
    region: Region | None = None,
    dataset: Dataset = DATASETS["central_india_sampled"],
    recompute: bool = False,
) -> DataFrame:
    """Daily metrics, seasonal cycle, season comparison, first-year timeline and summary of a sampled region."""
    box = region or dataset.region

    def compute() -> dict[str, DataFrame]:
        instant = select.in_region(read_grid(spark, instant_path, dataset.instant), box)
        accum = select.in_region(read_grid(spark, accum_path, dataset.accum), box)
        require_nonempty(instant.select(TIME), f"region {box.name}")
        return {"daily": sampled_regional_daily(instant, accum, box), "grid_shape": summary.grid_shape(instant)}

    identity = {"analysis": "sampled-region", "region": box, "dataset": dataset, "instant": instant_path, "accum": accum_path}
    kept = kept_tables(spark, f"{out}/kept", identity, compute, recompute)
    daily = kept.tables["daily"]
    write_table(daily, f"{out}/daily", digits=None, sort="date")
    monthly = temporal.monthly_climatology(daily, "date")
    write_table(temporal.month_spine(monthly), f"{out}/monthly", digits=None, sort="month")
    write_table(summary.season_compare(daily), f"{out}/season", digits=None)
    write_table(windows.month_ticks(select.first_year(daily)), f"{out}/first_year", digits=None, sort="date")

    shape = _shape(kept.tables["grid_shape"], rows="rows", time_steps="time_steps", latitude="latitudes", longitude="longitudes")
    document = windows.with_scalar(summary.sampled_summary(daily), shape, "grid_shape")
    write_summary(_with_region(_with_source(document, kept), dataset.name, box), f"{out}/summary")
    return daily


def _tiled(axes: GridAxes, steps: int | None, lats: int | None, lons: int | None) -> layout.Layout:
    if lats is None:
        return lambda df: layout.tile_time(df, axes, steps)
    return (lambda df: layout.tile_space(df, axes, lats, lons)) if steps is None else (lambda df: layout.tile_blocks(df, axes, steps, lats, lons))


def month_layouts(axes=GLOBAL_2024) -> dict[str, layout.Layout]:
    """The three layouts the monthly aggregation is run under."""
    return {name: _tiled(axes, *size) for name, size in MONTH_BLOCKS.items()}


def step_layouts(axes=GLOBAL_2024, sizes: Sequence[int] = STEP_BLOCKS) -> dict[str, layout.Layout]:
    """Time-first layouts of different block lengths."""
    return {f"time_{k}": (lambda df, k=k: layout.tile_time(df, axes, k)) for k in sizes}


def run_layouts(axes=GLOBAL_2024) -> dict[str, layout.Layout]:
    """Block shapes the regional pipeline is timed under."""
    return {name: _tiled(axes, *size) for name, size in RUN_BLOCKS.items()}


def calendar_months(*grids: DataFrame) -> DataFrame:
    """Calendar-month table of every catalogued variable of the grids."""
    steps = [spatial.spatial_mean(g, available(g, VARIABLES)) for g in grids]
    return temporal.calendar_month_agg(align.merge_on_keys(steps, [TIME]) if len(steps) > 1 else steps[0])


def monthly_layout_study(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    layouts: Mapping[str, layout.Layout] | None = None,
) -> DataFrame:
    """The monthly aggregation under several layouts: tables, timings, and the check that they agree."""
    chosen = month_layouts() if layouts is None else layouts
    grids = [read_grid(spark, p) for p in paths]
    for grid, path in zip(grids, paths):
        if not available(grid, VARIABLES):
            raise ValueError(f"grid {path} has no known variable")

    results = {}

    def keep(name: str, months: DataFrame) -> DataFrame:
        write_table(months, f"{out}/{name}_monthly", digits=None, format="parquet")
        results[name] = spark.read.parquet(f"{out}/{name}_monthly")
        return results[name]

    runs = layout.measure_layouts(grids, chosen, calendar_months, keep=keep)
    for name, months in results.items():
        write_table(months, f"{out}/{name}_monthly_csv", digits=None, sort=TIME)
    write_table(runs, f"{out}/benchmark", digits=2)
    ends = compare.best_worst(runs)
    write_table(ends, f"{out}/best_worst", digits=3)
    first, *others = results
    if others:
        checks = [compare.compare_tables(results[first], results[n], TIME, label=n) for n in others]
        write_table(stack(checks), f"{out}/agreement", digits=None)
    temperature = [c for c in results[first].columns if c.startswith("t2m")]
    if temperature:
        overlay = temporal.month_spine(layout.layout_overlay(results, temperature[0]))
        write_table(overlay, f"{out}/overlay", digits=None, sort="month")
    best = results[ends.first()["best"]]
    values = [c for c in best.columns if c not in (TIME, "month", "month_abbr")]
    write_table(figures.climatology_by_month(best, values), f"{out}/climatology", digits=None, sort="month")
    radiation = {c: c.split("_")[0] for c in values if c.split("_")[0] in figures.RADIATION}
    if len(radiation) >= 2:
        matrix = figures.radiation_matrix(best.withColumnsRenamed(radiation), list(radiation.values()))
        write_table(matrix, f"{out}/radiation", digits=None, sort="variable")
    else:
        log.warning("no radiation table: the grids hold %d of at least 2 radiation variables", len(radiation))
    return runs


def run_experiment(
    spark: SparkSession,
    instant_path: str,
    accum_path: str,
    out: str,
    layouts: Mapping[str, layout.Layout] | None = None,
    slow: str = "tiny_chunks",
    fast: str = "balanced",
    region: Region = REGIONS["south_asia"],
) -> DataFrame:
    """Time the regional pipeline under several block shapes; all must give the same annual mean."""
    chosen = run_layouts() if layouts is None else layouts
    grids = [read_grid(spark, instant_path, INSTANT_VARIABLES), read_grid(spark, accum_path, ACCUM_VARIABLES)]
    cells = [select.in_region(g, region) for g in grids]
    runs = layout.measure_layouts(
        cells, chosen, lambda instant, accum: regional_daily(instant, accum, region), F.avg("t2m_c")
    )
    write_table(runs, f"{out}/runs", digits=6, sort="elapsed_s")
    write_summary(compare.best_worst(runs), f"{out}/best_worst")
    write_summary(compare.run_delta(runs, slow, fast, "value"), f"{out}/speedup")
    return runs


def validate(
    spark: SparkSession,
    reference_dir: str,
    candidate_dir: str,
    out: str,
    atol: float = 1e-3,
    rtol: float = 1e-3,
    tables: Mapping[str, tuple[str, str]] = VALIDATION_TABLES,
) -> DataFrame:
    """Compare the result tables of two runs.

    Tables missing on either side are skipped and listed in the summary; any
    other failure is raised.  If both runs have a summary, these are compared
    path by path too.
    """
    reports, skipped = [], []
    for label, (name, key) in tables.items():
        key_type = "int" if key == "month" else "date"
        try:
            a = read_time_table(spark, f"{reference_dir}/{name}", key, key_type, sort=False)
            b = read_time_table(spark, f"{candidate_dir}/{name}", key, key_type, sort=False)
        except AnalysisException as problem:
            if not unreadable(problem):
                raise
            skipped.append(label)
            continue
        require_nonempty(align.common_keys(a, b, key), f"overlap of {label}")
        reports.append(compare.compare_tables(a, b, key, atol, rtol, label))
    if not reports:
        raise FileNotFoundError(f"no comparable tables in {reference_dir} and {candidate_dir}")
    report = stack(reports)
    write_table(report.orderBy("table", "column"), f"{out}/validation", digits=None)
    kept = spark.read.csv(f"{out}/validation", header=True, schema=report.schema)
    try:
        documents = [read_document(spark, f"{d}/summary") for d in (reference_dir, candidate_dir)]
    except AnalysisException as problem:
        if not unreadable(problem):
            raise
        skipped.append("summary")
    else:
        write_table(document_diff(*documents, atol, rtol).orderBy("path"), f"{out}/summary_diff", digits=None)
    tolerances = F.struct(F.lit(atol).alias("atol"), F.lit(rtol).alias("rtol")).alias("tolerances")
    left_out = F.array(*[F.lit(name) for name in skipped]).cast("array<string>").alias("skipped")
    write_summary(compare.validation_rollup(kept).select(tolerances, "*", left_out), f"{out}/validation_summary")
    return kept


def check_consistency(spark: SparkSession, a_dir: str, b_dir: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Largest and mean differences of two runs' daily tables and of their anomalies."""
    a, b = (read_time_table(spark, f"{d}/daily", sort=False) for d in (a_dir, b_dir))
    daily = compare.consistency(a, b, CONSISTENCY_COLUMNS)
    names = [c for c in CONSISTENCY_COLUMNS if c in a.columns and c in b.columns]
    anomalies = compare.consistency(
        windows.anomaly(a, names), windows.anomaly(b, names), [c + "_anom" for c in names]
    )
    write_table(daily, f"{out}/consistency_daily", digits=None, sort="metric")
    write_table(anomalies, f"{out}/consistency_anomaly", digits=None, sort="metric")
    return daily, anomalies


def region_and_global(
    spark: SparkSession,
    paths: Sequence[str],
    variables: Sequence[str],
    out: str,
    region: Region = REGIONS["south_asia"],
    convert: Mapping[str, Callable] = MappingProxyType({}),
    disjoint: bool = False,
) -> DataFrame:
    """Global and regional mean series of variables with their 24-row rolling means.

    Files with the same variables are opened as one grid; each such grid, say
    each step type, is read once for all its variables, and the step means
    meet by time.  ``disjoint`` says that files of one grid hold different
    times.
    """
    held: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        names = tuple(available(spark.read.parquet(path), variables))
        if names:
            held.setdefault(names, []).append(path)
    missing = set(variables) - {v for names in held for v in names}
    if missing:
        raise ValueError(f"no grid holds the variables {sorted(missing)}")
    grids = [(read_grid_multi(spark, files, names, disjoint or len(files) == 1), names) for names, files in held.items()]
    series = region_and_global_means(grids, region)
    columns = {f"{v}_{part}": convert.get(v, units.unchanged) for v in variables for part in ("global", "region")}
    series.select(TIME, *[f(F.col(n)).alias(n) for n, f in columns.items()]).write.mode("overwrite").parquet(f"{out}/series")
    kept = spark.read.parquet(f"{out}/series")
    write_table(windows.rolling24(kept, {n: n + "_rolling24" for n in columns}), f"{out}/rolling24", digits=None, sort=TIME)
    return kept
