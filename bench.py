"""Times the registered queries on one machine and prints one JSON line.

Each query is evaluated completely (every output column, all rows) through the
``noop`` sink, twice: ``queries`` holds the second run, ``first_run`` the first,
in which the JVM still compiles the query's code.  ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the threads,
``BENCH_QUERIES`` a comma-separated choice.

``BENCH_GRID=STEPSxLATSxLONS`` (say 1464x121x141, the shape of the published
study) times the regional analyses on an invented grid of that shape instead;
the grid is written to the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from isograd.catalog import ACCUM_VARIABLES, GLOBAL_2024, INSTANT_VARIABLES, LATITUDE, LONGITUDE, REGIONS, TIME, Region
from isograd.functions.calendar import epoch_to_ts
from isograd.operators import align, cells, exact, packed, regions, summary, temporal, windows
from isograd.plans.pipelines import calendar_months
from isograd.plans.queries import QUERIES
from isograd.plans.regional import region_and_global_means, regional_daily
from isograd.operators.select import in_region
from isograd.operators.spatial import weighted_spatial_mean
from isograd.session import local_session, shared_folder
from isograd.sources.cells import read_cells, write_cells
from isograd.sources.grid import read_grid, write_grid

HEADLINE = (
    "daily_metrics", "daily_metrics_gaps", "regional_step_series", "monthly_climatology", "daily_anomaly",
    "annual_cycle", "monthly_energy", "region_summary", "central_daily", "season_compare", "calendar_month",
    "region_vs_global", "rolling24", "merge_steps_outer", "multi_open", "explode_grid", "validation_metrics",
    "consistency_anomaly", "layout_time_first", "layout_balanced", "layout_space_first", "layout_invariance",
    "radiation_heatmap", "grid_shape",
    "merge_packed", "packed_means", "regions_daily", "layout_exact",
    "cell_rolling", "csv_roundtrip", "stored_grid", "kept_daily", "cell_anomaly", "both_steps_means",
)


def invented_grid(spark, variables, steps: int, lats: int, lons: int, seed: int):
    """Six-hourly cells from 35 N, 65 E in quarter degrees, float32 values from a hash of the cell."""
    cell = F.col("id")
    place = F.call_function("div", cell, F.lit(lons))
    draw = [(F.pmod(F.xxhash64(cell, F.lit(seed + i)), F.lit(10_000)) / 10_000).alias(v) for i, v in enumerate(variables)]
    rows = spark.range(steps * lats * lons).select(
        epoch_to_ts(F.call_function("div", place, F.lit(lats)) * 21_600 + 1_704_067_200).alias(TIME),
        (35.0 - 0.25 * (place % lats)).cast("float").alias(LATITUDE),
        (65.0 + 0.25 * (cell % lons)).cast("float").alias(LONGITUDE),
        *draw,
    )
    scale = {"t2m": (273.0, 45.0), "tcc": (0.0, 1.0)}
    values = [(F.lit(scale.get(v, (0.0, 1e6))[0]) + F.col(v) * scale.get(v, (0.0, 1e6))[1]).cast("float").alias(v) for v in variables]
    return rows.select(TIME, LATITUDE, LONGITUDE, *values)


def grid_work(spark, shape: tuple[int, int, int]) -> dict:
    """The regional analyses on stored grids of a shape, as functions that give a lazy table."""
    root = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    for seed, (name, variables) in enumerate((("instant", INSTANT_VARIABLES), ("accum", ACCUM_VARIABLES))):
        write_grid(invented_grid(spark, variables, *shape, 100 * seed), f"{root}/{name}")

    def instant():
        return read_grid(spark, f"{root}/instant", INSTANT_VARIABLES)

    def accum():
        return read_grid(spark, f"{root}/accum", ACCUM_VARIABLES)

    region = REGIONS["south_asia"]
    for name, make in (("instant", instant), ("accum", accum)):
        write_cells(make(), GLOBAL_2024, f"{root}/cells-{name}", 64)
    held = [read_cells(spark, f"{root}/cells-{name}").cells for name in ("instant", "accum")]
    axes = replace(GLOBAL_2024, lat_north=35.0, lon_west=65.0)
    packed.pack_grid(instant(), ["t2m", "tcc"], axes, shape[1], shape[2]).write.parquet(f"{root}/packed")
    arrays = spark.read.parquet(f"{root}/packed")
    inner = {name: packed.Packed(name) for name in ("t2m", "tcc")}
    boxes = {"whole": region, **{f"box {i}": Region(f"box {i}", 35.0 - i, 5.0 + i, 65.0 + i, 100.0 - i) for i in range(1, 4)}}
    return {
        "merge_cells_stored": lambda: cells.merge_indexed(*held, checked=True),
        "packed_means": lambda: packed.packed_means(arrays, inner, boxes["box 3"]),
        "long_means": lambda: weighted_spatial_mean(in_region(instant(), boxes["box 3"]), ["t2m", "tcc"]),
        "four_regions": lambda: regions.regions_series(instant(), GLOBAL_2024, boxes, ["t2m", "tcc"]),
        "exact_means": lambda: exact.exact_spatial_mean(instant(), ["t2m", "tcc"]),
        "regional_daily": lambda: regional_daily(instant(), accum(), region),
        "monthly_climatology": lambda: temporal.monthly_climatology(regional_daily(instant(), accum(), region)),
        "daily_anomaly": lambda: windows.anomaly(regional_daily(instant(), accum(), region, with_heat=False)),
        "calendar_months": lambda: calendar_months(instant(), accum()),
        "region_and_global": lambda: region_and_global_means([(instant(), ["t2m", "tcc"]), (accum(), ["tsr", "ttr"])], region),
        "grid_shape": lambda: summary.grid_shape(instant()),
        "merge_cells_grouping": lambda: align.merge_steps(instant(), accum()),
        "merge_cells_join": lambda: instant().drop("year", "month").join(accum().drop("year", "month"), [TIME, LATITUDE, LONGITUDE], "full"),
    }


def timed(make) -> float:
    started = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def run(spark, name: str, sf_dir: str) -> float:
    return timed(lambda: QUERIES[name](spark, sf_dir))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = local_session("isograd-bench", os.environ.get("BENCH_CPUS", os.cpu_count()))
    if shape := os.environ.get("BENCH_GRID"):
        work = grid_work(spark, tuple(int(n) for n in shape.split("x")))
        first = {name: round(timed(make), 3) for name, make in work.items()}
        seconds = {name: round(timed(make), 3) for name, make in work.items()}
        spark.stop()
        total = round(sum(seconds.values()), 3)
        print(json.dumps({"metric": "seconds of the regional analyses", "value": total, "unit": "sec", "queries": seconds, "first_run": first, "grid": shape}))
        return
    run(spark, "region_filter", sf_dir)  # starts the JVM's code paths once; not counted
    first = {name: round(run(spark, name, sf_dir), 4) for name in names}
    seconds = {name: round(run(spark, name, sf_dir), 4) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "first_run_total": round(sum(first.values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
