"""Command line: ``python -m isograd <analysis> ...``; submit it with ``spark-submit`` on a cluster."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from isograd.catalog import GLOBAL_2024, REGIONS, VARIABLES
from isograd.functions import units
from isograd.operators.layout import tile_blocks
from isograd.operators.select import preview
from isograd.plans import pipelines
from isograd.sources.grid import read_grid


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="isograd", description="Gridded-weather analyses on Spark")
    sub = top.add_subparsers(dest="analysis", required=True)

    def add(name: str, text: str, *flags: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        for flag in flags:
            p.add_argument(f"--{flag}", required=True)
        return p

    p = add("region-year", "daily, monthly and anomaly tables of a region", "instant", "accum", "out")
    p.add_argument("--region", choices=sorted(REGIONS), default="south_asia")
    p.add_argument("--sample-days", type=int, default=0, help="first days only; 0 takes the full span")
    p.add_argument("--recompute", action="store_true", help="do not use the kept daily table")
    p.add_argument(
        "--blocks", nargs=3, type=int, metavar=("STEPS", "LATS", "LONS"),
        help="re-lay the grid in blocks of this size before computing; by default the file splits are used",
    )

    p.add_argument(
        "--refresh", action="store_true", help="keep the step series by month of the input and read changed months only"
    )

    p = add("sampled-region", "daily and seasonal tables of a sampled region", "instant", "accum", "out")
    p.add_argument("--region", choices=sorted(REGIONS), default="central_india")
    p.add_argument("--recompute", action="store_true")

    p = add("layouts", "monthly aggregation under several layouts", "out")
    p.add_argument("--grid", nargs="+", required=True)
    p.add_argument("--time-sizes", action="store_true", help="compare time-first block lengths instead")

    p = add("experiment", "regional pipeline under several block shapes", "instant", "accum", "out")

    p = add("global-mean", "global and regional mean of variables", "out")
    p.add_argument("--variable", nargs="+", required=True)
    p.add_argument("--disjoint", action="store_true", help="files of the same variables hold different times")
    p.add_argument("--grid", nargs="+", required=True)
    p.add_argument("--step-seconds", type=int, default=units.STEP_SECONDS_1H, help="divisor of accumulated variables")

    p = add("validate", "compare the result tables of two runs", "reference", "candidate", "out")
    p.add_argument("--atol", type=float, default=1e-3)
    p.add_argument("--rtol", type=float, default=1e-3)

    add("consistency", "differences of two daily tables and their anomalies", "a", "b", "out")

    add("regions", "daily and monthly tables of all known regions from one pass", "instant", "out")

    p = add("merge", "both step types merged cell by cell, by way of stored cell tables", "instant", "accum", "out")
    p.add_argument("--buckets", type=int, default=200)
    p.add_argument("--how", choices=("full", "inner", "left"), default="full")

    p = add("conflicts", "open grids as one and report where they disagree", "out")
    p.add_argument("--grid", nargs="+", required=True)

    p = add("preview", "first rows of a grid")
    p.add_argument("--grid", required=True)
    p.add_argument("--rows", type=int, default=5)
    return top


def _blocks(df: DataFrame, sizes: list[int]) -> DataFrame:
    return tile_blocks(df, GLOBAL_2024, *sizes)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"isograd {args.analysis}").getOrCreate()
    if args.analysis == "region-year" and args.refresh:
        if args.sample_days or args.recompute or args.blocks:
            raise SystemExit("--refresh takes the whole span as it is stored")
        pipelines.region_year_refreshed(spark, args.instant, args.accum, args.out, REGIONS[args.region])
    elif args.analysis == "region-year":
        tile = None if args.blocks is None else partial(_blocks, sizes=args.blocks)
        pipelines.region_year(
            spark, args.instant, args.accum, args.out, REGIONS[args.region],
            days=args.sample_days, recompute=args.recompute, tile=tile,
        )
    elif args.analysis == "sampled-region":
        pipelines.sampled_region(
            spark, args.instant, args.accum, args.out, REGIONS[args.region], recompute=args.recompute
        )
    elif args.analysis == "layouts":
        layouts = pipelines.step_layouts() if args.time_sizes else None
        pipelines.monthly_layout_study(spark, args.grid, args.out, layouts).show(truncate=False)
    elif args.analysis == "experiment":
        pipelines.run_experiment(spark, args.instant, args.accum, args.out).show(truncate=False)
    elif args.analysis == "global-mean":
        convert = {v: VARIABLES[v].convert for v in args.variable if v in VARIABLES}
        fluxes = {v for v, f in convert.items() if f is units.accum_to_flux}
        convert |= {v: partial(units.accum_to_flux, seconds=args.step_seconds) for v in fluxes}
        pipelines.region_and_global(spark, args.grid, args.variable, args.out, convert=convert, disjoint=args.disjoint)
    elif args.analysis == "validate":
        pipelines.validate(spark, args.reference, args.candidate, args.out, args.atol, args.rtol).show(truncate=False)
    elif args.analysis == "consistency":
        for table in pipelines.check_consistency(spark, args.a, args.b, args.out):
            table.show(truncate=False)
    elif args.analysis == "regions":
        pipelines.all_regions(spark, args.instant, args.out)
    elif args.analysis == "merge":
        merged = pipelines.merge_stored(spark, args.instant, args.accum, args.out, buckets=args.buckets, how=args.how)
        merged.write.mode("overwrite").parquet(f"{args.out}/merged")
    elif args.analysis == "conflicts":
        pipelines.report_conflicts(spark, args.grid, args.out).show(truncate=False)
    else:
        preview(read_grid(spark, args.grid), args.rows).show(truncate=False)


if __name__ == "__main__":
    main()
