"""Daily tables of the two analyses, as lazy plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from isograd.catalog import REGIONS, TIME, Region
from isograd.functions import units
from isograd.operators.align import merge_on_keys
from isograd.operators.select import first_time, in_region, time_window
from isograd.operators.spatial import region_vs_global, regional_series, sampled_series
from isograd.operators.temporal import daily_metrics, fill_calendar, sampled_daily


def regional_daily(
    instant: DataFrame,
    accum: DataFrame,
    region: Region = REGIONS["south_asia"],
    days: int = 0,
    step_seconds: int = units.STEP_SECONDS_6H,
    with_heat: bool = True,
    gaps: bool = False,
) -> DataFrame:
    """Daily table of a region: box, units, area-weighted step means, daily reduction.

    Two shuffles whatever the grid's size: pre-aggregated steps, then days.
    ``days`` limits the span to the first days of the data; ``gaps``
    adds days without data, as resampling does.
    """
    inst, acc = in_region(instant, region), in_region(accum, region)
    if days > 0:
        start = first_time(instant, accum)
        inst, acc = time_window(inst, days, start), time_window(acc, days, start)
    daily = daily_metrics(regional_series(inst, acc, step_seconds), with_heat=with_heat)
    return fill_calendar(daily, "time") if gaps else daily


def sampled_regional_daily(
    instant: DataFrame, accum: DataFrame | None = None, region: Region = REGIONS["central_india"]
) -> DataFrame:
    """Daily table of the sampled region: temperature, pressure, precipitation."""
    rain = None if accum is None else in_region(accum, region)
    return sampled_daily(sampled_series(in_region(instant, region), rain))


def region_and_global_means(grids: Sequence[tuple[DataFrame, Sequence[str]]], region: Region) -> DataFrame:
    """Global and regional step means of variables held by several grids, say one of each step type.

    Each grid is read once for all its variables; only the step means meet.
    """
    means = [region_vs_global(grid, variables, region) for grid, variables in grids]
    return merge_on_keys(means, [TIME]) if len(means) > 1 else means[0]
