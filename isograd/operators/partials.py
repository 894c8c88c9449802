"""Sums that can be added: daily partial rows of a grid, and the results that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isograd.catalog import TIME


def daily_partials(series: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row a day of a step series: sum, number, largest and least of each variable, with the day's year and month."""
    day = F.col(TIME).cast("date")
    parts = []
    for v in variables:
        parts += [F.sum(v).alias(f"{v}_sum"), F.count(v).alias(f"{v}_n"), F.max(v).alias(f"{v}_max"), F.min(v).alias(f"{v}_min")]
    days = series.groupBy(day.alias("time")).agg(*parts)
    return days.select("*", F.year("time").alias("year"), F.month("time").alias("month"))


def merge_partials(partials: DataFrame, variables: Sequence[str], by: Sequence[str] = ("time",)) -> DataFrame:
    """Partial rows added up: mean, largest and least of each variable by any coarser key."""
    out = []
    for v in variables:
        out += [
            F.try_divide(F.sum(f"{v}_sum"), F.sum(f"{v}_n")).alias(v), F.max(f"{v}_max").alias(f"{v}_max"), F.min(f"{v}_min").alias(f"{v}_min")
        ]
    return partials.groupBy(*by).agg(*out)
