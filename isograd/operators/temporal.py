"""Reduction of the time axis: days, months of the year, calendar months."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isograd.catalog import TIME, VARIABLES, Variable
from isograd.functions import units
from isograd.functions.calendar import day_of, month_end, month_label
from isograd.functions.columns import numeric_columns, unit_name

SERIES_MEANS = ("t2m_c", "tcc", "ssr", "str_nlw", "tisr", "tsr", "ttr")
HEAT_COLUMNS = ("frac_above_35c", "frac_above_40c")
DAILY_METRICS = (*SERIES_MEANS, "t2m_c_max", "t2m_c_min", "net_rad", "reflected_solar")


def daily_metrics(series: DataFrame, with_heat: bool = False, suffixes: Sequence[str] = ("",)) -> DataFrame:
    """Daily table of a step series: means, extremes of the mean temperature, derived radiation.

    Maximum and minimum are those of the regional means, not of single cells.
    ``with_heat`` adds the daily peaks of the heat fractions in the same
    aggregation.  With ``suffixes`` the series holds several results side by
    side, and so does the daily table.
    """
    means, derived = [], {}
    for x in suffixes:
        means += [F.avg(c + x).alias(c + x) for c in SERIES_MEANS]
        means += [F.max("t2m_c" + x).alias("t2m_c_max" + x), F.min("t2m_c" + x).alias("t2m_c_min" + x)]
        means += [F.max(c + x).alias(c + x) for c in HEAT_COLUMNS] if with_heat else []
        derived["net_rad" + x] = units.net_radiation(F.col("ssr" + x), F.col("str_nlw" + x))
        derived["reflected_solar" + x] = units.reflected_solar(F.col("tisr" + x), F.col("tsr" + x))
    daily = series.groupBy(day_of(F.col(TIME)).alias("time")).agg(*means).withColumns(derived)
    shown = (*DAILY_METRICS, *(HEAT_COLUMNS if with_heat else ()))
    return daily.select("time", *[c + x for x in suffixes for c in shown])


def daily_heat(series: DataFrame, columns: Sequence[str] = HEAT_COLUMNS) -> DataFrame:
    """Daily peak of the heat fractions."""
    return series.groupBy(day_of(F.col(TIME)).alias("time")).agg(*[F.max(c).alias(c) for c in columns])


def daily_precip(series: DataFrame, column: str = "tp_mm_mean") -> DataFrame:
    """Daily precipitation: the sum of the sampled steps' regional means."""
    return series.groupBy(day_of(F.col(TIME)).alias("date")).agg(
        F.coalesce(F.sum(column), F.lit(0.0)).alias("tp_mm_total")
    )


def sampled_daily(series: DataFrame) -> DataFrame:
    """Daily table of the sampled grid: mean temperature and pressure, summed precipitation."""
    daily = series.groupBy(day_of(F.col(TIME)).alias("date")).agg(
        F.avg("t2m_c_mean").alias("t2m_c_mean"),
        F.avg("sp_hpa_mean").alias("sp_hpa_mean"),
        F.coalesce(F.sum("tp_mm_mean"), F.lit(0.0)).alias("tp_mm_total"),
    )
    return daily.withColumns({"month": F.month("date"), "year": F.year("date")})


def monthly_climatology(daily: DataFrame, time: str = "time", columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of the daily values by month of the year, all years pooled."""
    names = numeric_columns(daily, exclude=[time, "month", "year"]) if columns is None else columns
    return daily.groupBy(F.month(time).alias("month")).agg(*[F.avg(c).alias(c) for c in names])


def month_spine(df: DataFrame, key: str = "month") -> DataFrame:
    """All twelve months; those absent from the table carry nulls."""
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(key))
    return months.join(df.withColumn(key, F.col(key).cast("int")), key, "left")


def _with_gaps(df: DataFrame, key: str, following: Column, first: Column) -> DataFrame:
    """Every row, and rows of nulls for the keys that are missing before the next one.

    ``following`` gives the keys from a row's own to the one before the next
    row's, whose key is in ``_next``.  Looking at the next row needs no second
    pass over the table.  The window is not partitioned: a table has at most
    one row for each day, or month, of the calendar.
    """
    after = F.lead(key).over(Window.orderBy(key))
    spread = df.where(F.col(key).isNotNull()).withColumn("_next", after).withColumn("_key", F.explode(following))
    own = first.eqNullSafe(F.col("_key"))
    return spread.select(F.col("_key").alias(key), *[F.when(own, F.col(c)).alias(c) for c in df.columns if c != key])


def fill_calendar(df: DataFrame, key: str = "time", zero: Sequence[str] = ()) -> DataFrame:
    """Every day from the first to the last; added days are null, sums (``zero``) are 0.

    Resampling a series produces such days, grouping by day does not.
    """
    days = F.when(F.col("_next") > F.col(key), F.sequence(F.col(key), F.date_sub("_next", 1), F.expr("interval 1 day")))
    filled = _with_gaps(df, key, F.coalesce(days, F.array(key)), F.col(key))
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero}) if zero else filled


def calendar_month_agg(
    series: DataFrame,
    variables: Mapping[str, Variable] = VARIABLES,
    time: str = TIME,
    with_units: bool = True,
) -> DataFrame:
    """One row per calendar month, labelled by its last day, gaps included.

    Each variable found in the series is averaged or summed as its catalogue
    entry says and converted afterwards; missing steps are skipped.
    """
    present = [variables[c] for c in series.columns if c in variables]
    grouped = series.groupBy(month_end(F.col(time)).alias(time)).agg(
        *[(F.sum(v.name) if v.aggregate == "sum" else F.avg(v.name)).alias(v.name) for v in present]
    )
    until = F.add_months(F.trunc("_next", "month"), -1)
    starts = F.when(F.col("_next").isNotNull(), F.sequence(F.trunc(time, "month"), until, F.expr("interval 1 month")))
    filled = _with_gaps(grouped, time, F.coalesce(F.transform(starts, F.last_day), F.array(time)), F.col(time))
    columns = []
    for v in present:
        value = F.coalesce(F.col(v.name), F.lit(0.0)) if v.aggregate == "sum" else F.col(v.name)
        name = unit_name(v.name, v.unit) if with_units else v.name
        columns.append(v.convert(value).alias(name))
    month = F.month(time)
    return filled.select(time, *columns, month.alias("month"), month_label(month).alias("month_abbr"))
