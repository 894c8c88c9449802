"""Summary rows of daily tables and shape facts of grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isograd.catalog import COORDS, LATITUDE, LONGITUDE, MONSOON_LABEL, OTHER_LABEL, SUMMARY_DIGITS, SUMMARY_PARTS, TIME
from isograd.functions.calendar import is_monsoon, month_label
from isograd.functions.units import to_percent


def season_compare(daily: DataFrame) -> DataFrame:
    """Day count and means of monsoon days and other days, always in that order.

    One aggregation with conditional means; both rows exist even when a class
    has no day.
    """
    monsoon = is_monsoon(F.col("month"))
    classes = [("monsoon", monsoon), ("other", ~monsoon)]
    outputs = {"t2m_c_mean": "t2m_c_mean", "sp_hpa_mean": "sp_hpa_mean", "tp_mm_total": "tp_mm_total_mean"}
    aggs = []
    for prefix, member in classes:
        aggs.append(F.count_if(member).alias(f"{prefix}_day_count"))
        aggs += [F.avg(F.when(member, F.col(c))).alias(f"{prefix}_{out}") for c, out in outputs.items()]
    rows = [
        F.struct(
            F.lit(label).alias("season"),
            F.col(f"{prefix}_day_count").alias("day_count"),
            *[F.col(f"{prefix}_{out}").alias(out) for out in outputs.values()],
        )
        for (prefix, _), label in zip(classes, (MONSOON_LABEL, OTHER_LABEL))
    ]
    return daily.agg(*aggs).select(F.inline(F.array(*rows)))


def pearson(x: str, y: str) -> Column:
    """Correlation over the rows where both are present; null when either does not vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def temp_pressure_corr(daily: DataFrame) -> DataFrame:
    return daily.agg(pearson("t2m_c_mean", "sp_hpa_mean").alias("temp_pressure"))


def first_best(label: Column, value: Column) -> Column:
    """Label of the largest value, the smallest label on ties; missing values never win."""
    return F.max_by(label, F.when(value.isNotNull(), F.struct(value, -label)))


def argmax_month(monthly: DataFrame, column: str) -> DataFrame:
    """Month with the largest value and its label, the first on ties."""
    best = monthly.agg(first_best(F.col("month"), F.col(column)).alias("month"))
    return best.select("month", month_label(F.col("month")).alias("month_abbr"))


def table_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.avg(column).alias("mean"), F.max(column).alias("max"), F.min(column).alias("min"), F.sum(column).alias("sum")
    )


def grid_shape(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, number of steps, latitudes and longitudes, and extents.

    The grid is read once: a grouping by each axis alone sends one row per task
    and distinct coordinate, and these few rows are counted.  ``approximate``
    uses sketches of fixed size instead.
    """
    names = {TIME: "time_steps", LATITUDE: "latitudes", LONGITUDE: "longitudes"}
    extents = [(c, end) for c in COORDS for end in ("min", "max")]
    if approximate:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.approx_count_distinct(c).alias(n) for c, n in names.items()],
            *[(F.min if end == "min" else F.max)(c).alias(f"{c}_{end}") for c, end in extents],
        )
    # Which axis a grouped row belongs to, also where the coordinate itself is missing.
    axes = {c: F.grouping(c) == 0 for c in COORDS}
    per_value = df.groupingSets([[F.col(c)] for c in COORDS], *COORDS).agg(
        F.count(F.lit(1)).alias("_rows"), *[on.alias("_on_" + c) for c, on in axes.items()]
    )
    return per_value.agg(
        F.coalesce(F.sum(F.when(F.col("_on_" + TIME), F.col("_rows"))), F.lit(0)).alias("rows"),
        *[F.count(F.when(F.col("_on_" + c), F.col(c))).alias(n) for c, n in names.items()],
        *[(F.min if end == "min" else F.max)(F.when(F.col("_on_" + c), F.col(c))).alias(f"{c}_{end}") for c, end in extents],
    )


def _annual(daily: DataFrame) -> DataFrame:
    """One row over a daily table, by way of its twelve month rows.

    Days are folded into sums and counts per month of the year, months into the
    year, so that annual means and the months of the largest monthly means come
    out of one pass over the daily table.
    """
    averaged = ("t2m_c", "ssr", "tcc", "net_rad")
    months = daily.groupBy(F.month("time").alias("month")).agg(
        *[F.sum(c).alias(c + "_sum") for c in averaged],
        *[F.count(c).alias(c + "_n") for c in averaged],
        F.max("t2m_c_max").alias("t2m_c_max"),
        F.min("t2m_c_min").alias("t2m_c_min"),
        F.count_if(F.col("frac_above_35c") > 0).alias("days35"),
        F.count_if(F.col("frac_above_40c") > 0).alias("days40"),
        F.max("frac_above_35c").alias("peak35"),
        F.count(F.lit(1)).alias("days"),
    )

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(c + "_sum"), F.sum(c + "_n"))

    def top(c: str) -> Column:
        return month_label(first_best(F.col("month"), F.try_divide(F.col(c + "_sum"), F.col(c + "_n"))))

    return months.agg(
        F.coalesce(F.sum("days"), F.lit(0)).alias("rows_daily"),
        mean("t2m_c").alias("annual_mean_c"),
        F.max("t2m_c_max").alias("annual_max_c"),
        F.min("t2m_c_min").alias("annual_min_c"),
        F.sum("days35").alias("days_with_any_area_above_35c"),
        F.sum("days40").alias("days_with_any_area_above_40c"),
        to_percent(F.max("peak35")).alias("peak_frac_above_35c_pct"),
        top("t2m_c").alias("hottest_month"),
        mean("net_rad").alias("annual_mean_net_surface_rad_wm2"),
        top("ssr").alias("peak_solar_month"),
        to_percent(mean("tcc")).alias("annual_mean_pct"),
        top("tcc").alias("peak_cloud_month"),
    )


def region_summary(daily: DataFrame, rounded: bool = True) -> DataFrame:
    """Summary of a region-year: number of days, then nested temperature, energy budget, cloud cover."""

    def shown(name: str) -> Column:
        value = F.col(name)
        if rounded and name in SUMMARY_DIGITS:
            value = F.round(value, SUMMARY_DIGITS[name])
        return value.alias(name)

    return _annual(daily).select(
        "rows_daily", *[F.struct(*[shown(n) for n in names]).alias(part) for part, names in SUMMARY_PARTS.items()]
    )


def sampled_summary(daily: DataFrame) -> DataFrame:
    """Nested summary of the sampled region: temperature, pressure, precipitation, correlation."""
    one = daily.agg(
        F.avg("t2m_c_mean").alias("mean_t2m_c"),
        F.max("t2m_c_mean").alias("max_t2m_c"),
        F.min("t2m_c_mean").alias("min_t2m_c"),
        F.avg("sp_hpa_mean").alias("mean_sp_hpa"),
        F.avg("tp_mm_total").alias("mean_daily_tp_mm"),
        F.sum("tp_mm_total").alias("total_tp_mm"),
        pearson("t2m_c_mean", "sp_hpa_mean").alias("temp_pressure"),
    )
    return one.select(
        F.struct("mean_t2m_c", "max_t2m_c", "min_t2m_c").alias("temperature_summary"),
        F.struct("mean_sp_hpa").alias("pressure_summary"),
        F.struct("mean_daily_tp_mm", "total_tp_mm").alias("precipitation_summary"),
        F.struct("temp_pressure").alias("correlations"),
    )


def flatten(df: DataFrame) -> DataFrame:
    """One level of structs to plain columns."""
    columns = []
    for field in df.schema.fields:
        if hasattr(field.dataType, "fields"):
            columns += [F.col(f"{field.name}.{f.name}") for f in field.dataType.fields]
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)
