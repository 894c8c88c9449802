"""The tables behind the published figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isograd.catalog import MONTH_ABBR
from isograd.functions.calendar import month_label
from isograd.functions.units import to_percent
from isograd.operators.compare import melt
from isograd.operators.temporal import HEAT_COLUMNS, month_spine
from isograd.operators.windows import month_vs_annual, rolling15, sign_bands

RADIATION = ("ssr", "str", "tisr", "tsr", "ttr")


def annual_cycle(daily: DataFrame, **rolling) -> DataFrame:
    """Daily temperature with range and rolling mean, heat and cloud percent, radiation."""
    shown = daily.select("time", "t2m_c", "t2m_c_min", "t2m_c_max", *HEAT_COLUMNS, "tcc", "net_rad", "ssr", "str_nlw")
    return rolling15(shown, "t2m_c", "t2m_c_rolling15", **rolling).select(
        "time",
        "t2m_c",
        "t2m_c_min",
        "t2m_c_max",
        "t2m_c_rolling15",
        to_percent(F.col("frac_above_35c")).alias("above_35c_pct"),
        to_percent(F.col("frac_above_40c")).alias("above_40c_pct"),
        to_percent(F.col("tcc")).alias("cloud_pct"),
        "net_rad",
        "ssr",
        "str_nlw",
    )


def monthly_energy(daily: DataFrame) -> DataFrame:
    """Monthly radiation, temperature against the mean of the year, and cloud percent."""
    monthly = month_vs_annual(daily, "t2m_c", also=("ssr", "str_nlw", "net_rad", "tcc"))
    return monthly.select(
        "month",
        month_label(F.col("month")).alias("month_abbr"),
        "ssr",
        "str_nlw",
        "net_rad",
        "t2m_c_vs_annual",
        to_percent(F.col("tcc")).alias("cloud_pct"),
        "t2m_c",
    )


def anomaly_relations(anom: DataFrame, time: str = "time") -> DataFrame:
    """Temperature against radiation and shortwave against cloud, as anomalies with their month."""
    return anom.select(
        time,
        F.month(time).alias("month"),
        "net_rad_anom",
        "t2m_c_anom",
        to_percent(F.col("tcc_anom")).alias("cloud_pct_anom"),
        "ssr_anom",
    )


def anomaly_series(anom: DataFrame, column: str = "t2m_c_anom", **rolling) -> DataFrame:
    """Daily anomaly, its rolling mean and its warm and cool parts."""
    rolled = rolling15(anom.select("time", column), column, column + "_rolling15", **rolling)
    return sign_bands(rolled, column)


def monthly_anomaly(anom: DataFrame, time: str = "time") -> DataFrame:
    """Monthly mean of temperature, cloud (percent) and radiation anomalies; zero up to rounding."""
    return anom.groupBy(F.month(time).alias("month")).agg(
        F.avg("t2m_c_anom").alias("t2m_c_anom"),
        to_percent(F.avg("tcc_anom")).alias("cloud_pct_anom"),
        F.avg("net_rad_anom").alias("net_rad_anom"),
    )


def radiation_matrix(monthly: DataFrame, columns: Sequence[str] = RADIATION, eps: float = 1e-9) -> DataFrame:
    """Variables as rows, months as columns, each row scaled to [0, 1].

    After the pivot a row holds a variable's twelve months, so the scaling is
    row-wise arithmetic and needs no window.
    """
    means = monthly.groupBy("month").agg(*[F.avg(c).alias(c) for c in columns])
    long = melt(means, ["month"], columns, "variable", "value")
    wide = long.groupBy("variable").pivot("month", list(range(1, 13))).agg(F.first("value"))
    cells = [F.col(f"`{m}`") for m in range(1, 13)]
    lo, hi = F.least(*cells), F.greatest(*cells)
    return wide.select(
        "variable", *[((c - lo) / (hi - lo + F.lit(eps))).alias(label) for c, label in zip(cells, MONTH_ABBR)]
    )


def climatology_by_month(monthly: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Twelve months of the given columns, missing months null."""
    return month_spine(monthly.groupBy("month").agg(*[F.avg(c).alias(c) for c in columns]))
