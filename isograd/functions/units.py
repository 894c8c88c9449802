"""Unit conversion and per-cell expressions; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KELVIN_OFFSET = 273.15
STEP_SECONDS_6H = 6 * 3600
STEP_SECONDS_1H = 3600


def unchanged(col: Column) -> Column:
    return col


def kelvin_to_c(col: Column) -> Column:
    return col - F.lit(KELVIN_OFFSET)


def pa_to_hpa(col: Column) -> Column:
    return col / F.lit(100.0)


def m_to_mm(col: Column) -> Column:
    return col * F.lit(1000.0)


def accum_to_flux(col: Column, seconds: int = STEP_SECONDS_6H) -> Column:
    """J m⁻² accumulated over one step to W m⁻².

    The divisor is the step length.  6-hourly data needs 21 600, the default;
    ``STEP_SECONDS_1H`` reproduces tables that divided by one hour.
    """
    return col / F.lit(float(seconds))


def to_percent(col: Column) -> Column:
    return col * F.lit(100.0)


def net_radiation(ssr: Column, str_nlw: Column) -> Column:
    """Net surface radiation; the longwave part is negative when upward."""
    return ssr + str_nlw


def reflected_solar(tisr: Column, tsr: Column) -> Column:
    return tisr - tsr


def heat_flag(temp_c: Column, threshold: float, denominator: str = "all") -> Column:
    """1.0 where the temperature is strictly above the threshold, else 0.0.

    A missing cell counts as not hot and stays in the denominator
    (``denominator='all'``); with ``'present'`` it is left out.
    """
    hot = F.when(temp_c > F.lit(threshold), F.lit(1.0))
    if denominator == "all":
        return hot.otherwise(F.lit(0.0))
    if denominator == "present":
        return hot.when(temp_c.isNotNull(), F.lit(0.0))
    raise ValueError(f"denominator must be 'all' or 'present', not {denominator!r}")


def unpack(raw: Column, scale: float, offset: float, fill: float | int | None = None) -> Column:
    """Decode a packed value: the fill value is missing, else ``raw * scale + offset``."""
    value = raw * F.lit(float(scale)) + F.lit(float(offset))
    return value if fill is None else F.when(raw != F.lit(fill), value)


def nan_to_null(col: Column) -> Column:
    """Missing cells arrive as NaN; SQL comparison and averages need NULL."""
    return F.when(~F.isnan(col), col)
