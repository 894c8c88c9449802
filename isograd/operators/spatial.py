"""Reduction of the two space axes, the only step that sees every cell.

Each reduction is one ``groupBy`` on the time step: tasks pre-aggregate their
rows, so the shuffle carries at most one row per task and step, however many
cells a step has and however unevenly they are spread.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isograd.catalog import HEAT_DANGER_C, HEAT_WARN_C, LATITUDE, TIME, Region
from isograd.functions import units
from isograd.operators.align import merge_on_keys
from isograd.operators.select import inside

HEAT_THRESHOLDS = {"frac_above_35c": HEAT_WARN_C, "frac_above_40c": HEAT_DANGER_C}


def latitude_weight(latitude: str = LATITUDE) -> Column:
    """Area weight of a cell; a common factor cancels in the mean."""
    return F.cos(F.radians(F.col(latitude)))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weighted mean over the cells that are present; the weights of missing cells drop out."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def spatial_mean(df: DataFrame, variables: Sequence[str], by: Sequence[str] = (TIME,)) -> DataFrame:
    """Plain mean over all cells of a step."""
    return df.groupBy(*by).agg(*[F.avg(v).alias(v) for v in variables])


def weighted_spatial_mean(df: DataFrame, variables: Sequence[str], by: Sequence[str] = (TIME,)) -> DataFrame:
    """Area-weighted mean over all cells of a step."""
    w = F.col("_weight")
    cells = df.select(*by, *variables, latitude_weight().alias("_weight"))
    return cells.groupBy(*by).agg(*[weighted_mean(F.col(v), w).alias(v) for v in variables])


def area_fraction(
    df: DataFrame,
    thresholds: Mapping[str, float] = HEAT_THRESHOLDS,
    temperature: str = "t2m_c",
    by: Sequence[str] = (TIME,),
    denominator: str = "all",
) -> DataFrame:
    """Share of cells above each threshold per step; cells count alike, whatever their area."""
    t = F.col(temperature)
    return df.groupBy(*by).agg(
        *[F.avg(units.heat_flag(t, x, denominator)).alias(name) for name, x in thresholds.items()]
    )


def instant_columns(df: DataFrame) -> DataFrame:
    """Coordinates, temperature in °C and cloud cover of an instant grid."""
    return df.select(TIME, LATITUDE, units.kelvin_to_c(F.col("t2m")).alias("t2m_c"), "tcc")


def accum_columns(df: DataFrame, step_seconds: int = units.STEP_SECONDS_6H) -> DataFrame:
    """Coordinates and fluxes in W m⁻² of an accumulated grid."""
    flux = {"ssr": "ssr", "str": "str_nlw", "tisr": "tisr", "tsr": "tsr", "ttr": "ttr"}
    return df.select(
        TIME,
        LATITUDE,
        *[units.accum_to_flux(F.col(raw), step_seconds).alias(name) for raw, name in flux.items()],
    )


def instant_series(instant: DataFrame, thresholds: Mapping[str, float] = HEAT_THRESHOLDS) -> DataFrame:
    """Weighted temperature and cloud cover of every step with the heat fractions, from one aggregation."""
    w, t = F.col("_weight"), F.col("t2m_c")
    cells = instant_columns(instant).withColumn("_weight", latitude_weight())
    return cells.groupBy(TIME).agg(
        *[weighted_mean(F.col(v), w).alias(v) for v in ("t2m_c", "tcc")],
        *[F.avg(units.heat_flag(t, x)).alias(name) for name, x in thresholds.items()],
    )


def accum_series(accum: DataFrame, step_seconds: int = units.STEP_SECONDS_6H) -> DataFrame:
    """Weighted radiation fluxes of every step."""
    return weighted_spatial_mean(accum_columns(accum, step_seconds), ("ssr", "str_nlw", "tisr", "tsr", "ttr"))


def regional_series(
    instant: DataFrame,
    accum: DataFrame,
    step_seconds: int = units.STEP_SECONDS_6H,
    thresholds: Mapping[str, float] = HEAT_THRESHOLDS,
) -> DataFrame:
    """Step series of a region: seven area-weighted means and the heat fractions.

    Each step type is reduced on its own, then the two short series are put
    together by time.  That equals merging the cells first, because every mean
    divides by the weights of its own cells, and heat fractions must see
    instant cells only.  Both series are already partitioned by time, so
    putting them together needs no further shuffle.  Steps that one of the
    grids lacks keep nulls, as an outer merge would.
    """
    return merge_on_keys([instant_series(instant, thresholds), accum_series(accum, step_seconds)], [TIME])


def region_vs_global(df: DataFrame, variables: Sequence[str], region: Region) -> DataFrame:
    """Plain mean of every cell and of the region's cells, from one scan."""
    aggs = []
    for v in variables:
        aggs.append(F.avg(v).alias(f"{v}_global"))
        aggs.append(F.avg(F.when(inside(region), F.col(v))).alias(f"{v}_region"))
    return df.groupBy(TIME).agg(*aggs)


def sampled_series(instant: DataFrame, accum: DataFrame | None = None) -> DataFrame:
    """Plain step means of the sampled grid in °C, hPa and mm.

    Precipitation comes from its own step type when ``accum`` is given, else
    from the same grid.
    """
    state = (
        F.avg(units.kelvin_to_c(F.col("t2m"))).alias("t2m_c_mean"),
        F.avg(units.pa_to_hpa(F.col("sp"))).alias("sp_hpa_mean"),
    )
    rain = F.avg(units.m_to_mm(F.col("tp"))).alias("tp_mm_mean")
    if accum is None:
        return instant.groupBy(TIME).agg(*state, rain)
    return merge_on_keys([instant.groupBy(TIME).agg(*state), accum.groupBy(TIME).agg(rain)], [TIME])
