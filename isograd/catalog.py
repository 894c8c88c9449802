"""Regions, variables, thresholds and axes known to the library."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isograd.functions import units

# --- Fixed values -----------------------------------------------------------

TIME, LATITUDE, LONGITUDE = "valid_time", "latitude", "longitude"
COORDS = (TIME, LATITUDE, LONGITUDE)

HEAT_WARN_C = 35.0
HEAT_DANGER_C = 40.0

MONTH_ABBR = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

MONSOON_MONTHS = (6, 7, 8, 9)
MONSOON_LABEL = "Monsoon sampled days"
OTHER_LABEL = "Other sampled days"


@dataclass(frozen=True)
class Region:
    """A latitude/longitude box; all four bounds belong to it."""

    name: str
    north: float
    south: float
    west: float
    east: float


REGIONS = {
    "central_india": Region("Central India", north=30.0, south=20.0, west=75.0, east=85.0),
    "south_asia": Region("South Asia", north=35.0, south=5.0, west=65.0, east=100.0),
}


@dataclass(frozen=True)
class Variable:
    """How one stored variable is named, aggregated over months and converted."""

    name: str
    long_name: str
    unit: str
    aggregate: str
    convert: Callable[[Column], Column]


VARIABLES = {
    v.name: v
    for v in (
        Variable("t2m", "2-m Temperature", "°C", "mean", units.kelvin_to_c),
        Variable("tcc", "Total Cloud Cover", "fraction", "mean", units.unchanged),
        Variable("sp", "Surface Pressure", "hPa", "mean", units.pa_to_hpa),
        Variable("tp", "Total Precipitation", "mm", "sum", units.m_to_mm),
        Variable("ssr", "Surface Net Solar Radiation", "W m⁻²", "mean", units.accum_to_flux),
        Variable("str", "Surface Net Thermal Radiation", "W m⁻²", "mean", units.accum_to_flux),
        Variable("tisr", "TOA Incident Solar Radiation", "W m⁻²", "mean", units.accum_to_flux),
        Variable("tsr", "Top Net Solar Radiation", "W m⁻²", "mean", units.accum_to_flux),
        Variable("ttr", "Top Net Thermal Radiation", "W m⁻²", "mean", units.accum_to_flux),
    )
}

INSTANT_VARIABLES = ("t2m", "tcc")
SAMPLED_INSTANT_VARIABLES = ("t2m", "sp")
SAMPLED_ACCUM_VARIABLES = ("tp",)
ACCUM_VARIABLES = ("ssr", "str", "tisr", "tsr", "ttr")


@dataclass(frozen=True)
class Dataset:
    """What a stored data set is called, which variables its step types hold, and the region studied."""

    name: str
    instant: tuple[str, ...]
    accum: tuple[str, ...]
    region: Region


DATASETS = {
    "south_asia_2024": Dataset(
        "ERA5 Large South Asia (2024)", INSTANT_VARIABLES, ACCUM_VARIABLES, REGIONS["south_asia"]
    ),
    "central_india_sampled": Dataset(
        "ERA5 Consistent Slice (464 MB)", SAMPLED_INSTANT_VARIABLES, SAMPLED_ACCUM_VARIABLES, REGIONS["central_india"]
    ),
}

# What result tables and summaries are made of and compared on.

CONSISTENCY_COLUMNS = ("t2m_c", "tcc", "ssr", "str_nlw", "net_rad")
VALIDATION_TABLES = {
    "daily_regional_means": ("daily", "time"),
    "monthly_climatology": ("monthly", "month"),
    "temperature_anomalies": ("anomaly", "time"),
    "heat_extremes": ("heat", "time"),
}

SUMMARY_PARTS = {
    "temperature": (
        "annual_mean_c",
        "annual_max_c",
        "annual_min_c",
        "days_with_any_area_above_35c",
        "days_with_any_area_above_40c",
        "peak_frac_above_35c_pct",
        "hottest_month",
    ),
    "energy_budget": ("annual_mean_net_surface_rad_wm2", "peak_solar_month"),
    "cloud_cover": ("annual_mean_pct", "peak_cloud_month"),
}
SUMMARY_DIGITS = {
    "annual_mean_c": 2,
    "annual_max_c": 2,
    "annual_min_c": 2,
    "peak_frac_above_35c_pct": 1,
    "annual_mean_net_surface_rad_wm2": 2,
    "annual_mean_pct": 1,
}

#: Blocks of steps, latitudes and longitudes of the layouts under which results are computed; an axis without a size is not cut.
MONTH_BLOCKS = {"time_first": (24, None, None), "balanced": (120, 30, 30), "space_first": (None, 20, 20)}
RUN_BLOCKS = {"time_heavy": (240, 120, 140), "balanced": (96, 80, 80), "tiny_chunks": (24, 30, 30)}
STEP_BLOCKS = (4, 8, 16)

# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class GridAxes:
    """Origin and step of the three axes, so that a cell's index follows from its coordinates.

    Latitude index 0 is the northern row, as stored in weather files.
    """

    time_start: str
    time_step_s: int
    lat_north: float
    lat_step: float
    lon_west: float
    lon_step: float


def convert(df: DataFrame, variables: Mapping[str, Variable] | None = None) -> DataFrame:
    """Every catalogued variable of a table in its shown unit, other columns as they are."""
    known = VARIABLES if variables is None else variables
    return df.withColumns({c: known[c].convert(F.col(c)) for c in df.columns if c in known})


#: Global quarter-degree grid of 2024, 6-hourly.
GLOBAL_2024 = GridAxes("2024-01-01 00:00:00", 21_600, 90.0, 0.25, 0.0, 0.25)
