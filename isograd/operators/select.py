"""Row filters: region boxes and time spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isograd.catalog import COORDS, LATITUDE, LONGITUDE, TIME, Region
from isograd.functions.calendar import ntz


def inside(region: Region) -> Column:
    """Condition for a cell inside the box, both bounds of each axis included."""
    return F.col(LATITUDE).between(region.south, region.north) & F.col(LONGITUDE).between(region.west, region.east)


def in_region(df: DataFrame, region: Region) -> DataFrame:
    """Keep the cells of a box; reaches the scan as pushed filters on both coordinates."""
    return df.where(inside(region))


def _span(df: DataFrame, first: Column, last: Column, time: str) -> DataFrame:
    """Rows with ``first <= time <= last``.

    Grids stored by ``write_grid`` are partitioned by year; the span is then
    also stated on that column, so that files of other years are not opened.
    """
    kept = df.where((F.col(time) >= first) & (F.col(time) <= last))
    if "year" in df.columns:
        kept = kept.where((F.col("year") >= F.year(first)) & (F.col("year") <= F.year(last)))
    return kept


def time_between(df: DataFrame, start: str, end: str, time: str = TIME) -> DataFrame:
    """Keep the rows between two instants, both included."""
    return _span(df, ntz(start), ntz(end), time)


def first_time(*tables: DataFrame, time: str = TIME) -> Column:
    """Earliest instant of the tables, as a scalar subquery that reads the time column alone.

    Of a grid stored by year only the files of its first year are read.
    """
    starts = []
    for table in tables:
        if "year" in table.columns:
            table = table.where(F.col("year") == table.agg(F.min("year").alias("first_year")).scalar())
        starts.append(table.agg(F.min(time).alias("first_time")).scalar())
    return F.least(*starts) if len(starts) > 1 else starts[0]


def time_window(df: DataFrame, days: int, start: str | Column | None = None, time: str = TIME) -> DataFrame:
    """Keep the first ``days`` days, the closing instant included.

    The closing instant opens one more day, so a daily table of N days has
    N + 1 rows.  Zero or fewer days keep everything.  Without ``start`` the
    first instant is looked up; its value also prunes the scan.
    """
    if days <= 0:
        return df
    if start is None:
        first = first_time(df, time=time)
    else:
        first = ntz(start) if isinstance(start, str) else start
    return _span(df, first, first + F.make_dt_interval(F.lit(days)), time)


def first_year(df: DataFrame, time: str = "date") -> DataFrame:
    """Keep the rows of the earliest year."""
    year = F.year(F.col(time))
    return df.where(year == df.agg(F.min(year).alias("first_year")).scalar())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows of a grid in file order: time, north to south, west to east."""
    t, y, x = COORDS
    return df.orderBy(F.col(t).asc(), F.col(y).desc(), F.col(x).asc()).limit(n)
