"""Gridded data: reading, decoding, flattening and storing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.catalog import COORDS, LATITUDE, LONGITUDE, TIME
from isograd.functions.calendar import epoch_to_ts
from isograd.functions.units import nan_to_null
from isograd.operators.align import combine_grids
from isograd.sources.guards import available, require_columns


def utc_time(time: Column, kind: T.DataType) -> Column:
    """A stored time as a zone-less timestamp in UTC, whatever the session's zone.

    Integers are Unix seconds, zoned timestamps are read in UTC, zone-less ones
    and dates are taken as they are.
    """
    if isinstance(kind, T.TimestampNTZType):
        return time
    if isinstance(kind, T.TimestampType):
        return epoch_to_ts(F.unix_micros(time).cast("decimal(24,6)") / F.lit(1_000_000))
    if isinstance(kind, T.IntegralType):
        return epoch_to_ts(time)
    if isinstance(kind, T.DateType):
        return time.cast("timestamp_ntz")
    raise ValueError(f"{TIME} must be a timestamp, a date or integer Unix seconds, not {kind.simpleString()}")


def as_grid(df: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """Coordinates and the requested variables, in library types.

    Scalar coordinates and unknown columns are dropped, NaN becomes null,
    coordinates become doubles and time a zone-less UTC timestamp.  Partition
    columns ``year`` and ``month`` stay, they prune time filters.
    """
    require_columns(df, COORDS, "grid")
    keys = [c for c in ("year", "month") if c in df.columns]
    names = [c for c in df.columns if c not in COORDS and c not in keys] if variables is None else list(variables)
    require_columns(df, names, "grid")
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(c: str):
        missing_as_nan = isinstance(types[c], (T.FloatType, T.DoubleType))
        return nan_to_null(F.col(c)).alias(c) if missing_as_nan else F.col(c)

    return df.select(
        utc_time(F.col(TIME), types[TIME]).alias(TIME),
        F.col(LATITUDE).cast("double").alias(LATITUDE),
        F.col(LONGITUDE).cast("double").alias(LONGITUDE),
        *[value(c) for c in names],
        *keys,
    )


def read_grid(
    spark: SparkSession,
    path: str,
    variables: Sequence[str] | None = None,
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Open a stored grid lazily; only coordinates and requested variables are read.

    ``layout`` re-partitions the rows for computing (see ``operators.layout``);
    without it the file splits are used as they come.
    """
    grid = as_grid(spark.read.parquet(path), variables)
    return layout(grid) if layout else grid


def read_grid_multi(
    spark: SparkSession,
    paths: Sequence[str],
    variables: Sequence[str] | None = None,
    disjoint: bool = False,
) -> DataFrame:
    """Open several stored grids as one data set.

    Files may bring other times, other variables, or both; where they overlap
    they must agree.  ``disjoint`` skips that comparison.
    """
    tables = []
    for path in paths:
        stored = spark.read.parquet(path)
        wanted = None if variables is None else available(stored, variables)
        tables.append(as_grid(stored, wanted))
    return combine_grids(tables, disjoint)


def explode_grid(packed: DataFrame, variable: str, values: str = "values") -> DataFrame:
    """Packed rows (one per step, arrays of coordinates and values) to one row per cell.

    Values are stored latitude by latitude; NaN becomes null.  A step without
    values keeps its cells as nulls; values that do not fill the axes, or axes
    that are missing, are an error.
    """
    nx, cells = F.size("longitudes"), F.size("latitudes") * F.size("longitudes")
    kind = packed.schema[values].dataType.elementType
    present = F.coalesce(F.col(values), F.array_repeat(F.lit(None).cast(kind), cells))
    fits = F.coalesce((F.size("latitudes") >= 0) & (F.size("longitudes") >= 0) & (F.size(present) == cells), F.lit(False))
    wrong = F.raise_error(F.lit(f"a step of {variable} has axes and values of different size"))
    checked = F.when(fits, present).otherwise(wrong.cast(packed.schema[values].dataType))
    rows = packed.select(TIME, "latitudes", "longitudes", F.posexplode(checked).alias("_pos", "_value"))
    return rows.select(
        TIME,
        F.get("latitudes", F.floor(F.col("_pos") / nx).cast("int")).cast("double").alias(LATITUDE),
        F.get("longitudes", F.col("_pos") % nx).cast("double").alias(LONGITUDE),
        nan_to_null(F.col("_value")).alias(variable),
    )


def write_grid(
    df: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None, replace_months: bool = False
) -> None:
    """Store a grid so that time and region filters skip files and row groups.

    Rows are range-partitioned by their coordinates, which also splits a step
    larger than a partition, sorted inside each file, and filed by year and
    month.  With ``replace_months`` the months found in ``df`` take the place
    of those stored, and other months stay.
    """
    keyed = df.withColumns({"year": F.year(TIME), "month": F.month(TIME)})
    order = ["year", "month", *COORDS]
    ranged = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).write.mode("overwrite" if replace_months else mode)
    if replace_months:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month").parquet(path)
