"""Opening several grids as one when they may disagree: the agreeing cells, and who says what about the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.catalog import COORDS
from isograd.operators.align import stack
from isograd.sources.grid import as_grid
from isograd.sources.guards import available

CONFLICT = (*COORDS, "variable", "low_file", "low_value", "high_file", "high_value", "files")


def open_conflicts(
    spark: SparkSession, paths: Sequence[str], variables: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(cells, conflicts) of several stored grids that may bring other times, variables, or both.

    ``cells`` are those on which all files that hold them agree, a variable
    filled from whichever has it.  ``conflicts`` has a row for each cell and
    variable on which files differ: the least and the greatest value, a file
    that says so (the first by name for the least, the last for the greatest),
    and how many files hold the variable there.  Missing values agree with any.  Within one file a repeated
    cell is a conflict with itself if its values differ.

    Cells are compared by their extremes, which needs no text in the shuffle;
    only the rows of conflicting cells are looked up again with their files.
    """
    tables = []
    for path in paths:
        stored = spark.read.parquet(path)
        names = [c for c in stored.columns if c not in (*COORDS, "year", "month")] if variables is None else available(stored, variables)
        told = stored.withColumn("_file", F.col("_metadata.file_path"))
        tables.append(as_grid(told, [*names, "_file"]).drop("year", "month"))
    rows = stack(tables)
    names = [c for c in rows.columns if c not in (*COORDS, "_file")]
    extremes = [f(c).alias(f"_{end}_{c}") for c in names for f, end in ((F.min, "low"), (F.max, "high"))]
    seen = rows.groupBy(*COORDS).agg(*extremes)
    differ = reduce(lambda a, b: a | b, [~F.col(f"_low_{c}").eqNullSafe(F.col(f"_high_{c}")) for c in names])
    cells = seen.where(~differ).select(*COORDS, *[F.col(f"_low_{c}").alias(c) for c in names])

    again = rows.join(seen.where(differ).select(*COORDS), list(COORDS), "left_semi")
    long = again.unpivot([*COORDS, "_file"], names, "variable", "value").where("value is not null")
    low, high = (f(F.struct("value", "_file")) for f in (F.min, F.max))
    held = long.groupBy(*COORDS, "variable").agg(low.alias("l"), high.alias("h"), F.count_distinct("_file").alias("files"))
    conflicts = held.where("l.value <> h.value").select(
        *COORDS, "variable", F.col("l._file").alias("low_file"), F.col("l.value").alias("low_value"),
        F.col("h._file").alias("high_file"), F.col("h.value").alias("high_value"), "files",
    )
    return cells, conflicts
