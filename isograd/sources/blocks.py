"""Grids stored by block of the map and of time, and read back by asked boxes and spans.

A folder for every block of a long or fine grid would make as many small files
as blocks.  So the number of folders follows the rows: a folder holds one
block, or, of a grid of very many blocks, 2, 4, 8, ... neighbouring blocks along
each axis that is cut, and is named by the lowest numbers in it.  Its rows then
keep the numbers of their own blocks and lie in order of them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.catalog import COORDS, LATITUDE, LONGITUDE, TIME, GridAxes
from isograd.functions.calendar import ntz
from isograd.operators.cells import TOLERANCE
from isograd.operators.layout import with_blocks

#: What is asked for: a name, a span of time and a box, all bounds included.
ASKED = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("start", T.TimestampNTZType()), T.StructField("end", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in ("north", "south", "west", "east")]
)

#: A grid has at most so many folders, or one for so many rows.
FOLDERS = 64
FOLDER_ROWS = 1 << 18


@dataclass(frozen=True)
class StoredBlocks:
    """A grid filed by block, with its axes, the size of a block along each axis that is cut, and the blocks a folder holds along each."""

    cells: DataFrame
    axes: GridAxes
    sizes: dict[str, int]
    together: int = 1


def _own(block: str) -> str:
    """Column of the number of a row's own block, where a folder holds several."""
    return f"_{block}"


def _folder(block: str, together: int) -> Column:
    """Lowest number of the blocks in the folder of a block."""
    return F.floor(F.col(block) / F.lit(together)) * F.lit(together)


def _together(blocked: DataFrame, names: list[str], rows_a_folder: int) -> int:
    """Blocks that a folder holds along each axis: the least power of two that keeps the number of folders small."""
    sizes = blocked.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))
    powers = [1 << m for m in range(32)]
    folders = [F.approx_count_distinct(F.struct(*[_folder(c, k) for c in names]), 0.1).alias(f"by_{k}") for k in powers]
    found = sizes.agg(F.sum("rows").alias("rows"), *folders).first()
    limit = max(FOLDERS, (found["rows"] or 0) // rows_a_folder)
    return next((k for k in powers if found[f"by_{k}"] <= limit), powers[-1])


def write_blocks(grid: DataFrame, axes: GridAxes, path: str, kt: int | None = None, ky: int | None = None, kx: int | None = None, rows_a_folder: int = FOLDER_ROWS) -> None:
    """File a grid by blocks of ``kt`` steps, ``ky`` rows and ``kx`` columns; an axis without a size is not cut.

    Time-first, balanced and space-first layouts differ in which sizes are
    given.  Rows are brought together by folder; adaptive execution splits a
    folder that is too large and packs small ones into one task.  Axes and sizes
    are written last.
    """
    sizes = {c: k for c, k in (("block_t", kt), ("block_y", ky), ("block_x", kx)) if k}
    if not sizes:
        raise ValueError("give the size of a block along at least one axis")
    spark = grid.sparkSession
    blocked = with_blocks(grid.drop("year", "month"), axes, kt, ky, kx)
    together = _together(blocked, list(sizes), rows_a_folder)
    own = [_own(c) for c in sizes] if together > 1 else []
    if own:
        blocked = blocked.withColumns({_own(c): F.col(c) for c in sizes}).withColumns({c: _folder(c, together) for c in sizes})
    filed = blocked.hint("rebalance", *[F.col(c) for c in sizes])
    filed.sortWithinPartitions(*sizes, *own, *COORDS).write.partitionBy(*sizes).parquet(f"{path}/cells")
    about = {**asdict(axes), **{c: sizes.get(c, 0) for c in ("block_t", "block_y", "block_x")}, "together": together}
    spark.range(1).select(*[F.lit(v).alias(c) for c, v in about.items()]).coalesce(1).write.parquet(f"{path}/about")


def read_blocks(spark: SparkSession, path: str) -> StoredBlocks:
    about = spark.read.parquet(f"{path}/about").first().asDict()
    together = about.pop("together")
    sizes = {c: k for c in ("block_t", "block_y", "block_x") if (k := about.pop(c))}
    schema = spark.read.parquet(f"{path}/cells").schema
    kinds = T.StructType([T.StructField(f.name, T.LongType() if f.name in sizes else f.dataType) for f in schema.fields])
    return StoredBlocks(spark.read.schema(kinds).parquet(f"{path}/cells"), GridAxes(**about), sizes, together)


def store_asked(spark: SparkSession, rows: Iterable[tuple], path: str) -> DataFrame:
    """A stored table of asked boxes and spans; its size on disk tells Spark that it is small."""
    spark.createDataFrame(list(rows), ASKED).coalesce(1).write.parquet(path)
    return spark.read.schema(ASKED).parquet(path)


def blocks_of(asked: DataFrame, axes: GridAxes, sizes: dict[str, int]) -> DataFrame:
    """The asked rows, one for each block that their box and span touch."""

    def last(value: Column, origin: float, step: float) -> Column:
        return F.floor((value - F.lit(origin)) / F.lit(step) + TOLERANCE)

    def first(value: Column, origin: float, step: float) -> Column:
        return F.greatest(F.ceil((value - F.lit(origin)) / F.lit(step) - TOLERANCE), F.lit(0))

    def seconds(c: str) -> Column:
        return F.timestamp_diff("SECOND", ntz(axes.time_start), F.col(c)).cast("double")

    bounds = {
        "block_t": (first(seconds("start"), 0.0, axes.time_step_s), last(seconds("end"), 0.0, axes.time_step_s)),
        "block_y": (first(-F.col("north"), -axes.lat_north, axes.lat_step), last(-F.col("south"), -axes.lat_north, axes.lat_step)),
        "block_x": (first(F.col("west"), axes.lon_west, axes.lon_step), last(F.col("east"), axes.lon_west, axes.lon_step)),
    }
    touched = asked
    for c, k in sizes.items():
        low, high = (F.floor(b / F.lit(k)).cast("long") for b in bounds[c])
        numbers = F.when(bounds[c][0] <= bounds[c][1], F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        touched = touched.withColumn(c, F.explode(numbers))
    # the condition holds for all; a filter on this side is what makes Spark prune the other by it
    return touched.where(F.col(next(iter(sizes))) >= 0)


def read_asked(stored: StoredBlocks, asked: DataFrame) -> DataFrame:
    """The cells of every asked box and span with its ``name``; a cell in several comes once for each.

    The folders' names are block numbers, and the asked blocks prune them when
    the query runs: folders that nobody asked for are not opened.  Of the others
    the rows of asked blocks are met, and within those the bounds decide.
    """
    own = [_own(c) for c in stored.sizes] if stored.together > 1 else []
    wanted = blocks_of(asked, stored.axes, stored.sizes)
    if own:
        wanted = wanted.withColumns({_own(c): F.col(c) for c in stored.sizes}).withColumns({c: _folder(c, stored.together) for c in stored.sizes})
    met = stored.cells.join(wanted, [*stored.sizes, *own])
    inside = F.col(TIME).between(F.col("start"), F.col("end")) & F.col(LATITUDE).between(F.col("south"), F.col("north"))
    inside = inside & F.col(LONGITUDE).between(F.col("west"), F.col("east"))
    return met.where(inside).select("name", *[c for c in stored.cells.columns if c not in stored.sizes and c not in own])
