"""Cells by integer position on the axes of their grid.

Coordinates of a grid are multiples of its steps, but a step like 0.1 degrees
has no exact binary form: the same cell stored as float32 in one file and as
double in another has two different coordinates.  Integer positions are the
same in both, hash and compare fast, and can be the buckets of a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME, GridAxes, Region
from isograd.functions.calendar import epoch_to_ts, ntz

#: Position of a cell: time step, row from the north, column from the west.
CELL = ("step", "lat_row", "lon_col")

#: How far a coordinate may lie from its grid line, as a share of the grid's step.
TOLERANCE = 0.01


def _position(value: Column, steps_away: Column, what: str, tolerance: float) -> Column:
    """The nearest whole number of steps; a coordinate that is missing or off the grid is an error that shows it."""
    nearest = F.round(steps_away)
    good = F.coalesce(F.abs(steps_away - nearest) <= tolerance, F.lit(False))
    shown = F.concat(F.lit(f"{what} "), F.coalesce(value.cast("string"), F.lit("null")), F.lit(" is off the grid"))
    return F.when(good, nearest.cast("long")).otherwise(F.raise_error(shown).cast("long"))


def snap(grid: DataFrame, axes: GridAxes, tolerance: float = TOLERANCE) -> DataFrame:
    """A grid with integer positions ``step``, ``lat_row``, ``lon_col`` in place of its coordinates."""
    away = {
        "step": F.timestamp_diff("SECOND", ntz(axes.time_start), F.col(TIME)) / F.lit(float(axes.time_step_s)),
        "lat_row": (F.lit(axes.lat_north) - F.col(LATITUDE)) / F.lit(axes.lat_step),
        "lon_col": (F.col(LONGITUDE) - F.lit(axes.lon_west)) / F.lit(axes.lon_step),
    }
    coords = (TIME, LATITUDE, LONGITUDE)
    # time is exact in any form, so a step must be met to the second
    placed = [
        _position(F.col(c), away[i].cast("double"), c, 0.0 if i == "step" else tolerance).alias(i) for i, c in zip(CELL, coords, strict=True)
    ]
    return grid.select(*placed, *[c for c in grid.columns if c not in (*coords, "year", "month")])


def coordinates(axes: GridAxes) -> list[Column]:
    """Time, latitude and longitude of a position, as the axes define them."""
    start = int(datetime.fromisoformat(axes.time_start).replace(tzinfo=timezone.utc).timestamp())
    return [
        epoch_to_ts(F.col("step") * axes.time_step_s + start).alias(TIME),
        (F.lit(axes.lat_north) - F.col("lat_row") * F.lit(axes.lat_step)).alias(LATITUDE),
        (F.lit(axes.lon_west) + F.col("lon_col") * F.lit(axes.lon_step)).alias(LONGITUDE),
    ]


def unsnap(cells: DataFrame, axes: GridAxes) -> DataFrame:
    """Positions back to coordinates."""
    return cells.select(*coordinates(axes), *[c for c in cells.columns if c not in CELL])


def require_unique(table: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The table; a repeated key is an error.

    Rows are numbered within their key, which needs the partitioning and order
    that a join on the key needs anyway.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    wrong = F.raise_error(F.concat(F.lit(f"{what} holds more than once: "), shown)).isNull()
    return table.withColumn("_number", number).where(F.when(F.col("_number") == 1, F.lit(True)).otherwise(wrong)).drop("_number")


def merge_indexed(
    instant: DataFrame, accum: DataFrame, how: str = "full", overlap: str = "override", checked: bool = False
) -> DataFrame:
    """Join two tables of cells on their integer positions.

    A variable that both hold is taken from the first (``override``), or filled
    from whichever has it and must agree where both do (``no_conflicts``).
    ``checked`` tables, such as those of ``sources.cells``, are known to have
    unique positions.  Two stored tables with the same buckets meet without a
    shuffle.
    """
    if how not in ("full", "inner", "left"):
        raise ValueError(f"how must be 'full', 'inner' or 'left', not {how!r}")
    if overlap not in ("no_conflicts", "override"):
        raise ValueError(f"overlap must be 'no_conflicts' or 'override', not {overlap!r}")
    shared = [c for c in accum.columns if c in instant.columns and c not in CELL]
    if overlap == "override":
        accum, shared = accum.drop(*shared), []
    a, b = instant, accum.withColumnsRenamed({c: f"_second_{c}" for c in shared})
    if not checked:
        a, b = (require_unique(t, CELL, f"the {n} table") for t, n in ((a, "first"), (b, "second")))
    joined = a.join(b, list(CELL), how)
    if shared:
        same = [F.col(c).isNull() | F.col(f"_second_{c}").isNull() | (F.col(c) == F.col(f"_second_{c}")) for c in shared]
        where = F.concat_ws(", ", *[F.col(k).cast("string") for k in CELL])
        conflict = F.raise_error(F.concat(F.lit("the tables disagree at "), where)).isNull()
        joined = joined.where(F.when(reduce(lambda x, y: x & y, same), F.lit(True)).otherwise(conflict))
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_second_{c}")) for c in shared})
    return joined.drop(*[f"_second_{c}" for c in shared])


@dataclass(frozen=True)
class Box:
    """Rows and columns of a region; all four bounds belong to it.  A box without cells has its bounds crossed."""

    first_row: int
    last_row: int
    first_col: int
    last_col: int


def box_of(region: Region, axes: GridAxes, tolerance: float = TOLERANCE) -> Box:
    """The positions whose coordinates lie in the region."""
    return Box(
        max(0, math.ceil((axes.lat_north - region.north) / axes.lat_step - tolerance)),
        math.floor((axes.lat_north - region.south) / axes.lat_step + tolerance),
        max(0, math.ceil((region.west - axes.lon_west) / axes.lon_step - tolerance)),
        math.floor((region.east - axes.lon_west) / axes.lon_step + tolerance),
    )


def in_box(cells: DataFrame, box: Box) -> DataFrame:
    """Keep the cells of a box; the integer bounds reach the scan of a stored table."""
    rows = F.col("lat_row").between(box.first_row, box.last_row)
    return cells.where(rows & F.col("lon_col").between(box.first_col, box.last_col))
