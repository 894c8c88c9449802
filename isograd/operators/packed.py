"""Packed grids: one row a step (or a block of its rows), coordinates and values as arrays.

Weather files hold a step as one array.  Means over a box are taken inside the
arrays, without a row for each cell; two files with the same axes are put side
by side one row a step; and a long grid is packed by placing its cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.catalog import LATITUDE, LONGITUDE, TIME, GridAxes, Region
from isograd.functions.units import nan_to_null
from isograd.operators.cells import coordinates, require_unique, snap

AXES = ("latitudes", "longitudes")


@dataclass(frozen=True)
class Packed:
    """A variable of a packed grid: its array, and how the numbers in it are decoded."""

    values: str
    scale: float = 1.0
    offset: float = 0.0
    fill: float | None = None

    def decode(self, raw: Column) -> Column:
        """The value, or null where it is missing: null, NaN or the fill value."""
        number = raw.cast("double")
        present = ~F.isnan(number) if self.fill is None else ~F.isnan(number) & (number != F.lit(float(self.fill)))
        return F.when(present, number * F.lit(self.scale) + F.lit(self.offset))


def _at(time: str = TIME) -> Column:
    return F.concat(F.lit(" at "), F.coalesce(F.col(time).cast("string"), F.lit("a missing time")))


def _checked_size(values: str) -> Column:
    """The array, which must fill the axes (or be missing)."""
    fits = F.col(values).isNull() | F.coalesce(F.size(values) == F.size("latitudes") * F.size("longitudes"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit(f"{values} does not fill the axes"), _at()))
    return F.when(fits, F.col(values)).otherwise(wrong)


def _span(axis: str, low: float | None, high: float | None) -> tuple[Column, Column]:
    """Index of the first coordinate between the bounds, and how many follow one another.

    An axis runs one way, up or down, so the coordinates in the box are
    neighbours; an axis on which they are not is an error.
    """
    if low is None:
        return F.lit(0), F.size(axis)
    inside = F.transform(axis, lambda v: v.cast("double").between(low, high))
    first = F.array_position(inside, F.lit(True)).cast("int") - 1
    count = F.size(F.filter(inside, lambda x: x))
    whole = F.forall(F.slice(inside, F.greatest(first, F.lit(0)) + 1, count), lambda x: x)
    return first, F.when(whole, count).otherwise(F.raise_error(F.concat(F.lit(f"{axis} do not run one way"), _at())).cast("int"))


def packed_sums(
    packed: DataFrame,
    variables: Mapping[str, Packed],
    region: Region | None = None,
    weighted: bool = True,
    hot: Mapping[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """For each row its time and, for each variable, ``<name>_sum``, ``<name>_weight`` and ``<name>_n`` over the box.

    Longitudes are summed first, then the rows with the weights of their
    latitudes.  ``hot`` names counts of cells above a limit: name to variable
    and limit; ``cells`` counts the cells of the box.  No row is made of a cell.
    """
    hot = dict(hot or {})
    south, north, west, east = (None,) * 4 if region is None else (region.south, region.north, region.west, region.east)
    y, rows = _span("latitudes", south, north)
    x, columns = _span("longitudes", west, east)
    names = {v.values for v in variables.values()}
    framed = packed.select(
        TIME, "latitudes", F.size("longitudes").alias("_width"), y.alias("_y"), rows.alias("_rows"), x.alias("_x"), columns.alias("_columns"),
        *[_checked_size(c).alias(f"_of_{c}") for c in sorted(names)],
    )
    lines = F.when(F.col("_rows") > 0, F.sequence(F.col("_y"), F.col("_y") + F.col("_rows") - 1)).otherwise(F.array().cast("array<int>"))
    framed = framed.withColumn("_lines", lines).withColumn("cells", F.col("_rows").cast("long") * F.col("_columns"))

    def line_sums(name: str, v: Packed) -> Column:
        """Sum, number and hot cells of every line of the box, as an array of structs."""
        limits = [limit for of, limit in hot.values() if of == name]
        zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("n"), *[F.lit(0).cast("long").alias(f"h{i}") for i in range(len(limits))])

        def add(a: Column, raw: Column) -> Column:
            value = v.decode(raw)
            above = [(a[f"h{i}"] + F.when(value > limit, 1).otherwise(0)).alias(f"h{i}") for i, limit in enumerate(limits)]
            return F.when(value.isNull(), a).otherwise(F.struct((a["s"] + value).alias("s"), (a["n"] + 1).alias("n"), *above))

        held = F.col(f"_of_{v.values}")
        return F.transform("_lines", lambda r: F.aggregate(F.slice(held, r * F.col("_width") + F.col("_x") + 1, F.col("_columns")), zero, add))

    def weight(r: Column) -> Column:
        return F.cos(F.radians(F.get("latitudes", r).cast("double"))) if weighted else F.lit(1.0)

    summed = framed.withColumns({f"_lines_{name}": line_sums(name, v) for name, v in variables.items()} | {"_weights": F.transform("_lines", weight)})

    def total(lines: str, field: str, by_weight: bool) -> Column:
        pairs = F.zip_with(lines, "_weights", lambda line, w: line[field] * w if by_weight else line[field])
        return F.aggregate(pairs, F.lit(0.0) if by_weight else F.lit(0).cast("long"), lambda a, p: a + p)

    out = []
    for name in variables:
        lines = f"_lines_{name}"
        out += [total(lines, "s", True).alias(f"{name}_sum"), total(lines, "n", True).alias(f"{name}_weight"), total(lines, "n", False).alias(f"{name}_n")]
        of = [h for h, (v, _) in hot.items() if v == name]
        out += [total(lines, f"h{i}", False).alias(f"{h}_hot") for i, h in enumerate(of)]
    return summed.select(TIME, "cells", *out)


def packed_means(
    packed: DataFrame,
    variables: Mapping[str, Packed],
    region: Region | None = None,
    weighted: bool = True,
    hot: Mapping[str, tuple[str, float]] | None = None,
    denominator: str = "all",
) -> DataFrame:
    """Means of a box for every step, plain or weighted by area, and shares of hot cells, straight from the arrays.

    A step may come in several rows (blocks of its latitudes): their sums are
    added.  A step without a present cell has null means.  A missing cell is
    not hot, but counts among the cells unless ``denominator`` is ``present``.
    """
    if denominator not in ("all", "present"):
        raise ValueError(f"denominator must be 'all' or 'present', not {denominator!r}")
    hot = dict(hot or {})
    sums = packed_sums(packed, variables, region, weighted, hot)
    whole = sums.groupBy(TIME).agg(*[F.sum(c).alias(c) for c in sums.columns if c != TIME])
    means = [F.try_divide(F.col(f"{v}_sum"), F.col(f"{v}_weight")).alias(v) for v in variables]
    of = {h: F.col("cells") if denominator == "all" else F.col(f"{v}_n") for h, (v, _) in hot.items()}
    return whole.select(TIME, *means, *[F.try_divide(F.col(f"{h}_hot").cast("double"), of[h]).alias(h) for h in hot])


def merge_packed(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Two packed grids side by side, one row a step, by position.

    Steps must be unique.  Where both files hold a step, their axes must be the
    same (compared as float32, the type that weather files use); the error
    names the step.  With ``full``, steps of one file keep null arrays for the
    other's variables.  A variable that both hold is taken from the first.
    """
    if how not in ("full", "inner", "left"):
        raise ValueError(f"how must be 'full', 'inner' or 'left', not {how!r}")
    second = b.select(TIME, *[F.col(c).alias(f"_{c}") for c in AXES], *[c for c in b.columns if c not in a.columns])
    first, second = require_unique(a, [TIME], "the first file"), require_unique(second, [TIME], "the second file")

    def same(axis: str) -> Column:
        one, other = (F.transform(c, lambda v: v.cast("float")) for c in (axis, f"_{axis}"))
        return F.col(axis).isNull() | F.col(f"_{axis}").isNull() | (one == other)

    wrong = F.raise_error(F.concat(F.lit("axes differ"), _at())).isNull()
    met = first.join(second, TIME, how).where(F.when(same("latitudes") & same("longitudes"), F.lit(True)).otherwise(wrong))
    return met.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in AXES}).drop(*[f"_{c}" for c in AXES])


def explode_packed(packed: DataFrame, variables: Mapping[str, Packed]) -> DataFrame:
    """One row a cell with all variables, decoded; a missing array gives nulls."""
    cells = F.size("latitudes") * F.size("longitudes")
    names = sorted({v.values for v in variables.values()})
    kinds = {c: packed.schema[c].dataType.elementType for c in names}
    filled = [F.coalesce(_checked_size(c), F.array_repeat(F.lit(None).cast(kinds[c]), cells)).alias(c) for c in names]
    rows = packed.select(TIME, *AXES, *filled).select(TIME, *AXES, F.posexplode(F.arrays_zip(*names)).alias("_pos", "_cell"))
    width = F.size("longitudes")
    return rows.select(
        TIME,
        F.get("latitudes", F.floor(F.col("_pos") / width).cast("int")).cast("double").alias(LATITUDE),
        F.get("longitudes", F.col("_pos") % width).cast("double").alias(LONGITUDE),
        *[v.decode(F.col(f"_cell.{v.values}")).alias(name) for name, v in variables.items()],
    )


def _dense(cells: str, field: str, size: Column, kind: T.DataType, error: Column) -> Column:
    """An array of ``size`` with the ``field`` of cells ordered by their place ``p``; other places are null, a repeated one is an error.

    The column of cells is named, not given as an expression, so that looking
    at the cell before costs one step.
    """
    none = F.lit(None).cast(kind)

    def run(cell: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(cells, i - 1)["p"]).otherwise(F.lit(-1).cast("long"))
        gap = F.when(cell["p"] > before, cell["p"] - before - 1).otherwise(error.cast("long"))
        return F.concat(F.array_repeat(none, gap.cast("int")), F.array(cell[field]))

    last = F.coalesce(F.get(cells, F.size(cells) - 1)["p"], F.lit(-1).cast("long"))
    return F.concat(F.flatten(F.transform(cells, run)), F.array_repeat(none, (size - 1 - last).cast("int")))


def pack_grid(
    grid: DataFrame, variables: Sequence[str], axes: GridAxes, rows: int, columns: int, block_rows: int | None = None
) -> DataFrame:
    """A long grid as packed rows: ``latitudes``, ``longitudes`` and one array for each variable.

    Cells come in any order and are placed by their position on the axes, which
    have ``rows`` by ``columns`` cells.  Absent cells are null, NaN too; a
    repeated cell, or one outside the axes, is an error that names the step.
    With ``block_rows`` a step is packed in blocks of so many rows, a row of
    the table each, so that a large step is shared by several tasks; blocks
    without a cell are there too.
    """
    height = block_rows or rows
    cells = snap(grid.select(TIME, LATITUDE, LONGITUDE, *variables), axes)
    inside = F.col("lat_row").between(0, rows - 1) & F.col("lon_col").between(0, columns - 1)
    outside = F.raise_error(F.concat(F.lit("a cell lies outside the axes in step "), F.col("step").cast("string"))).isNull()
    cells = cells.where(F.when(inside, F.lit(True)).otherwise(outside))
    place = (F.col("lat_row") % height) * columns + F.col("lon_col")
    held = [nan_to_null(F.col(c)) if isinstance(grid.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c) for c in variables]
    placed = cells.select(
        "step", F.floor(F.col("lat_row") / height).cast("long").alias("block"),
        F.struct(place.alias("p"), *[v.alias(c) for v, c in zip(held, variables, strict=True)]).alias("cell"),
    )
    blocks = -(-rows // height)
    frame = cells.select("step").distinct().select(
        "step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(None).cast(placed.schema["cell"].dataType).alias("cell")
    )
    # nulls are not collected, so the frame adds blocks, not cells
    grouped = placed.unionAll(frame).groupBy("step", "block").agg(F.collect_list("cell").alias("cells"))
    ordered = grouped.withColumn("cells", F.sort_array("cells"))  # structs are ordered by their first field, the place
    first = F.col("block") * height
    line = F.least(first + height, F.lit(rows)) - first
    error = F.raise_error(F.concat(F.lit("a cell occurs more than once in step "), F.col("step").cast("string")))

    def values(c: str) -> Column:
        return _dense("cells", c, line * columns, grid.schema[c].dataType, error).alias(c)

    latitudes = F.transform(F.sequence(first, first + line - 1), lambda r: F.lit(axes.lat_north) - r * F.lit(axes.lat_step))
    longitudes = F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda x: F.lit(axes.lon_west) + x * F.lit(axes.lon_step))
    return ordered.select(coordinates(axes)[0], latitudes.alias("latitudes"), longitudes.alias("longitudes"), *[values(c) for c in variables])
