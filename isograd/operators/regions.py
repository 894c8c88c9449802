"""Any number of regions, also overlapping ones, from one pass over the cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME, GridAxes, Region
from isograd.functions import units
from isograd.operators.cells import box_of, coordinates, snap


def _lines(spark: SparkSession, key: str, name: str, spans: Sequence[tuple[int, int]]) -> DataFrame:
    """For every row (or column) number the regions whose span holds it; at most one row for each line of the map."""
    numbers = sorted({i for a, b in spans for i in range(a, b + 1)})
    listed = [(i, [k for k, (a, b) in enumerate(spans) if a <= i <= b]) for i in numbers]
    return spark.createDataFrame(listed, f"{key} LONG, {name} ARRAY<INT>")


def regions_series(
    grid: DataFrame,
    axes: GridAxes,
    regions: Mapping[str, Region],
    variables: Sequence[str],
    hot: Mapping[str, tuple[str, float]] | None = None,
    weighted: bool = True,
) -> DataFrame:
    """Step means of every region: ``region``, time, the variables and the shares of ``hot`` cells.

    A region is its rows and its columns.  Cells meet the two short lists of
    lines by equality, are reduced for every pair of sets of regions (one for
    the rows, one for the columns), and only these sums are given to each
    region in both sets.  A cell in several regions counts in each; cells
    outside all are dropped by the first list.  ``hot`` names shares of cells
    above a limit: name to variable and limit; missing cells are not hot.
    """
    names, hot = list(regions), dict(hot or {})
    boxes = [box_of(Region(r.name, min(r.north, 90.0), max(r.south, -90.0), r.west, r.east), axes) for r in regions.values()]
    wide = int(360.0 / axes.lon_step)  # no region has more columns than the globe
    spark = grid.sparkSession
    rows = _lines(spark, "lat_row", "_rows", [(b.first_row, b.last_row) for b in boxes])
    columns = _lines(spark, "lon_col", "_columns", [(b.first_col, min(b.last_col, b.first_col + wide)) for b in boxes])
    cells = snap(grid.select(TIME, LATITUDE, LONGITUDE, *variables), axes)
    met = cells.join(F.broadcast(rows), "lat_row").join(F.broadcast(columns), "lon_col")
    weight = F.cos(F.radians(coordinates(axes)[1])) if weighted else F.lit(1.0)
    met = met.withColumn("_w", weight)
    parts = [F.count(F.lit(1)).alias("_cells")]
    for v in variables:
        parts += [F.sum(F.col(v) * F.col("_w")).alias(f"_s_{v}"), F.sum(F.when(F.col(v).isNotNull(), F.col("_w"))).alias(f"_w_{v}")]
    parts += [F.sum(units.heat_flag(F.col(v), limit)).alias(f"_h_{name}") for name, (v, limit) in hot.items()]
    sets = met.groupBy("step", "_rows", "_columns").agg(*parts)
    sums = [c for c in sets.columns if c.startswith("_") and c not in ("_rows", "_columns")]
    each = sets.select("step", F.explode(F.array_intersect("_rows", "_columns")).alias("_region"), *sums)
    total = each.groupBy("step", "_region").agg(*[F.sum(c).alias(c) for c in sums])
    return total.select(
        F.get(F.array(*[F.lit(n) for n in names]), F.col("_region")).alias("region"),
        coordinates(axes)[0],
        *[F.try_divide(F.col(f"_s_{v}"), F.col(f"_w_{v}")).alias(v) for v in variables],
        *[(F.col(f"_h_{h}") / F.col("_cells")).alias(h) for h in hot],
    )


def regions_daily(series: DataFrame, means: Sequence[str], peaks: Sequence[str] = ()) -> DataFrame:
    """Days of every region: means of ``means`` with their largest and least step, and the largest of ``peaks``."""
    out = []
    for c in means:
        out += [F.avg(c).alias(c), F.max(c).alias(f"{c}_max"), F.min(c).alias(f"{c}_min")]
    return series.groupBy("region", F.col(TIME).cast("date").alias("time")).agg(*out, *[F.max(c).alias(c) for c in peaks])
