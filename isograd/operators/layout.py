"""Data layouts by time, by block and by space, and the check that results do not depend on them."""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME, GridAxes
from isograd.functions.calendar import ntz
from isograd.operators.compare import compare_tables

Layout = Callable[[DataFrame], DataFrame]


def time_index(axes: GridAxes) -> Column:
    """Step number of a row, from its time value."""
    elapsed = F.timestamp_diff("SECOND", ntz(axes.time_start), F.col(TIME))
    return F.floor(elapsed / F.lit(axes.time_step_s))


def lat_index(axes: GridAxes) -> Column:
    """Row number of a cell counted from the north."""
    return F.round((F.lit(axes.lat_north) - F.col(LATITUDE)) / F.lit(axes.lat_step)).cast("long")


def lon_index(axes: GridAxes) -> Column:
    return F.round((F.col(LONGITUDE) - F.lit(axes.lon_west)) / F.lit(axes.lon_step)).cast("long")


def with_blocks(
    df: DataFrame, axes: GridAxes, kt: int | None = None, ky: int | None = None, kx: int | None = None
) -> DataFrame:
    """Add block numbers ``block_t``, ``block_y``, ``block_x`` for the axes given a block size."""
    blocks = {}
    if kt:
        blocks["block_t"] = F.floor(time_index(axes) / F.lit(kt))
    if ky:
        blocks["block_y"] = F.floor(lat_index(axes) / F.lit(ky))
    if kx:
        blocks["block_x"] = F.floor(lon_index(axes) / F.lit(kx))
    return df.withColumns(blocks)


def _by_blocks(df: DataFrame, blocks: Sequence[str], partitions: int | None) -> DataFrame:
    """Bring the rows of a block together.

    Rebalancing lets adaptive execution split a block that outgrows the advisory
    partition size and pack small blocks into one partition.
    """
    sizes = [] if partitions is None else [partitions]
    return df.hint("rebalance", *sizes, *[F.col(b) for b in blocks])


def tile_time(df: DataFrame, axes: GridAxes, k: int, partitions: int | None = None) -> DataFrame:
    """Blocks of ``k`` steps over the whole map.

    Range partitioning on the full coordinates keeps blocks contiguous and can
    still cut inside a step that holds a large share of the rows.
    """
    keys = ["block_t", TIME, LATITUDE, LONGITUDE]
    blocked = with_blocks(df, axes, kt=k)
    return blocked.repartitionByRange(partitions, *keys) if partitions else blocked.repartitionByRange(*keys)


def tile_blocks(df: DataFrame, axes: GridAxes, kt: int, ky: int, kx: int, partitions: int | None = None) -> DataFrame:
    """Blocks of ``kt`` steps by ``ky`` latitudes by ``kx`` longitudes."""
    return _by_blocks(with_blocks(df, axes, kt, ky, kx), ["block_t", "block_y", "block_x"], partitions)


def tile_space(df: DataFrame, axes: GridAxes, ky: int, kx: int, partitions: int | None = None) -> DataFrame:
    """Spatial tiles that hold all times of their cells."""
    return _by_blocks(with_blocks(df, axes, ky=ky, kx=kx), ["block_y", "block_x"], partitions)


def layout_invariance(
    df: DataFrame,
    layouts: Mapping[str, Layout],
    reduce_fn: Callable[[DataFrame], DataFrame],
    key: str,
    atol: float = 1e-3,
    rtol: float = 1e-3,
) -> DataFrame:
    """Reduce the grid under every layout and compare each result with the first one's."""
    names = list(layouts)
    results = {name: reduce_fn(layouts[name](df)) for name in names}
    reports = [
        compare_tables(results[names[0]], results[name], key, atol, rtol, label=name) for name in names[1:]
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def layout_overlay(results: Mapping[str, DataFrame], column: str, month: str = "month") -> DataFrame:
    """Month by layout: the same column of every result side by side."""
    out = None
    for name, result in results.items():
        one = result.groupBy(month).agg(F.avg(column).alias(column)).select(
            F.lit(name).alias("layout"), F.col(month).cast("int").alias("month"), column
        )
        out = one if out is None else out.unionByName(one)
    return out.groupBy("month").pivot("layout", list(results)).agg(F.first(column))


def measure_layouts(
    grids: Sequence[DataFrame],
    layouts: Mapping[str, Layout],
    reduce_fn: Callable[..., DataFrame],
    value: Column | None = None,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Run a reduction of one or several grids once per layout; a small table of what each run needed.

    ``keep`` stores a result by the name of its layout and returns the stored
    table, from which the facts are then taken.

    Columns are the layout's ``name``, the ``partitions`` its rows came in, the
    ``elapsed_s``, the number of result ``rows`` and, with ``value``, an
    aggregate of the result (say, its mean temperature) by which runs can be
    compared.  Partitions are observed while the reduction runs, so that
    nothing is computed twice.
    """
    what = F.lit(None).cast("double") if value is None else value.cast("double")
    runs = []
    for name, layout in layouts.items():
        seen, tiled = [], []
        for i, grid in enumerate(grids):
            observation = Observation(f"layout {name} {i}")
            numbered = layout(grid).withColumn("_partition", F.spark_partition_id())
            tiled.append(numbered.observe(observation, F.max("_partition").alias("last")).drop("_partition"))
            seen.append(observation)
        started = clock.perf_counter()
        table = reduce_fn(*tiled)
        result = (keep(name, table) if keep else table).agg(F.count(F.lit(1)).alias("rows"), what.alias("value")).first()
        elapsed = clock.perf_counter() - started
        partitions = sum(1 + o.get["last"] for o in seen if o.get["last"] is not None)
        runs.append((name, partitions, elapsed, result["rows"], result["value"]))
    schema = "name string, partitions int, elapsed_s double, rows long, value double"
    return grids[0].sparkSession.createDataFrame(runs, schema)
