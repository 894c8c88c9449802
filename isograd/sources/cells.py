"""Grids stored by integer position, in buckets that later joins use as they are."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.catalog import GridAxes
from isograd.operators.cells import CELL, require_unique, snap


@dataclass(frozen=True)
class StoredCells:
    """A stored table of cells with the axes that its positions count on."""

    cells: DataFrame
    axes: GridAxes
    buckets: int


def write_cells(grid: DataFrame, axes: GridAxes, path: str, buckets: int) -> None:
    """Store a grid by integer position in ``buckets`` sorted files.

    Coordinates off the axes and repeated cells are errors, so readers need not
    look again.  Positions are hashed, so a step with many cells fills all
    buckets.  The folder must be new.  Axes and number of buckets are written
    last, so that a folder without them is known to be incomplete.
    """
    spark = grid.sparkSession
    dealt = snap(grid, axes).repartition(buckets, *CELL)
    ordered = require_unique(dealt, CELL, "the grid").sortWithinPartitions(*CELL)
    name = f"isograd_cells_{uuid.uuid4().hex}"
    ordered.write.format("parquet").bucketBy(buckets, *CELL).sortBy(*CELL).option("path", f"{path}/cells").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table was declared over a path of its own
    about = {"buckets": buckets, **asdict(axes)}
    spark.range(1).select(*[F.lit(v).alias(c) for c, v in about.items()]).coalesce(1).write.parquet(f"{path}/about")


def read_cells(spark: SparkSession, path: str) -> StoredCells:
    """Open stored cells; the table is declared with its buckets, which files alone do not show."""
    about = spark.read.parquet(f"{path}/about").first().asDict()
    buckets = about.pop("buckets")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/cells").schema.fields)
    told = f"{path} {columns} {buckets}"
    name, keys = f"isograd_cells_{hashlib.sha256(told.encode()).hexdigest()[:16]}", ", ".join(CELL)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}/cells'"
    )
    spark.catalog.refreshTable(name)
    return StoredCells(spark.table(name), GridAxes(**about), buckets)
