"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from isograd.session import shared_folder

#: Bytes of the batches that tasks hand to Python while a table is stored; without it 10,000 rows of any length make one.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries run inside hand batches of at most about ``BATCH_BYTES`` to Python; a setting of the session holds."""
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later uses neither repeat nor lose the work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """The names, longer by underscores where a column (in any case) has one already."""
    taken = {c.lower() for c in columns}

    def free(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        return name

    return [free(n) for n in names]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
