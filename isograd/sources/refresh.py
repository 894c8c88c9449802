"""Partial results kept by month of the input, of which only changed months are computed again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.sources.grid import as_grid
from isograd.sources.guards import require_columns
from isograd.sources.tables import unreadable

MONTH = ["year", "month"]


@dataclass(frozen=True)
class Refreshed:
    """The partial rows of all months, and which months this call computed or found gone."""

    partials: DataFrame
    computed: list[tuple[int, int]]
    gone: list[tuple[int, int]]


def month_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """For each month of a stored grid the number of its files and a digest of their names, sizes and times.

    One row a file comes from the listing; no file is opened.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    require_columns(listed, MONTH, f"the folders of {path}")
    file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return listed.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("files"), F.bit_xor(file).alias("fingerprint"))


def _overwrite_months(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(path)


def _marks(spark: SparkSession, folder: str) -> DataFrame:
    schema = "files LONG, fingerprint LONG, year INT, month INT"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/marks")
    except AnalysisException as problem:
        if not unreadable(problem):
            raise
        return spark.createDataFrame([], schema)


def _of_months(months: list[tuple[int, int]]) -> Column:
    return (F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months])


def refresh_months(
    spark: SparkSession,
    grid_path: str,
    out: str,
    reduce_fn: Callable[[DataFrame], DataFrame],
    identity: Mapping[str, object],
) -> Refreshed:
    """Bring the partial rows kept at ``out`` up to date with a grid stored by month.

    ``reduce_fn`` turns cells into partial rows with ``year`` and ``month``;
    rows of one month must depend on the cells of that month alone.
    ``identity`` names what it depends on besides the grid; another identity
    has a folder of its own.  A month is computed again when a file of it is
    new, gone, or changed in size or time; other months are not read.  Partial
    rows carry the fingerprint they were made from, and a month counts only
    while its mark has the same one.  The mark is written after the rows, so a
    driver lost in between leaves a month that the next call computes again,
    never one that mixes two inputs.  One writer at a time.
    """
    told = json.dumps({**identity, "grid": grid_path}, sort_keys=True, default=str)
    folder = f"{out}/{hashlib.sha256(told.encode()).hexdigest()[:16]}"
    now, marks = month_fingerprints(spark, grid_path), _marks(spark, folder)
    same = [*MONTH, "files", "fingerprint"]
    # a few numbers for each calendar month
    listed = {(r.year, r.month): (r.files, r.fingerprint) for r in now.collect()}
    known = {(r.year, r.month): (r.files, r.fingerprint) for r in marks.collect()}
    changed = sorted(m for m in listed if known.get(m) != listed[m])
    if changed:
        of = spark.createDataFrame([(*m, *listed[m]) for m in changed], "year INT, month INT, files LONG, fingerprint LONG")
        cells = as_grid(spark.read.parquet(grid_path).where(_of_months(changed)))
        rows = require_columns(reduce_fn(cells), MONTH, "the partial rows")
        _overwrite_months(rows.join(F.broadcast(of.withColumnRenamed("fingerprint", "_of").drop("files")), MONTH), f"{folder}/partials")
        _overwrite_months(of.coalesce(1), f"{folder}/marks")
    current = spark.createDataFrame([(*m, *v) for m, v in listed.items()], "year INT, month INT, files LONG, fingerprint LONG")
    valid = current.select(*same).withColumnRenamed("fingerprint", "_of").drop("files")
    kept = spark.read.parquet(f"{folder}/partials") if listed else spark.createDataFrame([], "year INT, month INT, _of LONG")
    return Refreshed(kept.join(F.broadcast(valid), [*MONTH, "_of"]).drop("_of"), changed, sorted(set(known) - set(listed)))
