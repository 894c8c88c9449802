"""Result tables: keyed CSV, Parquet and JSON documents."""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.functions.columns import round_columns
from isograd.functions.units import nan_to_null
from isograd.sources.guards import require_nonempty

log = logging.getLogger(__name__)


#: Columns of result tables that hold text.
TEXT_COLUMNS = frozenset({"month_abbr", "season", "table", "column", "metric", "strategy", "name", "tick_label"})

_KEYS = {
    "date": lambda c: F.to_timestamp_ntz(c).cast("date"),
    "timestamp": lambda c: F.to_timestamp_ntz(c),
    "int": lambda c: c.cast("int"),
}


def read_time_table(
    spark: SparkSession,
    path: str,
    key: str = "time",
    key_type: str = "date",
    text: Collection[str] = TEXT_COLUMNS,
    sort: bool = True,
) -> DataFrame:
    """Read a result table whose first column is the key, whatever it is called.

    The key is read as ``date``, ``timestamp`` or ``int``; every other column
    is a double unless named in ``text``.  Only the header is inspected, no
    pass over the rows infers types.  Rows come in the order of the key unless
    ``sort`` is off.  An empty table is an error.
    """
    raw = spark.read.csv(path, header=True)
    first, rest = raw.columns[0], raw.columns[1:]
    table = raw.select(
        _KEYS[key_type](F.col(first)).alias(key),
        *[F.col(c) if c in text else nan_to_null(F.col(c).cast("double")).alias(c) for c in rest],
    )
    require_nonempty(table, f"table {path}")
    return table.orderBy(key) if sort else table


def write_table(
    df: DataFrame,
    path: str,
    digits: int | None = 4,
    format: str = "csv",
    mode: str = "overwrite",
    sort: str | None = None,
) -> None:
    """Write a result table, rounded to ``digits`` places or as it is (``None``)."""
    out = df if digits is None else round_columns(df, digits)
    if sort:
        out = out.orderBy(sort)
    writer = out.write.mode(mode)
    if format == "csv":
        writer.option("header", True).csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format must be 'csv' or 'parquet', not {format!r}")


def write_summary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row summary as a JSON document."""
    df.coalesce(1).write.mode(mode).json(path, ignoreNullFields=False)


#: Conditions under which the input of a computation could not be read.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE")


@dataclass(frozen=True)
class Kept:
    """Tables of one complete run, read back from storage."""

    tables: dict[str, DataFrame]
    run: str
    source: str  # "computed", "kept", or "kept, inputs unreadable"


def unreadable(problem: BaseException) -> bool:
    """Whether an input was missing or could not be opened, as opposed to a failed check or a bug."""
    if isinstance(problem, OSError):
        return True
    condition = problem.getCondition() if isinstance(problem, PySparkException) else None
    return condition is not None and condition.startswith(UNREADABLE)


def _newest(spark: SparkSession, folder: str, source: str) -> Kept | None:
    try:
        marks = spark.read.schema("run STRING, finished TIMESTAMP, names ARRAY<STRING>").parquet(f"{folder}/complete")
    except AnalysisException as problem:
        if not unreadable(problem):
            raise
        return None
    last = marks.agg(F.max_by(F.struct("run", "names"), F.struct("finished", "run")).alias("last")).first()["last"]
    if last is None:
        return None
    return Kept({n: spark.read.parquet(f"{folder}/{last['run']}/{n}") for n in last["names"]}, last["run"], source)


def kept_tables(
    spark: SparkSession,
    path: str,
    identity: Mapping[str, object],
    compute: Callable[[], Mapping[str, DataFrame]],
    recompute: bool = False,
) -> Kept:
    """The tables kept at ``path`` for these parameters and inputs, or freshly computed ones that are then kept.

    ``identity`` names everything the tables depend on; another identity has a
    folder of its own.  Each computation writes a run of its own, and a mark
    when all its tables are written; readers take the newest marked run, so
    neither a lost driver nor a second job at the same time leaves parts in it.
    If the inputs cannot be read, an older run of the same identity stands in
    and ``source`` says so; any other failure is raised.
    """
    told = json.dumps(identity, sort_keys=True, default=str)
    folder = f"{path}/{hashlib.sha256(told.encode()).hexdigest()[:16]}"
    if not recompute:
        kept = _newest(spark, folder, "kept")
        if kept is not None:
            return kept
    run = uuid.uuid4().hex
    try:
        tables = dict(compute())
        for name, table in tables.items():
            table.write.parquet(f"{folder}/{run}/{name}")
    except Exception as problem:
        kept = _newest(spark, folder, "kept, inputs unreadable") if unreadable(problem) else None
        if kept is None:
            raise
        log.warning("the inputs cannot be read (%s); using run %s kept at %s", problem, kept.run, folder)
        return kept
    names = F.array(*[F.lit(n) for n in tables])
    mark = spark.range(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("finished"), names.alias("names"))
    mark.coalesce(1).write.mode("append").parquet(f"{folder}/complete")
    return Kept({n: spark.read.parquet(f"{folder}/{run}/{n}") for n in tables}, run, "computed")
