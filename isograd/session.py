"""Session for tests and single-machine runs; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "isograd", cpus: int | str | None = None) -> SparkSession:
    """A ``local[n]`` session.

    Shuffles start with four partitions per thread; adaptive execution merges
    those that turn out small.
    """
    n = int(cpus or os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", 4 * n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can see, named by ``spark.checkpoint.dir``.

    Only a session on one machine (``local[...]``) may leave the setting out;
    a folder of the warehouse directory then stands in for it.  On a cluster
    a missing setting is an error: a local folder would lose tables.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/isograd-shared"
