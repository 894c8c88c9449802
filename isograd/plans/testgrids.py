"""Grids derived from the test tables, for the registered queries.

No row of a table is left out: every event or order becomes one grid cell.
Schemas are stated, so that planning a query opens no file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME, GridAxes
from isograd.functions.calendar import epoch_to_ts

DENSE_START_S = 1_704_067_200  # 2024-01-01
SAMPLED_START_S = 1_609_459_200  # 2021-01-01
DENSE_AXES = GridAxes("2024-01-01 00:00:00", 21_600, 50.0, 10.0, 60.0, 10.0)

FINE_AXES = GridAxes("2024-01-01 00:00:00", 21_600, 50.0, 0.1, 60.0, 0.1)

PACK_SCALE, PACK_OFFSET, PACK_FILL = 0.01, 273.15, -32_767


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _dense_coords(k: Column) -> list[Column]:
    """5 x 5 cells, 6-hourly."""
    step = _div(k, 25)
    return [
        epoch_to_ts(step * 21_600 + DENSE_START_S).alias(TIME),
        (50.0 - 10.0 * (_div(k, 5) % 5)).alias(LATITUDE),
        (60.0 + 10.0 * (k % 5)).alias(LONGITUDE),
    ]


def _fine_coords(k: Column, kind: str) -> list[Column]:
    """5 x 5 cells a tenth of a degree apart, which neither float32 nor double holds exactly."""
    time, _, _ = _dense_coords(k)
    return [
        time,
        (F.lit(50.0) - F.lit(0.1) * (_div(k, 5) % 5)).cast(kind).alias(LATITUDE),
        (F.lit(60.0) + F.lit(0.1) * (k % 5)).cast(kind).alias(LONGITUDE),
    ]


def _sampled_coords(k: Column) -> list[Column]:
    """4 x 4 cells, 4-hourly on every fourth day."""
    step = _div(k, 16)
    seconds = SAMPLED_START_S + _div(step, 6) * (4 * 86_400) + (step % 6) * (4 * 3_600)
    return [
        epoch_to_ts(seconds).alias(TIME),
        (35.0 - 5.0 * (_div(k, 4) % 4)).alias(LATITUDE),
        (70.0 + 5.0 * (k % 4)).alias(LONGITUDE),
    ]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "event_id BIGINT, event_type STRING, value DOUBLE"
    return spark.read.schema(schema).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("o_orderkey BIGINT, o_totalprice DOUBLE").parquet(f"{sf_dir}/orders.parquet")


def instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense instant grid: t2m in K, tcc as a fraction."""
    v = F.col("value")
    return events(spark, sf_dir).select(
        *_dense_coords(F.col("event_id")),
        (F.lit(293.15) + v / 10.0).alias("t2m"),
        ((v % 100.0) / 100.0).alias("tcc"),
    )


def instant_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense instant grid whose temperature is missing where the event is an error."""
    v = F.col("value")
    present = F.col("event_type") != "error"
    return events(spark, sf_dir).select(
        *_dense_coords(F.col("event_id")),
        F.when(present, F.lit(293.15) + v / 10.0).alias("t2m"),
        ((v % 100.0) / 100.0).alias("tcc"),
    )


def instant_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense instant grid with the temperature of both ``instant`` and ``instant_with_gaps``, from one scan."""
    v = F.col("value")
    warm = F.lit(293.15) + v / 10.0
    gaps = F.when(F.col("event_type") != "error", warm)
    return events(spark, sf_dir).select(*_dense_coords(F.col("event_id")), warm.alias("t2m"), gaps.alias("t2m_gaps"), ((v % 100.0) / 100.0).alias("tcc"))


def accum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense accumulated grid in J m⁻²."""
    p = F.col("o_totalprice")
    return orders(spark, sf_dir).select(
        *_dense_coords(F.col("o_orderkey")),
        (2.0 * p).alias("ssr"),
        (-p / 2.0).alias("str"),
        (4.0 * p).alias("tisr"),
        (3.0 * p).alias("tsr"),
        (-p).alias("ttr"),
    )


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled grid: t2m in K, sp in Pa, tp in m."""
    v = F.col("value")
    return events(spark, sf_dir).select(
        *_sampled_coords(F.col("event_id")),
        (F.lit(293.15) + v / 10.0).alias("t2m"),
        (90_000.0 + 20.0 * v).alias("sp"),
        (v * 1e-5).alias("tp"),
    )


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense grid of packed integers with a fill value where the event is an error."""
    raw = F.round(F.col("value") * 100.0).cast("int")
    return events(spark, sf_dir).select(
        *_dense_coords(F.col("event_id")),
        F.when(F.col("event_type") == "error", F.lit(PACK_FILL)).otherwise(raw).alias("raw"),
    )


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense instant grid as one row per step with arrays; a step has exactly 25 cells."""
    per_lat = F.struct((-F.col(LATITUDE)).alias("south"), F.col(LONGITUDE).alias("east"), F.col("t2m"))
    steps = instant(spark, sf_dir).groupBy(TIME).agg(F.array_sort(F.collect_list(per_lat)).alias("cells"))
    return steps.select(
        TIME,
        F.array_distinct(F.transform("cells", lambda c: -c["south"])).alias("latitudes"),
        F.array_distinct(F.transform("cells", lambda c: c["east"])).alias("longitudes"),
        F.transform("cells", lambda c: c["t2m"]).alias("values"),
    )


def fine_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenth-degree instant grid with float32 coordinates."""
    v = F.col("value")
    return events(spark, sf_dir).select(*_fine_coords(F.col("event_id"), "float"), (F.lit(293.15) + v / 10.0).alias("t2m"))


def fine_accum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenth-degree accumulated grid with double coordinates."""
    return orders(spark, sf_dir).select(*_fine_coords(F.col("o_orderkey"), "double"), (2.0 * F.col("o_totalprice")).alias("ssr"))


def packed_by_cell(cells: DataFrame, variables: list[str], fill: float | None = None) -> DataFrame:
    """One row per step, cells from north-west to south-east; missing values become ``fill``."""
    held = [F.col(c) if fill is None else F.coalesce(F.col(c), F.lit(fill)) for c in variables]
    cell = F.struct((-F.col(LATITUDE)).alias("south"), F.col(LONGITUDE).alias("east"), *[h.alias(c) for h, c in zip(held, variables, strict=True)])
    steps = cells.groupBy(TIME).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return steps.select(
        TIME,
        F.array_distinct(F.transform("cells", lambda c: -c["south"])).alias("latitudes"),
        F.array_distinct(F.transform("cells", lambda c: c["east"])).alias("longitudes"),
        *[F.col(f"cells.{name}").alias(name) for name in variables],
    )


def sparse_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense instant grid without the cells whose event is an error."""
    return events(spark, sf_dir).where("event_type <> 'error'").select(
        *_dense_coords(F.col("event_id")), (F.lit(293.15) + F.col("value") / 10.0).alias("t2m"), ((F.col("value") % 100.0) / 100.0).alias("tcc")
    )


def raw_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids with the step time as Unix seconds."""
    return events(spark, sf_dir).select(
        "event_id", (_div(F.col("event_id"), 25) * 21_600 + DENSE_START_S).alias("epoch_s")
    )
