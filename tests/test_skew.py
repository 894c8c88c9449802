"""Hot keys: a third of the rows on one step, one block, one month."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME
from isograd.functions.calendar import epoch_to_ts
from isograd.operators import align, layout, spatial, windows
from isograd.plans.testgrids import DENSE_AXES, DENSE_START_S

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """One step in one corner of the map holds a third of all cells."""
    i = F.col("id")
    one_third = i < ROWS // 3
    step = F.when(one_third, F.lit(7)).otherwise(i % 100)
    return (
        spark.range(0, ROWS, 1, 12)
        .select(
            epoch_to_ts(step * 21_600 + DENSE_START_S).alias(TIME),
            F.when(one_third, F.lit(45.0)).otherwise(10.0 + (i % 40)).alias(LATITUDE),
            (60.0 + i * 0.0005).alias(LONGITUDE),
            (280.0 + (i % 50)).cast("double").alias("t2m"),
        )
        .withColumn("pad", F.sha2(F.col(LONGITUDE).cast("string"), 512))
    )


def largest_share(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()
    return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)


def test_time_layout_cuts_inside_a_hot_step(spark, hot):
    tiled = layout.tile_time(hot, DENSE_AXES, 24, partitions=12)
    assert tiled.count() == ROWS
    assert largest_share(tiled) < 0.2


def test_block_layout_splits_a_hot_block(spark, hot):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256KB")
    try:
        tiled = layout.tile_blocks(hot, DENSE_AXES, 120, 2, 5)
        placed = tiled.withColumn("_p", F.spark_partition_id())
        rows = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("count"), F.max("pad")).collect()
        hot_rows = tiled.where("block_y = 0").count()
        assert sum(r["count"] for r in rows) == ROWS
        assert hot_rows / ROWS > 0.3
        assert max(r["count"] for r in rows) / ROWS < 0.2
    finally:
        spark.conf.unset(key)


def test_hot_step_reaches_the_shuffle_as_one_row_per_task(spark, hot):
    means = spatial.spatial_mean(hot, ["t2m"])
    want = {r[TIME]: r["m"] for r in hot.groupBy(TIME).agg((F.sum("t2m") / F.count("t2m")).alias("m")).collect()}
    got = {r[TIME]: r["t2m"] for r in means.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[avg(") < plan.index("Exchange") < plan.index("functions=[partial_avg(")


def test_hot_month_is_not_sorted_in_one_task(spark, hot):
    anom = windows.anomaly(hot.select(TIME, LONGITUDE, "t2m"), ["t2m"], time=TIME)
    plan = anom._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_avg" in plan
    assert anom.count() == ROWS
    assert abs(anom.agg(F.sum("t2m_anom")).first()[0]) < 1e-5


def test_repeated_cells_are_reported_not_multiplied(spark, hot):
    cells = hot.select(TIME, LATITUDE, LONGITUDE, "t2m")
    doubled = cells.withColumn(LONGITUDE, F.lit(60.0)).withColumn(LATITUDE, F.lit(45.0))
    with pytest.raises(Exception, match="more than once"):
        align.merge_steps(doubled, doubled.withColumnRenamed("t2m", "ssr")).count()
