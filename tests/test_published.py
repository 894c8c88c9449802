"""Arithmetic of published result tables, a few values retyped."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isograd.functions import units
from isograd.operators import compare

# Month, ssr, str, tisr, tsr, net radiation, reflected solar (W m⁻², rounded to 4 places).
CLIMATOLOGY = [
    (1, 27.4631, -12.3517, 50.2652, 38.9547, 15.1115, 11.3106),
    (2, 32.2780, -13.0638, 57.5996, 45.4156, 19.2142, 12.1840),
    (3, 36.3295, -13.4815, 64.7180, 51.0736, 22.8480, 13.6444),
]


def test_derived_radiation(spark):
    names = "month int, ssr double, str_nlw double, tisr double, tsr double, net double, reflected double"
    rows = spark.createDataFrame(CLIMATOLOGY, names).select(
        "net",
        "reflected",
        units.net_radiation(F.col("ssr"), F.col("str_nlw")).alias("got_net"),
        units.reflected_solar(F.col("tisr"), F.col("tsr")).alias("got_reflected"),
    )
    for r in rows.collect():
        assert r.got_net == pytest.approx(r.net, abs=1.5e-4)
        assert r.got_reflected == pytest.approx(r.reflected, abs=1.5e-4)


@pytest.mark.parametrize(
    "differing,mean,rmse", [(4, 1.0928961748705477e-06, 1.0454167469854823e-05), (11, 3.0054644808770194e-06, 1.733627549642576e-05)]
)
def test_agreement_of_two_rounded_runs(spark, differing, mean, rmse):
    """366 days, some of which differ by one unit of the fourth place."""
    first = dt.date(2024, 1, 1)
    ref = [(first + dt.timedelta(days=i), 20.0 + i / 100) for i in range(366)]
    cand = [(d, v + (1e-4 if i % 30 == 7 and i // 30 < differing else 0.0)) for i, (d, v) in enumerate(ref)]
    a, b = (spark.createDataFrame(rows, "time date, ssr double") for rows in (ref, cand))
    (r,) = compare.compare_tables(a, b).collect()
    assert (r.rows_compared, r.pass_rate, r.passed) == (366, 1.0, True)
    assert r.mae == pytest.approx(mean, rel=1e-6)
    assert r.rmse == pytest.approx(rmse, rel=1e-6)
    assert r.max_abs == pytest.approx(1e-4, rel=1e-6)
    (c,) = compare.consistency(a, b).collect()
    assert (c.rows_compared, c.mean_abs_diff) == (366, pytest.approx(mean, rel=1e-6))


def test_runs(spark):
    runs = spark.createDataFrame(
        [("poor", 127.96, 22.49), ("revised", 61.585, 22.49)], "name string, elapsed_s double, value double"
    )
    (r,) = compare.run_delta(runs, "poor", "revised", "value").collect()
    assert (r.speedup, r.value_abs_diff) == (2.078, 0.0)
    shapes = [("time_heavy", 126.339), ("balanced", 74.687), ("tiny_chunks", 124.438)]
    (r,) = compare.best_worst(spark.createDataFrame(shapes, "name string, elapsed_s double")).collect()
    assert (r.runs, r.best, r.best_elapsed_s, r.worst, r.worst_elapsed_s) == (3, "balanced", 74.687, "time_heavy", 126.339)
