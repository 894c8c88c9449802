"""Stored blocks, exact sums, conflicting files, and documents compared path by path."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, TIME
from isograd.operators import exact, layout, spatial, windows
from isograd.plans import testgrids as grids
from isograd.plans.queries import LAYOUTS
from isograd.sources import blocks, conflicts, documents
from isograd.sources.tables import write_summary

SMALL = "/root/testdata/sf0.001"
AXES = grids.DENSE_AXES
T0 = dt.datetime(2024, 1, 1)
GRID = "valid_time timestamp_ntz, latitude double, longitude double, t2m double"


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- Layouts --------------------------------------------------------------------


@pytest.mark.parametrize("name,keys", [("balanced", ["block_t", "block_y", "block_x"]), ("space_first", ["block_y", "block_x"])])
def test_rows_of_a_block_are_in_one_partition(spark, name, keys):
    """Small blocks are not cut; without the layout their rows lie in several partitions."""
    cells = grids.instant(spark, SMALL).repartition(6)

    def places(df):
        return {r.places for r in df.withColumn("_p", F.spark_partition_id()).groupBy(*keys).agg(F.count_distinct("_p").alias("places")).collect()}

    assert places(LAYOUTS[name](cells)) == {1}
    sizes = {"kt": 120 if "block_t" in keys else None, "ky": 2, "kx": 2}
    assert max(places(layout.with_blocks(cells, AXES, **sizes))) > 1


def asked_rows():
    return [
        ("box", T0, T0 + dt.timedelta(days=2), 40.0, 30.0, 70.0, 80.0), ("span", T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=1), 90.0, -90.0, -10.0, 400.0),
        ("off the map", T0, T0, 5.0, 0.0, 0.0, 1.0), ("before", T0 - dt.timedelta(days=9), T0 - dt.timedelta(days=8), 90.0, -90.0, 0.0, 360.0),
    ]


@pytest.mark.parametrize("sizes", [{"kt": 8, "ky": 2, "kx": 3}, {"kt": 4}, {"ky": 1, "kx": 2}])
def test_asked_boxes_come_from_their_blocks_alone(spark, tmp_path, sizes):
    grid = grids.instant(spark, SMALL)
    blocks.write_blocks(grid, AXES, f"{tmp_path}/grid", **sizes)
    stored = blocks.read_blocks(spark, f"{tmp_path}/grid")
    assert stored.axes == AXES and list(stored.sizes.values()) == list(sizes.values())
    rows = asked_rows()
    asked = blocks.store_asked(spark, rows, f"{tmp_path}/asked")
    got = blocks.read_asked(stored, asked)
    assert "dynamicpruning" in initial(got) and "NestedLoop" not in initial(got)
    want = []
    for name, start, end, north, south, west, east in rows:
        inside = F.col(TIME).between(F.lit(start), F.lit(end)) & F.col(LATITUDE).between(south, north) & F.col(LONGITUDE).between(west, east)
        want += [(name, *r) for r in grid.where(inside).collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 50
    # folders that nobody asked for are not opened: files that are no Parquet do no harm there
    touched = {tuple(r) for r in blocks.blocks_of(asked.where("name = 'box'"), AXES, stored.sizes).select(*stored.sizes).collect()}
    spoilt = 0
    for file in glob.glob(f"{tmp_path}/grid/cells/**/*.parquet", recursive=True):
        place = tuple(int(part.split("=")[1]) for part in file.split("/") if part.startswith("block_"))
        if place not in touched:
            with open(file, "wb") as f:
                f.write(b"nothing")
            spoilt += 1
    only = blocks.store_asked(spark, rows[:1], f"{tmp_path}/only")
    fresh = blocks.StoredBlocks(spark.read.schema(stored.cells.schema).parquet(f"{tmp_path}/grid/cells"), AXES, stored.sizes)
    assert spoilt and sorted(map(tuple, blocks.read_asked(fresh, only).collect())) == sorted(r for r in want if r[0] == "box")


@pytest.mark.parametrize("sizes", [{"kt": 1, "ky": 2, "kx": 2}, {"kt": 1}, {"kt": 2, "kx": 1}])
def test_many_blocks_share_folders(spark, tmp_path, sizes):
    """The number of folders follows the rows, not the blocks; asked boxes come from the folders of their blocks alone."""
    steps = spark.range(-20, 400).select((F.lit(T0) + F.make_dt_interval(hours=6 * F.col("id"))).cast("timestamp_ntz").alias(TIME))
    map_ = spark.range(15).select((50.0 - 10.0 * F.floor(F.col("id") / 3)).alias(LATITUDE), (60.0 + 10.0 * (F.col("id") % 3)).alias(LONGITUDE))
    grid = steps.crossJoin(map_).withColumn("t2m", F.hash(TIME, LATITUDE, LONGITUDE) / 7)
    lost = spark.createDataFrame([(None, 10.0, 60.0, 1.0), (T0, None, None, 2.0)], GRID)
    grid = grid.unionAll(grid.limit(5)).unionAll(lost).cache()
    blocks.write_blocks(grid, AXES, f"{tmp_path}/grid", **sizes)
    stored = blocks.read_blocks(spark, f"{tmp_path}/grid")
    folders = {os.path.dirname(f) for f in glob.glob(f"{tmp_path}/grid/cells/**/*.parquet", recursive=True)}
    assert 4 < len(folders) <= 1.5 * blocks.FOLDERS and list(stored.sizes.values()) == list(sizes.values())
    assert stored.cells.count() == grid.count() == 420 * 15 + 7
    rows = [*asked_rows(), ("late", T0 + dt.timedelta(days=80), T0 + dt.timedelta(days=81), 30.0, 20.0, 60.0, 60.0), ("all", T0, T0 + dt.timedelta(days=999), 90.0, -90.0, 0.0, 360.0)]
    for some in (rows, rows[:1]):
        asked = blocks.store_asked(spark, some, f"{tmp_path}/asked{len(some)}")
        got = blocks.read_asked(stored, asked)
        assert "dynamicpruning" in initial(got) and "NestedLoop" not in initial(got)
        assert got.columns == ["name", *grid.columns]
        want = []
        for name, start, end, north, south, west, east in some:
            inside = F.col(TIME).between(F.lit(start), F.lit(end)) & F.col(LATITUDE).between(south, north) & F.col(LONGITUDE).between(west, east)
            want += [(name, *r) for r in grid.where(inside).collect()]
        assert sorted(map(tuple, got.collect())) == sorted(want) and want
        for folder in folders if some is rows else ():  # all but those of the first steps are no Parquet for the last reading
            if not any(f"block_t={k}/" in folder + "/" for k in range(10)):
                for file in glob.glob(f"{folder}/*.parquet"):
                    with open(file, "wb") as f:
                        f.write(b"nothing")


# --- Exact sums --------------------------------------------------------------------


def test_exact_means_do_not_depend_on_order(spark):
    rng = random.Random(4)
    values = [rng.choice([1e7, -1e7, 300.0, 1e-3]) * rng.random() for _ in range(4000)] + [None, 0.0, -0.0]
    held = [None if v is None else Fraction(int(Fraction(v) * 2**38 // 1), 2**38) for v in values]
    want = float(sum(v for v in held if v is not None) * 2**38) / (4002 * 2.0**38)
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(1, v) for v in values], "k int, v double").repartition(seed + 1)
        seen.add(exact.exact_means(exact.exact_sums(df, {"v": F.col("v")}, ["k"]), ["v"], ["k"]).first().v)
    assert seen == {want}
    true = sum(Fraction(v) for v in values if v is not None) / 4002
    assert abs(Fraction(want) - true) < Fraction(1, 2**37)


def test_float32_values_are_held_exactly(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(2.0**e, 2.0 ** (e + 1)) * rng.choice([-1, 1]),) for e in range(-14, 25) for _ in range(20)]
    cut = exact.limbs(F.col("v").cast("float"))
    got = spark.createDataFrame(rows, "v double").select(F.col("v").cast("float").cast("double").alias("v"), cut[0].alias("a"), cut[1].alias("b"))
    assert all(Fraction(r.v) == Fraction(r.a, 2**8) + Fraction(r.b, 2**38) for r in got.collect())


def test_exact_sums_can_be_added_and_have_limits(spark):
    df = spark.createDataFrame([(i % 3, i % 2, float(i)) for i in range(60)] + [(9, 9, None)], "a int, b int, v double")
    fine = exact.exact_sums(df, {"v": F.col("v")}, ["a", "b"])
    got = {r.a: r.v for r in exact.exact_means(exact.add_sums(fine, ["v"], ["a"]), ["v"], ["a"]).collect()}
    assert got == {0: 28.5, 1: 29.5, 2: 30.5, 9: None}
    with pytest.raises(Exception, match="too large for an exact sum"):
        exact.exact_sums(df.withColumn("v", F.lit(2.0**25)), {"v": F.col("v")}, ["a"]).collect()


def test_exact_spatial_means_are_the_usual_ones(spark):
    gaps = grids.instant_with_gaps(spark, SMALL)
    for weighted, usual in ((True, spatial.weighted_spatial_mean), (False, spatial.spatial_mean)):
        want = {r.valid_time: r.t2m for r in usual(gaps, ["t2m"]).collect()}
        got = {r.valid_time: r.t2m for r in exact.exact_spatial_mean(gaps, ["t2m"], weighted).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_a_result_that_depends_on_the_layout_is_seen(spark):
    cells = grids.instant(spark, SMALL)
    two = {"a": lambda df: df, "b": lambda df: df.withColumn("t2m", F.col("t2m") + F.when(F.col(TIME) == F.lit(T0), 1e-13 * 2**10).otherwise(0.0))}
    got = exact.same_under_layouts(cells, two, lambda df: df.groupBy(TIME).agg(F.max("t2m").alias("t2m")), TIME).collect()
    assert [r.valid_time for r in got if not r.same] == [T0] and len(got) == 40


# --- Rows numbered by stored sizes -------------------------------------------------


def test_stored_bucket_sizes_number_the_same_rows(spark, tmp_path):
    cells = grids.instant(spark, SMALL).select(TIME, LATITUDE, LONGITUDE, "t2m")
    cell = [LATITUDE, LONGITUDE]
    windows.bucket_sizes(cells, TIME, partition=cell).write.parquet(f"{tmp_path}/sizes")
    sizes = spark.read.parquet(f"{tmp_path}/sizes")
    asked = dict(columns={"t2m": "r"}, before=3, after=2, min_periods=6, order=TIME, partition=cell)
    one, other = windows.rolling_mean(cells, **asked), windows.rolling_mean(cells, **asked, sizes=sizes)
    rows = lambda df: sorted(tuple(r) for r in df.collect() if r.r is not None)
    assert rows(one) == rows(other)
    assert initial(other).split("== Initial Plan ==")[0].count("FileScan parquet [event_id") == 1


# --- Conflicts -----------------------------------------------------------------------


def test_conflicts_are_named_with_their_files(spark, tmp_path):
    def cell(lon, value):
        return (T0, 10.0, lon, value)

    parts = {"a": [cell(0.0, 1.0), cell(1.0, 2.0), cell(2.0, None), cell(3.0, 4.0)], "b": [cell(0.0, 1.0), cell(1.0, 5.0), cell(2.0, 3.0)], "c": [cell(1.0, 5.0), cell(4.0, float("nan"))]}
    for name, rows in parts.items():
        spark.createDataFrame(rows, GRID).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    extra = spark.createDataFrame([(T0, 10.0, 0.0, "x", 7.0)], "valid_time timestamp_ntz, latitude double, longitude double, note string, tcc double")
    extra.write.parquet(f"{tmp_path}/d")
    agreed, found = conflicts.open_conflicts(spark, [f"{tmp_path}/{n}" for n in "abcd"], ["t2m", "tcc"])
    assert sorted((r.longitude, r.t2m, r.tcc) for r in agreed.collect() if r.t2m) == [(0.0, 1.0, 7.0), (2.0, 3.0, None), (3.0, 4.0, None)]
    assert agreed.count() == 4 and agreed.where("longitude = 4").first().t2m is None
    (r,) = found.collect()
    assert (r.longitude, r.variable, r.low_value, r.high_value, r.files) == (1.0, "t2m", 2.0, 5.0, 3)
    assert "/a/" in r.low_file and "/c/" in r.high_file
    assert found.columns == list(conflicts.CONFLICT)


# --- Documents -----------------------------------------------------------------------


def test_documents_are_walked_to_their_leaves(spark, tmp_path):
    doc = spark.sql(
        "SELECT 1 AS n, named_struct('x', 2.5D, 'deep', named_struct('ok', true, 'word', 'a', 'none', CAST(NULL AS DOUBLE))) AS s,"
        " array(named_struct('v', 1.0D, 'w', array('p', 'q')), named_struct('v', 2.0D, 'w', array())) AS list, array(1, 2) AS `odd name`, CAST(NULL AS ARRAY<INT>) AS gone"
    )
    write_summary(doc, f"{tmp_path}/doc")
    got = {r.path: r.text if r.number is None else r.number for r in documents.leaves(documents.read_document(spark, f"{tmp_path}/doc")).collect()}
    want = {
        "n": 1.0, "s.x": 2.5, "s.deep.ok": "true", "s.deep.word": "a", "s.deep.none": None, "list[0].v": 1.0, "list[0].w[0]": "p", "list[0].w[1]": "q",
        "list[1].v": 2.0, "odd name[0]": 1.0, "odd name[1]": 2.0, "gone": None,
    }
    assert got == want


def test_documents_differ_by_path(spark):
    a = spark.sql("SELECT 1.0D AS near, 1.0D AS far, 'x' AS word, array(1, 2) AS list, CAST(NULL AS DOUBLE) AS none, 5 AS kind, 1 AS mine")
    b = spark.sql("SELECT 1.001D AS near, 2.0D AS far, 'y' AS word, array(1) AS list, CAST(NULL AS DOUBLE) AS none, '5' AS kind, 1 AS yours")
    got = {r.path: r.status for r in documents.document_diff(a, b, atol=0.01).collect()}
    assert got == {
        "near": "same", "far": "different", "word": "different", "list[0]": "same", "list[1]": "first only", "none": "same", "kind": "different",
        "mine": "first only", "yours": "second only",
    }
    assert {r.status for r in documents.document_diff(a, a).collect()} == {"same"}
