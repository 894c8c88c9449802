"""Integer positions, stored buckets, packed grids, regions and refreshed months."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from isograd.catalog import LATITUDE, LONGITUDE, REGIONS, TIME, GridAxes, Region
from isograd.operators import cells, packed, partials, regions, spatial
from isograd.plans import testgrids as grids
from isograd.plans.queries import QUERIES
from isograd.sources import cells as stored_cells
from isograd.sources import grid as source
from isograd.sources import refresh
from isograd.sources.grid import explode_grid

SMALL = "/root/testdata/sf0.001"
AXES = GridAxes("2024-01-01 00:00:00", 21_600, 50.0, 0.1, 60.0, 0.1)
T0 = dt.datetime(2024, 1, 1)
H6 = dt.timedelta(hours=6)
GRID = "valid_time timestamp_ntz, latitude double, longitude double, t2m double"


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- Positions ----------------------------------------------------------------


def test_float_and_double_coordinates_have_one_position(spark):
    lat, lon = [50.0 - 0.1 * i for i in range(400)], [60.0 + 0.1 * i for i in range(400)]
    df = spark.createDataFrame([(T0 + i * H6, a, b, 1.0) for i, (a, b) in enumerate(zip(lat, lon, strict=True))], GRID)
    narrow = df.withColumns({c: F.col(c).cast("float").cast("double") for c in (LATITUDE, LONGITUDE)})
    assert narrow.where(F.col(LATITUDE) == 49.9).count() == 0  # the coordinates themselves do not meet
    for grid in (df, narrow):
        got = cells.snap(grid, AXES).orderBy("step").collect()
        assert [(r.step, r.lat_row, r.lon_col) for r in got] == [(i, i, i) for i in range(400)]
    back = cells.unsnap(cells.snap(narrow, AXES), AXES).orderBy(TIME).collect()
    assert [r.latitude for r in back] == pytest.approx(lat) and back[1].valid_time == T0 + H6


@pytest.mark.parametrize(
    "row,what",
    [((T0, 50.03, 60.0, 1.0), "latitude 50.03"), ((T0, 50.0, 60.07, 1.0), "longitude 60.07"), ((T0 + H6 / 2, 50.0, 60.0, 1.0), "2024-01-01 03:00"), ((T0, None, 60.0, 1.0), "latitude null")],
)
def test_a_cell_off_the_grid_is_named(spark, row, what):
    with pytest.raises(Exception, match=what):
        cells.snap(spark.createDataFrame([row], GRID), AXES).collect()


def two(spark, first, second):
    schema = "step long, lat_row long, lon_col long, "
    return spark.createDataFrame(first, schema + "t2m double"), spark.createDataFrame(second, schema + "t2m double, ssr double")


def test_merging_by_position(spark):
    a, b = two(spark, [(0, 0, 0, 1.0), (0, 0, 1, None)], [(0, 0, 0, 9.0, 5.0), (0, 0, 1, 3.0, 6.0), (1, 0, 0, 4.0, 7.0)])
    rows = lambda df: sorted(tuple(r) for r in df.select("step", "lon_col", "t2m", "ssr").collect())
    assert rows(cells.merge_indexed(a, b, "inner")) == sorted([(0, 0, 1.0, 5.0), (0, 1, None, 6.0)], key=repr)
    assert len(rows(cells.merge_indexed(a, b, "full"))) == 3
    with pytest.raises(Exception, match="disagree at 0, 0, 0"):
        cells.merge_indexed(a, b, overlap="no_conflicts").collect()
    filled = cells.merge_indexed(a, b.where("lon_col = 1 or step = 1"), overlap="no_conflicts")
    assert rows(filled) == sorted([(0, 0, 1.0, None), (0, 1, 3.0, 6.0), (1, 0, 4.0, 7.0)], key=repr)
    with pytest.raises(Exception, match="second table holds more than once: 0, 0, 1"):
        cells.merge_indexed(a, b.unionAll(b.where("lon_col = 1"))).collect()
    assert cells.merge_indexed(a.limit(0), b.limit(0)).collect() == []


def test_stored_cells_meet_without_a_shuffle(spark, tmp_path):
    for name, grid in (("a", grids.fine_instant(spark, SMALL)), ("b", grids.fine_accum(spark, SMALL))):
        stored_cells.write_cells(grid, grids.FINE_AXES, f"{tmp_path}/{name}", 4)
    a, b = (stored_cells.read_cells(spark, f"{tmp_path}/{name}") for name in "ab")
    assert a.axes == grids.FINE_AXES and a.buckets == 4
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = cells.merge_indexed(a.cells, b.cells, checked=True)
        assert "Exchange" not in initial(merged) and "SortMergeJoin" in initial(merged)
        assert "Exchange" not in initial(cells.merge_indexed(a.cells, b.cells))  # the check of unique cells needs none either
        loose = cells.merge_indexed(cells.snap(grids.fine_instant(spark, SMALL), AXES), cells.snap(grids.fine_accum(spark, SMALL), AXES))
        assert initial(loose).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, merged.collect())) == sorted(map(key, loose.select(*merged.columns).collect())) and merged.count() == 1500
    box = cells.in_box(a.cells, cells.box_of(Region("r", 49.95, 49.7, 60.1, 60.2), AXES))
    assert "GreaterThanOrEqual(lat_row,1), LessThanOrEqual(lat_row,3" in initial(box)
    assert box.select("lat_row", "lon_col").distinct().count() == 6


def test_stored_cells_refuse_repeated_cells(spark, tmp_path):
    grid = spark.createDataFrame([(T0, 50.0, 60.0, 1.0)] * 2, GRID)
    with pytest.raises(Exception, match="more than once"):
        stored_cells.write_cells(grid, AXES, f"{tmp_path}/x", 2)


def test_a_box_keeps_cells_on_its_bounds(spark):
    for region in (Region("a", 49.9, 49.7, 60.1, 60.3), Region("b", 49.95, 49.65, 60.05, 60.35)):
        assert cells.box_of(region, AXES) == cells.Box(1, 3, 1, 3)
    nothing = cells.box_of(Region("c", 49.98, 49.92, 60.0, 61.0), AXES)
    assert nothing.first_row > nothing.last_row


# --- Packed grids ---------------------------------------------------------------

PACK = "valid_time timestamp_ntz, latitudes array<float>, longitudes array<float>, t2m array<double>, tcc array<double>"


def test_no_cell_becomes_a_row(spark):
    assert "Generate" not in initial(packed.packed_means(spark.createDataFrame([], PACK), {"t2m": packed.Packed("t2m")}, REGIONS["south_asia"]))


@pytest.mark.parametrize("upwards", [False, True])
def test_packed_means_by_hand(spark, upwards):
    lats = [40.0, 30.0, 20.0]
    values = [[9.0, 9.0, 9.0], [1.0, math.nan, 9.0], [3.0, -99.0, None]]
    if upwards:
        lats, values = lats[::-1], values[::-1]
    rows = [(T0, lats, [70.0, 80.0, 110.0], [x for line in values for x in line], None)]
    df = spark.createDataFrame(rows, PACK)
    box = Region("r", 30.0, 20.0, 70.0, 100.0)
    asked = {"t": packed.Packed("t2m", scale=2.0, offset=1.0, fill=-99.0), "c": packed.Packed("tcc")}
    w30, w20 = math.cos(math.radians(30.0)), math.cos(math.radians(20.0))
    got = packed.packed_means(df, asked, box, hot={"h": ("t", 5.0)}).first()
    assert got.t == pytest.approx((3.0 * w30 + 7.0 * w20) / (w30 + w20)) and got.c is None and got.h == 0.25
    plain = packed.packed_means(df, asked, box, weighted=False, hot={"h": ("t", 5.0)}, denominator="present").first()
    assert plain.t == 5.0 and plain.h == 0.5
    assert packed.packed_means(df, asked, Region("none", 10.0, 0.0, 70.0, 80.0)).first().t is None
    assert packed.packed_means(df.limit(0), asked, box).collect() == []


def test_packed_means_equal_those_of_cells(spark):
    gaps = grids.instant_with_gaps(spark, SMALL)
    held = packed.pack_grid(gaps, ["t2m", "tcc"], grids.DENSE_AXES, 5, 5)
    want = {r.valid_time: r for r in spatial.weighted_spatial_mean(gaps, ["t2m", "tcc"]).collect()}
    got = packed.packed_means(held, {"t2m": packed.Packed("t2m"), "tcc": packed.Packed("tcc")}).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.t2m == pytest.approx(want[r.valid_time].t2m) and r.tcc == pytest.approx(want[r.valid_time].tcc)


def test_packed_errors_name_the_step(spark):
    good = (T0, [40.0, 30.0], [70.0], [1.0, 2.0], [1.0, 2.0])
    wrong = spark.createDataFrame([(T0 + H6, [40.0, 30.0], [70.0], [1.0], [1.0, 2.0])], PACK)
    with pytest.raises(Exception, match="t2m does not fill the axes at 2024-01-01 06:00"):
        packed.packed_means(wrong, {"t2m": packed.Packed("t2m")}).collect()
    zigzag = spark.createDataFrame([(T0, [40.0, 10.0, 30.0], [70.0], [1.0, 2.0, 3.0], None)], PACK)
    with pytest.raises(Exception, match="latitudes do not run one way"):
        packed.packed_means(zigzag, {"t2m": packed.Packed("t2m")}, Region("r", 45.0, 20.0, 0.0, 90.0)).collect()
    a = spark.createDataFrame([good], PACK).drop("tcc")
    b = spark.createDataFrame([good], PACK).drop("t2m")
    moved = b.withColumn("latitudes", F.array(F.lit(40.0), F.lit(20.0)))
    with pytest.raises(Exception, match="axes differ at 2024-01-01 00:00"):
        packed.merge_packed(a, moved).collect()
    with pytest.raises(Exception, match="second file holds more than once"):
        packed.merge_packed(a, b.unionAll(b)).collect()
    # a double axis and a float32 axis of the same grid are the same
    wide = b.withColumn("latitudes", F.transform("latitudes", lambda v: v.cast("double") + 1e-9))
    assert packed.merge_packed(a, wide).count() == 1


def test_packed_steps_of_one_file(spark):
    a = spark.createDataFrame([(T0, [40.0], [70.0], [1.0], [2.0])], PACK).drop("tcc")
    b = spark.createDataFrame([(T0 + H6, [40.0], [70.0], [1.0], [2.0])], PACK).drop("t2m")
    asked = {c: packed.Packed(c) for c in ("t2m", "tcc")}
    rows = sorted(map(tuple, packed.explode_packed(packed.merge_packed(a, b, "full"), asked).collect()))
    assert rows == [(T0, 40.0, 70.0, 1.0, None), (T0 + H6, 40.0, 70.0, None, 2.0)]
    assert packed.merge_packed(a, b, "inner").collect() == [] and packed.merge_packed(a, b, "left").count() == 1


def test_packing_places_cells_by_their_position(spark):
    axes = GridAxes("2024-01-01 00:00:00", 21_600, 40.0, 0.1, 70.0, 0.1)
    rows = [(T0, 39.9, 70.2, 5.0), (T0, 40.0, 70.0, 1.0), (T0, 39.7, 70.1, math.nan), (T0 + H6, 39.8, 70.1, 7.0)]
    df = spark.createDataFrame(rows, GRID).withColumns({c: F.col(c).cast("float") for c in (LATITUDE, LONGITUDE)})
    got = packed.pack_grid(df, ["t2m"], axes, 4, 3).orderBy(TIME).collect()
    assert got[0].t2m == [1.0, None, None, None, None, 5.0] + [None] * 6 and got[1].t2m == [None] * 7 + [7.0] + [None] * 4
    assert got[0].latitudes == pytest.approx([40.0, 39.9, 39.8, 39.7]) and got[0].longitudes == pytest.approx([70.0, 70.1, 70.2])
    blocks = packed.pack_grid(df, ["t2m"], axes, 4, 3, block_rows=3)
    assert sorted((r.valid_time, len(r.latitudes), len(r.t2m)) for r in blocks.collect()) == [(t, n, 3 * n) for t in (T0, T0 + H6) for n in (1, 3)]
    back = explode_grid(blocks, "t2m", "t2m")
    assert back.count() == 24 and back.where("t2m is not null").count() == 3
    with pytest.raises(Exception, match="more than once in step 1"):
        packed.pack_grid(df.unionAll(df.where("t2m = 7")), ["t2m"], axes, 4, 3).collect()
    with pytest.raises(Exception, match="outside the axes in step 0"):
        packed.pack_grid(df, ["t2m"], axes, 3, 3).collect()
    assert packed.pack_grid(df.limit(0), ["t2m"], axes, 4, 3).collect() == []


# --- Regions ------------------------------------------------------------------------


def test_regions_need_one_scan_and_no_pair_join(spark):
    df = QUERIES["regions_daily"](spark, SMALL)
    df.collect()
    plan = initial(df).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_regions_count_cells_in_each(spark):
    axes = grids.DENSE_AXES
    grid = grids.instant(spark, SMALL)
    boxes = {"all": Region("a", 90, -90, 0, 360), "left": Region("l", 50, 10, 60, 70), "one": Region("o", 30, 30, 80, 80), "none": Region("n", 9, 5, 0, 1)}
    got = regions.regions_series(grid, axes, boxes, ["t2m"], weighted=False)
    assert {r.region for r in got.select("region").distinct().collect()} == {"all", "left", "one"}
    for name in ("all", "left", "one"):
        b = boxes[name]
        want = {r.valid_time: r.t2m for r in spatial.spatial_mean(grid.where(F.col(LATITUDE).between(b.south, b.north) & F.col(LONGITUDE).between(b.west, b.east)), ["t2m"]).collect()}
        mine = {r.valid_time: r.t2m for r in got.where(F.col("region") == name).collect()}
        assert mine == pytest.approx(want)


# --- Refreshed months ---------------------------------------------------------------


def months(spark, path, out, seen):
    def reduce_fn(cells_):
        seen.append(sorted((r.year, r.month) for r in cells_.select("year", "month").distinct().collect()))
        return partials.daily_partials(spatial.spatial_mean(cells_, ["t2m"]), ["t2m"])

    found = refresh.refresh_months(spark, path, out, reduce_fn, {"of": "t2m"})
    days = partials.merge_partials(found.partials, ["t2m"], ["year", "month"])
    return found, {(r.year, r.month): r.t2m for r in days.collect()}


def test_only_changed_months_are_read(spark, tmp_path):
    path, out, seen = f"{tmp_path}/grid", f"{tmp_path}/out", []
    month = lambda m, v: spark.createDataFrame([(dt.datetime(2024, m, d), 10.0, 20.0, v) for d in (1, 2)], GRID)
    source.write_grid(month(1, 1.0).unionAll(month(2, 2.0)), path)
    found, days = months(spark, path, out, seen)
    assert found.computed == [(2024, 1), (2024, 2)] and days == {(2024, 1): 1.0, (2024, 2): 2.0}
    found, days = months(spark, path, out, seen)
    assert found.computed == [] and len(seen) == 1 and days == {(2024, 1): 1.0, (2024, 2): 2.0}
    source.write_grid(month(3, 3.0), path, mode="append")
    found, days = months(spark, path, out, seen)
    assert found.computed == seen[-1] == [(2024, 3)] and days[2024, 3] == 3.0 and len(days) == 3
    source.write_grid(month(2, 5.0), path, replace_months=True)
    found, days = months(spark, path, out, seen)
    assert found.computed == seen[-1] == [(2024, 2)] and days == {(2024, 1): 1.0, (2024, 2): 5.0, (2024, 3): 3.0}


def test_a_month_without_rows_or_files_leaves_nothing(spark, tmp_path):
    path, out = f"{tmp_path}/grid", f"{tmp_path}/out"
    rows = [(dt.datetime(2024, m, 1), 10.0, 20.0, float(m)) for m in (1, 2)]
    source.write_grid(spark.createDataFrame(rows, GRID), path)

    def from_two(least):
        def reduce_fn(cells_):
            return partials.daily_partials(spatial.spatial_mean(cells_.where(F.col("t2m") >= least), ["t2m"]), ["t2m"])

        return sorted(r.month for r in refresh.refresh_months(spark, path, out, reduce_fn, {}).partials.collect())

    assert from_two(0.0) == [1, 2]
    source.write_grid(spark.createDataFrame([(dt.datetime(2024, 1, 1), 10.0, 20.0, -1.0)], GRID), path, replace_months=True)
    assert from_two(0.0) == [2]  # January has changed and has no rows any more; the old ones do not count


def test_an_interrupted_refresh_is_made_up(spark, tmp_path):
    path, out, seen = f"{tmp_path}/grid", f"{tmp_path}/out", []
    source.write_grid(spark.createDataFrame([(dt.datetime(2024, 1, 1), 10.0, 20.0, 1.0)], GRID), path)

    def lost(_):
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        refresh.refresh_months(spark, path, out, lost, {"of": "t2m"})
    assert months(spark, path, out, seen)[0].computed == [(2024, 1)]
    other = refresh.refresh_months(spark, path, out, lambda c: partials.daily_partials(spatial.spatial_mean(c, ["t2m"]), ["t2m"]), {"of": "another"})
    assert other.computed == [(2024, 1)]
