"""Radius bins on the whole sphere: poles, antimeridian, random points; counts."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderfield.contract import EARTH_RADIUS_M
from cinderfield.operators import circles
from cinderfield.operators.fire import fold_times
from cinderfield.operators.spatial import block_cover, joined_sides, radius_count, radius_fold, radius_pairs


def distance(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(
        math.radians(b[0])
    ) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def sphere_points(rng, n):
    out = []
    for i in range(n):
        kind = i % 5
        if kind == 0:  # poles
            out.append((rng.choice([-1, 1]) * rng.uniform(88.5, 90.0), rng.uniform(-180, 180)))
        elif kind == 1:  # antimeridian
            out.append((rng.uniform(-5, 5), rng.choice([-1, 1]) * rng.uniform(178.5, 180.0)))
        elif kind == 2:  # high latitude
            out.append((rng.uniform(69, 71), rng.uniform(20, 24)))
        elif kind == 3:  # cluster
            out.append((40 + rng.gauss(0, 0.05), 30 + rng.gauss(0, 0.05)))
        else:
            out.append((rng.uniform(-3, 3), rng.uniform(-3, 3)))
    return out


@pytest.mark.parametrize("radius_m, rows_per_slice", [(120_000.0, 20_000), (120_000.0, 5), (10_000.0, 20_000)])
def test_pairs_match_brute_force(spark, radius_m, rows_per_slice):
    rng = random.Random(11)
    left, right = sphere_points(rng, 250), sphere_points(rng, 250)
    c = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "i int, lat double, lon double")
    p = spark.createDataFrame([(j, *q) for j, q in enumerate(right)], "j int, latitude double, longitude double")
    rows = radius_pairs(c, p, radius_m, rows_per_slice=rows_per_slice, with_distance=True).collect()
    got = [(r["i"], r["j"]) for r in rows]
    want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if distance(a, b) <= radius_m}
    assert len(got) == len(set(got))
    assert set(got) == want
    for r in rows:
        assert r["distance_m"] == pytest.approx(distance(left[r["i"]], right[r["j"]]), abs=1e-3)


def test_points_on_180_and_minus_180_are_neighbours(spark):
    c = spark.createDataFrame([(0.0, 180.0), (0.0, -180.0)], "lat double, lon double")
    p = spark.createDataFrame([(0.0, -179.99), (0.0, 179.99)], "latitude double, longitude double")
    assert radius_pairs(c, p, 10_000.0).count() == 4


def test_pole_sees_every_longitude(spark):
    c = spark.createDataFrame([(90.0, 0.0)], "lat double, lon double")
    p = spark.range(36).select(F.lit(89.95).alias("latitude"), (F.col("id") * 10.0).alias("longitude"))
    assert radius_pairs(c, p, 10_000.0).count() == 36


def test_counts(spark):
    c = spark.createDataFrame([(1, 39.5, 32.85), (2, 39.5, 32.85), (3, 10.0, 10.0)], "i int, lat double, lon double")
    four_km, fifteen_km = 4 / 111.195, 15 / 111.195
    p = spark.createDataFrame(
        [(39.5 + four_km, 32.85)] * 3 + [(39.5 + fifteen_km, 32.85)], "latitude double, longitude double"
    )
    got = {r["i"]: r["n_points"] for r in radius_count(c, p, 10_000.0).collect()}
    assert got == {1: 3, 2: 3, 3: 0}
    assert {r["n_points"] for r in radius_count(c, p.limit(0), 10_000.0).collect()} == {0}


def test_null_coordinate_fails(spark):
    c = spark.createDataFrame([(None, 32.85)], "lat double, lon double")
    p = spark.createDataFrame([(39.5, 32.85)], "latitude double, longitude double")
    with pytest.raises(Exception, match="null or NaN"):
        radius_pairs(c, p, 10_000.0).collect()
    with pytest.raises(Exception, match="null or NaN"):
        radius_count(c, p, 10_000.0).collect()


@pytest.mark.parametrize("rows_per_slice, split_rows", [(20_000, 256), (5, 256), (1, 3), (20_000, 20)])
def test_folded_counts_match_brute_force_on_the_sphere(spark, rows_per_slice, split_rows):
    rng = random.Random(12)
    left, right = sphere_points(rng, 200), sphere_points(rng, 400)
    right += [(40 + rng.gauss(0, 0.01), 30 + rng.gauss(0, 0.01)) for _ in range(200)]
    c = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "i int, lat double, lon double")
    p = spark.createDataFrame(right, "latitude double, longitude double")
    got = radius_count(c, p, 30_000.0, rows_per_slice=rows_per_slice, split_rows=split_rows)
    want = {i: sum(distance(a, b) <= 30_000.0 for b in right) for i, a in enumerate(left)}
    assert {r["i"]: r["n_points"] for r in got.collect()} == want


def test_every_block_folds_without_limits(spark):
    # More crowded blocks than any list on the driver would hold: 12,000 of three points each.
    p = spark.range(36_000).selectExpr("((id % 12000) div 120) * 0.2 as latitude", "((id % 12000) % 120) * 0.2 + (id div 12000) * 1e-4 as longitude")
    c = spark.createDataFrame([(1, 10.0, 12.0), (2, 0.0, 0.0)], "i int, lat double, lon double")
    got = {r["i"]: r["n_points"] for r in radius_count(c, p, 30_000.0).collect()}
    want = {i: sum((distance((lat, lon), (a * 0.2, b * 0.2 + k * 1e-4)) <= 30_000.0) for a in range(100) for b in range(120) for k in range(3))
            for i, lat, lon in ((1, 10.0, 12.0), (2, 0.0, 0.0))}
    assert got == want
    plan = radius_count(c, p, 30_000.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan


def test_cover_takes_coarse_blocks_inside_and_fine_ones_along_the_rim(spark):
    """About 1,300 points to a circle of 10 km: a divided cover asks for under 80 blocks and tests fewer points."""
    step = 0.00443  # half a kilometre
    points = spark.range(160 * 160).selectExpr(
        f"40 + (id div 160) * {step} as latitude", f"30 + (id % 160) * {step} / cos(radians(40)) as longitude", "0L as _t", "1L as _n", "cast(null as long) as _at"
    )
    places = spark.range(25).selectExpr("40.2 + (id div 5) * 0.061 as lat", "30.25 + (id % 5) * 0.083 as lon")
    tested = {}
    for split_rows in (50, 10**6):
        cover = block_cover(places, points, 10_000.0, ("lat", "lon"), split_rows=split_rows)
        asked = cover.asked.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_bin") % 2 == 0).alias("whole")).collect()
        assert len(asked) == 25 and max(r["n"] for r in asked) < 80 and all(r["whole"] > 0 for r in asked)
        tested[split_rows] = cover.asked.where("_bin % 2 = 1").join(cover.offered, "_bin").count() / 25
    assert tested[50] < 0.7 * tested[10**6]


def test_circles_test_points_along_the_rim_only():
    """Sixteen times the points cost far less than sixteen times the tests, and sums equal those of all pairs."""
    tested = []
    for n in (10_000, 160_000):
        rng = np.random.default_rng(3)
        lat, lon, step, at = rng.uniform(40, 40.6, n), rng.uniform(30, 30.8, n), rng.integers(0, 5, n), rng.integers(0, 99, n)
        tree = circles.BlockTree(lat, lon, step, np.full(n, 2), at, 10_000.0)
        places = rng.uniform(40.2, 40.4, 20), rng.uniform(30.3, 30.5, 20)
        sums, latest = tree.fold(*places, 5)
        for i, (a, b) in enumerate(zip(*places, strict=True)):
            near = circles.distance_m(a, b, lat, lon) <= 10_000.0
            assert sums[i].tolist() == [2 * int((near & (step == s)).sum()) for s in range(5)]
            assert latest[i].tolist() == [int(at[near & (step == s)].max()) for s in range(5)]
        tested.append(tree.tested)
    assert tested[1] < 6 * tested[0]


def test_no_pair_of_place_and_day_is_a_row(spark):
    """Detections of 2,000 days around one place, three window ends: at most three rows per place come out."""
    days = spark.range(2000).selectExpr("40 + id * 1e-6 as latitude", "30D as longitude", "id * 86400000000 as _at")
    ends = np.array([5, 700, 1999]) * 86_400_000_000
    points = fold_times(days, ends).withColumn("_n", F.lit(1).cast("long"))
    places = spark.createDataFrame([(40.0, 30.0)], "lat double, lon double")
    rows = radius_fold(places, points, 10_000.0, ("lat", "lon"), merged=False).orderBy("_t").collect()
    assert [(r["_t"], r["_n"], r["_at"]) for r in rows] == [(int(e), n, int(e)) for e, n in zip(ends, (6, 695, 1299), strict=True)]


def test_the_smaller_side_of_a_radius_join_is_copied(spark):
    few = spark.range(10).selectExpr("40 + id / 100 as lat", "30D as lon")
    many = spark.range(3000).selectExpr("40 + id / 30000 as latitude", "30D as longitude")
    for a, b, cols in ((few, many, [("lat", "lon"), ("latitude", "longitude")]), (many, few, [("latitude", "longitude"), ("lat", "lon")])):
        pairs = radius_pairs(a, b, 5_000.0, *cols)
        assert pairs.count() == sum(distance((40 + i / 100, 30), (40 + j / 30000, 30)) <= 5_000.0 for i in range(10) for j in range(3000))
        assert 3000 in [side.count() for side in joined_sides(a, b, 5_000.0, *cols)]
