"""Formulas, grid, dates, tiles, rasters, weather."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderfield.functions import scalars
from cinderfield.functions import weather as formulas
from cinderfield.operators import grid, raster, weather


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_vpd(spark):
    rows = [(20.0, 100.0), (80.0, 1.0), (25.0, 50.0), (25.0, 120.0), (None, 50.0), (float("nan"), 50.0)]
    got = [v for (v,) in values(spark, rows, "t double, rh double", formulas.vpd(F.col("t"), F.col("rh")))]
    assert got[0] == 0.0 and got[1] == 10.0 and got[3] == 0.0
    assert got[2] == pytest.approx(0.6112 * math.exp(17.67 * 25 / 268.5) * 0.5)
    assert got[4] is None and got[5] is None


def test_ffmc(spark):
    rows = [(t, rh, w) for t in (-10.0, 20.0, 45.0) for rh in (0.0, 5.0, 50.0, 100.0) for w in (0.0, 5.0, 20.0)]
    col = formulas.ffmc(F.col("t"), F.col("rh"), F.col("w"))
    for (t, rh, w), (got,) in zip(rows, values(spark, rows, "t double, rh double, w double", col)):
        h = min(max(rh, 5.0), 100.0)
        ed = 0.942 * h**0.679 + 11 * math.exp((h - 100) / 10) + 0.18 * (21.1 - t) * (1 - math.exp(-0.115 * h))
        m0 = 147.2 * (101 - 85) / (59.5 + 85)
        m = ed + (m0 - ed) * math.exp(-1 - 0.0365 * w * 3.6)
        assert got == pytest.approx(min(max(59.5 * (250 - m) / (147.2 + m), 0.0), 101.0), abs=1e-9)


def test_dryness_orders_fuel_moisture(spark):
    rows = [(25.0, rh, 3.0) for rh in (10.0, 30.0, 60.0, 90.0)]
    got = [v for (v,) in values(spark, rows, "t double, rh double, w double", formulas.ffmc(F.col("t"), F.col("rh"), F.col("w")))]
    assert got == sorted(got, reverse=True)


def test_hash_uniform_does_not_depend_on_partitions(spark):
    def draw(n):
        rows = spark.range(2000).repartition(n).select("id", scalars.hash_uniform(F.col("id"), 7, "x").alias("u"))
        return {r["id"]: r["u"] for r in rows.collect()}

    one = draw(1)
    assert one == draw(7)
    assert 0.47 < np.mean(list(one.values())) < 0.53 and max(one.values()) < 1.0


def test_epoch_us_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = values(spark, [("2024-03-10 02:30:00.25",)], "s string", scalars.epoch_us(scalars.as_timestamp(F.col("s"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == [(1710037800250000,)]


def test_reference_region_grid(spark):
    cells = grid.grid_cells(spark, (32.7, 39.4, 33.0, 39.6), 250.0)
    rows = cells.orderBy("cell_id").collect()
    step_lat = 250.0 * 360.0 / 40_075_017.0
    lats = np.arange(39.4 + step_lat / 2, 39.6, step_lat)
    step_lon = step_lat / math.cos(math.radians(39.5))
    lons = np.arange(32.7 + step_lon / 2, 33.0, step_lon)
    assert len(rows) == 9167 == len(lats) * len(lons)
    want = [(la, lo) for la in lats for lo in lons]
    assert np.allclose([(r["lat"], r["lon"]) for r in rows], want, atol=1e-10)


def test_coarse_grid_has_one_cell_and_matches_area_grid(spark):
    box = (32.7, 39.4, 33.0, 39.6)
    only = grid.grid_cells(spark, box, 1e6).collect()
    assert [(r["lat"], r["lon"]) for r in only] == [(39.5, 32.85)]
    areas = spark.createDataFrame([("a", *box)], "area_id string, lon_min double, lat_min double, lon_max double, lat_max double")
    for resolution in (1e6, 5000.0):
        a = {(r["cell_id"], round(r["lat"], 9), round(r["lon"], 9)) for r in grid.grid_cells(spark, box, resolution).collect()}
        b = {(r["cell_id"], round(r["lat"], 9), round(r["lon"], 9)) for r in grid.grid_cells_by_area(areas, resolution).collect()}
        assert a == b


def test_obs_dates(spark):
    months = [r["obs_date"] for r in grid.obs_dates(spark, "2024-01-15", "2025-12-31").collect()]
    assert len(months) == 24 and str(months[0]) == "2024-01-01 00:00:00"
    weeks = [r["obs_date"] for r in grid.obs_dates(spark, "2024-01-01", "2025-12-31", "2W").collect()]
    assert len(weeks) == 52 and str(weeks[0].date()) == "2024-01-07" and all(d.weekday() == 6 for d in weeks)
    assert str(grid.obs_dates(spark, "2023-01-01", "2023-01-31", "1W").first()[0].date()) == "2023-01-01"
    assert grid.obs_dates(spark, "2024-01-02", "2023-12-01").count() == 0
    with pytest.raises(ValueError, match="frequency"):
        grid.obs_dates(spark, "2024-01-01", "2024-02-01", "D")


def test_cells_at_dates_needs_no_join(spark):
    dated = grid.at_dates(grid.grid_cells(spark, (32.7, 39.4, 33.0, 39.6), 5000.0), "2024-01-01", "2024-03-31")
    assert dated.count() == 3 * grid.grid_cells(spark, (32.7, 39.4, 33.0, 39.6), 5000.0).count()
    assert "Join" not in dated._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", ["1,2,3", "33,39,32,40", "32,40,33,39", "32,39,32,40"])
def test_bad_bbox(text):
    with pytest.raises(ValueError):
        grid.parse_bbox(text)


def test_tile_names(spark):
    areas = spark.createDataFrame(
        [(1, 32.7, 39.4, 33.0, 39.6), (2, -0.5, -0.5, 0.5, 0.5), (3, 32.2, 39.2, 33.4, 40.1)],
        "area_id int, lon_min double, lat_min double, lon_max double, lat_max double",
    )

    def names(scheme, area):
        rows = grid.tile_cover(areas, scheme).filter(F.col("area_id") == area)
        return sorted(r["tile_name"] for r in rows.collect())

    assert names("elevation", 1) == ["Copernicus_DSM_COG_10_N39_00_E032_00_DEM"]
    assert names("land_cover", 1) == [f"ESA_WorldCover_10m_2021_v200_N39E{e}_Map" for e in ("030", "033")]
    assert names("elevation", 2) == [
        f"Copernicus_DSM_COG_10_{la}_00_{lo}_00_DEM" for la in ("N00", "S01") for lo in ("E000", "W001")
    ]
    assert len(names("elevation", 3)) == 4


def pixel_table(spark, z):
    rows = [(r, c, float(z[r, c])) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(rows, "row_ix int, col_ix int, elevation double")


def gradient(z, res, lat):
    dy, dx = np.gradient(z, res, res / math.cos(math.radians(lat)))
    slope = np.degrees(np.arctan(np.hypot(dx, dy)))
    return slope, (np.degrees(np.arctan2(-dx, dy)) + 360) % 360


@pytest.mark.parametrize("shape", [(8, 8), (2, 5), (5, 2)])
def test_slope_aspect_matches_numpy(spark, shape):
    z = np.random.default_rng(3).uniform(900, 1600, shape)
    slope, aspect = gradient(z, 250.0, 39.5)
    rows = raster.slope_aspect(pixel_table(spark, z), 250.0, 39.5).collect()
    assert len(rows) == z.size
    for r in rows:
        assert r["slope_deg"] == pytest.approx(slope[r["row_ix"], r["col_ix"]], abs=1e-9)
        assert r["aspect_deg"] == pytest.approx(aspect[r["row_ix"], r["col_ix"]], abs=1e-9)


def test_slope_of_simple_surfaces(spark):
    flat = raster.slope_aspect(pixel_table(spark, np.full((4, 4), 1000.0)), 250.0, 39.5)
    assert {r["slope_deg"] for r in flat.collect()} == {0.0}
    east_west = np.tile(np.arange(10) * 20.0, (5, 1))

    def mean_slope(z, lat):
        return raster.slope_aspect(pixel_table(spark, z), 250.0, lat).agg(F.avg("slope_deg")).first()[0]

    assert 1.05 < mean_slope(east_west, 0.0) / mean_slope(east_west, 39.5) < 1.5
    assert mean_slope(east_west.T, 0.0) == pytest.approx(mean_slope(east_west.T, 60.0))
    single = raster.slope_aspect(pixel_table(spark, np.array([[1.0, 2.0]])), 250.0, 0.0)
    assert all(r["slope_deg"] is None for r in single.collect())


def test_sampling_clamps_to_the_edge(spark):
    z = np.arange(12.0).reshape(3, 4)
    t = raster.Transform(x0=30.0, y0=40.0, dx=0.1, dy=-0.1, height=3, width=4)
    where = [(39.95, 30.05), (39.75, 30.35), (50.0, 0.0), (0.0, 90.0), (39.85, 30.15)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(where)], "i int, lat double, lon double")
    got = [r["elevation"] for r in raster.sample(df, pixel_table(spark, z), t).orderBy("i").collect()]
    assert got == [0.0, 11.0, 0.0, 11.0, 5.0]


def test_land_cover_flags(spark):
    codes = [10, 20, 30, 40, 50, 60, 90, 100, 70, 80, 95, None]
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    flags = raster.land_cover_flags(F.col("code"))
    rows = df.select("code", raster.is_unmapped(F.col("code")).alias("u"), *[c.alias(n) for n, c in flags.items()]).collect()
    for i, r in enumerate(rows):
        marks = [r[n] for n in flags]
        assert marks == [int(i == k) for k in range(8)] and r["u"] == int(i >= 8)


def test_terrain_needs_one_shuffle_and_only_pixels_near_cells(spark, tmp_path):
    z = np.arange(400.0).reshape(20, 20) ** 1.5
    pixel_table(spark, z).write.parquet(str(tmp_path / "z"))
    stored = spark.read.parquet(str(tmp_path / "z"))
    grid_ = raster.Transform(x0=30.0, y0=40.0, dx=0.1, dy=-0.1, height=20, width=20)
    cells = spark.createDataFrame([(1, 39.05, 31.05), (2, 38.95, 31.25)], "i int, lat double, lon double")
    value = [c for c in stored.columns if c not in ("row_ix", "col_ix")][0]
    near = raster.around(stored, cells, grid_)
    assert 0 < near.count() < 40
    part = raster.terrain(near, 250.0, 39.0, value)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "GreaterThanOrEqual(row_ix" in plan
    whole = {(r["row_ix"], r["col_ix"]): tuple(r) for r in raster.terrain(stored, 250.0, 39.0, value).collect()}
    for r in raster.sample(cells, part, grid_).collect():
        at = (9, 10) if r["i"] == 1 else (10, 12)
        assert (r["elevation_m"], r["slope_deg"], r["aspect_sin"]) == whole[at][2:5]
    assert raster.around(stored, cells.limit(0), grid_).count() == 0


def test_mosaic_first_valid_tile_wins(spark):
    pixels = spark.createDataFrame(
        [("a", 0, 0, 1.0), ("a", 0, 1, None), ("b", 0, 0, 2.0), ("b", 0, 1, 3.0)],
        "tile_id string, row_ix int, col_ix int, z double",
    )
    tiles = spark.createDataFrame([("a", 0, 0, 0), ("b", 1, 0, 0)], "tile_id string, tile_seq int, row_off int, col_off int")
    out = raster.mosaic(pixels, tiles, ["z"])
    assert {(r["row_ix"], r["col_ix"]): r["z"] for r in out.collect()} == {(0, 0): 1.0, (0, 1): 3.0}
    assert out._jdf.queryExecution().executedPlan().toString().count("partial_min") >= 1


def test_mosaic_merges_each_band_alone(spark):
    rows = [("a", 0, 0, 1.0, None), ("b", 0, 0, 2.0, 3), ("a", 0, 1, None, None), ("b", 0, 2, None, 4)]
    pixels = spark.createDataFrame(rows, "tile_id string, row_ix int, col_ix int, `z m` double, code int")
    tiles = spark.createDataFrame([("a", 0, 0, 0), ("b", 1, 0, 0)], "tile_id string, tile_seq int, row_off int, col_off int")
    out = raster.mosaic(pixels, tiles, ["z m", "code"])
    assert {r["col_ix"]: (r["z m"], r["code"]) for r in out.collect()} == {0: (1.0, 3), 2: (None, 4)}


def test_crop(spark):
    z = np.arange(20.0).reshape(4, 5)
    t = raster.Transform(x0=30.0, y0=40.0, dx=0.1, dy=-0.1, height=4, width=5)
    kept, moved = raster.crop(pixel_table(spark, z), t, (30.15, 39.65, 30.4, 39.9))
    got = {(r["row_ix"], r["col_ix"]): r["elevation"] for r in kept.collect()}
    assert got == {(r, c): z[r + 1, c + 1] for r in range(3) for c in range(3)}
    assert (moved.x0, moved.y0, moved.height, moved.width) == (pytest.approx(30.1), pytest.approx(39.9), 3, 3)


def hours(spark, rows):
    return spark.createDataFrame(rows, "time_utc string, temp_c double, rh_pct double, wind_speed_ms double, wind_dir_deg double")


def test_attach_weather(spark):
    w = hours(spark, [("2024-01-01", 10.0, 40.0, 2.0, 350.0), ("2024-01-02", 20.0, None, 4.0, 10.0)])
    cells = spark.createDataFrame([(1,), (2,)], "i int")
    rows = weather.attach_weather(cells, w).collect()
    assert len(rows) == 2
    assert (rows[0]["temp_c"], rows[0]["rh_pct"], rows[0]["wind_speed_ms"]) == (15.0, 40.0, 3.0)
    assert rows[0]["wind_dir_cos"] == pytest.approx(-1.0)  # plain mean of directions: 180
    assert weather.attach_weather(cells, w, "circular").first()["wind_dir_cos"] == pytest.approx(1.0)
    kept = weather.attach_weather(cells.withColumns({c: F.lit(5.0) for c in ("temp_c", "rh_pct", "vpd_kpa")}), w.limit(0))
    assert (kept.first()["temp_c"], kept.first()["vpd_kpa"]) == (5.0, 5.0)


def test_explode_hourly(spark):
    schema = (
        "id int, hourly struct<time:array<string>,temperature_2m:array<double>,relative_humidity_2m:array<double>,"
        "windspeed_10m:array<double>,winddirection_10m:array<double>>"
    )
    payload = spark.createDataFrame([(1, (["2024-01-01T00:00", "2024-01-01T01:00"], [1.0, 2.0], [50.0, 51.0], [3.6, 7.2], [0.0, 90.0]))], schema)
    rows = weather.explode_hourly(payload, "kmh").orderBy("time_utc").collect()
    assert [(str(r["time_utc"]), r["temp_c"], round(r["wind_speed_ms"], 9)) for r in rows] == [
        ("2024-01-01 00:00:00", 1.0, 1.0),
        ("2024-01-01 01:00:00", 2.0, 2.0),
    ]
    assert weather.explode_hourly(payload, "ms").orderBy("time_utc").first()["wind_speed_ms"] == 3.6
    with pytest.raises(ValueError, match="hourly"):
        weather.explode_hourly(payload.drop("hourly"), "ms")
    with pytest.raises(ValueError, match="wind_unit"):
        weather.explode_hourly(payload, "knots")
