"""Label and fire-history windows, confidence filter, radius edges."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderfield.contract import EARTH_RADIUS_M, HUMAN, TARGET, LabelSettings
from cinderfield.operators.fire import filter_confidence, fire_history, fire_labels, packed, place_history, with_history
from cinderfield.operators.spatial import radius_windows
from cinderfield.plans.risk_dataset import Sources, build_dataset

LAT, LON = 39.5, 32.85
OBS = "2025-06-01"
ONE_METRE_DEG = math.degrees(1.0 / EARTH_RADIUS_M)


def cells(spark, rows=((LAT, LON, OBS),)):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "cell_id int, lat double, lon double, obs_date string")


def hotspots(spark, rows, confidence=True):
    if confidence:
        rows = [r if len(r) == 4 else (*r, "nominal") for r in rows]
        return spark.createDataFrame(rows, "latitude double, longitude double, acq_date string, confidence string")
    return spark.createDataFrame([r[:3] for r in rows], "latitude double, longitude double, acq_date string")


def label(spark, fires, obs=OBS):
    out = fire_labels(cells(spark, ((LAT, LON, obs),)), fires).collect()
    assert len(out) == 1
    return out[0][TARGET], out[0]["firms_density_1yr"], out[0]["days_since_last_fire"]


@pytest.mark.parametrize(
    "when, expected",
    [
        ("2025-06-01", 0),
        ("2025-06-02", 1),
        ("2025-06-15", 1),
        ("2025-07-01", 1),
        ("2025-07-02", 0),
        ("2025-07-01 12:00:00", 0),
        ("2025-06-01 12:00:00", 0),
        ("2025-05-20", 0),
    ],
)
def test_label_window_edges(spark, when, expected):
    assert label(spark, hotspots(spark, [(LAT, LON, when)])) == (expected, 0.0, 3650.0)


@pytest.mark.parametrize(
    "when, density, days",
    [
        ("2025-05-01", 1.0, 31.0),  # right edge, inclusive
        ("2025-05-02", 0.0, 3650.0),  # inside the buffer
        ("2024-06-01", 1.0, 365.0),  # left edge, inclusive
        ("2024-05-31", 0.0, 366.0),  # too old to count, still the last fire
        ("2025-04-01", 1.0, 61.0),
        ("2025-04-30 12:00:00", 1.0, 31.5),
        ("2010-01-01", 0.0, 3650.0),  # clipped
    ],
)
def test_history_window_edges(spark, when, density, days):
    assert label(spark, hotspots(spark, [(LAT, LON, when)])) == (0, density, days)


def test_observation_with_a_time_of_day(spark):
    obs = cells(spark, ((LAT, LON, "2025-06-01 06:00:00"),))
    days = ("2025-07-01 05:00:00", "2025-07-01 07:00:00", "2025-05-01 05:59:59", "2025-05-01 06:00:01")
    fires = hotspots(spark, [(LAT, LON, d) for d in days])
    with pytest.raises(Exception, match="exact_times"):
        fire_labels(obs, fires).collect()
    row = fire_labels(obs, fires, exact_times=True).first()
    assert (row[TARGET], row["firms_density_1yr"]) == (1, 1.0)
    assert row["days_since_last_fire"] == pytest.approx(31 + 1 / 86_400)


def test_times_within_a_day_fold_without_changing_the_result(spark):
    days = [f"2025-04-{d:02d} {h:02d}:30:00" for d in (28, 29, 30) for h in range(24)] + ["2025-05-01", "2025-05-01 00:00:01"]
    fires = hotspots(spark, [(LAT, LON, d) for d in days])
    folded = fire_labels(cells(spark), fires).first()
    exact = fire_labels(cells(spark), fires, exact_times=True).first()
    assert folded == exact and folded["firms_density_1yr"] == 73.0 and folded["days_since_last_fire"] == 31.0


def test_copies_count_and_the_latest_fire_wins(spark):
    fires = [(LAT, LON, "2025-03-01")] * 3 + [(LAT, LON, "2025-04-01"), (LAT + 0.01, LON, "2025-04-01")]
    assert label(spark, hotspots(spark, fires)) == (0, 5.0, 61.0)


@pytest.mark.parametrize("metres, inside", [(9_900, 1), (10_100, 0), (9_999.9, 1), (10_000.1, 0)])
def test_radius_edge_north(spark, metres, inside):
    fires = hotspots(spark, [(LAT + metres * ONE_METRE_DEG, LON, "2025-06-10")])
    assert label(spark, fires)[0] == inside


def test_cells_are_independent(spark):
    two = cells(spark, ((39.5, LON, OBS), (40.0, LON, OBS)))
    out = fire_labels(two, hotspots(spark, [(39.5, LON, "2025-06-10")])).orderBy("cell_id").collect()
    assert [r[TARGET] for r in out] == [1, 0]


def test_confidence_levels(spark):
    levels = ["l", "low", " N ", "nominal", "h", "HIGH", "85", None, "nan"]
    fires = spark.createDataFrame([(i, c) for i, c in enumerate(levels)], "i int, confidence string")
    assert sorted(r["i"] for r in filter_confidence(fires).collect()) == [2, 3, 4, 5]
    assert filter_confidence(fires.drop("confidence")).count() == len(levels)
    assert [r["i"] for r in filter_confidence(fires, ("Low",)).orderBy("i").collect()] == [0, 1]


def test_low_confidence_is_dropped_and_missing_column_keeps_all(spark):
    assert label(spark, hotspots(spark, [(LAT, LON, "2025-06-10", "low")]))[0] == 0
    assert label(spark, hotspots(spark, [(LAT, LON, "2025-06-10")], confidence=False))[0] == 1


def test_empty_hotspots_give_defaults(spark):
    assert label(spark, hotspots(spark, [])) == (0, 0.0, 3650.0)


def test_null_dates_give_defaults(spark):
    fires = hotspots(spark, [(LAT, LON, None), (LAT, LON, "2025-06-10")])
    obs = cells(spark, ((LAT, LON, None), (LAT, LON, OBS)))
    out = {r["obs_date"]: r for r in fire_labels(obs, fires).collect()}
    assert (out[None][TARGET], out[None]["firms_density_1yr"], out[None]["days_since_last_fire"]) == (0, 0.0, 3650.0)
    assert out[OBS][TARGET] == 1


def test_null_coordinates_fail(spark):
    with pytest.raises(Exception, match="null or NaN coordinate"):
        fire_labels(cells(spark), hotspots(spark, [(None, LON, "2025-06-10")])).collect()
    with pytest.raises(Exception, match="null or NaN coordinate"):
        fire_labels(cells(spark), hotspots(spark, [(float("nan"), LON, "2025-06-10")])).collect()


def test_repeated_observation_rows_are_kept(spark):
    obs = cells(spark, ((LAT, LON, OBS),) * 4 + ((LAT, LON, "2025-07-01"),))
    out = fire_labels(obs, hotspots(spark, [(LAT, LON, "2025-06-10")])).orderBy("cell_id").collect()
    assert [r[TARGET] for r in out] == [1, 1, 1, 1, 0]


def test_other_windows(spark):
    s = LabelSettings(label_days=10, buffer_days=5, history_days=20, radius_m=1000.0)
    fires = hotspots(spark, [(LAT, LON, d) for d in ("2025-06-11", "2025-05-27", "2025-05-12", "2025-05-11")])
    row = fire_labels(cells(spark), fires, s).first()
    assert (row[TARGET], row["firms_density_1yr"], row["days_since_last_fire"]) == (1, 2.0, 5.0)


def brute_force(obs, fires, s=LabelSettings()):
    day = 86_400.0
    out = {}
    for lat, lon, date in obs:
        t0 = datetime.fromisoformat(date).timestamp()
        near = []
        for flat, flon, fdate, _ in fires:
            a = math.sin(math.radians(flat - lat) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(
                math.radians(flat)
            ) * math.sin(math.radians(flon - lon) / 2) ** 2
            if 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a)) <= s.radius_m:
                near.append((datetime.fromisoformat(fdate).timestamp() - t0) / day)
        past = [d for d in near if d <= -s.buffer_days]
        out[(lat, lon, date)] = (
            int(any(1 <= d <= s.label_days for d in near)),
            float(sum(-s.history_days <= d <= -s.buffer_days for d in near)),
            min(3650.0, -max(past)) if past else 3650.0,
        )
    return out


@pytest.mark.parametrize(
    "partitions, rows_per_slice", [(1, 20_000), (8, 200), (5, 7), (3, 2)]
)
def test_against_brute_force_with_hot_bins(spark, partitions, rows_per_slice):
    """A third of the hotspots share one bin; slicing and partitioning must not change the result."""
    import random

    rng = random.Random(5)
    fires = []
    for i in range(600):
        near = i % 3 == 0
        lat = 39.5 + rng.uniform(-0.02, 0.02) if near else rng.uniform(39.0, 40.0)
        lon = 32.85 + rng.uniform(-0.02, 0.02) if near else rng.uniform(32.3, 33.4)
        fires.append((lat, lon, f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", "high"))
    obs = [
        (39.5 + rng.uniform(-0.3, 0.3), 32.85 + rng.uniform(-0.3, 0.3), d)
        for _ in range(40)
        for d in ("2024-06-01", "2025-01-01")
    ]
    table = spark.createDataFrame(obs, "lat double, lon double, obs_date string").repartition(partitions)
    got = fire_history(table, hotspots(spark, fires).repartition(partitions), rows_per_slice=rows_per_slice)
    got = {
        (r["lat"], r["lon"], r["obs_date"].date().isoformat()): (
            r[TARGET],
            r["firms_density_1yr"],
            r["days_since_last_fire"],
        )
        for r in got.collect()
    }
    assert got == brute_force(obs, fires)


def test_radius_join_is_an_equi_join(spark):
    obs = cells(spark)
    plan = fire_labels(obs, hotspots(spark, [(LAT, LON, OBS)]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_numeric_confidence_maps_only_where_bounds_are_given(spark):
    given = ["l", " N ", "high", "0", "29.9", "30", "79", "80", "100", "101", "-1", "x", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(given)], "i int, confidence string")
    plain = {r["i"] for r in filter_confidence(df).collect()}
    mapped = {r["i"] for r in filter_confidence(df, numeric_bounds=(30.0, 80.0)).collect()}
    assert plain == {1, 2} and mapped == {1, 2, 5, 6, 7, 8}
    assert {r["i"] for r in filter_confidence(df, ("low",), (30.0, 80.0)).collect()} == {0, 3, 4}


def test_no_row_for_place_and_date_moves(spark):
    """A place's history at all dates is one row; rows meet it before they are expanded by date."""
    fires = hotspots(spark, [(LAT, LON, f"2024-{m:02d}-10") for m in range(1, 13)] + [(40.0, LON, "2024-06-10")])
    table = spark.createDataFrame([(1, LAT, LON), (2, 40.0, LON), (3, 45.0, LON), (1, LAT, LON)], "cell_id int, lat double, lon double")
    dates = [int(datetime(2024, m, 1).timestamp() - datetime(1970, 1, 1).timestamp()) * 1_000_000 for m in range(1, 13)]
    places = table.selectExpr("lat as _plat", "lon as _plon").distinct()
    rows = place_history(places, dates, fires).collect()
    assert sorted(r["_plat"] for r in rows) == [LAT, 40.0] and all(len(r["_past"]) == 12 for r in rows)
    dated = with_history(table, fires, "2024-01-01", "2024-12-31")
    exact = fire_labels(dated.select("cell_id", "lat", "lon", "obs_date"), fires, exact_times=True)
    assert dated.count() == 48 and sorted(map(str, dated.collect())) == sorted(map(str, exact.collect()))
    settings = LabelSettings(start="2024-01-01", end="2024-12-31")
    plan = build_dataset(table, Sources(hotspots=fires), 250.0, LAT, settings).table._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")


def test_cells_of_one_task_are_dealt_out_before_they_become_rows(spark):
    table = spark.range(200).selectExpr("id as cell_id", "39 + id / 1000 as lat", "30D as lon").coalesce(1)
    built = build_dataset(table, Sources(), 250.0, LAT, LabelSettings(start="2024-01-01", end="2024-03-31"))
    assert built.table.count() == 600 and len(built.table.inputFiles()) > 1


def test_observations_of_a_place_meet_its_history_as_one_row(spark):
    nan, rows = float("nan"), []
    for i, lat in enumerate((LAT, LAT, LAT, 40.0, LAT, None, None, nan, nan, 0.0, -0.0)):
        rows.append((i, lat, LON, None if i == 1 else f"t{i}", [i] if i % 2 else None))
    df = spark.createDataFrame(rows, "id long, lat double, lon double, note string, more array<int>").coalesce(1)
    one = packed(df, ["lat", "lon"])
    assert [r["id"] for r in one.collect()] == [[0, 1, 2], [3], [4], [5], [6], [7], [8], [9], [10]]
    back = one.select("lat", "lon", F.explode(F.arrays_zip("id", "note", "more")).alias("r")).select("r.id", "lat", "lon", "r.note", "r.more")
    assert list(map(str, back.collect())) == list(map(str, df.collect()))

    days = spark.range(12).selectExpr("cast(id + 1 as string) as day", "cast(null as string) as note")
    places = spark.createDataFrame([(1, LAT, 33), (2, 40.0, 33), (1, LAT, 33)], "cell_id int, lat double, lon int")
    obs = places.crossJoin(days).selectExpr("cell_id", "lat", "lon", "date'2024-01-01' + cast(day as int) * 30 as obs_date", "note").orderBy("lat")
    fires = hotspots(spark, [(LAT, 33.0, f"2024-{m:02d}-10") for m in range(1, 13)])
    labelled = fire_labels(obs, fires)
    assert sorted(map(str, labelled.collect())) == sorted(map(str, fire_labels(obs, fires, exact_times=True).collect()))
    assert labelled.select(obs.columns).schema == obs.schema and labelled.count() == 36
    plan = fire_labels(obs, fires)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join") < plan.index("MapInArrow")  # packed before it moves


def test_windows_need_the_latest_time_only(spark):
    """Which end a point lies before follows from its time, so that end does not move; points after all ends are in no window."""
    places = spark.createDataFrame([(LAT, LON), (45.0, LON)], "_plat double, _plon double")
    points = spark.createDataFrame([(LAT, LON, 2, 5), (LAT, LON + 1e-3, 1, 7), (LAT, LON, 4, 100)], "latitude double, longitude double, _n long, _at long")
    ends = np.array([[10, 6, 5, 0], [20, 10, 10, 5]], np.int64)
    (row,) = radius_windows(places, points, 10_000.0, ends, ("_plat", "_plon")).collect()
    assert (row["_ahead"], row["_past"], row["_last"]) == ([True, False], [2, 1], [5, 7])
    assert radius_windows(places, points.filter("_at > 20"), 10_000.0, ends, ("_plat", "_plon")).count() == 0


def test_stored_rows_hold_nothing_that_follows_from_their_key(spark):
    table = spark.createDataFrame([(1, LAT, LON), (2, 40.0, LON), (2, 40.0, LON)], "cell_id int, lat double, lon double")
    fires, settings = hotspots(spark, [(LAT, LON, "2024-02-10")]), LabelSettings(start="2024-01-01", end="2024-06-30")
    plain, stored = (build_dataset(table, Sources(hotspots=fires), 250.0, LAT, settings, stored=s).table for s in (False, True))
    assert stored.dtypes == plain.dtypes and sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    written = spark.read.parquet(*stored.inputFiles())
    assert written.count() == 18 and TARGET in written.columns and not set(HUMAN) & set(written.columns)
