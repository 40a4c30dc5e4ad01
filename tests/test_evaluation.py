"""Order statistics, splits, folds, metrics, placeholders, contract."""

import hashlib
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinderfield import contract
from cinderfield.contract import FEATURES, LAND_COVER, TARGET
from cinderfield.operators import metrics, ordered, placeholders, quality, splits


def frame(spark, rows, schema, partitions=3):
    return spark.createDataFrame(rows, schema).repartition(partitions)


@pytest.mark.parametrize(("partitions", "rows", "block"), [(1, 50_000, 1000), (6, 50, 1000), (6, 20, 3)])
def test_running_sums_with_skewed_keys(spark, monkeypatch, partitions, rows, block):
    monkeypatch.setattr(ordered, "RANGES_PER_BLOCK", block)
    rng = random.Random(1)
    keys = sorted({rng.choice([0.01 + i * 1e-9 for i in range(300)] + [float(i) for i in range(300)]) for _ in range(900)})
    given = [(k, rng.randint(0, 9)) for k in keys]
    df = frame(spark, given, "k double, n int", partitions)
    for descending in (False, True):
        out = ordered.running_sums(df, "k", ["n"], descending=descending, rows_per_range=rows).collect()
        total, want = 0, {}
        for k, n in sorted(given, reverse=descending):
            total += n
            want[k] = total
        assert {r["k"]: r["run_n"] for r in out} == want
        assert {r["tot_n"] for r in out} == {total}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=500), np.full(400, 0.25), rng.exponential(5, 101)])
    df = frame(spark, [(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
    q = [0.0, 0.1, 0.2, 0.25, 0.5, 0.8, 0.85, 0.99, 1.0]
    assert ordered.exact_quantiles(df, "v", q) == pytest.approx(list(np.quantile(x, q)), abs=1e-12)
    assert ordered.exact_quantiles(df.limit(0), "v", q) == []


@pytest.mark.parametrize("tied", [False, True])
@pytest.mark.parametrize("k", [2, 5])
def test_latitude_bands_match_qcut(spark, tied, k):
    rng = random.Random(4)
    lats = [round(rng.uniform(39.4, 39.6), 2 if tied else 6) for _ in range(300)] + [39.5] * (90 if tied else 0)
    out = splits.latitude_bands(frame(spark, list(enumerate(lats)), "i int, lat double"), k).toPandas().sort_values("i")
    want = pd.qcut(pd.Series(lats), q=k, labels=False, duplicates="drop")
    assert out["fold"].tolist() == want.tolist()


def test_constant_latitude_has_no_band(spark):
    out = splits.latitude_bands(frame(spark, [(1, 39.5), (2, 39.5), (3, None)], "i int, lat double"), 5)
    assert {r["fold"] for r in out.collect()} == {None}


def test_folds_cover_and_do_not_overlap(spark):
    rng = random.Random(6)
    rows = [(i, rng.uniform(39.4, 39.6), int(i % 7 == 0)) for i in range(300)] + [(900, None, 1)]
    folded = splits.spatial_folds(frame(spark, rows, "i int, lat double, y int"), 5, "lat", "y")
    seen = []
    for fold in range(5):
        val = {r["i"] for r in splits.validation_rows(folded, fold).collect()}
        train = {r["i"] for r in splits.training_rows(folded, fold).collect()}
        assert not val & train and len(val) + len(train) == 301 and 900 in train
        seen += val
    assert sorted(seen) == list(range(300))
    summary = {r["fold"]: r for r in splits.fold_summary(folded, "y").collect()}
    assert sum(r["n_val"] for r in summary.values()) == 300
    assert all(r["n_val"] + r["n_train"] == 301 and r["usable"] == 1 for r in summary.values())


@pytest.mark.parametrize("positives, requested, planned", [(100, 5, 5), (24, 5, 4), (19, 5, 3), (3, 5, 2), (0, 5, 2), (50, 1, 2)])
def test_fold_plan(spark, positives, requested, planned):
    df = spark.range(200).select((F.col("id") < positives).cast("int").alias("y"))
    row = splits.fold_plan(df, requested, "y").first()
    assert (row["n_pos"], row["k_planned"]) == (positives, planned)


def test_missing_fold_columns(spark):
    with pytest.raises(ValueError, match="lat"):
        splits.spatial_folds(spark.range(3).withColumn("y", F.lit(1)), 5, "lat", "y")


def test_rank_bands_are_even(spark):
    df = spark.range(103).select("id", F.lit(39.5).alias("lat"))
    out = splits.rank_bands(df, 5, "lat", "id")
    sizes = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert sizes == [20, 20, 21, 21, 21]


def test_stratified_split(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = splits.stratified_split(df.repartition(1), "id", "y", seed=42).toPandas()
    many = splits.stratified_split(df.repartition(9), "id", "y", seed=42).toPandas()
    other = splits.stratified_split(df, "id", "y", seed=43).toPandas()
    key = lambda p: dict(zip(p["id"], p["split"]))
    assert key(one) == key(many) != key(other)
    assert one.groupby(["y", "split"]).size().to_dict() == {
        (0, "test"): 180, (0, "train"): 540, (0, "val"): 180, (1, "test"): 20, (1, "train"): 60, (1, "val"): 20,
    }


@pytest.mark.parametrize("bin_rows", [0, 10, 10_000])
def test_split_limits_are_selected_digit_by_digit(spark, bin_rows):
    rows = [(f"k{i % 900}", 1 if i % 5 == 0 else (0 if i % 7 else None)) for i in range(1000)]  # some keys twice
    df = frame(spark, rows, "id string, y int")
    out = splits.stratified_split(df, "id", "y", 0.15, 0.3, bin_rows=bin_rows).toPandas()
    hashed = out.assign(h=[hashlib.md5(f"{k}|42".encode()).hexdigest() for k in out["id"]], cls=out["y"].fillna(-1))
    for _, part in hashed.groupby("cls"):
        order = sorted(part["h"])
        n_test = math.ceil(len(order) * 0.15 - 1e-9)
        test, val = order[n_test - 1], order[n_test + math.ceil(len(order) * 0.3 - 1e-9) - 1]
        want = ["test" if h <= test else "val" if h <= val else "train" for h in part["h"]]
        assert part["split"].tolist() == want


def test_ranking_scans_its_input_once(spark, tmp_path):
    frame(spark, [(i % 2, (i * 7919 % 100_003) / 1e5) for i in range(30_000)], "y int, p double").write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(p):
        read.add(1)
        return p

    scored = spark.read.parquet(str(tmp_path / "t")).select("y", seen("p").alias("p"))
    metrics.roc_auc(scored).collect()
    assert read.value == 30_000


def test_split_of_tiny_and_unlabelled_classes(spark):
    rows = [(i, None if i < 3 else int(i == 3)) for i in range(12)]
    out = splits.stratified_split(frame(spark, rows, "id int, y int"), "id", "y").toPandas()
    assert len(out) == 12 and out["split"].notna().all()
    assert out[out["id"] == 3]["split"].tolist() == ["test"]


def test_sample_and_order_are_reproducible(spark):
    df = spark.range(500)
    a = [r["id"] for r in splits.bounded_sample(df.repartition(1), "id", 50, 0).collect()]
    b = [r["id"] for r in splits.bounded_sample(df.repartition(7), "id", 50, 0).collect()]
    assert a == b and len(set(a)) == 50 and a != sorted(a)
    assert splits.bounded_sample(df, "id", 2000).count() == 500
    assert [r["id"] for r in splits.first_rows(df, "id", 3).collect()] == [0, 1, 2]


def reference_ranking(y, p):
    pos, neg = [s for s, t in zip(p, y) if t], [s for s, t in zip(p, y) if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for s in sorted(set(p), reverse=True):
        tp = sum(t for q, t in zip(p, y) if q >= s)
        ap += (tp - seen) / len(pos) * tp / sum(q >= s for q in p)
        seen = tp
    return auc, ap


@pytest.mark.parametrize("digits", [1, 2, 8])
def test_ranking_metrics(spark, digits):
    rng = random.Random(digits)
    y = [int(rng.random() < 0.3) for _ in range(400)]
    p = [round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * t, 0.2))), digits) for t in y]
    row = metrics.ranking_metrics(frame(spark, list(zip(y, p)), "y int, p double")).first()
    auc, ap = reference_ranking(y, p)
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert row["average_precision"] == pytest.approx(ap, abs=1e-12)


def test_ranking_metrics_by_group(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9), ("c", 0, 0.5)]
    out = {r["g"]: r for r in metrics.ranking_metrics(frame(spark, rows, "g string, y int, p double"), by=["g"]).collect()}
    assert (out["a"]["roc_auc"], out["b"]["roc_auc"]) == (1.0, 0.0)
    assert math.isnan(out["c"]["roc_auc"]) and out["c"]["average_precision"] == 0.0


def test_threshold_metrics(spark):
    rows = [(1, 0.5), (1, 0.4), (0, 0.6), (0, 0.1), (1, 0.9)]
    r = metrics.threshold_metrics(frame(spark, rows, "y int, p double")).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 1, 2)
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (
        pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 0.6,
    )
    none = metrics.threshold_metrics(frame(spark, rows, "y int, p double").limit(0)).first()
    assert (none["tp"], none["precision"], none["f1"], none["n_samples"]) == (0, 0.0, 0.0, 0)


def test_weighted_logloss(spark):
    df = frame(spark, [(1, 0.8), (0, 0.3), (0, 1.0)], "y int, p double")
    want = -(3 * math.log(0.8) + math.log(0.7) - 100) / 3
    assert metrics.weighted_logloss(df, 3.0).first()["logloss"] == pytest.approx(want)
    assert math.isnan(metrics.weighted_logloss(df.limit(0)).first()["logloss"])


def test_class_weight(spark):
    def weight(pos, neg, strict):
        df = spark.createDataFrame([(1,)] * pos + [(0,)] * neg, "y int")
        return metrics.class_weight(df, "y", strict).first()["weight"]

    assert (weight(50, 50, True), weight(10, 90, True), weight(0, 10, False), weight(10, 0, True)) == (1.0, 9.0, 10.0, 1.0)
    with pytest.raises(Exception, match="no positive"):
        weight(0, 10, True)


def test_cv_summary(spark):
    folds = spark.createDataFrame([(0.8, 1), (0.6, 1), (0.1, 0)], "roc_auc double, usable int")
    r = metrics.cv_summary(folds, ["roc_auc"]).first()
    assert (r["cv_n_folds"], r["cv_roc_auc_mean"], r["cv_roc_auc_std"]) == (2, pytest.approx(0.7), pytest.approx(0.1))
    r = metrics.cv_summary(folds.filter("usable = 2"), ["roc_auc"]).first()
    assert tuple(r) == (0, 0.0, 0.0)


def test_score_parity(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, None), (4, 0.1)], "k int, p double")
    b = spark.createDataFrame([(1, 0.5005), (2, 0.51), (3, None), (5, 0.1)], "k int, p double")
    r = metrics.score_parity(a, b, "k").first()
    assert (r["n_rows"], r["n_violations"]) == (5, 3)


def test_attribution_rank(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -3.0), ("b", 0.5), ("c", -9.0)], "feature string, phi double")
    assert [(r["feature"], r["mean_abs"]) for r in metrics.attribution_rank(df, 2).collect()] == [("c", 9.0), ("a", 2.0)]


@pytest.fixture(scope="module")
def synthetic(spark):
    return placeholders.synthetic_dataset(spark.range(4000), "id").toPandas()


def test_placeholder_distributions(synthetic):
    d = synthetic
    assert d[FEATURES].notna().all().all()
    assert (d[LAND_COVER].sum(axis=1) == 1).all()
    assert d["lc_tree_cover"].mean() == pytest.approx(0.40, abs=0.03)
    assert d["lc_moss_lichen"].mean() == pytest.approx(0.02, abs=0.01)
    assert d["slope_deg"].mean() == pytest.approx(45 * 2 / 7, abs=0.6)
    assert d["temp_c"].mean() == pytest.approx(25.0, abs=0.5) and d["temp_c"].std() == pytest.approx(8.0, abs=0.5)
    assert d["wind_speed_ms"].mean() == pytest.approx(3.0, abs=0.2)
    assert d["firms_density_1yr"].mean() == pytest.approx(0.3, abs=0.04)
    assert d["picnic_area"].mean() == pytest.approx(0.05, abs=0.015)
    assert d[TARGET].mean() == pytest.approx(0.15, abs=0.005)
    for f in contract.fields():
        assert d[f.name].between(f.low, f.high).all(), f.name


def test_placeholders_depend_on_key_and_seed_only(spark):
    def draw(n, seed):
        out = placeholders.placeholder_features(spark.range(50).repartition(n), "id", seed)
        return out.toPandas().sort_values("id").reset_index(drop=True)

    assert draw(1, 42).equals(draw(5, 42))
    assert not draw(1, 42).equals(draw(1, 43))
    empty = placeholders.synthetic_dataset(spark.range(0), "id")
    assert empty.count() == 0 and empty.columns == ["id", *FEATURES, TARGET]


def test_label_follows_the_features_passed_in(spark):
    base = placeholders.placeholder_features(spark.range(400), "id")
    changed = base.withColumn("vpd_kpa", F.when(F.col("id") < 60, 10.0).otherwise(0.0))
    a = {r["id"] for r in placeholders.quantile_label(base).filter(f"{TARGET} = 1").collect()}
    b = {r["id"] for r in placeholders.quantile_label(changed).filter(f"{TARGET} = 1").collect()}
    assert a != b and len(b & set(range(60))) > len(a & set(range(60)))


def test_contract_shape():
    assert len(FEATURES) == 24 and len(contract.fields()) == 25
    schema = contract.schema()
    assert [f.name for f in schema.fields] == FEATURES + [TARGET]
    assert schema["elevation_m"].metadata == {"dtype": "float32", "min": 900.0, "max": 1600.0, "unit": "m"}
    assert sum(f.dtype == "int8" for f in contract.fields()) == 10


def test_contract_check_and_diff(spark):
    typed = placeholders.synthetic_dataset(spark.range(100), "id").select(
        *[F.col(f.name).cast(f.spark_type) for f in contract.fields()]
    )
    clean = quality.contract_check(typed).collect()
    assert len(clean) == 25 and all((r["type_ok"], r["n_null"], r["n_outside"]) == (1, 0, 0) for r in clean)
    broken = typed.withColumn("slope_deg", F.lit(60.0)).withColumn("temp_c", F.lit(None).cast("float"))
    bad = {r["col"]: r for r in quality.contract_check(broken).collect()}
    assert (bad["slope_deg"]["type_ok"], bad["slope_deg"]["n_outside"]) == (0, 100)
    assert bad["temp_c"]["n_null"] == 100
    with pytest.raises(ValueError, match="rh_pct"):
        quality.contract_check(typed.drop("rh_pct"))
    declared = contract.contract_frame(spark)
    assert quality.contract_diff(declared, declared).count() == 0
    other = declared.filter("col <> 'rh_pct'").withColumn("high", F.when(F.col("col") == "slope_deg", 90.0).otherwise(F.col("high")))
    diff = {r["col"]: r["status"] for r in quality.contract_diff(declared, other).collect()}
    assert diff == {"rh_pct": "missing", "slope_deg": "both"}


def test_metadata_and_gate(spark):
    rows = [(39.5, 32.8, d, int(i == 0)) for i, d in enumerate(["2024-01-01", "2024-02-01"])] + [(39.6, 32.8, "2024-01-01", 0)]
    df = frame(spark, rows, f"lat double, lon double, obs_date string, {TARGET} int")
    r = quality.dataset_metadata(df, "real-b1", "hotspot_archive").first()
    assert (r["n_rows"], r["n_grid_cells"], r["n_obs_date_slices"], r["n_positive"], r["too_sparse"]) == (3, 2, 2, 1, 0)
    none = df.withColumn(TARGET, F.lit(0))
    assert quality.dataset_metadata(none, "real-b1", "hotspot_archive").first()["too_sparse"] == 1
    assert quality.dataset_metadata(none, "v0", "synthetic_fallback").first()["too_sparse"] == 0
    assert quality.sparsity_gate(none).first()["too_sparse"] == 1
