"""Boosted trees: contract of the jobs, round selection, attributions."""

import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderfield.contract import FEATURES, TARGET, BoosterSettings, SplitSettings
from cinderfield.operators import attribution, booster, placeholders
from cinderfield.plans import model_jobs, queries
from cinderfield.scratch import settle

SMALL = BoosterSettings(rounds=6, depth=3, step=0.3, patience=3)


@pytest.fixture(scope="module")
def rows(spark):
    keys = spark.range(600).withColumn("lat", 39.4 + F.col("id") % 97 / 500)
    return settle(placeholders.synthetic_dataset(keys, "id"))


@pytest.fixture(scope="module")
def fitted(rows):
    return booster.fit(rows, settings=SMALL)


def test_holdout(rows):
    split = model_jobs.split_table(rows, "id", SplitSettings())
    fitted = model_jobs.fit_on_split(split, SMALL)
    r = model_jobs.holdout_evaluation(split, fitted).first()
    assert r["n_train"] + r["n_val"] + r["n_test"] == 600 and r["n_test"] == r["tn"] + r["fp"] + r["fn"] + r["tp"]
    assert r["roc_auc"] >= 0.65 and 0 < r["pr_auc"] <= 1
    assert r["scale_pos_weight"] == fitted.positive_weight > 1
    assert 1 <= r["best_round"] <= SMALL.rounds and len(fitted.history) == SMALL.rounds


def test_best_round_patience():
    history = [(1, 0.1), (2, 0.5), (3, 0.4), (4, 0.4), (5, 0.9)]
    assert booster._best_round(history, 2) == 2
    assert booster._best_round(history, 30) == 5
    assert booster._best_round([(1, 0.3), (2, 0.3)], 30) == 1


def test_fewer_rounds_are_a_prefix(rows, fitted):
    short = booster.fit(rows, settings=BoosterSettings(rounds=3, depth=3, step=0.3))
    members = booster.trees(fitted.model, rows)
    for a, b in zip(booster.trees(short.model, rows), members):
        assert np.array_equal(a.threshold, b.threshold, equal_nan=True) and np.allclose(a.value, b.value)


def test_cut_model_equals_a_refit(spark, rows, fitted):
    cut = booster.first_trees(fitted.model, 3, spark)
    short = booster.fit(rows, settings=replace(SMALL, rounds=3))
    assert cut.getNumTrees == 3 and cut.treeWeights == short.model.treeWeights
    for a, b in zip(booster.trees(cut, rows), booster.trees(short.model, rows), strict=True):
        assert np.array_equal(a.threshold, b.threshold, equal_nan=True) and np.array_equal(a.value, b.value)
    both = [booster.score(replace(fitted, model=m), rows).orderBy("id").toPandas()["p"] for m in (cut, short.model)]
    assert both[0].equals(both[1])
    with pytest.raises(ValueError, match="no first 7"):
        booster.first_trees(fitted.model, 7, spark)


def test_fit_cuts_to_the_best_round(rows):
    kept = booster.fit(rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0"), SMALL)
    assert kept.model.getNumTrees == kept.best_round == booster._best_round(list(kept.history), SMALL.patience)


def test_saved_booster_comes_back(spark, rows, fitted, tmp_path):
    booster.save(fitted, spark, str(tmp_path / "m"), threshold=0.3)
    loaded, threshold = booster.load(spark, str(tmp_path / "m"))
    assert threshold == 0.3 and loaded.settings == fitted.settings and loaded.positive_weight == fitted.positive_weight
    a, b = (booster.margins(f, booster.score(f, rows)).orderBy("id").select("p", "margin").toPandas() for f in (fitted, loaded))
    assert a.equals(b) and np.allclose(a["p"], 1 / (1 + np.exp(-2 * a["margin"])), atol=1e-6)
    other = replace(fitted, settings=replace(SMALL, features=SMALL.features[:5]))
    booster.save(other, spark, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="names 5"):
        booster.load(spark, str(tmp_path / "bad"))


def test_scores_are_probabilities_and_match_the_trees(rows, fitted):
    out = booster.score(fitted, rows)
    assert out.columns == [*rows.columns, "p"]
    pdf = out.toPandas()
    assert pdf["p"].between(0, 1).all()
    x = pdf[FEATURES].to_numpy(float)
    margin = sum(t.weight * booster.tree_values(t, x) for t in booster.trees(fitted.model, rows))
    assert np.allclose(pdf["p"], 1 / (1 + np.exp(-2 * margin)), atol=1e-6)


def test_spatial_cv(rows):
    folds, summary = model_jobs.spatial_cv(rows, 3, SMALL)
    r = summary.first()
    assert r["cv_n_folds"] == 3 == folds.count()
    assert 0.5 < r["cv_roc_auc_mean"] <= 1 and r["cv_roc_auc_std"] >= 0


def test_spatial_cv_without_positives(rows):
    folds, summary = model_jobs.spatial_cv(rows.withColumn(TARGET, F.lit(0)), 5, SMALL)
    assert folds.count() == 0 and tuple(summary.first()) == (0,) + (0.0,) * 6


def test_spatial_cv_query_trains_the_whole_model(monkeypatch, spark):
    taken = []
    monkeypatch.setattr(queries, "keyed_risk_table", lambda spark, sf: None)
    monkeypatch.setattr(model_jobs, "spatial_cv", lambda df, k, settings: (taken.append((k, settings)), None))
    queries.spatial_cv(spark, "")
    assert taken == [(5, BoosterSettings())] and (taken[0][1].rounds, taken[0][1].depth) == (500, 6)


def test_training_in_steps_finds_the_round_of_all_rounds(rows):
    train, val = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    s = replace(SMALL, rounds=25, step=1.0, patience=1)
    kept = booster.fit(train, val, s)
    whole = booster._train(train, s, kept.positive_weight, TARGET)
    history = booster.round_precision(whole, val, s)
    assert booster._steps(s) == [3, 6, 12, 25] and len(kept.history) < 25
    assert np.allclose(kept.history, history[: len(kept.history)])
    assert kept.best_round == kept.model.getNumTrees == booster._best_round(history, s.patience)
    for a, b in zip(booster.trees(kept.model, rows), booster.trees(whole, rows)):
        assert np.array_equal(a.threshold, b.threshold, equal_nan=True) and np.allclose(a.value, b.value)
    assert booster._steps(replace(s, patience=3, judge_every=5)) == [10, 25] and booster._steps(SMALL) == [6]
    assert booster._steps(BoosterSettings()) == [62, 125, 250, 500]


@pytest.mark.parametrize("label", [0, 1])
def test_folds_of_one_class_give_no_scores(monkeypatch, spark, rows, label):
    one_class = rows.withColumn(TARGET, F.lit(label))
    scores = model_jobs.fold_scores(one_class, 5, SMALL)
    assert scores.dtypes == [("fold", "int"), ("y", "int"), ("p", "float")] and scores.count() == 0
    monkeypatch.setattr(queries, "keyed_risk_table", lambda spark, sf: one_class)
    assert queries.spatial_cv_folds(spark, "").collect() == []


def brute_shapley(tree, x, n_features):
    """Shapley values from the definition, over all feature subsets of a small tree."""

    def expected(node, known):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        a, b = tree.left[node], tree.right[node]
        if f in known:
            return expected(a if x[f] <= tree.threshold[node] else b, known)
        return (tree.cover[a] * expected(a, known) + tree.cover[b] * expected(b, known)) / tree.cover[node]

    used = sorted(set(tree.feature[tree.feature >= 0]))
    phi = np.zeros(n_features)
    for i in used:
        rest = [j for j in used if j != i]
        for size in range(len(rest) + 1):
            w = math.factorial(size) * math.factorial(len(rest) - size) / math.factorial(len(used))
            for s in itertools.combinations(rest, size):
                phi[i] += w * (expected(0, {*s, i}) - expected(0, set(s)))
    return tree.weight * phi


def test_attributions_match_the_definition(rows, fitted):
    members = booster.trees(fitted.model, rows)
    out = attribution.attributions(fitted, rows.limit(25), "id").toPandas()
    x = {r["id"]: np.array([float(r[c]) for c in FEATURES]) for r in rows.collect()}
    for _, r in out.iterrows():
        want = sum(brute_shapley(t, x[r["id"]], len(FEATURES)) for t in members)
        assert np.allclose(r["phi"], want, atol=1e-9)
        margin = sum(t.weight * booster.tree_values(t, x[r["id"]][None, :])[0] for t in members)
        assert r["base"] + np.sum(r["phi"]) == pytest.approx(margin, abs=1e-9) == pytest.approx(r["margin"])


def test_attribution_check_brings_no_rows_to_the_driver(monkeypatch, spark, rows):
    keyed = settle(rows.withColumn("row_key", F.col("id").cast("string")))
    monkeypatch.setattr(queries, "keyed_risk_table", lambda spark, sf: keyed)
    monkeypatch.setattr(queries, "BOOSTER", SMALL)
    out = queries.attribution_check(spark, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and plan.count("SortMergeJoin") == 1
    assert [tuple(r) for r in out.collect()] == [(600, 0, 0)]
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_importance_table(rows, fitted):
    top = model_jobs.feature_importance(fitted, rows, "id", sample_rows=200, top_n=10).collect()
    assert len(top) == 10 and [r["mean_abs"] for r in top] == sorted((r["mean_abs"] for r in top), reverse=True)
    assert {r["feature"] for r in top} <= set(FEATURES)
