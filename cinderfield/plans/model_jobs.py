"""Model jobs on a feature table: holdout evaluation, spatial cross-validation, importances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.contract import TARGET, BoosterSettings, SplitSettings
from cinderfield.operators import attribution, booster, metrics, splits
from cinderfield.scratch import settle


def split_table(df: DataFrame, key: str, settings: SplitSettings | None = None, y: str = TARGET) -> DataFrame:
    """The stratified split, written once so that every fit pass reads files."""
    s = settings or SplitSettings()
    return settle(
        splits.stratified_split(df, key, y, s.test_fraction, s.val_fraction, s.seed), "split", "zstd"
    )


def fit_on_split(split: DataFrame, settings: BoosterSettings | None = None, y: str = TARGET) -> booster.Booster:
    return booster.fit(
        split.filter("split = 'train'"), split.filter("split = 'val'"), settings, y
    )


def holdout_evaluation(
    split: DataFrame, fitted: booster.Booster, y: str = TARGET, threshold: float = 0.5
) -> DataFrame:
    """One row: ranking and threshold metrics on the test rows, split sizes, class weight, best round."""
    test = settle(
        booster.score(fitted, split.filter("split = 'test'")).select(F.col(y).cast("int").alias("y"), "p"),
        "scored",
    )
    sizes = split.agg(
        *[F.sum((F.col("split") == s).cast("long")).alias(f"n_{s}") for s in ("train", "val", "test")]
    )
    one = F.lit(1).alias("_one")
    ranking = metrics.ranking_metrics(test).select(
        one, "roc_auc", F.col("average_precision").alias("pr_auc")
    )
    cut = metrics.threshold_metrics(test, threshold=threshold).drop("n_samples").select(one, "*")
    return (
        ranking.join(cut, "_one")
        .join(sizes.select(one, "*"), "_one")
        .drop("_one")
        .withColumn("scale_pos_weight", F.lit(fitted.positive_weight))
        .withColumn("best_round", F.lit(fitted.best_round))
    )


def fold_scores(
    df: DataFrame, k: int = 5, settings: BoosterSettings | None = None, lat: str = "lat", y: str = TARGET
) -> DataFrame:
    """Rows (fold, y, p): each usable fold scored by a model of the others; an empty table without a usable fold.

    The loop runs over folds, at most ``k``; each fit and each scoring is a Spark job
    over the folded table, which is written once. Folds with one class on either
    side are skipped.
    """
    folded = settle(splits.spatial_folds(df, k, lat, y), "folds", "zstd")
    plan = splits.fold_summary(folded, y).orderBy("fold").collect()
    scored = []
    for fold in (r["fold"] for r in plan if r["usable"]):
        val = splits.validation_rows(folded, fold)
        fitted = booster.fit(splits.training_rows(folded, fold), val, settings, y)
        scored.append(
            booster.score(fitted, val).select("fold", F.col(y).cast("int").alias("y"), "p")
        )
    if not scored:
        return df.sparkSession.createDataFrame([], "fold int, y int, p float")
    return settle(reduce(DataFrame.unionByName, scored), "fold-scores")


def spatial_cv(
    df: DataFrame,
    k: int = 5,
    settings: BoosterSettings | None = None,
    lat: str = "lat",
    y: str = TARGET,
) -> tuple[DataFrame, DataFrame]:
    """(one row per usable fold, summary) of ``fold_scores``."""
    held = fold_scores(df, k, settings, lat, y)
    ranking = metrics.ranking_metrics(held, by=["fold"]).withColumnRenamed("average_precision", "pr_auc")
    cut = metrics.threshold_metrics(held, by=["fold"]).select("fold", "f1")
    per_fold = ranking.join(cut, "fold").select("fold", "roc_auc", "pr_auc", "f1", F.lit(1).alias("usable"))
    return per_fold, metrics.cv_summary(per_fold, ["roc_auc", "pr_auc", "f1"])


def feature_importance(
    fitted: booster.Booster, df: DataFrame, key: str, sample_rows: int | None = None, top_n: int = 10
) -> DataFrame:
    """Mean absolute attribution per feature over ``df``, or over a seeded sample of it."""
    rows = df if sample_rows is None else splits.bounded_sample(df, key, sample_rows)
    explained = attribution.attributions(fitted, rows, key)
    long_form = attribution.long_attributions(explained, fitted.settings.features, key)
    return metrics.attribution_rank(long_form, top_n)
