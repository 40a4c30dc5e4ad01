"""Boosted trees on MLlib: fit with the best round kept, score, and read the trees back."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderfield.contract import TARGET, BoosterSettings
from cinderfield.operators.metrics import class_weight, ranking_from_counts
from cinderfield.scratch import scratch_path


@dataclass(frozen=True)
class Booster:
    """A fitted model; ``history`` holds (round, average precision) on the validation rows."""

    model: GBTClassificationModel
    settings: BoosterSettings
    positive_weight: float
    best_round: int
    history: tuple[tuple[int, float], ...] = ()


def _vectors(df: DataFrame, settings: BoosterSettings) -> DataFrame:
    typed = df.withColumns({f"_x_{c}": F.col(c).cast("double") for c in settings.features})
    assemble = VectorAssembler(inputCols=[f"_x_{c}" for c in settings.features], outputCol="_features")
    return assemble.transform(typed).drop(*[f"_x_{c}" for c in settings.features])


def _train(df: DataFrame, settings: BoosterSettings, weight: float, y: str) -> GBTClassificationModel:
    rows = _vectors(df, settings).select(
        "_features",
        F.col(y).cast("double").alias("_y"),
        F.when(F.col(y) == 1, F.lit(weight)).otherwise(F.lit(1.0)).alias("_w"),
    )
    booster = GBTClassifier(
        featuresCol="_features",
        labelCol="_y",
        weightCol="_w",
        maxIter=settings.rounds,
        maxDepth=settings.depth,
        stepSize=settings.step,
        minInstancesPerNode=settings.min_rows_per_leaf,
        subsamplingRate=settings.row_fraction,
        featureSubsetStrategy=str(settings.feature_fraction),
        maxBins=settings.max_bins,
        seed=settings.seed,
    )
    return booster.fit(rows)


def fit(
    train: DataFrame,
    val: DataFrame | None = None,
    settings: BoosterSettings | None = None,
    y: str = TARGET,
) -> Booster:
    """Fit on ``train``; with ``val`` keep the round of best average precision.

    The rounds trained are judged on the validation rows in one pass. The winner is
    the first best round that ``patience`` further rounds do not beat; the model is
    then cut to it. Rounds after those are never looked at, so many rounds are
    trained in steps (``_steps``), the last of them all rounds, until patience has
    run out: fewer rounds are a prefix of more, and the winner is that of all rounds.
    Both tables are scanned repeatedly: pass tables read from files, not unexecuted plans.
    """
    s = settings or BoosterSettings()
    weight = s.positive_weight or class_weight(train, y).first()["weight"]
    if val is None:
        return Booster(_train(train, s, weight, y), s, weight, s.rounds)
    for rounds in _steps(s):
        model = _train(train, replace(s, rounds=rounds), weight, y)
        history = round_precision(model, val, s, y)
        best = _best_round(history, s.patience)
        if history[-1][0] - best >= s.patience:
            break
    if best < rounds:
        model = first_trees(model, best, train.sparkSession)
    return Booster(model, s, weight, best, tuple(history))


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def _write_json(spark: SparkSession, content: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(path)


def first_trees(model: GBTClassificationModel, keep: int, spark: SparkSession) -> GBTClassificationModel:
    """The model of the first ``keep`` rounds: its saved node table without the later trees, loaded again.

    Trees are added one after another, so nothing has to be trained for it.
    """
    if not 1 <= keep <= model.getNumTrees:
        raise ValueError(f"a model of {model.getNumTrees} trees has no first {keep}")
    whole, cut = scratch_path(spark, "booster"), scratch_path(spark, "booster-cut")
    model.write().save(whole)
    for part in ("data", "treesMetadata"):
        rows = spark.read.parquet(f"{whole}/{part}")
        rows.filter(F.col(rows.columns[0]) < keep).write.parquet(f"{cut}/{part}")  # the tree's number comes first
    _write_json(spark, _read_json(spark, f"{whole}/metadata") | {"numTrees": keep}, f"{cut}/metadata")
    return GBTClassificationModel.load(cut)


def save(booster: Booster, spark: SparkSession, path: str, threshold: float = 0.5) -> None:
    """The model and beside it what scoring needs: feature order, class weight, best round, threshold, settings."""
    booster.model.write().save(f"{path}/model")
    card = {
        "features": list(booster.settings.features),
        "settings": {k: v for k, v in asdict(booster.settings).items() if k != "features"},
        "positive_weight": booster.positive_weight,
        "best_round": booster.best_round,
        "threshold": threshold,
        "history": [list(h) for h in booster.history],
    }
    _write_json(spark, card, f"{path}/card")


def load(spark: SparkSession, path: str) -> tuple[Booster, float]:
    """A saved booster and its decision threshold; a model that does not fit its card is an error."""
    card, model = _read_json(spark, f"{path}/card"), GBTClassificationModel.load(f"{path}/model")
    if model.numFeatures != len(card["features"]):
        raise ValueError(f"the model at {path} takes {model.numFeatures} features, its card names {len(card['features'])}")
    settings = BoosterSettings(**card["settings"], features=tuple(card["features"]))
    history = tuple((number, value) for number, value in card["history"])
    return Booster(model, settings, card["positive_weight"], card["best_round"], history), card["threshold"]


def _steps(settings: BoosterSettings) -> list[int]:
    """How many rounds to train, and again while patience lasts: halves of all rounds with room for twice the patience.

    Each ends on a judged round, as MLlib cannot go on with a model and judging must not depend on the steps.
    """
    steps = [settings.rounds]
    while (half := steps[0] // 2 // settings.judge_every * settings.judge_every) >= 2 * max(1, settings.patience):
        steps.insert(0, half)
    return steps


def _best_round(history: list[tuple[int, float]], patience: int) -> int:
    best, best_score = history[0]
    for number, score in history:
        if score > best_score:
            best, best_score = number, score
        elif number - best >= patience:
            break
    return best


def score(booster: Booster, df: DataFrame) -> DataFrame:
    """``df`` plus ``p``, the probability of class 1."""
    scored = booster.model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(
        "_probability"
    ).setFeaturesCol("_features").transform(_vectors(df, booster.settings))
    p = vector_to_array("_probability")[1].cast("float")
    return scored.select(*df.columns, p.alias("p"))


@dataclass(frozen=True)
class Tree:
    """One tree as arrays indexed by node; ``feature`` is -1 at a leaf."""

    weight: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


def trees(model: GBTClassificationModel, df: DataFrame) -> list[Tree]:
    """The model's trees, read from its saved node table.

    The size is set by rounds and depth (at most 2^(depth+1) nodes per round),
    not by the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "booster")
    model.write().save(path)
    node = F.col("nodeData")
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            node["id"].alias("id"),
            node["prediction"].alias("value"),
            node["impurityStats"][0].alias("cover"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        )
        .toPandas()
    )
    out = []
    for tree_id, part in nodes.groupby("treeID"):
        part = part.sort_values("id")
        out.append(
            Tree(
                weight=float(model.treeWeights[tree_id]),
                feature=part["feature"].to_numpy(np.int64),
                threshold=part["threshold"].to_numpy(np.float64),
                left=part["left"].to_numpy(np.int64),
                right=part["right"].to_numpy(np.int64),
                value=part["value"].to_numpy(np.float64),
                cover=part["cover"].to_numpy(np.float64),
            )
        )
    return out


def tree_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf value of each row of ``x``."""
    node = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    while True:
        feature = tree.feature[node]
        inner = feature >= 0
        if not inner.any():
            return tree.value[node]
        go_left = x[rows, np.where(inner, feature, 0)] <= tree.threshold[node]
        step = np.where(go_left, tree.left[node], tree.right[node])
        node = np.where(inner, step, node)


def margins(booster: Booster, df: DataFrame) -> DataFrame:
    """``df`` plus ``margin``: the weighted sum of the trees' leaf values, added up tree by tree."""
    members = df.sparkSession.sparkContext.broadcast(trees(booster.model, df))
    features = list(booster.settings.features)

    @F.pandas_udf("double")
    def total(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(np.float64) for c in columns])
            yield pd.Series(sum(t.weight * tree_values(t, x) for t in members.value))

    return df.withColumn("margin", total(*_as_doubles(tuple(features))))


def _as_doubles(features: tuple[str, ...]) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in features]


def round_precision(
    model: GBTClassificationModel, val: DataFrame, settings: BoosterSettings, y: str = TARGET
) -> list[tuple[int, float]]:
    """Average precision of the first r trees on ``val``, for every round r.

    Each task adds up its rows' margins tree by tree and hands on counts per
    (round, margin); the exact ranking per round is then an ordinary aggregation.
    """
    members = val.sparkSession.sparkContext.broadcast(trees(model, val))
    features = list(settings.features)

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(np.float64)
            positive = batch["_y"].to_numpy(np.int64)
            margin = np.zeros(len(x))
            for number, tree in enumerate(members.value, start=1):
                margin = margin + tree.weight * tree_values(tree, x)
                if number % settings.judge_every and number != len(members.value):
                    continue
                level, index = np.unique(margin, return_inverse=True)
                pos = np.bincount(index, weights=positive, minlength=len(level))
                total = np.bincount(index, minlength=len(level))
                yield pd.DataFrame(
                    {"round": number, "_score": level, "pos": pos.astype("int64"), "neg": (total - pos).astype("int64")}
                )

    rows = val.select(*_as_doubles(settings.features), (F.col(y) == 1).cast("int").alias("_y"))
    counted = rows.mapInPandas(margins, "round int, _score double, pos long, neg long")
    by_score = counted.groupBy("round", "_score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranked = ranking_from_counts(by_score, ["round"]).select("round", "average_precision").orderBy("round")
    return [(r["round"], r["average_precision"]) for r in ranked.collect()]
