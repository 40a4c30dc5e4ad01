"""Classification metrics of a scored table ``y, p`` (optionally per group)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.operators.ordered import running_sums


def _ratio(num: Column, den: Column) -> Column:
    """num/den, 0 when the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def decide(p: Column, threshold: float = 0.5) -> Column:
    return (p >= threshold).cast("int")


def confusion_matrix(
    scored: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5, by: list[str] | None = None
) -> DataFrame:
    """Counts ``tn, fp, fn, tp``; empty cells are 0."""
    guess = decide(F.col(p), threshold)

    def cell(truth: int, guessed: int) -> Column:
        hit = (F.col(y) == truth) & (guess == guessed)
        return F.coalesce(F.sum(F.when(hit, 1).otherwise(0)), F.lit(0)).cast("long")

    cells = [
        cell(0, 0).alias("tn"),
        cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"),
        cell(1, 1).alias("tp"),
    ]
    return scored.groupBy(*(by or [])).agg(*cells)


def threshold_metrics(
    scored: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5, by: list[str] | None = None
) -> DataFrame:
    """Confusion counts with precision, recall, F1 and accuracy; division by zero gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion_matrix(scored, y, p, threshold, by).withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(tp * 2, tp * 2 + fp + fn),
            "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
            "n_samples": tn + fp + fn + tp,
        }
    )


def ranking_metrics(
    scored: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None
) -> DataFrame:
    """Exact ``roc_auc`` (ties count one half) and ``average_precision``.

    A single class gives NaN for ROC AUC; no positive gives 0 average precision.
    Rows are folded to distinct scores before anything is ordered.
    """
    by = by or []
    one = F.when(F.col(y) == 1, 1).otherwise(0)
    by_score = scored.groupBy(*by, F.col(p).cast("double").alias("_score")).agg(
        F.sum(one).cast("long").alias("pos"), F.sum(1 - one).cast("long").alias("neg")
    )
    return ranking_from_counts(by_score, by)


def ranking_from_counts(by_score: DataFrame, by: list[str]) -> DataFrame:
    """The same from ``_score, pos, neg`` rows, one per distinct score (and group)."""
    ranked = running_sums(by_score, "_score", ["pos", "neg"], by, descending=True)
    pos, neg = F.col("pos"), F.col("neg")
    higher = F.col("run_pos") - pos
    wins = neg.cast("double") * (higher + pos / 2.0)
    step = pos / F.greatest(F.col("tot_pos"), F.lit(1)) * F.col("run_pos") / (
        F.col("run_pos") + F.col("run_neg")
    )
    sums = ranked.groupBy(*by).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
        F.sum(wins).alias("_wins"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    auc = F.when(pairs == 0, F.lit(float("nan"))).otherwise(F.col("_wins") / pairs)
    return sums.select(*by, "n_pos", "n_neg", auc.alias("roc_auc"), "average_precision")


def roc_auc(scored: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    return ranking_metrics(scored, y, p, by).select(*(by or []), "n_pos", "n_neg", "roc_auc")


def average_precision(
    scored: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None
) -> DataFrame:
    return ranking_metrics(scored, y, p, by).select(*(by or []), "n_pos", "n_neg", "average_precision")


def weighted_logloss(
    scored: DataFrame, weight: float | Column = 1.0, y: str = "y", p: str = "p"
) -> DataFrame:
    """Row mean of ``-(w*y*ln p + (1-y)*ln(1-p))``; logarithms are floored at -100.

    ``weight`` may be a scalar subquery. Empty input gives NaN.
    """
    w = weight if isinstance(weight, Column) else F.lit(float(weight))

    def log(x: Column) -> Column:
        return F.when(x <= 0, F.lit(-100.0)).otherwise(F.greatest(F.ln(x), F.lit(-100.0)))

    truth, prob = F.col(y), F.col(p)
    loss = -(w * truth * log(prob) + (1 - truth) * log(F.lit(1.0) - prob))
    return scored.agg(
        F.coalesce(F.avg(loss), F.lit(float("nan"))).alias("logloss"),
        F.count(F.lit(1)).alias("n_samples"),
    )


def class_weight(df: DataFrame, y: str, strict: bool = False) -> DataFrame:
    """One row ``n_pos, n_neg, weight`` with weight = neg / max(pos, 1).

    ``strict`` fails when there is no positive and gives 1.0 when there is no negative.
    """
    counts = df.agg(
        F.coalesce(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.sum(F.when(F.col(y) == 0, 1).otherwise(0)), F.lit(0)).cast("long").alias("n_neg"),
    )
    weight = F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1).cast("long"))
    if strict:
        no_positive = F.raise_error(F.lit("no positive sample: class weight is undefined"))
        weight = (
            F.when(F.col("n_pos") == 0, no_positive.cast("double"))
            .when(F.col("n_neg") == 0, F.lit(1.0))
            .otherwise(weight)
        )
    return counts.withColumn("weight", weight.cast("double"))


def cv_summary(per_fold: DataFrame, metrics: list[str], usable: str = "usable") -> DataFrame:
    """Mean and population deviation over usable folds; no usable fold gives zeros.

    ``per_fold`` has one row per fold.
    """
    kept = per_fold.filter(F.col(usable) == 1)
    columns = [F.count(F.lit(1)).alias("cv_n_folds")]
    for m in metrics:
        columns.append(F.coalesce(F.avg(m), F.lit(0.0)).alias(f"cv_{m}_mean"))
        columns.append(F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias(f"cv_{m}_std"))
    return kept.agg(*columns)


def attribution_rank(attributions: DataFrame, top_n: int = 10) -> DataFrame:
    """Mean absolute attribution per feature, largest first, from ``feature, phi`` rows."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs"))
        .orderBy(F.desc("mean_abs"), "feature")
        .limit(top_n)
    )


def score_parity(
    a: DataFrame,
    b: DataFrame,
    key: str,
    rtol: float = 1e-3,
    atol: float = 1e-4,
    a_score: str = "p",
    b_score: str = "p",
) -> DataFrame:
    """Compare two scored tables: ``|a-b| <= atol + rtol*|b|`` row by row.

    Keys on one side only, and scores null on one side only, count as violations.
    """
    left = a.select(F.col(key).alias("_k"), F.col(a_score).alias("_a"), F.lit(1).alias("_in_a"))
    right = b.select(F.col(key).alias("_k"), F.col(b_score).alias("_b"), F.lit(1).alias("_in_b"))
    both = left.join(right, "_k", "full_outer")
    gap = F.abs(F.col("_a") - F.col("_b"))
    close = gap <= F.lit(atol) + F.abs(F.col("_b")) * rtol
    same_null = F.col("_a").isNull() & F.col("_b").isNull()
    ok = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull() & (F.coalesce(close, F.lit(False)) | same_null)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.when(ok, 0).otherwise(1)), F.lit(0)).cast("long").alias("n_violations"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("max_gap"),
    )
