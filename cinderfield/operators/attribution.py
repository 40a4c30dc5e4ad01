"""Additive feature attributions of a boosted model (path-dependent tree Shapley values)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.operators.booster import Booster, Tree, trees


@dataclass(frozen=True)
class LeafPath:
    """A leaf's conditions merged per feature: inside (low, high], and the share of
    training weight that goes this way when the feature is unknown."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def leaf_paths(tree: Tree) -> list[LeafPath]:
    out: list[LeafPath] = []
    todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while todo:
        node, seen = todo.pop()
        f = int(tree.feature[node])
        if f < 0:
            names = sorted(seen)
            low, high, share = (np.array([seen[n][i] for n in names], dtype=float) for i in range(3))
            out.append(LeafPath(tree.weight * tree.value[node], np.array(names, dtype=int), low, high, share))
            continue
        lo, hi, z = seen.get(f, (-np.inf, np.inf, 1.0))
        cut = tree.threshold[node]
        for child, bounds in (
            (int(tree.left[node]), (lo, min(hi, cut))),
            (int(tree.right[node]), (max(lo, cut), hi)),
        ):
            portion = tree.cover[child] / tree.cover[node]
            todo.append((child, {**seen, f: (*bounds, z * portion)}))
    return out


def _pattern_table(path: LeafPath) -> np.ndarray:
    """Contribution of each path feature for every in/out pattern of the conditions."""
    d = len(path.features)
    inside = ((np.arange(2**d)[:, None] >> np.arange(d)) & 1).astype(float)
    weights = np.array([factorial(s) * factorial(d - 1 - s) / factorial(d) for s in range(d)])
    table = np.zeros((2**d, d))
    for i in range(d):
        # by_size[s]: sum over known sets of size s of the product of in-flags and shares
        by_size = np.zeros((2**d, d))
        by_size[:, 0] = 1.0
        for j in range(d):
            if j != i:
                longer = np.zeros_like(by_size)
                longer[:, 1:] = by_size[:, :-1] * inside[:, [j]]
                by_size = by_size * path.share[j] + longer
        table[:, i] = path.value * (inside[:, i] - path.share[i]) * (by_size @ weights)
    return table


def base_value(members: list[Tree]) -> float:
    """Expected margin: leaf values weighted by the shares along their paths."""
    return float(sum(p.value * np.prod(p.share) for t in members for p in leaf_paths(t)))


def explain_rows(paths: list[LeafPath], tables: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    phi = np.zeros(x.shape)
    for path, table in zip(paths, tables):
        if len(path.features) == 0:
            continue
        held = x[:, path.features]
        inside = (held > path.low) & (held <= path.high)
        pattern = inside @ (1 << np.arange(len(path.features)))
        phi[:, path.features] += table[pattern]
    return phi


def attributions(booster: Booster, df: DataFrame, key: str) -> DataFrame:
    """``key, phi ARRAY<DOUBLE>, base, margin``: per row, ``base + sum(phi) = margin``.

    The leaf tables depend on the model only; each task builds them once from
    the broadcast trees and then works on Arrow batches.
    """
    members = trees(booster.model, df)
    shared = df.sparkSession.sparkContext.broadcast(members)
    features = list(booster.settings.features)
    base = base_value(members)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths = [p for t in shared.value for p in leaf_paths(t)]
        tables = [_pattern_table(p) for p in paths]
        for batch in batches:
            phi = explain_rows(paths, tables, batch[features].to_numpy(np.float64))
            yield pd.DataFrame(
                {key: batch[key], "phi": list(phi), "base": base, "margin": base + phi.sum(axis=1)}
            )

    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in features])
    key_type = df.schema[key].dataType.simpleString()
    return rows.mapInPandas(explain, f"{key} {key_type}, phi array<double>, base double, margin double")


def long_attributions(attributed: DataFrame, features: tuple[str, ...], key: str) -> DataFrame:
    """One row per (key, feature): ``key, feature, phi``."""
    names = F.array(*[F.lit(f) for f in features])
    exploded = attributed.select(key, F.posexplode("phi").alias("_i", "phi"))
    return exploded.select(key, F.element_at(names, F.col("_i") + 1).alias("feature"), "phi")
