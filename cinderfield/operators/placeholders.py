"""Placeholder features and the fallback label, both functions of the row alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.contract import FEATURES, LAND_COVER, TARGET, SplitSettings
from cinderfield.functions.scalars import circular, clamp, hash_uniform
from cinderfield.functions.weather import ffmc, vpd
from cinderfield.operators.ordered import exact_quantiles
from cinderfield.scratch import settle

# Land-cover shares in the order of LAND_COVER.
LAND_COVER_SHARES = [0.40, 0.20, 0.15, 0.10, 0.05, 0.05, 0.03, 0.02]
# Weights of the risk score.
SCORE_BIAS = -0.5
SCORE_TERMS = {
    "vpd_kpa": (0.15, 5.0, False),
    "rh_pct": (0.10, 100.0, True),
    "lc_tree_cover": (0.15, 1.0, False),
    "lc_shrubland": (0.10, 1.0, False),
    "picnic_area": (0.10, 1.0, False),
    "ffmc_approx": (0.05, 100.0, False),
    "settlement_dist_m": (0.05, 10000.0, True),
    "firms_density_1yr": (0.05, 5.0, False),
}


class KeyedDraws:
    """Random variables of a row, drawn from a hash of its key, the seed and a name."""

    def __init__(self, key: Column, seed: int) -> None:
        self.key, self.seed = key, seed

    def unit(self, name: str) -> Column:
        return hash_uniform(self.key, self.seed, name)

    def uniform(self, name: str, low: float, high: float) -> Column:
        return self.unit(name) * (high - low) + low

    def beta_2_5(self, name: str) -> Column:
        """Second smallest of six uniforms is Beta(2, 5)."""
        return F.element_at(F.array_sort(F.array(*[self.unit(f"{name}{i}") for i in range(6)])), 2)

    def normal(self, name: str, mean: float, deviation: float) -> Column:
        size = F.sqrt(F.ln(F.lit(1.0) - self.unit(f"{name}a")) * -2.0)
        return size * F.cos(self.unit(f"{name}b") * (2.0 * math.pi)) * deviation + mean

    def exponential(self, name: str, scale: float) -> Column:
        return F.ln(F.lit(1.0) - self.unit(name)) * -scale


def poisson_step(u: Column, rate: float) -> Column:
    """Poisson count from one uniform: how many CDF steps lie at or below it."""
    total, weight, cdf = F.lit(0.0), math.exp(-rate), 0.0
    for k in range(16):
        cdf += weight
        total = total + F.when(u >= cdf, 1.0).otherwise(0.0)
        weight *= rate / (k + 1)
    return total


def share_flags(u: Column, shares: list[float]) -> list[Column]:
    """One 0/1 flag per class from one uniform; exactly one flag is set."""
    flags, low = [], 0.0
    for i, share in enumerate(shares):
        high = low + share
        inside = (u >= low) if i == len(shares) - 1 else (u >= low) & (u < high)
        flags.append(inside.cast("byte"))
        low = high
    return flags


# The distributions' parameters and the clipping bounds in the two functions below.


def _drawn(draw: KeyedDraws) -> dict[str, Column]:
    """Independent variables, read straight from the hash."""
    return {
        "elevation_m": draw.uniform("elevation_m", 900.0, 1600.0),
        "slope_deg": draw.beta_2_5("slope_deg") * 45.0,
        "aspect": draw.uniform("aspect", 0.0, 360.0),
        "cover": draw.unit("land_cover"),
        "temp_c": draw.normal("temp_c", 25.0, 8.0),
        "rh_pct": draw.beta_2_5("rh_pct") * 100.0,
        "wind_speed_ms": draw.exponential("wind_speed_ms", 3.0),
        "heading": draw.uniform("wind_dir", 0.0, 360.0),
        "density": draw.unit("firms_density_1yr"),
        "days_since_last_fire": draw.exponential("days_since_last_fire", 500.0),
        "road_dist_m": draw.exponential("road_dist_m", 800.0),
        "settlement_dist_m": draw.exponential("settlement_dist_m", 2000.0),
        "picnic_area": (draw.unit("picnic_area") < 0.05).cast("byte"),
    }


def _shaped() -> dict[str, Column]:
    """Clipping and coding of drawn columns."""
    aspect, heading = circular(F.col("_ph_aspect")), circular(F.col("_ph_heading"))
    clips = {
        "temp_c": (-10.0, 45.0),
        "rh_pct": (5.0, 100.0),
        "wind_speed_ms": (0.0, 25.0),
        "days_since_last_fire": (0.0, 3650.0),
        "road_dist_m": (0.0, 5000.0),
        "settlement_dist_m": (0.0, 10000.0),
    }
    cover = share_flags(F.col("_ph_cover"), LAND_COVER_SHARES)
    return {
        **{c: clamp(F.col(f"_ph_{c}"), low, high) for c, (low, high) in clips.items()},
        "aspect_sin": aspect[0],
        "aspect_cos": aspect[1],
        **dict(zip(LAND_COVER, cover)),
        "wind_dir_sin": heading[0],
        "wind_dir_cos": heading[1],
        "firms_density_1yr": poisson_step(F.col("_ph_density"), 0.3),
    }


def _derived() -> dict[str, Column]:
    t, rh, wind = (F.col(f"_ph_{c}") for c in ("temp_c", "rh_pct", "wind_speed_ms"))
    return {"vpd_kpa": vpd(t, rh), "ffmc_approx": ffmc(t, rh, wind)}


# Inputs of the columns that are not drawn under their own name.
_INPUTS = {
    "aspect_sin": ["aspect"],
    "aspect_cos": ["aspect"],
    **{c: ["cover"] for c in LAND_COVER},
    "wind_dir_sin": ["heading"],
    "wind_dir_cos": ["heading"],
    "firms_density_1yr": ["density"],
    "vpd_kpa": ["temp_c", "rh_pct"],
    "ffmc_approx": ["temp_c", "rh_pct", "wind_speed_ms"],
}


def placeholder_features(
    keys: DataFrame, key: str, seed: int = 42, columns: list[str] | None = None
) -> DataFrame:
    """``keys`` plus the requested placeholder features (all 24 by default).

    The same key and seed give the same values on any cluster; an empty table
    gives an empty table with the columns. Drawn, clipped and derived columns
    are stacked projections: a hash is computed once however often its value is
    used.
    """
    columns = columns or FEATURES
    given = [c for c in keys.columns if c not in columns]
    needed = {name for c in columns for name in [c, *_INPUTS.get(c, [])]}
    out = keys
    for stage in (_drawn(KeyedDraws(F.col(key), seed)), _shaped(), _derived()):
        out = out.withColumns({f"_ph_{n}": c for n, c in stage.items() if n in needed})
    return out.select(*given, *[F.col(f"_ph_{c}").alias(c) for c in columns])


def risk_score() -> Column:
    """Logistic risk score of a feature row."""
    score = F.lit(0.0)
    for name, (weight, scale, inverted) in SCORE_TERMS.items():
        share = F.col(name).cast("double") / scale
        score = score + ((F.lit(1.0) - share) if inverted else share) * weight
    return F.lit(1.0) / (F.lit(1.0) + F.exp((score + SCORE_BIAS) * -2.0))


def quantile_label(
    df: DataFrame, rate: float = SplitSettings().positive_rate, out: str = TARGET
) -> DataFrame:
    """``df`` plus a 0/1 label: score at or above its exact (1 - rate) quantile.

    The score is taken from the feature columns of the table passed in; its
    threshold is one number, read first.
    """
    scored = df.withColumn("_score", risk_score())
    threshold = exact_quantiles(scored, "_score", [1.0 - rate])
    label = (F.col("_score") >= threshold[0]) if threshold else F.lit(None)
    return scored.withColumn(out, label.cast("byte")).drop("_score")


def synthetic_dataset(keys: DataFrame, key: str, settings: SplitSettings | None = None) -> DataFrame:
    """All placeholder features and the fallback label for a key table.

    The features are written once: the threshold needs several passes over them.
    """
    s = settings or SplitSettings()
    features = settle(placeholder_features(keys, key, s.seed), "placeholders")
    return quantile_label(features, s.positive_rate)
