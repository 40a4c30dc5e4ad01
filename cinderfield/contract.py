"""The feature-table contract and the run settings shared by every job.

One definition serves dataset building, training and scoring: the column
order, types and declared bounds live here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They must equal the published feature contract.
# ---------------------------------------------------------------------------
TARGET = "fire_occurred_within_30d"

TOPOGRAPHY = ["elevation_m", "slope_deg", "aspect_sin", "aspect_cos"]
LAND_COVER = [
    "lc_tree_cover",
    "lc_shrubland",
    "lc_grassland",
    "lc_cropland",
    "lc_built_up",
    "lc_bare_sparse",
    "lc_herbaceous_wetland",
    "lc_moss_lichen",
]
WEATHER = [
    "temp_c",
    "rh_pct",
    "wind_speed_ms",
    "wind_dir_sin",
    "wind_dir_cos",
    "vpd_kpa",
    "ffmc_approx",
]
FIRE_HISTORY = ["firms_density_1yr", "days_since_last_fire"]
HUMAN = ["road_dist_m", "settlement_dist_m", "picnic_area"]

# Raster code of each land-cover class, in the order of LAND_COVER.
LAND_COVER_CODES = [10, 20, 30, 40, 50, 60, 90, 100]

# (dtype, min, max, unit) of the columns that are not land-cover flags.
_SCALARS = {
    "elevation_m": ("float32", 900.0, 1600.0, "m"),
    "slope_deg": ("float32", 0.0, 45.0, "deg"),
    "aspect_sin": ("float32", -1.0, 1.0, "unitless"),
    "aspect_cos": ("float32", -1.0, 1.0, "unitless"),
    "temp_c": ("float32", -10.0, 45.0, "C"),
    "rh_pct": ("float32", 5.0, 100.0, "pct"),
    "wind_speed_ms": ("float32", 0.0, 25.0, "m/s"),
    "wind_dir_sin": ("float32", -1.0, 1.0, "unitless"),
    "wind_dir_cos": ("float32", -1.0, 1.0, "unitless"),
    "vpd_kpa": ("float32", 0.0, 10.0, "kPa"),
    "ffmc_approx": ("float32", 0.0, 101.0, "unitless"),
    "firms_density_1yr": ("float32", 0.0, 100.0, "count"),
    "days_since_last_fire": ("float32", 0.0, 3650.0, "days"),
    "road_dist_m": ("float32", 0.0, 5000.0, "m"),
    "settlement_dist_m": ("float32", 0.0, 10000.0, "m"),
    "picnic_area": ("int8", 0.0, 1.0, "binary"),
    TARGET: ("int8", 0.0, 1.0, "binary"),
}

EARTH_RADIUS_M = 6_371_000.0
EARTH_CIRCUMFERENCE_M = 40_075_017.0
NO_FIRE_DAYS = 3650.0
HOTSPOT_COLUMNS = ["latitude", "longitude", "acq_date", "confidence"]
# ---------------------------------------------------------------------------

FEATURES = TOPOGRAPHY + LAND_COVER + WEATHER + FIRE_HISTORY + HUMAN
DATASET_KEYS = ["lat", "lon", "obs_date"]
DATASET_COLUMNS = DATASET_KEYS + FEATURES + [TARGET]

_SPARK_TYPES = {"float32": T.FloatType(), "int8": T.ByteType()}


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    low: float
    high: float
    unit: str

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.dtype]


def fields() -> list[Field]:
    """Contract fields in order: the 24 features, then the target."""
    flag = ("int8", 0.0, 1.0, "binary")
    return [Field(c, *_SCALARS.get(c, flag)) for c in FEATURES + [TARGET]]


def schema() -> T.StructType:
    """The contract as a Spark schema, bounds and unit kept as field metadata."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.spark_type,
                True,
                {"dtype": f.dtype, "min": f.low, "max": f.high, "unit": f.unit},
            )
            for f in fields()
        ]
    )


CONTRACT_SCHEMA = "col string, dtype string, low double, high double, unit string"


def contract_rows() -> list[tuple[str, str, float, float, str]]:
    return [(f.name, f.dtype, f.low, f.high, f.unit) for f in fields()]


def contract_frame(spark: SparkSession) -> DataFrame:
    """The contract as a table, one row per column (25 rows)."""
    return spark.createDataFrame(contract_rows(), CONTRACT_SCHEMA)


# Defaults of the runs that this library reproduces.


@dataclass(frozen=True)
class LabelSettings:
    """Search radius, time windows and run thresholds of the label job."""

    radius_m: float = 10_000.0
    label_days: int = 30
    buffer_days: int = 31
    history_days: int = 365
    confidence_levels: tuple[str, ...] = ("nominal", "high")
    start: str = "2024-01-01"
    end: str = "2025-12-31"
    folds: int = 5
    min_positive_rate: float = 0.002


@dataclass(frozen=True)
class SplitSettings:
    seed: int = 42
    test_fraction: float = 0.20
    val_fraction: float = 0.20
    positive_rate: float = 0.15
    sample_rows: int = 2000


@dataclass(frozen=True)
class BoosterSettings:
    """Boosted-tree settings.

    ``positive_weight`` None means neg/pos of the training rows. ``judge_every`` n
    judges only every n-th round on the validation rows; the work of choosing a
    round grows with validation rows times judged rounds.
    """

    rounds: int = 500
    depth: int = 6
    step: float = 0.05
    min_rows_per_leaf: int = 5
    row_fraction: float = 0.8
    feature_fraction: float = 0.8
    patience: int = 30
    judge_every: int = 1
    positive_weight: float | None = None
    max_bins: int = 64
    seed: int = 42
    features: tuple[str, ...] = field(default_factory=lambda: tuple(FEATURES))
