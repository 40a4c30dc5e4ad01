"""Contract checks, run metadata and the sparsity gate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.contract import CONTRACT_SCHEMA, FEATURES, LAND_COVER, TARGET, Field, LabelSettings, fields


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    """``df`` itself, or an error that lists the missing columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def contract_check(df: DataFrame, checked: list[Field] | None = None) -> DataFrame:
    """Per contract column: whether the type is the declared one, and how many values are null,
    not a number, not castable to the declared type, or outside the declared bounds.

    Columns may be text, as a CSV file holds them; a text that is no value of the
    type counts as not castable, an empty one as null. One aggregation over the
    table; its single row is then turned into one row per column.
    """
    checked = checked or fields()
    require_columns(df, [f.name for f in checked], "feature table")
    types = {f.name: f.dataType for f in df.schema.fields}

    def count(hit: Column) -> Column:
        return F.coalesce(F.count_if(hit), F.lit(0)).cast("long")

    measures = []
    for f in checked:
        given = F.col(f"`{f.name}`")
        if isinstance(types[f.name], T.StringType):
            given = F.nullif(F.trim(given), F.lit(""))
        typed = given.try_cast(f.spark_type)
        value = typed.cast("double")
        measures.append(
            F.struct(
                F.lit(f.name).alias("col"),
                F.lit(int(types[f.name] == f.spark_type)).alias("type_ok"),
                count(given.isNull()).alias("n_null"),
                count(F.isnan(value)).alias("n_nan"),
                count(given.isNotNull() & typed.isNull()).alias("n_uncast"),
                count(~F.isnan(value) & ((value < f.low) | (value > f.high))).alias("n_outside"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("r")).select("r.*")


def observed_contract(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The contract a table actually meets: type, smallest and largest value per column."""
    columns = columns or [c for c in FEATURES + [TARGET] if c in df.columns]
    names = {"float": "float32", "tinyint": "int8", "double": "float64", "int": "int32", "bigint": "int64"}
    types = dict(df.dtypes)
    measures = [
        F.struct(
            F.lit(c).alias("col"),
            F.lit(names.get(types[c], types[c])).alias("dtype"),
            F.min(F.col(c).cast("double")).alias("low"),
            F.max(F.col(c).cast("double")).alias("high"),
        )
        for c in columns
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("r")).select("r.*")


def contract_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differences of two contract tables: keys on one side only, and unequal fields.

    Compares every column of the contract that both sides carry.
    """
    shared = [c.split()[0] for c in CONTRACT_SCHEMA.split(", ")][1:]
    shared = [c for c in shared if c in a.columns and c in b.columns]
    left = a.select("col", F.lit(1).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in shared])
    right = b.select("col", F.lit(1).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in shared])
    both = left.join(right, "col", "full_outer")
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("both")
    unequal = [(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))).cast("int").alias(f"{c}_differs") for c in shared]
    out = both.select("col", status.alias("status"), *unequal)
    any_difference = F.col("status") != "both"
    for c in shared:
        any_difference = any_difference | (F.col(f"{c}_differs") == 1)
    return out.filter(any_difference)


def dataset_metadata(
    df: DataFrame,
    data_version: str,
    label_source: str,
    threshold: float = LabelSettings().min_positive_rate,
    y: str = TARGET,
) -> DataFrame:
    """One row on a table that is already there: rows, distinct cells and dates, positive rate, gate outcome, provenance.

    Rows and positives are plain sums; cells and dates are distinct values of their
    own columns, reduced within each task first. No row is shuffled by its full key.
    """
    positive = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(positive, F.lit(0)).alias("n_positive"))
    known = df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("lat", "lon").distinct()
    cells = known.agg(F.count(F.lit(1)).alias("n_grid_cells"))
    dates = df.select("obs_date").distinct().agg(F.count("obs_date").alias("n_obs_date_slices"))
    counts = totals.unionByName(cells, allowMissingColumns=True).unionByName(dates, allowMissingColumns=True)
    row = counts.agg(*[F.max(c).alias(c) for c in counts.columns])  # three rows, each with its own columns
    rate = F.when(F.col("n_rows") == 0, F.lit(0.0)).otherwise(F.col("n_positive") / F.col("n_rows"))
    return row.select(
        F.lit(data_version).alias("data_version"),
        F.lit(label_source).alias("label_source"),
        "n_rows",
        "n_grid_cells",
        "n_obs_date_slices",
        "n_positive",
        rate.alias("positive_rate"),
        F.lit(threshold).alias("positive_rate_threshold"),
        ((rate < threshold) & F.lit(label_source == "hotspot_archive")).cast("int").alias("too_sparse"),
    )


@dataclass(frozen=True)
class Run:
    """What a dataset was built from; goes into its metadata as it is."""

    data_version: str
    label_source: str
    n_grid_cells: int
    n_obs_date_slices: int
    bbox: tuple[float, float, float, float]  # lon_min, lat_min, lon_max, lat_max
    resolution_m: float
    obs_freq: str
    hotspots: str | None = None
    note: str = ""
    placeholder_columns: tuple[str, ...] = ()


def observed(table: DataFrame, y: str = TARGET) -> tuple[DataFrame, Observation]:
    """``table`` with counters that its next write fills: rows, positives, unmapped land cover, bounds."""
    watch = Observation("dataset")
    no_class = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in LAND_COVER])
    measures = {
        "n_rows": F.count(F.lit(1)),
        "n_positive": F.count_if(F.col(y) == 1),
        "n_unmapped": F.count_if(no_class),
        "lat_min": F.min(F.col("lat").cast("double")),
        "lat_max": F.max(F.col("lat").cast("double")),
        "lon_min": F.min(F.col("lon").cast("double")),
        "lon_max": F.max(F.col("lon").cast("double")),
    }
    return table.observe(watch, *[m.alias(n) for n, m in measures.items()]), watch


def run_metadata(
    spark: SparkSession, seen: dict, run: Run, threshold: float = LabelSettings().min_positive_rate
) -> DataFrame:
    """One row from what the write has counted and what the run knows; the table is not read again.

    Cells and dates are those of the run's grid. Bounds of an empty table are null.
    """
    rate = seen["n_positive"] / seen["n_rows"] if seen["n_rows"] else 0.0
    west, south, east, north = run.bbox
    row = {
        "data_version": run.data_version,
        "label_source": run.label_source,
        "n_rows": seen["n_rows"],
        "n_grid_cells": run.n_grid_cells,
        "n_obs_date_slices": run.n_obs_date_slices,
        "n_positive": seen["n_positive"],
        "n_unmapped": seen["n_unmapped"],
        "positive_rate": rate,
        "positive_rate_threshold": threshold,
        "too_sparse": int(rate < threshold and run.label_source == "hotspot_archive"),
        "obs_freq": run.obs_freq,
        "grid_resolution_m": run.resolution_m,
        "bbox_lon_min": west,
        "bbox_lat_min": south,
        "bbox_lon_max": east,
        "bbox_lat_max": north,
        **{c: seen[c] for c in ("lat_min", "lat_max", "lon_min", "lon_max")},
        "hotspots": run.hotspots,
        "note": run.note,
        "placeholder_columns": ",".join(run.placeholder_columns),
    }
    return spark.createDataFrame([tuple(row.values())], METADATA)


METADATA = (
    "data_version string, label_source string, n_rows long, n_grid_cells long, n_obs_date_slices long, n_positive long,"
    " n_unmapped long, positive_rate double, positive_rate_threshold double, too_sparse int, obs_freq string,"
    " grid_resolution_m double, bbox_lon_min double, bbox_lat_min double, bbox_lon_max double, bbox_lat_max double,"
    " lat_min double, lat_max double, lon_min double, lon_max double, hotspots string, note string, placeholder_columns string"
)


def sparsity_gate(
    df: DataFrame, y: str = TARGET, threshold: float = LabelSettings().min_positive_rate
) -> DataFrame:
    """One row: positive rate and whether it falls below the threshold."""
    rate = F.coalesce(F.avg(F.when(F.col(y) == 1, 1.0).otherwise(0.0)), F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), rate.alias("positive_rate")).withColumn(
        "too_sparse", (F.col("positive_rate") < threshold).cast("int")
    )
