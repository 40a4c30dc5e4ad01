"""Hourly weather files: JSON payloads and CSV."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.operators.weather import explode_hourly
from cinderfield.scratch import settle

HOURLY_JSON_SCHEMA = (
    "hourly struct<time:array<string>,temperature_2m:array<double>,"
    "relative_humidity_2m:array<double>,windspeed_10m:array<double>,winddirection_10m:array<double>>"
)
HOURLY_CSV_SCHEMA = (
    "time_utc timestamp_ntz, temp_c double, rh_pct double, wind_speed_ms double, wind_dir_deg double"
)


def read_hourly_json(spark: SparkSession, paths: str | list[str], wind_unit: str) -> DataFrame:
    """Payload files to hourly rows; a payload without ``hourly.time`` fails the job."""
    payload = spark.read.schema(HOURLY_JSON_SCHEMA).option("multiLine", True).json(paths)
    no_hours = F.raise_error(F.lit("weather payload has no 'hourly' data"))
    checked = payload.select(
        F.when(F.col("hourly.time").isNull(), no_hours.cast(payload.schema["hourly"].dataType))
        .otherwise(F.col("hourly"))
        .alias("hourly")
    )
    return explode_hourly(checked, wind_unit)


def read_hourly_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.schema(HOURLY_CSV_SCHEMA).option("header", True).option("comment", "#").csv(paths)
    )


BAD = "_bad"


@dataclass(frozen=True)
class Scan:
    """Hourly rows, and beside them what could not be read: ``file, record, reason``."""

    rows: DataFrame
    bad: DataFrame


def _with_bad(schema: str) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(BAD, T.StringType())])


def _split(parsed: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Parse once, to shared scratch; then the sound rows and the damaged ones are two readings of it."""
    kept = settle(parsed.select("*", F.col("_metadata.file_path").alias("file")), "weather")
    bad = kept.filter(F.col(BAD).isNotNull()).select("file", F.col(BAD).alias("record"), F.lit(reason).alias("reason"))
    return kept.filter(F.col(BAD).isNull()).drop(BAD), bad


def scan_hourly_csv(spark: SparkSession, paths: str | list[str]) -> Scan:
    """CSV files of hourly rows. A line that does not fit the columns and types is kept in ``bad``, not dropped."""
    reader = spark.read.schema(_with_bad(HOURLY_CSV_SCHEMA)).option("header", True).option("comment", "#")
    sound, bad = _split(reader.option("columnNameOfCorruptRecord", BAD).csv(paths), "not a row of the table")
    return Scan(sound.drop("file"), bad)


def scan_hourly_json(spark: SparkSession, paths: str | list[str], wind_unit: str) -> Scan:
    """Payload files, one JSON value a line. Text that is no JSON, payloads without hours and
    those whose arrays differ in length are kept in ``bad``."""
    parsed = spark.read.schema(_with_bad(HOURLY_JSON_SCHEMA)).option("columnNameOfCorruptRecord", BAD).json(paths)
    sound, bad = _split(parsed, "no JSON payload")
    sizes = [F.size(F.col(f"hourly.{f}")) for f in T.StructType.fromDDL(HOURLY_JSON_SCHEMA)["hourly"].dataType.names]
    even = F.col("hourly.time").isNotNull()
    for size in sizes[1:]:
        even = even & (size == sizes[0])
    even = F.coalesce(even, F.lit(False))
    uneven = sound.filter(~even).select("file", F.to_json("hourly").alias("record"), F.lit("hours missing or of unequal length").alias("reason"))
    return Scan(explode_hourly(sound.filter(even).select("hourly"), wind_unit), bad.unionByName(uneven))


def optional(spark: SparkSession, path: str | None, read, on_missing: Literal["error", "placeholder"] = "error"):
    """``read(path)``, or None where the source is absent and may be: its features then are placeholders.

    Only a path that is not given or does not exist counts as absent; a file that is
    there and cannot be read always fails.
    """
    if path is not None:
        try:
            spark.read.format("binaryFile").load(path)
            return read(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if on_missing == "placeholder":
        return None
    raise FileNotFoundError(f"source {path} is missing; pass on_missing='placeholder' to go on without it")
