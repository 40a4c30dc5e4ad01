"""The feature table: load with its contract, write in contract order, run records as JSON."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.contract import DATASET_COLUMNS, FEATURES, TARGET, SplitSettings, fields
from cinderfield.operators.placeholders import synthetic_dataset
from cinderfield.operators.quality import Run, observed, require_columns, run_metadata

DAY_FOLDER = "obs_day"
ROWS_PER_FILE = 2_000_000
# A table is written as it is dealt where no file gets fewer rows than FEWEST_PER_FILE by that.
ROWS_PER_TASK, FEWEST_PER_FILE = 1_000_000, 20_000


def to_contract(df: DataFrame) -> DataFrame:
    """Keys, features and target in contract order, each cast to its declared type."""
    require_columns(df, DATASET_COLUMNS, "feature table")
    typed = [F.col(f.name).cast(f.spark_type).alias(f.name) for f in fields()]
    return df.select(
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.col("obs_date").cast("timestamp_ntz").alias("obs_date"),
        *typed,
    )


def write_feature_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    rows_per_day: int | None = None,
    n_days: int | None = None,
    compression: str | None = None,
) -> None:
    """Parquet in folders by observation day, or CSV with header; files hold ROWS_PER_FILE rows at most.

    The folders are named by a copy of the date, so the table in the files keeps
    its columns, order and types. Where days are long and few, each task writes what it
    has to every folder and the wide rows do not move (``_tasks_in_place``). Else they are
    dealt by day and a salt of the place: a day goes to as many tasks as it fills files,
    and a task writes to few folders. ``rows_per_day`` and ``n_days``, where the caller
    knows them (the cells and dates of a grid), spare the job that counts them.
    ``compression`` is the files' codec if it is not to be Spark's default (none for CSV).
    """
    table = to_contract(df)
    how = {"maxRecordsPerFile": ROWS_PER_FILE} | ({"compression": compression} if compression else {})
    if fmt == "csv":
        table.write.mode(mode).options(header=True, **how).csv(path)
        return
    day = F.col("obs_date").cast("date")
    if rows_per_day is None or n_days is None:
        size = table.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(day).alias("days")).first()
        rows_per_day, n_days = size["n"] // max(1, size["days"]), size["days"]
    dealt = table.withColumn(DAY_FOLDER, day)
    tasks = _tasks_in_place(df.sparkSession, rows_per_day, n_days)
    if tasks:
        dealt = dealt.coalesce(tasks)
    else:
        salts = 1 + rows_per_day // ROWS_PER_FILE
        dealt = dealt.repartition(DAY_FOLDER, F.pmod(F.xxhash64("lat", "lon"), F.lit(salts)))
    dealt.write.mode(mode).options(**how).partitionBy(DAY_FOLDER).parquet(path)


def _tasks_in_place(spark: SparkSession, rows_per_day: int, n_days: int) -> int | None:
    """How many tasks write a table without moving its rows, at most one file each for a day; None: files would be too small."""
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows_per_day * n_days / ROWS_PER_TASK))
    return tasks if rows_per_day >= tasks * FEWEST_PER_FILE else None


def write_dataset(df: DataFrame, path: str, run: Run, rows_per_day: int | None = None) -> DataFrame:
    """Write the table by day and return its metadata row, counted while it was written."""
    table, watch = observed(df)
    write_feature_table(table, path, rows_per_day=run.n_grid_cells if rows_per_day is None else rows_per_day, n_days=run.n_obs_date_slices)
    return run_metadata(df.sparkSession, watch.get, run)


def load_feature_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    n_rows: int = 5000,
    settings: SplitSettings | None = None,
    days: DataFrame | tuple[str, str] | None = None,
) -> DataFrame:
    """Feature table from files, or placeholder rows when there is no path.

    ``days`` keeps a range of days (both ends included) or those of a table with a
    column ``day``; other day folders are not opened: a range is pruned when the
    query is planned, a table while it runs.

    A missing contract column is an error. Contract columns come first, in contract
    order and type, whatever the file's; further columns follow as they are.
    """
    if path is None:
        return synthetic_dataset(spark.range(n_rows), "id", settings)
    if fmt == "csv":
        types = {f.name: f.spark_type for f in fields()}
        types.update(lat=T.DoubleType(), lon=T.DoubleType(), obs_date=T.TimestampNTZType())
        names = spark.read.option("header", True).option("comment", "#").csv(path).columns
        schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in names])
        df = spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)
    else:
        df = spark.read.parquet(path)
    df = _of_days(df, days, F.col(DAY_FOLDER) if DAY_FOLDER in df.columns else F.col("obs_date").cast("date")).drop(DAY_FOLDER)
    require_columns(df, FEATURES + [TARGET], "feature table")
    types = {f.name: f.spark_type for f in fields()}
    types.update(lat=T.DoubleType(), lon=T.DoubleType(), obs_date=T.TimestampNTZType())
    ordered = [c for c in DATASET_COLUMNS if c in df.columns] + [c for c in df.columns if c not in DATASET_COLUMNS]
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in ordered])


def _of_days(df: DataFrame, days: DataFrame | tuple[str, str] | None, day: Column) -> DataFrame:
    if days is None:
        return df
    if isinstance(days, DataFrame):
        # Spark prunes folders by a side that has a condition of its own.
        wanted = days.select(F.col("day").cast("date").alias("_wanted")).distinct().filter(F.col("_wanted") > F.lit("0001-01-01").cast("date"))
        return df.join(wanted, day == F.col("_wanted"), "left_semi")
    first, last = (F.lit(d).cast("date") for d in days)
    return df.filter(day.between(first, last))


def write_record(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Small result tables (metadata, metrics, importances) as one JSON file."""
    record.coalesce(1).write.mode(mode).json(path)
