"""Shared scratch space: where long plans are cut and intermediate tables land."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse.

    Both are shared by the driver and all executors. A temporary folder is not: on
    a cluster it would exist on one machine only and die with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/cinderfield-scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder, remembered for ``release``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame, name: str = "table", compression: str = "snappy") -> DataFrame:
    """Write ``df`` to shared scratch once and read it back.

    Later passes over it (k model fits, several metrics) then read columnar
    files instead of re-running the plan, and a lost executor costs one file
    split, not the whole upstream job. ``compression`` zstd makes tables that stay for
    a whole job smaller, for more time to write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all that this application wrote to scratch.

    To be called when a job's results are stored: frames that read settled tables
    are gone afterwards.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for text in _written.pop(spark.sparkContext.applicationId, []):
        path = hadoop.Path(text)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
