"""Image catalogue sources: annotated shards and image/label directories."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from cinderfield.functions.text import file_stem
from cinderfield.operators.images import catalogue, label_annotated, label_by_file, ordered_catalogue

CATALOGUE_SCHEMA = "path string, bytes binary, label int"
# Folder names that may stand for a split.
SPLIT_FOLDERS = {"train": ["train"], "val": ["val", "valid", "test"], "test": ["test"]}


def _opened(reader: DataFrameReader, path: str) -> DataFrame | None:
    """What is at the path or pattern, whose files are listed once; None if there is nothing."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _plain_path(encoded: Column) -> Column:
    """A percent-encoded file path as it is on disk; a plus sign stands for itself."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def read_shards(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Annotated Parquet shards of a split: many for ``train``, one for ``val``, else none."""
    pattern = {"train": f"{root}/*-train-*.parquet", "val": f"{root}/*-val.parquet"}.get(split)
    shards = None if pattern is None else _opened(spark.read.format("parquet"), pattern)
    if shards is None:
        return spark.createDataFrame([], CATALOGUE_SCHEMA)
    return label_annotated(shards.select("image", "annotations")).select(
        F.col("image.path").alias("path"), F.col("image.bytes").alias("bytes"), "label"
    )


def read_image_folders(spark: SparkSession, root: str, split: str) -> DataFrame:
    """``images/<split>/*.jpg|png`` with ``labels/<split>/<stem>.txt``; image bytes are not read."""
    for folder in SPLIT_FOLDERS.get(split, [split]):
        found = _opened(spark.read.format("binaryFile"), f"{root}/images/{folder}")
        if found is not None:
            break
    else:
        return spark.createDataFrame([], CATALOGUE_SCHEMA)
    images = found.select("path").filter(F.col("path").rlike(r"\.(jpg|png)$"))
    # The folder with a filter of names: of a pattern every single file would be a path to look up.
    texts = _opened(spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.txt"), f"{root}/labels/{folder}")
    if texts is not None:
        files = texts.select(
            file_stem(_plain_path(F.col("_metadata.file_path"))).alias("stem"), F.col("value").alias("content")
        )
    else:
        files = spark.createDataFrame([], "stem string, content string")
    return label_by_file(images, files).select(
        "path", F.lit(None).cast("binary").alias("bytes"), "label"
    )


def image_catalogue(
    spark: SparkSession, shard_root: str, folder_root: str, split: str = "train", seed: int = 42
) -> DataFrame:
    """Union of both sources; ``train`` in seeded order, other splits by path."""
    samples = catalogue(read_shards(spark, shard_root, split), read_image_folders(spark, folder_root, split))
    return ordered_catalogue(samples, split, "path", seed)
