"""Hotspot CSV files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.contract import HOTSPOT_COLUMNS

HOTSPOT_SCHEMA = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("acq_date", T.TimestampNTZType()),
        T.StructField("confidence", T.StringType()),
    ]
)


def empty_hotspots(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HOTSPOT_SCHEMA)


def read_hotspots(
    spark: SparkSession, paths: str | list[str], extra: T.StructType | None = None
) -> DataFrame:
    """Hotspots of CSV files with header; lines starting with ``#`` are skipped.

    ``paths`` is one or many files, folders or globs. Columns are matched to each
    file's own header by name: one distributed pass finds every file's header, and
    files of equal layout are read together. ``extra`` adds typed columns; without
    it only the four needed columns are parsed. A file without one of them fails, a
    header-only or blank file adds no row.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = T.StructType(HOTSPOT_SCHEMA.fields + (extra.fields if extra else []))
    frames = [_read_one_layout(spark, files, schema) for files in files_by_layout(spark, paths)]
    if not frames:
        return empty_hotspots(spark)
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def file_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file with a line that is neither blank nor a comment: its percent-encoded name and its first such line."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        "value",
    )
    text = F.trim("value")
    # Of text alone Spark aggregates by sorting, here all lines of a task; beside a collected
    # set, of nothing, it keeps one line for each file instead.
    nothing = F.collect_set(F.lit(None).cast("int")).alias("nothing")
    return lines.filter((text != "") & ~text.startswith("#")).groupBy("file").agg(F.min_by("value", "place").alias("header"), nothing)


def files_by_layout(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files behind ``paths``, grouped by their header line.

    One job over all files; a file's name and header come back, as they do for any
    file listing. File names leave Spark percent-encoded and are decoded here.
    """
    if not paths:
        return []
    groups: dict[str, list[str]] = {}
    for row in file_headers(spark, paths).orderBy("file").collect():
        groups.setdefault(row["header"].strip(), []).append(unquote(row["file"]))
    return list(groups.values())


def layout_schema(spark: SparkSession, path: str, wanted: T.StructType) -> T.StructType:
    """Schema of a file in the order of its header: wanted columns typed, all others text."""
    types = {f.name: f.dataType for f in wanted.fields}
    header = spark.read.option("header", True).option("comment", "#").csv(path).columns
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    missing = [c for c in HOTSPOT_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"hotspot file {path} lacks {missing}")
    return schema


def by_header(reader):
    """CSV options under which a file whose header differs from the schema fails."""
    return reader.option("header", True).option("comment", "#").option("enforceSchema", False)


def _read_one_layout(spark: SparkSession, files: list[str], wanted: T.StructType) -> DataFrame:
    schema = layout_schema(spark, files[0], wanted)
    df = by_header(spark.read).schema(schema).csv(files)
    return df.select(*[f"`{f.name}`" for f in wanted.fields if f.name in schema.names])
