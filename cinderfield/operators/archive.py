"""Hotspot archive: union of chunks, keep-first dedup, coverage per time chunk."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOTSPOT_KEY = ["latitude", "longitude", "acq_date"]


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """All rows of all chunks; a column missing in one chunk is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def dedup_hotspots(df: DataFrame, order_by: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row per place and detection date: the first in ``order_by``.

    ``order_by`` must rank copies fully for a reproducible pick. Spark applies
    the row limit per map partition too, so a key with very many copies is cut
    down before the shuffle.
    """
    keys = keys or HOTSPOT_KEY
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")


def archive_coverage(
    df: DataFrame, start: str, end: str, chunk_days: int, date_column: str = "acq_date"
) -> DataFrame:
    """Hotspots per chunk of at most ``chunk_days`` days, empty chunks included, last one clipped."""
    if chunk_days < 1:
        raise ValueError(f"chunk_days must be at least 1, got {chunk_days}")
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last:
        raise ValueError(f"start {start} lies after end {end}")
    days = (last - first).days + 1
    n_chunks = -(-days // chunk_days)
    offset = F.datediff(F.col(date_column).cast("date"), F.lit(start).cast("date"))
    counts = (
        df.filter((offset >= 0) & (offset < days))
        .groupBy(F.floor(offset / chunk_days).alias("chunk"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    begin = (F.col("id") * chunk_days).cast("int")
    chunks = df.sparkSession.range(n_chunks).select(
        F.col("id").alias("chunk"),
        F.date_add(F.lit(start).cast("date"), begin).alias("chunk_start"),
        F.least(F.lit(chunk_days), F.lit(days) - begin).cast("int").alias("span_days"),
    )
    return chunks.join(counts, "chunk", "left").select(
        "chunk", "chunk_start", "span_days", F.coalesce("n", F.lit(0).cast("long")).alias("n_hotspots")
    )
