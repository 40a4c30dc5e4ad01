"""Incremental hotspot ingest: overlapping chunk files in, a duplicate-free table out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cinderfield.operators.archive import HOTSPOT_KEY
from cinderfield.sources.hotspots import HOTSPOT_SCHEMA, by_header, layout_schema


def stream_hotspot_files(
    spark: SparkSession, folder: str, layout: str, files_per_batch: int = 64, extra: T.StructType | None = None
) -> DataFrame:
    """Stream of hotspot CSV files of one layout landing in a folder.

    ``layout`` is a file with the header all files must have, for example the first
    chunk. Columns are taken by name; a file with another header stops the stream
    instead of filling columns by position. ``extra`` adds typed columns.
    """
    wanted = T.StructType(HOTSPOT_SCHEMA.fields + (extra.fields if extra else []))
    schema = layout_schema(spark, layout, wanted)
    files = by_header(spark.readStream).schema(schema).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return files.select(*[f"`{f.name}`" for f in wanted.fields if f.name in schema.names])


def dedup_stream(stream: DataFrame, overlap: str = "10 days") -> DataFrame:
    """Drop repeats of (place, detection date) that arrive within the archive overlap.

    State is bounded by the watermark: rows older than the newest date minus
    ``overlap`` are late and their keys are forgotten. Which copy of a key within
    one micro-batch survives is not defined, so columns outside the key may come
    from any of them; a batch dedup of the table (``dedup_hotspots``, with an order)
    is the authority for that and for anything later than the overlap. The event
    time must be TIMESTAMP, which the date already is in UTC.
    """
    timed = stream.withColumn("acq_date", F.col("acq_date").cast("timestamp"))
    return timed.withWatermark("acq_date", overlap).dropDuplicates(HOTSPOT_KEY)


_SEEN = "latitude array<double>, longitude array<double>, acq_date array<bigint>"
_DAY_MS = 86_400_000


def _keep_first(order_by: list[str], columns: list[str]):
    """Rows of one day and one-degree cell whose key was not seen before, of equal keys the first in order."""

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen = pd.DataFrame(dict(zip(HOTSPOT_KEY, state.get, strict=True))) if state.exists else None
        first, late = None, pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        for frame in frames:
            frame = frame[frame["acq_date"] >= late]
            both = frame if first is None else pd.concat([first, frame])
            first = both.sort_values(order_by, na_position="first", kind="stable").drop_duplicates(HOTSPOT_KEY)
        if first is None or first.empty:
            return
        keys = first[HOTSPOT_KEY].assign(acq_date=first["acq_date"].astype("datetime64[us]").astype("int64"))
        if seen is not None:
            fresh = ~pd.MultiIndex.from_frame(keys).isin(pd.MultiIndex.from_frame(seen))
            first, keys = first[fresh], keys[fresh]
        known = keys if seen is None else pd.concat([seen, keys])
        state.update(tuple(known[c].tolist() for c in HOTSPOT_KEY))
        state.setTimeoutTimestamp(int(key[0].timestamp() * 1000) + _DAY_MS)
        if len(first):
            yield first[columns]

    return keep


def keep_first_stream(stream: DataFrame, order_by: list[str], overlap: str = "10 days") -> DataFrame:
    """The first copy of each (place, detection date), all columns kept; later copies within the overlap go.

    Of the copies in one micro-batch the first in ``order_by`` stays, and what an
    earlier batch has emitted is never replaced: where chunks arrive in their order,
    that is the batch dedup of the whole archive. State is kept by day and
    one-degree cell, a list of the keys seen there, and ends by an event-time timer
    once the watermark (newest date minus ``overlap``) has passed the day; rows
    older than the watermark are late and go. A batch must hold whole chunks, and the
    session's time zone be UTC.
    """
    timed = stream.withColumn("acq_date", F.col("acq_date").cast("timestamp")).withWatermark("acq_date", overlap)
    cell = {"_day": F.date_trunc("day", "acq_date"), "_row": F.floor("latitude"), "_col": F.floor("longitude")}
    return timed.withColumns(cell).groupBy(*cell).applyInPandasWithState(
        _keep_first(order_by, timed.columns), timed.schema, _SEEN, "append", GroupStateTimeout.EventTimeTimeout
    )


def ingest_batches(
    stream: DataFrame, table_path: str, checkpoint_path: str, after_write: Callable[[int], None] | None = None
) -> StreamingQuery:
    """Like ``ingest``, but each micro-batch replaces its own folder of the table.

    A batch that was written and not committed, because the driver died in between,
    runs again with the same number and overwrites what it had left: nothing is
    added twice. ``after_write`` is called between the two.
    """

    def write(batch: DataFrame, number: int) -> None:
        named = batch.withColumn("ingest_batch", F.lit(number))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(table_path)
        if after_write:
            after_write(number)

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return started.outputMode("append").trigger(availableNow=True).start()


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path).drop("ingest_batch")


def ingest(stream: DataFrame, table_path: str, checkpoint_path: str) -> StreamingQuery:
    """Append what is there now and stop; run again to pick up new files exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
