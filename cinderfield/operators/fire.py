"""Fire label and fire history of (place, observation date) rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.contract import FIRE_HISTORY, NO_FIRE_DAYS, TARGET, LabelSettings
from cinderfield.functions.scalars import DAY_US, as_timestamp, clamp, epoch_us
from cinderfield.functions.text import confidence_level
from cinderfield.operators.circles import NEVER
from cinderfield.operators.grid import date_steps, obs_dates
from cinderfield.operators.spatial import ROWS_PER_SLICE, radius_fold, radius_windows
from cinderfield.scratch import settle

DENSITY, DAYS_SINCE = FIRE_HISTORY


def filter_confidence(
    hotspots: DataFrame,
    levels: tuple[str, ...] = LabelSettings().confidence_levels,
    numeric_bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Keep the wanted confidence levels; a table without the column is kept whole.

    Null confidence matches no level and is dropped; so is a number, unless
    ``numeric_bounds`` say which level it stands for.
    """
    if "confidence" not in hotspots.columns:
        return hotspots
    wanted = [level.lower() for level in levels]
    return hotspots.filter(confidence_level(F.col("confidence"), numeric_bounds).isin(wanted))


def window_ends(dates: list[int], s: LabelSettings) -> np.ndarray:
    """Per observation date (microseconds): up to when the label, what precedes it, the past, and what precedes that count."""
    offsets = (s.label_days * DAY_US, DAY_US - 1, -s.buffer_days * DAY_US, -s.history_days * DAY_US - 1)
    return np.array([[date + offset for offset in offsets] for date in dates], np.int64).reshape(len(dates), len(offsets))


def fold_times(fires: DataFrame, ends: np.ndarray) -> DataFrame:
    """``_t`` as the first of ``ends`` at or after ``_at``: alike in every window. Later detections are in none and go."""
    if not len(ends):
        return fires.filter(F.lit(False)).withColumn("_t", F.col("_at"))

    @F.pandas_udf("long")
    def next_end(at: pd.Series) -> pd.Series:
        return pd.Series(ends[np.minimum(np.searchsorted(ends, at.to_numpy()), len(ends) - 1)])

    return fires.filter(F.col("_at") <= int(ends[-1])).withColumn("_t", next_end("_at"))


def _observation_time(ts: Column, exact_times: bool) -> Column:
    if exact_times:
        return ts
    at_midnight = ts.isNull() | (ts == F.date_trunc("day", ts).cast("timestamp_ntz"))
    timed = F.raise_error(F.lit("obs_date has a time of day; pass exact_times=True"))
    return F.when(at_midnight, ts).otherwise(timed.cast("timestamp_ntz"))


def _fires(hotspots: DataFrame, s: LabelSettings) -> DataFrame:
    wanted = filter_confidence(hotspots, s.confidence_levels).filter(F.col("acq_date").isNotNull())
    return wanted.select("latitude", "longitude", epoch_us(as_timestamp(F.col("acq_date"))).alias("_at"))


def _folded(fires: DataFrame) -> DataFrame:
    return fires.groupBy("latitude", "longitude", "_t").agg(F.count(F.lit(1)).alias("_n"), F.max("_at").alias("_at"))


def place_history(
    places: DataFrame,
    dates: list[int],
    hotspots: DataFrame,
    settings: LabelSettings | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Fire history of distinct places (``_plat, _plon``) at observation dates (microseconds, rising): a row per place.

    ``_ahead, _past, _last`` are arrays with an element per date (``spatial.radius_windows``);
    ``at_date`` turns an element into the three columns. Detections may carry a time. Those
    that no end of any window separates are alike: they fold to one time, with their number
    and latest time kept. Places without a detection near are left out.
    """
    s = settings or LabelSettings()
    ends = window_ends(dates, s)
    fires = _folded(fold_times(_fires(hotspots, s), np.unique(ends)))
    # Both are read several times: written once, so the input tables themselves are scanned once.
    spots = settle(places.select(F.col("_plat").cast("double"), F.col("_plon").cast("double")), "places", "zstd")
    fires = settle(fires.select("latitude", "longitude", "_n", "_at"), "fires", "zstd")
    return radius_windows(spots, fires, s.radius_m, ends, ("_plat", "_plon"), rows_per_slice=rows_per_slice)


def at_date(t: Column, ahead: Column, past: Column, last: Column, settings: LabelSettings) -> dict[str, Column]:
    """Label, count and days since the last fire at an observation time, from elements of ``place_history``; null ones: no fire."""
    gap = (t - settings.buffer_days * DAY_US - F.nullif(last, F.lit(NEVER))) / float(DAY_US) + float(settings.buffer_days)
    return {
        TARGET: F.coalesce(ahead, F.lit(False)).cast("byte"),
        DENSITY: F.coalesce(past, F.lit(0)).cast("double"),
        DAYS_SINCE: clamp(F.coalesce(gap, F.lit(NO_FIRE_DAYS)), 0.0, NO_FIRE_DAYS),
    }


def with_history(
    df: DataFrame, hotspots: DataFrame, start: str, end: str, freq: str = "MS", settings: LabelSettings | None = None
) -> DataFrame:
    """``df`` (with ``lat, lon``) at every observation date of a calendar, plus its fire history.

    Rows meet their place's history before they are expanded by date, so nothing moves
    once for each date.
    """
    s = settings or LabelSettings()
    t = epoch_us(F.col("obs_date")).alias("t")
    dates = [r["t"] for r in obs_dates(df.sparkSession, start, end, freq).select(t).orderBy("t").collect()]
    df = df.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    places = df.select(F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).distinct()
    history = place_history(places, dates, hotspots, s)
    met = history.join(df, (F.col("_plat") == F.col("lat")) & (F.col("_plon") == F.col("lon")), "right")
    steps = date_steps(F.lit(start), F.lit(end), freq)
    each = F.transform(
        steps, lambda d, i: F.struct(d.alias("d"), F.get("_ahead", i).alias("ahead"), F.get("_past", i).alias("past"), F.get("_last", i).alias("last"))
    )
    dated = met.select(*df.columns, F.explode(each).alias("_h")).select(*df.columns, F.col("_h.d").alias("obs_date"), "_h")
    element = at_date(epoch_us(F.col("obs_date")), F.col("_h.ahead"), F.col("_h.past"), F.col("_h.last"), s)
    return dated.withColumns(element).drop("_h")


def fire_history(
    obs: DataFrame,
    hotspots: DataFrame,
    settings: LabelSettings | None = None,
    places: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    exact_times: bool = False,
) -> DataFrame:
    """Label, one-year count and days since the last fire per distinct (lat, lon, obs_date).

    ``obs`` needs ``lat, lon, obs_date``. Windows, all ends inclusive:
    label ``[obs+1d, obs+label_days]``, count ``[obs-history_days, obs-buffer_days]``,
    last fire ``<= obs-buffer_days``. ``places`` may give the distinct ``lat, lon``
    of ``obs`` when the caller already has them; ``obs`` must then be distinct too.

    Observation dates lie at midnight; one with a time of day fails the job unless
    ``exact_times`` is set. Without it each place has one row with its history at every
    distinct observation date of the table (``place_history``), and an observation looks
    its own up. These dates, bounded by the calendar, are read on the driver. With
    ``exact_times`` detections fold per distinct time only, and detections and observations
    of a place are merged in time order: each window is a difference of two running sums.

    The radius search runs once per place, not once per date, and no pair is a row.
    """
    s = settings or LabelSettings()
    asked = obs.select(
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        _observation_time(as_timestamp(F.col("obs_date")), exact_times).alias("obs_date"),
    )
    if places is None:
        asked = asked.distinct()
        places = asked.select("lat", "lon").distinct()
    places = places.select(F.col("lat").cast("double").alias("_plat"), F.col("lon").cast("double").alias("_plon"))
    if exact_times:
        return _timeline(asked, places, hotspots, s, rows_per_slice)
    return _attached(asked, places, hotspots, s, rows_per_slice)


def _attached(obs: DataFrame, places: DataFrame, hotspots: DataFrame, s: LabelSettings, rows_per_slice: int) -> DataFrame:
    """``obs`` plus its fire history, looked up in its place's row by the number of its date.

    Observations of a place that follow each other meet its history as one row.
    """
    when = _observation_time(as_timestamp(F.col("obs_date")), False)
    times = obs.select(epoch_us(when).alias("_ot"))
    dates = sorted(r["_ot"] for r in times.filter("_ot is not null").distinct().collect())
    history = place_history(places, dates, hotspots, s, rows_per_slice)
    types = dict(obs.dtypes)
    whole = [c for c in ("lat", "lon") if types[c] == "double"]  # the keys themselves
    rest = {c: f"_c{i}" for i, c in enumerate(obs.columns) if c not in whole}
    keyed = obs.select(*[F.col(c).cast("double").alias(f"_o{c}") for c in ("lat", "lon")], *[F.col(c).alias(own) for c, own in rest.items()])
    met = packed(keyed, ["_olat", "_olon"]).join(history, (F.col("_olat") == F.col("_plat")) & (F.col("_olon") == F.col("_plon")), "left")
    met = met.select("_olat", "_olon", "_ahead", "_past", "_last", F.explode(F.arrays_zip(*rest.values())).alias("_row"))
    met = met.select("_ahead", "_past", "_last", *[(F.col(f"_o{c}") if c in whole else F.col(f"_row.{rest[c]}")).alias(c) for c in obs.columns])
    met = met.withColumn("_ot", epoch_us(when))
    calendar = F.lit(dates) if dates else F.array().cast("array<bigint>")
    met = met.withColumn("_i", (F.array_position(calendar, F.col("_ot")) - 1).cast("int"))
    element = at_date(F.col("_ot"), *[F.get(c, F.col("_i")) for c in ("_ahead", "_past", "_last")], s)
    return met.select(*obs.columns, *[c.alias(name) for name, c in element.items()])


def packed(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with rows that follow each other and agree in ``keys`` (double) as one row, the other columns as arrays.

    Nothing is moved or sorted for it, and no array is longer than an Arrow batch. Rows of
    a key that lie apart stay apart.
    """
    schema = T.StructType([f if f.name in keys else T.StructField(f.name, T.ArrayType(f.dataType)) for f in df.schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # Compared by their bits: a null or NaN agrees with none, and zeros of unlike signs stay apart.
            held = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in keys]
            first = np.ones(batch.num_rows, bool)
            first[1:] = np.any([(h.view(np.int64)[1:] != h.view(np.int64)[:-1]) | np.isnan(h[1:]) for h in held], axis=0)
            starts = np.flatnonzero(first)
            offsets = pa.array(np.append(starts, batch.num_rows).astype(np.int32))
            columns = [batch.column(f.name).take(pa.array(starts)) if f.name in keys else pa.ListArray.from_arrays(offsets, batch.column(f.name)) for f in schema.fields]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(pack, schema)


def _timeline(asked: DataFrame, places: DataFrame, hotspots: DataFrame, s: LabelSettings, rows_per_slice: int) -> DataFrame:
    """``asked``, distinct observations at any time of day, plus their fire history."""
    fires = _folded(_fires(hotspots, s).withColumn("_t", F.col("_at")))
    # Both are read several times by the fold: written once, so the input tables
    # themselves are scanned once.
    spots, fires = settle(places, "places"), settle(fires, "fires")
    near = radius_fold(
        spots, fires, s.radius_m, ("_plat", "_plon"), rows_per_slice=rows_per_slice, merged=False
    )
    timeline = near.select(
        F.col("_plat").alias("lat"),
        F.col("_plon").alias("lon"),
        F.lit(None).cast("timestamp_ntz").alias("obs_date"),
        "_t",
        "_n",
        "_at",
        F.lit(False).alias("_asked"),
    ).unionByName(
        asked.select(
            "lat",
            "lon",
            "obs_date",
            epoch_us(F.col("obs_date")).alias("_t"),
            F.lit(0).cast("long").alias("_n"),
            F.lit(None).cast("long").alias("_at"),
            F.lit(True).alias("_asked"),
        )
    )
    by_time = Window.partitionBy("lat", "lon").orderBy("_t")

    def seen_by(offset_us: int) -> Column:
        frame = by_time.rangeBetween(Window.unboundedPreceding, offset_us)
        return F.coalesce(F.sum("_n").over(frame), F.lit(0).cast("long"))

    cut = -s.buffer_days * DAY_US
    last = F.max("_at").over(by_time.rangeBetween(Window.unboundedPreceding, cut))
    windows = timeline.select(
        "lat",
        "lon",
        "obs_date",
        "_t",
        "_asked",
        (seen_by(s.label_days * DAY_US) - seen_by(DAY_US - 1)).alias("_ahead"),
        (seen_by(cut) - seen_by(-s.history_days * DAY_US - 1)).alias("_past"),
        last.alias("_last"),
    ).filter("_asked")
    gap = (F.col("_t") + cut - F.col("_last")) / float(DAY_US) + float(s.buffer_days)
    return windows.select(
        "lat",
        "lon",
        "obs_date",
        (F.col("_ahead") > 0).cast("byte").alias(TARGET),
        F.col("_past").cast("double").alias(DENSITY),
        clamp(F.coalesce(gap, F.lit(NO_FIRE_DAYS)), 0.0, NO_FIRE_DAYS).alias(DAYS_SINCE),
    )


def fire_labels(
    obs: DataFrame,
    hotspots: DataFrame,
    settings: LabelSettings | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    exact_times: bool = False,
) -> DataFrame:
    """``obs`` plus target, one-year count and days since the last fire; rows are kept one to one."""
    base = obs.drop(TARGET, DENSITY, DAYS_SINCE)
    if not exact_times:
        places = base.select(F.col("lat").cast("double").alias("_plat"), F.col("lon").cast("double").alias("_plon")).distinct()
        return _attached(base, places, hotspots, settings or LabelSettings(), rows_per_slice)
    history = fire_history(
        obs, hotspots, settings, rows_per_slice=rows_per_slice, exact_times=exact_times
    ).select(
        F.col("lat").alias("_hlat"),
        F.col("lon").alias("_hlon"),
        F.col("obs_date").alias("_hdate"),
        TARGET,
        DENSITY,
        DAYS_SINCE,
    )
    match = (
        (F.col("lat").cast("double") == F.col("_hlat"))
        & (F.col("lon").cast("double") == F.col("_hlon"))
        & as_timestamp(F.col("obs_date")).eqNullSafe(F.col("_hdate"))
    )
    joined = base.join(history, match, "left")
    return joined.select(*base.columns, TARGET, DENSITY, DAYS_SINCE)
