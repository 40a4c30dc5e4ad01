"""Weather: hourly payloads to rows, and weather columns for a cell table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.functions import weather as formulas
from cinderfield.functions.scalars import circular

# Payload field -> column.
HOURLY_FIELDS = {
    "time": "time_utc",
    "temperature_2m": "temp_c",
    "relative_humidity_2m": "rh_pct",
    "windspeed_10m": "wind_speed_ms",
    "winddirection_10m": "wind_dir_deg",
}
WIND_TO_MS = {"ms": 1.0, "kmh": 1.0 / 3.6}


def explode_hourly(payload: DataFrame, wind_unit: str, keep: list[str] | None = None) -> DataFrame:
    """``hourly`` struct of parallel arrays to one row per hour, columns renamed.

    ``wind_unit`` says what the source delivers (``ms`` or ``kmh``); there is no
    silent scaling.
    """
    if wind_unit not in WIND_TO_MS:
        raise ValueError(f"wind_unit must be one of {sorted(WIND_TO_MS)}")
    if "hourly" not in payload.columns:
        raise ValueError(f"payload has no 'hourly' data, columns: {payload.columns}")
    inner = payload.select("hourly.*").columns
    missing = [f for f in HOURLY_FIELDS if f not in inner]
    if missing:
        raise ValueError(f"hourly data lacks {missing}")
    keep = keep or []
    hours = payload.select(
        *keep, F.explode(F.arrays_zip(*[F.col(f"hourly.{f}").alias(f) for f in HOURLY_FIELDS])).alias("_h")
    )
    columns = {}
    for source, name in HOURLY_FIELDS.items():
        value = F.col(f"_h.{source}")
        if name == "time_utc":
            columns[name] = value.cast("timestamp_ntz")
        elif name == "wind_speed_ms":
            columns[name] = value.cast("double") * WIND_TO_MS[wind_unit]
        else:
            columns[name] = value.cast("double")
    return hours.select(*keep, *[c.alias(n) for n, c in columns.items()])


def mean_weather(hourly: DataFrame, direction: str = "arithmetic") -> DataFrame:
    """One row of means; null when there are no hours.

    Wind direction is averaged as a plain number by default; ``circular``
    averages the direction vectors instead.
    """
    east, north = circular(F.col("wind_dir_deg"))
    if direction == "arithmetic":
        heading = F.avg("wind_dir_deg")
    elif direction == "circular":
        heading = F.pmod(F.degrees(F.atan2(F.avg(east), F.avg(north))) + 360.0, F.lit(360.0))
    else:
        raise ValueError(f"unknown direction mean: {direction}")
    return hourly.agg(
        F.avg("temp_c").alias("temp_c"),
        F.avg("rh_pct").alias("rh_pct"),
        F.avg("wind_speed_ms").alias("wind_speed_ms"),
        heading.alias("wind_dir_deg"),
    )


def attach_weather(df: DataFrame, hourly: DataFrame, direction: str = "arithmetic") -> DataFrame:
    """``df`` plus the seven weather features from the means of the whole series.

    The means enter as a scalar subquery: no join, nothing read on the driver.
    With no hours the columns ``df`` already has are kept.
    """
    means = mean_weather(hourly, direction)
    one = means.select(F.struct(*means.columns).alias("w")).scalar()
    base = df.withColumn("_w", one)
    t, rh, wind = F.col("_w.temp_c"), F.col("_w.rh_pct"), F.col("_w.wind_speed_ms")
    east, north = circular(F.col("_w.wind_dir_deg"))
    fresh = {
        "temp_c": t,
        "rh_pct": rh,
        "wind_speed_ms": wind,
        "wind_dir_sin": east,
        "wind_dir_cos": north,
        "vpd_kpa": formulas.vpd(t, rh),
        "ffmc_approx": formulas.ffmc(t, rh, wind),
    }
    columns = {
        name: F.coalesce(value, F.col(name).cast("double")) if name in df.columns else value
        for name, value in fresh.items()
    }
    return base.withColumns(columns).drop("_w")
