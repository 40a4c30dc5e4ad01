"""Small column helpers: clamp, circular encoding, time in microseconds, keyed hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def clamp(x: Column, low: float, high: float) -> Column:
    """Inclusive clip. Null and NaN give null: ``least``/``greatest`` alone would turn them into a bound."""
    clipped = F.greatest(F.least(x, F.lit(float(high))), F.lit(float(low)))
    return F.when(x <= F.lit(float("inf")), clipped)


def circular(degrees: Column) -> tuple[Column, Column]:
    """Direction in degrees as (sin, cos)."""
    rad = F.radians(degrees)
    return F.sin(rad), F.cos(rad)


def as_timestamp(x: Column) -> Column:
    """String, date or timestamp as TIMESTAMP_NTZ, so no step can see a DST jump."""
    return x.cast("timestamp_ntz")


def midnight(x: Column) -> Column:
    return F.date_trunc("day", as_timestamp(x)).cast("timestamp_ntz")


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, free of the session time zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return days * F.lit(DAY_US) + seconds.cast("long") * F.lit(1_000_000) + micros


def hash_text(key: Column, seed: int, name: str = "") -> Column:
    """MD5 of ``key|seed|name``: the same for a row whatever its partition."""
    suffix = f"|{seed}|{name}" if name else f"|{seed}"
    return F.md5(F.concat(key.cast("string"), F.lit(suffix)))


def hash_uniform(key: Column, seed: int, name: str) -> Column:
    """Uniform in [0, 1) from the first 48 bits of the keyed hash.

    ``rand(seed)`` depends on partitioning and row order; this does not.
    """
    head = F.conv(F.substring(hash_text(key, seed, name), 1, 12), 16, 10)
    return head.cast("double") / F.lit(float(2**48))
