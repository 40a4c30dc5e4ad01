"""Text rules: confidence levels, annotation labels, file stems, tile names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One-letter confidence codes.
CONFIDENCE_CODES = {"l": "low", "n": "nominal", "h": "high"}


# Percent from which a numeric confidence is nominal, and high.
NUMERIC_BOUNDS = (30.0, 80.0)


def confidence_level(raw: Column, numeric_bounds: tuple[float, float] | None = None) -> Column:
    """Trimmed lower-case level with one-letter codes spelled out; other text unchanged.

    With ``numeric_bounds`` (``NUMERIC_BOUNDS`` is what sensors with a percent scale
    publish) numbers from 0 to 100 become low, nominal or high; others stay text.
    """
    text = F.lower(F.trim(raw.cast("string")))
    level = text
    for code, word in CONFIDENCE_CODES.items():
        level = F.when(text == code, F.lit(word)).otherwise(level)
    if numeric_bounds is None:
        return level
    nominal, high = numeric_bounds
    percent = text.try_cast("double")
    named = F.when(percent < nominal, F.lit("low")).when(percent < high, F.lit("nominal")).otherwise(F.lit("high"))
    return F.when(percent.between(0, 100), named).otherwise(level)


def any_box_label(annotations: Column) -> Column:
    """1 when the annotation text holds anything but white space, else 0."""
    blank = F.coalesce(F.regexp_replace(annotations, r"\s+", ""), F.lit("")) == ""
    return F.when(blank, 0).otherwise(1)


def class_line_label(content: Column, classes: tuple[str, ...] = ("0", "1")) -> Column:
    """1 when any line's first token is one of ``classes``; missing text gives 0.

    One regular expression over the whole text: line start, optional blanks,
    a class token, then a blank or the end of the line.
    """
    tokens = "|".join(classes)
    hit = content.rlike(rf"(?m)^[^\S\r\n]*(?:{tokens})(?=\s|\z)")
    return F.when(F.coalesce(hit, F.lit(False)), 1).otherwise(0)


def file_stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def tile_label(lat: Column, lon: Column, pattern: str) -> Column:
    """Tile name from its corner: hemisphere letter plus zero-padded degrees."""
    ns = F.when(lat >= 0, F.lit("N")).otherwise(F.lit("S"))
    ew = F.when(lon >= 0, F.lit("E")).otherwise(F.lit("W"))
    return F.format_string(
        pattern, ns, F.abs(lat).cast("int"), ew, F.abs(lon).cast("int")
    )
