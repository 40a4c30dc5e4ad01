"""Row generators: grid cells, observation dates, raster tiles covering a box."""

from __future__ import annotations

import math
from typing import NamedTuple, NoReturn

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderfield.contract import EARTH_CIRCUMFERENCE_M
from cinderfield.functions.text import tile_label

# Published tile names and grid steps in degrees.
ELEVATION_TILE = "Copernicus_DSM_COG_10_%s%02d_00_%s%03d_00_DEM"
LAND_COVER_TILE = "ESA_WorldCover_10m_2021_v200_%s%02d%s%03d_Map"
TILE_DEGREES = {"elevation": 1, "land_cover": 3}

DEGREES_PER_M = 360.0 / EARTH_CIRCUMFERENCE_M


class Box(NamedTuple):
    """Degrees; west lies before east and south before north."""

    west: float
    south: float
    east: float
    north: float

    @staticmethod
    def refuse(what: object) -> NoReturn:
        raise ValueError(f"not a box of rising west,south,east,north: {what}")

    def checked(self) -> Box:
        rising = self.west < self.east and self.south < self.north
        return self if rising else self.refuse(tuple(self))


def parse_bbox(text: str) -> Box:
    """The box named by west, south, east and north in degrees, joined by commas."""
    if text.count(",") + 1 != len(Box._fields):
        Box.refuse(text)
    return Box._make(map(float, text.split(","))).checked()


def in_bbox(
    df: DataFrame,
    bbox: tuple[float, float, float, float],
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Rows inside the box, edges included; a plain range filter that reaches the scan."""
    lon_min, lat_min, lon_max, lat_max = bbox
    return df.filter(
        F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max)
    )


def _axis(low: float, high: float, step: float) -> tuple[float, int]:
    start = low + step / 2.0
    n = math.ceil((high - start) / step)
    return (start, n) if n > 0 else ((low + high) / 2.0, 1)


def grid_cells(
    spark: SparkSession, bbox: tuple[float, float, float, float], resolution_m: float
) -> DataFrame:
    """Cell centres every ``resolution_m`` metres: ``cell_id, lat, lon``, latitude outermost.

    ``cell_id`` is split into its row and column by arithmetic, so the grid is
    produced in parallel without joining two axes.
    """
    lon_min, lat_min, lon_max, lat_max = bbox
    step_lat = resolution_m * DEGREES_PER_M
    step_lon = step_lat / math.cos(math.radians((lat_min + lat_max) / 2.0))
    lat0, n_lat = _axis(lat_min, lat_max, step_lat)
    lon0, n_lon = _axis(lon_min, lon_max, step_lon)
    row = F.floor(F.col("id") / n_lon)
    col = F.col("id") % n_lon
    return spark.range(n_lat * n_lon).select(
        F.col("id").alias("cell_id"),
        (F.lit(lat0) + row * step_lat).alias("lat"),
        (F.lit(lon0) + col * step_lon).alias("lon"),
    )


def grid_cells_by_area(areas: DataFrame, resolution_m: float) -> DataFrame:
    """The same grid for a table of boxes ``area_id, lon_min, lat_min, lon_max, lat_max``.

    Grid lines are spread over the cluster before they become cells, so one very
    large area is not expanded inside one task.
    """
    step_lat = F.lit(resolution_m * DEGREES_PER_M)
    mid = (F.col("lat_min") + F.col("lat_max")) / 2.0
    step_lon = step_lat / F.cos(F.radians(mid))

    def lines(low: str, high: str, step: Column) -> tuple[Column, Column, Column]:
        n = F.ceil((F.col(high) - (F.col(low) + step / 2.0)) / step)
        start = F.when(n > 0, F.col(low) + step / 2.0).otherwise((F.col(low) + F.col(high)) / 2.0)
        return start, F.greatest(n, F.lit(1).cast("long")), step

    lat0, n_lat, _ = lines("lat_min", "lat_max", step_lat)
    lon0, n_lon, _ = lines("lon_min", "lon_max", step_lon)
    rows = areas.select(
        "area_id",
        lat0.alias("_lat0"),
        lon0.alias("_lon0"),
        step_lon.alias("_step_lon"),
        n_lon.alias("_n_lon"),
        F.explode(F.sequence(F.lit(0).cast("long"), n_lat - 1)).alias("_row"),
    ).repartition("area_id", "_row")
    cells = rows.withColumn(
        "_col", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n_lon") - 1))
    )
    return cells.select(
        "area_id",
        (F.col("_row") * F.col("_n_lon") + F.col("_col")).alias("cell_id"),
        (F.col("_lat0") + F.col("_row") * step_lat).alias("lat"),
        (F.col("_lon0") + F.col("_col") * F.col("_step_lon")).alias("lon"),
    )


def date_steps(start: Column, end: Column, freq: str = "MS") -> Column:
    """Array of observation dates; the start is first moved to day 1 of its month.

    ``MS`` gives month starts, ``<n>W`` every n-th Sunday counted from the first
    Sunday on or after the start.
    """
    first = F.trunc(start.cast("date"), "month")
    last = end.cast("timestamp_ntz")
    if freq == "MS":
        step = F.expr("interval 1 month")
    elif freq.endswith("W") and (freq[:-1] or "1").isdigit():
        first = F.next_day(F.date_sub(first, 1), "SU")
        step = F.expr(f"interval {7 * int(freq[:-1] or 1)} days")
    else:
        raise ValueError(f"unknown observation frequency: {freq}")
    first = first.cast("timestamp_ntz")
    empty = F.array().cast("array<timestamp_ntz>")
    return F.when(first <= last, F.sequence(first, last, step)).otherwise(empty)


def obs_dates(spark: SparkSession, start: str, end: str, freq: str = "MS") -> DataFrame:
    return spark.range(1).select(
        F.explode(date_steps(F.lit(start), F.lit(end), freq)).alias("obs_date")
    )


def obs_dates_by_area(
    areas: DataFrame, start: str = "start_date", end: str = "end_date", freq: str = "MS"
) -> DataFrame:
    """One row per input row and observation date of its own period."""
    dates = date_steps(F.col(start), F.col(end), freq)
    return areas.withColumn("obs_date", F.explode(dates))


def at_dates(cells: DataFrame, start: str, end: str, freq: str = "MS") -> DataFrame:
    """Every cell at every observation date: a row-wise expansion, no join."""
    return cells.withColumn("obs_date", F.explode(date_steps(F.lit(start), F.lit(end), freq)))


def tile_cover(areas: DataFrame, scheme: str) -> DataFrame:
    """Corner and name of the tiles covering each box.

    One-degree tiles run from floor(min) up to but not including ceil(max);
    three-degree tiles run from floor(min) to floor(max), both included.
    """
    size = TILE_DEGREES[scheme]

    def corners(low: str, high: str) -> Column:
        if scheme == "elevation":
            first, last = F.floor(F.col(low)), F.ceil(F.col(high)) - 1
        else:
            first = F.floor(F.col(low) / float(size)) * size
            last = F.floor(F.col(high) / float(size)) * size
        none = F.array().cast("array<bigint>")
        return F.when(first <= last, F.sequence(first, last, F.lit(size).cast("long"))).otherwise(none)

    pattern = ELEVATION_TILE if scheme == "elevation" else LAND_COVER_TILE
    return (
        areas.withColumn("tile_lat", F.explode(corners("lat_min", "lat_max")))
        .withColumn("tile_lon", F.explode(corners("lon_min", "lon_max")))
        .withColumn("tile_name", tile_label(F.col("tile_lat"), F.col("tile_lon"), pattern))
    )


def keep_covered_tiles(pixels: DataFrame, cover: DataFrame) -> DataFrame:
    """Pixels of covered tiles only (semi-join; prunes a table partitioned by ``tile_name``)."""
    return pixels.join(cover.select("tile_name").distinct(), "tile_name", "left_semi")
