"""Rasters as pixel tables ``row_ix, col_ix, <value>``: sampling, terrain, mosaic, crop."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderfield.contract import LAND_COVER, LAND_COVER_CODES
from cinderfield.functions.scalars import circular, clamp
from cinderfield.functions.text import tile_label
from cinderfield.operators.grid import keep_covered_tiles


@dataclass(frozen=True)
class Transform:
    """North-up affine: upper-left corner, pixel size (``dy`` negative) and size.

    ``height`` and ``width`` may be Columns, for example scalar subqueries.
    """

    x0: float
    y0: float
    dx: float
    dy: float
    height: int | Column
    width: int | Column

    def _edge(self, index: Column, size: int | Column) -> Column:
        top = (size if isinstance(size, Column) else F.lit(size)).cast("int") - 1
        return F.greatest(F.least(index.cast("int"), top), F.lit(0))

    def row_ix(self, lat: Column) -> Column:
        """Pixel row under a latitude; outside the raster the edge row."""
        return self._edge(F.floor((lat - self.y0) / self.dy), self.height)

    def col_ix(self, lon: Column) -> Column:
        return self._edge(F.floor((lon - self.x0) / self.dx), self.width)


def with_pixel_index(df: DataFrame, grid: Transform, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.withColumns(
        {"row_ix": grid.row_ix(F.col(lat)), "col_ix": grid.col_ix(F.col(lon))}
    )


def sample(df: DataFrame, pixels: DataFrame, grid: Transform, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``df`` plus the value columns of the pixel under each row.

    ``pixels`` holds one row per (row_ix, col_ix). Rows outside the raster all
    meet the edge pixels, so distinct pixels are looked up first and the wide
    rows join the short answer.
    """
    values = [c for c in pixels.columns if c not in ("row_ix", "col_ix")]
    placed = with_pixel_index(df, grid, lat, lon)
    wanted = placed.select("row_ix", "col_ix").distinct()
    keyed = pixels.select(
        F.col("row_ix").cast("int").alias("row_ix"), F.col("col_ix").cast("int").alias("col_ix"), *values
    )
    hit = keyed.join(wanted, ["row_ix", "col_ix"], "left_semi")
    return placed.join(hit, ["row_ix", "col_ix"], "left").select(*df.columns, *values)


def around(pixels: DataFrame, df: DataFrame, grid: Transform, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The pixels in the rows and columns that ``df`` lies on, and one more on each side.

    A small job finds the bounds; as plain ranges they reach the scan of ``pixels``.
    """
    placed = with_pixel_index(df.select(lat, lon), grid, lat, lon)
    ends = placed.agg(F.min("row_ix"), F.max("row_ix"), F.min("col_ix"), F.max("col_ix")).first()
    if ends[0] is None:
        return pixels.filter(F.lit(False))
    r0, r1, c0, c1 = ends
    return pixels.filter(F.col("row_ix").between(r0 - 1, r1 + 1) & F.col("col_ix").between(c0 - 1, c1 + 1))


def slope_aspect(
    pixels: DataFrame,
    pixel_m: float,
    mid_lat: float,
    value: str = "elevation",
) -> DataFrame:
    """Slope and aspect in degrees: central differences inside, one-sided at edges.

    The east-west spacing is ``pixel_m / cos(mid_lat)``. A pixel without any
    neighbour on one axis has no gradient and gets null.
    """
    return _shaped(pixels, pixel_m, mid_lat, value).drop("elevation_m")


def _shaped(pixels: DataFrame, pixel_m: float, mid_lat: float, value: str) -> DataFrame:
    """Height, slope and aspect of each pixel with a height.

    Each pixel sends its value to itself and its four neighbours and one aggregation
    per pixel gathers them: one shuffle with evenly small groups, where row and
    column windows would sort whole raster lines in two shuffles.
    """
    step_ns = pixel_m
    step_ew = pixel_m / math.cos(math.radians(mid_lat))
    offsets = [(0, 0, "self"), (1, 0, "up"), (-1, 0, "down"), (0, 1, "left"), (0, -1, "right")]
    sends = F.array(
        *[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc"), F.lit(s).alias("slot")) for r, c, s in offsets]
    )
    sent = pixels.select(
        F.col("row_ix").cast("int").alias("row_ix"),
        F.col("col_ix").cast("int").alias("col_ix"),
        F.col(f"`{value}`").cast("double").alias("_z"),
        F.explode(sends).alias("_to"),
    )
    gathered = (
        sent.groupBy(
            (F.col("row_ix") + F.col("_to.dr")).alias("row_ix"),
            (F.col("col_ix") + F.col("_to.dc")).alias("col_ix"),
        )
        .agg(*[F.max(F.when(F.col("_to.slot") == s, F.col("_z"))).alias(s) for _, _, s in offsets])
        .filter(F.col("self").isNotNull())
    )

    def difference(before: str, after: str, step: float) -> Column:
        a, z, b = F.col(before), F.col("self"), F.col(after)
        return F.coalesce((b - a) / (2.0 * step), (b - z) / step, (z - a) / step)

    dy, dx = difference("up", "down", step_ns), difference("left", "right", step_ew)
    return gathered.select(
        "row_ix",
        "col_ix",
        F.col("self").alias("elevation_m"),
        F.degrees(F.atan(F.hypot(dx, dy))).alias("slope_deg"),
        F.pmod(F.degrees(F.atan2(-dx, dy)) + 360.0, F.lit(360.0)).alias("aspect_deg"),
    )


def terrain(pixels: DataFrame, pixel_m: float, mid_lat: float, value: str = "elevation") -> DataFrame:
    """Elevation, slope clipped to [0, 45] and the aspect's sine and cosine per pixel with a height."""
    east, north = circular(F.col("aspect_deg"))
    return _shaped(pixels, pixel_m, mid_lat, value).select(
        "row_ix",
        "col_ix",
        "elevation_m",
        clamp(F.col("slope_deg"), 0.0, 45.0).alias("slope_deg"),
        east.alias("aspect_sin"),
        north.alias("aspect_cos"),
    )


def land_cover_flags(code: Column) -> dict[str, Column]:
    """One 0/1 column per class; a code outside the classes sets none."""
    return {
        name: F.coalesce((code == value).cast("byte"), F.lit(0).cast("byte"))
        for name, value in zip(LAND_COVER, LAND_COVER_CODES)
    }


def is_unmapped(code: Column) -> Column:
    return (~F.coalesce(code.isin(LAND_COVER_CODES), F.lit(False))).cast("int")


def mosaic(pixels: DataFrame, tiles: DataFrame, values: list[str]) -> DataFrame:
    """Several tiles on one grid; per value, the first tile with a valid pixel wins.

    ``tiles`` gives ``tile_id, tile_seq, row_off, col_off``, one row per tile. Each
    value is merged alone, so a tile without one band still gives its other bands;
    a pixel valid in no band of any tile is left out. The minimum per value is taken
    before the shuffle as well, so copies of one pixel do not pile up in one task.
    """
    placed = (
        pixels.join(tiles, "tile_id")
        .withColumn("row_ix", (F.col("row_ix") + F.col("row_off")).cast("int"))
        .withColumn("col_ix", (F.col("col_ix") + F.col("col_off")).cast("int"))
        .filter(reduce(lambda a, b: a | b, [F.col(f"`{v}`").isNotNull() for v in values]))
    )
    first = [
        F.min(F.when(F.col(f"`{v}`").isNotNull(), F.struct("tile_seq", F.col(f"`{v}`").alias("v")))).alias(f"_{i}")
        for i, v in enumerate(values)
    ]
    merged = placed.groupBy("row_ix", "col_ix").agg(*first)
    return merged.select("row_ix", "col_ix", *[F.col(f"_{i}.v").alias(v) for i, v in enumerate(values)])


def crop(
    pixels: DataFrame, grid: Transform, bbox: tuple[float, float, float, float]
) -> tuple[DataFrame, Transform]:
    """Pixels whose cell meets the box, renumbered from 0, and the shifted transform.

    The window is a pair of constant ranges on ``row_ix``/``col_ix``, which the
    scan can use to skip row groups.
    """
    if isinstance(grid.height, Column) or isinstance(grid.width, Column):
        raise ValueError("crop needs a transform of known size")
    lon_min, lat_min, lon_max, lat_max = bbox
    eps = 1e-9

    def span(low: float, high: float, size: int) -> tuple[int, int]:
        return max(math.floor(low + eps), 0), min(math.ceil(high - eps) - 1, size - 1)

    r0, r1 = span((lat_max - grid.y0) / grid.dy, (lat_min - grid.y0) / grid.dy, grid.height)
    c0, c1 = span((lon_min - grid.x0) / grid.dx, (lon_max - grid.x0) / grid.dx, grid.width)
    kept = pixels.filter(F.col("row_ix").between(r0, r1) & F.col("col_ix").between(c0, c1))
    kept = kept.withColumns({"row_ix": F.col("row_ix") - r0, "col_ix": F.col("col_ix") - c0})
    moved = Transform(
        grid.x0 + c0 * grid.dx,
        grid.y0 + r0 * grid.dy,
        grid.dx,
        grid.dy,
        max(r1 - r0 + 1, 0),
        max(c1 - c0 + 1, 0),
    )
    return kept, moved


def with_tile_name(pixels: DataFrame, grid: Transform, pattern: str, degrees: int = 1) -> DataFrame:
    """``pixels`` plus ``tile_name``, the tile that holds the pixel's middle."""
    lat = F.lit(grid.y0) + (F.col("row_ix") + 0.5) * grid.dy
    lon = F.lit(grid.x0) + (F.col("col_ix") + 0.5) * grid.dx
    corner = [(F.floor(x / degrees) * degrees).cast("long") for x in (lat, lon)]
    return pixels.withColumn("tile_name", tile_label(*corner, pattern))


def write_tiles(pixels: DataFrame, path: str, rows_per_file: int = 4_000_000) -> None:
    """Pixels with ``tile_name`` as one folder per tile, so that readers open only tiles they need.

    A tile of many pixels goes to several tasks by its rows; each file holds a band
    of rows in order, which lets a scan skip row groups.
    """
    most = pixels.groupBy("tile_name").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = max(1, -(-most // rows_per_file))
    dealt = pixels.repartition("tile_name", F.pmod(F.col("row_ix"), F.lit(parts)))
    dealt.sortWithinPartitions("tile_name", "row_ix", "col_ix").write.partitionBy("tile_name").parquet(path)


def read_tiles(spark: SparkSession, path: str, cover: DataFrame) -> DataFrame:
    """Pixels of the tiles that ``cover`` names; folders of other tiles are skipped at run time."""
    named = cover.filter(F.col("tile_name") > "")  # Spark prunes folders by a side that has a condition of its own
    return keep_covered_tiles(spark.read.parquet(path), named)
