"""The dataset build: cells and dates to the full feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.contract import (
    FEATURES,
    FIRE_HISTORY,
    HUMAN,
    LAND_COVER,
    TARGET,
    TOPOGRAPHY,
    WEATHER,
    LabelSettings,
    SplitSettings,
)
from cinderfield.operators import fire, grid, placeholders, raster, weather
from cinderfield.scratch import settle


@dataclass(frozen=True)
class RasterLayer:
    """A pixel table with its transform; ``value`` names the value column."""

    pixels: DataFrame
    transform: raster.Transform
    value: str


@dataclass(frozen=True)
class Sources:
    """What is available. A source left out gets placeholder features, and only its own."""

    hotspots: DataFrame | None = None
    elevation: RasterLayer | None = None
    land_cover: RasterLayer | None = None
    hourly: DataFrame | None = None


@dataclass(frozen=True)
class Built:
    table: DataFrame
    data_version: str
    label_source: str
    placeholder_columns: list[str]


def cell_features(cells: DataFrame, sources: Sources, pixel_m: float, mid_lat: float) -> DataFrame:
    """Raster features, which do not depend on the date: computed once per cell."""
    out = cells
    if sources.elevation is not None:
        layer = sources.elevation
        # Terrain only where cells are: a fine raster has many pixels for each cell.
        wanted = raster.around(layer.pixels, cells, layer.transform)
        surface = raster.terrain(wanted, pixel_m, mid_lat, layer.value)
        out = raster.sample(out, surface, layer.transform)
    if sources.land_cover is not None:
        layer = sources.land_cover
        codes = raster.around(layer.pixels, cells, layer.transform).select("row_ix", "col_ix", F.col(layer.value).alias("_code"))
        out = raster.sample(out, codes, layer.transform)
        out = out.withColumns(raster.land_cover_flags(F.col("_code"))).drop("_code")
    return out


def build_dataset(
    cells: DataFrame,
    sources: Sources,
    pixel_m: float,
    mid_lat: float,
    labels: LabelSettings | None = None,
    split: SplitSettings | None = None,
    freq: str = "MS",
    cell_key: str = "cell_id",
    stored: bool = False,
) -> Built:
    """Cells x dates with the 24 features and the target.

    Fire history is one row per place, so per-cell raster features meet it before
    they are expanded by date.
    Values stay DOUBLE here; the writer casts to the contract types. With ``stored`` the
    rows are written once, for callers that scan them many times; not the placeholders
    among them, which a scan draws again from the row's key.
    """
    labels, split = labels or LabelSettings(), split or SplitSettings()
    features = cell_features(cells, sources, pixel_m, mid_lat)
    if sources.hotspots is not None:
        table = fire.with_history(features, sources.hotspots, labels.start, labels.end, freq, labels)
    else:
        # A table of cells is small, often one file and task: its rows are dealt out before each becomes many.
        spark = cells.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        table = grid.at_dates(features.repartition(tasks, cell_key), labels.start, labels.end, freq)
    if sources.hourly is not None:
        table = weather.attach_weather(table, sources.hourly)

    groups = [
        (sources.elevation, TOPOGRAPHY),
        (sources.land_cover, LAND_COVER),
        (sources.hourly, WEATHER),
        (sources.hotspots, FIRE_HISTORY),
        (None, HUMAN),
    ]
    missing = [c for source, columns in groups if source is None for c in columns]
    if stored and sources.hotspots is not None:  # without hotspots the features are written for the label, below
        table = settle(table, "risk", "zstd")
    row_key = F.concat_ws("|", F.col(cell_key).cast("string"), F.date_format("obs_date", "yyyy-MM-dd"))
    table = table.withColumn("_row_key", row_key)
    table = placeholders.placeholder_features(table, "_row_key", split.seed, missing)

    if sources.hotspots is None:
        # The threshold takes several passes: write the features once instead of building them again.
        table = placeholders.quantile_label(settle(table, "features", "zstd"), split.positive_rate)
        version, source = "real-v0-no-firms", "synthetic_fallback"
    else:
        version, source = "real-b1", "hotspot_archive"
    ordered = table.select(cell_key, "lat", "lon", "obs_date", *FEATURES, TARGET)
    return Built(ordered, version, source, missing)
