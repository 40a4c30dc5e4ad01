"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield import contract
from cinderfield.contract import FEATURES, LAND_COVER, TARGET, BoosterSettings, LabelSettings
from cinderfield.functions import scalars
from cinderfield.functions import text as text_rules
from cinderfield.functions import weather as formulas
from cinderfield.operators import (
    archive,
    attribution,
    booster,
    fire,
    grid,
    images,
    metrics,
    ordered,
    placeholders,
    quality,
    raster,
    spatial,
    splits,
    weather,
)
from cinderfield.plans import model_jobs, views
from cinderfield.plans.risk_dataset import Built, RasterLayer, Sources, build_dataset
from cinderfield.scratch import scratch_path, settle
from cinderfield.sources import features as feature_files
from cinderfield.sources import hotspots as hotspot_files
from cinderfield.sources import images as image_files
from cinderfield.sources import weather as weather_files
from cinderfield.sources.files import write_files
from cinderfield.streaming import hotspots as stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BBOX = (29.0, 38.0, 34.0, 41.0)
AREA_RESOLUTION_M = 2500.0
COVERAGE_DAYS = 5
LABELS = LabelSettings(start=views.OBS_START, end=views.OBS_END)


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def r6(x: Column | str) -> Column:
    return F.round(F.col(x) if isinstance(x, str) else x, 6)


def pixels_with_transform(spark: SparkSession, sf: str) -> tuple[DataFrame, raster.Transform]:
    pixels = views.view(spark, sf, "PIXELS")
    height = pixels.agg((F.max("row_ix") + 1).alias("h")).scalar()
    return pixels, raster.Transform(height=height, **views.RASTER)


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return grid.at_dates(views.view(spark, sf, "CELLS"), views.OBS_START, views.OBS_END)


def risk_table(spark: SparkSession, sf: str, with_hotspots: bool = True, stored: bool = False) -> Built:
    pixels, transform = pixels_with_transform(spark, sf)
    sources = Sources(
        hotspots=views.view(spark, sf, "HOTSPOTS") if with_hotspots else None,
        elevation=RasterLayer(pixels, transform, "elevation"),
        land_cover=RasterLayer(pixels, transform, "code"),
        hourly=views.view(spark, sf, "WEATHER"),
    )
    cells = views.view(spark, sf, "CELLS")
    return build_dataset(cells, sources, views.PIXEL_M, views.MID_LAT, LABELS, stored=stored)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return views.view(spark, sf, "SCORED")


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return splits.spatial_folds(scored(spark, sf), 5, "lat", "y")


# --- fire history ----------------------------------------------------------


@register
def fire_labels(spark: SparkSession, sf: str) -> DataFrame:
    out = fire.fire_labels(observations(spark, sf), views.view(spark, sf, "HOTSPOTS"), LABELS)
    return out.select(
        "cell_id",
        "obs_date",
        F.col(TARGET).cast("int").alias("label"),
        F.col("firms_density_1yr").cast("long").alias("density"),
    )


@register
def days_since_last(spark: SparkSession, sf: str) -> DataFrame:
    out = fire.fire_labels(observations(spark, sf), views.view(spark, sf, "HOTSPOTS"), LABELS)
    return out.select("cell_id", "obs_date", F.col("days_since_last_fire").alias("days_since"))


@register
def confidence_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = fire.filter_confidence(views.view(spark, sf, "HOTSPOTS"))
    level = text_rules.confidence_level(F.col("confidence"))
    return kept.select("hotspot_id", level.alias("level"))


@register
def confidence_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Levels where some confidences are percent numbers, mapped by the published bounds."""
    percent = F.when(F.col("confidence") == "85", (F.col("hotspot_id") % 120 - 5).cast("string")).otherwise(F.col("confidence"))
    hotspots = views.view(spark, sf, "HOTSPOTS").withColumn("confidence", percent)
    kept = fire.filter_confidence(hotspots, numeric_bounds=text_rules.NUMERIC_BOUNDS)
    return kept.select("hotspot_id", text_rules.confidence_level(F.col("confidence"), text_rules.NUMERIC_BOUNDS).alias("level"))


@register
def radius_join(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spatial.radius_pairs(
        views.view(spark, sf, "CELLS"),
        views.view(spark, sf, "HOTSPOTS").select("hotspot_id", "latitude", "longitude"),
        10_000.0,
        with_distance=True,
    )
    return pairs.select("cell_id", "hotspot_id", F.round("distance_m", 3).alias("distance_m"))


@register
def radius_count(spark: SparkSession, sf: str) -> DataFrame:
    counted = spatial.radius_count(
        views.view(spark, sf, "CELLS"), views.view(spark, sf, "HOTSPOTS"), 10_000.0, "n_hotspots"
    )
    return counted.select("cell_id", "n_hotspots")


# --- grid, dates, tiles ----------------------------------------------------


@register
def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = grid.grid_cells_by_area(views.view(spark, sf, "AREAS"), AREA_RESOLUTION_M)
    return cells.select("area_id", "cell_id", r6("lat").alias("lat"), r6("lon").alias("lon"))


@register
def obs_dates(spark: SparkSession, sf: str) -> DataFrame:
    periods = views.view(spark, sf, "PERIODS")
    both = [
        grid.obs_dates_by_area(periods, freq=f).select("area_id", F.lit(f).alias("freq"), "obs_date")
        for f in ("MS", "2W")
    ]
    return both[0].unionByName(both[1])


@register
def grid_dates(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).select("cell_id", "lat", "lon", "obs_date")


@register
def tile_cover(spark: SparkSession, sf: str) -> DataFrame:
    areas = views.view(spark, sf, "AREAS")
    both = [
        grid.tile_cover(areas, s).select("area_id", F.lit(s).alias("scheme"), "tile_name")
        for s in ("elevation", "land_cover")
    ]
    return both[0].unionByName(both[1])


@register
def tile_prune(spark: SparkSession, sf: str) -> DataFrame:
    """Hotspots on one-degree tiles that some area needs, per tile."""
    lat0, lon0 = F.floor("latitude"), F.floor("longitude")
    on_tiles = views.view(spark, sf, "HOTSPOTS").withColumn(
        "tile_name", text_rules.tile_label(lat0, lon0, grid.ELEVATION_TILE)
    )
    cover = grid.tile_cover(views.view(spark, sf, "AREAS"), "elevation")
    kept = grid.keep_covered_tiles(on_tiles, cover)
    return kept.groupBy("tile_name").agg(F.count(F.lit(1)).alias("n_hotspots"))


# --- scalar features -------------------------------------------------------


@register
def hotspots_in_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return grid.in_bbox(views.view(spark, sf, "HOTSPOTS"), BBOX).select(
        "hotspot_id", "latitude", "longitude"
    )


@register
def vpd(spark: SparkSession, sf: str) -> DataFrame:
    value = formulas.vpd(F.col("temp_c"), F.col("rh_pct"))
    return views.view(spark, sf, "WEATHER").select("event_id", r6(value).alias("vpd_kpa"))


@register
def ffmc(spark: SparkSession, sf: str) -> DataFrame:
    value = formulas.ffmc(F.col("temp_c"), F.col("rh_pct"), F.col("wind_speed_ms"))
    return views.view(spark, sf, "WEATHER").select("event_id", r6(value).alias("ffmc_approx"))


@register
def circular_encode(spark: SparkSession, sf: str) -> DataFrame:
    east, north = scalars.circular(F.col("wind_dir_deg"))
    return views.view(spark, sf, "WEATHER").select(
        "event_id", r6(east).alias("wind_dir_sin"), r6(north).alias("wind_dir_cos")
    )


# --- rasters ---------------------------------------------------------------


@register
def landcover_onehot(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("code")
    flags = [c.cast("int").alias(n) for n, c in raster.land_cover_flags(code).items()]
    return views.view(spark, sf, "PIXELS").select(
        "row_ix", "col_ix", *flags, raster.is_unmapped(code).alias("unmapped")
    )


@register
def pixel_index(spark: SparkSession, sf: str) -> DataFrame:
    _, transform = pixels_with_transform(spark, sf)
    placed = raster.with_pixel_index(views.view(spark, sf, "CELLS"), transform)
    return placed.select("cell_id", "row_ix", "col_ix")


@register
def raster_sample(spark: SparkSession, sf: str) -> DataFrame:
    pixels, transform = pixels_with_transform(spark, sf)
    out = raster.sample(views.view(spark, sf, "CELLS"), pixels, transform)
    return out.select("cell_id", "elevation", "code")


@register
def slope_aspect(spark: SparkSession, sf: str) -> DataFrame:
    out = raster.slope_aspect(views.view(spark, sf, "PIXELS"), views.PIXEL_M, views.MID_LAT)
    return out.select(
        "row_ix", "col_ix", r6("slope_deg").alias("slope_deg"), r6("aspect_deg").alias("aspect_deg")
    )


@register
def raster_mosaic(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping tiles of two bands with gaps: the part raster, and a changed copy one pixel south-east."""
    pixels = views.view(spark, sf, "PIXELS").withColumns(
        {
            "elevation": F.expr("case when (row_ix + col_ix) % 3 = 0 then null else elevation end"),
            "code": F.expr("case when (row_ix + col_ix) % 4 = 0 then null else code end"),
        }
    )
    other = pixels.withColumns({"elevation": F.col("elevation") + 1000.0, "code": F.col("code") + 1000})
    both = pixels.withColumn("tile_id", F.lit("a")).unionByName(other.withColumn("tile_id", F.lit("b")))
    tiles = spark.createDataFrame(
        [("a", 0, 0, 0), ("b", 1, 1, 1)], "tile_id string, tile_seq int, row_off int, col_off int"
    )
    return raster.mosaic(both, tiles, ["elevation", "code"])


@register
def raster_crop(spark: SparkSession, sf: str) -> DataFrame:
    pixels = views.view(spark, sf, "PIXELS")
    transform = raster.Transform(height=pixels.agg(F.max("row_ix") + 1).first()[0], **views.RASTER)
    kept, _ = raster.crop(pixels, transform, (30.1, 0.0, 35.3, 42.8))
    return kept.select("row_ix", "col_ix", "elevation", "code")


@register
def tile_store(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels written by one-degree tile; those of the tiles that some area needs are read back, per tile."""
    pixels = views.view(spark, sf, "PIXELS")
    transform = raster.Transform(height=1, **views.RASTER | {"y0": views.TILED_Y0})  # placing needs no size
    path = scratch_path(spark, "tiles")
    raster.write_tiles(raster.with_tile_name(pixels, transform, grid.ELEVATION_TILE), path)
    kept = raster.read_tiles(spark, path, grid.tile_cover(views.view(spark, sf, "AREAS"), "elevation"))
    return kept.groupBy("tile_name").agg(F.count(F.lit(1)).alias("n_pixels"), r6(F.avg("elevation")).alias("elevation"))


# --- weather ---------------------------------------------------------------


@register
def weather_attach(spark: SparkSession, sf: str) -> DataFrame:
    out = weather.attach_weather(views.view(spark, sf, "CELLS"), views.view(spark, sf, "WEATHER"))
    return out.select("cell_id", *[r6(c).alias(c) for c in contract.WEATHER])


@register
def hourly_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Each event becomes a three-hour payload of parallel arrays, then rows again."""
    w = views.view(spark, sf, "WEATHER")
    hours = range(3)
    payload = w.select(
        "event_id",
        F.struct(
            F.array(*[F.date_format(F.col("time_utc") + F.expr(f"interval {h} hours"), "yyyy-MM-dd'T'HH:mm") for h in hours]).alias("time"),
            F.array(*[F.col("temp_c") + h for h in hours]).alias("temperature_2m"),
            F.array(*[F.col("rh_pct") for _ in hours]).alias("relative_humidity_2m"),
            F.array(*[F.col("wind_speed_ms") + h for h in hours]).alias("windspeed_10m"),
            F.array(*[F.col("wind_dir_deg") for _ in hours]).alias("winddirection_10m"),
        ).alias("hourly"),
    )
    out = weather.explode_hourly(payload, "kmh", keep=["event_id"])
    return out.withColumn("wind_speed_ms", r6("wind_speed_ms"))


@register
def weather_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly rows written as CSV and as JSON payloads with damaged records among them, and read back: rows, sums, bad records."""
    w = views.view(spark, sf, "WEATHER")
    folder = scratch_path(spark, "weather")
    broken = F.col("event_id") % 17 == 0
    rows = w.select("event_id", F.date_format("time_utc", "yyyy-MM-dd'T'HH:mm").alias("at"), "temp_c", "rh_pct", "wind_speed_ms", "wind_dir_deg")
    text = rows.select("at", F.when(broken, F.lit("n/a")).otherwise(F.col("temp_c").cast("string")).alias("temp_c"), "rh_pct", "wind_speed_ms", "wind_dir_deg")
    text.withColumnRenamed("at", "time_utc").write.option("header", True).csv(f"{folder}/csv")
    uneven = F.col("event_id") % 19 == 0
    hourly = F.struct(
        F.when(uneven, F.array("at", "at")).otherwise(F.array("at")).alias("time"),
        F.array("temp_c").alias("temperature_2m"),
        F.array("rh_pct").alias("relative_humidity_2m"),
        F.array("wind_speed_ms").alias("windspeed_10m"),
        F.array("wind_dir_deg").alias("winddirection_10m"),
    )
    payload = F.to_json(F.struct(hourly.alias("hourly")))
    rows.select(F.when(broken, F.substring(payload, 1, 40)).otherwise(payload).alias("value")).write.text(f"{folder}/json")
    found = []
    for name, scan in (
        ("csv", weather_files.scan_hourly_csv(spark, f"{folder}/csv")),
        ("json", weather_files.scan_hourly_json(spark, f"{folder}/json", "ms")),
    ):
        sums = [r6(F.sum(c)).alias(c) for c in ("temp_c", "rh_pct", "wind_speed_ms", "wind_dir_deg")]
        good = scan.rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("time_utc").alias("n_times"), *sums)
        bad = scan.bad.agg(F.count(F.lit(1)).alias("n_bad"), F.count_distinct("reason").alias("n_reasons"))
        one = F.lit(1).alias("_one")
        found.append(good.select(one, "*").join(bad.select(one, "*"), "_one").select(F.lit(name).alias("source"), "*").drop("_one"))
    return found[0].unionByName(found[1])


# --- archive and quality ---------------------------------------------------


@register
def hotspot_dedup(spark: SparkSession, sf: str) -> DataFrame:
    hotspots = views.view(spark, sf, "ARCHIVE")
    order = ["chunk_seq", "line_ref", "frp", "confidence"]
    return archive.dedup_hotspots(hotspots, order)


@register
def archive_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Hotspots per chunk of five days, from the first detection to the last."""
    hotspots = views.view(spark, sf, "HOTSPOTS")
    first, last = hotspots.agg(F.min("acq_date"), F.max("acq_date")).first()
    out = archive.archive_coverage(hotspots, f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}", COVERAGE_DAYS)
    return out.withColumn("chunk_start", F.col("chunk_start").cast("timestamp_ntz"))


@register
def risk_dataset(spark: SparkSession, sf: str) -> DataFrame:
    built = risk_table(spark, sf).table
    flags = [*LAND_COVER, "picnic_area", TARGET]
    columns = [
        F.col(c).cast("int").alias(c) if c in flags else r6(F.col(c).cast("double")).alias(c)
        for c in FEATURES + [TARGET]
    ]
    return built.select("cell_id", "lat", "lon", "obs_date", *columns)


@register
def risk_dataset_no_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    """The fallback label: positives per date and the share over the whole table."""
    built = risk_table(spark, sf, with_hotspots=False).table
    return built.groupBy("obs_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(TARGET).cast("long")).alias("n_positive")
    )


def dataset_run(spark: SparkSession, sf: str, built: Built) -> quality.Run:
    cells = views.view(spark, sf, "CELLS")
    n_cells, *bbox = cells.agg(F.count_distinct("lat", "lon"), F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
    return quality.Run(
        built.data_version,
        built.label_source,
        n_cells,
        grid.obs_dates(spark, LABELS.start, LABELS.end).count(),
        tuple(bbox),
        views.PIXEL_M,
        "MS",
        "orders",
        "hotspots, rasters and weather are derived from tables",
        tuple(built.placeholder_columns),
    )


@register
def dataset_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset written by day; its metadata is counted by that write, without a second scan."""
    built = risk_table(spark, sf)
    out = feature_files.write_dataset(built.table, scratch_path(spark, "dataset"), dataset_run(spark, sf, built))
    bounds = [c for c in out.columns if c.startswith(("lat_", "lon_", "bbox_"))]
    return out.withColumns({c: r6(c) for c in ["positive_rate", *bounds]})


@register
def feature_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset written by day and as CSV, and the days of one year read back: each column's place, type and values."""
    built = risk_table(spark, sf)
    root = scratch_path(spark, "features")
    n_cells, n_days = views.view(spark, sf, "CELLS").count(), grid.obs_dates(spark, LABELS.start, LABELS.end).count()
    feature_files.write_feature_table(built.table, f"{root}/parquet", rows_per_day=n_cells, n_days=n_days)
    whole = feature_files.load_feature_table(spark, f"{root}/parquet")
    feature_files.write_feature_table(whole, f"{root}/csv", "csv", compression="gzip")
    days = ("1998-01-01", "1998-12-31")
    dates = grid.obs_dates(spark, *days).select(F.col("obs_date").alias("day"))
    tables = {
        "all": whole,
        "range": feature_files.load_feature_table(spark, f"{root}/parquet", days=days),
        "dates": feature_files.load_feature_table(spark, f"{root}/parquet", days=dates),
        "csv": feature_files.load_feature_table(spark, f"{root}/csv", "csv", days=days),
    }
    return reduce(DataFrame.unionByName, [_columns_of(name, table) for name, table in tables.items()])


def _columns_of(name: str, table: DataFrame) -> DataFrame:
    """One row per column: where it stands, its type, and how many values it holds."""
    measures = [
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("col"), F.lit(kind).alias("type"), F.count(F.col(c)).alias("n_values"))
        for i, (c, kind) in enumerate(table.dtypes, 1)
    ]
    rows = table.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("r"))
    return rows.select(F.lit(name).alias("reading"), "r.*")


@register
def sparsity_gate(spark: SparkSession, sf: str) -> DataFrame:
    labelled = fire.fire_labels(observations(spark, sf), views.view(spark, sf, "HOTSPOTS"), LABELS)
    return quality.sparsity_gate(labelled).withColumn("positive_rate", r6("positive_rate"))


def weather_features(spark: SparkSession, sf: str) -> DataFrame:
    w = views.view(spark, sf, "WEATHER")
    t, rh, wind = F.col("temp_c"), F.col("rh_pct"), F.col("wind_speed_ms")
    return w.withColumns({"vpd_kpa": formulas.vpd(t, rh), "ffmc_approx": formulas.ffmc(t, rh, wind)})


@register
def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    """All 25 declared columns of the built table in their declared types."""
    return quality.contract_check(feature_files.to_contract(risk_table(spark, sf).table))


@register
def contract_check_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same check on a table of text, as a CSV file holds it, with damage in every column."""
    table = feature_files.to_contract(risk_table(spark, sf).table)
    spot = F.pmod(F.floor(F.col("lat") * 1000 + 0.5) + F.dayofyear("obs_date"), F.lit(25))
    texts = []
    for i, f in enumerate(contract.fields()):
        damage = [F.lit("n/a"), F.lit(""), F.lit("NaN"), F.lit(str(int(f.high) + 1))][i % 4]
        texts.append(F.when(spot == i, damage).otherwise(F.col(f.name).cast("string")).alias(f.name))
    return quality.contract_check(table.select(*texts))


@register
def contract_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The declared contract against what the built table and one column more hold."""
    table = feature_files.to_contract(risk_table(spark, sf).table)
    seen = quality.observed_contract(table, [*FEATURES, "lat"])
    return quality.contract_diff(contract.contract_frame(spark), seen)


# --- splits ----------------------------------------------------------------


@register
def latitude_bands(spark: SparkSession, sf: str) -> DataFrame:
    return splits.latitude_bands(scored(spark, sf), 5).select("event_id", "fold")


@register
def spatial_folds(spark: SparkSession, sf: str) -> DataFrame:
    return splits.fold_summary(folded(spark, sf), "y")


@register
def fold_plan(spark: SparkSession, sf: str) -> DataFrame:
    return splits.fold_plan(scored(spark, sf), 5, "y")


@register
def rank_bands(spark: SparkSession, sf: str) -> DataFrame:
    out = splits.rank_bands(scored(spark, sf), 5, "lat", "event_id")
    return out.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max")
    )


@register
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_split(scored(spark, sf), "event_id", "y").select("event_id", "split")


@register
def seeded_order(spark: SparkSession, sf: str) -> DataFrame:
    """The seeded order as an exact rank: partitions of the sorted table, offset by the sizes of those before.

    A partition is one range of the order, so its rows are numbered where they lie;
    only the sizes of partitions are summed up.
    """
    ordered = splits.seeded_order(scored(spark, sf).select("event_id"), "event_id", 42)
    return splits.ranked(ordered).select("event_id", "place")


@register
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return splits.first_rows(scored(spark, sf).select("event_id", "p"), "event_id", 500)


@register
def hotspot_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The archive written as CSV chunks of three layouts, some with extra columns, and read back as one folder."""
    archive_rows = views.view(spark, sf, "ARCHIVE")
    layouts = [
        ["latitude", "longitude", "acq_date", "confidence"],
        ["latitude", "longitude", "frp", "line_ref", "acq_date", "chunk_seq", "confidence"],
        ["confidence", "frp", "acq_date", "longitude", "latitude"],
    ]
    folder = scratch_path(spark, "csv")
    for i, layout in enumerate(layouts):
        part = archive_rows.filter(F.pmod("line_ref", F.lit(len(layouts))) == i)
        part.select(*layout).write.option("header", True).csv(f"{folder}/{i}")
    found = hotspot_files.read_hotspots(spark, f"{folder}/*")
    return found.groupBy("latitude", "longitude", "acq_date", "confidence").agg(F.count(F.lit(1)).alias("n"))


@register
def bounded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return splits.bounded_sample(scored(spark, sf), "event_id", 2000).select("event_id", "p")


# --- metrics ---------------------------------------------------------------


@register
def class_weight(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.class_weight(scored(spark, sf), "y", strict=True)
    return out.withColumn("weight", r6("weight"))


@register
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(scored(spark, sf))


@register
def threshold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.threshold_metrics(scored(spark, sf))
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1", "accuracy")})


@register
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_auc(scored(spark, sf)).withColumn("roc_auc", r6("roc_auc"))


@register
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.average_precision(scored(spark, sf))
    return out.withColumn("average_precision", r6("average_precision"))


@register
def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles and tails of order values."""
    orders = views.table(spark, sf, "orders")
    q = ordered.quantile_row(orders, "o_totalprice", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])
    names = ["q0", "q01", "q25", "q50", "q75", "q99", "q1"]
    return q.select(*[F.round(F.element_at("q", i + 1), 4).alias(n) for i, n in enumerate(names)])


def fold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Per fold: ranking and threshold metrics and whether the fold counts."""
    rows = folded(spark, sf)
    usable = splits.fold_summary(rows, "y").select("fold", "usable")
    in_fold = rows.filter(F.col("fold").isNotNull())
    ranking = metrics.ranking_metrics(in_fold, by=["fold"])
    cut = metrics.threshold_metrics(in_fold, by=["fold"]).select("fold", "f1")
    return ranking.join(cut, "fold").join(usable, "fold")


@register
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.cv_summary(
        fold_metrics(spark, sf).withColumnRenamed("average_precision", "pr_auc"),
        ["roc_auc", "pr_auc", "f1"],
    )
    return out.select("cv_n_folds", *[r6(c).alias(c) for c in out.columns if c != "cv_n_folds"])


@register
def weighted_logloss(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    weight = metrics.class_weight(rows, "y").select("weight").scalar()
    return metrics.weighted_logloss(rows, weight).withColumn("logloss", r6("logloss"))


@register
def score_parity(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    out = metrics.score_parity(rows, rows, "event_id", b_score="p_alt")
    return out.withColumn("max_gap", r6("max_gap"))


@register
def attribution_rank(spark: SparkSession, sf: str) -> DataFrame:
    weights = F.create_map(*[F.lit(x) for kv in views.ATTRIBUTION_WEIGHTS.items() for x in kv])
    phi = (F.pmod(F.col("event_id") * F.col("k"), F.lit(101)) - 50) / 100.0 * F.col("k")
    long_form = views.table(spark, sf, "events").select("event_id", F.explode(weights).alias("feature", "k"))
    out = metrics.attribution_rank(long_form.select("feature", phi.alias("phi")), 10)
    return out.withColumn("mean_abs", r6("mean_abs"))


# --- placeholders ----------------------------------------------------------


@register
def placeholder_features(spark: SparkSession, sf: str) -> DataFrame:
    out = placeholders.placeholder_features(views.view(spark, sf, "CELLS").select("cell_id"), "cell_id")
    flags = [*LAND_COVER, "picnic_area"]
    return out.select(
        "cell_id",
        *[F.col(c).cast("int").alias(c) if c in flags else r6(c).alias(c) for c in FEATURES],
    )


@register
def quantile_label(spark: SparkSession, sf: str) -> DataFrame:
    out = placeholders.synthetic_dataset(views.view(spark, sf, "CELLS").select("cell_id"), "cell_id")
    return out.select("cell_id", F.col(TARGET).cast("int").alias("label"))


# --- images ----------------------------------------------------------------


@register
def annotation_label(spark: SparkSession, sf: str) -> DataFrame:
    """Both label rules on the annotation text, and the line rule on whole documents."""
    return views.view(spark, sf, "IMAGES").select(
        "image_id",
        text_rules.any_box_label(F.col("annotations")).alias("any_box"),
        text_rules.class_line_label(F.col("annotations")).alias("class_line"),
        text_rules.class_line_label(F.col("text"), ("the", "The", "a", "A")).alias("text_line"),
    )


@register
def image_label_join(spark: SparkSession, sf: str) -> DataFrame:
    pictures = views.view(spark, sf, "IMAGES").select("image_id", "path")
    out = images.label_by_file(pictures, views.view(spark, sf, "LABEL_FILES"))
    return out.select("image_id", "stem", "label")


@register
def image_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Union of the annotated and the folder catalogue, per source and label."""
    pictures = views.view(spark, sf, "IMAGES")
    annotated = images.label_annotated(pictures).select("path", "split", "label", F.lit("shard").alias("source"))
    foldered = images.label_by_file(
        pictures.select("path", "split"), views.view(spark, sf, "LABEL_FILES")
    ).select("path", "split", "label", F.lit("folder").alias("source"))
    both = images.catalogue(annotated, foldered)
    return both.groupBy("source", "split", "label").agg(F.count(F.lit(1)).alias("n"))


@register
def image_folder_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Images, label files and annotated shards written as files and read back as one catalogue; other splits than train in path order."""
    root = scratch_path(spark, "images")
    pictures = views.view(spark, sf, "IMAGES")
    labels = views.view(spark, sf, "LABEL_FILES")
    stems = pictures.select("split", text_rules.file_stem(F.col("path")).alias("stem"))
    texts = labels.join(stems, "stem").select(F.concat_ws("/", F.lit("labels"), "split", F.concat("stem", F.lit(".txt"))).alias("name"), F.col("content").alias("data"))
    write_files(pictures.select(F.col("path").alias("name"), F.col("text").alias("data")).unionByName(texts), root)
    image = F.struct("path", F.encode("text", "UTF-8").alias("bytes")).alias("image")
    for split, name in (("train", "shots-train-0.parquet"), ("val", "shots-val.parquet")):
        pictures.filter(F.col("split") == split).select(image, "annotations").write.parquet(f"{root}/shards/{name}")
    found = []
    for split in ("train", "val"):
        samples = image_files.image_catalogue(spark, f"{root}/shards", root, split)
        placed = splits.ranked(samples) if split == "val" else samples.withColumn("place", F.lit(None).cast("long"))
        stem, size = text_rules.file_stem(F.col("path")).alias("stem"), F.octet_length("bytes").cast("long").alias("n_bytes")
        found.append(placed.select(F.lit(split).alias("split"), stem, "label", size, F.col("place").cast("long").alias("place")))
    return found[0].unionByName(found[1])


# --- models ----------------------------------------------------------------

BOOSTER = BoosterSettings(rounds=8, depth=4, step=0.2, patience=4)


def keyed_risk_table(spark: SparkSession, sf: str) -> DataFrame:
    """The built dataset with a row key, written once but for what follows from the key: model jobs scan it many times."""
    key = F.concat_ws("|", F.col("cell_id").cast("string"), F.date_format("obs_date", "yyyy-MM-dd"))
    return risk_table(spark, sf, stored=True).table.withColumn("row_key", key)


@register
def spatial_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validation with the library's own settings: 500 rounds of depth 6, each fold's best round kept."""
    _, summary = model_jobs.spatial_cv(keyed_risk_table(spark, sf), 5, BoosterSettings())
    return summary


@register
def holdout_eval(spark: SparkSession, sf: str) -> DataFrame:
    split = model_jobs.split_table(keyed_risk_table(spark, sf), "row_key")
    return model_jobs.holdout_evaluation(split, model_jobs.fit_on_split(split, BOOSTER))


@register
def batch_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = keyed_risk_table(spark, sf)
    fitted = booster.fit(rows, settings=BOOSTER)
    return booster.score(fitted, rows).select("row_key", F.col("p").cast("double").alias("p"))


@register
def feature_attribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = keyed_risk_table(spark, sf)
    fitted = booster.fit(rows, settings=BOOSTER)
    return model_jobs.feature_importance(fitted, rows, "row_key")


# Their outcomes depend on the trees; these parts of them do not.


@register
def holdout_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Holdout evaluation of a fitted model: split sizes, class weight, and whether the metrics fit together."""
    split = model_jobs.split_table(keyed_risk_table(spark, sf), "row_key")
    r = model_jobs.holdout_evaluation(split, model_jobs.fit_on_split(split, BOOSTER))
    shares = [F.col(c).between(0, 1) for c in ("roc_auc", "pr_auc", "precision", "recall", "f1", "accuracy")]
    agree = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp") == F.col("n_test")) & F.col("best_round").between(1, BOOSTER.rounds)
    return r.select(
        "n_train",
        "n_val",
        "n_test",
        (F.col("tp") + F.col("fn")).alias("pos_test"),
        r6("scale_pos_weight").alias("scale_pos_weight"),
        reduce(lambda a, b: a & b, shares, agree).cast("int").alias("metrics_agree"),
    )


@register
def spatial_cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Spatial cross-validation: rows and positives scored per fold, and how many scores are probabilities."""
    scores = model_jobs.fold_scores(keyed_risk_table(spark, sf), 5, BOOSTER)
    return scores.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_val"),
        F.sum(F.col("y").cast("long")).alias("pos_val"),
        F.count_if(F.col("p").between(0, 1)).alias("n_probabilities"),
    )


@register
def batch_score_check(spark: SparkSession, sf: str) -> DataFrame:
    """Every row scored by a saved and loaded model: whether p is the logistic of its trees, added up one by one."""
    rows = keyed_risk_table(spark, sf)
    path = scratch_path(spark, "model")
    booster.save(booster.fit(rows, settings=BOOSTER), spark, path)
    loaded, threshold = booster.load(spark, path)
    scored_rows = booster.margins(loaded, booster.score(loaded, rows))
    logistic = 1 / (1 + F.exp(-2 * F.col("margin")))
    return scored_rows.select(
        "row_key",
        (F.abs(F.col("p") - logistic) < 1e-6).cast("int").alias("p_is_logistic"),
        ((F.col("p") >= threshold) == (metrics.decide(F.col("p")) == 1)).cast("int").alias("same_decision"),
    )


@register
def attribution_check(spark: SparkSession, sf: str) -> DataFrame:
    """Attributions of every row: how many do not add up to the margin of the trees."""
    rows = keyed_risk_table(spark, sf)
    fitted = booster.fit(rows, settings=BOOSTER)
    total = F.aggregate("phi", F.col("base"), lambda a, x: a + x).alias("total")
    wrong_size = (F.size("phi") != len(FEATURES)).alias("wrong_size")
    explained = attribution.attributions(fitted, rows, "row_key").select("row_key", wrong_size, total)
    # Keys and scores take many times the few bytes of the file they are made from, by which Catalyst would broadcast them.
    both = explained.hint("merge").join(booster.margins(fitted, rows).select("row_key", "margin"), "row_key")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("wrong_size").alias("n_wrong_size"),
        F.count_if(F.abs(F.col("total") - F.col("margin")) > 1e-6).alias("n_violations"),
    )


# --- streaming -------------------------------------------------------------


@register
def hotspot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The archive streamed from its file, deduplicated and appended to a table, then read back."""
    schema = views.table(spark, sf, "lineitem").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    incoming = spark.sql(views.ARCHIVE, lineitem=lines)
    # The file is one batch in no date order, so nothing in it may count as late; that late
    # rows go and state is forgotten is tested on files of rising dates.
    deduped = stream.dedup_stream(incoming, "3650 days")
    path = scratch_path(spark, "stream")
    stream.ingest(deduped, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    table = spark.read.parquet(f"{path}/table")
    return table.select("latitude", "longitude", F.col("acq_date").cast("timestamp_ntz").alias("acq_date"))


CHUNK_DAYS, OVERLAP_DAYS = 365, 10


@register
def hotspot_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The archive as overlapping CSV chunk files, streamed two at a time with one lost commit, and read back.

    Each chunk begins with the last ten days of the one before. The last batch is
    written and its commit lost; the stream is then started anew.
    """
    rows = views.view(spark, sf, "ARCHIVE")
    first, last = rows.agg(F.min("acq_date"), F.max("acq_date")).first()
    day = F.datediff("acq_date", F.lit(first))
    own = F.floor(day / CHUNK_DAYS).cast("int")
    begun = F.when((day % CHUNK_DAYS >= CHUNK_DAYS - OVERLAP_DAYS), F.array(own, own + 1)).otherwise(F.array(own))
    copies, path = rows.withColumn("chunk", F.explode(begun)), scratch_path(spark, "copies")
    copies.write.partitionBy("chunk").parquet(path)  # the archive is run once; each chunk then reads its own rows
    copies = spark.read.schema(copies.schema).parquet(path)
    folder = scratch_path(spark, "chunks")
    chunks = (last - first).days // CHUNK_DAYS + 1
    for number in range(chunks):  # one file for each chunk, as an archive delivers them
        copies.filter(F.col("chunk") == number).repartition(1).write.option("header", True).csv(f"{folder}/{number:05d}")
    extra = T.StructType.fromDDL("chunk int, chunk_seq bigint, line_ref bigint, frp double")
    order, path = ["chunk", "chunk_seq", "line_ref", "frp", "confidence"], scratch_path(spark, "ingest")

    def run(after_write: Callable[[int], None] | None = None) -> None:
        files = stream.stream_hotspot_files(spark, f"{folder}/*", f"{folder}/00000", 2, extra)
        kept = stream.keep_first_stream(files, order, f"{OVERLAP_DAYS} days")
        stream.ingest_batches(kept, f"{path}/table", f"{path}/checkpoint", after_write).awaitTermination()

    class CommitLost(Exception):
        pass

    def lose_last(number: int) -> None:
        if 2 * (number + 1) >= chunks:
            raise CommitLost(f"batch {number} was written and not committed")

    try:
        run(lose_last)
    except StreamingQueryException as lost:
        if "CommitLost" not in str(lost):
            raise
    run()
    table = stream.read_ingested(spark, f"{path}/table").select(*rows.columns, "chunk")
    return table.withColumn("acq_date", F.col("acq_date").cast("timestamp_ntz"))
