"""CSV, JSON, Parquet and image sources; archive operators; streaming ingest; dataset build."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderfield.contract import DATASET_COLUMNS, FEATURES, HUMAN, TARGET, LabelSettings, fields
from cinderfield.operators import archive, grid, placeholders, quality, raster
from cinderfield.plans.risk_dataset import RasterLayer, Sources, build_dataset
from cinderfield.sources import features as feature_tables
from cinderfield.sources import hotspots as hotspot_files
from cinderfield.sources import images as image_files
from cinderfield.sources import weather as weather_files
from cinderfield.sources.files import write_files
from cinderfield.streaming import hotspots as stream

HEADER = "latitude,longitude,acq_date,confidence,brightness,frp\n"
TWO = "39.5,32.8,2024-06-01,n,300.1,5.5\n39.6,32.9,2024-06-02,h,310.0,7.5\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_hotspot_csv(spark, tmp_path):
    a = write(tmp_path / "a.csv", "# licence\n# query\n" + HEADER + TWO)
    b = write(tmp_path / "b.csv", HEADER)
    df = hotspot_files.read_hotspots(spark, [a, b], T.StructType([T.StructField("frp", T.DoubleType())]))
    assert df.columns == ["latitude", "longitude", "acq_date", "confidence", "frp"]
    rows = df.orderBy("latitude").collect()
    assert [(r["latitude"], str(r["acq_date"]), r["confidence"], r["frp"]) for r in rows] == [
        (39.5, "2024-06-01 00:00:00", "n", 5.5),
        (39.6, "2024-06-02 00:00:00", "h", 7.5),
    ]


def test_hotspot_csv_matches_columns_by_name(spark, tmp_path):
    a = write(tmp_path / "a.csv", HEADER + TWO)
    b = write(tmp_path / "b.csv", "confidence,acq_date,longitude,latitude\nl,2024-07-01,33.0,40.0\n")
    df = hotspot_files.read_hotspots(spark, [a, b])
    row = df.filter("confidence = 'l'").first()
    assert (row["latitude"], row["longitude"]) == (40.0, 33.0) and df.count() == 3


def test_hotspot_folder_and_glob_match_columns_by_name(spark, tmp_path):
    write(tmp_path / "a 1%.csv", "# note\n" + HEADER + TWO)
    write(tmp_path / "b+ü.csv", "longitude,latitude,scan,acq_date,confidence\n33.0,40.0,0.4,2024-07-01,l\n")
    write(tmp_path / "c.csv", "")
    for paths in (str(tmp_path), str(tmp_path / "*.csv"), [str(tmp_path / "a 1%.csv"), str(tmp_path / "b+ü.csv")]):
        rows = hotspot_files.read_hotspots(spark, paths).orderBy("latitude").collect()
        assert [(r["latitude"], r["longitude"], r["confidence"]) for r in rows] == [
            (39.5, 32.8, "n"), (39.6, 32.9, "h"), (40.0, 33.0, "l"),
        ]


def test_stream_takes_columns_by_name_and_refuses_other_layouts(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()
    usual = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,confidence\n"
    first = write(inbox / "1.csv", usual + "39.5,32.8,300,0.4,0.4,2024-06-01,10,n\n39.5,32.8,300,0.4,0.4,2024-06-02,11,h\n")

    def run():
        source = stream.stream_hotspot_files(spark, str(inbox), first)
        stream.ingest(stream.dedup_stream(source), table, state).awaitTermination()

    run()
    rows = spark.read.parquet(table).orderBy("acq_date").collect()
    assert [(str(r["acq_date"].date()), r["confidence"]) for r in rows] == [("2024-06-01", "n"), ("2024-06-02", "h")]
    write(inbox / "2.csv", HEADER + TWO)
    with pytest.raises(Exception, match="2.csv"):
        run()


CHUNKED = "latitude,longitude,acq_date,confidence,chunk,line\n"
EXTRA = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("line", T.IntegerType())])


def chunk_stream(spark, inbox, files=1):
    source = stream.stream_hotspot_files(spark, str(inbox), str(inbox / "1.csv"), files, EXTRA)
    return stream.keep_first_stream(source, ["chunk", "line"])


def ingested(spark, table):
    rows = stream.read_ingested(spark, table).collect()
    return sorted((r["latitude"], str(r["acq_date"]), r["confidence"], r["chunk"], r["line"]) for r in rows)


def test_stream_keeps_the_first_copy_and_drops_late_rows(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()
    write(inbox / "1.csv", CHUNKED + "39.5,32.8,2024-06-03 04:00:00,second,1,2\n39.5,32.8,2024-06-03 04:00:00,first,1,1\n39.5,32.8,2024-06-03 05:00:00,n,1,3\n")
    os.utime(inbox / "1.csv", (1, 1))
    write(inbox / "2.csv", CHUNKED + "39.5,32.8,2024-06-03 04:00:00,copy,2,1\n39.5,32.8,2024-06-20,h,2,2\n-0.5,-32.8,2024-06-12,h,2,3\n")
    os.utime(inbox / "2.csv", (2, 2))
    # The watermark is 2024-06-10 now: a row before it is late, one after it is new or a copy.
    write(inbox / "3.csv", CHUNKED + "39.5,32.8,2024-06-09,late,3,1\n39.5,32.8,2024-06-20,copy,3,2\n-0.5,-32.8,2024-06-12,copy,3,3\n1.0,2.0,2024-07-01,new,3,4\n")
    os.utime(inbox / "3.csv", (3, 3))
    query = stream.ingest_batches(chunk_stream(spark, inbox), table, state)
    query.awaitTermination()
    assert ingested(spark, table) == [
        (-0.5, "2024-06-12 00:00:00", "h", 2, 3), (1.0, "2024-07-01 00:00:00", "new", 3, 4), (39.5, "2024-06-03 04:00:00", "first", 1, 1),
        (39.5, "2024-06-03 05:00:00", "n", 1, 3), (39.5, "2024-06-20 00:00:00", "h", 2, 2),
    ]
    # Of four days and cells two hold state: the watermark has passed the others.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()
    for n in (1, 2):
        write(inbox / f"{n}.csv", CHUNKED + f"39.5,32.8,2024-06-0{n},n,{n},1\n39.5,32.8,2024-06-01,c,{n},2\n")
        os.utime(inbox / f"{n}.csv", (n, n))
    seen = []

    def lost(number):
        seen.append(number)
        if number == 1:
            raise RuntimeError("commit lost")

    with pytest.raises(Exception, match="commit lost"):
        stream.ingest_batches(chunk_stream(spark, inbox), table, state, lost).awaitTermination()
    before = ingested(spark, table)
    stream.ingest_batches(chunk_stream(spark, inbox), table, state, seen.append).awaitTermination()
    assert ingested(spark, table) == before == [(39.5, "2024-06-01 00:00:00", "n", 1, 1), (39.5, "2024-06-02 00:00:00", "n", 2, 1)]
    assert seen.count(1) == 2  # written twice, kept once


def test_missing_hotspot_column(spark, tmp_path):
    bad = write(tmp_path / "bad.csv", "latitude,longitude,acq_date\n1,2,2024-01-01\n")
    with pytest.raises(ValueError, match="confidence"):
        hotspot_files.read_hotspots(spark, bad)


def test_empty_archive_has_the_schema(spark, tmp_path):
    empty = hotspot_files.read_hotspots(spark, [])
    assert empty.columns == ["latitude", "longitude", "acq_date", "confidence"] and empty.count() == 0
    assert hotspot_files.read_hotspots(spark, write(tmp_path / "h.csv", HEADER)).count() == 0


def test_dedup_keeps_the_first_chunk(spark):
    schema = "latitude double, longitude double, acq_date string, confidence string, chunk int"
    one = spark.createDataFrame([(1.0, 2.0, "2024-06-01", "h", 0), (1.0, 2.0, "2024-06-02", "n", 0)], schema)
    two = one.withColumns({"confidence": F.lit("l"), "chunk": F.lit(1)}).withColumn("extra", F.lit("x"))
    both = archive.union_chunks([one, two])
    assert both.count() == 4 and "extra" in both.columns
    rows = archive.dedup_hotspots(both.repartition(3), ["chunk"]).collect()
    assert sorted(r["confidence"] for r in rows) == ["h", "n"] and {r["extra"] for r in rows} == {None}


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select(
        (F.col("id") % 2 + 0.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit("d").alias("acq_date"), "id"
    )
    out = archive.dedup_hotspots(df, ["id"])
    assert sorted(r["id"] for r in out.collect()) == [0, 1]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial and final


@pytest.mark.parametrize("end, spans", [("2024-06-21", [7, 7, 7]), ("2024-06-10", [7, 3]), ("2024-06-01", [1])])
def test_coverage_chunks(spark, end, spans):
    df = spark.createDataFrame([("2024-06-01",), ("2024-06-07",), ("2024-06-10",), ("2024-07-30",)], "acq_date string")
    rows = archive.archive_coverage(df, "2024-06-01", end, 7).orderBy("chunk").collect()
    assert [r["span_days"] for r in rows] == spans
    if len(spans) > 1:
        assert [r["n_hotspots"] for r in rows][:2] == [2, 1]


def test_coverage_errors(spark):
    df = spark.createDataFrame([("2024-06-01",)], "acq_date string")
    with pytest.raises(ValueError, match="chunk_days"):
        archive.archive_coverage(df, "2024-06-01", "2024-06-02", 0)
    with pytest.raises(ValueError, match="after"):
        archive.archive_coverage(df, "2024-06-03", "2024-06-02", 5)


def test_hourly_files(spark, tmp_path):
    good = {"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.5], "relative_humidity_2m": [50],
                       "windspeed_10m": [3.6], "winddirection_10m": [90]}}
    path = write(tmp_path / "w.json", json.dumps(good, indent=1))
    row = weather_files.read_hourly_json(spark, path, "kmh").first()
    assert (row["temp_c"], row["rh_pct"], row["wind_speed_ms"]) == (1.5, 50.0, 1.0)
    with pytest.raises(Exception, match="no 'hourly' data"):
        weather_files.read_hourly_json(spark, write(tmp_path / "x.json", '{"error": true}'), "ms").collect()
    csv = write(tmp_path / "w.csv", "# c\ntime_utc,temp_c,rh_pct,wind_speed_ms,wind_dir_deg\n2024-01-01T00:00,1,2,3,4\n")
    assert tuple(weather_files.read_hourly_csv(spark, csv).first())[1:] == (1.0, 2.0, 3.0, 4.0)


def test_stream_ingest_is_duplicate_free_and_restartable(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()
    small = "latitude,longitude,acq_date,confidence\n"
    write(inbox / "1.csv", "# note\n" + small + "39.5,32.8,2024-06-01,n\n39.6,32.9,2024-06-02,h\n")

    def run():
        source = stream.stream_hotspot_files(spark, str(inbox), str(inbox / "1.csv"))
        stream.ingest(stream.dedup_stream(source), table, state).awaitTermination()
        return sorted((r["latitude"], r["confidence"]) for r in spark.read.parquet(table).collect())

    assert run() == [(39.5, "n"), (39.6, "h")]
    write(inbox / "2.csv", small + "39.6,32.9,2024-06-02,l\n39.7,32.9,2024-06-03,n\n")
    assert run() == [(39.5, "n"), (39.6, "h"), (39.7, "n")]
    assert len(run()) == 3


def image_root(tmp_path):
    for split, stems in {"train": ["a", "b", "c", "d"], "test": ["v"]}.items():
        os.makedirs(tmp_path / "images" / split)
        os.makedirs(tmp_path / "labels" / split)
        for s in stems:
            (tmp_path / "images" / split / f"{s}.{'png' if s == 'b' else 'jpg'}").write_bytes(b"x")
    (tmp_path / "images" / "train" / "note.gif").write_bytes(b"x")
    labels = tmp_path / "labels" / "train"
    write(labels / "a.txt", "2 0.1 0.1 0.2 0.2\n 1 0.5 0.5 0.1 0.1\n")
    write(labels / "b.txt", "2 0.1 0.1 0.2 0.2\n10 0 0 1 1\n")
    write(labels / "c.txt", "\n")
    write(labels / "orphan.txt", "0 0 0 1 1\n")
    return str(tmp_path)


def test_image_folders(spark, tmp_path):
    root = image_root(tmp_path)
    rows = image_files.read_image_folders(spark, root, "train").collect()
    assert {r["path"].rsplit("/", 1)[1]: r["label"] for r in rows} == {"a.jpg": 1, "b.png": 0, "c.jpg": 0, "d.jpg": 0}
    assert image_files.read_image_folders(spark, root, "val").count() == 1  # val falls back to test
    assert image_files.read_image_folders(spark, root, "other").count() == 0


def test_image_names_with_blanks_signs_and_letters(spark, tmp_path):
    for stem in ("fire 1", "fire%2", "fire+3", "feuer ä", "fire"):
        for folder, name, content in (("images", f"{stem}.jpg", "x"), ("labels", f"{stem}.txt", "0 0 0 1 1\n")):
            (tmp_path / folder / "train").mkdir(parents=True, exist_ok=True)
            write(tmp_path / folder / "train" / name, content)
    rows = image_files.read_image_folders(spark, str(tmp_path), "train").collect()
    assert len(rows) == 5 and all(r["label"] == 1 for r in rows)


def test_image_and_label_folders_are_one_path_each(spark, tmp_path):
    plan = image_files.read_image_folders(spark, image_root(tmp_path), "train")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex(1 paths)") == plan.count("InMemoryFileIndex(") == 2


def test_lines_are_not_sorted_to_find_headers(spark, tmp_path):
    for name, text in (("a", "# x\n\n b,a \n1,2\n"), ("b", "a,b\n" + "0,9\n" * 1000), ("c", "\n# only\n")):
        write(tmp_path / f"{name}.csv", text)
    heads = hotspot_files.file_headers(spark, [str(tmp_path)])
    assert {r["file"][-5:]: r["header"] for r in heads.collect()} == {"a.csv": " b,a ", "b.csv": "a,b"}
    assert "SortAggregate" not in heads._jdf.queryExecution().executedPlan().toString()


def test_image_catalogue(spark, tmp_path):
    root = image_root(tmp_path)
    shards = tmp_path / "shards"
    schema = "image struct<bytes:binary,path:string>, annotations string"
    data = [((b"1", "s1"), None), ((b"2", "s2"), "  \n"), ((b"3", "s3"), "0 .5 .5 .1 .1")]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(shards / "set-train-0.parquet"))
    out = image_files.image_catalogue(spark, str(shards), root, "train").collect()
    assert len(out) == 7 and sum(r["label"] for r in out) == 2
    again = image_files.image_catalogue(spark, str(shards), root, "train").collect()
    assert [r["path"] for r in out] == [r["path"] for r in again] != sorted(r["path"] for r in out)
    assert image_files.read_shards(spark, str(shards), "val").count() == 0
    assert image_files.read_shards(spark, str(shards), "test").count() == 0


BOX = (32.7, 39.4, 33.0, 39.6)
SETTINGS = LabelSettings(start="2024-01-01", end="2024-12-31")


def parts(spark):
    t = raster.Transform(x0=32.6, y0=39.7, dx=0.05, dy=-0.05, height=8, width=8)
    pixels = spark.range(64).select(
        (F.col("id") / 8).cast("int").alias("row_ix"),
        (F.col("id") % 8).cast("int").alias("col_ix"),
        (F.col("id") * 37 % 100 + 900.0).alias("elevation"),
        F.element_at(F.array(*[F.lit(c) for c in (10, 20, 30, 80)]), (F.col("id") % 4 + 1).cast("int")).alias("code"),
    )
    hourly = spark.createDataFrame(
        [("2024-01-01", 20.0, 40.0, 2.0, 90.0)],
        "time_utc string, temp_c double, rh_pct double, wind_speed_ms double, wind_dir_deg double",
    )
    fires = spark.createDataFrame(
        [(39.5, 32.85, "2024-06-10", "n")] * 2 + [(38.0, 32.85, "2024-06-10", "n")],
        "latitude double, longitude double, acq_date string, confidence string",
    )
    return t, pixels, hourly, fires


def test_full_dataset(spark, tmp_path):
    t, pixels, hourly, fires = parts(spark)
    cells = grid.grid_cells(spark, BOX, 5000.0)
    built = build_dataset(
        cells, Sources(fires, RasterLayer(pixels, t, "elevation"), RasterLayer(pixels, t, "code"), hourly), 250.0, 39.5, SETTINGS
    )
    assert (built.data_version, built.label_source) == ("real-b1", "hotspot_archive")
    assert built.placeholder_columns == HUMAN
    table = feature_tables.to_contract(built.table)
    assert table.columns == DATASET_COLUMNS
    assert [f.dataType for f in table.schema.fields][3:] == [f.spark_type for f in fields()]
    rows = table.toPandas()
    assert len(rows) == cells.count() * 12 and rows.notna().all().all()
    positive = rows[rows[TARGET] == 1]
    assert set(positive["obs_date"].dt.strftime("%Y-%m-%d")) == {"2024-06-01"} and len(positive) > 0
    assert rows["temp_c"].unique().tolist() == [20.0]
    path = str(tmp_path / "table")
    feature_tables.write_feature_table(built.table, path)
    days = [d for d in os.listdir(path) if d.startswith("obs_day=")]
    assert len(days) == 12 and "obs_day=2024-06-01" in days
    assert sum(f.endswith(".parquet") for d in days for f in os.listdir(f"{path}/{d}")) == 12
    back = feature_tables.load_feature_table(spark, path)
    assert back.dtypes == table.dtypes
    assert back.exceptAll(table).count() == 0 and back.count() == len(rows)
    feature_tables.write_feature_table(built.table, str(tmp_path / "csv"), "csv")
    loaded = feature_tables.load_feature_table(spark, str(tmp_path / "csv"), "csv")
    assert loaded.schema["elevation_m"].dataType == T.FloatType()
    a = loaded.agg(F.sum("elevation_m"), F.sum(TARGET), F.sum("road_dist_m")).first()
    b = table.agg(F.sum("elevation_m"), F.sum(TARGET), F.sum("road_dist_m")).first()
    assert list(a) == pytest.approx(list(b), rel=1e-4)


def test_missing_sources_are_filled_one_by_one(spark):
    t, pixels, _, _ = parts(spark)
    cells = grid.grid_cells(spark, BOX, 5000.0)
    built = build_dataset(cells, Sources(elevation=RasterLayer(pixels, t, "elevation")), 250.0, 39.5, SETTINGS)
    assert (built.data_version, built.label_source) == ("real-v0-no-firms", "synthetic_fallback")
    assert "elevation_m" not in built.placeholder_columns and "temp_c" in built.placeholder_columns
    rows = built.table.toPandas()
    assert rows[FEATURES].notna().all().all()
    assert rows[TARGET].mean() == pytest.approx(0.15, abs=0.01)


def test_loader_errors_and_placeholder_rows(spark, tmp_path):
    df = feature_tables.load_feature_table(spark, n_rows=100)
    assert df.count() == 100
    path = str(tmp_path / "broken")
    df.drop("rh_pct").write.parquet(path)
    with pytest.raises(ValueError, match="rh_pct"):
        feature_tables.load_feature_table(spark, path)


def test_join_of_history_moves_cells_only(spark):
    """Fire history is already partitioned by place: with broadcasts off, its side of the join is not shuffled again."""
    t, pixels, hourly, fires = parts(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = build_dataset(
            grid.grid_cells(spark, BOX, 5000.0),
            Sources(fires, RasterLayer(pixels, t, "elevation"), RasterLayer(pixels, t, "code"), hourly),
            250.0,
            39.5,
            SETTINGS,
        )
        plan = built.table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    top_join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "lat" in line)
    assert top_join < window and not any("Exchange" in line for line in lines[top_join:window])


def test_day_folders_are_pruned(spark, tmp_path):
    keys = spark.range(40).selectExpr("id", "39 + id / 100.0 as lat", "32 + id / 100.0 as lon", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 8 as int)) as obs_date")
    table = placeholders.synthetic_dataset(keys, "id")
    path = str(tmp_path / "t")
    run = quality.Run("v", "synthetic_fallback", 5, 8, (32.0, 39.0, 33.0, 40.0), 250.0, "MS", note="n", placeholder_columns=("a", "b"))
    row = feature_tables.write_dataset(table, path, run).first()
    again = quality.dataset_metadata(table, "v", "synthetic_fallback").first()
    assert (row["n_rows"], row["n_positive"], row["positive_rate"]) == (40, again["n_positive"], again["positive_rate"])
    assert row["n_unmapped"] == 0 and row["placeholder_columns"] == "a,b" and row["hotspots"] is None
    assert (row["lat_min"], row["lat_max"]) == (39.0, 39.39)
    assert len(os.listdir(path)) >= 8

    def read_days(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return {r["d"] for r in df.select(F.col("obs_date").cast("date").cast("string").alias("d")).collect()}, plan

    found, plan = read_days(feature_tables.load_feature_table(spark, path, days=("2024-01-02", "2024-01-03")))
    assert found == {"2024-01-02", "2024-01-03"} and "PartitionFilters: [" in plan and "obs_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    dates = spark.createDataFrame([("2024-01-05",), ("2024-01-05",), ("2030-01-01",)], "day string")
    found, plan = read_days(feature_tables.load_feature_table(spark, path, days=dates))
    assert found == {"2024-01-05"} and "dynamicpruning" in plan
    assert feature_tables.load_feature_table(spark, path).columns == DATASET_COLUMNS
    assert feature_tables.write_dataset(table.limit(0), str(tmp_path / "none"), run).first()["lat_min"] is None


def test_long_days_are_written_without_moving_rows_and_csv_packed(spark, tmp_path, monkeypatch):
    keys = spark.range(0, 80, 1, 4).selectExpr("id", "39 + id / 100.0 as lat", "32 + id / 100.0 as lon", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 4 as int)) as obs_date")
    table = feature_tables.to_contract(placeholders.synthetic_dataset(keys, "id"))
    monkeypatch.setattr(feature_tables, "FEWEST_PER_FILE", 1)
    path = str(tmp_path / "t")
    feature_tables.write_feature_table(table, path, rows_per_day=20, n_days=4)
    files = {d: [f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")] for d in os.listdir(path) if d.startswith("obs_day=")}
    assert len(files) == 4 and all(2 <= len(f) <= spark.sparkContext.defaultParallelism for f in files.values())  # dealt by day: one each
    back = feature_tables.load_feature_table(spark, path)
    assert back.dtypes == table.dtypes and back.count() == 80 and back.exceptAll(table).count() == 0
    feature_tables.write_feature_table(back, str(tmp_path / "csv"), "csv", compression="gzip")
    packed = [f for f in os.listdir(tmp_path / "csv") if f.startswith("part-")]
    assert packed and all(f.endswith(".csv.gz") for f in packed)
    assert feature_tables.load_feature_table(spark, str(tmp_path / "csv"), "csv").exceptAll(table).count() == 0
    monkeypatch.undo()
    assert feature_tables._tasks_in_place(spark, 20, 4) is None and feature_tables._tasks_in_place(spark, 900_000, 24) == 22
    assert feature_tables._tasks_in_place(spark, 900_000, 3_650) is None  # many days: files would be too small


def test_contract_of_text_values(spark):
    table = placeholders.synthetic_dataset(spark.range(30), "id")
    texts = table.select(*[F.col(f.name).cast(f.spark_type).cast("string").alias(f.name) for f in fields()])
    broken = texts.withColumns({
        "temp_c": F.lit(" 12.5 "), "rh_pct": F.lit("wet"), "vpd_kpa": F.lit("NaN"), "picnic_area": F.lit("2"), "lc_cropland": F.lit(" "), "slope_deg": F.lit("1e9"),
    })
    found = {r["col"]: r for r in quality.contract_check(broken).collect()}
    counts = lambda c: tuple(found[c][k] for k in ("type_ok", "n_null", "n_nan", "n_uncast", "n_outside"))
    assert counts("temp_c") == (0, 0, 0, 0, 0) and counts("rh_pct") == (0, 0, 0, 30, 0) and counts("vpd_kpa") == (0, 0, 30, 0, 0)
    assert counts("picnic_area") == (0, 0, 0, 0, 30) and counts("lc_cropland") == (0, 30, 0, 0, 0) and counts("slope_deg") == (0, 0, 0, 0, 30)
    assert counts("elevation_m") == (0, 0, 0, 0, 0)


def test_weather_scan_keeps_bad_records(spark, tmp_path):
    csv = write(tmp_path / "w.csv", "time_utc,temp_c,rh_pct,wind_speed_ms,wind_dir_deg\n2024-01-01 00:00:00,1,2,3,4\n2024-01-01 01:00:00,warm,2,3,4\nonly,three,fields\n")
    scan = weather_files.scan_hourly_csv(spark, csv)
    assert [tuple(r)[1:] for r in scan.rows.collect()] == [(1.0, 2.0, 3.0, 4.0)]
    bad = scan.bad.collect()
    assert sorted(r["record"] for r in bad) == ["2024-01-01 01:00:00,warm,2,3,4", "only,three,fields"] and all(r["file"].endswith("w.csv") for r in bad)
    hours = {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0], "relative_humidity_2m": [2.0], "windspeed_10m": [36.0], "winddirection_10m": [4.0]}
    lines = [{"hourly": hours}, {"hourly": hours | {"time": ["2024-01-01T00:00", "2024-01-01T01:00"]}}, {"error": True}, {"hourly": None}]
    path = write(tmp_path / "w.json", "\n".join(map(json.dumps, lines)) + '\n{"hourly": {"time": [')
    scan = weather_files.scan_hourly_json(spark, path, "kmh")
    assert [r["wind_speed_ms"] for r in scan.rows.collect()] == [10.0]
    reasons = sorted(r["reason"] for r in scan.bad.collect())
    assert reasons == ["hours missing or of unequal length"] * 3 + ["no JSON payload"]


def test_absent_sources_are_placeholders_only_if_allowed(spark, tmp_path):
    there = write(tmp_path / "w.csv", "x")
    assert weather_files.optional(spark, there, lambda p: p) == there
    assert weather_files.optional(spark, None, len, "placeholder") is None
    assert weather_files.optional(spark, str(tmp_path / "no.csv"), len, "placeholder") is None
    with pytest.raises(FileNotFoundError, match="no.csv"):
        weather_files.optional(spark, str(tmp_path / "no.csv"), len)


def test_files_are_written_by_name(spark, tmp_path):
    rows = [("a/b 1%/x.jpg", bytearray(b"\x00\xff")), ("a/ü.txt", bytearray(b"")), ("top.txt", None)]
    assert write_files(spark.createDataFrame(rows, "name string, data binary"), str(tmp_path)) == 3
    assert {n: (tmp_path / n).read_bytes() for n, _ in rows} == {"a/b 1%/x.jpg": b"\x00\xff", "a/ü.txt": b"", "top.txt": b""}
    assert write_files(spark.createDataFrame([], "name string, data binary"), str(tmp_path)) == 0


def test_tiles_are_skipped_at_run_time(spark, tmp_path):
    pixels = spark.range(10_000).selectExpr("cast(id div 100 as int) as row_ix", "cast(id % 100 as int) as col_ix", "id as v")
    transform = raster.Transform(30.0, 40.0, 0.05, -0.05, 100, 100)
    path = str(tmp_path / "tiles")
    raster.write_tiles(raster.with_tile_name(pixels, transform, grid.ELEVATION_TILE), path)
    names = [f for f in os.listdir(path) if f.startswith("tile_name=")]
    assert len(names) == 25
    areas = spark.createDataFrame([(1, 32.2, 37.1, 33.4, 37.3)], "area_id int, lon_min double, lat_min double, lon_max double, lat_max double")
    kept = raster.read_tiles(spark, path, grid.tile_cover(areas, "elevation"))
    rows = kept.collect()
    assert len(rows) == 800 and {(r["row_ix"] // 20, r["col_ix"] // 20) for r in rows} == {(2, 2), (2, 3)}
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()
