"""Inputs derived from the benchmark tables: hotspots, cells, weather, rasters, scores.

Each text is valid in Spark and in DuckDB; ``E0`` keeps literals DOUBLE. Every
view runs over its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOTSPOTS = """
select o_orderkey as hotspot_id,
       37.0E0 + ((o_orderkey*7919)%59999)/10000.0E0 as latitude,
       28.0E0 + ((o_orderkey*104729)%99991)/10000.0E0 as longitude,
       o_orderdate as acq_date,
       case o_orderkey%4 when 0 then 'l' when 1 then ' N ' when 2 then 'high' else '85' end as confidence,
       o_totalprice as frp
from {orders}"""

ARCHIVE = """
select cast(l_linenumber as bigint) as chunk_seq, l_orderkey as line_ref,
       38.0E0 + (l_suppkey%40)/20.0E0 as latitude,
       30.0E0 + ((l_suppkey*7)%60)/20.0E0 as longitude,
       l_shipdate as acq_date,
       case l_orderkey%3 when 0 then 'low' when 1 then 'nominal' else 'high' end as confidence,
       l_quantity as frp
from {lineitem}"""

CELLS = """
select c_custkey as cell_id,
       37.0E0 + ((c_custkey*7919)%5987)/1000.0E0 as lat,
       28.0E0 + ((c_custkey*104729)%9973)/1000.0E0 as lon
from {customer}"""

AREAS = """
select s_suppkey as area_id,
       26.0E0 + ((s_suppkey*37)%190)/10.0E0 as lon_min,
       36.0E0 + ((s_suppkey*53)%60)/10.0E0 as lat_min,
       26.0E0 + ((s_suppkey*37)%190)/10.0E0 + (1+s_suppkey%5)/10.0E0 as lon_max,
       36.0E0 + ((s_suppkey*53)%60)/10.0E0 + (1+s_suppkey%3)/10.0E0 as lat_max
from {supplier}"""

PERIODS = """
select o_custkey as area_id, min(o_orderdate) as start_date, max(o_orderdate) as end_date
from {orders} group by o_custkey"""

WEATHER = """
select event_id, ts as time_utc, -10.0E0 + ((event_id*29)%550)/10.0E0 as temp_c,
       5.0E0 + (event_id*13)%96 as rh_pct, ((event_id*7)%250)/10.0E0 as wind_speed_ms,
       ((event_id*47)%360)*1.0E0 as wind_dir_deg
from {events}"""

PIXELS = """
select cast(floor(p_partkey/50.0E0) as int) as row_ix, cast(p_partkey%50 as int) as col_ix,
       900.0E0 + (p_partkey*37+p_size*11)%700 as elevation,
       cast(case p_partkey%11 when 0 then 10 when 1 then 20 when 2 then 30 when 3 then 40 when 4 then 50
            when 5 then 60 when 6 then 70 when 7 then 80 when 8 then 90 when 9 then 95 else 100 end as int) as code
from {part}"""

SCORED = """
select event_id, 39.4E0 + ((event_id*37)%977)/5000.0E0 as lat,
       case when event_type='error' then 1 else 0 end as y,
       ((event_id*7919)%80 + case when event_type='error' then 20 else 0 end)/100.0E0 as p,
       ((event_id*7919)%80 + case when event_type='error' then 20 else 0 end
          + case when event_id%50=0 then 1 else 0 end)/100.0E0 as p_alt
from {events}"""

IMAGES = """
select doc_id as image_id, case when doc_id%5=0 then 'val' else 'train' end as split,
       'images/' || case when doc_id%5=0 then 'val' else 'train' end || '/img_' || cast(doc_id as string) || '.jpg' as path,
       case doc_id%4 when 0 then null when 1 then '   ' when 2 then '0 0.5 0.5 0.1 0.1' else '1 0.2 0.3 0.1 0.1' end as annotations,
       text
from {documents}"""

LABEL_FILES = """
select 'img_' || cast(doc_id as string) as stem,
       case doc_id%4 when 0 then '' when 1 then '2 0.1 0.1 0.2 0.2' when 2 then '0 0.5 0.5 0.1 0.1' else '1 0.2 0.2 0.1 0.1' end as content
from {labels}"""

# Observation months, and the 50-column pixel raster laid over the region.
OBS_START, OBS_END = "1997-01-01", "1998-12-01"
RASTER = {"x0": 28.0, "y0": 43.0, "dx": 0.2, "dy": -0.15, "width": 50}
PIXEL_M, MID_LAT = 250.0, 39.5
# Upper edge of the same pixels where they are stored by tile.
TILED_Y0 = 41.5

ATTRIBUTION_WEIGHTS = {"vpd_kpa": 3, "temp_c": 5, "slope_deg": 7, "elevation_m": 2, "ffmc_approx": 11}

_TABLE_OF = {
    "HOTSPOTS": "orders",
    "ARCHIVE": "lineitem",
    "CELLS": "customer",
    "AREAS": "supplier",
    "PERIODS": "orders",
    "WEATHER": "events",
    "PIXELS": "part",
    "SCORED": "events",
    "IMAGES": "documents",
    "LABEL_FILES": "labels",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame."""
    source = _TABLE_OF[name]
    return spark.sql(globals()[name], **{source: table(spark, sf_dir, source)})


def sql_text(name: str) -> str:
    """The same view for DuckDB, reading the registered table of that name."""
    source = _TABLE_OF[name]
    return globals()[name].replace("{" + source + "}", source)
