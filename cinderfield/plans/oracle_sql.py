"""DuckDB statements that compute each registered query a second, independent way.

They use plain nested joins and textbook formulas on purpose: nothing of the
Spark plans (bins, running sums, value ranges) appears here.
"""

from __future__ import annotations

from cinderfield.contract import HUMAN, LAND_COVER, LAND_COVER_CODES, contract_rows
from cinderfield.plans import views
from cinderfield.plans.queries import AREA_RESOLUTION_M, BBOX, COVERAGE_DAYS

_SETS = {
    "hot": "HOTSPOTS",
    "arch": "ARCHIVE",
    "cells": "CELLS",
    "areas": "AREAS",
    "periods": "PERIODS",
    "weather": "WEATHER",
    "pixels": "PIXELS",
    "scored": "SCORED",
    "images": "IMAGES",
    "label_files": "LABEL_FILES",
}


def _with(names: str, body: str, extra: str = "") -> str:
    parts = [f"{n} as ({views.sql_text(_SETS[n])})" for n in names.split()]
    if extra:
        parts.append(extra.strip())
    return "with " + ",\n".join(parts) + "\n" + body.strip()


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2*6371000.0E0*asin(sqrt(least(1.0E0, pow(sin(radians({lat2}-{lat1})/2),2)"
        f" + cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2))))"
    )


_KEPT = "case lower(trim(confidence)) when 'l' then 'low' when 'n' then 'nominal' when 'h' then 'high' else lower(trim(confidence)) end"
_OBS = (
    f"obs as (select cell_id, lat, lon, unnest(generate_series(timestamp '{views.OBS_START}', "
    f"timestamp '{views.OBS_END}', interval 1 month)) as obs_date from cells)"
)
_NEAR = f"""near as (select c.cell_id, h.acq_date from cells c join hot h
  on {_haversine('c.lat', 'c.lon', 'h.latitude', 'h.longitude')} <= 10000.0E0
  where {_KEPT} in ('nominal', 'high'))"""
_LABELLED = f"""{_OBS}, {_NEAR},
labelled as (select o.cell_id, o.obs_date, any_value(o.lat) as lat, any_value(o.lon) as lon,
  max(case when n.acq_date >= o.obs_date + interval 1 day and n.acq_date <= o.obs_date + interval 30 day
      then 1 else 0 end) as label,
  sum(case when n.acq_date >= o.obs_date - interval 365 day and n.acq_date <= o.obs_date - interval 31 day
      then 1 else 0 end) as density,
  max(case when n.acq_date <= o.obs_date - interval 31 day then n.acq_date end) as last_fire
  from obs o left join near n on n.cell_id = o.cell_id group by o.cell_id, o.obs_date)"""
_DAYS = (
    "cast(case when last_fire is null then 3650 else least(3650, datediff('day', last_fire, obs_date)) end as double)"
)

_R = views.RASTER
_ROW = f"greatest(0, least(cast(floor((lat-{_R['y0']}E0)/({_R['dy']}E0)) as bigint), (select max(row_ix) from pixels)))"
_COL = f"greatest(0, least(cast(floor((lon-{_R['x0']}E0)/{_R['dx']}E0) as bigint), {_R['width'] - 1}))"

_STEP_EW = f"({views.PIXEL_M}E0/cos(radians({views.MID_LAT}E0)))"
_GRADIENT = f"""g as (select row_ix, col_ix, elevation,
   elevation - lag(elevation) over ns as dn, lead(elevation) over ns - elevation as ds,
   elevation - lag(elevation) over we as dw, lead(elevation) over we - elevation as de
   from pixels window ns as (partition by col_ix order by row_ix), we as (partition by row_ix order by col_ix)),
 grad as (select row_ix, col_ix, elevation,
   case when dn is null then ds when ds is null then dn else (dn+ds)/2 end/{views.PIXEL_M}E0 as dy,
   case when dw is null then de when de is null then dw else (dw+de)/2 end/{_STEP_EW} as dx from g),
 terrain as (select row_ix, col_ix, elevation, degrees(atan(sqrt(dx*dx+dy*dy))) as slope_deg,
   case when degrees(atan2(-dx, dy)) < 0 then degrees(atan2(-dx, dy))+360 else degrees(atan2(-dx, dy)) end as aspect_deg
   from grad)"""


def _vpd(t: str, rh: str) -> str:
    return f"greatest(0.0E0, least(10.0E0, 0.6112E0*exp(17.67E0*{t}/({t}+243.5E0))*(1.0E0-{rh}/100.0E0)))"


def _ffmc(t: str, rh: str, wind: str) -> str:
    h = f"greatest(5.0E0, least(100.0E0, {rh}))"
    ed = (
        f"(0.942E0*pow({h},0.679E0)+11.0E0*exp(({h}-100.0E0)/10.0E0)"
        f"+0.18E0*(21.1E0-{t})*(1.0E0-exp(-0.115E0*{h})))"
    )
    m0 = "(147.2E0*(101.0E0-85.0E0)/(59.5E0+85.0E0))"
    m = f"({ed}+({m0}-{ed})*exp(-1.0E0-0.0365E0*({wind}*3.6E0)))"
    return f"greatest(0.0E0, least(101.0E0, 59.5E0*(250.0E0-{m})/(147.2E0+{m})))"


_MEANS = """means as (select avg(temp_c) as t, avg(rh_pct) as rh, avg(wind_speed_ms) as w,
  avg(wind_dir_deg) as d from weather)"""
_WEATHER_COLUMNS = f"""round(t,6) as temp_c, round(rh,6) as rh_pct, round(w,6) as wind_speed_ms,
  round(sin(radians(d)),6) as wind_dir_sin, round(cos(radians(d)),6) as wind_dir_cos,
  round({_vpd('t', 'rh')},6) as vpd_kpa, round({_ffmc('t', 'rh', 'w')},6) as ffmc_approx"""


def _flags(code: str) -> str:
    return ", ".join(
        f"case when {code}={value} then 1 else 0 end as {name}"
        for name, value in zip(LAND_COVER, LAND_COVER_CODES)
    )


def _unit(key: str, name: str, seed: int = 42) -> str:
    text = f"md5(cast({key} as varchar)||'|{seed}|{name}')"
    return f"(cast('0x'||substr({text},1,12) as bigint)/281474976710656.0E0)"


def _beta(key: str, name: str) -> str:
    return "list_sort([" + ", ".join(_unit(key, f"{name}{i}") for i in range(6)) + "])[2]"


def _exponential(key: str, name: str, scale: float, high: float) -> str:
    return f"least({high}E0, -{scale}E0*ln(1.0E0-{_unit(key, name)}))"


def _poisson(u: str) -> str:
    steps, weight, total = [], 0.7408182206817179, 0.0
    for k in range(8):
        total += weight
        steps.append(f"case when {u} >= {total!r}E0 then 1.0E0 else 0.0E0 end")
        weight *= 0.3 / (k + 1)
    return "(" + " + ".join(steps) + ")"


def _placeholder_base(key: str, table: str) -> str:
    shares = [0.0, 0.40, 0.60, 0.75, 0.85, 0.90, 0.95, 0.98]
    cover = " ".join(f"when u_cover < {s}E0 then {i}" for i, s in enumerate(shares[1:]))
    return f"""draws as (select {key},
  {_unit(key, 'elevation_m')}*700.0E0+900.0E0 as elevation_m, {_beta(key, 'slope_deg')}*45.0E0 as slope_deg,
  {_unit(key, 'aspect')}*360.0E0 as aspect, {_unit(key, 'land_cover')} as u_cover,
  greatest(-10.0E0, least(45.0E0, 25.0E0+8.0E0*sqrt(-2.0E0*ln(1.0E0-{_unit(key, 'temp_ca')}))
     *cos(2.0E0*pi()*{_unit(key, 'temp_cb')}))) as temp_c,
  greatest(5.0E0, least(100.0E0, {_beta(key, 'rh_pct')}*100.0E0)) as rh_pct,
  {_exponential(key, 'wind_speed_ms', 3.0, 25.0)} as wind_speed_ms,
  {_unit(key, 'wind_dir')}*360.0E0 as heading, {_unit(key, 'firms_density_1yr')} as u_density,
  {_exponential(key, 'days_since_last_fire', 500.0, 3650.0)} as days_since_last_fire,
  {_exponential(key, 'road_dist_m', 800.0, 5000.0)} as road_dist_m,
  {_exponential(key, 'settlement_dist_m', 2000.0, 10000.0)} as settlement_dist_m,
  case when {_unit(key, 'picnic_area')} < 0.05E0 then 1 else 0 end as picnic_area from {table}),
 filled as (select *, case {cover} else 7 end as cover, {_poisson('u_density')} as firms_density_1yr,
  {_vpd('temp_c', 'rh_pct')} as vpd_kpa, {_ffmc('temp_c', 'rh_pct', 'wind_speed_ms')} as ffmc_approx from draws)"""


_COVER_FLAGS = ", ".join(
    f"case when cover={i} then 1 else 0 end as {name}" for i, name in enumerate(LAND_COVER)
)
_SCORE = """1.0E0/(1.0E0+exp(-2.0E0*(0.15E0*vpd_kpa/5.0E0 + 0.10E0*(1.0E0-rh_pct/100.0E0)
  + 0.15E0*{tree} + 0.10E0*{shrub} + 0.10E0*picnic_area + 0.05E0*ffmc_approx/100.0E0
  + 0.05E0*(1.0E0-settlement_dist_m/10000.0E0) + 0.05E0*firms_density_1yr/5.0E0 - 0.5E0)))"""

_SAMPLED = f"""{_GRADIENT},
placed as (select *, {_ROW} as r, {_COL} as c from cells),
static as (select p.cell_id, p.lat, p.lon, t.elevation, least(45.0E0, t.slope_deg) as slope_deg,
  t.aspect_deg, x.code from placed p join terrain t on t.row_ix=p.r and t.col_ix=p.c
  join pixels x on x.row_ix=p.r and x.col_ix=p.c)"""

_ROW_KEY = "cast(cell_id as varchar)||'|'||strftime(obs_date, '%Y-%m-%d')"

_BANDS = """edges as (select quantile_cont(lat, [0.2, 0.4, 0.6, 0.8]) as e from scored),
banded as (select s.*, cast((case when lat > e[1] then 1 else 0 end) + (case when lat > e[2] then 1 else 0 end)
  + (case when lat > e[3] then 1 else 0 end) + (case when lat > e[4] then 1 else 0 end) as int) as fold
  from scored s, edges)"""

_BY_SCORE = """by_score as (select p, cast(sum(y) as double) as pos, cast(sum(1-y) as double) as neg from scored group by p),
ranked as (select *, sum(pos) over (order by p desc) as tp, sum(neg) over (order by p desc) as fp,
  sum(pos) over () as all_pos, sum(neg) over () as all_neg from by_score)"""

_CONFUSION = """cm as (select count(*) filter (where y=0 and p<0.5) as tn, count(*) filter (where y=0 and p>=0.5) as fp,
  count(*) filter (where y=1 and p<0.5) as fn, count(*) filter (where y=1 and p>=0.5) as tp from scored)"""


def _tile(ns_lat: str, ew_lon: str, pattern: str) -> str:
    lat = f"case when {ns_lat}>=0 then 'N' else 'S' end"
    lat_n = f"lpad(cast(abs({ns_lat}) as varchar),2,'0')"
    lon = f"case when {ew_lon}>=0 then 'E' else 'W' end"
    lon_n = f"lpad(cast(abs({ew_lon}) as varchar),3,'0')"
    return pattern.format(lat=lat, lat_n=lat_n, lon=lon, lon_n=lon_n)


_ELEVATION_NAME = "'Copernicus_DSM_COG_10_'||{lat}||{lat_n}||'_00_'||{lon}||{lon_n}||'_00_DEM'"
_COVER_NAME = "'ESA_WorldCover_10m_2021_v200_'||{lat}||{lat_n}||{lon}||{lon_n}||'_Map'"

_STEP = f"({AREA_RESOLUTION_M}E0*(360.0E0/40075017.0E0))"


def statements() -> dict[str, str]:
    lo0, la0, lo1, la1 = BBOX
    days = COVERAGE_DAYS
    out: dict[str, str] = {}

    out["fire_labels"] = _with(
        "hot cells",
        "select cell_id, obs_date, cast(label as int) as label, cast(density as bigint) as density from labelled",
        _LABELLED,
    )
    out["days_since_last"] = _with(
        "hot cells", f"select cell_id, obs_date, {_DAYS} as days_since from labelled", _LABELLED
    )
    out["confidence_filter"] = _with(
        "hot", f"select hotspot_id, {_KEPT} as level from hot where {_KEPT} in ('nominal','high')"
    )
    percent = "hotspot_id % 120 - 5"
    out["confidence_numeric"] = _with(
        "hot",
        f"""select hotspot_id, case when confidence <> '85' then {_KEPT} when {percent} < 80 then 'nominal' else 'high' end as level from hot
            where case when confidence = '85' then {percent} between 30 and 100 else {_KEPT} in ('nominal','high') end""",
    )
    distance = _haversine("c.lat", "c.lon", "h.latitude", "h.longitude")
    out["radius_join"] = _with(
        "hot cells",
        f"select c.cell_id, h.hotspot_id, round({distance},3) as distance_m from cells c, hot h where {distance} <= 10000.0E0",
    )
    out["radius_count"] = _with(
        "hot cells",
        f"""select c.cell_id, count(h.hotspot_id) as n_hotspots from cells c left join hot h
            on {distance} <= 10000.0E0 group by c.cell_id""",
    )

    out["grid_cells"] = _with(
        "areas",
        """select area_id, r*n_lon + c as cell_id, round(lat0 + r*step_lat, 6) as lat, round(lon0 + c*step_lon, 6) as lon
           from (select *, unnest(range(n_lon)) as c from (select *, unnest(range(n_lat)) as r from dims))""",
        f"""steps as (select *, {_STEP} as step_lat, {_STEP}/cos(radians((lat_min+lat_max)/2)) as step_lon from areas),
        dims as (select *, lat_min+step_lat/2 as lat0, lon_min+step_lon/2 as lon0,
          cast(ceil((lat_max-(lat_min+step_lat/2))/step_lat) as bigint) as n_lat,
          cast(ceil((lon_max-(lon_min+step_lon/2))/step_lon) as bigint) as n_lon from steps)""",
    )
    out["obs_dates"] = _with(
        "periods",
        """select area_id, 'MS' as freq, unnest(generate_series(first_day, end_date, interval 1 month)) as obs_date from firsts
           union all
           select area_id, '2W', unnest(generate_series(first_day + to_days(cast((7 - isodow(first_day))%7 as int)), end_date, interval 14 day)) from firsts""",
        "firsts as (select *, cast(date_trunc('month', start_date) as timestamp) as first_day from periods)",
    )
    out["grid_dates"] = _with("cells", "select cell_id, lat, lon, obs_date from obs", _OBS)
    one = _tile("la", "lo", _ELEVATION_NAME)
    three = _tile("la", "lo", _COVER_NAME)
    cover1 = """one_lat as (select *, unnest(range(cast(floor(lat_min) as bigint), cast(ceil(lat_max) as bigint))) as la from areas),
        one as (select *, unnest(range(cast(floor(lon_min) as bigint), cast(ceil(lon_max) as bigint))) as lo from one_lat)"""
    out["tile_cover"] = _with(
        "areas",
        f"""select area_id, 'elevation' as scheme, {one} as tile_name from one
            union all select area_id, 'land_cover', {three} from three""",
        cover1
        + """, three_lat as (select *, unnest(range(cast(floor(lat_min/3)*3 as bigint), cast(floor(lat_max/3)*3 as bigint)+1, 3)) as la from areas),
        three as (select *, unnest(range(cast(floor(lon_min/3)*3 as bigint), cast(floor(lon_max/3)*3 as bigint)+1, 3)) as lo from three_lat)""",
    )
    spot_tile = _tile("cast(floor(latitude) as bigint)", "cast(floor(longitude) as bigint)", _ELEVATION_NAME)
    out["tile_prune"] = _with(
        "areas hot",
        f"""select tile_name, count(*) as n_hotspots from (select {spot_tile} as tile_name from hot)
            where tile_name in (select {one} from one) group by tile_name""",
        cover1,
    )

    mid_lat = f"cast(floor({views.TILED_Y0}E0 + (row_ix + 0.5E0) * {views.RASTER['dy']}E0) as int)"
    mid_lon = f"cast(floor({views.RASTER['x0']}E0 + (col_ix + 0.5E0) * {views.RASTER['dx']}E0) as int)"
    pixel_tile = _tile(mid_lat, mid_lon, _ELEVATION_NAME)
    out["tile_store"] = _with(
        "areas pixels",
        f"""select tile_name, count(*) as n_pixels, round(avg(elevation),6) as elevation from (select *, {pixel_tile} as tile_name from pixels)
            where tile_name in (select {one} from one) group by tile_name""",
        cover1,
    )
    sums = "round(sum(temp_c),6) as temp_c, round(sum(rh_pct),6) as rh_pct, round(sum(wind_speed_ms),6) as wind_speed_ms, round(sum(wind_dir_deg),6) as wind_dir_deg"
    out["weather_file_scan"] = _with(
        "weather",
        f"""select 'csv' as source, count(*) as n_rows, count(distinct date_trunc('minute', time_utc)) as n_times, {sums},
              (select count(*) from weather where event_id%17=0) as n_bad, 1::bigint as n_reasons from weather where event_id%17<>0
            union all select 'json', count(*), count(distinct date_trunc('minute', time_utc)), {sums},
              (select count(*) from weather where event_id%17=0 or event_id%19=0), 2::bigint from weather where event_id%17<>0 and event_id%19<>0""",
    )
    out["hotspots_in_bbox"] = _with(
        "hot",
        f"""select hotspot_id, latitude, longitude from hot
            where longitude >= {lo0} and longitude <= {lo1} and latitude >= {la0} and latitude <= {la1}""",
    )
    out["vpd"] = _with("weather", f"select event_id, round({_vpd('temp_c', 'rh_pct')},6) as vpd_kpa from weather")
    out["ffmc"] = _with(
        "weather",
        f"select event_id, round({_ffmc('temp_c', 'rh_pct', 'wind_speed_ms')},6) as ffmc_approx from weather",
    )
    out["circular_encode"] = _with(
        "weather",
        """select event_id, round(sin(radians(wind_dir_deg)),6) as wind_dir_sin,
           round(cos(radians(wind_dir_deg)),6) as wind_dir_cos from weather""",
    )

    codes = ", ".join(str(c) for c in LAND_COVER_CODES)
    out["landcover_onehot"] = _with(
        "pixels",
        f"""select row_ix, col_ix, {_flags('code')},
            case when code in ({codes}) then 0 else 1 end as unmapped from pixels""",
    )
    out["pixel_index"] = _with(
        "pixels cells", f"select cell_id, cast({_ROW} as int) as row_ix, cast({_COL} as int) as col_ix from cells"
    )
    out["raster_sample"] = _with(
        "pixels cells",
        f"""select p.cell_id, x.elevation, x.code from (select cell_id, {_ROW} as r, {_COL} as c from cells) p
            left join pixels x on x.row_ix = p.r and x.col_ix = p.c""",
    )
    out["slope_aspect"] = _with(
        "pixels",
        "select row_ix, col_ix, round(slope_deg,6) as slope_deg, round(aspect_deg,6) as aspect_deg from terrain",
        _GRADIENT,
    )
    out["raster_mosaic"] = _with(
        "pixels",
        """select * from (
             select coalesce(a.row_ix, b.row_ix) as row_ix, coalesce(a.col_ix, b.col_ix) as col_ix,
               coalesce(a.elevation, b.elevation) as elevation, coalesce(a.code, b.code) as code
             from gaps a full join (select row_ix+1 as row_ix, col_ix+1 as col_ix, elevation+1000.0E0 as elevation, code+1000 as code from gaps) b
               on a.row_ix = b.row_ix and a.col_ix = b.col_ix)
           where elevation is not null or code is not null""",
        """gaps as (select row_ix, col_ix, case when (row_ix+col_ix)%3=0 then null else elevation end as elevation,
             case when (row_ix+col_ix)%4=0 then null else code end as code from pixels)""",
    )
    # The box spans columns 10.5..36.5 and rows from 1.3 on: pixels 10..36 and 1.. meet it.
    out["raster_crop"] = _with(
        "pixels",
        """select row_ix-1 as row_ix, col_ix-10 as col_ix, elevation, code from pixels
           where 28.0+(col_ix+1)*0.2 > 30.1+1e-7 and 28.0+col_ix*0.2 < 35.3-1e-7
             and 43.0-(row_ix+1)*0.15 < 42.8-1e-7""",
    )

    out["weather_attach"] = _with(
        "cells weather", f"select cell_id, {_WEATHER_COLUMNS} from cells, means", _MEANS
    )
    out["hourly_explode"] = _with(
        "weather",
        """select event_id, date_trunc('minute', time_utc) + to_hours(cast(h as int)) as time_utc, temp_c+h as temp_c, rh_pct,
           round((wind_speed_ms+h)/3.6E0,6) as wind_speed_ms, wind_dir_deg
           from (select *, unnest([0,1,2]) as h from weather)""",
    )

    out["hotspot_dedup"] = _with(
        "arch",
        """select * exclude rn from (select *, row_number() over (partition by latitude, longitude, acq_date
           order by chunk_seq, line_ref, frp, confidence) as rn from arch) where rn = 1""",
    )
    out["archive_coverage"] = _with(
        "hot",
        f"""select k as chunk, s as chunk_start, cast(least({days}, date_diff('day', s, s1)+1) as int) as span_days, count(h.hotspot_id) as n_hotspots
            from (select i as k, s0 + to_days(cast(i*{days} as int)) as s, s1 from (select *, unnest(range(n)) as i from span)) c
            left join hot h on h.acq_date >= s and h.acq_date < s + to_days({days}) group by k, s, s1""",
        f"""span as (select s0, s1, cast(ceil((date_diff('day', s0, s1)+1)/{days}.0) as bigint) as n
            from (select date_trunc('day', min(acq_date)) as s0, date_trunc('day', max(acq_date)) as s1 from hot))""",
    )

    human = (
        f"round({_exponential('rk', 'road_dist_m', 800.0, 5000.0)},6) as road_dist_m, "
        f"round({_exponential('rk', 'settlement_dist_m', 2000.0, 10000.0)},6) as settlement_dist_m, "
        f"case when {_unit('rk', 'picnic_area')} < 0.05E0 then 1 else 0 end as picnic_area"
    )
    out["risk_dataset"] = _with(
        "hot cells pixels weather",
        f"""select cell_id, lat, lon, obs_date, round(elevation,6) as elevation_m, round(slope_deg,6) as slope_deg,
            round(sin(radians(aspect_deg)),6) as aspect_sin, round(cos(radians(aspect_deg)),6) as aspect_cos,
            {_flags('code')}, {_WEATHER_COLUMNS}, cast(density as double) as firms_density_1yr,
            {_DAYS} as days_since_last_fire, {human}, cast(label as int) as fire_occurred_within_30d
            from (select l.*, s.elevation, s.slope_deg, s.aspect_deg, s.code, {_ROW_KEY.replace('cell_id', 'l.cell_id')} as rk
                  from labelled l join static s on s.cell_id = l.cell_id), means""",
        f"{_LABELLED}, {_SAMPLED}, {_MEANS}",
    )
    score = _SCORE.format(
        tree="(case when code=10 then 1 else 0 end)", shrub="(case when code=20 then 1 else 0 end)"
    )
    out["risk_dataset_no_hotspots"] = _with(
        "cells pixels weather",
        """select obs_date, count(*) as n_rows, cast(sum(case when score >= (select quantile_cont(score, 0.85) from scores)
           then 1 else 0 end) as bigint) as n_positive from scores group by obs_date""",
        f"""{_OBS}, {_SAMPLED}, {_MEANS},
        rows_ as (select o.cell_id, o.obs_date, s.code, {_ROW_KEY.replace('cell_id', 'o.cell_id').replace('obs_date', 'o.obs_date')} as rk
          from obs o join static s on s.cell_id=o.cell_id),
        base as (select r.*, {_vpd('t', 'rh')} as vpd_kpa, rh as rh_pct, {_ffmc('t', 'rh', 'w')} as ffmc_approx,
          {_exponential('rk', 'settlement_dist_m', 2000.0, 10000.0)} as settlement_dist_m,
          case when {_unit('rk', 'picnic_area')} < 0.05E0 then 1 else 0 end as picnic_area,
          {_unit('rk', 'firms_density_1yr')} as u_density from rows_ r, means),
        dens as (select *, {_poisson('u_density')} as firms_density_1yr from base),
        scores as (select obs_date, {score} as score from dens)""",
    )
    risk = f"risk as materialized ({out['risk_dataset']})"
    cells = f"cells as ({views.sql_text('CELLS')})"
    target = "fire_occurred_within_30d"
    out["dataset_metadata"] = f"""with {risk}, {cells}
      select 'real-b1' as data_version, 'hotspot_archive' as label_source, count(*) as n_rows,
        (select count(distinct (lat, lon)) from cells) as n_grid_cells, count(distinct obs_date) as n_obs_date_slices,
        cast(sum({target}) as bigint) as n_positive, count(*) filter (where {' + '.join(LAND_COVER)} = 0) as n_unmapped,
        round(avg({target}),6) as positive_rate, 0.002E0 as positive_rate_threshold,
        case when avg({target}) < 0.002 then 1 else 0 end as too_sparse, 'MS' as obs_freq, 250.0E0 as grid_resolution_m,
        (select round(min(lon),6) from cells) as bbox_lon_min, (select round(min(lat),6) from cells) as bbox_lat_min,
        (select round(max(lon),6) from cells) as bbox_lon_max, (select round(max(lat),6) from cells) as bbox_lat_max,
        round(min(lat),6) as lat_min, round(max(lat),6) as lat_max, round(min(lon),6) as lon_min, round(max(lon),6) as lon_max,
        'orders' as hotspots, 'hotspots, rasters and weather are derived from tables' as note, '{",".join(HUMAN)}' as placeholder_columns
      from risk"""
    in_1998 = "from risk where year(obs_date) = 1998"
    kinds = {"float32": "float", "int8": "tinyint"}
    columns = [("lat", "double"), ("lon", "double"), ("obs_date", "timestamp_ntz"), *[(r[0], kinds[r[1]]) for r in contract_rows()]]
    listed = ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(columns, 1))
    out["feature_table_roundtrip"] = f"""with {risk}, listed(place, col, type) as (values {listed}),
      readings as (select 'all' as reading, count(*) as n_values from risk
        {" ".join(f"union all select '{r}', count(*) {in_1998}" for r in ("range", "dates", "csv"))})
      select reading, place, col, type, n_values from readings, listed"""
    split = "ceil({n} * 0.2 - 1e-9)"
    n1, n0 = split.format(n="pos"), split.format(n="neg")
    out["holdout_sizes"] = f"""with {risk}, sizes as (select sum({target}) as pos, sum(1 - {target}) as neg from risk)
      select cast(pos + neg - 2 * ({n1} + {n0}) as bigint) as n_train, cast({n1} + {n0} as bigint) as n_val, cast({n1} + {n0} as bigint) as n_test,
        cast({n1} as bigint) as pos_test, round((neg - 2 * {n0}) / (pos - 2 * {n1}), 6) as scale_pos_weight, 1 as metrics_agree from sizes"""
    edges = " ".join(f"when {k} then quantile_cont(lat, {[i / k for i in range(1, k)]})" for k in (2, 3, 4, 5))
    out["spatial_cv_folds"] = f"""with {risk}, planned as (select greatest(2, least(5, floor(sum({target}) / 5.0))) as k from risk),
      edges as (select list_distinct(case (select k from planned) {edges} end) as e from risk),
      banded as (select {target}, cast(len(list_filter(e, lambda x: lat > x)) as int) as fold from risk, edges),
      per as (select fold, count(*) as n_val, cast(sum({target}) as bigint) as pos_val from banded group by fold),
      totals as (select sum(n_val) as n, sum(pos_val) as p from per)
      select fold, n_val, pos_val, n_val as n_probabilities from per, totals
      where pos_val between 1 and n_val - 1 and p - pos_val between 1 and n - n_val - 1"""
    out["batch_score_check"] = f"""with {risk} select {_ROW_KEY} as row_key, 1 as p_is_logistic, 1 as same_decision from risk"""
    out["attribution_check"] = f"""with {risk} select count(*) as n_rows, 0::bigint as n_wrong_size, 0::bigint as n_violations from risk"""
    out["sparsity_gate"] = _with(
        "hot cells",
        """select count(*) as n_rows, round(avg(label),6) as positive_rate,
           case when avg(label) < 0.002 then 1 else 0 end as too_sparse from labelled""",
        _LABELLED,
    )

    out["contract_check"] = f"with {risk} " + " union all ".join(
        f"""select '{c}' as col, 1 as type_ok, count(*) filter (where {c} is null) as n_null, 0::bigint as n_nan, 0::bigint as n_uncast,
            count(*) filter (where {c} < {lo} or {c} > {hi}) as n_outside from risk"""
        for c, _, lo, hi, _ in contract_rows()
    )
    spot = "(cast(floor(lat * 1000 + 0.5) as bigint) + dayofyear(obs_date)) % 25"
    checks = []
    for i, (c, dtype, lo, hi, _) in enumerate(contract_rows()):
        hit = [f"count(*) filter (where spot = {i} and {int(kind)} = 1)" for kind in (
            i % 4 == 1, i % 4 == 2 and dtype == "float32", i % 4 == 0 or (i % 4 == 2 and dtype == "int8"), i % 4 == 3)]
        checks.append(
            f"""select '{c}' as col, 0 as type_ok, {hit[0]} as n_null, {hit[1]} as n_nan, {hit[2]} as n_uncast,
            {hit[3]} + count(*) filter (where spot <> {i} and ({c} < {lo} or {c} > {hi})) as n_outside from spotted"""
        )
    out["contract_check_text"] = f"with {risk}, spotted as (select *, {spot} as spot from risk) " + " union all ".join(checks)
    declared = ", ".join(f"('{c}', '{d}', {lo!r}E0, {hi!r}E0)" for c, d, lo, hi, _ in contract_rows())
    held = [(r[0], r[1]) for r in contract_rows() if r[0] != target] + [("lat", "float64")]
    seen = " union all ".join(f"select '{c}' as col, '{d}' as dtype, min({c})::double as low, max({c})::double as high from risk" for c, d in held)
    out["contract_diff"] = f"""with {risk}, declared(col, dtype, low, high) as (values {declared}), seen as ({seen})
      select coalesce(d.col, s.col) as col,
        case when s.col is null then 'missing' when d.col is null then 'extra' else 'both' end as status,
        case when d.dtype is distinct from s.dtype then 1 else 0 end as dtype_differs,
        case when d.low is distinct from s.low then 1 else 0 end as low_differs,
        case when d.high is distinct from s.high then 1 else 0 end as high_differs
      from declared d full outer join seen s on s.col = d.col
      where d.col is null or s.col is null or d.dtype <> s.dtype or d.low <> s.low or d.high <> s.high"""

    out["latitude_bands"] = _with("scored", "select event_id, fold from banded", _BANDS)
    out["spatial_folds"] = _with(
        "scored",
        """select fold, n_val, pos_val, n - n_val as n_train, p - pos_val as pos_train,
           case when pos_val > 0 and pos_val < n_val and p-pos_val > 0 and p-pos_val < n-n_val then 1 else 0 end as usable,
           case when pos_val < 5 then 1 else 0 end as few_positives
           from (select fold, count(*) as n_val, cast(sum(y) as bigint) as pos_val from banded group by fold),
                (select count(*) as n, cast(sum(y) as bigint) as p from scored)""",
        _BANDS,
    )
    out["fold_plan"] = _with(
        "scored",
        """select 5 as k_requested, count(*) as n_rows, cast(sum(y) as bigint) as n_pos,
           case when sum(y) >= 25 then 5 when sum(y) >= 20 then 4 when sum(y) >= 15 then 3 else 2 end as k_planned from scored""",
    )
    out["rank_bands"] = _with(
        "scored",
        """select fold, count(*) as n, min(lat) as lat_min, max(lat) as lat_max from (
             select lat, cast(ceil(row_number() over (order by lat, substr(md5(cast(event_id as varchar)),1,3), event_id)*5/
                    cast(count(*) over () as double))-1 as int) as fold from scored) group by fold""",
    )
    out["stratified_split"] = _with(
        "scored",
        """select event_id, case when rn <= ceil(0.2*n) then 'test' when rn <= ceil(0.2*n)+ceil(0.2*n) then 'val' else 'train' end as split
           from (select event_id, row_number() over (partition by y order by md5(cast(event_id as varchar)||'|42'), event_id) as rn,
                 count(*) over (partition by y) as n from scored)""",
    )
    out["seeded_order"] = _with(
        "scored",
        """select event_id, row_number() over (order by md5(cast(event_id as varchar)||'|42'), event_id) as place from scored""",
    )
    out["first_rows"] = _with("scored", "select event_id, p from scored order by event_id limit 500")
    out["hotspot_csv_roundtrip"] = _with(
        "arch",
        "select latitude, longitude, acq_date, confidence, count(*) as n from arch group by latitude, longitude, acq_date, confidence",
    )
    out["bounded_sample"] = _with(
        "scored",
        "select event_id, p from scored order by md5(cast(event_id as varchar)||'|0'), event_id limit 2000",
    )

    out["class_weight"] = _with(
        "scored",
        """select cast(sum(y) as bigint) as n_pos, cast(sum(1-y) as bigint) as n_neg,
           round(sum(1-y)/cast(sum(y) as double),6) as weight from scored""",
    )
    out["confusion_matrix"] = _with("scored", "select tn, fp, fn, tp from cm", _CONFUSION)
    out["threshold_metrics"] = _with(
        "scored",
        """select tn, fp, fn, tp, round(tp/cast(tp+fp as double),6) as precision, round(tp/cast(tp+fn as double),6) as recall,
           round(2*tp/cast(2*tp+fp+fn as double),6) as f1, round((tp+tn)/cast(tp+tn+fp+fn as double),6) as accuracy,
           tp+tn+fp+fn as n_samples from cm""",
        _CONFUSION,
    )
    out["roc_auc"] = _with(
        "scored",
        """select cast(max(all_pos) as bigint) as n_pos, cast(max(all_neg) as bigint) as n_neg,
           round(sum(neg*(tp-pos+pos/2))/(max(all_pos)*max(all_neg)),6) as roc_auc from ranked""",
        _BY_SCORE,
    )
    out["average_precision"] = _with(
        "scored",
        """select cast(max(all_pos) as bigint) as n_pos, cast(max(all_neg) as bigint) as n_neg,
           round(sum(pos/all_pos*tp/(tp+fp)),6) as average_precision from ranked""",
        _BY_SCORE,
    )
    quantiles = ", ".join(
        f"round(quantile_cont(o_totalprice, {q}),4) as {n}"
        for q, n in zip(
            [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], ["q0", "q01", "q25", "q50", "q75", "q99", "q1"]
        )
    )
    out["exact_quantiles"] = f"select {quantiles} from orders"
    out["cv_summary"] = _with(
        "scored",
        """select count(*) as cv_n_folds, round(avg(auc),6) as cv_roc_auc_mean, round(stddev_pop(auc),6) as cv_roc_auc_std,
           round(avg(ap),6) as cv_pr_auc_mean, round(stddev_pop(ap),6) as cv_pr_auc_std,
           round(avg(f1),6) as cv_f1_mean, round(stddev_pop(f1),6) as cv_f1_std
           from (select fold, sum(neg*(tp-pos+pos/2))/(max(all_pos)*max(all_neg)) as auc,
                 sum(pos/all_pos*tp/(tp+fp)) as ap,
                 2*sum(case when p>=0.5 then pos else 0 end)/(sum(case when p>=0.5 then pos+neg else 0 end)+max(all_pos)) as f1
                 from fr group by fold having max(all_pos) > 0 and max(all_neg) > 0)""",
        f"""{_BANDS}, fs as (select fold, p, cast(sum(y) as double) as pos, cast(sum(1-y) as double) as neg from banded group by fold, p),
        fr as (select *, sum(pos) over (partition by fold order by p desc) as tp, sum(neg) over (partition by fold order by p desc) as fp,
          sum(pos) over (partition by fold) as all_pos, sum(neg) over (partition by fold) as all_neg from fs)""",
    )
    ln = "case when {0} <= 0 then -100.0E0 else greatest(-100.0E0, ln(case when {0} <= 0 then 1 else {0} end)) end"
    out["weighted_logloss"] = _with(
        "scored",
        f"""select round(avg(-((select sum(1-y)/cast(sum(y) as double) from scored)*y*({ln.format('p')})
            + (1-y)*({ln.format('(1.0E0-p)')}))),6) as logloss, count(*) as n_samples from scored""",
    )
    out["score_parity"] = _with(
        "scored",
        """select count(*) as n_rows, count(*) filter (where abs(p-p_alt) > 1e-4 + 1e-3*abs(p_alt)) as n_violations,
           round(max(abs(p-p_alt)),6) as max_gap from scored""",
    )
    weights = ", ".join(f"('{k}', {v})" for k, v in views.ATTRIBUTION_WEIGHTS.items())
    out["attribution_rank"] = f"""select feature, round(avg(abs((((event_id*k)%101)-50)/100.0E0*k)),6) as mean_abs
        from events, (values {weights}) f(feature, k) group by feature"""

    out["placeholder_features"] = _with(
        "cells",
        f"""select cell_id, round(elevation_m,6) as elevation_m, round(slope_deg,6) as slope_deg,
            round(sin(radians(aspect)),6) as aspect_sin, round(cos(radians(aspect)),6) as aspect_cos, {_COVER_FLAGS},
            round(temp_c,6) as temp_c, round(rh_pct,6) as rh_pct, round(wind_speed_ms,6) as wind_speed_ms,
            round(sin(radians(heading)),6) as wind_dir_sin, round(cos(radians(heading)),6) as wind_dir_cos,
            round(vpd_kpa,6) as vpd_kpa, round(ffmc_approx,6) as ffmc_approx, firms_density_1yr,
            round(days_since_last_fire,6) as days_since_last_fire, round(road_dist_m,6) as road_dist_m,
            round(settlement_dist_m,6) as settlement_dist_m, picnic_area from filled""",
        _placeholder_base("cell_id", "cells"),
    )
    score = _SCORE.format(tree="(case when cover=0 then 1 else 0 end)", shrub="(case when cover=1 then 1 else 0 end)")
    out["quantile_label"] = _with(
        "cells",
        """select cell_id, case when score >= (select quantile_cont(score, 0.85) from scores) then 1 else 0 end as label from scores""",
        f"{_placeholder_base('cell_id', 'cells')}, scores as (select cell_id, {score} as score from filled)",
    )

    def first_tokens(column: str, tokens: str) -> str:
        return (
            f"case when len(list_filter(string_split_regex(coalesce({column},''), '\\r\\n|\\n|\\r'), "
            f"lambda x: string_split_regex(trim(x, ' \t'), '[ \\t]+')[1] in ({tokens}))) > 0 then 1 else 0 end"
        )

    out["annotation_label"] = _with(
        "images",
        f"""select image_id, case when trim(coalesce(annotations,'')) = '' then 0 else 1 end as any_box,
            {first_tokens('annotations', "'0','1'")} as class_line,
            {first_tokens('text', "'the','The','a','A'")} as text_line from images""",
    )
    flags = f"flags as (select stem, {first_tokens('content', chr(39) + '0' + chr(39) + ',' + chr(39) + '1' + chr(39))} as flag from label_files)"
    out["image_label_join"] = _with(
        "images label_files",
        """select i.image_id, i.stem, coalesce(f.flag, 0) as label
           from (select image_id, 'img_'||cast(image_id as varchar) as stem from images) i left join flags f on f.stem = i.stem""",
        flags,
    )
    out["image_catalogue"] = _with(
        "images label_files",
        """select source, split, label, count(*) as n from (
             select 'shard' as source, split, case when trim(coalesce(annotations,'')) = '' then 0 else 1 end as label from images
             union all
             select 'folder', i.split, coalesce(f.flag, 0) from images i left join flags f
               on f.stem = 'img_'||cast(i.image_id as varchar)) group by all""",
        flags,
    )
    out["image_folder_scan"] = _with(
        "images label_files",
        """select split, stem, label, n_bytes, case when split = 'val' then row_number() over (partition by split order by n_bytes is null desc, path) end as place
           from (select i.split, path, 'img_'||cast(image_id as varchar) as stem, coalesce(f.flag, 0) as label, null::bigint as n_bytes
                 from images i left join flags f on f.stem = 'img_'||cast(i.image_id as varchar)
                 union all
                 select split, path, 'img_'||cast(image_id as varchar), case when trim(coalesce(annotations,'')) = '' then 0 else 1 end, strlen(text) from images)""",
        flags,
    )
    out["hotspot_ingest"] = _with(
        "arch",
        """select * exclude (rn, lowest), cast(date_diff('day', lowest, acq_date) // 365 as int) as chunk
           from (select *, row_number() over (partition by latitude, longitude, acq_date order by chunk_seq, line_ref, frp, confidence) as rn,
             min(acq_date) over () as lowest from arch) where rn = 1""",
    )
    out["hotspot_stream"] = _with("arch", "select distinct latitude, longitude, acq_date from arch")
    return out

