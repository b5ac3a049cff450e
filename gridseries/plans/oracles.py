"""SQL that states the expected result of each registered query over the given tables."""

from __future__ import annotations

from gridseries.schemas import CONTINUOUS, FEATURES, PARAMETERS, TARGETS, TEMPERATURES


def r(expression: str, places: int = 6) -> str:
    return f"(round_even(({expression}) * 1e{places}, 0) / 1e{places} + 0.0::DOUBLE)"


def _list(*items: str) -> str:
    return ", ".join(items)


SERIES = """
select l_suppkey as location_id, date_trunc('month', l_shipdate) as time,
  avg(l_partkey % 300) as ALLSKY_SFC_SW_DWN, avg(round_even(l_discount * 100, 0)) as PRECTOTCORR,
  avg(l_linenumber) as QV2M, avg(round_even(l_tax * 100, 0)) * 10 as RH2M, avg(l_quantity) as T2M,
  max(l_quantity) as T2M_MAX, min(l_quantity) as T2M_MIN
from lineitem group by 1, 2
"""


def _lat(key: str) -> str:
    return f"((({key} * 37) % 181 - 90) * 0.99::DOUBLE + 0.004::DOUBLE)"


def _lon(key: str) -> str:
    return f"((({key} * 73) % 361 - 180) * 0.99::DOUBLE)"


LOCATIONS = f"""
select s_suppkey as location_id, {_lat('s_suppkey')} as latitude, {_lon('s_suppkey')} as longitude,
  'global' as grid_type, s_name as description from supplier
"""

REQUESTS = f"""
select c_custkey as request_id, {_lat('c_custkey')} as latitude, {_lon('c_custkey')} as longitude,
  (2025 + c_custkey % 5)::INTEGER as year, (c_custkey % 12 + 1)::INTEGER as month,
  (1 + c_custkey % 3)::INTEGER as months from customer
"""

UNIQUE_DIRTY = """
select event_id, user_id as location_id, ts as time,
  case when event_id % 7 = 0 then null when event_id % 101 = 0 then 'Infinity'::DOUBLE
       when event_id % 103 = 0 then '-Infinity'::DOUBLE else value end as T2M,
  case when event_id % 11 in (0, 1) then null else value * 2 end as RH2M,
  value as PRECTOTCORR,
  case when event_id % 13 = 0 then null else concat(' ', upper(event_type), ' ') end as season
from events
"""

DIRTY = "select * from unique_dirty union all select * from unique_dirty where event_id % 50 = 0"

NORMALS = f"""
select {r('latitude', 2)} as lat_rounded, {r('longitude', 2)} as lon_rounded, month(time)::INTEGER as month,
  avg(T2M) as baseline_temp, avg(PRECTOTCORR) as baseline_precip,
  arg_min(latitude, time) as latitude, arg_min(longitude, time) as longitude
from series join (select location_id, latitude, longitude from locations) using (location_id) group by 1, 2, 3
"""

TEXTS = "select event_id, lower(trim(season)) as season from unique_dirty"

_VIEWS = {
    "series": SERIES, "locations": LOCATIONS, "requests": REQUESTS, "unique_dirty": UNIQUE_DIRTY, "dirty": DIRTY,
    "normals": NORMALS, "texts": TEXTS,
}


def _with(views: str, body: str) -> str:
    """Prefix the named views; materialized, so that each is computed once."""
    names = views.split()
    parts = [f"{n} as materialized ({_VIEWS[n]})" for n in names]
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


_SQL: dict[str, str] = {}


def _add(name: str, views: str, body: str) -> None:
    _SQL[name] = _with(views, body) if views else body


# Grids, manifests, responses

_SNAP = ("select round_even((latitude - ({south})) / {step}, 0) * {step} + ({south}) as latitude, "
         "round_even((longitude - ({west})) / {step}, 0) * {step} + ({west}) as longitude, count(*) as places "
         "from locations group by 1, 2")

_add("grid_global", "locations", f"""
with snapped as ({_SNAP.format(south='-90', west='-180', step=10)}),
cells as (select a.i * 37 + b.j as location_id, (-90 + a.i * 10) as lat, (-180 + b.j * 10) as lon
          from range(19) a(i), range(37) b(j))
select location_id, lat::DOUBLE as latitude, lon::DOUBLE as longitude, 'global' as grid_type,
  'Global_' || lat || '_' || lon as description, coalesce(places, 0) as places
from cells left join snapped on snapped.latitude = lat and snapped.longitude = lon
""")

_add("grid_regional", "locations", """
with box as (select floor(min(latitude))::BIGINT as south, ceil(max(latitude))::BIGINT as north,
                    floor(min(longitude))::BIGINT as west, ceil(max(longitude))::BIGINT as east from locations),
size as (select *, ceil((north + 5 - south) / 5.0)::BIGINT as nlat, ceil((east + 5 - west) / 5.0)::BIGINT as nlon
         from box),
snapped as (select round_even((latitude - south) / 5, 0) * 5 + south as latitude,
                   round_even((longitude - west) / 5, 0) * 5 + west as longitude, count(*) as places
            from locations, box group by 1, 2),
cells as (select i.i * nlon + j.j as location_id, south + i.i * 5 as lat, west + j.j * 5 as lon
          from size, range(200) i(i), range(200) j(j) where i.i < nlat and j.j < nlon)
select location_id, lat::DOUBLE as latitude, lon::DOUBLE as longitude, 'regional' as grid_type,
  'Regional_' || lat || '_' || lon as description, coalesce(places, 0) as places
from cells left join snapped on snapped.latitude = lat and snapped.longitude = lon
""")

_add("grid_india", "locations", f"""
with snapped as ({_SNAP.format(south='8', west='68', step=2)}),
cells as (select a.i * 16 + b.j as location_id, 8 + a.i * 2 as lat, 68 + b.j * 2 as lon
          from range(16) a(i), range(16) b(j))
select location_id, lat::DOUBLE as latitude, lon::DOUBLE as longitude, 'regional' as grid_type,
  'Regional_' || lat || '_' || lon as description, coalesce(places, 0) as places
from cells left join snapped on snapped.latitude = lat and snapped.longitude = lon
""")

_add("first_locations", "locations", "select * from locations order by location_id limit 3")

_HOST = "https://power.larc.nasa.gov"

_add("manifest_monthly", "locations", f"""
select location_id, latitude, longitude,
  '{_HOST}/api/temporal/monthly/point?parameters=T2M,T2M_MAX,T2M_MIN,PRECTOTCORR,ALLSKY_SFC_SW_DWN,RH2M,QV2M'
  || '&community=SB&longitude=' || longitude || '&latitude=' || latitude
  || '&format=JSON&start=2010&end=2024' as url,
  'temporal_monthly_' || location_id || '_2010_2024.json' as file_name
from locations
""")

_add("manifest_climatology", "locations", f"""
select location_id, latitude, longitude,
  '{_HOST}/api/temporal/monthly/climatology/point?parameters=T2M,T2M_MAX&community=SB&longitude=' || longitude
  || '&latitude=' || latitude || '&format=JSON&start=2010&end=2024' as url
from locations
""")

_add("manifest_indicators", "locations", f"""
select location_id, latitude, longitude,
  '{_HOST}/api/application/indicators/point?longitude=' || longitude || '&latitude=' || latitude
  || '&start=2001&end=2016&format=JSON' as url
from locations
""")

_add("manifest_window", "requests", f"""
select request_id, latitude, longitude, (12 + request_id % 49)::INTEGER as months_back,
  '{_HOST}/api/temporal/monthly/point?parameters=T2M,T2M_MAX,T2M_MIN,PRECTOTCORR,RH2M,ALLSKY_SFC_SW_DWN'
  || '&community=RE&longitude=' || longitude || '&latitude=' || latitude || '&start='
  || strftime(date '2024-12-15' - ((12 + request_id % 49) * 30)::INTEGER, '%Y%m')
  || '&end=202412&format=JSON' as url
from requests
""")

_add("json_unpivot", "series", "select * from series")

_add("json_climatology", "series", f"""
select location_id, year(time)::VARCHAR as request, strftime(time, '%Y%m') as period,
  {_list(*[f"{r(p)} as {p}" for p in PARAMETERS])} from series
union all
select location_id, year(time)::VARCHAR, year(time) || '13', {_list(*[r(f"avg({p})") for p in PARAMETERS])}
from series group by location_id, year(time)
""")

_add("json_window", "series locations", """
select location_id, year(time)::VARCHAR as request, T2M, T2M_MAX, T2M_MIN, PRECTOTCORR, RH2M, ALLSKY_SFC_SW_DWN,
  time as date, year(time)::INTEGER as year, month(time)::INTEGER as month, latitude, longitude
from series left join (select location_id, latitude, longitude from locations) using (location_id)
""")

_add("failed_locations", "series requests", """
select request_id as location_id, latitude, longitude, year, month, months from requests
where request_id not in (select location_id from series where T2M_MAX < 50)
""")

_add("union_by_name", "series", f"""
select location_id, time, {_list(*[p for p in PARAMETERS if p != 'QV2M'])}, null::DOUBLE as QV2M
from series where year(time) between 1995 and 1998
union all
select location_id, time, {_list(*['T2M' if p == 'T2M' else f'null::DOUBLE as {p}'
                                   for p in PARAMETERS if p != 'QV2M'])}, QV2M
from series where year(time) >= 1999
""")

_add("csv_roundtrip", "unique_dirty", "select * from unique_dirty")

# Features

_add("location_join", "series locations", """
select series.*, grid_type, description from series left join locations using (location_id)
""")

_CLIM = _list(*[f"avg({p}) as {p}_baseline" for p in TEMPERATURES])
_CLIMATOLOGY = (f"select location_id, month(time)::INTEGER as month, {_CLIM} from series "
                "where year(time) between 1995 and 1998 group by 1, 2")

_add("climatology", "series", f"""
select location_id, month, {_list(*[f"{r(f'{p}_baseline')} as {p}_baseline" for p in TEMPERATURES])}
from ({_CLIMATOLOGY})
""")

_add("anomaly", "series", f"""
with c as ({_CLIMATOLOGY})
select s.location_id, s.time, {_list(*[f"{r(f's.{p} - c.{p}_baseline')} as {p}_anom" for p in TEMPERATURES])}
from series s left join c on c.location_id = s.location_id and c.month = month(s.time)
""")

_LAGS = _list(*[f"lag({c}, {n}) over w as {c}_lag{n}" for c in ("T2M", "PRECTOTCORR", "RH2M") for n in (1, 3, 6, 12)])
_LAG_SQL = f"select *, {_LAGS} from series window w as (partition by location_id order by time)"
_add("lags", "series", _LAG_SQL)
_add("lags_cut", "series", _LAG_SQL)
_add("lags_complete", "series", f"select * from ({_LAG_SQL}) where T2M_lag12 is not null")

_SEASON = ("case when month(time) in (12, 1, 2) then 'winter' when month(time) in (3, 4, 5) then 'spring' "
           "when month(time) in (6, 7, 8) then 'summer' else 'fall' end")

_DERIVED = (f"{r('T2M_MAX - T2M_MIN')} as T2M_range, {r('T2M + 0.1::DOUBLE * RH2M')} as heat_index, "
            f"{r('ln(1 + PRECTOTCORR)')} as precip_log, month(time)::INTEGER as month, {_SEASON} as season, "
            "year(time)::INTEGER as year")

_add("derived", "series", f"select *, {_DERIVED} from series")


def _flags(season: str) -> str:
    return _list(*[f"(lower({season}) = '{n.lower()}')::INTEGER as season_{n}"
                   for n in ("Fall", "Spring", "Summer", "Winter")])


_add("calendar_scoring", "series", f"""
select location_id, time, {r('T2M + 0.5::DOUBLE * RH2M / 100')} as heat_index,
  {r('sin(2 * pi() * month(time) / 12)')} as month_sin, {r('cos(2 * pi() * month(time) / 12)')} as month_cos,
  {r('(year(time) - 1995) / 6.0::DOUBLE')} as year_norm, {_flags(_SEASON)}
from series
""")

_QUARTER = ("case when month(time) <= 3 then 'Winter' when month(time) <= 6 then 'Spring' "
            "when month(time) <= 9 then 'Summer' else 'Fall' end")
_add("season_quarter", "series", f"""
select location_id, time, {_QUARTER} as quarter_season, {_flags(_QUARTER)} from series
""")

_DEVIATION = ("select *, T2M - avg(T2M) over p as T2M_anom, PRECTOTCORR - avg(PRECTOTCORR) over p as PRECTOTCORR_anom "
              "from series window p as (partition by location_id)")

_add("window_anomaly", "series", f"""
select location_id, time, {_list(*[f"{r(t)} as {t}" for t in TARGETS])} from ({_DEVIATION})
""")

_add("year_norm", "series", f"""
select location_id, time, {r('(y - min(y) over p) / (max(y) over p - min(y) over p + 1e-8)')} as year_norm
from (select *, year(time) as y from series) window p as (partition by location_id)
""")

_add("transformed", "series", f"""
with m as (select avg(T2M) as a, stddev_pop(T2M) as b, avg(RH2M) as c, stddev_pop(RH2M) as d from series)
select location_id, time, {_list(*[
    (r(f"({p} - {'a' if p == 'T2M' else 'c'}) / {'b' if p == 'T2M' else 'd'}") if p in ("T2M", "RH2M") else r(p))
    + f" as {p}_transformed" for p in CONTINUOUS])}
from series, m
""")

_add("master_table", "series locations", f"""
with c as ({_CLIMATOLOGY}),
lagged as (select *, {_LAGS} from series window w as (partition by location_id order by time)),
joined as (
  select lagged.*, grid_type, description,
    {_list(*[f"{r(f'lagged.{p} - c.{p}_baseline')} as {p}_anom" for p in TEMPERATURES])}
  from lagged left join locations using (location_id)
  left join c on c.location_id = lagged.location_id and c.month = month(lagged.time))
select *, {_DERIVED} from joined
where T2M_lag12 is not null and T2M_anom is not null and grid_type is not null
""")

# Baselines

_add("baselines", "series locations normals", f"""
select * replace ({r('baseline_temp')} as baseline_temp, {r('baseline_precip')} as baseline_precip) from normals
""")

_add("baselines_landed", "series locations normals", f"""
select * replace ({r('baseline_temp')} as baseline_temp, {r('baseline_precip')} as baseline_precip) from normals
""")

_add("baseline_keys", "series locations normals", f"""
select printf('%.2f,%.2f,%d', lat_rounded, lon_rounded, month) as key, {r('baseline_temp')} as temperature,
  {r('baseline_precip')} as precipitation, latitude, longitude from normals
""")

_add("baseline_stats", "series locations normals", f"""
select {_list(*[f"{r(f'{f}(baseline_{n})')} as {n}_{label}"
                for n in ("temp", "precip") for f, label in (("min", "min"), ("max", "max"), ("avg", "mean"))])},
  count(*) as normals, count(distinct (lat_rounded, lon_rounded)) as places from normals
""")

_add("baseline_by_month", "series locations normals", f"""
select month, {r('avg(baseline_temp)')} as baseline_temp, {r('avg(baseline_precip)')} as baseline_precip
from normals group by month
""")

_EXACT = f"""
select q.*, n.baseline_temp, n.baseline_precip, n.month is not null as hit
from {{source}} q left join normals n on n.lat_rounded = {r('q.latitude', 2)} and n.lon_rounded = {r('q.longitude', 2)}
  and n.month = q.month
"""

_NEAREST = """
select * from (
  select q.*, n.lat_rounded as nearest_lat, n.lon_rounded as nearest_lon,
    sqrt((q.latitude - n.lat_rounded) * (q.latitude - n.lat_rounded)
         + (q.longitude - n.lon_rounded) * (q.longitude - n.lon_rounded)) as distance,
    n.baseline_temp, n.baseline_precip
  from {source} q join normals n on n.month = q.month)
qualify row_number() over (partition by request_id, year, month order by distance, nearest_lat, nearest_lon) = 1
"""

_add("baseline_exact", "series locations normals requests", f"""
select request_id, latitude, longitude, year, month, months, {r('baseline_temp')} as baseline_temp,
  {r('baseline_precip')} as baseline_precip from ({_EXACT.format(source='requests')})
""")

_add("baseline_nearest", "series locations normals requests", f"""
select * replace ({r('baseline_temp')} as baseline_temp, {r('baseline_precip')} as baseline_precip,
  {r('distance')} as distance) from ({_NEAREST.format(source='requests')})
""")

_MONTHS = """
expanded as (
  select request_id, latitude, longitude, year(d)::INTEGER as year, month(d)::INTEGER as month from (
    select *, make_date(year, month, 1) + to_months(step::INTEGER) as d
    from requests, range(3) steps(step) where step < months))
"""

_add("baseline_lookup", "series locations normals requests", f"""
with {_MONTHS}, exact as ({_EXACT.format(source='expanded')}),
missed as (select request_id, latitude, longitude, year, month from exact where not hit),
near as ({_NEAREST.format(source='missed')})
select request_id, latitude, longitude, year, month, {r('baseline_temp')} as baseline_temp,
  {r('baseline_precip')} as baseline_precip, 0.0::DOUBLE as distance, 'exact' as matched from exact where hit
union all
select request_id, latitude, longitude, year, month, {r('baseline_temp')}, {r('baseline_precip')}, {r('distance')},
  'nearest' from near
""")

# Quality

_DIRTY_COLUMNS = ["event_id", "location_id", "time", "T2M", "RH2M", "PRECTOTCORR", "season"]
_NULLS = " union all ".join(
    f"select {i} as position, '{c}' as \"column\", count(*) - count({c}) as count, "
    f"(count(*) - count({c})) / count(*)::DOUBLE * 100 as percent from dirty"
    for i, c in enumerate(_DIRTY_COLUMNS))

_add("null_profile", "unique_dirty dirty", f"""
select "column", count, {r('percent')} as percent from ({_NULLS}) where count > 0
""")

_add("top_missing", "unique_dirty dirty", f"""
select "column", count, {r('percent')} as percent from ({_NULLS}) where count > 0
order by percent desc, position limit 2
""")

_add("inf_profile", "unique_dirty dirty", " union all ".join(
    f"select '{c}' as \"column\", count(*) as count from dirty where isinf({c}) having count(*) > 0"
    for c in ("T2M", "RH2M", "PRECTOTCORR")))

_add("column_table", "unique_dirty dirty", " union all ".join(
    f"select {i}::INTEGER as position, '{c}' as column, '{kind}' as type, count(*) as rows, count({c}) as known from dirty"
    for i, (c, kind) in enumerate([
        ("event_id", "bigint"), ("location_id", "bigint"), ("time", "timestamp"), ("T2M", "double"), ("RH2M", "double"),
        ("PRECTOTCORR", "double"), ("season", "string")])))

_add("dup_profile", "unique_dirty dirty", f"""
select (n - d) as count, {r('(n - d) / n::DOUBLE * 100')} as percent
from (select (select count(*) from dirty) as n, (select count(*) from (select distinct * from dirty)) as d)
""")

_add("dataset_summary", "series", """
select count(*) as rows, count(distinct location_id) as locations, min(time) as first_time, max(time) as last_time,
  9::INTEGER as columns from series
""")

_DESCRIBE = " union all ".join(
    f"select '{c}' as \"column\", count({c}) as count, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std, "
    f"{r(f'min({c})')} as min, {r(f'quantile_cont({c}, 0.25)')} as p25, {r(f'quantile_cont({c}, 0.5)')} as p50, "
    f"{r(f'quantile_cont({c}, 0.75)')} as p75, {r(f'max({c})')} as max from series" for c in PARAMETERS)
_add("describe", "series", _DESCRIBE)
_add("describe_selected", "series", _DESCRIBE)

_add("describe_times", "unique_dirty", """
select 'time' as "column", count(time) as count, make_timestamp((sum(epoch_us(time)::HUGEINT) // count(time))::BIGINT) as mean,
  min(time) as min,
  make_timestamp(quantile_cont(epoch_us(time)::DOUBLE, 0.25)::BIGINT) as p25,
  make_timestamp(quantile_cont(epoch_us(time)::DOUBLE, 0.5)::BIGINT) as p50,
  make_timestamp(quantile_cont(epoch_us(time)::DOUBLE, 0.75)::BIGINT) as p75, max(time) as max
from unique_dirty
""")

_add("validate", "unique_dirty dirty", f"""
with t as (
  select count(*) as total_rows,
    sum({' + '.join(f'({c} is null)::INTEGER' for c in _DIRTY_COLUMNS)}) as missing_values,
    count(*) filter (isinf(T2M)) + count(*) filter (isinf(RH2M)) + count(*) filter (isinf(PRECTOTCORR))
      as infinite_values from dirty),
u as (select count(*) as distinct_rows from (select distinct * from dirty))
select total_rows, missing_values::BIGINT as missing_values, total_rows - distinct_rows as duplicate_rows,
  infinite_values, 7::INTEGER as total_columns, 5::INTEGER as numeric_columns, 1::INTEGER as categorical_columns,
  (missing_values = 0 and infinite_values = 0) as passed from t, u
""")

# Missing values

_GAPS = ("gaps as (select location_id, time, case when month(time) % 5 <> 0 then T2M end as T2M, "
         "case when month(time) % 3 <> 0 then RH2M end as RH2M from series)")
_add("fill_mean", "series", f"""
with {_GAPS}, m as (select avg(T2M) as a, avg(RH2M) as b from gaps)
select location_id, time, {r('coalesce(T2M, a)')} as T2M, {r('coalesce(RH2M, b)')} as RH2M from gaps, m
""")

_add("fill_median", "unique_dirty", f"""
with m as (select quantile_cont(T2M, 0.5) as a, quantile_cont(RH2M, 0.5) as b from unique_dirty)
select * exclude (a, b) replace (coalesce(T2M, a) as T2M, {r('coalesce(RH2M, b)')} as RH2M) from unique_dirty, m
""")


def _mode(column: str, source: str = "unique_dirty") -> str:
    return (f"(select {column} from {source} where {column} is not null group by {column} "
            f"order by count(*) desc, {column} limit 1)")


_add("fill_mode", "unique_dirty", f"""
select * replace (coalesce(T2M, {_mode('T2M')}) as T2M, coalesce(RH2M, {_mode('RH2M')}) as RH2M,
  coalesce(season, {_mode('season')}) as season) from unique_dirty
""")

_add("fill_ffill", "unique_dirty", f"""
select event_id, location_id, time, {_list(*[f"last_value({c} ignore nulls) over w as {c}" for c in ("T2M", "RH2M")])},
  PRECTOTCORR, last_value(season ignore nulls) over w as season
from unique_dirty window w as (order by event_id rows between unbounded preceding and current row)
""")


def _interpolated(source: str, columns: list[str], partition: str, order: str) -> str:
    """CTEs ``numbered``, ``sided`` and ``interpolated``."""
    part = f"partition by {partition}" if partition else ""
    sides, values = [], []
    for c in columns:
        for side, function, frame in (("p", "last_value", "up"), ("q", "first_value", "down")):
            sides.append(f"{function}(case when {c} is not null then rn end ignore nulls) over {frame} as {c}_{side}n")
            sides.append(f"{function}({c} ignore nulls) over {frame} as {c}_{side}y")
        slope = f"(({c}_qy - {c}_py) / ({c}_qn - {c}_pn))"
        left = f"{slope} * (rn - {c}_pn) + {c}_py"
        right = f"{slope} * (rn - {c}_qn) + {c}_qy"
        values.append(
            f"case when {c} is not null then {c} "
            f"when {c}_pn is not null and {c}_qn is not null then "
            f"case when not isnan({left}) then {left} when not isnan({right}) then {right} "
            f"when {c}_py = {c}_qy then {c}_py end "
            f"else coalesce({c}_py, {c}_qy) end as {c}")
    return f"""
numbered as (select *, row_number() over ({part} order by {order}) as rn from {source}),
sided as (select *, {_list(*sides)} from numbered
  window up as ({part} order by rn rows between unbounded preceding and current row),
         down as ({part} order by rn rows between current row and unbounded following)),
interpolated as (select * replace ({_list(*values)}) from sided)
"""


_PLAIN = "event_id, location_id, time, {t} as T2M, {h} as RH2M, PRECTOTCORR, season"
_add("fill_interp_all", "unique_dirty", f"""
with {_interpolated('unique_dirty', ['T2M', 'RH2M'], '', 'event_id')}
select {_PLAIN.format(t=r('T2M'), h=r('RH2M'))} from interpolated
""")

_GROUPED = f"""
with {_interpolated('unique_dirty', ['T2M', 'RH2M'], 'location_id', 'time, event_id')}
select {_PLAIN.format(t=r('T2M'), h=r('RH2M'))} from interpolated
"""
_add("fill_interp_group", "unique_dirty", _GROUPED)
_add("fill_interp_cut", "unique_dirty", _GROUPED)

_add("fill_drop", "unique_dirty", """
select * from unique_dirty where T2M is not null and RH2M is not null and season is not null
""")


def _smart(source: str) -> str:
    """CTEs up to ``smart``: interpolation, medians for what is left, running text, mode."""
    return f"""
{_interpolated(source, ['T2M', 'RH2M'], 'location_id', 'time, event_id')},
medians as (select quantile_cont(T2M, 0.5) as mt, quantile_cont(RH2M, 0.5) as mh from interpolated),
smart as (
  select event_id, location_id, time, coalesce(T2M, mt) as T2M, coalesce(RH2M, mh) as RH2M, PRECTOTCORR,
    coalesce(last_value(season ignore nulls) over (order by location_id, time, event_id
      rows between unbounded preceding and current row), {_mode('season', source)}) as season
  from interpolated, medians)
"""


_add("fill_smart", "unique_dirty", f"""
with {_smart('unique_dirty')}
select * replace ({r('T2M')} as T2M, {r('RH2M')} as RH2M) from smart
""")

# Infinities, duplicates, format

_add("inf_replace", "unique_dirty dirty", f"""
with c as (select * replace (case when not isinf(T2M) then T2M end as T2M) from dirty),
m as (select quantile_cont(T2M, 0.5) as a from c)
select * exclude (a) replace ({r('coalesce(T2M, a)')} as T2M) from c, m
""")

_add("inf_drop", "unique_dirty dirty", """
select * from dirty where T2M is not null and not isinf(T2M) and RH2M is not null and season is not null
""")

_add("inf_clip", "unique_dirty dirty", """
with m as (select min(T2M) as a, max(T2M) as b from dirty where not isinf(T2M))
select * exclude (a, b) replace (case when T2M is not null then least(greatest(T2M, a), b) end as T2M) from dirty, m
""")

_add("dedup_all", "unique_dirty dirty", "select distinct * from dirty")
for _name, _way in (("dedup_first", ""), ("dedup_last", " desc")):
    _add(_name, "unique_dirty dirty", f"""
    select * from dirty
    qualify row_number() over (partition by location_id, season order by time{_way}, event_id{_way}) = 1
    """)
_add("dedup_none", "unique_dirty dirty", f"""
select {_list(*_DIRTY_COLUMNS)} from dirty group by all having count(*) = 1
""")

_add("standardize", "unique_dirty", f"""
select event_id, location_id, time, {r('T2M / 7', 4)} as T2M, {r('RH2M / 3', 4)} as RH2M,
  {r('PRECTOTCORR', 4)} as PRECTOTCORR, lower(trim(season)) as season from unique_dirty
""")

# Outliers


def _bounds(columns: list[str], threshold: float, source: str = "unique_dirty") -> str:
    quarters = _list(*[
        f"quantile_cont({c}, 0.25) as {c}_a, quantile_cont({c}, 0.75) as {c}_b" for c in columns])
    ends = _list(*[
        f"{c}_a - {threshold} * ({c}_b - {c}_a) as {c}_low, {c}_b + {threshold} * ({c}_b - {c}_a) as {c}_high"
        for c in columns])
    return f"bounds as (select {ends} from (select {quarters} from {source}))"


_CHECKED = ["RH2M", "PRECTOTCORR"]
_BEYOND = "({c} < {c}_low or {c} > {c}_high)"

_FOUND = " union all ".join(
    f"select '{c}' as \"column\", count(*) filter ({_BEYOND.format(c=c)}) as count, "
    f"{r(f'count(*) filter ({_BEYOND.format(c=c)}) / count(*)::DOUBLE * 100')} as percent, "
    f"{r(f'any_value({c}_low)')} as lower_bound, {r(f'any_value({c}_high)')} as upper_bound "
    "from unique_dirty, bounds" for c in _CHECKED)

_add("outlier_iqr", "unique_dirty", f"with {_bounds(_CHECKED, 1.5)} select * from ({_FOUND}) where count > 0")

_add("top_outliers", "unique_dirty", f"""
with {_bounds(_CHECKED, 1.5)} select "column", count from ({_FOUND}) where count > 0
order by count desc, "column" limit 1
""")

_add("outlier_z", "unique_dirty", "with m as (select " + _list(*[
    f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in _CHECKED]) + " from unique_dirty) " + " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (abs({c} - {c}_m) / {c}_s > 3.0) as count, "
    f"{r(f'count(*) filter (abs({c} - {c}_m) / {c}_s > 3.0) / count(*)::DOUBLE * 100')} as percent "
    f"from unique_dirty, m having count(*) filter (abs({c} - {c}_m) / {c}_s > 3.0) > 0" for c in _CHECKED))

_add("outlier_flags", "unique_dirty", f"""
with {_bounds(_CHECKED, 1.5)}
select event_id, {_list(*_CHECKED)},
  {_list(*[f"coalesce({_BEYOND.format(c=c)}, false) as {c}_outlier" for c in _CHECKED])} from unique_dirty, bounds
""")

_CLIPPED = "case when {c} is not null then least(greatest({c}, {c}_low), {c}_high) end"
_add("treat_clip", "unique_dirty", f"""
with {_bounds(_CHECKED, 3.0)}
select event_id, {_list(*[f"{r(_CLIPPED.format(c=c))} as {c}" for c in _CHECKED])} from unique_dirty, bounds
""")

_add("treat_remove", "unique_dirty", f"""
with {_bounds(_CHECKED, 3.0)}
select event_id, {_list(*_CHECKED)} from unique_dirty, bounds
where {' and '.join(f'{c} between {c}_low and {c}_high' for c in _CHECKED)}
""")

_add("treat_winsorize", "unique_dirty", "with " + ", ".join(
    f"{c}_sorted as (select {c}, row_number() over (order by {c}) - 1 as k, count(*) over () as n "
    f"from unique_dirty where {c} is not null), "
    f"{c}_ends as (select max({c}) filter (k = (0.05::DOUBLE * n)::BIGINT - "
    f"((0.05::DOUBLE * n)::BIGINT > 0.05::DOUBLE * n)::BIGINT) as {c}_low, "
    f"max({c}) filter (k = n - 1 - ((0.05::DOUBLE * n)::BIGINT - "
    f"((0.05::DOUBLE * n)::BIGINT > 0.05::DOUBLE * n)::BIGINT)) as {c}_high from {c}_sorted)" for c in _CHECKED)
    + f" select event_id, {_list(*[_CLIPPED.format(c=c) + f' as {c}' for c in _CHECKED])} from unique_dirty, "
    + ", ".join(f"{c}_ends" for c in _CHECKED))

_add("treat_log", "unique_dirty", f"""
select event_id, RH2M, PRECTOTCORR, {r('ln(1 + PRECTOTCORR)')} as PRECTOTCORR_log from unique_dirty
""")

# Scaling, encoding, the whole cleaning run


def _scale(centers: str, scales: str, fit: str = "series") -> str:
    stats = _list(*[f"{centers.format(c=c)} as {c}_c, {scales.format(c=c)} as {c}_s" for c in PARAMETERS])
    shown = _list(*[f"{r(f'({c} - {c}_c) / case when {c}_s = 0 then 1 else {c}_s end')} as {c}" for c in PARAMETERS])
    return f"with m as (select {stats} from {fit}) select location_id, time, {shown} from series, m"


_add("scale_standard", "series", _scale("avg({c})", "stddev_pop({c})"))
_add("scale_minmax", "series", _scale("min({c})", "max({c}) - min({c})"))
_add("scale_robust", "series", _scale(
    "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
_add("scale_apply", "series", _scale(
    "avg({c})", "stddev_pop({c})", "series where year(time) between 1995 and 1998"))

_CATEGORIES = ("click", "error", "purchase", "signup", "view")


def _onehot(where: str) -> str:
    return f"""
    with kept as (select season from texts where season is not null group by 1 order by 1 offset 1)
    select event_id, {_list(*[
        f"coalesce((season = '{v}')::INTEGER, 0) as season_{v}" for v in _CATEGORIES[1:]])} from texts {where}
    """


_add("onehot", "unique_dirty texts", _onehot(""))
_add("onehot_apply", "unique_dirty texts", _onehot("where season <> 'click'"))

_CODE = "case when {c} is not null then dense_rank() over (order by {c} nulls last) - 1 end"
_add("label_encode", "unique_dirty texts", f"select event_id, {_CODE.format(c='season')} as season from texts")
_add("label_encode_many", "", f"""
select c_custkey, {_CODE.format(c='c_name')} as c_name, {_CODE.format(c='c_mktsegment')} as c_mktsegment from customer
""")

_SCALED = ["event_id", "T2M", "RH2M", "PRECTOTCORR", "season"]
_CLEANED = f"""
{_smart('dirty')},
cleared as (select * replace (case when not isinf(T2M) then T2M end as T2M) from smart),
center as (select quantile_cont(T2M, 0.5) as m from cleared),
filled as (select * exclude (m) replace (coalesce(T2M, m) as T2M) from cleared, center),
uniform as (
  select event_id, location_id, time, {r('T2M', 4)} as T2M, {r('RH2M', 4)} as RH2M,
    {r('PRECTOTCORR', 4)} as PRECTOTCORR, lower(trim(season)) as season from (select distinct * from filled)),
{_bounds(['T2M', 'RH2M', 'PRECTOTCORR'], 3.0, 'uniform')},
treated as (
  select event_id, location_id, time,
    {_list(*[_CLIPPED.format(c=c) + f' as {c}' for c in ('T2M', 'RH2M', 'PRECTOTCORR')])},
    dense_rank() over (order by season) - 1 as season from uniform, bounds),
untreated as (select event_id, location_id, time, T2M, RH2M, PRECTOTCORR,
    dense_rank() over (order by season) - 1 as season from uniform),
stats as (select {_list(*[f"avg({c}) as {c}_c, stddev_pop({c}) as {c}_s" for c in _SCALED])} from treated)
"""
_SCALES = _list(*[f"{r(f'({c} - {c}_c) / {c}_s')} as {c}" for c in _SCALED])

_add("clean_all", "unique_dirty dirty", f"with {_CLEANED} select location_id, time, {_SCALES} from treated, stats")
_add("clean_apply", "unique_dirty dirty", f"with {_CLEANED} select location_id, time, {_SCALES} from untreated, stats")
_add("clean_report", "unique_dirty dirty", f"""
with {_CLEANED},
scaled as (select location_id, time, {_list(*[f"({c} - {c}_c) / {c}_s as {c}" for c in _SCALED])} from treated, stats),
gaps as ({' union all '.join(f"select 'missing' as section, '{c}' as item, count(*) filter ({c} is null) as value from dirty"
                             for c in ('T2M', 'RH2M', 'PRECTOTCORR', 'season'))}),
rows as (
  select * from gaps where value > 0
  union all select 'infinite', 'T2M', count(*) filter (isinf(T2M)) from dirty
  union all select 'duplicates', 'all', count(*) - (select count(*) from (select distinct * from dirty)) from dirty
  union all select 'validation', 'total_rows', count(*) from scaled
  union all select 'validation', 'total_columns', 7
  union all select 'validation', 'missing_values', {' + '.join(f'count(*) filter ({c} is null)' for c in _SCALED)} from scaled
  union all select 'validation', 'duplicate_rows', count(*) - (select count(*) from (select distinct * from scaled)) from scaled
  union all select 'validation', 'infinite_values', 0
  union all select 'validation', 'passed', case when {' + '.join(f'count(*) filter ({c} is null)' for c in _SCALED)} = 0
    then 1 else 0 end from scaled),
spread as ({' union all '.join(f"select 'deviation' as section, '{c}' as item, stddev_samp({c}) as value from scaled"
                               for c in _SCALED)})
select section, item, {r('value::DOUBLE')} as value from rows union all select section, item, {r('value')} from spread
""")

# Scenarios

_add("range_check", "requests", """
select request_id, reason is null as valid, reason from (
  select request_id, case
    when not latitude * 1.2::DOUBLE between -90 and 90 then 'latitude must be between -90 and 90'
    when not longitude * 1.05::DOUBLE between -180 and 180 then 'longitude must be between -180 and 180'
    when request_id % 17 = 0 then 'month must be between 1 and 12'
    when not (10 + request_id % 60) between 12 and 60 then 'months_back must be between 12 and 60' end as reason
  from requests)
""")

_add("scenario_months", "requests", f"with {_MONTHS} select request_id, year, month from expanded")


def _estimated(source: str) -> str:
    """CTEs ``zoned`` and ``estimated`` from a source with baseline_temp, baseline_precip and hit."""
    wave = "sin(2 * pi() * ({m} - 1) / 12 - pi() / 2)"
    peak = "sin(2 * pi() * (em - 6) / 12)"
    return f"""
shifted as (select *, case when latitude >= 0 then month else (month + 5) % 12 + 1 end as em,
  abs(latitude) as size from {source}),
zoned as (
  select *, {wave.format(m='em')} as ewave, case when hit then {wave.format(m='month')}
    else {wave.format(m='em')} end as swave,
    case when size < 23.5 then 27.0 when size < 35 then 22.0 when size < 50 then 15.0 when size < 60 then 8.0
      else -5.0 end::DOUBLE as ztemp,
    case when size < 23.5 then 3.0 when size < 35 then 10.0 when size < 50 then 15.0 when size < 60 then 20.0
      else 25.0 end::DOUBLE as zspan,
    case when size < 10 then 200.0::DOUBLE
      when size < 30 then 100 * (0.5::DOUBLE + 1.5::DOUBLE * greatest(0.0::DOUBLE, {peak}))
      when size < 50 then 60 * (0.8::DOUBLE + 0.4::DOUBLE * {peak}) else 40.0::DOUBLE end as zrain
  from shifted),
valued as (
  select *, case when hit then baseline_temp else ztemp + ewave * zspan end as T2M,
    case when hit then baseline_precip else zrain end as PRECTOTCORR from zoned),
humid as (
  select *, least(greatest(70 - T2M * 0.8::DOUBLE + PRECTOTCORR / 100 * 10, 20::DOUBLE), 95::DOUBLE) as RH2M from valued),
estimated as (
  select *, T2M + 7 as T2M_MAX, T2M - 7 as T2M_MIN,
    220 * (1 - size / 90 * 0.3::DOUBLE) * (0.7::DOUBLE + 0.3::DOUBLE * swave) as ALLSKY_SFC_SW_DWN,
    0.622::DOUBLE * 0.01::DOUBLE * RH2M * exp(17.27::DOUBLE * T2M / (T2M + 237.3::DOUBLE)) / 1013.25::DOUBLE * 15
      as QV2M from humid)
"""


_ESTIMATES = ["T2M", "T2M_MAX", "T2M_MIN", "PRECTOTCORR", "RH2M", "ALLSKY_SFC_SW_DWN", "QV2M"]
_SHOWN = _list(*[f"{r(c)} as {c}" for c in _ESTIMATES])

_add("scenario_zone", "requests", f"""
with source as (select *, false as hit, null::DOUBLE as baseline_temp, null::DOUBLE as baseline_precip from requests),
{_estimated('source')}
select request_id, {_SHOWN} from estimated
""")

_add("scenario_baseline", "series locations normals requests", f"""
with source as ({_EXACT.format(source='requests')}), {_estimated('source')}
select request_id, case when hit then 'baseline' else 'zone' end as estimated_from, {_SHOWN} from estimated
""")

_SCENARIOS = f"{_MONTHS}, source as ({_EXACT.format(source='expanded')}), {_estimated('source')}"
_MONTH_SEASON = _SEASON.replace("month(time)", "month")
_FEATURE_SQL = {
    **{f"{c}_transformed": c for c in CONTINUOUS},
    "month_sin": "sin(2 * pi() * month / 12)", "month_cos": "cos(2 * pi() * month / 12)",
    "year_norm": "(year - 2010) / 14.0::DOUBLE", "latitude": "latitude", "longitude": "longitude",
    "T2M_range": "T2M_MAX - T2M_MIN", "heat_index": "T2M + 0.5::DOUBLE * RH2M / 100",
    "precip_log": "ln(1 + PRECTOTCORR)",
}
_add("scenario_features", "series locations normals requests", f"""
with {_SCENARIOS}
select request_id, year, month,
  {_list(*[f"{r(_FEATURE_SQL[c])} as {c}" for c in FEATURES if c in _FEATURE_SQL])}, {_flags(_MONTH_SEASON)}
from estimated
""")

_PREDICTED = f"""
{_SCENARIOS},
predicted as (
  select *, T2M + ta as predicted_temp, greatest(0.0::DOUBLE, PRECTOTCORR + pa) as predicted_precip from (
    select *, (request_id % 7 - 3) / 20.0::DOUBLE as ta, (request_id % 11 - 5) * 30.0::DOUBLE as pa from estimated))
"""
_add("predict_value", "series locations normals requests", f"""
with {_PREDICTED}
select request_id, year, month, {r('T2M')} as baseline_temp, {r('PRECTOTCORR')} as baseline_precip,
  {r('predicted_temp')} as predicted_temp, {r('predicted_precip')} as predicted_precip from predicted
""")

_add("labels", "series locations normals requests", f"""
with {_PREDICTED}
select request_id, year, month,
  case when ta > 0 then 'warmer than average' else 'cooler than average' end as temperature_label,
  case when pa > 0 then 'wetter than average' else 'drier than average' end as precipitation_label,
  case when abs(ta) < 0.1::DOUBLE then 'Normal' when ta > 0 then 'Warmer than average'
    else 'Cooler than average' end as temperature_status,
  case when abs(pa) < 0.1::DOUBLE then 'Normal' when pa > 0 then 'More precipitation than average'
    else 'Less precipitation than average' end as precipitation_status
from predicted
""")

_add("prediction_records", "series locations normals requests", f"""
with {_PREDICTED}
select latitude, longitude, year, month, strftime(make_date(year, month, 1), '%b') as month_name,
  {r('predicted_temp')} as temperature, {r('predicted_precip')} as precipitation,
  case when ta > 0 then 'warmer than average' else 'cooler than average' end as temperature_label
from predicted
""")

# Scoring and evaluation

_JUDGED = f"""
judged as (select *, 0.5::DOUBLE * T2M_anom as T2M_p, 0.5::DOUBLE * PRECTOTCORR_anom as PRECTOTCORR_p
  from ({_DEVIATION})),
scored as (select location_id, strftime(time, '%Y-%m') as date, {r('T2M_p')} as temperature_anomaly,
  {r('PRECTOTCORR_p')} as precipitation_anomaly, {r('T2M')} as actual_temperature,
  {r('PRECTOTCORR')} as actual_precipitation, T2M_p, PRECTOTCORR_p from judged)
"""
_SCORED = "location_id, date, temperature_anomaly, precipitation_anomaly, actual_temperature, actual_precipitation"

_add("score_closed_form", "series", f"with {_JUDGED} select {_SCORED} from scored")
_add("alerts", "series", f"with {_JUDGED} select {_SCORED} from scored where T2M_p > 0.5")
_add("last_three", "series", f"""
with {_JUDGED} select {_SCORED} from scored
qualify row_number() over (partition by location_id order by date desc) <= 3
""")

_add("prediction_errors", "series", f"""
with {_JUDGED} select location_id, time, {r('T2M_anom - T2M_p')} as T2M_error,
  {r('PRECTOTCORR_anom - PRECTOTCORR_p')} as PRECTOTCORR_error from judged
""")

_add("metrics", "series", f"with {_JUDGED} " + " union all ".join(
    f"select '{t}' as target, {r(f'avg(abs({t} - {p}))')} as mae, {r(f'sqrt(avg(({t} - {p}) * ({t} - {p})))')} as rmse, "
    f"{r(f'1 - avg(({t} - {p}) * ({t} - {p})) / var_pop({t})')} as r2 from judged"
    for t, p in (("T2M_anom", "T2M_p"), ("PRECTOTCORR_anom", "PRECTOTCORR_p"))))

_add("overall_loss", "series", f"""
with {_JUDGED}, e as (
  select (avg((T2M_anom - T2M_p) * (T2M_anom - T2M_p))
          + avg((PRECTOTCORR_anom - PRECTOTCORR_p) * (PRECTOTCORR_anom - PRECTOTCORR_p))) / 2 as loss,
    (avg(abs(T2M_anom - T2M_p)) + avg(abs(PRECTOTCORR_anom - PRECTOTCORR_p))) / 2 as mae from judged)
select {r('loss')} as loss, {r('mae')} as mae, {r('sqrt(loss)')} as rmse from e
""")

_add("prediction_summary", "series", f"""
with {_JUDGED} select location_id, count(*) as samples, {_list(*[
    f"{r(f'{f}({p})')} as {n}_{label}" for n, p in (("temperature_anomaly", "T2M_p"),
                                                   ("precipitation_anomaly", "PRECTOTCORR_p"))
    for f, label in (("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max"))])}
from scored group by location_id
""")

_add("response_records", "series", f"""
with {_JUDGED} select location_id, count(*) as samples, count(*)::INTEGER as listed, min(date) as first_date,
  max(date) as last_date, {r('sum(T2M)')} as actual_total, {_list(*[
    f"{r(f'{f}({p})')} as {n}_{label}" for n, p in (("temperature_anomaly", "T2M_p"), ("precipitation_anomaly", "PRECTOTCORR_p"))
    for f, label in (("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max"))])}
from (select s.*, j.T2M from scored s join (select location_id, strftime(time, '%Y-%m') as date, T2M from judged) j
  using (location_id, date)) group by location_id
""")

_add("error_histogram", "", f"""
with errors as (select value - 10 as e from events),
span as (select min(e) as lo, max(e) as hi, (max(e) - min(e)) / 50 as step from errors),
edges as (select i::INTEGER as bin, i * step + lo as low, case when i = 49 then hi else (i + 1) * step + lo end as high,
            i = 49 as closed from span, range(50) b(i))
select bin, {r('any_value(low)')} as low, {r('any_value(high)')} as high, count(e) as count
from edges left join errors on e >= low and (e < high or (closed and e <= high)) group by bin
""")

_add("error_histogram_saved", "series", f"""
with {_JUDGED},
errors as (select unnest(['T2M_error', 'PRECTOTCORR_error']) as "column",
  unnest([{r('T2M_anom - T2M_p')}, {r('PRECTOTCORR_anom - PRECTOTCORR_p')}]) as e from judged),
span as (select "column", min(e) as lo, max(e) as hi, (max(e) - min(e)) / 50 as step, avg(e) as mean from errors group by "column"),
edges as (select "column", mean, i::INTEGER as bin, i * step + lo as low,
  case when i = 49 then hi else (i + 1) * step + lo end as high, i = 49 as closed from span, range(50) b(i))
select edges."column", bin, {r('any_value(low)')} as low, {r('any_value(high)')} as high, count(e) as count,
  {r('any_value(mean)')} as mean_error
from edges left join errors on errors."column" = edges."column" and e >= low and (e < high or (closed and e <= high))
group by edges."column", bin
""")

_STREAM = f"""
with stream_rows as (select *, year(time)::VARCHAR as request from series),
scored as (select location_id, request, strftime(time, '%Y-%m') as date,
  0.5::DOUBLE * (T2M - avg(T2M) over p) as a, 0.5::DOUBLE * (PRECTOTCORR - avg(PRECTOTCORR) over p) as b,
  T2M, PRECTOTCORR from stream_rows window p as (partition by location_id, request))
select location_id, request, date, {r('a')} as temperature_anomaly, {r('b')} as precipitation_anomaly,
  {r('T2M')} as actual_temperature, {r('PRECTOTCORR')} as actual_precipitation from scored
"""
_add("score_stream", "series", _STREAM)
_add("score_pieces", "series", f"select *, true as complete from ({_STREAM})")


_add("onehot_many", "", """
with sorted as (select distinct c_name from customer), coded as (select c_name, row_number() over (order by c_name) - 2 as index from sorted)
select c_custkey, (select count(*) - 1 from sorted) as size, index from customer join coded using (c_name)
""")


_PLACE = "(location_id * 7 + year(time) * 13 + month(time) * 3) % 20"
_LINE = f"""
parted as (select *, case when {_PLACE} < 14 then 'train' when {_PLACE} < 17 then 'validation' else 'test' end as part
  from ({_DEVIATION})),
line as (select {_list(*[f"regr_slope({t}, T2M) as {t}_a, regr_intercept({t}, T2M) as {t}_b" for t in (
    "T2M_anom", "PRECTOTCORR_anom")])} from parted where part = 'train'),
fitted as (select parted.*, T2M * T2M_anom_a + T2M_anom_b as tp, T2M * PRECTOTCORR_anom_a + PRECTOTCORR_anom_b as pp
  from parted, line)
"""

_add("score_model", "series", f"""
with {_LINE} select location_id, time as date, part, {r('T2M_anom')} as T2M_anom, {r('PRECTOTCORR_anom')} as PRECTOTCORR_anom,
  {r('tp')} as T2M_anom_predicted, {r('pp')} as PRECTOTCORR_anom_predicted, {r('T2M_anom - tp')} as T2M_error,
  {r('PRECTOTCORR_anom - pp')} as PRECTOTCORR_error from fitted
""")

_add("predict_windows", "series", f"""
with {_LINE} select location_id, strftime(time, '%Y-%m') as date, {r('tp')} as temperature_anomaly,
  {r('pp')} as precipitation_anomaly, {r('T2M')} as actual_temperature, {r('PRECTOTCORR')} as actual_precipitation from fitted
""")

_add("model_metrics", "series", f"""
with rows as (select month(time) as m from series where {_PLACE} >= 17),
steps as (select unnest(['T2M_anom', 'PRECTOTCORR_anom']) as target,
  unnest([case when m <= 6 then 1.0 else 3.0 end, case when m <= 3 then -2.0 else 0.5 end])::DOUBLE as y from rows)
select target, avg(abs(y - y)) as mae, sqrt(avg((y - y) * (y - y))) as rmse, 1 - avg((y - y) * (y - y)) / var_pop(y) as r2
from steps group by target
""")


def all_sql() -> dict[str, str]:
    return dict(_SQL)
