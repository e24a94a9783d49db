"""Cleaning, flags, text rules."""
from pyspark.sql import functions as F

import chargelens.plans.oracle_ctes  # noqa: F401
from chargelens.functions import codes, opening_hours
from chargelens.functions.exprs import normal_text
from chargelens.operators import clean, snapshots
from chargelens.plans.common import current_chargers
from chargelens.plans.q_spatial import stations
from chargelens.plans.registry import query
from chargelens.sources.views import ORACLE_CTES

TYPE_SQL = "case {c} " + " ".join(f"when '{k}' then '{v}'" for k, v in codes.CHARGER_TYPE.items()) + " else '알수없음' end"
INTERNAL_SQL = "case ltrim({c}, '0') when '2' then 'AVAILABLE' when '3' then 'CHARGING' when '4' then 'OUT_OF_ORDER' when '5' then 'UNDER_INSPECTION' else 'UNKNOWN' end"


def raw_stations(t):
    return t.v_stations_raw.withColumns({
        "lat": F.when(F.col("lat_text").isin("x", "37.5"), F.col("lat_text")).otherwise((F.col("lat_text").try_cast("double") / 1000).cast("string")),
        "lng": (F.col("lng_text").cast("double") / 1000).cast("string"),
    }).drop("lat_text", "lng_text")


@query("b1_clean_stations", """
select stat_id, trim(stat_nm) as stat_nm, trim(addr) as addr, lat, lng, trim(coalesce(busi_nm, '')) as busi_nm, trim(coalesce(use_time, '24시간 이용가능')) as use_time, upper(trim(coalesce(parking_free, 'N'))) as parking_free
from (select *, case lat_text when 'x' then null when '37.5' then 37.5 else cast(lat_text as double) / 1000 end as lat, cast(lng_text as double) / 1000 as lng from v_stations_raw)
where stat_id is not null and trim(stat_nm) <> '' and trim(addr) <> '' and lat between 35.6 and 36.2 and lng between 128.3 and 128.9""", num="lat lng")
def _(t):
    return clean.stations(raw_stations(t))


@query("b2_clean_chargers", f"""
select stat_id, chger_id, {TYPE_SQL.format(c='trim(chger_type)')} as chger_type, trim(coalesce(output, '')) as output, {INTERNAL_SQL.format(c='trim(stat)')} as stat, trim(coalesce(stat_updated_at, '')) as stat_updated_at
from v_chargers_raw where stat_id is not null and chger_id is not null""")
def _(t):
    return clean.chargers(t.v_chargers_raw)


@query("b3_official_from_code", "select stat, case ltrim(stat, '0') when '2' then 'AVAILABLE' when '3' then 'CHARGING' when '1' then 'OUT_OF_SERVICE' when '4' then 'OUT_OF_SERVICE' when '5' then 'OUT_OF_SERVICE' else 'UNKNOWN' end as official, count(*) as n from v_chargers_raw group by 1, 2")
def _(t):
    return t.v_chargers_raw.groupBy("stat", codes.official_status(F.col("stat")).alias("official")).agg(F.count("*").alias("n"))


@query("b4_official_from_name", f"""
select internal, case internal when 'OUT_OF_ORDER' then 'OUT_OF_SERVICE' when 'UNDER_INSPECTION' then 'OUT_OF_SERVICE' else internal end as official, count(*) as n
from (select {INTERNAL_SQL.format(c='stat')} as internal from v_charger_master) group by 1, 2""")
def _(t):
    internal = codes.internal_status(F.col("stat"))
    return t.v_charger_master.groupBy(internal.alias("internal"), codes.official_from_name(F.lower(internal)).alias("official")).agg(F.count("*").alias("n"))


@query("b5_normalized_events", """
select station_id || '|' || charger_id as charger_key, fetched_at as observed_at, case stat when 2 then 'AVAILABLE' when 3 then 'CHARGING' when 9 then 'UNKNOWN' else 'OUT_OF_SERVICE' end as status, event_id from v_status_events""", ts="observed_at")
def _(t):
    raw = t.v_status_events.select(
        F.col("station_id").alias("statId"), F.col("charger_id").alias("chgerId"), F.col("stat").cast("string").alias("stat"), F.date_format("tick_ts", "yyyyMMdd_HHmmss").alias("snapshotId"),
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetchedAt"), F.date_format("stat_updated_at", "yyyyMMddHHmmss").alias("statUpdDt"), F.col("page_no").cast("string").alias("pageNo"), F.col("event_id").alias("row_no"),
    )
    ev = snapshots.typed_events(raw)
    return ev.select(F.concat_ws("|", "station_id", "charger_id").alias("charger_key"), F.col("fetched_at").alias("observed_at"), codes.official_smart(F.col("stat")).alias("status"), "event_id")


ORACLE_CTES["x_info"] = """
select *, case when lat is null or lng is null then 'MISSING_COORD' else coalesce(nullif(concat_ws('|', case when holder then 'PLACEHOLDER_COORD' end, case when not box then 'OUT_OF_BBOX' end,
  case when city and not box then 'ADDR_DAEGU_COORD_SUSPECT' end, case when addr is not null and not city and box then 'ADDR_NOT_DAEGU' end), ''), 'OK') end as coordinate_quality_flag
from (select m.*, coalesce(upper(del_yn) <> 'Y', true) as is_service_target, coalesce(contains(addr, '대구'), false) as city, coalesce(lat between 35.55 and 36.45 and lng between 128.25 and 129.05, false) as box,
  lat = 35 and lng = 128 as holder, x.n as shared_coord_station_n from v_charger_master m left join (select lat, lng, count(distinct station_id) as n from v_charger_master where lat is not null group by 1, 2) x using (lat, lng))"""
INFO_COLS = "station_id, charger_id, is_service_target, city as addr_is_city, box as coord_in_bbox, cast(shared_coord_station_n as double) as shared_coord_station_n, coalesce(shared_coord_station_n >= 10, false) as shared_coord_cluster, coordinate_quality_flag, coordinate_quality_flag = 'OK' as coord_ok"


def info_out(df):
    return df.select("station_id", "charger_id", "is_service_target", "addr_is_city", "coord_in_bbox", F.col("shared_coord_station_n").cast("double").alias("shared_coord_station_n"), "shared_coord_cluster", "coordinate_quality_flag", "coord_ok")


@query("b6_annotate_charger_info", f"select {INFO_COLS} from x_info")
def _(t):
    return info_out(clean.annotate_info(t.v_charger_master))


@query("b7_service_chargers", f"select {INFO_COLS} from x_info where is_service_target and coordinate_quality_flag = 'OK'")
def _(t):
    return info_out(clean.service(clean.annotate_info(t.v_charger_master)))


@query("b7_quarantine_chargers", f"select {INFO_COLS} from x_info where coordinate_quality_flag <> 'OK'")
def _(t):
    return info_out(clean.quarantine(clean.annotate_info(t.v_charger_master)))


@query("b8_full_info_clean", """
select station_id, charger_id, try_cast(output as double) as output_num, case when upper(parking_free) in ('Y', 'N') then upper(parking_free) else 'UNKNOWN' end as parking_free,
  replace(replace(busi_nm, '(주)', '㈜'), '㈜ ', '㈜') as busi_nm_norm, use_time is not null as operation_time_known, coalesce(contains(use_time, '24') or contains(use_time, '종일'), false) as is_24h,
  coalesce(nullif(concat_ws('|', case when lat is null then 'MISSING_COORD' end, case when lat is not null and not box then 'OUT_OF_BBOX' end, case when city and not box and lat is not null then 'ADDR_DAEGU_COORD_SUSPECT' end,
    case when not city and addr is not null and box then 'ADDR_NOT_DAEGU' end), ''), 'OK') as coordinate_quality_flag from x_info""", num="output_num")
def _(t):
    return clean.full_info(t.v_charger_master).select("station_id", "charger_id", "output_num", "parking_free", "busi_nm_norm", "operation_time_known", "is_24h", "coordinate_quality_flag")


@query("b9_status_clean", """
select r.stat_id as station_id, r.chger_id as charger_id, m.station_name, case when r.stat is null then null when r.stat = '0' then 'UNKNOWN_CODE' else case r.stat when '1' then 'COMM_ERROR' when '2' then 'AVAILABLE' when '3' then 'CHARGING' when '4' then 'OPERATING_STOPPED' when '5' then 'MAINTENANCE' else 'UNKNOWN_CODE' end end as stat_mapped,
  r.stat_updated_at is not null and try_strptime(r.stat_updated_at, '%Y%m%d%H%M%S') is null as updated_parse_failed,
  epoch(timestamp '2024-01-30 12:20:00' - try_strptime(r.stat_updated_at, '%Y%m%d%H%M%S')) as status_age_seconds,
  coalesce(epoch(timestamp '2024-01-30 12:20:00' - try_strptime(r.stat_updated_at, '%Y%m%d%H%M%S')) > 900, false) as is_status_stale
from v_chargers_raw r left join v_charger_master m on m.station_id = r.stat_id and m.charger_id = r.chger_id""", num="status_age_seconds")
def _(t):
    raw = t.v_chargers_raw.withColumnsRenamed({"stat_id": "station_id", "chger_id": "charger_id"}).withColumn("fetched_at", F.expr("timestamp_ntz'2024-01-30 12:20:00'"))
    return clean.status_rows(raw, t.v_charger_master).select("station_id", "charger_id", "station_name", "stat_mapped", "updated_parse_failed", "status_age_seconds", "is_status_stale")


@query("b9_status_coverage_by_operator", """
select replace(replace(m.busi_nm, '(주)', '㈜'), '㈜ ', '㈜') as operator, count(*) as chargers, avg(case when c.station_id is not null then 100.0 else 0 end) as coverage_pct
from v_charger_master m left join x_chargers c using (station_id, charger_id) group by 1""", num="coverage_pct")
def _(t):
    return clean.coverage_by(t.v_charger_master, t.v_status_events, clean.operator_name(F.col("busi_nm")), "operator")


@query("b9_status_coverage_by_type", """
select coalesce(m.chger_type, 'UNKNOWN') as chger_type, count(*) as chargers, avg(case when c.station_id is not null then 100.0 else 0 end) as coverage_pct
from v_charger_master m left join x_chargers c using (station_id, charger_id) group by 1""", num="coverage_pct")
def _(t):
    return clean.coverage_by(t.v_charger_master, t.v_status_events, F.col("chger_type"), "chger_type")


@query("b10_current_view", "select station_id, charger_id, busi_nm, status_code, stat_mapped, status_missing, case when status_missing then 'NO_STATUS_OBSERVED' else 'STATUS_OBSERVED' end as availability_note from x_current", num="status_code")
def _(t):
    return current_chargers(t).select("station_id", "charger_id", "busi_nm", F.col("status_code").cast("double").alias("status_code"), "stat_mapped", "status_missing", "availability_note")


ORACLE_CTES["x_lot_now"] = "select * from (select *, row_number() over (partition by lot_id order by collected_at desc, id desc) rn from v_lot_realtime) where rn = 1"


@query("b11_parking_clean", """
select l.lot_id, oper_type = '전일' and open_hr is null and close_hr is null as oper_hours_derived, case when oper_type = '전일' and open_hr is null and close_hr is null then '2400' end as close_hr_derived,
  r.remaining_spaces is null as realtime_parking_missing, coalesce(r.congestion_status, 'UNKNOWN') as realtime_status, coalesce(r.remaining_spaces < 0, false) as rmnd_negative, coalesce(r.remaining_spaces > l.total_spaces, false) as rmnd_gt_total,
  coalesce(abs(r.occupancy_rate - (1 - r.remaining_spaces / cast(l.total_spaces as double))) > 0.05, false) as occupancy_inconsistent
from v_lots l left join x_lot_now r using (lot_id)""")
def _(t):
    now = snapshots.keep_one(t.v_lot_realtime, ("lot_id",), ("collected_at", "id"))
    return clean.parking(t.v_lots, now).select("lot_id", "oper_hours_derived", "close_hr_derived", "realtime_parking_missing", "realtime_status", "rmnd_negative", "rmnd_gt_total", "occupancy_inconsistent")


@query("b12_link_clean", """
with n as (select *, try_cast(distance_m_text as double) as m, try_cast(speed_text as double) as v, try_cast(travel_text as double) as s from v_links)
select link_id, m as distance_m, v as speed_kph, coalesce(m < 0, false) or coalesce(v < 0, false) or coalesce(s < 0, false) as negative_metric, m * 3.6 / v as travel_time_expected,
  coalesce(abs(s - m * 3.6 / v) > 30, false) as travel_time_inconsistent, coalesce(cong_name <> case cong_grade when '1' then '원활' when '2' then '지체' else '정체' end, false) as cong_name_inconsistent from n""", num="distance_m speed_kph travel_time_expected")
def _(t):
    return clean.links(t.v_links).select("link_id", "distance_m", "speed_kph", "negative_metric", "travel_time_expected", "travel_time_inconsistent", "cong_name_inconsistent")


@query("b13_incident_clean", """
select event_id, incident_id, start_ts > end_ts as start_after_end, start_ts <= timestamp '2024-01-15 12:00:00' and end_ts >= timestamp '2024-01-15 12:00:00' as is_active_at_asof,
  link_id is null or link_id in (select link_id from v_links) as link_fk_ok from v_incidents""")
def _(t):
    return clean.incidents(t.v_incidents, t.v_links, F.expr("timestamp_ntz'2024-01-15 12:00:00'")).select("event_id", "incident_id", "start_after_end", "is_active_at_asof", "link_fk_ok")


ORACLE_CTES["x_weather"] = """
select *, case when category in ('PCP', 'SNO') then case when fcst_value = '강수없음' then 0 when contains(fcst_value, '미만') then 1 else coalesce(try_cast(nullif(regexp_extract(fcst_value, '([0-9.]+)\\s*mm', 1), '') as double), try_cast(fcst_value as double)) end
    when category <> 'SKY' then try_cast(fcst_value as double) end as value_numeric,
  strptime(base_date || lpad(base_time, 4, '0'), '%Y%m%d%H%M') as base_datetime, strptime(fcst_date || lpad(fcst_time, 4, '0'), '%Y%m%d%H%M') as forecast_datetime from v_weather"""


@query("b14_weather_clean", "select l_orderkey, l_linenumber, l_partkey, category, base_datetime, forecast_datetime, value_numeric, category <> 'SKY' and value_numeric is null as weather_parse_error from x_weather", num="value_numeric", ts="base_datetime forecast_datetime")
def _(t):
    return clean.weather(t.v_weather).select("l_orderkey", "l_linenumber", "l_partkey", "category", "base_datetime", "forecast_datetime", "value_numeric", "weather_parse_error")


def _wide(c):
    v = "try_cast(fcst_value as double)" if c == "SKY" else "value_numeric"
    return f"arg_min({v}, (base_datetime, l_orderkey, l_linenumber, l_partkey)) filter (category = '{c}' and {v} is not null) as {c}"


@query("b15_weather_wide", "select forecast_datetime, nx, ny, " + ", ".join(_wide(c) for c in ("TMP", "REH", "WSD", "PCP", "SNO", "SKY")) + " from x_weather group by 1, 2, 3", num="TMP REH WSD PCP SNO SKY", ts="forecast_datetime")
def _(t):
    return clean.weather_wide(clean.weather(t.v_weather))


def tour_clean(t):
    scale = lambda c: F.when(F.col(c) == "none", F.col(c)).otherwise((F.col(c).try_cast("double") / 1000).cast("string"))
    return clean.tour(t.v_tour.withColumns({"mapx": scale("mapx_text"), "mapy": scale("mapy_text")}))


ORACLE_CTES["x_tour"] = """
select *, try_cast(mapx_text as double) / 1000 as lng, try_cast(mapy_text as double) / 1000 as lat, addr1 is not null and addr2 is null as addr2_structural_missing,
  nullif(trim(coalesce(addr1, '') || ' ' || coalesce(addr2, '')), '') as address_std, first_image is not null as has_image from v_tour"""
ORACLE_CTES["x_parks"] = """
select *, coalesce(road_addr, lot_addr, 'UNKNOWN') as representative_address, case when road_addr is not null then 'ROAD' when lot_addr is not null then 'LOT' else 'UNKNOWN' end as address_source,
  lat between 33 and 39 and lng between 124 and 132 as coord_valid from v_parks"""


@query("b16_tour_clean", "select content_id, lat, lng, addr2_structural_missing, address_std, has_image from x_tour", num="lat lng")
def _(t):
    return tour_clean(t).select("content_id", "lat", "lng", "addr2_structural_missing", "address_std", "has_image")


ORACLE_CTES["x_attrs"] = """
select row_id, attract_name, attr_col, case replace(nm, ' ', '') when '이용시간' then '이용시간' else nm end as attr_name, nullif(trim(split_part(cell, '|', 2)), '') as attr_value
from (select row_id, attract_name, attr_col, trim(cell) as cell, trim(split_part(cell, '|', 1)) as nm from (
  select row_id, attract_name, 'attr01' as attr_col, attr01 as cell from v_city_tour union all select row_id, attract_name, 'attr02', attr02 from v_city_tour union all select row_id, attract_name, 'attr03', attr03 from v_city_tour)) where contains(cell, '|')"""


@query("b17_city_tour_attributes", "select *, attr_value is null as attr_missing from x_attrs")
def _(t):
    return clean.city_tour_attributes(t.v_city_tour)


@query("b17_city_tour_wide", "select row_id, " + ", ".join(f"""min(attr_value) filter (attr_name = '{n}') as "{n}\"""" for n in ("입장료", "휴무일", "이용시간")) + " from x_attrs group by 1")
def _(t):
    return clean.city_tour_wide(clean.city_tour_attributes(t.v_city_tour))


@query("b18_parks_clean", "select mng_no, representative_address, address_source, coord_valid from x_parks")
def _(t):
    return clean.parks(t.v_parks).select("mng_no", "representative_address", "address_source", "coord_valid")


@query("b19_poi_master", """
select 'TOUR-' || content_id as poi_id, 'TOUR_API' as poi_type, title as name, address_std as address, lat, lng, true as has_coords, cast(null as varchar) as address_source from x_tour
union all select 'PARK-' || mng_no, 'PARK_WALK', park_name, representative_address, lat, lng, coord_valid, address_source from x_parks""", num="lat lng")
def _(t):
    return clean.poi_master(tour_clean(t), clean.parks(t.v_parks))


@query("b19_poi_without_coords", "select 'CITYTOUR-' || row_id as poi_id, 'CITY_TOUR' as poi_type, attract_name as name, trim(regexp_replace(address, '\\s+', ' ', 'g')) as address, true as needs_geocoding from v_city_tour")
def _(t):
    return clean.poi_without_coords(t.v_city_tour)


@query("b20_normal_text", """
select doc_id, md5(t) as text_md5, length(t) as n_text from (select doc_id, case when lower(t) not in ('', 'null', 'none', 'nan', '-', 'na', 'n/a') then t end as t
from (select doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')) as t from documents))""")
def _(t):
    d = clean.normalize_text_columns(t.documents.select("doc_id", "text"))
    return d.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_text"))


@query("b21_mojibake_repair", """
select doc_id, md5(text) as text_md5, case when regexp_matches(text, '[^\\x00-\\x7f]') then 1 else 0 end as repaired_cells from documents""")
def _(t):
    broken = t.documents.select("doc_id", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("text"))
    return clean.repair_mojibake(broken).select("doc_id", F.md5("text").alias("text_md5"), "repaired_cells")


OPEN_SQL = """case use_time when '24시간' then 'Y' when '00:00~24:00' then 'Y' when '비개방' then 'N' when '개방불가' then 'N' when '매장 영업시간' then 'UNKNOWN' when '09:00~18:00, 10:00~16:00' then 'UNKNOWN'
 when '09:00~18:00' then {a} when '19:00~08:00' then {b} when '평일 09:00~18:00, 주말 10:00~14:00' then {c} when '05:00~익일 01:00' then {d} when '09시~23시' then {e} when '8~18시' then {f}
 when '평일 08:00~20:00, 주말 휴무' then {g} else 'UNKNOWN' end"""
OPEN_TUE_2030 = OPEN_SQL.format(a="'N'", b="'Y'", c="'N'", d="'Y'", e="'Y'", f="'N'", g="'N'")
OPEN_SAT_0900 = OPEN_SQL.format(a="'Y'", b="'N'", c="'N'", d="'Y'", e="'Y'", f="'Y'", g="'N'")


@query("b22_operating_now_weekday", f"select station_id, {OPEN_TUE_2030} as is_operating_now from x_stations")
def _(t):
    return opening_hours.with_operating_now(stations(t), F.expr("timestamp_ntz'2024-01-30 20:30:00'")).select("station_id", "is_operating_now")


@query("b22_operating_now_weekend", f"select station_id, {OPEN_SAT_0900} as is_operating_now from x_stations")
def _(t):
    return opening_hours.with_operating_now(stations(t), F.expr("timestamp_ntz'2024-01-27 09:00:00'")).select("station_id", "is_operating_now")


ORACLE_CTES["x_city_sessions"] = "select * from v_sessions where region = '대구광역시' and starts_with(addr, '대구광역시')"
ORACLE_CTES["x_sessions"] = """
select *, cast(split_part(duration_text, ':', 1) as double) * 60 + cast(split_part(duration_text, ':', 2) as double) + cast(split_part(duration_text, ':', 3) as double) / 60.0 as minutes,
  extract(hour from start_ts) as hour, isodow(start_ts) - 1 as dow, isodow(start_ts) >= 6 as is_weekend, trim(station_name) || '|' || split_part(addr, ' ', 2) as station_key from x_city_sessions"""


@query("b23_city_sessions", "select session_id from x_city_sessions")
def _(t):
    return clean.city_sessions(t.v_sessions).select("session_id")


@query("b24_city_incidents", """
select event_id from v_incidents where contains(coalesce(addr, ''), '대구') or (addr is null and lat between 35.55 and 36.45 and lng between 128.25 and 129.05)""")
def _(t):
    return clean.city_incidents(t.v_incidents).select("event_id")


@query("b25_city_lots_first_by_source_id", """
select lot_name, lot_id from (select *, row_number() over (partition by lot_name order by lot_id) rn from v_lots where starts_with(addr, '대구광역시')) where rn = 1""")
def _(t):
    return snapshots.keep_one(clean.city_lots(t.v_lots), ("lot_name",), ("lot_id",), last=False).select("lot_name", "lot_id")


@query("b26_enriched_sessions", "select session_id, minutes, hour, dow, is_weekend, station_key from x_sessions", num="minutes")
def _(t):
    return clean.enrich_sessions(clean.city_sessions(t.v_sessions)).select("session_id", "minutes", "hour", "dow", "is_weekend", "station_key")


@query("b27_capacity_buckets", "select case capacity when '급속(50kW)' then '50kW' when '100kW' then '100kW' when '완속 7 kW' then '50kW' when '200KW' then '200kW' else 'unknown' end as kw_bucket, count(*) as sessions from v_sessions group by 1")
def _(t):
    return t.v_sessions.groupBy(clean.kw_bucket(F.col("capacity")).alias("kw_bucket")).agg(F.count("*").alias("sessions"))


INCIDENT_TYPE_SQL = "case when contains(title, '사고') then '사고' when contains(title, '공사') then '공사' when contains(title, '행사') then '행사' when contains(title, '통제') then '통제' else '기타' end"


@query("b28_incident_types", f"select {INCIDENT_TYPE_SQL} as incident_type, count(*) as n from v_incidents group by 1")
def _(t):
    return t.v_incidents.groupBy(clean.incident_type(F.col("title")).alias("incident_type")).agg(F.count("*").alias("n"))


@query("b29_congestion_grades", "select try_cast(trim(cong_grade) as double) as grade, count(*) as n from v_link_ticks group by 1", num="grade")
def _(t):
    return t.v_link_ticks.groupBy(clean.grade_number(F.col("cong_grade")).alias("grade")).agg(F.count("*").alias("n"))


ORACLE_CTES["x_access"] = """
select s.*, l.r as access_restricted, contains(station_name, '아파트') or contains(station_name, ' APT ') as name_suggests_residential, not l.r as recommend_public_default
from x_stations s join (select station_id, bool_or(limit_yn = 'Y') as r from v_charger_master group by 1) l using (station_id)"""


@query("b30_access_flags", "select station_id, access_restricted, name_suggests_residential, recommend_public_default from x_access")
def _(t):
    return clean.access_flags(t.v_charger_master, stations(t)).select("station_id", "access_restricted", "name_suggests_residential", "recommend_public_default")


@query("b31_parking_fees", """
select id, it ->> '$.prkInfo.pkltId' as lot_id, nullif(it ->> '$.prkOperInfo.gnrlFrstCrg', '') as first_fee, it ->> '$.prkOperInfo.stlmMthd' as payment
from (select id, unnest(cast(payload -> '$.data' as json[])) as it from v_lot_payloads where json_valid(payload))""")
def _(t):
    return clean.parking_fees(t.v_lot_payloads).select("id", "lot_id", F.col("gnrlFrstCrg").alias("first_fee"), F.col("stlmMthd").alias("payment"))


@query("b31_free_parking_by_station", """
with p as (select station_id, nullif(upper(parking_free), '') as v, count(*) as n from v_charger_master group by 1, 2)
select station_id, cast(sum(n) as bigint) as chargers, cast(coalesce(sum(n) filter (v = 'Y'), 0) as bigint) as free_y, cast(coalesce(sum(n) filter (v = 'N'), 0) as bigint) as free_n,
  coalesce(arg_min(v, (-n, v)) filter (v is not null), '') as free_mode from p group by 1""")
def _(t):
    return clean.free_parking_by_station(t.v_charger_master)


@query("b33_vehicle_master", "select model_name, coalesce(fixed_kwh, battery_kwh) as battery_kwh, range_km, fixed_kwh is not null as corrected from v_vehicles", num="battery_kwh range_km")
def _(t):
    return clean.vehicle_master(t.v_vehicles)


@query("n1_info_with_status", "select station_id, charger_id, busi_nm, l.stat as status_code from (select * from (select *, row_number() over (partition by station_id, charger_id order by chger_type) rn from v_charger_master) where rn = 1) m left join (select station_id, charger_id, arg_min(stat, event_id) as stat from v_status_events group by 1, 2) l using (station_id, charger_id)", num="status_code")
def _(t):
    first = t.v_status_events.groupBy("station_id", "charger_id").agg(F.min_by("stat", "event_id").cast("double").alias("status_code"))
    return t.v_charger_master.dropDuplicates(["station_id", "charger_id"]).join(first, ["station_id", "charger_id"], "left").select("station_id", "charger_id", "busi_nm", "status_code")


@query("n2_base_pipeline", f"""
with s as (select stat_id as station_id, trim(stat_nm) as stat_nm from (select *, case lat_text when 'x' then null when '37.5' then 37.5 else cast(lat_text as double) / 1000 end as lat, cast(lng_text as double) / 1000 as lng from v_stations_raw)
  where stat_id is not null and trim(stat_nm) <> '' and trim(addr) <> '' and lat between 35.6 and 36.2 and lng between 128.3 and 128.9),
c as (select *, stat_id as station_id, {INTERNAL_SQL.format(c='trim(stat)')} as st, epoch(timestamp '2024-01-30 12:20:00' - try_strptime(case when length(stat_updated_at) = 14 then stat_updated_at end, '%Y%m%d%H%M%S')) / 60.0 as age from v_chargers_raw where stat_id is not null),
a as (select station_id, count(*) as n, count(*) filter (st = 'AVAILABLE') as av, min(age) as age from c group by 1)
select s.station_id, stat_nm, coalesce(n, 0) as total_chargers, coalesce(av, 0) as available_chargers, case when age <= 5 then 'HIGH' when age <= 15 then 'NORMAL' else 'CHECK_REQUIRED' end as reliability_grade,
  (select count(*) from c where c.station_id in (select station_id from s)) as kept_chargers from s left join a using (station_id)""")
def _(t):
    from chargelens.operators import station

    st = clean.stations(raw_stations(t)).withColumnRenamed("stat_id", "station_id")
    ch = clean.chargers(t.v_chargers_raw).withColumnRenamed("stat_id", "station_id")
    kept = ch.join(st.select("station_id"), "station_id", "left_semi")
    out = st.join(station.charger_totals(ch), "station_id", "left").join(station.station_grade(ch, F.expr("timestamp_ntz'2024-01-30 12:20:00'")), "station_id", "left")
    return out.select("station_id", "stat_nm", F.coalesce("total_chargers", F.lit(0)).alias("total_chargers"), F.coalesce("available_chargers", F.lit(0)).alias("available_chargers"),
                      F.coalesce("reliability_grade", F.lit("CHECK_REQUIRED")).alias("reliability_grade"), kept.agg(F.count("*")).scalar().alias("kept_chargers"))
