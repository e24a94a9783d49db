"""Domain tables derived from the given tables. One SQL text per view, valid for Spark and for the oracle.

`{name}` marks an input: a given table or another view.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEW_SQL: dict[str, str] = {
    # change-feed status polls: one row per charger whose state changed in the tick
    "v_status_events": """
select concat('S', cast(cast(floor(user_id / 3.0) as bigint) as string)) as station_id,
       concat('0', cast(user_id % 3 as string)) as charger_id,
       date_trunc('hour', ts) + interval '10' minute * cast(floor(extract(minute from ts) / 10.0) as int) as tick_ts,
       date_trunc('hour', ts) + interval '10' minute * cast(1 + floor(extract(minute from ts) / 10.0) as int) as fetched_at,
       ts as stat_updated_at, event_id,
       case event_type when 'click' then 2 when 'view' then 3 when 'purchase' then 2 when 'signup' then 5
            else case when event_id % 4 = 0 then 9 when event_id % 4 = 1 then 1 else 4 end end as stat,
       case when event_id % 50 = 0 then 2 else 1 end as page_no
from {events}""",
    # poll log: some polled ticks failed, some event ticks are missing from the log
    "v_poll_log": """
select tick_ts, min(case when extract(hour from tick_ts) % 6 = 4 and extract(minute from tick_ts) = 50 then 0 else 1 end) = 1 as ok,
       count(*) as n_rows, cast(1 + floor(count(*) / 5.0) as bigint) as api_calls
from {v_status_events} where not (extract(hour from tick_ts) = 13 and extract(minute from tick_ts) = 20) group by tick_ts""",
    "v_charger_master": """
select concat('S', cast(k as string)) as station_id, concat('0', cast(c_custkey % 3 as string)) as charger_id,
       concat(case when k % 7 = 3 then '행복아파트 ' when k % 11 = 2 then 'Tower APT ' else '공영 ' end, cast(k as string)) as station_name,
       case when k % 13 = 5 then '서울특별시 중구 1' when k % 29 = 7 then null else concat('대구광역시 중구 ', cast(k % 90 as string)) end as addr,
       concat(case when k % 4 = 0 then '(주) ' else '' end, c_mktsegment) as busi_nm,
       lpad(cast(1 + c_custkey % 12 as string), 2, '0') as chger_type,
       case c_nationkey % 5 when 0 then '50' when 1 then '100' when 2 then '7' when 3 then '' else 'unknown' end as output,
       case when c_custkey % 11 = 0 then 'Y' else 'N' end as limit_yn,
       case when c_custkey % 97 = 0 then 'y' else 'N' end as del_yn,
       case c_custkey % 3 when 0 then 'y' when 1 then 'N' else '' end as parking_free,
       cast(c_custkey % 10 as string) as stat,
       case k % 14 when 0 then '24시간' when 1 then '09:00~18:00' when 2 then '19:00~08:00' when 3 then null
            when 4 then '09:00~18:00, 10:00~16:00' when 5 then '비개방' when 6 then '평일 09:00~18:00, 주말 10:00~14:00'
            when 7 then '05:00~익일 01:00' when 8 then '09시~23시' when 9 then '8~18시' when 10 then '평일 08:00~20:00, 주말 휴무'
            when 11 then '매장 영업시간' when 12 then '00:00~24:00' else '개방불가' end as use_time,
       case when k % 103 = 1 then null when k % 101 = 2 then cast(35 as double)
            else cast(35600 + (k * 37) % 600 as double) / 1000 end as lat,
       case when k % 103 = 1 then null when k % 101 = 2 then cast(128 as double)
            else cast(128300 + (k * 53) % 600 as double) / 1000 end as lng
from (select c_custkey, c_nationkey, c_mktsegment, cast(floor(c_custkey / 3.0) as bigint) as k from {customer}) as c""",
    # raw text tables before cleaning
    "v_stations_raw": """
select case when k % 89 = 3 then null else concat('S', cast(k as string)) end as stat_id,
       case k % 17 when 4 then '  ' when 5 then null else concat(' Station ', cast(k as string), ' ') end as stat_nm,
       case k % 19 when 6 then '' else concat('대구광역시 ', cast(k % 50 as string)) end as addr,
       case k % 23 when 7 then 'x' when 8 then '37.5' else cast(35600 + (k * 37) % 600 as string) end as lat_text,
       cast(128300 + (k * 53) % 700 as string) as lng_text,
       case k % 5 when 0 then null else concat(c_mktsegment, ' ') end as busi_nm,
       case k % 3 when 0 then null else ' 09:00~18:00' end as use_time,
       case k % 4 when 0 then null when 1 then ' y' else 'n' end as parking_free
from (select min(case when c_custkey % 3 = 0 then c_mktsegment end) as c_mktsegment, cast(floor(c_custkey / 3.0) as bigint) as k from {customer} group by cast(floor(c_custkey / 3.0) as bigint)) as c""",
    "v_chargers_raw": """
select case when c_custkey % 91 = 5 then null else concat('S', cast(cast(floor(c_custkey / 3.0) as bigint) as string)) end as stat_id,
       concat('0', cast(c_custkey % 3 as string)) as chger_id,
       case c_custkey % 13 when 12 then null else concat(' ', lpad(cast(c_custkey % 13 as string), 2, '0')) end as chger_type,
       case c_nationkey % 3 when 0 then null else cast(c_nationkey as string) end as output,
       case c_custkey % 8 when 7 then null when 6 then '05' else cast(c_custkey % 8 as string) end as stat,
       case c_custkey % 6 when 5 then null when 4 then 'bad' else concat('202401301', lpad(cast(c_custkey % 10 as string), 1, '0'), lpad(cast(c_custkey % 60 as string), 2, '0'), '00') end as stat_updated_at
from {customer}""",
    "v_lots": """
select concat('L', cast(s_suppkey as string)) as lot_id, 50 + s_suppkey % 200 as total_spaces,
       concat(case when s_suppkey % 3 = 0 then '공영 ' else 'Lot ' end, cast(s_suppkey % 37 as string)) as lot_name,
       concat('대구광역시 중구 ', cast(s_suppkey % 90 as string)) as addr,
       case when s_suppkey % 4 = 0 then '전일' else '시간제' end as oper_type,
       case when s_suppkey % 4 = 0 and s_suppkey % 8 = 0 then null else '0900' end as open_hr,
       case when s_suppkey % 4 = 0 and s_suppkey % 8 = 0 then null else '1800' end as close_hr,
       cast(35600 + (s_suppkey * 61) % 600 as double) / 1000 as lat, cast(128300 + (s_suppkey * 29) % 600 as double) / 1000 as lng
from {supplier}""",
    "v_pois": """
select concat('P', cast(p_partkey as string)) as poi_id, p_type as poi_type, p_name as poi_name,
       cast(35600 + (p_partkey * 17) % 600 as double) / 1000 as lat, cast(128300 + (p_partkey * 41) % 600 as double) / 1000 as lng
from {part}""",
    "v_lot_ticks": """
select concat('L', cast(l_suppkey as string)) as lot_id, l_shipdate as collected_at, l_orderkey, l_linenumber, l_partkey,
       l_quantity as remaining_spaces, 50 + l_suppkey % 200 as total_spaces
from {lineitem}""",
    # realtime parking inside the month of the polls
    "v_lot_realtime": """
select event_id as id, concat('L', cast(user_id % 40 as string)) as lot_id, ts as collected_at,
       cast(floor(value) as bigint) - 2 as remaining_spaces, 50 + user_id % 40 as total_spaces,
       case when event_id % 9 = 0 then null else 1 - (floor(value) - 2) / (50 + user_id % 40) + case when event_id % 31 = 0 then 0.2 else 0 end end as occupancy_rate,
       case event_type when 'click' then '여유' when 'view' then '보통' when 'purchase' then '혼잡' else '만차' end as congestion_status
from {events}""",
    "v_usage_daily": """
select concat('S', cast(cast(floor(o_custkey / 3.0) as bigint) as string)) as station_id,
       concat('0', cast(o_custkey % 3 as string)) as charger_id,
       case o_custkey % 2 when 0 then 'fast' else 'slow' end as charger_type,
       cast(o_orderdate as date) as use_date, count(*) as sessions, sum(round(o_totalprice)) / 1000 as kwh
from {orders} group by 1, 2, 3, 4""",
    # municipal stations, a little off the charging stations they belong to
    "v_usage_stations": """
select distinct concat('S', cast(k as string)) as station_id,
       cast(356000 + ((k * 37) % 600) * 10 + (k % 4) * 4 as double) / 10000 as lat, cast(128300 + (k * 53) % 600 as double) / 1000 as lng
from (select cast(floor(o_custkey / 3.0) as bigint) as k from {orders}) as o""",
    "v_links": """
select concat('K', cast(p_partkey as string)) as link_id, concat('Road ', cast(p_partkey % 23 as string)) as road_name,
       cast(p_size * 10 as string) as distance_m_text,
       case when p_partkey % 41 = 0 then '-5' when p_partkey % 43 = 0 then 'n/a' else cast(10 + p_partkey % 70 as string) end as speed_text,
       cast(p_size % 50 as string) as travel_text,
       cast(1 + p_partkey % 3 as string) as cong_grade,
       case p_partkey % 4 when 0 then '원활' when 1 then '지체' when 2 then '정체' else null end as cong_name,
       cast(35600 + (p_partkey * 17) % 600 as double) / 1000 as lat, cast(128300 + (p_partkey * 41) % 600 as double) / 1000 as lng
from {part}""",
    "v_link_ticks": """
select concat('K', cast(user_id as string)) as link_id, concat('Road ', cast(user_id % 23 as string)) as road_name,
       date_trunc('hour', ts) as tick_ts, event_id,
       case when event_id % 17 = 0 then null else round(value) end as speed_kph,
       case event_type when 'click' then '1' when 'view' then '2.0' when 'purchase' then ' 3' when 'signup' then '-' else null end as cong_grade
from {events}""",
    "v_incidents": """
select concat('I', cast(cast(floor(event_id / 3.0) as bigint) as string)) as incident_id, event_id, ts as start_ts,
       case when event_id % 37 = 0 then ts - interval '1' hour else ts + interval '3' hour end as end_ts,
       date_trunc('hour', ts) as tick_ts,
       concat(case event_type when 'click' then '교통사고 발생' when 'view' then '도로 공사' when 'purchase' then '행사 통제' when 'signup' then '차량 고장' else '기타 상황' end, ' ', cast(user_id as string)) as title,
       concat('Road ', cast(user_id % 23 as string)) as road_name,
       case user_id % 4 when 0 then '대구광역시 중구' when 1 then '경상북도 경산시' when 2 then null else '대구 북구' end as addr,
       case when event_id % 19 = 0 then null else concat('K', cast(user_id * 3 as string)) end as link_id,
       cast(35600 + (user_id * 23) % 600 as double) / 1000 as lat, cast(128300 + (user_id * 47) % 800 as double) / 1000 as lng
from {events}""",
    "v_weather": """
select concat('2024', lpad(cast(1 + l_partkey % 12 as string), 2, '0'), lpad(cast(1 + l_suppkey % 28 as string), 2, '0')) as base_date,
       cast((l_linenumber % 4) * 300 + 200 as string) as base_time,
       concat('2024', lpad(cast(1 + l_partkey % 12 as string), 2, '0'), lpad(cast(1 + l_orderkey % 28 as string), 2, '0')) as fcst_date,
       cast((l_orderkey % 24) * 100 as string) as fcst_time,
       case l_orderkey % 6 when 0 then 'TMP' when 1 then 'PCP' when 2 then 'SKY' when 3 then 'REH' when 4 then 'SNO' else 'WSD' end as category,
       '89' as nx, cast(90 + l_suppkey % 2 as string) as ny, l_orderkey, l_linenumber, l_partkey,
       case when l_orderkey % 6 in (1, 4) then case l_quantity % 4 when 0 then '강수없음' when 1 then '1mm 미만' when 2 then concat(cast(cast(l_quantity as bigint) as string), '.5 mm') else 'odd' end
            when l_orderkey % 211 = 0 then 'x' else cast(cast(l_quantity as bigint) as string) end as fcst_value
from {lineitem}""",
    # charging sessions as exported by a provider
    "v_sessions": """
select o_orderkey as session_id,
       concat(case when o_custkey % 5 = 0 then ' ' else '' end, '공영 ', cast(cast(floor(o_custkey / 3.0) as bigint) as string), case when o_custkey % 2 = 0 then '충전소' else '' end) as station_name,
       case o_custkey % 9 when 0 then '부산광역시' else '대구광역시' end as region,
       case o_custkey % 7 when 1 then '경북 대구로 1' else concat('대구광역시 ', case o_custkey % 3 when 0 then '중구' when 1 then '북구' else '수성구' end, ' 1') end as addr,
       o_orderdate + interval '1' minute * cast((o_orderkey * 37) % 1440 as int) as start_ts,
       o_orderdate + interval '1' minute * cast((o_orderkey * 37) % 1440 + 15 + o_custkey % 200 as int) as end_ts,
       concat(cast(cast(floor((o_orderkey % 700) / 60.0) as bigint) as string), ':', lpad(cast((o_orderkey % 700) % 60 as string), 2, '0'), ':30') as duration_text,
       case o_orderpriority when '1-URGENT' then '급속(50kW)' when '2-HIGH' then '100kW' when '3-MEDIUM' then '완속 7 kW' when '4-NOT SPECIFIED' then '200KW' else '-' end as capacity,
       round(o_totalprice) / 1000 as kwh
from {orders}""",
    "v_tour": """
select concat('T', cast(p_partkey as string)) as content_id, p_name as title,
       case when p_partkey % 5 = 0 then null else concat('대구광역시 ', cast(p_partkey % 40 as string)) end as addr1,
       case when p_partkey % 3 = 0 then null else concat(cast(p_size as string), '층') end as addr2,
       cast(35600 + (p_partkey * 17) % 600 as string) as mapy_text,
       case when p_partkey % 53 = 0 then 'none' else cast(128300 + (p_partkey * 41) % 600 as string) end as mapx_text,
       case when p_partkey % 4 = 0 then null else 'http://img' end as first_image
from {part}""",
    "v_parks": """
select concat('G', cast(s_suppkey as string)) as mng_no, concat('park ', cast(s_suppkey % 31 as string)) as park_name,
       case s_suppkey % 3 when 0 then null else concat('도로 ', cast(s_suppkey as string)) end as road_addr,
       case s_suppkey % 4 when 1 then null else concat('지번 ', cast(s_suppkey as string)) end as lot_addr,
       case when s_suppkey % 29 = 3 then cast(0 as double) else cast(35600 + (s_suppkey * 61) % 600 as double) / 1000 end as lat,
       cast(128300 + (s_suppkey * 29) % 600 as double) / 1000 as lng
from {supplier}""",
    "v_city_tour": """
select p_partkey as row_id, case p_partkey % 3 when 0 then p_name when 1 then concat(p_name, ' park') else replace(p_name, ' ', '') end as attract_name,
       concat('  대구  ', cast(p_size as string)) as address,
       concat('입장료|', cast(p_size as string)) as attr01, case p_partkey % 2 when 0 then '휴무일| ' else concat('휴무일|', p_brand) end as attr02,
       case p_partkey % 5 when 0 then 'broken' else concat(' 이용 시간 | ', p_type) end as attr03
from {part}""",
    "v_tariffs": """
select concat('202', cast(n_nationkey % 3 + 4 as string), '0', cast(1 + n_nationkey % 9 as string)) as month, n_nationkey as tariff_id,
       case n_regionkey when 0 then 'AUTOMOBILE' when 1 then 'BUILDING CO' when 2 then 'FURNI' when 3 then 'MACHINERY' else n_name end as operator_name,
       cast(200 + n_nationkey * 7 as double) as fee_krw
from {nation}""",
    "v_lot_payloads": """
select s_suppkey as id, case s_suppkey % 2 when 0 then 'parking_info' else 'parking_realtime' end as api_type, case when s_suppkey % 23 = 5 then '<broken' else
  replace(replace(concat('<"data":[<"prkInfo":<"pkltId":"L', cast(s_suppkey as string), '","pkltNm":"', s_name, '">,"prkFcltInfo":<"roadNmAddr":', case s_suppkey % 3 when 0 then 'null' else '"road 1"' end,
    ',"lotnoAddr":"lot 2","lat":"35.', cast(s_suppkey % 10 as string), '","lot":"128.', cast(s_suppkey % 10 as string), '","prkNocmprt":"', cast(50 + s_suppkey % 200 as string),
    '">,"prkOperInfo":<"wkdayOperBgngHr":"0900","gnrlFrstCrg":"', case s_suppkey % 4 when 0 then '' else cast(s_suppkey * 10 as string) end, '","stlmMthd":"card">,"rltmPrkInfo":<"pkltId":"L', cast(s_suppkey as string),
    '","totPrkNocmprt":"', cast(s_suppkey % 5 * 40 as string), '","totRmndPrkNocmprt":"', cast(s_suppkey % 37 as string), '","prkCnfSttsCd":"', cast(s_nationkey % 4 as string), '">>,',
    '<"rltmPrkInfo":<"pkltId":"M', cast(s_suppkey as string), '","totPrkNocmprt":"80","totRmndPrkNocmprt":null>,"prkInfo":<"pkltId":"M', cast(s_suppkey as string), '">>]>'), '<', chr(123)), '>', chr(125)) end as payload
from {supplier}""",
    "v_nodes": """
select s_suppkey as node_id, cast(35600 + (s_suppkey * 61) % 600 as double) / 1000 as lat,
       cast(128300 + (s_suppkey * 29) % 600 as double) / 1000 as lng from {supplier}""",
    "v_node_links": """
select concat('K', cast(l_partkey as string)) as link_id, min(l_suppkey) as f_node, max(l_suppkey) + 3 as t_node from {lineitem} group by l_partkey""",
    "v_polylines": """
select l_orderkey as line_id, l_linenumber as seq, min(l_quantity) as x, min(cast(l_partkey % 100 as double)) as y
from {lineitem} group by l_orderkey, l_linenumber""",
    "v_vehicles": """
select n_name as model_name, cast(40 + n_nationkey as double) as battery_kwh, cast(250 + n_nationkey * 10 as double) as range_km,
       case when n_nationkey % 6 = 0 then cast(77 as double) else null end as fixed_kwh from {nation}""",
    "v_routes": """
select concat('R', cast(s_suppkey as string)) as route_id, cast(5 + s_suppkey % 120 as double) as distance_km from {supplier}""",
    "v_bms": """
select concat('V', cast(user_id as string)) as vehicle_id, ts, event_id, round(100 - cast((event_id * 7) % 97 as double), 1) as soc,
       round(value) as speed_kph, cast(event_id as double) as odometer_km from {events}""",
    "v_station_eta": """
select distinct concat('S', cast(cast(floor(c_custkey / 3.0) as bigint) as string)) as station_id,
       case when cast(floor(c_custkey / 3.0) as bigint) % 4 = 3 then null
            else cast(1 + (cast(floor(c_custkey / 3.0) as bigint) * 7) % 45 as double) end as eta_minutes,
       cast(1 + (cast(floor(c_custkey / 3.0) as bigint) * 13) % 29 as double) / 2 as road_km,
       cast(1 + (cast(floor(c_custkey / 3.0) as bigint) * 13) % 27 as double) / 3 as straight_km
from {customer}""",
    # scored, labelled rows for rank statistics
    "v_scored": """
select l_orderkey * 10 + l_linenumber as row_key, l_partkey, l_suppkey, cast(l_shipdate as date) as block_date,
       case when l_returnflag = 'R' then 1 else 0 end as y,
       case l_suppkey % 4 when 0 then 5 when 1 then 10 when 2 then 15 else 30 end as horizon,
       case when l_suppkey % 7 = 0 then null else l_quantity end as f_quantity, l_discount as f_discount, round(l_extendedprice / 100) as f_price,
       l_tax as f_tax, cast(1 as double) as f_const,
       (cast(l_partkey * 7 % 100 as double) + 0.5) / 100 as score
from {lineitem}""",
}

ORACLE_CTES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables and the derived views of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in GIVEN and name not in VIEW_SQL):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._given(name) if name in GIVEN else self._view(name)
        return self._frames[name]

    def _given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        text = VIEW_SQL[name]
        inputs = {n: getattr(self, n) for n in [*GIVEN, *VIEW_SQL] if "{" + n + "}" in text}
        df = self.spark.sql(text, **inputs)
        zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    @cached_property
    def input_files(self) -> dict[str, str]:
        return {n: f"{self.sf_dir}/{n}.parquet" for n in GIVEN}
