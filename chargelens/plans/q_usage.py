"""Usage history, sessions, parking history, D1 assembly and candidates."""
from pyspark.sql import functions as F

import chargelens.plans.q_clean  # noqa: F401
from chargelens.operators import candidates, clean, snapshots, spatial, usage
from chargelens.plans.q_spatial import hav, nearest_sql, stations
from chargelens.plans.registry import query
from chargelens.plans.station_snapshot import d1, matched_usage, usage_station_rows
from chargelens.sources.views import ORACLE_CTES

ORACLE_CTES.update({
    "x_usage_match": "select station_id, matched_id from (" + nearest_sql("v_usage_stations", "station_id", "(select station_id as charge_station_id, lat, lng from x_stations)", "charge_station_id", 80) + ") where matched",
    "x_usage": "select u.* replace (m.matched_id as station_id) from v_usage_daily u join x_usage_match m using (station_id)",
    "x_usage_day": "select station_id, charger_type, use_date, isodow(use_date) - 1 as dow, sum(sessions) as sessions, sum(kwh) as kwh from x_usage group by 1, 2, 3",
    "x_usage_feat": """
select f.*, n.n_chargers, avg_sessions_all / n_chargers as sessions_per_charger, avg_sessions_28d / n_chargers as sessions_per_charger_28d, avg_kwh / avg_sessions_all as kwh_per_session from (
  select station_id, charger_type, avg(sessions) as avg_sessions_all, avg(kwh) as avg_kwh, count(*) as n_days, avg(sessions) filter (dow < 5) as weekday_avg_sessions, avg(sessions) filter (dow >= 5) as weekend_avg_sessions,
    avg(sessions) filter (use_date >= mx - 6) as avg_sessions_7d, avg(sessions) filter (use_date >= mx - 27) as avg_sessions_28d, avg(kwh) filter (use_date >= mx - 27) as avg_kwh_28d,
    """ + ", ".join(f"avg(sessions) filter (dow = {d}) as same_dow_{d}_avg_sessions" for d in range(7)) + """
  from x_usage_day, (select max(use_date) as mx from x_usage) group by 1, 2) f
join (select station_id, charger_type, count(distinct charger_id) as n_chargers from x_usage group by 1, 2) n using (station_id, charger_type)""",
    "x_usage_level": """
select *, case when (rn - 1) * 3 <= n - 1 then '적음' when (rn - 1) * 3 <= 2 * (n - 1) then '보통' else '많음' end as usage_level, (rk + (ties - 1) / 2.0) / n as usage_percentile from (
  select *, row_number() over (partition by charger_type order by sessions_per_charger, station_id) as rn, rank() over (partition by charger_type order by sessions_per_charger) as rk,
    count(*) over (partition by charger_type, sessions_per_charger) as ties, count(*) over (partition by charger_type) as n from x_usage_feat)""",
    "x_usage_station": "select station_id, usage_level, sessions_per_charger, weekday_avg_sessions as usage_weekday_avg, weekend_avg_sessions as usage_weekend_avg, charger_type as usage_charger_type from (select *, row_number() over (partition by station_id order by sessions_per_charger desc, charger_type) as r from x_usage_level) where r = 1",
})
FEATS = "avg_sessions_all weekday_avg_sessions weekend_avg_sessions avg_sessions_7d avg_sessions_28d avg_kwh_28d sessions_per_charger sessions_per_charger_28d kwh_per_session " + " ".join(f"same_dow_{d}_avg_sessions" for d in range(7))


@query("f10_usage_features", "select * exclude (avg_kwh) from x_usage_feat", num=FEATS)
def _(t):
    return usage.usage_features(matched_usage(t))


@query("f11_usage_level_and_percentile", "select station_id, charger_type, sessions_per_charger, usage_level, usage_percentile from x_usage_level", num="sessions_per_charger usage_percentile")
def _(t):
    return usage.usage_levels(usage.usage_features(matched_usage(t))).select("station_id", "charger_type", "sessions_per_charger", "usage_level", "usage_percentile")


@query("f12_usage_per_station", "select *, true as history_observed from x_usage_station", num="sessions_per_charger usage_weekday_avg usage_weekend_avg")
def _(t):
    return usage_station_rows(t)


LOT_HOUR = """
select lot_id, stddev_pop(remaining_spaces) as parking_remaining_std_1h, cast(arg_max(remaining_spaces, (collected_at, id)) - arg_min(remaining_spaces, (collected_at, id)) as double) as parking_remaining_delta_1h, count(*) as parking_realtime_ticks_1h
from v_lot_realtime, {asof} where collected_at >= as_of - interval '1' hour and collected_at <= as_of group by 1"""


@query("f14_lot_hour_features", LOT_HOUR.format(asof="(select max(collected_at) as as_of from v_lot_realtime)"), num="parking_remaining_std_1h parking_remaining_delta_1h")
def _(t):
    r = t.v_lot_realtime
    return usage.lot_hour_features(r, r.agg(F.max("collected_at")).scalar())


@query("f15_parking_batches", """
select date_trunc('hour', collected_at) as batch, avg(occupancy_rate) as occ_mean, median(occupancy_rate) as occ_median, count(distinct lot_id) as lots,
""" + ", ".join(f"count(*) filter (congestion_status = '{c}') * 100.0 / count(congestion_status) as pct_{i}" for i, c in enumerate(usage.CONGESTION_LABELS)) + " from v_lot_realtime group by 1", num="occ_mean occ_median pct_0 pct_1 pct_2 pct_3", ts="batch")
def _(t):
    return usage.parking_batches(t.v_lot_realtime)


@query("f15_parking_lot_profile", "select lot_id, count(*) as observations, avg(occupancy_rate) as occupancy_mean, median(occupancy_rate) as occupancy_median, avg(remaining_spaces) as remaining_mean from v_lot_realtime group by 1", num="occupancy_mean occupancy_median remaining_mean")
def _(t):
    return usage.parking_by(t.v_lot_realtime, ["lot_id"])


@query("f15_parking_hour_profile", "select extract(hour from collected_at) as hour, count(*) as observations, avg(occupancy_rate) as occupancy_mean, median(occupancy_rate) as occupancy_median, avg(remaining_spaces) as remaining_mean from v_lot_realtime group by 1", num="occupancy_mean occupancy_median remaining_mean")
def _(t):
    return usage.parking_by(t.v_lot_realtime.withColumn("hour", F.hour("collected_at")), ["hour"])


ORACLE_CTES["x_fleet_day"] = "select use_date, cast(sum(sessions) as bigint) as sessions, sum(kwh) as kwh, count(distinct (station_id, charger_id)) as chargers, count(distinct station_id) as stations from v_usage_daily group by 1"


@query("f19_fleet_daily_usage", "select * replace (cast(use_date as string) as use_date) from x_fleet_day", num="kwh")
def _(t):
    return usage.fleet_daily(t.v_usage_daily)


@query("f19_usage_breakdown", " union all ".join(f"select '{k}' as kind, cast({e} as string) as bucket, avg(sessions) as sessions_mean, avg(kwh) as kwh_mean, count(*) as n_rows from v_usage_daily group by 1, 2" for k, e in (("weekday", "isodow(use_date) - 1"), ("month", "extract(month from use_date)"), ("type", "charger_type"))), num="sessions_mean kwh_mean")
def _(t):
    return usage.usage_breakdown(t.v_usage_daily)


@query("f19_usage_volatility", "select station_id, stddev_samp(s) as sessions_std, avg(s) as sessions_mean, count(*) as days from (select station_id, use_date, sum(sessions) as s from v_usage_daily group by 1, 2) group by 1", num="sessions_std sessions_mean")
def _(t):
    return usage.usage_volatility(t.v_usage_daily)


@query("f19_usage_summary", "select corr(sessions, kwh) as sessions_kwh_corr, count(*) filter (sessions = 0) as zero_session_rows, count(distinct use_date) as distinct_dates, max(use_date) - min(use_date) + 1 as span_days from v_usage_daily", num="sessions_kwh_corr")
def _(t):
    return usage.usage_summary(t.v_usage_daily)


@query("g1_moving_means", "select cast(use_date as string) as use_date, sessions, avg(sessions) over (order by use_date rows 6 preceding) as sessions_ma7, avg(sessions) over (order by use_date rows 27 preceding) as sessions_ma28 from x_fleet_day", num="sessions_ma7 sessions_ma28")
def _(t):
    return usage.moving_means(usage.fleet_daily(t.v_usage_daily)).select("use_date", "sessions", "sessions_ma7", "sessions_ma28")


@query("g6_station_ranking", "select station_id, cast(s as bigint) as sessions, row_number() over (order by s desc, station_id) as rank from (select station_id, sum(sessions) as s from v_usage_daily group by 1) order by 3 limit 50")
def _(t):
    return usage.station_ranking(t.v_usage_daily)


ORACLE_CTES["x_poi_links"] = f"""
select poi_id, station_id, distance_m from (
  select *, min(distance_m) over (partition by poi_id) <= 500 as near, row_number() over (partition by poi_id order by distance_m, station_id) as rn
  from (select a.poi_id, b.station_id, {hav('a', 'b')} as distance_m from v_pois a, x_stations b where b.lat is not null)) where case when near then rn <= 8 and distance_m <= 500 else rn <= 3 end"""


@query("f20_day_type_lift", """
with d as (select *, case when strftime(use_date, '%m-%d') in ('01-01', '03-01', '05-05', '06-06', '08-15', '10-03', '10-09', '12-25') then 'holiday' when isodow(use_date) >= 6 then 'weekend' else 'weekday' end as t
  from (select station_id, use_date, sum(sessions) as s from v_usage_daily group by 1, 2)),
p as (select station_id, count(*) as has_usage_days, avg(s) filter (t = 'weekday') as wd, avg(s) filter (t = 'weekend') as we, avg(s) filter (t = 'holiday') as ho from d group by 1)
select poi_id, station_id, coalesce(has_usage_days, 0) as has_usage_days, wd as sessions_mean_weekday, we as sessions_mean_weekend, ho as sessions_mean_holiday, ho / wd as holiday_vs_weekday, we / wd as weekend_vs_weekday,
  ho / (select avg(s) from d where t = 'holiday') as holiday_vs_control from x_poi_links left join p using (station_id)""", num="sessions_mean_weekday sessions_mean_weekend sessions_mean_holiday holiday_vs_weekday weekend_vs_weekday holiday_vs_control")
def _(t):
    links = spatial.linked_stations(t.v_pois, stations(t)).select("poi_id", "station_id")
    return usage.day_type_lift(links, t.v_usage_daily)


HOLIDAY_SQL = f"strftime(use_date, '%m-%d') in {usage.HOLIDAYS} or strftime(use_date, '%Y-%m-%d') in {usage.MOVING_HOLIDAYS}"


@query("f20_poi_day_types", f"""
with d as (select station_id, use_date, sum(sessions) as s from v_usage_daily group by 1, 2),
per as (select poi_id, use_date, avg(s) as s, case when {HOLIDAY_SQL} then 'holiday' when isodow(use_date) >= 6 then 'weekend' else 'weekday' end as t from x_poi_links join d using (station_id) group by 1, 2),
g as (select poi_id, avg(s) filter (t = 'weekday') as wd, avg(s) filter (t = 'weekend') as we, avg(s) filter (t = 'holiday') as ho, count(*) as n from per group by 1),
u as (select poi_id, count(*) as linked_stations, count(k.station_id) as linked_with_usage from x_poi_links l left join (select distinct station_id from d) k using (station_id) group by 1)
select poi_id, linked_stations, linked_with_usage, wd as sessions_mean_weekday, we as sessions_mean_weekend, ho as sessions_mean_holiday, coalesce(n, 0) as usage_days, ho / wd as holiday_vs_weekday, we / wd as weekend_vs_weekday from u left join g using (poi_id)""",
       num="sessions_mean_weekday sessions_mean_weekend sessions_mean_holiday holiday_vs_weekday weekend_vs_weekday")
def _(t):
    return usage.poi_day_types(spatial.linked_stations(t.v_pois, stations(t)).select("poi_id", "station_id"), t.v_usage_daily)


ORACLE_CTES["x_named_sessions"] = """
select s.*, n.station_id from v_sessions s join (select lower(regexp_replace(station_name, '[ ()_]', '', 'g')) as k, min(station_id) as station_id from x_stations group by 1) n
  on lower(regexp_replace(regexp_replace(s.station_name, '충전소$', ''), '[ ()_]', '', 'g')) = n.k"""


@query("n22_session_station_names", "select session_id, station_id from x_named_sessions")
def _(t):
    return usage.session_stations(t.v_sessions, stations(t)).select("session_id", "station_id")


@query("f21_session_profile", """
with g as (select station_id, isodow(start_ts) - 1 as dow, extract(hour from start_ts) as hour, count(*) as session_count, sum(kwh) as total_kwh, avg(kwh) as avg_kwh, sum(d) as total_duration_min, avg(d) as avg_duration_min
  from (select *, least(greatest(epoch(end_ts - start_ts) / 60.0, 0), 720) as d from x_named_sessions) group by 1, 2, 3)
select *, (total_duration_min - min(total_duration_min) over ()) / (max(total_duration_min) over () - min(total_duration_min) over ()) * 100 as demand_score from g""", num="total_kwh avg_kwh total_duration_min avg_duration_min demand_score")
def _(t):
    return usage.session_profile(usage.session_stations(t.v_sessions, stations(t)))


def enriched(t):
    return clean.enrich_sessions(clean.city_sessions(t.v_sessions))


@query("f22_session_summary", """
with h as (select dow, hour, count(*) as n from x_sessions group by 1, 2 order by n desc, dow, hour limit 1)
select count(*) as n_sessions, count(distinct station_key) as n_stations, sum(kwh) as kwh_total, avg(kwh) as kwh_mean, avg(minutes) as min_mean, count(*) filter (g > 5) as mismatch_gt5, count(*) filter (g > 60) as mismatch_gt60,
  avg(case when is_weekend then 1.0 else 0 end) as weekend_share, (select dow from h) as peak_dow, (select hour from h) as peak_hour, median(kwh) as kwh_median from (select *, abs(epoch(end_ts - start_ts) / 60.0 - minutes) as g from x_sessions)""", num="kwh_total kwh_mean min_mean weekend_share kwh_median")
def _(t):
    return usage.session_summary(enriched(t))


@query("f22_session_counts", """
select 'month' as kind, strftime(start_ts, '%Y-%m') as bucket, count(*) as n from x_sessions group by 1, 2
union all select 'hour', cast(h as string), count(session_id) from range(24) r(h) left join x_sessions on hour = h group by 1, 2
union all select 'district', split_part(station_key, '|', 2), count(*) from x_sessions group by 1, 2
union all select 'capacity', case capacity when '급속(50kW)' then '50kW' when '100kW' then '100kW' when '완속 7 kW' then '50kW' when '200KW' then '200kW' else 'unknown' end, count(*) from x_sessions group by 1, 2""")
def _(t):
    return usage.session_counts(enriched(t), clean.kw_bucket(F.col("capacity")))


# opening state at the newest poll: Wednesday 31 January 2024, midnight, on every scale
ORACLE_CTES["x_open_now"] = """
select station_id, use_time, case when use_time in ('24시간', '00:00~24:00') then 'Y' when use_time in ('비개방', '개방불가') then 'N' when use_time in ('매장 영업시간', '09:00~18:00, 10:00~16:00') or use_time is null then 'UNKNOWN'
  when use_time = '19:00~08:00' then case when m >= 1140 or m < 480 then 'Y' else 'N' end when use_time = '05:00~익일 01:00' then case when m >= 300 or m < 60 then 'Y' else 'N' end
  when use_time = '09시~23시' then case when m >= 540 and m < 1380 then 'Y' else 'N' end when use_time = '평일 08:00~20:00, 주말 휴무' then case when not we and m >= 480 and m < 1200 then 'Y' else 'N' end
  when use_time = '8~18시' then case when m >= 480 and m < 1080 then 'Y' else 'N' end when use_time = '09:00~18:00' then case when m >= 540 and m < 1080 then 'Y' else 'N' end
  else case when m >= 540 and m < case when we then 0 else 1080 end then 'Y' when we and m >= 600 and m < 840 then 'Y' else 'N' end end as is_operating_now
from x_stations, (select extract(hour from as_of) * 60 + extract(minute from as_of) as m, isodow(as_of) >= 6 as we from x_asof)"""
ORACLE_CTES["x_d1"] = f"""
select a.station_id, a.station_name, a.addr, a.lat, a.lng, a.access_restricted, a.name_suggests_residential, a.recommend_public_default, o.is_operating_now, i.coord_ok,
  s.total_chargers, s.available_count, s.observed_count, s.unobserved_count, s.availability_ratio_observed, s.unobserved_rate, s.has_confirmed_available, s.status_age_minutes, s.observation_age_minutes,
  s.reliability_grade, s.observation_grade, s.reliability_grade_effective, s.observation_state, l.matched_id as parking_matched_id, l.distance_m as nearest_parking_m, cast(ln.remaining_spaces as double) as parking_remaining_spaces, ln.occupancy_rate as parking_occupancy_rate,
  ln.congestion_status as parking_congestion_status, lh.parking_remaining_std_1h, lh.parking_remaining_delta_1h, n.distance_m as nearest_incident_m, coalesce(p.poi_count_1km, 0) as poi_count_1km,
  l.total_spaces as parking_total_spaces, ln.lot_id is not null as parking_has_realtime, lh.parking_realtime_ticks_1h, k.matched_id as nearest_link_id, k.distance_m as nearest_link_m, k.speed_kph as link_speed_kph, k.link_cong_grade, k.cong_name as link_cong_grade_nm,
  (select max(limit_yn) from v_charger_master m where m.station_id = a.station_id) as limit_yn, cast(null as double) as eta_minutes, false as parking_is_mock, 'lots' as parking_source, false as traffic_is_mock, 'incidents' as traffic_source, 'status_polls' as source_status, 'd1.2' as schema_version,
  u.usage_level, u.sessions_per_charger, u.usage_weekday_avg, u.usage_weekend_avg, u.usage_charger_type, u.station_id is not null as history_observed, x_asof.as_of as as_of_ts
from x_access a cross join x_asof join x_open_now o using (station_id) join (select station_id, coordinate_quality_flag = 'OK' as coord_ok from (select *, row_number() over (partition by station_id order by charger_id) as rr from x_info) where rr = 1) i using (station_id)
left join x_station_status s using (station_id) left join (select n.*, v.total_spaces from x_near_lot n left join v_lots v on v.lot_id = n.matched_id) l using (station_id) left join x_lot_now ln on ln.lot_id = l.matched_id left join ({LOT_HOUR.format(asof='x_asof')}) lh on lh.lot_id = l.matched_id
left join x_near_incident n using (station_id) left join (select station_id, count(*) as poi_count_1km from (select station_id from x_near_poi where matched union all select station_id from x_near_park where matched) group by 1) p using (station_id)
left join (select n.*, s.speed_kph, s.cong_grade as link_cong_grade, v.cong_name from x_near_link n left join x_speed_links s on s.link_id = n.matched_id left join v_links v on v.link_id = n.matched_id) k using (station_id)
left join x_usage_station u using (station_id)"""
D1_NUM = "nearest_link_m link_speed_kph eta_minutes parking_realtime_ticks_1h parking_total_spaces lat lng availability_ratio_observed unobserved_rate status_age_minutes observation_age_minutes nearest_parking_m parking_remaining_spaces parking_occupancy_rate parking_remaining_std_1h parking_remaining_delta_1h nearest_incident_m sessions_per_charger usage_weekday_avg usage_weekend_avg"


@query("n23_station_snapshot_d1", "select * from x_d1", num=D1_NUM, ts="as_of_ts")
def _(t):
    return d1(t).drop("use_time", "busi_nm")


ORIGIN = (35.871, 128.601)


@query("g7_candidate_list", f"""
select station_id, tier, distance_m, available_count, total_chargers, reliability_grade_effective, is_operating_now, row_number() over (order by tier, distance_m, available_count desc, station_id) as display_rank from (
  select *, case when reliability_grade_effective in ('HIGH', 'NORMAL') and is_operating_now = 'Y' then 'A' else 'B' end as tier, {hav('o', 'd')} as distance_m from x_d1 d, (select cast(35.871 as double) as lat, cast(128.601 as double) as lng) o
  where recommend_public_default and coord_ok and d.lat is not null and has_confirmed_available and is_operating_now <> 'N') order by display_rank limit 30""", num="distance_m")
def _(t):
    return candidates.candidate_list(d1(t), *ORIGIN, 30).select("station_id", "tier", "distance_m", "available_count", "total_chargers", "reliability_grade_effective", "is_operating_now", "display_rank")


@query("g7_candidate_funnel", """
with f as (select recommend_public_default as p, coord_ok and lat is not null as c, coalesce(has_confirmed_available, false) as a, is_operating_now <> 'N' as o from x_d1)
select 'all' as stage, count(*) as stations from f union all select 'public', count(*) from f where p union all select 'located', count(*) from f where p and c union all select 'available', count(*) from f where p and c and a
union all select 'listed', count(*) from f where p and c and a and o union all select 'rejected_access_restricted', count(*) from f where not p union all select 'rejected_coordinate', count(*) from f where p and not c
union all select 'rejected_no_available', count(*) from f where p and c and not a union all select 'rejected_closed', count(*) from f where p and c and a and not o""")
def _(t):
    return candidates.candidate_funnel(d1(t))


@query("g8_candidate_evidence", f"""
select station_id, concat(coalesce(array_to_string(list_transform(list_sort([e for e in pros if e.t is not null]), lambda e: e.t), '; '), ''), ' | ', coalesce(array_to_string(list_transform(list_sort([e for e in cons if e.t is not null]), lambda e: e.t), '; '), '')) as evidence from (
  select station_id, [{{'w': -available_count * 10, 't': case when available_count > 0 then available_count || ' of ' || total_chargers || ' free' end}}, {{'w': -9, 't': case when age <= 15 then 'seen ' || cast(round(age) as bigint) || ' min ago' end}},
    {{'w': -5, 't': case when parking_remaining_spaces > 0 then cast(parking_remaining_spaces as bigint) || ' parking spaces at ' || cast(round(nearest_parking_m) as bigint) || 'm' end}}, {{'w': -3, 't': case when usage_level = 'LOW' then 'rarely busy' end}}] as pros,
   [{{'w': -8, 't': case when is_operating_now = 'UNKNOWN' then 'opening hours unclear' end}}, {{'w': -7, 't': case when age is null or age > 15 then 'state is old' end}}, {{'w': -6, 't': case when parking_remaining_spaces <= 0 then 'parking full' end}},
    {{'w': -4, 't': case when nearest_incident_m <= 500 then 'road incident at ' || cast(round(nearest_incident_m) as bigint) || 'm' end}}, {{'w': -2, 't': case when total_chargers = 1 then 'no second charger' end}}] as cons
  from (select d.*, least(status_age_minutes, observation_age_minutes) as age, case when reliability_grade_effective in ('HIGH', 'NORMAL') and is_operating_now = 'Y' then 'A' else 'B' end as tier, {hav('o', 'd')} as distance_m from x_d1 d, (select cast(35.871 as double) as lat, cast(128.601 as double) as lng) o
  where recommend_public_default and coord_ok and d.lat is not null and has_confirmed_available and is_operating_now <> 'N' order by tier, distance_m, available_count desc, station_id limit 30))""")
def _(t):
    return candidates.candidate_list(d1(t), *ORIGIN, 30).select("station_id", "evidence")


@query("g11_band_sample", f"""
with b as (select station_id, distance_km, case when distance_km < 2 then 0 when distance_km < 4 then 1 when distance_km < 6 then 2 when distance_km < 8 then 3 end as band from (
  select s.station_id, {hav('o', 's')} / 1000 as distance_km from x_stations s, (select cast(35.871 as double) as lat, cast(128.601 as double) as lng) o where s.lat is not null)),
r as (select *, row_number() over (partition by band order by distance_km, station_id) - 1 as i, count(*) over (partition by band) as n from b where band is not null)
select distinct r.station_id, r.band, r.distance_km from r, range(4) g(j) where j < least(4, n) and r.i = round_even(j * (n - 1) / cast(greatest(least(4, n) - 1, 1) as double), 0)""", num="distance_km")
def _(t):
    return candidates.band_sample(stations(t).where("lat is not null"), *ORIGIN, 4)


METRICS = ["total_chargers", "availability_ratio_observed", "status_age_minutes", "nearest_parking_m", "nearest_incident_m", "sessions_per_charger"]
ORACLE_CTES["x_metrics"] = " union all ".join(f"select station_id, '{m}' as metric, cast({m} as double) as value from x_d1" for m in METRICS)
ORACLE_CTES["x_fences"] = """
select *, case when abs(iqr) < 1e-12 then p01 else q1 - 1.5 * iqr end as lo_mild, case when abs(iqr) < 1e-12 then p99 else q3 + 1.5 * iqr end as hi_mild, case when abs(iqr) < 1e-12 then p01 else q1 - 3 * iqr end as lo_far, case when abs(iqr) < 1e-12 then p99 else q3 + 3 * iqr end as hi_far
from (select *, q3 - q1 as iqr from (select metric, quantile_cont(value, 0.01) as p01, quantile_cont(value, 0.25) as q1, median(value) as median, quantile_cont(value, 0.75) as q3, quantile_cont(value, 0.99) as p99 from x_metrics where value is not null group by 1))"""


@query("i12_iqr_outliers", """
select metric, count(*) as n, any_value(q1) as q1, any_value(f.median) as median, any_value(q3) as q3, any_value(iqr) as iqr, any_value(lo_mild) as lo_mild, any_value(hi_mild) as hi_mild, count(*) filter (value < lo_mild or value > hi_mild) as n_mild, count(*) filter (value < lo_far or value > hi_far) as n_far
from x_metrics join x_fences f using (metric) where value is not null group by 1""", num="q1 median q3 iqr lo_mild hi_mild")
def _(t):
    return candidates.iqr_summary(candidates.metric_rows(d1(t), "station_id", METRICS))


@query("g12_top_outliers", """
select * from (select metric, station_id, value, abs(value - f.median) as deviation, row_number() over (partition by metric order by abs(value - f.median) desc, station_id) as rank from x_metrics join x_fences f using (metric) where value < lo_mild or value > hi_mild) where rank <= 15""", num="value deviation")
def _(t):
    return candidates.top_outliers(candidates.metric_rows(d1(t), "station_id", METRICS), "station_id")
