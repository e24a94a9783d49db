"""Profiles by hour, weekday, size and freshness; traffic, incidents, vehicles; tick windows."""
from pyspark.sql import functions as F

import chargelens.plans.q_usage  # noqa: F401
from chargelens.operators import candidates, clean, panel, profiles, snapshots, station
from chargelens.plans.common import current_chargers, event_ticks, fleet, log_ticks
from chargelens.plans.q_clean import INCIDENT_TYPE_SQL
from chargelens.plans.q_spatial import stations
from chargelens.plans.registry import query
from chargelens.session import stage
from chargelens.sources.views import ORACLE_CTES


def d2_panel(t):
    """Panel read by several branches of a profile, so it is staged once."""
    return stage(panel.station_panel_d2(t.v_status_events, event_ticks(t)))


def status(t):
    return stage(station.station_status(current_chargers(t)))


ORACLE_CTES.update({
    "x_link_tick": """
select tick_ts, count(*) as links, count(*) filter (g = 1) * 100.0 / nullif(count(*) filter (g in (1, 2, 3)), 0) as pct_smooth, count(*) filter (g = 2) * 100.0 / nullif(count(*) filter (g in (1, 2, 3)), 0) as pct_slow,
  count(*) filter (g = 3) * 100.0 / nullif(count(*) filter (g in (1, 2, 3)), 0) as pct_jam, count(*) filter (g in (2, 3)) * 100.0 / nullif(count(*) filter (g in (1, 2, 3)), 0) as pct_congested, avg(speed_kph) as speed_mean, median(speed_kph) as speed_median
from (select *, try_cast(trim(cong_grade) as double) as g from v_link_ticks) group by 1""",
    "x_hour_union": "select h as hour, count(tick_ts) as ticks, count(distinct cast(tick_ts as date)) as days, avg(pct_congested) as pct_congested_mean, avg(speed_mean) as speed_mean from range(24) r(h) left join x_link_tick on extract(hour from tick_ts) = h group by 1",
    "x_unique_incidents": "select * from (select *, row_number() over (partition by incident_id order by start_ts desc, event_id desc) as r from v_incidents) where r = 1",
    "x_dwell": """
select *, epoch(lead(tick_ts) over (partition by station_id, charger_id order by tick_ts) - tick_ts) / 60.0 as dwell_minutes from (
  select *, lag(stat) over (partition by station_id, charger_id order by tick_ts) as p from x_dedup) where p is null or p <> stat""",
    "x_inventory": """
select e.*, t.prev_gap_s / 60.0 as gap_min, case when n_rows <= (select quantile_cont(n, 1.0 / 3) from (select count(*) as n from v_status_events group by tick_ts)) then 'small' when n_rows <= (select quantile_cont(n, 2.0 / 3) from (select count(*) as n from v_status_events group by tick_ts)) then 'medium' else 'large' end as size_class
from (select tick_ts, count(*) as n_rows, count(distinct station_id) as stations, count(distinct (station_id, charger_id)) as chargers, count(*) filter (stat = 2) as stat_2, count(*) filter (stat = 3) as stat_3, count(*) filter (stat not in (2, 3)) as stat_other from v_status_events group by 1) e
join x_ticks t using (tick_ts)""",
})


@query("f16_link_tick_summary", "select * from x_link_tick", num="pct_smooth pct_slow pct_jam pct_congested speed_mean speed_median", ts="tick_ts")
def _(t):
    return profiles.link_tick_summary(t.v_link_ticks, clean.grade_number(F.col("cong_grade")))


@query("f16_hour_union", "select * from x_hour_union", num="pct_congested_mean speed_mean")
def _(t):
    return profiles.hour_union(profiles.link_tick_summary(t.v_link_ticks, clean.grade_number(F.col("cong_grade"))))


@query("f17_traffic_beside_availability", "select hour, pct_congested_mean, u.speed_mean, a.availability_pct from x_hour_union u join (select hour, avg(availability_pct) as availability_pct from x_series group by 1) a using (hour) where pct_congested_mean is not null", num="pct_congested_mean speed_mean availability_pct")
def _(t):
    hours = profiles.hour_union(profiles.link_tick_summary(t.v_link_ticks, clean.grade_number(F.col("cong_grade"))))
    return profiles.traffic_beside_availability(hours, panel.hourly_availability(fleet(t)))


@query("f18_incident_ticks", "select tick_ts, count(*) as n, count(distinct incident_id) as n_unique from v_incidents group by 1", ts="tick_ts")
def _(t):
    return profiles.incident_ticks(t.v_incidents)


@query("f18_top_incident_roads", "select road_name as value, count(*) as n from x_unique_incidents group by 1 order by n desc, value limit 8")
def _(t):
    return profiles.top_values(snapshots.last_per_incident(t.v_incidents), F.col("road_name"))


@query("f18_top_incident_types", f"select {INCIDENT_TYPE_SQL} as value, count(*) as n from x_unique_incidents group by 1 order by n desc, value limit 8")
def _(t):
    return profiles.top_values(snapshots.last_per_incident(t.v_incidents), clean.incident_type(F.col("title")))


PROFILE = """
select {k}, count(*) as panel_rows, count(distinct tick_ts) as n_timestamps, count(distinct station_id) as n_stations, avg(availability_ratio_observed) as avail_mean, avg(case when has_confirmed_available then 1.0 else 0 end) as confirmed_rate,
  avg(in_use_count / cast(nullif(usable_known, 0) as double)) as in_use_rate_mean, median(availability_ratio_observed) as avail_median, count(distinct tick_ts) >= 2 and count(*) >= 5000 as analyzable from (select *, {e} as {k} from x_d2) group by 1"""
PROFILE_NUM = "avail_mean confirmed_rate in_use_rate_mean avail_median"


@query("f23_availability_by_hour", PROFILE.format(k="hour", e="extract(hour from tick_ts)"), num=PROFILE_NUM)
def _(t):
    return profiles.panel_profile(d2_panel(t), F.hour("tick_ts"), "hour")


@query("f24_availability_by_weekday", PROFILE.format(k="dow", e="isodow(tick_ts) - 1"), num=PROFILE_NUM)
def _(t):
    return profiles.panel_profile(d2_panel(t), F.weekday("tick_ts"), "dow", all_values=7)


@query("f24_weekday_vs_weekend", "select isodow(tick_ts) >= 6 as is_weekend, count(*) as panel_rows, avg(availability_ratio_observed) as avail_mean from x_d2 group by 1", num="avail_mean")
def _(t):
    return panel.station_panel_d2(t.v_status_events, event_ticks(t)).groupBy((F.weekday("tick_ts") >= 5).alias("is_weekend")).agg(F.count("*").alias("panel_rows"), F.avg("availability_ratio_observed").alias("avail_mean"))


@query("f25_by_charger_count", """
select case when total_chargers <= 1 then '1' when total_chargers <= 3 then '2-3' when total_chargers <= 6 then '4-6' else '7+' end as bucket, count(*) as stations, avg(total_chargers) as total_chargers_mean, avg(unobserved_rate) as unobserved_rate_mean,
  avg(case when has_confirmed_available then 1.0 else 0 end) as confirmed_rate, avg(availability_ratio_observed) as d1_avail_mean, avg(m) as d2_avail_mean, count(m) as d2_stations
from x_station_status left join (select station_id, avg(availability_ratio_observed) as m from x_d2 group by 1) using (station_id) group by 1""", num="total_chargers_mean unobserved_rate_mean confirmed_rate d1_avail_mean d2_avail_mean")
def _(t):
    return profiles.by_charger_count(status(t), panel.station_panel_d2(t.v_status_events, event_ticks(t)))


FRESH = """
select {e} as {k}, count(*) as stations, avg(case when has_confirmed_available then 1.0 else 0 end) as confirmed_rate, avg(availability_ratio_observed) as avail_mean, avg(unobserved_rate) as unobserved_rate_mean,
  count(*) * 100.0 / (select count(*) from x_station_status) as share_pct, median(status_age_minutes) as age_median_min from x_station_status group by 1"""
FRESH_NUM = "confirmed_rate avail_mean unobserved_rate_mean share_pct age_median_min"


@query("f26_by_freshness", FRESH.format(k="age_bucket", e="case when status_age_minutes is null then 'UNOBSERVED' when status_age_minutes <= 5 then '<=5min_HIGH' when status_age_minutes <= 15 then '5-15min_NORMAL' else '>15min_CHECK' end"), num=FRESH_NUM)
def _(t):
    return profiles.by_freshness(status(t), profiles.age_bucket(F.col("status_age_minutes")), "age_bucket")


@query("f26_by_grade", FRESH.format(k="grade", e="reliability_grade"), num=FRESH_NUM)
def _(t):
    return profiles.by_freshness(status(t), F.col("reliability_grade"), "grade")


@query("f27_segment_quality", """
with s as (select station_id, segment_id, min(tick_ts) as a, max(tick_ts) as b, count(*) as ticks from x_d2 group by 1, 2),
g as (select *, epoch(b - a) / 60.0 as duration, epoch(a - lag(b) over (partition by station_id order by a)) / 60.0 as gap from s)
select cast(sum(ticks) as bigint) as total_rows, count(*) as total_segments, avg(duration) as duration_mean, max(duration) as duration_max, avg(ticks) as ticks_mean, count(gap) as gaps, avg(gap) as gap_mean, max(gap) as gap_max, median(duration) as duration_median, median(gap) as gap_median from g""", num="duration_mean duration_max ticks_mean gap_mean gap_max duration_median gap_median")
def _(t):
    return profiles.segment_quality(d2_panel(t))


@query("f28_access_hour_profile", """
select access, extract(hour from tick_ts) as hour, avg(a * 100.0 / u) as mean_pct, count(*) as ticks from (
  select case when access_restricted or name_suggests_residential then 'restricted_or_residential' else 'public' end as access, tick_ts, sum(available_count) as a, sum(usable_known) as u from x_d2 join x_access using (station_id) group by 1, 2) where u > 0 group by 1, 2""", num="mean_pct")
def _(t):
    return profiles.access_hour_profile(panel.station_panel_d2(t.v_status_events, event_ticks(t)), clean.access_flags(t.v_charger_master, stations(t)))


@query("f29_date_hour_matrix", "select cast(cast(tick_ts as date) as string) as date, hour, avg(availability_pct) as availability_pct, count(availability_pct) as ticks from x_series group by 1, 2", num="availability_pct")
def _(t):
    return profiles.date_hour_matrix(fleet(t))


@query("f29_day_night", "select case when hour between 7 and 22 then 'day_07_22' else 'night_23_06' end as tod, avg(availability_pct) as mean_pct, min(availability_pct) as min_pct, max(availability_pct) as max_pct, count(*) as ticks from x_series where availability_pct is not null group by 1", num="mean_pct min_pct max_pct")
def _(t):
    return profiles.day_night(fleet(t))


@query("f29_snapshot_inventory", "select * from x_inventory", num="gap_min", ts="tick_ts")
def _(t):
    return profiles.snapshot_inventory(t.v_status_events, event_ticks(t))


@query("f29_inventory_by_date", "select cast(cast(tick_ts as date) as string) as date, count(*) as snapshots, cast(sum(n_rows) as bigint) as rows_sum, max(gap_min) as gap_max, count(*) filter (gap_min > 25) as gaps_gt25, median(gap_min) as gap_med from x_inventory group by 1", num="gap_max gap_med")
def _(t):
    return profiles.inventory_by_date(stage(profiles.snapshot_inventory(t.v_status_events, event_ticks(t))))


@query("f30_observation_depth", "select k as at_least, count(*) filter (n >= k) as chargers from (select count(*) as n from v_status_events group by station_id, charger_id), (values (1), (2), (5), (10), (20), (30)) v(k) group by 1")
def _(t):
    return profiles.observation_depth(t.v_status_events)


@query("f31_dwell_times", "select station_id, charger_id, tick_ts, stat, dwell_minutes from x_dwell where dwell_minutes is not null", num="dwell_minutes", ts="tick_ts")
def _(t):
    return profiles.dwell_rows(snapshots.dedupe_snapshot_rows(t.v_status_events))


@query("f31_dwell_summary", """
with d as (select * from x_dwell where dwell_minutes is not null), m as (select c.station_id, c.charger_id, count(d.stat) as n from x_chargers c left join d using (station_id, charger_id) group by 1, 2)
select count(*) as dwells, avg(case when dwell_minutes < 5 then 1.0 else 0 end) as lt_5min_share, avg(case when dwell_minutes > 1440 then 1.0 else 0 end) as gt_24h_share, quantile_cont(dwell_minutes, 0.05) as dwell_p05, median(dwell_minutes) as dwell_median, quantile_cont(dwell_minutes, 0.95) as dwell_p95,
  (select avg(n) from m) as transitions_mean, (select median(n) from m) as transitions_median, (select quantile_cont(n, 0.95) from m) as transitions_p95 from d""", num="lt_5min_share gt_24h_share dwell_p05 dwell_median dwell_p95 transitions_mean transitions_median transitions_p95")
def _(t):
    return profiles.dwell_summary(stage(snapshots.dedupe_snapshot_rows(t.v_status_events)))


@query("f32_daily_checkpoint", """
with l as (select *, cast(tick_ts as date) as date, epoch(tick_ts - lag(tick_ts) over (partition by cast(tick_ts as date) order by tick_ts)) / 60.0 as g from v_poll_log),
a as (select date, count(*) as snapshots, cast(sum(api_calls) as bigint) as api_calls, max(n_rows) as rows_max, median(g) as interval_median_minutes from l group by 1),
r as (select cast(tick_ts as date) as date, count(*) as raw_rows from v_status_events group by 1), k as (select cast(tick_ts as date) as date, count(*) as dedup_rows, count(*) filter (stat not in (1, 2, 3, 4, 5, 9)) as invalid_status_rows from x_dedup group by 1),
p as (select cast(tick_ts as date) as date, avg(availability_pct) as availability_mean_pct, count(distinct segment_id) as segments from x_series group by 1),
c as (select date, count(*) filter (n >= 1) as chargers_ge_1, count(*) filter (n >= 2) as chargers_ge_2, count(*) filter (n >= 5) as chargers_ge_5, count(*) filter (n >= 10) as chargers_ge_10 from (
  select a.date, d.station_id, d.charger_id, count(*) as n from a join x_dedup d on cast(d.tick_ts as date) <= a.date group by 1, 2, 3) group by 1)
select cast(date as string) as date, snapshots, api_calls, rows_max, interval_median_minutes, raw_rows, dedup_rows, invalid_status_rows, availability_mean_pct, segments, chargers_ge_1, chargers_ge_2, chargers_ge_5, chargers_ge_10, raw_rows - dedup_rows as duplicate_rows,
  case when invalid_status_rows = 0 and coalesce(interval_median_minutes <= 25, false) then 'healthy' else 'check_required' end as health
from a left join r using (date) left join k using (date) left join p using (date) left join c using (date)""", num="interval_median_minutes availability_mean_pct")
def _(t):
    return profiles.daily_checkpoint(t.v_status_events, stage(snapshots.dedupe_snapshot_rows(t.v_status_events)), t.v_poll_log, fleet(t))


@query("f33_base_distributions", "select 'busi_nm' as column_name, busi_nm as value, count(*) as n from v_charger_master group by 1, 2 union all select 'chger_type', chger_type, count(*) from v_charger_master group by 1, 2 union all select 'stat', stat, count(*) from v_charger_master group by 1, 2")
def _(t):
    return profiles.distribution(t.v_charger_master, ["busi_nm", "chger_type", "stat"])


@query("f34_latest_tariffs", "select month, operator_name, arg_min(fee_krw, tariff_id) as fee_krw from v_tariffs where month = (select max(month) from v_tariffs) group by 1, 2", num="fee_krw")
def _(t):
    return profiles.latest_tariffs(t.v_tariffs)


ORACLE_CTES["x_soc"] = """
select *, arrival_soc - 10 as soc_safety_margin, arrival_soc > 0 as can_reach, model_name = '__FALLBACK__' as used_fallback, case when arrival_soc <= 10 then 'DANGER' when arrival_soc <= 20 then 'WARNING' else 'SAFE' end as soc_risk_level from (
  select route_id, distance_km, model_name, s as current_soc, s - distance_km / (range_km / kwh) / kwh * 100 as arrival_soc from v_routes,
    (select model_name, range_km, coalesce(fixed_kwh, battery_kwh) as kwh from v_vehicles union all select '__FALLBACK__', 200.0, 50.0) v, (values (10.0), (15.0), (20.0), (30.0), (50.0)) l(s))"""


@query("f35_soc_scenarios", "select * from x_soc", num="distance_km current_soc arrival_soc soc_safety_margin")
def _(t):
    return profiles.soc_scenarios(t.v_routes, clean.vehicle_master(t.v_vehicles))


@query("f35_soc_summary", "select current_soc, count(*) as scenarios, avg(case when soc_risk_level = 'DANGER' then 1.0 else 0 end) as danger_rate, avg(case when can_reach then 1.0 else 0 end) as reach_rate, avg(arrival_soc) as arrival_soc_mean from x_soc group by 1", num="current_soc danger_rate reach_rate arrival_soc_mean")
def _(t):
    return profiles.soc_summary(profiles.soc_scenarios(t.v_routes, clean.vehicle_master(t.v_vehicles)))


@query("f36_drive_check", """
with t as (select vehicle_id, arg_max(ts, (soc, -epoch_us(ts))) as t0 from v_bms group by 1), a as (select b.* , t0 from v_bms b join t using (vehicle_id) where ts >= t0),
l as (select vehicle_id, arg_min(ts, (soc, ts)) as t1 from a group by 1), d as (select a.* from a join l using (vehicle_id) where ts <= t1),
o as (select vehicle_id, max(odometer_km) - min(odometer_km) as distance_km, max(soc) - min(soc) as soc_drop, avg(speed_kph) as avg_speed, count(*) as points from d group by 1)
select *, distance_km / 5.5 / 64.0 * 100 as model_soc_drop, case when distance_km > 0 then (soc_drop - distance_km / 5.5 / 64.0 * 100) * 100 / (distance_km / 5.5 / 64.0 * 100) end as error_pct from o""", num="distance_km soc_drop avg_speed model_soc_drop error_pct")
def _(t):
    return profiles.drive_check(t.v_bms, 5.5, 64.0)


@query("f37_charger_state_sets", "select states, count(*) as chargers from (select array_to_string(list_sort(list(distinct cast(stat as string))), ',') as states from v_status_events group by station_id, charger_id) group by 1")
def _(t):
    return profiles.charger_state_sets(t.v_status_events)


@query("f37_observation_histogram", "select cast(floor(n / 10.0) * 10 as bigint) as bin_start, count(*) as chargers from (select count(*) as n from v_status_events group by station_id, charger_id) group by 1")
def _(t):
    return profiles.observation_histogram(t.v_status_events)


@query("f37_status_mix_by_hour", "select extract(hour from tick_ts) as hour, count(*) as n, " + ", ".join(f"avg(case when stat = {s} then 1.0 else 0 end) as share_{s}" for s in (1, 2, 3, 4, 5, 9)) + " from v_status_events group by 1", num="share_1 share_2 share_3 share_4 share_5 share_9")
def _(t):
    return profiles.status_mix_by_hour(t.v_status_events)


@query("f38_supply_profile", "select busi_nm, count(*) as stations, cast(sum(n) as bigint) as chargers, avg(n) as chargers_per_station, max(n) as largest from (select busi_nm, station_id, count(*) as n from v_charger_master group by 1, 2) group by 1", num="chargers_per_station")
def _(t):
    return profiles.supply_profile(t.v_charger_master)


@query("f39_observation_coverage", "select count(*) as stations, count(e.station_id) as observed, avg(case when e.station_id is not null then 100.0 else 0 end) as observed_pct from x_stations s left join (select distinct station_id from v_status_events) e using (station_id) where lat between 35.55 and 36.45 and lng between 128.25 and 129.05", num="observed_pct")
def _(t):
    return profiles.observation_coverage(stations(t), t.v_status_events)


@query("f40_event_age_grades_by_day", """
select cast(cast(fetched_at as date) as string) as date, count(*) as n_rows, avg(case when a <= 5 then 1.0 else 0 end) as share_high, avg(case when a > 5 and a <= 15 then 1.0 else 0 end) as share_normal, avg(case when a > 15 then 1.0 else 0 end) as share_check_required
from (select *, epoch_us(fetched_at - stat_updated_at) / 60e6 as a from v_status_events) group by 1""", num="share_high share_normal share_check_required")
def _(t):
    return profiles.grade_share_by_day(snapshots.event_age(t.v_status_events))


@query("g2_gap_list", "select tick_ts, prev_gap_s / 60.0 as minutes, greatest(cast(round_even(prev_gap_s / 600.0, 0) as bigint) - 1, 1) as approx_missed from x_ticks where prev_gap_s > 1500", num="minutes", ts="tick_ts")
def _(t):
    return candidates.gap_list(event_ticks(t))


@query("g2_timing_summary", """
select *, least(ticks * 100.0 / expected_rounds, 100) as continuity_pct from (select count(*) as ticks, epoch(max(tick_ts) - min(tick_ts)) / 60.0 as span_minutes, max(prev_gap_s) / 60.0 as interval_max, count(*) filter (prev_gap_s > 1500) as gaps,
  cast(round_even(epoch(max(tick_ts) - min(tick_ts)) / 600.0, 0) as bigint) + 1 as expected_rounds, median(prev_gap_s) / 60.0 as interval_median from x_ticks)""", num="span_minutes interval_max interval_median continuity_pct")
def _(t):
    return candidates.timing_summary(event_ticks(t))


@query("g3_longest_failure", "select coalesce(max(n), 0) as max_consecutive_failures from (select g, count(*) as n from (select ok, sum(case when ok then 1 else 0 end) over (order by tick_ts) as g from v_poll_log) where not ok group by 1)")
def _(t):
    return candidates.longest_failure(log_ticks(t))


@query("g5_cumulative_chargers", """
select tick_ts, per_snapshot, cast(sum(coalesce(n, 0)) over (order by tick_ts) as bigint) as cumulative_unique from (select tick_ts, count(distinct (station_id, charger_id)) as per_snapshot from v_status_events group by 1)
left join (select tick_ts, count(*) as n from (select min(tick_ts) as tick_ts from v_status_events group by station_id, charger_id) group by 1) using (tick_ts)""", ts="tick_ts")
def _(t):
    return candidates.cumulative_chargers(t.v_status_events, event_ticks(t))
