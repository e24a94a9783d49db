"""Panels, station counts per tick, lags."""
from pyspark.sql import functions as F

import chargelens.plans.oracle_ctes  # noqa: F401
from chargelens.functions.codes import official_smart
from chargelens.operators import panel
from chargelens.plans.common import d2, event_ticks, fleet, log_ticks, station_ticks
from chargelens.plans.registry import query

E3_STATUS_SQL = "case stat when 2 then 'AVAILABLE' when 3 then 'CHARGING' when 9 then 'UNKNOWN' else 'OUT_OF_SERVICE' end"
E7_SQL = f"""
select *, available_count / cast(greatest(total_chargers, 1) as double) as available_ratio, charging_count / cast(greatest(total_chargers, 1) as double) as charging_ratio,
  out_of_service_count / cast(greatest(total_chargers, 1) as double) as out_of_service_ratio, extract(hour from tick_ts) as hour,
  isodow(tick_ts) - 1 as day_of_week, case when isodow(tick_ts) >= 6 then 1 else 0 end as is_weekend
from (select tick_ts, station_id, count(*) as total_chargers, count(*) filter (status = 'AVAILABLE') as available_count, count(*) filter (status = 'CHARGING') as charging_count,
  count(*) filter (status = 'OUT_OF_SERVICE') as out_of_service_count from (select *, {E3_STATUS_SQL} as status from x_e3) group by 1, 2)"""
LAG_SQL = """
select p.station_id, p.tick_ts, p.segment_id, p.known_chargers, p.available_count, p.in_use_count, p.usable_known, p.availability_ratio_observed, p.has_confirmed_available,
  case when a.tick_ts >= p.tick_ts - interval '27' minute then a.availability_ratio_observed end as avail_rate_lag_15m,
  case when b.tick_ts >= p.tick_ts - interval '75' minute then b.availability_ratio_observed end as avail_rate_lag_60m
from x_d2 p
asof left join x_d2 a on p.station_id = a.station_id and p.segment_id = a.segment_id and p.tick_ts - interval '15' minute >= a.tick_ts
asof left join x_d2 b on p.station_id = b.station_id and p.segment_id = b.segment_id and p.tick_ts - interval '60' minute >= b.tick_ts"""


def e3(t):
    return panel.charger_segment_panel(t.v_status_events, event_ticks(t), official_smart(F.col("stat")))


@query("e1_tick_segments", "select tick_ts, tick_idx, segment_id, prev_gap_s, seg_end_idx from x_ticks", num="prev_gap_s", ts="tick_ts")
def _(t):
    return event_ticks(t).select("tick_ts", "tick_idx", "segment_id", F.col("prev_gap_s").cast("double").alias("prev_gap_s"), "seg_end_idx")


@query("e2_fleet_segment_panel", "select station_id, charger_id, tick_ts, stat, segment_id from x_fleet", ts="tick_ts")
def _(t):
    return panel.fleet_segment_panel(t.v_status_events, event_ticks(t))


@query("e3_charger_segment_panel", f"select station_id, charger_id, tick_ts, {E3_STATUS_SQL} as status, segment_id from x_e3", ts="tick_ts")
def _(t):
    return e3(t)


@query("e4_bounded_hold_panel", """
select station_id, charger_id, tick_ts, stat as reconstructed_status, cast(case when age = 0 then stat end as double) as observed_status, age as observation_age_minutes,
  ok as collection_success, case when age = 0 then 'observed_event' else 'ffill_within_hold' end as source_type from x_hold""", num="observation_age_minutes", ts="tick_ts")
def _(t):
    return panel.bounded_hold_panel(t.v_status_events, log_ticks(t)).withColumn("observed_status", F.col("observed_status").cast("double"))


@query("e4_source_type_counts", """
select source_type, coalesce(n_cells, 0) as n_cells from (values ('observed_event'), ('ffill_within_hold'), ('collection_failed'), ('hold_expired'), ('unobserved')) as k(source_type)
left join (select case when age = 0 then 'observed_event' when ok and age <= 25 then 'ffill_within_hold' when not ok then 'collection_failed' when age > 25 then 'hold_expired' else 'unobserved' end as source_type,
  count(*) as n_cells from x_grid group by 1) using (source_type)""")
def _(t):
    return panel.hold_source_counts(t.v_status_events, log_ticks(t))


@query("e5_station_tick_panel", """
select station_id, tick_ts, segment_id, chargers, observed_chargers, available_observed, usable_observed, known_recon, available_recon, usable_recon, observation_age_minutes, collection_success
from x_station_tick""", num="observation_age_minutes", ts="tick_ts")
def _(t):
    return station_ticks(t).drop("tick_s", "tick_idx")


@query("e6_station_panel_d2", "select * from x_d2", num="availability_ratio_observed", ts="tick_ts")
def _(t):
    return panel.station_panel_d2(t.v_status_events, event_ticks(t)).drop("tick_s")


@query("e7_station_features_per_tick", E7_SQL, num="available_ratio charging_ratio out_of_service_ratio", ts="tick_ts")
def _(t):
    return panel.station_features_e3(e3(t))


@query("e7_station_features_as_of", f"""
select * from ({E7_SQL}) where tick_ts = (select max(tick_ts) from x_e3 where tick_ts <= timestamp '2024-01-20 12:00:00')""", num="available_ratio charging_ratio out_of_service_ratio", ts="tick_ts")
def _(t):
    noon = F.expr("timestamp_ntz'2024-01-20 12:00:00'")
    return panel.station_features_e3(panel.charger_segment_state(t.v_status_events, event_ticks(t), official_smart(F.col("stat")), noon))


@query("e8_fleet_series", "select tick_ts, segment_id, available, in_use, usable_known, availability_pct, hour from x_series", num="availability_pct", ts="tick_ts")
def _(t):
    return fleet(t).drop("date")


@query("e9_fleet_from_station_panel", """
select tick_ts, cast(sum(available_count) as bigint) as available, cast(sum(in_use_count) as bigint) as in_use, cast(sum(usable_known) as bigint) as usable_known, count(*) as stations,
  avg(case when has_confirmed_available then 1.0 else 0 end) as confirmed_share, case when sum(usable_known) > 0 then sum(available_count) * 100.0 / sum(usable_known) end as availability_pct
from x_d2 group by 1""", num="confirmed_share availability_pct", ts="tick_ts")
def _(t):
    return panel.fleet_from_station_panel(panel.station_panel_d2(t.v_status_events, event_ticks(t)))


@query("e10_hourly_availability", "select hour, avg(availability_pct) as availability_pct from x_series group by 1", num="availability_pct")
def _(t):
    return panel.hourly_availability(fleet(t))


@query("e11_weighting_bias", """
with u as (select * from x_dedup where stat in (2, 3)), c as (select station_id, charger_id, count(*) as n, avg(case when stat = 2 then 1.0 else 0 end) as a from u group by 1, 2)
select (select avg(case when stat = 2 then 100.0 else 0 end) from u) as row_weighted_pct, avg(a) * 100 as charger_weighted_pct,
  avg(case when n = 1 then 100.0 else 0 end) as observed_once_pct, (select avg(availability_pct) from x_series) as panel_weighted_pct from c""", num="row_weighted_pct charger_weighted_pct observed_once_pct panel_weighted_pct")
def _(t):
    return panel.weighting_bias(t.v_status_events, fleet(t))


@query("e12_change_features", """
with k as (select *, sum(case when known_recon > 0 then 0 else 1 end) over (partition by station_id, segment_id order by tick_ts) as blk from x_station_tick),
d as (select *, available_recon - lag(available_recon) over (partition by station_id, segment_id, blk order by tick_ts) as delta from k where known_recon > 0)
select station_id, tick_ts, delta as available_count_delta_1tick,
  epoch(tick_ts - max(case when delta is null or delta <> 0 then tick_ts end) over (partition by station_id, segment_id, blk order by tick_ts)) / 60.0 as minutes_since_last_change
from d""", num="minutes_since_last_change available_count_delta_1tick", ts="tick_ts")
def _(t):
    return panel.change_features(station_ticks(t, sparse=True)).select("station_id", "tick_ts", F.col("available_count_delta_1tick").cast("double").alias("available_count_delta_1tick"), "minutes_since_last_change")


@query("e13_master_totals", f"""
select p.station_id, p.tick_ts, coalesce(m.n, p.total_chargers) as total_chargers, p.available_count / cast(greatest(coalesce(m.n, p.total_chargers), 1) as double) as available_ratio
from ({E7_SQL}) p left join (select station_id, count(*) as n from v_charger_master group by 1) m using (station_id)""", num="available_ratio", ts="tick_ts")
def _(t):
    counts = t.v_charger_master.groupBy("station_id").agg(F.count("*").alias("chargers"))
    return panel.with_master_totals(panel.station_features_e3(e3(t)), counts).select("station_id", "tick_ts", "total_chargers", "available_ratio")


@query("e14_row_shift_targets", f"""
select station_id, tick_ts, lead(available_ratio, 1) over w as target_plus_1, lead(available_ratio, 2) over w as target_plus_2, lead(available_ratio, 3) over w as target_plus_3
from ({E7_SQL}) window w as (partition by station_id order by tick_ts)""", num="target_plus_1 target_plus_2 target_plus_3", ts="tick_ts")
def _(t):
    return panel.shifted_targets(panel.station_features_e3(e3(t))).select("station_id", "tick_ts", "target_plus_1", "target_plus_2", "target_plus_3")


@query("e15_lag_reset_check", f"""
select count(*) as rows_after_gap, count(avail_rate_lag_15m) as lag15_not_null, count(avail_rate_lag_60m) as lag60_not_null
from (select *, tick_ts - lag(tick_ts) over (partition by station_id order by tick_ts) as gap from ({LAG_SQL})) where gap > interval '25' minute""")
def _(t):
    return panel.lag_reset_check(d2(t))


@query("n13_rate_lags", LAG_SQL, num="availability_ratio_observed avail_rate_lag_15m avail_rate_lag_60m", ts="tick_ts")
def _(t):
    return d2(t).drop("tick_s")
