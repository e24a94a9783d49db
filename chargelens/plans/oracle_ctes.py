"""Shared building blocks of the oracle SQL, written independently of the Spark plans."""
from chargelens.sources.views import ORACLE_CTES

ORACLE_CTES.update({
    "x_dedup": """
select * exclude (rn) from (select *, row_number() over (partition by tick_ts, station_id, charger_id
  order by stat_updated_at desc nulls last, page_no desc, event_id desc) as rn from v_status_events) where rn = 1""",
    "x_ticks": """
select *, max(tick_idx) over (partition by segment_id) as seg_end_idx from (
  select tick_ts, tick_idx, prev_gap_s, cast(sum(case when prev_gap_s > 1500 then 1 else 0 end) over (order by tick_ts) as bigint) as segment_id
  from (select tick_ts, row_number() over (order by tick_ts) - 1 as tick_idx, epoch(tick_ts - lag(tick_ts) over (order by tick_ts)) as prev_gap_s
        from (select distinct tick_ts from v_status_events)))""",
    "x_log": """
select *, max(tick_idx) over (partition by segment_id) as seg_end_idx from (
  select tick_ts, ok, tick_idx, prev_gap_s, cast(sum(case when prev_gap_s > 1500 then 1 else 0 end) over (order by tick_ts) as bigint) as segment_id
  from (select tick_ts, ok, row_number() over (order by tick_ts) - 1 as tick_idx, epoch(tick_ts - lag(tick_ts) over (order by tick_ts)) as prev_gap_s
        from v_poll_log))""",
    "x_chargers": "select distinct station_id, charger_id from v_status_events",
    "x_asof": "select max(fetched_at) as as_of from v_status_events",
    # fleet-segment rule: newest observation at or before the tick, same segment
    "x_fleet": """
select c.station_id, c.charger_id, c.tick_ts, c.segment_id, o.stat
from (select * from x_chargers cross join x_ticks) as c
asof join (select d.*, t.segment_id as obs_segment from x_dedup d join x_ticks t using (tick_ts)) as o
  on c.station_id = o.station_id and c.charger_id = o.charger_id and c.tick_ts >= o.tick_ts
where o.obs_segment = c.segment_id""",
    "x_d2": """
select *, case when usable_known > 0 then available_count / cast(usable_known as double) end as availability_ratio_observed, available_count >= 1 as has_confirmed_available
from (select station_id, tick_ts, segment_id, count(*) as known_chargers, count(*) filter (stat = 2) as available_count,
  count(*) filter (stat = 3) as in_use_count, count(*) filter (stat in (2, 3)) as usable_known from x_fleet group by 1, 2, 3)""",
    "x_series": """
select *, case when usable_known > 0 then available * 100.0 / usable_known end as availability_pct, extract(hour from tick_ts) as hour
from (select tick_ts, segment_id, count(*) filter (stat = 2) as available, count(*) filter (stat = 3) as in_use, count(*) filter (stat in (2, 3)) as usable_known
      from x_fleet group by 1, 2)""",
    # charger-segment rule: between two own observations at most 25 minutes apart
    "x_e3": """
select o.station_id, o.charger_id, t.tick_ts, t.segment_id, o.stat from (
  select d.*, lead(tick_ts) over (partition by station_id, charger_id order by tick_ts) as nxt from x_dedup d) as o
join x_ticks t on t.tick_ts = o.tick_ts or (nxt - o.tick_ts <= interval '25' minute and t.tick_ts > o.tick_ts and t.tick_ts < nxt)""",
    # bounded hold: every charger x polled tick with its newest observation of the segment
    "x_grid": """
select c.station_id, c.charger_id, c.tick_ts, c.tick_idx, c.segment_id, c.ok,
  case when o.obs_segment = c.segment_id then o.stat end as stat, case when o.obs_segment = c.segment_id then epoch(c.tick_ts - o.tick_ts) / 60.0 end as age
from (select * from x_chargers cross join x_log) as c
asof left join (select d.*, t.segment_id as obs_segment from x_dedup d join x_log t using (tick_ts)) as o
  on c.station_id = o.station_id and c.charger_id = o.charger_id and c.tick_ts >= o.tick_ts""",
    "x_hold": "select * from x_grid where age = 0 or (ok and age <= 25)",
    "x_station_tick": """
select g.station_id, g.tick_ts, g.tick_idx, g.segment_id, count(*) as chargers, count(*) filter (age = 0) as observed_chargers,
  count(*) filter (age = 0 and stat = 2) as available_observed, count(*) filter (age = 0 and stat in (2, 3)) as usable_observed,
  count(*) filter (age = 0 or (ok and age <= 25)) as known_recon, count(*) filter ((age = 0 or (ok and age <= 25)) and stat = 2) as available_recon,
  count(*) filter ((age = 0 or (ok and age <= 25)) and stat in (2, 3)) as usable_recon,
  min(age) filter (age = 0 or (ok and age <= 25)) as observation_age_minutes, bool_or(ok) as collection_success
from x_grid g group by 1, 2, 3, 4""",
    "x_latest": """
select * exclude (rn) from (select d.*, max(fetched_at) over (partition by station_id, charger_id) as last_seen_at, as_of,
  row_number() over (partition by station_id, charger_id order by stat_updated_at desc, fetched_at desc) as rn
  from x_dedup d cross join x_asof where stat_updated_at <= as_of and fetched_at <= as_of) where rn = 1""",
    "x_current": """
select m.*, l.stat as status_code, case l.stat when 2 then 'AVAILABLE' when 3 then 'CHARGING' when 4 then 'OUT_OF_ORDER' when 5 then 'UNDER_INSPECTION' else case when l.stat is not null then 'UNKNOWN' end end as stat_mapped,
  epoch_us(l.as_of - l.stat_updated_at) / 1e6 as status_age_seconds, epoch_us(l.as_of - l.last_seen_at) / 1e6 as observation_age_seconds, l.tick_ts,
  l.stat is null as status_missing
from v_charger_master m left join x_latest l using (station_id, charger_id)""",
    "x_station_status": """
select *, case when observed_count > 0 then available_count / cast(observed_count as double) end as availability_ratio_observed,
  unobserved_count / cast(total_chargers as double) as unobserved_rate, available_count >= 1 as has_confirmed_available,
  case when status_age_minutes <= 5 then 'HIGH' when status_age_minutes <= 15 then 'NORMAL' else 'CHECK_REQUIRED' end as reliability_grade,
  case when observation_age_minutes <= 5 then 'HIGH' when observation_age_minutes <= 15 then 'NORMAL' else 'CHECK_REQUIRED' end as observation_grade,
  case when least(status_age_minutes, observation_age_minutes) <= 5 then 'HIGH' when least(status_age_minutes, observation_age_minutes) <= 15 then 'NORMAL' else 'CHECK_REQUIRED' end as reliability_grade_effective,
  case when observed_count = 0 then 'UNOBSERVED' when least(status_age_minutes, observation_age_minutes) <= 5 then 'FRESH' when least(status_age_minutes, observation_age_minutes) <= 15 then 'NORMAL' else 'STALE' end as observation_state
from (select station_id, count(*) as total_chargers, count(*) filter (stat_mapped = 'AVAILABLE') as available_count,
  count(*) filter (stat_mapped <> 'UNKNOWN') as observed_count, count(*) filter (coalesce(stat_mapped, 'UNKNOWN') = 'UNKNOWN') as unobserved_count,
  min(status_age_seconds) filter (stat_mapped <> 'UNKNOWN') / 60.0 as status_age_minutes,
  min(observation_age_seconds) filter (stat_mapped <> 'UNKNOWN') / 60.0 as observation_age_minutes from x_current group by 1)""",
})
