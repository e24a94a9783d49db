"""De-duplication, as-of selection and station features."""
from pyspark.sql import functions as F

import chargelens.plans.oracle_ctes  # noqa: F401
from chargelens.operators import snapshots, station
from chargelens.plans.common import current_chargers
from chargelens.plans.registry import query


@query("c1_dedupe_snapshot_rows", "select station_id, charger_id, tick_ts, stat, event_id, page_no from x_dedup", ts="tick_ts")
def _(t):
    return snapshots.dedupe_snapshot_rows(t.v_status_events).select("station_id", "charger_id", "tick_ts", "stat", "event_id", "page_no")


@query("c2_latest_status_as_of", """
select station_id, charger_id, stat, tick_ts, last_seen_at, epoch_us(as_of - stat_updated_at) / 1e6 as status_age_seconds,
  epoch_us(as_of - last_seen_at) / 1e6 as observation_age_seconds from x_latest""", num="status_age_seconds observation_age_seconds", ts="tick_ts last_seen_at")
def _(t):
    ev = t.v_status_events
    return snapshots.latest_status_as_of(ev, snapshots.newest_poll(ev)).drop("stat_mapped", "stat_updated_at")


@query("c3_master_with_status", """
select station_id, charger_id, stat_mapped, status_missing, case when status_missing then 'NO_STATUS_OBSERVED' else 'STATUS_OBSERVED' end as availability_note,
  status_age_seconds from x_current""", num="status_age_seconds")
def _(t):
    return current_chargers(t).select("station_id", "charger_id", "stat_mapped", "status_missing", "availability_note", "status_age_seconds")


@query("c4_newest_poll", "select as_of from x_asof", ts="as_of")
def _(t):
    return t.v_status_events.agg(F.max("fetched_at").alias("as_of"))


@query("c5_first_charger_per_station", """
select station_id, charger_id, chger_type, busi_nm from (select *, row_number() over (partition by station_id order by charger_id) rn from v_charger_master) where rn = 1""")
def _(t):
    return snapshots.first_per_station(t.v_charger_master).select("station_id", "charger_id", "chger_type", "busi_nm")


@query("c5_last_row_per_incident", """
select incident_id, event_id, start_ts, title from (select *, row_number() over (partition by incident_id order by start_ts desc, event_id desc) rn from v_incidents) where rn = 1""", ts="start_ts")
def _(t):
    return snapshots.last_per_incident(t.v_incidents).select("incident_id", "event_id", "start_ts", "title")


@query("c6_duplicate_audit_sample", """
with g as (select tick_ts, station_id, charger_id, count(*) as group_rows, min(stat) <> max(stat) as status_conflict from v_status_events group by 1, 2, 3 having count(*) > 1),
p as (select tick_ts, station_id, charger_id from g where not status_conflict order by md5(concat_ws('|', '42', strftime(tick_ts, '%Y%m%d%H%M%S'), station_id, charger_id)) limit 20),
s as (select * from g where status_conflict or (tick_ts, station_id, charger_id) in (select (tick_ts, station_id, charger_id) from p))
select tick_ts, station_id, charger_id, e.event_id, e.stat, e.page_no, group_rows, status_conflict, case when status_conflict then 'status_conflict' else 'same_status_duplicate' end as sample_group, d.event_id = e.event_id as selected,
  row_number() over (partition by tick_ts, station_id, charger_id order by e.stat_updated_at desc, e.page_no desc, e.event_id desc) as selection_rank
from v_status_events e join s using (tick_ts, station_id, charger_id) join x_dedup d using (tick_ts, station_id, charger_id)""", ts="tick_ts")
def _(t):
    return snapshots.duplicate_audit_sample(t.v_status_events, 20)


@query("f1_charger_totals", """
select station_id, count(*) as total_chargers, count(*) filter (stat = '2') as available_chargers from v_charger_master group by 1""")
def _(t):
    from chargelens.functions.codes import internal_status
    return station.charger_totals(t.v_charger_master.withColumn("stat", internal_status(F.col("stat"))))


@query("f2_availability_features", """
select station_id, total_chargers, available_count, observed_count, unobserved_count, availability_ratio_observed, unobserved_rate, has_confirmed_available
from x_station_status""", num="availability_ratio_observed unobserved_rate")
def _(t):
    return station.availability_features(current_chargers(t))


@query("f3_unobserved_chargers", "select station_id, charger_id, coalesce(stat_mapped, 'UNKNOWN') = 'UNKNOWN' as is_unobserved from x_current")
def _(t):
    c = current_chargers(t)
    return c.select("station_id", "charger_id", station.unobserved(c, station.standard_status(F.col("stat_mapped"))).alias("is_unobserved"))


@query("f4_grade_from_age", """
select station_id, charger_id, case when status_age_seconds <= 300 then 'HIGH' when status_age_seconds <= 900 then 'NORMAL' else 'CHECK_REQUIRED' end as grade from x_current""")
def _(t):
    from chargelens.functions.exprs import grade_from_minutes
    return current_chargers(t).select("station_id", "charger_id", grade_from_minutes(F.col("status_age_seconds") / 60).alias("grade"))


@query("f5_station_grade", """
select stat_id as station_id, case when min(age) <= 5 then 'HIGH' when min(age) <= 15 then 'NORMAL' else 'CHECK_REQUIRED' end as reliability_grade
from (select stat_id, epoch(timestamp '2024-01-30 12:20:00' - try_strptime(case when length(stat_updated_at) = 14 then stat_updated_at end, '%Y%m%d%H%M%S')) / 60.0 as age from v_chargers_raw where stat_id is not null) group by 1""")
def _(t):
    raw = t.v_chargers_raw.where("stat_id is not null").withColumnRenamed("stat_id", "station_id")
    return station.station_grade(raw, F.expr("timestamp_ntz'2024-01-30 12:20:00'"))


@query("f6_status_age_grade", "select station_id, status_age_minutes, reliability_grade from x_station_status", num="status_age_minutes")
def _(t):
    return station.status_age_grade(current_chargers(t))


@query("f7_observation_freshness", "select station_id, observation_age_minutes, observation_grade, reliability_grade_effective from x_station_status", num="observation_age_minutes")
def _(t):
    return station.observation_freshness(current_chargers(t))


@query("f8_reliability_combined", """
select station_id, status_age_minutes, reliability_grade, observation_age_minutes, observation_grade, reliability_grade_effective from x_station_status""", num="status_age_minutes observation_age_minutes")
def _(t):
    return station.reliability_combined(current_chargers(t))


@query("f9_observation_state", "select station_id, observed_count, observation_state from x_station_status")
def _(t):
    return station.station_status(current_chargers(t)).select("station_id", "observed_count", "observation_state")
