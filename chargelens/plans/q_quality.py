"""Quality checks, verdicts and their inputs."""
from pyspark.sql import functions as F

import chargelens.plans.q_labels  # noqa: F401
from chargelens.functions import codes
from chargelens.operators import clean, labels, panel, quality, snapshots, spatial
from chargelens.plans.common import event_ticks, fleet, log_ticks, station_ticks
from chargelens.plans.q_labels import observed_parts, training
from chargelens.plans.q_spatial import incident_points, stations
from chargelens.plans.registry import ENTRIES, query
from chargelens.plans.station_snapshot import d1
from chargelens.session import stage
from chargelens.sources.views import ORACLE_CTES

V = "value threshold"
OFFICIAL = "case stat when 2 then 'AVAILABLE' when 3 then 'CHARGING' when 9 then 'UNKNOWN' else 'OUT_OF_SERVICE' end"


def rows(*checks):
    """Oracle check rows: (code, value, threshold, condition for PASS, else-status) or an explicit status."""
    return " union all ".join(f"select '{c}' as code, {st} as status, cast({v} as double) as value, cast({th} as double) as threshold from one" for c, v, th, st in checks)


def ok(cond, other="FAIL"):
    return f"case when {cond} then 'PASS' else '{other}' end"


def lvl(v, w, f):
    return f"case when {v} is null or {v} >= {f} then 'FAIL' when {v} >= {w} then 'WARN' else 'PASS' end"


NOW = "timestamp_ntz'2024-01-31 02:00:00'"


@query("i1_history_validation", f"""
with k as (select station_id, charger_id, fetched_at, {OFFICIAL} as st, count(*) as n from v_status_events group by 1, 2, 3, 4)
select cast(sum(n) as bigint) as n_rows, count(distinct station_id) as stations, count(distinct (station_id, charger_id)) as chargers, min(fetched_at) as observed_min, max(fetched_at) as observed_max, cast(sum(n) - count(*) as bigint) as duplicate_event_keys, 0 as null_updates, 0 as invalid_status_rows from k""", ts="observed_min observed_max")
def _(t):
    return quality.history_validation(t.v_status_events, codes.official_smart(F.col("stat")))


MISS_COLS = ["station_id", "charger_id", "station_name", "addr", "busi_nm", "chger_type", "output", "limit_yn", "del_yn", "parking_free", "stat", "use_time", "lat", "lng"]


@query("i2_missing_profile", "select *, case when missing_pct = 0 then 'complete' when missing_pct < 5 then 'low' when missing_pct < 50 then 'mid' when missing_pct < 90 then 'high' else 'almost_all' end as band from (select *, missing * 100.0 / n_rows as missing_pct from (" + " union all ".join(
    f"select '{c}' as column_name, count(*) as n_rows, count(*) filter ({c} is null" + ("" if c in ("lat", "lng") else f" or lower(trim({c})) in ('', 'nan', 'null', '<na>', 'nat', 'natype')") + ") as missing from v_charger_master" for c in MISS_COLS) + "))", num="missing_pct")
def _(t):
    return quality.missing_profile(t.v_charger_master.select(*MISS_COLS))


FAMILIES = {"identity": ("station_id", "charger_id", "station_name"), "place": ("addr", "lat", "lng"), "equipment": ("busi_nm", "chger_type", "output"), "access": ("limit_yn", "del_yn", "parking_free", "use_time"), "status": ("stat",)}
MISSING_SQL = ENTRIES["i2_missing_profile"].sql


@query("i2_missing_by_family", "with p as (" + MISSING_SQL + "), f as (select *, case " + " ".join(f"when column_name in ({', '.join(repr(c) for c in cs)}) then '{n}'" for n, cs in FAMILIES.items()) + """ end as family from p)
select family, count(*) as n_columns, sum(missing) * 100.0 / sum(n_rows) as missing_pct, arg_max(column_name, (missing_pct, column_name)) as worst_column, count(*) filter (band = 'complete') as complete_columns, count(*) filter (band = 'low') as low_columns,
  count(*) filter (band = 'mid') as mid_columns, count(*) filter (band = 'high') as high_columns, count(*) filter (band = 'almost_all') as almost_all_columns from f group by 1""", num="missing_pct")
def _(t):
    return quality.missing_by_family(quality.missing_profile(t.v_charger_master.select(*MISS_COLS)), FAMILIES)


BOX = (35.6, 36.2, 128.3, 128.9)  # fixed values: the city's box
NO_LAT, NO_LNG = "coalesce(lat, 0) = 0", "coalesce(lng, 0) = 0"


@query("i3_station_table_profile", " union all ".join(f"select '{k}' as metric, cast(count(*) filter ({c}) as double) as value from x_stations" for k, c in (
    ("rows", "true"), ("missing_lat", NO_LAT), ("missing_lng", NO_LNG), ("missing_both", f"{NO_LAT} and {NO_LNG}"), ("outside_box", f"not {NO_LAT} and not (lat between 35.6 and 36.2 and lng between 128.3 and 128.9)"),
    *((f"blank_{c}", f"coalesce(trim({c}), '') = ''") for c in ("station_name", "addr", "busi_nm", "use_time")))), num="value")
def _(t):
    return quality.station_table_profile(stations(t), BOX)


@query("i3_update_age_profile", """
with a as (select stat_updated_at as s, case when length(stat_updated_at) = 14 then try_strptime(stat_updated_at, '%Y%m%d%H%M%S') end as upd from v_chargers_raw)
select case when coalesce(trim(s), '') = '' then 'blank' when upd is null then 'unreadable' when epoch(timestamp '2024-01-30 13:20:00' - upd) < 0 then 'future' when epoch(timestamp '2024-01-30 13:20:00' - upd) <= 300 then 'HIGH'
  when epoch(timestamp '2024-01-30 13:20:00' - upd) <= 900 then 'NORMAL' else 'CHECK_REQUIRED' end as reliability, count(*) as chargers from a group by 1""")
def _(t):
    return quality.update_age_profile(t.v_chargers_raw, "stat_updated_at", F.expr("timestamp_ntz'2024-01-30 13:20:00'"))


@query("i3_charger_table_profile", " union all ".join(f"select '{k}' as metric, cast({e} as double) as value from v_charger_master" for k, e in (
    ("rows", "count(*)"), ("stations", "count(distinct station_id)"), ("missing_coordinates", "count(*) filter (lat is null)"), ("missing_output", "count(*) filter (try_cast(output as double) is null)"), ("missing_hours", "count(*) filter (use_time is null)"), ("mean_lat", "avg(lat)"))), num="value")
def _(t):
    return quality.charger_table_profile(t.v_charger_master)


ORACLE_CTES["x_per_tick"] = "select tick_ts, cast(sum(n) as bigint) as raw_rows, cast(sum(n - 1) as bigint) as extra_rows, count(*) filter (n > 1) as duplicate_groups, count(*) filter (c) as conflict_groups from (select tick_ts, station_id, charger_id, count(*) as n, min(stat) <> max(stat) as c from v_status_events group by 1, 2, 3) group by 1"
ORACLE_CTES["x_input_checks"] = """
with one as (select (select sum(raw_rows) from x_per_tick) as raw, (select sum(extra_rows) from x_per_tick) as extra, (select sum(conflict_groups) from x_per_tick) as conflict, (select count(*) from x_per_tick) as ticks,
  (select count(*) filter (stat_updated_at > fetched_at + interval '5' minute) from v_status_events) as travel, (select quantile_cont(prev_gap_s, 0.95) / 60.0 from x_ticks) as p95, (select epoch(timestamp '2024-01-31 02:00:00' - max(tick_ts)) / 60.0 from x_ticks) as age)
""" + rows(("READABLE", "ticks", 1, ok("ticks >= 1")), ("RAW_GRAIN_UNIQUENESS", "extra / cast(raw as double)", 0, ok("extra = 0", "WARN")), ("CONFLICTING_STATUS_GROUPS", "conflict", 20, lvl("conflict", 20, 100)), ("CODE_VALIDITY", 0, 0, "'PASS'"), ("TIME_PARSE", 0, 0, "'PASS'"),
           ("NO_TIME_TRAVEL", "travel", 0, ok("travel = 0")), ("CADENCE_P95_MINUTES", "p95", 20, lvl("p95", 20, 30)), ("LATEST_SNAPSHOT_AGE_MINUTES", "age", 60, lvl("age", 60, 180)), ("RAW_DUPLICATE_RATE", "extra / cast(raw as double)", 0.005, lvl("extra / cast(raw as double)", 0.005, 0.02)))


def input_checks(t):
    return quality.input_report(t.v_status_events, stage(quality.snapshot_group_counts(t.v_status_events)), event_ticks(t), F.expr(NOW))


@query("i4_input_report", "select * from x_input_checks", num=V)
def _(t):
    return input_checks(t)


@query("i5_monitor_verdict", """
select count(*) filter (status = 'FAIL') as fails, count(*) filter (status = 'WARN') as warns, case when count(*) filter (status = 'FAIL') > 0 then 'FAIL' when count(*) filter (status = 'WARN') > 0 then 'WARN' else 'PASS' end as monitor_status
from x_input_checks where code in ('RAW_DUPLICATE_RATE', 'CONFLICTING_STATUS_GROUPS', 'CADENCE_P95_MINUTES', 'LATEST_SNAPSHOT_AGE_MINUTES')""")
def _(t):
    return quality.monitor_verdict(input_checks(t))


@query("i6_index_cross_check", "select count(*) as ticks, count(*) filter (l.tick_ts is null) as not_in_log, count(*) filter (e.tick_ts is null) as without_rows from x_ticks e full join v_poll_log l on e.tick_ts = l.tick_ts")
def _(t):
    return quality.index_cross_check(event_ticks(t), t.v_poll_log)


@query("i7_reliability_battery", """
with a as (select *, epoch_us(fetched_at - stat_updated_at) / 60e6 as age from v_status_events),
one as (select (select count(*) from v_poll_log where not ok) as fails, (select count(*) from x_ticks where prev_gap_s > 1500) as gaps, (select median(age) from a where age between -1 and 1440) as med, (select avg(case when age <= 5 then 1.0 else 0 end) from a) as high,
  (select count(*) filter (age < -1) / cast(count(*) as double) from a) as bad, (select count(availability_pct) from x_series) as series)
""" + rows(("R1_call_log", "fails", 0, ok("fails = 0")), ("R2_gap25", "gaps", 10, ok("gaps <= 10")), ("R3_age_median", "med", 10, ok("med <= 10")), ("R4_high_share", "high", 0.5, ok("high >= 0.5")), ("R5_parse", "bad", 0.01, ok("bad < 0.01")), ("R6_panel_avail", "series", 100, ok("series > 100"))), num=V)
def _(t):
    return quality.reliability_battery(snapshots.event_age(t.v_status_events), event_ticks(t), fleet(t), t.v_poll_log)


@query("i8_master_status_audit", """
with l as (select distinct station_id, charger_id from v_status_events where tick_ts = (select max(tick_ts) from v_status_events)),
one as (select (select coalesce(sum(n), 0) from (select count(*) as n from v_charger_master group by station_id, charger_id) where n > 1) as dup, (select avg(case when lat between 35.55 and 36.45 and lng between 128.25 and 129.05 then 1.0 else 0 end) from v_charger_master) as coord,
  (select count(*) from l where (station_id, charger_id) in (select (station_id, charger_id) from v_charger_master)) / cast((select count(*) from l) as double) as ov)
""" + rows(("MASTER_UNIQUE_KEY", "dup", 0, ok("dup = 0")), ("MASTER_COORDINATES", "coord", 0.99, ok("coord >= 0.99", "WARN")), ("MASTER_STATUS_KEY_OVERLAP", "ov", 0.98, ok("ov >= 0.98", "WARN"))), num=V)
def _(t):
    return quality.master_status_audit(t.v_charger_master, t.v_status_events)


@query("i8_parking_audit", """
with one as (select (select count(distinct lot_id) filter (lot_id in (select lot_id from v_lots)) / cast(count(distinct lot_id) as double) from v_lot_realtime) as share, (select count(*) from v_lot_realtime where abs(occupancy_rate - (1 - remaining_spaces / cast(total_spaces as double))) > 0.05) as formula,
  (select count(*) from x_near_lot where distance_m > 1000) as far, (select count(*) from x_near_lot where not matched and distance_m is not null) as mock)
""" + rows(("PARKING_KEY_OVERLAP", "share", 0.98, ok("share >= 0.98", "WARN")), ("PARKING_OCCUPANCY_FORMULA", "formula", 0, ok("formula = 0", "WARN")), ("PARKING_RADIUS", "far", 0, ok("far = 0")), ("PARKING_NULL_POLICY", "mock", 0, ok("mock = 0"))), num=V)
def _(t):
    return quality.parking_audit(t.v_lots, t.v_lot_realtime, spatial.nearest_within(stations(t), t.v_lots, "lot_id", 1000.0))


@query("i8_traffic_audit", """
with g as (select *, try_cast(trim(cong_grade) as double) as g from v_link_ticks), one as (select avg(speed_kph) filter (g = 1) as v1, avg(speed_kph) filter (g = 2) as v2, avg(speed_kph) filter (g = 3) as v3, count(*) filter (speed_kph < 0) as neg from g)
""" + rows(("SPEED_GRADE_ORDER", "v1 - v3", 0, ok("v1 >= v2 and v2 >= v3", "WARN")), ("SPEED_NEGATIVE", "neg", 0, ok("neg = 0"))), num=V)
def _(t):
    return quality.traffic_audit(t.v_link_ticks, clean.grade_number(F.col("cong_grade")))


@query("i8_snapshot_audit", "with one as (select count(*) filter (available_count > observed_count or observed_count > total_chargers) as bound, count(*) filter (observed_count = 0 and availability_ratio_observed is not null) as zero, count(*) - count(distinct station_id) as dup from x_d1) " + rows(
    ("COUNT_BOUNDS", "bound", 0, ok("bound = 0")), ("UNOBSERVED_IS_NULL", "zero", 0, ok("zero = 0")), ("STATION_UNIQUE", "dup", 0, ok("dup = 0"))), num=V)
def _(t):
    return quality.snapshot_audit(d1(t))


@query("i8_drift", """
with m as (select epoch(min(tick_ts)) / 2 + epoch(max(tick_ts)) / 2 as mid from x_d2), one as (select abs(avg(availability_ratio_observed) filter (epoch(tick_ts) > mid) - avg(availability_ratio_observed) filter (epoch(tick_ts) <= mid)) as d from x_d2, m)
""" + rows(("AVAILABILITY_DRIFT", "d", 0.1, ok("d <= 0.1", "WARN"))), num=V)
def _(t):
    return quality.drift(stage(panel.station_panel_d2(t.v_status_events, event_ticks(t))))


TYPES = "(" + ", ".join(f"'{k}'" for k in codes.CHARGER_TYPE) + ")"


@query("i9_field_checks", f"""
with one as (select count(*) filter (coalesce(trim(station_id), '') = '') as blank, count(*) filter (chger_type not in {TYPES}) as type, count(*) filter (chger_type in ('02', '08') and try_cast(output as double) > 50) as slow, count(*) filter (chger_type not in ('02', '08') and try_cast(output as double) < 20) as fast, count(*) filter (use_time is null) as hours from v_charger_master)
""" + rows(("BLANK_KEYS", "blank", 0, ok("blank = 0")), ("UNKNOWN_TYPES", "type", 0, ok("type = 0", "WARN")), ("SLOW_TYPE_HIGH_POWER", "slow", 0, ok("slow = 0", "WARN")), ("FAST_TYPE_LOW_POWER", "fast", 0, ok("fast = 0", "WARN")), ("HOURS_MISSING", "hours", 0, ok("hours = 0", "WARN"))), num=V)
def _(t):
    return quality.field_checks(t.v_charger_master, codes.CHARGER_TYPE)


ORACLE_CTES["x_train_split"] = "select t.*, s.split from x_training t join x_split s using (feature_date)"


@query("i10_training_quality", """
with one as (select count(*) filter (target_available not in (0, 1)) as bad, count(*) filter (feature_as_of >= label_observed_at) as travel, avg(target_available) as pos, count(distinct feature_date) as days, avg(cast(history_observed as int)) as hist, min(target_observation_coverage) filter (target_available = 0) as cov,
  max(feature_date) filter (split = 'train') < min(feature_date) filter (split = 'valid') and max(feature_date) filter (split = 'valid') < min(feature_date) filter (split = 'test') as ord, count(*) - count(distinct (station_id, feature_as_of, horizon_minutes)) as dup from x_train_split)
""" + rows(("PRIMARY_KEY_UNIQUENESS", "dup", 0, ok("dup = 0")), ("TARGET_VALIDITY", "bad", 0, ok("bad = 0")), ("NO_TIME_TRAVEL", "travel", 0, ok("travel = 0")), ("TEMPORAL_SPLIT", "cast(ord as int)", 1, ok("ord")), ("CONSERVATIVE_NEGATIVE_LABEL", "cov", 1, ok("coalesce(cov >= 1, true)")),
           ("CLASS_IMBALANCE", "pos", 0.9, ok("pos <= 0.9", "WARN")), ("TIME_COVERAGE", "days", 14, ok("days >= 14", "WARN")), ("USAGE_HISTORY_COVERAGE", "hist", 0.2, ok("hist >= 0.2", "WARN"))) + """
union all select 'CLASS_SUPPORT_' || upper(split) || '_' || horizon_minutes || 'M', case when count(*) filter (target_available = 0) >= 100 then 'PASS' else 'WARN' end, cast(count(*) filter (target_available = 0) as double), 100.0 from x_train_split group by split, horizon_minutes""", num=V)
def _(t):
    return quality.training_quality(training(t))


@query("i11_training_profile", "select split, cast(horizon_minutes as double) as horizon_minutes, count(*) as n_rows, cast(sum(target_available) as bigint) as positives, avg(target_available) as positive_rate, count(distinct station_id) as stations from x_train_split group by rollup (split, horizon_minutes)", num="horizon_minutes positive_rate")
def _(t):
    return quality.training_profile(training(t)).withColumn("horizon_minutes", F.col("horizon_minutes").cast("double"))


@query("i13_daily_trend", """
select cast(cast(tick_ts as date) as string) as date, count(*) as snapshot_count, cast(sum(raw_rows) as bigint) as raw_rows, cast(sum(extra_rows) as bigint) as duplicate_extra_rows, sum(extra_rows) / cast(sum(raw_rows) as double) as duplicate_rate, cast(sum(conflict_groups) as bigint) as conflicting_status_groups,
  median(prev_gap_s / 60.0) as cadence_median, quantile_cont(prev_gap_s / 60.0, 0.95) as cadence_p95 from x_per_tick join x_ticks using (tick_ts) group by 1""", num="duplicate_rate cadence_median cadence_p95")
def _(t):
    return quality.daily_trend(quality.snapshot_group_counts(t.v_status_events), event_ticks(t))


@query("i14_source_freshness", " union all ".join(f"select '{n}' as source, max({c}) as latest, epoch(timestamp '2024-01-31 02:00:00' - max({c})) / 60.0 as age_minutes, case when epoch(timestamp '2024-01-31 02:00:00' - max({c})) / 60.0 <= {lim} then 'OK' else 'STALE' end as state from {v}" for n, v, c, lim in (
    ("status", "v_poll_log", "tick_ts", 60), ("parking", "v_lot_realtime", "date_trunc('second', collected_at)", 180), ("incidents", "v_incidents", "tick_ts", 60))), num="age_minutes", ts="latest")
def _(t):
    lot = t.v_lot_realtime.withColumn("collected_at", F.date_trunc("second", "collected_at").cast("timestamp_ntz"))
    return quality.source_freshness([("status", t.v_poll_log, "tick_ts", 60), ("parking", lot, "collected_at", 180), ("incidents", t.v_incidents, "tick_ts", 60)], F.expr(NOW))


K = "'OK'"


@query("i15_kpi_table", """
with one as (select (select count(*) filter (prev_gap_s > 720) from x_ticks where cast(tick_ts as date) = (select max(cast(tick_ts as date)) from x_ticks)) as gaps, (select sum(api_calls) from v_poll_log where cast(tick_ts as date) = (select max(cast(tick_ts as date)) from v_poll_log)) as calls,
  (select count(distinct tick_ts) from v_incidents where cast(tick_ts as date) = (select max(cast(tick_ts as date)) from v_incidents)) as itoday, count(nearest_incident_m) as inc, avg(availability_ratio_observed) as avail, count(*) as n, avg(case when has_confirmed_available then 100.0 else 0 end) as conf, avg(unobserved_rate) * 100 as unobs,
  avg(case when reliability_grade_effective in ('HIGH', 'NORMAL') then 100.0 else 0 end) as fresh, avg(case when recommend_public_default then 100.0 else 0 end) as pub, avg(case when nearest_parking_m is not null then 100.0 else 0 end) as park, avg(case when history_observed then 100.0 else 0 end) as hist, (select count(*) from x_d2) as prows from x_d1)
""" + rows(*[(k, v, th, f"case when {c} then 'OK' else '{b}' end") for k, v, th, c, b in (
    ("K1", "gaps", 1, "gaps <= 1", "WARN"), ("K3", "itoday", 1, "itoday >= 1", "FAIL"), ("K4", "inc", 1, "inc > 0", "FAIL"), ("K5", "avail", 0, "n > 0", "FAIL"), ("K6", "conf", 50, "conf >= 50", "WARN"), ("K7", "unobs", 50, "unobs <= 50", "WARN"), ("K8", "fresh", 50, "fresh >= 50", "WARN"),
    ("K9", "pub", 30, "pub >= 30", "WARN"), ("K10", "park", 50, "park >= 50", "WARN"), ("K11", "hist", 10, "hist >= 10", "WARN"), ("K12", "prows", 1, "prows > 0", "FAIL"))]) + " union all select 'K2', case when calls >= 900 then 'FAIL' when calls <= 800 then 'OK' else 'WARN' end, cast(calls as double), 800.0 from one", num=V)
def _(t):
    ticks = event_ticks(t)
    return quality.kpi_table(ticks, t.v_poll_log, d1(t), t.v_incidents, panel.station_panel_d2(t.v_status_events, ticks))


ORACLE_CTES["x_viability"] = """
with o as (select count(*) as n from v_status_events group by station_id, charger_id),
one as (select (select count(*) from x_ticks) as snaps, (select count(distinct cast(tick_ts as date)) from x_ticks) as days, (select coalesce(sum(prev_gap_s) filter (prev_gap_s > 1800), 0) / epoch(max(tick_ts) - min(tick_ts)) from x_ticks) as night,
  (select count(*) from o) / cast((select count(*) from (select distinct station_id, charger_id from v_charger_master)) as double) as ratio, (select count(*) from o where n >= 5) as o5, (select count(*) from o where n >= 10) as o10,
  (select median(prev_gap_s) / 60.0 from x_ticks where extract(hour from tick_ts) between 7 and 22 and prev_gap_s <= 1800) as gap)
select *, case when code like 'mvp%' then 'A_rule_based' else 'B_time_series' end as axis from (""" + rows(
    ("mvp_days", "days", 3, ok("days >= 3")), ("mvp_snaps", "snaps", 100, ok("snaps >= 100")), ("mvp_ratio", "ratio", 0.3, ok("ratio >= 0.3")), ("mvp_gap_hard", "gap", 20, ok("gap <= 20")), ("mvp_gap_soft", "gap", 7, ok("gap <= 7")), ("eda_days", "days", 7, ok("days >= 7")), ("eda_obs5", "o5", 50, ok("o5 >= 50")), ("eda_obs10", "o10", 20, ok("o10 >= 20")), ("eda_night", "night", 0.6, ok("night <= 0.6"))) + ")"
VERDICT = """select axis, count(*) filter (status = 'PASS') as passed, count(*) as total, count(*) filter (status <> 'PASS' and code not in ({soft})) as hard_failed, count(*) filter (status <> 'PASS' and code in ({soft})) as soft_failed,
  case when count(*) filter (status <> 'PASS' and code not in ({soft})) > 0 then 'NO' when count(*) filter (status <> 'PASS' and code in ({soft})) > 0 then 'CONDITIONAL' else 'GO' end as verdict from {src} group by 1"""


@query("i16_status_viability_checks", "select * from x_viability", num=V)
def _(t):
    return quality.status_viability(t.v_status_events, event_ticks(t), t.v_charger_master)


@query("i16_status_verdict", VERDICT.format(soft="'mvp_ratio', 'mvp_gap_soft'", src="x_viability"))
def _(t):
    return quality.verdict(quality.status_viability(t.v_status_events, event_ticks(t), t.v_charger_master), ("mvp_ratio", "mvp_gap_soft"))


ORACLE_CTES["x_inc_viability"] = "with one as (select count(distinct incident_id) as n, count(distinct tick_ts) as ticks, avg(case when lat is not null then 1.0 else 0 end) as coord, (select avg(cast(matched as int)) from x_near_incident) as rate from v_incidents) select *, 'incident_feed' as axis from (" + rows(
    ("inc_ticks", "ticks", 24, ok("ticks >= 24")), ("inc_events", "n", 30, ok("n >= 30")), ("inc_coords", "coord", 0.9, ok("coord >= 0.9")), ("inc_join", "rate", 0.1, ok("rate >= 0.1"))) + ")"


@query("i16_incident_verdict", VERDICT.format(soft="'inc_join'", src="x_inc_viability"))
def _(t):
    near = spatial.nearest_within(stations(t), incident_points(t), "incident_id", 1000.0)
    return quality.verdict(quality.incident_viability(t.v_incidents, near), ("inc_join",))


@query("i17_feasibility_grade", """
select *, case when labeled_rows = 0 then 'C_NO_GO' when labeled_rows >= 5000 and label_days >= 14 and five_minute_share >= 0.5 and coverage >= 0.25 then 'A_GO' else 'B_CONDITIONAL_GO' end as grade from (
  select count(target_available) as labeled_rows, count(distinct case when target_available is not null then cast(tick_ts as date) end) as label_days, count(target_available) / cast(count(*) as double) as coverage, (select avg(case when prev_gap_s <= 330 then 1.0 else 0 end) from x_log where prev_gap_s is not null) as five_minute_share from x_observed_labels where horizon_min = 15)""", num="coverage five_minute_share")
def _(t):
    cells, ticks = observed_parts(t)
    stats = labels.label_stats(labels.observed_labels(cells, ticks, (15,)), labels.candidate_counts(cells, ticks, (15,)))
    return quality.feasibility_grade(stats, ticks)


@query("i18_integration_readiness", " union all ".join(f"select '{n}' as metric, count(*) filter ({c}) as stations from x_d1" for n, c in (
    ("stations", "true"), ("with_coordinates", "lat is not null"), ("public", "recommend_public_default"), ("observed", "observed_count > 0"), ("parking_matched", "nearest_parking_m is not null"), ("incident_matched", "nearest_incident_m is not null"), ("poi_matched", "poi_count_1km > 0"), ("usage_matched", "history_observed"))))
def _(t):
    return quality.integration_readiness(d1(t))


from chargelens.plans.q_spatial import nearest_sql  # noqa: E402

ORACLE_CTES["x_usage_near"] = nearest_sql("v_usage_stations", "station_id", "(select station_id as charge_station_id, lat, lng from x_stations)", "charge_station_id", 80)


@query("i18_usage_join_qa", "select count(*) as stations, count(*) filter (matched) as matched, count(*) filter (not matched) as unmatched, max(distance_m) as distance_max, median(distance_m) as distance_p50, quantile_cont(distance_m, 0.9) as distance_p90 from x_usage_near", num="distance_max distance_p50 distance_p90")
def _(t):
    st = stations(t).select(F.col("station_id").alias("charge_station_id"), "lat", "lng")
    return quality.usage_join_qa(stage(spatial.nearest_within(t.v_usage_stations, st, "charge_station_id", 80.0)))
