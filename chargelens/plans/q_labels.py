"""As-of joins, labels, training rows, replay and travel times."""
from pyspark.sql import functions as F

import chargelens.plans.q_usage  # noqa: F401
from chargelens.functions.opening_hours import operating_at
from chargelens.functions.exprs import epoch_s
from chargelens.operators import candidates, clean, labels, matching, panel, snapshots, spatial
from chargelens.plans.common import d2, event_ticks, log_ticks, station_ticks
from chargelens.plans.q_spatial import hav, stations
from chargelens.plans.registry import query
from chargelens.plans.station_snapshot import d1, usage_station_rows
from chargelens.session import stage
from chargelens.sources.views import ORACLE_CTES

HV = "(values (5), (10), (15), (30)) hz(h)"


def eligible(t):
    """Public stations with good coordinates."""
    q = snapshots.first_per_station(clean.annotate_info(t.v_charger_master)).select("station_id", "coord_ok")
    return labels.eligible_stations(clean.access_flags(t.v_charger_master, stations(t)).join(q, "station_id"))


def observed_parts(t):
    """Observed cells and ticks, both staged."""
    ticks = log_ticks(t)
    return stage(labels.observed_cells(t.v_status_events, ticks)), ticks


def observed(t, horizons=labels.HORIZONS):
    return labels.observed_labels(*observed_parts(t), horizons)


def training(t):
    meta = eligible(t).select("station_id").join(usage_station_rows(t).select("station_id", "sessions_per_charger", "usage_weekday_avg", "usage_weekend_avg", "history_observed"), "station_id", "left")
    meta = stage(meta.withColumn("history_observed", F.coalesce("history_observed", F.lit(False))))
    ticks = log_ticks(t)
    events = t.v_status_events.join(meta.select("station_id"), "station_id", "left_semi")  # others give no row
    p = panel.change_features(panel.station_tick_panel(events, ticks, sparse=True))
    return labels.split_training(stage(labels.training_rows(p, meta, ticks)))


ORACLE_CTES.update({
    "x_eligible": "select a.station_id from x_access a join (select station_id, coordinate_quality_flag, row_number() over (partition by station_id order by charger_id) as rr from x_info) i using (station_id) where rr = 1 and coordinate_quality_flag = 'OK' and recommend_public_default",
    "x_future": """
select t.tick_ts, t.segment_id, h as horizon_minutes, f.tick_ts as future_ts from (select * from {ticks}, (values (5), (10), (15), (30)) hz(h)) t
left join lateral (select min(g.tick_ts) as tick_ts from {ticks} g where g.segment_id = t.segment_id and g.tick_ts >= t.tick_ts + interval '1' minute * t.h and g.tick_ts <= t.tick_ts + interval '1' minute * t.h + interval '450' second) f on true""",
    "x_observed_base": "select * from (select *, count(*) filter (observed_chargers > 0) over (partition by station_id) as n from x_station_tick) where n >= 3 and collection_success",
    "x_near_tick": """
select tick_ts, h, arg_min(fut, (abs(epoch(fut - tick_ts) - h * 60), fut)) as fut from (select a.tick_ts, h, b.tick_ts as fut from (select * from x_log, (values (5), (10), (15), (30)) hz(h) where ok) a
  join x_log b on b.ok and b.tick_ts between a.tick_ts + interval '1' minute * h - interval '450' second and a.tick_ts + interval '1' minute * h + interval '450' second) group by 1, 2""",
    "x_observed_labels": """
select b.station_id, b.tick_ts, b.available_observed, b.observed_chargers, hz.h as horizon_min, case when f.usable_observed > 0 then cast(f.available_observed >= 1 as int) end as target_available,
  case when f.station_id is null then 'no_tick_near_horizon' when f.observed_chargers <= 0 then 'horizon_tick_no_charger_observation' when f.usable_observed <= 0 then 'horizon_observed_but_no_usable_2_or_3' else 'ok' end as label_reason
from x_observed_base b cross join (values (5), (10), (15), (30)) hz(h) left join x_near_tick n on n.tick_ts = b.tick_ts and n.h = hz.h left join x_observed_base f on f.station_id = b.station_id and f.tick_ts = n.fut""",
})
FUT_LOG = ORACLE_CTES["x_future"].replace("{ticks}", "x_log")
ORACLE_CTES["x_future_log"] = FUT_LOG
ORACLE_CTES["x_future"] = ORACLE_CTES["x_future"].replace("{ticks}", "x_ticks")
ORACLE_CTES.update({
    "x_change": """
select station_id, tick_ts, delta as available_count_delta_1tick, epoch(tick_ts - max(case when delta is null or delta <> 0 then tick_ts end) over (partition by station_id, segment_id, blk order by tick_ts)) / 60.0 as minutes_since_last_change from (
  select *, available_recon - lag(available_recon) over (partition by station_id, segment_id, blk order by tick_ts) as delta from (
    select *, sum(case when known_recon > 0 then 0 else 1 end) over (partition by station_id, segment_id order by tick_ts) as blk from x_station_tick) where known_recon > 0)""",
    "x_training": """
select a.station_id, a.tick_ts as feature_as_of, u.horizon_minutes, u.future_ts as label_observed_at, epoch(u.future_ts - a.tick_ts) / 60.0 - u.horizon_minutes as label_match_delta_minutes,
  case when b.known_recon > 0 and b.available_recon > 0 then 1 else 0 end as target_available, case when b.known_recon > 0 and b.available_recon > 0 then 'confirmed_positive' else 'full_coverage_negative' end as label_reason,
  a.available_recon as available_count, a.usable_recon as usable_count, a.known_recon as known_charger_count, a.observed_chargers as direct_observed_count, a.chargers as total_chargers,
  a.known_recon / cast(a.chargers as double) as observation_coverage, a.observed_chargers / cast(a.chargers as double) as direct_observation_coverage, (a.chargers - a.known_recon) / cast(a.chargers as double) as unobserved_rate,
  a.observation_age_minutes, c.available_count_delta_1tick, c.minutes_since_last_change, us.sessions_per_charger, case when isodow(a.tick_ts) >= 6 then us.usage_weekend_avg else us.usage_weekday_avg end as usage_daytype_avg,
  extract(hour from a.tick_ts) as hour, isodow(a.tick_ts) - 1 as weekday, isodow(a.tick_ts) >= 6 as is_weekend, us.station_id is not null as history_observed, b.known_recon / cast(b.chargers as double) as target_observation_coverage, cast(a.tick_ts as date) as feature_date
from x_station_tick a join x_eligible e using (station_id) join x_future_log u on u.tick_ts = a.tick_ts and u.future_ts is not null join x_station_tick b on b.station_id = a.station_id and b.tick_ts = u.future_ts
left join x_change c on c.station_id = a.station_id and c.tick_ts = a.tick_ts left join x_usage_station us on us.station_id = a.station_id
where a.known_recon > 0 and a.collection_success and b.collection_success and ((b.known_recon > 0 and b.available_recon > 0) or (b.known_recon >= b.chargers and b.available_recon = 0))""",
    "x_split": """
select feature_date, case when rn <= a then 'train' when rn <= least(greatest(a + 1, floor(n * 0.8)), n - 1) then 'valid' else 'test' end as split from (
  select *, greatest(1, floor(n * 0.6)) as a from (select feature_date, row_number() over (order by feature_date) as rn, count(*) over () as n from (select distinct feature_date from x_training)))""",
})
TRAIN_NUM = "label_match_delta_minutes available_count usable_count known_charger_count direct_observed_count total_chargers observation_coverage direct_observation_coverage unobserved_rate observation_age_minutes available_count_delta_1tick minutes_since_last_change sessions_per_charger usage_daytype_avg target_observation_coverage"


@query("n14_n17_future_tick_map", "select * from x_future", ts="tick_ts future_ts")
def _(t):
    return labels.future_ticks(event_ticks(t))


@query("n14_nearest_tick_label", "select station_id, tick_ts, horizon_min, label_reason from x_observed_labels where horizon_min = 15", ts="tick_ts")
def _(t):
    cells, ticks = observed_parts(t)
    return labels.with_reasons(labels.observed_labels(cells, ticks, (15,)), cells, ticks, 15).select("station_id", "tick_ts", "horizon_min", "label_reason")


@query("h1_observed_labels", "select station_id, tick_ts, available_observed, observed_chargers, horizon_min, cast(target_available as double) as target_available, label_reason from x_observed_labels where target_available is not null", num="target_available", ts="tick_ts")
def _(t):
    return observed(t).where("target_available is not null").drop("tick_s", "tick_idx").withColumn("target_available", F.col("target_available").cast("double"))


@query("h1_label_stats", """
select horizon_min, count(*) as candidate_rows, count(target_available) as labeled_rows, count(*) filter (target_available = 1) as positive, count(*) filter (target_available = 0) as negative, avg(target_available) as positive_rate,
  count(distinct case when target_available is not null then station_id end) as stations_with_label, count(distinct case when target_available is not null then cast(tick_ts as date) end) as dates_with_label from x_observed_labels group by 1""", num="positive_rate")
def _(t):
    cells, ticks = observed_parts(t)
    return labels.label_stats(labels.observed_labels(cells, ticks), labels.candidate_counts(cells, ticks))


@query("g4_longest_label_run", """
select coalesce(max(n), 0) as max_consecutive_days from (select g, count(*) as n from (select d - cast(row_number() over (order by d) as int) as g
  from (select distinct cast(tick_ts as date) as d from x_observed_labels where horizon_min = 15 and target_available is not null)) group by 1)""")
def _(t):
    lab = observed(t, (15,)).where("target_available is not null")
    return candidates.longest_day_run(lab.select(F.to_date("tick_ts").alias("date")))


@query("h2_conservative_labels", """
select station_id, tick_ts, cast(case when known_recon > 0 and available_recon > 0 then 1 when known_recon >= chargers and available_recon = 0 then 0 end as double) as target from x_station_tick where known_recon > 0""", num="target", ts="tick_ts")
def _(t):
    y = labels.conservative_target(F.col("available_recon"), F.col("known_recon"), F.col("chargers"))
    return station_ticks(t, sparse=True).where("known_recon > 0").select("station_id", "tick_ts", y.cast("double").alias("target"))


@query("h3_training_rows", "select t.* replace (cast(feature_date as string) as feature_date), s.split from x_training t join x_split s using (feature_date)", num=TRAIN_NUM, ts="feature_as_of label_observed_at")
def _(t):
    return training(t)


@query("h4_eligible_stations", "select station_id from x_eligible join (select distinct station_id from x_station_tick) using (station_id)")
def _(t):
    return eligible(t).join(t.v_status_events.select("station_id"), "station_id", "left_semi").select("station_id")


@query("g9_temporal_split", "select cast(feature_date as string) as feature_date, split, count(*) as n from x_training join x_split using (feature_date) group by 1, 2")
def _(t):
    return training(t).groupBy("feature_date", "split").agg(F.count("*").alias("n"))


@query("g10_time_or_row_split", """
with d as (select block_date, row_number() over (order by block_date) as d, count(*) over () as nd from (select distinct block_date from v_scored))
select case when (d - 1) / cast(nd as double) < 0.70 then 'train' when (d - 1) / cast(nd as double) < 0.85 then 'valid' else 'test' end as split, count(*) as n, cast(min(block_date) as string) as first_date from v_scored join d using (block_date) group by 1""")
def _(t):
    s = t.v_scored.withColumn("_s", epoch_s(F.col("block_date").cast("timestamp_ntz")))
    return candidates.time_or_row_split(s.select("row_key", "block_date", "_s"), "_s", "row_key", "block_date").groupBy("split").agg(F.count("*").alias("n"), F.min("block_date").alias("first_date"))


ORACLE_CTES["x_replay"] = """
with p as (select s.*, e.* exclude (station_id) from x_station_tick s join (select station_id from x_eligible) e using (station_id)),
r as (select a.station_id, a.tick_ts, u.horizon_minutes, u.future_ts, a.available_recon as cur, b.available_recon as arr from x_station_tick a join x_eligible using (station_id) join x_future_log u on u.tick_ts = a.tick_ts
  join x_station_tick b on b.station_id = a.station_id and b.tick_ts = u.future_ts where a.known_recon > 0 and a.available_recon > 0 and b.known_recon > 0),
f as (select n.station_id, r.tick_ts, r.horizon_minutes, count(*) as fallback_count from x_neighbors n join r on r.station_id = n.neighbor_id where r.arr > 0 group by 1, 2, 3)
select r.station_id, r.tick_ts as t0, r.horizon_minutes, r.future_ts as matched_arrival_time, r.cur as current_available_count, r.arr as arrival_available_count, r.arr > 0 as arrival_available, r.cur <> r.arr as available_count_changed,
  coalesce(f.fallback_count, 0) as fallback_count, r.arr <= 0 and coalesce(f.fallback_count, 0) > 0 as fallback_covered from r left join f using (station_id, tick_ts, horizon_minutes)""".replace("with p as (select s.*, e.* exclude (station_id) from x_station_tick s join (select station_id from x_eligible) e using (station_id)),\nr as", "with r as")
ORACLE_CTES["x_pool"] = "select s.station_id, s.lat, s.lng from x_stations s join x_eligible using (station_id) join (select distinct station_id from v_status_events) using (station_id)"
ORACLE_CTES["x_neighbors"] = f"""
select station_id, neighbor_id from (select a.station_id, b.station_id as neighbor_id, row_number() over (partition by a.station_id order by {hav('a', 'b')}, b.station_id) as rn from x_pool a, x_pool b where a.station_id <> b.station_id) where rn <= 5"""


def replay(t):
    """Replay over the eligible stations that were ever polled, with their nearest five among them."""
    pool = stage(eligible(t).join(t.v_status_events.select("station_id"), "station_id", "left_semi").select("station_id", "lat", "lng"))
    ticks = log_ticks(t)
    own = t.v_status_events.join(pool.select("station_id"), "station_id", "left_semi")
    p = stage(panel.station_tick_panel(own, ticks, sparse=True))
    return labels.replay_rows(p, spatial.nearest_neighbors(pool), ticks)


@query("h5_arrival_replay", "select * from x_replay", ts="t0 matched_arrival_time")
def _(t):
    return replay(t)


@query("h5_replay_rates", """
select horizon_minutes, count(*) as labeled_rows, count(distinct station_id) as stations, avg(cast(arrival_available as int)) as arrival_available_rate, avg(cast(available_count_changed as int)) as change_rate, count(*) filter (not arrival_available) as failed_rows,
  avg(cast(fallback_covered as int)) filter (not arrival_available) as fallback_coverage, avg(cast(arrival_available as int)) filter (current_available_count = 1) as single_rate, avg(cast(arrival_available as int)) filter (current_available_count >= 2) as multi_rate from x_replay group by 1""",
       num="arrival_available_rate change_rate fallback_coverage single_rate multi_rate")
def _(t):
    return labels.replay_stats(replay(t))


ORACLE_CTES["x_eta_labels"] = """
with h as (select *, least(greatest(cast(round_even(eta_minutes, 0) as int), 1), 120) as hm from v_station_eta where eta_minutes is not null),
q as (select a.*, h.hm, h.eta_minutes, h.straight_km, (select min(g.tick_ts) from x_ticks g where g.segment_id = a.segment_id and g.tick_ts >= a.tick_ts + interval '1' minute * h.hm and g.tick_ts <= a.tick_ts + interval '1' minute * h.hm + interval '450' second) as fut
  from x_d2 a join h using (station_id) where a.available_count > 0)
select q.station_id, q.tick_ts as feature_as_of, q.hm as horizon_minutes, b.tick_ts as matched_arrival_time, q.eta_minutes, q.straight_km, q.available_count as current_available_count, b.available_count as arrival_available_count, b.available_count > 0 as target_available_at_arrival
from q join x_d2 b on b.station_id = q.station_id and b.tick_ts = q.fut"""


def eta_label_rows(t):
    ticks = event_ticks(t)
    return labels.eta_labels(stage(panel.station_panel_d2(t.v_status_events, ticks)), t.v_station_eta, ticks)


@query("n18_h6_eta_labels", "select * from x_eta_labels", num="eta_minutes straight_km", ts="feature_as_of matched_arrival_time")
def _(t):
    return eta_label_rows(t)


ETA_BAND = "case when straight_km >= 0 and straight_km < 2 then 0 when straight_km < 4 then 2 when straight_km < 6 then 4 when straight_km < 8 then 6 end"
ORACLE_CTES["x_bands"] = f"select {ETA_BAND} as band, count(*) as n, quantile_cont(r, 0.25) as ratio_p25, median(r) as ratio_median, quantile_cont(r, 0.75) as ratio_p75 from (select *, eta_minutes / (straight_km / 30.0 * 60) as r from v_station_eta where eta_minutes is not null) where {ETA_BAND} is not null group by 1"


@query("h7_eta_ratio_by_band", "select * from x_bands", num="ratio_p25 ratio_median ratio_p75")
def _(t):
    return labels.eta_ratio_by_band(t.v_station_eta)


@query("h8_filled_eta", f"select station_id, coalesce(eta_minutes, straight_km / 30.0 * 60 * coalesce(ratio_median, 1.94)) as eta_minutes, eta_minutes is null as eta_is_proxy, straight_km, road_km from (select *, {ETA_BAND} as band from v_station_eta) left join x_bands using (band)", num="eta_minutes straight_km road_km")
def _(t):
    return labels.fill_eta(t.v_station_eta, stage(labels.eta_ratio_by_band(t.v_station_eta)))


@query("h9_horizon_overlap", """
with c as (select h, count(horizon_minutes) as n from (values (5), (10), (15), (30)) hz(h) left join x_training on horizon_minutes = h group by 1),
o as (select a.horizon_minutes as left_horizon, b.horizon_minutes as right_horizon, count(*) as overlap_rows, count(*) filter (a.target_available = b.target_available) as same_label_rows, count(*) filter (a.label_observed_at = b.label_observed_at) as same_tick_rows
  from x_training a join x_training b on a.station_id = b.station_id and a.feature_as_of = b.feature_as_of and a.horizon_minutes < b.horizon_minutes group by 1, 2)
select l.h as left_horizon, r.h as right_horizon, coalesce(overlap_rows, 0) as overlap_rows, coalesce(same_label_rows, 0) as same_label_rows, coalesce(same_tick_rows, 0) as same_tick_rows, l.n as left_rows, r.n as right_rows,
  same_label_rows / cast(overlap_rows as double) as same_label_rate, coalesce(overlap_rows, 0) / cast(nullif(least(l.n, r.n), 0) as double) as overlap_rate from c l join c r on l.h < r.h left join o on o.left_horizon = l.h and o.right_horizon = r.h""", num="same_label_rate overlap_rate")
def _(t):
    return labels.horizon_overlap(training(t))


@query("h10_handoff", """
select station_id, as_of_ts - interval '1' second * cast(round(status_age_minutes * 60) as int) as status_updated_at, as_of_ts - interval '1' second * cast(round(observation_age_minutes * 60) as int) as status_observed_at, observed_count / cast(total_chargers as double) as observation_coverage, fr as freshness_flag,
  concat_ws('|', fr, case when observed_count = 0 and fr <> 'UNOBSERVED' then 'UNOBSERVED' end, case when not coord_ok then 'COORDINATE_EXCLUDED' end, case when not recommend_public_default then 'ACCESS_RESTRICTED' end, case when observed_count = 0 then 'STATUS_MISSING' end) as data_quality_flags,
  fr in ('CHECK_REQUIRED', 'UNOBSERVED') or available_count <= 1 as recheck_required, coord_ok and recommend_public_default and is_operating_now <> 'N' and observed_count > 0 as static_candidate_ready, false as availability_guaranteed
from (select *, case when status_age_minutes is null then 'UNOBSERVED' when status_age_minutes <= 5 then 'FRESH' when status_age_minutes <= 15 then 'AGING' else 'CHECK_REQUIRED' end as fr from x_d1)""", num="observation_coverage", ts="status_updated_at status_observed_at")
def _(t):
    return labels.handoff(d1(t))


def balanced_sql(multiple, floor, ceiling):
    return f"""
with l as (select *, cast(target_available_at_arrival as int) as y from x_eta_labels), c as (select count(*) filter (y = 0) as neg, count(*) filter (y = 1) as pos from l),
u as (select *, cast('0x' || substr(md5(concat_ws('|', '42', station_id, cast(feature_as_of as string))), 1, 8) as bigint) / 4294967296.0 as u from l, c)
select station_id, feature_as_of, y from u where u < case when y = 0 then least(neg, {ceiling}) / cast(neg as double) else least(pos, greatest(neg * {multiple}, {floor}), {ceiling}) / cast(pos as double) end"""


def labelled_arrivals(t):
    return stage(eta_label_rows(t).withColumn("y", F.col("target_available_at_arrival").cast("int")))


@query("h11_balanced_sample", f"select y, count(*) as n from ({balanced_sql(20, 50_000, 400_000)}) group by 1")
def _(t):
    return labels.balanced_sample(labelled_arrivals(t), "y", ["station_id", "feature_as_of"]).groupBy("y").agg(F.count("*").alias("n"))


@query("h11_balanced_sample_rows", balanced_sql(2, 500, 5_000), ts="feature_as_of")
def _(t):
    return labels.balanced_sample(labelled_arrivals(t), "y", ["station_id", "feature_as_of"], 2, 500, 5_000).select("station_id", "feature_as_of", "y")


@query("h13_arrival_gate", """
select station_id, case o when 'N' then 'DROP' when 'Y' then 'KEEP' else 'REVIEW' end as gate, eta_minutes / (straight_km / 30.0 * 60) as eta_ratio from (
  select e.*, case when use_time in ('24시간', '00:00~24:00') then 'Y' when use_time in ('비개방', '개방불가') then 'N' when use_time = '09:00~18:00' or use_time = '8~18시' or use_time = '평일 09:00~18:00, 주말 10:00~14:00' then case when m < 1080 then 'Y' else 'N' end
    when use_time = '평일 08:00~20:00, 주말 휴무' or use_time = '09시~23시' or use_time = '05:00~익일 01:00' then 'Y' when use_time = '19:00~08:00' then 'N' else 'UNKNOWN' end as o
  from (select *, 17 * 60 + 30 + floor(eta_minutes) as m from v_station_eta where eta_minutes is not null) e join x_stations using (station_id))""", num="eta_ratio")
def _(t):
    e = t.v_station_eta.where("eta_minutes is not null").join(stations(t).select("station_id", "use_time"), "station_id")
    e = e.withColumn("arrive", F.timestamp_add("SECOND", (F.col("eta_minutes") * 60).cast("int"), F.expr("timestamp_ntz'2024-01-30 17:30:00'")))
    e = operating_at(e, "use_time", F.col("arrive"), "open_state")
    return e.select("station_id", labels.arrival_gate(F.col("open_state")).alias("gate"), F.try_divide(F.col("eta_minutes"), labels.proxy_minutes(F.col("straight_km"))).alias("eta_ratio"))


@query("b32_eta_bucket", """
select l.station_id, feature_as_of, case when eta_minutes <= 10 then '<=10' when eta_minutes <= 20 then '10-20' when eta_minutes <= 40 then '20-40' else '>40' end as eta_bucket, n = 1 as single_charger, current_available_count / cast(greatest(n, 1) as double) as avail_ratio_t0
from x_eta_labels l join (select station_id, count(*) as n from v_charger_master group by 1) m using (station_id)""", num="avail_ratio_t0", ts="feature_as_of")
def _(t):
    n = t.v_charger_master.groupBy("station_id").agg(F.count("*").alias("n"))
    return eta_label_rows(t).join(n, "station_id", "left").select("station_id", "feature_as_of", clean.eta_bucket(F.col("eta_minutes")).alias("eta_bucket"), (F.col("n") == 1).alias("single_charger"), (F.col("current_available_count") / F.greatest("n", F.lit(1))).alias("avail_ratio_t0"))


@query("n24_labels_with_panel", f"""
select l.station_id, l.feature_as_of, p.known_chargers, p.availability_ratio_observed from x_eta_labels l left join x_d2 p on p.station_id = l.station_id and p.tick_ts = l.feature_as_of""", num="availability_ratio_observed", ts="feature_as_of")
def _(t):
    ticks = event_ticks(t)
    p = stage(panel.station_panel_d2(t.v_status_events, ticks))
    lab = labels.eta_labels(p, t.v_station_eta, ticks)
    return lab.join(p.select("station_id", F.col("tick_ts").alias("feature_as_of"), "known_chargers", "availability_ratio_observed"), ["station_id", "feature_as_of"], "left").select("station_id", "feature_as_of", "known_chargers", "availability_ratio_observed")


# every polled charger tick against the realtime rows of a lot: key = lot, tolerance 10 minutes
ORACLE_CTES["x_cohort"] = "select station_id, tick_ts, 'L' || cast(cast(substr(station_id, 2) as bigint) % 40 as string) as lot_id, available_count from x_d2"


def cohort(t):
    return panel.station_panel_d2(t.v_status_events, event_ticks(t)).select("station_id", "tick_ts", "tick_s", F.concat(F.lit("L"), (F.substring("station_id", 2, 20).cast("long") % 40).cast("string")).alias("lot_id"), "available_count")


ASOF_SQL = """
select c.station_id, c.tick_ts, case when r.collected_at >= c.tick_ts - interval '10' minute then r.remaining_spaces end as remaining_spaces from x_cohort c
asof left join (select lot_id, time_bucket(interval '1' second, collected_at) as collected_at, arg_max(remaining_spaces, (collected_at, id)) as remaining_spaces from v_lot_realtime group by 1, 2) r on r.lot_id = c.lot_id and c.tick_ts >= r.collected_at"""


@query("n15_asof_backward", ASOF_SQL, num="remaining_spaces", ts="tick_ts")
def _(t):
    park = t.v_lot_realtime.groupBy("lot_id", epoch_s(F.col("collected_at")).alias("park_s")).agg(F.max_by("remaining_spaces", F.struct("collected_at", "id")).cast("double").alias("remaining_spaces"))
    return labels.asof_backward(cohort(t), park, "lot_id", "tick_s", "park_s", ["remaining_spaces"], 600).select("station_id", "tick_ts", "remaining_spaces")


@query("n16_asof_forward_labels", """
select c.station_id, c.tick_ts, cast(f.available_count as double) as future_available from x_cohort c asof left join x_cohort f on f.station_id = c.station_id and f.tick_ts >= c.tick_ts + interval '15' minute
where f.tick_ts <= c.tick_ts + interval '25' minute union all
select c.station_id, c.tick_ts, null from x_cohort c asof left join x_cohort f on f.station_id = c.station_id and f.tick_ts >= c.tick_ts + interval '15' minute where f.tick_ts is null or f.tick_ts > c.tick_ts + interval '25' minute""", num="future_available", ts="tick_ts")
def _(t):
    return labels.forward_state(cohort(t), 15, "available_count").select("station_id", "tick_ts", F.col("future_available").cast("double").alias("future_available"))


@query("h12_parking_cohort", """
with st as (select best_station_id as station_id, arg_min(lot_id, (best_distance_m, lot_id)) as lot_id from x_coloc where best_grade = 'STRONG' group by 1),
co as (select d.station_id, d.tick_ts, st.lot_id, d.available_count from x_d2 d join st using (station_id)),
pk as (select lot_id, time_bucket(interval '1' second, collected_at) as at, arg_max(remaining_spaces, (collected_at, id)) as remaining_spaces from v_lot_realtime group by 1, 2)
select c.station_id, c.tick_ts, c.lot_id, case when r.at >= c.tick_ts - interval '10' minute then r.remaining_spaces end as remaining_spaces, case when r.at >= c.tick_ts - interval '10' minute then epoch(c.tick_ts - r.at) / 60.0 end as lag_minutes,
  cast(case when f.tick_ts <= c.tick_ts + interval '25' minute then f.available_count >= 1 end as double) as target_available
from co c asof left join pk r on r.lot_id = c.lot_id and c.tick_ts >= r.at asof left join co f on f.station_id = c.station_id and f.tick_ts >= c.tick_ts + interval '15' minute""", num="remaining_spaces lag_minutes target_available", ts="tick_ts")
def _(t):
    pairs = labels.strong_pairs(matching.colocated_lots(spatial.nearest_within(stations(t), t.v_lots, "lot_id", 1000.0), t.v_lots))
    co = cohort(t).drop("lot_id").join(pairs.select("station_id", "lot_id"), "station_id")
    park = t.v_lot_realtime.groupBy("lot_id", epoch_s(F.col("collected_at")).alias("park_s")).agg(F.max_by("remaining_spaces", F.struct("collected_at", "id")).cast("double").alias("remaining_spaces"))
    joined = labels.asof_backward(co, park, "lot_id", "tick_s", "park_s", ["remaining_spaces"], 600)
    return labels.forward_state(joined, 15, "available_count").select("station_id", "tick_ts", "lot_id", "remaining_spaces", "lag_minutes", F.col("target_available").cast("double").alias("target_available"))
