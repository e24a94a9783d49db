"""Streams over the given tables, drained once. Open windows, sessions and holds are not emitted before the watermark."""
import uuid

from pyspark.sql import functions as F

import chargelens.plans.q_sources  # noqa: F401
from chargelens.functions.exprs import from_epoch
from chargelens.operators import snapshots
from chargelens.plans.q_sources import snapshot_text
from chargelens.plans.registry import query
from chargelens.session import shared_dir
from chargelens.streaming import streams


def live(t):
    return streams.StreamTables(t.spark, t.sf_dir)


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("l1_snapshot_file_stream", "select station_id, charger_id, tick_ts, stat, count(*) as n from v_status_events group by 1, 2, 3, 4", ts="tick_ts")
def _(t):
    root = f"{shared_dir(t.spark)}/landing-{uuid.uuid4().hex}"
    snapshot_text(t).repartition("day").write.option("header", True).partitionBy("day").csv(root)
    events = snapshots.typed_events(streams.snapshot_files(t.spark, root, files_per_batch=10))
    return streams.drain_append(events, "events").groupBy("station_id", "charger_id", "tick_ts", "stat").agg(F.count("*").alias("n"))


@query("l2_stream_dedupe", "select station_id, charger_id, tick_ts, stat, event_id from x_dedup", ts="tick_ts")
def _(t):
    return streams.deduped(live(t).v_status_events)[0].select("station_id", "charger_id", "tick_ts", "stat", "event_id")


@query("l2_stream_exact_copies", "select count(*) as n_rows, count(distinct event_id) as n_ids from v_status_events")
def _(t):
    ev = live(t).v_status_events.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return streams.drain_append(streams.without_copies(ev), "copies").agg(F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))


@query("l3_stream_sessions", """
with i as (select *, sum(case when prev is null or fetched_at >= prev + interval '25' minute then 1 else 0 end) over (partition by station_id, charger_id order by fetched_at, event_id) as s from (
  select *, lag(fetched_at) over (partition by station_id, charger_id order by fetched_at, event_id) as prev from v_status_events))
select station_id, charger_id, min(fetched_at) as start_ts, max(fetched_at) + interval '25' minute as end_ts, count(*) as n from i group by station_id, charger_id, s having max(fetched_at) + interval '25' minute <= (select max(fetched_at) - interval '10' minute from v_status_events)""", ts="start_ts end_ts")
def _(t):
    ev = live(t).v_status_events.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return ntz(streams.drain_append(streams.collection_sessions(ev), "sessions"), "start_ts", "end_ts")


@query("l4_stream_bounded_hold", """
with n as (select *, lead(tick_ts) over (partition by station_id, charger_id order by tick_ts) as nxt from x_dedup)
select station_id, charger_id, stat, tick_ts as from_ts, case when nxt <= tick_ts + interval '25' minute then nxt else tick_ts + interval '25' minute end as until_ts, coalesce(nxt > tick_ts + interval '25' minute, true) as expired
from n where nxt is not null or tick_ts + interval '25' minute < (select max(stat_updated_at) - interval '10' minute from v_status_events)""", ts="from_ts until_ts")
def _(t):
    ev = live(t).v_status_events.withColumn("stat_updated_at", F.col("stat_updated_at").cast("timestamp"))
    held = streams.drain_append(streams.bounded_hold(ev), "hold")
    return held.select("station_id", "charger_id", "stat", from_epoch(F.col("from_s")).alias("from_ts"), from_epoch(F.col("until_s")).alias("until_ts"), "expired")


@query("l5_stream_fleet_windows", """
select tick_ts as start_ts, tick_ts + interval '10' minute as end_ts, count(*) as n_rows, count(*) filter (stat = 2) as available, count(*) filter (stat = 3) as in_use from v_status_events
group by tick_ts having tick_ts + interval '10' minute <= (select max(stat_updated_at) - interval '10' minute from v_status_events)""", ts="start_ts end_ts")
def _(t):
    ev = live(t).v_status_events.withColumn("stat_updated_at", F.col("stat_updated_at").cast("timestamp"))
    return ntz(streams.drain_append(streams.fleet_windows(ev), "fleet"), "start_ts", "end_ts")


@query("l6_stream_parking_windows", """
with w as (select *, time_bucket(interval '10' minute, collected_at) - interval '10' minute * k as start_ts from v_lot_realtime, range(6) r(k))
select lot_id, start_ts, start_ts + interval '1' hour as end_ts, stddev_pop(remaining_spaces) as remaining_std, cast(arg_max(remaining_spaces, (collected_at, id)) - arg_min(remaining_spaces, (collected_at, id)) as double) as remaining_delta, count(*) as ticks
from w group by 1, 2 having start_ts + interval '1' hour <= (select max(collected_at) - interval '10' minute from v_lot_realtime)""", num="remaining_std remaining_delta", ts="start_ts end_ts")
def _(t):
    rt = live(t).v_lot_realtime.withColumn("collected_at", F.col("collected_at").cast("timestamp"))
    return ntz(streams.drain_append(streams.parking_windows(rt), "parking"), "start_ts", "end_ts")


@query("l7_stream_current_state", "select station_id, charger_id, stat, event_id from (select *, row_number() over (partition by station_id, charger_id order by stat_updated_at desc, event_id desc) as rn from v_status_events) where rn = 1")
def _(t):
    return streams.current_state(live(t).v_status_events).select("station_id", "charger_id", "stat", "event_id")


@query("l8_stream_incremental_append", "select count(*) as n_rows, max(id) as cursor from v_lot_realtime")
def _(t):
    root = f"{shared_dir(t.spark)}/append-{uuid.uuid4().hex}"
    src = live(t).v_lot_realtime.select("id", "lot_id", "collected_at", "remaining_spaces")
    for _ in range(2):  # the second run finds nothing new
        out = streams.drain_append(src, "append", f"{root}/ckpt", f"{root}/table")
    return out.agg(F.count("*").alias("n_rows"), F.max("id").alias("cursor"))
