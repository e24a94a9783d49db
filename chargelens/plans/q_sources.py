"""Sources, sinks and set operations, on files that Spark writes from the given tables first."""
import uuid

from pyspark.sql import functions as F

import chargelens.plans.q_clean  # noqa: F401
from chargelens.functions import codes
from chargelens.operators import clean, panel, sets, snapshots
from chargelens.plans.common import event_ticks
from chargelens.plans.registry import query
from chargelens.session import shared_dir
from chargelens.sources import files


def folder(t, name):
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def snapshot_text(t):
    """Events in the text layout of a snapshot file."""
    return t.v_status_events.select(
        F.col("station_id").alias("statId"), F.col("charger_id").alias("chgerId"), F.col("stat").cast("string").alias("stat"), F.date_format("stat_updated_at", "yyyyMMddHHmmss").alias("statUpdDt"),
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetchedAt"), F.date_format("tick_ts", "yyyyMMdd_HHmmss").alias("snapshotId"), F.col("page_no").cast("string").alias("pageNo"), F.to_date("tick_ts").alias("day"),
    )


@query("a1_snapshot_csvs", "select station_id, charger_id, tick_ts, stat, count(*) as n from v_status_events group by 1, 2, 3, 4", ts="tick_ts")
def _(t):
    root = folder(t, "snapshots")
    snapshot_text(t).repartition("day").write.option("header", True).partitionBy("day").csv(root)
    ev = snapshots.typed_events(files.read_snapshots(t.spark, [root, root]))  # the second root repeats every file name
    return ev.groupBy("station_id", "charger_id", "tick_ts", "stat").agg(F.count("*").alias("n"))


@query("a2_live_over_archive", """
select event_id, case when tick_ts >= timestamp '2024-01-16' then 'live' else 'archive' end as source from v_status_events where tick_ts >= timestamp '2024-01-16' or tick_ts < timestamp '2024-01-20' """)
def _(t):
    ev = t.v_status_events
    live = ev.where("tick_ts >= timestamp_ntz'2024-01-16 00:00:00'").withColumn("source", F.lit("live"))
    archive = ev.where("tick_ts < timestamp_ntz'2024-01-20 00:00:00'").withColumn("source", F.lit("archive"))
    return files.prefer_live(live, archive).select("event_id", "source")


@query("a3_charger_info_csv", "select station_id, charger_id, nullif(busi_nm, '') as busi_nm, nullif(limit_yn, '') as limit_yn from v_charger_master")
def _(t):
    path = folder(t, "info")
    t.v_charger_master.withColumnsRenamed({v: k for k, v in files.INFO_NAMES.items()}).write.option("header", True).csv(path)
    return files.read_charger_info(t.spark, path).select("station_id", "charger_id", "busi_nm", "limit_yn")


@query("a4_latest_file_per_kind", "select 'lots' as kind, true as found union all select 'nodes', true")
def _(t):
    root = folder(t, "kinds")
    t.v_lots.write.option("header", True).csv(f"{root}/lots")
    t.v_nodes.write.option("header", True).csv(f"{root}/nodes")
    kind = F.regexp_extract("path", r"/(\w+)/[^/]+\.csv$", 1)
    return files.latest_files(t.spark, root, kind).select("kind", F.endswith("path", F.lit(".csv")).alias("found"))


@query("a5_usage_csv_encodings", "select cast(use_date as string) as use_date, station_id, charger_id, charger_type, cast(sessions as double) as sessions, kwh from v_usage_daily", num="sessions kwh")
def _(t):
    """A folder of exports in three code pages and two column orders."""
    path = folder(t, "usage")
    back = {v: k for k, v in files.USAGE_HEADERS.items()}
    part = F.pmod(F.crc32(F.col("station_id").cast("binary")), F.lit(3))
    for i, encoding in enumerate(files.USAGE_ENCODINGS):
        rows = t.v_usage_daily.where(part == i)
        rows.select(*(rows.columns if i else rows.columns[::-1])).withColumnsRenamed(back).write.option("header", True).option("encoding", encoding).csv(f"{path}/export-{i}")
    return files.read_usage(t.spark, path)


LOT_ITEMS = "(select id, api_type, unnest(cast(payload -> '$.data' as json[])) as it from v_lot_payloads where json_valid(payload))"


@query("a6_parking_payload_info", f"""
select it ->> '$.prkInfo.pkltId' as lot_id, it ->> '$.prkInfo.pkltNm' as lot_name, coalesce(it ->> '$.prkFcltInfo.roadNmAddr', it ->> '$.prkFcltInfo.lotnoAddr') as addr, cast(it ->> '$.prkFcltInfo.lat' as double) as lat, cast(it ->> '$.prkFcltInfo.lot' as double) as lng,
  cast(it ->> '$.prkFcltInfo.prkNocmprt' as double) as total_spaces, it ->> '$.prkOperInfo.wkdayOperBgngHr' as open_hr from {LOT_ITEMS} where api_type = 'parking_info'""", num="lat lng total_spaces")
def _(t):
    return clean.lot_info(t.v_lot_payloads)


@query("a6_parking_payload_realtime", f"""
select lot_id, tot as total_spaces, rem as remaining_spaces, st as congestion_status, round_even((tot - rem) * 100 / nullif(tot, 0), 2) as occupancy_rate from (
  select it ->> '$.rltmPrkInfo.pkltId' as lot_id, cast(it ->> '$.rltmPrkInfo.totPrkNocmprt' as double) as tot, cast(it ->> '$.rltmPrkInfo.totRmndPrkNocmprt' as double) as rem, it ->> '$.rltmPrkInfo.prkCnfSttsCd' as st from {LOT_ITEMS} where api_type = 'parking_realtime')""", num="total_spaces remaining_spaces occupancy_rate")
def _(t):
    return clean.lot_realtime(t.v_lot_payloads)


@query("a7_incremental_append", "select count(*) as n_rows, count(distinct id) as n_ids, max(id) as cursor from v_lot_realtime")
def _(t):
    target = folder(t, "incremental")
    rt = t.v_lot_realtime.select("id", "lot_id", "remaining_spaces")
    files.append_new(rt.where("collected_at < timestamp_ntz'2024-01-15 00:00:00'"), target)
    files.append_new(rt, target)
    return files.append_new(rt, target).agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.max("id").alias("cursor"))


@query("a8_daily_rollup", "select cast(date as string) as date, raw_rows, snapshots, dedup_rows from (select cast(tick_ts as date) as date, count(*) as raw_rows, count(distinct tick_ts) as snapshots from v_status_events group by 1) join (select cast(tick_ts as date) as date, count(*) as dedup_rows from x_dedup group by 1) using (date)")
def _(t):
    kept = files.write_by_date(snapshots.dedupe_snapshot_rows(t.v_status_events), folder(t, "daily"), "tick_ts")
    return files.daily_rollup(t.v_status_events, kept)


ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+09:00'"


@query("a9_history_json", f"""
select station_id as "stationId", charger_id as "chargerId", case stat when 2 then 'AVAILABLE' when 3 then 'CHARGING' when 9 then 'UNKNOWN' else 'OUT_OF_SERVICE' end as status, {ISO.format('stat_updated_at')} as "statusUpdatedAt", {ISO.format('fetched_at')} as "observedAt"
from (select *, row_number() over (partition by tick_ts, station_id, charger_id order by event_id) as rn from v_status_events) where rn = 1""")
def _(t):
    path = folder(t, "history")
    records = files.history_records(t.v_status_events, codes.official_smart(F.col("stat")))
    records.write.json(path)
    return t.spark.read.schema(records.schema).json(path)


@query("a10_d2_parquet_sink", "select cast(cast(tick_ts as date) as string) as date, count(*) as n_rows, count(distinct station_id) as stations from x_d2 group by 1")
def _(t):
    d2 = panel.station_panel_d2(t.v_status_events, event_ticks(t))
    return files.write_by_date(d2, folder(t, "d2-latest"), "tick_ts").groupBy("date").agg(F.count("*").alias("n_rows"), F.count_distinct("station_id").alias("stations"))


@query("a11_master_split", """
select case when coordinate_quality_flag <> 'OK' then 'quarantine' when is_service_target then 'service' else 'flagged' end as part, count(*) as n from x_info group by 1""")
def _(t):
    root = folder(t, "split")
    info = clean.annotate_info(t.v_charger_master)
    part = F.when(~F.col("coord_ok"), "quarantine").when(F.col("is_service_target"), "service").otherwise("flagged")
    info.withColumn("part", part).write.partitionBy("part").parquet(root)
    return t.spark.read.parquet(root).groupBy("part").agg(F.count("*").alias("n"))


# columns of the inventoried tables and the one that tells their time
INVENTORY = {"events": (("event_id", "ts", "user_id", "event_type", "value", "props"), "ts"), "nation": (("n_nationkey", "n_name", "n_regionkey"), None)}


def inventory_sql(name):
    columns, time = INVENTORY[name]
    line = "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as string), '')" for c in columns) + ")"
    span = [f"{f}({time})" if time else "cast(null as timestamp)" for f in ("min", "max")]
    return f"select '{name}.parquet' as file_name, count(*) as n_rows, {len(columns)} as n_columns, '{','.join(columns)}' as columns, (select {line} from {name} limit 1) as head, {span[0]} as first_ts, {span[1]} as last_ts from {name}"


@query("a12_file_inventory", " union all ".join(map(inventory_sql, INVENTORY)), ts="first_ts last_ts")
def _(t):
    parts = []
    for name, (_, time) in INVENTORY.items():
        df = getattr(t, name)
        time = F.col(time) if time else F.lit(None)
        parts.append(files.inventory(df, time.cast("timestamp_ntz")))
    return parts[0].unionByName(parts[1])


@query("k1_changed_station_ids", """
with a as (select distinct station_id from v_charger_master where limit_yn = 'Y'), b as (select distinct station_id from v_usage_daily where charger_type = 'fast')
select station_id, 'added' as change from b where station_id not in (select station_id from a) union all select station_id, 'removed' from a where station_id not in (select station_id from b)""")
def _(t):
    return sets.changed_ids(t.v_charger_master.where("limit_yn = 'Y'"), t.v_usage_daily.where("charger_type = 'fast'"), "station_id")


@query("k2_one_sided_lots", "select lot_id, 'realtime_only' as side from (select distinct lot_id from v_lot_realtime) where lot_id not in (select lot_id from v_lots) union all select lot_id, 'info_only' from v_lots where lot_id not in (select lot_id from v_lot_realtime)")
def _(t):
    out = sets.changed_ids(t.v_lots, t.v_lot_realtime, "lot_id")
    return out.select("lot_id", F.when(F.col("change") == "added", "realtime_only").otherwise("info_only").alias("side"))


@query("k3_status_master_overlap", "select (select count(*) from (select distinct station_id, charger_id from v_charger_master)) as left_keys, (select count(*) from x_chargers) as right_keys, (select count(*) from x_chargers join (select distinct station_id, charger_id from v_charger_master) using (station_id, charger_id)) as common_keys")
def _(t):
    return sets.overlap(t.v_charger_master, t.v_status_events, ["station_id", "charger_id"])


@query("k4_union_by_name", "select poi_id as id, poi_type, cast(null as bigint) as total_spaces from v_pois union all select lot_id, null, total_spaces from v_lots", num="total_spaces")
def _(t):
    a = t.v_pois.select(F.col("poi_id").alias("id"), "poi_type")
    return a.unionByName(t.v_lots.select(F.col("lot_id").alias("id"), F.col("total_spaces").cast("double").alias("total_spaces")), allowMissingColumns=True)
