"""De-duplication and as-of selection of status polls.

Every "keep one row" rule is an aggregate, so copies are folded before the shuffle and a key holding a large share
of all rows never travels as a whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargelens.functions.codes import internal_status
from chargelens.functions.exprs import epoch_s

CHARGER = ("station_id", "charger_id")


def keep_one(df: DataFrame, keys, order, *, last: bool = True) -> DataFrame:
    """The row with the greatest (or least) `order` per key; NULLs sort lowest."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    out = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def dedupe_snapshot_rows(events: DataFrame) -> DataFrame:
    """One row per poll and charger: newest event time, then page, then source order."""
    return keep_one(events, ("tick_ts", *CHARGER), ("stat_updated_at", "page_no", "event_id"))


def newest_poll(events: DataFrame) -> Column:
    """Reference time as a scalar subquery: nothing runs until the plan that uses it does."""
    return events.agg(F.max("fetched_at")).scalar()


def latest_status_as_of(events: DataFrame, as_of: Column) -> DataFrame:
    """Newest status per charger with event time and observation time both not after `as_of`, and the two ages."""
    seen = dedupe_snapshot_rows(events).where(
        (F.col("stat_updated_at") <= as_of) & (F.col("fetched_at") <= as_of)
    )
    out = seen.groupBy(*CHARGER).agg(
        F.max_by(F.struct("stat", "stat_updated_at", "tick_ts"), F.struct("stat_updated_at", "fetched_at")).alias("_r"),
        F.max("fetched_at").alias("last_seen_at"),
    )
    return out.select(
        *CHARGER,
        F.col("_r.stat").alias("stat"),
        internal_status(F.col("_r.stat")).alias("stat_mapped"),
        F.col("_r.stat_updated_at").alias("stat_updated_at"),
        (F.timestamp_diff("MICROSECOND", F.col("_r.stat_updated_at"), as_of) / F.lit(1e6)).alias("status_age_seconds"),
        "last_seen_at",
        (F.timestamp_diff("MICROSECOND", F.col("last_seen_at"), as_of) / F.lit(1e6)).alias("observation_age_seconds"),
        F.col("_r.tick_ts").alias("tick_ts"),
    )


def master_with_status(master: DataFrame, latest: DataFrame) -> DataFrame:
    """Left join: a charger without status is marked as not observed, never as unavailable."""
    st = latest.select(*CHARGER, *[F.col(c).alias("status_code" if c == "stat" else c) for c in latest.columns if c not in CHARGER])
    out = master.join(st, list(CHARGER), "left")
    missing = F.col("stat_mapped").isNull()
    return out.withColumns({
        "status_missing": missing,
        "availability_note": F.when(missing, "NO_STATUS_OBSERVED").otherwise("STATUS_OBSERVED"),
    })


def first_per_station(chargers: DataFrame, order=("charger_id",)) -> DataFrame:
    return keep_one(chargers, ("station_id",), order, last=False)


def last_per_incident(incidents: DataFrame) -> DataFrame:
    return keep_one(incidents, ("incident_id",), ("start_ts", "event_id"))


def duplicate_audit_sample(events: DataFrame, sample_groups: int, seed: str = "42") -> DataFrame:
    """Rows of duplicate groups with their rank: every group with conflicting status, plus a seeded sample of the rest.

    The sample is the feature (an audit sheet). Groups are ranked by hash; the cut is a top-k, which Spark takes per
    partition before the merge.
    """
    keys = ["tick_ts", *CHARGER]
    groups = events.groupBy(*keys).agg(
        F.count("*").alias("group_rows"), F.min("stat").alias("_lo"), F.max("stat").alias("_hi"), F.max(F.struct("stat_updated_at", "page_no", "event_id")).alias("_win")
    ).where("group_rows > 1").withColumn("status_conflict", F.col("_lo") != F.col("_hi"))
    key_text = F.concat_ws("|", F.lit(seed), F.date_format("tick_ts", "yyyyMMddHHmmss"), *CHARGER)
    plain = groups.where(~F.col("status_conflict")).withColumn("_h", F.md5(key_text)).orderBy("_h").limit(sample_groups).drop("_h")
    chosen = groups.where("status_conflict").unionByName(plain)
    order = F.struct("stat_updated_at", "page_no", "event_id")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order.desc()))  # copies of one charger in one poll
    return events.join(chosen, keys).select(
        *keys, "event_id", "stat", "page_no", "group_rows", "status_conflict",
        F.when(F.col("status_conflict"), "status_conflict").otherwise("same_status_duplicate").alias("sample_group"),
        (order == F.col("_win")).alias("selected"), place.alias("selection_rank"),
    )


def event_age(events: DataFrame) -> DataFrame:
    """Minutes from the state change to the poll that returned it."""
    return events.withColumn("age_minutes", F.timestamp_diff("MICROSECOND", F.col("stat_updated_at"), F.col("fetched_at")) / F.lit(60e6))


def typed_events(raw: DataFrame) -> DataFrame:
    """Text snapshot columns to the event schema; ids stay text, unreadable times become NULL."""
    tick = F.try_to_timestamp("snapshotId", F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    fetched = F.try_to_timestamp("fetchedAt").cast("timestamp_ntz")
    return raw.select(
        F.col("statId").alias("station_id"), F.col("chgerId").alias("charger_id"),
        tick.alias("tick_ts"), F.coalesce(fetched, tick).alias("fetched_at"),
        F.try_to_timestamp("statUpdDt", F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz").alias("stat_updated_at"),
        F.col("row_no").cast("long").alias("event_id"),
        F.col("stat").try_cast(T.IntegerType()).alias("stat"),
        F.coalesce(F.col("pageNo").try_cast(T.IntegerType()), F.lit(-1)).alias("page_no"),
    )
