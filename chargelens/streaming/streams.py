"""Streaming forms of the batch operators. Sinks are idempotent per batch, so a replayed batch changes nothing."""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chargelens.functions.exprs import epoch_s
from chargelens.operators.snapshots import CHARGER, keep_one
from chargelens.session import shared_dir
from chargelens.sources.files import SNAPSHOT_SCHEMA
from chargelens.sources.views import Tables

DELAY = "10 minutes"


class StreamTables(Tables):
    """The given tables as file streams; row-wise views work on them unchanged."""

    def _given(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)


def _new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def snapshot_files(spark: SparkSession, root: str, files_per_batch: int = 500) -> DataFrame:
    """Snapshot CSVs as they appear, as text columns."""
    return (
        spark.readStream.schema(SNAPSHOT_SCHEMA).option("header", True).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).csv(root)
        .withColumn("row_no", F.xxhash64(*SNAPSHOT_SCHEMA.names))  # streams have no row position; ties fall to a hash
    )


def drain_append(stream: DataFrame, name: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Run all available input through an append sink and read the result. The checkpoint is the cursor: a second run
    with the same two folders only takes new files."""
    spark = stream.sparkSession
    out = out or _new_dir(spark, name)
    q = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint or _new_dir(spark, f"{name}-ckpt")).outputMode("append").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


class Drained(NamedTuple):
    """What a drained stream left: the folder of its changes, and the rows it refused as too late."""

    changes: str
    late: int


def drain_changes(aggregated: DataFrame, name: str, root: str | None = None) -> Drained:
    """Run all available input of a grouped stream and write, per batch, only the keys whose row changed.

    The groups live in the state store, so a batch costs what it touches. A replayed batch writes its own folder again.
    Rows that the watermark refuses are counted from the stream's own progress.
    """
    spark = aggregated.sparkSession
    root = root or _new_dir(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    q = aggregated.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{root}/cursor").trigger(availableNow=True).start()
    q.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    return Drained(root, late)


def _found(read: DataFrameReader, path: str) -> DataFrame | None:
    """The files of a folder, None where there is no folder yet."""
    try:
        return read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest_base(spark: SparkSession, root: str) -> int | None:
    done = _found(spark.read.schema("upto long"), f"{root}/bases")
    return None if done is None else done.agg(F.max("upto")).first()[0]


def latest_changes(spark: SparkSession, root: str, keys: Iterable[str], schema: T.StructType) -> DataFrame:
    """Newest row per key over the base, if `compact` wrote one, and the changes after it."""
    base = _newest_base(spark, root)
    fields = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = _found(spark.read.schema(fields), f"{root}/changes")
    rows = spark.createDataFrame([], fields) if rows is None else rows.where(F.col("batch") > (-1 if base is None else base))
    if base is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{root}/base-{base}").withColumn("batch", F.lit(base).cast("long")))
    return keep_one(rows, keys, ("batch",)).select(*schema.names)


def compact(spark: SparkSession, root: str, keys: Iterable[str], schema: T.StructType) -> int:
    """Folds the changes so far into one base table and returns the last batch it holds. To be run now and then between
    streams, so that readers need not fold a long history; a base counts from its entry in `bases`, made when it is whole."""
    upto = spark.read.parquet(f"{root}/changes").agg(F.max("batch").cast("long")).first()[0]
    latest_changes(spark, root, keys, schema).write.mode("overwrite").parquet(f"{root}/base-{upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{root}/bases")
    return upto


def newest_per_key(events: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """Grouped stream: the row with the greatest `order` per key."""
    keys, order = list(keys), list(order)
    rest = [c for c in events.columns if c not in keys]
    best = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def deduped(events: DataFrame, root: str | None = None, delay: str = DELAY) -> tuple[DataFrame, int]:
    """(rows, late): keep-latest per poll and charger, and how many rows came too late.

    A poll's groups stay in the state until the watermark on the poll's time has passed them; rows for older polls are
    dropped and counted. A later run on the same `root` goes on from its state and equals one run over everything.
    """
    names = events.columns
    keys = ("tick_ts", *CHARGER)
    timed = events.withColumn("tick_ts", F.col("tick_ts").cast("timestamp")).withWatermark("tick_ts", delay)
    best = newest_per_key(timed, keys, ("stat_updated_at", "page_no", "event_id"))
    left = drain_changes(best, "dedup", root)
    return latest_changes(events.sparkSession, left.changes, keys, best.schema).withColumn("tick_ts", F.col("tick_ts").cast("timestamp_ntz")).select(*names), left.late


def without_copies(events: DataFrame) -> DataFrame:
    """Exact copies dropped while their time is within the watermark."""
    return events.withWatermark("fetched_at", DELAY).dropDuplicatesWithinWatermark(["event_id", *CHARGER])


def collection_sessions(events: DataFrame, gap: str = "25 minutes") -> DataFrame:
    w = F.session_window("fetched_at", gap)
    return events.withWatermark("fetched_at", DELAY).groupBy(w, *CHARGER).agg(F.count("*").alias("n")).select(
        *CHARGER, F.col("session_window.start").alias("start_ts"), F.col("session_window.end").alias("end_ts"), "n"
    )


def fleet_windows(events: DataFrame, size: str = "10 minutes") -> DataFrame:
    w = F.window("stat_updated_at", size)
    return events.withWatermark("stat_updated_at", DELAY).groupBy(w).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("stat") == 2).alias("available"), F.count_if(F.col("stat") == 3).alias("in_use")
    ).select(F.col("window.start").alias("start_ts"), F.col("window.end").alias("end_ts"), "n_rows", "available", "in_use")


def parking_windows(ticks: DataFrame, size: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    w = F.window("collected_at", size, slide)
    order = F.struct("collected_at", "id")
    return ticks.withWatermark("collected_at", DELAY).groupBy(w, "lot_id").agg(
        F.stddev_pop("remaining_spaces").alias("remaining_std"), (F.max_by("remaining_spaces", order) - F.min_by("remaining_spaces", order)).alias("remaining_delta"), F.count("*").alias("ticks")
    ).select("lot_id", F.col("window.start").alias("start_ts"), F.col("window.end").alias("end_ts"), "remaining_std", F.col("remaining_delta").cast("double").alias("remaining_delta"), "ticks")


def bounded_hold(events: DataFrame, hold_s: int = 1500) -> DataFrame:
    """Validity intervals of each charger's state: until its next observation, at most `hold_s`; an event-time timer
    closes the last one. State per charger is one open interval."""

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            stat, start, _ = state.get
            state.remove()
            yield pd.DataFrame({"station_id": [key[0]], "charger_id": [key[1]], "stat": [stat], "from_s": [start], "until_s": [start + hold_s], "expired": [True]})
            return
        rows = pd.concat(list(chunks))[["tick_s", "event_us", "stat"]].sort_values(["tick_s", "event_us"]).drop_duplicates("tick_s", keep="last")  # one poll = one row
        if state.exists:
            stat, start, us = state.get
            same = rows["tick_s"] == start
            rows = rows[(rows["tick_s"] > start) | (same & (rows["event_us"] > us))]
            if not same.any():
                rows = pd.concat([pd.DataFrame({"tick_s": [start], "event_us": [us], "stat": [stat]}), rows])
            elif rows.empty:
                rows = pd.DataFrame({"tick_s": [start], "event_us": [us], "stat": [stat]})
        closed, last = rows.iloc[:-1], rows.iloc[-1]
        nxt = rows["tick_s"].shift(-1).iloc[:-1].astype("int64")
        state.update((int(last["stat"]), int(last["tick_s"]), int(last["event_us"])))
        due = (int(last["tick_s"]) + hold_s) * 1000
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if len(closed):
            until = nxt.where(nxt - closed["tick_s"] <= hold_s, closed["tick_s"] + hold_s)
            yield pd.DataFrame({"station_id": key[0], "charger_id": key[1], "stat": closed["stat"].astype("int32"), "from_s": closed["tick_s"].astype("int64"), "until_s": until.astype("int64"), "expired": (nxt - closed["tick_s"]) > hold_s})

    rows = events.withWatermark("stat_updated_at", DELAY).select(*CHARGER, "stat_updated_at", "stat", epoch_s(F.col("tick_ts")).alias("tick_s"), F.unix_micros(F.col("stat_updated_at").cast("timestamp")).alias("event_us"))
    return rows.groupBy(*CHARGER).applyInPandasWithState(
        step, "station_id string, charger_id string, stat int, from_s long, until_s long, expired boolean", "stat int, tick_s long, event_us long", "append", GroupStateTimeout.EventTimeTimeout
    )


def current_state(events: DataFrame, root: str | None = None) -> DataFrame:
    """Newest state per charger. The state store holds one row per charger; a batch writes the chargers it changed."""
    best = newest_per_key(events, CHARGER, ("stat_updated_at", "event_id"))
    left = drain_changes(best, "current", root)
    return latest_changes(events.sparkSession, left.changes, CHARGER, best.schema).select(*events.columns)
