"""Driver contract, a sample of queries against their oracles, and multi-batch streams against batch operators."""
import pytest
from pyspark.sql import functions as F

import check_queries
from chargelens.operators import snapshots
from chargelens.session import shared_dir
from chargelens.streaming import streams

SF = "/root/testdata/sf0.001"
SAMPLE = ["c1_dedupe_snapshot_rows", "e5_station_tick_panel", "n13_rate_lags", "n10_poi_station_links", "b6_annotate_charger_info", "f11_usage_level_and_percentile", "h1_observed_labels", "j1_associations", "l4_stream_bounded_hold"]


@pytest.fixture(scope="module")
def contract():
    import __spark_entry__ as e

    return e.queries(), e.oracle_sql()


def test_oracle_names_are_queries(contract):
    queries, oracles = contract
    assert set(oracles) <= set(queries) and len(queries) > 180


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, contract, name):
    status, rows, note, _ = check_queries.compare(name, spark, check_queries.connect(SF), *contract, SF)
    assert status == "ok", (rows, note)


def _polls(spark, root, parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "station_id string, charger_id string, tick_ts timestamp, stat_updated_at timestamp, event_id long, stat int, page_no int").coalesce(1).write.mode("append").parquet(f"{root}/p{i}")


def test_hold_over_several_batches(spark):
    """Each poll arrives in its own batch; the state must carry over and expire."""
    import uuid
    from datetime import datetime, timedelta

    t0 = datetime(2026, 1, 1, 0, 0)
    at = lambda m: t0 + timedelta(minutes=m)
    root = f"{shared_dir(spark)}/hold-{uuid.uuid4().hex}"
    schema = "station_id string, charger_id string, tick_ts timestamp, stat_updated_at timestamp, event_id long, stat int, page_no int"
    ckpt, out = f"{root}-ckpt", f"{root}-out"
    got = None
    for i, (m, stat) in enumerate([(0, 2), (10, 3), (60, 2), (200, 2)]):
        _polls(spark, root, [[("A", "1", at(m), at(m), i, stat, 1)]])
        src = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(root).withColumn("tick_ts", F.col("tick_ts").cast("timestamp_ntz"))
        got = streams.drain_append(streams.bounded_hold(src), "hold", ckpt, out)
    rows = sorted((r.from_s, r.until_s - r.from_s, r.stat, r.expired) for r in got.collect())
    assert [(d, s, e) for _, d, s, e in rows] == [(600, 2, False), (1500, 3, True), (1500, 2, True)]


SCHEMA = "station_id string, charger_id string, tick_ts timestamp_ntz, stat_updated_at timestamp_ntz, event_id long, stat int, page_no int"
NAMES = SCHEMA.replace(",", "").split()[::2]


def _poll(charger, minute, event, stat):
    from datetime import datetime, timedelta

    t0 = datetime(2026, 1, 1, 0, 0)
    return ("A", charger, t0 + timedelta(minutes=minute - minute % 10), t0 + timedelta(minutes=minute), event, stat, 1)


def _source(spark, root):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}-in")


def _arrive(spark, root, i, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}-in/p{i}")


def _rows(df):
    return sorted(map(tuple, df.select(*NAMES).collect()))


@pytest.mark.parametrize("step", [streams.current_state, lambda *a: streams.deduped(*a)[0]], ids=["current", "deduped"])
def test_restart_on_one_folder_equals_one_run(spark, step):
    """A second run takes only new files and goes on from what the first one kept; a third finds nothing new."""
    import uuid

    root = f"{shared_dir(spark)}/restart-{uuid.uuid4().hex}"
    for i, rows in enumerate([[_poll("1", 0, 0, 2), _poll("2", 0, 1, 3)], [_poll("1", 10, 2, 3), _poll("1", 12, 3, 2), _poll("2", 3, 4, 4)], []]):
        if rows:
            _arrive(spark, root, i, rows)
        got = _rows(step(_source(spark, root), root))
    assert got == _rows(step(_source(spark, root), f"{root}-once"))
    assert [r[4] for r in got] in ([3, 4], [0, 3, 4])


def test_only_changed_keys_are_written_and_compacted(spark):
    import uuid

    root = f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"
    _arrive(spark, root, 0, [_poll(str(c), 0, c, 2) for c in range(50)])
    streams.current_state(_source(spark, root), root)
    _arrive(spark, root, 1, [_poll("7", 20, 100, 3), _poll("7", 15, 101, 4), _poll("x", 20, 102, 2)])
    got = _rows(streams.current_state(_source(spark, root), root))
    per = {r.batch: r["count"] for r in spark.read.parquet(f"{root}/changes").groupBy("batch").count().collect()}
    assert sorted(per.values()) == [2, 50] and len(got) == 51
    schema = spark.createDataFrame([], SCHEMA).select(*streams.CHARGER, *[c for c in NAMES if c not in streams.CHARGER]).schema
    assert streams.compact(spark, root, streams.CHARGER, schema) == max(per)
    assert _rows(streams.latest_changes(spark, root, streams.CHARGER, schema)) == got
    _arrive(spark, root, 2, [_poll("7", 40, 103, 5)])
    later = _rows(streams.current_state(_source(spark, root), root))
    assert len(later) == 51 and [r[5] for r in later if r[1] == "7"] == [5]


def test_late_polls_are_dropped_and_counted(spark):
    import uuid

    root = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    late = 0
    for i, rows in enumerate([[_poll("1", 0, 0, 2)], [_poll("1", 100, 1, 3)], [_poll("1", 110, 2, 3)], [_poll("1", 5, 3, 4), _poll("2", 7, 4, 4), _poll("1", 112, 5, 2)]]):
        _arrive(spark, root, i, rows)
        got, dropped = streams.deduped(_source(spark, root), root)
        late += dropped
    assert [r[4] for r in _rows(got)] == [0, 1, 5] and late == 2


def test_empty_stream(spark):
    import uuid

    root = f"{shared_dir(spark)}/none-{uuid.uuid4().hex}"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}-in/p0")
    assert streams.current_state(_source(spark, root), root).count() == 0 and streams.deduped(_source(spark, root))[0].count() == 0


def test_upsert_and_dedupe_equal_batch(spark):
    t = streams.StreamTables(spark, SF)
    batch = check_queries.canon(snapshots.dedupe_snapshot_rows(streams.Tables(spark, SF).v_status_events).select("event_id").toPandas())
    assert check_queries.canon(streams.deduped(t.v_status_events)[0].select("event_id").toPandas()).equals(batch)
