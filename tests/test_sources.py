"""File sources: line order under two split sizes, code pages per file, replay-safe appends."""
import uuid

import pytest
from pyspark.sql import functions as F

from chargelens.operators import snapshots
from chargelens.session import shared_dir
from chargelens.sources import files


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_last_line_wins_under_any_split(spark):
    """Of equal event times and pages the last line of the poll's file counts."""
    root = _folder(spark, "polls")
    n, chargers = 3000, 7
    rows = [(f"S{i % chargers}", "01", str(1 + i % 5), "20260101000000", "2026-01-01 00:05:00", "20260101_000500", "1") for i in range(n)]
    spark.createDataFrame(rows, files.SNAPSHOT_SCHEMA).coalesce(1).write.option("header", True).csv(root)
    last = {f"S{i % chargers}": 1 + i % 5 for i in range(n)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1m", "9k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            raw = files.read_snapshots(spark, [root])
            assert (raw.rdd.getNumPartitions() > 4) == (size == "9k")
            kept = snapshots.dedupe_snapshot_rows(snapshots.typed_events(raw))
            assert {r.station_id: r.stat for r in kept.collect()} == last
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_each_file_has_its_own_code_page(spark):
    root = _folder(spark, "usage")
    back = {v: k for k, v in files.USAGE_HEADERS.items()}
    names = list(back)
    want = []
    for i, encoding in enumerate(files.USAGE_ENCODINGS):
        row = [f"2026-01-0{i + 1}", f"충전소{i}", "01", "급속", "3", "4.5"]
        want.append((row[0], row[1]))
        order = names if i else names[::-1]
        spark.createDataFrame([row], names).select(*order).withColumnsRenamed(back).coalesce(1).write.option("header", True).option("encoding", encoding).csv(f"{root}/e{i}")
    got = files.read_usage(spark, root)
    assert sorted((str(r.use_date), r.station_id) for r in got.collect()) == want and got.where("sessions = 3 and kwh = 4.5").count() == 3
    spark.createDataFrame([("1",)], ["other"]).coalesce(1).write.option("header", True).csv(f"{root}/odd")
    with pytest.raises(ValueError):
        files.read_usage(spark, root)


def test_crash_between_write_and_commit_leaves_no_double_row(spark):
    target = _folder(spark, "append")
    source = spark.range(10)
    assert files.append_new(source.where("id < 4"), target).count() == 4
    number, cursor = files.write_batch(source.where("id < 7"), target)  # dies here
    assert (number, cursor) == (1, 3) and files.read_committed(spark, target, source.schema).count() == 4
    again = files.append_new(source, target)
    assert sorted(r.id for r in again.collect()) == list(range(10))
    assert files.append_new(source, target).count() == 10  # nothing new
    log = files._log(spark, target).orderBy("batch").collect()
    assert [tuple(r) for r in log] == [(0, 0, 3, 4), (1, 4, 9, 6)]


def test_append_without_rows_or_keys(spark):
    target = _folder(spark, "append")
    keyless = spark.createDataFrame([(None,), (1,)], "id long")
    assert [r.id for r in files.append_new(keyless, target).collect()] == [1]
    assert files.append_new(spark.range(0), _folder(spark, "append")).count() == 0


def test_inventory_names_columns_and_first_line(spark):
    root = _folder(spark, "inv")
    spark.range(5, 9).select("id", F.lit("a").alias("x")).coalesce(1).write.parquet(root)
    r = files.inventory(spark.read.parquet(root), F.lit(None).cast("timestamp_ntz")).first()
    assert (r.n_rows, r.n_columns, r.columns, r.head) == (4, 2, "id,x", "5|a")
