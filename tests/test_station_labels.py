"""As-of selection, station features, labels, splits, opening hours, vehicle arithmetic."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chargelens.functions.exprs import effective_grade, grade_from_minutes, observation_state
from chargelens.functions.opening_hours import operating_at
from chargelens.operators import candidates, clean, labels, profiles, snapshots, station

AS_OF = datetime(2026, 7, 17, 10, 0)


def test_latest_status_is_never_from_the_future(spark):
    m = lambda k: AS_OF - timedelta(minutes=k)
    rows = [("A", "1", m(30), m(30), m(31), 1, 3, 1), ("A", "1", m(5), m(5), m(12), 2, 2, 1), ("A", "1", m(-5), m(-5), m(-6), 3, 5, 1), ("B", "1", m(-1), m(-1), m(3), 4, 2, 1)]
    ev = spark.createDataFrame(rows, "station_id string, charger_id string, tick_ts timestamp_ntz, fetched_at timestamp_ntz, stat_updated_at timestamp_ntz, event_id long, stat int, page_no int")
    got = snapshots.latest_status_as_of(ev, F.lit(AS_OF).cast("timestamp_ntz")).collect()
    assert [(r.station_id, r.stat_mapped, r.status_age_seconds, r.observation_age_seconds) for r in got] == [("A", "AVAILABLE", 720.0, 300.0)]


def test_unobserved_is_not_unavailable(spark):
    rows = [("A", None, True, None, None), ("A", "UNKNOWN", False, 60.0, 60.0), ("B", "AVAILABLE", False, 1200.0, 240.0), ("B", None, True, None, None)]
    df = spark.createDataFrame(rows, "station_id string, stat_mapped string, status_missing boolean, status_age_seconds double, observation_age_seconds double")
    got = {r.station_id: r for r in station.station_status(df).collect()}
    assert got["A"].availability_ratio_observed is None and got["A"].observation_state == "UNOBSERVED" and got["A"].unobserved_rate == 1.0
    assert got["B"].availability_ratio_observed == 1.0 and got["B"].reliability_grade == "CHECK_REQUIRED" and got["B"].reliability_grade_effective == "HIGH"


@pytest.mark.parametrize("minutes,grade", [(5.0, "HIGH"), (5.01, "NORMAL"), (15.0, "NORMAL"), (15.01, "CHECK_REQUIRED"), (None, "CHECK_REQUIRED")])
def test_grade_bounds(spark, minutes, grade):
    assert spark.range(1).select(grade_from_minutes(F.lit(minutes).cast("double"))).first()[0] == grade


def test_effective_grade_and_state(spark):
    r = spark.range(1).select(effective_grade(F.lit("NORMAL"), F.lit("HIGH")), observation_state(F.lit(0), F.lit("HIGH")), observation_state(F.lit(2), F.lit("CHECK_REQUIRED"))).first()
    assert tuple(r) == ("HIGH", "UNOBSERVED", "STALE")


@pytest.mark.parametrize("text,when,state", [
    ("24시간 이용가능", "2026-07-17 03:00", "Y"), ("비개방", "2026-07-17 12:00", "N"), ("09:00~18:00", "2026-07-17 09:00", "Y"), ("09:00~18:00", "2026-07-17 18:00", "N"), ("19:00~08:00", "2026-07-17 23:00", "Y"),
    ("05:00~익일 01:00", "2026-07-17 00:30", "Y"), ("평일 09:00~18:00, 주말 10:00~14:00", "2026-07-18 15:00", "N"), ("평일 08:00~20:00, 주말 휴무", "2026-07-18 12:00", "N"), ("주중/주말 : 06시~23시", "2026-07-18 22:00", "Y"),
    ("9-22시", "2026-07-17 21:59", "Y"), ("매장 영업시간", "2026-07-17 12:00", "UNKNOWN"), ("09:00~18:00, 10:00~16:00", "2026-07-17 12:00", "UNKNOWN"), (None, "2026-07-17 12:00", "UNKNOWN"), ("-", "2026-07-17 12:00", "UNKNOWN"),
])
def test_opening_hours(spark, text, when, state):
    df = spark.createDataFrame([(text,)], "use_time string")
    assert operating_at(df, "use_time", F.expr(f"timestamp_ntz'{when}:00'"), "o").first().o == state


def test_conservative_label(spark):
    df = spark.createDataFrame([(1, 1, 4), (0, 4, 4), (0, 2, 4), (0, 0, 0)], "a int, k int, n int")
    assert [r[0] for r in df.select(labels.conservative_target(F.col("a"), F.col("k"), F.col("n"))).collect()] == [1, 0, None, None]


def test_future_tick_is_later_and_in_the_segment(spark):
    from test_panel import T0, minute, ticks

    got = {minute(r.tick_ts): r.future_ts and minute(r.future_ts) for r in labels.future_ticks(ticks(spark, [0, 10, 20, 60, 70]), horizons=(5,)).collect()}
    assert got == {0: 10, 10: 20, 20: None, 60: 70, 70: None}
    assert T0


def test_nearest_tick_ties_go_back(spark):
    from test_panel import ticks

    got = {r.tick_idx: r.future_idx for r in labels.nearest_ticks(ticks(spark, [0, 10, 20]), horizons=(15,)).collect()}
    assert got == {0: 1, 1: 2}


def test_temporal_split_needs_three_dates_and_leaves_none_empty(spark):
    mk = lambda n: spark.createDataFrame([(f"2026-07-{d:02d}",) for d in range(1, n + 1)], "feature_date string")
    assert {r.split for r in candidates.temporal_split(mk(3)).collect()} == {"train", "valid", "test"}
    counts = {r.split: r["count"] for r in candidates.temporal_split(mk(10)).groupBy("split").count().collect()}
    assert counts == {"train": 6, "valid": 2, "test": 2}
    with pytest.raises(Exception, match="three dates"):
        candidates.temporal_split(mk(2)).collect()


def test_asof_backward_over_block_edges(spark):
    left = spark.createDataFrame([("k", 86400), ("k", 86400 + 700), ("k", 100)], "key string, t long")
    right = spark.createDataFrame([("k", 86300, 1.0), ("k", 50, 2.0)], "key string, s long, v double")
    got = {r.t: r.v for r in labels.asof_backward(left, right, "key", "t", "s", ["v"], 600).collect()}
    assert got == {86400: 1.0, 87100: None, 100: 2.0}


def test_soc_falls_with_distance(spark):
    routes = spark.createDataFrame([("a", 10.0), ("b", 100.0)], "route_id string, distance_km double")
    cars = spark.createDataFrame([("m", 64.0, 400.0)], "model_name string, battery_kwh double, range_km double")
    got = {(r.route_id, r.model_name, r.current_soc): r for r in profiles.soc_scenarios(routes, cars).collect()}
    assert len(got) == 2 * 2 * 5
    assert got[("a", "m", 50.0)].arrival_soc > got[("b", "m", 50.0)].arrival_soc
    assert got[("b", "m", 30.0)].soc_risk_level == "DANGER" and got[("a", "__FALLBACK__", 50.0)].used_fallback


def test_mojibake_round_trip(spark):
    df = spark.createDataFrame([("대구 수성구",), ("plain",), ("già",)], "t string").select(F.decode(F.encode("t", "UTF-8"), "ISO-8859-1").alias("t"))
    got = clean.repair_mojibake(df).collect()
    assert [r.t for r in got] == ["대구 수성구", "plain", "già"] and [r.repaired_cells for r in got] == [1, 0, 1]
