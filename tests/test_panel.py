"""Carry rules, station counts, lags and change features on hand-made polls."""
from datetime import datetime, timedelta

import numpy as np
import pytest

from chargelens.operators import panel, snapshots

T0 = datetime(2026, 7, 17, 9, 0)
SCHEMA = "station_id string, charger_id string, tick_ts timestamp_ntz, fetched_at timestamp_ntz, stat_updated_at timestamp_ntz, event_id long, stat int, page_no int"


def events(spark, rows):
    """rows: (minute, station, charger, stat)"""
    data = [(s, c, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m), T0 + timedelta(minutes=m), i, st, 1) for i, (m, s, c, st) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def ticks(spark, minutes, failed=()):
    df = spark.createDataFrame([(T0 + timedelta(minutes=m), m not in failed) for m in minutes], "tick_ts timestamp_ntz, ok boolean")
    return panel.tick_index(df)


def minute(ts):
    return int((ts - T0).total_seconds() // 60)


def cells(df, value="stat"):
    return {(r.station_id + r.charger_id, minute(r.tick_ts)): r[value] for r in df.collect()}


def test_gap_of_25_minutes_continues_and_26_resets(spark):
    t = ticks(spark, [0, 25, 51])
    assert [r.segment_id for r in t.orderBy("tick_idx").collect()] == [0, 0, 1]


def test_segments_across_days(spark):
    df = spark.createDataFrame([(datetime(2026, 7, 17, 23, 50),), (datetime(2026, 7, 18, 0, 0),), (datetime(2026, 7, 18, 3, 0),), (datetime(2026, 7, 20, 3, 0),)], "tick_ts timestamp_ntz")
    got = panel.tick_index(df).orderBy("tick_idx").collect()
    assert [r.tick_idx for r in got] == [0, 1, 2, 3]
    assert [r.segment_id for r in got] == [0, 0, 1, 2]
    assert [r.seg_end_idx for r in got] == [1, 1, 2, 3]


def test_fleet_rule_has_no_back_fill_and_carries_to_segment_end(spark):
    ev = events(spark, [(0, "A", "1", 2), (10, "B", "1", 3), (20, "A", "1", 3), (60, "B", "1", 2)])
    t = ticks(spark, [0, 10, 20, 60])
    got = cells(panel.fleet_segment_panel(ev, t))
    assert got == {("A1", 0): 2, ("A1", 10): 2, ("A1", 20): 3, ("B1", 10): 3, ("B1", 20): 3, ("B1", 60): 2}


def test_charger_rule_stops_at_own_last_observation(spark):
    from pyspark.sql import functions as F

    ev = events(spark, [(0, "A", "1", 2), (10, "B", "1", 3), (20, "A", "1", 3), (30, "B", "1", 3), (40, "B", "1", 2)])
    got = cells(panel.charger_segment_panel(ev, ticks(spark, [0, 10, 20, 30, 40]), F.col("stat")), "status")
    assert got == {("A1", 0): 2, ("A1", 10): 2, ("A1", 20): 3, ("B1", 10): 3, ("B1", 20): 3, ("B1", 30): 3, ("B1", 40): 2}


def test_bounded_hold_expires_and_failed_tick_keeps_only_observed(spark):
    ev = events(spark, [(0, "A", "1", 2), (20, "B", "1", 3)])
    t = ticks(spark, [0, 10, 20, 30, 40], failed=(20,))
    got = cells(panel.bounded_hold_panel(ev, t), "observation_age_minutes")
    assert got == {("A1", 0): 0.0, ("A1", 10): 10.0, ("B1", 20): 0.0, ("B1", 30): 10.0, ("B1", 40): 20.0}


def test_newest_event_of_a_poll_wins(spark):
    rows = [("A", "1", T0, T0, T0 - timedelta(minutes=4), 1, 5, 4), ("A", "1", T0, T0, T0 - timedelta(minutes=1), 2, 2, 5), ("A", "1", T0, T0, None, 3, 3, 9)]
    got = snapshots.dedupe_snapshot_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.stat, r.page_no) for r in got] == [(2, 5)]


def test_ratio_is_null_when_only_unknown_codes(spark):
    ev = events(spark, [(0, "A", "1", 9), (0, "A", "2", 5), (0, "B", "1", 2), (0, "B", "2", 3)])
    got = {r.station_id: r for r in panel.station_panel_d2(ev, ticks(spark, [0])).collect()}
    assert got["A"].known_chargers == 2 and got["A"].availability_ratio_observed is None
    assert got["B"].availability_ratio_observed == 0.5


def test_first_tick_after_long_gap_has_no_lag(spark):
    ev = events(spark, [(m, "A", "1", 2) for m in (0, 15, 30, 100, 115)])
    got = {minute(r.tick_ts): r.avail_rate_lag_15m for r in panel.add_rate_lags(panel.station_panel_d2(ev, ticks(spark, [0, 15, 30, 100, 115]))).collect()}
    assert got == {0: None, 15: 1.0, 30: 1.0, 100: None, 115: 1.0}


def test_change_features_restart_after_unknown(spark):
    ev = events(spark, [(0, "A", "1", 2), (10, "A", "1", 3), (50, "A", "1", 2), (0, "Z", "1", 2)])
    t = ticks(spark, [0, 10, 20, 30, 40, 50])
    rows = {minute(r.tick_ts): (r.available_count_delta_1tick, r.minutes_since_last_change) for r in panel.change_features(panel.station_tick_panel(ev, t)).where("station_id = 'A'").collect()}
    assert rows[0] == (None, 0.0) and rows[10] == (-1, 0.0) and rows[20] == (0, 10.0)
    assert 40 not in rows and rows[50] == (None, 0.0)


@pytest.fixture(scope="module")
def random_feed():
    rng = np.random.default_rng(3)
    minutes = np.cumsum(rng.choice([5, 10, 20, 40], 40)).tolist()
    rows = [(int(m), f"S{c % 3}", str(c), int(rng.choice([1, 2, 3, 5, 9]))) for m in minutes for c in range(6) if rng.random() < 0.35]
    return minutes, rows, [m for m in minutes if rng.random() < 0.15]


def brute_hold(minutes, rows, failed, hold=25):
    out, last, prev = {}, {}, None
    at = {}
    for m, s, c, st in rows:
        at.setdefault(m, []).append((s + c, st))
    for m in minutes:
        if prev is not None and m - prev > 25:
            last = {}
        for k, st in at.get(m, []):
            last[k] = (st, m)
            out[(k, m)] = (st, 0.0)
        if m not in failed:
            for k, (st, seen) in last.items():
                if seen != m and m - seen <= hold:
                    out[(k, m)] = (st, float(m - seen))
        prev = m
    return out


def test_bounded_hold_equals_brute_force(spark, random_feed):
    minutes, rows, failed = random_feed
    df = panel.bounded_hold_panel(events(spark, rows), ticks(spark, minutes, failed))
    got = {(r.station_id + r.charger_id, minute(r.tick_ts)): (r.reconstructed_status, r.observation_age_minutes) for r in df.collect()}
    assert got == brute_hold(minutes, rows, failed)


def test_station_counts_equal_brute_force(spark, random_feed):
    minutes, rows, failed = random_feed
    hold = brute_hold(minutes, rows, failed)
    got = panel.station_tick_panel(events(spark, rows), ticks(spark, minutes, failed)).collect()
    assert len(got) == 3 * len(minutes)
    for r in got:
        mine = [v for (k, m), v in hold.items() if m == minute(r.tick_ts) and k.startswith(r.station_id)]
        assert r.known_recon == len(mine) and r.available_recon == sum(v[0] == 2 for v in mine)
        assert r.observed_chargers == sum(v[1] == 0 for v in mine)
        assert r.observation_age_minutes == (min(v[1] for v in mine) if mine else None)


def test_source_counts_cover_the_grid(spark, random_feed):
    minutes, rows, failed = random_feed
    ev, t = events(spark, rows), ticks(spark, minutes, failed)
    got = {r.source_type: r.n_cells for r in panel.hold_source_counts(ev, t).collect()}
    assert sum(got.values()) == len({(s, c) for _, s, c, _ in rows}) * len(minutes)
    hold = brute_hold(minutes, rows, failed)
    assert got["observed_event"] == sum(v[1] == 0 for v in hold.values()) and got["ffill_within_hold"] == sum(v[1] > 0 for v in hold.values())


def test_hot_charger_folds_before_windows(spark):
    """A third of all rows in one charger: copies fold to one row per tick."""
    ev = events(spark, [(0, "H", "1", 2)] * 500 + [(10 * i, "A", str(i), 3) for i in range(30)])
    assert snapshots.dedupe_snapshot_rows(ev).where("station_id = 'H'").count() == 1
