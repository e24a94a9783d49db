"""Frames several queries share."""
from __future__ import annotations

from pyspark.sql import DataFrame

from chargelens.operators import panel, snapshots
from chargelens.session import stage
from chargelens.sources.views import Tables


def event_ticks(t: Tables) -> DataFrame:
    return stage(panel.tick_index(t.v_status_events.select("tick_ts")))


def log_ticks(t: Tables) -> DataFrame:
    return stage(panel.tick_index(t.v_poll_log.select("tick_ts", "ok")))


def current_chargers(t: Tables) -> DataFrame:
    ev = t.v_status_events
    return snapshots.master_with_status(t.v_charger_master, snapshots.latest_status_as_of(ev, snapshots.newest_poll(ev)))


def d2(t: Tables) -> DataFrame:
    return panel.add_rate_lags(panel.station_panel_d2(t.v_status_events, event_ticks(t)))


def station_ticks(t: Tables, sparse: bool = False) -> DataFrame:
    return panel.station_tick_panel(t.v_status_events, log_ticks(t), sparse=sparse)


def fleet(t: Tables) -> DataFrame:
    return panel.fleet_series(t.v_status_events, event_ticks(t))
