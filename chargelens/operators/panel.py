"""Panel reconstruction: states as intervals on a tick index.

A poll returns only chargers whose state changed, so a charger's state holds from its observation to a carry limit.
Three carry rules exist and are kept apart by name:

* fleet segment    - to the charger's next observation or the end of the collection segment;
* charger segment  - only between two of the charger's own observations at most 25 minutes apart;
* bounded hold     - fleet segment, at most 25 minutes, and only on ticks whose poll succeeded.

Observations are folded to one row per charger and tick first, so a charger contributes at most one row per tick and no
window group exceeds the number of ticks. States stay intervals; station counts come from +1/-1 steps at interval ends
and are widened to ticks only for the final dense table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import epoch_s, ratio, weekday0
from chargelens.operators.snapshots import CHARGER, dedupe_snapshot_rows
from chargelens.session import stage

MAX_GAP_S = 25 * 60


def tick_index(ticks: DataFrame, gap_s: int = MAX_GAP_S) -> DataFrame:
    """Ticks numbered in time order with their collection segment (a gap over `gap_s` opens a new one).

    Numbering runs per day and is shifted by day totals, so no task sees more than one day of ticks or one row per day.
    Adds tick_s, tick_idx, segment_id, seg_end_idx, prev_gap_s and, when `ok` exists, the running count of good ticks.
    """
    has_ok = "ok" in ticks.columns
    base = ticks.groupBy("tick_ts").agg(F.max("ok").alias("ok")) if has_ok else ticks.select("tick_ts").distinct()
    base = base.withColumn("tick_s", epoch_s(F.col("tick_ts"))).withColumn("_day", F.floor(F.col("tick_s") / 86400))
    in_day = Window.partitionBy("_day").orderBy("tick_s")
    upto = in_day.rowsBetween(Window.unboundedPreceding, 0)
    good = F.col("ok").cast("long") if has_ok else F.lit(1)
    base = base.withColumns({
        "_prev": F.lag("tick_s").over(in_day),
        "_n": F.row_number().over(in_day),
        "_good": F.sum(good).over(upto),
    }).withColumn("_gaps", F.sum(F.when(F.col("tick_s") - F.col("_prev") > gap_s, 1).otherwise(0)).over(upto))
    days = base.groupBy("_day").agg(
        F.min("tick_s").alias("_first"), F.max("tick_s").alias("_last"), F.count("*").alias("_cnt"),
        F.max("_gaps").alias("_day_gaps"), F.max("_good").alias("_day_good"),
    )
    by_day = Window.orderBy("_day")  # one row per calendar day
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_prev_last", F.lag("_last").over(by_day)).withColumn(
        "_opens", F.when(F.col("_first") - F.col("_prev_last") > gap_s, 1).otherwise(0)
    ).select(
        "_day", "_prev_last",
        (F.coalesce(F.sum("_day_gaps").over(before), F.lit(0)) + F.sum("_opens").over(by_day)).alias("_seg0"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_idx0"),
        F.coalesce(F.sum("_day_good").over(before), F.lit(0)).alias("_good0"),
    )
    out = base.join(days, "_day").select(
        "tick_ts", "tick_s", *(["ok"] if has_ok else []),
        (F.col("_idx0") + F.col("_n") - 1).cast("int").alias("tick_idx"),
        (F.col("_seg0") + F.col("_gaps")).cast("int").alias("segment_id"),
        (F.col("tick_s") - F.coalesce("_prev", "_prev_last")).alias("prev_gap_s"),
        (F.col("_good0") + F.col("_good")).alias("good_upto"),
    )
    ends = out.groupBy("segment_id").agg(F.max("tick_idx").alias("seg_end_idx"))
    return out.join(ends, "segment_id")


def indexed_observations(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """One observation per charger and tick, on the tick index, with the charger's next one in the segment.

    The tick table is joined without a hint: the optimizer broadcasts it while its measured size allows and shuffles
    it otherwise.
    """
    obs = dedupe_snapshot_rows(events).select(*CHARGER, "tick_ts", "stat", "stat_updated_at")
    obs = obs.join(ticks.select("tick_ts", "tick_s", "tick_idx", "segment_id", "seg_end_idx", "good_upto"), "tick_ts")
    w = Window.partitionBy(*CHARGER, "segment_id").orderBy("tick_idx")
    return obs.withColumns({"next_idx": F.lead("tick_idx").over(w), "next_s": F.lead("tick_s").over(w)})


# ---- the three carry rules, as intervals [tick_idx, end_idx) ------------------------------------------------------

def fleet_segment_intervals(events: DataFrame, ticks: DataFrame) -> DataFrame:
    obs = indexed_observations(events, ticks)
    return obs.withColumn("end_idx", F.coalesce(F.col("next_idx"), F.col("seg_end_idx") + 1))


def charger_segment_intervals(events: DataFrame, ticks: DataFrame, gap_s: int = MAX_GAP_S) -> DataFrame:
    obs = indexed_observations(events, ticks)
    near = F.col("next_s") - F.col("tick_s") <= gap_s
    return obs.withColumn("end_idx", F.when(near, F.col("next_idx")).otherwise(F.col("tick_idx") + 1))


def hold_limits(ticks: DataFrame, hold_s: int = MAX_GAP_S) -> DataFrame:
    """Adds the last tick within `hold_s` seconds of each tick in its segment, and the good ticks up to there."""
    w = Window.partitionBy("segment_id").orderBy("tick_s").rangeBetween(0, hold_s)
    return ticks.withColumns({"hold_end_idx": F.max("tick_idx").over(w), "hold_good_upto": F.max("good_upto").over(w)})


def bounded_hold_intervals(events: DataFrame, ticks: DataFrame, hold_s: int = MAX_GAP_S) -> DataFrame:
    held = hold_limits(ticks, hold_s).select("tick_idx", "hold_end_idx", "hold_good_upto")
    obs = indexed_observations(events, ticks).join(held, "tick_idx")
    return obs.withColumn("end_idx", F.least(F.coalesce("next_idx", F.col("seg_end_idx") + 1), F.col("hold_end_idx") + 1))


def widen(intervals: DataFrame, ticks: DataFrame, *, extra=()) -> DataFrame:
    """Intervals to one row per covered tick."""
    cells = intervals.select(
        *[c for c in intervals.columns if c not in ("tick_ts", "tick_s", "tick_idx", "end_idx", "segment_id", "ok", *extra)],
        F.col("tick_idx").alias("_from"), F.col("tick_s").alias("observed_s"),
        F.explode(F.sequence("tick_idx", F.col("end_idx") - 1)).alias("tick_idx"),
    )
    return cells.join(ticks.select("tick_idx", "tick_ts", "tick_s", "segment_id", *extra), "tick_idx")


def fleet_segment_panel(events: DataFrame, ticks: DataFrame) -> DataFrame:
    return widen(fleet_segment_intervals(events, ticks), ticks).select(*CHARGER, "tick_ts", "stat", "segment_id")


def charger_segment_panel(events: DataFrame, ticks: DataFrame, status: Column) -> DataFrame:
    panel = widen(charger_segment_intervals(events, ticks), ticks)
    return panel.select(*CHARGER, "tick_ts", status.alias("status"), "segment_id")


def charger_segment_state(events: DataFrame, ticks: DataFrame, status: Column, as_of: Column) -> DataFrame:
    """Cells of the charger-segment panel at its newest tick up to `as_of`, looked up in the intervals.

    Of each charger only the last interval that starts by then can reach that tick, as an interval ends where the next
    one starts; so no interval is widened. The newest tick is the last one that any of them covers.
    """
    upto = ticks.where(F.col("tick_ts") <= as_of).agg(F.max("tick_idx")).scalar()
    begun = charger_segment_intervals(events, ticks).where(F.col("tick_idx") <= upto)
    last = stage(begun.groupBy(*CHARGER).agg(F.max_by(F.struct("end_idx", "stat", "segment_id"), "tick_idx").alias("_s")))
    at = last.agg(F.max(F.least(F.col("_s.end_idx") - 1, upto))).scalar()
    when = ticks.where(F.col("tick_idx") == at).agg(F.max("tick_ts")).scalar()
    return last.where(F.col("_s.end_idx") > at).select(*CHARGER, "_s.stat", "_s.segment_id").select(*CHARGER, when.alias("tick_ts"), status.alias("status"), "segment_id")


def bounded_hold_panel(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Observed and carried cells. A failed tick keeps only what was observed in it."""
    cells = widen(bounded_hold_intervals(events, ticks), ticks, extra=("ok",))
    observed = F.col("tick_idx") == F.col("_from")
    return cells.where(F.col("ok") | observed).select(
        *CHARGER, "tick_ts", F.col("stat").alias("reconstructed_status"),
        F.when(observed, F.col("stat")).alias("observed_status"),
        ((F.col("tick_s") - F.col("observed_s")) / 60.0).alias("observation_age_minutes"),
        F.col("ok").alias("collection_success"),
        F.when(observed, "observed_event").otherwise("ffill_within_hold").alias("source_type"),
    )


def hold_source_counts(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Cells of the full charger x tick grid by source type, counted from intervals without building the grid."""
    iv = bounded_hold_intervals(events, ticks)
    until = F.coalesce("next_idx", F.col("seg_end_idx") + 1)
    upto = ticks.select(F.col("tick_idx").alias("_i"), F.col("good_upto").alias("_g"), F.col("ok").alias("_ok"))
    # good ticks strictly after the observation, up to the hold end and up to the segment / next observation
    last_cov = iv.withColumn("_cov", F.col("end_idx") - 1).join(upto.select(F.col("_i").alias("_cov"), F.col("_g").alias("_gcov")), "_cov")
    last_all = last_cov.withColumn("_lst", until - 1).join(upto.select(F.col("_i").alias("_lst"), F.col("_g").alias("_glst")), "_lst")
    own_ok = last_all.join(upto.select(F.col("_i").alias("tick_idx"), "_ok"), "tick_idx")
    sums = own_ok.agg(
        F.count("*").alias("observed"), F.count_if("_ok").alias("observed_ok"),
        F.sum(F.col("_gcov") - F.col("good_upto")).alias("held"), F.sum(F.col("_glst") - F.col("_gcov")).alias("expired"),
    )
    chargers = events.select(*CHARGER).distinct().agg(F.count("*")).scalar()
    n_ticks, n_good = ticks.agg(F.count("*")).scalar(), ticks.agg(F.max("good_upto")).scalar()
    one = sums.withColumns({"cells": chargers * n_ticks, "failed": chargers * (n_ticks - n_good) - (F.col("observed") - F.col("observed_ok"))})
    rest = F.col("cells") - F.col("observed") - F.col("held") - F.col("expired") - F.col("failed")
    kinds = [("observed_event", F.col("observed")), ("ffill_within_hold", F.col("held")), ("collection_failed", F.col("failed")), ("hold_expired", F.col("expired")), ("unobserved", rest)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("source_type"), v.cast("long").alias("n_cells")) for k, v in kinds])))


# ---- station level ------------------------------------------------------------------------------------------------

def _steps(intervals: DataFrame, flags: dict[str, Column], *, keys=("station_id", "segment_id")) -> DataFrame:
    """Running counts of the given flags per key at every tick where one changes, as intervals [tick_idx, end_idx)."""
    marked = intervals.select(*keys, "seg_end_idx", "tick_idx", "end_idx", *[c.cast("int").alias(n) for n, c in flags.items()])
    step = F.explode(F.array(
        F.struct(F.col("tick_idx").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("end_idx").alias("at"), F.lit(-1).alias("sign"))
    )).alias("_e")
    steps = marked.select(*keys, "seg_end_idx", step, *flags)
    steps = steps.groupBy(*keys, F.col("_e.at").alias("tick_idx")).agg(
        F.max("seg_end_idx").alias("seg_end_idx"), *[F.sum(F.col(n) * F.col("_e.sign")).alias(n) for n in flags]
    )
    w = Window.partitionBy(*keys).orderBy("tick_idx")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        *keys, "tick_idx", F.least(F.coalesce(F.lead("tick_idx").over(w), F.col("seg_end_idx") + 1), F.col("seg_end_idx") + 1).alias("end_idx"),
        *[F.sum(n).over(run).cast("int").alias(n) for n in flags],
    ).where(F.col("tick_idx") <= F.col("end_idx") - 1)


def station_panel_d2(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Station x tick counts under the fleet-segment rule; only ticks where a charger is known."""
    iv = fleet_segment_intervals(events, ticks)
    runs = _steps(iv, {"known_chargers": F.lit(1), "available_count": F.col("stat") == 2, "in_use_count": F.col("stat") == 3})
    runs = runs.where("known_chargers > 0").drop("segment_id")
    cells = runs.select("station_id", "known_chargers", "available_count", "in_use_count", F.explode(F.sequence("tick_idx", F.col("end_idx") - 1)).alias("tick_idx"))
    usable = F.col("available_count") + F.col("in_use_count")
    return cells.join(ticks.select("tick_idx", "tick_ts", "tick_s", "segment_id"), "tick_idx").select(
        "station_id", "tick_ts", "tick_s", "segment_id", "known_chargers", "available_count", "in_use_count", usable.alias("usable_known"),
        ratio(F.col("available_count"), usable).alias("availability_ratio_observed"),
        (F.col("available_count") >= 1).alias("has_confirmed_available"),
    )


def add_rate_lags(panel: DataFrame, specs=((15, 12), (60, 15)), value: str = "availability_ratio_observed") -> DataFrame:
    """Latest value at or before t-lag, not older than the tolerance, same station and segment.

    The row at that time decides even when its value is NULL, hence no ignore-nulls.
    """
    base = Window.partitionBy("station_id", "segment_id").orderBy("tick_s")
    return panel.withColumns({
        f"avail_rate_lag_{lag}m": F.last(value).over(base.rangeBetween(-(lag + tol) * 60, -lag * 60)) for lag, tol in specs
    })


def fleet_series(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Fleet availability per tick under the fleet-segment rule, each charger counted once.

    Steps are summed per tick first: the running total then runs over ticks of one segment only.
    """
    iv = fleet_segment_intervals(events, ticks)
    runs = _steps(iv, {"available": F.col("stat") == 2, "in_use": F.col("stat") == 3}, keys=("segment_id",))
    cells = runs.select("available", "in_use", F.explode(F.sequence("tick_idx", F.col("end_idx") - 1)).alias("tick_idx"))
    usable = F.col("available") + F.col("in_use")
    return cells.join(ticks.select("tick_idx", "tick_ts", "segment_id"), "tick_idx").select(
        "tick_ts", "segment_id", "available", "in_use", usable.alias("usable_known"), (ratio(F.col("available"), usable) * 100).alias("availability_pct"),
        F.hour("tick_ts").alias("hour"), F.to_date("tick_ts").alias("date"),
    )


def fleet_from_station_panel(panel: DataFrame) -> DataFrame:
    return panel.groupBy("tick_ts").agg(
        F.sum("available_count").alias("available"), F.sum("in_use_count").alias("in_use"), F.sum("usable_known").alias("usable_known"),
        F.count("*").alias("stations"), F.avg(F.col("has_confirmed_available").cast("double")).alias("confirmed_share"),
    ).withColumn("availability_pct", ratio(F.col("available"), F.col("usable_known")) * 100)


def hourly_availability(series: DataFrame) -> DataFrame:
    return series.groupBy("hour").agg(F.avg("availability_pct").alias("availability_pct"))


def weighting_bias(events: DataFrame, series: DataFrame) -> DataFrame:
    """Row-weighted, charger-weighted and panel-weighted availability, and the share of chargers seen once."""
    usable = dedupe_snapshot_rows(events).where(F.col("stat").isin(2, 3))
    per_charger = usable.groupBy(*CHARGER).agg(F.count("*").alias("n"), F.sum((F.col("stat") == 2).cast("long")).alias("a"))
    return per_charger.agg(
        (F.sum("a") / F.sum("n") * 100).alias("row_weighted_pct"),
        (F.avg(F.col("a") / F.col("n")) * 100).alias("charger_weighted_pct"),
        (F.avg((F.col("n") == 1).cast("double")) * 100).alias("observed_once_pct"),
    ).withColumn("panel_weighted_pct", series.agg(F.avg("availability_pct")).scalar())


def station_tick_panel(events: DataFrame, ticks: DataFrame, hold_s: int = MAX_GAP_S, sparse: bool = False) -> DataFrame:
    """Dense station x tick table under the bounded-hold rule, zeros where nothing is known; `sparse` leaves those cells out.

    Each station's counts are piecewise constant between its steps, so the dense rows come from widening those pieces;
    the grid is never built by a join. The youngest observation of a station decides its age: when it has expired, so
    has every older one.
    """
    iv = bounded_hold_intervals(events, ticks, hold_s)
    usable, avail = (F.coalesce(c.cast("int"), F.lit(0)) for c in (F.col("stat").isin(2, 3), F.col("stat") == 2))
    observed, known = ("observed_chargers", "available_observed", "usable_observed"), ("known_recon", "available_recon", "usable_recon")
    flags, one, none = [*observed, *known], (F.lit(1), avail, usable), (F.lit(0),) * 3
    n_ticks = ticks.agg(F.count("*")).scalar().cast("int")
    stations = events.groupBy("station_id").agg(F.count_distinct("charger_id").cast("int").alias("chargers"))
    # every station starts at tick 0 with zeros; pieces end at the next step or the last tick
    edge = stations.select("station_id", F.lit(0).alias("at"), F.lit(None).cast("long").alias("obs_s"), *[F.lit(0).alias(n) for n in flags])
    # an interval opens both counts at its tick; the observed one ends a tick later, the known one at its end
    step = lambda at, s, values: F.struct(at.alias("at"), s.alias("obs_s"), *[v.alias(n) for n, v in zip(flags, values)])
    late, no_time = tuple(-c for c in one), F.lit(None).cast("long")
    three = [step(F.col("tick_idx"), F.col("tick_s"), one + one), step(F.col("tick_idx") + 1, no_time, late + none), step(F.col("end_idx"), no_time, none + late)]
    steps = iv.select("station_id", F.inline(F.array(*three))).unionByName(edge)
    steps = steps.groupBy("station_id", "at").agg(F.max("obs_s").alias("obs_s"), *[F.sum(n).alias(n) for n in flags])
    w = Window.partitionBy("station_id").orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    pieces = steps.select(
        "station_id", "at", F.coalesce(F.lead("at").over(w), n_ticks).alias("upto"), F.max("obs_s").over(run).alias("obs_s"),
        *[F.sum(n).over(run).cast("int").alias(n) for n in flags],
    ).where(F.col("at") < F.least(F.col("upto"), n_ticks))
    if sparse:  # before the pieces are widened, so empty cells are never made
        pieces = pieces.where((F.col("known_recon") > 0) | (F.col("observed_chargers") > 0))
    cells = pieces.join(stations, "station_id").select(
        "station_id", "chargers", "obs_s", *flags, F.explode(F.sequence("at", F.least(F.col("upto"), n_ticks) - 1)).alias("tick_idx")
    )
    out = cells.join(ticks.select("tick_idx", "tick_ts", "tick_s", "segment_id", "ok"), "tick_idx")
    ok = F.col("ok")
    known = F.when(ok, F.col("known_recon")).otherwise(F.col("observed_chargers"))
    return out.select(
        "station_id", "tick_ts", "tick_s", "tick_idx", "segment_id", "chargers", "observed_chargers", "available_observed", "usable_observed",
        known.alias("known_recon"),
        F.when(ok, F.col("available_recon")).otherwise(F.col("available_observed")).alias("available_recon"),
        F.when(ok, F.col("usable_recon")).otherwise(F.col("usable_observed")).alias("usable_recon"),
        F.when(known > 0, (F.col("tick_s") - F.col("obs_s")) / 60.0).alias("observation_age_minutes"),
        ok.alias("collection_success"),
    )


def station_features_e3(panel: DataFrame) -> DataFrame:
    """Station counts and ratios per tick of the charger-segment panel, or of its cells at one tick."""
    out = panel.groupBy("tick_ts", "station_id").agg(
        F.count("*").alias("total_chargers"),
        *[F.count_if(F.col("status") == s).alias(f"{n}_count") for n, s in (("available", "AVAILABLE"), ("charging", "CHARGING"), ("out_of_service", "OUT_OF_SERVICE"))],
    )
    for n in ("available", "charging", "out_of_service"):
        out = out.withColumn(f"{n}_ratio", F.col(f"{n}_count") / F.greatest(F.col("total_chargers"), F.lit(1)))
    dow = weekday0(F.col("tick_ts"))
    return out.withColumns({"hour": F.hour("tick_ts"), "day_of_week": dow, "is_weekend": dow.isin(5, 6).cast("int")})


def change_features(panel: DataFrame) -> DataFrame:
    """One-tick delta of available chargers and minutes since it last changed; both restart after a long gap or an
    unknown tick. Only known cells are sorted; a jump in the tick index ends a block of unbroken knowledge."""
    w = Window.partitionBy("station_id", "segment_id").orderBy("tick_idx")
    known = panel.where("known_recon > 0").withColumn("_gap", F.coalesce((F.col("tick_idx") - F.lag("tick_idx").over(w) > 1).cast("int"), F.lit(0)))
    known = known.withColumn("_block", F.sum("_gap").over(w)).drop("_gap")
    b = Window.partitionBy("station_id", "segment_id", "_block").orderBy("tick_idx")
    prev = F.lag("available_recon").over(b)
    known = known.withColumn("available_count_delta_1tick", F.col("available_recon") - prev)
    moved = F.when(F.col("available_count_delta_1tick").isNull() | (F.col("available_count_delta_1tick") != 0), F.col("tick_s"))
    return known.withColumn("minutes_since_last_change", (F.col("tick_s") - F.max(moved).over(b)) / 60.0).drop("_block")


def with_master_totals(panel: DataFrame, master_counts: DataFrame) -> DataFrame:
    """Observed charger totals replaced by the master's count, ratios recomputed."""
    out = panel.join(master_counts.select("station_id", F.col("chargers").alias("_m")), "station_id", "left")
    total = F.coalesce(F.col("_m"), F.col("total_chargers"))
    out = out.withColumn("total_chargers", total).drop("_m")
    for n in ("available", "charging", "out_of_service"):
        out = out.withColumn(f"{n}_ratio", F.col(f"{n}_count") / F.greatest(F.col("total_chargers"), F.lit(1)))
    return out


def shifted_targets(panel: DataFrame, value: str = "available_ratio", steps=(1, 2, 3)) -> DataFrame:
    w = Window.partitionBy("station_id").orderBy("tick_ts")
    return panel.withColumns({f"target_plus_{n}": F.lead(value, n).over(w) for n in steps})


def lag_reset_check(panel: DataFrame, gap_s: int = MAX_GAP_S) -> DataFrame:
    """Rows right after a long gap of their station, and how many of them wrongly carry a lag."""
    w = Window.partitionBy("station_id").orderBy("tick_s")
    after = panel.withColumn("_gap", F.col("tick_s") - F.lag("tick_s").over(w)).where(F.col("_gap") > gap_s)
    return after.agg(
        F.count("*").alias("rows_after_gap"),
        F.count_if(F.col("avail_rate_lag_15m").isNotNull()).alias("lag15_not_null"),
        F.count_if(F.col("avail_rate_lag_60m").isNotNull()).alias("lag60_not_null"),
    )
