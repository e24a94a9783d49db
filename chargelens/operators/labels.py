"""Leakage-free labels at a later time, training rows, replay, travel-time fills.

The state at t + h is read by a range frame over the station's own rows, so no self-join is needed; horizons share one
sort. A station has at most one row per tick, which bounds the frame's group.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import haversine_m, ratio
from chargelens.operators.candidates import temporal_split
from chargelens.operators.ranks import quantiles
from chargelens.operators.snapshots import dedupe_snapshot_rows

HORIZONS = (5, 10, 15, 30)
TOL_S = 450


def stack(df: DataFrame, columns: list[str], structs: list[Column]) -> DataFrame:
    return df.select(*columns, F.inline(F.array(*structs)))


# ---- tick to tick -------------------------------------------------------------------------------------------------

def future_ticks(ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S) -> DataFrame:
    """First tick at or after t + h, within the tolerance and the segment; NULL if none."""
    w = Window.partitionBy("segment_id").orderBy("tick_s")
    out = ticks.withColumns({f"_f{h}": F.first("tick_ts").over(w.rangeBetween(h * 60, h * 60 + tol_s)) for h in horizons})
    return stack(out, ["tick_ts", "segment_id"], [F.struct(F.lit(h).alias("horizon_minutes"), F.col(f"_f{h}").alias("future_ts")) for h in horizons])


def match_ticks(wanted: DataFrame, ticks: DataFrame, tol_s: int = TOL_S) -> DataFrame:
    """`wanted` (tick_s, segment_id, horizon_minutes) to the first tick at or after the horizon, same segment.

    Horizons differ per row, so times are cut into buckets of the tolerance and joined on the bucket.
    """
    t = ticks.select(F.col("tick_s").alias("future_s"), "segment_id", F.floor(F.col("tick_s") / tol_s).alias("_b"))
    target = F.col("tick_s") + F.col("horizon_minutes") * 60
    w = wanted.withColumn("target_s", target).withColumn("_b", F.explode(F.sequence(F.floor(F.col("target_s") / tol_s), F.floor((F.col("target_s") + tol_s) / tol_s))))
    hit = w.join(t, ["segment_id", "_b"]).where((F.col("future_s") >= F.col("target_s")) & (F.col("future_s") <= F.col("target_s") + tol_s))
    return hit.groupBy("tick_s", "segment_id", "horizon_minutes").agg(F.min("future_s").alias("future_s"))


def future_index(ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S) -> DataFrame:
    """Tick index of the first tick at or after t + h per horizon, one column each."""
    w = Window.partitionBy("segment_id").orderBy("tick_s")
    return ticks.select("tick_idx", *[F.first("tick_idx").over(w.rangeBetween(h * 60, h * 60 + tol_s)).alias(f"_i{h}") for h in horizons])


def _known_future(panel: DataFrame, ticks: DataFrame, state: Column, horizons, tol_s: int) -> DataFrame:
    """Known cells with the state of the same station at each future tick, NULL when it is unknown there.

    Only known cells are sorted. The range frame may find a later known tick, so its index must be the mapped one.
    """
    w = Window.partitionBy("station_id", "segment_id").orderBy("tick_s")
    p = panel.where("known_recon > 0").join(future_index(ticks, horizons, tol_s), "tick_idx")
    p = p.withColumns({f"_f{h}": F.first(state).over(w.rangeBetween(h * 60, h * 60 + tol_s)) for h in horizons})
    return p.withColumns({f"_f{h}": F.when(F.col(f"_f{h}.tick_idx") == F.col(f"_i{h}"), F.col(f"_f{h}")) for h in horizons})


# ---- as-of joins between two tables -------------------------------------------------------------------------------

def asof_backward(left: DataFrame, right: DataFrame, key: str, left_s: str, right_s: str, payload: list[str], tol_s: int) -> DataFrame:
    """Latest right row at or before each left row of the same key, not older than the tolerance.

    Keys are cut into time blocks much longer than the tolerance, and right rows near a block's end are offered to the
    next block too; a key with very many rows thus spreads over many tasks.
    """
    block = max(86400, 8 * tol_s)
    lcols = left.columns
    edge = F.floor((F.col(right_s) + tol_s) / block)
    r = right.select(F.col(key), F.explode(F.array_distinct(F.array(F.floor(F.col(right_s) / block), edge))).alias("_blk"), F.col(right_s).alias("_t"), F.struct(F.col(right_s).alias("_rs"), *payload).alias("_r"), F.lit(0).alias("_side"))
    lf = left.select(F.col(key), F.floor(F.col(left_s) / block).alias("_blk"), F.col(left_s).alias("_t"), F.lit(1).alias("_side"), F.struct(*lcols).alias("_l"))
    both = r.unionByName(lf, allowMissingColumns=True)
    w = Window.partitionBy(key, "_blk").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    fresh = F.col("_t") - F.col("_m._rs") <= tol_s
    return out.select("_l.*", *[F.when(fresh, F.col(f"_m.{c}")).alias(c) for c in payload], F.when(fresh, (F.col("_t") - F.col("_m._rs")) / 60.0).alias("lag_minutes"))


def forward_state(cohort: DataFrame, horizon_min: int, value: str, tol_s: int = 600) -> DataFrame:
    """First state of the same station at or after t + h within the tolerance."""
    w = Window.partitionBy("station_id").orderBy("tick_s").rangeBetween(horizon_min * 60, horizon_min * 60 + tol_s)
    fut = F.first(value).over(w)
    return cohort.withColumn("future_available", fut).withColumn("target_available", F.when(F.col("future_available").isNotNull(), (F.col("future_available") >= 1).cast("int"))).withColumn("horizon_minutes", F.lit(horizon_min))


# ---- labels -------------------------------------------------------------------------------------------------------

def nearest_ticks(ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S) -> DataFrame:
    """For every good tick and horizon the good tick nearest to t + h within the tolerance, ties to the earlier one."""
    good = ticks.where("ok").select("tick_idx", "tick_s")
    width = 2 * tol_s
    bucket = lambda c: F.floor(c / width)
    want = good.withColumn("horizon_min", F.explode(F.array(*[F.lit(h) for h in horizons]))).withColumn("_t", F.col("tick_s") + F.col("horizon_min") * 60)
    want = want.withColumn("_b", F.explode(F.sequence(bucket(F.col("_t") - tol_s), bucket(F.col("_t") + tol_s)))).select("tick_idx", "horizon_min", "_t", "_b")
    near = want.join(good.select(F.col("tick_idx").alias("future_idx"), F.col("tick_s").alias("_s"), bucket(F.col("tick_s")).alias("_b")), "_b")
    gap = F.abs(F.col("_s") - F.col("_t"))
    return near.where(gap <= tol_s).groupBy("tick_idx", "horizon_min").agg(F.min(F.struct(gap, "_s", "future_idx")).alias("m")).select("tick_idx", "horizon_min", "m.future_idx")


def observed_cells(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Station x tick counts of what a poll itself returned; cells without an observation do not exist."""
    own = dedupe_snapshot_rows(events).select("station_id", "tick_ts", "stat")
    cells = own.groupBy("station_id", "tick_ts").agg(F.count("*").cast("int").alias("observed_chargers"), F.count_if(F.col("stat") == 2).cast("int").alias("available_observed"), F.count_if(F.col("stat").isin(2, 3)).cast("int").alias("usable_observed"))
    return cells.join(ticks.select("tick_ts", "tick_s", "tick_idx", "ok"), "tick_ts")


def often_observed(cells: DataFrame, least: int = 3) -> DataFrame:
    return cells.groupBy("station_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("station_id")


def observed_labels(cells: DataFrame, ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S, min_observed: int = 3) -> DataFrame:
    """Rows station x good tick x horizon whose future tick, the good tick nearest to t + h, was observed at the station.

    Every observed cell is offered to the ticks that look at it: the work follows the observations, and a candidate
    without an observation at its future tick is never made (see `candidate_counts` and `with_reasons`).
    """
    good = cells.where("ok").join(often_observed(cells, min_observed), "station_id", "left_semi")
    seen_then = good.select("station_id", F.col("tick_idx").alias("future_idx"), F.col("usable_observed").alias("_u"), F.col("available_observed").alias("_a"))
    rows = seen_then.join(nearest_ticks(ticks, horizons, tol_s), "future_idx")
    now = good.select("station_id", "tick_idx", "available_observed", "observed_chargers")
    rows = rows.join(now, ["station_id", "tick_idx"], "left").join(ticks.select("tick_idx", "tick_ts", "tick_s"), "tick_idx")
    usable = F.col("_u") > 0
    return rows.select(
        "station_id", "tick_ts", "tick_s", "tick_idx", F.coalesce("available_observed", F.lit(0)).alias("available_observed"), F.coalesce("observed_chargers", F.lit(0)).alias("observed_chargers"), "horizon_min",
        F.when(usable, (F.col("_a") >= 1).cast("int")).alias("target_available"), F.when(usable, "ok").otherwise("horizon_observed_but_no_usable_2_or_3").alias("label_reason"),
    )


def with_reasons(labels: DataFrame, cells: DataFrame, ticks: DataFrame, horizon: int, tol_s: int = TOL_S, min_observed: int = 3) -> DataFrame:
    """Every candidate of one horizon with its reason, for a listing of all of them: station x good tick rows."""
    nth = ticks.where("ok").select(F.col("good_upto").cast("int").alias("_n"), "tick_idx", "tick_ts")
    last = ticks.agg(F.max("good_upto").cast("int")).scalar()
    grid = often_observed(cells, min_observed).select("station_id", F.explode(F.sequence(F.lit(1), last)).alias("_n")).join(nth, "_n")
    grid = grid.join(nearest_ticks(ticks, (horizon,), tol_s).select("tick_idx", "future_idx"), "tick_idx", "left")
    known = labels.where(F.col("horizon_min") == horizon).select("station_id", "tick_idx", "target_available", "label_reason")
    why = F.when(F.col("future_idx").isNull(), "no_tick_near_horizon").otherwise("horizon_tick_no_charger_observation")
    return grid.join(known, ["station_id", "tick_idx"], "left").select("station_id", "tick_ts", F.lit(horizon).alias("horizon_min"), "target_available", F.coalesce("label_reason", why).alias("label_reason"))


def candidate_counts(cells: DataFrame, ticks: DataFrame, horizons=HORIZONS, min_observed: int = 3) -> DataFrame:
    """Candidates per horizon (stations times good ticks), counted without making them."""
    stations, good = often_observed(cells, min_observed).agg(F.count("*")).scalar(), ticks.agg(F.count_if("ok")).scalar()
    one = ticks.sparkSession.range(1).select((stations * good).alias("candidate_rows"))
    return one.select(F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon_min"), "candidate_rows").where("candidate_rows > 0")


def label_stats(labels: DataFrame, candidates: DataFrame) -> DataFrame:
    y = F.col("target_available")
    per = labels.groupBy("horizon_min").agg(
        F.count(y).alias("labeled_rows"), F.count_if(y == 1).alias("positive"), F.count_if(y == 0).alias("negative"), F.avg(y).alias("positive_rate"),
        F.count_distinct(F.when(y.isNotNull(), F.col("station_id"))).alias("stations_with_label"), F.count_distinct(F.when(y.isNotNull(), F.to_date("tick_ts"))).alias("dates_with_label"),
    )
    counts = ["labeled_rows", "positive", "negative", "stations_with_label", "dates_with_label"]
    return candidates.join(per, "horizon_min", "left").fillna(0, counts)


def conservative_target(available: Column, known: Column, total: Column) -> Column:
    """1 if any charger is known available; 0 only if all are known and none is; NULL otherwise."""
    return F.when((known > 0) & (available > 0), 1).when((total > 0) & (known >= total) & (available == 0), 0)


def eligible_stations(stations: DataFrame) -> DataFrame:
    return stations.where(F.col("coord_ok") & F.col("recommend_public_default"))


def training_rows(panel: DataFrame, meta: DataFrame, ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S) -> DataFrame:
    """Station x time x horizon rows with features at t and the conservative label at t + h.

    `panel` carries the change features; `meta` holds the eligible stations with their usage columns.
    """
    state = F.struct("tick_idx", "tick_ts", "tick_s", "available_recon", "known_recon", "chargers", "collection_success")
    p = _known_future(panel.join(meta, "station_id"), ticks, state, horizons, tol_s)
    now = p.where("collection_success")
    total, known = F.col("chargers"), F.col("known_recon")
    weekend = F.weekday("tick_ts") >= 5
    features = {
        "available_count": F.col("available_recon"), "usable_count": F.col("usable_recon"), "known_charger_count": known, "direct_observed_count": F.col("observed_chargers"), "total_chargers": total,
        "observation_coverage": ratio(known, total), "direct_observation_coverage": ratio(F.col("observed_chargers"), total), "unobserved_rate": ratio(total - known, total),
        "observation_age_minutes": F.col("observation_age_minutes"), "available_count_delta_1tick": F.col("available_count_delta_1tick"), "minutes_since_last_change": F.col("minutes_since_last_change"),
        "sessions_per_charger": F.col("sessions_per_charger"), "usage_daytype_avg": F.when(weekend, F.col("usage_weekend_avg")).otherwise(F.col("usage_weekday_avg")),
    }
    fut = [F.struct(F.lit(h).alias("horizon_minutes"), F.col(f"_f{h}").alias("f")) for h in horizons]
    rows = stack(
        now.select("station_id", F.col("tick_ts").alias("feature_as_of"), F.col("tick_s"), *[c.cast("double").alias(n) for n, c in features.items()], F.hour("tick_ts").alias("hour"), F.weekday("tick_ts").alias("weekday"), weekend.alias("is_weekend"), "history_observed", *[f"_f{h}" for h in horizons]),
        ["station_id", "feature_as_of", "tick_s", *features, "hour", "weekday", "is_weekend", "history_observed"], fut,
    )
    y = conservative_target(F.col("f.available_recon"), F.col("f.known_recon"), F.col("f.chargers"))
    rows = rows.where(F.col("f").isNotNull() & F.col("f.collection_success")).withColumn("target_available", y).where("target_available is not null")
    return rows.select(
        "station_id", "feature_as_of", "horizon_minutes", F.col("f.tick_ts").alias("label_observed_at"), ((F.col("f.tick_s") - F.col("tick_s")) / 60.0 - F.col("horizon_minutes")).alias("label_match_delta_minutes"),
        "target_available", F.when(F.col("target_available") == 1, "confirmed_positive").otherwise("full_coverage_negative").alias("label_reason"), *features, "hour", "weekday", "is_weekend", "history_observed",
        ratio(F.col("f.known_recon"), F.col("f.chargers")).alias("target_observation_coverage"), F.to_date("feature_as_of").alias("feature_date"),
    )


def split_training(rows: DataFrame) -> DataFrame:
    return temporal_split(rows, "feature_date")


def replay_rows(panel: DataFrame, neighbors: DataFrame, ticks: DataFrame, horizons=HORIZONS, tol_s: int = TOL_S) -> DataFrame:
    """Stations available now and what became of them at t + h, with how many of their nearest others stayed available."""
    p = _known_future(panel, ticks, F.struct("tick_idx", "tick_ts", "available_recon", "known_recon"), horizons, tol_s).where("available_recon > 0")
    rows = stack(p, ["station_id", "tick_ts", "tick_idx", "known_recon", "available_recon"], [F.struct(F.lit(h).alias("horizon_minutes"), F.col(f"_f{h}").alias("f")) for h in horizons])
    rows = rows.where(F.col("f.known_recon") > 0).withColumns({"arrival_available_count": F.col("f.available_recon"), "matched_arrival_time": F.col("f.tick_ts")}).drop("f")
    alive = rows.where("arrival_available_count > 0").select(F.col("station_id").alias("neighbor_id"), "tick_idx", "horizon_minutes")
    back = neighbors.select("station_id", "neighbor_id").join(alive, "neighbor_id").groupBy("station_id", "tick_idx", "horizon_minutes").agg(F.count("*").alias("fallback_count"))
    out = rows.join(back, ["station_id", "tick_idx", "horizon_minutes"], "left").withColumn("fallback_count", F.coalesce("fallback_count", F.lit(0)))
    gone = F.col("arrival_available_count") <= 0
    return out.select(
        "station_id", F.col("tick_ts").alias("t0"), "horizon_minutes", "matched_arrival_time", F.col("available_recon").alias("current_available_count"), "arrival_available_count",
        (~gone).alias("arrival_available"), (F.col("available_recon") != F.col("arrival_available_count")).alias("available_count_changed"), "fallback_count", (gone & (F.col("fallback_count") > 0)).alias("fallback_covered"),
    )


def replay_stats(rows: DataFrame) -> DataFrame:
    d = lambda c: c.cast("double")
    a, n = F.col("arrival_available"), F.col("current_available_count")
    return rows.groupBy("horizon_minutes").agg(
        F.count("*").alias("labeled_rows"), F.count_distinct("station_id").alias("stations"), F.avg(d(a)).alias("arrival_available_rate"), F.avg(d(F.col("available_count_changed"))).alias("change_rate"),
        F.count_if(~a).alias("failed_rows"), F.avg(F.when(~a, d(F.col("fallback_covered")))).alias("fallback_coverage"), F.avg(F.when(n == 1, d(a))).alias("single_rate"), F.avg(F.when(n >= 2, d(a))).alias("multi_rate"),
    )


# ---- travel times -------------------------------------------------------------------------------------------------

def eta_horizon(eta: Column) -> Column:
    return F.least(F.greatest(F.bround(eta).cast("int"), F.lit(1)), F.lit(120))


def eta_labels(panel: DataFrame, eta: DataFrame, ticks: DataFrame) -> DataFrame:
    """Labels at each station's own travel time: available now, known at the matched tick.

    Distinct horizons are at most 120, so tick pairs are matched once per horizon and joined by key.
    """
    h = eta.where("eta_minutes is not null").select("station_id", "eta_minutes", "straight_km", eta_horizon(F.col("eta_minutes")).alias("horizon_minutes"))
    minutes = h.agg(F.collect_set("horizon_minutes")).scalar()  # at most 120 values
    pairs = match_ticks(ticks.select("tick_s", "segment_id", F.explode(minutes).alias("horizon_minutes")), ticks)
    now = panel.join(h, "station_id").where("known_chargers > 0 and available_count > 0").join(pairs, ["tick_s", "segment_id", "horizon_minutes"])
    later = panel.select("station_id", F.col("tick_s").alias("future_s"), F.col("tick_ts").alias("matched_arrival_time"), F.col("available_count").alias("arrival_available_count"), F.col("known_chargers").alias("_k"))
    return now.join(later, ["station_id", "future_s"]).where("_k > 0").select(
        "station_id", F.col("tick_ts").alias("feature_as_of"), "horizon_minutes", "matched_arrival_time", "eta_minutes", "straight_km", F.col("available_count").alias("current_available_count"), "arrival_available_count",
        (F.col("arrival_available_count") > 0).alias("target_available_at_arrival"),
    )


ETA_BANDS = ((0, 2), (2, 4), (4, 6), (6, 8))  # fixed values: km
ASSUMED_KMH, DEFAULT_RATIO = 30.0, 1.94


def band_of(km: Column) -> Column:
    return reduce(lambda acc, b: acc.when((km >= b[0]) & (km < b[1]), b[0]), ETA_BANDS[1:], F.when((km >= 0) & (km < 2), 0))


def proxy_minutes(km: Column) -> Column:
    return km / ASSUMED_KMH * 60


def eta_ratio_by_band(eta: DataFrame) -> DataFrame:
    r = eta.where("eta_minutes is not null").withColumns({"band": band_of(F.col("straight_km")), "ratio": F.try_divide(F.col("eta_minutes"), proxy_minutes(F.col("straight_km")))})
    n = r.where("band is not null").groupBy("band").agg(F.count("ratio").alias("n"))
    q = quantiles(r.where("band is not null"), ["band"], "ratio", {"ratio_p25": 0.25, "ratio_median": 0.5, "ratio_p75": 0.75})
    return n.join(q, "band")


def fill_eta(eta: DataFrame, bands: DataFrame) -> DataFrame:
    """Missing travel times by straight-line minutes times the band's median ratio; marked as proxy."""
    out = eta.withColumn("band", band_of(F.col("straight_km"))).join(bands.select("band", "ratio_median"), "band", "left")
    proxy = proxy_minutes(F.col("straight_km")) * F.coalesce("ratio_median", F.lit(DEFAULT_RATIO))
    return out.select("station_id", F.coalesce("eta_minutes", proxy).alias("eta_minutes"), F.col("eta_minutes").isNull().alias("eta_is_proxy"), "straight_km", "road_km")


def horizon_overlap(rows: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Joint rows and equal-label rates of every horizon pair; labels of one key are set side by side, not self-joined."""
    wide = rows.groupBy("station_id", "feature_as_of").agg(
        *[F.max(F.when(F.col("horizon_minutes") == h, F.col("target_available"))).alias(f"y{h}") for h in horizons],
        *[F.max(F.when(F.col("horizon_minutes") == h, F.col("label_observed_at"))).alias(f"t{h}") for h in horizons],
    )
    pairs = [F.struct(F.lit(a).alias("left_horizon"), F.lit(b).alias("right_horizon"), F.col(f"y{a}").alias("ya"), F.col(f"y{b}").alias("yb"), (F.col(f"t{a}") == F.col(f"t{b}")).alias("same_tick")) for i, a in enumerate(horizons) for b in horizons[i + 1:]]
    long = wide.select(F.inline(F.array(*pairs)))
    both = F.col("ya").isNotNull() & F.col("yb").isNotNull()
    return long.groupBy("left_horizon", "right_horizon").agg(
        F.count("ya").alias("left_rows"), F.count("yb").alias("right_rows"), F.count_if(both).alias("overlap_rows"), F.count_if(F.col("ya") == F.col("yb")).alias("same_label_rows"), F.count_if(both & F.col("same_tick")).alias("same_tick_rows"),
    ).withColumns({"same_label_rate": F.try_divide("same_label_rows", "overlap_rows"), "overlap_rate": F.try_divide(F.col("overlap_rows"), F.least("left_rows", "right_rows"))})


def handoff(d1: DataFrame) -> DataFrame:
    """Request-time input: times from ages, coverage, freshness, flag list, recheck and readiness marks."""
    age = F.col("status_age_minutes")
    fresh = F.when(age.isNull(), "UNOBSERVED").when(age <= 5, "FRESH").when(age <= 15, "AGING").otherwise("CHECK_REQUIRED")
    seen = F.coalesce("observed_count", F.lit(0)) > 0
    flags = F.array_distinct(F.array_compact(F.array(
        fresh, F.when(~seen, "UNOBSERVED"), F.when(~F.col("coord_ok"), "COORDINATE_EXCLUDED"), F.when(~F.col("recommend_public_default"), "ACCESS_RESTRICTED"), F.when(~seen, "STATUS_MISSING"))))
    back = lambda c: F.timestamp_add("SECOND", -F.round(F.col(c) * 60).cast("int"), F.col("as_of_ts"))
    return d1.select(
        "station_id", back("status_age_minutes").alias("status_updated_at"), back("observation_age_minutes").alias("status_observed_at"), ratio(F.col("observed_count"), F.col("total_chargers")).alias("observation_coverage"),
        fresh.alias("freshness_flag"), F.concat_ws("|", flags).alias("data_quality_flags"), (fresh.isin("CHECK_REQUIRED", "UNOBSERVED") | (F.coalesce("available_count", F.lit(0)) <= 1)).alias("recheck_required"),
        (F.col("coord_ok") & F.col("recommend_public_default") & (F.col("is_operating_now") != "N") & seen).alias("static_candidate_ready"), F.lit(False).alias("availability_guaranteed"),
    )


def in_balanced_sample(rows: DataFrame, y: str, key: list[str], multiple: int = 20, floor: int = 50_000, ceiling: int = 400_000, name: str = "fitted") -> DataFrame:
    """Marks a class-balanced sample (a sampling operator): negatives, and positives up to `multiple` times as many but
    `floor` at least, both at most `ceiling`. A row is in by a seeded hash whose threshold gives the wanted count on
    average, so no sort and no collection is needed."""
    neg, pos = rows.agg(F.count_if(F.col(y) == 0)).scalar(), rows.agg(F.count_if(F.col(y) == 1)).scalar()
    want = F.when(F.col(y) == 0, F.least(neg, F.lit(ceiling))).otherwise(F.least(pos, F.greatest(neg * multiple, F.lit(floor)), F.lit(ceiling)))
    text = F.concat_ws("|", F.lit("42"), *[F.col(k).cast("string") for k in key])
    u = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 2.0**32
    return rows.withColumn(name, F.coalesce(u < F.try_divide(want, F.when(F.col(y) == 0, neg).otherwise(pos)), F.lit(False)))


def balanced_sample(rows: DataFrame, y: str, key: list[str], multiple: int = 20, floor: int = 50_000, ceiling: int = 400_000) -> DataFrame:
    return in_balanced_sample(rows, y, key, multiple, floor, ceiling, "_in").where("_in").drop("_in")


def arrival_gate(open_state: Column) -> Column:
    return F.when(open_state == "N", "DROP").when(open_state == "Y", "KEEP").otherwise("REVIEW")


def strong_pairs(colocated: DataFrame) -> DataFrame:
    """One lot per station: the closest among lots with strong evidence."""
    s = colocated.where("best_grade = 'STRONG'")
    return s.groupBy(F.col("best_station_id").alias("station_id")).agg(F.min_by(F.struct("lot_id", "best_distance_m"), F.struct("best_distance_m", "lot_id")).alias("p")).select("station_id", "p.lot_id", F.col("p.best_distance_m").alias("distance_m"))


def station_distance_km(lat: float, lng: float) -> Column:
    return haversine_m(F.lit(lat), F.lit(lng), F.col("lat"), F.col("lng")) / 1000
