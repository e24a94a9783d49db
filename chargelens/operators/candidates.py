"""Station snapshot assembly, candidate list, rankings and samples."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import haversine_m
from chargelens.operators.ranks import numbered, quantiles
from chargelens.session import stage


def assemble(stations: DataFrame, status: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row per station: every part is keyed by station and joined on the left; what did not match stays NULL."""
    out = stations.join(status, "station_id", "left")
    for p in parts:
        out = out.join(p, "station_id", "left")
    return out.withColumns({
        "observation_state": F.coalesce("observation_state", F.lit("UNOBSERVED")),
        "poi_count_1km": F.coalesce("poi_count_1km", F.lit(0)), "history_observed": F.coalesce("history_observed", F.lit(False)),
    })


def _gates() -> dict[str, Column]:
    return {
        "public": F.col("recommend_public_default"),
        "coord": F.coalesce(F.col("coord_ok"), F.lit(False)) & F.col("lat").isNotNull() & F.col("lng").isNotNull(),
        "available": F.coalesce(F.col("has_confirmed_available"), F.lit(False)),
        "operating": F.col("is_operating_now") != "N",
    }


def _evidence() -> Column:
    """One line per candidate: what speaks for it, then after a bar what to look at before driving there.

    Both parts are lists of (weight, text); entries that do not apply are left out and the heaviest come first.
    """
    meters = lambda c: F.concat(F.round(F.col(c)).cast("long").cast("string"), F.lit("m"))
    number = lambda c: F.col(c).cast("long").cast("string")
    free, total, spaces = F.col("available_count"), F.col("total_chargers"), F.col("parking_remaining_spaces")
    minutes = F.least(F.col("status_age_minutes"), F.col("observation_age_minutes"))
    entry = lambda on, weight, text: F.when(on, F.struct((-weight).alias("w"), text.alias("t")))
    said = lambda entries: F.array_join(F.transform(F.array_sort(F.array_compact(F.array(*entries))), lambda e: e["t"]), "; ")
    pros = [
        entry(free > 0, free * 10, F.concat(number("available_count"), F.lit(" of "), number("total_chargers"), F.lit(" free"))),
        entry(minutes <= 15, F.lit(9), F.concat(F.lit("seen "), F.round(minutes).cast("long").cast("string"), F.lit(" min ago"))),
        entry(spaces > 0, F.lit(5), F.concat(number("parking_remaining_spaces"), F.lit(" parking spaces at "), meters("nearest_parking_m"))),
        entry(F.col("usage_level") == "LOW", F.lit(3), F.lit("rarely busy")),
    ]
    cons = [
        entry((F.col("is_operating_now") == "UNKNOWN"), F.lit(8), F.lit("opening hours unclear")),
        entry(F.coalesce(minutes > 15, F.lit(True)), F.lit(7), F.lit("state is old")),
        entry(spaces <= 0, F.lit(6), F.lit("parking full")),
        entry(F.col("nearest_incident_m") <= 500, F.lit(4), F.concat(F.lit("road incident at "), meters("nearest_incident_m"))),
        entry((total == 1), F.lit(2), F.lit("no second charger")),
    ]
    return F.concat(said(pros), F.lit(" | "), said(cons))


def candidate_list(d1: DataFrame, lat: float, lng: float, limit: int) -> DataFrame:
    """Public, located, available and not closed stations by tier and distance; the list length is the request's."""
    g = _gates()
    fresh = F.col("reliability_grade_effective").isin("HIGH", "NORMAL") & (F.col("is_operating_now") == "Y")
    ok = d1.where(g["public"] & g["coord"] & g["available"] & g["operating"]).withColumns({
        "distance_m": haversine_m(F.lit(lat), F.lit(lng), F.col("lat"), F.col("lng")), "tier": F.when(fresh, "A").otherwise("B"), "evidence": _evidence(),
    })
    order = ["tier", "distance_m", F.desc("available_count"), "station_id"]
    top = ok.orderBy(*order).limit(limit)
    return top.withColumn("display_rank", F.row_number().over(Window.orderBy(*order)))


def candidate_funnel(d1: DataFrame) -> DataFrame:
    """Stations left after each gate, and stations rejected by the first gate they fail."""
    g = _gates()
    p, c, a, o = g["public"], g["coord"], g["available"], g["operating"]
    rows = [
        ("all", F.lit(True)), ("public", p), ("located", p & c), ("available", p & c & a), ("listed", p & c & a & o), ("rejected_access_restricted", ~p),
        ("rejected_coordinate", p & ~c), ("rejected_no_available", p & c & ~a), ("rejected_closed", p & c & a & ~o),
    ]
    one = d1.agg(*[F.count_if(cond).alias(name) for name, cond in rows])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("stations")) for n, _ in rows])))


# ---- windows and samples ------------------------------------------------------------------------------------------

def gap_list(ticks: DataFrame, expected_min: float = 10.0, gap_min: float = 25.0) -> DataFrame:
    minutes = F.col("prev_gap_s") / 60.0
    missed = F.greatest(F.bround(minutes / expected_min).cast("int") - 1, F.lit(1))
    return ticks.where(minutes > gap_min).select("tick_ts", minutes.alias("minutes"), missed.alias("approx_missed"))


def timing_summary(ticks: DataFrame, expected_min: float = 10.0, gap_min: float = 25.0) -> DataFrame:
    minutes = F.col("prev_gap_s") / 60.0
    span = (F.max("tick_s") - F.min("tick_s")) / 60.0
    one = ticks.agg(F.count("*").alias("ticks"), span.alias("span_minutes"), F.max(minutes).alias("interval_max"), F.count_if(minutes > gap_min).alias("gaps"))
    expected = F.bround(F.col("span_minutes") / expected_min).cast("int") + 1
    med = quantiles(ticks, [], "prev_gap_s", {"m": 0.5}).scalar() / 60.0
    return one.withColumns({"expected_rounds": expected, "interval_median": med, "continuity_pct": F.least(F.col("ticks") * 100.0 / expected, F.lit(100.0))})


def longest_failure(ticks: DataFrame) -> DataFrame:
    """Longest run of failed polls: failures between two good polls share the running count of good ones."""
    runs = ticks.where("not ok").groupBy("good_upto").agg(F.count("*").alias("n"))
    return runs.agg(F.coalesce(F.max("n"), F.lit(0)).alias("max_consecutive_failures"))


def longest_day_run(dates: DataFrame, column: str = "date") -> DataFrame:
    """Longest run of consecutive dates (one row per calendar day)."""
    d = dates.select(F.col(column).alias("d")).where("d is not null").distinct()
    run = d.withColumn("g", F.date_sub("d", F.row_number().over(Window.orderBy("d")))).groupBy("g").agg(F.count("*").alias("n"))
    return run.agg(F.coalesce(F.max("n"), F.lit(0)).alias("max_consecutive_days"))


def cumulative_chargers(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Chargers per poll and distinct chargers seen so far: each charger counts once, in its first poll."""
    keys = ["station_id", "charger_id"]
    first = events.groupBy(*keys).agg(F.min("tick_ts").alias("tick_ts")).groupBy("tick_ts").agg(F.count("*").alias("new"))
    per = events.groupBy("tick_ts").agg(F.count_distinct(*keys).alias("per_snapshot"))
    t = ticks.select("tick_ts", "tick_idx", F.to_date("tick_ts").alias("_d")).join(per, "tick_ts").join(first, "tick_ts", "left").withColumn("new", F.coalesce("new", F.lit(0)))
    day = t.groupBy("_d").agg(F.sum("new").alias("n"))
    before = day.select("_d", F.coalesce(F.sum("n").over(Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inday = F.sum("new").over(Window.partitionBy("_d").orderBy("tick_idx"))
    return t.withColumn("_in", inday).join(before, "_d").select("tick_ts", "per_snapshot", (F.col("_b") + F.col("_in")).alias("cumulative_unique"))


def temporal_split(df: DataFrame, date: str = "feature_date", train: float = 0.6, valid: float = 0.8) -> DataFrame:
    """Whole dates to train / valid / test in time order, none empty; needs three dates. One row per date is ranked."""
    d = df.select(date).where(F.col(date).isNotNull()).distinct()
    n = d.agg(F.count("*")).scalar()
    a = F.greatest(F.lit(1), F.floor(n * F.lit(train) + F.lit(1e-9)))
    b = F.least(F.greatest(a + 1, F.floor(n * F.lit(valid) + F.lit(1e-9))), n - 1)
    rn = F.row_number().over(Window.orderBy(date))
    named = d.withColumns({"_rn": rn, "_n": n, "_a": a, "_b": b}).select(
        date, F.when(F.col("_n") < 3, F.raise_error(F.lit("temporal split needs at least three dates")).cast("string")).when(F.col("_rn") <= F.col("_a"), "train").when(F.col("_rn") <= F.col("_b"), "valid").otherwise("test").alias("split")
    )
    return df.join(named, date)


def time_or_row_split(df: DataFrame, time_s: str, tie: str, date: str, train: float = 0.70, valid: float = 0.85, min_dates: int = 6) -> DataFrame:
    """70/15/15 by whole dates, or by row rank in time when there are fewer than six dates."""
    d = stage(df.select(date).distinct())
    n = d.count()
    named = lambda pos: F.when(pos < train, "train").when(pos < valid, "valid").otherwise("test")
    if n >= min_dates:  # rows need no rank
        days = d.select(date, named((F.row_number().over(Window.orderBy(date)) - 1) / F.lit(n)).alias("split"))
        return df.join(days, date).select(*df.columns, "split")
    ranked = numbered(df.where(F.col(date).isNotNull()), [], time_s, [tie])
    return ranked.withColumn("split", named((F.col("row_no") - 1) / F.col("n_rows"))).select(*df.columns, "split")


BAND_EDGES_KM = (0.0, 2.0, 4.0, 6.0, 8.0)  # fixed values


def distance_band(km: Column) -> Column:
    out = None
    for i, (lo, hi) in enumerate(zip(BAND_EDGES_KM[:-1], BAND_EDGES_KM[1:], strict=True)):
        hit = (km >= lo) & (km < hi)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def band_sample(points: DataFrame, lat: float, lng: float, per_band: int) -> DataFrame:
    """Evenly spaced stations by distance rank inside each band around an origin (a sampling operator)."""
    km = haversine_m(F.lit(lat), F.lit(lng), F.col("lat"), F.col("lng")) / 1000
    p = points.withColumn("distance_km", km).withColumn("band", distance_band(F.col("distance_km"))).where("band is not null")
    r = numbered(p, ["band"], "distance_km", ["station_id"])
    last = F.col("n_rows") - 1
    take = F.least(F.lit(per_band), F.col("n_rows"))
    wanted = F.transform(F.sequence(F.lit(0), take.cast("int") - 1), lambda i: F.bround(i * last / F.greatest(take - 1, F.lit(1))).cast("long"))
    return r.where(F.array_contains(wanted, F.col("row_no") - 1)).select("station_id", "band", "distance_km")


def metric_rows(df: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    return df.select(key, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))


def iqr_fences(rows: DataFrame) -> DataFrame:
    """Fences at 1.5 and 3 interquartile ranges per metric; with no spread, the 1st and 99th percentile."""
    q = quantiles(rows, ["metric"], "value", {"p01": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99})
    iqr = F.col("q3") - F.col("q1")
    flat = F.abs(iqr) < 1e-12
    fence = lambda side, k: F.when(flat, F.col("p01" if side < 0 else "p99")).otherwise(F.col("q1" if side < 0 else "q3") + side * k * iqr)
    return q.withColumns({"iqr": iqr, "lo_mild": fence(-1, 1.5), "hi_mild": fence(1, 1.5), "lo_far": fence(-1, 3.0), "hi_far": fence(1, 3.0)})


def iqr_summary(rows: DataFrame) -> DataFrame:
    rows = stage(rows)
    f = iqr_fences(rows)
    v = F.col("value")
    n = rows.where(v.isNotNull()).join(f, "metric").groupBy("metric").agg(
        F.count("*").alias("n"), F.count_if((v < F.col("lo_mild")) | (v > F.col("hi_mild"))).alias("n_mild"), F.count_if((v < F.col("lo_far")) | (v > F.col("hi_far"))).alias("n_far")
    )
    return f.join(n, "metric").select("metric", "n", "q1", "median", "q3", "iqr", "lo_mild", "hi_mild", "n_mild", "n_far")


def top_outliers(rows: DataFrame, key: str, k: int = 15) -> DataFrame:
    """Largest deviations from the median among outliers, k per metric (Spark cuts to k before the shuffle)."""
    rows = stage(rows)
    f = iqr_fences(rows)
    v = F.col("value")
    out = rows.join(f, "metric").where((v < F.col("lo_mild")) | (v > F.col("hi_mild"))).withColumn("deviation", F.abs(v - F.col("median")))
    w = Window.partitionBy("metric").orderBy(F.desc("deviation"), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("metric", key, "value", "deviation", "rank")
