"""Time-of-day, coverage, traffic and vehicle profiles."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import grade_from_minutes, ratio
from chargelens.operators.ranks import quantiles
from chargelens.operators.snapshots import CHARGER

MIN_TICKS, MIN_ROWS = 2, 5000  # fixed values: support below which an hour or weekday is not read


def panel_profile(panel: DataFrame, key: Column, name: str, all_values: int | None = None) -> DataFrame:
    """Availability by hour or weekday with the support filter; with `all_values`, absent keys are shown empty."""
    p = panel.withColumns({name: key, "_use": ratio(F.col("in_use_count"), F.col("usable_known"))})
    out = p.groupBy(name).agg(
        F.count("*").alias("panel_rows"), F.count_distinct("tick_ts").alias("n_timestamps"), F.count_distinct("station_id").alias("n_stations"), F.avg("availability_ratio_observed").alias("avail_mean"),
        F.avg(F.col("has_confirmed_available").cast("double")).alias("confirmed_rate"), F.avg("_use").alias("in_use_rate_mean"),
    ).join(quantiles(p, [name], "availability_ratio_observed", {"avail_median": 0.5}), name, "left")
    if all_values is not None:
        base = panel.sparkSession.range(all_values).select(F.col("id").cast("int").alias(name))
        out = base.join(out, name, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("panel_rows", "n_timestamps", "n_stations")})
    return out.withColumn("analyzable", (F.col("n_timestamps") >= MIN_TICKS) & (F.col("panel_rows") >= MIN_ROWS))


def charger_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 3, "2-3").when(n <= 6, "4-6").otherwise("7+")


def by_charger_count(stations: DataFrame, panel: DataFrame) -> DataFrame:
    mean = panel.groupBy("station_id").agg(F.avg("availability_ratio_observed").alias("_d2"))
    return stations.join(mean, "station_id", "left").groupBy(charger_bucket(F.col("total_chargers")).alias("bucket")).agg(
        F.count("*").alias("stations"), F.avg("total_chargers").alias("total_chargers_mean"), F.avg("unobserved_rate").alias("unobserved_rate_mean"), F.avg(F.col("has_confirmed_available").cast("double")).alias("confirmed_rate"),
        F.avg("availability_ratio_observed").alias("d1_avail_mean"), F.avg("_d2").alias("d2_avail_mean"), F.count("_d2").alias("d2_stations"),
    )


def age_bucket(m: Column) -> Column:
    return F.when(m.isNull(), "UNOBSERVED").when(m <= 5, "<=5min_HIGH").when(m <= 15, "5-15min_NORMAL").otherwise(">15min_CHECK")


def by_freshness(stations: DataFrame, key: Column, name: str) -> DataFrame:
    s = stations.withColumn(name, key)
    n = stations.agg(F.count("*")).scalar()
    out = s.groupBy(name).agg(F.count("*").alias("stations"), F.avg(F.col("has_confirmed_available").cast("double")).alias("confirmed_rate"), F.avg("availability_ratio_observed").alias("avail_mean"), F.avg("unobserved_rate").alias("unobserved_rate_mean"))
    return out.withColumn("share_pct", F.col("stations") * 100.0 / n).join(quantiles(s, [name], "status_age_minutes", {"age_median_min": 0.5}), name, "left")


def segment_quality(panel: DataFrame) -> DataFrame:
    """Length of each station's segments and the gaps between them, one row."""
    seg = panel.groupBy("station_id", "segment_id").agg(F.min("tick_s").alias("a"), F.max("tick_s").alias("b"), F.count("*").alias("ticks"))
    seg = seg.withColumns({"duration": (F.col("b") - F.col("a")) / 60.0, "gap": (F.col("a") - F.lag("b").over(Window.partitionBy("station_id").orderBy("a"))) / 60.0})
    one = seg.agg(
        F.sum("ticks").alias("total_rows"), F.count("*").alias("total_segments"), F.avg("duration").alias("duration_mean"), F.max("duration").alias("duration_max"), F.avg("ticks").alias("ticks_mean"),
        F.count("gap").alias("gaps"), F.avg("gap").alias("gap_mean"), F.max("gap").alias("gap_max"),
    )
    return one.withColumns({"duration_median": quantiles(seg, [], "duration", {"m": 0.5}).scalar(), "gap_median": quantiles(seg, [], "gap", {"m": 0.5}).scalar()})


def access_hour_profile(panel: DataFrame, flags: DataFrame) -> DataFrame:
    """Hourly availability of public against restricted or residential stations, each tick's fleet weighed once."""
    kind = F.when(F.col("access_restricted") | F.col("name_suggests_residential"), "restricted_or_residential").otherwise("public")
    p = panel.join(flags.select("station_id", kind.alias("access")), "station_id")
    tick = p.groupBy("access", "tick_ts").agg(F.sum("available_count").alias("a"), F.sum("usable_known").alias("u"))
    return tick.where("u > 0").groupBy("access", F.hour("tick_ts").alias("hour")).agg(F.avg(F.col("a") * 100.0 / F.col("u")).alias("mean_pct"), F.count("*").alias("ticks"))


def date_hour_matrix(series: DataFrame) -> DataFrame:
    return series.groupBy("date", "hour").agg(F.avg("availability_pct").alias("availability_pct"), F.count("availability_pct").alias("ticks"))


def day_night(series: DataFrame) -> DataFrame:
    s = series.where("availability_pct is not null")
    return s.groupBy(F.when(F.col("hour").between(7, 22), "day_07_22").otherwise("night_23_06").alias("tod")).agg(
        F.avg("availability_pct").alias("mean_pct"), F.min("availability_pct").alias("min_pct"), F.max("availability_pct").alias("max_pct"), F.count("*").alias("ticks")
    )


def snapshot_inventory(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """One row per poll: rows, stations, chargers, status mix, gap and size tertile."""
    per = events.groupBy("tick_ts").agg(
        F.count("*").alias("n_rows"), F.count_distinct("station_id").alias("stations"), F.count_distinct(*CHARGER).alias("chargers"),
        F.count_if(F.col("stat") == 2).alias("stat_2"), F.count_if(F.col("stat") == 3).alias("stat_3"), F.count_if(~F.coalesce(F.col("stat").isin(2, 3), F.lit(False))).alias("stat_other"),
    )
    q = quantiles(per, [], "n_rows", {"q1": 1 / 3, "q2": 2 / 3})
    q1, q2 = q.select("q1").scalar(), q.select("q2").scalar()
    size = F.when(F.col("n_rows") <= q1, "small").when(F.col("n_rows") <= q2, "medium").otherwise("large")
    return per.join(ticks.select("tick_ts", (F.col("prev_gap_s") / 60.0).alias("gap_min")), "tick_ts").withColumn("size_class", size)


def inventory_by_date(inventory: DataFrame) -> DataFrame:
    d = inventory.withColumn("date", F.to_date("tick_ts"))
    per = d.groupBy("date").agg(F.count("*").alias("snapshots"), F.sum("n_rows").alias("rows_sum"), F.max("gap_min").alias("gap_max"), F.count_if(F.col("gap_min") > 25).alias("gaps_gt25"))
    return per.join(quantiles(d, ["date"], "gap_min", {"gap_med": 0.5}), "date", "left")


def observation_depth(events: DataFrame, at_least=(1, 2, 5, 10, 20, 30)) -> DataFrame:
    n = events.groupBy(*CHARGER).agg(F.count("*").alias("n"))
    one = n.agg(*[F.count_if(F.col("n") >= k).alias(f"k{k}") for k in at_least])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("at_least"), F.col(f"k{k}").alias("chargers")) for k in at_least])))


def dwell_rows(events: DataFrame) -> DataFrame:
    """Finished dwells: minutes from the tick a state began to the tick it changed. `events` is one row per charger and tick."""
    w = Window.partitionBy(*CHARGER).orderBy("tick_ts")
    starts = events.withColumn("_p", F.lag("stat").over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col("stat")))
    nxt = F.lead("tick_ts").over(w)
    return starts.withColumn("dwell_minutes", F.timestamp_diff("SECOND", F.col("tick_ts"), nxt) / 60.0).where("dwell_minutes is not null").select(*CHARGER, "tick_ts", "stat", "dwell_minutes")


def dwell_summary(events: DataFrame) -> DataFrame:
    d = dwell_rows(events)
    moves = events.select(*CHARGER).distinct().join(d.groupBy(*CHARGER).agg(F.count("*").alias("n")), list(CHARGER), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    one = d.agg(F.count("*").alias("dwells"), F.avg((F.col("dwell_minutes") < 5).cast("double")).alias("lt_5min_share"), F.avg((F.col("dwell_minutes") > 1440).cast("double")).alias("gt_24h_share"))
    q = quantiles(d, [], "dwell_minutes", {"p05": 0.05, "median": 0.5, "p95": 0.95})
    m = quantiles(moves, [], "n", {"median": 0.5, "p95": 0.95})
    return one.withColumns({
        "dwell_p05": q.select("p05").scalar(), "dwell_median": q.select("median").scalar(), "dwell_p95": q.select("p95").scalar(),
        "transitions_mean": moves.agg(F.avg("n")).scalar(), "transitions_median": m.select("median").scalar(), "transitions_p95": m.select("p95").scalar(),
    })


def daily_checkpoint(raw: DataFrame, dedup: DataFrame, log: DataFrame, series: DataFrame) -> DataFrame:
    """One row per date: raw and kept rows, timing, panel level, cumulative depth, health.

    Depth through a date needs no rescan: each charger enters a depth on one date, and dates are then summed up.
    """
    day = F.to_date("tick_ts").alias("date")
    rows = raw.groupBy(day).agg(F.count("*").alias("raw_rows"))
    kept = dedup.groupBy(day).agg(F.count("*").alias("dedup_rows"), F.count_if(~F.coalesce(F.col("stat").isin(1, 2, 3, 4, 5, 9), F.lit(False))).alias("invalid_status_rows"))
    timing = log.withColumn("date", F.to_date("tick_ts"))
    time = timing.groupBy("date").agg(F.count("*").alias("snapshots"), F.sum("api_calls").alias("api_calls"), F.max("n_rows").alias("rows_max"))
    gaps = timing.withColumn("g", F.timestamp_diff("SECOND", F.lag("tick_ts").over(Window.partitionBy("date").orderBy("tick_ts")), F.col("tick_ts")) / 60.0)
    med = quantiles(gaps, ["date"], "g", {"interval_median_minutes": 0.5})
    panel = series.groupBy("date").agg(F.avg("availability_pct").alias("availability_mean_pct"), F.count_distinct("segment_id").alias("segments"))
    per = dedup.groupBy(*CHARGER, day).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*CHARGER).orderBy("date")
    run = per.withColumn("c", F.sum("n").over(w)).withColumn("p", F.col("c") - F.col("n"))
    enter = run.groupBy("date").agg(*[F.count_if((F.col("p") < k) & (F.col("c") >= k)).alias(f"e{k}") for k in (1, 2, 5, 10)])
    by_day = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # one row per calendar day
    depth = enter.select("date", *[F.sum(f"e{k}").over(by_day).alias(f"chargers_ge_{k}") for k in (1, 2, 5, 10)])
    out = time.join(rows, "date", "left").join(kept, "date", "left").join(med, "date", "left").join(panel, "date", "left").join(depth, "date", "left")
    ok = (F.col("invalid_status_rows") == 0) & F.coalesce(F.col("interval_median_minutes") <= 25, F.lit(False))
    return out.withColumn("duplicate_rows", F.col("raw_rows") - F.col("dedup_rows")).withColumn("health", F.when(ok, "healthy").otherwise("check_required"))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of several columns in one pass."""
    kinds = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(kinds)).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def latest_tariffs(tariffs: DataFrame) -> DataFrame:
    new = tariffs.where(F.col("month") == tariffs.agg(F.max("month")).scalar())
    return new.groupBy("month", "operator_name").agg(F.min_by("fee_krw", "tariff_id").alias("fee_krw"))


SOC_LEVELS = (10.0, 15.0, 20.0, 30.0, 50.0)  # fixed values: starting charge, percent
DANGER_SOC, WARN_SOC = 10.0, 20.0  # fixed values: percent
FALLBACK_KWH, FALLBACK_KM_PER_KWH = 50.0, 4.0


def soc_scenarios(routes: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Charge left on arrival for route x vehicle x starting charge.

    Every route meets every vehicle, which is the result itself. Both sides are cut by a vehicle bucket, so the product
    is spread over tasks by an equi-join and neither side has to be small.
    """
    buckets = 8
    cars = vehicles.where("battery_kwh > 0 and range_km > 0").select("model_name", "battery_kwh", "range_km")
    cars = cars.withColumn("_b", F.pmod(F.xxhash64("model_name"), F.lit(buckets)).cast("int"))
    own = routes.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).join(cars, "_b").drop("_b")
    unknown = routes.withColumns({"model_name": F.lit("__FALLBACK__"), "battery_kwh": F.lit(FALLBACK_KWH), "range_km": F.lit(FALLBACK_KWH * FALLBACK_KM_PER_KWH)})
    v = own.unionByName(unknown).withColumn("current_soc", F.explode(F.array(*[F.lit(x) for x in SOC_LEVELS])))
    arrival = F.col("current_soc") - F.col("distance_km") / (F.col("range_km") / F.col("battery_kwh")) / F.col("battery_kwh") * 100
    out = v.select("route_id", "distance_km", "model_name", "current_soc", arrival.alias("arrival_soc"))
    return out.withColumns({
        "soc_safety_margin": F.col("arrival_soc") - DANGER_SOC, "can_reach": F.col("arrival_soc") > 0, "used_fallback": F.col("model_name") == "__FALLBACK__",
        "soc_risk_level": F.when(F.col("arrival_soc") <= DANGER_SOC, "DANGER").when(F.col("arrival_soc") <= WARN_SOC, "WARNING").otherwise("SAFE"),
    })


def soc_summary(scenarios: DataFrame) -> DataFrame:
    return scenarios.groupBy("current_soc").agg(
        F.count("*").alias("scenarios"), F.avg((F.col("soc_risk_level") == "DANGER").cast("double")).alias("danger_rate"), F.avg(F.col("can_reach").cast("double")).alias("reach_rate"), F.avg("arrival_soc").alias("arrival_soc_mean")
    )


def drive_check(bms: DataFrame, km_per_kwh: float, battery_kwh: float) -> DataFrame:
    """Per vehicle: the drive from its highest charge to the next lowest, its distance and charge drop against the model."""
    top = bms.groupBy("vehicle_id").agg(F.max_by(F.struct("ts", "soc"), F.struct("soc", -F.unix_micros(F.col("ts").cast("timestamp")))).alias("t"))
    after = bms.join(top, "vehicle_id").where(F.col("ts") >= F.col("t.ts"))
    low = after.groupBy("vehicle_id").agg(F.min(F.struct("soc", "ts")).alias("l"))
    drive = after.join(low, "vehicle_id").where(F.col("ts") <= F.col("l.ts"))
    out = drive.groupBy("vehicle_id").agg((F.max("odometer_km") - F.min("odometer_km")).alias("distance_km"), (F.max("soc") - F.min("soc")).alias("soc_drop"), F.avg("speed_kph").alias("avg_speed"), F.count("*").alias("points"))
    model = F.col("distance_km") / km_per_kwh / battery_kwh * 100
    return out.withColumn("model_soc_drop", model).withColumn("error_pct", F.try_divide((F.col("soc_drop") - model) * 100, model))


def charger_state_sets(events: DataFrame) -> DataFrame:
    """The states each charger was ever seen in (a subset of six codes) and how many chargers share the set."""
    s = events.groupBy(*CHARGER).agg(F.array_join(F.array_sort(F.collect_set(F.col("stat").cast("string"))), ",").alias("states"))
    return s.groupBy("states").agg(F.count("*").alias("chargers"))


def observation_histogram(events: DataFrame, width: int = 10) -> DataFrame:
    n = events.groupBy(*CHARGER).agg(F.count("*").alias("n"))
    return n.groupBy((F.floor(F.col("n") / width) * width).alias("bin_start")).agg(F.count("*").alias("chargers"))


def status_mix_by_hour(events: DataFrame) -> DataFrame:
    n = F.count("*")
    return events.groupBy(F.hour("tick_ts").alias("hour")).agg(n.alias("n"), *[(F.count_if(F.col("stat") == s) / n).alias(f"share_{s}") for s in (1, 2, 3, 4, 5, 9)])


def supply_profile(chargers: DataFrame) -> DataFrame:
    """How many stations and chargers each operator has, and chargers per station."""
    st = chargers.groupBy("busi_nm", "station_id").agg(F.count("*").alias("n"))
    return st.groupBy("busi_nm").agg(F.count("*").alias("stations"), F.sum("n").alias("chargers"), F.avg("n").alias("chargers_per_station"), F.max("n").alias("largest"))


def observation_coverage(stations: DataFrame, events: DataFrame) -> DataFrame:
    seen = events.select("station_id").distinct().withColumn("_s", F.lit(1.0))
    s = stations.where("lat between 35.55 and 36.45 and lng between 128.25 and 129.05").join(seen, "station_id", "left")
    return s.agg(F.count("*").alias("stations"), F.count("_s").alias("observed"), (F.avg(F.coalesce("_s", F.lit(0.0))) * 100).alias("observed_pct"))


def grade_share_by_day(aged: DataFrame) -> DataFrame:
    g = grade_from_minutes(F.col("age_minutes"))
    n = F.count("*")
    return aged.groupBy(F.to_date("fetched_at").alias("date")).agg(n.alias("n_rows"), *[(F.count_if(g == k) / n).alias(f"share_{k.lower()}") for k in ("HIGH", "NORMAL", "CHECK_REQUIRED")])


# ---- traffic ------------------------------------------------------------------------------------------------------

def link_tick_summary(ticks: DataFrame, grade: Column) -> DataFrame:
    """Grade shares of links with a known grade and speed mean and median per tick."""
    t = ticks.withColumn("_g", grade)
    known = F.count_if(F.col("_g").isin(1, 2, 3))
    pct = lambda *g: ratio(F.count_if(F.col("_g").isin(*g)), known) * 100
    out = t.groupBy("tick_ts").agg(F.count("*").alias("links"), pct(1).alias("pct_smooth"), pct(2).alias("pct_slow"), pct(3).alias("pct_jam"), pct(2, 3).alias("pct_congested"), F.avg("speed_kph").alias("speed_mean"))
    return out.join(quantiles(t, ["tick_ts"], "speed_kph", {"speed_median": 0.5}), "tick_ts", "left")


def hour_union(tick_summary: DataFrame) -> DataFrame:
    g = tick_summary.groupBy(F.hour("tick_ts").alias("hour")).agg(F.count("*").alias("ticks"), F.count_distinct(F.to_date("tick_ts")).alias("days"), F.avg("pct_congested").alias("pct_congested_mean"), F.avg("speed_mean").alias("speed_mean"))
    hours = tick_summary.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(g, "hour", "left").withColumns({"ticks": F.coalesce("ticks", F.lit(0)), "days": F.coalesce("days", F.lit(0))})


def traffic_beside_availability(hours: DataFrame, availability: DataFrame) -> DataFrame:
    return hours.where("pct_congested_mean is not null").join(availability, "hour").select("hour", "pct_congested_mean", "speed_mean", "availability_pct")


def incident_ticks(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("tick_ts").agg(F.count("*").alias("n"), F.count_distinct("incident_id").alias("n_unique"))


def top_values(unique_events: DataFrame, column: Column, k: int = 8) -> DataFrame:
    return unique_events.groupBy(column.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)
