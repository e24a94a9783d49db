"""Daily usage, charging sessions, parking history."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import ratio
from chargelens.operators.ranks import numbered, quantiles, value_ranks
from chargelens.session import stage

# fixed values: public holidays on a solar date
HOLIDAYS = ("01-01", "03-01", "05-05", "06-06", "08-15", "10-03", "10-09", "12-25")
# fixed values: public holidays on a lunar date, their substitutes, and days declared for one year
MOVING_HOLIDAYS = (
    "2024-02-09", "2024-02-10", "2024-02-11", "2024-02-12", "2024-04-10", "2024-05-06", "2024-05-15", "2024-09-16", "2024-09-17", "2024-09-18",
    "2025-01-28", "2025-01-29", "2025-01-30", "2025-03-03", "2025-05-05", "2025-05-06", "2025-10-05", "2025-10-06", "2025-10-07", "2025-10-08",
    "2026-02-16", "2026-02-17", "2026-02-18", "2026-05-24", "2026-05-25", "2026-09-24", "2026-09-25", "2026-09-26",
)
LEVELS = ("적음", "보통", "많음")


def day_type(date: Column, moving: tuple[str, ...] = MOVING_HOLIDAYS) -> Column:
    """holiday, weekend or weekday; `moving` lists holidays that have no fixed day of the year."""
    holiday = F.date_format(date, "MM-dd").isin(*HOLIDAYS) | F.date_format(date, "yyyy-MM-dd").isin(*moving)
    return F.when(holiday, "holiday").when(F.weekday(date) >= 5, "weekend").otherwise("weekday")


def station_usage(usage: DataFrame, matched: DataFrame) -> DataFrame:
    """Usage rows under the charging station their municipal station was matched to."""
    m = matched.where("matched").select(F.col("station_id").alias("_m"), F.col("matched_id").alias("_s"))
    return usage.join(m, F.col("station_id") == F.col("_m")).withColumn("station_id", F.col("_s")).drop("_m", "_s")


def usage_features(usage: DataFrame) -> DataFrame:
    """Per station and charger type: means over days, weekday kinds and recent windows, per-charger intensity, level.

    Daily totals are aggregated once; every mean is a conditional aggregate over them.
    """
    keys = ["station_id", "charger_type"]
    n_ch = usage.select(*keys, "charger_id").distinct().groupBy(*keys).agg(F.count("*").alias("n_chargers"))
    daily = usage.groupBy(*keys, "use_date").agg(F.sum("sessions").alias("sessions"), F.sum("kwh").alias("kwh"))
    newest = usage.agg(F.max("use_date")).scalar()
    dow = F.weekday("use_date")
    s = F.col("sessions")
    recent = lambda d: F.datediff(newest, F.col("use_date")) < d
    feat = daily.groupBy(*keys).agg(
        F.avg(s).alias("avg_sessions_all"), F.avg("kwh").alias("_kwh"), F.count("*").alias("n_days"),
        F.avg(F.when(dow < 5, s)).alias("weekday_avg_sessions"), F.avg(F.when(dow >= 5, s)).alias("weekend_avg_sessions"),
        F.avg(F.when(recent(7), s)).alias("avg_sessions_7d"), F.avg(F.when(recent(28), s)).alias("avg_sessions_28d"), F.avg(F.when(recent(28), F.col("kwh"))).alias("avg_kwh_28d"),
        *[F.avg(F.when(dow == d, s)).alias(f"same_dow_{d}_avg_sessions") for d in range(7)],
    ).join(n_ch, keys)
    return feat.withColumns({
        "sessions_per_charger": F.col("avg_sessions_all") / F.col("n_chargers"), "sessions_per_charger_28d": F.col("avg_sessions_28d") / F.col("n_chargers"),
        "kwh_per_session": F.try_divide(F.col("_kwh"), F.col("avg_sessions_all")),
    }).drop("_kwh")


def usage_levels(feat: DataFrame) -> DataFrame:
    """Tertile label and average-tie percentile of the intensity inside each charger type."""
    feat = stage(feat)
    rank = numbered(feat, ["charger_type"], "sessions_per_charger", ["station_id"])
    third = (F.col("row_no") - 1) * 3
    level = F.when(third <= F.col("n_rows") - 1, LEVELS[0]).when(third <= 2 * (F.col("n_rows") - 1), LEVELS[1]).otherwise(LEVELS[2])
    ties = value_ranks(feat, ["charger_type"], "sessions_per_charger").select("charger_type", "sessions_per_charger", "avg_rank")
    return rank.withColumn("usage_level", level).join(ties, ["charger_type", "sessions_per_charger"]).withColumn(
        "usage_percentile", F.col("avg_rank") / F.col("n_rows")
    ).drop("row_no", "n_rows", "avg_rank")


def usage_per_station(levels: DataFrame) -> DataFrame:
    """The station's charger type with the highest intensity."""
    pick = F.struct("usage_level", "sessions_per_charger", F.col("weekday_avg_sessions").alias("usage_weekday_avg"), F.col("weekend_avg_sessions").alias("usage_weekend_avg"), F.col("charger_type").alias("usage_charger_type"))
    out = levels.groupBy("station_id").agg(F.min_by(pick, F.struct(-F.col("sessions_per_charger"), "charger_type")).alias("r"))
    return out.select("station_id", "r.*").withColumn("history_observed", F.lit(True))


def fleet_daily(usage: DataFrame) -> DataFrame:
    return usage.groupBy("use_date").agg(
        F.sum("sessions").alias("sessions"), F.sum("kwh").alias("kwh"), F.count_distinct("station_id", "charger_id").alias("chargers"), F.count_distinct("station_id").alias("stations")
    )


def moving_means(daily: DataFrame) -> DataFrame:
    """7- and 28-row means over the day table (one row per calendar day)."""
    w = Window.orderBy("use_date")
    return daily.withColumns({"sessions_ma7": F.avg("sessions").over(w.rowsBetween(-6, 0)), "sessions_ma28": F.avg("sessions").over(w.rowsBetween(-27, 0))})


def usage_breakdown(usage: DataFrame) -> DataFrame:
    """Mean sessions by weekday, month and charger type in one pass (grouping sets)."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("bucket")) for k, v in (("weekday", F.weekday("use_date")), ("month", F.month("use_date")), ("type", F.col("charger_type")))])
    return usage.select("sessions", "kwh", F.inline(kinds)).groupBy("kind", "bucket").agg(F.avg("sessions").alias("sessions_mean"), F.avg("kwh").alias("kwh_mean"), F.count("*").alias("n_rows"))


def usage_volatility(usage: DataFrame) -> DataFrame:
    per_day = usage.groupBy("station_id", "use_date").agg(F.sum("sessions").alias("s"), F.sum("kwh").alias("k"))
    return per_day.groupBy("station_id").agg(F.stddev_samp("s").alias("sessions_std"), F.avg("s").alias("sessions_mean"), F.count("*").alias("days"))


def usage_summary(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.corr("sessions", "kwh").alias("sessions_kwh_corr"), F.count_if(F.col("sessions") == 0).alias("zero_session_rows"), F.count_distinct("use_date").alias("distinct_dates"),
        (F.datediff(F.max("use_date"), F.min("use_date")) + 1).cast("long").alias("span_days"),
    )


def station_ranking(usage: DataFrame, top: int = 50) -> DataFrame:
    """Most used stations; the cut is taken per partition before the merge."""
    s = usage.groupBy("station_id").agg(F.sum("sessions").alias("sessions")).orderBy(F.desc("sessions"), "station_id").limit(top)
    return s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("sessions"), "station_id")))


def day_type_lift(links: DataFrame, usage: DataFrame) -> DataFrame:
    """Mean daily sessions by day type of each station linked to a point of interest, and lift over the weekday mean and
    over the mean of all stations. Usage is folded per station first; a station with many days joins as one row."""
    daily = usage.groupBy("station_id", "use_date").agg(F.sum("sessions").alias("s")).withColumn("t", day_type(F.col("use_date")))
    kinds = ("weekday", "weekend", "holiday")
    per = daily.groupBy("station_id").agg(F.count("*").alias("has_usage_days"), *[F.avg(F.when(F.col("t") == k, F.col("s"))).alias(f"sessions_mean_{k}") for k in kinds])
    control = daily.agg(F.avg(F.when(F.col("t") == "holiday", F.col("s"))).alias("c")).scalar()
    out = links.join(per, "station_id", "left").withColumn("has_usage_days", F.coalesce("has_usage_days", F.lit(0)))
    return out.withColumns({
        "holiday_vs_weekday": F.try_divide("sessions_mean_holiday", "sessions_mean_weekday"),
        "weekend_vs_weekday": F.try_divide("sessions_mean_weekend", "sessions_mean_weekday"),
        "holiday_vs_control": F.try_divide(F.col("sessions_mean_holiday"), control),
    })


def poi_day_types(links: DataFrame, usage: DataFrame) -> DataFrame:
    """Per point of interest: its linked stations and those with usage, and its sessions by day type: the mean over linked
    stations on each day, then over days."""
    daily = usage.groupBy("station_id", "use_date").agg(F.sum("sessions").alias("s"))
    days = links.join(daily, "station_id").groupBy("poi_id", "use_date").agg(F.avg("s").alias("s")).withColumn("t", day_type(F.col("use_date")))
    means = days.groupBy("poi_id").agg(*[F.avg(F.when(F.col("t") == k, F.col("s"))).alias(f"sessions_mean_{k}") for k in ("weekday", "weekend", "holiday")], F.count("*").alias("usage_days"))
    used = links.join(daily.select("station_id").distinct().withColumn("_u", F.lit(1)), "station_id", "left").groupBy("poi_id").agg(F.count("*").alias("linked_stations"), F.count("_u").alias("linked_with_usage"))
    out = used.join(means, "poi_id", "left").withColumn("usage_days", F.coalesce("usage_days", F.lit(0)))
    return out.withColumns({"holiday_vs_weekday": F.try_divide("sessions_mean_holiday", "sessions_mean_weekday"), "weekend_vs_weekday": F.try_divide("sessions_mean_weekend", "sessions_mean_weekday")})


def lot_hour_features(ticks: DataFrame, as_of: Column) -> DataFrame:
    """Population std, last minus first and tick count of free spaces over the hour before `as_of`."""
    recent = ticks.where((F.col("collected_at") >= as_of - F.expr("interval 1 hour")) & (F.col("collected_at") <= as_of))
    order = F.struct("collected_at", "id")
    return recent.groupBy("lot_id").agg(
        F.stddev_pop("remaining_spaces").alias("parking_remaining_std_1h"),
        (F.max_by("remaining_spaces", order) - F.min_by("remaining_spaces", order)).cast("double").alias("parking_remaining_delta_1h"),
        F.count("*").alias("parking_realtime_ticks_1h"),
    )


CONGESTION_LABELS = ("여유", "보통", "혼잡", "만차")  # fixed values


def parking_batches(ticks: DataFrame) -> DataFrame:
    """Occupancy and congestion mix per collection batch (here: per hour of collection)."""
    b = ticks.withColumn("batch", F.date_trunc("hour", "collected_at").cast("timestamp_ntz"))
    total = F.count("congestion_status")
    per = b.groupBy("batch").agg(
        F.avg("occupancy_rate").alias("occ_mean"), F.count_distinct("lot_id").alias("lots"),
        *[(ratio(F.count_if(F.col("congestion_status") == c), total) * 100).alias(f"pct_{i}") for i, c in enumerate(CONGESTION_LABELS)],
    )
    return per.join(quantiles(b, ["batch"], "occupancy_rate", {"occ_median": 0.5}), "batch", "left")


def parking_by(ticks: DataFrame, keys: list[str]) -> DataFrame:
    per = ticks.groupBy(*keys).agg(F.count("*").alias("observations"), F.avg("occupancy_rate").alias("occupancy_mean"), F.avg("remaining_spaces").alias("remaining_mean"))
    return per.join(quantiles(ticks, keys, "occupancy_rate", {"occupancy_median": 0.5}), keys, "left")


def site_name(col: Column) -> Column:
    return F.lower(F.regexp_replace(col, r"[ ()_]", ""))


def session_stations(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Sessions of stations whose cleaned name is known; one station per name, the least id."""
    names = stations.groupBy(site_name(F.col("station_name")).alias("_k")).agg(F.min("station_id").alias("station_id"))
    return sessions.withColumn("_k", site_name(F.regexp_replace("station_name", "충전소$", ""))).join(names, "_k").drop("_k")


def session_profile(sessions: DataFrame) -> DataFrame:
    """Sessions per station, weekday and hour, durations capped at 12 hours, and a 0-100 demand score."""
    dur = F.least(F.greatest(F.coalesce(F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")) / 60.0, F.lit(0.0)), F.lit(0.0)), F.lit(720.0))
    kwh = F.greatest(F.coalesce("kwh", F.lit(0.0)), F.lit(0.0))
    g = sessions.groupBy("station_id", F.weekday("start_ts").alias("dow"), F.hour("start_ts").alias("hour")).agg(
        F.count("*").alias("session_count"), F.sum(kwh).alias("total_kwh"), F.avg(kwh).alias("avg_kwh"), F.sum(dur).alias("total_duration_min"), F.avg(dur).alias("avg_duration_min")
    )
    lo, hi = g.agg(F.min("total_duration_min")).scalar(), g.agg(F.max("total_duration_min")).scalar()
    return g.withColumn("demand_score", F.coalesce(F.try_divide(F.col("total_duration_min") - lo, hi - lo), F.lit(0.0)) * 100)


def session_summary(s: DataFrame) -> DataFrame:
    """One row: totals, recorded against elapsed time, weekend share, busiest weekday-hour slot."""
    gap = F.abs(F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")) / 60.0 - F.col("minutes"))
    one = s.agg(
        F.count("*").alias("n_sessions"), F.count_distinct("station_key").alias("n_stations"), F.sum("kwh").alias("kwh_total"), F.avg("kwh").alias("kwh_mean"), F.avg("minutes").alias("min_mean"),
        F.count_if(gap > 5).alias("mismatch_gt5"), F.count_if(gap > 60).alias("mismatch_gt60"), F.avg(F.col("is_weekend").cast("double")).alias("weekend_share"),
    )
    heat = s.groupBy("dow", "hour").agg(F.count("*").alias("n")).agg(F.min(F.struct(-F.col("n"), "dow", "hour")).alias("p"))
    med = quantiles(s, [], "kwh", {"kwh_median": 0.5})
    return one.withColumns({"peak_dow": heat.select("p.dow").scalar(), "peak_hour": heat.select("p.hour").scalar(), "kwh_median": med.scalar()})


def session_counts(s: DataFrame, kw: Column) -> DataFrame:
    """Session counts by month, hour (all 24 present), district and capacity class."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("bucket")) for k, v in (("month", F.date_format("start_ts", "yyyy-MM")), ("hour", F.col("hour")), ("district", F.substring_index("station_key", "|", -1)), ("capacity", kw))])
    got = s.select(F.inline(kinds)).groupBy("kind", "bucket").agg(F.count("*").alias("n"))
    hours = s.sparkSession.range(24).select(F.lit("hour").alias("kind"), F.col("id").cast("string").alias("bucket"), F.lit(0).cast("long").alias("n"))
    return got.unionByName(hours).groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
