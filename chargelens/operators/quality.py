"""Quality checks. Each is an aggregate that ends in check rows (code, status, value, threshold)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargelens.functions.codes import OFFICIAL_NAMES
from chargelens.functions.exprs import beside, check, grade_from_minutes, ratio, stack_checks
from chargelens.operators.ranks import quantiles
from chargelens.operators.snapshots import CHARGER

# fixed values: monitor thresholds (warn, fail)
RAW_DUPLICATE_RATE, CONFLICT_GROUPS, CADENCE_P95, LATEST_AGE = (0.005, 0.02), (20, 100), (20.0, 30.0), (60.0, 180.0)


def passes(cond: Column, otherwise: str = "FAIL") -> Column:
    return F.when(cond, "PASS").otherwise(otherwise)


def level(value: Column, warn: float, fail: float) -> Column:
    return F.when(value.isNull() | (value >= fail), "FAIL").when(value >= warn, "WARN").otherwise("PASS")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def history_validation(events: DataFrame, status: Column) -> DataFrame:
    """Counts, duplicate keys and invalid status of the history, one row. Duplicates are counted from folded keys."""
    keys = events.withColumn("_st", status).groupBy(*CHARGER, "fetched_at", "_st").agg(F.count("*").alias("n"), F.count_if(F.col("stat_updated_at").isNull()).alias("nul"))
    return keys.agg(
        F.sum("n").alias("n_rows"), F.count_distinct("station_id").alias("stations"), F.count_distinct(*CHARGER).alias("chargers"), F.min("fetched_at").alias("observed_min"), F.max("fetched_at").alias("observed_max"),
        (F.sum("n") - F.count("*")).alias("duplicate_event_keys"), F.sum("nul").alias("null_updates"), F.sum(F.when(F.col("_st").isin(*OFFICIAL_NAMES), 0).otherwise(F.col("n"))).alias("invalid_status_rows"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count, rate and band per column in one pass; blank and NA texts are missing, business codes are not."""
    def gone(f):
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            return c.isNull() | F.lower(F.trim(c)).isin("", "nan", "null", "<na>", "nat", "natype")
        return c.isNull()
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(gone(f)).alias(f.name) for f in df.schema.fields])
    rows = one.select(F.col("_n").alias("n_rows"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in df.columns])))
    pct = F.col("missing") * 100.0 / F.col("n_rows")
    band = F.when(pct == 0, "complete").when(pct < 5, "low").when(pct < 50, "mid").when(pct < 90, "high").otherwise("almost_all")
    return rows.withColumn("missing_pct", pct).withColumn("band", band)


def missing_by_family(profile: DataFrame, families: dict[str, tuple[str, ...]]) -> DataFrame:
    """Missing share over all cells of a family of columns, its worst column, and its columns per band."""
    of = F.create_map(*[F.lit(x) for name, columns in families.items() for c in columns for x in (c, name)])
    worst = F.max_by("column_name", F.struct("missing_pct", F.col("column_name")))
    return profile.groupBy(F.coalesce(of[F.col("column_name")], F.lit("other")).alias("family")).agg(
        F.count("*").alias("n_columns"), F.try_divide(F.sum("missing") * 100.0, F.sum("n_rows")).alias("missing_pct"), worst.alias("worst_column"),
        *[F.count_if(F.col("band") == b).alias(f"{b}_columns") for b in ("complete", "low", "mid", "high", "almost_all")],
    )


def _metrics(one: DataFrame, metrics: dict[str, str]) -> DataFrame:
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).cast("double").alias("value")) for k, c in metrics.items()])))


def station_table_profile(stations: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Profile of the station table: missing or zero coordinates, blank texts, coordinates outside the box."""
    no = lambda c: F.col(c).isNull() | (F.col(c) == 0)
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    south, north, west, east = box
    outside = ~no("lat") & ~(F.col("lat").between(south, north) & F.col("lng").between(west, east))
    tests = {"missing_lat": no("lat"), "missing_lng": no("lng"), "missing_both": no("lat") & no("lng"), "outside_box": outside} | {f"blank_{c}": blank(c) for c in ("station_name", "addr", "busi_nm", "use_time")}
    one = stations.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()])
    return _metrics(one, {n: n for n in ("rows", *tests)})


def update_age_profile(chargers: DataFrame, stamp: str, now: Column) -> DataFrame:
    """Chargers by the age of their 14-digit update stamp: up to 5 minutes, up to 15, older, in the future; unreadable stamps apart."""
    given = F.coalesce(F.trim(stamp), F.lit("")) != ""
    at = F.when(F.length(stamp) == 14, F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", at, now)
    kind = F.when(~given, "blank").when(at.isNull(), "unreadable").when(age < 0, "future").when(age <= 300, "HIGH").when(age <= 900, "NORMAL").otherwise("CHECK_REQUIRED")
    return chargers.groupBy(kind.alias("reliability")).agg(F.count("*").alias("chargers"))


def charger_table_profile(chargers: DataFrame) -> DataFrame:
    """Profile of the charger table as check rows."""
    one = chargers.agg(
        F.count("*").alias("n"), F.count_distinct("station_id").alias("st"), F.count_if(F.col("lat").isNull()).alias("nolat"), F.count_if(F.col("output").try_cast("double").isNull()).alias("noout"),
        F.count_if(F.col("use_time").isNull()).alias("notime"), F.avg("lat").alias("lat"),
    )
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).cast("double").alias("value")) for k, c in (("rows", "n"), ("stations", "st"), ("missing_coordinates", "nolat"), ("missing_output", "noout"), ("missing_hours", "notime"), ("mean_lat", "lat"))])))


def snapshot_group_counts(events: DataFrame) -> DataFrame:
    """Per poll: rows, extra copies, duplicate groups and groups whose copies disagree on the state."""
    g = events.groupBy("tick_ts", *CHARGER).agg(F.count("*").alias("n"), (F.min("stat") != F.max("stat")).alias("conflict"))
    return g.groupBy("tick_ts").agg(F.sum("n").alias("raw_rows"), F.sum(F.col("n") - 1).alias("extra_rows"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.count_if("conflict").alias("conflict_groups"))


def input_report(events: DataFrame, per_tick: DataFrame, ticks: DataFrame, as_of: Column) -> DataFrame:
    """Checks on the polled input: grain, codes, times, no time travel over 5 minutes, cadence, age of the newest poll."""
    rows = events.agg(
        F.count_if(~F.coalesce(F.col("stat").isin(1, 2, 3, 4, 5, 9), F.lit(False))).alias("bad_code"), F.count_if(F.col("stat_updated_at").isNull()).alias("bad_time"),
        F.count_if(F.col("stat_updated_at") > F.col("fetched_at") + F.expr("interval 5 minutes")).alias("travel"),
    )
    tot = per_tick.agg(F.sum("raw_rows").alias("raw"), F.sum("extra_rows").alias("extra"), F.sum("conflict_groups").alias("conflict"), F.count("*").alias("ticks"))
    p95 = quantiles(ticks, [], "prev_gap_s", {"p": 0.95}).scalar() / 60.0
    age = F.timestamp_diff("SECOND", ticks.agg(F.max("tick_ts")).scalar(), as_of) / 60.0
    one = beside(rows, tot).withColumns({"p95": p95, "age": age})
    dup = F.col("extra") / F.col("raw")
    z = F.lit(0.0)
    return stack_checks(
        one,
        check("READABLE", F.col("ticks"), 1, passes(F.col("ticks") >= 1)), check("RAW_GRAIN_UNIQUENESS", dup, 0, passes(F.col("extra") == 0, "WARN")), check("CONFLICTING_STATUS_GROUPS", F.col("conflict"), CONFLICT_GROUPS[0], level(F.col("conflict"), *CONFLICT_GROUPS)),
        check("CODE_VALIDITY", F.col("bad_code"), z, passes(F.col("bad_code") == 0)), check("TIME_PARSE", F.col("bad_time"), z, passes(F.col("bad_time") == 0)), check("NO_TIME_TRAVEL", F.col("travel"), z, passes(F.col("travel") == 0)),
        check("CADENCE_P95_MINUTES", F.col("p95"), CADENCE_P95[0], level(F.col("p95"), *CADENCE_P95)), check("LATEST_SNAPSHOT_AGE_MINUTES", F.col("age"), LATEST_AGE[0], level(F.col("age"), *LATEST_AGE)),
        check("RAW_DUPLICATE_RATE", dup, RAW_DUPLICATE_RATE[0], level(dup, *RAW_DUPLICATE_RATE)),
    )


MONITORED = ("RAW_DUPLICATE_RATE", "CONFLICTING_STATUS_GROUPS", "CADENCE_P95_MINUTES", "LATEST_SNAPSHOT_AGE_MINUTES")


def monitor_verdict(checks: DataFrame) -> DataFrame:
    """Overall level of the monitored checks."""
    m = checks.where(F.col("code").isin(*MONITORED))
    one = m.agg(F.count_if(F.col("status") == "FAIL").alias("fails"), F.count_if(F.col("status") == "WARN").alias("warns"))
    return one.withColumn("monitor_status", F.when(F.col("fails") > 0, "FAIL").when(F.col("warns") > 0, "WARN").otherwise("PASS"))


def index_cross_check(ticks: DataFrame, log: DataFrame) -> DataFrame:
    """Polls in the log without rows, and rows without a poll in the log."""
    a, b = ticks.select("tick_ts", F.lit(1).alias("f")), log.select("tick_ts", F.lit(1).alias("l"))
    j = a.join(b, "tick_ts", "full_outer")
    return j.agg(F.count("*").alias("ticks"), F.count_if(F.col("l").isNull()).alias("not_in_log"), F.count_if(F.col("f").isNull()).alias("without_rows"))


def reliability_battery(aged: DataFrame, ticks: DataFrame, series: DataFrame, log: DataFrame) -> DataFrame:
    """R1-R6: poll success, long gaps, age median, share of fresh rows, parse failures, usable series."""
    ok_age = aged.where(F.col("age_minutes").between(-1, 1440))
    one = aged.agg(
        F.count("*").alias("n"), F.count_if(F.col("age_minutes") < -1).alias("neg"), F.count_if(F.col("stat_updated_at").isNull()).alias("miss"),
        F.avg((grade_from_minutes(F.col("age_minutes")) == "HIGH").cast("double")).alias("high"),
    )
    one = one.withColumns({
        "fails": log.agg(F.count_if(~F.col("ok"))).scalar(), "gaps": ticks.agg(F.count_if(F.col("prev_gap_s") > 1500)).scalar(), "med": quantiles(ok_age, [], "age_minutes", {"m": 0.5}).scalar(),
        "series": series.agg(F.count("availability_pct")).scalar(),
    })
    bad = F.greatest(F.col("neg"), F.col("miss")) / F.greatest(F.col("n"), F.lit(1))
    return stack_checks(
        one, check("R1_call_log", F.col("fails"), 0, passes(F.col("fails") == 0)), check("R2_gap25", F.col("gaps"), 10, passes(F.col("gaps") <= 10)), check("R3_age_median", F.col("med"), 10, passes(F.col("med") <= 10)),
        check("R4_high_share", F.col("high"), 0.5, passes(F.col("high") >= 0.5)), check("R5_parse", bad, 0.01, passes(bad < 0.01)), check("R6_panel_avail", F.col("series"), 100, passes(F.col("series") > 100)),
    )


def master_status_audit(master: DataFrame, events: DataFrame) -> DataFrame:
    """Master key uniqueness, coordinates, and overlap of the newest poll's keys with the master."""
    keys = master.groupBy(*CHARGER).agg(F.count("*").alias("n"), F.count_if((F.col("lat").between(35.55, 36.45)) & F.col("lng").between(128.25, 129.05)).alias("ok"))
    one = keys.agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("dup"), (F.sum("ok") / F.sum("n")).alias("coord"))
    newest = events.where(F.col("tick_ts") == events.agg(F.max("tick_ts")).scalar()).select(*CHARGER).distinct()
    hit = newest.join(master.select(*CHARGER).distinct(), list(CHARGER), "left_semi").agg(F.count("*")).scalar()
    one = one.withColumn("ov", hit / newest.agg(F.count("*")).scalar())
    return stack_checks(one, check("MASTER_UNIQUE_KEY", F.col("dup"), 0, passes(F.col("dup") == 0)), check("MASTER_COORDINATES", F.col("coord"), 0.99, passes(F.col("coord") >= 0.99, "WARN")), check("MASTER_STATUS_KEY_OVERLAP", F.col("ov"), 0.98, passes(F.col("ov") >= 0.98, "WARN")))


def parking_audit(lots: DataFrame, realtime: DataFrame, nearest: DataFrame, radius_m: float = 1000.0) -> DataFrame:
    """Lot key overlap, occupancy formula, join radius, no value on unmatched stations."""
    exp = 1 - ratio(F.col("remaining_spaces"), F.col("total_spaces"))
    one = realtime.agg(F.count_if(F.abs(F.col("occupancy_rate") - exp) > 0.05).alias("formula"), F.count_distinct("lot_id").alias("lots"))
    known = realtime.select("lot_id").distinct().join(lots.select("lot_id"), "lot_id", "left_semi").agg(F.count("*")).scalar()
    near = nearest.agg(F.count_if(F.col("distance_m") > radius_m).alias("far"), F.count_if(~F.col("matched") & F.col("distance_m").isNotNull()).alias("mock"))
    one = one.withColumns({"known": known, "far": near.select("far").scalar(), "mock": near.select("mock").scalar()})
    share = F.col("known") / F.col("lots")
    return stack_checks(one, check("PARKING_KEY_OVERLAP", share, 0.98, passes(share >= 0.98, "WARN")), check("PARKING_OCCUPANCY_FORMULA", F.col("formula"), 0, passes(F.col("formula") == 0, "WARN")), check("PARKING_RADIUS", F.col("far"), 0, passes(F.col("far") == 0)), check("PARKING_NULL_POLICY", F.col("mock"), 0, passes(F.col("mock") == 0)))


def traffic_audit(link_ticks: DataFrame, grade: Column) -> DataFrame:
    """Better grades must be faster on average: mean speed of grade 1 >= 2 >= 3."""
    g = link_ticks.withColumn("_g", grade)
    one = g.agg(*[F.avg(F.when(F.col("_g") == k, F.col("speed_kph"))).alias(f"v{k}") for k in (1, 2, 3)], F.count_if(F.col("speed_kph") < 0).alias("neg"))
    order = F.coalesce((F.col("v1") >= F.col("v2")) & (F.col("v2") >= F.col("v3")), F.lit(False))
    return stack_checks(one, check("SPEED_GRADE_ORDER", F.col("v1") - F.col("v3"), 0, passes(order, "WARN")), check("SPEED_NEGATIVE", F.col("neg"), 0, passes(F.col("neg") == 0)))


def snapshot_audit(d1: DataFrame) -> DataFrame:
    """Count bounds and NULL policy of the station table."""
    one = d1.agg(
        F.count_if((F.col("available_count") > F.col("observed_count")) | (F.col("observed_count") > F.col("total_chargers"))).alias("bound"), F.count_if((F.col("observed_count") == 0) & F.col("availability_ratio_observed").isNotNull()).alias("zero"),
        (F.count("*") - F.count_distinct("station_id")).alias("dup"),
    )
    return stack_checks(one, *[check(c, F.col(n), 0, passes(F.col(n) == 0)) for c, n in (("COUNT_BOUNDS", "bound"), ("UNOBSERVED_IS_NULL", "zero"), ("STATION_UNIQUE", "dup"))])


def drift(panel: DataFrame) -> DataFrame:
    """Mean availability of the newer half of the days against the older half."""
    mid = panel.agg((F.min("tick_s") + F.max("tick_s")) / 2).scalar()
    r = F.col("availability_ratio_observed")
    one = panel.agg(F.avg(F.when(F.col("tick_s") > mid, r)).alias("b"), F.avg(F.when(F.col("tick_s") <= mid, r)).alias("a"))
    d = F.abs(F.col("b") - F.col("a"))
    return stack_checks(one, check("AVAILABILITY_DRIFT", d, 0.1, passes(d <= 0.1, "WARN")))


def field_checks(info: DataFrame, types: dict[str, str]) -> DataFrame:
    """Blank keys, unknown types, power against type, texts without hours."""
    kw = F.col("output").try_cast("double")
    slow = F.col("chger_type").isin("02", "08")
    one = info.agg(
        F.count_if(F.coalesce(F.trim("station_id"), F.lit("")) == "").alias("blank"), F.count_if(~F.col("chger_type").isin(*types)).alias("type"), F.count_if(slow & (kw > 50)).alias("slow"), F.count_if(~slow & (kw < 20)).alias("fast"),
        F.count_if(F.col("use_time").isNull()).alias("hours"),
    )
    return stack_checks(one, check("BLANK_KEYS", F.col("blank"), 0, passes(F.col("blank") == 0)), *[check(c, F.col(n), 0, passes(F.col(n) == 0, "WARN")) for c, n in (("UNKNOWN_TYPES", "type"), ("SLOW_TYPE_HIGH_POWER", "slow"), ("FAST_TYPE_LOW_POWER", "fast"), ("HOURS_MISSING", "hours"))])


def training_quality(rows: DataFrame) -> DataFrame:
    """Key uniqueness, label validity, no time travel, split order, imbalance, time and usage coverage, class support."""
    key = rows.groupBy("station_id", "feature_as_of", "horizon_minutes").agg(F.count("*").alias("n"))
    y = F.col("target_available")
    one = rows.agg(
        F.count_if(~F.coalesce(y.isin(0, 1), F.lit(False))).alias("bad"), F.count_if(F.col("feature_as_of") >= F.col("label_observed_at")).alias("travel"), F.avg(y).alias("pos"), F.count_distinct("feature_date").alias("days"),
        F.avg(F.col("history_observed").cast("double")).alias("hist"), F.min(F.when(y == 0, F.col("target_observation_coverage"))).alias("cov"),
        *[f(F.when(F.col("split") == s, F.col("feature_date"))).alias(f"{n}_{s}") for s in ("train", "valid", "test") for n, f in (("lo", F.min), ("hi", F.max))],
    )
    one = one.withColumn("dup", key.agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))).scalar())
    order = (F.col("hi_train") < F.col("lo_valid")) & (F.col("hi_valid") < F.col("lo_test"))
    fixed = stack_checks(
        one, check("PRIMARY_KEY_UNIQUENESS", F.col("dup"), 0, passes(F.col("dup") == 0)), check("TARGET_VALIDITY", F.col("bad"), 0, passes(F.col("bad") == 0)), check("NO_TIME_TRAVEL", F.col("travel"), 0, passes(F.col("travel") == 0)),
        check("TEMPORAL_SPLIT", order.cast("int"), 1, passes(order)), check("CONSERVATIVE_NEGATIVE_LABEL", F.col("cov"), 1, passes(F.coalesce(F.col("cov") >= 1, F.lit(True)))), check("CLASS_IMBALANCE", F.col("pos"), 0.9, passes(F.col("pos") <= 0.9, "WARN")),
        check("TIME_COVERAGE", F.col("days"), 14, passes(F.col("days") >= 14, "WARN")), check("USAGE_HISTORY_COVERAGE", F.col("hist"), 0.2, passes(F.col("hist") >= 0.2, "WARN")),
    )
    sup = rows.groupBy("split", "horizon_minutes").agg(F.count_if(y == 0).alias("neg"))
    support = sup.select(
        F.concat(F.lit("CLASS_SUPPORT_"), F.upper("split"), F.lit("_"), F.col("horizon_minutes").cast("string"), F.lit("M")).alias("code"), passes(F.col("neg") >= 100, "WARN").alias("status"), F.col("neg").cast("double").alias("value"), F.lit(100.0).alias("threshold"))
    return fixed.unionByName(support)


def training_profile(rows: DataFrame) -> DataFrame:
    """Rows, positives and rate by split and horizon, with totals, from one grouping-sets pass."""
    return rows.rollup("split", "horizon_minutes").agg(F.count("*").alias("n_rows"), F.sum("target_available").alias("positives"), F.avg("target_available").alias("positive_rate"), F.count_distinct("station_id").alias("stations"))


def daily_trend(per_tick: DataFrame, ticks: DataFrame) -> DataFrame:
    """Duplicates, conflicts and cadence per date."""
    d = per_tick.join(ticks.select("tick_ts", (F.col("prev_gap_s") / 60.0).alias("gap")), "tick_ts").withColumn("date", F.to_date("tick_ts"))
    per = d.groupBy("date").agg(F.count("*").alias("snapshot_count"), F.sum("raw_rows").alias("raw_rows"), F.sum("extra_rows").alias("duplicate_extra_rows"), (F.sum("extra_rows") / F.sum("raw_rows")).alias("duplicate_rate"), F.sum("conflict_groups").alias("conflicting_status_groups"))
    return per.join(quantiles(d, ["date"], "gap", {"cadence_median": 0.5, "cadence_p95": 0.95}), "date", "left")


def source_freshness(sources: list[tuple[str, DataFrame, str, float]], now: Column) -> DataFrame:
    """Age of the newest row of each source against its limit in minutes."""
    out = []
    for name, df, time, limit in sources:
        one = df.agg(F.max(time).alias("latest"))
        age = F.timestamp_diff("SECOND", F.col("latest").cast("timestamp_ntz"), now) / 60.0
        out.append(one.select(F.lit(name).alias("source"), F.col("latest").cast("timestamp_ntz").alias("latest"), age.alias("age_minutes"), F.when(age <= limit, "OK").otherwise("STALE").alias("state")))
    return union_all(out)


def kpi_table(ticks: DataFrame, log: DataFrame, d1: DataFrame, incidents: DataFrame, panel: DataFrame) -> DataFrame:
    """Twelve indicators: collection continuity and cost, incident feed, station table, panel."""
    day = lambda df, c: df.where(F.to_date(c) == df.agg(F.max(F.to_date(c))).scalar())
    one = day(ticks, "tick_ts").agg(F.count("*").alias("ticks"), F.count_if(F.col("prev_gap_s") > 720).alias("gaps"))
    f = d1.agg(
        F.count("*").alias("n"), F.avg("availability_ratio_observed").alias("avail"), (F.avg(F.coalesce("has_confirmed_available", F.lit(False)).cast("double")) * 100).alias("conf"), (F.avg("unobserved_rate") * 100).alias("unobs"),
        (F.avg(F.col("reliability_grade_effective").isin("HIGH", "NORMAL").cast("double")) * 100).alias("fresh"), (F.avg(F.col("recommend_public_default").cast("double")) * 100).alias("public"),
        (F.avg(F.col("nearest_parking_m").isNotNull().cast("double")) * 100).alias("park"), F.count("nearest_incident_m").alias("inc"), (F.avg(F.col("history_observed").cast("double")) * 100).alias("hist"),
    )
    one = one.withColumns({
        "calls": day(log, "tick_ts").agg(F.sum("api_calls")).scalar(), "itoday": day(incidents, "tick_ts").agg(F.count_distinct("tick_ts")).scalar(), "prows": panel.agg(F.count("*")).scalar(),
    })
    one = beside(one, f)
    ok = lambda c, bad="WARN": F.when(c, "OK").otherwise(bad)
    return stack_checks(
        one, check("K1", F.col("gaps"), 1, ok(F.col("gaps") <= 1)), check("K2", F.col("calls"), 800, F.when(F.col("calls") >= 900, "FAIL").when(F.col("calls") <= 800, "OK").otherwise("WARN")), check("K3", F.col("itoday"), 1, ok(F.col("itoday") >= 1, "FAIL")),
        check("K4", F.col("inc"), 1, ok(F.col("inc") > 0, "FAIL")), check("K5", F.col("avail"), 0, ok(F.col("n") > 0, "FAIL")), check("K6", F.col("conf"), 50, ok(F.col("conf") >= 50)), check("K7", F.col("unobs"), 50, ok(F.col("unobs") <= 50)), check("K8", F.col("fresh"), 50, ok(F.col("fresh") >= 50)),
        check("K9", F.col("public"), 30, ok(F.col("public") >= 30)), check("K10", F.col("park"), 50, ok(F.col("park") >= 50)), check("K11", F.col("hist"), 10, ok(F.col("hist") >= 10)), check("K12", F.col("prows"), 1, ok(F.col("prows") > 0, "FAIL")),
    )


def verdict(checks: DataFrame, soft: tuple[str, ...]) -> DataFrame:
    """GO / CONDITIONAL / NO per axis: any failed hard check is NO, any failed soft one CONDITIONAL."""
    bad, is_soft = F.col("status") != "PASS", F.col("code").isin(*soft)
    one = checks.groupBy("axis").agg(F.count_if(~bad).alias("passed"), F.count("*").alias("total"), F.count_if(bad & ~is_soft).alias("hard_failed"), F.count_if(bad & is_soft).alias("soft_failed"))
    return one.withColumn("verdict", F.when(F.col("hard_failed") > 0, "NO").when(F.col("soft_failed") > 0, "CONDITIONAL").otherwise("GO"))


def status_viability(events: DataFrame, ticks: DataFrame, master: DataFrame) -> DataFrame:
    """Check rows of the status feed on two axes: rule-based use and time series."""
    t = ticks.agg(F.count("*").alias("snaps"), F.count_distinct(F.to_date("tick_ts")).alias("days"), F.sum(F.when(F.col("prev_gap_s") > 1800, F.col("prev_gap_s"))).alias("off"), (F.max("tick_s") - F.min("tick_s")).alias("span"))
    day = ticks.where(F.hour("tick_ts").between(7, 22) & (F.col("prev_gap_s") <= 1800))
    seen = events.groupBy(*CHARGER).agg(F.count("*").alias("n")).agg(F.count("*").alias("cum"), F.count_if(F.col("n") >= 5).alias("o5"), F.count_if(F.col("n") >= 10).alias("o10"))
    one = beside(t, seen).withColumns({"gap": quantiles(day, [], "prev_gap_s", {"m": 0.5}).scalar() / 60.0, "ratio": F.col("cum") / master.select(*CHARGER).distinct().agg(F.count("*")).scalar()})
    night = F.coalesce(F.col("off"), F.lit(0)) / F.col("span")
    a = stack_checks(one, check("mvp_days", F.col("days"), 3, passes(F.col("days") >= 3)), check("mvp_snaps", F.col("snaps"), 100, passes(F.col("snaps") >= 100)), check("mvp_ratio", F.col("ratio"), 0.3, passes(F.col("ratio") >= 0.3)), check("mvp_gap_hard", F.col("gap"), 20, passes(F.col("gap") <= 20)), check("mvp_gap_soft", F.col("gap"), 7, passes(F.col("gap") <= 7)))
    b = stack_checks(one, check("eda_days", F.col("days"), 7, passes(F.col("days") >= 7)), check("eda_obs5", F.col("o5"), 50, passes(F.col("o5") >= 50)), check("eda_obs10", F.col("o10"), 20, passes(F.col("o10") >= 20)), check("eda_night", night, 0.6, passes(night <= 0.6)))
    return a.withColumn("axis", F.lit("A_rule_based")).unionByName(b.withColumn("axis", F.lit("B_time_series")))


def incident_viability(incidents: DataFrame, joined: DataFrame) -> DataFrame:
    one = incidents.agg(F.count_distinct("incident_id").alias("n"), F.count_distinct("tick_ts").alias("ticks"), F.avg(F.col("lat").isNotNull().cast("double")).alias("coord"))
    one = one.withColumn("rate", joined.agg(F.avg(F.col("matched").cast("double"))).scalar())
    return stack_checks(one, check("inc_ticks", F.col("ticks"), 24, passes(F.col("ticks") >= 24)), check("inc_events", F.col("n"), 30, passes(F.col("n") >= 30)), check("inc_coords", F.col("coord"), 0.9, passes(F.col("coord") >= 0.9)), check("inc_join", F.col("rate"), 0.1, passes(F.col("rate") >= 0.1))).withColumn("axis", F.lit("incident_feed"))


def feasibility_grade(label_stats: DataFrame, ticks: DataFrame, primary: int = 15) -> DataFrame:
    """A / B / C grade from label volume, days, coverage and polling pace."""
    s = label_stats.where(F.col("horizon_min") == primary).withColumn("pace", ticks.agg(F.avg(F.when(F.col("prev_gap_s").isNotNull(), (F.col("prev_gap_s") <= 330).cast("double")))).scalar())
    cov = F.col("labeled_rows") / F.col("candidate_rows")
    go = (F.col("labeled_rows") >= 5000) & (F.col("dates_with_label") >= 14) & (F.col("pace") >= 0.5) & (cov >= 0.25)
    return s.select("labeled_rows", F.col("dates_with_label").alias("label_days"), cov.alias("coverage"), F.col("pace").alias("five_minute_share"), F.when(F.col("labeled_rows") == 0, "C_NO_GO").when(go, "A_GO").otherwise("B_CONDITIONAL_GO").alias("grade"))


def integration_readiness(d1: DataFrame) -> DataFrame:
    rows = (("stations", F.lit(True)), ("with_coordinates", F.col("lat").isNotNull()), ("public", F.col("recommend_public_default")), ("observed", F.col("observed_count") > 0), ("parking_matched", F.col("nearest_parking_m").isNotNull()),
            ("incident_matched", F.col("nearest_incident_m").isNotNull()), ("poi_matched", F.col("poi_count_1km") > 0), ("usage_matched", F.col("history_observed")))
    one = d1.agg(*[F.count_if(c).alias(n) for n, c in rows])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("stations")) for n, _ in rows])))


def usage_join_qa(nearest: DataFrame) -> DataFrame:
    one = nearest.agg(F.count("*").alias("stations"), F.count_if("matched").alias("matched"), F.max("distance_m").alias("distance_max"))
    q = quantiles(nearest, [], "distance_m", {"p50": 0.5, "p90": 0.9})
    return one.withColumns({"unmatched": F.col("stations") - F.col("matched"), "distance_p50": q.select("p50").scalar(), "distance_p90": q.select("p90").scalar()})


def decision_deltas(base: DataFrame, current: DataFrame) -> DataFrame:
    """Feature decisions of two runs side by side."""
    b = base.select("feature", F.col("decision").alias("decision_baseline"), F.col("directional_auc").alias("auc_baseline"))
    c = current.select("feature", F.col("decision").alias("decision_current"), F.col("directional_auc").alias("auc_current"))
    return b.join(c, "feature", "full_outer").withColumns({"decision_changed": ~F.col("decision_baseline").eqNullSafe(F.col("decision_current")), "auc_delta": F.col("auc_current") - F.col("auc_baseline")})
