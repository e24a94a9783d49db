"""Station-level availability and reliability from chargers joined with their as-of status."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.functions.codes import code_map
from chargelens.functions.exprs import effective_grade, epoch_s, grade_from_minutes, observation_state, ratio

# fixed values: names of the same state in other tables
STATUS_ALIAS = {"IN_USE": "CHARGING", "MAINTENANCE": "UNDER_INSPECTION"}


def standard_status(col: Column) -> Column:
    up = F.upper(col)
    return F.coalesce(code_map(up, STATUS_ALIAS), up)


def unobserved(df: DataFrame, status: Column) -> Column:
    """Explicit missing flag, unknown or absent status, or the not-observed note."""
    out = status.isNull() | F.upper(status).isin("UNKNOWN", "STATUS_UNKNOWN")
    if "status_missing" in df.columns:
        out = out | F.coalesce(F.lower(F.col("status_missing").cast("string")).isin("true", "1", "yes"), F.lit(False))
    if "availability_note" in df.columns:
        out = out | F.coalesce(F.col("availability_note") == "NO_STATUS_OBSERVED", F.lit(False))
    return out


def charger_totals(chargers: DataFrame) -> DataFrame:
    return chargers.groupBy("station_id").agg(F.count("*").alias("total_chargers"), F.count_if(F.col("stat") == "AVAILABLE").alias("available_chargers"))


def _marked(chargers: DataFrame) -> DataFrame:
    status = standard_status(F.col("stat_mapped"))
    return chargers.withColumns({"_st": status, "_un": unobserved(chargers, status)})


def _availability_aggs() -> list[Column]:
    return [
        F.count("*").alias("total_chargers"),
        F.count_if(~F.col("_un") & (F.col("_st") == "AVAILABLE")).alias("available_count"),
        F.count_if(~F.col("_un")).alias("observed_count"),
        F.count_if("_un").alias("unobserved_count"),
    ]


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "availability_ratio_observed": ratio(F.col("available_count"), F.col("observed_count")),
        "unobserved_rate": ratio(F.col("unobserved_count"), F.col("total_chargers")),
        "has_confirmed_available": F.col("available_count") >= 1,
    })


def availability_features(chargers: DataFrame) -> DataFrame:
    """Counts and ratios; the ratio has observed chargers as denominator and is NULL when there is none."""
    return _with_ratios(_marked(chargers).groupBy("station_id").agg(*_availability_aggs()))


def station_grade(chargers: DataFrame, base: Column) -> DataFrame:
    """Grade from the newest update text of the station's chargers; unreadable texts count as infinitely old."""
    upd = F.when(F.length("stat_updated_at") == 14, F.try_to_timestamp("stat_updated_at", F.lit("yyyyMMddHHmmss")))
    minutes = (epoch_s(base) - epoch_s(upd)) / 60.0
    return chargers.groupBy("station_id").agg(grade_from_minutes(F.min(minutes)).alias("reliability_grade"))


def _age(name: str) -> Column:
    return F.min(F.when(~F.col("_un"), F.col(name) / 60.0))


def status_age_grade(chargers: DataFrame) -> DataFrame:
    out = _marked(chargers).groupBy("station_id").agg(_age("status_age_seconds").alias("status_age_minutes"))
    return out.withColumn("reliability_grade", grade_from_minutes(F.col("status_age_minutes")))


def observation_freshness(chargers: DataFrame) -> DataFrame:
    out = _marked(chargers).groupBy("station_id").agg(
        _age("status_age_seconds").alias("_s"), _age("observation_age_seconds").alias("observation_age_minutes")
    )
    out = out.withColumn("observation_grade", grade_from_minutes(F.col("observation_age_minutes")))
    return out.withColumn("reliability_grade_effective", effective_grade(grade_from_minutes(F.col("_s")), F.col("observation_grade"))).drop("_s")


def reliability_combined(chargers: DataFrame) -> DataFrame:
    out = _marked(chargers).groupBy("station_id").agg(
        _age("status_age_seconds").alias("status_age_minutes"), _age("observation_age_seconds").alias("observation_age_minutes")
    )
    return _grades(out)


def _grades(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "reliability_grade": grade_from_minutes(F.col("status_age_minutes")),
        "observation_grade": grade_from_minutes(F.col("observation_age_minutes")),
    })
    return df.withColumn("reliability_grade_effective", effective_grade(F.col("reliability_grade"), F.col("observation_grade")))


def station_status(chargers: DataFrame) -> DataFrame:
    """Availability, both ages, all grades and the observation state in one aggregation."""
    out = _marked(chargers).groupBy("station_id").agg(
        *_availability_aggs(), _age("status_age_seconds").alias("status_age_minutes"), _age("observation_age_seconds").alias("observation_age_minutes")
    )
    out = _grades(_with_ratios(out))
    return out.withColumn("observation_state", observation_state(F.col("observed_count"), F.col("reliability_grade_effective")))
