"""Column expressions shared by the operators. Everything here stays inside code generation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
# fixed values: texts read as missing
NULL_TOKENS = ("", "null", "none", "nan", "-", "na", "n/a")


def epoch_s(col: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock time, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), col.cast("timestamp_ntz"))


def from_epoch(col: Column) -> Column:
    return F.timestamp_add("SECOND", col.cast("int"), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier.cast("timestamp_ntz"), later.cast("timestamp_ntz")) / F.lit(60e6)


def ratio(num: Column, den: Column) -> Column:
    """NULL, not 0, when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def grade_from_minutes(minutes: Column) -> Column:
    return F.when(minutes <= 5.0, "HIGH").when(minutes <= 15.0, "NORMAL").otherwise("CHECK_REQUIRED")


def grade_rank(grade: Column) -> Column:
    return F.when(grade == "HIGH", 3).when(grade == "NORMAL", 2).when(grade == "CHECK_REQUIRED", 1).otherwise(0)


def effective_grade(status_grade: Column, observation_grade: Column) -> Column:
    return F.when(grade_rank(status_grade) >= grade_rank(observation_grade), status_grade).otherwise(observation_grade)


def observation_state(observed: Column, grade: Column) -> Column:
    return (
        F.when(F.coalesce(observed, F.lit(0)) <= 0, "UNOBSERVED")
        .when(grade == "HIGH", "FRESH").when(grade == "NORMAL", "NORMAL").otherwise("STALE")
    )


def normal_text(col: Column) -> Column:
    """Whitespace folded, ends trimmed, null tokens to NULL."""
    t = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.when(~F.lower(t).isin(*NULL_TOKENS), t)


def flag_list(*pairs: tuple[Column, str], sep: str = "|", empty: str | None = "OK") -> Column:
    """Names of the conditions that hold, joined in the given order."""
    joined = F.concat_ws(sep, *[F.when(cond, name) for cond, name in pairs])
    return joined if empty is None else F.when(joined == "", empty).otherwise(joined)


def weekday0(col: Column) -> Column:
    """Monday = 0."""
    return F.weekday(col)


def check(code: str, value: Column, threshold: Column | float | int, status: Column) -> Column:
    """One quality-check row; see `stack_checks`."""
    th = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.struct(F.lit(code).alias("code"), status.alias("status"), value.cast("double").alias("value"), th.cast("double").alias("threshold"))


def stack_checks(one_row: DataFrame, *checks: Column) -> DataFrame:
    """One row of aggregates to check rows (code, status, value, threshold)."""
    return one_row.select(F.inline(F.array(*checks)))


def beside(one_row: DataFrame, *others: DataFrame) -> DataFrame:
    """Columns of further one-row frames as scalar subqueries; no join takes place. The rows are staged, so a costly
    aggregate runs once and not per column."""
    from chargelens.session import stage

    rows = [stage(o) for o in others]
    return one_row.withColumns({c: o.select(c).scalar() for o in rows for c in o.columns})
