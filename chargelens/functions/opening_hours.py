"""Open / closed / unknown at a given time from free-text opening hours.

A text is brought to one spelling, cut into clauses in front of each mention of days, and every clause is read by the same
small grammar: which days it speaks of, whether it says "closed", and its time spans. The answer for a time is then a
matter of the clauses that speak of its day.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of the source texts, blanks left out.
WEEKDAY_WORDS = ("평일", "주중")
WEEKEND_WORDS = ("주말", "토요일", "일요일", "토,일", "토일", "토/일", "공휴일")
CLOSED_WORDS = ("비개방", "미개방", "개방불가")
DAY_OFF_WORDS = (*CLOSED_WORDS, "이용불가", "휴무", "제외")
ALL_DAY_WORDS = ("24시간", "종일", "(24시)")
NEXT_DAY_WORD = "익일"

DAY = 1440
#: signs that are written for a range, a clock's colon and a separator
SAME = {"–": "~", "—": "~", "～": "~", "-": "~", "：": ":", "／": "/", "，": ","}
_ANY_DAY = "(?:" + "|".join((*WEEKDAY_WORDS, *WEEKEND_WORDS)) + ")"
#: a mention of days: one day word or several, joined by signs or "and"
DAYS = f"{_ANY_DAY}(?:[및,/·()]*{_ANY_DAY})*"
#: hour, minute ~ hour, minute or the word for hour; the end must show that it is a time
SPAN = rf"(?<!\d)(\d{{1,2}})(?::(\d\d)(?::\d\d)?)?시?~(?:{NEXT_DAY_WORD})?(\d{{1,2}})(?:시|:(\d\d)(?::\d\d)?)"


def _says(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def _one_spelling(text: Column) -> Column:
    return F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", ""), "".join(SAME), "".join(SAME.values()))


def _spans(text: Column) -> Column:
    """Distinct (start, end) minutes of the day; times that no clock shows are left out."""
    part = [F.regexp_extract_all(text, F.lit(SPAN), F.lit(i)) for i in (1, 2, 3, 4)]
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")).cast("int"), F.lit(0))
    read = F.transform(F.arrays_zip(*[p.alias(n) for p, n in zip(part, ("h", "m", "hh", "mm"))]), lambda r: F.struct(
        (number(r["h"]) * 60 + number(r["m"])).alias("start"), (number(r["hh"]) * 60 + number(r["mm"])).alias("end"), F.greatest(number(r["m"]), number(r["mm"])).alias("minute")))
    shown = F.filter(read, lambda r: (r["start"] <= DAY) & (r["end"] <= DAY) & (r["minute"] < 60))
    return F.array_distinct(F.transform(shown, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))))


def _covers(span: Column, now: Column) -> Column:
    """The start belongs to the span, the end does not; an end before the start is on the next day."""
    length = F.pmod(span["end"] - span["start"], F.lit(DAY))
    whole = (span["start"] == 0) & (span["end"] >= DAY - 1)
    return whole | (F.pmod(now - span["start"], F.lit(DAY)) < length)


def operating_at(df: DataFrame, text: str, when: Column, out: str) -> DataFrame:
    """Adds Y, N or UNKNOWN. A missing or unreadable text is UNKNOWN, never open.

    closed without any time                         N
    an all-day word, or a span from 0 to 24         Y
    a clause on this day says closed                N
    clauses on this day have spans                  Y if one covers the time, else N
    other spans, days mentioned somewhere           Y if one covers the time, else N
    other spans, no day mentioned                   the only one decides; several are UNKNOWN
    """
    plain, now, weekend = F.col("_plain"), F.col("_now"), F.col("_weekend")
    df = df.withColumns({"_plain": _one_spelling(F.col(text)), "_now": F.hour(when) * 60 + F.minute(when), "_weekend": F.weekday(when) >= 5})
    clause = lambda c: F.struct(
        _says(c, WEEKDAY_WORDS).alias("weekday"), _says(c, WEEKEND_WORDS).alias("weekend"), _says(c, DAY_OFF_WORDS).alias("off"), _spans(c).alias("spans"))
    df = df.withColumn("_clauses", F.transform(F.split(F.regexp_replace(plain, f"({DAYS})", "\n$1"), "\n"), clause))
    today = lambda c: F.when(weekend, c["weekend"]).otherwise(c["weekday"])
    spans = lambda cs: F.array_distinct(F.flatten(F.transform(cs, lambda c: c["spans"])))
    df = df.withColumns({"_mine": F.filter("_clauses", today), "_every": spans(F.col("_clauses"))}).withColumn("_own", spans(F.col("_mine")))
    open_in = lambda s: F.when(F.exists(s, lambda x: _covers(x, now)), "Y").otherwise("N")
    timeless, named = F.size("_every") == 0, F.exists("_clauses", lambda c: c["weekday"] | c["weekend"])
    unnamed_shut = F.exists("_clauses", lambda c: ~c["weekday"] & ~c["weekend"]) & ~named & _says(plain, CLOSED_WORDS)
    rows = [
        (timeless & (unnamed_shut | F.contains(plain, F.lit("개방불가"))), F.lit("N")),
        (_says(plain, ALL_DAY_WORDS) | F.exists("_every", lambda s: (s["start"] == 0) & (s["end"] >= DAY - 1)), F.lit("Y")),
        (F.exists("_mine", lambda c: c["off"]), F.lit("N")),
        (F.size("_own") > 0, open_in(F.col("_own"))),
        (~timeless & (named | (F.size("_every") == 1)), open_in(F.col("_every"))),
    ]
    state = F.coalesce(*[F.when(met, answer) for met, answer in rows], F.lit("UNKNOWN"))
    return df.withColumn(out, state).drop("_plain", "_now", "_weekend", "_clauses", "_mine", "_every", "_own")


def with_operating_now(stations: DataFrame, when: Column, text: str = "use_time") -> DataFrame:
    """Opening state at one time: each distinct text is read once and joined back."""
    texts = operating_at(stations.select(text).where(F.col(text).isNotNull()).distinct(), text, when, "is_operating_now")
    return stations.join(texts, text, "left").withColumn("is_operating_now", F.coalesce("is_operating_now", F.lit("UNKNOWN")))
