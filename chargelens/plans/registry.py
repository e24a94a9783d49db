"""Query registry: each entry pairs a Spark query with an ANSI-SQL oracle over the same tables."""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargelens.session import configure
from chargelens.sources.views import ORACLE_CTES, VIEW_SQL, Tables

ROUND_TO = 6
NUDGE = 3e-10  # moves exact ties off the rounding edge, where engines differ


@dataclass
class Entry:
    fn: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, num: str = "", ts: str = ""):
    """Register `fn(tables)`. `num` / `ts` name the oracle's floating and time columns (space separated)."""

    def wrap(fn):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(fn, None if sql is None else oracle(sql, num, ts))
        return fn

    return wrap


def present(df: DataFrame) -> DataFrame:
    """Engine-neutral output: times as text, floating values rounded, small integers widened."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(NUDGE), ROUND_TO) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def oracle(body: str, num: str, ts: str) -> str:
    reps = [f"round(cast({c} as double) + {NUDGE:.12f}, {ROUND_TO}) + 0.0 as {c}" for c in num.split()]
    reps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in ts.split()]
    star = f"* replace ({', '.join(reps)})" if reps else "*"
    named = {**{k: v.replace("{", "").replace("}", "") for k, v in VIEW_SQL.items()}, **ORACLE_CTES}
    need: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[vx]_\w+", text):
            if word in named and word not in need:
                visit(named[word])
                if word not in need:
                    need.append(word)

    visit(body)
    ctes = ",\n".join(f"{n} as ({named[n]})" for n in need)
    head = f"with {ctes}\n" if ctes else ""
    return f"{head}select {star} from (\n{body}\n) as result"


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return present(ENTRIES[name].fn(Tables(spark, sf_dir)))
