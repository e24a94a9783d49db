"""Order-dependent totals over large groups, without sending a group through one task.

Rows are cut into ordered chunks, totals run inside a chunk, and each chunk is shifted by the totals of those before it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.session import stage

def chunk_of(df: DataFrame, order: list[str]) -> DataFrame:
    """Written with `_chunk`, monotone in `order` (keys first): ranges that Spark cuts from a sample of the rows.

    The cuts only place rows, so results stay exact; long tails and hot values are cut like any other range, the latter
    along the further columns of `order`.
    """
    return stage(df.repartitionByRange(*order).withColumn("_chunk", F.spark_partition_id()))


def totals_before(df: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """For a frame with one row per key and value: adds `<s>_before`, the total of `s` over smaller values."""
    cut = chunk_of(df, [*keys, value])
    per = cut.groupBy(*keys, "_chunk").agg(*[F.sum(s).alias(s) for s in sums])
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk of a key
    base = per.select(*keys, "_chunk", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_{s}0") for s in sums])
    inner = Window.partitionBy(*keys, "_chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.withColumns({f"_{s}1": F.coalesce(F.sum(s).over(inner), F.lit(0)) for s in sums}).join(base, [*keys, "_chunk"])
    return out.withColumns({f"{s}_before": F.col(f"_{s}0") + F.col(f"_{s}1") for s in sums}).drop("_chunk", *[f"_{s}{i}" for s in sums for i in (0, 1)])


def numbered(df: DataFrame, keys: list[str], value: str, ties: list[str]) -> DataFrame:
    """Adds `row_no` (1-based, by value then ties) and `n_rows` per key."""
    cut = chunk_of(df, [*keys, value, *ties])
    per = cut.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_chunk")
    base = per.select(*keys, "_chunk", (F.sum("_n").over(w) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(*keys)).alias("n_rows"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(value, *ties)
    return cut.withColumn("_rn", F.row_number().over(inner)).join(base, [*keys, "_chunk"]).withColumn(
        "row_no", F.col("_before") + F.col("_rn")
    ).drop("_chunk", "_before", "_rn")


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key and distinct value: how many rows hold it, and the mean rank of those rows (average ties).

    Equal values are folded before the shuffle, so a value held by a third of all rows costs one row.
    """
    per = stage(df.groupBy(*keys, value).agg(F.count("*").alias("n")))
    return totals_before(per, keys, value, ["n"]).withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / 2.0)


def running_total(df: DataFrame, keys: list[str], order: str, value: Column, chunk: Column, name: str) -> DataFrame:
    """Inclusive running sum per key over `order`; `chunk` must not decrease with it."""
    cut = df.withColumns({"_chunk": chunk, "_v": value})
    per = cut.groupBy(*keys, "_chunk").agg(F.sum("_v").alias("_s"))
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(*keys, "_chunk", F.coalesce(F.sum("_s").over(w), F.lit(0.0)).alias("_before"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumn("_in", F.sum("_v").over(inner)).join(base, [*keys, "_chunk"])
    return out.withColumn(name, F.col("_before") + F.col("_in")).drop("_chunk", "_v", "_in", "_before")


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated quantiles per key, NULLs left out. Works on value counts, so no group is collected."""
    per = stage(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")))
    at = totals_before(per, keys, "_v", ["_n"])
    total = per.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    at = at.join(total, keys) if keys else at.withColumn("_total", total.select("_total").scalar())
    aggs = []
    for name, p in probs.items():
        h = F.lit(p) * (F.col("_total") - 1)
        aggs += [F.max(F.when(F.col("_n_before") <= F.floor(h), F.col("_v"))).alias(f"_lo_{name}"),
                 F.max(F.when(F.col("_n_before") <= F.ceil(h), F.col("_v"))).alias(f"_hi_{name}"), F.max(h - F.floor(h)).alias(f"_f_{name}")]
    out = at.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in probs])
