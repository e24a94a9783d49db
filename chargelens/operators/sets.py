"""Set differences and overlaps as anti and semi joins on distinct keys."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_ids(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Ids only in the newer table (added) and only in the older one (removed)."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("change", F.lit("added")).unionByName(a.join(b, key, "left_anti").withColumn("change", F.lit("removed")))


def overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Sizes of both key sets and of their intersection, from one grouping of the marked keys."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    per = both.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per.agg(F.sum("l").alias("left_keys"), F.sum("r").alias("right_keys"), F.sum(F.col("l") * F.col("r")).alias("common_keys"))
