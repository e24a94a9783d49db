"""Paired bootstrap of rank metrics over groups of rows, all replicates in one pass over the sorted scores."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargelens.operators.ranks import chunk_of

REPLICATES = 300
#: Poisson(1): probability of at most 0, 1, 2 .. draws
_UPTO = np.cumsum([1 / np.e / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


def unit_weights(units: np.ndarray, replicates: int) -> np.ndarray:
    """(units, replicates + 1): 1, then a Poisson(1) count per replicate, the usual stand-in for drawing units with
    replacement. A count is a hash of unit and replicate, so it depends on nothing else."""
    with np.errstate(over="ignore"):
        z = units.astype(np.uint64)[:, None] + np.arange(1, replicates + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        z = z ^ z >> np.uint64(31)
    drawn = np.searchsorted(_UPTO, (z >> np.uint64(11)) * 2.0**-53, "right")
    return np.hstack([np.ones((len(units), 1)), drawn])


def _weighted(table: pa.Table, replicates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores in rising order with their weighted positives and negatives per replicate."""
    table = table.sort_by("x")
    sizes = pc.list_value_length(table["u"]).to_numpy()
    of = np.repeat(np.arange(len(sizes)), sizes)
    u, pos, neg = (table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("u", "pos", "neg"))
    units, at = np.unique(u, return_inverse=True)
    w = unit_weights(units, replicates)
    sums = [np.zeros((len(sizes), replicates + 1)) for _ in range(2)]
    for out, n in zip(sums, (pos, neg)):
        for lo in range(0, len(of), 4096):  # rows are many, replicates wide
            some = slice(lo, lo + 4096)
            np.add.at(out, of[some], w[at[some]] * n[some, None])
    return table["x"].to_numpy(), *sums


def replicate_metrics(scored: DataFrame, model: str, unit: str, y: str, p: str, replicates: int = REPLICATES) -> DataFrame:
    """(model, replicate, auc, pr_auc, brier); replicate 0 has every unit once. NULL where a replicate has one class.

    One row per model and score carries its counts per unit. Ranges of scores are worked on side by side: a first pass
    gives each range's total weights, a second one its share of the rank sum and of the average precision, given the
    totals of the ranges above it.
    """
    rows = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    per = rows.groupBy(F.col(model).alias("model"), F.col(p).cast("double").alias("x"), F.xxhash64(unit).alias("u")).agg(F.sum(F.col(y).cast("long")).alias("pos"), F.sum(1 - F.col(y).cast("long")).alias("neg"))
    by_score = per.groupBy("model", "x").agg(F.collect_list("u").alias("u"), F.collect_list("pos").alias("pos"), F.collect_list("neg").alias("neg"))
    cut = chunk_of(by_score, ["model", "x"])

    def totals(table: pa.Table) -> pa.Table:
        _, p_sum, n_sum = _weighted(table, replicates)
        return _lists(table, [p_sum.sum(0), n_sum.sum(0)], ["p", "n"])

    keys = "model string, _chunk int"
    sums = cut.groupBy("model", "_chunk").applyInArrow(totals, f"{keys}, p array<double>, n array<double>")
    above = Window.partitionBy("model").orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    added = lambda c: F.aggregate(F.collect_list(c).over(above), F.array_repeat(F.lit(0.0), replicates + 1), lambda a, b: F.zip_with(a, b, lambda x, z: x + z))
    base = sums.select("model", "_chunk", added("p").alias("p_above"), added("n").alias("n_above"))

    def parts(left: pa.Table, right: pa.Table) -> pa.Table:
        x, p_sum, n_sum = _weighted(left, replicates)
        p_above, n_above = (np.array(right[c][0].as_py()) for c in ("p_above", "n_above"))
        tp = p_above + np.cumsum(p_sum[::-1], axis=0)[::-1]  # positives of this score and above
        fp = n_above + np.cumsum(n_sum[::-1], axis=0)[::-1]
        seen = tp + fp
        precision = (p_sum * np.divide(tp, seen, out=np.zeros_like(tp), where=seen > 0)).sum(0)
        worse = (p_sum * (fp - n_sum / 2)).sum(0)  # negatives that rank above a positive, half of equal ones
        brier = (p_sum * ((x - 1) ** 2)[:, None] + n_sum * (x**2)[:, None]).sum(0)
        return _lists(left, [p_sum.sum(0), n_sum.sum(0), precision, worse, brier], ["p", "n", "precision", "worse", "brier"])

    names = ["p", "n", "precision", "worse", "brier"]
    each = cut.groupBy("model", "_chunk").cogroup(base.groupBy("model", "_chunk")).applyInArrow(parts, f"{keys}, " + ", ".join(f"{c} array<double>" for c in names))
    long = each.select("model", F.posexplode(F.arrays_zip(*names)).alias("replicate", "s"))
    one = long.groupBy("model", "replicate").agg(*[F.sum(f"s.{c}").alias(c) for c in names])
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return one.select(
        "model", "replicate", F.when(both, 1 - F.col("worse") / (F.col("p") * F.col("n"))).alias("auc"), F.when(F.col("p") > 0, F.col("precision") / F.col("p")).alias("pr_auc"),
        F.try_divide(F.col("brier"), F.col("p") + F.col("n")).alias("brier"),
    )


def _lists(table: pa.Table, arrays: list[np.ndarray], names: list[str]) -> pa.Table:
    return pa.table([table["model"].slice(0, 1), table["_chunk"].slice(0, 1), *[pa.array([a.tolist()], pa.list_(pa.float64())) for a in arrays]], names=["model", "_chunk", *names])


METRICS = ("auc", "pr_auc", "brier")


def paired_deltas(metrics: DataFrame, base: str, other: str) -> DataFrame:
    """One row: each metric of `other` minus `base` over all units, its 95 % interval over the replicates that have both,
    and the number of those."""
    pick = lambda m, c: F.max(F.when(F.col("model") == m, F.col(c)))
    d = metrics.groupBy("replicate").agg(*[(pick(other, c) - pick(base, c)).alias(c) for c in METRICS])
    drawn = F.col("replicate") > 0
    out = []
    for c in METRICS:
        kept = F.when(drawn, F.col(c))
        out += [F.max(F.when(~drawn, F.col(c))).alias(f"{c}_delta"), F.percentile(kept, F.lit(0.025)).alias(f"{c}_low"), F.percentile(kept, F.lit(0.975)).alias(f"{c}_high"), F.count(kept).alias(f"{c}_replicates")]
    return d.agg(*out)
