"""Quality classifier: a sparse ensemble of tree rules over text statistics, compiled into a column expression."""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import stage

FEATURES = ("n_bytes", "n_words", "word_bytes", "upper", "digit", "punct", "symbol", "high", "space", "distinct_words", "lines", "repeated_lines", "line_stop", "word_stop", "longest_word", "top_word")
TREES, DEPTH = 24, 3
LASSO = 0.002
MOST_TRAINED = 200_000  # labelled rows that fit the model; all rows are scored
ROWS_A_TASK = 10_000
SEED = 7
_KIND = np.zeros(256, np.int64)  # 1 upper, 2 digit, 3 sentence mark, 4 symbol, 5 beyond ASCII, 6 white space
for _i in range(256):
    _c = chr(_i)
    _KIND[_i] = 5 if _i > 127 else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c in ".,;:?!'\"()-" else 6 if _c.isspace() else 0 if _c.isalpha() else 4


def statistics_of(text: str | None) -> list[float]:
    """FEATURES of one text; null counts as empty, and an empty text is all zeros."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=7) / n
    words = raw.split()
    m = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    sizes = list(map(len, words))
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    ends = sum(x.rstrip()[-1:] in (b".", b"?", b"!") for x in lines)
    stops = sum(w[-1:] in b".,;:?!" for w in words)
    return [math.log1p(n), math.log1p(len(words)), sum(sizes) / m, *kinds[1:7].tolist(), len(distinct) / m, math.log1p(len(lines)), 1 - len(set(lines)) / k, ends / k, stops / m, math.log1p(max(sizes, default=0)), max(distinct.values(), default=0) / m]


def with_statistics(rows: DataFrame, text: str, key: str) -> DataFrame:
    """(key, f array<double>): one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statistics_of(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))], names=["key", "f"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, f array<double>")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature number, is it `<=`, bound)."""

    terms: tuple[tuple[int, bool, float], ...]

    def column(self, f: Column) -> Column:
        out = F.lit(True)
        for i, below, bound in self.terms:
            out = out & ((f[i] <= bound) if below else (f[i] > bound))
        return out


def rules_of(trees: list[str]) -> list[Rule]:
    """Every path from a root to an inner or last node, without repeats, from the trees' printed form."""
    found: dict[Rule, None] = {}
    for text in trees:
        path: list[tuple[int, tuple[int, bool, float]]] = []
        for line in text.split("\n"):
            m = re.match(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)", line)
            if not m:
                continue
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3] == "<=", float(m[4])))]
            tight: dict[tuple[int, bool], float] = {}
            for _, (i, below, bound) in path:
                old = tight.get((i, below))
                tight[(i, below)] = bound if old is None else min(old, bound) if below else max(old, bound)
            found.setdefault(Rule(tuple((i, b, v) for (i, b), v in sorted(tight.items()))))
    return list(found)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, f: Column) -> Column:
        """Probability of label 1 as an expression over the statistics array."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(f), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, most: int = MOST_TRAINED, seed: int = SEED) -> RuleModel:
    """train (f array<double>, label 0/1). Above `most` rows about that many fit the model, picked by a hash of their statistics.

    No row: every score is 0.5. One label only: the share (n + 1) / (n + 2) for it. Rows without label are left out by
    `train_rows`; copies count each.
    """
    rows = stage(train.select("f", F.col("label").cast("double").alias("label")))
    share = most / max(rows.count(), 1)
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64("f"), F.lit(1_000_000)) < int(share * 1_000_000))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        p = (ones + 1) / (n + 2)
        return RuleModel(math.log(p / (1 - p)), ())
    rows = rows.coalesce(n // ROWS_A_TASK + 1)  # each step of a fit is a job over all tasks
    data = rows.select(array_to_vector("f").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", subsamplingRate=0.8).fit(data)
    rules = rules_of([t.toDebugString for t in forest.trees])
    marks = rows.select(array_to_vector(F.array(*[r.column(F.col("f")).cast("double") for r in rules])).alias("features"), "label")
    line = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=100).fit(marks)
    kept = tuple((r, float(w)) for r, w in zip(rules, line.coefficients) if w != 0.0)
    return RuleModel(float(line.intercept), kept)


def train_rows(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(f, label) of the labelled documents for which `usable` (over column doc_id) holds; labels other than 0 and 1 are left out.

    A doc_id with both labels is left out; repeated label rows count once.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    return with_statistics(docs, text, doc_id).join(known, F.col("key") == F.col("doc_id")).select("f", "label")


def score_all(docs: DataFrame, model: RuleModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every input row: null and empty texts have all statistics zero; repeated rows each keep a row."""
    return with_statistics(docs, text, doc_id).select(F.col("key").alias("doc_id"), model.score(F.col("f")).alias("score"))


def keep_good(docs: DataFrame, model: RuleModel, threshold: float, text: str = "text") -> DataFrame:
    """Rows of `docs`, with their own columns, that score `threshold` or more.

    Null texts are scored as empty ones; copies are kept or dropped alike; ties with the threshold stay; texts are read
    whole; an empty table stays empty.
    """
    rows = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    scored = with_statistics(rows, text, "__row")
    return scored.filter(model.score(F.col("f")) >= threshold).select("key.*")
