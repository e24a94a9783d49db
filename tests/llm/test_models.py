"""Quality rules, language model, pipeline."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chargelens.llm import pitman_yor, quality
from chargelens.llm.common import table
from chargelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_rules_on_held_out_rows(spark):
    got = QUERIES["op5_quality_rules"](spark, SF)
    docs = table(spark, SF, "documents")
    assert got.count() == docs.count()
    rows = got.join(table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.9
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97


def test_compiled_rules_equal_plain_evaluation(spark):
    text = "Tree (depth=2)\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0E-1)\n    Predict: 0.0\n   Else (feature 1 > 2.0E-1)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0"
    rules = quality.rules_of([text, text])
    assert [r.terms for r in rules] == [((0, True, 1.5),), ((0, True, 1.5), (1, True, 0.2)), ((0, True, 1.5), (1, False, 0.2)), ((0, False, 1.5),)]
    model = quality.RuleModel(0.25, tuple((r, w) for r, w in zip(rules, (1.0, -2.0, 0.5, 3.0))))
    points = [(a, b) for a in (1.0, 1.5, 2.0) for b in (0.1, 0.2, 0.3)]
    got = spark.createDataFrame([([float(a), float(b)],) for a, b in points], "f array<double>").select(model.score(F.col("f")).alias("s")).collect()
    for (a, b), r in zip(points, got):
        z = 0.25 + sum(w for rule, w in model.rules if all((((a, b)[i] <= v) if le else ((a, b)[i] > v)) for i, le, v in rule.terms))
        assert abs(r.s - 1 / (1 + math.exp(-z))) < 1e-12


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 0, None), (None, 1, 1), (9, None, 0), (1, 1, 0)]])
def test_few_labels(spark, make_docs, labels):
    rows = [(1, "Some fine words."), (2, None), (3, "### !!! ###"), (3, "### !!! ###"), (None, ""), (4, "w " * 30000)]
    docs = make_docs(rows).withColumn("f", F.lit(1)).withColumn("label", F.lit("x"))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(quality.train_rows(docs, known, F.lit(True)))
    got = quality.score_all(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns and quality.keep_good(docs, model, 0.0).count() == len(rows)


def test_language_model(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    extra = docs.limit(0).union(spark.createDataFrame([(-1, None, None, None, None), (-1, None, None, None, None), (-2, "", None, None, 0), (-3, "\x00 \U0001f600 zzz", None, None, 0), (None, "the the", None, None, 1)], docs.schema))
    every = docs.union(extra).withColumn("k", F.lit(1)).withColumn("chunk", F.lit("x"))
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = pitman_yor.score_texts(every, learn).collect()
    rows = [(r.doc_id, r.text) for r in every.collect()]
    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c: Counter = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words(t), b""])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), b""]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), b""]), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), not r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) and r.perplexity >= 1 for r in got)
    out = [r for r in got if not r.learned]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert pitman_yor.score_texts(every.limit(0), learn).count() == 0


def test_spelling_restaurants_sum_to_one(spark):
    words = spark.createDataFrame([(b"wabc", 3), (b"wabd", 1), (b"wb", 7), (b"w", 2), ("wé".encode(), 0)], "k binary, c long")
    runs = pitman_yor.spelling_runs(words)
    assert runs.agg(F.sum("c")).first()[0] == 4 + 4 + 2 + 1
    p = pitman_yor.gibbs(runs, 1, 3).withColumn("ctx", F.shiftright("g", pitman_yor.BITS)).groupBy("ctx").agg(F.sum("p").alias("p")).collect()
    assert all(0 < r.p <= 1 + 1e-9 for r in p)


def test_seating():
    rng = np.random.default_rng(0)
    c = np.array([0, 1, 2, 50, 100_000])
    t = pitman_yor.seat(c, np.full(5, 0.5), 0.5, rng)
    assert t[0] == 0 and t[1] == 1 and (t[1:] >= 1).all() and (t <= c).all()
    # two customers: the second opens a table with fresh / (fresh + 1 - discount)
    many = pitman_yor.seat(np.full(40_000, 2), np.full(40_000, 0.5), 0.5, rng) - 1
    assert abs(many.mean() - 0.5) < 0.02


def test_pipeline_stages(spark, make_docs, tmp_path):
    from tests_llm_brute import brute_clean, brute_first_of_groups

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    bench = [(r.item_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    steps = dict(corpus_pipeline.STAGES)
    odd = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0)], docs.schema))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    dedup = steps["simhash_near_dedup"](spark, odd, "/root/testdata/sf0.001")
    assert dedup.columns == docs.columns
    assert sorted(str(r.doc_id) for r in dedup.collect()) == sorted(map(str, brute_first_of_groups(rows)))
    clean = steps["benchmark_decontamination"](spark, odd, "/root/testdata/sf0.001")
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in rows if brute_clean(t, bench))
    named = steps["pseudonyms"](spark, odd, "/root/testdata/sf0.001")
    assert named.columns == docs.columns and named.count() == odd.count()
    kept = steps["quality_rules"](spark, odd, "/root/testdata/sf0.001")
    assert kept.columns == docs.columns and 0 < kept.count() <= odd.count()
    for _, step in corpus_pipeline.STAGES:
        step(spark, docs.limit(0), "/root/testdata/sf0.001").count()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
