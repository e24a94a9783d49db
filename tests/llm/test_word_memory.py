"""Memory of op2's tasks: arrays as long as a chunk, and workers that a task keeps."""
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargelens.llm import pitman_yor as py


def chunk(n: int, words: int) -> tuple[dict, np.ndarray]:
    rng = np.random.default_rng(3)
    word = np.minimum(rng.zipf(1.3, n), words - 1).astype(np.int32)
    word[99::100] = 0
    size = np.full(n // 100, 100) * 2 + rng.integers(0, 2, n // 100)
    return {"x": py._pack(word), "y": py._pack(size)}, rng.permutation(words * 7)[:words]


@pytest.mark.parametrize("n", [100, 300, 20_000])
def test_pairs_of_a_chunk(n):
    doc, code = chunk(n, 500)
    word, size, learned, pair, first, at, part = py._pairs(doc, code, 5)
    before = [0, *word[:-1].tolist()]
    want = [(int(code[u]), int(code[w])) for u, w in zip(before, word.tolist())]
    assert list(zip(*(x.tolist() for x in py._words_of(pair)))) == sorted(set(want))
    assert [want[i] for i in first.tolist()] == sorted(set(want)) and first.tolist() == [want.index(p) for p in sorted(set(want))]
    assert (pair[at] == [u << py.CODE_BITS | w for u, w in want]).all()
    assert (size == 100).all() and learned.dtype == bool and ((part >= 0) & (part < 5)).all()


def test_a_chunk_needs_few_bytes_a_place():
    n = 1_000_000
    doc, code = chunk(n, 50_000)
    tracemalloc.start()
    py._pairs(doc, code, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 42 * n


def test_a_task_keeps_one_worker(spark, make_docs, monkeypatch):
    plans, run = [], py.stage

    class Reached(Exception):
        pass

    def staged(df, *a):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return run(df, *a)

    def reached(counts, *_):
        raise Reached(counts)

    monkeypatch.setattr(py, "stage", staged)
    monkeypatch.setattr(py, "gibbs", reached)
    docs = make_docs([(1, "red green red"), (2, "Big green"), (3, "unseen word"), (4, None)])
    with pytest.raises(Reached) as e:
        py.score_texts(docs, F.col("doc_id") < 3, chunk=10)
    assert plans and all(p.count("MapInArrow") <= 1 for p in plans)  # one behind the other are two workers at once
    words = spark.createDataFrame([(b"w" + w, c) for w, c in ((b"red", 2), (b"green", 2), (b"big", 1), (b"", 2), (b"unseen", 0), (b"word", 0))], "k binary, c long")
    assert sorted(map(tuple, e.value.args[0].collect())) == sorted(map(tuple, py.spelling_runs(words).collect()))
