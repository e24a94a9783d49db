"""Word contexts of op2 against plain counts and a plain sampler."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargelens.llm import pitman_yor as py

LEARNED = [(i, " ".join(random.Random(i).choices(["red", "green", "big", "small"], k=4) + ["new york", "los angeles"][i % 2 :][:1] + ["new", f"odd{i}"][: i % 3])) for i in range(40)]


@pytest.fixture(scope="module")
def texts(spark, make_docs):
    return make_docs([*LEARNED, (1, LEARNED[1][1]), (100, "york new odd8 never seen"), (101, None), (102, "Big new york"), (103, "york new big")]).repartition(3)


def plain_sampler(pairs: Counter, base: dict, d_pair: float, d_word: float, sweeps: int, rng: random.Random) -> tuple[float, dict]:
    """Customers leave and sit down again one by one. Mean number of tables after the first half; mean probability of each pair."""
    sat, parent = defaultdict(list), defaultdict(list)
    tables, customers = Counter(), Counter()
    now = {"tables": 0, "customers": 0}
    p_word = lambda w: (sum(parent[w]) - d_word * len(parent[w]) + (1 + d_word * now["tables"]) * base[w]) / (1 + now["customers"])

    def sit(tables_of, fresh, d):
        weights = [n - d for n in tables_of]
        x = rng.random() * (sum(weights) + fresh)
        for k, v in enumerate(weights):
            x -= v
            if x < 0:
                tables_of[k] += 1
                return False
        tables_of.append(1)
        return True

    def leave(tables_of):
        k = rng.choices(range(len(tables_of)), tables_of)[0]
        tables_of[k] -= 1
        if not tables_of[k]:
            del tables_of[k]
            return True
        return False

    every = [x for x, n in pairs.items() for _ in range(n)]
    total, mean, kept = 0, Counter(), 0
    for sweep in range(sweeps):
        for u, w in every:
            if sweep:
                customers[u] -= 1
                if leave(sat[u, w]):
                    tables[u] -= 1
                    now["customers"] -= 1
                    now["tables"] -= leave(parent[w])
            if sit(sat[u, w], (1 + d_pair * tables[u]) * p_word(w), d_pair):
                tables[u] += 1
                now["tables"] += sit(parent[w], (1 + d_word * now["tables"]) * base[w], d_word)
                now["customers"] += 1
            customers[u] += 1
        if sweep >= sweeps // 2:
            kept += 1
            total += sum(tables.values())
            for u, w in pairs:
                mean[u, w] += (sum(sat[u, w]) - d_pair * len(sat[u, w]) + (1 + d_pair * tables[u]) * p_word(w)) / (1 + customers[u])
    return total / kept, {x: v / kept for x, v in mean.items()}


def test_restaurants_of_words_and_pairs(spark, texts):
    n_parts, samples = 3, 12
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    split = lambda t: [b"", *(t or "").lower().encode().split(), b""]
    want = Counter(p for i, t in rows if i < 100 for p in zip(split(t), split(t)[1:]))
    letters = py.numbered_texts(texts, F.col("doc_id") < 100, n_parts, "doc_id", "text", 300)
    words = py._answer(py._number, py._kinds(letters, "words"))
    n_train, distinct = py._totals(words)[:2]
    assert n_train == sum(want.values())
    numbers, lists = py._kinds(words, "numbers"), py._kinds(words, "list").collect()
    word_of = {j * n_parts + r["at"]: w for r in lists for j, w in enumerate(r.x.split(b" "))}
    count = {w: c for r in lists for w, c in zip(r.x.split(b" "), py._unpack(r.y).tolist())}
    spelling = spark.createDataFrame([("spelled", r["at"], 0, bytes(r.y), py._pack(np.full(len(r.x.split(b" ")), -np.log(distinct))), None) for r in lists], py.LETTER)
    pairs = py.pair_counts(letters.filter("kind = 'docs'"), numbers, n_parts)
    values, found, from_base, d_pair = py.word_predictive(spelling, pairs, n_parts, int(distinct), 6, samples)
    p, tables = {}, {}
    for r in values.collect():
        own, base = py._unpack(r.x).reshape(2, -1)
        for j, (a, b, t) in enumerate(zip(own, base, py._unpack(r.y))):
            p[word_of[j * n_parts + r["at"]]], tables[word_of[j * n_parts + r["at"]]] = a + from_base * b, t / samples
    # the known words and the sign of all unknown ones share all chances
    assert abs(sum(p[w] for w in p if count[w]) + from_base * (1 - py.SPELLED) / (distinct + 1) - 1) < 1e-9
    # each chunk is told the corpus-wide count and the tables of each of its pairs
    by_chunk = {r["at"]: r for r in letters.filter("kind = 'docs'").collect()}
    sent = {(r["at"], r.of): r for r in found.collect()}
    got = {}
    for at, doc in by_chunk.items():
        doc = doc.asDict()
        _, code = py._codes(doc, sorted((r.asDict() for r in numbers.filter(F.col("at") == at).collect()), key=lambda r: r["of"]), n_parts)
        *_, pair, _, _, part = py._pairs(doc, code, n_parts)
        for q, own in py._split(part):
            r = sent[at, q]
            for k, c, t in zip(pair[own].tolist(), py._unpack(r.x).tolist(), py._unpack(r.y).tolist()):
                u, w = word_of[k >> py.CODE_BITS], word_of[k & ((1 << py.CODE_BITS) - 1)]
                assert c == want[u, w] and (c == 0) == (t == 0) and t <= c * samples
                assert got.setdefault((u, w), (c, t / samples)) == (c, t / samples)
    assert len(by_chunk) > 3 and set(want) <= set(got)
    # tables of a context are those of its pairs; its chances sum to one
    for u in {u for u, _ in want}:
        assert abs(tables[u] - sum(t for (v, _), (_, t) in got.items() if v == u)) < 1e-9
        known = sum((got[u, w][0] - d_pair * got[u, w][1] if (u, w) in got else 0) + (1 + d_pair * tables[u]) * p[w] for w in p if count[w])
        assert abs((known + (1 + d_pair * tables[u]) * from_base * (1 - py.SPELLED) / (distinct + 1)) / (1 + count[u]) - 1) < 1e-9
    n = Counter(w for _, w in want)
    d_word = py._discount(sum(x == 1 for x in n.values()), sum(x == 2 for x in n.values()))
    base = {w: (1 - py.SPELLED) / (distinct + 1) + py.SPELLED / distinct for w in count}
    # all pairs are seated at once given the sweep before, so there are some more tables than with customers one by one
    total, mean = plain_sampler(want, base, d_pair, d_word, 400, random.Random(1))
    assert abs(sum(tables.values()) - total) < 0.15 * total
    ours = {(u, w): (c - d_pair * t + (1 + d_pair * tables[u]) * p[w]) / (1 + count[u]) for (u, w), (c, t) in got.items() if c}
    assert np.mean([abs(np.log10(ours[x] / mean[x])) for x in ours]) < 0.1


def test_the_order_of_words_changes_a_score(texts):
    got = {(r.doc_id, r.text): r for r in py.score_texts(texts, F.col("doc_id") < 100, chunk=300).join(texts.select("doc_id", "text").distinct(), "doc_id").collect()}
    there, back = got[102, "Big new york"], got[103, "york new big"]
    assert there.n_tokens == back.n_tokens == 4 and abs(there.base_score - back.base_score) < 1e-9
    assert there.score > back.score + 1
    assert got[101, None].n_tokens == 1 and got[100, "york new odd8 never seen"].n_known == 4
