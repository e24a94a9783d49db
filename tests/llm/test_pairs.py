"""SimHash groups, winnowing and top-k against brute force."""
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from chargelens.llm import simhash, topk, winnow


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    k = min(4, len(words))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps):
    left, out = set(range(len(fps))), {}
    while left:
        queue = [left.pop()]
        group = set(queue)
        while queue:
            a = queue.pop()
            near = {b for b in left if bin(fps[a] ^ fps[b]).count("1") <= 4}
            left -= near
            group |= near
            queue.extend(near)
        for i in group:
            out[i] = frozenset(group)
    return out


def texts(rng, n):
    base = [" ".join(rng.choice("alpha Beta gamma\tdelta éps zeta Eta theta".split(" ")) + str(rng.randrange(40)) for _ in range(rng.randrange(60, 200))) for _ in range(6)]
    out = ["", None, " \n", "one", "One", "two words", "x " * 5000]
    while len(out) < n:
        words = rng.choice(base).split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(3))
        out.append(" ".join(words))
    return out


def test_groups_equal_brute_force(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(texts(random.Random(3), 90))] + [(4, "one"), (None, "one"), (None, "lonely words of a row without an id")]
    got = simhash.near_duplicates(make_docs(rows).withColumn("key", F.lit(1)).withColumn("fp", F.lit("x"))).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups(fps)
    want = sorted((str(i), f, str(min((rows[j][0] for j in groups[k] if rows[j][0] is not None), default=None))) for k, ((i, _), f) in enumerate(zip(rows, fps)))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(make_docs(rows)).collect()
    assert len(kept) == len(set(groups.values())) and kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_split_buckets_lose_no_link(spark):
    rng = random.Random(5)
    fps = [0] + [sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(150)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    groups = brute_groups([f % (1 << 64) for f in fps])
    from chargelens.llm.components import components

    for block in (4096, 7):
        roots = {r.node: r.root for r in components(simhash.links(df, block=block)).collect()}
        assert {f: roots.get(f, f) for f in fps} == {f: min(fps[j] for j in groups[i]) for i, f in enumerate(fps)}


def test_empty_tables(spark, make_docs):
    none = make_docs([]).limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(none, items).count() == 0
    one = winnow.decontaminate(make_docs([(1, "a b c")]), items).first()
    assert (one.n_words, one.n_hit, one.n_items, one.contaminated) == (3, 0, 0, False)
    assert winnow.keep_clean(make_docs([(1, None)]), items).count() == 1


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hit, found = set(), set()
    for item, t in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(words)


def test_winnowing_equals_brute_force(spark, make_docs):
    rng = random.Random(9)
    word = lambda: rng.choice(["a", "B", "c3", "é"])
    items = [(i, " ".join(word() + str(rng.randrange(6)) for _ in range(rng.choice([1, 2, 5, 12, 13, 20, 40])))) for i in range(14)] + [(3, "again Again"), (20, None), (21, ""), (None, "null item here"), (22, "z " * 30), (23, "z " * 30)]
    docs = [(None, None), (1, ""), (2, "!?"), (3, "null item, here"), (4, "z-" * 400), (4, "z-" * 400), (5, "again again")]
    for i in range(60):
        words = [word() + str(rng.randrange(6)) for _ in range(rng.randrange(1, 80))]
        at = rng.randrange(len(words))
        source = (rng.choice(items)[1] or "").split()
        docs.append((10 + i, " ".join(words[:at] + source[rng.randrange(3) : rng.randrange(14, 42)] + words[at:])))
    df = make_docs(docs).withColumn("hash", F.lit(1)).withColumn("words", F.lit(None).cast("string")).withColumn("window", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("x"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.contaminated) for r in winnow.decontaminate(df, bench).collect())
    assert got == sorted((str(i), *brute_hits(t, items)) for i, t in docs)
    clean = winnow.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in docs if not brute_hits(t, items)[3])


def test_least_hashes_equal_placed_ones_and_split_texts_once(spark):
    rng = random.Random(3)
    rows = [(0, None), (1, "")] + [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 60)))) for i in range(2, 40)]
    words = spark.createDataFrame(rows, "text_key long, text string").select("text_key", winnow.alnum_words(F.col("text")).alias("words"))
    for span in (1, 2, 5, 13):
        least = winnow._least_hashes(words, span, ["text_key"])
        assert least._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
        placed = winnow._fingerprints(words, span, ["text_key"]).select("text_key", "hash").distinct()
        got = sorted(tuple(r) for r in least.collect())
        assert got and got == sorted(tuple(r) for r in placed.collect())


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) * rng.choice([0.1, 1, 3])]) for i in range(300)]
    rows += [(301, None), (302, [1.0, None] + [0.0] * 6), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (None, [1.0] * 8), (305, []), (306, [0.5]), (307, [0.0] * 8), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("part", F.lit(1)).withColumn("score", F.lit("x"))
    good = [(i, np.floor(64 * np.array(np.float32(v), np.float64))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    pad = [(i, np.concatenate([v, np.zeros(8 - len(v))])) for i, v in good]
    want = []
    for a, (i, v) in enumerate(pad):
        if i % 20 == 0:
            best = sorted((-int(v @ w), j) for b, (j, w) in enumerate(pad) if a != b)[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    for size in (4096, 32):
        got = topk.top_k(df, lambda c: c % 20 == 0, rows=size, queries=7, head=3).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.top_k(df.limit(0), lambda c: c % 20 == 0).count() == 0
