"""Packing, order, licences, pseudonyms, link graph."""
import datetime
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chargelens.llm import licences, linkgraph, ordering, packing, pseudonyms, simhash, winnow
from chargelens.llm.queries import TEST_KEY
from chargelens.llm.tokens import TextEncoder, tokenizer_path

ODD = ["", None, " ", "  two  blanks ", "tab\tand\n\nlines \n x", "a b   c", "it's 1234 é日本 😀!!", "<|endoftext|> x", "x" * 3000, "word " * 4000]


@lru_cache(maxsize=1)
def tokenizer():
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    return tok


def whole(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def test_pieces_have_the_ids_of_the_text():
    rng = random.Random(1)
    some = ODD + ["".join(rng.choice(["a", "B", " ", "  ", "\n", "\t", "7", "é", ".", "'s", " ", "-"]) for _ in range(60)) for _ in range(300)]
    for size in (1 << 20, 3):
        enc = TextEncoder(tokenizer_path(), size=size)
        for t in some:
            assert np.frombuffer(enc.encode(t or ""), "<u4").tolist() == whole(t), repr(t)


def test_packing_round_trip(spark, make_docs):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, ODD[5]), (None, "no id")] + [(100 + i, "some words " * rng.randrange(1, 500)) for i in range(40)]
    got = packing.pack(make_docs(rows).withColumn("ids", F.lit(1)).withColumn("start", F.lit(1)), size=64).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) and r.length > 0
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    for i, t in rows:
        ids = whole(t) + [0]
        want = ids + ids if i == 5 else ids
        assert sum(len(p) for _, p, _ in pieces[i]) == len(want)
        if i != 5:
            assert [x for _, p, _ in sorted(pieces[i]) for x in p] == ids and {n for *_, n in pieces[i]} == {len(ids)}
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    assert packing.pack(make_docs([]).limit(0)).count() == 0


def test_a_rest_goes_where_the_squares_are_least():
    p = packing.SumOfSquares(8)
    for size in (3, 3, 3):
        list(p.add(0, b"\0" * 4 * size))
    # 3 alone: new; second 3 on the first (levels 6) beats two windows at 3; third opens anew
    assert p.level[6] == 1 and p.level[3] == 1 and p.n_open == 2
    assert [len(w) for w in p.add(1, b"\0" * 8)] == [3]
    many = packing.SumOfSquares(8, most_open=3)
    out = [w for i in range(50) for w in many.add(i, b"\0" * 4 * 5)] + list(many.drain())
    assert sum(len(x[2]) for w in out for x in w) == 50 * 20 and many.n_open == 0


def test_order_is_a_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        order = ordering.FeistelOrder(n)
        slots = order.slot(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n)) and (order.index(slots) == np.arange(n)).all()
    assert (ordering.FeistelOrder(1000, "other").slot(np.arange(1000)) != ordering.FeistelOrder(1000).slot(np.arange(1000))).any()


def test_shards_are_read_from_any_slot(spark, make_docs, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i, f"document {i} " * i) for i in range(60)]
    make_docs(rows).coalesce(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    manifest, folder = ordering.materialise(docs, folder=str(tmp_path / "shards"), length=32, shard=10)
    listed = sorted(manifest.collect())
    n = len(listed)
    assert [r.slot for r in listed] == list(range(n)) and all(r.byte_offset == r.position * 64 for r in listed)
    ids = [x.tolist() for x in ordering.read_from(folder, 0, 32, 10)]
    assert len(ids) == n and [zlib.crc32(np.array(x, "<u2").tobytes()) for x in ids] == [r.ids_crc32 for r in listed]
    assert [x.tolist() for x in ordering.read_from(folder, 17, 32, 10)] == ids[17:]
    assert n * 32 >= sum(len(whole(t)) + 1 for _, t in rows)
    # the stream of each task, put back in order, is its documents
    back = ordering.FeistelOrder(n).slot(np.arange(n))
    stream = [x for s in back for x in ids[s]]
    joined = [x for t in [r.text for r in docs.collect()] for x in whole(t) + [0]]
    assert sorted(x for x in stream if x) == sorted(x for x in joined if x)
    assert ordering.materialise(docs.limit(0), folder=str(tmp_path / "none"))[0].count() == 0


def test_matching_statistics_equal_brute_force():
    rng = random.Random(7)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 9))] for _ in range(5)]
    auto = licences.Automaton(texts)
    parts = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(20)]
        got = {end: (n, auto.ends[s], auto.whole[s]) for end, n, s in auto.statistics(words)}
        for end in range(1, 21):
            n = max((k for k in range(1, end + 1) if tuple(words[end - k : end]) in parts), default=0)
            assert got.get(end, (0,))[0] == n
            if n:
                m = words[end - n : end]
                assert got[end][1] == {(i, j) for i, t in enumerate(texts) for j in range(n, len(t) + 1) if t[j - n : j] == m}
                assert [i for i in got[end][2] if len(texts[i]) <= n] == [i for i, t in enumerate(texts) if len(t) <= n and words[end - len(t) : end] == t]


def test_licences(make_docs):
    rows = [(1, "Released under the MIT License. apache LICENSE, Mit license"), (2, None), (3, ""), (None, "cc-by cc by"), (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of the software and associated documentation files (the Software), to deal in the Software without restriction"), (4, "no licence"), (5, "permission is hereby " * 3000)]
    got = {(r.doc_id, r.n_words): r for r in licences.scan_licences(make_docs(rows).withColumn("places", F.lit(1))).collect()}
    assert len(got) == len(rows)
    assert [(p.label, p.start) for p in got[(1, 9)].places] == [("mit", 3), ("apache", 5), ("mit", 7)]
    assert [(s.label, s.start, s.stop, s.share) for s in got[(1, 9)].spans] == [("mit-grant", 0, 5, 1.0)]
    assert [p.start for p in got[(None, 4)].places] == [0, 2]
    (span,) = next(r.spans for r in got.values() if r.doc_id == 4 and r.n_words > 9)
    assert span.label == "mit-grant" and 0.8 <= span.share < 1
    assert all(not r.places and not r.spans for r in got.values() if r.doc_id in (2, 3, 5))


def test_whole_template_before_words_of_another(make_docs):
    rows = [(1, "Licensed under the Apache License, Version 2.0. The code ..."), (2, "Licensed under the Apache License, Version 2.0 (the License) and others"), (3, "Licensed under the Apache License, Version 1.0"), (4, licences.TEMPLATES[1][1] + " " + licences.TEMPLATES[2][1]), (5, "Released under the MIT License. Released under the MIT License.")]
    got = {r.doc_id: [(s.label, s.start, s.stop, s.share) for s in r.spans] for r in licences.scan_licences(make_docs(rows)).collect()}
    assert got[1] == got[2] == [("apache-2.0", 0, 8, 1.0)]
    assert [s[0] for s in got[4]] == ["gpl-notice", "apache-2.0"] and got[5] == [("mit-grant", 0, 5, 1.0), ("mit-grant", 5, 10, 1.0)]
    every = {r.doc_id: {s.label for s in r.spans} for r in licences.scan_licences(make_docs([(i, f"See here: {t} And so on") for i, (_, t) in enumerate(licences.TEMPLATES)])).collect()}
    assert all(every[i] == {label} for i, (label, _) in enumerate(licences.TEMPLATES))


def brute_permute(n, low, high, tag):
    import hashlib

    x, y = n % low, n // low
    for r in range(pseudonyms.ROUNDS):
        other = y if r % 2 == 0 else x
        h = int(hashlib.sha256(f"{TEST_KEY}|{tag}|{r}|{other}".encode()).hexdigest()[:15], 16)
        x, y = ((x + h) % low, y) if r % 2 == 0 else (x, (y + h) % high)
    return y * low + x


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms(spark, make_docs):
    same = "4041894974608795"
    rows = [
        (1, f"card {same}, 4041 8949 7460 8795 and 4041-8949-7460-8795; not {same[:-1]}6 nor x{same} nor {same}12345"),
        (2, "ip 70.123.182.155 and 999.1.1.1, v1.2.3 4.0."),
        (3, "on 2021-02-28 or 28.02.2021 or 28/02/2021, never 2021-02-30"),
        (4, "call +1 (988) 555-2485 or 988-555-2485, not 123-456-7890"),
        (5, "id 123-45-6789, not 000-45-6789"),
        (6, "to a.User7@mail8.example.com and a.User7@mail8.example.com."),
        (7, None), (8, ""), (None, "plain"), (1, "plain 4041894974608795"), (9, "9" * 20000 + " 4041894974608795 " + "word " * 20000),
    ]
    df = make_docs(rows).withColumn("kinds", F.lit("mine")).withColumn("kind", F.lit(1))
    out = pseudonyms.pseudonymise(df, TEST_KEY)
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    card = re.findall(r"\d[\d -]+\d", next(t for t in got[1] if t.startswith("card")))
    assert re.sub(r"\D", "", card[0]) == re.sub(r"\D", "", card[1]) == re.sub(r"\D", "", card[2]) != same and luhn(re.sub(r"\D", "", card[0]))
    body = brute_permute(int(same[:-1]), 10**7, 10**8, "card16")
    assert card[0].startswith(f"{body:015d}") and card[1][4] == " " and card[2][4] == "-"
    assert f"not {same[:-1]}6 nor x{same} nor {same}12345" in next(t for t in got[1] if t.startswith("card"))
    assert f"plain {card[0].strip()}" in got[1]
    n = brute_permute((70 << 24) + (123 << 16) + (182 << 8) + 155, 65536, 65536, "ipv4")
    assert got[2] == [f"ip {n >> 24}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255} and 999.1.1.1, v1.2.3 4.0."]
    y, m, d = re.search(r"(\d{4})-(\d\d)-(\d\d) or", got[3][0]).groups()
    assert f"or {d}.{m}.{y} or {d}/{m}/{y}, never 2021-02-30" in got[3][0] and (y, m, d) != ("2021", "02", "28")
    a, b = re.match(r"call \+1 (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}), not 123-456-7890", got[4][0]).groups()
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "9885552485"
    assert re.match(r"id (?!123-45-6789)\d{3}-\d\d-\d{4}, not 000-45-6789", got[5][0])
    x, z = re.findall(r"[a-z]\.[A-Z][a-z]{3}\d@mail8\.example\.com", got[6][0])
    assert x == z != "a.User7@mail8.example.com"
    assert got[7] == [None] and got[8] == [""] and got[None] == ["plain"] and card[0].strip() in got[9][0]


def test_pseudonyms_are_one_to_one(spark):
    days = spark.range(0, 73_049, 7).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    mails = spark.range(2000).select(F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.org")).alias("text"))
    phones = spark.range(2000).select(F.concat(F.lit("200-200-"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("text"))
    for df in (days, mails, phones):
        assert pseudonyms.pseudonymise(df, TEST_KEY).distinct().count() == df.count() == pseudonyms.pseudonymise(df, TEST_KEY, found="k").filter(F.size("k") == 1).count()


def test_phones_with_any_codes(spark, make_docs):
    rows = [(1, "+1 (091) 555-3384"), (2, "(091) 555-3384 or 1-091-555-3384"), (3, "+1 (134) 055-2562"), (4, "091-555-3384"), (5, "+1 (988) 155-2485")]
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymise(make_docs(rows), TEST_KEY).collect()}
    d = f"{brute_permute(915553384, 40_000, 50_000, 'phone low'):010d}"
    assert got[1] == f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}" != rows[0][1]
    assert got[2] == f"({d[:3]}) {d[3:6]}-{d[6:]} or 1-{d[:3]}-{d[3:6]}-{d[6:]}"
    assert got[3] != rows[2][1] and got[4] == rows[3][1] and got[5] != rows[4][1]
    code = F.lpad((F.col("id") * 7 % 1000).cast("string"), 3, "0")
    many = spark.range(4000).select(F.concat(F.lit("("), code, F.lit(") "), F.lpad((F.col("id") * 13 % 1000).cast("string"), 3, "0"), F.lit("-0000")).alias("text")).distinct()
    out = pseudonyms.pseudonymise(many, TEST_KEY, found="k").filter("k[0] = 'phone'")
    assert out.select("text").distinct().count() == many.count() and out.filter(r"text rlike '^\\([0-9]{3}\\) [0-9]{3}-[0-9]{4}$'").count() == many.count()


def test_values_side_by_side(spark, make_docs):
    card = "4111111111111111"
    texts = [
        ("2021-03-04 12345", "date"), ("1990-05-17 1991-06-18", "date,date"), ("123-45-6789 2020", "ssn"), ("555-123-4567 123-45-6789", "phone,ssn"),
        (f"{card} 123", "card"), (f"12 {card}", "card"), ("1234 4111 1111 1111 1111 123", "card"), ("212-555-1234 100", "phone"), ("12/31/1999 31/12/1999 1999-12-31", "date,date,date"),
        (f"2021-03-04 {card} 212-555-1234 70.123.182.155 12.31.1999", "date,card,phone,ipv4,date"), ("4111-1111 1111-1111", "card"), ("2021-02-30 13/13/1999 29.02.2021 02/29/1900", ""),
        ("02/29/2000 29.02.2000", "date,date"), ("4111111111111112 123-45-6789", "ssn"), (f"{card} 123a", "card"), ("1234 " * 5000, None),
    ]
    out = pseudonyms.pseudonymise(make_docs(list(enumerate(t for t, _ in texts))), TEST_KEY, found="kinds").collect()
    got = {r.doc_id: r.text for r in out}
    kinds = {r.doc_id: ",".join(r.kinds) for r in out}
    assert {i: k for i, k in kinds.items() if texts[i][1] is not None} == {i: k for i, (_, k) in enumerate(texts) if k is not None}
    new = f"{brute_permute(int(card[:-1]), 10**7, 10**8, 'card16'):015d}"
    assert got[4][:15] == new and got[4].endswith(" 123") and got[5][3:18] == new and got[6].startswith("1234 ") and got[6].endswith(" 123") and new in re.sub(" ", "", got[6])
    assert got[2].endswith(" 2020") and got[7].endswith(" 100") and got[7][:12] in got[9] and got[11] == texts[11][0]
    us, eu, iso = got[8].split()
    y, m, d = iso.split("-")
    assert eu == f"{d}/{m}/{y}" and us == (f"{m}/{d}/{y}" if d > "12" else eu) and iso != "1999-12-31"


def test_day_patterns_equal_the_calendar(spark):
    def real(y, m, d):
        try:
            return bool(datetime.date(y, m, d)) and 1900 <= y <= 2099
        except ValueError:
            return False

    sample = [(y, m, d) for y in (1899, 1900, 1904, 1999, 2000, 2004, 2099, 2100) for m in range(14) for d in range(33)]
    for y, m, d in sample:
        assert bool(re.fullmatch(pseudonyms.DAY, f"{y}-{m:02d}-{d:02d}")) == real(y, m, d)
        for mark in "/.":
            assert bool(re.fullmatch(pseudonyms.DAY, f"{d:02d}{mark}{m:02d}{mark}{y}")) == (real(y, m, d) or real(y, d, m))


def test_link_graph(spark):
    pages = [
        (1, "https://A.example.net/en/x", '<a href="http://b.com/x">'), (2, "http://bad.net/", "<a href='//c.com'>"), (3, "http://b.com/?q", '<A HREF="https://d.com/">'),
        (4, "http://c.com", '<a href="http://bad.net/z">'), (5, "http://d.com#x", None), (6, None, None), (7, "no url", ""), (7, "no url", ""), (8, "http://www.example.com/de/1", "<p>"),
        (9, "http://w.org/fr/", "<a href=http://d.com>"), (None, "http://example.com/dex", "x"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("score", F.lit(2))
    got = {r.page_id: r for r in linkgraph.judge(df).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("net/", "block") and got[4].verdict == "block" and got[4].distrust > 0
    assert (got[3].host, got[3].path, got[3].verdict) == ("b.com", "/", "allow") and got[3].trust > 0 and got[5].trust > 0
    assert (got[6].host, got[6].path, got[6].rule, got[6].verdict) == ("", "", None, "allow") == (got[7].host, got[7].path, got[7].rule, got[7].verdict)
    assert (got[8].rule, got[8].verdict) == ("example.com/de/", "block") and got[None].rule is None
    edges = [("a.example.net", "b.com"), ("bad.net", "c.com"), ("b.com", "d.com"), ("c.com", "bad.net"), ("w.org", "d.com")]
    seed = {"a.example.net": 0.5, "w.org": 0.5}
    score = {h: 0.15 * s for h, s in seed.items()}
    for _ in range(linkgraph.ROUNDS):
        new = defaultdict(float, {h: 0.15 * s for h, s in seed.items()})
        for a, b in edges:
            new[b] += 0.85 * score.get(a, 0) / sum(x == a for x, _ in edges)
        score = new
    for i, h in ((1, "a.example.net"), (3, "b.com"), (5, "d.com"), (9, "w.org")):
        assert abs(got[i].trust - score[h]) < 1e-12
    assert linkgraph.judge(df.limit(0)).count() == 0


def test_scores_stand_still(spark):
    n = 14
    urls = [f"http://h{i}.com/" for i in range(n)] + ["http://bad.net/"]
    chain = [(i, u, f'<a href="{v}">') for i, (u, v) in enumerate(zip(urls, urls[1:]))] + [(n, urls[-1], None)]
    ring = [(20, "http://a.org/fr/", '<a href="http://b.io">'), (21, "http://b.io/", '<a href="http://a.org/"><a href="http://c.io">'), (22, "http://c.io/", None)]
    got = {r.page_id: r for r in linkgraph.judge(spark.createDataFrame(chain + ring, "page_id long, url string, html string")).collect()}
    for i in range(n):
        assert abs(got[i].distrust - 0.15 * 0.85 ** (n - i)) < 1e-9 and got[i].verdict == "block"
    a = 0.15 / (1 - 0.85**2 / 2)
    assert abs(got[20].trust - a) < 1e-9 and abs(got[21].trust - 0.85 * a) < 1e-9 and abs(got[22].trust - 0.85**2 * a / 2) < 1e-9


def test_columns_with_the_names_of_temporary_ones_stay(spark, make_docs):
    """Whatever names a caller's columns have, they come back as they went in."""
    odd = ["__text", "__pieces", "__text_key", "__row_uid", "__bad_key", "__row", "_pieces", "_text", "_text_key", "_bad_key", "_row_uid", "text_key", "uid", "kinds"]
    docs = make_docs([(1, "Write to a.b@example.com or 123-45-6789 today please now"), (2, None), (3, "Clean words of another kind are here"), (3, "Clean words of another kind are here")])
    docs = docs.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in odd])
    items = spark.createDataFrame([("b1", "clean words of another kind are here")], "item_id string, text string")
    kept = lambda df: sorted(tuple(r[c] for c in odd) for r in df.collect())
    named = pseudonyms.pseudonymise(docs, TEST_KEY)
    assert named.columns == docs.columns and kept(named) == kept(docs) and "a.b@example.com" not in named.filter("doc_id = 1").first().text
    clean = winnow.keep_clean(docs, items)
    assert clean.columns == docs.columns and kept(clean) == kept(docs.filter("doc_id < 3"))
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns and kept(one) == kept(docs.dropDuplicates(["doc_id"]))
    replaced = pseudonyms.pseudonymise(docs, TEST_KEY, found="kinds")
    assert replaced.columns.count("kinds") == 1 and {tuple(r.kinds) for r in replaced.filter("doc_id = 1").collect()} == {("email", "ssn")}
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise(docs, "")
