"""Languages, periodic runs, token alignment against brute force."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chargelens.llm import alignment, langid, runs, tokens
from chargelens.llm.common import table
from chargelens.llm.queries import QUERIES, looped

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "\n", "a", " a", "a ", "  a  b ", "a\nb", "a\n\nb\n", "\na b", "tab\there", "x\x00y\x01 \x01z", "a▁b c", "▁", "don't 's  's", "<s> <|endoftext|> </s>",
       "naïve café   ½ ﬁ", "日本語 テスト 🎉 🎉", "w" * 9000, "ab " * 3000, "1234567 12 3,4", "é ́", " x  y", "a \n b", " q"]


def brute_runs(x, least=6, exponent=4):
    def smallest(part):
        return next(q for q in range(1, len(part) + 1) if part[q:] == part[: len(part) - q])

    found = []
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q) and smallest(x[i : j + q]) == q:
                found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found)


def brute_row(doc_id, text):
    """The contract's columns of one document."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    inside = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in inside)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_equal_brute_force():
    rng, seen = random.Random(5), 0
    for _ in range(1500):
        x = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(70))]
        for _ in range(rng.randrange(3)):
            if len(x) > 8:
                p, a = rng.randrange(1, len(x) // 4 + 1), rng.randrange(len(x))
                for i in range(a + p, min(len(x), a + rng.randrange(3, 7) * p)):
                    x[i] = x[i - p]
        want = brute_runs(x)
        seen += len(want)
        assert runs.runs_of(np.array(x, np.int64)) == want
    assert seen > 500


def test_runs_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_basic_factor_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 5
    for d in docs:
        if len((d.text or "").split()) < 900:
            assert got[d.doc_id] == brute_row(d.doc_id, d.text)


def test_runs_of_odd_rows(spark, make_docs):
    texts = [None, "", " \t\n", "a", "a a a a a a", "x " + "a b\x0bc " * 5 + "y", "a " * 40000, "é é " * 7]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "b b b b b b b"), (39, "one two three four five six seven")]
    docs = make_docs(rows).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x"))
    got = runs.periodic_runs(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, tuple(map(tuple, r.runs))) for r in got) == sorted((str(i), len((t or "").encode().split()), tuple(brute_runs((t or "").encode().split()) if len(t or "") < 9999 else [(0, 40000, 1)])) for i, t in rows)
    assert {r.collapsed for r in got if r.doc_id == 5} == {"x a b c y"}
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    made = docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    by = runs.periodic_runs(made).collect()
    assert sorted((str(r.doc_id), len(r.runs)) for r in by) == sorted((str(i), brute_row(i, t)[1]) for i, t in rows if len(t or "") < 9999 or True)
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=3)


@pytest.fixture(scope="module")
def pair_of():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {v: k for k, v in tokens.byte_letters().items()}
    back = {c: i for i, c in letters.items()}

    def encode(text):
        """(A ids with byte lengths, B ids with byte lengths), or None."""
        if not text:
            return None
        x = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        want = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == want and b"".join(t for _, t in y) == want else None

    return encode


def brute_alignment(rows, encode):
    per, count = [], Counter()
    for _, text in rows:
        got, links, groups = encode(text), [], []
        if got:
            x, y = got
            ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in got]
            both = ends[0] & ends[1]
            cut = []
            for side in got:
                parts, part, at = [], [], 0
                for i, t in side:
                    part.append(i)
                    at += len(t)
                    if at in both:
                        parts.append(part)
                        part = []
                cut.append(parts)
            groups = list(zip(*cut))
            links = [(i, j) for p, q in groups for i in p for j in q]
            count.update(set(links))
        per.append((got, groups, links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for (key, _), (got, groups, links) in zip(rows, per):
        line = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((key, len(got[0]) if got else 0, len(got[1]) if got else 0, len(groups), len(links), sum(count[k] == best[k[0]] for k in links), sum(count[k] for k in links), hashlib.sha256(line.encode()).hexdigest() if got else ""))
    return out, count


def test_alignment_equals_brute_force(spark, make_docs, pair_of, monkeypatch):
    texts = [r.text for r in table(spark, SF, "documents").select("text").collect()]
    rows = [(i, t) for i, t in enumerate([*ODD, *texts[:80], *ODD])] + [(None, "The end.\nOf the word"), (None, "The end.\nOf the word")]
    want, count = brute_alignment(rows, pair_of)
    docs = make_docs(rows).withColumn("block", F.lit(1)).withColumn("pair", F.lit("x")).withColumn("n_a", F.lit(0))
    for parts, sent in ((1, alignment.SENT), (5, 0)):
        monkeypatch.setattr(alignment, "SENT", sent)
        got, counts = alignment.align(docs.repartition(parts))
        assert sorted(map(str, (tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in got.collect()))) == sorted(map(str, want))
        assert {(r.pair >> 16, r.pair & 65535): r.docs for r in counts.collect()} == count
    assert alignment.align(docs.limit(0))[0].count() == 0


def test_small_blocks_and_forgetting_workers(pair_of):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "ndtion", "éêtre", "schüß", "Zq7#", "of"]) + rng.choice(["", ",", ".\nEr"]) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    want, _ = brute_alignment(list(enumerate(texts)), pair_of)
    al = alignment.Aligner(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    got = []
    for at in range(0, 60, 7):
        if at == 28:
            al.clear()
        if at == 42:
            al.forget(5)
        block = alignment._Block(al, texts[at : at + 7])
        got += [(*s, h.hex()) for s, h in zip(block.sums, block.hashes)]
    assert got == [(*w[1:5], w[7]) for w in want]


def test_ids_equal_the_tokenizers(pair_of):
    """Both libraries and cuts into slices on texts of all kinds, runs of blanks too long for a pattern included."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    encoders = [tokens.TextEncoder(tokens.tokenizer_path(), "<u4", size) for size in (1 << 20, 50)]
    rng = random.Random(11)
    some = [" ", " ", " ", "\n", "\t", "\x85", "\xa0", "\x1c", "　", "'ll", "don't", "tion", "éà", "ß", "日", "🎉", "12", "...", "the", "Of", "\u0378", "\U0001f9ff"]
    texts = [t for t in ODD if t] + ["".join(rng.choice(some) for _ in range(rng.randrange(1, 40))) for _ in range(3000)] + [" " * 30000 + "x", "\n" * 20000, "ab " * 50_000]
    for t in texts:
        want = tok.encode(t, add_special_tokens=False).ids
        for encoder in encoders:
            assert np.frombuffer(encoder.encode(t), "<u4").tolist() == want, t[:80]
    assert encoders[0].encode("") == b""


def test_giant_groups(pair_of, monkeypatch):
    monkeypatch.setattr(alignment, "GIANT", 2)
    al = alignment.Aligner(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    texts = ["ndtion ththsb Zukeitpf eauenaux", "eauenaux eauenaux ththsb"]
    block = alignment._Block(al, texts)
    want, count = brute_alignment(list(enumerate(texts)), pair_of)
    assert [s[3] for s in block.sums] == [w[4] for w in want]
    assert {(int(p) >> 16, int(p) & 65535): int(n) for p, n in zip(block.pairs, block.held)} == count


def test_languages_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    rows = QUERIES["op11_kneser_ney_languages"](spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    known = {r.lang for r in rows if r.lang}
    lettered = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    assert {r.lang_pred for r in lettered} <= known and all(r.lang_pred == "und" and r.score == 0 for r in rows if r not in lettered)
    assert np.mean([r.lang_pred == r.lang for r in lettered if r.held_out and r.lang]) > 0.97


def brute_kneser_ney(texts, order):
    """Interpolated probability of each character after the ones before, all grams kept."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        codes, starts = langid.letters_of([t])
        seq = codes.tolist()
        for i in range(starts[0], len(seq)):
            counts[order][tuple(seq[i - order + 1 : i + 1])] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    size = len(counts[1])

    def prob(gram):
        k = len(gram)
        if k == 0:
            return 1 / (size + 1)
        c = counts[k]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = n1 / (n1 + 2 * n2) if n1 * n2 else 0.5
        after = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        lower = prob(gram[1:])
        return max(c[gram] - d, 0) / sum(after) + d * len(after) / sum(after) * lower if after else lower

    return prob


def test_model_equals_plain_kneser_ney(spark):
    texts = {"aa": ["abra cadabra abra", "cab dab!", "a  b-c"], "bb": ["dodo oddo", "böd böd", "od do 1 od"]}
    rows = spark.createDataFrame([(k, t) for k, some in texts.items() for t in some for _ in (0, 1)], "lang string, text string")
    held = {(r.lang, r.text) for r in rows.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(langid.HELD)) == 0).collect()}
    model = langid.train(rows)
    plain = {k: brute_kneser_ney([t for t in some if (k, t) not in held for _ in (0, 1)], langid.ORDER) for k, some in texts.items()}
    size = max(len({c for t in some for c in langid.letters_of([t])[0].tolist()}) for some in texts.values())
    for t in ("abra dodo", "cad", "böa zz", "od do"):
        codes, starts = langid.letters_of([t])
        keys = langid.grams(codes)[starts[0] :]
        got = 10 ** model.log_probs(keys)
        for j, k in enumerate(model.langs):
            for i, at in enumerate(range(starts[0], len(codes))):
                want = plain[k](tuple(codes[at - langid.ORDER + 1 : at + 1].tolist()))
                assert abs(got[i, j] - want) < 0.02 * want or size != len({c for x in texts[k] for c in langid.letters_of([x])[0].tolist()})
    # after any context the probabilities of all characters sum to one, also with few grams in the model
    small = langid.train(rows, most_grams=langid.ORDER * 2 * 6)
    for m in (model, small):
        chars = np.unique(np.concatenate([langid.letters_of(some)[0] for some in texts.values()]))
        base = 10.0 ** m.level[0][1][0]
        for text in ("abr", "zzz", "do"):
            context = langid.grams(langid.letters_of([text])[0])[-1] & ((1 << langid.BITS * 3) - 1)
            some = 10 ** m.log_probs((context << langid.BITS) | chars)
            left = 10 ** m.log_probs(np.array([(context << langid.BITS) | 32000]))[0]
            for j, k in enumerate(m.langs):
                own = np.isin(chars, np.unique(langid.letters_of(texts[k])[0]))
                unseen = 1 / base[j] - own.sum()  # characters that the language lacks share what is left evenly
                assert abs(some[own, j].sum() + unseen * left[j] - 1) < 1e-6


def test_languages_of_odd_rows(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(ODD)] * 2 + [(None, "the word and the end"), (99, "#!? 123")]
    docs = make_docs(rows).withColumn("best", F.lit(1)).withColumn("letters", F.lit("x"))
    got = langid.identify(docs, F.lit(True)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} == {"en", "und"}
    assert all((r.lang_pred == "und") == (r.score == 0) for r in got)
    none = langid.identify(docs, F.lit(False)).collect()
    assert len(none) == len(rows) and {(r.lang_pred, r.score, r.refused) for r in none} == {("und", 0.0, True)}
    assert langid.identify(docs.limit(0), F.lit(True)).count() == 0
    two = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x").when(F.col("doc_id") % 3 == 0, "y"))
    assert {r.lang_pred for r in langid.identify(two, F.lit(True)).collect()} <= {"x", "y", "und"}


def test_unlike_texts_are_refused(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    odd = spark.createDataFrame([(-1, "zxqv wkjq vvzx qqkz xzwv kqxj zvvk jxqz " * 20, None, None, 0)], docs.schema)
    got = langid.identify(docs.union(odd), F.col("doc_id") >= 0).filter("doc_id < 0 or not refused").collect()
    assert [r.refused for r in got if r.doc_id < 0] == [True] and len(got) > 0.85 * docs.count()
