"""Hierarchical Pitman-Yor language model: words over the word before, over all words, over their spelling.

A text is its lower-cased words and then the end, which is the empty word; the end also stands before the first word. A
word is drawn from the restaurant of the word before it. That one's parent is the restaurant of all words. A new table's
word there is drawn with equal chances from the words known and one sign for all unknown words, or else spelled: spelling
draws the signs of a word and a last sign, each from the restaurant of the three signs before. That one's parent is the
restaurant of two signs, then one, then none, down to equal chances for all signs, so contexts share parents. The
customers of a parent are the tables of its children; spelling is seated with one table per known word.

Texts are numbered in chunks, words and pairs of words live in parts of the table, and what a chunk or part tells another
is one row of packed arrays (a letter), so a pair of words is never a row of its own.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.llm.common import blank_split, stage

ORDER = 3  # signs of the longest context
BITS = 9  # of a sign: 0 before the text, byte + 1, END
END = 257
SIGNS = 257  # that can follow: 256 bytes and the end
DISCOUNT = (0.3, 0.5, 0.6, 0.7)  # by length of the context
STRENGTH = 1.0
SPELLED = 0.1  # share of new tables whose word is spelled
BURN_IN, SAMPLES = 1, 3
CHUNK = 12 << 20  # bytes of text that share one table of looked-up values; there is a part of words and pairs for each
ROW_GROUP = 8 << 20  # bytes of letters that a reader holds at once
CODE_BITS = 31  # of a word's number
LETTER = "kind string, at long, of long, x binary, y binary, z binary"  # at: chunk or part that reads it, of: the one that wrote it
AT_ONCE = 1 << 20  # signs that are worked on together
_PAIRS = 1 << 2 * BITS


def _signs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Signs of texts one after the other, each behind ORDER empty signs, and the bounds of the texts."""
    size = np.array([len(t) + 1 + ORDER for t in texts])
    stop = np.cumsum(size)
    out = np.zeros(stop[-1], np.int32)
    for t, e in zip(texts, stop):
        out[e - 1] = END
        out[e - 1 - len(t) : e - 1] = np.frombuffer(t, np.uint8)
        out[e - 1 - len(t) : e - 1] += 1
    return out, stop


def _pair_codes(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sign from the fourth on: numbers of the pair before and of the pair that it ends; the pairs by number."""
    pair = (signs[:-1] << BITS) | signs[1:]
    used = np.flatnonzero(np.bincount(pair, minlength=_PAIRS))
    number = np.zeros(_PAIRS, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    return number[pair[:-2]], number[pair[2:]], used


def _real(signs: np.ndarray) -> np.ndarray:
    return signs[ORDER:] > 0


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed runs of four signs and how often each stands."""
    signs, _ = _signs(texts)
    first, second, used = _pair_codes(signs)
    real = _real(signs)
    code = first[real].astype(np.int64) * len(used) + second[real]
    if len(used) ** 2 <= 1 << 24:
        n = np.bincount(code, minlength=1)
        code = np.flatnonzero(n)
        n = n[code]
    else:
        code, n = np.unique(code, return_counts=True)
    return (used[code // len(used)] << 2 * BITS) | used[code % len(used)], n


def _blocks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Texts in blocks of AT_ONCE bytes; a longer one is a block of its own."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t) + ORDER + 1
        if n >= AT_ONCE:
            yield held
            held, n = [], 0
    if held:
        yield held


def _pack(a: np.ndarray) -> bytes:
    """An array, its lowest bytes first, then the next ones, and so on."""
    head = a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little")
    if not len(a):
        return head
    return head + pa.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:4].strip().decode()), int.from_bytes(b[4:12], "little")
    if not n:
        return np.empty(0, kind)
    raw = pa.decompress(b[12:], n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def _gaps(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=0))


def _ungaps(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b))


def _letters(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 6
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("kind", "at", "of", "x", "y", "z"), columns, types)})


def _by_kind(table: pa.Table) -> dict[str, list[dict]]:
    """Letters by kind, in the order of those who wrote them."""
    out: dict[str, list[dict]] = defaultdict(list)
    for r in sorted(table.to_pylist(), key=lambda r: r["of"]):
        out[r["kind"]].append(r)
    return out


def _kinds(df: DataFrame, *kinds: str) -> DataFrame:
    return df.filter(F.col("kind").isin(*kinds)).select("kind", "at", "of", "x", "y", "z")


def _answer(run: Callable, *letters: DataFrame) -> DataFrame:
    """Written letters of run(reader's number, its letters by kind), for each reader."""
    every = letters[0]
    for more in letters[1:]:
        every = every.union(more)
    return stage(every.groupBy("at").applyInArrow(lambda key, table: _letters(run(key[0].as_py(), _by_kind(table))), LETTER), ROW_GROUP)


def _totals(letters: DataFrame) -> np.ndarray:
    """Sum of the few figures that each part tells."""
    rows = [_unpack(r.x) for r in letters.filter(F.col("kind") == "total").select("x").collect()]
    return np.sum(rows, axis=0) if rows else np.zeros(8, np.int64)


def _split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, ascending, with its places in their order."""
    order = np.argsort(part, kind="stable")
    used, first = np.unique(part[order], return_index=True)
    for p, at in zip(used.tolist(), np.split(order, first[1:])):
        yield p, at


def numbered_texts(docs: DataFrame, learn: Column, n_parts: int, doc_id: str, text: str, chunk: int = CHUNK) -> DataFrame:
    """Written letters of chunks of about `chunk` bytes of text: `docs` to the chunk itself, `words` to the parts of its words.

    docs: numbers of the words in the chunk (0: the end), length * 2 + learned of each text, the part of each number.
    words: the distinct words of one part, and how often each stands in texts to learn from.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def letters(at: int, number: dict, tokens: list, learned: list, ids: list, id_type: pa.DataType) -> pa.RecordBatch:
        words = list(number)
        part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n_parts
        sizes, flags, all_ = np.array(list(map(len, tokens))), np.array(learned), np.concatenate(tokens)
        c = np.bincount(all_[np.repeat(flags, sizes)], minlength=len(words))
        rows = [("docs", at, 0, _pack(all_), _pack(sizes * 2 + flags), _pack(part.astype(np.int32)))]
        rows += [("words", p, at, b" ".join([words[i] for i in own]), _pack(c[own]), None) for p, own in _split(part)]
        whose = pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * len(rows), pa.int32()), pa.array(ids, id_type))
        return _letters(rows).append_column("doc_ids", whose).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def new() -> tuple:
            number: dict = defaultdict()
            number.default_factory = number.__len__
            number[b""]
            return number, [], [], [], 0

        at, id_type = TaskContext.get().partitionId() << 20, None
        number, tokens, learned, ids, size = new()
        for b in batches:
            id_type = b.column(0).type
            for i, t, use in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                words = [*blank_split(t.as_py()), b""]
                tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                learned.append(use)
                ids.append(i)
                size += sum(map(len, words)) + len(words)
                if size >= chunk:
                    yield letters(at, number, tokens, learned, ids, id_type)
                    at += 1
                    number, tokens, learned, ids, size = new()
        if ids:
            yield letters(at, number, tokens, learned, ids, id_type)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    return stage(rows.mapInArrow(run, f"{LETTER}, doc_ids array<{kind}>"), ROW_GROUP)


def _number(p: int, got: dict) -> list[tuple]:
    """`list`: words of a part in ascending order with their counts; `numbers`: to each chunk the numbers of its words."""
    rows = got["words"]
    held = [r["x"].split(b" ") for r in rows]
    words = sorted(set().union(*held))
    number = dict(zip(words, range(len(words))))
    c, out = np.zeros(len(words), np.int64), []
    for r, own in zip(rows, held):
        j = np.fromiter(map(number.__getitem__, own), np.int32, len(own))
        c[j] += _unpack(r["y"])
        out.append(("numbers", r["of"], p, _pack(j), None, None))
    return [*out, ("list", p, 0, b" ".join(words), _pack(c), None), ("total", p, 0, _pack(np.array([c.sum(), (c > 0).sum()])), None, None)]


def _run_batches(words: list[bytes], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    for use in (True, False):
        for block in _blocks(words[i] for i in np.flatnonzero(known == use)):
            g, n = gram_counts(block)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(n if use else n * 0, pa.int64())], names=["g", "c"])


def _summed(runs: DataFrame) -> DataFrame:
    return runs.groupBy("g").agg(F.sum("c").alias("c"))


def spelling_runs(words: DataFrame) -> DataFrame:
    """words (k: b"w" and the word, c) -> (g, c): runs of four signs and how many known words hold them (0: only unknown ones do)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _run_batches([k.as_py()[1:] for k in b.column(0)], b.column(1).to_numpy() > 0)

    return _summed(words.select("k", "c").mapInArrow(run, "g long, c long"))


def listed_runs(lists: DataFrame) -> DataFrame:
    """The same of all words of letters `list`, in one step of Python, so that a task keeps one worker and not two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column(0), b.column(1)):
                yield from _run_batches(x.as_py().split(b" "), _unpack(y.as_py()) > 0)

    return _summed(lists.select("x", "y").mapInArrow(run, "g long, c long"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 3
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - np.log(x * (x + 1) * (x + 2))


def seat(c: np.ndarray, fresh: np.ndarray | Callable, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of a dish after c customers came: one opens a table with weight `fresh`, else joins with weight n - discount * tables.

    The first 16 customers come one by one, later ones in groups of a sixteenth of those seated. `fresh` may be a function of
    dishes and their tables so far. Then a choice also weighs how likely it makes the dish for the customers to come, if they
    opened no table: without that there are too many tables, as each one lowers the weight of the dish by the discount.
    """
    t = (c > 0).astype(np.int64)
    n = t.copy()
    while len(open_ := np.flatnonzero(n < c)):
        step = np.minimum(np.maximum(1, n[open_] // 16), c[open_] - n[open_])
        join = n[open_] - discount * t[open_]
        if callable(fresh):
            new = np.array(fresh(open_, t[open_]))
            later = np.flatnonzero(n[open_] + 1 < c[open_])
            i = open_[later]
            stay, go = new[later] - discount * t[i], fresh(i, t[i] + 1) - discount * (t[i] + 1)
            new[later] *= np.exp(_log_gamma(c[i] + go) - _log_gamma(n[i] + 1 + go) - _log_gamma(c[i] + stay) + _log_gamma(n[i] + 1 + stay))
        else:
            new = fresh[open_]
        t[open_] += rng.binomial(step, new / (new + join))
        n[open_] += step
    return t


def _seated(rows: DataFrame, discount: float, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            g, c, fresh = (b.column(i).to_numpy() for i in range(3))
            t = seat(c, fresh, discount, np.random.default_rng([seed, int(g[0])]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(t)], names=["g", "c", "t"])

    return rows.select("g", "c", "fresh").mapInArrow(run, "g long, c long, t long")


def _parent(level: int) -> Column:
    return F.col("g").bitwiseAND(F.lit((1 << BITS * level) - 1))


def _predictive(levels: list[DataFrame]) -> list[DataFrame]:
    """By length of the context: (g, c, p of the sign in it, fresh: weight of a new table). A context has 257 rows at most."""
    out: list[DataFrame] = []
    for k, rows in enumerate(levels):
        w = Window.partitionBy(F.shiftright("g", BITS))
        if k:
            rows = rows.withColumn("parent", _parent(k)).join(out[-1].select(F.col("g").alias("parent"), F.col("p").alias("up")), "parent")
        else:
            rows = rows.withColumn("up", F.lit(1.0 / SIGNS))
        free = F.lit(STRENGTH) + DISCOUNT[k] * F.sum("t").over(w)
        all_ = F.lit(STRENGTH) + F.sum("c").over(w)
        out.append(rows.select("g", "c", "t", (free * F.col("up")).alias("fresh"), all_.alias("all_")).select("g", "c", "fresh", ((F.col("c") - DISCOUNT[k] * F.col("t") + F.col("fresh")) / F.col("all_")).alias("p")))
    return out


def gibbs(counts: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 11) -> DataFrame:
    """counts (g, c) of all runs of four signs -> written (g, p): predictive probability averaged over the samples.

    A sweep seats every dish of every restaurant anew, longest contexts first, given the tables and parents of the sweep before.
    """
    levels = []
    for k in range(ORDER + 1):
        own = counts if k == ORDER else counts.select(_parent(k + 1).alias("g")).distinct().select("g", F.lit(0).cast("long").alias("c"))
        levels.append(own.select("g", "c", F.lit(0).cast("long").alias("t")))
    levels[ORDER] = counts.select("g", "c", F.lit(0).cast("long").alias("t"))
    flat = [x.withColumn("c", F.lit(0).cast("long")) for x in levels]  # before the first sweep all signs have equal chances
    kept = None
    for sweep in range(burn_in + samples):
        weights = _predictive(levels if sweep else flat)
        new: list[DataFrame] = [None] * (ORDER + 1)
        below = counts
        for k in range(ORDER, -1, -1):
            rows = weights[k].select("g", "fresh").join(below, "g", "left").select("g", F.coalesce("c", F.lit(0)).alias("c"), "fresh")
            new[k] = stage(_seated(rows, DISCOUNT[k], seed + 100 * sweep + k))
            if k:
                below = new[k].groupBy(_parent(k).alias("g")).agg(F.sum("t").alias("c"))
        levels = new
        if sweep >= burn_in:
            p = _predictive(levels)[ORDER].select("g", "p")
            kept = p if kept is None else kept.union(p)
    return stage(kept.groupBy("g").agg(F.avg("p").alias("p")))


def _word_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at, x in zip(b.column(0).to_pylist(), b.column(1)):
            grams: set[int] = set()
            for block in _blocks(iter(x.as_py().split(b" "))):
                grams.update(gram_counts(block)[0].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([at] * len(grams), pa.int64()), pa.array(list(grams), pa.int64())], names=["at", "g"])


def _spell(key: tuple[pa.Scalar, ...], words: pa.Table, found: pa.Table) -> pa.Table:
    """`spelled`: counts of the words of a part and the log probability that the spelling restaurants give each."""
    g, p = found.column("g").to_numpy(), found.column("p").to_numpy()
    order = np.argsort(g)
    g, lp = g[order], np.log(p[order])
    out = []
    for block in _blocks(iter(words.column("x")[0].as_py().split(b" "))):
        signs, stop = _signs(block)
        first, second, used = _pair_codes(signs)
        real = _real(signs)
        at = np.minimum(np.searchsorted(g, (used[first] << 2 * BITS) | used[second]), len(g) - 1)
        out.append(np.add.reduceat(np.where(real, lp[at], 0.0), np.concatenate(([0], stop[:-1]))))
    return _letters([("spelled", key[0].as_py(), 0, words.column("y")[0].as_py(), _pack(np.concatenate(out)), None)])


def spelled(lists: DataFrame, model: DataFrame) -> DataFrame:
    """lists of words, model (g, p) -> letters `spelled`: parts of words look their runs of signs up."""
    found = lists.select("at", "x").mapInArrow(_word_runs, "at long, g long").join(model, "g").select("at", "g", "p")
    return lists.groupBy("at").cogroup(found.groupBy("at")).applyInArrow(_spell, LETTER)


def _codes(doc: dict, numbers: list[dict], n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a chunk: order of its words by part, and by its own numbers the codes that words have everywhere."""
    part = _unpack(doc["z"])
    order = np.argsort(part, kind="stable")
    code = np.empty(len(part), np.int64)
    code[order] = np.concatenate([_unpack(r["x"]).astype(np.int64) * n_parts + r["of"] for r in numbers])
    if code.max() >> CODE_BITS:
        raise ValueError(f"more than {1 << CODE_BITS} distinct words")
    return order, code


def _pairs(doc: dict, code: np.ndarray, n_parts: int) -> tuple:
    """Of a chunk: words, lengths of texts, whether learned, distinct pairs, their first place, places of pairs, parts of pairs.

    A chunk has millions of places, so arrays that long are made one after the other and no longer held than needed.
    """
    word, size = _unpack(doc["x"]), _unpack(doc["y"])
    every = code[_before(word)]
    every <<= CODE_BITS
    every |= code[word]
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    pair, first = every[new], order[new]
    del every
    at = np.empty(len(order), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    del order, new
    mixed = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return word, size >> 1, (size & 1) > 0, pair, first, at, ((mixed >> np.uint64(33)) % np.uint64(n_parts)).astype(np.int64)


def _before(word: np.ndarray) -> np.ndarray:
    """The word before each one; the end of a text (0) stands before the next one's first word."""
    return np.concatenate((word[:0], [0], word[:-1]), dtype=word.dtype)


def _words_of(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pair >> CODE_BITS, pair & ((1 << CODE_BITS) - 1)


def _tables_to_parts(kind: str, q: int, pair: np.ndarray, tables: np.ndarray, n_parts: int) -> list[tuple]:
    """To each part of words: its words in these pairs; tables (a row per sample) that each has as word before, and as word."""
    u, w = _words_of(pair)
    code = np.unique(np.concatenate((u, w)))
    sums = [np.stack([np.bincount(np.searchsorted(code, x), weights=t, minlength=len(code)) for t in tables]).astype(np.int64) for x in (u, w)]
    return [(kind, p, q, _gaps(code[own] // n_parts), *(_pack(s[:, own].ravel()) for s in sums)) for p, own in _split(code % n_parts)]


def _add(rows: list[dict], n: int, samples: int = 1) -> np.ndarray:
    """Tables as word before and as word, by sample and word."""
    out = np.zeros((2, samples, n), np.int64)
    for r in rows:
        j = _ungaps(r["x"])
        for side, x in zip(out, ("y", "z")):
            side[:, j] += _unpack(r[x]).reshape(samples, -1)
    return out


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / max(once + 2 * twice, 1)))


def pair_counts(texts: DataFrame, numbers: DataFrame, n_parts: int) -> DataFrame:
    """Written letters of the parts of pairs.

    `pairs`: those that were learned twice or more, with their counts and tables (one at first); `places`: of each chunk's pairs, 0 if never learned, 1
    if once, else 2 + place in `pairs`; `ones` and `tables`: one table per pair that was learned once, and more often.
    """

    def tell(key: tuple[pa.Scalar, ...], docs: pa.Table, found: pa.Table) -> pa.Table:
        doc = docs.to_pylist()[0]
        _, code = _codes(doc, _by_kind(found)["numbers"], n_parts)
        _, size, learned, pair, _, at, part = _pairs(doc, code, n_parts)
        c = np.bincount(at[np.repeat(learned, size)], minlength=len(pair))
        return _letters([("pairs", q, doc["at"], _gaps(pair[own]), _pack(c[own]), None) for q, own in _split(part)])

    def count(q: int, got: dict) -> list[tuple]:
        rows = got["pairs"]
        held = [_ungaps(r["x"]) for r in rows]
        pair, at = np.unique(np.concatenate(held), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate([_unpack(r["y"]) for r in rows]), minlength=len(pair)).astype(np.int64)
        many, one = c > 1, c == 1
        place = np.where(many, 1 + np.cumsum(many), c).astype(np.int32)
        out = [("places", q, r["of"], _pack(x), None, None) for r, x in zip(rows, np.split(place[at], np.cumsum([len(h) for h in held])[:-1]))]
        out.append(("pairs", q, 0, _gaps(pair[many]), _pack(c[many]), _pack(np.ones(int(many.sum()), np.int64))))
        for kind, some in (("ones", one), ("tables", many)):
            out += _tables_to_parts(kind, q, pair[some], np.ones((1, int(some.sum())), np.int64), n_parts)
        return [*out, ("total", q, 0, _pack(np.array([one.sum(), (c == 2).sum(), many.sum()])), None, None)]

    told = texts.select("kind", "at", "of", "x", "y", "z").groupBy("at").cogroup(numbers.groupBy("at")).applyInArrow(tell, LETTER)
    return _answer(count, told)


def word_predictive(spelling: DataFrame, pairs: DataFrame, n_parts: int, distinct: int, burn_in: int, samples: int, seed: int = 5) -> tuple[DataFrame, DataFrame, float, float]:
    """Letters `spelled` and those of `pair_counts` -> letters `values` and `found`, weight of the base, discount of contexts.

    A sweep seats the restaurant of all words, whose customers are the tables of pairs, and then the pairs, given all tables
    of the sweep before; it begins with one table per pair. The samples are drawn after the burn-in, each from its last state;
    pairs that were learned once have one table in all. Discounts are n1 / (n1 + 2 * n2) of pairs learned, or words at tables, once and twice.

    values: by word the part of its probability that does not come from the base (mean of the samples), then the base; tables of the
    context (sum over the samples), then the count. found: of each chunk's pairs, counts and tables (sum over the samples).
    """
    once, twice, many = (int(x) for x in _totals(pairs)[:3])
    d_pair = _discount(once, twice)

    def settle(p: int, got: dict) -> list[tuple]:
        own = got["spelled"][0]
        base = (1 - SPELLED) / (distinct + 1) + SPELLED * np.exp(_unpack(own["y"]))
        fixed = _add(got["ones"], len(base))
        n = fixed[1, 0] + _add(got["tables"], len(base))[1, 0]
        total = ("total", p, 0, _pack(np.array([(n == 1).sum(), (n == 2).sum(), (n > 0).sum()])), None, None)
        return [("state", p, 0, own["x"], _pack(base), _pack(fixed.ravel())), total]

    state = _answer(settle, spelling, _kinds(pairs, "ones", "tables"))
    n1, n2, words = (int(x) for x in _totals(state)[:3])
    d_word = _discount(n1, n2)
    state = _kinds(state, "state")

    def seated(got: dict, before: float, sweep: int, p: int, draws: int) -> tuple[np.ndarray, ...]:
        own = got["state"][0]
        base = _unpack(own["y"])
        context, n = _unpack(own["z"]).reshape(2, 1, -1) + _add(got["tables"], len(base), draws)
        fresh = (STRENGTH + d_word * before) * base
        return base, context, n, np.stack([seat(x, lambda i, _: fresh[i], d_word, np.random.default_rng([seed, sweep, 0, k, p])) for k, x in enumerate(n)])

    def words_step(before: float, sweep: int) -> Callable:
        def run(p: int, got: dict) -> list[tuple]:
            base, context, n, t = seated(got, before, sweep, p, 1)
            out = []
            for r in got["tables"]:
                j = _ungaps(r["x"])
                out.append(("weights", r["of"], p, _pack(np.concatenate((n[0, j], t[0, j], context[0, j]))), _pack(base[j].astype(np.float32)), None))
            return [*out, ("total", p, 0, _pack(np.array([t.sum()])), None, None)]

        return run

    def pairs_step(customers: float, tables: float, sweep: int, draws: int, last: bool) -> Callable:
        def run(q: int, got: dict) -> list[tuple]:
            own = got["pairs"][0]
            pair, c = _ungaps(own["x"]), _unpack(own["y"])
            u, w = _words_of(pair)
            code = np.unique(np.concatenate((u, w)))
            order = np.argsort(code % n_parts, kind="stable")
            told = np.empty((4, len(code)))
            if len(code):
                told[:3, order] = np.concatenate([_unpack(r["x"]).reshape(3, -1) for r in got["weights"]], axis=1)
                told[3, order] = np.concatenate([_unpack(r["y"]) for r in got["weights"]])
            (n, t, _, base), mine = told[:, np.searchsorted(code, w)], _unpack(own["z"])
            room = STRENGTH + d_pair * (told[2, np.searchsorted(code, u)] - mine)
            n = n - mine
            other = (n - d_word * np.minimum(t, n) + (STRENGTH + d_word * tables) * base, n == 0)

            def fresh(i: np.ndarray, t: np.ndarray) -> np.ndarray:
                """The pair's own tables of the sweep before are taken away, those opened since count."""
                return (room[i] + d_pair * t) * (other[0][i] + t - d_word * other[1][i]) / (STRENGTH + customers)

            seats = np.stack([seat(c, fresh, d_pair, np.random.default_rng([seed, sweep, 1, k, q])) for k in range(draws)])
            out = [*_tables_to_parts("tables", q, pair, seats, n_parts), ("total", q, 0, _pack(seats.sum(axis=1)), None, None)]
            out.append(("pairs", q, 0, own["x"], own["y"], _pack(seats[0])))
            if last:
                counts, sums = np.concatenate(([0, 1], c)), np.concatenate(([0, draws], seats.sum(axis=0)))
                for r in got["places"]:
                    at = _unpack(r["x"])
                    out.append(("found", r["of"], q, _pack(counts[at]), _pack(sums[at]), None))
            return out

        return run

    places, seats, held = _kinds(pairs, "places"), _kinds(pairs, "tables"), _kinds(pairs, "pairs")
    now, before = np.array([many]), float(words)
    for sweep in range(burn_in + 1):
        last = sweep == burn_in
        told = _answer(words_step(before, sweep), state, seats)
        before = float(_totals(told)[0])
        step = pairs_step(float(once + now[0]), before, sweep, samples if last else 1, last)
        told = _answer(step, held, _kinds(told, "weights"), *[places] * last)
        seats, held, now = _kinds(told, "tables"), _kinds(told, "pairs"), _totals(told)
    customers = STRENGTH + once + now[:samples].astype(float)

    def average(p: int, got: dict) -> list[tuple]:
        base, context, n, t = seated(got, before, burn_in + 1, p, samples)
        own = ((n - d_word * t) / customers[:, None]).mean(axis=0)
        values = ("values", p, 0, _pack(np.concatenate((own, base))), _pack(np.concatenate((context.sum(axis=0), _unpack(got["state"][0]["x"])))), None)
        return [values, ("total", p, 0, _pack(t.sum(axis=1)), None, None)]

    values = _answer(average, state, seats)
    from_base = float(((STRENGTH + d_word * _totals(values)[:samples]) / customers).mean())
    return _kinds(values, "values"), _kinds(told, "found"), from_base, d_pair


def _values_to_chunks(from_base: float) -> Callable:
    """`known`: numbers of a chunk's words in this part; their probability in the restaurant of all words; counts, then tables as context."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        got = _by_kind(table)
        own, base = _unpack(got["values"][0]["x"]).reshape(2, -1)
        tables, c = _unpack(got["values"][0]["y"]).reshape(2, -1)
        p, out = own + from_base * base, []
        for r in got["numbers"]:
            j = _unpack(r["x"])
            out.append(("known", r["of"], key[0].as_py(), r["x"], _pack(p[j]), _pack(np.concatenate((c[j], tables[j])))))
        return _letters(out)

    return run


def _score_chunk(n_train: int, base_total: float, n_parts: int, discount: float, samples: int) -> Callable:
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, found: pa.Table) -> pa.Table:
        doc, got = docs.select(["at", "x", "y", "z"]).to_pylist()[0], _by_kind(found)
        order, code = _codes(doc, got["known"], n_parts)
        word, size, learned, pair, first, at, part = _pairs(doc, code, n_parts)
        p, c, tables = np.empty(len(code)), np.empty(len(code)), np.empty(len(code))
        p[order] = np.concatenate([_unpack(r["y"]) for r in got["known"]])
        c[order], tables[order] = np.concatenate([_unpack(r["z"]).reshape(2, -1) for r in got["known"]], axis=1)
        order = np.argsort(part, kind="stable")
        c_pair, t_pair = np.empty(len(pair)), np.empty(len(pair))
        c_pair[order] = np.concatenate([_unpack(r["x"]) for r in got["found"]])
        t_pair[order] = np.concatenate([_unpack(r["y"]) for r in got["found"]])
        u, w = _before(word)[first], word[first]
        score = np.log10((c_pair - discount * t_pair / samples + (STRENGTH + discount * tables[u] / samples) * p[w]) / (STRENGTH + c[u]))
        start, n = np.cumsum(size) - size, len(size)
        whose = pa.concat_arrays(docs.column("doc_ids").chunks).flatten()
        sums = [np.add.reduceat(x[where], start) for x, where in (((c > 0).astype(np.int64), word), (np.log10(c + 1.0) - base_total, word), (score, at))]
        return pa.table({"doc_id": whose, "learned": pa.array(learned), "n_tokens": pa.array(size, pa.int64()), "n_known": pa.array(sums[0], pa.int64()), "train_tokens": pa.array([n_train] * n, pa.int64()), "base_score": pa.array(sums[1]), "score": pa.array(sums[2])})

    return run


def score_texts(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", burn_in: int = BURN_IN, samples: int = SAMPLES, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score, perplexity) per input row; logarithms to base 10.

    `learn` picks the rows whose counts seat the model. Null and empty texts are the end alone; repeated rows are learned
    and scored each; rows for which `learn` is null are not learned. Without rows to learn from all signs have equal
    chances. Other columns are not read; an empty table gives no row.

    Texts are split into words once. Chunks of texts and parts of words and of pairs send each other packed arrays, so no table is broadcast
    and a word or pair that is frequent costs a place per chunk or part, not a row per occurrence.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    n_parts = size // chunk + 1
    texts = numbered_texts(docs, learn, n_parts, doc_id, text, chunk)
    words = _answer(_number, _kinds(texts, "words"))
    n_train, distinct = (int(x) for x in _totals(words)[:2])
    numbers, lists = _kinds(words, "numbers"), _kinds(words, "list")
    texts = texts.filter(F.col("kind") == "docs")
    model = gibbs(stage(listed_runs(lists)), burn_in, samples)
    pairs = pair_counts(texts, numbers, n_parts)
    values, found, from_base, discount = word_predictive(spelled(lists, model), pairs, n_parts, distinct, burn_in, samples)
    asked = numbers.select("kind", F.col("of").alias("at"), F.col("at").alias("of"), "x", "y", "z")
    known = values.union(asked).groupBy("at").applyInArrow(_values_to_chunks(from_base), LETTER)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    score = _score_chunk(n_train, float(np.log10(n_train + distinct + 1)), n_parts, discount, samples)
    out = texts.groupBy("at").cogroup(known.union(found).groupBy("at")).applyInArrow(score, schema)
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
