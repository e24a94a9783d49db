"""Language identification by interpolated Kneser-Ney models of characters."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.llm.common import stage

ORDER = 4  # characters of the longest gram
BITS = 15  # of a character in a gram
MODEL_GRAMS = 1 << 19  # grams that a model sent to every task holds, over all languages; more are looked up by a shuffle
CHUNK = 8 << 20  # characters of text that look their grams up together
HELD = 20  # one in so many training rows calibrates and is not counted
STEPS = 8  # calibration steps per unit of evidence
MOST_STEP = 400
REFUSED = 0.005  # share of rightly judged calibration rows that the limit on the cross-entropy refuses
LEAST_SCORE = 0.5  # calibrated probability below which a prediction is refused
CHARS = 1 << 20  # characters worked on at once
KEPT = 1 << 21  # grams that a counting task holds before it hands them on
MARK = "\ue000"  # stands between documents


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Character numbers by code point: letters by their code point within 15 bits, all else 0, the mark -1."""
    points = np.arange(0x110000)
    codes = np.zeros(len(points), np.int64)
    letter = np.fromiter((chr(i).isalpha() for i in range(len(points))), bool, len(points))
    codes[letter] = points[letter] % ((1 << BITS) - 1) + 1
    codes[ord(MARK)] = -1
    return codes


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts): lower-cased letters with runs of other characters as one blank; ORDER blanks before each text."""
    clean = [(t or "").replace(MARK, " ").lower() for t in texts]
    raw = (MARK * ORDER + (MARK * ORDER).join(clean)).encode("utf-32-le", "replace")
    codes = _codes()[np.frombuffer(raw, "<u4")]
    before = np.empty_like(codes)
    before[0], before[1:] = -1, codes[:-1]
    codes = codes[(codes != 0) | (before > 0)]
    marks = codes < 0
    ends = np.flatnonzero(marks[:-1] & ~marks[1:]) + 1 if len(codes) else np.zeros(0, np.int64)
    if len(ends) != len(texts):  # texts without any character left
        ends = np.flatnonzero(marks)[ORDER - 1 :: ORDER] + 1
    codes[marks] = 0
    return codes, ends


def grams(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The gram that ends at each character, `order` characters of 15 bits; before the first one stand blanks."""
    out = codes.copy()
    for back in range(1, order):
        out[back:] |= codes[:-back] << (BITS * back)
    return out


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHARS characters."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < CHARS:
            size += len(texts[stop] or "") + ORDER
            stop += 1
        yield at, stop
        at = stop


def _own(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """False at the blanks that stand before each text."""
    own = np.ones(len(codes), bool)
    for back in range(1, ORDER + 1):
        own[starts - back] = False
    return own


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over rows (lang, text): grams of ORDER characters, folded in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def fold(lang: str) -> None:
            keys, counts = (np.concatenate(x) for x in zip(*held[lang]))
            keys, of = np.unique(keys, return_inverse=True)
            held[lang] = [(keys, np.bincount(of, weights=counts).astype(np.int64))]

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in held:
                fold(lang)
                (keys, counts), = held[lang]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        for b in batches:
            by: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for at, stop in _slices(texts):
                    codes, starts = letters_of(texts[at:stop])
                    keys, counts = np.unique(grams(codes)[_own(codes, starts)], return_counts=True)
                    held.setdefault(lang, []).append((keys, counts))
                    if len(held[lang]) > 8:
                        fold(lang)
            if sum(len(k) for some in held.values() for k, _ in some) > KEPT:
                yield from flush()
        yield from flush()

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class CharModel:
    """Grams of each order as sorted hashes, with one column per language.

    level[k]: (hashes, log10 probability of the gram's last character after the others, log10 weight that the gram leaves
    to shorter ones when it is the context).
    """

    langs: list[str]
    level: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    steps: np.ndarray  # calibrated probability by step of evidence
    limit: np.ndarray  # greatest cross-entropy taken, per language

    def look_up(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Rows of the level, the last one (no such gram) for others."""
        hashes = self.level[order][0]
        wanted = _mix(keys)
        at = np.minimum(np.searchsorted(hashes, wanted), max(len(hashes) - 1, 0))
        return np.where(hashes[at] == wanted, at, len(hashes)) if len(hashes) else np.zeros(len(keys), np.int64)

    def log_probs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(len(keys), languages) log10 probability of the last character of grams of `order` characters."""
        if order == 0:
            return np.broadcast_to(self.level[0][1][0], (len(keys), len(self.langs)))
        at = self.look_up(order, keys)
        out = self.level[order][1][at]
        todo = np.isnan(out).any(1)
        if todo.any():
            short = keys[todo]
            lower = self.log_probs(short & ((1 << BITS * (order - 1)) - 1), order - 1)
            # weight of the context, a gram one shorter
            left = self.level[order - 1][2][self.look_up(order - 1, short >> BITS)] if order > 1 else self.level[0][2][[0]]
            found = out[todo]
            out[todo] = np.where(np.isnan(found), left + lower, found)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(letters, mean -log10 probability per character and language); texts without a letter have 0 letters."""
        codes, starts = letters_of(texts)
        own = _own(codes, starts)
        ends = np.append(starts[1:] - ORDER, len(codes))
        first = np.cumsum(own) - own
        sizes = ends - starts
        letters = np.cumsum(np.append(0, codes != 0))
        letters = letters[ends] - letters[starts]
        logs = self.log_probs(grams(codes)[own])
        sums = np.vstack([np.zeros((1, len(self.langs))), np.cumsum(logs, axis=0, dtype=np.float64)])
        at = np.append(first, own.sum())[np.minimum(starts, len(codes))]
        return letters, -(sums[at + sizes] - sums[at]) / np.maximum(sizes, 1)[:, None]

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """(letters, best language's number, its entropy, evidence): evidence is the lead over the next language times the root of the length."""
        letters, h = self.entropies(texts)
        best = h.argmin(1)
        own = h[np.arange(len(h)), best]
        rest = h.copy()
        rest[np.arange(len(h)), best] = np.inf
        lead = rest.min(1) - own
        return letters, best, own, np.where(np.isfinite(lead), lead, MOST_STEP) * np.sqrt(letters)


def _mix(keys: np.ndarray) -> np.ndarray:
    """A one-to-one hash of grams."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(32)


def _discounted(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Of counts (lang, gram, n) of one order: (lang, gram, n, part) with absolute discounting."""
    n1, n2 = (F.sum((F.col("n") == k).cast("long")) for k in (1, 2))
    d = counts.groupBy("lang").agg(n1.alias("n1"), n2.alias("n2"))
    d = d.select("lang", F.when(F.col("n1") * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5).alias("d"))
    context = F.shiftright("gram", BITS).alias("context") if order > 1 else F.lit(0).cast("long").alias("context")
    rows = counts.withColumn("context", context)
    total = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"))
    return rows.join(total, ["lang", "context"]).join(d, "lang").select("lang", "gram", "context", "n", ((F.col("n") - F.col("d")) / F.col("total")).alias("part"))


def _frequent(parts: DataFrame, most: int) -> DataFrame:
    """Rows of the counts that fit `most` per language, all rows of a count or none."""
    sizes = parts.groupBy("lang", "n").agg(F.count("*").alias("size"))
    down = sizes.withColumn("upto", F.sum("size").over(Window.partitionBy("lang").orderBy(F.col("n").desc())))
    return parts.join(down.filter(F.col("upto") <= most).select("lang", "n"), ["lang", "n"])


def _counted(rows: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """(counts of the longest grams, calibrating rows, languages) of rows (lang, text) without null languages."""
    rows = rows.filter(F.col("lang").isNotNull())
    held = F.pmod(F.xxhash64("text", "lang"), F.lit(HELD)) == 0
    counts = stage(count_grams(rows.filter(~held)))
    return counts, rows.filter(held), sorted(r.lang for r in counts.select("lang").distinct().collect())


def _parts(counts: DataFrame) -> tuple[list[DataFrame | None], int]:
    """(parts by order, different characters of the richest language); each shorter order counts the different characters
    that stand before its grams."""
    parts: list[DataFrame | None] = [None] * (ORDER + 1)
    for order in range(ORDER, 0, -1):
        parts[order] = _discounted(counts, order)
        if order > 1:
            mask = F.lit((1 << BITS * (order - 1)) - 1)
            counts = stage(counts.groupBy("lang", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count("*").alias("n")))
    return parts, max(r.v for r in counts.groupBy("lang").agg(F.count("*").alias("v")).collect())


def train(rows: DataFrame, most_grams: int = MODEL_GRAMS) -> CharModel:
    """Bounded model of rows (lang, text) without null languages, for use on its own; `identify` cuts nothing. Counts
    cover all rows but the calibrating ones.

    Only the most frequent grams of each order enter the model (`most_grams` over all languages and orders); what they
    leave is the weight of the shorter gram, so probabilities still sum to one. No row: a model without languages.
    """
    counts, held, langs = _counted(rows)
    if not langs:
        return CharModel([], [], np.zeros(0), np.zeros(0))
    share = max(1, most_grams // (ORDER * len(langs)))
    parts, size = _parts(counts)
    cut = [None if p is None else _frequent(p, share).select("lang", "gram", "context", "part").toArrow() for p in parts]  # share * len(langs) rows each
    model = assemble(langs, {lang: i for i, lang in enumerate(langs)}, cut, size)
    _calibrate(model, held, lambda r, key: judge_rows(r, model, key))
    return model


Judge = Callable[[DataFrame, str], DataFrame]


def learn_all(rows: DataFrame, most_sent: int = MODEL_GRAMS) -> tuple[CharModel, Judge | None]:
    """(model, how it judges rows by a key) of all grams. Up to `most_sent` grams go to every task; beyond that texts look
    their grams up by a shuffle, with the same results, and `model` holds languages and calibration only."""
    counts, held, langs = _counted(rows)
    if not langs:
        return CharModel([], [], np.zeros(0), np.zeros(0)), None
    number = {lang: i for i, lang in enumerate(langs)}
    parts, size = _parts(counts)
    table = stage(reduce(DataFrame.unionByName, [p.select(F.lit(k).alias("order"), "lang", "gram", "context", "part") for k, p in enumerate(parts) if p is not None]))
    if table.count() <= most_sent:
        whole = table.toArrow()
        model = assemble(langs, number, [None, *(whole.filter(pc.equal(whole["order"], k)) for k in range(1, ORDER + 1))], size)
        judge: Judge = lambda r, key: judge_rows(r, model, key)
    else:
        model = CharModel(langs, [], np.zeros(0), np.full(len(langs), np.inf))
        taken = table.groupBy("order", "lang", "context").agg(F.sum("part").alias("part"))
        looked_up = stage(table.select("order", F.lit(False).alias("is_context"), "lang", F.col("gram").alias("key"), "part").unionByName(taken.select("order", F.lit(True).alias("is_context"), "lang", F.col("context").alias("key"), "part")))
        judge = lambda r, key: judge_by_chunks(r, looked_up, langs, size, key)
    _calibrate(model, held, judge)
    return model, judge


def assemble(langs: list[str], number: dict[str, int], parts: list[pa.Table], size: int, contexts: list[pa.Table] | None = None) -> CharModel:
    """Final probabilities, shortest grams first. `contexts` (lang, context, part) holds what each context gives to its
    grams, where `parts` are only some of these."""
    n = len(langs)
    uniform = np.full((1, n), -np.log10(size + 1))
    model = CharModel(langs, [(np.zeros(0, np.uint64), uniform, np.zeros((1, n)))], np.zeros(0), np.full(n, np.inf))
    for order in range(1, ORDER + 1):
        lang = np.array([number[x] for x in parts[order]["lang"].to_pylist()], np.int64)
        gram, context, part = (parts[order][c].to_numpy() for c in ("gram", "context", "part"))
        of_parts = (lang, part)
        if contexts is not None:
            c = contexts[order]
            of_parts = (np.array([number[x] for x in c["lang"].to_pylist()], np.int64), c["part"].to_numpy())
            context = c["context"].to_numpy()
        # weight left by each context, into the level below
        low_hash, low_log, _ = model.level[order - 1]
        used = np.ones((len(low_log), n))
        known, of = np.unique(context, return_inverse=True)
        at = model.look_up(order - 1, known) if order > 1 else np.zeros(len(known), np.int64)
        taken = np.zeros((len(known), n))
        np.add.at(taken, (of, of_parts[0]), of_parts[1])
        missing = at == len(low_hash) if order > 1 else np.zeros(len(known), bool)
        if missing.any():  # contexts whose own gram is not in the model: rows with the weight only
            hashes = np.concatenate([low_hash, _mix(known[missing])])
            logs = np.vstack([low_log[:-1], np.full((missing.sum(), n), np.nan), low_log[-1:]])
            line = np.argsort(hashes)
            low_hash, low_log = hashes[line], logs[np.append(line, len(line))]
            model.level[order - 1] = (low_hash, low_log, np.zeros((len(low_log), n)))
            at = model.look_up(order - 1, known)
            used = np.ones((len(low_log), n))
        used[at] = np.maximum(1 - taken, 1e-9)
        model.level[order - 1] = (low_hash, low_log, np.log10(used))
        # probabilities of this level: the part of its own and what the context leaves to the shorter gram
        keys, of = np.unique(gram, return_inverse=True)
        own = np.zeros((len(keys), n))
        own[of, lang] = part
        left = model.level[order - 1][2][model.look_up(order - 1, keys >> BITS)] if order > 1 else model.level[0][2][[0]]
        lower = model.log_probs(keys & ((1 << BITS * (order - 1)) - 1), order - 1)
        logs = np.log10(own + 10 ** (left + lower))
        hashes = _mix(keys)
        line = np.argsort(hashes)
        model.level.append((hashes[line], np.vstack([logs[line], np.full((1, n), np.nan)]), np.zeros((len(keys) + 1, n))))
    return model


def _calibrate(model: CharModel, rows: DataFrame, judge: Judge) -> None:
    """Probability of being right by evidence, never falling with it, and the cross-entropy that few right rows exceed."""
    judged = judge(rows.withColumn("own", F.col("lang")), "own")
    step = F.least(F.floor(F.col("evidence") * STEPS), F.lit(MOST_STEP)).cast("int").alias("step")
    judged = stage(judged.filter("letters > 0").select(step, F.col("best").alias("lang"), (F.col("best") == F.col("own")).cast("int").alias("right"), F.ceil(F.col("entropy") * 50).alias("bin")))
    by_step = {r.step: (r.right, r.all) for r in judged.groupBy("step").agg(F.sum("right").alias("right"), F.count("*").alias("all")).collect()}
    blocks: list[list[float]] = []  # pooled neighbours: right, all, steps
    for s in range(MOST_STEP + 1):
        right, every = by_step.get(s, (0, 0))
        blocks.append([right, every, 1])
        while len(blocks) > 1 and (not blocks[-2][1] or not blocks[-1][1] or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    model.steps = np.maximum.accumulate(np.concatenate([np.full(int(n), (right + 1) / (every + 2)) for right, every, n in blocks]))
    bins = judged.filter("right = 1").groupBy("lang", "bin").agg(F.count("*").alias("n"))
    over = F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("bin").desc()))
    every = F.sum("n").over(Window.partitionBy("lang"))
    ends = bins.select("lang", "bin", over.alias("over"), every.alias("every")).filter(F.col("over") > REFUSED * F.col("every")).groupBy("lang").agg(F.max("bin").alias("bin")).collect()
    for r in ends:
        model.limit[model.langs.index(r.lang)] = r.bin / 50


def _judged(m: CharModel, name: str, keys: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
    names = np.array(m.langs, object)
    for at, stop in _slices(texts):
        letters, best, entropy, evidence = m.judge(texts[at:stop])
        none = letters == 0
        yield pa.RecordBatch.from_arrays(
            [keys.slice(at, stop - at), pa.array(letters, pa.int64()), pa.array(names[best], pa.string(), mask=none), pa.array(entropy, pa.float64(), mask=none), pa.array(evidence, pa.float64(), mask=none)],
            names=[name, "letters", "best", "entropy", "evidence"],
        )


def judge_rows(rows: DataFrame, model: CharModel, key: str, text: str = "text") -> DataFrame:
    """(key, letters, best, entropy, evidence) of each row; best is null where the text has no letter."""
    name, kind = key, rows.schema[key].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)  # MODEL_GRAMS bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _judged(shared.value, name, b.column(0), b.column(1).to_pylist())

    return rows.select(F.col(key).alias(name), F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{name}` {kind}, letters long, best string, entropy double, evidence double")


def _wanted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Grams of each order, and their contexts, that the texts of a chunk ask for."""
    texts, found = table["text"].to_pylist(), np.zeros(0, np.int64)
    for at, stop in _slices(texts):
        codes, starts = letters_of(texts[at:stop])
        found = np.union1d(found, grams(codes)[_own(codes, starts)])
    out = []
    for order in range(ORDER, 0, -1):
        found = np.unique(found & ((1 << BITS * order) - 1))
        out += [(order, False, found), (order, True, np.unique(found >> BITS) if order > 1 else np.zeros(1, np.int64))]
    n = [len(k) for _, _, k in out]
    return pa.table({"chunk": pa.array([key[0].as_py()] * sum(n), pa.int64()), "order": pa.array(np.repeat([o for o, _, _ in out], n), pa.int32()), "is_context": pa.array(np.repeat([c for _, c, _ in out], n)), "key": pa.array(np.concatenate([k for _, _, k in out]), pa.int64())})


def judge_by_chunks(rows: DataFrame, grams_of: DataFrame, langs: list[str], size: int, key: str, text: str = "text") -> DataFrame:
    """As `judge_rows`, for a model (order, is_context, lang, key, part) of any size: chunks of texts fetch the rows that
    they ask for and judge by these."""
    kind, number = rows.schema[key].dataType.simpleString(), {lang: i for i, lang in enumerate(langs)}
    own = rows.select(F.col(key).alias("name"), F.col(text).cast("string").alias("text"))
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    own = own.select(F.pmod(F.xxhash64("name", "text"), F.lit(chars // CHUNK + 1)).alias("chunk"), "name", "text")
    found = own.groupBy("chunk").applyInArrow(_wanted, "chunk long, order int, is_context boolean, key long").join(grams_of, ["order", "is_context", "key"])

    def run(chunk: tuple[pa.Scalar, ...], docs: pa.Table, table: pa.Table) -> pa.Table:
        of = lambda k, c: table.filter(pc.and_(pc.equal(table["order"], k), pc.equal(table["is_context"], c)))
        parts = [None, *(of(k, False).rename_columns({"key": "gram"}) for k in range(1, ORDER + 1))]
        parts = [p and p.append_column("context", pc.shift_right(p["gram"], BITS) if k > 1 else pa.array(np.zeros(len(p), np.int64))) for k, p in enumerate(parts)]
        contexts = [None, *(of(k, True).rename_columns({"key": "context"}) for k in range(1, ORDER + 1))]
        m = assemble(langs, number, parts, size, contexts)
        return pa.Table.from_batches(_judged(m, "name", docs["name"].combine_chunks(), docs["text"].to_pylist()), pa.schema([docs.schema.field("name"), ("letters", pa.int64()), ("best", pa.string()), ("entropy", pa.float64()), ("evidence", pa.float64())]))

    found = found.select("chunk", "order", "is_context", "lang", "key", "part")
    out = own.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, f"name {kind}, letters long, best string, entropy double, evidence double")
    return out.withColumnRenamed("name", key)


def identify(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most_grams: int = MODEL_GRAMS) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, refused): the language of least cross-entropy per character, one row per row.

    `learn` marks the rows whose text and non-null language are learned. `score` is the calibrated probability of the
    prediction; `refused` marks predictions below `LEAST_SCORE` and texts less like their language than nearly all that
    were rightly judged. Null and empty texts and texts without a letter are `und` with score 0, and so is every text when
    nothing could be learned. All grams are learned; more than `most_grams` are looked up by a shuffle. Ties of entropy go to the first language by name. Long texts are judged whole; repeated rows
    are learned and judged each; a null doc_id stays null; other columns are not read; an empty table gives no row.
    """
    model, judge = learn_all(docs.filter(learn).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")), most_grams)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if not model.langs:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("refused"))
    judged = judge(rows, "doc_id")
    steps = F.array(*[F.lit(float(x)) for x in model.steps])
    score = F.get(steps, F.least(F.floor(F.col("evidence") * STEPS), F.lit(MOST_STEP)).cast("int"))
    limits = F.create_map(*[x for name, v in zip(model.langs, model.limit.tolist()) for x in (F.lit(name), F.lit(v))])
    return judged.select(
        "doc_id",
        F.coalesce("best", F.lit("und")).alias("lang_pred"),
        F.when(F.col("best").isNotNull(), score).otherwise(0.0).alias("score"),
        "entropy",
    ).withColumn("refused", F.coalesce((F.col("score") < LEAST_SCORE) | (F.col("entropy") > F.get(F.array(limits), F.lit(0))[F.col("lang_pred")]), F.lit(True)))
