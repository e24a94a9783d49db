"""Benchmark decontamination by winnowing; DataFrame functions only."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import alnum_words, spare, stage

SPAN = 13  # words; every shared span of so many words is found
PERCENT = 5
KEYS_SENT = 500_000  # text keys of 64 bytes that are sent to every task rather than texts to the keys


def _chosen(grams: Column, width: int) -> Column:
    """Positions (from 0) of the leftmost least hash of each window; of a run of equal hashes each window marks its own first."""
    windows = F.size(grams) - width + 1

    def least(s: Column) -> Column:
        part = F.slice(grams, s, width)
        return (s + F.array_position(part, F.array_min(part)) - 2).cast("int")

    return F.when(windows >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), windows), least))).otherwise(F.array().cast("array<int>"))


def _stretches(df: DataFrame, name: str, width: int, join: Callable[[Column, Column], Column], keep: list[str]) -> DataFrame:
    """Array `name` with `join` over each stretch of `width` neighbours, null where there are fewer.

    Two stretches that meet or overlap make up a longer one, so there are log2(width) steps. Each is a column of its own:
    written into one expression, a step would be worked out anew for every element of the next.
    """
    have = 1
    while have < width:
        step = min(have, width - have)
        starts = F.sequence(F.lit(0), F.size(name) - (step + 1))
        df = df.select(*keep, F.when(F.size(name) > step, F.transform(starts, lambda i: join(F.get(F.col(name), i), F.get(F.col(name), i + step)))).alias(name))
        have += step
    return df


def _grams(df: DataFrame, span: int, keep: list[str]) -> DataFrame:
    """(keep..., g) of a frame with `words`: hashes of all runs of half of `span` words, null where there are fewer."""
    hashes = df.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("g"))
    return _stretches(hashes, "g", (span + 1) // 2, lambda a, b: F.xxhash64(a, b), keep)


def _least_hashes(df: DataFrame, span: int, keep: list[str]) -> DataFrame:
    """(keep..., hash): the hashes that `_fingerprints` gives, without their places."""
    least = _stretches(_grams(df, span, keep), "g", span - (span + 1) // 2 + 1, F.least, keep)
    # explode_outer: a filter before it, also the one that explode adds, would work the steps out again for every element
    return least.select(*keep, F.explode_outer(F.array_distinct("g")).alias("hash")).filter(F.col("hash").isNotNull())


def _fingerprints(df: DataFrame, span: int, keep: list[str]) -> DataFrame:
    """(keep..., pos, hash) of a frame with `words`: the least k-gram hash of each window of k-grams that make up `span` words.

    A window's choice follows from its words alone, so two texts that share `span` words share a choice.
    """
    chosen = _grams(df, span, keep).select(*keep, "g", _chosen(F.col("g"), span - (span + 1) // 2 + 1).alias("p"))
    placed = chosen.select(*keep, F.explode_outer(F.transform("p", lambda p: F.struct(p.alias("pos"), F.get(F.col("g"), p).alias("hash")))).alias("f"))
    return placed.select(*keep, "f.pos", "f.hash").filter(F.col("pos").isNotNull())


def few_keys(keys: DataFrame) -> DataFrame:
    """A written table of text keys, broadcast where it has at most KEYS_SENT rows, else joined as the planner likes."""
    return F.broadcast(keys) if keys.count() <= KEYS_SENT else keys


def _windows(words: Column, starts: Column, span: int) -> Column:
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.array_join(F.slice(words, s + 1, span), " ").alias("window")))


def benchmark_windows(items: DataFrame, item_id: str, text: str, span: int) -> DataFrame:
    """(item, n, window): windows of `span` words, or the whole item where it has fewer; items without words have none."""
    words = items.select(F.col(item_id).cast("string").alias("item"), alnum_words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(span))
    starts = F.sequence(F.lit(0), F.size("words") - n)
    return (
        words.select("item", n.alias("n"), F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, n), " "))).alias("window"))
        .distinct()
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, percent: int = PERCENT) -> DataFrame:
    """Each input row's (doc_id, text_key, n_words, n_hit, n_items, items, contaminated).

    Text is folded by its SHA-256 while hits are sought, so copies are extended once. A fingerprint hit is extended to
    every window of `span` words around it and checked word for word against the windows of the benchmark. Items of
    fewer words are one window and get a winnowing of their own length. Null texts and texts without words have no hit;
    repeated rows and null ids each keep a row; items with a null id count only for hit words; an empty benchmark hits
    nothing; an empty table gives no row. Texts are read whole, however long. Other columns are not read.
    """
    windows = stage(benchmark_windows(items, item_id, item_text, span))
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most `span` numbers
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.sha2("text", 256))
    read = base.select("doc_id", "text_key", alnum_words(F.col("text")).alias("words"))
    counted = read.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    hits = None
    for n in lengths:
        own = windows.filter(F.col("n") == n)
        marks = stage(_least_hashes(own.select(F.split("window", " ").alias("words")), n, []).distinct())
        # candidates: texts with a fingerprint that the benchmark has, and then its places in them
        keys = stage(_least_hashes(read.select("text_key", "words"), n, ["text_key"]).join(marks, "hash", "left_semi").select("text_key").distinct())
        texts = stage(base.select("text_key", "text").join(few_keys(keys), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text")))
        split = texts.select("text_key", alnum_words(F.col("text")).alias("words"))
        k = (n + 1) // 2
        spots = _fingerprints(split, n, ["text_key"]).join(marks, "hash", "left_semi").groupBy("text_key").agg(F.collect_set("pos").alias("at"))
        both = split.join(spots, "text_key").select("text_key", "at", "words")
        last = F.size("words") - n
        starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(F.greatest(p - (n - k), F.lit(0)), F.least(p, last)))))
        cut = both.select("text_key", F.explode(_windows(F.col("words"), starts, n)).alias("w")).select("text_key", "w.start", "w.window")
        kept = stage(cut.join(own.select("window").distinct(), "window", "left_semi").select("text_key", "start", "window", F.lit(n).alias("n")))
        hits = kept if hits is None else hits.union(kept)
    if hits is None:
        none = F.lit(0).cast("long")
        return counted.select("doc_id", "text_key", "n_words", none.alias("n_hit"), none.alias("n_items"), F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    covered = (
        hits.groupBy("text_key")
        .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))).alias("spans"))
        .select(
            "text_key",
            F.aggregate(
                "spans",
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
                lambda acc, s: F.struct((acc["n"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["upto"]), F.lit(0))).alias("n"), F.greatest(acc["upto"], s["stop"]).alias("upto")),
            )["n"].alias("n_hit"),
        )
    )
    items_of = hits.select("text_key", "window").distinct().join(windows.select("window", "item"), "window").groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = stage(covered.join(items_of, "text_key", "left"))
    n_hit, items_ = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    out = counted.join(found, "text_key", "left").select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"), items_.alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(100) * F.col("n_hit") >= F.lit(percent) * F.col("n_words")))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of `docs`, with their own columns, that are not contaminated. Rows with null or empty texts stay; an empty
    table stays empty, and an empty benchmark keeps all; copies are judged once and kept or dropped together."""
    judged = decontaminate(docs, items, text=text, **how)
    key = spare(docs, "_text_key")
    other = spare(docs, "_bad_key")
    bad = stage(judged.filter("contaminated").select(F.col("text_key").alias(other)).distinct())
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    return keyed.join(few_keys(bad), keyed[key] == bad[other], "left_anti").drop(key)
