"""SimHash near-duplicates by deletion-variant signatures."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import blank_split, rows_with_uid, spare, stage
from chargelens.llm.components import components

BITS = 64
SHINGLE = 4
DISTANCE = 4
HASH_SEED = 42
BLOCK = 4096  # fingerprints of one bucket that are compared at once; larger buckets are split into pairs of blocks
HASHED_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = HASH_SEED) -> int:
    """Unsigned 64-bit SimHash over word shingles, repeats included; no words: 0."""
    words = blank_split(text)
    if not words:
        return 0
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    ends = starts + size
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    h = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), HASHED_AT_ONCE):
        got = np.array([h(flat[a:b], seed) for a, b in zip(first[at : at + HASHED_AT_ONCE], last[at : at + HASHED_AT_ONCE])], "<u8")
        ones += np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(key, fp long): one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"key {kind}, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """Fewest segments of which one must differ by at most one bit: `distance` bits in n segments, n > distance / 2."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def variants(fp: Column, distance: int = DISTANCE) -> Column:
    """Array of signatures: each segment with each one of its bits wiped. Two fingerprints within `distance` share one."""
    out = []
    for lo, hi in _segments(distance):
        segment = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        for bit in range(lo, hi):
            mask = segment & ~(1 << bit)
            signed = mask - (1 << 64) if mask >> 63 else mask
            out.append(F.struct(F.lit(bit).cast("int").alias("bit"), fp.bitwiseAND(F.lit(signed)).alias("seg")))
    return F.array(*out)


def forest(fp: np.ndarray, distance: int, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all links within `distance` connect, found breadth first: at most one per fingerprint."""
    values = fp if other is None else np.concatenate([fp, other])
    todo = np.ones(len(values), bool)
    a, b = [], []
    for start in range(len(values)):
        if not todo[start]:
            continue
        todo[start] = False
        left = np.flatnonzero(todo)
        queue = [start]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= distance
            if near.any():
                hit = left[near]
                left = left[~near]
                todo[hit] = False
                a.append(np.full(len(hit), values[at]))
                b.append(values[hit])
                queue.extend(hit.tolist())
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def _link_buckets(distance: int):
    """Sorted rows (bit, seg, left, right, fp, side) -> links (a, b), one bucket or pair of blocks after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in now[:4]], axis=0)) + 1
            done = new[-1] if len(new) else 0  # the last bucket may go on
            rest = [x[done:] for x in now]
            yield from _emit([x[:done] for x in now], new[:-1], distance)
        if rest is not None and len(rest[0]):
            yield from _emit(rest, np.empty(0, np.int64), distance)

    return run


def _emit(cols: list[np.ndarray], cuts: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    if not len(cols[0]):
        return
    bounds = np.concatenate(([0], cuts, [len(cols[0])]))
    size = np.diff(bounds)
    fp = cols[4].view(np.uint64)
    pairs = bounds[:-1][size == 2]
    near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= distance
    found = [(fp[pairs[near]], fp[pairs[near] + 1])]
    for i in np.flatnonzero(size > 2):
        found.append(forest(fp[bounds[i] : bounds[i + 1]], distance))
    a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fps: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) within `distance` that connect all that such links connect.

    Every fingerprint meets every other one of its bucket: a bucket above `block` is cut into blocks, and each pair of
    blocks is a bucket of its own.
    """
    keyed = fps.select("fp", F.explode(variants(F.col("fp"), distance)).alias("v")).select("v.bit", "v.seg", "fp")
    hot = stage(keyed.groupBy("bit", "seg").count().filter(F.col("count") > block).select("bit", "seg", F.ceil(F.col("count") / block).cast("int").alias("n")))
    part = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    dealt = (
        keyed.join(hot, ["bit", "seg"], "left")
        .withColumn("p", F.when(F.col("n").isNotNull(), part).otherwise(F.lit(0)))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n"), F.lit(1)) - 1)))
        .select("bit", "seg", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "fp")
    )
    sorted_ = dealt.repartition("bit", "seg", "i", "j").sortWithinPartitions("bit", "seg", "i", "j")
    return sorted_.mapInArrow(_link_buckets(distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Input rows' (uid, doc_id, fp long, root long, component_id).

    `uid` numbers the rows, `root` is the least fingerprint reachable and names the group, `component_id` its least
    doc_id. Null or empty texts and texts without words have fingerprint 0 and link like any other. Repeated rows each
    keep a row; rows with a null doc_id take part, and a group of such rows only has a null component_id. Other columns
    are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumn("key", F.struct("uid", "doc_id"))
    found = stage(fingerprints(rows, "key", "text", shingle).select("key.uid", "key.doc_id", "fp"))
    return _grouped(found, distance)


def _grouped(found: DataFrame, distance: int) -> DataFrame:
    own = stage(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(own.select("fp"), distance))
    named = own.join(roots, own.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stage(named)
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(heads, "root").select("fp", "root", "component_id")
    return found.join(classes, "fp").select("uid", "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group, with its own columns: the least doc_id (nulls last), then the first row as written."""
    uid = spare(docs, "_row_uid")
    rows = rows_with_uid(docs, uid)
    keyed = rows.select(F.struct(F.col(uid).alias("uid"), F.col(doc_id).alias("doc_id")).alias("key"), F.col(text).alias("text"))
    found = stage(fingerprints(keyed, "key", "text", shingle).select("key.uid", "key.doc_id", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    heads = _grouped(found, distance).groupBy("root").agg(F.min(order).alias("head")).select(F.col("head.uid").alias(uid))
    return rows.join(heads.hint("merge"), uid, "left_semi").drop(uid)  # most rows stay, so their numbers are not broadcast
