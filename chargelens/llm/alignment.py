"""Alignment of two tokenizers' ids over a corpus, with an identity map for tokens of the same bytes."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import stage
from chargelens.llm.tokens import ByteBPE, units

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 3 << 20  # texts that one block of documents holds
UNITS, KEPT = 300_000, 150_000  # units a worker holds between blocks, some 250 bytes each, and those it keeps when there are more
CHUNK, AT_ONCE = 2000, 8  # words encoded as one text, and such texts encoded at once
SENT = 2_000_000  # different pairs whose totals every task may get, 16 bytes each
ROW_GROUP = 16 << 20  # bytes of the stored blocks that are read at once
GIANT = 4096  # pairs of a group above which its ids are counted before they are paired
CUT = re.compile(r"(?<=\S)(?= \S)")
BITS = 16  # of a B id in a pair


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process, so later tasks find the units of earlier ones."""
    return Aligner(a_path, b_path)


def _first_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _spread(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + lengths[0] - 1, first[1] .. and so on."""
    return np.arange(lengths.sum()) + np.repeat(first - _first_of(lengths), lengths)


class Aligner:
    """Ids, groups and links of units.

    A unit is a stretch of " " + text that both vocabularies always cut at its ends: A's splitting rule starts a piece at
    a lone blank and around a lone line feed, and no piece of B goes on over a blank or a line feed. So the alignment of a
    text is that of its units, and each different unit is aligned once. Units: "word" (its blank left out), "\\nword", and
    "\\1" + any other stretch as it stands.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = ByteBPE(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        a_bytes = self.a.bytes
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (a_bytes, b_bytes))
        by_bytes = {x: i for i, x in reversed(list(enumerate(b_bytes))) if x and not self.b.is_byte(i)}
        by_bytes = {x: i for i, x in enumerate(b_bytes) if self.b.is_byte(i)} | by_bytes
        #: B id of the same bytes for each A id, or -1
        self.same = np.array([by_bytes.get(x, -1) if x else -1 for x in a_bytes], np.int64)
        self.a_blank, self.b_blank = (np.array([x[:1] == b" " for x in v]) for v in (a_bytes, b_bytes))
        self.a_feed, self.b_feed = (np.array([x == b"\n" for x in v]) for v in (a_bytes, b_bytes))
        self.feed_alone = not any(b"\n" in x and x != b"\n" for x in b_bytes)
        if any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces):
            raise ValueError("pieces of B go on over a blank, so texts cannot be cut there")
        # names of ids by their place in a group: inside it, or last of their side
        self.a_names = [np.array([f"{i}{c}" for i in range(len(a_bytes))], object) for c in ",|"]
        self.b_names = [np.array([f"{i}{c}" for i in range(len(b_bytes))], object) for c in ",;"]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.stats = np.zeros((0, 5), np.int32)  # A ids, B ids, groups, links, aligned (0 or 1)
        self.n_pairs = np.zeros(0, np.int32)
        self.pairs = np.zeros(0, np.uint32)
        self.times = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int32)  # blocks that held the unit

    def forget(self, kept: int) -> None:
        """Drops all but the units that most blocks held."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:kept])
        names = list(self.known)
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.groups = [self.groups[i] for i in keep.tolist()]
        sizes = self.n_pairs.astype(np.int64)
        taken = _spread(_first_of(sizes)[keep], sizes[keep])
        self.pairs, self.times = self.pairs[taken], self.times[taken]
        self.stats, self.n_pairs, self.uses = self.stats[keep], self.n_pairs[keep], self.uses[keep] // 2

    def cut(self, text: str) -> list[str]:
        """Units of " " + text, for a text that is not empty."""
        plain = units(text) if self.feed_alone else None
        return ["\1" + u for u in CUT.split(" " + text)] if plain is None or "▁" in text else plain

    def learn(self, wanted: set[str]) -> None:
        """Aligns units not known yet."""
        new = list(wanted.difference(self.known))
        feeds = [u for u in new if u[0] == "\n"]
        others = [u for u in new if u[0] == "\1"]
        words = [u for u in new if u[0] not in "\n\1"]
        found = []
        step = CHUNK * AT_ONCE
        for some, blank, a_first, b_first in ((words, " ", self.a_blank, self.b_blank), (feeds, "", self.a_feed, self.b_feed)):
            for at in range(0, len(some), step):
                parts = [some[i : i + CHUNK] for i in range(at, min(at + step, len(some)), CHUNK)]
                others += self._align(parts, [blank + blank.join(p) for p in parts], [blank.join(p) for p in parts], a_first, b_first, found)
        for at in range(0, len(others), step):
            some = others[at : at + step]
            raw = [u[1:] if u[0] == "\1" else u if u[0] == "\n" else " " + u for u in some]
            self._align([[u] for u in some], raw, [r.removeprefix(" ") for r in raw], None, None, found)
        if found:
            self.stats, self.n_pairs, self.pairs, self.times = (np.concatenate(x) for x in zip((self.stats, self.n_pairs, self.pairs, self.times), *found))
            self.uses = np.append(self.uses, np.zeros(len(self.n_pairs) - len(self.uses), np.int32))

    def _align(self, parts: list[list[str]], a_texts: list[str], b_texts: list[str], a_first: np.ndarray | None, b_first: np.ndarray | None, found: list) -> list[str]:
        """Adds the units of each part, encoded as one text; returns those of parts that do not come out as their own bytes.

        Without `a_first` each part is one unit, and a unit whose bytes differ counts as not aligned.
        """
        left, failed, units, a_all, b_all, a_heads, b_heads = [], [], [], [], [], [], []
        b_ids = self.b.encode(b_texts, num_threads=1) if b_texts else []
        for part, raw, a, b in zip(parts, a_texts, map(self.a.ids, a_texts), b_ids):
            if raw[:1] != " " and b:
                b = b[1:] if self.b_bytes[b[0]] == b" " else [0]  # the blank that B adds is not part of a unit after a feed
            right = raw.encode()
            fits = b"".join(map(self.a_bytes.__getitem__, a)) == right and b"".join(map(self.b_bytes.__getitem__, b)) == right
            a, b = np.array(a, np.int32), np.array(b, np.int32)
            if a_first is None:
                if not fits:
                    failed += part
                    continue
                a_head, b_head = np.arange(len(a)) == 0, np.arange(len(b)) == 0
            else:
                a_head, b_head = a_first[a], b_first[b]
                if not fits or a_head.sum() != len(part) or b_head.sum() != len(part):
                    left += part
                    continue
            units += part
            a_all.append(a)
            b_all.append(b)
            a_heads.append(a_head)
            b_heads.append(b_head)
        if units:
            found.append(self._add(units, *(np.concatenate(x) for x in (a_all, b_all, a_heads, b_heads))))
        if failed:
            n = len(failed)
            self.known.update(zip(failed, range(len(self.known), len(self.known) + n)))
            self.groups += [""] * n
            found.append((np.zeros((n, 5), np.int32), np.zeros(n, np.int32), self.pairs[:0], self.times[:0]))
        return left

    def _add(self, units: list[str], a: np.ndarray, b: np.ndarray, a_head: np.ndarray, b_head: np.ndarray) -> tuple[np.ndarray, ...]:
        """Numbers the units, keeps the names of their groups, and returns their rows of stats, n_pairs, pairs and times."""
        n = len(units)
        a, b = a.astype(np.int64), b.astype(np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_last = np.isin(a_end, b_end, assume_unique=True, kind="sort")  # last A id of a group
        b_last = np.isin(b_end, a_end, assume_unique=True, kind="sort")
        a_of, b_of = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last  # group of each id
        n_groups = int(a_last.sum())
        na, nb = np.bincount(a_of, minlength=n_groups), np.bincount(b_of, minlength=n_groups)
        unit_of = (np.cumsum(a_head) - 1)[a_last]  # unit of each group
        per_unit = np.bincount(unit_of, minlength=n)
        # names in the order A ids, B ids of each group
        names = np.empty(len(a) + len(b), object)
        names[np.arange(len(a)) + _first_of(nb)[a_of]] = np.where(a_last, self.a_names[1][a], self.a_names[0][a])
        names[np.arange(len(b)) + np.cumsum(na)[b_of]] = np.where(b_last, self.b_names[1][b], self.b_names[0][b])
        stops = np.cumsum(np.bincount(unit_of, weights=na + nb, minlength=n).astype(np.int64)).tolist()
        flat = names.tolist()
        self.groups += ["".join(flat[i:j]) for i, j in zip([0, *stops], stops)]
        # links
        a0, b0, links = _first_of(na), _first_of(nb), na * nb
        giant = links > GIANT
        times = np.where(giant, 0, links)
        group = np.repeat(np.arange(n_groups), times)
        k = _spread(np.zeros(n_groups, np.int64), times)
        pairs = a[a0[group] + k // nb[group]] << BITS | b[b0[group] + k % nb[group]]
        count, of = np.ones(len(pairs), np.int64), unit_of[group]
        for g in np.flatnonzero(giant).tolist():
            (x, nx), (y, ny) = (np.unique(ids[at : at + size], return_counts=True) for ids, at, size in ((a, a0[g], na[g]), (b, b0[g], nb[g])))
            pairs = np.concatenate([pairs, (x[:, None] << BITS | y).ravel()])
            count = np.concatenate([count, (nx[:, None] * ny).ravel()])
            of = np.concatenate([of, np.full(len(x) * len(y), unit_of[g])])
        if giant.any():
            order = np.argsort(of, kind="stable")
            pairs, count, of = pairs[order], count[order], of[order]
        self.known.update(zip(units, range(len(self.known), len(self.known) + n)))
        totals = [np.bincount(unit_of, weights=w, minlength=n).astype(np.int64) for w in (na, nb)]
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, unit_of, links)
        stats = np.column_stack([*totals, per_unit, n_links, np.ones(n, np.int64)])
        return stats.astype(np.int32), np.bincount(of, minlength=n).astype(np.int32), pairs.astype(np.uint32), count.astype(np.int32)


class _Block:
    """Documents of one block: their units' codes, and how many of them hold each pair."""

    def __init__(self, al: Aligner, texts: list[str | None]):
        if len(al.known) > UNITS:
            al.forget(KEPT)
        cuts = [al.cut(t) if t else [] for t in texts]
        al.learn(set().union(*cuts))
        self.docs = [np.fromiter(map(al.known.__getitem__, c), np.int64, len(c)) for c in cuts]
        del cuts
        self.docs = [c if al.stats[c, 4].all() else c[:0] for c in self.docs]
        self.sums = [al.stats[c, :4].sum(0, dtype=np.int64).tolist() for c in self.docs]
        self.hashes = [hashlib.sha256("".join([al.groups[i] for i in c.tolist()])[:-1].encode()).digest() for c in self.docs]
        # only units of this block, with pairs numbered in the order of the pair's value
        used, codes = np.unique(np.concatenate([*self.docs, np.zeros(0, np.int64)]), return_inverse=True)
        ends = np.cumsum([len(c) for c in self.docs])[:-1]
        self.docs = np.split(codes, ends) if len(ends) else [codes]
        al.uses[used] += 1
        self.n_pairs = al.n_pairs[used].astype(np.int64)
        first = _first_of(al.n_pairs.astype(np.int64))[used]
        taken = _spread(first, self.n_pairs)
        self.pairs, self.of = np.unique(al.pairs[taken], return_inverse=True)
        self.pairs, self.times = self.pairs.astype(np.int64), al.times[taken]
        start, stamp = _first_of(self.n_pairs), np.zeros(len(self.pairs), np.int64)
        self.held = np.zeros(len(self.pairs), np.int64)
        for c in self.docs:
            own = np.unique(c)
            p = self.of[_spread(start[own], self.n_pairs[own])]
            turn = np.arange(len(p))
            stamp[p] = turn
            self.held[p[stamp[p] == turn]] += 1  # one place of each different pair


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as their low bytes, then the next ones and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


#: a block's arrays: ids of its documents' units and where each document ends, pairs of each unit, the pairs themselves
PARTS = ("codes", "ends", "n_pairs", "of", "times", "pair", "held", "plain")


def _row(block: _Block, same: np.ndarray) -> dict[str, bytes]:
    """Stored form of a block; `held` is for pairs of other bytes only, as those of `same` go to the vector."""
    a_of = block.pairs >> BITS
    plain = same[a_of] == block.pairs & (1 << BITS) - 1
    arrays = (np.concatenate([*block.docs, np.zeros(0, np.int64)]), np.cumsum([len(c) for c in block.docs]), block.n_pairs, block.of, block.times, block.pairs, block.held[~plain], plain)
    return {name: _packed(x) for name, x in zip(PARTS, arrays)}


def _others(pair: bytes, plain: bytes) -> np.ndarray:
    return _unpacked(pair)[_unpacked(plain) == 0]


def _values(row: dict, pairs: np.ndarray, docs: np.ndarray, known: np.ndarray, best: np.ndarray) -> np.ndarray:
    """(documents, 2): n_best and count_sum of a block from the totals `docs` of the sorted `pairs`, those of the identity
    vector `known`, and each A id's highest count."""
    codes, ends, n_pairs, of, times, pair, _, plain = (_unpacked(row[c]) for c in PARTS)
    a = pair >> BITS
    total = np.where(plain == 1, known[a], 0)
    rest = np.flatnonzero(plain == 0)
    total[rest] = docs[np.searchsorted(pairs, pair[rest])]
    value = np.column_stack([total == best[a], total]).astype(np.int64)
    sums = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(value[of] * times[:, None], axis=0)])
    last = np.cumsum(n_pairs)
    units = (sums[last] - sums[last - n_pairs])[codes]
    sums = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(units, axis=0)])
    return sums[ends] - sums[np.concatenate([[0], ends[:-1]])]


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def _out(ids: pa.Array, sums: bytes, hashes: bytes, values: np.ndarray) -> pa.RecordBatch:
    sums = np.frombuffer(sums, "<i8").reshape(-1, 4)
    text = [hashes[i : i + 32].hex() if n else "" for i, n in zip(range(0, len(hashes), 32), sums[:, 0].tolist())]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(sums[:, i]) for i in range(4)), pa.array(text, pa.string()), pa.array(values[:, 0]), pa.array(values[:, 1])], names=OUT)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, counts): the alignment of each row, and the corpus table of id pairs.

    documents: (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum). counts: (pair, docs), the number of
    rows that hold A id `pair >> 16` and B id `pair & 65535` linked.

    Texts are tokenised once, in blocks of about `BLOCK_BYTES`; a block is kept as one row of unit numbers. A pair of ids with
    the same bytes is counted in a vector as long as A's vocabulary; only the other pairs of a block, each with its number
    of rows, are shuffled. Their totals go back to the blocks: to every task while there are at most `SENT` different
    pairs, and beyond that by a shuffle to the blocks that hold them. The identity vector and the highest count of each A
    id are as long as A's vocabulary. Null and empty texts and those whose bytes do not come back have zeros and an empty
    hash; repeated rows count each; a null doc_id stays null; a long text is one block; an empty table gives no row; other
    columns are not read.
    """
    a_path, b_path = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
    kind = docs.schema[doc_id].dataType.simpleString()
    blobs = ["sums", "hashes", *PARTS]
    fields = ["block", "ids", *blobs, "vector"]
    first_schema = f"block long, ids array<{kind}>, " + ", ".join(f"{c} binary" for c in blobs) + ", vector binary"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        vector = np.zeros(len(al.same), np.int64)
        types: list[pa.DataType] = []

        def row(ids: pa.Array | None, values: dict[str, bytes]) -> pa.RecordBatch:
            listed = pa.array([None], types[1]) if ids is None else pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), listed, *(pa.array([values.get(c)], pa.binary()) for c in fields[2:])], names=fields)

        for b in batches:
            if not types:
                types += [pa.int64(), pa.list_(b.column(0).type)]
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(sizes):
                stop = min(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BLOCK_BYTES)) + 1, len(sizes))
                block = _Block(al, b.column(1).slice(at, stop - at).to_pylist())
                plain = al.same[block.pairs >> BITS] == block.pairs & (1 << BITS) - 1
                vector[block.pairs[plain] >> BITS] += block.held[plain]
                ids = b.column(0).slice(at, stop - at)
                yield row(pa.concat_arrays([ids]), {"sums": np.array(block.sums, "<i8").tobytes(), "hashes": b"".join(block.hashes)} | _row(block, al.same))
                number += 1
                at = stop
        if types:
            yield row(None, {"vector": vector.astype("<i8").tobytes()})

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    staged = stage(src.mapInArrow(first, first_schema), row_group=ROW_GROUP)
    blocks = staged.filter("vector is null").drop("vector")

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Other pairs of each block, one row each."""
        aligner.cache_clear()
        for b in batches:
            for block, pair, plain, held in zip(*(b.column(i).to_pylist() for i in range(4))):
                pair = _others(pair, plain)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(_unpacked(held))], names=["block", "pair", "held"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for v in b.column(0).to_pylist():
                v = np.frombuffer(v, "<i8")
                total = v if total is None else total + v
        if total is not None:
            has = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["a", "docs"])

    others = blocks.select("block", "pair", "plain", "held").mapInArrow(shown, "block long, pair long, held long")
    totals = stage(others.groupBy("pair").agg(F.sum("held").alias("docs")))
    identity = staged.filter("vector is not null").select("vector").mapInArrow(vectors, "a long, docs long").groupBy("a").agg(F.sum("docs").alias("docs"))
    highest = totals.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("docs").alias("most"))
    table = aligner(a_path, b_path).same
    known, best = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
    # at most one row per id of A's vocabulary
    both = identity.join(highest, "a", "full").select("a", F.coalesce("docs", F.lit(0)), F.coalesce("most", F.lit(0))).toArrow()
    known[both.column(0).to_numpy()] = both.column(1).to_numpy()
    best[both.column(0).to_numpy()] = np.maximum(both.column(1).to_numpy(), both.column(2).to_numpy())
    same_pairs = np.arange(len(table)) << BITS | table
    counts = totals.unionByName(docs.sparkSession.createDataFrame(pa.table({"pair": same_pairs[known > 0], "docs": known[known > 0]})))
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"

    if totals.count() <= SENT:
        sent = totals.orderBy("pair").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(tuple(sent.column(i).to_numpy() for i in (0, 1)) + (known, best))

        def with_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    row = {c: b.column(c)[i].as_py() for c in blobs}
                    yield _out(b.column("ids")[i].values, row["sums"], row["hashes"], _values(row, *shared.value))

        return blocks.select("ids", *blobs).mapInArrow(with_all, schema), counts

    def with_own(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left[c][0].as_py() for c in blobs}
        right = right.sort_by("pair")
        return pa.Table.from_batches([_out(left["ids"][0].values, row["sums"], row["hashes"], _values(row, right["pair"].to_numpy(), right["docs"].to_numpy(), known, best))])

    back = others.select("block", "pair").join(totals, "pair").select("block", "pair", "docs")
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(with_own, schema), counts
