"""Training order: fixed-length sequences at keyed slots, written as fixed-stride shards."""
from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargelens.llm.common import stage
from chargelens.llm.tokens import TextEncoder, text_encoder, tokenizer_path
from chargelens.session import shared_dir

LENGTH = 512  # ids of a sequence
SHARD = 4096  # sequences of a shard
END_ID = 0
KEY = "order key 1"
ROUNDS = 6
BATCH = 1024  # sequences kept as one packed row
HELD = 16 << 20  # bytes of sequences that a task holds before it deals them to their shards


class FeistelOrder:
    """Keyed permutation of 0 .. n - 1: rounds on the two halves of the bits of n - 1, walked on while the outcome is n or more."""

    def __init__(self, n: int, key: str = KEY, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [int.from_bytes(hashlib.sha256(f"{key}|{r}".encode()).digest()[:8], "little") for r in range(rounds)]

    def _mix(self, x: np.ndarray, key: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return x ^ (x >> np.uint64(32))

    def _once(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        h, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        a, b = x >> h, x & mask
        for key in reversed(self.keys) if back else self.keys:
            if back:
                a, b = b ^ (self._mix(a, key) & mask), a
            else:
                a, b = b, a ^ (self._mix(b, key) & mask)
        return (a << h) | b

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


def _rows(texts: Iterator, encoder: TextEncoder, length: int, end_id: int, width: int = 2) -> Iterator[bytes]:
    """Rows of `length` ids of documents laid end to end, each closed by end_id; the last row is filled up with end_id."""
    end, stride = int(end_id).to_bytes(width, "little"), length * width
    rest = bytearray()
    for t in texts:
        rest += encoder.encode(t or "") + end
        whole = len(rest) - len(rest) % stride
        for at in range(0, whole, stride):
            yield bytes(rest[at : at + stride])
        del rest[:whole]
    if rest:
        yield bytes(rest) + end * ((stride - len(rest)) // width)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator:
    for b in batches:
        for t in b.column(0):
            yield t.as_py()


def cut_sequences(docs: DataFrame, text: str = "text", length: int = LENGTH, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Written (task, local, n, ids): sequences `local` .. `local` + n - 1 of a task, packed. Texts are tokenised once."""
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=6)
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        n = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([n], pa.int64()), pa.array([len(held)], pa.int64()), pa.array([pack.compress(b"".join(held))], pa.binary())], names=["task", "local", "n", "ids"])

        for sequence in _rows(_texts(batches), text_encoder(path, "<u2"), length, end_id):
            held.append(sequence)
            if len(held) == BATCH:
                yield row()
                n += len(held)
                held.clear()
        if held:
            yield row()

    return stage(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(cut, "task long, local long, n long, ids binary"), row_group=HELD)


def training_order(sequences: DataFrame, key: str = KEY, length: int = LENGTH, shard: int = SHARD) -> tuple[DataFrame, int]:
    """((shard, slots, ids), number of sequences) of `cut_sequences`: each row holds sequences of one shard, packed, and
    their slots in rising order.

    Running sums over the tasks give every sequence its index, and the keyed permutation its slot.
    """
    counts = sequences.groupBy("task").agg(F.sum("n").alias("own"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the scan
    starts = stage(counts.select("task", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("base")))
    total = starts.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    order, stride = FeistelOrder(total, key), 2 * length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        slots: list[np.ndarray] = []
        rows: list[np.ndarray] = []

        def dealt() -> pa.RecordBatch:
            every, data = np.concatenate(slots), np.concatenate(rows)
            line = np.argsort(every)
            every, data = every[line], data[line]
            number = every // shard
            edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(every)]
            parts = list(zip(edges, edges[1:]))
            slots.clear()
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(number[edges[:-1]]), pa.array([every[i:j].astype("<i8").tobytes() for i, j in parts], pa.binary()), pa.array([pack.compress(data[i:j].tobytes()) for i, j in parts], pa.binary())], names=["shard", "slots", "ids"])

        for b in batches:
            for first, n, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                slots.append(order.slot(np.arange(first, first + n)))
                rows.append(np.frombuffer(unpack.decompress(ids.as_py()), np.uint8).reshape(n, stride))
                if sum(r.nbytes for r in rows) >= HELD:
                    yield dealt()
        if rows:
            yield dealt()

    placed = sequences.join(starts, "task").select((F.col("base") + F.col("local")).alias("first"), "n", "ids").mapInArrow(place, "shard long, slots binary, ids binary")
    return placed, total


def write_shards(placed: DataFrame, total: int, folder: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Files `shard-<number>.bin` of `shard` sequences each (the last one may hold fewer), 2 * length bytes per sequence,
    in slot order -> (slot, shard, position, byte_offset, ids_crc32) per sequence, written.

    Shards are ranged over the tasks, and a task puts one shard after the other together from the rows that hold parts of
    it. A shard gets its name by a move when it is complete and its slots have no gap; a repeated task writes the same
    bytes again.
    """
    n_shards, stride = -(-total // shard), 2 * length

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        unpack = zstandard.ZstdDecompressor()
        number, slots, rows = None, [], []

        def whole() -> pa.RecordBatch:
            every, data = np.concatenate(slots), np.concatenate(rows)
            line = np.argsort(every)
            every, data = every[line], np.ascontiguousarray(data[line])
            if not np.array_equal(every, np.arange(number * shard, min((number + 1) * shard, total))):
                raise RuntimeError(f"shard {number} has {len(every)} sequences")
            name = f"{root}/_part-{number:08d}-{uuid.uuid4().hex}"
            with place.open_output_stream(name) as out:
                out.write(data.tobytes())
            place.move(name, f"{root}/shard-{number:08d}.bin")
            return pa.RecordBatch.from_arrays([pa.array(every), pa.array([zlib.crc32(r) for r in data], pa.int64())], names=["slot", "crc"])

        for b in batches:
            for at, s, ids in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if at != number and number is not None:
                    yield whole()
                    slots, rows = [], []
                number = at
                slots.append(np.frombuffer(s.as_py(), "<i8"))
                rows.append(np.frombuffer(unpack.decompress(ids.as_py()), np.uint8).reshape(-1, stride))
        if number is not None:
            yield whole()

    if not total:
        return placed.select(*[F.lit(0).cast("long").alias(c) for c in ("slot", "shard", "position", "byte_offset", "ids_crc32")])
    tasks = max(1, min(n_shards, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # shards are 0 .. n_shards - 1, so the ranges are known and need no sample of the rows
    dealt = placed.repartitionById(tasks, F.floor(F.col("shard") * tasks / n_shards).cast("int")).sortWithinPartitions("shard")
    done = stage(dealt.mapInArrow(write, "slot long, crc long"))
    number = F.floor(F.col("slot") / shard)
    return done.select("slot", number.alias("shard"), (F.col("slot") % shard).alias("position"), (F.col("slot") % shard * stride).alias("byte_offset"), F.col("crc").alias("ids_crc32"))


def materialise(docs: DataFrame, text: str = "text", folder: str | None = None, length: int = LENGTH, shard: int = SHARD, key: str = KEY, tokenizer: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """(manifest of write_shards, folder). Folder: given, else a new one in the shared folder.

    Null and empty texts are one end id; repeated rows are written each; other columns are not read; an empty table gives
    no shard and an empty manifest. The last sequence of each task is filled up with end ids.
    """
    base = folder or f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    placed, total = training_order(cut_sequences(docs, text, length, tokenizer, end_id), key, length, shard)
    return write_shards(placed, total, base, length, shard), base


def read_from(folder: str, slot: int, length: int = LENGTH, shard: int = SHARD) -> Iterator[np.ndarray]:
    """Sequences from `slot` on, in order: one seek, then sequential reads over the shards."""
    place, root = fs.FileSystem.from_uri(folder)
    number, stride = slot // shard, 2 * length
    offset = slot % shard * stride
    while place.get_file_info(name := f"{root}/shard-{number:08d}.bin").type == fs.FileType.File:
        with place.open_input_file(name) as f:
            f.seek(offset)
            while row := f.read(stride):
                yield np.frombuffer(row, "<u2")
        number, offset = number + 1, 0
