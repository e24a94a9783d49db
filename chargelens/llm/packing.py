"""Sum-of-squares packing of token sequences."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargelens.llm.tokens import text_encoder, tokenizer_path

WINDOW = 1024
END_ID = 0
OPEN_WINDOWS = 4096  # partly filled windows a task holds; beyond it they are joined into full ones
BATCH_BYTES = 4 << 20
TASK_BITS = 40  # sequence_id: number of the task above, number in the task below


class SumOfSquares:
    """Online packing into windows of `size`. A piece is (document number, start, ids).

    level[h] counts the open windows filled to h. A rest of s ids goes to the level h (0: a new window) that makes the sum
    of squared counts least; the fuller level wins a tie. Documents are cut at whole windows first. What is open at the
    end is laid end to end, cut into full windows, and the last rest into powers of two, which need no padding.
    """

    def __init__(self, size: int = WINDOW, most_open: int = OPEN_WINDOWS):
        self.size, self.most_open = size, most_open
        self.level = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def add(self, doc: int, ids: bytes, width: int = 4) -> Iterator[list[tuple]]:
        """Windows that became full, each a list of pieces."""
        n = len(ids) // width
        whole = n - n % self.size
        for at in range(0, whole, self.size):
            yield [(doc, at, ids[at * width : (at + self.size) * width])]
        s = n - whole
        if not s:
            return
        fit = self.level[: self.size - s + 1]
        cost = 2 * self.level[s:] + 1
        cost[-1] = 0  # a full window leaves the count
        cost = cost - np.where(np.arange(len(fit)) > 0, 2 * fit - 1, 0)
        cost[1:][fit[1:] == 0] = np.iinfo(np.int64).max
        h = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = []
        if h:
            window = self.open[h].pop()
            self.level[h] -= 1
            self.n_open -= 1
        window.append((doc, whole, ids[whole * width :]))
        if h + s == self.size:
            yield window
            return
        self.open[h + s].append(window)
        self.level[h + s] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            yield from self.drain(width, last=False)

    def drain(self, width: int = 4, last: bool = True) -> Iterator[list[tuple]]:
        """Open windows, fullest first, laid end to end; without `last` the rest stays open."""
        pieces = [p for h in range(self.size, 0, -1) for w in self.open[h] for p in w]
        self.open = [[] for _ in range(self.size + 1)]
        self.level[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in pieces) // width
        goal = self._next(left, last)
        window: list[tuple] = []
        have = 0
        for doc, start, ids in pieces:
            n = len(ids) // width
            at = 0
            while at < n:
                take = min(n - at, goal - have)
                window.append((doc, start + at, ids[at * width : (at + take) * width]))
                at, have, left = at + take, have + take, left - take
                if have == goal and (goal == self.size or last):
                    yield window
                    window, have = [], 0
                    goal = self._next(left, last)
        if window:
            self.open[have].append(window)
            self.level[have] += 1
            self.n_open += 1

    def _next(self, left: int, last: bool) -> int:
        if left >= self.size or not last:
            return self.size
        return 1 << (max(left, 1).bit_length() - 1)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids binary, sequence_id, offset): one row per piece, ids as unsigned 32-bit little-endian.

    Each task packs the rows that it reads, so nothing is shuffled; its windows are numbered from its own number, and a
    repeated task makes the same rows. A document is its ids and `end_id`, so null and empty texts have one id; repeated
    rows are packed each; a null doc_id stays null. Other columns are not read; an empty table gives no row.
    """
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = text_encoder(path), SumOfSquares(size)
        end = np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << TASK_BITS
        rows: list[tuple] = []
        held = 0

        def take(windows: Iterator[list[tuple]]) -> None:
            nonlocal number, held
            for window in windows:
                offset = 0
                for (key, total), start, ids in window:
                    rows.append((key, total, start, len(ids) // 4, ids, number, offset))
                    offset += len(ids) // 4
                    held += len(ids) + 64
                number += 1

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=fields)
            rows.clear()
            held = 0
            return out

        for b in batches:
            kinds = [b.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            fields = ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"]
            for key, t in zip(b.column(0), b.column(1)):
                ids = encoder.encode(t.as_py() or "") + end
                for window in packer.add((key.as_py(), len(ids) // 4), ids):
                    take(iter([window]))
                    if held > BATCH_BYTES:
                        yield flush()
        for window in packer.drain():
            take(iter([window]))
            if held > BATCH_BYTES:
                yield flush()
        if rows:
            yield flush()

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
