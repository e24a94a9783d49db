"""Exact top-k by inner product: blocks by descending length, rotated partial sums, Cauchy-Schwarz bounds."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargelens.llm.common import stage

K = 20
SCALE = 64
ROWS = 4096  # vectors of a block
QUERIES = 512  # queries of a block
PAIR_TASKS = 64
HEAD = 16  # rotated coordinates of the partial sum


def integer_vectors(df: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """Written (uid, vec_id, v array<bigint>): floor(scale * x). Rows with a null id, a null vector, or a null or non-finite component are left out."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    good = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.filter(F.coalesce(good, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("bigint")).alias("v"))
    return stage(rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "vec_id", "v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first, from the dim x dim sum of products (one partial sum per task)."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column(0), dim)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["cell", "s"])

    cells = rows.select("v").mapInArrow(products, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()  # dim squared numbers
    gram = np.zeros(dim * dim)
    for r in cells:
        gram[r.cell] = r.s
    return np.linalg.eigh(gram.reshape(dim, dim))[1][:, ::-1].copy()


def _blocks(rows: DataFrame, size: int, dim: int, by_length: bool) -> DataFrame:
    """(part, block, n, ids, uids, data): vectors of one block as one row of bytes; by_length: longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = number = 0
        part = None

        def out() -> pa.RecordBatch:
            nonlocal number
            u, i, m = (np.concatenate(x) for x in zip(*held))
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number - 1]), pa.array([len(u)]), pa.array([u.tobytes()], pa.binary()), pa.array([i.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], names=["part", "block", "n", "uids", "ids", "data"])

        for b in batches:
            for at in range(0, b.num_rows, size):
                s = b.slice(at, size)
                part = s.column(3)[0].as_py()
                held.append((s.column(0).to_numpy(), s.column(1).to_numpy(), _matrix(s.column(2), dim)))
                n += s.num_rows
                if n >= size:
                    yield out()
                    held.clear()
                    n = 0
        if held:
            yield out()

    if by_length:
        length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        rows = rows.withColumn("l", length).repartitionByRange(F.desc("l"), "uid").sortWithinPartitions(F.desc("l"), "uid")
    rows = rows.select("uid", "vec_id", "v", F.spark_partition_id().cast("long").alias("part"))
    return rows.mapInArrow(run, "part long, block long, n long, uids binary, ids binary, data binary")


def _best(score: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((uids, ids, -score))[:k]


def _search(k: int, dim: int, head: int, turn: np.ndarray):
    """Rows of a query block and a data block -> the block's candidates (query, query_id, vec_id, uid, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield _pair(r, k, dim, head, turn)

    return run


def _pair(r: dict, k: int, dim: int, head: int, turn: np.ndarray) -> pa.RecordBatch:
    qu, qi, q = np.frombuffer(r["q_uids"], np.int64), np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_data"]).reshape(r["q_n"], dim)
    xu, xi, x = np.frombuffer(r["uids"], np.int64), np.frombuffer(r["ids"], np.int64), np.frombuffer(r["data"]).reshape(r["n"], dim)
    floor = np.full(len(qu), -np.inf) if r["q_floor"] is None else np.array(r["q_floor"])  # a score that the k-th best reaches at least
    qr, xr = q @ turn, x @ turn
    near_q, near_x = qr[:, :head].copy(), xr[:, :head].copy()
    rest_q, rest_x = np.sqrt((qr[:, head:] ** 2).sum(1)), np.sqrt((xr[:, head:] ** 2).sum(1))
    length_q, length_x = np.sqrt((q**2).sum(1)), np.sqrt((x**2).sum(1))
    out: list[tuple] = []
    for j in range(len(qu)):
        slack = 1e-9 * (1 + length_q[j] * (length_x[0] if len(length_x) else 0))
        low = floor[j]
        n = int(np.searchsorted(-length_x, -(low - slack) / length_q[j], side="right")) if length_q[j] > 0 and low > 0 else len(xu)  # the rest is too short
        if not n:
            continue
        bound = near_x[:n] @ near_q[j] + rest_q[j] * rest_x[:n]
        kept = np.flatnonzero((bound + slack >= low) & (xu[:n] != qu[j]))
        if len(kept) > k:  # the k best by bound give a floor for the others
            some = kept[np.argpartition(-bound[kept], k - 1)[:k]]
            own = (x[some] @ q[j]).min()
            if own > low:
                kept = kept[bound[kept] + slack >= own]
        score = np.rint(x[kept] @ q[j])
        best = _best(score, xi[kept], xu[kept], k)
        out.append((np.full(len(best), qu[j]), np.full(len(best), qi[j]), xi[kept][best], xu[kept][best], score[best].astype(np.int64)))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "query_id", "vec_id", "uid", "score"])


_FOUND = "query long, query_id long, vec_id long, uid long, score long"


def top_k(df: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: int = SCALE, rows: int = ROWS, queries: int = QUERIES, head: int = HEAD) -> DataFrame:
    """(query_id, rank, vec_id, score long): each query row's k best other rows by integer inner product, ties to the smaller vec_id.

    Queries are the rows whose vec_id fulfils `is_query` (Column -> Column). Vectors of other lengths count as padded
    with zeros. Repeated rows are rows of their own: each is a candidate, and each as a query has its own ranks (ties
    between equal ids go to the row written first). Null ids, null vectors and non-finite components take no part; an empty table
    gives no row. Scores are exact up to 2**53.

    Blocks of queries meet blocks of vectors. The block of the longest vectors gives each query a floor; further blocks
    are cut at the length, then at the partial sum plus the product of the residual lengths, that can still reach it.
    """
    ints = integer_vectors(df, vec_id, embedding, scale)
    dim = ints.agg(F.max(F.size("v"))).first()[0] or 1
    turn = rotation(ints, dim)
    head = min(head, dim)
    data = stage(_blocks(ints, rows, dim, True))
    asked = stage(_blocks(ints.filter(is_query(F.col("vec_id"))), queries, dim, False))
    task = _search(k, dim, head, turn)
    # the longest vectors, one block: a floor for each query
    first = data.filter((F.col("part") == 0) & (F.col("block") == 0)).select("n", "uids", "ids", "data")
    none = asked.withColumn("f", F.lit(None).cast("array<double>"))
    lead = stage(_meet(none, first, task))
    floors = lead.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    others = data.filter((F.col("part") > 0) | (F.col("block") > 0)).select("n", "uids", "ids", "data")
    rest = _meet(_with_floors(asked, floors), others, task)
    w = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id", "uid")
    every = lead.union(rest).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return every.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _meet(asked: DataFrame, data: DataFrame, task) -> DataFrame:
    """Every block of queries with every block of vectors; few rows of a few MB, dealt evenly."""
    q = asked.select(F.col("n").alias("q_n"), F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("f").alias("q_floor"))
    return q.join(data).repartition(PAIR_TASKS).mapInArrow(task, _FOUND)


def _with_floors(asked: DataFrame, floors: DataFrame) -> DataFrame:
    """Blocks with the floors of their queries, in the order of the block."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                u = np.frombuffer(r["uids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r["part"]] * len(u)), pa.array([r["block"]] * len(u)), pa.array(u), pa.array(np.arange(len(u)))], names=["part", "block", "query", "at"])

    spread = asked.select("part", "block", "uids").mapInArrow(unpack, "part long, block long, query long, at long")
    low = F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf")))
    listed = spread.join(floors, "query", "left").groupBy("part", "block").agg(F.sort_array(F.collect_list(F.struct("at", low.alias("floor")))).alias("f"))
    return asked.join(listed.select("part", "block", F.col("f.floor").alias("f")), ["part", "block"])
