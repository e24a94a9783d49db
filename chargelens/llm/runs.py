"""Periodic runs of words by the dictionary of basic factors."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6  # words of the shortest run
EXPONENT = 4  # periods that a run holds at least; the search below is complete from 4 on
BATCH_BYTES = 8 << 20


def proposals(x: np.ndarray, exponent: int = EXPONENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, periods): for each power of two L, places whose factor of length L comes back twice at one distance in (L, 2L].

    Factors of length 2L are named by the pair of names of their halves. A run of smallest period q has, for
    L < q <= 2L, a factor of length L that occurs once per period (there are at least L + 1 different ones among the q
    rotations), so its next occurrence lies exactly q further on; with four periods there are three occurrences, an
    arithmetic progression. Factors with fewer than three occurrences are therefore left out on the next level.
    """
    at, names, size = np.arange(len(x)), x, 1
    while len(at) > 2 and size * exponent < len(x) + exponent:
        order = np.argsort(names, kind="stable")
        sorted_names, places = names[order], at[order]
        new = np.empty(len(order), bool)
        new[0], new[1:] = True, sorted_names[1:] != sorted_names[:-1]
        step = np.diff(places)
        step[new[1:]] = 0  # no successor
        far = (step > (size if size > 1 else 0)) & (step <= 2 * size)
        hit = np.flatnonzero(far[:-1] & (step[:-1] == step[1:]))
        if len(hit):
            yield places[hit], step[hit]
        rank = np.cumsum(new) - 1
        often = np.bincount(rank)[rank] > 2
        name_at = np.full(len(x), -1, np.int64)
        name_at[places[often]] = rank[often]
        at = np.flatnonzero(name_at[: len(x) - size] >= 0)
        at = at[name_at[at + size] >= 0]
        names = name_at[at] * len(x) + name_at[at + size]
        size *= 2


def runs_of(x: np.ndarray, least: int = LEAST_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """Sorted (start, length, period) of the maximal stretches with that smallest period and max(least, exponent * period) items or more."""
    found = set()
    breaks: dict[int, np.ndarray] = {}
    for places, steps in proposals(x, exponent):
        for q in np.unique(steps).tolist():
            if q not in breaks:  # places whose item differs from the one q further on, the ends of both sides included
                breaks[q] = np.concatenate(([-1], np.flatnonzero(x[q:] != x[:-q]), [len(x) - q]))
            stops = np.unique(np.searchsorted(breaks[q], places[steps == q]))
            start, stop = breaks[q][stops - 1] + 1, breaks[q][stops]
            length = stop + q - start
            long = length >= max(least, exponent * q)
            found.update((s, n, q) for s, n in zip(start[long].tolist(), length[long].tolist()))
    return sorted(found)


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words outside the repeats: a run keeps its first period only."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edge[:-1]).tolist()) if not inside]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed): one row per row, in blank-separated words.

    `runs` is sorted by start, then period; `collapsed` is the text with one period of each run left and single blanks.
    Each row is worked on by itself in the task that reads it, so nothing is shuffled and copies or hot sources are no
    matter. Null and empty texts have no words, no runs and an empty collapsed text; repeated rows are judged each; a null
    doc_id stays null; other columns are not read; an empty table gives no row. A long text takes O(n log n) time and
    memory in its words, and O(n) more per distinct proposed period.
    """
    if exponent < 4:
        raise ValueError("the search is complete from four periods on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = max(1, b.num_rows * BATCH_BYTES // max(b.nbytes, 1))
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                counts, runs, short = [], [], []
                for t in part.column(1):
                    words = (t.as_py() or "").encode().split()
                    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
                    own = runs_of(np.fromiter(map(number.__getitem__, words), np.int64, len(words)), least, exponent) if len(words) >= least and len(number) < len(words) - 2 else []
                    counts.append(len(words))
                    runs.append(own)
                    short.append(b" ".join(kept_words(words, own)))
                ends = np.cumsum([0, *map(len, runs)])
                flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
                items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items), pa.array(short, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
