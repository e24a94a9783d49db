"""Many boosted-tree fits side by side over one binned table.

Feature values are turned into bin numbers once. A fit is a row of a plan: which rows it learns from, which label, how deep
and for how many rounds. A fit learns from all rows that it names: those that are equal in bins and label are one row with
their number, which leaves a table bounded by the grid of bins and not by the input. A fit of up to IN_TASK such rows is
one task; one of more is grown by sums over all tasks, level by level. Every row is scored by all fits that want it in one
pass.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.operators.ranks import totals_before
from chargelens.session import stage

BINS = 255  # bin 0 holds missing values
# fixed values: settings of the published model
RATE, LEAST_LEAF, L2, HELD_SHARE, PATIENCE = 0.08, 50, 1.0, 0.1, 20
DEPTH, ROUNDS = 6, 200
IN_TASK = 2_000_000  # folded rows of a fit that one task grows (about 250 bytes each); more are grown by all tasks
STAGED_ROUNDS = 20  # rounds whose trees are added up anew before the sums are written


@dataclass(frozen=True)
class Fit:
    """`learn` and `score` pick rows; `name` and `note` come back with every scored row's metrics."""

    name: str
    learn: Column
    score: Column
    label: str = "y"
    depth: int = DEPTH
    rounds: int = ROUNDS
    seed: int = 42
    uses: tuple[str, ...] | None = None  # features; all if None


def cut_points(rows: DataFrame, features: list[str]) -> list[np.ndarray]:
    """At most BINS - 1 ascending cut points per feature: between neighbouring values, or between evenly spaced ranks of all
    rows. Ranks come from value counts in chunks, so no feature's values meet in one task."""
    long = rows.select(F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("feature", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    per = stage(long.groupBy("feature", "x").agg(F.count("*").alias("n")))
    size = per.groupBy("feature").agg(F.count("*").alias("values"), F.sum("n").alias("total"))
    at = totals_before(per, ["feature"], "x", ["n"]).join(size, "feature")
    upto, share = F.col("n_before") + F.col("n"), F.lit(float(BINS)) / F.col("total")
    near = F.sequence(F.greatest(F.floor(F.col("n_before") * share), F.lit(1)), F.least(F.ceil(upto * share) + 1, F.lit(BINS - 1)))
    rank = lambda i: i / F.lit(float(BINS)) * F.col("total")
    hit = F.exists(near, lambda i: (rank(i) > F.col("n_before")) & (rank(i) <= upto))
    by: dict[int, list[float]] = {}
    for r in at.where((F.col("values") <= BINS) | hit).select("feature", "x").collect():  # at most BINS per feature
        by.setdefault(r.feature, []).append(r.x)
    values = [np.unique(by.get(i, [])) for i in range(len(features))]
    return [(x[1:] + x[:-1]) / 2 for x in values]


def with_bins(rows: DataFrame, features: list[str], cuts: list[np.ndarray]) -> DataFrame:
    """Adds `bins`: one byte per feature, 0 for a missing value."""
    names = [f"_x{i}" for i in range(len(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names])
            out = np.column_stack([np.where(np.isnan(c), 0, np.searchsorted(cut, c, "right") + 1) for c, cut in zip(x.T, cuts)]).astype(np.uint8)
            raw = out.tobytes()
            keep = [c for c in b.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([raw[i : i + len(names)] for i in range(0, len(raw), len(names))], pa.binary())], names=[*keep, "bins"])

    wide = rows.select("*", *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    schema = rows.schema.add("bins", "binary")
    return wide.mapInArrow(run, schema)


def _ends(flat: np.ndarray, first: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node in which each row ends. A tree becomes one table, the next node by node and bin; a leaf is followed by itself."""
    feature, cut, missing_left, left, _, depth = tree
    right = np.arange(256) > cut[:, None]
    right[:, 0] = ~missing_left
    then = np.where(left[:, None] < 0, np.arange(len(left))[:, None], left[:, None] + right).ravel()
    of = feature.astype(np.int64)
    node = np.zeros(len(first), np.int64)
    for _ in range(depth):
        node = then.take(node * 256 + flat.take(first + of.take(node)))
    return node


def _scores(bins: np.ndarray, trees: list[tuple[np.ndarray, ...]], start: float) -> np.ndarray:
    """Sum of the trees per row."""
    out = np.full(len(bins), start)
    flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for tree in trees:
        out += tree[4].take(_ends(flat, first, tree))
    return out


def _scan(histograms: Iterable[tuple[int, np.ndarray, np.ndarray, np.ndarray]], G: np.ndarray, H: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node (gain, (feature, cut, missing goes left)) from its sums per feature and bin; no gain is 0."""
    size = len(G)
    best, which = np.zeros(size), np.full((size, 3), -1)
    for f, hg, hh, hn in histograms:
        total, width = hn.sum(1, keepdims=True), hn.shape[1]
        for with_missing in (True, False) if hn[:, 0].any() else (True,):
            lg, lh, ln = (np.cumsum(np.where(np.arange(width) == 0, x if with_missing else 0, x), axis=1) for x in (hg, hh, hn))
            gain = lg**2 / (lh + L2) + (G[:, None] - lg) ** 2 / (H[:, None] - lh + L2) - (G**2 / (H + L2))[:, None]
            gain[(ln < LEAST_LEAF) | (total - ln < LEAST_LEAF)] = 0
            at = gain.argmax(1)
            got = gain[np.arange(size), at]
            better = got > best + 1e-12
            best[better] = got[better]
            which[better] = np.column_stack([np.full(better.sum(), f), at[better], np.full(better.sum(), with_missing)])
    return best, which


def _best_splits(columns: list[np.ndarray], uses: list[int], own: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray | None, G: np.ndarray, H: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`_scan` over rows. Histograms are as wide as the feature has bins."""

    def histograms() -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for f, column in zip(uses, columns):
            width = int(column.max()) + 1
            key = own * width + column
            yield f, *(np.bincount(key, v, len(G) * width).reshape(len(G), width) for v in (g, h, rows))

    return _scan(histograms(), G, H)


def _tree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, uses: list[int], rows: np.ndarray | None = None) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """One tree on gradients and curvatures, level by level, and its value per row. Both children of a node are `left` and
    `left` + 1; a node without children has left = -1. `rows`: how many rows each row stands for (1 if None). Rows of
    nodes that can not be split further are left aside."""
    feature, cut, missing_left, left, value = np.zeros(1, np.int16), np.zeros(1, np.int16), np.ones(1, bool), np.full(1, -1, np.int32), np.zeros(1)
    end, level, grown = np.zeros(len(bins), np.int64), np.zeros(1, np.int64), 0
    at, own, columns = np.arange(len(bins)), np.zeros(len(bins), np.int64), [np.ascontiguousarray(bins[:, f]) for f in uses]
    for step in range(depth + 1):
        size = len(level)
        G, H = np.bincount(own, g, size), np.bincount(own, h, size)
        value[level] = -G / (H + L2) * RATE
        if step == depth:
            break
        wide = np.bincount(own, rows, size) >= 2 * LEAST_LEAF

        def only(keep: np.ndarray) -> None:
            nonlocal at, own, g, h, rows, columns
            if not keep.all():
                at, own, g, h, columns = at[keep], own[keep], g[keep], h[keep], [c[keep] for c in columns]
                rows = None if rows is None else rows[keep]

        only(wide[own])
        if not len(own):
            break
        number = np.cumsum(wide) - 1
        own, level = number[own], level[wide]
        best, which = _best_splits(columns, uses, own, g, h, rows, G[wide], H[wide])
        split = np.flatnonzero(best > 0)
        if not len(split):
            break
        grown = step + 1
        new = len(left) + 2 * np.arange(len(split))
        into = np.full(len(level), -1)
        into[split] = np.arange(len(split))
        only(into[own] >= 0)
        of = into[own]
        picked = which[split]
        b = bins[at, picked[of, 0]]
        own = 2 * of + np.where(b == 0, picked[of, 2] == 0, b > picked[of, 1])
        feature[level[split]], cut[level[split]], missing_left[level[split]], left[level[split]] = picked[:, 0], picked[:, 1], picked[:, 2] == 1, new
        level = np.arange(len(left), len(left) + 2 * len(split))
        end[at] = level[own]
        more = 2 * len(split)
        feature, cut, missing_left, left, value = (np.concatenate([x, np.full(more, empty, x.dtype)]) for x, empty in ((feature, 0), (cut, 0), (missing_left, True), (left, -1), (value, 0.0)))
    return (feature, cut, missing_left, left, value, grown), value[end]


def grow(bins: np.ndarray, y: np.ndarray, u: np.ndarray, depth: int, rounds: int, uses: list[int] | None = None, rows: np.ndarray | None = None) -> tuple[float, list]:
    """(start, trees) of logistic boosting. Label 0 weighs as much in all as label 1. A tenth of the rows (by `u` in [0, 1)) tells when to stop.
    `rows`: how many equal rows each row stands for (1 if None)."""
    uses = list(range(bins.shape[1])) if uses is None else uses
    each = np.ones(len(y)) if rows is None else rows.astype(float)
    n, pos = each.sum(), max(int((each * y).sum()), 1)
    w = np.where(y == 0, pos / max(n - pos, 1), 1.0) * each
    held = (u < HELD_SHARE) if n * HELD_SHARE >= LEAST_LEAF else np.zeros(len(y), bool)
    tb, ty, tw, vb, vy, vw = bins[~held], y[~held], w[~held], bins[held], y[held], w[held]
    of = None if rows is None else each[~held]
    mean = min(max((tw * ty).sum() / tw.sum(), 1e-6), 1 - 1e-6)
    start = float(np.log(mean / (1 - mean)))
    now, then, trees = np.full(len(ty), start), np.full(len(vy), start), []
    best, best_at = np.inf, 0
    for r in range(rounds):
        p = 1 / (1 + np.exp(-now))
        tree, add = _tree(tb, tw * (p - ty), tw * p * (1 - p), depth, uses, of)
        trees.append(tree)
        now += add
        if held.any():
            then += _scores(vb, [tree], 0.0)
            loss = float((vw * (np.logaddexp(0, then) - vy * then)).sum() / vw.sum())
            if loss < best - 1e-7:
                best, best_at = loss, r
            elif r - best_at >= PATIENCE:
                break
        if tree[5] == 0:
            break
    return start, trees


class _Grown:
    """What the driver knows of a fit that all tasks grow: its trees so far and when it stops, as in `grow`."""

    def __init__(self, counts: dict[tuple[int, bool], int], depth: int, rounds: int, uses: list[int]):
        self.depth, self.rounds, self.uses = depth, rounds, uses
        self.n, self.positives = sum(counts.values()), sum(n for (y, _), n in counts.items() if y)
        self.weight0 = max(self.positives, 1) / max(self.n - max(self.positives, 1), 1)
        self.holds = self.n * HELD_SHARE >= LEAST_LEAF
        weighed = {y: sum(n for (y_, held), n in counts.items() if y_ == y and not (held and self.holds)) * (1.0 if y else self.weight0) for y in (0, 1)}
        mean = min(max(weighed[1] / sum(weighed.values()), 1e-6), 1 - 1e-6)
        self.start, self.trees, self.best, self.best_at, self.done = float(np.log(mean / (1 - mean))), [], np.inf, 0, False
        self.any_held = self.holds and any(held and n for (_, held), n in counts.items())

    def begin(self) -> None:
        self.feature, self.cut, self.missing_left, self.left, self.value, self.grown = np.zeros(1, np.int16), np.zeros(1, np.int16), np.ones(1, bool), np.full(1, -1, np.int32), np.zeros(1), 0
        self.open = np.zeros(1, np.int64)

    def tree(self) -> tuple:
        return self.feature, self.cut, self.missing_left, self.left, self.value, self.grown

    def split(self, found: list) -> None:
        """Takes the best splits of the open nodes; children that can be split are open next."""
        if len(self.left) == 1:
            self.value[0] = -found[0].G / (found[0].H + L2) * RATE
        found = [r for r in found if r.gain > 0]
        if found:
            self.grown += 1
        opened = []
        for r in found:
            new = len(self.left)
            self.feature[r.node], self.cut[r.node], self.missing_left[r.node], self.left[r.node] = self.uses[r.place], r.cut, r.missing_left, new
            sides = ((r.lG, r.lH, r.ln), (r.G - r.lG, r.H - r.lH, r.n - r.ln))
            more = [-G / (H + L2) * RATE for G, H, _ in sides]
            opened += [new + i for i, (_, _, n) in enumerate(sides) if n >= 2 * LEAST_LEAF]
            self.feature, self.cut, self.missing_left, self.left, self.value = (np.concatenate([x, np.array(e, x.dtype)]) for x, e in (
                (self.feature, [0, 0]), (self.cut, [0, 0]), (self.missing_left, [True, True]), (self.left, [-1, -1]), (self.value, more)))
        self.open = np.array(opened, np.int64)

    def judge(self, loss: float | None) -> None:
        """Stops by the loss on the held rows after the trees so far."""
        r = len(self.trees) - 1
        if loss is not None and r >= 0:
            if loss < self.best - 1e-7:
                self.best, self.best_at = loss, r
            elif r - self.best_at >= PATIENCE:
                self.done = True


def _best_of_node(table: pa.Table) -> pa.Table:
    """The best split of one node from its sums per feature (its place in `uses`) and bin; node -1 carries the loss on the held rows."""
    first = {c: table[c][0].as_py() for c in ("fit", "node")}
    f, b, g, h, n = (table[c].to_numpy() for c in ("place", "bin", "g", "h", "n"))
    sums = {k: tuple(np.bincount(b[f == k], v[f == k], BINS + 1)[None] for v in (g, h, n)) for k in np.unique(f)}
    G, H, N = (x.sum(1) for x in next(iter(sums.values())))
    gain, which, left = 0.0, (-1, -1, -1), (0.0, 0.0, 0.0)
    if first["node"] >= 0 and N[0] >= 2 * LEAST_LEAF:
        (gain,), (which,) = _scan(((int(k), *sums[k]) for k in sums), G, H)
        if gain > 0:
            goes = np.arange(BINS + 1) <= which[1]
            goes[0] = which[2] == 1
            left = tuple(float(x[0, goes].sum()) for x in sums[which[0]])
    row = {**first, "gain": float(gain), "place": int(which[0]), "cut": int(which[1]), "missing_left": bool(which[2] == 1), "G": float(G[0]), "H": float(H[0]), "n": float(N[0]), "lG": left[0], "lH": left[1], "ln": left[2]}
    return pa.Table.from_pylist([row], schema=pa.schema([("fit", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("place", pa.int32()), ("cut", pa.int32()), ("missing_left", pa.bool_()), *((c, pa.float64()) for c in ("G", "H", "n", "lG", "lH", "ln"))]))


def grow_spread(use: DataFrame, numbers: list[int], shape: list[tuple], width: int) -> dict[int, _Grown]:
    """`grow` for fits whose rows are too many for one task, all side by side. A pass over the rows gives the sums per node,
    feature and bin of one level of one tree of every fit; the driver holds trees only. The trees are those of `grow` but for
    the rounding of sums, which are added in another order.

    `use`: fit, bins, y, u, n, staged; `width`: how many features there are.
    """
    counts: dict[int, dict] = {k: {} for k in numbers}
    for r in use.groupBy("fit", "y", (F.col("u") < HELD_SHARE).alias("held")).agg(F.sum("n").alias("n")).collect():  # four rows per fit
        counts[r.fit][int(r.y), r.held] = r.n
    fits = {k: _Grown(counts[k], shape[k][0], shape[k][1], list(range(width)) if shape[k][2] is None else shape[k][2]) for k in numbers}
    base, staged_at, rounds = use.withColumn("now", F.element_at(F.create_map(*[F.lit(x) for k, f in fits.items() for x in (k, f.start)]), F.col("fit"))), 0, 0

    def added(trees: dict[int, list]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                fit, now, bins = b["fit"].to_numpy(), b["now"].to_numpy().copy(), _bytes(b["bins"])
                for k in np.unique(fit):
                    now[fit == k] += _scores(bins[fit == k], trees[k], 0.0)
                yield b.set_column(b.schema.names.index("now"), "now", pa.array(now))

        return run

    def sums(known: dict[int, tuple], level: int):
        """Per fit, open node, feature and bin: gradient, curvature and rows; on the first level the loss on the held rows."""

        def cells(acc: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for k, a in acc.items():
                at, f, b = np.nonzero(a[2])
                if len(at):
                    columns = np.full(len(at), k), known[k][2][at], f, b, *(x[at, f, b] for x in a)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.int32()] * 4 + [pa.float64()] * 3)], names=["fit", "node", "place", "bin", "g", "h", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc: dict[int, np.ndarray] = {}
            lost: dict[int, np.ndarray] = {}
            for b in batches:
                fit, y, now, n, all_bins = (*(b[c].to_numpy() for c in ("fit", "y", "now", "n")), _bytes(b["bins"]))
                held_rows = b["u"].to_numpy() < HELD_SHARE
                for k in np.unique(fit):
                    tree, uses, open_nodes, weight0, holds = known[k]
                    own = fit == k
                    held = held_rows & own & holds
                    if level == 0 and held.any():
                        w = np.where(y[held] == 0, weight0, 1.0) * n[held]
                        lost[k] = lost.get(k, 0) + np.array([(w * (np.logaddexp(0, now[held]) - y[held] * now[held])).sum(), w.sum()])
                    own &= ~held
                    bins = all_bins[own]
                    if not len(bins) or not len(open_nodes):
                        continue
                    place = np.full(len(tree[3]), -1)
                    place[open_nodes] = np.arange(len(open_nodes))
                    node = place[_ends(bins.ravel(), np.arange(len(bins)) * width, tree)]
                    at = node >= 0
                    p, w = 1 / (1 + np.exp(-now[own][at])), np.where(y[own][at] == 0, weight0, 1.0) * n[own][at]
                    values, size = (w * (p - y[own][at]), w * p * (1 - p), n[own][at]), len(open_nodes) * (BINS + 1)
                    if k not in acc:
                        if sum(a.nbytes for a in acc.values()) > 64 << 20:
                            yield from cells(acc)
                            acc = {}
                        acc[k] = np.zeros((3, len(open_nodes), len(uses), BINS + 1))
                    for i, f in enumerate(uses):
                        key = node[at] * (BINS + 1) + bins[at, f]
                        for total, v in zip(acc[k], values):
                            total[:, i] += np.bincount(key, v, size).reshape(-1, BINS + 1)
            yield from cells(acc)
            for k, (loss, w) in lost.items():
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((k, -1, 0, 0, loss, w, 1.0), [pa.int32()] * 4 + [pa.float64()] * 3)], names=["fit", "node", "place", "bin", "g", "h", "n"])

        return run

    while going := {k: f for k, f in fits.items() if not f.done and rounds < f.rounds}:
        state = base.where(F.col("fit").isin(list(going))).mapInArrow(added({k: f.trees[staged_at:] for k, f in going.items()}), base.schema)
        if rounds - staged_at >= STAGED_ROUNDS:
            base, staged_at = stage(state), rounds
            state = base
        state.persist(StorageLevel.DISK_ONLY)
        for f in going.values():
            f.begin()
        for level in range(max(f.depth for f in going.values())):
            known = {k: (f.tree(), f.uses, f.open if level < f.depth and not f.done else f.open[:0], f.weight0, f.any_held) for k, f in going.items()}
            if not any(len(x[2]) for x in known.values()):
                break
            cell = state.mapInArrow(sums(known, level), "fit int, node int, place int, bin int, g double, h double, n double")
            cell = cell.groupBy("fit", "node", "place", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
            found: dict[int, list] = {}
            for r in cell.groupBy("fit", "node").applyInArrow(_best_of_node, "fit int, node int, gain double, place int, cut int, missing_left boolean, G double, H double, n double, lG double, lH double, ln double").collect():  # one row per open node
                found.setdefault(r.fit, []).append(r)
            for k, f in going.items():
                rows = sorted(found.get(k, []), key=lambda r: r.node)
                if level == 0:
                    f.judge(next((r.G / r.H for r in rows if r.node < 0), None))
                if not f.done and len(known[k][2]):
                    f.split([r for r in rows if r.node >= 0])
        state.unpersist()
        for f in going.values():
            if not f.done:
                f.trees.append(f.tree())
                f.done = f.grown == 0
        rounds += 1
    return fits


def _bytes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def run_fits(rows: DataFrame, features: list[str], fits: list[Fit], key: list[str], keep: list[str], folded: bool = False, in_task: int = IN_TASK) -> tuple[DataFrame, DataFrame]:
    """(scored, plan). scored: `keep`, fit, y, p for every row that a fit scores; plan: one row per fit with depth,
    rounds asked for and used, training rows and positives. `folded` scores rows that are equal in `keep`, label and bins
    once and adds `n`, how many they are.

    `key` names a row, so that the rows that stop a fit do not depend on the table's layout. A fit learns from every row it
    picks, equal ones as one row with their number; up to `in_task` of these meet in one task, more are left to `grow_spread`.
    """
    learned = rows.where(_any([f.learn for f in fits]))
    cuts = cut_points(learned, features)
    wanted = dict.fromkeys([*keep, *key, "y", *(f.label for f in fits), *features])
    binned = rows.withColumns({"_learn": _numbers([f.learn for f in fits]), "_score": _numbers([f.score for f in fits])}).select(*wanted, "_learn", "_score")
    binned = stage(with_bins(binned, features, cuts))
    labels = F.array(*[F.col(f.label).cast("int") for f in fits])
    held = lambda seed: F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_003)) / 1_000_003.0 < HELD_SHARE
    by_seed = {s: i for i, s in enumerate(dict.fromkeys(f.seed for f in fits))}
    seed_at = F.array(*[F.lit(by_seed[f.seed]) for f in fits])
    use = binned.where(F.size("_learn") > 0).select("bins", "_learn", labels.alias("_y"), F.array(*[held(s) for s in by_seed]).alias("_held"))
    use = use.groupBy(*use.columns).agg(F.count("*").alias("n"))  # before rows go to several fits
    use = use.select(F.explode("_learn").alias("fit"), "bins", "_y", "_held", "n")
    use = use.select("fit", "bins", F.get("_y", "fit").alias("y"), F.when(F.get("_held", F.get(seed_at, F.col("fit"))), 0.0).otherwise(1.0).alias("u"), "n").where("y is not null")
    use = stage(use.groupBy("fit", "bins", "y", "u").agg(F.sum("n").alias("n")))
    wide = [r.fit for r in use.groupBy("fit").agg(F.count("*").alias("rows")).where(F.col("rows") > in_task).collect()]  # numbers of fits
    shape = [(f.depth, f.rounds, None if f.uses is None else [features.index(x) for x in f.uses]) for f in fits]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held)
        number = table["fit"][0].as_py()
        bins = _bytes(table["bins"])
        y, u, n = (table[c].to_numpy() for c in ("y", "u", "n"))
        order = np.lexsort((*bins.T, y, u))  # sums in the same order whatever the layout
        start, trees = grow(bins[order], y[order].astype(float), u[order], *shape[number], n[order])
        values = [number, int(n.sum()), int((n * y).sum()), len(trees), pickle.dumps((start, trees))]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["fit", "train_rows", "train_positives", "rounds_used", "model"])

    made = stage(use.where(~F.col("fit").isin(wide)).repartitionById(len(fits), "fit").mapInArrow(fit, "fit int, train_rows long, train_positives long, rounds_used long, model binary"))  # a task each
    models = {r.fit: r.model for r in made.select("fit", "model").collect()}  # one per fit, its size bounded by depth and rounds
    made = made.drop("model")
    if wide:
        spread = grow_spread(use.where(F.col("fit").isin(wide)), wide, shape, len(features))
        models |= {k: pickle.dumps((f.start, f.trees)) for k, f in spread.items()}
        made = made.union(rows.sparkSession.createDataFrame([(k, f.n, f.positives, len(f.trees)) for k, f in spread.items()], made.schema))
    shared = rows.sparkSession.sparkContext.broadcast(models)
    names = [f.name for f in fits]
    own = [*keep, *(["n"] if folded else [])]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: pickle.loads(m) for k, m in shared.value.items()}
        for b in batches:
            bins = _bytes(b.column("bins"))
            wanted = b.column("_score")
            of, fit_no = np.repeat(np.arange(b.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False)), wanted.flatten().to_numpy(zero_copy_only=False)
            for k, (start, trees) in known.items():
                at = of[fit_no == k]
                if len(at):
                    p = 1 / (1 + np.exp(-_scores(bins[at], trees, start)))
                    part = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array([names[k]] * len(at), pa.string()), part.column("y").cast(pa.int32()), pa.array(p)], names=[*own, "fit", "y", "p"])

    wanted = binned.where(F.size("_score") > 0).select(*dict.fromkeys([*keep, "y", "bins", "_score"]))
    if folded:
        wanted = wanted.groupBy(*wanted.columns).agg(F.count("*").alias("n"))
    kept = ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in own)
    scored = wanted.mapInArrow(score, f"{kept}, fit string, y int, p double")
    asked = rows.sparkSession.createDataFrame([(i, f.name, f.depth, f.rounds, f.seed) for i, f in enumerate(fits)], "number int, fit string, depth int, rounds int, seed int")
    plan = asked.join(made.withColumnRenamed("fit", "number"), "number", "left").drop("number")
    return scored, plan


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _numbers(conditions: list[Column]) -> Column:
    """Numbers of the conditions that hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
