"""Boosted fits side by side and the paired bootstrap, against plain versions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from chargelens.operators import boosting, models, resampling, stats


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 1500
    a, b, c = rng.normal(size=n), rng.integers(0, 5, n), rng.random(n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * np.where(np.abs(a) > 0.8, 1.0, -1.0) + (b == 2) * 2)))).astype(int)
    a[rng.random(n) < 0.1] = np.nan
    rows = [(i, f"s{i % 37}", int(y[i]), None if np.isnan(a[i]) else float(a[i]), float(b[i]), float(c[i]), "train" if i % 3 else "test") for i in range(n)]
    return spark.createDataFrame(rows, "k int, station_id string, y int, a double, b double, c double, split string")


def _auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


def test_fits_learn_interactions_and_do_not_depend_on_layout(spark, table):
    train, test = F.col("split") == "train", F.col("split") == "test"
    fits = [boosting.Fit("whole", train, test), boosting.Fit("short", train, test, depth=2, rounds=5), boosting.Fit("noise", train, test, uses=("c",))]
    got = {}
    for parts in (1, 5):
        scored, plan = boosting.run_fits(table.repartition(parts), ["a", "b", "c"], fits, ["k"], ["k"])
        got[parts] = {(r.fit, r.k): r.p for r in scored.collect()}
        made = {r.fit: r for r in plan.collect()}
    assert got[1] == got[5] and len(got[1]) == 3 * 500
    assert made["whole"].train_rows == 1000 and made["whole"].depth == 6 and made["short"].rounds_used == 5
    y = {r.k: r.y for r in table.collect()}
    auc = {n: _auc(*map(np.array, zip(*[(y[k], p) for (f, k), p in got[1].items() if f == n]))) for n in ("whole", "short", "noise")}
    assert auc["whole"] > 0.75 and auc["short"] > 0.7 and abs(auc["noise"] - 0.5) < 0.1


def test_one_round_takes_the_best_split():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 8, (400, 2)).astype(np.uint8)
    g, h = rng.normal(size=400) + (bins[:, 1] > 4), np.ones(400)
    (feature, cut, missing_left, left, value, grown), add = boosting._tree(bins, g, h, 1, [0, 1])
    best = (0, None)
    for f in (0, 1):
        for c in range(8):
            for m in (True, False):
                go = np.where(bins[:, f] == 0, not m, bins[:, f] > c)
                if 50 <= go.sum() <= 350:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (go, ~go)) - g.sum() ** 2 / (h.sum() + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, go)
    values = np.where(best[1], -g[best[1]].sum() / (best[1].sum() + 1), -g[~best[1]].sum() / ((~best[1]).sum() + 1)) * boosting.RATE
    assert grown == 1 and np.allclose(add, values)


def test_few_rows_one_class_and_missing_features(spark):
    rows = spark.createDataFrame([(1, 1, None, "train"), (2, 1, None, "train"), (3, 1, None, "test")], "k int, y int, a double, split string")
    scored, plan = boosting.run_fits(rows, ["a"], [boosting.Fit("f", F.col("split") == "train", F.col("split") == "test"), boosting.Fit("none", F.lit(False), F.lit(True))], ["k"], ["k"])
    got = scored.collect()
    assert [r.fit for r in got] == ["f"] and got[0].p > 0.99
    assert {r.fit: r.train_rows for r in plan.collect()} == {"f": 2, "none": None}


def test_replicates_equal_plain_weighting(spark):
    rng = np.random.default_rng(9)
    n = 400
    station, y = rng.integers(0, 12, n), rng.integers(0, 2, n)
    p = {"x": np.round(rng.random(n) * 0.6 + y * 0.3, 1), "z": np.round(rng.random(n), 2)}
    rows = spark.createDataFrame([(m, f"s{s}", int(t), float(v)) for m in p for s, t, v in zip(station, y, p[m])], "model string, station_id string, y int, p double")
    metrics = resampling.replicate_metrics(rows.repartition(3), "model", "station_id", "y", "p", 20)
    got = {(r.model, r.replicate): r for r in metrics.collect()}
    ids = {r.station_id: r.u for r in rows.select("station_id", F.xxhash64("station_id").alias("u")).distinct().collect()}
    w = resampling.unit_weights(np.array([ids[f"s{s}"] for s in station], np.int64), 20)
    assert 0.5 < w[:, 1:].mean() < 1.5
    deltas = []
    for r in range(21):
        plain = {}
        for m, v in p.items():
            pos, neg = (y == 1) * w[:, r], (y == 0) * w[:, r]
            auc = (pos[:, None] * neg[None, :] * ((v[:, None] > v[None, :]) + 0.5 * (v[:, None] == v[None, :]))).sum() / pos.sum() / neg.sum()
            at = [(pos[v >= x].sum(), w[v >= x, r].sum(), pos[v == x].sum()) for x in np.unique(v)]
            ap = sum(k * tp / a for tp, a, k in at if a) / pos.sum()
            plain[m] = (auc, ap, (w[:, r] * (v - y) ** 2).sum() / w[:, r].sum())
            assert np.allclose(plain[m], [got[m, r].auc, got[m, r].pr_auc, got[m, r].brier])
        deltas.append([b - a for a, b in zip(plain["x"], plain["z"])])
    one = resampling.paired_deltas(metrics, "x", "z").first()
    for i, c in enumerate(resampling.METRICS):
        low, high = np.quantile([d[i] for d in deltas[1:]], [0.025, 0.975])
        assert np.allclose([one[f"{c}_delta"], one[f"{c}_low"], one[f"{c}_high"]], [deltas[0][i], low, high]) and one[f"{c}_replicates"] == 20


def test_no_row_crosses_from_train_to_test(spark):
    rows = spark.createDataFrame([(d, t) for d in range(10) for t in (d, d + 1) if t < 10], "d int, t int")
    rows = rows.select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("d")).alias("date"), F.date_add(F.lit("2026-01-01").cast("date"), F.col("t")).alias("target_date"))
    got = models.split_without_crossing(rows).groupBy("split").agg(F.max("target_date").cast("string").alias("last"), F.min("date").cast("string").alias("first"), F.count("*").alias("n")).collect()
    assert {r.split: (r.first, r.last, r.n) for r in got} == {"train": ("2026-01-01", "2026-01-08", 15), "test": ("2026-01-09", "2026-01-10", 3)}


def test_comparison_says_why_it_is_skipped(spark, table):
    rows = table.select("station_id", "y", "a", "b", F.date_add(F.lit("2026-01-01").cast("date"), F.col("k") % 20).alias("date")).withColumn("target_date", F.col("date"))
    got = {r.model: r for r in models.with_without(rows, ["b"], ["a"], 30).collect()}
    assert got["difference"].skipped is None and got["difference"].auc_low <= got["difference"].auc_high
    assert abs(got["with"].auc - got["without"].auc - got["difference"].auc) < 1e-12
    few = models.with_without(rows.limit(100), ["b"], ["a"], 30).collect()
    assert {r.skipped for r in few} == {"too few labels or days"}


def test_date_blocks_are_even(spark):
    rows = spark.range(8).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("feature_date"))
    got = [r.block for r in models.date_blocks(rows).orderBy("feature_date").collect()]
    assert got == [i for i, part in enumerate(np.array_split(np.arange(8), 3)) for _ in part]
    assert {r.block for r in models.date_blocks(rows.limit(5)).collect()} == {None}


def test_blocked_auc_against_plain_bootstrap(spark):
    rng = np.random.default_rng(2)
    n = 600
    x, y, block = np.round(rng.normal(size=n) + 0.0, 1), rng.integers(0, 2, n), rng.choice(["a", "b", "c", "d"], n, p=[0.7, 0.1, 0.1, 0.1])
    x = x + y * 0.5
    rows = spark.createDataFrame([("f", float(v), int(t), b) for v, t, b in zip(x, y, block)] + [("g", 1.0, 1, "a"), ("g", 2.0, 0, "a")], "feature string, x double, y int, block string")
    got = {r.feature: r for r in stats.blocked_auc(rows.repartition(4), "block", 15, 100).collect()}
    names = sorted(set(block))
    times = stats.draws(15, 4)
    size = np.array([(block == b).sum() for b in names])
    weight = np.minimum(1, 100 / size)
    auc = []
    for t in times:
        w = np.array([t[names.index(b)] * weight[names.index(b)] for b in block])
        pos, neg = w * (y == 1), w * (y == 0)
        a = (pos[:, None] * neg[None, :] * ((x[:, None] > x[None, :]) + 0.5 * (x[:, None] == x[None, :]))).sum() / pos.sum() / neg.sum()
        auc.append(max(a, 1 - a))
    assert np.allclose([got["f"].blocked_auc, got["f"].auc_ci_low, got["f"].auc_ci_high], [auc[0], *np.quantile(auc[1:], [0.025, 0.975])]) and got["f"].replicates == 15
    assert got["g"].blocked_auc is None and got["g"].replicates == 0 and got["g"].blocks == 1


def _plain_information(x, y, k=3):
    """The estimator row by row, with the digamma of whole numbers as harmonic sums."""
    psi = np.concatenate([[0, -0.5772156649015329], -0.5772156649015329 + np.cumsum(1 / np.arange(1, len(x) + 1))])
    keep = np.array([(y == t).sum() > 1 for t in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for v, t in zip(x, y):
        same = np.sort(np.abs(x[y == t] - v))[1:]
        own = min(k, len(same))
        r = same[own - 1] * (1 - 1e-9)
        total += psi[own] - psi[len(same) + 1] - psi[((x >= v - r) & (x <= v + r)).sum()]
    return max(0.0, psi[len(x)] + total / len(x)) if len(x) else None


def test_mutual_information_equals_row_by_row(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 300)
    cases = {"smooth": rng.normal(size=300) + y, "ties": np.round(rng.normal(size=300) + y, 1), "hot": np.where(rng.random(300) < 0.4, 1.0, rng.random(300)), "noise": rng.random(300)}
    rows = [(f, float(v), int(t)) for f, xs in cases.items() for v, t in zip(xs, y)] + [("few", 1.0, 1), ("few", 2.0, 1), ("few", 3.0, 0), ("smooth", None, 1)]
    df = spark.createDataFrame(rows, "feature string, x double, y int").repartition(5)
    want = {f: _plain_information(xs, y) for f, xs in cases.items()} | {"few": _plain_information(np.array([1.0, 2.0, 3.0]), np.array([1, 1, 0]))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("2", "23"):  # 23 ranges hold fewer values than neighbours are wanted
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.feature: r.mutual_information for r in stats.mutual_information(df, ["feature"]).collect()}
            assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_equal_rows_fit_and_score_as_one(spark):
    rng = np.random.default_rng(6)
    n = 4000
    a, b = rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = (rng.random(n) < 0.15 + 0.2 * a).astype(int)
    rows = spark.createDataFrame([(i, int(y[i]), float(a[i]), float(b[i]), "train" if i % 3 else "test") for i in range(n)], "k int, y int, a double, b double, split string")
    fits = [boosting.Fit("f", F.col("split") == "train", F.col("split") == "test", rounds=10)]
    each, _ = boosting.run_fits(rows, ["a", "b"], fits, ["k"], ["split"])
    once, plan = boosting.run_fits(rows, ["a", "b"], fits, ["k"], ["split"], folded=True)
    assert once.count() <= 4 * 3 * 2 and once.agg(F.sum("n")).first()[0] == each.count()
    got, want = models.fit_table(once, plan, ["split"]).first(), models.fit_table(each.withColumn("n", F.lit(1)), plan, ["split"]).first()
    assert got.n == want.n == len([i for i in range(n) if i % 3 == 0])
    for c in ("auc", "pr_auc", "brier", "logloss", "precision", "recall", "negative_recall"):
        assert got[c] == pytest.approx(want[c], abs=1e-9)


def test_growing_sees_repeated_rows_as_their_number():
    rng = np.random.default_rng(7)
    bins, y = rng.integers(0, 5, (3000, 2)).astype(np.uint8), rng.integers(0, 2, 3000).astype(float)
    u = (rng.random(3000) >= 0.1).astype(float)
    rows, n = np.unique(np.column_stack([bins, y, u]), axis=0, return_counts=True)
    start, trees = boosting.grow(bins, y, u, 4, 8)
    start_, trees_ = boosting.grow(rows[:, :2].astype(np.uint8), rows[:, 2], rows[:, 3], 4, 8, None, n)
    assert len(rows) < 120 and np.allclose(boosting._scores(bins, trees, start), boosting._scores(bins, trees_, start_))


def _unequal(n, seed=12):
    """Rows of which few are negative, so that a balanced sample of them would leave most positives out."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 30, n), rng.integers(0, 6, n)
    y = (rng.random(n) > 0.004 + 0.01 * (a > 20)).astype(int)
    day = np.sort(rng.integers(0, 8, n))
    split = np.where(day < 5, "train", np.where(day < 6, "valid", "test"))
    return [(int(i % 211), int(i), int(y[i]), float(a[i]), float(b[i]), f"2024-03-{day[i] + 1:02d}", str(split[i])) for i in range(n)]


@pytest.fixture(scope="module")
def unequal(spark):
    rows = spark.createDataFrame(_unequal(90_000), "station_id long, t long, y int, a double, b double, feature_date string, split string")
    return rows.withColumns({"t": F.timestamp_seconds("t"), "feature_date": F.to_date("feature_date")}).localCheckpoint()


def _train_rows(frame):
    train = frame.where("split = 'train'")
    return train.count(), train.where("y = 1").count()


def test_ablation_learns_from_every_train_row(spark, unequal):
    got = models.ablation(unequal, {"both": ["a", "b"], "one": ["a"]}, ["station_id", "t"]).collect()
    assert {(r.spec, r.split) for r in got} == {(s, p) for s in ("both", "one") for p in ("valid", "test")}
    assert {(r.train_rows, r.train_positives) for r in got} == {_train_rows(unequal)}


@pytest.mark.parametrize("uses", [None, ("c", "a")])
def test_fits_grown_by_all_tasks_equal_those_of_one_task(spark, table, uses):
    train, test = F.col("split") == "train", F.col("split") == "test"
    fits = [boosting.Fit("deep", train, test, depth=4, rounds=6, uses=uses), boosting.Fit("short", train, test, depth=2, rounds=3, seed=7), boosting.Fit("none", F.lit(False), test)]
    before, boosting.STAGED_ROUNDS = boosting.STAGED_ROUNDS, 2
    try:
        (one, plan), (all_, plan_) = (boosting.run_fits(table, ["a", "b", "c"], fits, ["k"], ["k"], in_task=m) for m in (10**9, 0))
    finally:
        boosting.STAGED_ROUNDS = before
    want, got = ({(r.fit, r.k): r.p for r in x.collect()} for x in (one, all_))
    assert sorted(plan.collect()) == sorted(plan_.collect()) and got.keys() == want.keys() and len(got) == 2 * 500
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_fits_grown_by_all_tasks_stop_early(spark):
    rng = np.random.default_rng(3)
    n = 1200
    rows = spark.createDataFrame([(i, int(y), float(a), "train") for i, (y, a) in enumerate(zip(rng.integers(0, 2, n), rng.random(n)))], "k int, y int, a double, split string")
    fits = [boosting.Fit("noise", F.lit(True), F.lit(True), depth=1, rounds=60)]
    (one, plan), (all_, plan_) = (boosting.run_fits(rows, ["a"], fits, ["k"], ["k"], in_task=m) for m in (10**9, 0))
    assert plan.first() == plan_.first() and plan.first().rounds_used < 60
    want, got = ({r.k: r.p for r in x.collect()} for x in (one, all_))
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_cut_points_are_evenly_spaced_ranks(spark):
    rng = np.random.default_rng(8)
    few, many = rng.integers(0, 9, 5000).astype(float), np.round(rng.normal(size=5000), 2)
    many[:1500] = 0.25
    frame = spark.createDataFrame(list(zip(few.tolist(), many.tolist())), "few double, many double").repartition(5)
    got = boosting.cut_points(frame, ["many", "few"])
    x, n = np.unique(many, return_counts=True)
    upto = np.cumsum(n)
    x = np.unique(x[np.minimum(np.searchsorted(upto, np.arange(1, boosting.BINS) / boosting.BINS * upto[-1]), len(x) - 1)])
    assert np.array_equal(got[0], (x[1:] + x[:-1]) / 2) and np.array_equal(got[1], np.arange(8) + 0.5)


def test_stability_refits_learn_from_every_row(spark, unequal):
    fits = {r.fit: r for r in models.stability_fits(unequal, ["a", "b"], ["station_id", "t"]).collect()}
    assert len(fits) == 12
    assert {(fits[f"seed_{s}"].train_rows, fits[f"seed_{s}"].train_positives) for s in models.SEEDS} == {_train_rows(unequal)}
    blocks = {r.block: r["count"] for r in unequal.join(models.date_blocks(unequal), "feature_date").groupBy("block").count().collect()}
    assert {(b, fits[f"without_block_{b}_seed_{s}"].train_rows) for b in blocks for s in models.SEEDS} == {(b, 90_000 - n) for b, n in blocks.items()}


def test_overfit_checks_learn_from_every_train_row(spark, unequal):
    n, positives = _train_rows(unequal)
    checks = models.overfit_checks(unequal, ["a", "b"], ["station_id", "t"], fractions=(0.5, 1.0), depths=(2,), round_counts=(5,))
    fits = {(r.fit, r.split): r for r in checks.collect()}
    for name in ("model", "learning_1.0", "depth_2_rounds_5", "shuffled"):  # shuffling keeps the number of positives
        assert {(r.train_rows, r.train_positives) for (f, _), r in fits.items() if f == name} == {(n, positives)}
    assert fits["learning_0.5", "test"].train_rows == n // 2 and fits["model", "train"].n == n


def test_risk_verdict_rests_on_every_train_row(spark, unequal):
    """The graded gaps are those of the plain model on all train rows."""
    checks = models.overfit_checks(unequal, ["a", "b"], ["station_id", "t"], fractions=(1.0,), depths=(2,), round_counts=(5,))
    got = {r.code: r for r in models.risk_verdict(checks.localCheckpoint()).collect()}
    x = {s: [r for r in _unequal(90_000) if r[6] == s] for s in ("train", "valid", "test")}
    bins = {s: np.array([[r[3] + 1, r[4] + 1] for r in x[s]], np.uint8) for s in x}
    y = {s: np.array([r[2] for r in x[s]], float) for s in x}
    u = unequal.where("split = 'train'").select("station_id", "t", (F.pmod(F.xxhash64(F.lit(42), "station_id", "t"), F.lit(1_000_003)) / 1_000_003.0).alias("u")).orderBy("t")
    start, trees = boosting.grow(bins["train"], y["train"], np.array([r.u for r in u.collect()]), boosting.DEPTH, boosting.ROUNDS)

    def pr_auc(s):
        p = np.round(boosting._scores(bins[s], trees, start), 9)
        values, of = np.unique(-p, return_inverse=True)
        tp, n = (np.cumsum(np.bincount(of, w, len(values))) for w in (y[s], np.ones(len(p))))
        return float((np.bincount(of, y[s], len(values)) * tp / n).sum() / y[s].sum())

    assert got["TRAIN_VALID_PR_GAP"].value == pytest.approx(pr_auc("train") - pr_auc("valid"), abs=1e-7)
    assert got["TRAIN_TEST_PR_GAP"].value == pytest.approx(pr_auc("train") - pr_auc("test"), abs=1e-7)
