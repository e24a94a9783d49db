"""Model evidence with spark.ml: backtest, ablation, stability, over-fit checks."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import check, stack_checks
from chargelens.operators.boosting import Fit, run_fits
from chargelens.operators.labels import in_balanced_sample
from chargelens.operators.ranks import numbered
from chargelens.operators.resampling import METRICS, REPLICATES, paired_deltas, replicate_metrics
from chargelens.operators.stats import hit_ndcg, probability_metrics
from chargelens.session import stage


def _vectors(train: DataFrame, features: list[str], *others: DataFrame) -> list[DataFrame]:
    """Missing values filled by the training median, features assembled."""
    num = lambda df: df.withColumns({f: F.col(f).cast("double") for f in features})
    fill = Imputer(strategy="median", inputCols=features, outputCols=[f"_{f}" for f in features]).fit(num(train))
    join = VectorAssembler(inputCols=[f"_{f}" for f in features], outputCol="features")
    return [join.transform(fill.transform(num(d))).drop(*[f"_{f}" for f in features]) for d in (train, *others)]


def class_weights(train: DataFrame, y: str = "y") -> DataFrame:
    """Balanced weights from one count of both classes."""
    n, pos = train.agg(F.count("*")).scalar(), train.agg(F.sum(y)).scalar()
    return train.withColumn("weight", F.when(F.col(y) == 1, F.try_divide(n.cast("double"), 2 * pos)).otherwise(F.try_divide(n.cast("double"), 2 * (n - pos))))


def logistic_scores(train: DataFrame, score: DataFrame, features: list[str], *, weighted: bool = True, reg: Column | float = 0.01) -> DataFrame:
    """`score` with a probability column `p` from a logistic model fitted on `train` (label `y`)."""
    tr, sc = _vectors(class_weights(train) if weighted else train, features, score)
    model = LogisticRegression(labelCol="y", maxIter=100, regParam=reg, **({"weightCol": "weight"} if weighted else {})).fit(tr)
    return model.transform(sc).withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def _in(split: str) -> Column:
    return F.col("split") == split


def sampled(labels: DataFrame, key: list[str]) -> DataFrame:
    """Staged rows with `fitted`: whether a fit may learn from the row (see labels.in_balanced_sample)."""
    return stage(labels if "fitted" in labels.columns else in_balanced_sample(labels, "y", key))


def labelled(labels: DataFrame) -> DataFrame:
    """Staged rows with `fitted`: a fit may learn from every row that has a label."""
    return stage(labels.withColumn("fitted", F.col("y").isNotNull()))


def fit_table(scored: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """One row per fit and key: how it was fitted, on how many rows, and its metrics on the rows of the key. A row of
    `scored` stands for `n` equal ones."""
    scored = stage(scored)
    m = probability_metrics(scored, ["fit", *keys], "y", "p", F.col("n")).join(negative_recall(scored, ["fit", *keys], F.col("n")), ["fit", *keys])
    return plan.join(m, "fit", "left")


def backtest(labels: DataFrame, features: list[str]) -> DataFrame:
    """Persistence, station x weekday x hour rate from train with the global rate behind it, logistic and trees, on test.

    `labels`: station_id, t, y, split, available_at_t, hour, weekday and the features.
    """
    lab = sampled(labels, ["station_id", "t"])
    train, test = lab.where(_in("train")), lab.where(_in("test"))
    keys = ["station_id", "weekday", "hour"]
    hist = train.groupBy(*keys).agg(F.avg("y").alias("_h"))
    rate = train.agg(F.avg("y")).scalar()
    cols = ["station_id", "t", "y"]
    trees, _ = run_fits(lab, features, [Fit("boosted_trees", _in("train") & F.col("fitted"), _in("test"))], ["station_id", "t"], ["station_id", "t"])
    parts = [
        test.select(*cols, F.lit("persistence").alias("model"), (F.col("available_at_t") >= 1).cast("double").alias("p")),
        test.join(hist, keys, "left").select(*cols, F.lit("history_rate").alias("model"), F.coalesce("_h", rate).alias("p")),
        logistic_scores(train.where("fitted"), test, features).select(*cols, F.lit("logistic").alias("model"), "p"),
        trees.select(*cols, F.col("fit").alias("model"), "p"),
    ]
    scored = stage(_union(parts))
    ranks = [hit_ndcg(scored.where(F.col("model") == m), "t", "y", "p", "station_id").withColumn("model", F.lit(m)) for m in ("persistence", "history_rate", "logistic", "boosted_trees")]
    return probability_metrics(scored, ["model"], "y", "p").join(_union(ranks), "model")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def negative_recall(scored: DataFrame, keys: list[str], n: Column | None = None) -> DataFrame:
    neg, n = F.col("y") == 0, F.lit(1) if n is None else n
    return scored.groupBy(*keys).agg(F.try_divide(F.sum(F.when(neg & (F.col("p") < 0.5), n).otherwise(0)).cast("double"), F.sum(F.when(neg, n).otherwise(0))).alias("negative_recall"))


def ablation(labels: DataFrame, specs: dict[str, list[str]], key: list[str], *, leave_one_out: str | None = None) -> DataFrame:
    """One fit per feature set (and per feature left out of one set) on all train rows, all at once; the best by average
    precision, then negative recall, then Brier score is marked."""
    lab = labelled(labels)
    all_specs = dict(specs)
    if leave_one_out:
        full = specs[leave_one_out]
        all_specs |= {f"{leave_one_out}_without_{f}": [x for x in full if x != f] for f in full}
    features = sorted({f for fs in all_specs.values() for f in fs})
    fits = [Fit(n, _in("train") & F.col("fitted"), ~_in("train"), uses=tuple(fs)) for n, fs in all_specs.items()]
    m = stage(fit_table(*run_fits(lab, features, fits, key, ["split"], folded=True), ["split"]).withColumnRenamed("fit", "spec"))
    best = m.where("split = 'valid'").agg(F.max_by("spec", F.struct(F.col("pr_auc"), F.col("negative_recall"), -F.col("brier")))).scalar()
    return m.withColumn("is_best", F.col("spec") == best)


# fixed values: seeds, date blocks, and the spread and drift that still count as stable
SEEDS, BLOCKS, LEAST_DATES, LEAST_SCORED = (7, 21, 42), 3, 6, 2000
MOST_SPREAD = {"seed_pr_auc": 0.005, "seed_negative_recall": 0.02, "block_pr_auc": 0.02}
MOST_DRIFT = {"pr_auc": 0.02, "negative_recall": 0.05, "brier": 0.03}


def date_blocks(rows: DataFrame, date: str = "feature_date", blocks: int = BLOCKS) -> DataFrame:
    """Dates in order in `blocks` parts of equal number, earlier parts one longer; one row per date is ranked."""
    d = rows.select(date).where(F.col(date).isNotNull()).distinct().withColumns({"_i": F.row_number().over(Window.orderBy(date)) - 1, "_n": F.count("*").over(Window.partitionBy())})
    short, longer = F.floor(F.col("_n") / blocks), F.col("_n") % blocks
    edge = longer * (short + 1)
    block = F.when(F.col("_i") < edge, F.floor(F.col("_i") / (short + 1))).otherwise(longer + F.floor((F.col("_i") - edge) / F.greatest(short, F.lit(1))))
    return d.select(date, F.when(F.col("_n") >= LEAST_DATES, block).cast("int").alias("block"))


def stability_fits(labels: DataFrame, features: list[str], key: list[str], least: int = LEAST_SCORED) -> DataFrame:
    """Every refit: per seed one on all train rows, scored on valid and test, and one on all rows without each date block,
    scored on that block. `part` is the split or the block that a row's metrics are for."""
    lab = labelled(labels)
    lab = lab.join(date_blocks(lab), "feature_date", "left").withColumn("part", F.col("split"))
    ok = F.col("fitted")
    fits = [Fit(f"seed_{s}", _in("train") & ok, ~_in("train"), seed=s) for s in SEEDS]
    block = lambda b: F.coalesce(F.col("block") == b, F.lit(False))
    fits += [Fit(f"without_block_{b}_seed_{s}", ok & F.col("block").isNotNull() & ~block(b), block(b), seed=s) for b in range(BLOCKS) for s in SEEDS]
    scored, plan = run_fits(lab, features, fits, key, ["part", "block"], folded=True)
    left_out = F.col("fit").startswith("without_block")
    scored = scored.withColumn("part", F.when(left_out, F.concat(F.lit("block_"), F.col("block").cast("string"))).otherwise(F.col("part"))).drop("block")
    return fit_table(scored, plan, ["part"]).withColumn("counted", (F.col("n") >= least) | ~left_out)


def stability(fits: DataFrame) -> DataFrame:
    """One row of spreads over seeds and left-out blocks, drift from valid to test, and pass marks, from `stability_fits`."""
    fits = stage(fits)
    seeds, blocks = F.col("fit").startswith("seed_"), F.col("fit").startswith("without_block") & F.col("counted")
    on = lambda part, c: F.when(seeds & (F.col("part") == part), F.col(c))
    per_block = fits.where(blocks).groupBy("part").agg(F.avg("pr_auc").alias("a")).agg(F.stddev_samp("a")).scalar()
    one = fits.agg(
        F.count("*").alias("rows"), F.count_distinct("fit").alias("fits"), F.stddev_samp(on("test", "pr_auc")).alias("seed_pr_auc"), F.stddev_samp(on("test", "negative_recall")).alias("seed_negative_recall"), F.avg(F.when(blocks, F.col("pr_auc"))).alias("block_pr_auc_mean"),
        *[(F.avg(on("test", c)) - F.avg(on("valid", c))).alias(f"drift_{c}") for c in MOST_DRIFT],
    ).withColumn("block_pr_auc", per_block)
    one = one.withColumn("drift_ok", F.forall(F.array(*[F.abs(f"drift_{c}") <= most for c, most in MOST_DRIFT.items()]), lambda x: F.coalesce(x, F.lit(False))))
    return one.withColumns({f"{c}_ok": F.coalesce(F.col(c) <= most, F.lit(False)) for c, most in MOST_SPREAD.items()})


def shuffled_labels(df: DataFrame, key: list[str]) -> DataFrame:
    """Adds `y_shuffled`, the label of another row: two hash orders of the same rows are joined on their row numbers."""
    h = lambda seed: F.xxhash64(F.lit(seed), *key).cast("double")
    a = numbered(df.withColumn("_h", h(1)), [], "_h", key).drop("_h", "n_rows")
    b = numbered(df.select(*key, "y").withColumn("_h", h(2)), [], "_h", key).select("row_no", F.col("y").alias("y_shuffled"))
    return a.join(b, "row_no").drop("row_no")


def in_time_order(train: DataFrame, key: list[str]) -> DataFrame:
    return numbered(train.withColumn("_at", F.unix_micros(F.col("t").cast("timestamp")).cast("double")), [], "_at", key)


# fixed values: shares of the train rows of the learning curve, and depths and rounds of the capacity grid
FRACTIONS, LEAST_CURVE, DEPTHS, ROUND_COUNTS = (0.2, 0.4, 0.6, 0.8, 1.0), 2000, (3, 6, 12), (50, 200, 500)


def early(fraction: float, least: int = LEAST_CURVE) -> Column:
    """Whether a row of `in_time_order` is in the earliest share of the rows, `least` rows or more."""
    return F.col("row_no") <= F.greatest(F.floor(F.col("n_rows") * fraction), F.lit(least))


def first_rows(train: DataFrame, fraction: float, least: int = LEAST_CURVE) -> DataFrame:
    """The earliest share of the rows of `in_time_order`, with their own columns."""
    return train.where(early(fraction, least)).drop("row_no", "n_rows", "_at")


def overfit_checks(labels: DataFrame, features: list[str], key: list[str], fractions=FRACTIONS, depths=DEPTHS, round_counts=ROUND_COUNTS) -> DataFrame:
    """Every fit of the over-fit checks with its metrics per split: the model itself, learning curve by the earliest share
    of the train rows, grid of depth and rounds, and a fit on shuffled labels. Fits learn from all train rows; all
    rows of a split are scored, the train split included."""
    lab = labelled(labels)
    learned = in_time_order(shuffled_labels(lab.where(_in("train") & F.col("fitted")), key), key).withColumn("learned", F.lit(True))
    rest = lab.where(~(_in("train") & F.col("fitted")))
    rows = learned.unionByName(rest, allowMissingColumns=True).withColumn("learned", F.coalesce("learned", F.lit(False)))
    own = F.col("learned")
    fits = [Fit("model", own, F.lit(True)), *[Fit(f"learning_{f}", own & early(f), _in("test")) for f in fractions]]
    fits += [Fit(f"depth_{d}_rounds_{r}", own, F.lit(True), depth=d, rounds=r) for d in depths for r in round_counts]
    fits.append(Fit("shuffled", own, _in("test"), label="y_shuffled"))
    return fit_table(*run_fits(stage(rows), features, fits, key, ["split"], folded=True), ["split"])


# fixed values: largest gap in average precision that passes, and that only warns; least drop on shuffled labels
GAP_LIMITS = {"TRAIN_VALID_PR_GAP": (0.03, 0.05), "TRAIN_TEST_PR_GAP": (0.04, 0.06), "VALID_TEST_PR_STABLE": (0.02, 0.04)}
LEAST_DROP = 0.05


def risk_verdict(checks: DataFrame) -> DataFrame:
    """Check rows (code, status, value, threshold) on the gaps between splits and on shuffled labels, and the worst of them."""
    pr = lambda fit, split: F.max(F.when((F.col("fit") == fit) & (F.col("split") == split), F.col("pr_auc")))
    one = checks.agg(pr("model", "train").alias("train"), pr("model", "valid").alias("valid"), pr("model", "test").alias("test"), pr("shuffled", "test").alias("shuffled"))
    values = {"TRAIN_VALID_PR_GAP": F.col("train") - F.col("valid"), "TRAIN_TEST_PR_GAP": F.col("train") - F.col("test"), "VALID_TEST_PR_STABLE": F.abs(F.col("valid") - F.col("test"))}
    graded = [check(c, v, GAP_LIMITS[c][0], F.when(v <= GAP_LIMITS[c][0], "PASS").when(v <= GAP_LIMITS[c][1], "WARN").otherwise("FAIL")) for c, v in values.items()]
    drop = F.col("test") - F.col("shuffled")
    rows = stack_checks(one, *graded, check("LABEL_SHUFFLE_COLLAPSE", drop, LEAST_DROP, F.when(drop >= LEAST_DROP, "PASS").otherwise("FAIL")))
    rank = F.when(F.col("status") == "PASS", 0).when(F.col("status") == "WARN", 1).otherwise(2)
    return rows.withColumn("overall", F.max_by("status", rank).over(Window.partitionBy()))  # four rows


def correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])))


# fixed values: what a comparison over time needs at least
LEAST_LABELS, LEAST_DAYS, LEAST_TEST_ROWS, LEAST_TEST_DAYS, LEAST_STATIONS = 500, 14, 50, 2, 10


def split_without_crossing(rows: DataFrame, train: float = 0.8) -> DataFrame:
    """Rows of `date` and `target_date` whose two dates fall into the same split, by whole target dates in time order; a
    row that looks from the last train day into the first test day belongs to neither. One row per date is ranked."""
    d = rows.select(F.col("target_date").alias("_d")).distinct()
    d = d.withColumns({"_i": F.row_number().over(Window.orderBy("_d")), "_n": F.count("*").over(Window.partitionBy())})
    side = d.select("_d", F.when(F.col("_i") <= F.greatest(F.floor(F.col("_n") * train), F.lit(1)), "train").otherwise("test").alias("_s"))
    of = lambda date, name: side.withColumnsRenamed({"_d": date, "_s": name})
    both = rows.join(of("target_date", "split"), "target_date").join(of("date", "_own"), "date")
    return both.where(F.col("split") == F.col("_own")).drop("_own")


def with_without(rows: DataFrame, base: list[str], extra: list[str], replicates: int = REPLICATES, least: tuple[int, int, int, int] = (LEAST_LABELS, LEAST_DAYS, LEAST_TEST_ROWS, LEAST_TEST_DAYS)) -> DataFrame:
    """Logistic fit without and with extra features on later days, and the paired difference of AUC, average precision and
    Brier score with a 95 % interval over stations.

    `rows`: station_id, y, date, target_date and the features. Three rows: without, with, difference; metrics are NULL
    and `skipped` says why when there are too few labels, days, test rows, test days or classes; the interval needs
    LEAST_STATIONS test stations.
    """
    lab = stage(rows.where(F.col("y").isNotNull()))
    cut = stage(split_without_crossing(lab))
    n, days = lab.agg(F.count("*"), F.count_distinct("target_date")).first()
    sides = {r.split: r for r in cut.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("target_date").alias("days"), F.count_distinct("y").alias("classes"), F.count_distinct("station_id").alias("stations")).collect()}
    test = sides.get("test")
    why = None
    if n < least[0] or days < least[1]:
        why = "too few labels or days"
    elif test is None or "train" not in sides or test.n < least[2] or test.days < least[3]:
        why = "too few test rows or days"
    elif sides["train"].classes < 2 or test.classes < 2:
        why = "one class only"
    spark = lab.sparkSession
    counts = [F.lit(n).alias("labels"), F.lit(days).alias("days"), F.lit(test.n if test else 0).cast("long").alias("test_rows"), F.lit(test.stations if test else 0).cast("long").alias("test_stations")]
    names = spark.createDataFrame([(m, why) for m in ("without", "with", "difference")], "model string, skipped string").select("*", *counts)
    if why:
        return names.select("*", *[F.lit(None).cast("double").alias(c) for m in METRICS for c in (m, f"{m}_low", f"{m}_high")])
    train, later = cut.where(_in("train")), cut.where(_in("test"))
    reg = 1.0 / sides["train"].n  # one unit of penalty over all rows, as on standardised features
    scored = [logistic_scores(train, later, f, weighted=False, reg=reg).select("station_id", "y", "p", F.lit(m).alias("model")) for f, m in ((base, "without"), (base + extra, "with"))]
    metrics = stage(replicate_metrics(stage(scored[0].unionByName(scored[1])), "model", "station_id", "y", "p", replicates))
    whole = metrics.where("replicate = 0").select("model", *METRICS, *[F.lit(None).cast("double").alias(f"{m}_{e}") for m in METRICS for e in ("low", "high")])
    sure = F.lit(test.stations >= LEAST_STATIONS)
    delta = paired_deltas(metrics, "without", "with").select(F.lit("difference").alias("model"), *[F.col(f"{m}_delta").alias(m) for m in METRICS], *[F.when(sure, F.col(f"{m}_{e}")).alias(f"{m}_{e}") for m in METRICS for e in ("low", "high")])
    return names.join(whole.unionByName(delta), "model")
