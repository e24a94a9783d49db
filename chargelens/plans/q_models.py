"""Model evidence. Fitted models have no SQL oracle."""
from pyspark.sql import Window
from pyspark.sql import functions as F

import chargelens.plans.q_stats  # noqa: F401
from chargelens.functions.exprs import epoch_s
from chargelens.operators import candidates, labels, matching, models, panel, resampling, spatial
from chargelens.plans.common import event_ticks
from chargelens.plans.q_labels import eta_label_rows, observed
from chargelens.plans.q_spatial import stations
from chargelens.plans.registry import query
from chargelens.session import stage

FEATURES = ["current_available_count", "horizon_minutes", "hour", "weekday", "straight_km"]
KEY = ["station_id", "t"]


def arrival_frame(t):
    rows = eta_label_rows(t).select(
        "station_id", F.col("feature_as_of").alias("t"), F.col("target_available_at_arrival").cast("int").alias("y"), "current_available_count", "horizon_minutes", "straight_km",
        F.hour("feature_as_of").alias("hour"), F.weekday("feature_as_of").alias("weekday"), F.to_date("feature_as_of").alias("feature_date"), epoch_s(F.col("feature_as_of")).alias("_s"),
    )
    return candidates.time_or_row_split(stage(rows), "_s", "station_id", "feature_date").drop("_s")


def observed_frame(t):
    lab = observed(t, (15,)).where("target_available is not null")
    lab = stage(lab.select("station_id", F.col("tick_ts").alias("t"), F.col("target_available").alias("y"), F.col("available_observed").alias("available_at_t"), F.col("observed_chargers").alias("observed_at_t"),
                           F.hour("tick_ts").alias("hour"), F.weekday("tick_ts").alias("weekday"), F.to_date("tick_ts").alias("feature_date")))
    return candidates.temporal_split(lab)


@query("j9_backtest")
def _(t):
    return models.backtest(observed_frame(t), ["available_at_t", "observed_at_t", "hour", "weekday"])


@query("j10_ablation")
def _(t):
    return models.ablation(arrival_frame(t), {"base": ["current_available_count", "horizon_minutes"], "time": ["current_available_count", "horizon_minutes", "hour", "weekday"], "full": FEATURES}, KEY, leave_one_out="base")


@query("j12_stability")
def _(t):
    return models.stability(models.stability_fits(arrival_frame(t), FEATURES, KEY))


@query("j12_stability_fits")
def _(t):
    return models.stability_fits(arrival_frame(t), FEATURES, KEY)


@query("j13_overfit_checks")
def _(t):
    return models.overfit_checks(arrival_frame(t), FEATURES, KEY)


@query("j13_risk_verdict")
def _(t):
    return models.risk_verdict(stage(models.overfit_checks(arrival_frame(t), FEATURES, KEY)))


@query("j13_correlation_matrix", " union all ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, corr({a}, {b}) as corr from (select *, extract(hour from feature_as_of) as hour, isodow(feature_as_of) - 1 as weekday from x_eta_labels)" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]), num="corr")
def _(t):
    rows = eta_label_rows(t).withColumns({"hour": F.hour("feature_as_of"), "weekday": F.weekday("feature_as_of")})
    return models.correlation_matrix(rows, FEATURES)


def parking_rows(t):
    """Stations with a lot on the spot, every polled tick with the lot's state at most ten minutes old and what the station
    had 15 minutes on."""
    colocated = matching.colocated_lots(spatial.nearest_within(stations(t), t.v_lots, "lot_id", 1000.0), t.v_lots)
    pairs = labels.strong_pairs(colocated).select("station_id", "lot_id")
    own = panel.station_panel_d2(t.v_status_events, event_ticks(t)).select("station_id", "tick_ts", "tick_s", "available_count", "known_chargers").join(pairs, "station_id")
    state = F.struct("collected_at", "id")
    park = t.v_lot_realtime.groupBy("lot_id", epoch_s(F.col("collected_at")).alias("park_s")).agg(*[F.max_by(c, state).cast("double").alias(c) for c in ("remaining_spaces", "occupancy_rate")])
    rows = labels.asof_backward(own, park, "lot_id", "tick_s", "park_s", ["remaining_spaces", "occupancy_rate"], 600).where("lag_minutes is not null")
    ahead = Window.partitionBy("station_id").orderBy("tick_s").rangeBetween(15 * 60, 25 * 60)
    rows = rows.withColumn("_then", F.first(F.struct("tick_ts", "available_count")).over(ahead)).where("_then is not null")
    return rows.select(
        "station_id", (F.col("_then.available_count") >= 1).cast("int").alias("y"), (F.col("available_count") >= 1).cast("int").alias("available_now"), "known_chargers", F.hour("tick_ts").alias("hour"), F.weekday("tick_ts").alias("weekday"),
        "occupancy_rate", "remaining_spaces", F.to_date("tick_ts").alias("date"), F.to_date("_then.tick_ts").alias("target_date"))


@query("j14_with_and_without_parking")
def _(t):
    return models.with_without(parking_rows(t), ["available_now", "known_chargers", "hour", "weekday"], ["occupancy_rate", "remaining_spaces"])


def rank_sql(p):
    """AUC, average precision and Brier score of a score over the scored rows."""
    return f"""(select sum(pos * (below + neg / 2.0)) / (sum(pos) * cast(sum(neg) as double)) as auc, sum(pos * tp / cast(n as double)) / sum(pos) as pr_auc, sum(pos * (p - 1) * (p - 1) + neg * p * p) / sum(pos + neg) as brier from (
  select *, coalesce(sum(neg) over (order by p rows between unbounded preceding and 1 preceding), 0) as below, sum(pos) over (order by p desc) as tp, sum(pos + neg) over (order by p desc) as n from (select {p} as p, sum(y) as pos, sum(1 - y) as neg from v_scored group by 1)))"""


OTHER_SCORE = "(cast(l_suppkey * 13 % 100 as double) + 0.5) / 100"


@query("j14_paired_deltas", f"select b.auc - a.auc as auc_delta, b.pr_auc - a.pr_auc as pr_auc_delta, b.brier - a.brier as brier_delta, 20 as replicates from {rank_sql('score')} a, {rank_sql(OTHER_SCORE)} b", num="auc_delta pr_auc_delta brier_delta")
def _(t):
    scored = t.v_scored.select(F.col("l_suppkey").alias("unit"), "y", F.explode(F.create_map(F.lit("score"), F.col("score"), F.lit("other"), F.expr(OTHER_SCORE))).alias("model", "p"))
    d = resampling.paired_deltas(resampling.replicate_metrics(scored, "model", "unit", "y", "p", 20), "score", "other")
    return d.select("auc_delta", "pr_auc_delta", "brier_delta", F.col("auc_replicates").alias("replicates"))
