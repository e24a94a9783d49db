"""Association, metrics, decisions on scored rows of the given tables and on the training set."""
from pyspark.sql import functions as F

import chargelens.plans.q_labels  # noqa: F401
from chargelens.functions.exprs import haversine_m
from chargelens.operators import quality, stats
from chargelens.plans.q_labels import eta_label_rows
from chargelens.plans.q_spatial import hav
from chargelens.plans.registry import query
from chargelens.plans.station_snapshot import station_points
from chargelens.session import stage
from chargelens.sources.views import ORACLE_CTES

FEATURES = ["f_quantity", "f_discount", "f_price", "f_tax", "f_const"]
ORACLE_CTES["x_feat"] = " union all ".join(f"select horizon, strftime(block_date, '%Y-%m') as block, y, '{f}' as feature, cast({f} as double) as x from v_scored" for f in FEATURES)


def assoc_sql(keys, src="x_feat"):
    k = ", ".join(keys)
    on = " and ".join(f"a.{c} = b.{c}" for c in keys)
    return f"""
select a.* exclude (ok), case when ok then b.point_biserial end as point_biserial, case when ok then b.spearman end as spearman, case when ok then b.auc end as auc, case when ok then greatest(b.auc, 1 - b.auc) end as directional_auc from (
  select {k}, avg(case when x is null then 1.0 else 0 end) as null_rate, count(x) as "rows", count(distinct x) as distinct_values, avg(y) filter (x is not null) as positive_rate, count(x) >= 20 and count(distinct x) >= 2 as ok from {src} group by {k}) a
left join (select {k}, case when count(distinct x) >= 2 then corr(x, y) end as point_biserial, case when count(distinct x) >= 2 then corr(r, y) end as spearman, (sum(r) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0) / (count(*) filter (y = 1) * cast(count(*) filter (y = 0) as double)) as auc from (
  select *, rank() over (partition by {k} order by x) + (count(*) over (partition by {k}, x) - 1) / 2.0 as r from {src} where x is not null) group by {k}) b on {on}"""


ASSOC_NUM = "null_rate positive_rate point_biserial spearman auc directional_auc"


def rows(t):
    return stats.feature_rows(t.v_scored, FEATURES, "y", ["horizon", F.date_format("block_date", "yyyy-MM").alias("block")])


@query("j1_associations", assoc_sql(["feature"]), num=ASSOC_NUM)
def _(t):
    return stats.associations(rows(t), ["feature"], p_values=False)


# two-sided p of a correlation r over n pairs: the tail of the density of r, with r = sin(angle), by Simpson's rule
ORACLE_CTES["x_assoc"] = assoc_sql(["feature"])
ORACLE_CTES["x_assoc_p"] = """
with a as (select feature, "rows" as n, asin(abs(point_biserial)) as lo from x_assoc where point_biserial is not null),
g as (select *, (least(pi() / 2, lo + 40 / sqrt(n)) - lo) / 4000 as h from a),
p as (select feature, least(1.0, max(h) / 3 * 2 * sum(case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end * pow(cos(lo + i * h), n - 3)) / exp(max(lgamma(0.5) + lgamma((n - 2) / 2.0) - lgamma((n - 1) / 2.0)))) as p_value from g, range(4001) s(i) group by 1)
select *, least(min(p_value * m / rn) over (order by rn desc rows unbounded preceding), 1) as q_value from (select *, count(*) over () as m, row_number() over (order by p_value, feature) as rn from p)"""


@query("j1_associations_with_p", "select a.*, p.p_value, p.q_value from x_assoc a left join x_assoc_p p using (feature)", num=ASSOC_NUM + " p_value q_value")
def _(t):
    return stats.associations(rows(t), ["feature"])


@query("j2_associations_by_horizon", assoc_sql(["horizon", "feature"]), num=ASSOC_NUM)
def _(t):
    return stats.associations(rows(t), ["horizon", "feature"], p_values=False)


def boot_sql(src, replicates=100, block_rows=1000):
    """Balanced AUC per feature and replicate over the blocks of a feature table; replicate -1 has every block once."""
    return f"""
with blk as (select block, row_number() over (order by block) - 1 as i from (select distinct block from {src})), n as (select count(*) as n from blk),
m as (select r as replicate, ((((r * 7919 + d * 104729 + 12345) % 2147483647) * 48271 % 2147483647) * 69621 % 2147483647) % n as i, count(*) as m from range({replicates}) a(r), n, range(n.n) b(d) group by 1, 2 union all select -1, i, 1 from blk),
c as (select feature, block, x, sum(y) as pos, sum(1 - y) as neg from {src} where x is not null group by 1, 2, 3),
f as (select feature, block, least(1.0, {block_rows}.0 / sum(pos + neg)) as f from c group by 1, 2),
w as (select feature, replicate, x, sum(pos * m * f) as pos, sum(neg * m * f) as neg from c join f using (feature, block) join blk using (block) join m using (i) group by 1, 2, 3),
u as (select *, coalesce(sum(neg) over (partition by feature, replicate order by x rows between unbounded preceding and 1 preceding), 0) as before from w),
a as (select feature, replicate, case when count(*) >= 2 and sum(pos) > 0 and sum(neg) > 0 then sum(pos * (before + neg / 2.0)) / (sum(pos) * cast(sum(neg) as double)) end as auc from u group by 1, 2),
e as (select feature, max(greatest(auc, 1 - auc)) filter (replicate = -1) as point, count(auc) filter (replicate >= 0) as replicates, quantile_cont(greatest(auc, 1 - auc), 0.025) filter (replicate >= 0) as low, quantile_cont(greatest(auc, 1 - auc), 0.975) filter (replicate >= 0) as high from a group by 1)
select feature, blocks, case when ok then replicates else 0 end as replicates, case when ok then point end as blocked_auc, case when ok then low end as auc_ci_low, case when ok then high end as auc_ci_high
from (select *, blocks >= 2 and point is not null as ok from e join (select feature, count(*) as blocks from f group by 1) using (feature))"""


ORACLE_CTES["x_boot"] = boot_sql("x_feat")


@query("j3_blocked_auc_interval", "select * from x_boot", num="blocked_auc auc_ci_low auc_ci_high")
def _(t):
    return stats.blocked_auc(rows(t), "block")


@query("j4_benjamini_hochberg", """
select row_key, horizon, least(min(raw) over (partition by horizon order by rn desc rows unbounded preceding), 1) as q_value from (
  select *, p * count(*) over (partition by horizon) / rn as raw from (select row_key, horizon, p, row_number() over (partition by horizon order by p, row_key) as rn from (select min(row_key) as row_key, horizon, l_partkey, pow(min(score), 6) as p from v_scored group by horizon, l_partkey)))""", num="q_value")
def _(t):
    p = t.v_scored.groupBy("horizon", "l_partkey").agg(F.min("row_key").alias("row_key"), F.pow(F.min("score"), F.lit(6)).alias("p"))
    return stats.benjamini_hochberg(p, ["horizon"], "p", ["row_key"]).select("row_key", "horizon", "q_value")


# digamma of n is the harmonic sum up to n - 1 less Euler's constant
@query("j5_mutual_information", """
with c as (select feature, cast(y as int) as y, cast(x as double) as x, count(*) as n from x_feat where x is not null group by 1, 2, 3), l as (select feature, y, sum(n) as ly from c group by 1, 2 having sum(n) > 1),
p as (select c.*, ly, least(3, ly - 1) as k from c join l using (feature, y)), t as (select feature, sum(ly) as nn from l group by 1), a as (select feature, x, sum(n) as n from p group by 1, 2),
h as (select i + 1 as n, coalesce(sum(1.0 / nullif(i, 0)) over (order by i), 0) - 0.5772156649015329 as psi from range((select cast(max(nn) + 1 as bigint) from t)) r(i)),
d as (select p.feature, p.y, p.x, p.k, abs(q.x - p.x) as d, sum(q.n) - max(case when q.x = p.x then 1 else 0 end) as n from p join p q on q.feature = p.feature and q.y = p.y group by 1, 2, 3, 4, 5),
w as (select *, sum(n) over (partition by feature, y, x order by d) as upto from d),
r as (select feature, y, x, min(d) as r from w where upto >= k group by 1, 2, 3),
m as (select r.feature, r.y, r.x, sum(a.n) as m from r join a on a.feature = r.feature and a.x >= r.x - r.r * (1 - 1e-9) and a.x <= r.x + r.r * (1 - 1e-9) group by 1, 2, 3)
select feature, greatest(0.0, max(hn.psi) + sum(p.n * (hk.psi - hl.psi - hm.psi)) / max(nn)) as mutual_information from p join m using (feature, y, x) join t using (feature) join h hk on hk.n = p.k join h hl on hl.n = p.ly join h hm on hm.n = m.m join h hn on hn.n = t.nn group by 1""", num="mutual_information")
def _(t):
    return stats.mutual_information(rows(t), ["feature"])


ORACLE_CTES["x_assoc_h"] = assoc_sql(["horizon", "feature"])
REQUIRED = ("f_quantity",)
ORACLE_CTES["x_decisions"] = """
select * exclude (d, useful), d.decision as decision, d.reason as reason from (
select *, case when distinct_values < 2 then {'decision': 'EXCLUDE', 'reason': 'one value at most'} when null_rate > 0.9 then {'decision': 'HOLD', 'reason': 'nearly always missing'} when feature = 'f_quantity' then {'decision': 'RETAIN_FOR_ABLATION', 'reason': 'required by the domain'}
  when useful and q_value < 0.05 and auc_ci_low > 0.5 then {'decision': 'RETAIN_CANDIDATE', 'reason': 'significant, interval above chance, stable direction'} when useful then {'decision': 'RETAIN_CANDIDATE', 'reason': 'discriminates, stable direction'} else {'decision': 'HOLD_FOR_HGB_INTERACTION_TEST', 'reason': 'weak on its own'} end as d
from (select *, coalesce(practical_auc >= 0.55, false) and direction_stable as useful from (
  select a.feature, a.null_rate, a.distinct_values, a.directional_auc, b.blocked_auc, case when a.directional_auc is null then b.blocked_auc when b.blocked_auc is null then a.directional_auc else least(a.directional_auc, b.blocked_auc) end as practical_auc, b.auc_ci_low, p.q_value, s.direction_stable
  from x_assoc a left join x_boot b using (feature) left join x_assoc_p p using (feature)
  left join (select feature, count(distinct sign(point_biserial)) filter (sign(point_biserial) <> 0) <= 1 as direction_stable from x_assoc_h group by 1) s using (feature))))"""


def decisions(t, part=None):
    r = rows(t) if part is None else rows(t).where(part)
    blocked = stats.blocked_auc(r, "block").select("feature", "blocked_auc", "auc_ci_low")
    return stats.feature_decisions(stats.associations(r, ["feature"]), stats.associations(r, ["horizon", "feature"], p_values=False), blocked, REQUIRED)


@query("j6_feature_decisions", "select * exclude (distinct_values) from x_decisions", num="null_rate directional_auc blocked_auc practical_auc auc_ci_low q_value")
def _(t):
    return decisions(t)


@query("i19_decision_deltas", """
with h as (select * replace (case when feature = 'f_price' then 'HOLD' else decision end as decision) from x_decisions where feature <> 'f_tax')
select feature, b.decision as decision_baseline, b.directional_auc as auc_baseline, c.decision as decision_current, c.directional_auc as auc_current, b.decision is distinct from c.decision as decision_changed, c.directional_auc - b.directional_auc as auc_delta from h b full join x_decisions c using (feature)""", num="auc_baseline auc_current auc_delta")
def _(t):
    cur = stage(decisions(t))
    base = cur.where("feature <> 'f_tax'").withColumn("decision", F.when(F.col("feature") == "f_price", "HOLD").otherwise(F.col("decision")))
    return quality.decision_deltas(base, cur)


AP = """(select sum(pos * tp / cast(n as double)) / max(pp) from (select *, sum(pos) over w as tp, sum(k) over w as n, sum(pos) over () as pp from (select score, sum(y) as pos, count(*) as k from v_scored group by 1) window w as (order by score desc)))"""
AUC = """(select (sum(r) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0) / (count(*) filter (y = 1) * cast(count(*) filter (y = 0) as double)) from (select y, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r from v_scored))"""


@query("j7_probability_metrics", f"""
select count(*) as n, avg(pow(score - y, 2)) as brier, -avg(y * ln(score) + (1 - y) * ln(1 - score)) as logloss, count(*) filter (score >= 0.5 and y = 1) / cast(count(*) filter (score >= 0.5) as double) as precision, count(*) filter (score >= 0.5 and y = 1) / cast(sum(y) as double) as recall, {AUC} as auc, {AP} as pr_auc from v_scored""", num="brier logloss precision recall auc pr_auc")
def _(t):
    return stats.probability_metrics(t.v_scored, [], "y", "score")


@query("j8_hit_ndcg_at_5", """
with g as (select block_date from v_scored group by 1 having max(y) = 1), k as (select *, row_number() over (partition by block_date order by score desc, row_key, l_suppkey) as rn from (select block_date, row_key, l_suppkey, max(y) as y, max(score) as score from v_scored group by 1, 2, 3)),
p as (select block_date, max(y) as hit, sum(y / log2(rn + 1)) as dcg, sum(y) as c from k join g using (block_date) where rn <= 5 group by 1)
select avg(hit) as hit_at_5, avg(case when c > 0 then dcg / (case c when 1 then 1 when 2 then 1 + 1 / log2(3) when 3 then 1 + 1 / log2(3) + 0.5 when 4 then 1.5 + 1 / log2(3) + 1 / log2(5) else 1.5 + 1 / log2(3) + 1 / log2(5) + 1 / log2(6) end) else 0 end) as ndcg_at_5, count(*) as n_groups from p""", num="hit_at_5 ndcg_at_5")
def _(t):
    s = t.v_scored.groupBy("block_date", "row_key", "l_suppkey").agg(F.max("y").alias("y"), F.max("score").alias("score"))
    s = s.withColumn("tie", F.struct("row_key", "l_suppkey"))
    return stats.hit_ndcg(s, "block_date", "y", "score", "tie")


@query("j11_univariate", """
with d as (select feature, sum(pos * tp / cast(n as double)) / max(pp) as up from (select *, sum(pos) over w as tp, sum(k) over w as n, sum(pos) over (partition by feature) as pp from (select feature, x, sum(y) as pos, count(*) as k from x_feat where x is not null group by 1, 2) window w as (partition by feature order by x desc)) group by 1),
a as (select feature, sum(pos * tp / cast(n as double)) / max(pp) as down from (select *, sum(pos) over w as tp, sum(k) over w as n, sum(pos) over (partition by feature) as pp from (select feature, x, sum(y) as pos, count(*) as k from x_feat where x is not null group by 1, 2) window w as (partition by feature order by x)) group by 1)
select feature, null_rate, distinct_values, directional_auc, case when directional_auc is not null then case when point_biserial >= 0 then up else down end end as pr_auc_univ from x_assoc left join d using (feature) left join a using (feature)""", num="null_rate directional_auc pr_auc_univ")
def _(t):
    return stats.univariate(rows(t))


CENTRE = (35.8714, 128.6014)  # fixed values: city centre
ORACLE_CTES["x_coord"] = f"""
select feature, x, y, block from (select {hav('c', 's')} / 1000 as km, s.lat, s.lng, cast(l.target_available_at_arrival as int) as y, cast(cast(feature_as_of as date) as string) as block
  from x_eta_labels l join x_stations s using (station_id), (select cast(35.8714 as double) as lat, cast(128.6014 as double) as lng) c) unpivot include nulls (x for feature in (km, lat, lng))"""
ORACLE_CTES["x_boot_coord"] = boot_sql("x_coord")


@query("j15_coordinate_features", "select a.*, b.blocked_auc, b.auc_ci_low, case when directional_auc is null then 'INCONCLUSIVE' when least(directional_auc, blocked_auc) >= 0.60 and auc_ci_low > 0.5 then 'CANDIDATE' when least(directional_auc, blocked_auc) >= 0.55 and auc_ci_low > 0.5 then 'WEAK_CANDIDATE' else 'DROP_LIKELY' end as decision from ("
       + assoc_sql(["feature"], "x_coord") + ") a left join x_boot_coord b using (feature)", num=ASSOC_NUM + " blocked_auc auc_ci_low")
def _(t):
    lab = eta_label_rows(t).join(station_points(t).select("station_id", "lat", "lng"), "station_id")
    lab = lab.withColumns({"km": haversine_m(F.lit(CENTRE[0]), F.lit(CENTRE[1]), F.col("lat"), F.col("lng")) / 1000, "y": F.col("target_available_at_arrival").cast("int"), "block": F.to_date("feature_as_of").cast("string")})
    r = stage(stats.feature_rows(lab, ["km", "lat", "lng"], "y", ["block"]))
    a = stats.associations(r, ["feature"], p_values=False).join(stats.blocked_auc(r, "block").select("feature", "blocked_auc", "auc_ci_low"), "feature", "left")
    practical = F.least("directional_auc", "blocked_auc")
    sure = F.col("auc_ci_low") > 0.5
    return a.withColumn("decision", F.when(F.col("directional_auc").isNull(), "INCONCLUSIVE").when((practical >= 0.60) & sure, "CANDIDATE").when((practical >= 0.55) & sure, "WEAK_CANDIDATE").otherwise("DROP_LIKELY"))


@query("j16_hold_recheck", """
with l as (select cast(target_available_at_arrival as int) as y, current_available_count / cast(n as double) as s, current_available_count = 1 as single from x_eta_labels join (select station_id, count(*) as n from v_charger_master group by 1) using (station_id))
select avg(y) filter (single) as rate_single, avg(y) filter (not single) as rate_multi, corr(s, y) as corr, count(*) as n, (select (sum(r) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0) / (count(*) filter (y = 1) * cast(count(*) filter (y = 0) as double)) from (
  select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as r from l)) as auc from l""", num="rate_single rate_multi corr auc")
def _(t):
    n = t.v_charger_master.groupBy("station_id").agg(F.count("*").alias("n"))
    lab = stage(eta_label_rows(t).join(n, "station_id").select(F.col("target_available_at_arrival").cast("int").alias("y"), (F.col("current_available_count") / F.col("n")).alias("s"), (F.col("current_available_count") == 1).alias("single")))
    return stats.hold_recheck(lab, "y", "s", "single")


@query("j17_calibration", "select cast(least(floor(score * 5), 4) as bigint) as bin, count(*) as n, avg(score) as mean_predicted, avg(y) as mean_observed from v_scored group by 1", num="mean_predicted mean_observed")
def _(t):
    return stats.calibration(t.v_scored, "y", "score")


@query("j18_roc_points", "select score as threshold, sum(pos) over w / cast(sum(pos) over () as double) as tpr, sum(neg) over w / cast(sum(neg) over () as double) as fpr from (select score, sum(y) as pos, sum(1 - y) as neg from v_scored group by 1) window w as (order by score desc)", num="threshold tpr fpr")
def _(t):
    return stats.roc_points(t.v_scored, "y", "score")


@query("j18_confusion", "select count(*) filter (score >= 0.5 and y = 1) as tp, count(*) filter (score >= 0.5 and y = 0) as fp, count(*) filter (score < 0.5 and y = 1) as fn, count(*) filter (score < 0.5 and y = 0) as tn from v_scored")
def _(t):
    return stats.confusion(t.v_scored, "y", "score")


ARRIVAL = {"f_quantity": "tmap_eta_min", "f_discount": "available_count", "f_price": "avail_ratio_t0", "f_tax": "avail_rate_lag_15m", "f_const": "hour"}


@query("j19_arrival_decisions", "select feature, directional_auc, null_rate, case feature when 'tmap_eta_min' then 'RETAIN_ALT' when 'available_count' then 'RETAIN' when 'avail_ratio_t0' then 'HOLD' when 'avail_rate_lag_15m' then 'RETAIN_FOR_ABLATION' else case when directional_auc >= 0.55 then 'RETAIN_CANDIDATE' else 'HOLD_FOR_HGB' end end as decision from (select * replace (case feature " + " ".join(f"when '{a}' then '{b}'" for a, b in ARRIVAL.items()) + " end as feature) from x_assoc)", num="directional_auc null_rate")
def _(t):
    named = stats.feature_rows(t.v_scored.withColumnsRenamed(ARRIVAL), list(ARRIVAL.values()), "y", [])
    return stats.arrival_feature_decisions(stats.associations(named, ["feature"], p_values=False))
