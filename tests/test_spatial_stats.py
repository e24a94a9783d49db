"""Grid joins, ranks, quantiles and association against brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargelens.operators import matching, ranks, spatial, stats


def dist(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h)))


@pytest.fixture(scope="module")
def clouds():
    """Uneven density: a third of the points on one coordinate, a dense cluster, and a sparse rest."""
    rng = np.random.default_rng(5)
    dense = [(35.8 + x, 128.5 + y) for x, y in rng.normal(0, 0.002, (60, 2))]
    wide = [(35.6 + x, 128.3 + y) for x, y in rng.random((40, 2)) * 0.6]
    left = [(f"s{i:03d}", *p) for i, p in enumerate(dense[:30] + wide[:30] + [(35.7, 128.4)] * 30)]
    right = [(f"p{i:03d}", *p) for i, p in enumerate(dense[30:] + wide[30:] + [(35.801, 128.501)] * 20)]
    return left, right


@pytest.fixture(scope="module")
def frames(spark, clouds):
    mk = lambda rows, name: spark.createDataFrame([(i, float(a), float(b)) for i, a, b in rows], f"{name} string, lat double, lng double")
    return mk(clouds[0], "station_id"), mk(clouds[1], "poi_id")


@pytest.mark.parametrize("radius", [150.0, 1000.0, 20000.0])
def test_nearest_within_equals_full_matrix(frames, clouds, radius):
    got = {r.station_id: (r.matched_id, r.distance_m) for r in spatial.nearest_within(*frames, "poi_id", radius).collect()}
    assert len(got) == len(clouds[0])
    for sid, *p in clouds[0]:
        d, best = min((dist(p, q), pid) for pid, *q in clouds[1])
        if d <= radius:
            assert got[sid][1] == pytest.approx(d, abs=1e-6) and got[sid][0] == best
        else:
            assert got[sid] == (None, None)


def test_count_within(frames, clouds):
    got = {r.station_id: r.n for r in spatial.count_within(*frames, 2000.0, "n").collect()}
    assert got == {sid: sum(dist(p, q) <= 2000 for _, *q in clouds[1]) for sid, *p in clouds[0]}


def test_nearest_neighbors_exclude_self(frames, clouds):
    got = {}
    for r in spatial.nearest_neighbors(frames[0], 5).collect():
        got.setdefault(r.station_id, []).append((r.neighbor_rank, r.neighbor_id))
    for sid, *p in clouds[0]:
        want = [i for _, i in sorted((dist(p, q), i) for i, *q in clouds[0] if i != sid)[:5]]
        assert [i for _, i in sorted(got[sid])] == want


def _rows(spark, rows, name):
    return spark.createDataFrame([(i, float(a), float(b)) for i, a, b in rows], f"{name} string, lat double, lng double")


def test_far_points_meet_only_the_nearest_cells(spark):
    """Points at (0, 0), a pole and over the date line, next to a city; fewer right points than wanted as well."""
    rng = np.random.default_rng(7)
    city = [(f"p{i:03d}", 35.6 + x, 128.3 + y) for i, (x, y) in enumerate(rng.random((597, 2)) * 0.6)]
    right = city + [("q0", 89.0, 10.0), ("q1", -17.0, 179.9), ("q2", -17.1, -179.8)]
    far = [("a", 0.0, 0.0), ("b", 90.0, -60.0), ("c", -17.0, -179.99), ("d", -17.0, 179.99), ("e", 35.9, 128.6)]
    pts, lefts = _rows(spark, right, "poi_id"), _rows(spark, far, "station_id")
    got = {}
    for r in spatial.k_nearest(lefts, pts, "poi_id", 5).collect():
        got.setdefault((r.lat, r.lng), []).append((r.neighbor_rank, r.neighbor_id))
    for _, *p in far:
        want = [i for _, i in sorted((dist(p, q), i) for i, *q in right)[:5]]
        assert [i for _, i in sorted(got[tuple(p)])] == want
    lone = _rows(spark, far[:3], "station_id").select("lat", "lng")
    assert spatial._tree_pairs(lone, pts.select("lat", "lng", "poi_id"), 5, ["poi_id"]).count() < 150  # of 1,800
    few = spatial.k_nearest(lefts, _rows(spark, right[-2:], "poi_id"), "poi_id", 5)
    assert few.groupBy("lat", "lng").count().where("count = 2").count() == len(far)


def test_count_within_looks_into_border_pieces_only(spark, monkeypatch):
    rng = np.random.default_rng(8)
    dense = [(f"p{i:04d}", 35.8 + x, 128.5 + y) for i, (x, y) in enumerate(rng.normal(0, 0.01, (3000, 2)))] + [("z", 35.8, 128.5)] * 50
    left = [(f"s{i}", 35.8 + x, 128.5 + y) for i, (x, y) in enumerate(rng.normal(0, 0.01, (12, 2)))] + [("t", 35.8, 128.5), ("u", 0.0, 0.0)]
    for few in (4, 10**6):
        monkeypatch.setattr(spatial, "FEW", few)
        got = {r.station_id: r.n for r in spatial.count_within(_rows(spark, left, "station_id"), _rows(spark, dense, "poi_id"), 1000.0, "n").collect()}
        assert got == {sid: sum(dist(p, q) <= 1000 for _, *q in dense) for sid, *p in left}


def test_high_latitude_cells(spark):
    a = spark.createDataFrame([("a", 69.65, 18.95)], "station_id string, lat double, lng double")
    b = spark.createDataFrame([("b", 69.655, 18.97)], "poi_id string, lat double, lng double")
    assert spatial.nearest_within(a, b, "poi_id", 1000.0).first().matched_id == "b"


def test_polyline_midpoint(spark):
    v = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 3.0, 0.0), (1, 2, 3.0, 3.0), (2, 0, 5.0, 5.0)], "line_id int, seq int, x double, y double")
    for step in (1, 2, 4096):  # lines cut anywhere give the same point
        assert sorted((r.line_id, r.x, r.y) for r in spatial.polyline_midpoints(v, step).collect()) == [(1, 3.0, 0.0), (2, 5.0, 5.0)]


def test_containment_pairs(spark):
    a = spark.createDataFrame([("ab",), ("xyz",), ("q",)], "a_key string")
    b = spark.createDataFrame([("cabd",), ("y",), ("zz",)], "b_key string")
    assert sorted(map(tuple, matching.containment_pairs(a, b).collect())) == [("ab", "cabd"), ("xyz", "y")]


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(9)
    v = np.concatenate([np.full(200, 3.0), np.exp(rng.normal(0, 3, 300))])  # a hot value and a long tail
    y = (rng.random(500) < 0.3 + 0.4 * (v > 3)).astype(int)
    return v, y, spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(v, y))], "id int, x double, y int")


def test_quantiles_are_linear(values):
    v, _, df = values
    got = ranks.quantiles(df, [], "x", {"a": 0.05, "b": 0.5, "c": 0.9}).first()
    assert tuple(got) == pytest.approx(tuple(np.quantile(v, [0.05, 0.5, 0.9])))


def test_numbered(values):
    v, _, df = values
    got = [r.row_no for r in ranks.numbered(df, [], "x", ["id"]).orderBy("x", "id").collect()]
    assert got == list(range(1, len(v) + 1))


def test_association_matches_definition(values):
    v, y, df = values
    r = stats.associations(stats.feature_rows(df, ["x"], "y", []), ["feature"]).first()
    assert r.point_biserial == pytest.approx(np.corrcoef(v, y)[0, 1])
    pairs = [(a > b) + 0.5 * (a == b) for a in v[y == 1] for b in v[y == 0]]
    assert r.auc == pytest.approx(np.mean(pairs))
    assert 0 <= r.p_value <= 1 and r.q_value == pytest.approx(r.p_value)


@pytest.mark.parametrize("r,n,p", [(0.0, 50, 1.0), (0.2, 100, 0.046), (0.5, 20, 0.0248), (0.632, 10, 0.05)])
def test_two_sided_p(r, n, p):
    assert stats._two_sided_t(r, n) == pytest.approx(p, abs=6e-4)


def test_adjusted_p_is_monotone(spark):
    p = [0.01, 0.04, 0.03, 0.20]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(p)], "feature string, p double")
    for chunk in (1, 2, 4096):
        got = {r.feature: r.q_value for r in stats.benjamini_hochberg(df, [], "p", ["feature"], chunk).collect()}
        assert [got[str(i)] for i in range(4)] == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.20])


def test_average_precision_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, p double")
    m = stats.probability_metrics(df, [], "y", "p").first()
    assert m.pr_auc == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3) and m.auc == pytest.approx((0.5 + 1 + 0 + 1) / 4)
    assert F


def test_learning_curve_takes_the_earliest_rows(spark):
    import inspect

    from chargelens.operators import models

    rows = spark.range(50).selectExpr("id as station_id", "timestamp_seconds(1700000000 + (id * 7 % 50) * 600) as t", "id * 7 % 50 as place")
    ordered = models.in_time_order(rows, ["station_id", "t"])
    for f in inspect.signature(models.overfit_checks).parameters["fractions"].default:
        got = models.first_rows(ordered, f, least=5)
        assert sorted(r.place for r in got.collect()) == list(range(round(50 * f))) and got.columns == rows.columns
    assert inspect.signature(models.overfit_checks).parameters["fractions"].default == (0.2, 0.4, 0.6, 0.8, 1.0)
    assert models.first_rows(ordered, 0.2).count() == 50


def test_tour_points_of_one_name_are_not_multiplied_out(spark):
    from chargelens.operators import matching

    tour = spark.createDataFrame([(f"T{i}", "Old Tower" if i % 2 else "lake") for i in range(40)] + [("T90", None), ("T91", "none such")], "content_id string, title string")
    city = spark.createDataFrame([(i, "OldTower" if i % 2 else "Old Tower Park") for i in range(30)], "row_id int, attract_name string")
    rows = matching.tour_candidates(tour, city).collect()
    pairs = {(r.tour_key, r.city_key, r.match_score, r.needs_review, r.tour_points, r.city_points) for r in rows if r.kind == "pair"}
    assert pairs == {("OldTower", "OldTower", 1.0, False, 20, 15), ("OldTower", "OldTowerPark", 0.8, True, 20, 15)}
    assert sorted(r.point_id for r in rows if r.kind == "tour") == sorted(f"T{i}" for i in range(1, 40, 2))
    assert len([r for r in rows if r.kind == "city"]) == 30 and len(rows) == 2 + 20 + 30


def test_every_pair_of_matching_tour_points_is_returned(spark):
    from chargelens.operators import matching

    names = ["Old Tower", "OldTower", "lake", "Lake side", "", "  ", None, "Tower"]
    tour = [(f"T{i % 50}" if i % 13 else None, names[i % len(names)]) for i in range(120)]
    city = [(i % 30 if i % 11 else None, names[i * 3 % len(names)] if i % 5 else "old tower park") for i in range(90)]
    frames = spark.createDataFrame(tour, "content_id string, title string"), spark.createDataFrame(city, "row_id int, attract_name string")
    want = []
    for i, a in tour:
        for j, b in city:
            x, y = (a or "").replace(" ", ""), (b or "").replace(" ", "")
            if a and b and (x in y or y in x):
                want.append((i, a, j, b, 1.0 if x == y else 0.8, x != y))
    for block in (3, 2048):
        got = matching.tour_point_pairs(*frames, block=block)
        assert got.columns == ["content_id", "title", "row_id", "attract_name", "match_score", "needs_review"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert matching.tour_point_pairs(frames[0].limit(0), frames[1]).count() == 0
