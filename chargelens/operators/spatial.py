"""Distance joins on grid cells.

Both sides are first reduced to distinct coordinates (a point many rows share is one point), then joined on cell keys.
The search cell adapts to density: a point uses the finest level whose own cell already holds enough neighbours, so a
crowded area is searched with small cells. A cell's width follows its own latitude band, so no global bound is needed.
Within a radius, longitudes are taken as not crossing the date line; k-nearest has no such limit: points that no
search cell serves, at a pole or the date line go down a hierarchy of cells, nearest cells first.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargelens.functions.exprs import EARTH_M, haversine_m
from chargelens.session import stage

DEGREE_M = 111_190.0  # slightly under the true length, so neighbouring cells always cover the radius
NEAREST_LEVELS = 4
KNN_SIZES = tuple(250.0 * 2**j for j in range(12))
TREE_BITS = (4, 8, 12, 16, 20, 24)  # halvings of the globe per level of the hierarchy
PARTS = (8, 64)  # pieces of a search cell's side, when whole pieces are counted
FEW = 32  # points of a piece that are compared one by one rather than cut further
SLACK = 1e-9


# cell row and column of a point; `size` is the cell height in metres, NULL for one cell over the whole plane
_ROW = f"coalesce(floor(lat / (size / {DEGREE_M})), 0)"
_COL = (
    f"coalesce(floor(lng / ((size / {DEGREE_M}) / cos(radians(least(89.0D, (greatest(abs(crow), abs(crow + 1)) + 1) * (size / {DEGREE_M})))))), 0)"
)


def _sizes(sizes) -> Column:
    return F.array(*[F.lit(s).cast("double") for s in sizes])


def _on_levels(points: DataFrame, sizes) -> DataFrame:
    """Every point in its own cell on every level."""
    out = points.select("*", F.posexplode(_sizes(sizes)).alias("level", "size"))
    return out.withColumn("crow", F.expr(_ROW)).withColumn("ccol", F.expr(_COL)).drop("size")


def _around(points: DataFrame, sizes) -> DataFrame:
    """Every point in the 3 x 3 cells around it on its search level."""
    step = "explode(if(size is null, array(0), array(-1, 0, 1)))"
    out = points.withColumn("size", F.element_at(_sizes(sizes), F.col("level") + 1)).withColumn("dr", F.expr(step))
    out = out.withColumn("crow", F.expr(f"{_ROW} + dr")).withColumn("dc", F.expr(step))
    return out.withColumn("ccol", F.expr(f"{_COL} + dc")).drop("size", "dr", "dc")


def _filled(left: DataFrame, keyed: DataFrame, sizes, need: int) -> DataFrame:
    """Left points with the finest level whose own cell holds `need` right points, NULL if none."""
    fill = keyed.groupBy("level", "crow", "ccol").agg(F.count("*").alias("_n")).where(F.col("_n") >= need).drop("_n")
    level = _on_levels(left, sizes).join(fill, ["level", "crow", "ccol"], "left_semi").groupBy("lat", "lng").agg(F.min("level").alias("_lv"))
    return left.join(level, ["lat", "lng"], "left")


def _pairs(chosen: DataFrame, keyed: DataFrame, sizes, payload: list[str]) -> DataFrame:
    search = _around(chosen, sizes).withColumnsRenamed({"lat": "_la", "lng": "_lo"})
    return _measured(search.join(keyed, ["level", "crow", "ccol"]), payload)


def _measured(pairs: DataFrame, payload: list[str]) -> DataFrame:
    return pairs.select(
        "_la", "_lo", *payload, haversine_m(F.col("_la"), F.col("_lo"), F.col("lat"), F.col("lng")).alias("distance_m")
    ).withColumnsRenamed({"_la": "lat", "_lo": "lng"})


def _candidates(left: DataFrame, right: DataFrame, sizes, need: int, payload: list[str]) -> DataFrame:
    """Pairs of distinct left coordinates and right rows that contain the `need` nearest (within the last size).

    With `need` right points in the own cell of size s, the nearest ones lie within its diagonal, hence within the
    3 x 3 cells of the next level, whose size is 2s. Points with no such level use the last one.
    """
    left, right = stage(left), stage(right)
    keyed = _on_levels(right.select("lat", "lng", *payload), sizes)
    last = len(sizes) - 1
    if last == 0:
        chosen = left.withColumn("level", F.lit(0))
    else:
        chosen = _filled(left, keyed, sizes, need).select("lat", "lng", F.least(F.coalesce(F.col("_lv") + 1, F.lit(last)), F.lit(last)).alias("level"))
    return _pairs(chosen, keyed, sizes, payload)


# ---- boxes of points: bounds on the distance to all of them ---------------------------------------------------------

_AXES = ("x", "y", "z")


def _on_sphere(points: DataFrame) -> DataFrame:
    """Adds the place on the unit sphere. Straight distances there order like distances on the ground, at the poles and
    over the date line too."""
    la, lo = F.radians("lat"), F.radians("lng")
    return points.withColumns({"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)})


def _boxes(points: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """Per cell its points' number and the box around them."""
    ends = [f(a).alias(f"{a}{i}") for a in _AXES for i, f in ((0, F.min), (1, F.max))]
    return points.groupBy(*keys).agg(F.sum(weight).alias("n"), *ends)


def _merged(boxes: DataFrame, keys: list[Column]) -> DataFrame:
    ends = [f(f"{a}{i}").alias(f"{a}{i}") for a in _AXES for i, f in ((0, F.min), (1, F.max))]
    return boxes.groupBy(*keys).agg(F.sum("n").alias("n"), *ends)


def _with_bounds(pairs: DataFrame) -> DataFrame:
    """Adds squares of the least and the greatest straight distance from (px, py, pz) to a box."""
    low = [F.greatest(F.col(f"{a}0") - F.col(f"p{a}"), F.col(f"p{a}") - F.col(f"{a}1"), F.lit(0.0)) for a in _AXES]
    high = [F.greatest(F.abs(F.col(f"{a}0") - F.col(f"p{a}")), F.abs(F.col(f"{a}1") - F.col(f"p{a}"))) for a in _AXES]
    square = lambda v: v[0] * v[0] + v[1] * v[1] + v[2] * v[2]
    return pairs.withColumns({"near": square(low), "far": square(high)}).drop(*[f"{a}{i}" for a in _AXES for i in (0, 1)])


def _seen_from(left: DataFrame) -> DataFrame:
    return _on_sphere(left.select("lat", "lng")).withColumnsRenamed({"lat": "_la", "lng": "_lo"} | {a: f"p{a}" for a in _AXES})


def _tree_pairs(left: DataFrame, right: DataFrame, need: int, payload: list[str]) -> DataFrame:
    """Pairs of left coordinates and right rows that contain the `need` nearest at any distance.

    The globe is halved again and again in both directions. On each level a point ranks the cells it still holds by
    their greatest distance; where their points reach `need`, every cell whose least distance lies beyond is dropped, and
    the others give way to their children. A point far from everything so meets a few cells per level and the points of
    the nearest ones, not the whole table.
    """
    deep = TREE_BITS[-1]
    halved = lambda c, span: F.pmod(F.floor((F.col(c) + span / 2) / span * 2**deep).cast("long"), F.lit(2**deep))
    cells = _on_sphere(right).withColumns({"crow": halved("lat", 180), "ccol": halved("lng", 360)})
    leaves = stage(_boxes(cells, ["crow", "ccol"], F.lit(1)))
    up = lambda c, bits: F.shiftright(F.col(c), deep - bits).alias(c)
    level = lambda bits: leaves if bits == deep else _merged(leaves, [up("crow", bits), up("ccol", bits)])
    box = ["crow", "ccol", "n", *[f"{a}{i}" for a in _AXES for i in (0, 1)]]
    top = level(TREE_BITS[0]).agg(F.collect_list(F.struct(*box))).scalar()  # at most 16 x 16 cells
    seen = ["_la", "_lo", "px", "py", "pz"]
    open_cells = _seen_from(left).select(*seen, F.inline(top))
    by_far = Window.partitionBy("_la", "_lo").orderBy("far", "crow", "ccol").rowsBetween(Window.unboundedPreceding, 0)
    for i, bits in enumerate(TREE_BITS):
        if i:
            shift = bits - TREE_BITS[i - 1]
            child = level(bits).withColumns({"_pr": F.shiftright("crow", shift), "_pc": F.shiftright("ccol", shift)})
            held = open_cells.withColumnsRenamed({"crow": "_pr", "ccol": "_pc"}).drop("n")
            open_cells = held.join(child, ["_pr", "_pc"]).select(*seen, *box)
        ranked = _with_bounds(open_cells).withColumn("_upto", F.sum("n").over(by_far))
        enough = F.min(F.when(F.col("_upto") >= need, F.col("far"))).over(Window.partitionBy("_la", "_lo"))
        kept = ranked.withColumn("_enough", enough).where(F.col("_enough").isNull() | (F.col("near") <= F.col("_enough") * (1 + SLACK) + SLACK**2))
        open_cells = stage(kept.select(*seen, "crow", "ccol", "n"))
        if bits == deep or not open_cells.where(F.col("n") > FEW).limit(1).count():
            break
    rows = cells.select("lat", "lng", up("crow", bits), up("ccol", bits), *payload)
    return _measured(open_cells.select("_la", "_lo", "crow", "ccol").join(rows, ["crow", "ccol"]), payload)


def _points(df: DataFrame) -> DataFrame:
    if df.columns == ["lat", "lng"]:
        return df
    return df.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(F.col("lat").cast("double"), F.col("lng").cast("double")).distinct()


def distinct_points(df: DataFrame) -> DataFrame:
    """Distinct coordinates as a staged table, for several searches from the same points."""
    return stage(_points(df))


def nearest_within(left: DataFrame, right: DataFrame, right_id: str, radius_m: float, *, name: str = "matched_id", points: DataFrame | None = None) -> DataFrame:
    """Nearest right point within the radius per left row; unmatched rows stay with NULL. Equal distances: least id."""
    pts = right.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy(F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng")).agg(F.min(right_id).alias(name))
    sizes = [radius_m / 2 ** (NEAREST_LEVELS - i) for i in range(NEAREST_LEVELS)] + [radius_m]
    near = _candidates(_points(left) if points is None else points, pts, sizes, 1, [name]).where(F.col("distance_m") <= radius_m)
    best = near.groupBy("lat", "lng").agg(F.min(F.struct("distance_m", name)).alias("_b")).select("lat", "lng", F.col(f"_b.{name}").alias(name), "_b.distance_m")
    return left.join(best, ["lat", "lng"], "left").withColumn("matched", F.col(name).isNotNull())


def count_within(left: DataFrame, right: DataFrame, radius_m: float, name: str) -> DataFrame:
    """Number of right points within the radius per left row, 0 when none.

    Right points are counted per piece of a search cell, an eighth of its side wide. Pieces wholly inside the circle add
    their count, pieces wholly outside are dropped; only pieces that the circle cuts are looked into, by pieces an eighth
    as wide or, with few points, one by one. So a crowded place costs what lies on the circle, not what lies in it.
    """
    pts = right.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy(F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng")).agg(F.count("*").alias("_w"))
    cells = _on_sphere(pts).withColumn("size", F.lit(float(radius_m))).withColumn("crow", F.expr(_ROW)).withColumn("ccol", F.expr(_COL))
    width = F.expr(_COL.removeprefix("coalesce(floor(").removesuffix("), 0)"))  # place in cell widths
    inside = {"_fr": F.col("lat") / (radius_m / DEGREE_M) - F.col("crow"), "_fc": width - F.col("ccol")}
    part = lambda c, n: F.least(F.floor(F.col(c) * n), F.lit(n - 1))
    cells = stage(cells.withColumns(inside).withColumns({f"_p{n}": part("_fr", n) * n + part("_fc", n) for n in PARTS}).drop("size", "_fr", "_fc"))
    seen = ["_la", "_lo", "px", "py", "pz"]
    reach = (2 * F.sin(F.lit(min(float(radius_m) / (2 * EARTH_M), 1.5707963267948966)))) ** 2  # square of the straight length
    where = _around(_points(left).withColumn("level", F.lit(0)), [radius_m]).withColumnsRenamed({"lat": "_la", "lng": "_lo"}).drop("level")
    open_cells = where.join(_seen_from(_points(left)), ["_la", "_lo"])
    keys, counted, border = ["crow", "ccol"], [], []
    for n in PARTS:
        keys = [*keys, f"_p{n}"]
        pieces = _with_bounds(open_cells.join(_boxes(cells, keys, F.col("_w")), keys[:-1])).where(F.col("near") <= reach * (1 + SLACK) + SLACK**2)
        pieces = stage(pieces.withColumn("_whole", F.col("far") <= reach * (1 - SLACK)))
        counted.append(pieces.where("_whole").select("_la", "_lo", "n"))
        cut = pieces.where("not _whole")
        few = F.lit(True) if n == PARTS[-1] else F.col("n") <= FEW
        near = cut.where(few).select("_la", "_lo", *keys).join(cells.select("lat", "lng", "_w", *keys), keys)
        border.append(_measured(near, ["_w"]).where(F.col("distance_m") <= radius_m).select(F.col("lat").alias("_la"), F.col("lng").alias("_lo"), F.col("_w").alias("n")))
        open_cells = cut.where(~few).select(*seen, *keys)
    hits = counted[0]
    for more in (*counted[1:], *border):
        hits = hits.unionByName(more)
    n = hits.groupBy(F.col("_la").alias("lat"), F.col("_lo").alias("lng")).agg(F.sum("n").alias(name))
    return left.join(n, ["lat", "lng"], "left").withColumn(name, F.coalesce(name, F.lit(0)))


def k_nearest(left: DataFrame, right: DataFrame, right_id: str, k: int, *, name: str = "neighbor_id") -> DataFrame:
    """The k nearest right rows per distinct left coordinate, any distance, ties by id.

    More than k rows of one coordinate can never all be wanted, so each coordinate offers its k least ids.
    """
    at = Window.partitionBy("lat", "lng").orderBy(name)
    pts = right.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(F.col("lat").cast("double"), F.col("lng").cast("double"), F.col(right_id).alias(name))
    pts = pts.withColumn("_i", F.row_number().over(at)).where(F.col("_i") <= k).drop("_i")
    points, pts = stage(_points(left)), stage(pts)
    keyed = _on_levels(pts, KNN_SIZES)
    # the cells around the own cell of the level below the last must be those of a level
    size = F.element_at(_sizes(KNN_SIZES), F.col("_lv") + 2) / DEGREE_M
    north = F.abs("lat") + 2 * size
    edge = (north >= 89) | (F.abs("lng") + 2 * size / F.cos(F.radians(F.least(north, F.lit(89.0)))) >= 180)  # search cells that meet a pole or the date line
    filled = stage(_filled(points, keyed, KNN_SIZES[:-1], k).withColumn("_open", F.col("_lv").isNull() | edge))
    pairs = _pairs(filled.where("not _open").select("lat", "lng", (F.col("_lv") + 1).alias("level")), keyed, KNN_SIZES, [name])
    lone = filled.where("_open").select("lat", "lng")
    if not lone.isEmpty():
        pairs = pairs.unionByName(_tree_pairs(lone, pts, k, [name]))
    w = Window.partitionBy("lat", "lng").orderBy("distance_m", name)
    return pairs.withColumn("neighbor_rank", F.row_number().over(w)).where(F.col("neighbor_rank") <= k)


def nearest_neighbors(stations: DataFrame, k: int = 5) -> DataFrame:
    """k nearest other stations of every station."""
    near = k_nearest(stations, stations, "station_id", k + 1)
    pairs = stations.select("station_id", "lat", "lng").join(near, ["lat", "lng"]).where(F.col("station_id") != F.col("neighbor_id"))
    w = Window.partitionBy("station_id").orderBy("distance_m", "neighbor_id")
    return pairs.withColumn("neighbor_rank", F.row_number().over(w)).where(F.col("neighbor_rank") <= k).select("station_id", "neighbor_id", "distance_m", "neighbor_rank")


def linked_stations(pois: DataFrame, stations: DataFrame, radius_m: float = 500.0, at_most: int = 8, fallback: int = 3) -> DataFrame:
    """Stations near a point of interest: up to `at_most` within the radius, else the nearest `fallback`."""
    near = k_nearest(pois, stations, "station_id", at_most, name="station_id")
    w = Window.partitionBy("lat", "lng")
    inside = F.min("distance_m").over(w) <= radius_m
    near = near.withColumn("link_mode", F.when(inside, "within").otherwise("nearest_fallback"))
    near = near.where(F.when(F.col("link_mode") == "within", F.col("distance_m") <= radius_m).otherwise(F.col("neighbor_rank") <= fallback))
    return pois.join(near, ["lat", "lng"])


def match_rates(nearest: DataFrame, radii) -> DataFrame:
    """Match rates at several radii from one join at the largest."""
    one = nearest.agg(F.count("*").alias("n"), *[F.count_if(F.col("distance_m") <= r).alias(f"m{i}") for i, r in enumerate(radii)])
    rows = [F.struct(F.lit(float(r)).alias("radius_m"), F.col("n").alias("stations"), F.col(f"m{i}").alias("matched")) for i, r in enumerate(radii)]
    return one.select(F.inline(F.array(*rows))).withColumns({
        "unmatched": F.col("stations") - F.col("matched"), "match_rate_pct": F.try_divide(F.col("matched") * 100.0, F.col("stations")),
    })


def closest_to(points: DataFrame, lat: float, lng: float, n: int, tie: str) -> DataFrame:
    return points.withColumn("distance_m", haversine_m(F.lit(lat), F.lit(lng), F.col("lat"), F.col("lng"))).orderBy("distance_m", tie).limit(n)


def link_midpoints(links: DataFrame, nodes: DataFrame) -> DataFrame:
    a = nodes.select(F.col("node_id").alias("f_node"), F.col("lat").alias("_la"), F.col("lng").alias("_lo"))
    b = nodes.select(F.col("node_id").alias("t_node"), F.col("lat").alias("_lb"), F.col("lng").alias("_lp"))
    out = links.join(a, "f_node", "left").join(b, "t_node", "left")
    ok = F.col("_la").isNotNull() & F.col("_lb").isNotNull()
    return out.select("link_id", ((F.col("_la") + F.col("_lb")) / 2).alias("lat"), ((F.col("_lo") + F.col("_lp")) / 2).alias("lng"), ok.alias("geom_ok"))


def polyline_midpoints(vertices: DataFrame, step: int = 4096) -> DataFrame:
    """Point at half the arc length of each line. Lines are cut every `step` vertices; one long line spreads over tasks."""
    from chargelens.operators.ranks import running_total

    chunk = F.floor(F.col("seq") / step)
    cut = vertices.withColumn("_c", chunk)
    w = Window.partitionBy("line_id", "_c").orderBy("seq")
    ends = cut.groupBy("line_id", "_c").agg(F.max_by(F.struct("x", "y"), "seq").alias("_end"))
    prev = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy("line_id").orderBy("_c"))).select("line_id", "_c", "_carry")
    v = cut.withColumn("_p", F.lag(F.struct("x", "y")).over(w)).join(prev, ["line_id", "_c"]).withColumn("_p", F.coalesce("_p", "_carry"))
    v = v.withColumn("_d", F.coalesce(F.hypot(F.col("x") - F.col("_p.x"), F.col("y") - F.col("_p.y")), F.lit(0.0))).drop("_carry")
    v = running_total(v, ["line_id"], "seq", F.col("_d"), F.col("_c"), "_s")
    half = v.groupBy("line_id").agg((F.max("_s") / 2).alias("_half"), F.count("*").alias("_n"))
    v = v.join(half, "line_id")
    # lines without length keep their middle vertex; the others the first vertex at or past half way
    first = v.where((F.col("_half") > 0) & F.col("_p").isNotNull() & (F.col("_s") >= F.col("_half"))).groupBy("line_id").agg(
        F.min(F.struct("seq", "x", "y", "_p", "_s", "_d", "_half")).alias("r")
    )
    t = F.try_divide(F.col("r._half") - (F.col("r._s") - F.col("r._d")), F.col("r._d"))
    long = first.select("line_id", (F.col("r._p.x") + t * (F.col("r.x") - F.col("r._p.x"))).alias("x"), (F.col("r._p.y") + t * (F.col("r.y") - F.col("r._p.y"))).alias("y"))
    flat = v.where(F.col("_half") <= 0).groupBy("line_id").agg(F.min("x").alias("x"), F.min("y").alias("y"))  # all vertices coincide
    return long.unionByName(flat)
