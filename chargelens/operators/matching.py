"""Name and address matching as equi-joins.

Containment of one name in another becomes a join on substrings: those of the longer name, of the lengths that names of
the other side have, are listed once and matched by hash. No pair of names is compared that does not match.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.session import stage

# fixed values: words that do not identify a site
FILLER_WORDS = ("전기차", "충전소", "충전기", "주차장", "지상", "지하")


def squeezed(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def site_key(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[^0-9a-z가-힣]", ""), "|".join(FILLER_WORDS), "")


def lot_numbers(col: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(\d+(?:-\d+)?)"), 1)


def substrings(col: Column, lengths: Column) -> Column:
    """Distinct substrings of the given lengths, so a text of n characters has at most n per length."""
    n = F.length(col)
    fit = F.filter(lengths, lambda k: k <= n)
    return F.array_distinct(F.flatten(F.transform(fit, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(col, i, k)))))


def _within(whole: DataFrame, whole_key: str, part: DataFrame, part_key: str) -> DataFrame:
    """Pairs in which `part_key` stands inside `whole_key`; only lengths that parts have are cut out."""
    lengths = part.agg(F.collect_set(F.length(part_key))).scalar()  # one number per length of a name
    cut = whole.select(whole_key, lengths.alias("_len")).select(whole_key, F.explode(substrings(F.col(whole_key), F.col("_len"))).alias(part_key))
    return cut.join(part, part_key)


def containment_pairs(a: DataFrame, b: DataFrame, min_len: int = 1) -> DataFrame:
    """Distinct (a_key, b_key) where one contains the other; both inputs have one text column of their own name."""
    ka, kb = a.where(F.length("a_key") >= min_len).distinct(), b.where(F.length("b_key") >= min_len).distinct()
    in_b, in_a = _within(kb, "b_key", ka, "a_key"), _within(ka, "a_key", kb, "b_key")
    return in_b.select("a_key", "b_key").union(in_a.select("a_key", "b_key")).distinct()


def tour_names(tour: DataFrame) -> DataFrame:
    return tour.where("title is not null and title <> ''").withColumn("tour_key", squeezed(F.col("title")))


def city_names(city: DataFrame) -> DataFrame:
    return city.where("attract_name is not null and attract_name <> ''").withColumn("city_key", squeezed(F.col("attract_name")))


def tour_candidates(tour: DataFrame, city: DataFrame) -> DataFrame:
    """Candidate matches of two point lists by name: 1.0 equal, 0.8 contained, spaces ignored.

    One row per pair of matching names (`kind` pair: tour_key, city_key, score and how many points bear each name), and one
    per point whose name has a match (tour or city: its id, its name as written and its key). Points that share a name
    share its pairs, so these are never multiplied out. Empty names match nothing, names of spaces only are contained in all.
    """
    t, c = (df.select(F.col(i).cast("string").alias("point_id"), F.col(name).alias("name"), key) for df, i, name, key in ((tour_names(tour), "content_id", "title", "tour_key"), (city_names(city), "row_id", "attract_name", "city_key")))
    pairs = stage(containment_pairs(t.select(F.col("tour_key").alias("a_key")), c.select(F.col("city_key").alias("b_key")), 0).withColumnsRenamed({"a_key": "tour_key", "b_key": "city_key"}))
    count = lambda df, key, n: df.groupBy(key).agg(F.count("*").alias(n))
    score = F.when(F.col("tour_key") == F.col("city_key"), 1.0).otherwise(0.8)
    named = pairs.join(count(t, "tour_key", "tour_points"), "tour_key").join(count(c, "city_key", "city_points"), "city_key")
    named = named.select(F.lit("pair").alias("kind"), "tour_key", "city_key", score.alias("match_score"), (score < 1.0).alias("needs_review"), "tour_points", "city_points")
    members = [df.join(pairs, key, "left_semi").select(F.lit(kind).alias("kind"), key, "point_id", "name") for df, key, kind in ((t, "tour_key", "tour"), (c, "city_key", "city"))]
    out = named.unionByName(members[0], allowMissingColumns=True).unionByName(members[1], allowMissingColumns=True)
    return out.select("kind", "tour_key", "city_key", "match_score", "needs_review", "tour_points", "city_points", "point_id", "name")


# fixed values: points of a name that meet in one block, and rows that a task writes
BLOCK_POINTS, TASK_PAIRS = 2048, 2_000_000


def tour_point_pairs(tour: DataFrame, city: DataFrame, block: int = BLOCK_POINTS) -> DataFrame:
    """Every tour point with every city point whose name matches, from the name pairs of `tour_candidates`.

    The points of a name are dealt to blocks, and each block meets each block of the other name in a key of its own, so the
    points of a frequent pair are multiplied out by many tasks; a task holds points, never their pairs.
    """
    pairs = stage(tour_candidates(tour, city).where("kind = 'pair'").select(
        "tour_key", "city_key", "match_score", "needs_review", F.ceil(F.col("tour_points") / block).alias("_tour_blocks"), F.ceil(F.col("city_points") / block).alias("_city_blocks"),
        (F.col("tour_points") * F.col("city_points")).alias("_pairs")))
    tasks = int(pairs.agg(F.coalesce(F.ceil(F.sum("_pairs") / TASK_PAIRS), F.lit(1))).first()[0])
    dealt = lambda ids, n: F.pmod(F.xxhash64(*ids), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    t = pairs.join(tour_names(tour), "tour_key").select("tour_key", "city_key", "match_score", "needs_review", "content_id", "title", dealt(["content_id", "title"], "_tour_blocks").alias("_t"), every("_city_blocks").alias("_c"))
    c = pairs.join(city_names(city), "city_key").select("tour_key", "city_key", "row_id", "attract_name", dealt(["row_id", "attract_name"], "_city_blocks").alias("_c"), every("_tour_blocks").alias("_t"))
    keys = ["tour_key", "city_key", "_t", "_c"]
    if tasks > t.sparkSession.sparkContext.defaultParallelism:  # sized by the pairs, which the points do not show
        t, c = t.repartition(tasks, *keys), c.repartition(tasks, *keys)
    return t.join(c, keys).select("content_id", "title", "row_id", "attract_name", "match_score", "needs_review")


def colocation_grade(distance: Column, evidence: Column) -> Column:
    return F.when((distance <= 20) & evidence, "STRONG").when((distance <= 50) | ((distance <= 100) & evidence), "LIKELY").otherwise("NEARBY_ONLY")


def colocated_lots(nearest: DataFrame, lots: DataFrame) -> DataFrame:
    """Best station per parking lot with its evidence grade, from the nearest-lot join cut at 100 m."""
    pairs = nearest.where(F.col("matched") & (F.col("distance_m") <= 100)).join(
        lots.select(F.col("lot_id").alias("matched_id"), "lot_name", F.col("addr").alias("lot_addr")), "matched_id", "left"
    )
    left, right = site_key(F.col("station_name")), site_key(F.col("lot_name"))
    name_hit = (F.least(F.length(left), F.length(right)) >= 4) & (F.contains(left, right) | F.contains(right, left))
    addr_hit = F.coalesce(F.arrays_overlap(lot_numbers(F.col("addr")), lot_numbers(F.col("lot_addr"))), F.lit(False))
    pairs = pairs.withColumns({"name_match": name_hit, "address_number_match": addr_hit})
    grade = colocation_grade(F.col("distance_m"), F.col("name_match") | F.col("address_number_match"))
    pairs = pairs.withColumn("grade", grade)
    rank = F.when(F.col("grade") == "STRONG", 0).when(F.col("grade") == "LIKELY", 1).otherwise(2)
    best = pairs.groupBy("matched_id").agg(
        F.min(F.struct(rank.alias("g"), "distance_m", "station_id", "grade", "name_match", "address_number_match")).alias("b"), F.count("*").alias("ev_station_count")
    )
    return best.select(F.col("matched_id").alias("lot_id"), F.col("b.station_id").alias("best_station_id"), F.col("b.grade").alias("best_grade"),
                       F.col("b.distance_m").alias("best_distance_m"), "b.name_match", "b.address_number_match", "ev_station_count")


def operator_tariffs(operators: DataFrame, tariffs: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Tariff operator per charging operator: equal name, else containment either way, else alias list; NULL if none.

    Ties go to the least tariff name. `aliases` is a short fixed list, so it is a literal table.
    """
    norm = lambda c: F.regexp_replace(F.lower(c), r"[\s()㈜]|주식회사", "")
    ops = operators.select("operator").distinct().withColumn("a_key", norm(F.col("operator")))
    fee = tariffs.groupBy(norm(F.col("operator_name")).alias("b_key")).agg(F.min(F.struct("tariff_id", "operator_name", "fee_krw")).alias("rep"))
    hits = containment_pairs(ops.select("a_key"), fee.select("b_key")).withColumn("prio", F.when(F.col("a_key") == F.col("b_key"), 0).otherwise(1))
    for key, names in aliases.items():
        words = [key, *names]
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(F.col("a_key"), F.lit(word))
        wanted = ops.where(hit).select("a_key", F.explode(F.array(*[F.lit(w) for w in words])).alias("b_key"))
        hits = hits.unionByName(wanted.join(fee.select("b_key"), "b_key").select("a_key", "b_key", F.lit(2).alias("prio")))
    best = hits.groupBy("a_key").agg(F.min(F.struct("prio", "b_key")).alias("m")).select("a_key", "m.prio", "m.b_key")
    return ops.join(best, "a_key", "left").join(fee, "b_key", "left").select(
        "operator", F.col("rep.operator_name").alias("tariff_operator"), F.col("rep.fee_krw").alias("fee_krw"),
        F.when(F.col("prio") == 0, "EXACT").when(F.col("prio") == 1, "CONTAINED").when(F.col("prio") == 2, "ALIAS").otherwise("NONE").alias("match_level"),
    )
