"""Distance joins, name matching and geometry."""
from pyspark.sql import functions as F

import chargelens.plans.oracle_ctes  # noqa: F401
from chargelens.operators import matching, snapshots, spatial
from chargelens.plans.registry import query
from chargelens.sources.views import ORACLE_CTES


def hav(a, b):
    """Haversine text for the oracle."""
    return (f"2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))"
            f" * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))")


def nearest_sql(left, lid, right, rid, radius):
    return f"""
select l.*, r.matched_id, r.distance_m, r.matched_id is not null as matched from {left} l left join (
  select * from (select a.{lid}, b.{rid} as matched_id, {hav('a', 'b')} as distance_m,
    row_number() over (partition by a.{lid} order by {hav('a', 'b')}, b.{rid}) as rn from {left} a, {right} b where {hav('a', 'b')} <= {radius}) where rn = 1) r using ({lid})"""


ORACLE_CTES.update({
    "x_stations": """
select * exclude (rn) from (select station_id, station_name, addr, busi_nm, use_time, lat, lng, row_number() over (partition by station_id order by charger_id) rn from v_charger_master) where rn = 1""",
    "x_incident_points": "select incident_id, lat, lng from (select *, row_number() over (partition by incident_id order by start_ts desc, event_id desc) rn from v_incidents) where rn = 1",
    "x_near_poi": nearest_sql("x_stations", "station_id", "v_pois", "poi_id", 1000),
    "x_near_lot": nearest_sql("x_stations", "station_id", "v_lots", "lot_id", 1000),
    "x_near_incident": nearest_sql("x_stations", "station_id", "x_incident_points", "incident_id", 1000),
})
ORACLE_CTES["x_near_park"] = nearest_sql("x_stations", "station_id", "(select * from v_parks where lat between 33 and 39)", "mng_no", 1000)


def stations(t):
    return snapshots.first_per_station(t.v_charger_master).select("station_id", "station_name", "addr", "busi_nm", "use_time", "lat", "lng")


def incident_points(t):
    return snapshots.last_per_incident(t.v_incidents).select("incident_id", "lat", "lng")


NEAR = "select station_id, matched_id, distance_m, matched from "


def near_cols(df):
    return df.select("station_id", "matched_id", "distance_m", "matched")


@query("n3_nearest_poi_within", NEAR + "x_near_poi", num="distance_m")
def _(t):
    return near_cols(spatial.nearest_within(stations(t), t.v_pois, "poi_id", 1000.0))


@query("n4_match_rates_by_radius", """
select r as radius_m, count(*) as stations, count(*) filter (distance_m <= r) as matched, count(*) filter (distance_m is null or distance_m > r) as unmatched,
  count(*) filter (distance_m <= r) * 100.0 / count(*) as match_rate_pct from x_near_poi, (values (300.0), (500.0), (1000.0)) as v(r) group by 1""", num="radius_m match_rate_pct")
def _(t):
    return spatial.match_rates(spatial.nearest_within(stations(t), t.v_pois, "poi_id", 1000.0), (300.0, 500.0, 1000.0))


@query("n5_nearest_parking", """
select n.station_id, n.matched_id, n.distance_m, n.matched, r.remaining_spaces, r.congestion_status, r.lot_id is not null as has_realtime
from x_near_lot n left join (select * from (select *, row_number() over (partition by lot_id order by collected_at desc, id desc) rn from v_lot_realtime) where rn = 1) r on r.lot_id = n.matched_id""", num="distance_m remaining_spaces")
def _(t):
    near = spatial.nearest_within(stations(t), t.v_lots, "lot_id", 1000.0)
    rt = snapshots.keep_one(t.v_lot_realtime, ("lot_id",), ("collected_at", "id")).select(F.col("lot_id").alias("matched_id"), F.col("remaining_spaces").cast("double").alias("remaining_spaces"), "congestion_status", F.lit(True).alias("has_realtime"))
    out = near.join(rt, "matched_id", "left").withColumn("has_realtime", F.coalesce("has_realtime", F.lit(False)))
    return out.select("station_id", "matched_id", "distance_m", "matched", "remaining_spaces", "congestion_status", "has_realtime")


@query("n6_nearest_incident", NEAR + "x_near_incident", num="distance_m")
def _(t):
    return near_cols(spatial.nearest_within(stations(t), incident_points(t), "incident_id", 1000.0))


SPEED_LINKS = """
select l.link_id, l.lat, l.lng, s.speed_kph, s.cong_grade from v_links l join (select * from (select *, row_number() over (partition by link_id order by tick_ts desc, event_id desc) rn from v_link_ticks) where rn = 1) s using (link_id)"""
ORACLE_CTES["x_speed_links"] = SPEED_LINKS
ORACLE_CTES["x_near_link"] = nearest_sql("x_stations", "station_id", "x_speed_links", "link_id", 400)


@query("n7_nearest_road_link", """
select n.station_id, n.matched_id, n.distance_m, n.matched, s.speed_kph, s.cong_grade from x_near_link n left join x_speed_links s on s.link_id = n.matched_id""", num="distance_m speed_kph")
def _(t):
    speed = snapshots.keep_one(t.v_link_ticks, ("link_id",), ("tick_ts", "event_id")).select("link_id", "speed_kph", F.col("cong_grade").alias("grade_now"))
    links = t.v_links.select("link_id", "lat", "lng").join(speed, "link_id")
    near = spatial.nearest_within(stations(t), links, "link_id", 400.0)
    return near.join(links.select(F.col("link_id").alias("matched_id"), "speed_kph", F.col("grade_now").alias("cong_grade")), "matched_id", "left").select("station_id", "matched_id", "distance_m", "matched", "speed_kph", "cong_grade")


@query("n8_usage_station_match", "select station_id, matched_id, distance_m, matched from (" + nearest_sql("v_usage_stations", "station_id", "(select station_id as charge_station_id, lat, lng from x_stations)", "charge_station_id", 80) + ")", num="distance_m")
def _(t):
    st = stations(t).select(F.col("station_id").alias("charge_station_id"), "lat", "lng")
    return near_cols(spatial.nearest_within(t.v_usage_stations, st, "charge_station_id", 80.0))


@query("n9_incident_exposure", f"""
select s.station_id, count(b.incident_id) as incidents_1km from x_stations s left join x_incident_points b on {hav('s', 'b')} <= 1000 group by 1""")
def _(t):
    return spatial.count_within(stations(t), incident_points(t), 1000.0, "incidents_1km").select("station_id", "incidents_1km")


@query("n10_poi_station_links", f"""
select poi_id, station_id, distance_m, link_mode from (
  select *, case when min(distance_m) over (partition by poi_id) <= 500 then 'within' else 'nearest_fallback' end as link_mode,
    row_number() over (partition by poi_id order by distance_m, station_id) as rn
  from (select a.poi_id, b.station_id, {hav('a', 'b')} as distance_m from v_pois a, x_stations b where b.lat is not null))
where case when link_mode = 'within' then rn <= 8 and distance_m <= 500 else rn <= 3 end""", num="distance_m")
def _(t):
    return spatial.linked_stations(t.v_pois, stations(t)).select("poi_id", "station_id", "distance_m", "link_mode")


@query("n11_nearest_neighbors", f"""
select station_id, neighbor_id, distance_m, rn as neighbor_rank from (
  select a.station_id, b.station_id as neighbor_id, {hav('a', 'b')} as distance_m, row_number() over (partition by a.station_id order by {hav('a', 'b')}, b.station_id) as rn
  from x_stations a, x_stations b where a.station_id <> b.station_id and a.lat is not null and b.lat is not null) where rn <= 5""", num="distance_m")
def _(t):
    return spatial.nearest_neighbors(stations(t))


@query("n12_closest_to_origin", f"""
select s.station_id, {hav('o', 's')} as distance_m from x_stations s, (select cast(35.871 as double) as lat, cast(128.601 as double) as lng) o where s.lat is not null order by 2, 1 limit 20""", num="distance_m")
def _(t):
    return spatial.closest_to(stations(t).where("lat is not null"), 35.871, 128.601, 20, "station_id").select("station_id", "distance_m")


@query("n19_tour_name_candidates", """
select content_id, title, row_id, attract_name, case when a = b then 1.0 else 0.8 end as match_score, a <> b as needs_review
from (select *, replace(title, ' ', '') as a from v_tour where title <> '') t join (select *, replace(attract_name, ' ', '') as b from v_city_tour where attract_name <> '') c on contains(a, b) or contains(b, a)""", num="match_score")
def _(t):
    return matching.tour_point_pairs(t.v_tour, t.v_city_tour)


ORACLE_CTES["x_coloc"] = """
with p as (select n.*, l.lot_id, regexp_replace(regexp_replace(lower(n.station_name), '[^0-9a-z가-힣]', '', 'g'), '전기차|충전소|충전기|주차장|지상|지하', '', 'g') as a,
  regexp_replace(regexp_replace(lower(l.lot_name), '[^0-9a-z가-힣]', '', 'g'), '전기차|충전소|충전기|주차장|지상|지하', '', 'g') as b,
  list_has_any(regexp_extract_all(coalesce(n.addr, ''), '\\d+(?:-\\d+)?'), regexp_extract_all(l.addr, '\\d+(?:-\\d+)?')) as address_number_match
  from x_near_lot n join v_lots l on l.lot_id = n.matched_id where distance_m <= 100),
g as (select *, least(length(a), length(b)) >= 4 and (contains(a, b) or contains(b, a)) as name_match from p),
h as (select *, case when distance_m <= 20 and (name_match or address_number_match) then 'STRONG' when distance_m <= 50 or name_match or address_number_match then 'LIKELY' else 'NEARBY_ONLY' end as grade from g)
select lot_id, station_id as best_station_id, grade as best_grade, distance_m as best_distance_m, name_match, address_number_match, ev_station_count
from (select *, count(*) over (partition by lot_id) as ev_station_count, row_number() over (partition by lot_id order by case grade when 'STRONG' then 0 when 'LIKELY' then 1 else 2 end, distance_m, station_id) as rn from h) where rn = 1"""


@query("n20_parking_colocation", "select * from x_coloc", num="best_distance_m")
def _(t):
    return matching.colocated_lots(spatial.nearest_within(stations(t), t.v_lots, "lot_id", 1000.0), t.v_lots)


# fixed values: names under which an operator's tariff may be listed
OPERATOR_ALIASES = {"household": ("nation_14", "nation_4"), "building": ("buildingco",)}


@query("n21_operator_tariffs", r"""
with o as (select operator, regexp_replace(lower(operator), '[\s()㈜]|주식회사', '', 'g') as a from (select distinct busi_nm as operator from v_charger_master)),
f as (select b, arg_min(operator_name, tariff_id) as operator_name, arg_min(fee_krw, tariff_id) as fee_krw from (select *, regexp_replace(lower(operator_name), '[\s()㈜]|주식회사', '', 'g') as b from v_tariffs) group by 1),
al as (select a, b, 2 as prio from o join f on (contains(a, 'household') or contains(a, 'nation_14') or contains(a, 'nation_4')) and b in ('household', 'nation_14', 'nation_4')
  union all select a, b, 2 from o join f on (contains(a, 'building') or contains(a, 'buildingco')) and b in ('building', 'buildingco')),
h as (select a, b, case when a = b then 0 else 1 end as prio from o join f on contains(a, b) or contains(b, a) union all select * from al),
m as (select * from (select *, row_number() over (partition by a order by prio, b) rn from h) where rn = 1)
select distinct operator, operator_name as tariff_operator, fee_krw, case prio when 0 then 'EXACT' when 1 then 'CONTAINED' when 2 then 'ALIAS' else 'NONE' end as match_level
from o left join m using (a) left join f using (b)""", num="fee_krw")
def _(t):
    return matching.operator_tariffs(t.v_charger_master.select(F.col("busi_nm").alias("operator")), t.v_tariffs, OPERATOR_ALIASES)


@query("n25_link_midpoints", """
select l.link_id, (a.lat + b.lat) / 2 as lat, (a.lng + b.lng) / 2 as lng, a.lat is not null and b.lat is not null as geom_ok
from v_node_links l left join v_nodes a on a.node_id = l.f_node left join v_nodes b on b.node_id = l.t_node""", num="lat lng")
def _(t):
    return spatial.link_midpoints(t.v_node_links, t.v_nodes)


@query("n26_polyline_midpoints", """
with v as (select *, lag(x) over w as px, lag(y) over w as py from v_polylines window w as (partition by line_id order by seq)),
s as (select *, coalesce(sqrt(pow(x - px, 2) + pow(y - py, 2)), 0) as d from v), c as (select *, sum(d) over (partition by line_id order by seq) as cum from s),
h as (select *, max(cum) over (partition by line_id) / 2 as half from c),
p as (select *, row_number() over (partition by line_id order by seq) rn from h where half > 0 and px is not null and cum >= half)
select line_id, px + (half - (cum - d)) / d * (x - px) as x, py + (half - (cum - d)) / d * (y - py) as y from p where rn = 1
union all select line_id, min(x), min(y) from h where half <= 0 group by 1""", num="x y")
def _(t):
    return spatial.polyline_midpoints(t.v_polylines)


@query("f13_poi_count_1km", """
select station_id, count(*) as poi_count_1km from (select station_id from x_near_poi where matched union all select station_id from x_near_park where matched) group by 1""")
def _(t):
    near = lambda p, i: spatial.nearest_within(stations(t), p, i, 1000.0).where("matched").select("station_id")
    parks = t.v_parks.where("lat between 33 and 39")
    return near(t.v_pois, "poi_id").unionByName(near(parks, "mng_no")).groupBy("station_id").agg(F.count("*").alias("poi_count_1km"))

