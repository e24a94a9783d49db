"""The one-row-per-station table as of the newest poll."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargelens.functions.opening_hours import with_operating_now
from chargelens.operators import candidates, clean, snapshots, spatial, station, usage
from chargelens.plans.common import current_chargers
from chargelens.session import stage


def station_points(t) -> DataFrame:
    return snapshots.first_per_station(t.v_charger_master).select("station_id", "station_name", "addr", "busi_nm", "use_time", "lat", "lng")


def matched_usage(t) -> DataFrame:
    st = snapshots.first_per_station(t.v_charger_master).select(F.col("station_id").alias("charge_station_id"), "lat", "lng")
    return usage.station_usage(t.v_usage_daily, spatial.nearest_within(t.v_usage_stations, st, "charge_station_id", 80.0))


def usage_station_rows(t) -> DataFrame:
    return usage.usage_per_station(usage.usage_levels(usage.usage_features(matched_usage(t))))


def speed_links(t) -> DataFrame:
    """Road links with a speed: the newest tick of each link."""
    speed = snapshots.keep_one(t.v_link_ticks, ("link_id",), ("tick_ts", "event_id")).select("link_id", "speed_kph", F.col("cong_grade").alias("link_cong_grade"))
    return t.v_links.select("link_id", "lat", "lng", "cong_name").join(speed, "link_id")


def poi_sources(t) -> list[tuple[DataFrame, str]]:
    """Sources of points of interest with coordinates, and their key."""
    return [(t.v_pois, "poi_id"), (t.v_parks.where("lat between 33 and 39"), "mng_no")]


def parking_part(t, places: DataFrame, at: DataFrame, as_of) -> DataFrame:
    lots = spatial.nearest_within(places, t.v_lots, "lot_id", 1000.0, points=at).join(t.v_lots.select(F.col("lot_id").alias("matched_id"), F.col("total_spaces").cast("double").alias("parking_total_spaces")), "matched_id", "left")
    now = snapshots.keep_one(t.v_lot_realtime, ("lot_id",), ("collected_at", "id")).select(
        F.col("lot_id").alias("matched_id"), F.col("remaining_spaces").cast("double").alias("parking_remaining_spaces"), "occupancy_rate", "congestion_status", F.lit(True).alias("parking_has_realtime")
    )
    hour = usage.lot_hour_features(t.v_lot_realtime, as_of).withColumnRenamed("lot_id", "matched_id")
    return lots.join(now, "matched_id", "left").join(hour, "matched_id", "left").select(
        "station_id", F.col("matched_id").alias("parking_matched_id"), F.col("distance_m").alias("nearest_parking_m"), "parking_remaining_spaces", "parking_total_spaces",
        F.col("occupancy_rate").alias("parking_occupancy_rate"), F.col("congestion_status").alias("parking_congestion_status"), F.coalesce("parking_has_realtime", F.lit(False)).alias("parking_has_realtime"),
        "parking_remaining_std_1h", "parking_remaining_delta_1h", F.col("parking_realtime_ticks_1h").cast("double").alias("parking_realtime_ticks_1h"),
    )


def traffic_part(t, places: DataFrame, at: DataFrame) -> DataFrame:
    links = stage(speed_links(t))
    near = spatial.nearest_within(places, links, "link_id", 400.0, points=at)
    return near.join(links.select(F.col("link_id").alias("matched_id"), "speed_kph", "link_cong_grade", "cong_name"), "matched_id", "left").select(
        "station_id", F.col("matched_id").alias("nearest_link_id"), F.col("distance_m").alias("nearest_link_m"), F.col("speed_kph").alias("link_speed_kph"), "link_cong_grade", F.col("cong_name").alias("link_cong_grade_nm"))


SCHEMA_VERSION = "d1.2"


def d1(t) -> DataFrame:
    """Every station of the master once, with its state, surroundings and usage as of the newest poll; written once, so
    a query that looks at it several times builds it once.

    Distances of one station to lots, incidents, links and points of interest start from one table of distinct places.
    """
    ev = t.v_status_events
    as_of = snapshots.newest_poll(ev)
    points = stage(station_points(t))
    at = spatial.distinct_points(points)
    places = points.select("station_id", "lat", "lng")
    info = clean.annotate_info(t.v_charger_master)
    quality = snapshots.first_per_station(info).select("station_id", "coord_ok")
    limits = t.v_charger_master.groupBy("station_id").agg(F.max("limit_yn").alias("limit_yn"))
    base = with_operating_now(clean.access_flags(t.v_charger_master, points), as_of).join(quality, "station_id", "left").join(limits, "station_id", "left")
    status = station.station_status(current_chargers(t))
    incident = spatial.nearest_within(places, snapshots.last_per_incident(t.v_incidents).select("incident_id", "lat", "lng"), "incident_id", 1000.0, points=at)
    near = [spatial.nearest_within(places, p, key, 1000.0, points=at).where("matched").select("station_id") for p, key in poi_sources(t)]
    parts = [
        parking_part(t, places, at, as_of),
        incident.select("station_id", F.col("distance_m").alias("nearest_incident_m")),
        traffic_part(t, places, at),
        near[0].unionByName(near[1]).groupBy("station_id").agg(F.count("*").alias("poi_count_1km")),
        usage_station_rows(t),
    ]
    marks = {"eta_minutes": F.lit(None).cast("double"), "parking_is_mock": F.lit(False), "parking_source": F.lit("lots"), "traffic_is_mock": F.lit(False), "traffic_source": F.lit("incidents"), "source_status": F.lit("status_polls"), "schema_version": F.lit(SCHEMA_VERSION)}
    return stage(candidates.assemble(base, status, *parts).withColumns({"as_of_ts": as_of, **marks}))
