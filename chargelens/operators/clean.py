"""Cleaning and flagging. Rows are annotated, not dropped, unless the rule says so."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargelens.functions.codes import CHARGER_TYPE, CITY, CONGESTION_NAME, UNKNOWN_TYPE, code_map, internal_status, preprocess_status
from chargelens.functions.exprs import NULL_TOKENS, flag_list, minutes_between, normal_text, ratio

D = T.DoubleType()
CLEAN_BOX = ((35.6, 36.2), (128.3, 128.9))
SERVICE_BOX = ((35.55, 36.45), (128.25, 129.05))


def in_box(lat: Column, lng: Column, box) -> Column:
    (a, b), (c, d) = box
    return F.coalesce(lat.between(a, b) & lng.between(c, d), F.lit(False))


def stations(raw: DataFrame) -> DataFrame:
    """Required keys, trimmed text, numeric coordinates inside the box, defaults filled."""
    nm, addr = F.trim("stat_nm"), F.trim("addr")
    out = raw.where(F.col("stat_id").isNotNull() & (nm != "") & (addr != ""))
    out = out.withColumns({"stat_nm": nm, "addr": addr, "lat": F.col("lat").try_cast(D), "lng": F.col("lng").try_cast(D)})
    return out.where(in_box(F.col("lat"), F.col("lng"), CLEAN_BOX)).withColumns({
        "busi_nm": F.trim(F.coalesce("busi_nm", F.lit(""))),
        "use_time": F.trim(F.coalesce("use_time", F.lit("24시간 이용가능"))),
        "parking_free": F.upper(F.trim(F.coalesce("parking_free", F.lit("N")))),
    })


def chargers(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("stat_id").isNotNull() & F.col("chger_id").isNotNull()).withColumns({
        "chger_type": code_map(F.trim("chger_type"), CHARGER_TYPE, UNKNOWN_TYPE),
        "stat": internal_status(F.col("stat")),
        "output": F.trim(F.coalesce("output", F.lit(""))),
        "stat_updated_at": F.trim(F.coalesce("stat_updated_at", F.lit(""))),
    })


def annotate_info(info: DataFrame) -> DataFrame:
    """Service target, address and coordinate quality of every charger.

    Stations per coordinate are counted by an aggregate and joined back; placeholder coordinates that many rows share
    fold to one row before the join.
    """
    lat, lng = F.col("lat"), F.col("lng")
    xy = info.where(lat.isNotNull() & lng.isNotNull()).groupBy(F.round(lat, 6).alias("_x"), F.round(lng, 6).alias("_y")).agg(
        F.count_distinct("station_id").alias("shared_coord_station_n")
    )
    out = info.withColumns({"_x": F.round(lat, 6), "_y": F.round(lng, 6)}).join(xy, ["_x", "_y"], "left").drop("_x", "_y")
    city = F.coalesce(F.contains(F.col("addr"), F.lit(CITY)), F.lit(False))
    box = in_box(lat, lng, SERVICE_BOX)
    missing = lat.isNull() | lng.isNull()
    holder = ~missing & F.round(lat, 3).isin(35.0, 0.0) & F.round(lng, 3).isin(128.0, 0.0)
    flag = flag_list(
        (missing, "MISSING_COORD"), (~missing & holder, "PLACEHOLDER_COORD"), (~missing & ~box, "OUT_OF_BBOX"),
        (~missing & city & ~box, "ADDR_DAEGU_COORD_SUSPECT"), (~missing & F.col("addr").isNotNull() & ~city & box, "ADDR_NOT_DAEGU"),
    )
    return out.withColumns({
        "is_service_target": F.coalesce(F.upper("del_yn") != "Y", F.lit(True)), "addr_is_city": city, "coord_in_bbox": box,
        "coord_placeholder": F.coalesce(holder, F.lit(False)), "shared_coord_cluster": F.coalesce(F.col("shared_coord_station_n") >= 10, F.lit(False)),
        "coordinate_quality_flag": flag,
    }).withColumn("coord_ok", F.col("coordinate_quality_flag") == "OK")


def service(annotated: DataFrame) -> DataFrame:
    return annotated.where("is_service_target and coord_ok")


def quarantine(annotated: DataFrame) -> DataFrame:
    return annotated.where(~F.col("coord_ok"))


def operator_name(col: Column) -> Column:
    s = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.replace(F.replace(s, F.lit("(주)"), F.lit("㈜")), F.lit("㈜ "), F.lit("㈜"))


def full_info(info: DataFrame) -> DataFrame:
    lat, lng, addr = F.col("lat"), F.col("lng"), F.col("addr")
    conflict = info.groupBy("station_id").agg((F.count_distinct("lat") > 1).alias("statid_coord_conflict"))
    out = info.join(conflict, "station_id", "left")
    city = F.coalesce(F.contains(addr, F.lit(CITY)), F.lit(False))
    box = in_box(lat, lng, SERVICE_BOX)
    missing = lat.isNull() | lng.isNull()
    pf = F.upper("parking_free")
    return out.withColumns({
        "output_num": F.col("output").try_cast(D), "parking_free": F.when(pf.isin("Y", "N"), pf).otherwise("UNKNOWN"),
        "limit_yn": F.upper("limit_yn"), "del_yn": F.upper("del_yn"), "busi_nm_norm": operator_name(F.col("busi_nm")),
        "operation_time_known": F.col("use_time").isNotNull(),
        "is_24h": F.coalesce(F.contains("use_time", F.lit("24")) | F.contains("use_time", F.lit("종일")), F.lit(False)),
        "is_service_target": F.coalesce(F.upper("del_yn") != "Y", F.lit(True)),
        "coordinate_quality_flag": flag_list(
            (missing, "MISSING_COORD"), (~missing & ~box, "OUT_OF_BBOX"), (city & ~box & lat.isNotNull(), "ADDR_DAEGU_COORD_SUSPECT"),
            (~city & addr.isNotNull() & box, "ADDR_NOT_DAEGU"), (F.col("statid_coord_conflict"), "STATID_COORD_CONFLICT"),
        ),
    })


def status_rows(status: DataFrame, info: DataFrame, stale_s: int = 900) -> DataFrame:
    """Status with the station name restored from the master, parsed times with failure flags, age, stale flag."""
    key = info.select("station_id", "charger_id", "station_name").dropDuplicates(["station_id", "charger_id"])
    upd = F.try_to_timestamp("stat_updated_at", F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    out = status.join(key, ["station_id", "charger_id"], "left").withColumns({
        "updated_ts": upd, "updated_parse_failed": normal_text(F.col("stat_updated_at")).isNotNull() & upd.isNull(),
    })
    age = minutes_between(F.col("fetched_at"), F.col("updated_ts")) * 60
    return out.withColumns({"status_age_seconds": age, "is_status_stale": F.coalesce(age > stale_s, F.lit(False)), "stat_mapped": preprocess_status(F.col("stat"))})


def coverage_by(info: DataFrame, status: DataFrame, column: Column, name: str) -> DataFrame:
    seen = status.select("station_id", "charger_id").distinct().withColumn("_s", F.lit(1.0))
    return info.join(seen, ["station_id", "charger_id"], "left").groupBy(F.coalesce(column, F.lit("UNKNOWN")).alias(name)).agg(
        F.count("*").alias("chargers"), (F.avg(F.coalesce("_s", F.lit(0.0))) * 100).alias("coverage_pct")
    )


def parking(lots: DataFrame, realtime: DataFrame) -> DataFrame:
    all_day = F.coalesce(F.contains("oper_type", F.lit("전일")), F.lit(False)) & F.col("open_hr").isNull() & F.col("close_hr").isNull()
    rt = realtime.select("lot_id", "remaining_spaces", "occupancy_rate", "congestion_status")
    out = lots.withColumns({
        "oper_hours_derived": all_day, "open_hr_derived": F.when(all_day, "0000"), "close_hr_derived": F.when(all_day, "2400")
    }).join(rt, "lot_id", "left")
    gone = F.col("remaining_spaces").isNull()
    expected = 1 - ratio(F.col("remaining_spaces"), F.col("total_spaces"))
    no = F.lit(False)
    return out.withColumns({
        "realtime_parking_missing": gone, "realtime_status": F.when(gone, "UNKNOWN").otherwise(F.coalesce("congestion_status", F.lit("UNKNOWN"))),
        "rmnd_negative": F.coalesce(F.col("remaining_spaces") < 0, no), "rmnd_gt_total": F.coalesce(F.col("remaining_spaces") > F.col("total_spaces"), no),
        "occupancy_inconsistent": F.coalesce(F.abs(F.col("occupancy_rate") - expected) > 0.05, no),
    })


def links(raw: DataFrame) -> DataFrame:
    m, v, s = (F.col(c).try_cast(D) for c in ("distance_m_text", "speed_text", "travel_text"))
    expected = F.try_divide(m * 3.6, v)
    name = code_map(F.col("cong_grade"), CONGESTION_NAME)
    no = F.lit(False)
    return raw.withColumns({
        "distance_m": m, "speed_kph": v, "travel_sec": s, "negative_metric": F.coalesce(m < 0, no) | F.coalesce(v < 0, no) | F.coalesce(s < 0, no),
        "travel_time_expected": expected, "travel_time_inconsistent": F.coalesce(F.abs(s - expected) > 30, no),
        "cong_name_inconsistent": F.coalesce(F.col("cong_name") != name, no),
    })


def incidents(raw: DataFrame, link_ids: DataFrame, as_of: Column) -> DataFrame:
    known = link_ids.select("link_id").distinct().withColumn("_k", F.lit(True))
    out = raw.join(known, "link_id", "left")
    return out.withColumns({
        "start_after_end": F.col("start_ts") > F.col("end_ts"),
        "is_active_at_asof": (F.col("start_ts") <= as_of) & (F.col("end_ts") >= as_of),
        "link_fk_ok": F.col("link_id").isNull() | F.coalesce("_k", F.lit(False)),
    }).drop("_k")


# fixed values: forecast categories by the kind of their value
NUMERIC_CATEGORIES = ("TMP", "T1H", "REH", "WSD", "UUU", "VVV", "VEC", "POP", "WAV")
CODE_CATEGORIES = ("SKY", "PTY")
RAIN_CATEGORIES = ("PCP", "RN1", "SNO")


def weather(raw: DataFrame) -> DataFrame:
    """Times from date and hour texts; the value is read by the rule of its category."""
    stamp = lambda d, h: F.try_to_timestamp(F.concat(d, F.lpad(h, 4, "0")), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")
    text = F.trim("fcst_value")
    number = text.try_cast(D)
    first = F.nullif(F.regexp_extract(text, r"([0-9.]+)", 1), F.lit("")).try_cast(D)
    mm = F.nullif(F.regexp_extract(text, r"(?i)([0-9.]+)\s*mm", 1), F.lit("")).try_cast(D)
    rain = F.when(text.isin("강수없음", "적설없음"), 0.0).when(F.contains(text, F.lit("미만")), first).otherwise(F.coalesce(mm, number))
    kind = F.col("category")
    value = F.when(kind.isin(*RAIN_CATEGORIES), rain).when(~kind.isin(*CODE_CATEGORIES), number)
    return raw.withColumns({
        "base_datetime": stamp(F.col("base_date"), F.col("base_time")), "forecast_datetime": stamp(F.col("fcst_date"), F.col("fcst_time")),
        "value_numeric": value, "weather_parse_error": ~kind.isin(*CODE_CATEGORIES) & value.isNull() & text.isNotNull(),
    })


def weather_wide(clean: DataFrame, categories=("TMP", "REH", "WSD", "PCP", "SNO", "SKY"), order=("base_datetime", "l_orderkey", "l_linenumber", "l_partkey")) -> DataFrame:
    """One row per time and grid; the category list is fixed, so no pass over the data to find it. First value by `order`."""
    cell = F.when(F.col("category").isin(*CODE_CATEGORIES), F.col("fcst_value").try_cast(D)).otherwise(F.col("value_numeric"))
    keys = F.struct(*order)
    pick = lambda c: F.min_by(F.when(F.col("category") == c, cell), F.when((F.col("category") == c) & cell.isNotNull(), keys)).alias(c)
    return clean.groupBy("forecast_datetime", "nx", "ny").agg(*[pick(c) for c in categories])


def tour(raw: DataFrame) -> DataFrame:
    addr = F.trim(F.concat(F.coalesce("addr1", F.lit("")), F.lit(" "), F.coalesce("addr2", F.lit(""))))
    return raw.withColumns({
        "lng": F.col("mapx").try_cast(D), "lat": F.col("mapy").try_cast(D), "addr2_structural_missing": F.col("addr1").isNotNull() & F.col("addr2").isNull(),
        "address_std": F.nullif(addr, F.lit("")), "has_image": F.col("first_image").isNotNull(),
    })


ATTRIBUTES = ("attr01", "attr02", "attr03")
# fixed values: attribute names written differently in the source
ATTRIBUTE_ALIAS = {
    "외국어안내서비스": "외국어 안내서비스", "이용시간": "이용시간", "이용요금": "이용요금", "주차시설": "주차시설",
    "장애인편의시설": "장애인 편의시설", "한국어안내서비스": "한국어 안내서비스",
}


def city_tour_attributes(raw: DataFrame) -> DataFrame:
    """`name|value` columns to rows; a text without the bar is skipped, an empty value is NULL."""
    cells = raw.select("row_id", "attract_name", F.explode(F.array(*[F.struct(F.lit(a).alias("attr_col"), F.col(a).alias("cell")) for a in ATTRIBUTES])).alias("a"))
    cells = cells.select("row_id", "attract_name", "a.attr_col", F.trim("a.cell").alias("cell")).where(F.contains("cell", F.lit("|")))
    name = F.regexp_replace(F.trim(F.substring_index("cell", "|", 1)), r"\s+", " ")
    value = F.nullif(F.trim(F.expr("substring(cell, instr(cell, '|') + 1)")), F.lit(""))
    return cells.select("row_id", "attract_name", "attr_col", F.coalesce(code_map(F.replace(name, F.lit(" "), F.lit("")), ATTRIBUTE_ALIAS), name).alias("attr_name"),
                        value.alias("attr_value"), value.isNull().alias("attr_missing"))


def city_tour_wide(attrs: DataFrame, names=("입장료", "휴무일", "이용시간")) -> DataFrame:
    pick = lambda n: F.min_by(F.when(F.col("attr_name") == n, F.col("attr_value")), F.when((F.col("attr_name") == n) & F.col("attr_value").isNotNull(), F.col("attr_col"))).alias(n)
    return attrs.groupBy("row_id").agg(*[pick(n) for n in names])


def parks(raw: DataFrame) -> DataFrame:
    road, lot = F.col("road_addr"), F.col("lot_addr")
    return raw.withColumns({
        "representative_address": F.coalesce(road, lot, F.lit("UNKNOWN")),
        "address_source": F.when(road.isNotNull(), "ROAD").when(lot.isNotNull(), "LOT").otherwise("UNKNOWN"),
        "coord_valid": F.coalesce(F.col("lat").between(33, 39) & F.col("lng").between(124, 132), F.lit(False)),
    })


def poi_master(tour_clean: DataFrame, parks_clean: DataFrame) -> DataFrame:
    """One table of points with coordinates; columns of one source only are NULL for the other."""
    a = tour_clean.select(F.concat(F.lit("TOUR-"), "content_id").alias("poi_id"), F.lit("TOUR_API").alias("poi_type"), F.col("title").alias("name"), F.col("address_std").alias("address"), "lat", "lng", F.lit(True).alias("has_coords"))
    b = parks_clean.select(F.concat(F.lit("PARK-"), "mng_no").alias("poi_id"), F.lit("PARK_WALK").alias("poi_type"), F.col("park_name").alias("name"), F.col("representative_address").alias("address"), "lat", "lng", F.col("coord_valid").alias("has_coords"), "address_source")
    return a.unionByName(b, allowMissingColumns=True)


def poi_without_coords(city: DataFrame) -> DataFrame:
    return city.select(F.concat(F.lit("CITYTOUR-"), F.col("row_id").cast("string")).alias("poi_id"), F.lit("CITY_TOUR").alias("poi_type"), F.col("attract_name").alias("name"),
                       normal_text(F.col("address")).alias("address"), F.lit(True).alias("needs_geocoding"))


def normalize_text_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: normal_text(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


MOJIBAKE_HINT = r"[ÃÂìëêåãÐÑ\x{FFFD}]|[À-ÿ]{2,}"


def repaired(col: Column) -> Column:
    """Text whose UTF-8 bytes were read as Latin-1, put right; NULL when it is not such a text."""
    latin = F.rlike(col, F.lit(r"^[\x{00}-\x{FF}]*$")) & F.rlike(col, F.lit(MOJIBAKE_HINT))
    fixed = F.try_validate_utf8(F.encode(F.when(latin, col), "ISO-8859-1").cast("string"))
    return F.when((fixed != col) & ~F.contains(fixed, F.lit("�")), fixed)


def repair_mojibake(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All text columns (or the named ones) repaired, with the number of repaired cells per row."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    n = sum((repaired(F.col(c)).isNotNull().cast("int") for c in names), F.lit(0))
    return df.withColumn("repaired_cells", n).withColumns({c: F.coalesce(repaired(F.col(c)), F.col(c)) for c in names})


def city_sessions(sessions: DataFrame) -> DataFrame:
    """Region and address both must name the city; a street that merely contains its name does not count."""
    full = F.lit("대구광역시")
    return sessions.where((F.trim("region") == full) & F.startswith(F.trim("addr"), full))


# fixed values: a district of another city that holds the city's name in it, and cities outside
OTHER_DISTRICT = "해운대구"
OTHER_CITIES = ("부산", "울산", "경주", "구미", "포항", "창원")


def city_incidents(incidents_: DataFrame) -> DataFrame:
    addr = F.coalesce("addr", F.lit(""))
    named = F.contains(addr, F.lit(CITY)) & ~F.contains(addr, F.lit(OTHER_DISTRICT))
    box = in_box(F.col("lat"), F.col("lng"), SERVICE_BOX)
    return incidents_.where(named | (box & (F.contains(addr, F.lit(CITY)) | (F.trim(addr) == "")) & ~F.rlike(addr, F.lit("|".join(OTHER_CITIES)))))


def city_lots(lots: DataFrame) -> DataFrame:
    return lots.where(F.startswith(F.trim("addr"), F.lit("대구광역시")))


def duration_minutes(col: Column) -> Column:
    p = F.transform(F.split(F.trim(col), ":"), lambda x: x.try_cast(D))
    return F.when(F.size(p) == 3, p[0] * 60 + p[1] + p[2] / 60.0).when(F.size(p) == 2, p[0] + p[1] / 60.0)


def enrich_sessions(sessions: DataFrame) -> DataFrame:
    dow = F.weekday("start_ts")
    return sessions.withColumns({
        "minutes": duration_minutes(F.col("duration_text")), "hour": F.hour("start_ts"), "dow": dow, "is_weekend": dow >= 5,
        "station_key": F.concat(F.trim("station_name"), F.lit("|"), F.element_at(F.split("addr", " "), 2)),
    })


def kw_bucket(col: Column) -> Column:
    kw = F.nullif(F.regexp_extract(col, r"(?i)(\d+)\s*kW", 1), F.lit("")).cast("int")
    return F.when(kw.isNull(), "unknown").when(kw <= 50, "50kW").when(kw <= 100, "100kW").when(kw <= 200, "200kW").when(kw <= 350, "350kW").otherwise("400kW+")


def incident_type(col: Column) -> Column:
    out = None
    for word in ("사고", "공사", "행사", "통제"):  # fixed values, first hit wins
        out = F.when(F.contains(col, F.lit(word)), word) if out is None else out.when(F.contains(col, F.lit(word)), word)
    return out.otherwise("기타")


def grade_number(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), r"^0+", "").try_cast(D)


def access_flags(chargers_: DataFrame, stations_: DataFrame) -> DataFrame:
    lim = chargers_.groupBy("station_id").agg(F.bool_or(F.coalesce(F.upper("limit_yn") == "Y", F.lit(False))).alias("access_restricted"))
    blob = F.concat(F.coalesce("station_name", F.lit("")), F.lit(" "), F.coalesce("addr", F.lit("")))
    out = stations_.join(lim, "station_id", "left").withColumn("access_restricted", F.coalesce("access_restricted", F.lit(False)))
    return out.withColumns({"name_suggests_residential": F.rlike(blob, F.lit(r"(?i)아파트|단지|\bAPT\b|거주자")), "recommend_public_default": ~F.col("access_restricted")})


# fixed values: fee keys of the parking payload
FEE_KEYS = (
    "crgLevySeNm", "crgLevlSeNm", "gnrlFrstCrgLevyHr", "gnrlFrstCrg", "gnrlAddCrgLevyHr", "gnrlMntbyAddCrg", "gnrlOneHrCrg",
    "gnrlOneDayCrg", "gnrlCmmtktCrg", "residntWikCrg", "residntNghtCrg", "residntPrvdyCrg", "residntFteCrg", "stlmMthd",
)
PAYLOAD_SCHEMA = (
    "data array<struct<prkInfo:struct<pkltId:string,pkltNm:string>,prkFcltInfo:struct<roadNmAddr:string,lotnoAddr:string,lat:string,lot:string,prkNocmprt:string>,"
    "prkOperInfo:struct<wkdayOperBgngHr:string," + ",".join(f"{k}:string" for k in FEE_KEYS) + ">,"
    "rltmPrkInfo:struct<pkltId:string,totPrkNocmprt:string,totRmndPrkNocmprt:string,prkCnfSttsCd:string>>>"
)


def _items(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("_p", F.from_json("payload", PAYLOAD_SCHEMA)).select("id", "api_type", F.explode("_p.data").alias("it"))


def parking_fees(payloads: DataFrame) -> DataFrame:
    return _items(payloads).select("id", F.col("it.prkInfo.pkltId").alias("lot_id"), *[F.nullif(F.col(f"it.prkOperInfo.{k}"), F.lit("")).alias(k) for k in FEE_KEYS])


def lot_info(payloads: DataFrame) -> DataFrame:
    f = "it.prkFcltInfo"
    return _items(payloads).where("api_type = 'parking_info'").select(
        F.col("it.prkInfo.pkltId").alias("lot_id"), F.col("it.prkInfo.pkltNm").alias("lot_name"), F.coalesce(F.col(f"{f}.roadNmAddr"), F.col(f"{f}.lotnoAddr")).alias("addr"),
        F.col(f"{f}.lat").try_cast(D).alias("lat"), F.col(f"{f}.lot").try_cast(D).alias("lng"), F.col(f"{f}.prkNocmprt").try_cast(D).alias("total_spaces"), F.col("it.prkOperInfo.wkdayOperBgngHr").alias("open_hr"),
    )


def lot_realtime(payloads: DataFrame) -> DataFrame:
    r = "it.rltmPrkInfo"
    tot, rem = F.col(f"{r}.totPrkNocmprt").try_cast(D), F.col(f"{r}.totRmndPrkNocmprt").try_cast(D)
    return _items(payloads).where("api_type = 'parking_realtime'").select(
        F.col(f"{r}.pkltId").alias("lot_id"), tot.alias("total_spaces"), rem.alias("remaining_spaces"), F.col(f"{r}.prkCnfSttsCd").alias("congestion_status"),
        F.bround(F.try_divide((tot - rem) * 100, tot), 2).alias("occupancy_rate"),
    )


def free_parking_by_station(chargers_: DataFrame) -> DataFrame:
    """Counts of the free-parking flag per station and its most frequent value, the least one on ties."""
    pf = F.nullif(F.upper("parking_free"), F.lit(""))
    per = chargers_.groupBy("station_id", pf.alias("v")).agg(F.count("*").alias("n"))
    return per.groupBy("station_id").agg(
        F.sum("n").alias("chargers"), F.coalesce(F.sum(F.when(F.col("v") == "Y", F.col("n"))), F.lit(0)).alias("free_y"), F.coalesce(F.sum(F.when(F.col("v") == "N", F.col("n"))), F.lit(0)).alias("free_n"),
        F.coalesce(F.min_by("v", F.when(F.col("v").isNotNull(), F.struct(-F.col("n"), "v"))), F.lit("")).alias("free_mode"),
    )


def eta_bucket(col: Column) -> Column:
    return F.when(col <= 0, None).when(col <= 10, "<=10").when(col <= 20, "10-20").when(col <= 40, "20-40").when(col > 40, ">40")


def vehicle_master(raw: DataFrame) -> DataFrame:
    return raw.select(F.trim("model_name").alias("model_name"), F.coalesce("fixed_kwh", "battery_kwh").alias("battery_kwh"), "range_km", F.col("fixed_kwh").isNotNull().alias("corrected"))
