"""Status code maps, charger types, label lists. All must equal the published code tables."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
INTERNAL_STATUS = {"1": "UNKNOWN", "2": "AVAILABLE", "3": "CHARGING", "4": "OUT_OF_ORDER", "5": "UNDER_INSPECTION", "9": "UNKNOWN"}
OFFICIAL_STATUS = {"1": "OUT_OF_SERVICE", "2": "AVAILABLE", "3": "CHARGING", "4": "OUT_OF_SERVICE", "5": "OUT_OF_SERVICE", "9": "UNKNOWN"}
PREPROCESS_STATUS = {"1": "COMM_ERROR", "2": "AVAILABLE", "3": "CHARGING", "4": "OPERATING_STOPPED", "5": "MAINTENANCE", "9": "STATUS_UNKNOWN"}
OFFICIAL_NAMES = ("AVAILABLE", "CHARGING", "OUT_OF_SERVICE", "UNKNOWN")
INTERNAL_TO_OFFICIAL = {
    "AVAILABLE": "AVAILABLE", "CHARGING": "CHARGING", "IN_USE": "CHARGING", "OUT_OF_ORDER": "OUT_OF_SERVICE",
    "UNDER_INSPECTION": "OUT_OF_SERVICE", "UNKNOWN": "UNKNOWN", "STATUS_UNKNOWN": "UNKNOWN",
}
CHARGER_TYPE = {
    "01": "DC차데모", "02": "AC완속", "03": "DC차데모+AC3상", "04": "DC콤보", "05": "DC차데모+DC콤보",
    "06": "DC차데모+AC3상+DC콤보", "07": "AC3상", "08": "DC콤보(완속)", "10": "초급속(멀티)", "11": "초급속(미확인규격)",
}
UNKNOWN_TYPE = "알수없음"
CONGESTION_NAME = {"1": "원활", "2": "지체", "3": "정체"}
CITY = "대구"
GRADE_RANK = {"HIGH": 3, "NORMAL": 2, "CHECK_REQUIRED": 1}
AVAILABLE_CODE, IN_USE_CODE = 2, 3
# --- end of fixed values ------------------------------------------------------------------------


def code_map(col: Column, table: dict, default: str | None = None) -> Column:
    """Look a text code up in a fixed table; a code may come zero-padded to two digits."""
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    hit = F.try_element_at(lookup, col)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def unpadded(col: Column) -> Column:
    return F.regexp_replace(F.trim(col.cast("string")), r"^0(?=\d$)", "")


def internal_status(col: Column) -> Column:
    return code_map(unpadded(col), INTERNAL_STATUS, "UNKNOWN")


def official_status(col: Column) -> Column:
    return code_map(unpadded(col), OFFICIAL_STATUS, "UNKNOWN")


def preprocess_status(col: Column) -> Column:
    return F.when(col.isNotNull(), code_map(col.cast("string"), PREPROCESS_STATUS, "UNKNOWN_CODE"))


def official_from_name(col: Column) -> Column:
    return code_map(F.upper(F.trim(col.cast("string"))), {**INTERNAL_TO_OFFICIAL, "OUT_OF_SERVICE": "OUT_OF_SERVICE"}, "UNKNOWN")


def official_smart(col: Column) -> Column:
    """Official name if the text already is one, else the raw-code map."""
    named = official_from_name(col)
    return F.when((named == "UNKNOWN") & (F.trim(col.cast("string")) != "UNKNOWN"), official_status(col)).otherwise(named)
