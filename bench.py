"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import time

from chargelens.plans import run
from chargelens.session import local_session

HEADLINE = [
    "c1_dedupe_snapshot_rows", "c2_latest_status_as_of", "f2_availability_features", "e2_fleet_segment_panel", "e3_charger_segment_panel", "e4_bounded_hold_panel", "e5_station_tick_panel",
    "e6_station_panel_d2", "e8_fleet_series", "n13_rate_lags", "e12_change_features", "n3_nearest_poi_within", "n9_incident_exposure", "n11_nearest_neighbors", "n23_station_snapshot_d1",
    "f10_usage_features", "f23_availability_by_hour", "f31_dwell_summary", "h1_observed_labels", "h3_training_rows", "n15_asof_backward", "i4_input_report", "j1_associations", "j3_blocked_auc_interval", "j7_probability_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "chargelens-bench")
    run("c4_newest_poll", spark, sf_dir).collect()  # start-up is not measured
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
