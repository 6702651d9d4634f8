"""Benchmark: build the warehouse from the test tables, then run the headline
reports. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the no-op sink (nothing is collected).
A failing query is recorded as null with its error, and the line is still printed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_trips", "kpi", "kpi_rounded", "daily_metrics", "daily_trimmed", "hourly_fares",
    "dow_hour", "dow_hour_matrix", "payment_mix", "rate_mix_fact", "passenger_mix", "top_pickups",
    "top_tip_locations", "source_files", "distance_buckets", "time_bounds", "latest_trips",
    "measure_summary", "hist_total", "zone_map", "borough_mix", "zone_tiers", "fk_orphans",
    "constraint_violations", "clean_rejects", "ingest_ledger", "impute_median", "ordinal_encode",
    "daily_trips_window", "kpi_window", "date_window", "trip_sample", "zone_name_to_id", "request_rows",
    "imputed_rows", "encoded_rows", "load_modes_full", "reload_idempotent", "rollup_kpi", "rollup_daily_metrics", "rollup_pickup_counts",
    "summary_sketched", "split_share", "scan_drifted", "load_batches_twice", "model_train",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from farelake.plans import registry, star
    from farelake.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": "16g"})
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name: str, run) -> None:
        t = time.time()
        try:
            run()
            times[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001 - record it, keep measuring the rest
            times[name] = None
            errors[name] = f"{type(e).__name__}: {e}"[:300]

    try:
        # The load is measured, never reused.
        timed("load_star", lambda: star.star_for(spark, sf_dir, reuse=False))
        for name in HEADLINE:
            timed(name, lambda name=name: registry.QUERIES[name](spark, sf_dir)
                  .write.format("noop").mode("overwrite").save())
    finally:
        total = round(sum(v for v in times.values() if v is not None), 3)
        sf = sf_dir.rsplit("sf", 1)[-1]
        out = {"metric": "warehouse_load_plus_reports_wall", "value": total, "unit": "sec",
               "queries": times, "sf": sf, "cpus": cpus}
        if errors:
            out["errors"] = errors
        print(json.dumps(out))
        spark.stop()


if __name__ == "__main__":
    main()
