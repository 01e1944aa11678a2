"""Time the headline queries; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Every query is
written to the ``noop`` sink, so all rows and columns are computed. The stored gold tables are built
first and timed as their own entries; analytic queries then read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.queries import REGISTRY
from checks import fixture as fx

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
TABLES = ["unique", "silver", "hourly", "current", "realtime"]
HEADLINE = [
    "silver_dedup",
    "silver_fill_missing",
    "silver_fill_median",
    "silver_amount_percentile",
    "silver_outlier_iqr",
    "silver_row_fraction",
    "gold_hourly_fraud",
    "gold_fraud_rate",
    "gold_risk_profiles",
    "gold_summary_stats",
    "ml_rolling_100",
    "ml_rolling_100_global",
    "ml_build",
    "dq_bronze_profile",
    "dq_silver_report",
    "dq_scores",
    "st_decode_cdc",
    "st_feature_record",
    "st_rolling_100",
    "st_rolling_100_stream",
    "st_velocity_5min",
    "st_cdc_latest",
    "vw_fraud_analytics_unified",
    "vw_fraud_summary",
    "an_batch_vs_realtime",
    "an_high_risk",
    "an_hourly_unified",
    "an_top_features",
    "an_prediction_accuracy",
    "gl_amount_by_class",
    "gl_feature_distribution",
    "gl_amount_ranges",
    "prof_dataset",
    "prof_correlation",
]


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = session(CPUS)
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    for table in TABLES:
        timed(f"build_{table}", lambda t=table: fx.table(spark, SF_DIR, t))
    for name in names:
        timed(name, lambda n=name: REGISTRY[n](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    total = round(sum(times.values()), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
