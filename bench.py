"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlark.catalog.queries import QUERIES  # noqa: E402
from meterlark.session import local_session  # noqa: E402

HEADLINE = (
    "c8_clean_report", "c8_clean_rows", "f1_features", "f3_duration_matrix", "e9_summary", "e10_quality_table",
    "m2_assign_zone", "d2_hourly_grid", "w4_demand_dataset", "k6_chrono_split", "v3_compare",
    "q2_durations", "q6_demand", "q8_completed_scores", "q14_unified", "q13_insight",
    "m4_linear", "m5_forest", "m7_boosted", "m6_extra_trees", "a2_forest_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["c8_clean_report"](spark, sf_dir).collect()  # start the engine before timing
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
