"""Time the headline queries on one folder and print one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the local cores. ``etl`` is the time to build the
stored tables (lines, cleaned, scored, star, rollup, merged) that the queries then read.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peerbench.registry import QUERIES  # noqa: E402
from peerbench.session import build_session  # noqa: E402
from peerbench.workspace import workspace  # noqa: E402

HEADLINE = (
    "q1_peer_variation", "q2_geographic", "q3_volume_cost", "q4_outliers", "q5_items", "q6_item_quartiles",
    "q6_strict", "query_summary", "feat_volume_tier", "feat_peer_stats", "feat_zscore", "topk_per_peer",
    "dq_report", "dq_orphans", "eda_summary", "eda_box_stats", "eda_z_histogram", "eda_region_pivot",
    "api_entity_profile", "api_peer_profile", "api_outliers", "dash_kpis", "bi_outlier_mix", "insight_geo",
    "stream_score", "stream_daily_alert", "ml_scaled", "ml_k_search", "ml_assign", "ml_importance", "seg_update",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    w = workspace(spark, sf_dir)
    w.star.rollup, w.star.merged
    seconds["etl"] = round(time.perf_counter() - start, 3)
    for key in HEADLINE:
        start = time.perf_counter()
        QUERIES[key](w).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
