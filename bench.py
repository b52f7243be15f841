"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once, planning and eager steps included. Only the start of the JVM and of its code generation is left
out: the first query runs once untimed before the others.
"""

from __future__ import annotations

import json
import os
import time

from tidemill.plans.registry import QUERIES
from tidemill.session import local_session

HEADLINE = [
    "keyword_window_count", "keyword_tokenize", "visitor_repair", "visitor_repair_documented", "log_split", "multi_sink",
    "cdc_route", "cdc_upsert_latest", "cdc_config_state", "dim_enrich", "date_helpers", "iqr_bounds", "iqr_remove",
    "describe_numeric", "describe_object", "crosstab_index", "crosstab_sorted", "group_median", "group_mean_ci",
    "corr_matrix", "train_test_split", "smote_oversample", "classification_metrics", "retained_premium_ratio",
    "column_bind_position", "longest_run", "longest_distinct_span", "watermark_zero",
]


def _run(spark, folder: str, name: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tidemill-bench")
    _run(spark, folder, HEADLINE[0])
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        _run(spark, folder, name)
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": os.environ.get("BENCH_CPUS", "8")}))
    spark.stop()


if __name__ == "__main__":
    main()
