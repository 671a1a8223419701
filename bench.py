"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select the
data and the cores. Every query is written to the no-op sink, so all of its rows
are computed and none are collected: one warm-up, then the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from catalog import checking, extraction, learning, monitoring, streaming

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = {
    "d5_label_targets": checking.d5_label_targets,
    "d7_verdict_counts": checking.d7_verdict_counts,
    "d15_check_contracts": checking.d15_check_contracts,
    "d16_violating_rows": checking.d16_violating_rows,
    "d11_stateful_check": checking.d11_stateful_check,
    "d12_stateful_clamped": checking.d12_stateful_clamped,
    "b2_classify_lines": extraction.b2_classify_lines,
    "b9_describe_units": extraction.b9_describe_units,
    "c2_contract_features": extraction.c2_contract_features,
    "c5_text_features": extraction.c5_text_features,
    "e2_merge_pools": learning.e2_merge_pools,
    "e4_stratified_split": learning.e4_stratified_split,
    "f1_logistic": lambda spark, d: learning.full_fit(spark, d, "logistic"),
    "f2_forest": lambda spark, d: learning.full_fit(spark, d, "forest"),
    "f10_classification_report": learning.f10_classification_report,
    "h6_top_risk": monitoring.h6_top_risk,
    "h9_feature_drift": monitoring.h9_feature_drift,
    "i3_stream_contract_check": streaming.i3_stream_contract_check,
    "i4_stream_surge": streaming.i4_stream_surge,
}


def session() -> SparkSession:
    return (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
            .config("spark.sql.shuffle.partitions", CPUS)
            .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    times: dict[str, float] = {}
    for name, query in HEADLINE.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
