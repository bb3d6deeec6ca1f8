"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from millrace import catalog
from millrace.catalog import learning
from millrace.session import build_session

HEADLINE = (
    "silver_features",
    "pivot_metrics_1h",
    "window_avg_1m",
    "unpivot_readings",
    "dedupe_latest",
    "impute_baseline",
    "rolling_features",
    "last_cycle",
    "fact_engine_health",
    "ks_lineitem",
    "upsert_merge",
    "stream_bronze",
    "bi_status_counts",
    "bi_rul_correlation",
    "train_and_score",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    learning.forget_fits()  # a fit is part of the time
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)  # compiles and warms up
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "rows": "warm, best of 2",
    }))


if __name__ == "__main__":
    main()
