"""Time the headline queries at one scale factor and print one JSON line.

Every query runs once unmeasured, then ``BENCH_RUNS`` times (3 by default); the best time counts.  Results
go to the ``noop`` sink, so that all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = HERE + os.pathsep + os.environ.get("PYTHONPATH", "")

from pyspark.sql import SparkSession  # noqa: E402

#: Headline queries and the table whose rows count for their throughput.
HEADLINES = {
    "breach_rate_by_entity": "events",
    "dedup_keep_last": "lineitem",
    "impute_chain": "events",
    "iqr_cap": "events",
    "rolling_std": "events",
    "rolling_baseline": "events",
    "sigma_breach": "events",
    "cross_signal_flag": "events",
    "customer_snapshot": "customer",
    "time_split": "events",
    "stratified_split": "events",
    "roc_auc": "events",
    "pr_curve": "events",
    "ks_drift": "events",
    "panel_sar_fit": "events",
    "panel_sar_forecast": "events",
    "ljung_box": "events",
    "knn_join": "embeddings",
    "lof_score": "embeddings",
    "lof_novelty": "embeddings",
    "iforest_score": "lineitem",
    "ensemble_score": "embeddings",
    "permutation_importance": "lineitem",
    "churn_score": "customer",
    "attribution_sampled": "customer",
    "quality_report": "events",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("telequal-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="telequal-bench-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from telequal.plans.catalog import QUERIES

    only = sys.argv[1:] or list(HEADLINES)
    rows = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in {HEADLINES.get(n, "events") for n in only}}
    times: dict[str, float] = {}
    for name in only:
        best = float("inf")
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": {n: round(rows[HEADLINES.get(n, "events")] / max(t, 1e-3)) for n, t in times.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
