"""Time the headline queries and print one JSON line.

Report queries read marts that the session stores on first use; `warehouse_fact` times that build.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores (default 8). Each query
runs once unmeasured and then BENCH_RUNS times; the least time counts. Results go to a sink that
discards them, so every row and column is computed but none reaches the driver.
"""

from __future__ import annotations

import json
import os
import time

from txn_risk.session import build_session
from txn_risk.testbed.catalog import queries

HEADLINE = (
    "stage_latest", "warehouse_fact", "dim_customers", "dim_merchants", "fct_features", "txn_freq_24h",
    "txn_freq_24h_rank", "zscore_baseline", "measures_total", "measures_by_category",
    "measures_by_state", "top_merchants", "age_gender", "amount_quantiles", "distinct_entities",
    "dq_report", "feature_matrix", "export_fact", "cost_sweep", "average_precision",
    "stratified_folds", "newest_scores", "score_upsert", "stream_freq_24h", "stream_features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = os.environ.get("BENCH_ONLY")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries()
    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(min(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
