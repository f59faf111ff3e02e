"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPS`` (3)
timed full executions (``noop`` sink: every row computed, nothing collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "plan_batch_features",      # fitted encoder: key stats, codes, lookups, ratios (flagship)
    "jon_01_identity_join",
    "agg_01_frequency",
    "agg_05_group_amount_stats",
    "fun_09_row_vector",
    "fun_06_label_encoding",
    "jon_03_asof_join",
    "fst_01_historical",
    "agg_10_auc",
    "win_04_count_windows",
    "drf_01_psi",
    "drf_03_ks",
    "fun_14_parse_log_line",
    "jon_05_logs_spans",
    "win_07_span_depth_offset",
    "obs_02_bucket_quantiles",
    "obs_04_alerts",
    "agg_21_transaction_perf",
    "str_02_windowed_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from riskframe.plans.registry import QUERIES, load_all
    from riskframe.session import get_spark
    load_all()
    spark = get_spark(f"local[{cpus}]", app="riskframe-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in (only or HEADLINE):
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()
        print(f"# {name}: {times[name]}s rows={rows[name]}", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
