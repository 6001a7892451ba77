"""Benchmark the headline jobs; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3; one warm-up run first).
Each run executes the full plan into Spark's ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from subledger.plans.queries import registered  # noqa: E402
from subledger.session import build_session  # noqa: E402

HEADLINE = (
    "mrr_monthly",
    "timeline_intervals",
    "daily_active",
    "daily_active_sweep",
    "tx_attributed",
    "store_daily_active",
    "flatten_events",
    "policy_audit",
    "parse_arrivals",
    "ingest_pages",
    "curate_datetimes",
    "stream_curate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="subledger-bench", shuffle_partitions=cpus)
    qs = registered()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        fn = qs[name]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
        except Exception as ex:  # noqa: BLE001 - report the failure, keep timing the rest
            times[name] = None
            errors[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = qs["tx_attributed"](spark, sf_dir)._jdf.queryExecution().explainString(mode)
        exchanges = len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))
    except Exception:  # noqa: BLE001
        exchanges = None
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "plan": {"tx_attributed_exchanges": exchanges},
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
