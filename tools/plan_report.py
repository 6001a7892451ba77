"""Write PLANS.md: physical-plan shape of the headline jobs (formatted explain).

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.1)
Counts operators in the formatted plan and lists pushed filters and read schemas.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from subledger.plans.queries import registered  # noqa: E402
from subledger.session import build_session  # noqa: E402

WATCH = ("Exchange", "BroadcastExchange", "Scan", "Window", "Sort", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "Generate", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Union", "Expand")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = ["# Plan shapes of the headline jobs", "",
           f"Generated by `tools/plan_report.py` on `{sf_dir}` (plain path: no hot key). Counts are from",
           "the formatted physical plan before adaptive re-planning.", "",
           "| job | " + " | ".join(WATCH) + " |", "| --- |" + " --- |" * len(WATCH)]
    details = []
    for name in HEADLINE:
        df = registered()[name](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(mode)
        ops = collections.Counter(re.findall(r"^\(\d+\) (\w+)", text, flags=re.M))
        out.append(f"| {name} | " + " | ".join(str(ops.get(w, 0)) for w in WATCH) + " |")
        pushed = sorted(set(re.findall(r"PushedFilters: (\[.*?\])", text)))
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)", text)))
        parts = [p for p in re.findall(r"Exchange\n.*?Arguments: ([^\n]*)", text, flags=re.S)]
        details += [f"### {name}", "", "* pushed filters: " + ("; ".join(pushed) or "none"),
                    "* read schemas: " + "; ".join(f"`{s}`" for s in schemas),
                    "* exchanges: " + ("; ".join(f"`{p.split(', ENSURE')[0]}`" for p in parts) or "none"), ""]
    # the operator tree of the attribution job (plain path), as Spark prints it
    text = registered()["tx_attributed"](spark, sf_dir)._jdf.queryExecution().explainString(mode)
    tree = text.split("\n\n\n")[0]
    out += ["", "## Operator tree of `tx_attributed` (plain path)", "", "```", tree.strip(), "```"]

    # the same jobs on the hot-key path (every per-shop scan split into buckets)
    spark.conf.set("subledger.scan.hotKeyRows", "0")
    out += ["", "## Hot-key path (`subledger.scan.hotKeyRows=0`)", "",
            "Per-shop scans partition by (shop, bucket); the carry between buckets runs on one summary",
            "row per bucket. Stages cut on this path appear as Parquet scans of their written output.", "",
            "| job | exchanges | windows | exchange keys |", "| --- | --- | --- | --- |"]
    for name in ("timeline_intervals", "daily_active_sweep", "store_daily_active", "tx_attributed"):
        df = registered()[name](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(mode)
        ops = collections.Counter(re.findall(r"^\(\d+\) (\w+)", text, flags=re.M))
        keys = sorted({re.sub(r"#\d+L?", "", p.split(", ENSURE")[0])
                       for p in re.findall(r"Exchange\n.*?Arguments: ([^\n]*)", text, flags=re.S)})
        out.append(f"| {name} | {ops.get('Exchange', 0)} | {ops.get('Window', 0)} | "
                   + "; ".join(f"`{k}`" for k in keys) + " |")
    spark.conf.unset("subledger.scan.hotKeyRows")
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out + [""] + details))
    print(path)


if __name__ == "__main__":
    main()
