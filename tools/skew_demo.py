"""Skew demonstration: one shop holds a third of all payments.

Derives payments from the driver's events table, moves every third payment
to shop 0, and reports the largest partition of the per-shop scan with the
plain window and with the split (bucketed) scan. Not a registered query.

Usage: python tools/skew_demo.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from subledger import fixtures as fx  # noqa: E402
from subledger.operators import attribution, timeline  # noqa: E402
from subledger.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("subledger.scan.bucketRows", "500")
    pay = fx.payments(spark, sf_dir)
    hot = pay.withColumn("shopid", F.when(F.abs(F.hash("id")) % 3 == 0, F.lit(0)).otherwise(F.col("shopid")))
    total = hot.count()
    for split in (False, True):
        t0 = time.perf_counter()
        out = attribution.numbered_transactions(hot, bucketed=split)
        # keep the scanned column, or column pruning drops the window altogether
        sizes = (out.select(F.spark_partition_id().alias("p"), "prev_netamount")
                 .groupBy("p").agg(F.count(F.lit(1)).alias("count"), F.count("prev_netamount").alias("lags"))
                 .collect())
        biggest = max(r["count"] for r in sizes)
        print(f"{'split' if split else 'plain':5s}: rows={total} partitions={len(sizes)} "
              f"largest={biggest} ({biggest / total:.0%}) {time.perf_counter() - t0:.2f}s")
    # the whole attribution on the skewed payments: both strategies give the same rows
    subs = timeline.timeline_intervals(fx.subscription_events(spark, sf_dir), fx.EVENTS_AS_OF, bucketed=False)
    results = {}
    for split in (False, True):
        t0 = time.perf_counter()
        rows = attribution.attribute_transactions(hot, subs, bucketed=split).collect()
        results[split] = sorted(map(tuple, rows))
        print(f"attribution {'split' if split else 'plain'}: {len(rows)} rows {time.perf_counter() - t0:.2f}s")
    print("identical:", results[False] == results[True])
    spark.stop()


if __name__ == "__main__":
    main()
