"""Structured Streaming jobs: availableNow curate with quarantine, days replaced as they land again."""

import datetime as dt

from pyspark.sql import functions as F

from subledger.operators import quality
from subledger.sources import sinks
from subledger.streaming import jobs


def test_stream_curate_quarantines_unparsable_times(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = [("A", "2024-01-01T10:00:00Z", "c1"), ("B", "yesterday", "c2"), ("C", "2024-01-02T11:00:00Z", "c3")]
    (spark.createDataFrame(rows, "eventType string, occurredAt string, cursor string")
     .withColumn("dt", F.lit(dt.date(2024, 1, 1))).write.partitionBy("dt").parquet(raw))
    out, held = str(tmp_path / "curated"), str(tmp_path / "held")
    jobs.stream_curate(spark, raw, out, held, str(tmp_path / "ck"))
    good = spark.read.parquet(out)
    assert sorted(r["cursor"] for r in good.collect()) == ["c1", "c3"]
    assert good.schema["occurredat"].dataType.typeName() == "timestamp"
    assert [r["cursor"] for r in spark.read.parquet(held).collect()] == ["c2"]
    # a second run over the same files finds nothing new (exactly once)
    jobs.stream_curate(spark, raw, out, held, str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == 2


def test_stream_dedup_keeps_one_row_per_cursor(spark, tmp_path):
    base = str(tmp_path / "bronze")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), f"c{h}") for h in range(5)],
                               "createdAt timestamp, cursor string").withColumn("dt", F.to_date("createdAt"))
    df.write.mode("append").partitionBy("dt").parquet(base)
    df.write.mode("append").partitionBy("dt").parquet(base)
    out = str(tmp_path / "out")
    jobs.stream_dedup(spark, base, out, str(tmp_path / "ck"), ts_col="createdAt")
    assert sorted(r["cursor"] for r in spark.read.parquet(out).collect()) == [f"c{h}" for h in range(5)]


def test_no_row_is_too_late(spark, tmp_path):
    base, out, ck = (str(tmp_path / n) for n in ("bronze", "out", "ck"))

    def land(rows):
        (spark.createDataFrame(rows, "createdAt timestamp, cursor string").withColumn("dt", F.to_date("createdAt"))
         .write.mode("append").partitionBy("dt").parquet(base))
        jobs.stream_dedup(spark, base, out, ck, ts_col="createdAt", max_files=1)
        return sorted(r["cursor"] for r in spark.read.parquet(out).collect())
    assert land([(dt.datetime(2024, 1, 20), "new"), (dt.datetime(2024, 1, 21), "new2")]) == ["new", "new2"]
    assert land([(dt.datetime(2024, 1, 5), "late")]) == ["late", "new", "new2"]
    assert land([(dt.datetime(2024, 1, 20, 3), "more"), (dt.datetime(2024, 1, 20), "new")]) == [
        "late", "more", "new", "new2"]


def test_a_day_that_lands_again_is_replayed(spark, tmp_path):
    base, out, held, ck = (str(tmp_path / n) for n in ("raw", "out", "held", "ck"))

    def land(rows):
        (spark.createDataFrame(rows, "occurredAt string, cursor string").withColumn("dt", F.lit(dt.date(2024, 1, 1)))
         .write.mode("append").partitionBy("dt").parquet(base))
        jobs.stream_curate(spark, base, out, held, ck)
        return [sorted(r["cursor"] for r in sinks.stored_days(spark, p, [dt.date(2024, 1, 1)]).collect())
                if sinks.stored_days(spark, p, [dt.date(2024, 1, 1)]) else [] for p in (out, held)]
    assert land([("2024-01-01T01:00:00Z", "a"), ("soon", "b")]) == [["a"], ["b"]]
    assert land([("2024-01-01T01:00:00Z", "a"), ("2024-01-01T02:00:00Z", "b")]) == [["a", "b"], []]
    assert land([("2024-01-01T03:00:00Z", "c")]) == [["a", "b", "c"], []]


def test_policy_audit_exact_and_approximate(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "b", "x")], "shopid long, v string, occurredat string")
    exact = {r["column"]: r.asDict() for r in quality.policy_audit(df, distinct="exact").collect()}
    rules = {r["column"]: r.asDict() for r in quality.policy_audit(df).collect()}
    assert rules["shopid"] == exact["shopid"] and rules["v"]["distinct_values"] is None
    assert all(rules[c]["violated"] == exact[c]["violated"] for c in exact)
    assert exact["shopid"]["duplicate_count"] == 1 and exact["shopid"]["violated"]
    assert exact["occurredat"]["null_count"] == 2 and exact["occurredat"]["violated"]
    assert not exact["v"]["violated"]
    approx = {r["column"]: r["distinct_values"] for r in quality.policy_audit(df, distinct="approx").collect()}
    assert approx == {"shopid": 2, "v": 2, "occurredat": 1}
