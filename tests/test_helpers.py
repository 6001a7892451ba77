"""Public helpers that the registered queries do not reach directly."""

import datetime as dt

from pyspark.sql import functions as F

from subledger.functions.aggregates import any_true, first_by_rank
from subledger.functions.scalar import interval_distance, pricing_plan
from subledger.operators import quality

D = dt.datetime


def test_first_by_rank_skips_nulls_per_column(spark):
    df = spark.createDataFrame([(1, 3, "c", 30), (1, 1, None, 10), (1, 2, "b", None), (2, 1, None, None)],
                               "g int, r int, s string, n int")
    got = {r["g"]: (r["s"], r["n"]) for r in df.groupBy("g").agg(
        first_by_rank("s", F.col("r")).alias("s"), first_by_rank("n", F.col("r")).alias("n"),
        any_true(F.col("n") > 20).alias("big")).collect()}
    assert got == {1: ("b", 10), 2: (None, None)}


def test_interval_distance_counts_calendar_days(spark):
    rows = [(D(2024, 1, 5, 12), D(2024, 1, 1), D(2024, 1, 10)),      # inside
            (D(2024, 1, 11, 1), D(2024, 1, 1), D(2024, 1, 10, 23)),   # 2 hours later, next day
            (D(2024, 1, 10, 23, 30), D(2024, 1, 1), D(2024, 1, 10, 23)),  # same day, after end
            (D(2023, 12, 1), D(2024, 1, 1), D(2024, 1, 10))]           # before start
    df = spark.createDataFrame(rows, "t timestamp, a timestamp, e timestamp")
    assert [r[0] for r in df.select(interval_distance("t", "a", "e")).collect()] == [0, 1, 0, 999999]


def test_plan_label(spark):
    df = spark.createDataFrame([("Free plan",), ("Pro",), (None,)], "n string")
    assert [r[0] for r in df.select(pricing_plan("n")).collect()] == ["Unlimited Blog posts", "Pro", None]


def test_column_policy_rules():
    assert quality.column_policy(["occurredat", "shopid", "reason"]) == [
        ("occurredat", "no", "yes"), ("shopid", "no", "no"), ("reason", "yes", "yes")]
