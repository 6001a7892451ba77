"""The pair-free nearest-interval operator equals brute-force ranking of all pairs.

Random intervals overlap, tie, have zero length, stay open and carry NULL
values, which the timeline job never produces but the operator must handle.
"""

import datetime as dt
import random

import os

import pytest
from pyspark.sql import types as T

from subledger.operators.attribution import nearest_interval

COLS = ("plan", "amount", "prev_plan", "activated_date", "actual_end_date")
BASE = dt.datetime(2024, 3, 1)

SUB_SCHEMA = T.StructType([
    T.StructField("shopid", T.LongType()),
    T.StructField("activated_date", T.TimestampType()),
    T.StructField("actual_end_date", T.TimestampType()),
    T.StructField("cursor", T.StringType()),
    T.StructField("plan", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("prev_plan", T.StringType()),
])
PAY_SCHEMA = T.StructType([
    T.StructField("shopid", T.LongType()),
    T.StructField("pid", T.LongType()),
    T.StructField("createdat", T.TimestampType()),
])


def _distance(t, a, e):
    if t is None:
        return 999999
    if a is not None and e is not None and a <= t <= e:
        return 0
    if e is not None and t > e:
        return (t.date() - e.date()).days
    return 999999


def brute(pays, subs):
    out = {}
    for shop, pid, t in pays:
        cands = [s for s in subs if s[0] == shop]

        def key(s):
            a, e = s[1], s[2]
            return (_distance(t, a, e), (a is None, a or BASE), (e is None, e or BASE), s[3])
        ranked = sorted(cands, key=key)
        row = {}
        for j, c in enumerate(COLS):
            idx = {"plan": 4, "amount": 5, "prev_plan": 6, "activated_date": 1, "actual_end_date": 2}[c]
            row[c] = next((s[idx] for s in ranked if s[idx] is not None), None)
        out[pid] = row
    return out


def _case(seed):
    rnd = random.Random(seed)
    subs, pays = [], []
    n = 0
    for shop in range(4):
        bounds = []
        for _ in range(rnd.randint(0, 9)):
            a = BASE + dt.timedelta(hours=rnd.randint(0, 120))
            r = rnd.random()
            e = (None if r < 0.1 else a if r < 0.25 else a - dt.timedelta(hours=rnd.randint(1, 40)) if r < 0.45
                 else a + dt.timedelta(hours=rnd.randint(1, 80)))
            if rnd.random() < 0.08:
                a = None
            n += 1
            subs.append((shop, a, e, f"{n:06d}", rnd.choice(["A", "B", "C", None]),
                         rnd.choice([10, 20, None]), rnd.choice(["P", None])))
            bounds += [a] * (a is not None)
            bounds += [e, dt.datetime.combine(e.date(), dt.time()) + dt.timedelta(days=1)] if e else []
        for _ in range(rnd.randint(1, 25)):
            if bounds and rnd.random() < 0.4:
                t = rnd.choice(bounds) + dt.timedelta(minutes=rnd.choice([-1, 0, 0, 1]))
            else:
                t = BASE + dt.timedelta(hours=rnd.randint(-30, 220), minutes=rnd.randint(0, 59))
            n += 1
            pays.append((shop, n, t))
    return subs, pays


@pytest.mark.parametrize("split", [False, True], ids=["plain", "split-small-buckets"])
@pytest.mark.parametrize("seed", range(int(os.environ.get("NEAREST_SEEDS", "6"))))
def test_equals_all_pairs_ranking(spark, seed, split):
    subs, pays = _case(seed)
    s = spark.createDataFrame(subs, SUB_SCHEMA)
    p = spark.createDataFrame(pays, PAY_SCHEMA)
    spark.conf.set("subledger.scan.bucketRows", "5")
    try:
        got = {r["pid"]: r.asDict() for r in nearest_interval(p, s, COLS, bucketed=split).collect()}
    finally:
        spark.conf.unset("subledger.scan.bucketRows")
    want = brute(pays, subs)
    assert set(got) == set(want)
    for pid, row in want.items():
        for c in COLS:
            assert got[pid][c] == row[c], (seed, pid, c, got[pid][c], row[c])


@pytest.mark.parametrize("seed", range(3))
def test_month_flags_equal_exists(spark, seed):
    subs, pays = _case(seed + 100)
    s = spark.createDataFrame(subs, SUB_SCHEMA)
    p = spark.createDataFrame(pays, PAY_SCHEMA)
    got = {r["pid"]: (r["ended_same_month"], r["ended_month_before"])
           for r in nearest_interval(p, s, COLS, month_flags="actual_end_date").collect()}

    def month(d):
        return (d.year, d.month)

    def before(d):
        return (d.year - (d.month == 1), 12 if d.month == 1 else d.month - 1)
    for shop, pid, t in pays:
        ends = {month(x[2]) for x in subs if x[0] == shop and x[2] is not None}
        assert got[pid] == (month(t) in ends, before(t) in ends), (seed, pid)


def test_null_payment_time_takes_lowest_key(spark):
    subs, pays = _case(7)
    pays = pays + [(shop, 10_000 + shop, None) for shop in range(4)]
    s = spark.createDataFrame(subs, SUB_SCHEMA)
    p = spark.createDataFrame(pays, PAY_SCHEMA)
    got = {r["pid"]: r.asDict() for r in nearest_interval(p, s, COLS, month_flags="actual_end_date").collect()}
    want = brute(pays, subs)
    for pid, row in want.items():
        for c in COLS:
            assert got[pid][c] == row[c], (pid, c)
    assert all(not got[10_000 + shop]["ended_same_month"] for shop in range(4))


def test_no_subscription_gives_nulls(spark):
    s = spark.createDataFrame([], SUB_SCHEMA)
    p = spark.createDataFrame([(1, 1, BASE)], PAY_SCHEMA)
    row = nearest_interval(p, s, COLS).collect()[0]
    assert all(row[c] is None for c in COLS)
