"""Jobs that keep their results up to date touch only what changed, and give what a full run gives."""

import datetime as dt
import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from subledger import fixtures as fx
from subledger.operators import active, curate, incremental, spans
from subledger.sources import raw
from conftest import SMALL
from test_landing import spoil

D = dt.date
SPANS = "shopid long, activated_date timestamp, actual_end_date timestamp"


def intervals(spark, rows):
    return spark.createDataFrame([(s, dt.datetime.combine(a, dt.time(5)), b and dt.datetime.combine(b, dt.time(7)))
                                  for s, a, b in rows], SPANS)


def plain_spans(rows, as_of, start):
    seen = {}
    for s, a, b in rows:
        day, end = a, (b - dt.timedelta(days=1) if b else as_of + dt.timedelta(days=1))
        while s is not None and day <= end:
            seen.setdefault(start(day), set()).add(s)
            day += dt.timedelta(days=1)
    return {k: len(v) for k, v in seen.items()}


def test_bitmaps_count_like_sets(spark, tmp_path):
    rnd, as_of = random.Random(4), D(2024, 5, 20)
    rows = [(rnd.choice([None, 0, 1, -5, 32_768, 32_769, 40_000, 10 ** 12, rnd.randrange(50)]),
             (a := D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(130))),
             rnd.choice([None, a, a + dt.timedelta(days=rnd.randrange(60))])) for _ in range(80)]
    df, base = intervals(spark, rows), str(tmp_path / "bits")
    bits = spans.active_bitmaps(df, as_of)
    want = plain_spans(rows, as_of, lambda d: d.replace(day=1))
    got = {r["span_start"]: r["merchants"] for r in spans.merchants_by_span(bits, "month").collect()}
    assert got == want
    daily = {r["span_start"]: r["merchants"] for r in spans.merchants_by_span(bits, F.col("active_date")).collect()}
    assert daily == plain_spans(rows, as_of, lambda d: d)
    assert daily == {r["active_date"]: r["merchants"] for r in active.merchants_by_day(df, as_of).collect() if r["merchants"]}
    # stored piece by piece
    for first, last in ((D(2024, 1, 1), D(2024, 2, 10)), (D(2024, 2, 11), D(2024, 7, 31))):
        spans.refresh_bitmaps(df, base, first, last, as_of)
    stored = spans.merchants_by_span(spans.stored_bitmaps(spark, base), "month")
    assert {r["span_start"]: r["merchants"] for r in stored.collect()} == want


def test_a_new_day_leaves_other_months_alone(spark, tmp_path):
    base, as_of = str(tmp_path / "bits"), D(2024, 4, 1)
    first = intervals(spark, [(1, D(2024, 1, 5), D(2024, 1, 9)), (2, D(2024, 3, 1), D(2024, 3, 4)), (3, D(2024, 3, 2), D(2024, 3, 4))])
    spans.refresh_bitmaps(first, base, D(2024, 1, 1), D(2024, 3, 31), as_of)
    for f in glob.glob(f"{base}/month=2024-01-01/*.parquet"):
        spoil(f)
    # a correction: shop 3 was never active, shop 4 was on one day
    later = intervals(spark, [(2, D(2024, 3, 1), D(2024, 3, 4)), (4, D(2024, 3, 3), D(2024, 3, 4))])
    spans.refresh_bitmaps(later, base, D(2024, 3, 3), D(2024, 3, 3), as_of)
    march = spans.stored_bitmaps(spark, base, first=D(2024, 3, 1))
    got = {r["span_start"]: r["merchants"] for r in spans.merchants_by_span(march, F.col("active_date")).collect()}
    assert got == {D(2024, 3, 1): 1, D(2024, 3, 2): 2, D(2024, 3, 3): 2}
    spans.refresh_bitmaps(later.limit(0), base, D(2024, 3, 1), D(2024, 3, 31), as_of)
    assert not os.path.exists(f"{base}/month=2024-03-01")


def test_bitmaps_are_built_in_one_place(spark, tmp_path, monkeypatch):
    """Shop-months are shuffled, not days or bitmaps; a task writes so many bitmaps, however small they are as files."""
    as_of, rnd = D(2024, 3, 10), random.Random(7)
    rows = [(s, (a := D(2023, 1, 31) + dt.timedelta(days=rnd.randrange(390))), a + dt.timedelta(days=rnd.randrange(1, 150)))
            for s in (5, 5, 5, 31, 32_767, 32_768) for _ in range(6)] + [(9, D(2024, 2, 29), None)]
    bits = spans.active_bitmaps(intervals(spark, rows), as_of)
    assert {r["span_start"]: r["merchants"] for r in spans.merchants_by_span(bits, F.col("active_date")).collect()} \
        == plain_spans(rows, as_of, lambda d: d)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", bits._jdf.queryExecution().explainString(mode))
    assert len(moved) == 3 and not any("buf" in m or "shops" in m or "active_date" in m for m in moved)
    monkeypatch.setattr(spans, "TASK_BITMAPS", 50)
    base = str(tmp_path / "bits")
    spans.refresh_bitmaps(intervals(spark, rows), base, D(2023, 1, 1), D(2024, 7, 31), as_of)
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{base}/month=2023-10-01/*.parquet")]
    assert sum(sizes) == bits.where("trunc(active_date, 'month') = '2023-10-01'").count() and max(sizes) < 62


def test_retained_by_sets(spark):
    rows = [(1, D(2024, 1, 5), D(2024, 2, 9)), (2, D(2024, 1, 5), D(2024, 1, 6)), (3, D(2024, 2, 5), D(2024, 4, 6)),
            (2, D(2024, 3, 1), D(2024, 3, 2)), (40_000, D(2024, 3, 31), D(2024, 4, 2))]
    got = {r["span_start"]: (r["merchants"], r["kept"]) for r in
           spans.retained(spans.active_bitmaps(intervals(spark, rows), D(2024, 5, 1))).collect()}
    assert got == {D(2024, 1, 1): (2, 0), D(2024, 2, 1): (2, 1), D(2024, 3, 1): (3, 1), D(2024, 4, 1): (2, 2)}


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    ev = fx.subscription_events(spark, SMALL)
    history, out = {"events": str(tmp_path / "events")}, str(tmp_path / "out")
    job = lambda events: incremental.stored_intervals(events)
    last = ev.where(F.col("shopid") == ev.where("shopid % 10 <> 0").agg(F.max("shopid")).first()[0])
    first = ev.join(last.select("cursor"), "cursor", "left_anti").select(*ev.columns)
    incremental.refresh(job, history, {"events": first}, out, buckets=8)
    number = incremental.touched_buckets([last], buckets=8)
    assert len(number) == 1
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/bucket=*/*.parquet")}
    for f in glob.glob(f"{history['events']}/bucket=*/*.parquet"):
        if f"bucket={number[0]}/" not in f:
            spoil(f)
    assert incremental.refresh(job, history, {"events": last}, out, buckets=8) == number
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/bucket=*/*.parquet")}
    assert {f for f in before if f"bucket={number[0]}/" not in f} == {f for f in after if before.get(f) == after[f]}
    full = incremental.stored_intervals(ev)
    kept = spark.read.parquet(out).drop("bucket").select(*full.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, full.collect()))
    # nothing fresh, nothing done
    assert incremental.refresh(job, history, {"events": last.limit(0)}, out, buckets=8) == []


def test_curate_reads_its_source_once_and_takes_days(spark, tmp_path):
    base, out = str(tmp_path / "raw"), str(tmp_path / "curated")
    rows = [(f"2024-01-0{d}T10:00:00Z" if d != 2 else "some day", f"c{d}", D(2024, 1, d)) for d in range(1, 5)]
    spark.createDataFrame(rows, "occurredAt string, cursor string, dt date").write.partitionBy("dt").parquet(base)
    report = curate.curate(spark, base, out, dt=[D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)])
    # the source is gone, the report stands: nothing is read a second time
    for f in glob.glob(f"{base}/*/*.parquet"):
        spoil(f)
    assert sorted((r["dt"].day, r["rows"], r["bad_rows"], r["ok"]) for r in report.collect()) == [
        (1, 1, 0, True), (2, 1, 1, False), (3, 1, 0, True)]
    assert sorted(r["cursor"] for r in raw.read_raw(spark, out).collect()) == ["c1", "c3"]
    assert not glob.glob(f"{out}-stage-*")
    with pytest.raises(curate.CurateError):
        curate.curate(spark, base, out, dt=[D(2025, 1, 1)])


def test_added_rows_are_computed_once(spark, tmp_path):
    """No pass for the bounds of ranges; a bucket beyond a task's bytes is still written by several."""
    rows, seen = 20_000, spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    one_shop = spark.range(rows).selectExpr("7L AS shopid", "sha2(cast(id AS string), 256) AS note").repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        incremental.add_rows(one_shop.mapInArrow(counted, one_shop.schema), str(tmp_path / "h"), buckets=8)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert seen.value == rows
    assert spark.read.parquet(str(tmp_path / "h")).distinct().count() == rows
    assert len(glob.glob(f"{tmp_path}/h/bucket=*/*.parquet")) > 2


def test_neighbours_are_found_before_the_wide_scan(spark):
    """The scan over payments and marks sorts one payload per mark kind; neighbours are lagged on payments alone."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = E.queries()["tx_matched"](spark, SMALL)._jdf.queryExecution().explainString(mode)
    wide = [a for a in re.findall(r"\) Window\nInput \[\d+\]: .*\nArguments: (.*)", plan) if "_fs0" in a]
    assert len(wide) == 1 and wide[0].count(" AS ") == 24   # 8 columns in three fills
    lagged = re.findall(r"\) Window\nInput \[(\d+)\]: .*\nArguments: \[(?:lag|lead)\(netamount.*_day_amount", plan)
    assert lagged and max(map(int, lagged)) <= 9
