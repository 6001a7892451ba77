"""Landing and streams lose nothing, corrections win, schemas widen, registration follows the write."""

import datetime as dt
import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators import dedup, landing
from subledger.sources import catalog, pages, raw, sinks, widening
from subledger.streaming import jobs


def page(edges):
    return json.dumps({"data": {"transactions": {"edges": edges}}})


def edge(cursor, day, amount=1.0, **node):
    return {"cursor": cursor, "node": {"createdAt": f"{day}T10:00:00.123456Z", "id": f"gid/{cursor}",
                                       "grossAmount": {"amount": str(amount)}, **node}}


def docs(spark, *pages):
    return spark.createDataFrame([(i, page(p)) for i, p in enumerate(pages)], "page_id long, json string").coalesce(1)


def land(spark, base, as_of, *pages, **kw):
    landing.ingest_pages(spark, docs(spark, *pages), "transactions", base, dt.date.fromisoformat(as_of),
                         order=F.col("page_id"), **kw)


def stored(spark, base):
    return sorted((r["cursor"], r["dt"].isoformat(), r["grossAmount"]) for r in raw.read_raw(spark, base).collect())


def test_late_and_future_rows_are_kept(spark, tmp_path):
    base = str(tmp_path / "tx")
    land(spark, base, "2024-01-11", [edge(f"c{d:02}", f"2024-01-{d:02}") for d in range(1, 11)])
    land(spark, base, "2024-01-11", [edge("late", "2024-01-03"), edge("new", "2024-01-10"), edge("soon", "2024-01-25")])
    got = {c: d for c, d, _ in stored(spark, base)}
    assert got["late"] == "2024-01-03" and got["new"] == "2024-01-10" and "soon" not in got and len(got) == 12
    held = spark.read.parquet(f"{base}-quarantine").collect()
    assert [r["reason"] for r in held] == ["future day"] and "soon" in held[0]["json"]
    assert landing.release_held(spark, f"{base}-quarantine", "transactions", base, dt.date(2024, 1, 20)) == []
    assert landing.release_held(spark, f"{base}-quarantine", "transactions", base, dt.date(2024, 1, 25)) == [dt.date(2024, 1, 25)]
    soon = raw.read_raw(spark, base).where("cursor = 'soon'").first()
    assert soon["createdAt"] == dt.datetime(2024, 1, 25, 10, 0, 0, 123456)


def test_late_rows_can_be_held(spark, tmp_path):
    base = str(tmp_path / "tx")
    land(spark, base, "2024-01-11", [edge("a", "2024-01-09")])
    land(spark, base, "2024-01-11", [edge("b", "2024-01-08"), edge("c", "2024-01-07")], late="hold")
    assert [c for c, _, _ in stored(spark, base)] == ["a", "b"]
    assert [r["reason"] for r in spark.read.parquet(f"{base}-quarantine").collect()] == ["late day"]
    with pytest.raises(ValueError):
        land(spark, base, "2024-01-11", [edge("d", "2024-01-09")], late="drop")


def test_the_row_that_landed_last_wins(spark, tmp_path):
    day = "2024-01-09"
    one, two, old = (str(tmp_path / n) for n in ("one", "two", "old"))
    land(spark, one, "2024-01-11", [edge("c", day, 10.0), edge("c", day, 9.0)], [edge("c", day, 8.0)])
    land(spark, two, "2024-01-11", [edge("c", day, 10.0), edge("c", day, 9.0)])
    land(spark, two, "2024-01-11", [edge("c", day, 8.0)])
    assert stored(spark, one) == stored(spark, two) == [("c", day, 8.0)]
    # pages of an earlier fetch that come again don't undo a correction
    for at, amount in (("2024-01-11", 8.0), ("2024-01-10", 10.0)):
        land(spark, old, "2024-01-11", [edge("c", day, amount)], at=F.lit(f"{at} 00:00:00"))
    assert stored(spark, old) == [("c", day, 8.0)]


def test_keyless_rows_are_told_apart_and_counted(spark):
    schema = "cursor string, a string, b string, at timestamp"
    t, u = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    new = spark.createDataFrame([(None, "x", None, t), (None, None, "x", t), (None, "x", None, t), (None, "x", None, u),
                                 ("k", "x", None, t)], schema)
    once = sinks.newest_by_key(new, None)
    assert once.count() == 5
    assert sinks.newest_by_key(new, once).count() == 5        # the same batch again adds nothing
    wider = new.withColumn("c", F.lit(None).cast("string"))   # nor with a column that is new
    assert sinks.newest_by_key(wider, once).count() == 5
    many = spark.range(25_000).select(F.lit(None).cast("string").alias("cursor"), F.lit("y").alias("a"))
    assert sinks.newest_by_key(many, None).count() == 25_000


def test_stream_result_does_not_depend_on_batches(spark, tmp_path):
    base = str(tmp_path / "bronze")
    rows = [[("c1", 10.0), (None, 1.0), (None, 1.0)], [("c1", 8.0), ("c2", 5.0)], [("c2", 4.0), (None, 1.0)]]
    for part in rows:
        (spark.createDataFrame(part, "cursor string, amount double").coalesce(1)
         .withColumn("createdAt", F.lit("2024-01-05 01:00:00").cast("timestamp")).withColumn("dt", F.to_date("createdAt"))
         .write.mode("append").partitionBy("dt").parquet(base))
    got = {}
    for name, files in (("all", None), ("single", 1)):
        out = str(tmp_path / name)
        jobs.stream_dedup(spark, base, out, str(tmp_path / f"ck-{name}"), ts_col="createdAt", max_files=files)
        got[name] = sorted((r["cursor"] or "", r["amount"]) for r in spark.read.parquet(out).collect())
    assert got["single"] == got["all"] == [("", 1.0), ("", 1.0), ("c1", 8.0), ("c2", 4.0)]


def test_stream_with_a_declared_schema_reads_no_other_footers(spark, tmp_path):
    base, out, ck = (str(tmp_path / n) for n in ("bronze", "out", "ck"))
    schema = T.StructType().add("createdAt", T.TimestampType()).add("cursor", T.StringType()).add("dt", T.DateType())

    def add(day):
        (spark.createDataFrame([(dt.datetime(2024, 1, day), f"c{day}")], "createdAt timestamp, cursor string")
         .withColumn("dt", F.to_date("createdAt")).write.mode("append").partitionBy("dt").parquet(base))
        jobs.stream_dedup(spark, base, out, ck, ts_col="createdAt", schema=schema)
    add(1)
    for f in glob.glob(f"{base}/dt=2024-01-01/*.parquet"):
        spoil(f)
    add(2)
    assert sorted(r["cursor"] for r in spark.read.parquet(out).collect()) == ["c1", "c2"]


# --- widening -------------------------------------------------------------------------------
def test_lattice():
    i, l, d, f, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.StringType()
    assert widening.wider(i, l) == widening.wider(l, i) == l
    assert widening.wider(l, d) == widening.wider(f, d) == widening.wider(T.DecimalType(9, 2), f) == d
    assert widening.wider(i, T.DecimalType(9, 2)) == T.DecimalType(12, 2)
    assert widening.wider(T.DecimalType(38, 0), T.DecimalType(38, 10)) == d
    assert widening.wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert widening.wider(i, s) == widening.wider(T.BooleanType(), i) == widening.wider(T.DateType(), d) == s
    assert widening.wider(T.ArrayType(i), T.ArrayType(l)) == T.ArrayType(l)
    a, b = T.StructType().add("X", i).add("y", s), T.StructType().add("x", l).add("z", d)
    assert [(g.name, g.dataType) for g in widening.wider(a, b).fields] == [("X", l), ("y", s), ("z", d)]


def test_read_widened_with_types_back_and_forth(spark, tmp_path):
    base = str(tmp_path / "t")
    kinds = {1: "int", 2: "long", 3: "int", 4: "double", 5: "int", 6: "string"}
    for day, kind in kinds.items():
        (spark.range(3).select(F.col("id").cast(kind).alias("n"), F.struct(F.col("id").cast(kind).alias("v")).alias("s"))
         .write.parquet(f"{base}/dt=2024-01-0{day}"))
    # one folder holds files of two types, one has no day
    spark.range(3).select(F.col("id").alias("n")).write.mode("append").parquet(f"{base}/dt=2024-01-01")
    spark.range(2).select(F.col("id").alias("N")).write.parquet(f"{base}/dt=__HIVE_DEFAULT_PARTITION__")
    df = catalog.discover_schema(spark, base)
    assert dict(df.dtypes)["n"] == "string" and dict(df.dtypes)["dt"] == "date"
    assert dict(df.dtypes)["s"] == "struct<v:string>"
    got = {(str(r["dt"]), r["n"]) for r in df.collect()}
    assert df.count() == 23 and ("2024-01-04", "2.0") in got and ("None", "1") in got and ("2024-01-06", "2") in got
    assert df.where("s is null").count() == 5


# --- registration ---------------------------------------------------------------------------
def spoil(path):
    """Make a file unreadable: whoever opens it fails."""
    with open(path, "wb") as f:
        f.write(b"no parquet")
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_a_landing_opens_only_files_of_its_days(spark, tmp_path):
    base, name = str(tmp_path / "tx"), f"reg_{uuid.uuid4().hex[:8]}"
    land(spark, base, "2024-01-20", [edge(f"c{d}", f"2024-01-{d:02}") for d in range(1, 9)], table=name)
    assert spark.table(name).count() == 8
    for f in glob.glob(f"{base}/dt=2024-01-0[1-7]/*.parquet"):
        spoil(f)
    land(spark, base, "2024-01-20", [edge("c8", "2024-01-08", 2.0), edge("c9", "2024-01-09")], table=name)
    rows = spark.table(name).where("dt >= '2024-01-08'").collect()
    assert sorted((r["cursor"], r["grossAmount"]) for r in rows) == [("c8", 2.0), ("c9", 1.0)]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 9


def test_register_days_adds_and_widens_columns(spark, tmp_path):
    base, name = str(tmp_path / "t"), f"wide_{uuid.uuid4().hex[:8]}"

    def write(day, columns):
        df = spark.range(2).selectExpr(*columns)
        df.write.parquet(f"{base}/dt={day}")
        catalog.register_days(spark, name, base, df.schema, [dt.date.fromisoformat(day)])
        return {r[0]: r[1] for r in spark.table(name).groupBy("dt").agg(F.sum(F.col("n").cast("double"))).collect()}
    one, two, three, four = (dt.date(2024, 1, d) for d in range(1, 5))
    assert write("2024-01-01", ["cast(id as int) n"]) == {one: 1.0}
    assert write("2024-01-02", ["id n", "'x' note"]) == {one: 1.0, two: 1.0}
    assert dict(spark.table(name).dtypes) == {"n": "bigint", "note": "string", "dt": "date"}
    assert write("2024-01-03", ["cast(id as double) + 0.5 n"]) == {one: 1.0, two: 1.0, three: 2.0}
    assert write("2024-01-04", ["cast(id as int) n", "7 note"]) == {one: 1.0, two: 1.0, three: 2.0, four: 1.0}
    assert dict(spark.table(name).dtypes) == {"n": "double", "note": "string", "dt": "date"}
    assert {r["note"] for r in spark.table(name).collect()} == {"x", "7", None}


# --- unknown fields, long histories ---------------------------------------------------------
def test_unknown_fields_are_kept_and_survive_merges(spark, tmp_path):
    base, day = str(tmp_path / "tx"), "2024-01-09"
    more = {"tax": {"amount": "1.5", "lines": [1, None]}, "shop": {"id": "s", "tier": "gold"}, "grossAmount": {"amount": "2", "x": True}}
    land(spark, base, "2024-01-11", [edge("a", day), {**edge("b", day), "node": {**edge("b", day)["node"], **more}}], rescue=True)
    land(spark, base, "2024-01-11", [edge("c", day)])     # a landing without rescue leaves the column alone
    got = {(r["cursor"], r["field"]): json.loads(r["value"]) for r in pages.rescued_fields(raw.read_raw(spark, base)).collect()}
    assert got == {("b", "tax"): {"amount": "1.5", "lines": [1, None]}, ("b", "shop.tier"): "gold", ("b", "grossAmount.x"): True}
    assert sorted(r["cursor"] for r in raw.read_raw(spark, base).collect()) == ["a", "b", "c"]


def test_bounded_anti_join_reads_the_batch_range(spark, tmp_path):
    path = str(tmp_path / "seen")
    spark.range(1_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("cursor")).write.parquet(path)
    seen = spark.read.parquet(path)
    new = spark.createDataFrame([("000010",), ("000012x",), (None,), ("000020",)], "cursor string")
    kept = dedup.drop_seen(new, seen, bounded=True)
    assert sorted(map(str, (r[0] for r in kept.collect()))) == ["000012x", "None"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(cursor,000010)" in plan and "LessThanOrEqual(cursor,000020)" in plan
    assert dedup.drop_seen(new.where("cursor is null"), seen, bounded=True).count() == 1
