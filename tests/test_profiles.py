"""Day profiles: merged they equal the audit of the whole table, and a new day reads no other."""

import datetime as dt
import glob
import shutil

import pytest
from pyspark.sql import functions as F

from subledger.operators import profiles, quality
from subledger.sources import raw, sinks

SCHEMA = "dt date, shopid string, occurredat timestamp, amount double, units int, tags array<string>"
D1, D2, D3 = dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)


def at(hour):
    return dt.datetime(2024, 1, 31, hour)


ROWS = [(D1, "s1", at(1), 9.0, 10, ["a"]), (D1, "s2", None, 10.5, 9, None), (D1, None, at(2), None, None, []),
        (D2, "s1", at(3), -1.0, -100, ["b"]), (D2, "s3", at(4), 100.25, 5, ["b"]),
        (D3, "s3", at(5), 1e300, 7, None), (D3, "s3", at(6), 0.0, 7, None), (None, "s9", at(7), 2.0, None, None)]


def write(spark, path, rows):
    sinks.replace_days(spark.createDataFrame(rows, SCHEMA), path, {r[0] for r in rows})


def audit(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("order", [[[D1, D2, D3, None]], [[D2], [None], [D3, D1]], [[D1, D2], [D2, D3, None], [D1]]])
def test_merged_days_equal_the_whole_table(spark, tmp_path, order):
    table, base = str(tmp_path / "t"), str(tmp_path / "p")
    write(spark, table, ROWS)
    for days in order:
        profiles.refresh_profiles(spark, table, base, days)
    whole = raw.read_raw(spark, table)
    assert audit(profiles.profile_audit(spark, base, whole.schema)) == audit(quality.policy_audit(whole))
    got = {r.column: r for r in profiles.profile_summary(spark, base, whole.schema).collect()}
    assert (got["amount"].least, got["amount"].largest) == ("-1.0", "1.0E300")
    assert (got["units"].least, got["units"].largest) == ("-100", "10")          # numbers, not texts
    assert got["occurredat"].least == "2024-01-31 01:00:00" and got["tags"].least is None
    assert {c: r.about_values for c, r in got.items()} == {"shopid": 4, "occurredat": 7, "amount": 7, "units": 5, "tags": 3}


def test_changed_and_emptied_days(spark, tmp_path):
    table, base = str(tmp_path / "t"), str(tmp_path / "p")
    write(spark, table, ROWS)
    profiles.refresh_profiles(spark, table, base, [D1, D2, D3, None])
    write(spark, table, [(D2, "s7", at(1), 1.0, 1, None)])
    for day in (D3, None):
        shutil.rmtree(f"{table}/{sinks.day_folder(day)}")
    profiles.refresh_profiles(spark, table, base, [D2, D3, None])
    whole = raw.read_raw(spark, table)
    assert audit(profiles.profile_audit(spark, base, whole.schema)) == audit(quality.policy_audit(whole))


def test_a_new_day_reads_no_other(spark, tmp_path):
    table, base = str(tmp_path / "t"), str(tmp_path / "p")
    write(spark, table, ROWS[:5])
    profiles.refresh_profiles(spark, table, base, [D1, D2])
    want = quality.policy_audit(spark.createDataFrame(ROWS[:7], SCHEMA))
    for f in glob.glob(f"{table}/dt=*/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"spoilt")
    write(spark, table, ROWS[5:7])
    profiles.refresh_profiles(spark, table, base, [D3])
    assert audit(profiles.profile_audit(spark, base, spark.createDataFrame([], SCHEMA).schema)) == audit(want)


def test_columns_come_later_and_types_widen(spark, tmp_path):
    table, base = str(tmp_path / "t"), str(tmp_path / "p")
    sinks.write_daily(spark.createDataFrame([(at(1), 3)], "ts timestamp, units int"), table, "ts")
    later = spark.createDataFrame([(dt.datetime(2024, 2, 1), 2 ** 40, "S1")], "ts timestamp, units long, ShopId string")
    sinks.write_daily(later, table, "ts")
    for day in (D1, D2):
        profiles.refresh_profiles(spark, table, base, [day])
    got = {r.column: r for r in profiles.profile_summary(spark, base, later.schema).collect()}
    assert (got["ShopId"].rows, got["ShopId"].null_count, got["ShopId"].distinct_values) == (2, 1, 1)
    assert (got["units"].least, got["units"].largest) == ("3", str(2 ** 40))


def test_no_profile_no_rows_and_many_values(spark, tmp_path):
    table, base = str(tmp_path / "t"), str(tmp_path / "p")
    empty = spark.createDataFrame([], SCHEMA)
    profiles.refresh_profiles(spark, table, base, [D1])
    assert audit(profiles.profile_audit(spark, base, empty.schema)) == audit(quality.policy_audit(empty))
    many = spark.range(40_000).select(F.lit(D1).alias("dt"), (F.col("id") % 20_000).cast("string").alias("shopid"),
                                      F.col("id").alias("units"))
    sinks.replace_days(many, table, [D1])
    profiles.refresh_profiles(spark, table, base, [D1])
    got = {r.column: r for r in profiles.profile_summary(spark, base, many.schema).collect()}
    assert got["shopid"].distinct_values == 20_000 and abs(got["units"].about_values - 40_000) < 2_000
