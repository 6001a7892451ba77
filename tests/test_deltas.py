"""Delta folders: appended bytes follow the batch, reads equal a merge, compaction changes no row."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from subledger.sources import deltas, sinks

SCHEMA = "dt date, cursor string, amount double, _seq struct<file: string, row: long>"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def frame(spark, rows, file):
    return spark.createDataFrame([(d, c, a, (file, i)) for i, (d, c, a) in enumerate(rows)], SCHEMA)


BATCHES = [[(D1, "a", 10.0), (D1, "b", 5.0), (D1, None, 1.0), (D1, None, 1.0), (D2, "c", 7.0)],
           [(D1, "a", 8.0), (D1, None, 1.0), (None, "n", 3.0), (None, None, 4.0)],
           [(D3, "e", 2.0), (D1, None, 9.0), (D2, "a", 6.0), (None, "n", 2.0)]]
WANT = sorted([(D1, "a", 8.0), (D1, "b", 5.0), (D1, None, 1.0), (D1, None, 1.0), (D1, None, 9.0), (D2, "c", 7.0),
               (D2, "a", 6.0), (D3, "e", 2.0), (None, "n", 2.0), (None, None, 4.0)], key=str)


def rows_of(df):
    return sorted(((r.dt, r.cursor, r.amount) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}


@pytest.mark.parametrize("compact_after", [(), (0,), (1,), (0, 1, 2), (2, 2)])
def test_compaction_changes_no_row(spark, tmp_path, compact_after):
    base = str(tmp_path / "t")
    for n, rows in enumerate(BATCHES):
        deltas.append_deltas(frame(spark, rows, f"f{n}"), base, n)
        for _ in range(compact_after.count(n)):
            deltas.compact(spark, base)
            assert deltas.delta_days(spark, base) == []
    assert rows_of(deltas.read_merged(spark, base)) == WANT
    assert rows_of(deltas.read_merged(spark, base, [D1, None])) == [r for r in WANT if r[0] in (D1, None)]
    assert deltas.MARK not in deltas.read_merged(spark, base).columns


def test_batches_out_of_order_and_repeated(spark, tmp_path):
    base = str(tmp_path / "t")
    for n in (1, 0, 2, 1):
        deltas.append_deltas(frame(spark, BATCHES[n], f"f{n}"), base, n)
    assert rows_of(deltas.read_merged(spark, base)) == WANT


def test_append_leaves_the_stored_day_alone(spark, tmp_path):
    base = str(tmp_path / "t")
    big = spark.range(20_000).select(F.lit(D1).alias("dt"), F.col("id").cast("string").alias("cursor"),
                                     F.rand(1).alias("amount"), F.struct(F.lit("f0").alias("file"), F.col("id").alias("row")).alias("_seq"))
    sinks.merge_days(big.select(*[f.split()[0] for f in ("dt", "cursor", "amount", "_seq")]), base)
    before = files(base)
    deltas.append_deltas(frame(spark, [(D1, "7", -1.0)], "f1"), base, 1)
    assert files(base) == before
    assert deltas._bytes(spark, deltas.delta_path(base)) < deltas._bytes(spark, base) / 20
    assert deltas.compaction_due(spark, base) == [] and deltas.compaction_due(spark, base, 1e-6) == [D1]
    merged = deltas.read_merged(spark, base)
    assert merged.count() == 20_000 and merged.where("cursor = '7'").first().amount == -1.0
    assert deltas.compact(spark, base, [D2]) == [] and deltas.compact(spark, base) == [D1]
    assert deltas.read_merged(spark, base).where("amount < 0").count() == 1


def test_days_without_deltas_are_not_shuffled(spark, tmp_path):
    base = str(tmp_path / "t")
    deltas.append_deltas(frame(spark, BATCHES[0], "f0"), base, 0)
    deltas.compact(spark, base)
    plan = deltas.read_merged(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_compaction_that_died_before_removing_deltas(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    for n in (0, 1):
        deltas.append_deltas(frame(spark, BATCHES[n], f"f{n}"), base, n)
    with monkeypatch.context() as m:
        m.setattr(deltas, "remove_path", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            deltas.compact(spark, base)
    want = sorted([r for r in WANT if r not in BATCHES[2]] + [(None, "n", 3.0)], key=str)
    assert deltas.delta_days(spark, base) and rows_of(deltas.read_merged(spark, base)) == want
    deltas.append_deltas(frame(spark, BATCHES[2], "f2"), base, 2)
    assert rows_of(deltas.read_merged(spark, base)) == WANT
    deltas.compact(spark, base)
    assert deltas.delta_days(spark, base) == [] and rows_of(deltas.read_merged(spark, base)) == WANT


def test_a_compacted_batch_is_not_taken_again(spark, tmp_path):
    base = str(tmp_path / "t")
    deltas.append_deltas(frame(spark, BATCHES[0], "f0"), base, 0)
    deltas.append_deltas(frame(spark, BATCHES[1], "f1"), base, 1)
    deltas.compact(spark, base, [D1, None])
    with pytest.raises(ValueError):
        deltas.append_deltas(frame(spark, BATCHES[1], "f1"), base, 1)
    assert deltas.append_deltas(frame(spark, BATCHES[1], "f1"), base, 1, compacted="skip") == []
    assert deltas.append_deltas(frame(spark, BATCHES[0], "f0"), base, 0, compacted="skip") == [D2]
    deltas.append_deltas(frame(spark, BATCHES[2], "f2"), base, 2)
    assert rows_of(deltas.read_merged(spark, base)) == WANT


def test_without_sequence_key_or_rows(spark, tmp_path):
    base = str(tmp_path / "t")
    assert deltas.read_merged(spark, base) is None and deltas.compact(spark, base) == []
    assert deltas.append_deltas(frame(spark, [], "f"), base, 0) == []
    for n, amount in enumerate((10.0, 8.0)):
        deltas.append_deltas(frame(spark, [(D1, "a", amount)], "f").drop("_seq"), base, n)
    assert rows_of(deltas.read_merged(spark, base)) == [(D1, "a", 8.0)]
    wide = spark.createDataFrame([(D1, "b", 3, "new")], "dt date, cursor string, amount int, note string")
    deltas.append_deltas(wide, base, 2)
    got = deltas.read_merged(spark, base)
    assert rows_of(got) == [(D1, "a", 8.0), (D1, "b", 3.0)] and "note" in got.columns
    keyless = str(tmp_path / "k")
    for n in range(2):
        deltas.append_deltas(spark.createDataFrame([(D1, 1.0), (D1, 1.0)], "dt date, amount double"), keyless, n)
    assert deltas.read_merged(spark, keyless).count() == 2
