"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _duck_type(dt) -> str:
    name = dt.simpleString().upper()
    return {"INT": "INTEGER", "STRING": "VARCHAR", "TIMESTAMP_NTZ": "TIMESTAMP",
            "TIMESTAMP": "TIMESTAMP WITH TIME ZONE"}.get(name, name)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    from subledger.plans import queries
    assert set(queries.registered()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    types = {f.name: _duck_type(f.dataType) for f in df.schema.fields}
    assert types == {d[0]: str(d[1]).upper() for d in res.description}
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema


SPLIT_PATH = ["timeline_intervals", "daily_active_sweep", "store_daily_active", "tx_attributed", "tx_matched"]


FINE = {"subledger.scan.bucketRows": "7"}


@pytest.mark.parametrize("fine", [False, True], ids=["large-buckets", "small-buckets"])
@pytest.mark.parametrize("name", SPLIT_PATH)
def test_hot_key_path_matches_oracle(spark, con, name, fine):
    """With the hot-key threshold at 0 every scan takes the bucketed two-level path."""
    confs = {"subledger.scan.hotKeyRows": "0", **(FINE if fine else {})}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = E.queries()[name](spark, SMALL)
        srows = [tuple(r) for r in df.collect()]
    finally:
        for k in confs:
            spark.conf.unset(k)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _rows(df.columns, srows) == _rows(ocols, res.fetchall())
