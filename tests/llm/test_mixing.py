"""Operator 1: targets, pivotal rounding, copies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import SMALL, make_docs
from subledger.llm import mixing
from subledger.llm.queries import op1_mixing


def test_water_fill_by_hand():
    # 100 words at 5, 100 at 2, 100 at 1; 450 words wanted: 281, 112.5, 56 -> 200, 166.7, 83.3
    assert mixing.water_fill([100, 100, 100], [5, 2, 1], 1.5, 2.0) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.water_fill([0, 10], [5, 2], 1.5, 2.0) == pytest.approx([0, 15])
    assert mixing.water_fill([], [], 1.5, 2.0) == []
    assert mixing.water_fill([0, 0], [5, 2], 1.5, 2.0) == [0, 0]


def test_pivot_keeps_mass_and_expectation():
    r = random.Random(3)
    w = [r.randint(1, 50) for _ in range(40)]
    p = [r.random() for _ in range(40)]
    mass, taken = sum(a * b for a, b in zip(w, p)), np.zeros(40)
    for i in range(4000):
        q, rest = mixing.pivot_all(p, w, np.random.default_rng(i))
        assert sum(a * b for a, b in zip(w, q)) == pytest.approx(mass)
        assert all(x in (0.0, 1.0) for k, x in enumerate(q) if k != rest)
        taken += q
    assert np.abs(taken / 4000 - p).max() < 0.04


def test_query_properties(spark):
    import collections
    rows = op1_mixing(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    words = {d.doc_id: len((d.text or "").encode().split()) for d in docs}
    assert sorted(r.doc_id for r in rows) == sorted(words)
    by = collections.defaultdict(list)
    source = {d.doc_id: d.source for d in docs}
    for r in rows:
        assert r.size == words[r.doc_id]
        assert r.taken in (0, r.size, 2 * r.size)
        by[source[r.doc_id]].append(r)
    names = sorted(by)
    sizes = [sum(words[r.doc_id] for r in by[s]) for s in names]
    target = mixing.water_fill(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))], 1.5, 2.0)
    for s, n, t in zip(names, sizes, target):
        assert {(r.source_size, round(r.target, 6)) for r in by[s]} == {(n, round(t, 6))}
        assert abs(sum(r.taken for r in by[s]) - t) <= max(r.size for r in by[s])


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = sorted(map(tuple, mixing.mix_digest(docs).collect()))
    assert a == sorted(map(tuple, mixing.mix_digest(docs.repartition(13)).collect()))


def test_many_buckets_and_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    docs = make_docs(spark, [{"doc_id": i, "text": "w " * (1 + i % 17), "source": "ab"[i % 3 == 0]} for i in range(300)])
    rows = mixing.mix_digest(docs).collect()
    assert len(rows) == 300
    for t in {r.target for r in rows}:
        mine = [r for r in rows if r.target == t]
        assert abs(sum(r.taken for r in mine) - t) <= 17


def test_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT", 16)
    rows = [{"doc_id": 1, "text": "same words here", "source": "a"}] * 2_000
    rows += [{"doc_id": 10 + i, "text": f"other words {i}", "source": "b"} for i in range(2_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = mixing.mixed_documents(make_docs(spark, rows).repartition(4))
        sizes = sorted(r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect())
        copies = sum(r.copies for r in mixing.mix_digest(make_docs(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == copies and sizes[-1] < 0.4 * copies


def test_odd_rows(spark):
    rows = ([{"doc_id": None, "text": "a b", "source": None}] * 3 + [{"doc_id": 1, "text": None, "source": "s"}]
            + [{"doc_id": 2, "text": "", "source": "s"}, {"doc_id": 2, "text": " \t\n", "source": "s"}]
            + [{"doc_id": 3, "text": "x " * 50_000, "source": "s"}] + [{"doc_id": 4, "text": "y z", "source": "t"}] * 40)
    docs = make_docs(spark, [r | {"size": 5, "m": 1, "p": "x"} for r in rows], ", size int, m int, p string")
    out = mixing.mix_digest(docs).collect()
    assert len(out) == len(rows)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    assert {r.size for r in out if r.doc_id in (1, 2)} == {0}
    copies = sum(r.copies for r in out)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == copies
    four = [r for r in out if r.doc_id == 4]
    assert abs(sum(r.taken for r in four) - four[0].target) <= 2
    assert mixing.mix_digest(docs.limit(0)).collect() == []
    assert mixing.mixed_documents(docs.limit(0)).collect() == []
