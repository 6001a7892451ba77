"""Operator 13: the block matrix join against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import SMALL
from subledger.llm import block_search as bs
from subledger.llm.queries import op13_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute(rows, every, k):
    """All pairs, one by one; rows as (id, vector)."""
    own = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) for x in v]
        if i not in own or v < own[i]:
            own[i] = v
    out = set()
    for q, a in own.items():
        if q % every:
            continue
        near = []
        for c, b in own.items():
            if c != q and len(a) == len(b):
                s = sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))
                near.append((-s, c))
        out |= {(q, r + 1, c, round(-s, 9)) for r, (s, c) in enumerate(sorted(near)[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 7) for i, v in rows], SCHEMA)


def got(df):
    rows = df.collect()
    assert len(rows) == len({(r.query_id, r["rank"]) for r in rows})
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in rows}


def test_equals_all_pairs_in_small_tiles(spark):
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(9)] for _ in range(6)]
    rows = [(i, [x + rnd.gauss(0, 0.05) for x in rnd.choice(centres)]) for i in range(300)]
    df = frame(spark, rows).repartition(5)
    want = brute(rows, 10, 5)
    assert got(bs.nearest(df, F.col("id") % 10 == 0, 5, query_block=7, candidate_block=40)) == want
    assert got(bs.nearest(df, F.col("id") % 10 == 0, 5)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.1]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (None, [1.0, 0.0]), (7, [-0.0, 1.0]), (8, [0.0, 1.0]), (9, [1.0, 0.0, 0.0]), (100, [1.0, 2.0, 3.0]),
            (150, [1.0] * 5), (10, [3.0, 0.0]), (10, [2.0, 0.3]), (11, [1e-30, 1e-30]), (12, [1e30, 1e30]), (0, [1.0, 0.0]),
            (-50, [0.3, -0.4])]
    assert got(bs.neighbours(frame(spark, rows))) == brute(rows, 50, 5)
    assert bs.neighbours(frame(spark, [])).collect() == []
    assert bs.neighbours(frame(spark, [(0, [1.0, 2.0])])).collect() == []
    assert dict(bs.neighbours(frame(spark, rows)).dtypes) == {
        "query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}


def test_copies_and_ties(spark):
    """A third of the rows are one vector: the smaller ids win, and no tile sees more than six of them."""
    rnd = random.Random(5)
    hot = [rnd.gauss(0, 1) for _ in range(8)]
    rows = [(i, hot if i % 3 == 0 else [rnd.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    assert got(bs.neighbours(frame(spark, rows).repartition(7))) == brute(rows, 50, 5)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    for dims in (3, 64, 2_500):
        a, b = rng.normal(size=(20, dims)), rng.normal(size=(300, dims)) * rng.choice([1e-3, 1, 50], (300, 1))
        exact = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)
        near, off = bs.Codes(a).bounds(bs.Codes(b), 0, 300)
        assert (np.abs(near - exact) <= off).all()
        if dims > 3:
            assert off.max() < 0.05
    assert bs.Codes(a).code.dtype == np.int8


@pytest.mark.parametrize("strip", [1, 3, 64, 1_000])
def test_tile_equals_plain_search(strip):
    rng = np.random.default_rng(strip)
    q, c = rng.normal(size=(11, 6)), np.repeat(rng.normal(size=(50, 6)), 3, axis=0)
    first = rng.permutation(150)
    heaps = bs.search_tile(q, c, first, 6, strip)
    score = bs.dots(np.repeat(q, 150, axis=0), np.tile(c, (11, 1))).reshape(11, 150) / (
        bs.Codes(q).norm[:, None] * bs.Codes(c).norm)
    for row, heap in zip(score, heaps):
        want = sorted(range(150), key=lambda j: (-row[j], first[j]))[:6]
        assert [x[2] for x in sorted(heap, reverse=True)] == want


def test_query_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert got(op13_neighbours(spark, SMALL)) == brute(rows, 50, 5)
