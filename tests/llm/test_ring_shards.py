"""Operator 9: bounded loads on the ring."""

import collections
import zlib

from rows import SMALL, make_docs
from subledger.llm import ring_shards
from subledger.llm.queries import op9_sharding


def one_by_one(counts, n_shards, vnodes):
    """The same law, key after key: own shard while it has room, then clockwise."""
    at, owner = ring_shards.ring_points(n_shards, vnodes)
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    first = {c: next((i for i, a in enumerate(at) if a >= c), 0) for c in counts}
    got, left = collections.defaultdict(list), []
    for c in sorted(counts):
        for r in range(counts[c]):
            if room[owner[first[c]]]:
                room[owner[first[c]]] -= 1
                got[c].append(owner[first[c]])
            else:
                left.append(c)
    for c in left:
        i = first[c]
        while not room[owner[i % len(at)]]:
            i += 1
        room[owner[i % len(at)]] -= 1
        got[c].append(owner[i % len(at)])
    return got


def test_plan_equals_key_by_key():
    counts = {c: 1 + c * 7919 % 11 for c in range(0, ring_shards.CELLS, 37)}
    counts[37] = 900  # a heavy cell
    want = one_by_one(counts, 7, 8)
    got = collections.defaultdict(list)
    for cell, lo, hi, shard in sorted(ring_shards.plan_cells(counts, 7, 8)):
        assert lo == len(got[cell])
        got[cell] += [shard] * (hi - lo)
    assert got == want


def test_limited_movement():
    counts = {c: 20 for c in range(ring_shards.CELLS)}

    def where(n):
        return {(c, r): s for c, lo, hi, s in ring_shards.plan_cells(counts, n, 64) for r in range(lo, hi)}
    a, b = where(24), where(25)
    moved = sum(a[k] != b[k] for k in a) / len(a)
    assert 1 / 25 < moved < 0.4


def check(rows, n=24):
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert set(shards) <= set(range(n))
    sizes = [len(shards[s]) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))


def test_query(spark):
    rows = op9_sharding(spark, SMALL).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check(rows)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


def test_odd_rows(spark, tmp_path):
    rows = ([{"doc_id": 5, "text": "same"}] * 100 + [{"doc_id": None, "text": None}] * 30
            + [{"doc_id": i, "text": "é" * i} for i in range(70)])
    docs = make_docs(spark, [r | {"shard": 1, "size": 2, "cell": 3} for r in rows], ", shard int, size int, cell int")
    out = ring_shards.shard_digest(docs).collect()
    assert len(out) == 200
    check(out)
    assert {(r.size, r.text_crc32) for r in out if r.doc_id is None} == {(8, 0)}
    assert ring_shards.shard_digest(docs.limit(0)).collect() == []
    ring_shards.write_shards(docs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def test_same_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = sorted(tuple(r)[:6] for r in ring_shards.shard_digest(docs).collect())
    assert a == sorted(tuple(r)[:6] for r in ring_shards.shard_digest(docs.repartition(11)).collect())
