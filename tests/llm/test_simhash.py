"""Operator 7 against brute force."""

import random

import numpy as np
import xxhash

from rows import SMALL, make_docs
from subledger.llm import simhash
from subledger.llm.components import component_roots
from subledger.llm.queries import op7_simhash


def plain_fingerprint(text, n=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits):
    """Smallest id reachable, by flooding."""
    comp = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= bits and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return comp


def test_fingerprint():
    for t in [None, "", " \n", "one", "Two Words", "É A b c d\te f", "x " * 999, "a b c d e f g H I j " * 7]:
        assert simhash.fingerprint(t) & (2**64 - 1) == plain_fingerprint(t)


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op7_simhash(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [plain_fingerprint(docs[i]) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]
    assert [rows[i].component_id for i in ids] == plain_components(ids, prints, 4)


def clustered(seed, n):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        base = r.getrandbits(64)
        out.append(base)
        for _ in range(r.choice([0, 0, 1, 3, 40])):  # chains and balls of near fingerprints
            base = r.choice(out[-5:])
            for _ in range(r.randint(1, 6)):
                base ^= 1 << r.randrange(64)
            out.append(base)
    return sorted(set(out))


def linked(prints, stars):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in stars:
        assert root(a) is not None
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return [root(p) for p in prints]


def test_trees_lose_no_link():
    for seed, bits, bands in [(1, 4, 3), (2, 4, 1), (3, 4, 5), (4, 6, 2), (5, 0, 1)]:
        prints = clustered(seed, 600)
        points = np.array(prints, np.uint64)
        stars = []
        for mask in simhash.band_masks(bands):
            nodes = simhash.build_tree(points[::3], mask, bits // bands, bits, 12)
            assert len(nodes) > 10
            homes = 0
            for _, home, visit in simhash.route(nodes, points, np.empty(0, np.uint64)):
                homes += len(home)
                for a, b in simhash.link(home, visit, mask, bits // bands, bits, local_rows=16):
                    stars += zip(a.tolist(), b.tolist())
            assert homes == len(points)
        assert linked(prints, stars) == plain_components(prints, prints, bits)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 40)
    monkeypatch.setattr(simhash, "SAMPLE", 512)
    prints = clustered(9, 900)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    edges = [(a % 2**64, b % 2**64) for a, b in simhash.near_links(frame).collect()]
    assert linked(prints, edges) == plain_components(prints, prints, 4)


def test_component_roots(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 400)]
    loops = [(5, 5), (9, 8), (8, 9), (9, 8)]
    got = dict(map(tuple, component_roots(spark.createDataFrame(chain + star + loops, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(101, 141)} | {i: 7 for i in range(200, 400)} | {9: 8}
    assert component_roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(spark):
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))
    rows = [{"doc_id": 9, "text": None}, {"doc_id": 4, "text": ""}, {"doc_id": None, "text": " \n"},
            {"doc_id": 6, "text": long}, {"doc_id": 2, "text": long + " end"}, {"doc_id": 2, "text": "Other text"},
            {"doc_id": 3, "text": "other TEXT"}, {"doc_id": 3, "text": "other TEXT"},
            {"doc_id": None, "text": "nobody knows this"}, {"doc_id": None, "text": "nobody knows this"}]
    docs = make_docs(spark, [r | {"fp": 1, "keep": "k"} for r in rows], ", fp long, keep string")
    out = simhash.simhash_digest(docs).collect()
    assert len(out) == len(rows)
    by = lambda i: {r.component_id for r in out if r.doc_id == i}
    assert by(9) == by(4) == {4} and by(6) == by(2) == {2} and by(3) == {2}
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = sorted((str(r.doc_id), (r.text or "")[:10]) for r in kept.collect())
    assert texts == [("2", "Other text"), ("2", "w0 w7919 w"), ("4", ""), ("None", "nobody kno")]
    assert simhash.simhash_digest(docs.limit(0)).collect() == []
    assert simhash.deduplicated(docs.limit(0)).collect() == []
