"""Operator 11: the trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from rows import SMALL
from subledger.llm import prefix_trie as pt
from subledger.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, level string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(base, [])[:h] + t[h:])
    node = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            node[t[:d]].append(c)
    kids = defaultdict(list)
    for p in node:
        if p:
            kids[p[:-1]].append(p)
    leaves, kept = {}, {}
    for p in sorted(node, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        kept[p] = (len(node[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(kept[k] for k in kids[p])
    out = []
    for p, members in node.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(p))
        out.append((min(members), len(p), min(node[p[:-1]]) if p else None, len(members), len(kids[p]), leaves[p], kept[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert set(FIELDS) <= set(df.columns)
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)


def talk(rnd, convs, kinds, most):
    """Conversations whose turns are drawn from few texts, so prefixes are shared at any depth."""
    rows = []
    for c in convs:
        n = rnd.choice(most)
        script = rnd.randrange(3)
        for t in range(n):
            text = f"{script}-{t}" if rnd.random() < 0.95 else f"é{rnd.randrange(kinds)}"
            rows.append((c, t, rnd.choice(["user", "user", "user", None]), text))
    rnd.shuffle(rows)
    return rows


@pytest.fixture
def many_shards(spark):
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("most", [[0, 1, 2, 5, 9], [15, 16, 17, 31, 32, 33, 70]], ids=["short", "long"])
def test_equals_a_dictionary_of_prefixes(spark, many_shards, most):
    rnd = random.Random(len(most))
    rows = talk(rnd, range(-7, 140), 4, most)
    assert got(pt.prefix_trie(frame(spark, rows).repartition(5))) == brute(rows)


def test_one_shard(spark):
    rows = talk(random.Random(1), range(60), 2, [3, 16, 40])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64m")
    try:
        assert got(pt.prefix_trie(frame(spark, rows).repartition(1))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")


def test_hot_conversations(spark, many_shards, monkeypatch):
    """A third of the conversations are equal and their node lies in many shards; one conversation is very long."""
    monkeypatch.setattr(pt, "PIECE", 3)
    monkeypatch.setattr(pt, "SLICE", 50)
    monkeypatch.setattr(pt, "LEVELS", 4)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 300) for t in range(4 if c % 3 == 0 else c % 4)]
    rows += [(1000, t, "user", f"same {t}") for t in range(700)] + [(1001, t, "user", f"same {t}") for t in range(650)]
    assert got(pt.prefix_trie(frame(spark, rows).repartition(6))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 5, "user", "x" * 100_000),
            (2, 1, "user", "a"), (2, 1, "user", "b"), (2, 1, "user", "a"), (5, 0, "user", "u"), (5, 1, "sys", "u"),
            (6, 0, "user", "u"), (7, 3, "u", "ser"), (8, 3, "us", "er"), (-3, 0, "user", "u"), (-6, 0, "user", "u")]
    assert got(pt.prefix_trie(frame(spark, rows))) == brute(rows)
    assert got(pt.prefix_trie(frame(spark, rows + rows))) == brute(rows + rows)
    assert got(pt.prefix_trie(frame(spark, []))) == []
    assert got(pt.prefix_trie(frame(spark, [(None, 1, "user", "a")]))) == []


def test_turnless_conversation(spark):
    """Conversation c keeps nothing of its own if its head is as long as it is and its group has no first."""
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert got(pt.prefix_trie(frame(spark, rows))) == brute(rows)
    assert got(pt.prefix_trie(frame(spark, rows)))[0][:5] == (c, 0, None, 1, 0)


def test_query_on_the_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert got(op11_prefix_trie(spark, SMALL)) == brute(rows)
