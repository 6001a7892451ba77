"""Operator 12: spelling variants against a plain search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rows import SMALL, make_docs
from subledger.llm import spelling
from subledger.llm.queries import op12_spelling


def plain_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def got(df):
    rows = df.collect()
    assert len(rows) == len({r.word for r in rows})
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def scribble(rnd, n_words=160):
    """Words with their misspellings, in skewed numbers."""
    base = ["".join(rnd.choice(["an", "the", "qu", "é", "ou", "r", "st", "ü", "i"]) for _ in range(rnd.randint(2, 6)))
            for _ in range(n_words)]
    out = []
    for w in base:
        for _ in range(rnd.choice([3, 4, 9, 30])):
            out.append(w)
        for _ in range(3):
            i = rnd.randrange(len(w))
            v = rnd.choice([w[:i] + w[i + 1:], w[:i] + "a" + w[i:], w[:i] + "b" + w[i + 1:]])
            out += [v] * rnd.choice([1, 3, 5])
    rnd.shuffle(out)
    return [" ".join(out[i:i + 40]) for i in range(0, len(out), 40)]


def test_equals_all_pairs(spark):
    rnd = random.Random(7)
    rows = list(enumerate(scribble(rnd) + scribble(rnd)))
    docs = make_docs(spark, [{"doc_id": i, "text": t.title() if i % 3 else t} for i, t in rows])
    want = brute(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)
    assert any(r[1] and r[1] != r[2] for r in want)      # a chain of forms
    assert got(spelling.variants(docs)) == want
    # many small shards, small leaves, a sample smaller than the vocabulary
    assert got(spelling.variants(docs, shard_words=9, sample=200, leaf=3)) == want


@pytest.mark.parametrize("leaf", [2, 17, 1_000])
@pytest.mark.parametrize("size,other", [(5, 5), (6, 5), (9, 9), (9, 8)])
def test_near_pairs_of_lengths(size, other, leaf):
    rnd = random.Random(size * other + leaf)
    draw = lambda n: sorted({"".join(rnd.choice("aabcéÿ") for _ in range(n)) for _ in range(150)})
    home, visit = draw(size), draw(other)
    if size == other:
        visit = home
    x, y = spelling.near_pairs(spelling.letters(home), spelling.letters(visit), leaf)
    pairs = list(zip(x.tolist(), y.tolist()))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, j) for i, a in enumerate(home) for j, b in enumerate(visit) if one_edit(a, b)}


def test_coarse_tree_keeps_all_in_reach():
    rng = np.random.default_rng(4)
    points = np.zeros((400, 256), np.int32)
    points[:, 97:105] = rng.integers(0, 4, (400, 8))
    tree = spelling.coarse_tree(points, 20)
    home = {}
    for leaf, rows in spelling.reached(tree, points, 0):
        home |= dict.fromkeys(rows.tolist(), leaf)
    assert sorted(home) == list(range(400)) and len(set(home.values())) > 8
    for radius in (1, 2):
        seen = {(leaf, i) for leaf, rows in spelling.reached(tree, points, radius) for i in rows.tolist()}
        far = np.abs(points[:, None] - points[None]).sum(axis=2)
        assert all((home[j], i) in seen for i, j in zip(*np.nonzero(far <= radius)))
        assert len(seen) < 400 * len(set(home.values()))


def test_odd_rows(spark):
    long = "x" * 5_000
    rows = [(1, None), (2, ""), (None, "thing thing thing"), (3, "Thing ×÷abc ÉtéÉÉ étéÉÉ "),
            (4, f"{long} {long} {long} {long}y {long}y {long}y"), (5, "abcde,abcde;abcde abcdf abcdf abcdf"), (5, "abcde"),
            (6, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa"), (7, "12345 中文 ____")]
    docs = make_docs(spark, [{"doc_id": i, "text": t, "n": 9, "word": "w"} for i, t in rows], ", n long, word string")
    assert got(spelling.variants(docs)) == brute(plain_words(rows))
    assert got(spelling.variants(make_docs(spark, []))) == set()
    twice = docs.unionByName(docs)
    assert got(spelling.variants(twice)) == brute(plain_words(rows + rows))


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([(r.doc_id, r.text) for r in docs])
    result = got(op12_spelling(spark, SMALL))
    assert {(r[0], r[3]) for r in result} == set(words.items())
    # near words by wildcards instead of distances
    slots = {}
    for w in words:
        for i in range(len(w)):
            slots.setdefault((w[:i], "?", w[i + 1:]), set()).add(w)
            slots.setdefault((w[:i] + w[i + 1:],), set()).add(w)
    many = Counter()
    for w in words:
        near = set().union(*(slots[(w[:i], "?", w[i + 1:])] for i in range(len(w)))) | slots.get((w,), set())
        near |= {w[:i] + w[i + 1:] for i in range(len(w))} & set(words)
        many[w] = len(near - {w})
    assert {(r[0], r[4]) for r in result} == set(many.items())
