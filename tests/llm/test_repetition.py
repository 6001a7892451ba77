"""Operator 10 against plain counting."""

import random

import duckdb
import numpy as np

from rows import SMALL, make_docs
from subledger.llm import repetition
from subledger.llm.queries import op10_repetition


def split(text, spaces=" \t\n\v\f\r"):
    words, word = [], ""
    for c in text + " ":
        if c in spaces:
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    return words


def plain_cover(words, size):
    seen = {}
    for i in range(len(words) - size + 1):
        seen.setdefault(tuple(words[i:i + size]), []).append(i)
    return {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + size)}


def plain_longest(words):
    n = 0
    while any(True for _ in plain_cover(words, n + 1)):
        n += 1
    return n


def plain(text):
    text = text or ""
    words, lines, again = split(text), [], 0
    for line in text.split("\n"):
        if split(line):
            again += line in lines
            lines.append(line)
    repeat = len(plain_cover(words, 3))
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    cover, longest = len(plain_cover(words, 8)), plain_longest(words)
    good = cover <= 0.15 * len(words) and longest <= 100
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, repeat, failed,
            good and not failed, cover, longest)


COLUMNS = ("n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept covered_words "
           "longest_repeat").split()


def test_suffix_array():
    r = random.Random(1)
    for _ in range(300):
        ids = [r.randint(0, r.choice([0, 1, 3, 40])) for _ in range(r.randint(1, 60))]
        order, lcp = repetition.suffix_array(np.array(ids))
        want = sorted(range(len(ids)), key=lambda i: ids[i:])
        assert order.tolist() == want

        def common(a, b):
            n = 0
            while max(a, b) + n < len(ids) and ids[a + n] == ids[b + n]:
                n += 1
            return n
        assert lcp.tolist() == [0] + [common(a, b) for a, b in zip(want, want[1:])]


def test_measure():
    r = random.Random(2)
    for _ in range(60):
        phrase = " ".join(r.choice("abcdefgh") * 3 for _ in range(r.randint(1, 40)))
        text = " \n".join(r.choice([phrase, f"x{r.random()} # é", "", "same line here", " \t"]) for _ in range(9))
        m = repetition.measure(text)
        assert tuple(m[c] for c in COLUMNS) == plain(text)
        words = split(text)
        assert {j for s in m["repeats"] for j in range(s["first"], s["end"])} == plain_cover(words, 8)


def test_query(spark):
    rows = op10_repetition(spark, SMALL).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS[:-1]) == plain(docs[r.doc_id])[:-1]
    assert 0.5 < sum(r.kept for r in rows) / len(rows) < 1


def test_oracle_reaches_the_verdict():
    """The SQL against the operator on texts whose longest repeats lie around the limits."""
    r = random.Random(4)
    texts = [None, "", "a " * 60, "x y"]
    for n in (20, 60, 100, 101, 150, 200):
        for rest in (100, 300, 330, 340, 700):
            part = [f"p{r.random()}" for _ in range(n)]
            texts.append(" ".join(part + [f"w{r.random()}" for _ in range(rest)] + part))
            texts.append(" ".join([f"c{j % 20}" for j in range(n + 20)] + [f"w{r.random()}" for _ in range(rest)]))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = con.execute(repetition.oracle()).fetchdf().set_index("doc_id")
    kept = set()
    for i, t in enumerate(texts):
        m = repetition.measure(t)
        assert {c: got.loc[i, c] for c in got.columns} == {c: m[c] for c in got.columns}, i
        kept.add((m["base_failed"], m["kept"]))
    assert kept == {(True, False), (False, False), (False, True)}


def test_pasted_passages_are_caught():
    """Texts that the base rule passes: the verdict is the suffix array's alone."""
    words = [f"w{i}" for i in range(4_000)]
    clean = repetition.measure(" ".join(words))
    once = repetition.measure(" ".join(words + words[1_000:1_120]))              # 120 words pasted: 3 % each time
    many = repetition.measure(" ".join(words + [x for i in range(0, 400, 10) for x in words[i:i + 9]]))  # blocks of nine
    few = repetition.measure(" ".join(words + words[1_000:1_060]))               # a quoted paragraph
    assert not any(m["base_failed"] for m in (clean, once, many, few))
    assert [m["kept"] for m in (clean, once, many, few)] == [True, False, False, True]


def test_the_verdict_decides_documents_of_the_table(spark):
    rows = op10_repetition(spark, "/root/testdata/sf0.1").collect()
    passed = [r for r in rows if not r.base_failed]
    dropped = [r for r in passed if not r.kept]
    assert 0 < len(dropped) < 0.05 * len(passed)


def test_odd_rows(spark):
    rows = [{"doc_id": 1, "text": None}, {"doc_id": None, "text": ""}, {"doc_id": 2, "text": "   x"},
            {"doc_id": 2, "text": "a " * 120_000}, {"doc_id": 3, "text": " ".join(f"w{i}" for i in range(120_000))}]
    docs = make_docs(spark, [r | {"kept": True, "n_words": 3} for r in rows], ", kept boolean, n_words int")
    out = repetition.repetition(docs).collect()
    assert [(r.n_words, r.kept, r.base_failed) for r in out] == [
        (0, False, True), (0, False, True), (2, False, True), (120_000, False, True), (120_000, True, False)]
    assert out[2].word_chars == 3 and out[3].n_repeat_words == 120_000 and out[3].longest_repeat == 119_999
    assert repetition.repetition(docs.limit(0)).collect() == []
