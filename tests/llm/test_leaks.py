"""Operator 4: recall and precision against all windows, the SVD against numpy, odd rows."""

import random

import numpy as np
import pytest

from rows import SMALL, make_docs
from subledger.llm import leaks
from subledger.llm.queries import op4_decontamination


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_lcs():
    r = random.Random(1)
    for _ in range(300):
        a = [r.choice([b"a", b"b", b"c", b"d"]) for _ in range(r.randint(1, 30))]
        b = [r.choice([b"a", b"b", b"c", b"x"]) for _ in range(r.randint(0, 40))]
        assert leaks.common_words(leaks.position_masks(a), len(a), b) == plain_lcs(a, b)


def test_svd_against_numpy(spark):
    r = np.random.default_rng(4)
    m = (r.random((60, 300)) < 0.05) * r.random((60, 300)) + np.outer(r.random(60), r.random(300)) * 0.3
    rows = spark.createDataFrame([(np.flatnonzero(x).astype(np.int32).tobytes(), x[np.flatnonzero(x)].tobytes())
                                  for x in m], "at binary, x binary").repartition(5)
    want = np.linalg.svd(m)
    got = leaks.randomised_svd(rows, 300, 60, 8)
    assert got.shape == (300, 8) and np.allclose(got.T @ got, np.eye(8), atol=1e-8)
    assert np.linalg.norm(m @ got) == pytest.approx(np.sqrt((want[1][:8] ** 2).sum()), rel=0.02)
    full = leaks.randomised_svd(rows, 300, 60, 60)
    assert np.allclose(m @ full @ full.T, m, atol=1e-8)


def brute(docs, bench):
    """Every window of every document against every item by the longest common subsequence alone."""
    found = set()
    items = [(i, leaks.tokens(t), leaks.answer_words(t)) for i, t in bench]
    for d, text in docs:
        words = leaks.tokens(text)
        have = set(words)
        for i, w, a in items:
            if sum(x in have for x in w) < leaks.PARAPHRASED * len(w):
                continue
            masks, answer = leaks.position_masks(w), leaks.position_masks(w[len(w) - a:])
            for s in range(0, len(words), leaks.STEP):
                near = words[s:s + len(w) + 2 * leaks.STEP]
                share = leaks.common_words(masks, len(w), near) / len(w)
                if share >= leaks.COPIED or share >= leaks.PARAPHRASED and (
                        leaks.common_words(answer, a, near) / a >= leaks.ANSWERED):
                    found.add((d, i))
    return found


def test_query_against_all_windows(spark):
    got = {(r.doc_id, r.item_id) for r in op4_decontamination(spark, SMALL).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = brute(docs, bench)
    exact = {(d, i) for d, t in docs for i, b in bench if b"\0".join(leaks.tokens(b)) in b"\0".join(leaks.tokens(t))}
    assert exact <= got and exact
    assert len(want & got) >= 0.9 * len(want) and len(want & got) >= 0.9 * len(got)


def sentence(r, n):
    """Function words and content words in about equal parts."""
    return " ".join(f"f{int(r.paretovariate(0.8)) % 60}" if r.random() < 0.5 else f"c{int(r.random() ** 2 * 6000)}"
                    for _ in range(n))


def test_paraphrases_and_rank(spark):
    r = random.Random(5)
    bench = [(i, ". ".join(sentence(r, 14).capitalize() for _ in range(3)) + ".") for i in range(40)]
    docs, want = [], set()
    for d in range(160):
        words = sentence(r, 200).split()
        if d % 4 == 0:  # every fifth word of the question changed, two of them dropped
            copy = bench[d // 4][1].split()
            copy = [f"new{d}" if k % 5 == 2 and k < 28 else w for k, w in enumerate(copy) if k not in (3, 17)]
            words[50:50] = copy
            want.add((d, d // 4))
        docs.append({"doc_id": d, "text": " ".join(words)})
    frame, table = make_docs(spark, docs), spark.createDataFrame(bench, "item_id long, text string")
    for rank in (256, 24):  # exact, and a latent space smaller than the benchmark
        index = leaks.build_index(frame, table, rank=rank)
        got = {(d["doc_id"], h[0]) for d in docs for h in index.hits(d["text"])}
        assert len(got & want) >= 0.9 * len(want) and got <= want
    kept = leaks.decontaminated(frame, table)
    assert kept.columns == frame.columns
    assert {x.doc_id for x in kept.collect()} == {d["doc_id"] for d in docs} - {d for d, _ in want}


def test_odd_rows(spark):
    text = "Which colour has the sky over the wide quiet sea at noon in May? It is a pale blue without any cloud."
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [{"doc_id": 1, "text": None}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": text},
            {"doc_id": 3, "text": text}, {"doc_id": None, "text": "a b " + text}, {"doc_id": 5, "text": long + " " + text},
            {"doc_id": 6, "text": long}, {"doc_id": 7, "text": "It is a pale blue"}]
    docs = make_docs(spark, [r | {"item_id": 4, "cosine": 0.1} for r in rows], ", item_id long, cosine double")
    schema = "item_id long, text string, doc_id long"
    bench = spark.createDataFrame([(1, text, 9), (2, None, 9), (3, "", 9), (4, ". .", 9), (None, text, 9)], schema)
    out = leaks.find_leaks(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in out), key=str) == sorted(
        [(d, i) for d in (3, 3, None, 5) for i in (1, None)], key=str)
    kept = leaks.decontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 6, 7]
    nothing = bench.limit(0)
    assert leaks.find_leaks(docs, nothing).collect() == [] == leaks.find_leaks(docs.limit(0), bench).collect()
    assert leaks.decontaminated(docs, nothing).count() == len(rows)
    # an item longer than a passage
    book = spark.createDataFrame([(8, " ".join(f"x{i}" for i in range(200)), 0)], schema)
    assert {r.doc_id for r in leaks.find_leaks(docs, book).collect()} == {5, 6}


def test_a_benchmark_of_several_indexes(spark, monkeypatch):
    """Small bounds: empty rows use up nothing, and every item is found in its own index."""
    r = random.Random(12)
    bench = [(i, None if i % 2 else " ") for i in range(5)]
    bench += [(100 + i, " ".join(f"b{i}x{j}" for j in range(30))) for i in range(12)]
    bench += [(103, " ".join(f"second{j}" for j in range(30)))]
    docs = [{"doc_id": i, "text": f"{sentence(r, 40)} {t} {sentence(r, 40)}"} for i, t in bench[5:]]
    docs += [{"doc_id": 1, "text": sentence(r, 80)}]
    frame, table = make_docs(spark, docs), spark.createDataFrame(bench, "item_id long, text string")
    want = sorted((i, i) for i, _ in bench[5:])
    assert sorted((r.doc_id, r.item_id) for r in leaks.find_leaks(frame, table).collect()) == want
    for name, bound in (("MAX_PASSAGES", 3), ("MAX_TERMS", 70), ("BLOCK_ITEMS", 4)):
        monkeypatch.setattr(leaks, name, bound)
        assert len(list(leaks.build_indexes(frame, table))) > 3
        assert sorted((r.doc_id, r.item_id) for r in leaks.find_leaks(frame, table).collect()) == want
        assert [r.doc_id for r in leaks.decontaminated(frame, table).collect()] == [1]
        monkeypatch.undo()


def test_isolated_passages_of_a_large_benchmark(spark):
    """300 topics of four passages each fill the latent space; ten passages share no word with any."""
    r = random.Random(8)
    bench = []
    for k in range(300):
        topic = [f"t{k}x{j}" for j in range(40)]
        bench += [(4 * k + v, " ".join(topic[v:] + [f"u{k}x{v}"] * v)) for v in range(4)]
    bench += [(2000 + i, " ".join(f"lone{i}x{j}" for j in range(40))) for i in range(10)]
    docs = [{"doc_id": i, "text": f"{sentence(r, 90)} {text} {sentence(r, 90)}"} for i, text in bench[::100] + bench[1200:]]
    docs.append({"doc_id": 1, "text": sentence(r, 200)})
    frame, table = make_docs(spark, docs), spark.createDataFrame(bench, "item_id long, text string")
    index = leaks.build_index(frame, table)
    assert len(index.items) > 1000
    got = {(d["doc_id"], h[0]) for d in docs for h in index.hits(d["text"])}
    assert {(d["doc_id"], d["doc_id"]) for d in docs[:-1]} <= got
    assert {(d, i) for d, i in got if d >= 2000 or i >= 2000} == {(i, i) for i in range(2000, 2010)}
    assert not any(d == 1 for d, _ in got)


def test_common_words_in_rare_text(spark):
    """Passages just over a window size, in words that most documents have, inside words of one document."""
    r = random.Random(9)
    bench = [(n, " ".join(f"f{r.randrange(25)}" for _ in range(n))) for n in (17, 20, 33, 40, 64)]
    docs = [{"doc_id": n, "text": " ".join([f"n{n}x{k}" for k in range(83)] + [text] + [f"m{n}x{k}" for k in range(83)])}
            for n, text in bench]
    docs += [{"doc_id": 1000 + d, "text": " ".join(f"f{k}" for k in r.sample(range(25), 9)) + f" z{d}"} for d in range(400)]
    index = leaks.build_index(make_docs(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    got = [(d["doc_id"], h[0]) for d in docs for h in index.hits(d["text"])]
    assert {(n, n) for n, _ in bench} <= set(got) and all(d < 1000 for d, _ in got)
