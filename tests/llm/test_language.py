"""Operator 5: held-out accuracy, the learner against a plain version, odd rows."""

import math
import zlib

import numpy as np
import pytest

from rows import SMALL, make_docs
from subledger.llm import language
from subledger.llm.queries import op5_language


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op5_language(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_rows_and_labels_teach_nothing(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    from pyspark.sql import functions as F
    held = language._remainder(F.col("doc_id")) == 2
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "text", F.when(held, F.lit("zzz")).otherwise(F.col("text"))).withColumn("source", F.lit("s"))
    again = language.fit(other)
    assert again.languages == model.languages and again.temperature == model.temperature
    assert (again.weights == model.weights).all() and (again.idf == model.idf).all()


def test_grams_by_hand(monkeypatch):
    text = "Ab cÉ" * 40

    def bucket(points):
        h = np.uint32(len(points))
        with np.errstate(over="ignore"):
            for k, c in enumerate(points):
                h = (h ^ np.uint32(c)) * language.FACTORS[k]
                h ^= h >> np.uint32(15)
            return int((h * language.FACTORS[0]) >> np.uint32(17))
    want = np.zeros(language.BUCKETS, int)
    low = [ord(c) for c in text.lower()]
    for n in language.NGRAMS:
        for i in range(len(low) - n + 1):
            want[bucket(low[i:i + n])] += 1
    assert (language.grams(text) == want).all()
    monkeypatch.setattr(language, "PIECE", 7)
    assert (language.grams(text) == want).all()


def test_numbers_and_addresses_are_no_words():
    assert language.plain_words("Ab c3 x@y.z dé") == "Ab     dé"
    assert language.plain_words("a1 @b") == "a1 @b" and language.plain_words("a b") == "a b"
    language.plain_words("a" * 300_000 + " 1 " + "b" * 300_000 + "1")


def test_letters_beside_numbers_and_addresses_stay():
    plain = lambda text: language.plain_words(text).split()
    assert plain("In 東京は2020年に開催した") == ["In", "東京は", "年に開催した"]
    assert plain("ใน2020ปี เมลfoo@bar.comครับ") == ["ใน", "ปี", "เมล", "ครับ"]
    assert plain("Covid-19-Pandemie в 2020-го (Anfrage:foo.b@bar.com)/danke c3") == [
        "Covid-", "-Pandemie", "в", "-го", "(Anfrage:", ")/danke"]
    assert plain("siehe https://a1.example.com/x?y=2 oder www.example.com @name 1") == [
        "siehe", "oder", "www.example.com"]
    for piece in ("a", "a1", "@", "a.", "1-", "www.", "https://", "東1"):
        language.plain_words(piece * 200_000 + "1")


def test_ftrl_step_by_step():
    r = np.random.default_rng(1)
    rows = [(np.sort(r.choice(30, 5, False)), r.random(5), int(r.integers(3))) for _ in range(25)]
    z, n = np.zeros((30, 3)), np.zeros((30, 3))

    def w(i, c):
        if abs(z[i, c]) <= language.L1:
            return 0.0
        return (math.copysign(language.L1, z[i, c]) - z[i, c]) / (
            (language.BETA + math.sqrt(n[i, c])) / language.ALPHA + language.L2)
    for _ in range(2):
        for at, x, y in rows:
            score = [sum(w(i, c) * v for i, v in zip(at, x)) for c in range(3)]
            e = [math.exp(s) for s in score]
            old = {(i, c): w(i, c) for i in at for c in range(3)}
            for i, v in zip(at, x):
                for c in range(3):
                    g = v * (e[c] / sum(e) - (c == y))
                    s = (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / language.ALPHA
                    z[i, c] += g - s * old[i, c]
                    n[i, c] += g * g
    got = language.train_ftrl(rows, 3, epochs=2)
    assert np.allclose(got[:30], [[w(i, c) for c in range(3)] for i in range(30)])


def test_temperature():
    r = np.random.default_rng(2)
    logits = r.normal(size=(4000, 3)) * 2
    p = language.softmax(logits)
    labels = np.array([r.choice(3, p=x) for x in p])
    assert language.fit_temperature(logits * 3, labels) == pytest.approx(3, rel=0.1)
    assert language.fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_odd_rows(spark, model):
    rows = [{"doc_id": 1, "text": None}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": "12 34 !?\n²Ⅷ"},
            {"doc_id": None, "text": "the hand of the that"}, {"doc_id": 5, "text": "der die und " * 200_000}]
    docs = make_docs(spark, [r | {"score": 0.5, "lang_pred": "x"} for r in rows], ", score double, lang_pred string")
    out = language.identify(docs, model).collect()
    assert [(r.lang_pred, r.score) for r in out[:3]] == [("und", 0.0)] * 3
    assert out[3].lang_pred == "en" and out[3].held_out is False
    assert out[4].lang_pred == "de"
    kept = language.accepted(docs, model=model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [None, 5]
    assert language.accepted(docs, ("de",), model=model).count() == 1
    # nothing to learn from
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"und"}
    assert language.identify(docs.limit(0)).collect() == [] == language.accepted(docs.limit(0)).collect()
    # one language only
    one = make_docs(spark, [{"doc_id": i, "text": f"some words {i}", "lang": "en"} for i in range(80)])
    assert {(r.lang_pred, r.score) for r in language.identify(one).collect()} == {("en", 1.0)}


def test_documents_of_no_learnt_language_go(spark, model):
    clean = spark.read.parquet(f"{SMALL}/documents.parquet")
    r = np.random.default_rng(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "αβγδεζηθικλμνξοπρστυφχψω",
                 "абвгдежзийклмнопрстуфхцчшщыьэюя", "".join(map(chr, range(0x4e00, 0x5600)))]
    noise = [" ".join("".join(r.choice(list(a), r.integers(2, 9))) for _ in range(n))
             for a in alphabets for n in (12, 60, 300)]
    docs = clean.unionByName(make_docs(spark, [{"doc_id": -1 - i, "text": t} for i, t in enumerate(noise)]))
    kept = {x.doc_id for x in language.accepted(docs, model=model).collect()}
    assert kept == {x.doc_id for x in clean.collect() if language.known(x.text)}
