"""Operator 5: language identification by multinomial logistic regression.

Features are TF-IDF weights of character n-grams (``NGRAMS``) of the lower-cased text
(without numbers, Latin words that hold a digit, e-mail addresses, and web addresses with
a digit or @, which say nothing about the language; all letters beside them count),
hashed to ``BUCKETS`` buckets: (1 + ln tf) * idf, scaled to length one. Document
frequencies come from all learnable documents (label known, crc32 of the id not 2 mod
4), counted in the tasks and summed by a shuffle. The classifier, one weight vector per
language, is trained on a bounded sample by FTRL-proximal: per-coordinate learning
rates, an L1 penalty that keeps weights at exactly zero and an L2 penalty (elastic
net). A part of the sample (``CALIBRATE``) is not trained on; the temperature that
divides the logits is the one with the least log-loss on it. It also gives the bound below
which ``accepted`` drops a document as of no learnt language: how far the probability
lies above chance (1 / languages) for all but ``UNSURE`` of the held part, times ``MARGIN``,
and less for texts of few n-grams (half at ``SHORT`` of them), whose probability is never
high. One language alone, or too few documents to hold some back, sets no bound.

Bounds: the sample has ``PER_LANGUAGE`` documents a language on average (those with the
smallest hashes of the id; about ``MAX_SAMPLE`` in all, never twice as many); only their hashed features
come to the driver, whose model is languages x BUCKETS numbers. A table with more than
``MAX_LANGUAGES`` labels is refused. Prediction is one map over the whole texts.

Defined results: NULL text or text without a letter is ``und`` with score 0; without
any learnable document everything is ``und`` with score 0; rows with NULL or repeated
ids are predicted like any other (a NULL id is not held out and, having no checksum, is
not learnt from); other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NGRAMS = (1, 2, 3)
BUCKETS = 1 << 15
PER_LANGUAGE = 800
MAX_SAMPLE = 8_000
MAX_LANGUAGES = 256
CALIBRATE = 5          # every fifth document of the sample
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
UNSURE, MARGIN, SHORT = 0.01, 0.5, 60
PIECE = 1 << 20        # code points handled at once
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
MARK = re.compile("[0-9@]")
LATIN = "0-9A-Za-z_\u00c0-\u024f\u1e00-\u1eff"
# a web address, an e-mail address or @name, a word of Latin letters and digits; each starts once in a run
MARKED = re.compile(rf"""(?P<web>(?:https?://|www\.)[!-~]++)
    |(?<![{LATIN}.+%-])[{LATIN}.+%-]*+@[{LATIN}.@-]*+
    |(?<![{LATIN}])(?=[{LATIN}]*[0-9])[{LATIN}]++""", re.X)
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def plain_words(text: str) -> str:
    """The text without its numbers, Latin words with a digit and addresses, unless no letter remains."""
    if not MARK.search(text):
        return text
    kept = MARKED.sub(lambda m: m[0] if m["web"] and not MARK.search(m[0]) else " ", text)
    return kept if known(kept) else text


def grams(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the text's plain words."""
    text = plain_words(text)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for i in range(0, len(points), PIECE):
        piece = points[i:i + PIECE + max(NGRAMS) - 1]
        for n in NGRAMS:
            m = min(len(piece) - n + 1, PIECE)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint32)
            for k in range(n):
                h = (h ^ piece[k:k + m]) * FACTORS[k]
                h ^= h >> np.uint32(15)
            counts += np.bincount((h * FACTORS[0]) >> shift, minlength=BUCKETS)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of the TF-IDF vector of length one."""
    at = np.flatnonzero(counts)
    w = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((w * w).sum())
    return at, w / norm if norm else w


def known(text: str | None) -> bool:
    """Whether the text has a letter (the pattern also finds numerals such as a superscript two)."""
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def above_chance(p: np.ndarray) -> np.ndarray:
    """How far the best class lies above chance: 0 if all are alike, 1 if it is certain."""
    classes = p.shape[-1]
    return (p.max(-1) - 1 / classes) / (1 - 1 / classes) if classes > 1 else p.max(-1)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (BUCKETS x classes) by FTRL-proximal with elastic net."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at=slice(None)):
        za = z[at]
        return np.where(np.abs(za) <= L1, 0.0, (np.sign(za) * L1 - za) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, x, label in rows:
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights()


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the least log-loss, by golden-section search over its logarithm.

    The right class counts (n + 1) / (n + 2), not 1, so a held part without any error
    doesn't ask for boundless certainty.
    """
    n, classes = logits.shape
    if not n or classes < 2:
        return 1.0
    wanted = np.full((n, classes), 1 / (n + 2) / (classes - 1))
    wanted[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t):
        return -(wanted * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum()
    lo, hi, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bound: float = 0.0         # least distance of the probability from chance, for long texts

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, whether the score is that of a learnt language)."""
        if not self.languages or not known(text):
            return UNKNOWN, 0.0, False
        counts = grams(text)
        at, x = weigh(counts, self.idf)
        p = softmax(x @ self.weights[at] / self.temperature)
        best, n = int(p.argmax()), counts.sum()
        return self.languages[best], float(p[best]), above_chance(p) >= self.bound * n / (n + SHORT)


def _remainder(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            text = text.as_py()
            if known(text):
                df += grams(text) > 0
                n += 1
    if n:
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n))],
                                         ["bucket", "df"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, order, text in zip(batch["lang"].to_pylist(), batch["order"].to_pylist(), batch["text"]):
            text = text.as_py()
            if known(text):
                c = grams(text)
                at = np.flatnonzero(c)
                out.append((lang, order, at.astype(np.int32).tobytes(), c[at].astype(np.int32).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                ["lang", "order", "at", "n"])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the labelled documents whose crc32(id) mod 4 is not 2."""
    learn = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("lang")).filter(
        F.col(label).isNotNull() & F.col(text).isNotNull() & (_remainder(F.col(key)) != 2))
    per = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(per) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not per:
        return Model([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    counted = dict(learn.select("text").mapInArrow(_frequencies, "bucket int, df long")
                   .groupBy("bucket").agg(F.sum("df")).collect())
    total = counted.pop(-1, 0)
    df = np.zeros(BUCKETS)
    df[list(counted)] = list(counted.values())
    idf = np.log((1 + total) / (1 + df)) + 1

    per_language = min(per_language, max(1, MAX_SAMPLE // len(per)))
    order = F.xxhash64(F.lit(7), "key")
    share = F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(min(1.0, per_language / n)))])
    picked = (learn.withColumn("order", order)
              .filter(F.shiftrightunsigned("order", 11) < share[F.col("lang")] * float(1 << 53))
              .mapInArrow(_sample_features, "lang string, order long, at binary, n binary")
              .orderBy("order", "lang", "at", "n").limit(2 * MAX_SAMPLE).collect())
    languages = sorted({r["lang"] for r in picked})
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)), 1.0)
    rows = []
    for r in picked:
        counts = np.zeros(BUCKETS)
        counts[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["n"], np.int32)
        rows.append((*weigh(counts, idf), languages.index(r["lang"])))
    held = rows[::CALIBRATE] if len(rows) >= 10 * CALIBRATE else []
    weights = train_ftrl([r for i, r in enumerate(rows) if not held or i % CALIBRATE], len(languages))
    logits = np.array([x @ weights[at] for at, x, _ in held]).reshape(len(held), len(languages))
    heat = fit_temperature(logits, np.array([y for _, _, y in held], int))
    sure = above_chance(softmax(logits / heat)) if held and len(languages) > 1 else np.zeros(1)
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), heat,
                 MARGIN * float(np.quantile(sure, UNSURE)))


def _predict_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learns from ``docs`` unless a model is given."""
    fitted = docs.sparkSession.sparkContext.broadcast(model or fit(docs, key, text))
    return (docs.select(F.col(key).alias("doc_id"), F.coalesce(_remainder(F.col(key)) == 2, F.lit(False))
                        .alias("held_out"), F.col(text).alias("text"))
            .mapInArrow(_predict_task(fitted), "doc_id long, held_out boolean, lang_pred string, score double"))


def accepted(docs: DataFrame, languages: tuple[str, ...] | None = None, least: float = 0.0,
             model: Model | None = None) -> DataFrame:
    """Documents of a learnt language (one of ``languages`` if given) with a score of ``least`` and the model's bound."""
    fitted = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = fitted.value
        for batch in batches:
            found = [m.judge(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([bool(sure and p >= least and (not languages or lang in languages))
                                         for lang, p, sure in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
