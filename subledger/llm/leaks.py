"""Operator 4: benchmark decontamination by latent semantic retrieval.

The benchmark is cut into passages of at most ``PASSAGE`` words. Their TF-IDF matrix
(document frequencies counted over all documents; terms that no passage has share
``OTHER`` buckets, which matters for the length of a window only) gets a distributed
randomised SVD: a Gaussian test matrix, power iterations whose products X'(XQ) are
summed over the tasks, and the Gram matrix of XQ for the last rotation. With ``RANK`` or
fewer passages the latent space holds them exactly. A passage of which it holds less
than ``WEAK`` (its words are in few other passages, so its direction is none of the
largest) is compared by its own TF-IDF vector instead, in the texts that have one of its
rarer words; without any of these too few words are left to verify it.

Documents are read as overlapping windows of 16, 32 and 64 words, one every ``STEP``
words; a passage is compared with the smallest window that holds it. The cosine is taken
over the length of the window or, if that is less, of the passage: what else is in a
window that is larger than the passage, or in more telling words, can't hide a copy.
A window's cosine can't exceed the share of its TF-IDF mass on benchmark terms, nor the
sum of the most that each of its terms adds for any passage; windows below these bounds
are passed over without projecting them, which loses none.
Candidates (cosine of ``COSINE``, relative to how well the latent space holds the
passage) are verified on the words themselves: longest common subsequence of passage
and window with its surroundings, in relation to the passage. A passage is found if
the relation is ``COPIED``, or ``PARAPHRASED`` and its answer, the last sentence, is
there to ``ANSWERED``.

All of it is a map over whole texts; what is broadcast (terms, latent vectors) is
an index of at most ``MAX_PASSAGES`` passages and ``MAX_TERMS`` terms. A larger benchmark
is cut between items into several indexes, each with a map of its own; nothing of it is
left out. Only one item that is larger by itself makes a larger index.

Defined results: NULL and empty texts and items never match; a document that holds an
item is returned once per item with its best place, repeated rows each time; NULL ids
stay NULL; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

PASSAGE = 64
SCALES = (16, 32, 64)
STEP = 8
RANK = 256
OVERSAMPLE = 16
POWER = 2
COSINE = 0.4
WEAK = 0.3             # length in the latent space below which a passage is compared by its own vector
COPIED = 0.75
PARAPHRASED = 0.5
ANSWERED = 0.8
FEW_WORDS = 8          # shorter passages have to be there in full
MAX_PASSAGES = 100_000   # passages and terms of one index; a larger benchmark has several
MAX_TERMS = 1 << 16       # a task's sums of the SVD are at most MAX_TERMS x (RANK + OVERSAMPLE) doubles, 143 MB
BLOCK_ITEMS = 50_000      # benchmark rows that the driver reads at a time
OTHER = 1 << 16         # buckets for the document frequencies of terms that no passage has
SEGMENT = 32_768       # words of a text handled at once
BOUND_CELLS = 1 << 31  # terms x passages up to which the terms' largest shares are computed
CHUNK = 256            # terms in a row of partial sums
DROP = b".,;:!?\"'()[]{}"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER, DROP).split()


def answer_words(text: str | None) -> int:
    """How many words the last sentence has (of one sentence: its last third)."""
    parts = [p for p in map(tokens, SENTENCE.split((text or "").strip())) if p]
    if not parts:
        return 0
    return len(parts[-1]) if len(parts) > 1 else -(-len(parts[0]) // 3)


def common_words(masks: dict[bytes, int], n: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence of ``words`` and the n words with these position masks."""
    full = rest = (1 << n) - 1
    for w in words:
        m = masks.get(w)
        if m:
            hit = rest & m
            rest = ((rest + hit) | (rest - hit)) & full
    return n - rest.bit_count()


def position_masks(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def term_ids(words: Iterable[bytes], terms: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words: passage terms first, then the buckets of all others."""
    get, n = terms.get, len(terms)
    return np.fromiter([n + crc32(w) % OTHER if (i := get(w)) is None else i for w in words], np.int32)


@dataclass
class Index:
    """Benchmark passages in the latent space."""
    items: list[int | None]
    words: list[list[bytes]]
    answers: list[int]         # length of the passage's answer, its last words
    terms: dict[bytes, int]
    idf: np.ndarray            # of the terms, then of the buckets of other terms
    basis: np.ndarray          # terms x rank, scaled by idf
    latent: np.ndarray         # passages x rank, divided by its squared length
    capture: float             # least length of a passage in the latent space
    most: np.ndarray           # the most that a term adds for any passage, and that over the passage's length
    size: np.ndarray           # lengths of the passages
    weak: dict[int, tuple[np.ndarray, np.ndarray]]  # (terms, weights) of the passages outside of the latent space

    @cached_property
    def by_scale(self) -> list[tuple[int, np.ndarray]]:
        n = np.array([len(w) for w in self.words])
        out, below = [], 0  # (words of a window, its passages)
        for s in SCALES:
            mine = np.flatnonzero((n > below) & ((n <= s) | (s == SCALES[-1])))
            out.append((s, mine[[int(p) not in self.weak for p in mine]] if self.weak else mine))
            below = s
        return [x for x in out if len(x[1])]

    @cached_property
    def rare(self) -> tuple[np.ndarray, np.ndarray]:
        """(first entry of each term, passages): weak passages by their rarer words; the others can't verify them."""
        pairs = []
        for p in self.weak:
            ids = term_ids(self.words[p], self.terms)
            ids = ids[np.argsort(-self.idf[ids], kind="stable")]
            # a term's places are together or not, so it is listed with its first
            pairs += [(t, p) for t in set(ids[:int((1 - PARAPHRASED) * len(ids)) + 1].tolist())]
        at = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return np.searchsorted(at[:, 0], np.arange(len(self.terms) + 1)), at[:, 1]

    def _own_vectors(self, ids: np.ndarray, start: int, mass: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """Windows above the threshold of the weak passages, by their own vectors."""
        first, passages = self.rare
        here = np.unique(ids[ids < len(self.terms)])
        found = {int(p) for t in here[first[here + 1] > first[here]] for p in passages[first[t]:first[t + 1]]}
        weights, blocks = np.zeros(len(self.idf)), len(mass) - 1
        for p in sorted(found):
            at, x = self.weak[p]
            weights[at] = x * self.idf[at]
            sums = np.concatenate([[0], np.cumsum(np.add.reduceat(weights[ids], np.arange(0, len(ids), STEP)))])
            weights[at] = 0
            k = min(next((s for s in SCALES if len(self.words[p]) <= s), SCALES[-1]) // STEP, blocks)
            cosine = (sums[k:] - sums[:-k]) / np.minimum(np.sqrt(np.maximum(mass[k:] - mass[:-k], 1e-12)), self.size[p])
            for b in np.flatnonzero(cosine >= COSINE):
                yield p, start + int(b) * STEP, start + min(len(ids), int(b + k) * STEP), float(cosine[b])

    @cached_property
    def masks(self):
        return [(position_masks(w), position_masks(w[len(w) - a:])) for w, a in zip(self.words, self.answers)]

    def candidates(self, words: list[bytes]) -> Iterator[tuple[int, int, int, float]]:
        """(passage, first word, end word, cosine) of the windows above the threshold."""
        for start in range(0, len(words), SEGMENT):
            if start and len(words) - start <= SCALES[-1]:
                return
            yield from self._segment(words[start:start + SEGMENT + SCALES[-1]], start)

    @cached_property
    def per_word(self) -> np.ndarray:
        """For each word number: its TF-IDF mass, that on benchmark terms, the most it adds, over a passage's length."""
        out = np.zeros((len(self.idf), 4))
        out[:, 0] = self.idf ** 2
        out[:len(self.terms), 1] = out[:len(self.terms), 0]
        out[:len(self.terms), 2:] = self.most
        return out

    def _segment(self, words: list[bytes], start: int) -> Iterator[tuple[int, int, int, float]]:
        ids, n = term_ids(words, self.terms), len(self.terms)
        blocks = -(-len(ids) // STEP)
        bounds = np.zeros((blocks + 1, 4))
        np.cumsum(np.add.reduceat(self.per_word[ids], np.arange(0, len(ids), STEP)), axis=0, out=bounds[1:])
        if self.weak:
            yield from self._own_vectors(ids, start, bounds[:, 0])
        todo = []
        for scale, passages in self.by_scale:
            k = min(scale // STEP, blocks)
            mass, own, most, over = (bounds[k:] - bounds[:-k]).T
            limit = COSINE * np.sqrt(mass) - 1e-4
            at = np.flatnonzero((most >= limit) & (np.sqrt(np.maximum(own, 0)) >= self.capture * limit)
                                | (over >= COSINE - 1e-4))
            if len(at):
                todo.append((k, passages, at, np.sqrt(np.maximum(mass[at], 1e-12))))
        if not todo:
            return
        # the blocks of these windows in the latent space
        used = np.unique(np.concatenate([(at[:, None] + np.arange(k)).ravel() for k, _, at, _ in todo]))
        place = np.full(blocks, len(used))
        place[used] = np.arange(len(used))
        inside = np.flatnonzero((ids < n) & np.repeat(place < len(used), STEP)[:len(ids)])
        block = place[inside // STEP]
        heads = np.flatnonzero(np.diff(block, prepend=-1))
        sums = np.zeros((len(used), self.basis.shape[1]), np.float32)
        if len(heads):
            sums[block[heads]] = np.add.reduceat(self.basis[ids[inside]], heads, axis=0)
        for k, passages, at, length in todo:
            latent = self.latent[passages].T
            for i in range(0, len(at), SEGMENT // STEP):
                some = at[i:i + SEGMENT // STEP]
                cosine = (sums[place[some[:, None] + np.arange(k)]].sum(1) @ latent) / np.minimum(
                    length[i:i + len(some), None], self.size[passages])
                for b, j in zip(*np.nonzero(cosine >= COSINE)):
                    first = int(some[b]) * STEP
                    yield int(passages[j]), start + first, start + min(len(ids), first + k * STEP), float(cosine[b, j])

    def verify(self, words: list[bytes], passage: int, first: int, end: int) -> tuple[int, float, float] | None:
        """(common words, their share, the answer's share) if the passage is there."""
        n = len(self.words[passage])
        margin = STEP + n // 4
        near = words[max(0, first - margin):end + margin]
        masks, answer_masks = self.masks[passage]
        # the words in common, whatever their order, are a bound
        if sum(masks[w].bit_count() for w in masks.keys() & set(near)) < PARAPHRASED * n:
            return None
        lcs = common_words(masks, n, near)
        share = lcs / n
        if n < FEW_WORDS and lcs < n or share < PARAPHRASED:
            return None
        a = self.answers[passage]
        answer = common_words(answer_masks, a, near) / a if a else 1.0
        return (lcs, share, answer) if share >= COPIED or answer >= ANSWERED else None

    def hits(self, text: str | None) -> list[tuple]:
        """(item, first word, end word, cosine, common words, share, answer share), the best per item."""
        words, best = tokens(text), {}
        for p, a, z, cosine in self.candidates(words) if words else ():
            found = self.verify(words, p, a, z)
            item = self.items[p]
            if found and (item not in best or (found[1], cosine) > (best[item][5], best[item][3])):
                best[item] = (item, a, z, cosine, *found)
        return list(best.values())


# --- distributed randomised SVD ----------------------------------------------------------
def _packed_sums(product):
    """Task of a pass over the rows: sums a matrix and emits it in chunks of its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at, x in zip(batch["at"], batch["x"]):
                part = product(np.frombuffer(at.as_py(), np.int32), np.frombuffer(x.as_py(), np.float64), total)
                total = part if total is None else total
        if total is not None:
            chunks = [(i // CHUNK, total[i:i + CHUNK].tobytes()) for i in range(0, len(total), CHUNK)
                      if total[i:i + CHUNK].any()]
            if chunks:
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in chunks], pa.int32()),
                                                  pa.array([c[1] for c in chunks], pa.binary())], ["chunk", "part"])
    return run


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p.as_py(), np.float64) for p in group["part"])
    return pa.table({"chunk": group["chunk"][:1], "part": pa.array([total.tobytes()], pa.binary())})


def _summed(rows: DataFrame, product, shape: tuple[int, int]) -> np.ndarray:
    parts = rows.mapInArrow(_packed_sums(product), "chunk int, part binary")
    out = np.zeros(shape)
    for r in parts.groupBy("chunk").applyInArrow(_add, "chunk int, part binary").collect():
        block = np.frombuffer(r["part"], np.float64).reshape(-1, shape[1])
        out[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(block)] = block
    return out


def randomised_svd(rows: DataFrame, columns: int, n_rows: int, rank: int, power: int = POWER,
                   seed: int = 42) -> np.ndarray:
    """Right singular vectors (columns x rank) of the sparse matrix with rows (at int32s, x float64s)."""
    wide = min(rank + OVERSAMPLE, n_rows, columns)
    basis = rows.sparkSession.sparkContext.broadcast(np.random.default_rng(seed).standard_normal((columns, wide)))
    for _ in range(power + 1):
        held = basis

        def forth_and_back(at, x, total, q=held):
            total = np.zeros((columns, wide)) if total is None else total
            total[at] += np.outer(x, x @ q.value[at])
            return total
        basis = rows.sparkSession.sparkContext.broadcast(
            np.linalg.qr(_summed(rows, forth_and_back, (columns, wide)))[0])
    held = basis

    def gram(at, x, total, q=held):
        y = x @ q.value[at]
        total = np.zeros((wide, wide)) if total is None else total
        total += np.outer(y, y)
        return total
    values, turn = np.linalg.eigh(_summed(rows, gram, (wide, wide)))
    order = np.argsort(values)[::-1][:rank]
    return held.value @ turn[:, order[values[order] > 1e-12 * max(values.max(initial=0), 1e-300)]]


Piece = tuple  # (item, words of its passages, answer words of each)


def _pieces(rows: list) -> list[Piece]:
    """Benchmark rows as passages of at most ``PASSAGE`` words; rows without a word are none."""
    out = []
    for key, body in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        all_words, a = tokens(body), answer_words(body)
        pieces = max(1, -(-len(all_words) // PASSAGE))
        cut = [len(all_words) * i // pieces for i in range(pieces + 1)]
        spans = [(i, j) for i, j in zip(cut, cut[1:]) if j > i]
        if spans:
            out.append((key, [all_words[i:j] for i, j in spans],
                        [min(a, j - i) if j == len(all_words) else 0 for i, j in spans]))
    return out


def _parts(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cut where more passages or terms would come together than one index may hold; an item stays whole."""
    todo = [pieces] if pieces else []
    while todo:
        own = todo.pop()
        fits = (sum(len(p[1]) for p in own) <= MAX_PASSAGES
                and len({w for _, passages, _ in own for p in passages for w in p}) <= MAX_TERMS)
        borders = [] if fits else [i for i in range(1, len(own)) if own[i][0] != own[i - 1][0]]
        half = min(borders, key=lambda i: abs(2 * i - len(own)), default=0)
        if half:
            todo += [own[half:], own[:half]]
        else:
            yield own


def build_indexes(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  rank: int = RANK) -> Iterator[Index]:
    """Indexes that together hold the whole benchmark, each within the bounds; mostly it is one."""
    some = benchmark.select(item, text).filter(F.length(F.trim(text)) > 0)
    blocks = max(1, -(-some.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64(item), F.lit(blocks))
    for b in range(blocks):
        for part in _parts(_pieces(some.filter(block == b).collect())):
            yield _index(docs, part, text, rank)


def build_index(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                rank: int = RANK) -> Index | None:
    """The index of a benchmark that fits one; ``None`` if it holds no word."""
    found = list(build_indexes(docs, benchmark, text, item, rank))
    if len(found) > 1:
        raise ValueError("the benchmark needs several indexes: build_indexes")
    return found[0] if found else None


def _index(docs: DataFrame, pieces: list[Piece], text: str, rank: int) -> Index:
    spark = docs.sparkSession
    items = [key for key, passages, _ in pieces for _ in passages]
    words = [p for _, passages, _ in pieces for p in passages]
    answers = [a for _, _, own in pieces for a in own]
    terms = {w: i for i, w in enumerate(sorted({w for p in words for w in p}))}
    known = spark.sparkContext.broadcast(terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, df = known.value, 0, np.zeros(len(known.value) + OTHER, np.int64)
        for batch in batches:
            for value in batch.column(0):
                n += 1
                np.add.at(df, term_ids(set(tokens(value.as_py())), ids), 1)
        if n:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()),
                                              pa.array(np.append(df[at], n))], ["term", "df"])

    counted = dict(docs.select(text).mapInArrow(frequencies, "term int, df long").groupBy("term").sum("df").collect())
    total = counted.pop(-1, 0)
    df = np.zeros(len(terms) + OTHER)
    df[list(counted)] = list(counted.values())
    idf = np.log((total + 2) / (np.minimum(df, total) + 1))

    vectors, size = [], []
    for p in words:
        at, tf = np.unique([terms[w] for w in p], return_counts=True)
        x = tf * idf[at]
        size.append(max(np.sqrt((x * x).sum()), 1e-12))
        vectors.append((at.astype(np.int32), x / size[-1]))
    size = np.array(size)
    matrix = saved(spark.createDataFrame([(at.tobytes(), x.tobytes()) for at, x in vectors], "at binary, x binary")
                   .repartition(max(1, min(64, len(vectors) // 50))))
    basis = randomised_svd(matrix, len(terms), len(vectors), min(rank, len(vectors)))
    latent = np.array([x @ basis[at] for at, x in vectors])
    length = np.sqrt((latent ** 2).sum(1))
    weak = {int(i): vectors[i] for i in np.flatnonzero(length < WEAK)}
    latent = np.where(length < WEAK, 0, 1 / np.maximum(length, WEAK) ** 2)[:, None] * latent
    length = length[length >= WEAK]
    basis = basis * idf[:len(terms), None]
    if len(terms) * len(words) <= BOUND_CELLS:
        adds = (basis[i:i + CHUNK] @ latent.T for i in range(0, len(terms), CHUNK))
        most = np.concatenate([np.stack([x.max(1), (x / size).max(1)], 1) for x in adds])
    else:
        far = np.linalg.norm(latent, axis=1)
        most = np.linalg.norm(basis, axis=1)[:, None] * [far.max(), (far / size).max()]
    return Index(items, words, answers, terms, idf.astype(np.float32), basis.astype(np.float32),
                 latent.astype(np.float32), float(min(1.0, length.min(initial=1.0))), np.maximum(most, 0), size, weak)


HITS = ("doc_id long, item_id long, first_word int, end_word int, cosine double, common_words int, "
        "common_share double, answer_share double")


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds."""
    found = [_hits(docs, index, key, text) for index in build_indexes(docs, benchmark, text)]
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], HITS)


def _hits(docs: DataFrame, index: Index, key: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))
                   for hit in shared.value.hits(t.as_py())]
            if out:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(),
                         pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 [x.split()[0] for x in HITS.split(", ")])
    return docs.select(key, text).mapInArrow(run, HITS)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, columns unchanged."""
    kept = docs
    for index in build_indexes(docs, benchmark, text):
        kept = _without(kept, index, text)
    return kept


def _without(docs: DataFrame, index: Index, text: str) -> DataFrame:
    shared, at = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.hits(t.as_py()) for t in batch.column(at)], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
