"""Operator 12: spelling variants by k-d trees over letter-count vectors.

Words are runs of letters with their counts over the corpus. One edit changes the
vector of letter counts by an L1 distance of at most two: exactly two for a replaced
letter, one for an inserted or deleted one. So for every pair of lengths (n, n) and
(n, n + 1) the candidates are found by range searches in a k-d tree over the count
vectors of the length, whose boxes are pruned by their L1 distance to the query, and
then verified on the order of the letters.

On the cluster: documents are counted task by task (one entry per word, not per
occurrence) and summed by word. A coarse tree per length, fitted on at most ``SAMPLE``
words, cuts the words of a length into shards of about ``SHARD_WORDS``. A word goes to its
home shard, to the later shards of its length within distance two, and to the shards of
the next length within distance one; each pair of words thus meets in exactly one
shard, which builds the exact k-d tree of its home words and answers its visitors with
it. A shard returns one row per word that has near words there (their number and the
best of them), never pairs. Common letters of two words are counted by a product of
unary-coded count vectors. Forms are followed to the last by pointer doubling: counts at
least double along the chain, so a few joins do.

Defined results: NULL and empty texts hold no words; a NULL doc_id counts as the empty
text in the checksum; repeated rows count again; of equally frequent near words the
smallest in code-point order is the form; an empty table gives no rows; other columns
are ignored. Words of any length are searched, texts of any length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MODULUS = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
FORM_FACTOR = 2
FLUSH = 400_000          # words a task counts before it hands them on
SAMPLE = 65_536          # words the coarse trees are fitted on
SHARD_WORDS = 32_768     # words of a shard, about
LEAF = 128               # words of a leaf of the exact tree
BLOCK = 2_048            # queries compared with a leaf at a time


# --- words ------------------------------------------------------------------------------
def words_of(doc_id, text: str | None) -> Counter:
    """Counts of the words of one document, after the contract's deletions."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs: Counter = Counter()
    for run, n in Counter(RUN.findall(text or "")).items():
        runs[run.translate(LOWER)] += n
    words: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % MODULUS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        words[run] += n
    return words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def rows() -> pa.RecordBatch:
        kept = [(w, n) for w, n in total.items() if len(w) >= LEAST_LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                           pa.array([n for _, n in kept], pa.int64())], ["word", "n"])
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            total.update(words_of(doc_id.as_py(), text.as_py()))
            if len(total) >= FLUSH:
                yield rows()
                total.clear()
    yield rows()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of the least length and count."""
    return (docs.select(key, text).mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))


# --- vectors and trees --------------------------------------------------------------------
def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each (all are below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Letter counts of each word over the letters of ``alphabet``."""
    place = np.full(256, len(alphabet))
    place[alphabet] = np.arange(len(alphabet))
    n, wide = len(codes), len(alphabet) + 1
    flat = place[codes] + np.arange(n)[:, None] * wide
    return np.bincount(flat.ravel(), minlength=n * wide).reshape(n, wide)[:, :-1].astype(np.int32)


def split_at(points: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that divide the points best: (letter, limit), at most ``limit`` goes left."""
    best = None
    for d in np.argsort(-points.var(axis=0), kind="stable")[:8].tolist():
        value = points[:, d]
        for limit in {int(np.median(value)), int(np.median(value)) - 1}:
            share = abs((value <= limit).mean() - 0.5)
            if share < 0.5 and (best is None or share < best[0]):
                best = (share, d, limit)
    return None if best is None else (best[1], best[2])


def coarse_tree(points: np.ndarray, leaf: float) -> list[tuple[int, int, int, int]]:
    """Nodes (letter code, limit, left, right) over rows of 256 counts; a child below 0 is leaf -1 - child."""
    nodes: list = []
    leaves = 0
    todo = [(points, -1, 2)]
    while todo:
        own, parent, side = todo.pop()
        cut = split_at(own) if len(own) > leaf else None
        number = len(nodes) if cut else -1 - leaves
        if cut:
            nodes.append([cut[0], cut[1], 0, 0])
            right = own[:, cut[0]] > cut[1]
            todo += [(own[right], number, 3), (own[~right], number, 2)]
        else:
            leaves += 1
        if parent >= 0:
            nodes[parent][side] = number
    return [tuple(x) for x in nodes]


def reached(tree: list[tuple], points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``points`` whose L1 ball may reach it); leaves in order."""
    # what a letter's count still has to change is kept per letter: only its largest gap counts
    todo = [(0 if tree else -1, np.arange(len(points)), {})]
    while todo:
        at, rows, gaps = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            yield -1 - at, rows
            continue
        letter, limit, left, right = tree[at]
        value = points[rows, letter].astype(np.int64)
        for child, gap in ((right, np.maximum(limit + 1 - value, 0)), (left, np.maximum(value - limit, 0))):
            gap = np.maximum(gap, gaps[letter]) if letter in gaps else gap
            total = gap + sum(g for k, g in gaps.items() if k != letter)
            keep = total <= radius
            todo.append((child, rows[keep], {k: (gap if k == letter else g)[keep] for k, g in {**gaps, letter: gap}.items()}))


class Tree:
    """Exact k-d tree with tight boxes over the count vectors of words of one length."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.nodes: list = []      # (lowest, highest counts, rows or None, left, right)
        todo = [(np.arange(len(points)), -1, 3)]
        while todo:
            rows, parent, side = todo.pop()
            own = points[rows]
            cut = split_at(own) if len(rows) > leaf else None
            number = len(self.nodes)
            self.nodes.append([own.min(axis=0), own.max(axis=0), None if cut else rows, -1, -1])
            if parent >= 0:
                self.nodes[parent][side] = number
            if cut:
                right = own[:, cut[0]] > cut[1]
                todo += [(rows[right], number, 4), (rows[~right], number, 3)]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``queries``, rows of a leaf) whose boxes are within the radius."""
        todo = [(0, np.arange(len(queries)))] if len(self.points) else []
        while todo:
            at, rows = todo.pop()
            low, high, leaf, left, right = self.nodes[at]
            own = queries[rows]
            rows = rows[(np.maximum(low - own, 0) + np.maximum(own - high, 0)).sum(axis=1) <= radius]
            if not len(rows):
                continue
            if leaf is None:
                todo += [(right, rows), (left, rows)]
            else:
                for i in range(0, len(rows), BLOCK):
                    yield rows[i:i + BLOCK], leaf


def unary(points: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Each count as ones: the product of two rows is the number of letters that the words share."""
    return np.concatenate([points[:, d:d + 1] > np.arange(m) for d, m in enumerate(most)], axis=1).astype(np.float32)


def near_pairs(home: np.ndarray, visit: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(rows of home, rows of visit) one edit apart; home words have the same length or one letter more.

    With ``visit`` as ``home`` itself every pair is found in both orders.
    """
    none = np.empty(0, np.int64)
    if not len(home) or not len(visit):
        return none, none
    alphabet = np.unique(np.concatenate([np.unique(home), np.unique(visit)]))
    a, b = vectors(home, alphabet), vectors(visit, alphabet)
    most = np.maximum(a.max(axis=0), b.max(axis=0))
    ones_a, ones_b = unary(a, most), unary(b, most)
    replaced = home.shape[1] == visit.shape[1]
    shared = home.shape[1] - 1
    found = [(none, none)]
    for q, rows in Tree(a, leaf).search(b, 2 if replaced else 1):
        x, y = np.nonzero(ones_b[q] @ ones_a[rows].T == shared)   # L1 distance two, or one
        x, y = q[x], rows[y]
        fits = replaced_letter(home[y], visit[x]) if replaced else inserted_letter(home[y], visit[x])
        found.append((y[fits], x[fits]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def replaced_letter(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def inserted_letter(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Whether each row of ``long`` is that of ``short`` with one letter put in: equal heads and tails meet."""
    wide = short.shape[1]
    head = np.logical_and.accumulate(long[:, :wide] == short, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((long[:, 1:] == short)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= wide


# --- shards -------------------------------------------------------------------------------
def _route_task(trees: dict[int, list[tuple]]):
    """A word's home shard, and the shards where it meets the words that it may be near to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.arange(256)
        for batch in batches:
            words = np.array(batch["word"].to_pylist(), object)
            n = batch["n"].to_numpy()
            sizes = np.array([len(w) for w in words], np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                points = vectors(letters(words[rows].tolist()), full)
                own = np.zeros(len(rows), np.int64)
                for shard, at in reached(trees.get(size, []), points, 0):
                    own[at] = shard
                    yield _routed(words, n, rows[at], size, shard, 0)
                for shard, at in reached(trees.get(size, []), points, 2):
                    at = at[own[at] < shard]
                    yield _routed(words, n, rows[at], size, shard, 1)
                if size + 1 in trees:
                    for shard, at in reached(trees[size + 1], points, 1):
                        yield _routed(words, n, rows[at], size + 1, shard, 2)
    return run


def _routed(words, n, rows, size: int, shard: int, role: int) -> pa.RecordBatch:
    many = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(many, size, np.int32)), pa.array(np.full(many, shard, np.int32)),
         pa.array(np.full(many, role, np.int8)), pa.array(words[rows].tolist(), pa.string()), pa.array(n[rows])],
        ["size", "shard", "role", "word", "n"])


def _best(words: np.ndarray, n: np.ndarray, of: np.ndarray, near: np.ndarray) -> pa.Table:
    """(word, near words, the best of them and its count) from pairs of word numbers."""
    place = np.empty(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[near], -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
    many = np.diff(np.append(first, len(of)))
    return pa.table({"word": pa.array(words[of[first]].tolist(), pa.string()), "n_near": pa.array(many, pa.int64()),
                     "best": pa.array(words[near[first]].tolist(), pa.string()), "best_n": pa.array(n[near[first]], pa.int64())})


def _search_task(leaf: int):
    def run(group: pa.Table) -> pa.Table:
        role = group["role"].to_numpy()
        words = np.array(group["word"].to_pylist(), object)
        n = group["n"].to_numpy().astype(np.int64)
        at = [np.flatnonzero(role == r) for r in range(3)]
        codes = [letters(words[a].tolist()) if len(a) else np.empty((0, 0), np.uint8) for a in at]
        of, near = [], []
        for r in range(3):
            x, y = near_pairs(codes[0], codes[r], leaf)
            of.append(at[0][x])
            near.append(at[r][y])
            if r:   # a pair with a visitor is found once, it counts for both
                of.append(at[r][y])
                near.append(at[0][x])
        return _best(words, n, np.concatenate(of), np.concatenate(near))
    return run


def fit_trees(words: DataFrame, shard_words: int, sample: int) -> dict[int, list[tuple]]:
    """The coarse tree of every length, from at most ``sample`` words in all (those of smallest hash)."""
    total = words.count()
    order = F.xxhash64("word")
    few = words.select("word").filter(F.shiftrightunsigned(order, 11) < min(1.0, 2 * sample / max(total, 1)) * 2.0 ** 53)
    by_size: dict[int, list[str]] = {}
    for r in few.orderBy(order, "word").limit(sample).collect():
        by_size.setdefault(len(r.word), []).append(r.word)
    share = sum(map(len, by_size.values())) / max(total, 1)
    trees = {size: coarse_tree(vectors(letters(own), np.arange(256)), max(4, shard_words * share))
             for size, own in by_size.items()}
    # lengths too rare for the sample have one shard
    sizes = [r[0] for r in words.select(F.length("word").alias("size")).distinct().collect()]
    return {size: trees.get(size, []) for size in sizes}


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(word, n_near, best, best_n) for the words (word, n) that have near words."""
    importable(words.sparkSession)
    trees = fit_trees(words, shard_words, sample)
    routed = words.select("word", "n").mapInArrow(
        _route_task(trees), "size int, shard int, role byte, word string, n long")
    met = (routed.groupBy("size", "shard")
           .applyInArrow(_search_task(leaf), "word string, n_near long, best string, best_n long"))
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words (word, form) that have a form: pointers are doubled until none moves."""
    step = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(step.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")))
        step = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return step


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS,
             sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Every word with its near words, its form and the root of its group."""
    importable(docs.sparkSession)
    words = saved(word_counts(docs, key, text))
    near = words.join(near_words(words, shard_words, sample, leaf), "word", "left")
    formed = F.col("best_n") >= FORM_FACTOR * F.col("n")
    near = saved(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                             F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")))
    last = roots(near.filter(F.col("form").isNotNull()))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL of the query: CRC-32 by its shift register, near words by equal wildcards and deletions
ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS full_text
            FROM runs GROUP BY doc_id, run),
bytes AS (SELECT run, n, hex(encode(full_text)) AS x FROM counted),
summed AS (
  SELECT run, n, xor(list_reduce(
           [4294967295] || [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) for i in range(len(x) // 2)],
           lambda crc, b: list_reduce([xor(crc, b)] || range(8),
             lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) AS h FROM bytes),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {MODULUS} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                        || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER)) AS head, substr(word, CAST(i AS INTEGER) + 2) AS tail
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    AND a.i = b.i
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.head || a.tail = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN best.top >= {FORM_FACTOR} * w.n THEN best.top END AS form_n,
         (SELECT min(other) FROM pairs p WHERE p.word = w.word AND p.other_n = best.top
                                           AND best.top >= {FORM_FACTOR} * w.n) AS form
  FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM formed
          UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed g ON g.word = c.at AND g.form IS NULL"""
