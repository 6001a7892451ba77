"""Operator 10: quality rules on repetition inside a document, from its suffix array.

The words of a text are numbered and their suffixes sorted by prefix doubling; the
ranks of each doubling also give the longest common prefix of neighbouring suffixes.
Every run of neighbours with a common prefix of at least L words (an LCP interval) is a
substring that repeats, maximal to the right at the interval's smallest prefix; a
suffix's longest repeat is the larger of its two neighbouring prefixes. The union of
the spans of all repeats is the covered part. A document is dropped if repeats of
``MIN_WORDS`` or more cover more than ``MAX_COVERED`` of its words, or if the longest
repeat has more than ``MAX_LONGEST`` words. Both limits lie far below the base rule's
half of the words, so they decide documents that it passes: a passage pasted again, or
many short blocks that come back.

Base counts: code points in words, characters of ``SYMBOLS``, lines with a word that
equal an earlier line, words in three-word windows found twice or more (which is the
cover by repeats of three or more). A document of fewer than 50 words or with more than
half its words in such windows fails anyway.

A document is one row of a map; nothing is shuffled. Memory is a few arrays of the
longest document's words for each doubling it needs.

Defined results: NULL text counts as empty: no words, base_failed; repeated and NULL
ids are judged like any row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MIN_WORDS = 8
MAX_COVERED = 0.15
MAX_LONGEST = 100


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before it; 0 for the first)."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    levels, k, order = [rank], 1, np.argsort(rank, kind="stable")
    while k < n and rank.max(initial=0) < n:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:]
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]))
        levels.append(rank)
        k *= 2
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        # equal ranks are equal windows of 2**level words; past the end nothing is equal
        r = np.append(levels[level], -1)
        same = (r[np.minimum(a, n)] == r[np.minimum(b, n)]) & (a < n) & (b < n)
        step = same * (1 << level)
        lcp[1:] += step
        a += step
        b += step
    return order, lcp


def repeat_lengths(words: list[bytes]) -> np.ndarray:
    """For every position, the length of the longest substring from there that occurs elsewhere too."""
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words))
    longest = np.zeros(len(ids), np.int64)
    if len(ids) > len(number):
        order, lcp = suffix_array(ids)
        longest[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of ``least`` words or more."""
    at = np.flatnonzero(longest >= least)
    edges = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + longest[at], -1)
    return np.cumsum(edges[:-1]) > 0


def spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def measure(text: str | None) -> dict:
    text = text or ""
    words = text.encode().split()
    longest = repeat_lengths(words)
    n, seen, again = len(words), set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            again += line in seen
            seen.add(line)
    repeat_words = int(covered(longest, WINDOW).sum())
    mask = covered(longest, MIN_WORDS)
    top = int(longest.max(initial=0))
    failed = n < LEAST_WORDS or 100 * repeat_words > 50 * n
    fine = mask.sum() <= MAX_COVERED * n and top <= MAX_LONGEST
    return {
        "n_words": n, "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": again, "n_repeat_words": repeat_words,
        "base_failed": failed, "kept": bool(not failed and fine), "covered_words": int(mask.sum()),
        "longest_repeat": top, "repeats": [{"first": a, "end": b} for a, b in spans(mask)],
    }


FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
          ("covered_words", pa.int64()), ("longest_repeat", pa.int64()),
          ("repeats", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))]


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts, verdict, covered words and the spans (word numbers) of its repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r[name] for r in rows], kind) for name, kind in FIELDS],
                [key] + [name for name, _ in FIELDS])
    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    schema = ", ".join(f"{name} {kinds.get(kind, 'array<struct<first: long, end: long>>')}" for name, kind in FIELDS)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, {schema}")


def _covered_sql(name: str, size: int) -> str:
    """Words of a document that lie in a window of so many words found twice or more."""
    return f"""
{name}_windows AS (SELECT k, i, hash(list_slice(words, i, i + {size - 1})) AS h
                   FROM (SELECT k, words, unnest(range(1, n_words - {size} + 2)) AS i FROM d)),
{name} AS (SELECT k, count(DISTINCT i + j) AS n
           FROM (SELECT k, i FROM {name}_windows QUALIFY count(*) OVER (PARTITION BY k, h) > 1), range({size}) r(j)
           GROUP BY k)"""


def oracle() -> str:
    """DuckDB SQL of the contract's columns: repeats as equal windows, the longest one by windows of the limit's size."""
    return f"""
WITH d AS (
  SELECT *, len(words) AS n_words, {MAX_LONGEST} + 1 AS too_long
  FROM (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents)),
{_covered_sql('few', WINDOW)},{_covered_sql('many', MIN_WORDS)},
long_windows AS (SELECT k, hash(list_slice(words, i, i + too_long - 1)) AS h
                 FROM (SELECT k, words, too_long, unnest(range(1, n_words - too_long + 2)) AS i FROM d)),
long AS (SELECT DISTINCT k FROM long_windows QUALIFY count(*) OVER (PARTITION BY k, h) > 1),
lines AS (SELECT k, count(line) - count(DISTINCT line) AS n
          FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
r AS (
  SELECT doc_id, n_words::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT
             AS word_chars,
         len(regexp_extract_all(text, '[{SYMBOLS}]'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(few.n, 0)::BIGINT AS n_repeat_words,
         coalesce(many.n, 0)::BIGINT AS covered_words, long.k IS NOT NULL AS has_long
  FROM d LEFT JOIN few USING (k) LEFT JOIN many USING (k) LEFT JOIN lines USING (k) LEFT JOIN long USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words)
           AND covered_words <= {MAX_COVERED} * n_words AND NOT has_long AS kept
FROM r"""
