"""Operator 6: main text of web pages by nearest-URL page differencing.

A page is read into lines, one per block element, without the parts that are never
text (scripts, styles, forms, navigation, headers, footers, sidebars, elements whose
class, id or role names adverts, menus, notices, comments and the like; a page, its
``main`` and what holds that are never left out by such a name, an ``article``, what
holds one and what it holds only by the whole name: teaser or related-posts, not
has-teaser or related-work; a form that holds an article or main is no form here). Pages of a
host are ordered by URL path; a page is compared with its nearest neighbours before and
after: their lines are aligned by longest common subsequence, and shared lines, the
site's template, are deleted. A neighbour with the same lines is a copy and deletes
nothing; a run of copies, however long, is one page here. One that shares ``MIRROR`` of the
lines may be a copy with small changes or another page of few own lines, so up to
``REACH`` runs on each side are searched for a witness that differs more; only if there
is none, the alike pages are the witnesses. Lines in an element of ``PROTECTED`` (article,
main) need more evidence than two neighbours: they are deleted if they are shorter
than ``LONG`` and all of the ``2 * REACH`` runs around hold them.

On the cluster: the sort keys (reversed host, path, page_id) alone are range
partitioned first, which gives the first and last keys of every partition. Then each
page's lines go straight to the partition of their key, the rows at its ends also to
the partitions beside it as neighbours, so the text is shuffled once and a host with a
third of all pages is spread like any other. Partitions are streamed in key order with
``REACH`` pages on each side in memory.

Defined results: NULL html has no text; NULL url belongs to the empty host; rows with
equal keys are neighbours in any order; pages without lines give the empty text; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import saved, sort_key

PROTECTED = ("article", "main")
MIRROR = 0.8
REACH = 4
LONG = 100               # characters
ROWS_PER_PARTITION = 50_000

# fixed values: element names by their part in a page
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre section summary table tbody td tfoot th thead title tr ul""".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("""script style textarea title noscript iframe xmp noembed noframes template svg math canvas object
nav footer aside form button select menu dialog head""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PARTS = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie
cookies disqus footer menu nav navbar navigation newsletter notice notices pagination popup promo promotion related
share sharing sidebar social sponsor sponsored subscribe teaser toolbar widget""".split())
SHAPES = frozenset("""area bar block body box button buttons container content feed footer form header icons inner item
items link links list menu post posts section slot title widget wrap wrapper""".split())
PAGES = ("html", "body", "main")     # never left out for their names
PAGE_PARTS = frozenset("header masthead topbar".split())   # dropped outside of protected elements

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)
    ((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""", re.S | re.X)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=$|[\s=/])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
HOLDER = re.compile(f"<(?:{'|'.join(PROTECTED)})\\b", re.I)
CLOSING = re.compile(r"</([a-zA-Z][a-zA-Z0-9:-]*)")


def whole(name: str) -> bool:
    """Whether a class, id or role is the name of a part, alone or with words that only say how it is built."""
    first, *rest = re.split("[_-]+", name)
    return first in PARTS and all(w in SHAPES for w in rest)


def unwanted(name: str, attributes: str, inside: bool, holds=lambda: frozenset()) -> bool:
    """Whether the element is left out; ``holds`` tells which of the protected elements it has inside."""
    if name == "form" and holds():    # the page, or its article, is wrapped in one
        return False
    if name in DROPPED or name == "header" and not inside:
        return True
    if name in ("html", "body") or not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    if HIDDEN.search(attributes):
        return True
    if name in PAGES:
        return False
    names = [(m[1] or m[2] or m[3] or "").lower() for m in NAMED.finditer(attributes)]
    if inside:      # in an article a word of a name is not enough: related-posts, not related-work
        return any(whole(w) for x in names for w in x.split())
    parts = PARTS | PAGE_PARTS
    if not parts & {w for x in names for w in re.split(r"[\s_-]+", x)}:
        return False
    inner = {name} & {*PROTECTED} or holds()
    return "main" not in inner and (not inner or bool(parts & {w for x in names for w in x.split()}))


def protected_inside(source: str) -> dict[int, set[str]]:
    """For the end of every opening tag that has protected elements inside: which of them."""
    out: dict[int, set[str]] = {}
    stack: list[tuple[str, int]] = []
    counts: dict[str, int] = {}
    at = 0
    while tag := TAG.search(source, at):
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        attributes = tag[3] or tag[6] or ""
        if not name or name in VOID or attributes.endswith("/"):
            continue
        if tag[1] or tag[4]:
            # closes its own opening tag and the unclosed ones after that
            while counts.get(name):
                last, start = stack.pop()
                counts[last] -= 1
                held = out.get(start, set()) | ({last} & {*PROTECTED})
                if stack and held:
                    out.setdefault(stack[-1][1], set()).update(held)
                if last == name:
                    break
        elif name in RAW:
            close = re.compile("</" + name, re.I).search(source, at)
            at = close.start() if close else len(source)
        else:
            stack.append((name, at))
            counts[name] = counts.get(name, 0) + 1
    while stack:
        last, start = stack.pop()
        held = out.get(start, set()) | ({last} & {*PROTECTED})
        if stack and held:
            out.setdefault(stack[-1][1], set()).update(held)
    return out


def page_lines(source: str | None) -> list[tuple[str, bool]]:
    """(text, whether in a protected element) of the page's blocks in order."""
    source = source or ""
    last_close = {m[1].lower(): m.start() for m in CLOSING.finditer(source)}
    lines: list[tuple[str, bool]] = []
    piece: list[str] = []
    inside = 0               # open protected elements
    skip, depth = None, 0    # element that is being left out
    until_block = False      # an unclosed one: left out up to the next block
    at = 0
    held: dict[int, set[str]] | None = None

    def holds():
        nonlocal held
        if held is None:
            held = protected_inside(source) if HOLDER.search(source) else {}
        return held.get(at, set())

    def end_block():
        text = " ".join(entities.unescape("".join(piece)).split())
        if text:
            lines.append((text, inside > 0))
        piece.clear()

    while at < len(source):
        tag = TAG.search(source, at)
        if not skip and not until_block:
            piece.append(source[at:tag.start() if tag else len(source)])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        closing, attributes = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        if not name:
            continue
        if skip:
            if name == skip and not attributes.endswith("/"):
                depth += -1 if closing else 1
                if not depth:
                    skip = None
            continue
        if name in BLOCKS:
            end_block()
            until_block = False
        if closing and name in PROTECTED:
            inside = max(0, inside - 1)
        if closing or name in VOID:
            if name == "br":
                piece.append(" ")
            continue
        if name in RAW:
            close = re.compile("</" + name, re.I).search(source, at)
            at = close.start() if close else len(source)
        elif unwanted(name, attributes, inside > 0, holds) and not attributes.endswith("/"):
            if name != "head" and last_close.get(name, -1) >= at and name != "p":
                skip, depth = name, 1
            elif name != "head":
                until_block = True
        elif name in PROTECTED:
            inside += 1
    end_block()
    return lines


# --- alignment ---------------------------------------------------------------------------
def _masks(b: list) -> dict:
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | 1 << j
    return masks


def _middle(x: list, y: list) -> list[tuple[int, int]]:
    """The common subsequence that is found from the end, by bit rows of which every few are kept.

    Rows between two kept ones are computed again on the way back, so the memory is some
    2 sqrt(len(x)) rows of len(y) bits, and the pairs are the same whatever the lengths.
    """
    masks, full = _masks(y), (1 << len(y)) - 1

    def after(row: int, v) -> int:
        hit = row & masks.get(v, 0)
        return ((row + hit) | (row - hit)) & full
    step = isqrt(len(x)) + 1
    kept, row = [], full
    for i, v in enumerate(x):
        if i % step == 0:
            kept.append(row)
        row = after(row, v)
    found, i, j, rows, base = [], len(x), len(y), [], len(x) + 1
    while i and j:
        if i - 1 < base:
            base = (i - 1) // step * step
            rows = [kept[base // step]]
            for v in x[base:i]:
                rows.append(after(rows[-1], v))
        if rows[i - base] >> j - 1 & 1:
            j -= 1
        elif not rows[i - 1 - base] >> j - 1 & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return found[::-1]


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    cut = 0
    while cut < min(len(a), len(b)) - low and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    n, m = len(a) - low - cut, len(b) - low - cut
    pairs = [(i, i) for i in range(low)]
    x, y = a[low:low + n], b[low:low + m]
    if n and m:
        pairs += [(low + i, low + j) for i, j in _middle(x, y)]
    return pairs + [(len(a) - k, len(b) - k) for k in range(cut, 0, -1)]


def alike(lines: list[str], other: list[str]) -> bool:
    """Whether the pages are copies or have little besides a common template."""
    return len(aligned(lines, other)) >= MIRROR * max(len(lines), len(other))


def witness(page: list[tuple[str, bool]], others: Iterable[list[tuple[str, bool]]]) -> list[tuple[str, bool]] | None:
    """The nearest page that differs, or if all are alike the nearest that is no copy."""
    lines, second = [t for t, _ in page], None
    for other in others:
        theirs = [t for t, _ in other]
        if theirs == lines:
            continue
        if not alike(lines, theirs):
            return other
        second = second or other
    return second


def main_text(page: list[tuple[str, bool]], neighbours: list[list[tuple[str, bool]]],
              around: Iterable[list[tuple[str, bool]]] = ()) -> str:
    """The page's lines without the template: what it shares with its witnesses.

    A short protected line goes only if ``2 * REACH`` pages ``around`` differ from this one and all hold it.
    """
    lines = [t for t, _ in page]
    others = [n for n in ([t for t, _ in n] for n in neighbours) if n != lines]
    others = [n for n in others if not alike(lines, n)] or others
    template = {i for n in others for i, _ in aligned(lines, n)}
    held = [{t for t, _ in n} for n in around]
    held = held if len(held) >= 2 * REACH else []

    def stays(i: int, text: str, own: bool) -> bool:
        if not own:
            return i not in template
        return len(text) >= LONG or not held or i not in template or not all(text in h for h in held)
    return "\n".join(t for i, (t, own) in enumerate(page) if stays(i, t, own))


# --- on the cluster ----------------------------------------------------------------------
LINES = pa.list_(pa.struct([("text", pa.string()), ("own", pa.bool_())]))


def page_key(url: str | None, page_id: int | None) -> str:
    return f"{sort_key(url)} {'' if page_id is None else f'{page_id + 2**63:020d}':>20}"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [page_key(u, i) for i, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last ``REACH`` keys of a partition."""
    low: list[str] = []
    high: list[str] = []
    for batch in batches:
        keys = set(batch.column(0).to_pylist())
        low, high = sorted(keys.union(low))[:REACH], sorted(keys.union(high))[-REACH:]
    if low:
        yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([high])], ["low", "high"])


def host_of(key: str) -> str:
    return key.split(")", 1)[0]


def beside(ends: list[tuple[list[str], list[str]]]) -> dict[str, list[int]]:
    """For keys near the end of their partition: the other partitions that need their pages as neighbours."""
    out: dict[str, list[int]] = {}
    for step, side in ((1, 0), (-1, 1)):
        for p in range(len(ends)):
            host, left, q = host_of(ends[p][1 - side][-1 if step > 0 else 0]), REACH, p + step
            while left and 0 <= q < len(ends):
                keys = ends[q][side][:left] if step > 0 else ends[q][side][-left:]
                mine = [k for k in keys if host_of(k) == host]
                for k in mine:
                    out.setdefault(k, []).append(p)
                left = left - len(keys) if len(mine) == len(keys) else 0
                q += step
    return out


def _read_pages(ends):
    """Lines of every page for its partition, and for those beside it if it is near the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, others = ends.value
        for batch in batches:
            out = []
            for i, url, source in zip(*(c.to_pylist() for c in batch.columns)):
                key = page_key(url, i)
                part = max(0, bisect_right(firsts, key) - 1)
                lines = [{"text": t, "own": own} for t, own in page_lines(source)]
                out.append((part, key, i, url, lines, True))
                out += [(p, key, i, url, lines, False) for p in others.get(key, ())]
            types = (pa.int32(), pa.string(), pa.int64(), pa.string(), LINES, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types],
                ["part", "key", "page_id", "url", "lines", "own"])
    return run


@dataclass
class Run:
    """Neighbouring pages of equal lines: they share a text, and are one neighbour to others."""
    place: tuple
    lines: list[tuple[str, bool]]
    pages: list[tuple[int | None, str | None]]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    run = None
    for batch in batches:
        for r in batch.to_pylist():
            place, lines = (r["part"], host_of(r["key"])), [(x["text"], x["own"]) for x in r["lines"]]
            if run is None or run.place != place or run.lines != lines:
                if run:
                    yield run
                run = Run(place, lines, [])
            if r["own"]:
                run.pages.append((r["page_id"], r["url"]))
    if run:
        yield run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before: deque = deque(maxlen=REACH)
    ahead: deque = deque()
    out = []
    for item in chain(_runs(batches), [None] * REACH):
        ahead.append(item)
        if len(ahead) <= REACH:
            continue
        here = ahead.popleft()
        if here and here.pages:
            left, right = ([n.lines for n in side if n and n.place == here.place] for side in (reversed(before), ahead))
            near = [n for n in (witness(here.lines, left), witness(here.lines, right)) if n is not None]
            text = main_text(here.lines, near, left + right)
            for page_id, url in here.pages:
                out.append((page_id, url, text, len(text)))
                if len(out) >= 500:
                    yield _texts(out)
                    out = []
        before.append(here)
    if out:
        yield _texts(out)


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int64()))],
        ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page (page_id, url, html)."""
    spark = pages.sparkSession
    keys = saved(pages.select("page_id", "url").mapInArrow(_keys, "key string"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys.count() // ROWS_PER_PARTITION)
    ends = sorted((r.low, r.high) for r in keys.repartitionByRange(parts, "key")
                  .mapInArrow(_ends, "low array<string>, high array<string>").collect())
    shared = spark.sparkContext.broadcast(([low[0] for low, _ in ends], beside(ends)))
    lines = "array<struct<text: string, own: boolean>>"
    read = pages.select("page_id", "url", "html").mapInArrow(
        _read_pages(shared), f"part int, key string, page_id long, url string, lines {lines}, own boolean")
    return (read.repartitionById(max(1, len(ends)), "part").sortWithinPartitions("part", "key")
            .mapInArrow(_difference, "page_id long, url string, text string, n_chars long"))
