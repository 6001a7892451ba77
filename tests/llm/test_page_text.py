"""Operator 6: reading pages, alignment and neighbours against brute force."""

import random


from rows import SMALL
from subledger.llm import page_text
from subledger.llm.queries import op6_page_text

SCHEMA = "page_id long, url string, html string"


def test_reading():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
    <body><header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> -->
    <div class="top ad">Buy</div><p>Teaser &amp; more</p><article><header><h1>Head  &eacute;&#233;&lt;b&gt;</h1></header>
    <p><b>Bold<br>next<p>One <i>two</i>th ree<p class="ad">Advert<p>Last &am<form><p>f</p></form>
    <div id='comments'><div>c</div>d</div><aside>a<aside>b</aside>c</aside><p hidden>h</p><td a=">">cell</td>
    </article><footer>&copy; x</footer><p>After"""
    assert page_text.page_lines(source) == [
        ("Teaser & more", False), ("Head éé<b>", True), ("Bold next", True), ("One twoth ree", True),
        ("Last &am", True), ("cell", True), ("After", False)]
    assert page_text.page_lines(None) == [] == page_text.page_lines("") == page_text.page_lines("<p> </p>")
    assert page_text.page_lines("a < b <") == [("a < b <", False)]
    # unclosed parts swallow no more than their block
    assert page_text.page_lines("<nav>menu<p>text<script>x") == [("text", False)]


def test_names_of_the_page_and_its_main_part():
    for source in ('<html class="cookie-notice"><body class="has-sidebar"><p>text<main id="main-with-sidebar"><p>more</main>',
                   '<body><p>text<article class="post has-comments"><p>more</article>',
                   '<div id="page" class="has-sidebar menu-open"><p>text</p><div><article><p>more</article></div></div>',
                   '<div class="widget"><p>text</p><main><p>more</p></main></div>'):
        assert page_text.page_lines(source) == [("text", False), ("more", True)], source
    # a left-out article protects nothing after it
    assert page_text.page_lines('<p>a</p><article class="teaser"><p>card</article><p>b<article><p>c</article><p>d') == [
        ("a", False), ("b", False), ("c", True), ("d", False)]
    assert page_text.page_lines('<div class="comments"><article><p>c</article></div><div class="top-ad">x</div>y') == [
        ("y", False)]
    for piece in ("<article><div class='top-ad'>", "<div class='top-ad'></article>", "<main></div><p class='x-ad'>"):
        page_text.page_lines(piece * 30_000)


def test_long_pages_are_linear():
    for piece in ("<p>", "<", "<a \"", "<!--", "<nav>", "<p>x", "</p>", "<script>", "&amp;", "<div class='ad'>"):
        page_text.page_lines(piece * 30_000)


def brute_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def table_pairs(a, b):
    """The same choice by a full table: from the end, a step back in b if that loses nothing, else in a, else a pair."""
    size = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(size[-1][j] + 1 if x == y else max(size[-1][j + 1], row[-1]))
        size.append(row)
    i, j, out = len(a), len(b), []
    while i and j:
        if size[i][j] == size[i][j - 1]:
            j -= 1
        elif size[i][j] == size[i - 1][j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def test_alignment():
    r = random.Random(3)
    for _ in range(600):
        a = [r.choice("abcdxyz"[:r.randint(1, 7)]) for _ in range(r.randint(0, 40))]
        b = [r.choice("abcdxyz"[:r.randint(1, 7)]) for _ in range(r.randint(0, 40))]
        pairs = page_text.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == brute_length(a, b)
        assert all(p < q and s < t for (p, s), (q, t) in zip(pairs, pairs[1:]))
        if a and b:   # rows computed again are the rows of the whole table
            assert page_text._middle(a, b) == table_pairs(a, b)


def plain(rows):
    """Every page with its neighbours in one sorted list."""
    order = sorted(rows, key=lambda r: page_text.page_key(r[1], r[0]))
    host = lambda r: page_text.page_key(r[1], r[0]).split(")")[0]
    out = []
    for k, r in enumerate(order):
        near = [order[j] for j in (k - 1, k + 1) if 0 <= j < len(order) and host(order[j]) == host(r)]
        text = page_text.main_text(page_text.page_lines(r[2]), [page_text.page_lines(n[2]) for n in near])
        out.append((r[0], r[1], text, len(text)))
    return sorted(out, key=str)


def site(n):
    """Pages without any article element: only the neighbours tell the template."""
    r = random.Random(5)
    rows = []
    for i in range(n):
        host = r.choice(["hot.example.org", "hot.example.org", f"h{i % 7}.example.com"])
        own = [f"own {i} line {k}" for k in range(r.randint(1, 6))]
        lines = [f"Welcome to {host}", "Share this", *own, "All rights reserved", f"Contact {host}"]
        rows.append((i, f"https://{host}/{r.choice('abc')}/{r.randint(0, 10**6)}", "".join(f"<p>{x}" for x in lines)))
    return rows


def test_template_lines_go(spark):
    rows = site(300)
    rows += [(1000 + k, f"https://mirror.example.net/{k}", "<p>same<p>text<p>here") for k in range(3)]
    rows += [(2000, None, None), (2000, None, None), (None, "", "<p>x"), (2001, "bad url [", "<p>" + "long " * 300_000)]
    frame = spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA + ", n_chars int, text string").repartition(5)
    out = page_text.extract(frame).collect()
    assert sorted(map(tuple, out), key=str) == plain(rows)
    by = {r.page_id: r.text for r in out}
    assert sum(all(x.startswith("own") for x in by[i].split("\n")) for i in range(300)) > 280
    assert by[1001] == "same\ntext\nhere" and by[2000] == ""
    assert page_text.extract(frame.limit(0)).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    out = op6_page_text(spark, SMALL).collect()
    assert sorted(map(tuple, out), key=str) == plain(rows)
    for r in out:
        source = next(x[2] for x in rows if x[0] == r.page_id)
        assert "<nav>" in source and "track(" not in r.text and "©" not in r.text and len(r.text) > 3


def test_protected_lines_need_many_witnesses():
    long = "a long passage " * 10
    pages = [page_text.page_lines(f"<p>Welcome<div><p>own {i} a<p>own {i} b</div><article><h2>Summary</h2><p>card {i}"
                                  f"<p>Share this<p>{long}</article>") for i in range(9)]
    kept = ["own 4 a", "own 4 b", "Summary", "card 4", "Share this", long.strip()]
    # what two neighbours share may be the articles' own words
    assert page_text.main_text(pages[4], [pages[3], pages[5]]).split("\n") == kept
    assert page_text.main_text(pages[4], [pages[3], pages[5]], pages[1:4] + pages[5:8]).split("\n") == kept
    around = pages[:4] + pages[5:]
    assert page_text.main_text(pages[4], [pages[3], pages[5]], around).split("\n") == [
        "own 4 a", "own 4 b", "card 4", long.strip()]
    around[2] = page_text.page_lines("<article><p>Share this<p>card x</article>")
    assert "Summary" in page_text.main_text(pages[4], [pages[3], pages[5]], around)


def test_article_text_is_not_lost():
    def text(source):
        return [t for t, _ in page_text.page_lines(source)]
    assert text('<form id="aspnetForm"><div class="menu">m</div><main><article><p>body</article></main>'
                '<input><button>Go</button></form>') == ["body"]
    assert text('<article><p>body</p><form><label>Name</label><p>Leave a comment</p></form></article>') == ["body"]
    for name in ("related-work", "comment-on-case", "note-sidebar-free", "social-history"):
        assert text(f'<article><p>a</p><section class="{name}"><p>b</p></section></article>') == ["a", "b"], name
    for name in ("related-posts", "comments", "share", "ad-slot", "x comment-list", "newsletter_form"):
        assert text(f'<article><p>a</p><section class="{name}"><p>b</p></section></article>') == ["a"], name


def test_runs_of_copies_lose_their_template(spark):
    """Twelve copies beside three other pages, and a run that partitions cut."""
    def page(own):
        return "".join(f"<p>{x}" for x in ["Top", "Menu", "About", *own, "Imprint"])
    rows = [(i, f"https://c.example.org/?i={i:02d}", page([f"own text {k}" for k in range(3)])) for i in range(12)]
    rows += [(100 + i, f"https://c.example.org/x{i}", page([f"own page {i} {k}" for k in range(3)])) for i in range(3)]
    rows += [(200 + i, f"https://d.example.org/{i}", page(["own first"] if i < 5 or i > 15 else ["own run"])) for i in range(20)]
    for parts in (1, 4):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = {r.page_id: r.text.split("\n") for r in page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        for i, _, source in rows if parts == 1 else rows[12:15]:
            assert out[i] == [t for t, _ in page_text.page_lines(source) if t.startswith("own")], i


def test_short_pages_lose_their_template(spark):
    """All pages of hosts where the template dominates, and near copies next to a page that differs."""
    rows = site(300)
    template = [f"menu {k}" for k in range(8)]
    rows += [(500 + i, f"https://short.example.org/{i:03d}", "".join(f"<p>{x}" for x in template + [f"own {i}"]))
             for i in range(40)]
    body = [f"own text {k}" for k in range(20)]
    rows += [(600 + i, f"https://copies.example.org/a{i}", "".join(f"<p>{x}" for x in ["Top", *body, f"own seen {i}"]))
             for i in range(3)]
    rows += [(610, "https://copies.example.org/b", "<p>Top<p>own other<p>own page")]
    for parts in (2, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = {r.page_id: r.text.split("\n") for r in page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert len(out) == len(rows)
        for i, _, source in rows:
            want = [t for t, _ in page_text.page_lines(source) if t.startswith("own")]
            assert out[i] == want, i
