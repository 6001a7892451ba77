"""Operator 2: the contract's patterns, disclosure counts against brute force, odd rows."""

import hashlib
import math
import random
import re

from rows import SMALL, make_docs
from subledger.llm import private
from subledger.llm.queries import op2_private

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def literal(text):
    def check(digits):
        rev = [int(c) for c in digits[::-1]]
        return sum(rev[::2] + [d * 2 - 9 * (d > 4) for d in rev[1::2]]) % 10 == 0
    only = lambda s: "".join(c for c in s if c in "0123456789")
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(only(m[0])) <= 19 and check(only(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only(m[0])) <= 15]


def test_patterns():
    r = random.Random(1)
    pieces = ["a.b@c.d", "@", "x@y", "a@b@c.d.e", "..@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.0255",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "+1 (234) 555-2485", "+123", "+1--2",
              " ", "-", ".", "é", "+", "7", "12", "()", "ab", "\n", "%"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        assert private.base_spans(text) == literal(text), text
    for _ in range(4000):
        text = "".join(r.choice("1234567890.+- a@(") for _ in range(r.randint(1, 40)))
        assert private.base_spans(text) == literal(text), text


def test_long_runs_are_linear():
    for piece in ("a", "1", "1.", "1 ", "a@", "@", "+1(", "a@b.", "é@1"):
        private.base_spans(piece * 100_000)


def brute(docs):
    """spans string per (id, text) by the formulas, document after document."""
    total = len(docs)
    near, terms, general = {}, [], {}
    spans = [literal(t or "") for _, t in docs]
    with_e, pair, shape = {}, {}, {}
    for k, (_, t) in enumerate(docs):
        own = {w.lower() for w in re.findall(r"\w+", t or "")}
        terms.append(own | {"0:" + re.sub("[0-9]", "0", w) for w in own if re.search("[0-9]", w)})
        near[k] = private.near_terms(t or "", spans[k])
        for e in {private.entity(kind, t[a:b]) for kind, a, b in spans[k]}:
            with_e[e] = with_e.get(e, 0) + 1
        for e, w in {(e, w) for e, w, _, _ in near[k]}:
            pair[e, w] = pair.get((e, w), 0) + 1
        for e, w, _, _ in near[k]:
            if re.search("[0-9]", w):
                shape.setdefault((e, "0:" + re.sub("[0-9]", "0", w)), set()).add(docs[k])
    df = {}
    for own in terms:
        for w in own:
            df[w] = df.get(w, 0) + 1

    def told(e, w, both):
        return math.log(total * both / (df[w] * with_e[e])) / math.log(total / with_e[e]) >= private.DISCLOSED - 1e-12
    out = []
    for k, (i, _) in enumerate(docs):
        add = sorted({(a, b) for e, w, a, b in near[k] if pair[e, w] >= 2 and with_e[e] < total
                      and told(e, w, pair[e, w])})
        out.append((i, ",".join([f"{x}:{a}:{b}" for x, a, b in spans[k]] + [f"term:{a}:{b}" for a, b in add])))
    return out


def test_query_against_brute_force(spark):
    rows = op2_private(spark, SMALL).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted((r.doc_id, r.spans) for r in rows) == sorted(brute(list(docs.items())), key=lambda x: x[0])
    for r in rows:
        want = literal(docs[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == x for x, _, _ in want) for k in ("email", "ip", "card", "phone")]
    assert sum(r.n_email for r in rows)


def told_rows():
    docs = [{"doc_id": i, "text": f"the clerk filed form {i} about nothing in particular today"} for i in range(60)]
    for i in range(100, 104):
        docs.append({"doc_id": i, "text": f"Write to Zebulon (room77{i % 2}) the clerk jo@ex-ample.org today, {i}"})
    docs += [{"doc_id": 200 + i, "text": f"room77{2 + i % 8} is free and so is the clerk"} for i in range(30)]
    return docs


def test_disclosing_terms(spark):
    docs = make_docs(spark, told_rows())
    rows = {r.doc_id: r for r in private.personal_data(docs).collect()}
    text = next(d["text"] for d in told_rows() if d["doc_id"] == 100)
    spans = [s.split(":") for s in rows[100].spans.split(",")]
    terms = {text[int(a):int(b)] for k, a, b in spans if k == "term"}
    assert terms == {"Write", "Zebulon", "room770", "to"} and rows[100].n_term == 4
    assert rows[5].spans == "" and rows[205].spans == ""
    assert sorted((r.doc_id, r.spans) for r in rows.values()) == sorted(
        brute([(d["doc_id"], d["text"]) for d in told_rows()]), key=lambda x: x[0])
    clean = {r.doc_id: r.text for r in private.sanitised(docs).collect()}
    assert clean[100] == "[TERM] [TERM] [TERM] (room000) the clerk [EMAIL] today, 100"
    assert clean[5] == told_rows()[5]["text"]


def test_repeated_rows_do_not_change_the_action(spark):
    """Term and general form are counted in the same unit, rows."""
    rows = [{"doc_id": i, "text": f"the clerk filed form number {i} today"} for i in range(60)]
    told = [{"doc_id": i, "text": "Write jo@ex-ample.org about zeta42 now"} for i in (100, None)]
    for copies in (1, 3):
        clean = private.sanitised(make_docs(spark, rows + told * copies)).collect()
        assert {r.text for r in clean if "[EMAIL]" in r.text} == {"[TERM] [EMAIL] [TERM] [TERM] [TERM]"}


def test_odd_rows(spark):
    rows = [{"doc_id": 1, "text": None}, {"doc_id": None, "text": ""}, {"doc_id": 2, "text": "a@b.c"},
            {"doc_id": 2, "text": "a@b.c"}, {"doc_id": None, "text": "x a@b.c"},
            {"doc_id": 3, "text": "word " * 100_000 + "10.0.0.1"}]
    docs = make_docs(spark, [r | {"spans": "s", "digest": 1, "near": 2} for r in rows],
                     ", spans string, digest int, near int")
    out = private.personal_data(docs).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.base_sha256 == empty) for r in out) == [
        ("1", 0, 0, True), ("2", 1, 0, False), ("2", 1, 0, False), ("3", 0, 1, False), ("None", 0, 0, True),
        ("None", 1, 0, False)]
    clean = private.sanitised(docs)
    assert clean.columns == docs.columns
    assert sorted((r.text or "-")[-12:] for r in clean.collect()) == sorted(
        ["-", "-", "[EMAIL]", "[EMAIL]", "x [EMAIL]", "rd word [IP]"])
    assert private.personal_data(docs.limit(0)).collect() == [] == private.sanitised(docs.limit(0)).collect()
