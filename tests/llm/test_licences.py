"""Operator 3 against DuckDB, on the tables and on planted licence texts."""

import textwrap
import time

import duckdb

from rows import SMALL, make_docs
from subledger.llm import licences
from subledger.llm.queries import ORACLES, op3_licences

COLUMNS = "doc_id n_sentences n_known licences matches wrapped".split()


def both(spark, docs, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", [(r.get("doc_id"), r.get("text")) for r in rows])
    want = con.execute(licences.oracle()).fetchall()
    got = [tuple(r[c] for c in COLUMNS) for r in licences.scan_digest(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_tables(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(ORACLES["op3_licences"]).fetchall()
    got = [tuple(r[c] for c in COLUMNS) for r in op3_licences(spark, SMALL).collect()]
    assert sorted(got) == sorted(want) and any(r[3] for r in got)
    for doc_id, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        found = next(r[3] for r in got if r[0] == doc_id)
        assert ("MIT" in found) == ("Released under the MIT License." in text)


def test_known_sentences_are_found(spark):
    rows = [{"doc_id": i, "text": f"x y. {s}\nNext"} for i, s in enumerate(licences.SENTENCES.values())]
    for r in both(spark, make_docs(spark, rows), rows):
        assert r[2] >= 1, rows[r[0]]
    assert len(licences.known_sentences()) == len(licences.SENTENCES)


def full(*names):
    return " ".join(licences.SENTENCES[n] for n in names)


def test_rules_and_odd_rows(spark):
    mit = full("mit_grant", "mit_notice_kept", "mit_as_is")
    wrapped = "\n".join(" * " + x for x in textwrap.wrap(mit, 60))
    bsd3 = full("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")
    rows = [{"doc_id": 1, "text": "The MIT License (MIT)\n\n" + mit}, {"doc_id": 2, "text": "Code\n\n" + wrapped},
            {"doc_id": 3, "text": bsd3}, {"doc_id": 4, "text": full("bsd_source", "bsd_grant", "bsd_binary")},
            {"doc_id": 5, "text": licences.SENTENCES["mit_grant"] + " a. b. c. " + full("mit_notice_kept", "mit_as_is")},
            {"doc_id": 6, "text": licences.SENTENCES["mit_grant"] + " a. b. c. d. " + full("mit_notice_kept", "mit_as_is")},
            {"doc_id": 7, "text": None}, {"doc_id": None, "text": ""}, {"doc_id": None, "text": " .. \n ! "},
            {"doc_id": 8, "text": "ALL RIGHTS RESERVED"}, {"doc_id": 8, "text": "ALL RIGHTS RESERVED"},
            {"doc_id": 9, "text": "All rights reserved by é. All rights reserved; x"},
            {"doc_id": 10, "text": "one two. " * 50_000 + "Released under the MIT License."}]
    docs = make_docs(spark, [r | {"found": 1, "lines": "x"} for r in rows], ", found int, lines string")
    got = {r[0]: r for r in both(spark, docs, rows)}
    assert got[1][3:5] == ("MIT", "MIT:0:0,MIT:1:3") and got[2][3:5] == ("MIT", "") and got[2][5] == "MIT:1:3"
    assert got[3][3] == "BSD-3-Clause" and got[4][3] == "" and got[5][3] == "MIT" and got[6][3] == ""
    assert got[7][1:] == (0, 0, "", "", "") and got[8][3] == "All-Rights-Reserved" and got[9][2] == 1
    assert got[10][4] == "MIT:50000:50000"
    assert both(spark, docs.limit(0), []) == []


def test_plan_is_native(spark):
    plan = op3_licences(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_many_sentences_in_one_text(spark):
    """A notice file of 10,000 licence sentences: time follows their number."""
    one = "Licensed under the MIT License. Some other words here. "
    few, many = (make_docs(spark, [{"doc_id": 1, "text": one * n}]) for n in (50, 10_000))
    licences.scan(few).collect()
    start = time.time()
    row = licences.scan(many).collect()[0]
    assert time.time() - start < 60
    assert row.n_known == 10_000 and len(row.matches) == 10_000 and row.licences == ["MIT"]
    assert [m["first"] for m in row.matches] == list(range(0, 20_000, 2))


MIT_TEXT = ("Copyright (c) 2020 A. Holder\n\n" + full("mit_grant") + "\n\n" + full("mit_notice_kept") + "\n\n"
            + full("mit_as_is", "mit_liable"))
BSD_START = """Copyright (c) 1999 The Regents. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS BE LIABLE.
"""
UNIVERSITY = """Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
AUTHOR = """The name of the author may not be used to endorse or promote products
   derived from this software without specific prior written permission.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the University of
   California, Berkeley and its contributors.
"""
FREE = """This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation; either
version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
{kind}General Public License for more details.
"""
REAL = {
    "MIT license text": ("MIT", MIT_TEXT),
    "BSD-2": ("All-Rights-Reserved,BSD-2-Clause", BSD_START + BSD_END),
    "BSD-3 by holder": ("All-Rights-Reserved,BSD-3-Clause", BSD_START + "3. " + UNIVERSITY + BSD_END),
    "BSD-3 by author": ("All-Rights-Reserved,BSD-3-Clause", BSD_START + "3. " + AUTHOR + BSD_END),
    "BSD-4": ("All-Rights-Reserved,BSD-4-Clause", BSD_START + ADVERT + "4. " + UNIVERSITY + BSD_END),
    "LGPL-2.1": ("LGPL-2.1-or-later", FREE.format(what="library", kind="Lesser ", version="2.1")),
    "LGPL-3": ("LGPL-3.0-or-later", FREE.format(what="library", kind="Lesser ", version="3")),
    "GPL-2": ("GPL-2.0-or-later", FREE.format(what="program", kind="", version="2")),
    "GPL-3": ("GPL-3.0-or-later", FREE.format(what="program", kind="", version="3")),
    "AGPL-3": ("AGPL-3.0-or-later", FREE.format(what="program", kind="Affero ", version="3")),
    "GPL-2 comma": ("GPL-2.0-or-later", FREE.format(what="program", kind="", version="2").replace("Foundation; ", "Foundation, ")),
    "AGPL-3 comma": ("AGPL-3.0-or-later", FREE.format(what="program", kind="Affero ", version="3").replace("Foundation; ", "Foundation, ")),
    "EPL-2": ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License"
              " 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nx"),
    "EPL-2 v.": ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public "
                 "License v. 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nx"),
    "zlib": ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be "
             "held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this "
             "software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to "
             "the following restrictions:\n\n1. The origin must not be misrepresented."),
    "Boost": ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt)"),
    "ISC and": ("ISC", licences.SENTENCES["isc_grant"].replace("and/or distribute", "and distribute")),
    "0BSD": ("0BSD", full("bsd0_grant")),
    "MIT-0": ("MIT-0", full("mit0_grant") + "\n\n" + full("mit_as_is", "mit_liable")),
    "CC": ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 "
           "International License.\n"),
    "SPDX": ("MIT", "// SPDX-License-Identifier: MIT\nint main() {}"),
    "SPDX in a comment": ("GPL-2.0-or-later", "/* SPDX-License-Identifier: GPL-2.0-or-later */\n"),
    "SPDX old": ("GPL-2.0-only,LGPL-2.1-or-later", "# SPDX-License-Identifier: GPL-2.0\n# SPDX-License-Identifier: LGPL-2.1+\n"),
    "SPDX expression": ("", "# SPDX-License-Identifier: MIT OR Apache-2.0\n"),
    "no licence": ("", "Neither the name of the rose nor its thorns. MIT was founded in 1861. The GPL is discussed."),
}


def test_real_texts_in_their_own_wrapping(spark):
    rows = [{"doc_id": i, "text": text} for i, (_, text) in enumerate(REAL.values())]
    got = {r[0]: r[3] for r in both(spark, make_docs(spark, rows), rows)}
    assert {name: got[i] for i, name in enumerate(REAL)} == {name: want for name, (want, _) in REAL.items()}


def test_forms_are_their_own(spark):
    forms, ids = licences.known_forms(), {i for _, rule in licences.RULES for i in rule}
    names = set(forms.values()) | {n for n, _ in licences.NAMED}
    assert ids <= names and {n for n, _ in licences.WORDINGS} <= set(licences.SENTENCES)
    assert all(licences.normal(f) == f for f in forms)
    rows = [{"doc_id": i, "text": f"x. {f}\n\n"} for i, f in enumerate(forms)]
    assert all(r[2] >= 1 for r in both(spark, make_docs(spark, rows), rows))
