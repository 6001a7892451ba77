"""Operator 3: licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences, each brought to a normal form (ASCII lower case, every run
of characters other than letters and digits one space) and mapped to the identifier of
a known licence sentence. Wordings of one sentence share its identifier (``WORDINGS``), also those that
name somebody (``NAMED``). The rules are ordered sequences of identifiers; a rule matches
where its identifiers follow one another with at most ``GAP`` unknown sentences in all
between them, or one an identifier if that is more (list numbers count as sentences). A match
inside a longer match is part of it and not reported. An ``SPDX-License-Identifier:`` tag and the one
licence it names are a sentence of their own; tags with expressions of several licences are not known.

Sentences end at . ! ? ; : before white space, and at line ends. Licence texts are often
wrapped, so the text is cut a second time with single line ends as spaces, and rules
that match there count too (``wrapped``).

A document is one row of a projection: known sentences and rules are literals, nothing
is shuffled, joined or sent to Python, and the row's arrays are as long as its text.

Defined results: NULL text counts as empty: no sentence, no licence; repeated and NULL
ids are scanned like any row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = 3

# fixed values: licence sentences and the rules over them, in the licences' own words and order
SENTENCES = {
    "reserved": "All rights reserved.",
    "apache_notice": "Licensed under the Apache License, Version 2.0.",
    "apache_header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache_comply": "you may not use this file except in compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License "
                    "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                    "or implied.",
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit_notice": "Released under the MIT License.",
    "mit_licensed": "Licensed under the MIT License.",
    "mit_title": "The MIT License (MIT)",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                 "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                 "subject to the following conditions:",
    "mit_notice_kept": "The above copyright notice and this permission notice shall be included in all copies or "
                       "substantial portions of the Software.",
    "mit_as_is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                 "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                 "NONINFRINGEMENT.",
    "gpl3_work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3_notice": "Licensed under the GNU General Public License, version 3.",
    "gpl_free": "This program is free software:",
    "gpl3_later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                  "later version.",
    "gpl2_later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation;",
    "gpl2_version": "either version 2 of the License, or (at your option) any later version.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl_fitness": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_details": "See the GNU General Public License for more details.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
                  "the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission.",
    "bsd_notice": "Licensed under the BSD License.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                 "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                 "copies.",
    "mpl_subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl_version": "2.0.",
    "mpl_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/.",
    "cc_by": "Licensed under CC BY 4.0.",
    "cc_by_sa": "Licensed under CC BY-SA 4.0.",
    "cc_by_nc": "Licensed under CC BY-NC 4.0.",
    "cc_by_nd": "Licensed under CC BY-ND 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
           "this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit0_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                  "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "mit_liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                  "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                  "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "gpl2_comma": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 2 of the License, or (at your option) any "
                  "later version.",
    "gpl2_only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as "
                 "published by the Free Software Foundation.",
    "gpl3_version": "either version 3 of the License, or (at your option) any later version.",
    "lgpl_terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                  "published by the Free Software Foundation;",
    "lgpl21_version": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3_later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version.",
    "lgpl_details": "See the GNU Lesser General Public License for more details.",
    "agpl_terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                  "published by the Free Software Foundation;",
    "agpl3_later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version.",
    "agpl_details": "See the GNU Affero General Public License for more details.",
    "bsd_advert": "All advertising materials mentioning features or use of this software must display the following "
                  "acknowledgement:",
    "zlib_as_is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib_liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
                  "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost_notice": "Distributed under the Boost Software License, Version 1.0.",
    "boost_grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                   "software and accompanying documentation covered by this license (the \"Software\") to use, "
                   "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
                   "of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject "
                   "to the following:",
    "bsd0_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted.",
    "epl_terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                 "License v.",
}
# fixed values: other wordings of the sentences above
WORDINGS = [
    ("mit_notice_kept", "The above copyright notice and this permission notice (including the next paragraph) shall be "
                        "included in all copies or substantial portions of the Software."),
    ("mit_as_is", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                  "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NON-INFRINGEMENT."),
    ("mit_title", "The MIT License"),
    ("mit_title", "MIT License"),
    ("mit_licensed", "This project is licensed under the MIT License."),
    ("mit_licensed", "Distributed under the MIT License."),
    ("apache_notice", "Licensed under the Apache License 2.0."),
    ("apache_notice", "Released under the Apache License, Version 2.0."),
    ("gpl2_version", "either version 2, or (at your option) any later version."),
    ("gpl3_version", "either version 3, or (at your option) any later version."),
    ("gpl2_only", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                  "by the Free Software Foundation, version 2."),
    ("gpl_hope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("bsd_source", "Redistributions of source code must retain the above copyright notice, this list of conditions, and "
                   "the following disclaimer."),
    ("bsd_binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions, and "
                   "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc_grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all "
                  "copies."),
]
# fixed values: normal forms of sentences that name a holder or an address; % stands for any text
NAMED = [
    ("bsd_names", "neither the name% may be used to endorse or promote products derived from this software without %"),
    ("bsd_names", "the name% may not be used to endorse or promote products derived from this software without %"),
    ("bsd_product", "this product includes software developed by %"),
    ("bsd_as_is", "this software is provided by % as is and any express or implied warranties including but not limited to "
                  "the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("epl1", "this program and the accompanying materials are made available under the terms of the eclipse public license "
             "v1 0 which accompanies this distribution and is available at %"),
    ("epl2", "this program and the accompanying materials are made available under the terms of the eclipse public license "
             "2 0 which is available at %"),
    ("epl2_version", "2 0 which is available at %"),
]
# fixed values: licences that an SPDX tag may name
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT",
        "MIT-0", "MPL-2.0", "Unlicense", "Zlib"]
# fixed values: older SPDX names of the same licences
SPDX_OLD = {"GPL-2.0": "GPL-2.0-only", "GPL-2.0+": "GPL-2.0-or-later", "GPL-3.0": "GPL-3.0-only", "GPL-3.0+": "GPL-3.0-or-later",
            "LGPL-2.1": "LGPL-2.1-only", "LGPL-2.1+": "LGPL-2.1-or-later", "LGPL-3.0": "LGPL-3.0-only",
            "LGPL-3.0+": "LGPL-3.0-or-later", "AGPL-3.0": "AGPL-3.0-only", "AGPL-3.0+": "AGPL-3.0-or-later"}
SPDX_TAG = "SPDX-License-Identifier:"
# fixed values: Creative Commons 4.0 licences by their parts
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
RULES = [
    ("All-Rights-Reserved", ["reserved"]),
    ("Apache-2.0", ["apache_notice"]),
    ("Apache-2.0", ["apache_header", "apache_comply", "apache_copy", "apache_as_is", "apache_see"]),
    ("Apache-2.0", ["apache_header", "apache_comply"]),
    ("MIT", ["mit_notice"]),
    ("MIT", ["mit_licensed"]),
    ("MIT", ["mit_title"]),
    ("MIT", ["mit_grant", "mit_notice_kept", "mit_as_is"]),
    ("GPL-3.0-only", ["gpl3_work"]),
    ("GPL-3.0-only", ["gpl3_notice"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("GPL-2.0-or-later", ["gpl2_later", "gpl2_version"]),
    ("GPL-2.0-or-later", ["gpl2_later", "gpl2_version", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD", ["bsd_notice"]),
    ("ISC", ["isc_grant"]),
    ("MPL-2.0", ["mpl_subject", "mpl_version", "mpl_copy"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-ND-4.0", ["cc_by_nd"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["mit_grant", "mit_notice_kept", "mit_as_is", "mit_liable"]),
    ("MIT-0", ["mit0_grant", "mit_as_is"]),
    ("GPL-2.0-only", ["gpl2_only"]),
    ("GPL-2.0-only", ["gpl2_only", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("GPL-2.0-or-later", ["gpl2_comma"]),
    ("GPL-2.0-or-later", ["gpl2_comma", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("GPL-3.0-or-later", ["gpl2_later", "gpl3_version"]),
    ("GPL-3.0-or-later", ["gpl2_later", "gpl3_version", "gpl_hope", "gpl_fitness", "gpl_details"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "lgpl21_version"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "lgpl21_version", "gpl_hope", "gpl_fitness", "lgpl_details"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "gpl3_version"]),
    ("LGPL-3.0-or-later", ["lgpl3_later"]),
    ("LGPL-3.0-or-later", ["lgpl3_later", "gpl_hope", "gpl_fitness", "lgpl_details"]),
    ("AGPL-3.0-or-later", ["agpl_terms", "gpl3_version"]),
    ("AGPL-3.0-or-later", ["agpl3_later"]),
    ("AGPL-3.0-or-later", ["agpl3_later", "gpl_hope", "gpl_fitness", "agpl_details"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is"]),
    ("BSD-4-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_advert", "bsd_product", "bsd_names"]),
    ("BSD-4-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_advert", "bsd_product", "bsd_names", "bsd_as_is"]),
    ("Zlib", ["zlib_as_is", "zlib_liable", "zlib_grant"]),
    ("BSL-1.0", ["boost_notice"]),
    ("BSL-1.0", ["boost_grant"]),
    ("0BSD", ["bsd0_grant"]),
    ("EPL-1.0", ["epl1"]),
    ("EPL-2.0", ["epl2"]),
    ("EPL-2.0", ["epl_terms", "epl2_version"]),
]
RULES += [(name, [f"spdx {name}"]) for name in SPDX] + [(f"CC-{k}-4.0", [f"creative {k}"]) for k in CREATIVE]

#: identifiers of the longest rule
MOST = max(len(ids) for _, ids in RULES)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[ \\t\\n\\x0B\\f\\r]"
END = f"[.!?;:]+({SPACE}+|\\z)"
LINES = f"{END}|[\\n\\r]+"
PARAGRAPHS = f"{END}|\\r?\\n{SPACE}*\\n"
# a tag belongs to the name after it; a plus that ends an old name ("2.0+") says "or later"
TAGS = [(SPDX_TAG, SPDX_TAG[:-1]), ("L-2.0+", "L-2.0 plus"), ("L-2.1+", "L-2.1 plus"), ("L-3.0+", "L-3.0 plus")]
OTHER = "[^\\p{L}\\p{N}\\x01]+"


def normal(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Normal form to identifier; no known sentence has another's form."""
    return {normal(s): name for name, s in SENTENCES.items()}


def known_forms() -> dict[str, str]:
    """Normal form to identifier of all wordings, SPDX tags and Creative Commons sentences."""
    tags = {**{n: n for n in SPDX}, **SPDX_OLD}
    spdx = [(f"spdx {name}", f"{SPDX_TAG[:-1]} {tag}".replace("+", " plus")) for tag, name in tags.items()]
    creative = [(f"creative {k}", f"This work is licensed under {article} Creative Commons {v} 4.0 International License.")
                for k, v in CREATIVE.items() for article in ("a", "the")]
    return known_sentences() | {normal(s): name for name, s in [*WORDINGS, *spdx, *creative]}


def sentences(text: Column, ends: str) -> Column:
    """Array of the text's sentences in normal form, without empty ones."""
    whole = F.coalesce(text, F.lit(""))
    for a, b in TAGS:
        whole = F.replace(whole, F.lit(a), F.lit(b))
    cut = F.regexp_replace(whole, ends, "\x01")
    plain = F.regexp_replace(F.translate(cut, UPPER, LOWER), OTHER, " ")
    return F.filter(F.split(plain, " ?(\x01 ?)+"), lambda s: F.trim(s) != "")


def reach(ids: list[str]) -> int:
    """Sentences that a match of a rule may span, unknown ones included."""
    return len(ids) + max(GAP, len(ids))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it, also inside of lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(found: Column) -> Column:
    """Rule matches over found[(pos, id)], without those inside a longer one; linear in the sentences found.

    A rule has at most ``MOST`` identifiers, so a longer match that holds another one starts at most
    that many places before it: the longest match of these few places decides.
    """
    starts = {}
    for name, ids in RULES:
        starts.setdefault(ids[0], []).append(F.struct(
            F.lit(name).alias("licence"), F.array(*map(F.lit, ids)).alias("ids"), F.lit(len(ids)).alias("n"),
            F.lit(reach(ids)).alias("reach")))
    by_start = F.create_map(*[x for first, rules in starts.items() for x in (F.lit(first), F.array(*rules))])
    none = F.array().cast("array<struct<licence: string, ids: array<string>, n: int, reach: int>>")

    def fitting(found, ids, i):
        rules = F.coalesce(F.element_at(by_start, F.element_at(ids, i + 1)), none)
        return F.filter(rules, lambda r: (F.slice(ids, i + 1, r["n"]) == r["ids"])
                        & (F.element_at(found, F.least(i + r["n"], F.size(found)))["pos"]
                           - F.element_at(found, i + 1)["pos"] < r["reach"]))

    def kept(found, at):
        # at[i]: the rules that fit at place i (of nought on), last[i]: the last place of the longest
        def with_last(last):
            def place(rules_here, i):
                before = F.slice(last, F.greatest(i - MOST + 2, F.lit(1)), F.least(i, F.lit(MOST - 1)))
                free = F.filter(rules_here, lambda r: (i + r["n"] == F.element_at(last, i + 1))
                                & ~F.exists(before, lambda end: end >= i + r["n"]))
                return F.transform(free, lambda r: F.struct(
                    F.element_at(found, i + 1)["pos"].alias("first"),
                    F.element_at(found, i + r["n"])["pos"].alias("last"), r["licence"].alias("licence")))
            return F.flatten(F.transform(at, place))
        return _let(F.transform(at, lambda rules_here, i: F.coalesce(
            i + F.array_max(F.transform(rules_here, lambda r: r["n"])), F.lit(0))), with_last)

    def with_ids(found):
        return _let(F.transform(found, lambda x: x["id"]), lambda ids: _let(
            F.transform(ids, lambda _, i: fitting(found, ids, i)), lambda at: kept(found, at)))
    return _let(found, with_ids)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: sentences, recognised sentences, licences found and where (sentence numbers from 0)."""
    forms = known_forms()
    names = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])

    def identifier(s: Column) -> Column:
        # the map is looked through entry by entry, so only for sentences of the (hashed) set of forms
        known = F.when(s.isin(*forms), F.element_at(names, s))
        for name, form in NAMED:
            known = known.when(s.startswith(form.split("%")[0]) & s.like(form), F.lit(name))
        return known

    def found(column: str) -> Column:
        trimmed = F.transform(F.col(column), lambda s: F.trim(s))
        numbered = F.transform(trimmed, lambda s, i: F.struct(i.alias("pos"), identifier(s).alias("id")))
        return F.filter(numbered, lambda x: x["id"].isNotNull())

    empty = F.array().cast("array<struct<first: int, last: int, licence: string>>")
    rows = (docs.select(F.col(key), sentences(F.col(text), LINES).alias("lines"),
                        sentences(F.col(text), PARAGRAPHS).alias("paragraphs"))
            .select(key, F.size("lines").cast("long").alias("n_sentences"), found("lines").alias("found"),
                    found("paragraphs").alias("found_wrapped"))
            .select(key, "n_sentences", F.size("found").cast("long").alias("n_known"),
                    F.when(F.size("found") > 0, _matches(F.col("found"))).otherwise(empty).alias("matches"),
                    F.when(F.size("found_wrapped") > 0, _matches(F.col("found_wrapped"))).otherwise(empty)
                    .alias("wrapped")))
    all_names = F.array_sort(F.array_distinct(F.concat(
        F.transform("matches", lambda m: m["licence"]), F.transform("wrapped", lambda m: m["licence"]))))
    return rows.withColumn("licences", all_names)


def scan_digest(docs: DataFrame) -> DataFrame:
    def line(column):
        return F.array_join(F.transform(F.array_sort(column), lambda m: F.concat_ws(
            ":", m["licence"], m["first"].cast("string"), m["last"].cast("string"))), ",")
    return scan(docs).select("doc_id", "n_sentences", "n_known", F.array_join("licences", ",").alias("licences"),
                             line("matches").alias("matches"), line("wrapped").alias("wrapped"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """DuckDB SQL of ``scan_digest``: sentences as rows, rules joined identifier after identifier."""
    known = ", ".join(f"({_quoted(n)}, {_quoted(i)})" for n, i in known_forms().items())
    named = " ".join(f"WHEN trim(sentence) LIKE {_quoted(form)} THEN {_quoted(name)}" for name, form in NAMED)
    tagged = "coalesce(text, '')"
    for a, b in TAGS:
        tagged = f"replace({tagged}, {_quoted(a)}, {_quoted(b)})"
    steps = ", ".join(f"({r}, {_quoted(name)}, {len(ids)}, {reach(ids)}, {k}, {_quoted(i)})"
                      for r, (name, ids) in enumerate(RULES) for k, i in enumerate(ids))

    def cut(ends: str) -> str:
        return (f"list_filter(regexp_split_to_array(regexp_replace(translate(regexp_replace({tagged}, "
                f"{_quoted(ends)}, chr(1), 'g'), '{UPPER}', '{LOWER}'), {_quoted(OTHER)}, ' ', 'g'), "
                f"' ?(\\x01 ?)+'), lambda s: trim(s) <> '')")

    def matched(name: str, ends: str) -> str:
        return f"""
{name}_all AS (SELECT k, doc_id, {cut(ends)} AS s FROM d),
{name}_rows AS (SELECT k, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM {name}_all),
{name}_named AS (SELECT k, pos, coalesce(known.id, CASE {named} END) AS id
                 FROM {name}_rows LEFT JOIN known ON trim(sentence) = known.form),
{name}_found AS (SELECT k, pos, id, row_number() OVER (PARTITION BY k ORDER BY pos) AS n
                 FROM {name}_named WHERE id IS NOT NULL),
{name}_every AS (
  SELECT f.k, r.rule, r.licence, f.pos AS first, max(g.pos) AS last
  FROM {name}_found f JOIN rules r ON r.step = 0 AND r.id = f.id
  JOIN rules q ON q.rule = r.rule JOIN {name}_found g ON g.k = f.k AND g.n = f.n + q.step AND g.id = q.id
  GROUP BY f.k, f.n, f.pos, r.rule, r.licence, r.steps, r.reach
  HAVING count(*) = r.steps AND max(g.pos) - f.pos < r.reach),
{name}_kept AS (
  SELECT * FROM {name}_every m WHERE NOT EXISTS (
    SELECT 1 FROM {name}_every o WHERE o.k = m.k AND o.first <= m.first AND o.last >= m.last
    AND o.last - o.first > m.last - m.first)),
{name}_line AS (SELECT k, string_agg(licence || ':' || first || ':' || last, ',' ORDER BY first, last, licence) AS line
                FROM {name}_kept GROUP BY k)"""
    return f"""
WITH known(form, id) AS (VALUES {known}),
rules(rule, licence, steps, reach, step, id) AS (VALUES {steps}),
d AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
{matched('plain', LINES)},{matched('wrapped', PARAGRAPHS)},
names AS (SELECT k, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
          FROM (SELECT k, licence FROM plain_kept UNION ALL SELECT k, licence FROM wrapped_kept) GROUP BY k),
counts AS (SELECT k, count(*) AS n FROM plain_found GROUP BY k)
SELECT a.doc_id, len(a.s)::BIGINT AS n_sentences, coalesce(c.n, 0)::BIGINT AS n_known,
       coalesce(x.licences, '') AS licences, coalesce(p.line, '') AS matches, coalesce(w.line, '') AS wrapped
FROM plain_all a LEFT JOIN counts c USING (k) LEFT JOIN names x USING (k)
LEFT JOIN plain_line p USING (k) LEFT JOIN wrapped_line w USING (k)"""
