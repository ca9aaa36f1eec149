"""License scans by sentence rules: known sentences become identifiers, identifier sequences match rules.

A text is cut into sentences, each is normalised and looked up among known licence sentences. What is
found, in order, is a sequence of identifiers, in which the rules look for theirs, one rule after the
other; sentences that a rule has used are not there for the next. All of it is an expression over one
text: no shuffle, no row for each sentence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosstally.llm.common import text_of

# Sentences of public licences and of common notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software"
    ),
    "mit-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT'
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"
    ),
    "mit-liability": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE"
        " SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License"
    ),
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        ' distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'
    ),
    "apache-limits": (
        "See the License for the specific language governing permissions and limitations under the License"
    ),
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-notice-2": "Licensed under the GNU General Public License, version 3",
    "gpl-grant-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version"
    ),
    "gpl-grant-2": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version"
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    ),
    "gpl-details": "See the GNU General Public License for more details",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:"
    ),
    "bsd-grant-1": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer"
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution"
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission"
    ),
    "lgpl-grant-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
        " (at your option) any later version"
    ),
    "lgpl-grant-3": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version"
    ),
    "agpl-grant-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version"
    ),
    "gpl-grant-2-only": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License version 2 as published by the Free Software Foundation"
    ),
    "epl-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0",
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
    "unlicense-notice": "This is free and unencumbered software released into the public domain",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-notice-2": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"
    ),
    "cc-by-notice": "Licensed under CC BY 4.0",
    "cc-by-notice-2": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0",
    "cc0-notice": "Released under CC0 1.0 Universal",
}

# Rules in the order in which they are tried, longer ones of a licence first.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-condition", "mit-disclaimer", "mit-liability"]),
    ("MIT", ["mit-title-2", "mit-grant", "mit-condition", "mit-disclaimer", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-disclaimer", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-header", "apache-copy", "apache-disclaimer", "apache-limits"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0-or-later", ["gpl-grant-3", "gpl-hope", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl-grant-3"]),
    ("GPL-2.0-or-later", ["gpl-grant-2", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl-grant-2"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-only", ["gpl3-notice-2"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant-1", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-grant-1", "bsd-source", "bsd-binary"]),
    ("LGPL-2.1-or-later", ["lgpl-grant-2.1"]),
    ("LGPL-3.0-or-later", ["lgpl-grant-3"]),
    ("AGPL-3.0-or-later", ["agpl-grant-3"]),
    ("GPL-2.0-only", ["gpl-grant-2-only"]),
    ("EPL-2.0", ["epl-notice"]),
    ("BSL-1.0", ["bsl-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("Unlicense", ["unlicense-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice-2"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-notice-2"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
]

# Names in notices by licence. Licences without one are known by their text and their id only.
NAMES = {
    "MIT": "MIT License",
    "ISC": "ISC License",
    "Apache-2.0": "Apache License, Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "GPL-2.0-only": "GNU General Public License, version 2",
    "GPL-3.0-only": "GNU General Public License, version 3",
    "LGPL-2.1-only": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-only": "GNU Lesser General Public License, version 3",
    "AGPL-3.0-only": "GNU Affero General Public License, version 3",
    "MPL-2.0": "Mozilla Public License, version 2.0",
    "EPL-2.0": "Eclipse Public License, version 2.0",
    "BSL-1.0": "Boost Software License, Version 1.0",
}
#: How notices begin, before "under the" and a name.
VERBS = ("Licensed", "Released", "Distributed", "This work is licensed", "This software is licensed")


def _with_notices() -> None:
    """Each licence's notices, and the line with its id, as sentences and rules of their own."""
    forms = {normalised(sentence) for sentence in SENTENCES.values()}
    for licence in dict.fromkeys([*(name for name, _ in RULES), *NAMES]):
        own = [f"SPDX-License-Identifier: {licence}"]
        own += [f"{verb} under the {NAMES[licence]}" for verb in VERBS if licence in NAMES]
        for number, sentence in enumerate(own):
            if normalised(sentence) not in forms:
                name = f"{licence.lower()}-{'said' if number else 'spdx'}{f'-{number}' if number else ''}"
                SENTENCES[name] = sentence
                RULES.append((licence, [name]))


#: What is a blank in normalised text: all ASCII but letters, digits, new lines and what ends sentences.
BLANKS = r"[\x00-\x09\x0B-\x20\x22-\x2D\x2F\x3A-\x3E\x40\x5B-\x60\x7B-\x7F]+"
#: Ends of sentences: a mark before white space or the end, and an empty line.
ENDS = r"[.!?]+( |\n|$)|\n ?\n"
#: What is left inside a sentence that is no letter or digit.
INNER = r"[ \n.!?]+"


def normalised(sentence: str) -> str:
    """A known sentence in the form in which sentences of texts are looked up."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sentence)
    return re.sub(INNER, " ", re.sub(BLANKS, " ", lower)).strip(" ")


_with_notices()

#: Whose name must not be used differs from text to text; it is put as in the known sentence.
HOLDER = r"(neither[ \n]+the[ \n]+name[ \n]+of)[ \n](?s:.){1,160}?[ \n](nor[ \n]+the[ \n]+names[ \n]+of)"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs() -> str:
    """Matches runs of whole lines that are a known sentence, longer sentences before those they begin with."""
    forms = sorted(map(normalised, SENTENCES.values()), key=lambda form: (-len(form), form))
    known = "|".join(form.replace(" ", INNER) for form in forms)
    return rf"(?<![^\n])[ .!?]*(?:{known})[ .!?]*(?![^\n])"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A sentence may run over several lines. In one that is not known as a whole, runs of lines are looked up:
    from each line on the longest that is known; after it, the search goes on behind it.
    """
    known = F.create_map(*(F.lit(x) for name, s in SENTENCES.items() for x in (normalised(s), name)))

    def look_up(part: Column) -> Column:
        return F.try_element_at(known, F.trim(F.regexp_replace(part, INNER, " ")))

    def found(sentence: Column) -> Column:
        whole = look_up(sentence)
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(F.regexp_extract_all(sentence, F.lit(_runs()), F.lit(0)), look_up))

    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), BLANKS, " ")
    plain = F.regexp_replace(plain, HOLDER, "$1 the copyright holder $2")
    return F.array_compact(F.flatten(F.transform(F.split(plain, ENDS), found)))


def licences(ids: Column) -> Column:
    """The licences whose rules match a sequence of sentence identifiers, in the order of the rules."""
    rules = F.array(
        *(F.struct(F.lit(name).alias("name"), F.lit(_written(rule)).alias("ids")) for name, rule in RULES)
    )
    start = F.struct(
        F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("left"),
        F.array().cast("array<string>").alias("found"),
    )

    def step(state: Column, rule: Column) -> Column:
        return F.when(
            state["left"].contains(rule["ids"]),
            F.struct(
                F.replace(state["left"], rule["ids"], F.lit("|")).alias("left"),
                F.concat(state["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(state)

    return F.array_distinct(F.aggregate(rules, start, step, lambda state: state["found"]))


def _written(rule: list[str]) -> str:
    return "".join(f"<{name}>" for name in rule)


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, sentences (identifiers of the known ones, in order) and licences of each row of ``docs``.

    NULL and empty texts have none. Texts are taken whole; repeated rows get a row each; further columns
    are not looked at; an empty table gives an empty result. A licence is named once, however often it
    occurs.
    """
    found = docs.select(F.col(id_column).alias("doc_id"), sentence_ids(text_of(text_column)).alias("sentences"))
    return found.withColumn("licences", licences(F.col("sentences")))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql() -> str:
    """``op4`` in SQL: a row for each sentence and run of lines, and a replacement for each rule.

    Runs of lines of an unknown sentence are taken one after the other: from a line on the longest that is
    known, or none, and then from the line behind.
    """
    most = max(len(normalised(s).split(" ")) for s in SENTENCES.values())
    known = ", ".join(f"({_quoted(normalised(s))}, '{name}')" for name, s in SENTENCES.items())
    steps = "".join(
        f", s{k + 1} AS (SELECT *, replace(l{k}, '{_written(rule)}', '|') AS l{k + 1} FROM s{k})"
        for k, (_, rule) in enumerate(RULES)
    )
    names = list(dict.fromkeys(name for name, _ in RULES))
    hits = {n: " OR ".join(f"l{k} <> l{k + 1}" for k, (m, _) in enumerate(RULES) if m == n) for n in names}
    named = ", ".join(f"CASE WHEN {hits[n]} THEN '{n}' END" for n in names)
    return rf"""
WITH RECURSIVE known(sentence, name) AS (VALUES {known}), numbered AS (
  SELECT doc_id AS id, text, row_number() OVER () AS doc_id FROM documents
), parts AS (
  SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '{BLANKS}', ' ', 'g'), '{HOLDER}', '\1 the copyright holder \2', 'g'), '{ENDS}') AS p
  FROM numbered
), sentences AS (
  SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS k FROM parts
), whole AS (
  SELECT t.doc_id, t.s, t.k, w.name FROM sentences t
  LEFT JOIN known w ON w.sentence = trim(regexp_replace(t.s, '{INNER}', ' ', 'g'), ' ')
), cut AS (
  SELECT doc_id, k, string_split(s, chr(10)) AS p FROM whole WHERE name IS NULL
), first AS (
  SELECT doc_id, k, p, unnest(range(1, len(p) + 1)) AS l FROM cut
), lines AS (
  SELECT doc_id, k, l, p, unnest(range(l, least(l + {most}, len(p) + 1))) AS m FROM first
  WHERE regexp_full_match(p[l], '(?s).*[^ .!?].*')
), known_runs AS (
  SELECT t.doc_id, t.k, t.l, max(t.m) AS m, max_by(n.name, t.m) AS name FROM lines t
  JOIN known n ON n.sentence = trim(regexp_replace(array_to_string(p[l:m], chr(10)), '{INNER}', ' ', 'g'), ' ')
  WHERE regexp_full_match(p[m], '(?s).*[^ .!?].*')
  GROUP BY t.doc_id, t.k, t.l
), taken AS (
  SELECT doc_id, k, l, m, name FROM known_runs r
  WHERE l = (SELECT min(l) FROM known_runs f WHERE f.doc_id = r.doc_id AND f.k = r.k)
  UNION ALL
  SELECT r.doc_id, r.k, r.l, r.m, r.name FROM taken t JOIN known_runs r ON r.doc_id = t.doc_id AND r.k = t.k
  WHERE r.l = (SELECT min(l) FROM known_runs f WHERE f.doc_id = t.doc_id AND f.k = t.k AND f.l > t.m)
), found AS (
  SELECT doc_id, k, 0 AS l, name FROM whole WHERE name IS NOT NULL
  UNION ALL
  SELECT doc_id, k, l, name FROM taken
), s0 AS (
  SELECT d.id, count(f.name) AS n, coalesce(string_agg(f.name, ',' ORDER BY k, l), '') AS sentences,
         coalesce(string_agg('<' || f.name || '>', '' ORDER BY k, l), '') AS l0
  FROM numbered d LEFT JOIN found f ON f.doc_id = d.doc_id
  GROUP BY d.doc_id, d.id
){steps}
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_known, sentences, concat_ws(',', {named}) AS licences FROM s{len(RULES)}
"""
