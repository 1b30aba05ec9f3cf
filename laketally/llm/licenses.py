r"""Licence recognition by sentences and rules.

A text is read as words: runs of letters and digits, in lower case. Between them
stand breaks: the end of a line, and one of . ! ? : ; ) before white space. A
known sentence begins after a break (or where the text begins) and ends before
one (or where the text ends); it may run over breaks within, so neither comment
marks nor where its lines end matter. `*` in a known sentence stands for 1 to
`WILD` words. Of several that begin at a place the longest counts, then the
first listed, and the next one begins after it.

What lies between known sentences, cut at breaks, is of no account, except for
pieces with a word of `TELLING`: such a piece is unknown, and takes a place
among the ids as `?`. Rules are sequences of ids. They are matched from left to
right against the ids of the whole text, the longest first; ids in no rule stay
without a licence. All of every text is read, in time that grows with its length.

Spans of licences count code points, the end exclusive.

Nulls and odd rows: a null or empty text has no sentences. Repeated rows are each
scanned; a null doc_id is kept; an empty table gives an empty result.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WILD = 12
UNKNOWN = "?"
TELLING = frozenset("license licenses licensed licence licences licenced sublicense copyleft warranty warranties redistribute redistribution redistributions".split())

#: Sentence id and sentence.
SENTENCES = (
    ("apache2-short", "Licensed under the Apache License, Version 2.0"),
    ("apache2-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-asis", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("apache2-see", "See the License for the specific language governing permissions and limitations under the License"),
    ("mit-short", "Released under the MIT License"),
    ("mit-short", "Licensed under the MIT License"),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit-asis", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'),
    ("mit-liable", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-name", "Neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-asis", 'THIS SOFTWARE IS PROVIDED BY * "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED'),
    ("bsd-liable", "IN NO EVENT SHALL * BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl3-short", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl2-short", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl2-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("lgpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mpl2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("cc-by-4", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa-4", "Licensed under CC BY-NC-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Licence and the ids that tell it, in order.
RULES = (
    ("Apache-2.0", ("apache2-short",)),
    ("Apache-2.0", ("apache2-header",)),
    ("Apache-2.0", ("apache2-header", "apache2-copy", "apache2-asis", "apache2-see")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis", "mit-liable")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-asis", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-asis", "bsd-liable")),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-2.0-only", ("gpl2-short",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("MPL-2.0", ("mpl2",)),
    ("MPL-2.0", ("mpl2", "mpl2-copy")),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("Unlicense", ("unlicense",)),
)

PIECE = re.compile(r"""[^\W_]+|[.!?:;)]["'”’)]*(?!\S)|\n""")
TELLS = re.compile("|".join(sorted(TELLING)), re.I)
STAR = "*"


def _tree(sentences) -> dict:
    """Sentences by their words; under "" the rank and id of one that ends."""
    root: dict = {}
    for rank, (name, sentence) in enumerate(sentences):
        node = root
        for word in re.findall(r"[^\W_]+|\*", sentence.lower()):
            node = node.setdefault(word, {})
        node.setdefault("", (rank, name))
    return root


def _longest(tree: dict, words: list[str], ends: list[bool], begin: int) -> tuple[int, str] | None:
    """Where the longest sentence that begins at a word ends, and its id."""
    best = None
    states, at = [(tree, 0)], begin  # a node, and how many words its star has taken
    while states and at < len(words):
        word, after = words[at], []
        for node, taken in states:
            if word in node:
                after.append((node[word], 0))
            if STAR in node:
                after.append((node[STAR], 1))
            if 0 < taken < WILD:
                after.append((node, taken + 1))
        states = [s for k, s in enumerate(after) if not any(s[0] is o[0] and s[1] == o[1] for o in after[:k])]
        at += 1
        if ends[at - 1]:
            whole = [node[""] for node, _ in states if "" in node]
            if whole:
                best = (at, min(whole)[1])
    return best


def sentences_of(text: str, tree: dict) -> list[tuple[str, int, int]]:
    """(id, start, end) of the known and unknown sentences of a text, in order."""
    pieces = PIECE.findall(text)
    begins = [0] + [k + 1 for k, p in enumerate(pieces) if not p[0].isalnum()]
    telling = TELLS.search(text) is not None
    if not telling and not any(p < len(pieces) and pieces[p].lower() in tree for p in begins):
        return []
    words, where, ends, starts = [], [], [], []
    fresh = True
    for m in PIECE.finditer(text):
        if m.group()[0].isalnum():
            words.append(m.group().lower())
            where.append(m.span())
            starts.append(fresh)
            ends.append(False)
            fresh = False
        else:
            fresh = True
            if ends:
                ends[-1] = True
    if ends:
        ends[-1] = True
    found, at, begun, told = [], 0, 0, False
    while at < len(words):
        known = _longest(tree, words, ends, at) if starts[at] and (words[at] in tree or STAR in tree) else None
        if known:
            found.append((known[1], where[at][0], where[known[0] - 1][1]))
            at = begun = known[0]
            told = False
            continue
        told = told or words[at] in TELLING
        if ends[at]:
            if told:
                found.append((UNKNOWN, where[begun][0], where[at][1]))
            begun, told = at + 1, False
        at += 1
    return found


def licenses_of(found: list[tuple[str, int, int]], rules: dict) -> list[tuple[str, int, int]]:
    """(licence, start, end) of the rules that match the ids of a text."""
    out, at = [], 0
    while at < len(found):
        for some in rules.get(found[at][0], ()):
            name, ids = some
            if tuple(f[0] for f in found[at : at + len(ids)]) == ids:
                out.append((name, found[at][1], found[at + len(ids) - 1][2]))
                at += len(ids)
                break
        else:
            at += 1
    return out


def _by_first(rules) -> dict:
    """Rules by their first id, the longest first."""
    out: dict = {}
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        out.setdefault(rule[1][0], []).append(rule)
    return out


SPANS = "array<struct<name:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, sentences=SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, sentences, licenses) of every row: arrays of (name, start, end) in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, by_first = _tree(sentences), _by_first(rules)
        named = lambda some: [{"name": n, "start": a, "end": b} for n, a, b in some]
        for batch in batches:
            known, told = [], []
            for text in batch.column("text"):
                some = sentences_of(text.as_py() or "", tree)
                known.append(named(some))
                told.append(named(licenses_of(some, by_first)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(known, _SPANS), pa.array(told, _SPANS)], ["doc_id", "sentences", "licenses"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, sentences {SPANS}, licenses {SPANS}")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the licences of all documents, their sentences, and how many of these are unknown."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    unknown = F.size(F.filter("sentences", lambda s: s["name"] == UNKNOWN)).cast("long")
    written = F.array_join(F.transform("licenses", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("licenses.name")), ",").alias("licenses"),
        written.alias("spans"),
        F.array_join("sentences.name", ",").alias("sentences"),
        unknown.alias("n_unknown"),
    )
