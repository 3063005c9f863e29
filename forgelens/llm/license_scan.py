"""License scans: template markup compiled to token automata.

A template is wording with optional regions (``<<beginOptional>>``,
``<<endOptional>>``) and replaceable ones (``<<var;name="...";words=N>>``, which
stand for up to N words).  It becomes an automaton over words; a text carries
the template's label where the automaton accepts, that is where all mandatory
words stand in order and nothing else does but what the markup allows.  A
label may have several templates, as a license has a text and a usual notice.

Upper-case ASCII letters are lower-cased; words are runs of digits, letters and
non-ASCII characters.  Null and empty texts have no words, no labels and score
0.  Repeated rows are scanned one by one.  Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Wording of public licenses and of their usual notices, with markup; a label may have several.
TEMPLATES = {
    "mit-notice": (
        "<<beginOptional>>This <<var;name=\"work\";words=2>> is<<endOptional>> <<beginOptional>>Released"
        "<<endOptional>> <<beginOptional>>Licensed<<endOptional>> <<beginOptional>>Distributed<<endOptional>> under"
        " <<beginOptional>>the terms of<<endOptional>> the MIT License",
        "The MIT License <<beginOptional>>(MIT)<<endOptional>>",
        "MIT License Copyright <<beginOptional>>(c)<<endOptional>>",
    ),
    "apache-2.0": (
        "Licensed under the Apache License <<beginOptional>>Version<<endOptional>> 2.0"
        " <<beginOptional>>the \"License\"<<endOptional>>",
        "Apache License Version 2.0, January 2004",
    ),
    "gpl-2.0": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation;"
        " <<beginOptional>>either<<endOptional>> version 2 <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or (at your option) any later version<<endOptional>>",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "gpl-3.0": (
        "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>> General"
        " Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>"
        " <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>or later<<endOptional>>"
        " <<beginOptional>>of the License<<endOptional>>",
        "under the terms of the GNU General Public License as published by the Free Software Foundation,"
        " <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or (at your option) any later version<<endOptional>>",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "lgpl-2.1": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;"
        " <<beginOptional>>either<<endOptional>> version 2.1 <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or (at your option) any later version<<endOptional>>",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "lgpl-3.0": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation,"
        " <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or (at your option) any later version<<endOptional>>",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "agpl-3.0": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation,"
        " <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the License<<endOptional>>"
        " <<beginOptional>>or (at your option) any later version<<endOptional>>",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " <<beginOptional>>If a copy of the MPL was not distributed with this file, You can obtain one at"
        " <<var;name=\"scheme\";words=1>> mozilla.org/MPL/2.0<<endOptional>>",
        "Mozilla Public License Version 2.0",
    ),
    "cc-by-4.0": (
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>>"
        " <<beginOptional>>CC<<endOptional>> BY <<beginOptional>>International<<endOptional>> 4.0",
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons"
        " Attribution 4.0 <<beginOptional>>International<<endOptional>> <<beginOptional>>License<<endOptional>>",
    ),
    "cc-by-sa-4.0": (
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons"
        " Attribution-ShareAlike 4.0 <<beginOptional>>International<<endOptional>>"
    ),
    "cc-by-nc-4.0": (
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>>"
        " <<beginOptional>>CC<<endOptional>> BY-NC <<beginOptional>>International<<endOptional>> 4.0",
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons"
        " Attribution-NonCommercial 4.0 <<beginOptional>>International<<endOptional>>",
    ),
    "copyright-notice": (
        "Copyright <<beginOptional>>(c)<<endOptional>> <<var;name=\"years and holder\";words=12>> All rights reserved"
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next"
        " paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software."
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
        " IN NO EVENT SHALL <<var;name=\"holders\";words=8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE"
        " SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"
    ),
    "isc": (
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any"
        " purpose with or without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var;name=\"author\";words=4>> DISCLAIMS"
        " ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
        " IN NO EVENT SHALL <<var;name=\"author\";words=4>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
        " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
        " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must"
        " retain the above copyright notice, this list of conditions and the following disclaimer."
        " <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided"
        " with the distribution. <<beginOptional>><<beginOptional>>3.<<endOptional>> Neither the name of"
        " <<var;name=\"holder\";words=8>> nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission.<<endOptional>> THIS SOFTWARE IS"
        " PROVIDED BY <<var;name=\"provider\";words=8>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT"
        " NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED. IN NO EVENT SHALL <<var;name=\"holder\";words=8>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
        " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS"
        " OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
        " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY"
        " WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
    ),
}

#: Words a replaceable region may stand for, if its markup names no number.
VAR_WORDS = 10

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MARK = re.compile(r"<<(.*?)>>")


def wordings(templates: dict[str, str | tuple[str, ...]] = TEMPLATES) -> Iterator[tuple[str, str]]:
    """Every label with each of its templates."""
    for label, own in templates.items():
        for template in (own,) if isinstance(own, str) else own:
            yield label, template


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


@dataclass
class Automaton:
    """States are numbered in order; ``skips`` are moves that take no word."""

    words: list[dict[bytes, int]]
    wild: list[int | None]
    skips: list[list[int]]

    def closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for further in self.skips[todo.pop()]:
                if further not in seen:
                    seen.add(further)
                    todo.append(further)
        return seen

    def __post_init__(self):
        self.final = len(self.words) - 1
        self.begin = self.closed({0})
        #: Words that a match can begin with; a template may not begin with a replaceable region.
        self.first = {word for state in self.begin for word in self.words[state]}
        if any(self.wild[state] is not None for state in self.begin):
            raise ValueError("a template must begin with wording")

    def accepts_from(self, words: list[bytes], start: int) -> int | None:
        """End of the longest accepted run of words that begins at ``start``."""
        states, end, place = self.begin, None, start
        while states and place < len(words):
            word = words[place]
            moved = {self.words[s][word] for s in states if word in self.words[s]}
            moved |= {self.wild[s] for s in states if self.wild[s] is not None}
            states = self.closed(moved)
            place += 1
            if self.final in states:
                end = place
        return end


def parts_of(template: str) -> Iterator[tuple[str, object]]:
    """Words, ``open`` and ``close`` of optional regions, and replaceable regions."""
    place = 0
    for mark in [*_MARK.finditer(template), None]:
        upto = mark.start() if mark else len(template)
        for word in words_of(template[place:upto].encode()):
            yield "word", word
        if mark:
            place, kind = mark.end(), mark[1]
            if kind == "beginOptional":
                yield "open", None
            elif kind == "endOptional":
                yield "close", None
            elif kind.startswith("var"):
                most = re.search(r"words=(\d+)", kind)
                yield "var", int(most[1]) if most else VAR_WORDS
            else:
                raise ValueError(f"unknown markup {kind!r}")


def compile_template(template: str) -> Automaton:
    words: list[dict[bytes, int]] = [{}]
    wild: list[int | None] = [None]
    skips: list[list[int]] = [[]]
    opened: list[int] = []

    def state() -> int:
        words.append({})
        wild.append(None)
        skips.append([])
        return len(words) - 1

    for kind, value in parts_of(template):
        last = len(words) - 1
        if kind == "word":
            words[last][value] = state()
        elif kind == "var":
            through = [last]
            for _ in range(value):
                wild[through[-1]] = state()
                through.append(len(words) - 1)
            for s in through[:-1]:
                skips[s].append(through[-1])
        elif kind == "open":
            opened.append(last)
            skips[last].append(state())
        else:
            begin = opened.pop()
            end = state()
            skips[last].append(end)
            skips[begin].append(end)
    if opened:
        raise ValueError("an optional region is not closed")
    return Automaton(words, wild, skips)


def as_pattern(template: str) -> str:
    """The same template as a regular expression over words that each follow a blank."""
    pattern = {"open": "(?:", "close": ")?"}
    parts = []
    for kind, value in parts_of(template):
        if kind == "word":
            parts.append(" " + value.decode())
        elif kind == "var":
            parts.append(f"(?: [^ ]+){{0,{value}}}")
        else:
            parts.append(pattern[kind])
    return "".join(parts) + " "


class Scanner:
    """Automata of all templates, and the words at which one of them can begin."""

    def __init__(self, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.automata = [(label, compile_template(template)) for label, template in wordings(templates)]
        self.phrases = [(phrase.encode().split(), label) for phrase, label in phrases.items()]
        self.begins: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, automaton in self.automata:
            for word in automaton.first:
                self.begins.setdefault(word, []).append((label, automaton))

    def scan(self, text: bytes | None) -> dict:
        """Counts, base places and template matches (label, first word, last word) of one text."""
        words = words_of(text)
        places, labels = [], set()
        matches = []
        known = self.begins
        for phrase, label in self.phrases:
            at, first = -1, phrase[0]
            while True:
                try:
                    at = words.index(first, at + 1)
                except ValueError:
                    break
                if words[at : at + len(phrase)] == phrase:
                    places.append(at)
                    labels.add(label)
        for start in [i for i, word in enumerate(words) if word in known]:
            ends: dict[str, int] = {}
            for label, automaton in known[words[start]]:
                end = automaton.accepts_from(words, start)
                if end is not None:
                    ends[label] = max(end, ends.get(label, 0))
            matches += [(label, start, end - 1) for label, end in ends.items()]
        found = labels | {label for label, _, _ in matches}
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(found)),
            "matches": [{"label": label, "first": first, "last": last} for label, first, last in matches],
            "score": 1.0 if matches else 0.5 if places else 0.0,
        }


SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("matches", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))),
        ("score", pa.float64()),
    ]
)
SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, matches array<struct<label:string,first:bigint,last:bigint>>, score double"
)


def scan(
    documents: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES
) -> DataFrame:
    """One row per document: counts, labels, and the spans that templates accept."""

    def scanned(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            rows = [
                {"doc_id": doc_id} | scanner.scan(text)
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=SCANNED)

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(scanned, SCHEMA)
