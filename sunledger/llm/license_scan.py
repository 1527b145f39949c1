"""License scans: templates with optional and replaceable regions, as word automata.

A template is license wording with markup: ``<<beginOptional>>...<<endOptional>>`` may be
left out, ``<<var;words=a-b>>`` stands for any a to b words. All templates are compiled
into one automaton over words by subset construction: a word is a symbol, words of no
template share one symbol, and a state knows which templates it accepts. A text is read
once; the automaton starts at every word that can begin a template and follows it to the
longest accepted wording. So mandatory words must match exactly and in order, and words
only: punctuation and letter case do not count.

Templates of MIT, BSD and ISC come twice: whole, from the grant to the end of the disclaimer,
and as the opening clause alone, whose label ends in ``:partial``. A place where a whole
licence holds has no partial label of it; a licence that is cut off or changed after its
opening has only that one.

The base phrases are templates without regions; their places are counted.

Defined cases: null text counts as empty; a text without words has no labels and the
score 0; repeated rows are scanned row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

# The base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    '<<var;words=1-4>> and associated documentation <<beginOptional>>files (the "Software")<<endOptional>>, '
    "to deal in the <<var;words=1-2>> without restriction, including without limitation the rights to "
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var;words=1-2>>"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met"
)
_BSD_CONDITIONS = (
    "<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>> Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "<<beginOptional>>3<<endOptional>> Neither the name of <<var;words=1-10>> nor the names of "
    "<<var;words=1-3>> may be used to endorse or promote products derived from this software without specific "
    "prior written permission."
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY <<var;words=1-10>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL <<var;words=1-10>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
    "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
_ISC = (
    "Permission to use, copy, modify, <<beginOptional>>and/or<<endOptional>> distribute this software for any "
    "purpose with or without fee is hereby granted"
)
PARTIAL = ":partial"

#: Label and wording of the method's own templates.
TEMPLATES = (
    (
        "mit",
        f"{_MIT}, and to permit persons to whom the <<var;words=1-2>> is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice <<beginOptional>>(including "
        "the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the "
        "<<var;words=1-2>>. THE <<var;words=1-2>> IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1-10>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE <<var;words=1-2>> OR THE USE OR OTHER DEALINGS IN THE <<var;words=1-2>>",
    ),
    ("mit" + PARTIAL, _MIT),
    ("bsd-2", f"{_BSD} {_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("bsd-3", f"{_BSD} {_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("bsd" + PARTIAL, _BSD),
    (
        "isc",
        f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED AS IS AND <<var;words=1-4>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-4>> BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    ),
    ("isc" + PARTIAL, _ISC),
    ("mit", "<<beginOptional>>released or<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the <<var;words=1-1>>)<<endOptional>>",
    ),
    ("apache-2", "Apache <<beginOptional>>Software<<endOptional>> License <<beginOptional>>version<<endOptional>> 2.0"),
    (
        "gpl-3",
        "<<beginOptional>>This <<var;words=1-2>> is<<endOptional>> licensed under the <<beginOptional>>terms of the"
        "<<endOptional>> GNU General Public License, <<beginOptional>>as published by the Free Software Foundation,"
        "<<endOptional>> version 3 <<beginOptional>>or any later version<<endOptional>>",
    ),
    ("gpl-2", "GNU General Public License, <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 2"),
    ("lgpl", "GNU <<beginOptional>>Lesser<<endOptional>> Library General Public License"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl-3", "GNU Affero General Public License"),
    ("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> Creative Commons Attribution Non<<beginOptional>>-<<endOptional>>Commercial"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial <<var;words=0-2>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike <<var;words=0-2>> <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-sa", "licensed under CC BY-SA"),
    ("cc-by", "Creative Commons Attribution <<var;words=0-2>> <<beginOptional>>International<<endOptional>> License"),
    ("mpl-2", "<<beginOptional>>subject to the terms of the<<endOptional>> Mozilla Public License, <<beginOptional>>v.<<endOptional>> <<beginOptional>>version<<endOptional>> 2.0"),
)

OTHER = 0

_MARKUP = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var;words=(\d+)-(\d+)>>")

#: Separators become spaces and capitals small letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if common.LETTERS[b] else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass
class Automaton:
    symbols: dict[bytes, int]
    steps: list[list[int]]  # state, symbol -> state; state 0 is dead, 1 the start
    accepts: list[tuple[int, ...]]  # templates accepted in each state
    first: frozenset[bytes]  # words that leave the start alive


def _pieces(template: str) -> list:
    """Words as bytes, and markup as '(' , ')' and (least, most)."""
    out: list = []
    at = 0
    for mark in _MARKUP.finditer(template):
        out += words_of(template[at : mark.start()])
        out.append((int(mark[1]), int(mark[2])) if mark[1] else "(" if "begin" in mark[0] else ")")
        at = mark.end()
    return out + words_of(template[at:])


def compile_templates(templates: list[str]) -> Automaton:
    """One automaton that accepts every wording of every template."""
    edges: list[list[tuple[bytes | None, int]]] = [[]]  # word, or None for any word
    jumps: list[list[int]] = [[]]
    ends: dict[int, int] = {}

    def new() -> int:
        edges.append([])
        jumps.append([])
        return len(edges) - 1

    for number, template in enumerate(templates):
        at, opened = 0, []
        for piece in _pieces(template):
            if piece == "(":
                opened.append(at)
            elif piece == ")":
                jumps[opened.pop()].append(at)
            elif isinstance(piece, tuple):
                for i in range(piece[1]):
                    following = new()
                    edges[at].append((None, following))
                    if i >= piece[0]:
                        jumps[at].append(following)
                    at = following
            else:
                following = new()
                edges[at].append((piece, following))
                at = following
        ends[at] = number

    def closed(states) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for following in jumps[stack.pop()]:
                if following not in seen:
                    seen.add(following)
                    stack.append(following)
        return frozenset(seen)

    vocabulary = sorted({w for own in edges for w, _ in own if w is not None})
    symbols = {w: i for i, w in enumerate(vocabulary, start=1)}
    start = closed([0])
    known = {frozenset(): 0, start: 1}
    order, steps = [frozenset(), start], [[0] * (len(symbols) + 1)]
    while len(steps) < len(order):
        states, row = order[len(steps)], []
        for word in [None, *vocabulary]:
            target = closed({t for s in states for w, t in edges[s] if w is None or w == word})
            if target not in known:
                known[target] = len(order)
                order.append(target)
            row.append(known[target])
        steps.append(row)
    accepts = [tuple(sorted(ends[s] for s in states if s in ends)) for states in order]
    return Automaton(symbols, steps, accepts, frozenset(w for w, s in symbols.items() if steps[1][s]))


def scan(automaton: Automaton, words: list[bytes]) -> list[tuple[int, int, tuple[int, ...]]]:
    """(start, words, templates) of every place where a wording is accepted, per length."""
    found = []
    first, steps, accepts, symbols = automaton.first, automaton.steps, automaton.accepts, automaton.symbols
    for start in [i for i, w in enumerate(words) if w in first]:
        state, at = 1, start
        while state and at < len(words):
            state = steps[state][symbols.get(words[at], OTHER)]
            at += 1
            if accepts[state]:
                found.append((start, at - start, accepts[state]))
    return found


def labels_of(found: list[tuple[int, int, tuple[int, ...]]], names: list[str]) -> set[str]:
    """The labels of accepted wordings; a whole licence has no partial label of its own place."""
    at: dict[int, set[str]] = {}
    for start, _, accepted in found:
        at.setdefault(start, set()).update(names[t] for t in accepted)
    out = set()
    for own in at.values():
        whole = {label.split("-")[0] for label in own if not label.endswith(PARTIAL)}
        out |= {label for label in own if not label.endswith(PARTIAL) or label.removesuffix(PARTIAL) not in whole}
    return out


def _scan_rows(automaton: Automaton):
    labels = [label for label, _ in (*BASE, *TEMPLATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            out = []
            for i in range(batch.num_rows):
                words = words_of(column[i].as_py() or "")
                found = scan(automaton, words)
                base = [(start, t) for start, _, accepted in found for t in accepted if t < len(BASE)]
                starts = [start for start, _ in base]
                longest = max((size for _, size, _ in found), default=0)
                out.append(
                    (
                        len(words),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted({labels[t] for _, t in base})),
                        ",".join(sorted(labels_of(found, labels))),
                        float(1 - np.exp2(-longest / 3)),
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def licenses(docs: DataFrame) -> DataFrame:
    """Per row: words, places of the base phrases, labels, and a score that rises with the
    longest accepted wording (1 - 2 ** (-words / 3); 0 for none)."""
    automaton = compile_templates([text for _, text in (*BASE, *TEMPLATES)])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _scan_rows(automaton),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(common.table(spark, sf_dir, "documents"))
