"""License scans: templates with optional and replaceable regions, matched as token automata.

A template is mandatory wording with ``[[optional]]`` regions and replaceable regions: ``{{name}}`` stands for any number
of words, up to the next mandatory word wherever that is in the document, ``{{name:n}}`` for up to n words where the
wording itself has a fixed form (a version number).  It is compiled to an automaton over words; a text holds the license if the automaton accepts
some run of its words, so mandatory words must all be there, in order, exactly.  Automata start only where the
first two mandatory words stand, which is found for all documents of a block at once.

Words are lower-cased (A-Z) runs of ASCII letters and digits and non-ASCII bytes, compared by 64-bit hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from telequal.llm import text as tx

#: Phrases that always count, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met [[1]] redistributions of source code must retain the above copyright "
    "notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must "
    "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution "
)
_BSD_3 = (
    "[[3]] neither the name of {{holder}} nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission "
)
_BSD_END = (
    "this software is provided by {{holder}} as is and any express or implied warranties including but not limited to "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    "{{holder}} be liable for any direct indirect incidental special exemplary or consequential damages including but "
    "not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence "
    "or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)

#: The whole mandatory wording of public licenses, and short notices under templates of their own.
#: {{name}} is replaceable by any words, {{name:n}} by up to n, [[...]] may be absent.
TEMPLATES = {
    "mit": [
        "released under the [[terms of the]] mit license",
        "licensed under the [[terms of the]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice [[including the next paragraph]] shall be included in all "
        "copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular "
        "purpose and noninfringement in no event shall {{holder}} be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or "
        "the use or other dealings in the software",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license [[you may obtain a copy of the license at {{address}}]] unless required by applicable "
        "law or agreed to in writing software distributed under the license is distributed on an as is basis without "
        "warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license",
        "apache license version 2 0 january 2004",
    ],
    "gpl-2.0": [
        "licensed under the gnu general public license version 2",
        "gnu general public license version 2 june 1991",
    ],
    "gpl-3.0": [
        "licensed under the gnu general public license version 3",
        "gnu general public license version 3 29 june 2007",
        "it under the terms of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
    ],
    "lgpl": ["gnu lesser general public license [[version {{number:2}}]]"],
    "agpl-3.0": ["gnu affero general public license [[version 3]]"],
    "bsd": ["licensed under the bsd [[{{clauses:2}}]] license"],
    "bsd-2-clause": [_BSD + _BSD_END],
    "bsd-3-clause": [_BSD + _BSD_3 + _BSD_END],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and {{holder}} disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall {{holder}} be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
        "use or performance of this software",
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0", "mozilla public license version 2 0"],
    "cc-by-nc": ["licensed under [[a]] cc by nc [[{{version:2}}]]", "creative commons attribution noncommercial"],
    "cc-by-sa": ["licensed under [[a]] cc by sa [[{{version:2}}]]", "creative commons attribution sharealike"],
    "cc-by-4.0": ["licensed under [[a]] cc by 4 0", "creative commons attribution 4 0 international"],
    "cc0-1.0": ["cc0 1 0 universal"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "copyright": ["copyright [[c]] {{holder}} all rights reserved"],
}
SCANNED = "n_words long, places array<struct<label: string, start: long, end: long, base: boolean>>"

# A state of an automaton: words that lead on, by hash; whether any word leads on, and where; free moves; the end.
State = tuple[dict[int, int], int | None, list[int]]


def word_hashes(phrase: str) -> np.ndarray:
    data = phrase.encode()
    block = tx.Block(pa.RecordBatch.from_arrays([pa.array([0])], names=["x"]), [data])
    first, last, _ = block.words(tx.ALNUM)
    return block.hashes(first, last)


class Automaton:
    """A compiled template.  It begins with two mandatory words at least, which find where to start it."""

    def __init__(self, label: str, template: str) -> None:
        self.label = label
        self.states: list[State] = []
        self.words = 0
        parts = re.findall(r"\[\[|\]\]|\{\{\w+(?::\d+)?\}\}|[^\s\[\]{}]+", template)
        self.final = self._build(iter(parts), self._state())
        lead = parts[: next((i for i, p in enumerate(parts) if p[0] in "[{"), len(parts))]
        if len(lead) < 1:
            raise ValueError(f"a template must begin with a mandatory word: {template!r}")
        self.lead = word_hashes(" ".join(lead))[:2]

    def _state(self) -> int:
        self.states.append(({}, None, []))
        return len(self.states) - 1

    def _build(self, parts, at: int) -> int:
        for p in parts:
            if p == "]]":
                return at
            if p == "[[":
                inner = self._build(parts, self._enter(at))
                out = self._state()
                self.states[inner][2].append(out)
                self.states[at][2].append(out)
                at = out
            elif p.startswith("{{"):
                out = self._state()
                if ":" not in p:
                    loop = self._enter(at)
                    self.states[loop] = ({}, loop, [out])
                    at = out
                    continue
                for _ in range(int(p[2:-2].partition(":")[2])):
                    nxt = self._state()
                    words, _, free = self.states[at]
                    self.states[at] = (words, nxt, [*free, out])
                    at = nxt
                self.states[at][2].append(out)
                at = out
            else:
                for h in word_hashes(p).tolist():
                    nxt = self._state()
                    self.states[at][0][h] = nxt
                    at = nxt
                    self.words += 1
        return at

    def _enter(self, at: int) -> int:
        inner = self._state()
        self.states[at][2].append(inner)
        return inner

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.states[todo.pop()][2]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: np.ndarray, memo: dict | None = None, at: int = 0) -> int:
        """Words of the longest accepted run that begins at place ``at`` of ``words``; 0 if none is accepted.

        A region of any length goes on at once to the next place of a word that leads out of it.  What follows from
        there is the same for all beginnings, so it is kept in ``memo``, one for each document.
        """
        memo = {} if memo is None else memo
        here, best, n, passed = self._closed({0}), 0, at, []
        while n < len(words):
            loops = {s for s in here if self.states[s][1] == s}
            if loops and here == self._closed(set(loops)):
                waiting = frozenset(here)
                if waiting not in memo:
                    out = [w for s in here for w in self.states[s][0]]
                    memo[waiting] = np.flatnonzero(np.isin(words, np.array(out, np.uint64)))
                places = memo[waiting]
                k = int(np.searchsorted(places, n))
                if k == len(places):
                    break
                n = int(places[k])
                if (waiting, n) in memo:
                    best = memo[waiting, n] or best
                    break
                passed.append((waiting, n))
            there, w = set(), int(words[n])
            for s in here:
                by_word, any_word, _ = self.states[s]
                if w in by_word:
                    there.add(by_word[w])
                if any_word is not None:
                    there.add(any_word)
            if not there:
                break
            n += 1
            here = self._closed(there)
            if self.final in here:
                best = n
        for waiting, place in passed:
            memo[waiting, place] = best if best > place else 0
        return best - at if best else 0


def _starts(words: np.ndarray, stop: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand one after another within one document."""
    at = np.flatnonzero(words == phrase[0])
    at = at[at + len(phrase) <= stop[at]] if len(at) else at
    for t in range(1, len(phrase)):
        at = at[words[at + t] == phrase[t]]
    return at


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words`` and ``places``: label, first word, end, and whether a base phrase gave it.

    A null or empty text has no words and no places.  Rows repeat as they come; an empty table gives an empty
    result.  Columns of ``docs`` named like the added ones are replaced, others (or those in ``carry``) pass through.
    Every accepted run counts, with its longest reading; runs of several templates may overlap.
    """
    templates = TEMPLATES if templates is None else templates
    added = T.StructType.fromDDL(SCANNED)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added.names]
    base = docs.select(*dict.fromkeys([*carry, "text"]))
    schema = T.StructType([*[base.schema[c] for c in carry], *added.fields])

    def run(batches):
        phrases = [(label, word_hashes(p)) for p, label in PHRASES.items()]
        automata = [Automaton(label, t) for label, many in templates.items() for t in many]
        for block in tx.blocks(batches, size=2 * tx.BLOCK_BYTES):
            first, last, row = block.words(tx.ALNUM)
            words = block.hashes(first, last)
            at = tx.offsets(row, len(block))
            stop = at[1:][row]
            found: list[tuple[int, int, str, bool]] = []
            for label, phrase in phrases:
                found += [(s, s + len(phrase), label, True) for s in _starts(words, stop, phrase).tolist()]
            for a in automata:
                memo, begin = {}, -1
                for s in _starts(words, stop, a.lead).tolist():
                    if at[row[s]] != begin:
                        memo, begin = {}, int(at[row[s]])
                    if n := a.longest(words[begin : stop[s]], memo, s - begin):
                        found.append((s, s + n, a.label, False))
            found.sort()
            doc = row[[f[0] for f in found]] if found else np.zeros(0, np.int64)
            places = pa.StructArray.from_arrays(
                [
                    pa.array([f[2] for f in found], pa.string()),
                    pa.array([f[0] for f in found] - at[doc], pa.int64()),
                    pa.array([f[1] for f in found] - at[doc], pa.int64()),
                    pa.array([f[3] for f in found], pa.bool_()),
                ],
                names=["label", "start", "end", "base"],
            )
            yield tx.with_columns(
                block.batch,
                n_words=pa.array(np.diff(at)),
                places=tx.lists(places, np.bincount(doc, minlength=len(block))),
            ).select(schema.names)

    return base.mapInArrow(run, schema)
