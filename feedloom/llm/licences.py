"""Licence scans: phrases, and templates with optional and replaceable wording.

A template is text with markup: ``[[...]]`` may be missing, ``{{n}}`` stands for up to n words of any kind; both may stand inside
``[[...]]``. Each is compiled into an automaton over words. A text is accepted where all mandatory words follow each other exactly,
whatever fills the replaceable places. Automata start only where a template's first two words stand, which are found
for all texts of a slice at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import blocks
from feedloom.llm.decontaminate import BREAK, LOWER
from feedloom.llm.words import word_names, words

#: Phrases that count wherever they stand, and their labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Grants and notices of well-known licences, and three whole ones, as templates (fixed values).
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[,]] version 2.0 [[(the license)]]",
    "mit": "released under [[the terms of]] the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of {{4}} and associated documentation files",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that",
    "isc-grant": "permission to use copy modify [[and/or]] [[and]] distribute this software for any purpose with or without fee is hereby granted",
    "gpl-2.0": "licensed under [[the terms of]] the gnu general public license [[,]] [[as published by the free software foundation]] [[,]] version 2",
    "gpl-3.0": "licensed under [[the terms of]] the gnu general public license [[,]] [[as published by the free software foundation]] [[,]] version 3",
    "gpl-notice": "redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] general public license as published by the free software foundation",
    "lgpl": "under the terms of the gnu lesser general public license",
    "agpl": "under the terms of the gnu affero general public license",
    "mpl-2.0": "subject to the terms of the mozilla public license [[,]] v 2.0",
    "cc-by-4.0": "licensed under [[a]] [[the]] [[creative commons]] cc by 4.0",
    "cc-by-sa-4.0": "licensed under [[a]] [[the]] [[creative commons]] cc by sa 4.0",
    "cc-by-nc-4.0": "licensed under [[a]] [[the]] [[creative commons]] cc by nc 4.0",
    "cc-by-text": "licensed under [[a]] [[the]] creative commons attribution {{3}} 4.0 international license",
    "cc0-1.0": "dedicated to the public domain under [[the]] cc0 1.0",
    "mit-text": (
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the "
        "software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, "
        "and to permit persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission notice "
        "[[(including the next paragraph)]] shall be included in all copies or substantial portions of the software. the software is provided as is, without warranty of any kind, "
        "express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall "
        "{{12}} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software "
        "or the use or other dealings in the software"
    ),
    "isc-text": (
        "permission to use, copy, modify, [[and/or]] [[and]] distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies. the software is provided as is and {{12}} disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness. in no event shall {{12}} be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting "
        "from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"
    ),
    "bsd-text": (
        "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: [[1]] [[a]] "
        "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. [[2]] [[b]] redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "[[[[3]] [[c]] neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission]] this software is provided by {{12}} as is and any express or implied warranties, including, but not limited to, the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "proprietary": "unauthorized copying of this {{3}} via any medium is strictly prohibited",
}

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"\[\[|\]\]|\{\{.*?\}\}|\{\{|\}\}", re.S)


def _words(text: str) -> list[bytes]:
    return _WORD.findall(bytes(LOWER[np.frombuffer(text.encode(), np.uint8)]))


class Automaton:
    """States in a row; a word leads from a state to the next where it is the one expected, and markup adds ways
    without a word or with any."""

    def __init__(self, template: str):
        self.words: list[bytes | None] = []
        self.free: dict[int, set[int]] = {}
        begun, at = [], 0
        for mark in _MARK.finditer(template):
            self.words += _words(template[at : mark.start()])
            at, start = mark.end(), len(self.words)
            if mark[0] == "[[":
                begun.append(start)
            elif mark[0] == "]]":
                if not begun:
                    raise ValueError("]] without [[")
                if begun[-1] < start:
                    self.free.setdefault(begun[-1], set()).add(start)
                begun.pop()
            else:
                count = mark[0][2:-2].strip()
                if not (count.isascii() and count.isdigit()):
                    raise ValueError(f"a number between braces is wanted, not {mark[0]!r}")
                self.words += [None] * int(count)
                for i in range(start, len(self.words)):
                    self.free.setdefault(i, set()).add(len(self.words))
        if begun:
            raise ValueError("[[ without ]]")
        self.words += _words(template[at:])
        if len(self.words) < 2 or None in self.words[:2] or 0 in self.free or 1 in self.free:
            # The second word may follow an optional part, but then the first alone opens the template.
            self.opening = self.words[:1]
        else:
            self.opening = self.words[:2]
        if not self.words or self.words[0] is None or 0 in self.free:
            raise ValueError("a template starts with a mandatory word")

    def _spread(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for to in self.free.get(todo.pop(), ()):
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def accepts(self, tokens: Iterator[bytes]) -> bool:
        """Whether the words begin with a text of this template."""
        states, end = self._spread({0}), len(self.words)
        for token in tokens:
            states = self._spread({s + 1 for s in states if s < end and (self.words[s] is None or self.words[s] == token)})
            if end in states:
                return True
            if not states:
                break
        return False


def _name(word: bytes) -> np.uint64:
    data = np.frombuffer(word, np.uint8)
    return word_names(data, np.array([0]), np.array([len(data)]))[0]


def _runs(names: np.ndarray, pattern: list[bytes]) -> np.ndarray:
    """Where the pattern's words stand one after the other."""
    at = np.flatnonzero(names[: len(names) - len(pattern) + 1] == _name(pattern[0])) if len(names) >= len(pattern) else np.empty(0, np.int64)
    for k, word in enumerate(pattern[1:], 1):
        at = at[names[at + k] == _name(word)]
    return at


def _scan(batches: Iterator[pa.RecordBatch], phrases: Mapping[str, str], templates: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    base = [(_words(p), label) for p, label in phrases.items()]
    automata = [(Automaton(t), label) for label, t in templates.items()]
    for batch in batches:
        buffer, offsets = blocks.text_offsets(batch.column("text"))
        rows = batch.num_rows
        n_words, n_base = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        first, last = np.full(rows, 1 << 62, np.int64), np.full(rows, -1, np.int64)
        basic, extra = [set() for _ in range(rows)], [set() for _ in range(rows)]
        for begin, stop in blocks.slices(batch.column("text")):
            text = LOWER[buffer[offsets[begin] : offsets[stop]]]
            found = words(text, offsets[begin : stop + 1] - offsets[begin], BREAK)
            names, begins = found.names(), found.begins
            n_words[begin:stop] = np.diff(begins)
            for pattern, label in base:
                at = _runs(names, pattern)
                doc = np.searchsorted(begins, at, "right") - 1
                inside = at + len(pattern) <= begins[doc + 1]
                at, doc = at[inside], doc[inside]
                np.add.at(n_base, begin + doc, 1)
                np.minimum.at(first, begin + doc, at - begins[doc])
                np.maximum.at(last, begin + doc, at - begins[doc])
                for d in np.unique(doc).tolist():
                    basic[begin + d].add(label)
            for automaton, label in automata:
                for at in _runs(names, automaton.opening).tolist():
                    doc = int(np.searchsorted(begins, at, "right")) - 1
                    tokens = (text[found.start[i] : found.end[i]].tobytes() for i in range(at, int(begins[doc + 1])))
                    if label not in extra[begin + doc] and automaton.accepts(tokens):
                        extra[begin + doc].add(label)
        none = n_base == 0
        score = [1.0 if e else 0.5 if b else 0.0 for b, e in zip(basic, extra, strict=True)]
        arrays = [
            batch.column("doc_id"),
            pa.array(n_words),
            pa.array(n_base),
            pa.array(first, mask=none),
            pa.array(last, mask=none),
            pa.array([",".join(sorted(b)) for b in basic], pa.string()),
            pa.array([",".join(sorted(b | e)) for b, e in zip(basic, extra, strict=True)], pa.string()),
            pa.array(score, pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """Licence wording of every row.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. ``n_base``, ``first_word`` and
    ``last_word`` count and place the phrases; ``base_labels`` are the labels of phrases found, ``labels`` those of
    phrases and templates, distinct, in order, with commas. ``score`` is 1 if a template's wording is there in full,
    0.5 if only phrases are, else
    0. A template must start with a mandatory word; its punctuation counts for nothing, and unpaired markup is an error.

    Null and empty texts have no words, no labels, null places and score 0. Each row is judged by itself: repeated and
    null ids give a row each. Texts are read whole. An empty table gives no rows. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    return texts.mapInArrow(lambda b: _scan(b, phrases, templates), schema)
