"""Licence scans by a generalised suffix automaton of licence tokens.

The words of all templates go into one automaton.  A text is streamed through it: at each word the
automaton gives the matching statistic, the length of the longest run of words ending there that some
template contains.  Runs that cannot be lengthened are matches; matches that lie in one order in a text
and in a template are chained, and a chain that covers enough of a template is a span with its label.

A match has at least ``LEAST`` words, so only stretches of that many words that templates use are streamed;
the rest cannot hold a match.  Tasks read texts in pieces of documents, whole documents each; nothing is shuffled.

Defined results: null and empty texts have no words, null places, empty labels and score 0; repeated rows and null ids
are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.textops import MARKS, chunks, words

#: Phrases of the base contract and their labels (fixed values).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Licence texts and notices in common use, as (label, text) (fixed values).
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to
in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
#: Least words of a match, and most words between two matches of a chain.
LEAST, GAP = 3, 12
#: A span covers this share of a template, and all of one under SHORT words, where a word tells licences apart.
COVERED, SHORT = 0.8, 20


class Automaton:
    """Suffix automaton of several word sequences: states with lengths and links, and the places where each state's longest run ends."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            at = 0
            for place, word in enumerate(sequence):
                at = self._extend(at, word)
                self.ends[at].append((number, place + 1))
        # a state ends wherever the states that link to it end
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]] = sorted(set(self.ends[self.link[s]]) | set(self.ends[s]))
        self.ends[0] = []

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, at: int, word: int, held: int) -> int:
        """State of the run that ``at`` and ``word`` make, cut out of ``held``, which stands for longer ones as well."""
        if self.length[held] == self.length[at] + 1:
            return held
        copy = self._state(self.length[at] + 1, dict(self.next[held]), self.link[held])
        self.link[held] = copy
        while at >= 0 and self.next[at].get(word) == held:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word, self.next[at][word])
        return new

    def statistics(self, sequence: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(length, state) of the longest run that ends at each word."""
        at, length = 0, 0
        for word in sequence:
            while at and word not in self.next[at]:
                at = self.link[at]
                length = self.length[at]
            if (to := self.next[at].get(word)) is not None:
                at, length = to, length + 1
            yield length, at


class Scanner:
    """Templates and phrases, compiled; one for each worker process."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for _, label in phrases]
        texts = [t for _, t in templates] + [p for p, _ in phrases]
        w = words(texts, True, MARKS)
        self.vocabulary, ids = np.unique(w.hashes(), return_inverse=True)
        parts = [ids[a:b].tolist() for a, b in zip(w.first, w.first[1:])]
        self.templates, self.phrases = parts[: len(templates)], parts[len(templates) :]
        self.automaton = Automaton(self.templates)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the templates' vocabulary; -1: in none."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def matches(self, sequence: list[int]) -> list[tuple[int, int, int, int]]:
        """(template, first word of the text, first word of the template, length) of the runs that no further word lengthens."""
        out, told = [], list(self.automaton.statistics(sequence))
        for i, (length, state) in enumerate(told):
            if length >= LEAST and (i + 1 == len(told) or told[i + 1][0] <= length):
                for number, end in self.automaton.ends[state]:
                    out.append((number, i + 1 - length, end - length, length))
        return out

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, float]]:
        """(first word, end, template, covered share) of the best chain that ends with each match of a template, where it covers enough."""
        found = []
        by: dict[int, list[tuple[int, int, int]]] = {}
        for number, a, t, length in matches:
            by.setdefault(number, []).append((a, t, length))
        for number, mine in by.items():
            mine.sort()
            size = len(self.templates[number])
            best: list[tuple[int, int]] = []  # words covered, first word
            low = 0
            for i, (a, t, length) in enumerate(mine):
                cover, first = length, a
                while low < i and mine[low][0] + size + GAP < a:
                    low += 1
                for j in range(low, i):
                    b, u, n = mine[j]
                    # words that both hold count once; both orders must agree
                    over = max(0, b + n - a, u + n - t)
                    if b < a and u < t and a - (b + n) <= GAP and over < length and best[j][0] + length - over > cover:
                        cover, first = best[j][0] + length - over, best[j][1]
                best.append((cover, first))
                if cover >= (COVERED * size if size >= SHORT else size):
                    found.append((first, a + length, number, min(1.0, cover / size)))
        return found

    def scan(self, texts: list[str]) -> list[dict]:
        w = words(texts, True, MARKS)
        ids = self.ids(w.hashes()) if len(w.starts) else np.zeros(0, np.int64)
        doc = w.doc_of()
        out = [{"n_words": int(n), "base": [], "spans": []} for n in w.counts]
        for label, phrase in zip(self.phrase_labels, self.phrases):
            hit = np.ones(max(0, len(ids) - len(phrase) + 1), bool)
            for k, word in enumerate(phrase):
                hit &= ids[k : k + len(hit)] == word
            for i in np.flatnonzero(hit):
                if doc[i] == doc[i + len(phrase) - 1]:
                    out[doc[i]]["base"].append((int(i - w.first[doc[i]]), label))
        # stretches of known words within a text
        known = ids >= 0
        edge = np.flatnonzero(np.concatenate(([True], (known[1:] != known[:-1]) | (doc[1:] != doc[:-1]), [True]))) if len(ids) else np.zeros(0, int)
        matches: dict[int, list] = {}
        for a, b in zip(edge[:-1], edge[1:]):
            if known[a] and b - a >= LEAST:
                d, first = int(doc[a]), int(a - w.first[doc[a]])
                for number, i, t, length in self.matches(ids[a:b].tolist()):
                    matches.setdefault(d, []).append((number, first + i, t, length))
        for d, found in matches.items():
            out[d]["spans"] = self.spans(found)
        return out


_scanners: dict[tuple, Scanner] = {}


def scanner_of(templates: tuple, phrases: tuple) -> Scanner:
    """The worker's scanner; kept between tasks."""
    key = (templates, phrases)
    if key not in _scanners:
        _scanners[key] = Scanner(templates, phrases)
    return _scanners[key]


def _joined(labels: set[str]) -> str:
    return ",".join(sorted(labels))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``spans``: chains as (first_word, end_word, label, covered), the widest of those of a label that overlap.  ``score``: the largest covered share of a template.
    """
    templates, phrases = tuple(map(tuple, templates)), tuple(map(tuple, phrases))
    table = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = table.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<first_word:bigint,end_word:bigint,label:string,covered:double>>"
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("covered", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(templates, phrases)
        for b in batches:
            found = [x for _, texts in chunks(range(b.num_rows), b.column(1).to_pylist()) for x in scanner.scan(texts)]
            rows: list[tuple] = []
            for x in found:
                places = [i for i, _ in x["base"]]
                base = {label for _, label in x["base"]}
                spans: list[dict] = []
                for first, end, number, covered in sorted(x["spans"], key=lambda s: (s[2], s[0] - s[1])):
                    label = scanner.labels[number]
                    if not any(s["label"] == label and s["first_word"] < end and first < s["end_word"] for s in spans):
                        spans.append({"first_word": first, "end_word": end, "label": label, "covered": covered})
                spans.sort(key=lambda s: (s["first_word"], s["label"]))
                score = max((s[3] for s in x["spans"]), default=0.0)
                rows.append((x["n_words"], len(places), min(places, default=None), max(places, default=None), _joined(base), _joined(base | {s["label"] for s in spans}), score, spans))
            columns = [*zip(*rows)] or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return table.mapInArrow(run, schema)
