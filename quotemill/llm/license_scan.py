"""Licence scan by a generalised suffix automaton.

The automaton of all template texts is built once from their words. A text's words are streamed through it: at
each word it knows the longest run that ends there and stands in some template (matching statistics). Long runs
are matched to their place in a template, and runs in the same order are chained to covered template spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.tokens import ALNUM, Words, as_bytes, groups_of

# The phrases of the base and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Template texts (notices and passages of public licences), with the label that they show.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def template_words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass(frozen=True)
class LicenceScan:
    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    #: Words of the shortest run that counts as a match; words that may lie between chained runs.
    min_run: int = 4
    max_gap: int = 12
    #: A template's label needs so many covered words, and so much of the template.
    min_covered: int = 5
    min_share: float = 0.6
    #: Of the labels whose spans share words, those that cover at least so much of the most that one covers stay.
    rival_share: float = 0.95


@dataclass
class SuffixAutomaton:
    """States of all runs of the given word sequences."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
                continue
            new, p = self._state(self.length[last] + 1), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def matching_statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """Of each word: the length of the longest run that ends there, and its state."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            else:
                length = 0
            yield length, state


def maximal_runs(automaton: SuffixAutomaton, words: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start, length, state) of runs of at least ``least`` words that can't be extended to the right."""
    out, before = [], (0, 0)
    for at, (length, state) in enumerate([*automaton.matching_statistics(words), (0, 0)]):
        if length <= before[0] and before[0] >= least:
            out.append((at - before[0], before[0], before[1]))
        before = (length, state)
    return out


def chained(runs: list[tuple[int, int, int]], max_gap: int) -> tuple[int, int, int]:
    """The best chain of (text start, template start, length): covered words, first and last text word.

    Runs are in text order. A chain goes forward in text and template and leaves no gap over ``max_gap``. Every run
    that may come before is tried: none that starts so early that even the longest run would end too far off.
    """
    best: list[tuple[int, int]] = []
    top, longest = (0, -1, -1), max((n for _, _, n in runs), default=0)
    for i, (at, of, n) in enumerate(runs):
        score, first = n, at
        for j in range(i - 1, -1, -1):
            p_at, p_of, p_n = runs[j]
            if p_at + longest + max_gap < at:
                break
            over = max(0, p_at + p_n - at, p_of + p_n - of)
            near = at - (p_at + p_n) <= max_gap and of - (p_of + p_n) <= max_gap
            if near and at > p_at and of > p_of and over < n and best[j][0] + n - over > score:
                score, first = best[j][0] + n - over, best[j][1]
        best.append((score, first))
        if score > top[0]:
            top = (score, first, at + n - 1)
    return top


class Scanner:
    """Templates and phrases by word number, and the scan of a group of texts. Built once in each task."""

    def __init__(self, scan: LicenceScan):
        self.scan = scan
        self.labels = [label for label, _ in scan.templates]
        texts = [template_words(text) for _, text in scan.templates]
        phrases = [template_words(text) for text, _ in scan.phrases]
        vocabulary = sorted({w for t in [*texts, *phrases] for w in t})
        numbers = {w: k for k, w in enumerate(vocabulary)}
        # The hash of a word is that of a text which has only it.
        hashes = np.array([next(groups_of([w], ALNUM)).hashes[0] for w in vocabulary], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.numbered = [[numbers[w] for w in t] for t in texts]
        self.phrases = [np.array([numbers[w] for w in p]) for p in phrases]
        self.automaton = SuffixAutomaton()
        for t in self.numbered:
            self.automaton.add(t)
        self.places = self._places()

    def _places(self) -> dict[tuple[int, ...], list[tuple[int, int]]]:
        """(template, start) of every run of ``min_run`` words."""
        out: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        n = self.scan.min_run
        for k, t in enumerate(self.numbered):
            for a in range(len(t) - n + 1):
                out.setdefault(tuple(t[a : a + n]), []).append((k, a))
        return out

    def known(self, words: Words) -> np.ndarray:
        """The number of each word, -1 if no template or phrase has it."""
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words.hashes, self.order[at], -1)

    def base(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(start, phrase) of every place where a phrase's words stand consecutively."""
        out = []
        for k, phrase in enumerate(self.phrases):
            n = len(numbers) - len(phrase) + 1
            if n > 0:
                at = np.flatnonzero(numbers[:n] == phrase[0])
                for o in range(1, len(phrase)):
                    at = at[numbers[at + o] == phrase[o]]
                out += [(int(a), k) for a in at]
        return out

    def covered(self, numbers: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """By template: covered words, first and last word of the text in its best chain."""
        runs: dict[int, list[tuple[int, int, int]]] = {}
        seq = numbers.tolist()
        inside = np.concatenate(([0], (numbers >= 0).astype(np.int8), [0]))
        edges = np.diff(inside)
        for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if b - a < self.scan.min_run:
                continue
            for start, length, _ in maximal_runs(self.automaton, seq[a:b], self.scan.min_run):
                self._place(seq, a + start, length, runs)
        return {k: chained(sorted(set(r)), self.scan.max_gap) for k, r in runs.items()}

    def spans(self, numbers: np.ndarray) -> list[tuple[str, float, int, int]]:
        """(label, covered share, first, last word) of the templates that count, without those that a rival explains better."""
        found = []
        for k, (n, first, last) in self.covered(numbers).items():
            size = len(self.numbered[k])
            if n >= min(self.scan.min_covered, size) and n >= self.scan.min_share * size:
                found.append((self.labels[k], min(1.0, n / size), first, last, n))
        most = lambda x: max(y[4] for y in found if y[2] <= x[3] and x[2] <= y[3])
        return [x[:4] for x in found if x[4] >= self.scan.rival_share * most(x) or x[1] == 1.0]

    def _place(self, seq: list[int], at: int, length: int, runs: dict[int, list[tuple[int, int, int]]]) -> None:
        n = self.scan.min_run
        for k, a in self.places.get(tuple(seq[at : at + n]), []):
            t = self.numbered[k]
            if a + length <= len(t) and t[a : a + length] == seq[at : at + length]:
                runs.setdefault(k, []).append((at, a, length))


def scan_licences(documents: DataFrame, scan: LicenceScan = LicenceScan()) -> DataFrame:
    """One row for each document: base phrases, template spans, labels and score.

    Columns: doc_id, n_words, n_base (places of phrases), first_word, last_word (their smallest and largest
    start), base_labels, labels (base and templates; sorted, comma-joined, '' if none), score (the largest
    covered share of a template that gives a label, else 1 for a base label, else 0), spans (label:first-last
    words of the text, space-joined). Null and empty texts have no words; repeated rows get a row each; other
    columns are left out; an empty table gives an empty result. Whole texts are streamed.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(scan)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for words in groups_of(as_bytes(batch["text"]), ALNUM):
                numbers = scanner.known(words)
                for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                    own = numbers[a:b]
                    base = scanner.base(own) if len(own) else []
                    found = {scan.phrases[k][1] for _, k in base}
                    score, labels, spans = 1.0 if base else 0.0, set(found), []
                    for label, share, first, last in scanner.spans(own) if len(own) else []:
                        labels.add(label)
                        score = max(score, share)
                        spans.append(f"{label}:{first}-{last}")
                    out["n_words"].append(len(own))
                    out["n_base"].append(len(base))
                    out["first_word"].append(min(base)[0] if base else None)
                    out["last_word"].append(max(base)[0] if base else None)
                    out["base_labels"].append(",".join(sorted(found)))
                    out["labels"].append(",".join(sorted(labels)))
                    out["score"].append(score)
                    out["spans"].append(" ".join(sorted(spans)))
            kinds = {"score": pa.float64(), "base_labels": pa.string(), "labels": pa.string(), "spans": pa.string()}
            columns = {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **columns})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    return docs.mapInArrow(rows, schema)
