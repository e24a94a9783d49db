"""Licence scan: matching statistics on a generalised suffix automaton of template words, chained into covered spans."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import alnum_split

# Phrases of the base labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences and key paragraphs of public licences and of their usual notices.
TEMPLATES = (
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mit-grant", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mit-grant", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("lgpl-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
)
LONG = 4  # words of a match that counts
GAP = 3  # words that may lie between two matches of one chain
COVER = 0.8  # share of a template's words that its label takes


class Automaton:
    """Generalised suffix automaton over word sequences; `ends` holds each state's (text, end position) pairs."""

    def __init__(self, texts: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set] = [set()]
        for number, words in enumerate(texts):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].add((number, at + 1))
        for s in sorted(range(1, len(self.link)), key=lambda x: -self.length[x]):
            self.ends[self.link[s]] |= self.ends[s]
        self.ends[0] = set()
        #: texts that a match in this state may end with as a whole
        self.whole: list[tuple] = [()] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=lambda x: self.length[x]):
            own = {n for n, stop in self.ends[s] if stop == len(texts[n]) <= self.length[s]}
            self.whole[s] = tuple(sorted(own | set(self.whole[self.link[s]])))

    def _state(self, length: int, copy: int | None = None) -> int:
        self.next.append({} if copy is None else dict(self.next[copy]))
        self.link.append(-1 if copy is None else self.link[copy])
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        clone = self._state(self.length[p] + 1, q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) where the longest suffix of words[:end] that some template holds has a word or more."""
        state = length = 0
        nxt, link, size = self.next, self.link, self.length
        root = nxt[0]
        for i, w in enumerate(words):
            if not state:
                if w not in root:
                    continue
            else:
                while state and w not in nxt[state]:
                    state = link[state]
                    length = size[state]
                if w not in nxt[state]:
                    length = 0
                    continue
            state = nxt[state][w]
            length += 1
            yield i + 1, length, state


def scan(words: list[bytes], auto: Automaton, texts: list[list[bytes]], n_phrases: int, long: int, gap: int, cover: float) -> tuple[list, list]:
    """Places (phrase, start) and spans (template, start, stop, share covered) of one text."""
    places, runs, whole = [], [], set()
    before = None  # a match that may still grow
    for end, length, state in auto.statistics(words):
        if before and (end != before[0] + 1 or length != before[1] + 1):
            runs.append(before)
        before = (end, length, state) if length >= long else None
        for number in auto.whole[state]:
            if number < n_phrases and len(texts[number]) <= length:
                places.append((number, end - len(texts[number])))
            elif long <= len(texts[number]) <= length:
                whole.add((number, end - len(texts[number]), end))  # also where the words after it go on in another template
    if before:
        runs.append(before)
    chains: dict[int, list] = {}  # template -> [start, stop, template stop, covered]
    spans = []

    def close(number: int) -> None:
        start, stop, _, covered = chains.pop(number)
        share = covered / len(texts[number])
        if share >= cover:
            spans.append((number, start, stop, min(1.0, share)))

    for end, length, state in sorted(runs):
        for number, stop in sorted(auto.ends[state]):
            if number < n_phrases:
                continue
            begin = end - length
            chain = chains.get(number)
            if chain and begin >= chain[1] and begin - chain[1] <= gap and stop - length >= chain[2]:
                chain[1], chain[2], chain[3] = end, stop, chain[3] + length
                continue
            if chain and end <= chain[1]:
                continue
            if chain and length <= chain[3] and begin < chain[1]:
                continue
            if chain:
                close(number)
            chains[number] = [begin, end, stop, length]
    for number in list(chains):
        close(number)
    spans = [s for s in spans if s[:3] not in whole] + [(*w, 1.0) for w in whole]
    return places, sorted(spans, key=lambda s: (*s[1:], s[0]))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: tuple = PHRASES, templates: tuple = TEMPLATES, long: int = LONG, gap: int = GAP, cover: float = COVER) -> DataFrame:
    """(doc_id, n_words, places array<struct<label, start, n>>, spans array<struct<label, start, stop, share>>) per input row.

    Texts are streamed word by word; a chain joins matches of at least `long` words that follow each other in one template
    with at most `gap` foreign words between; a template of at least `long` words that stands whole is a span whatever
    follows it. Null and empty texts have no word, place or span; repeated rows each keep a
    row; a null doc_id stays null; an empty table gives no row. Texts are read whole, however long, in one pass. Other
    columns are not read.
    """
    texts = [alnum_split(t) for t, _ in phrases] + [alnum_split(t) for _, t in templates]
    labels = [label for _, label in phrases] + [label for label, _ in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Automaton(texts)
        place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("n", pa.int64())]))
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("share", pa.float64())]))
        for b in batches:
            n, ps, ss = [], [], []
            for t in b.column(1):
                words = alnum_split(t.as_py())
                places, spans = scan(words, auto, texts, len(phrases), long, gap, cover)
                n.append(len(words))
                ps.append([{"label": labels[i], "start": s, "n": len(texts[i])} for i, s in places])
                ss.append([{"label": labels[i], "start": s, "stop": e, "share": c} for i, s, e, c in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ps, place), pa.array(ss, span)], names=["doc_id", "n_words", "places", "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, places array<struct<label string, start long, n long>>, spans array<struct<label string, start long, stop long, share double>>"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
