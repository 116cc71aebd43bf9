"""Licence scans by a positional index of rare licence words.

The templates below are indexed by word: which template has it, at which position.  Document frequencies of the
templates' words are counted over the whole corpus.  Of each file its licence words with the highest IDF are looked up,
as many as give every template that is possible there ``RARE_WORDS`` of its words.  Each posting proposes where its
template would begin; beginnings that several rare words give, and that differ by no more than ``DRIFT`` (words were put
in or left out between them), are intersected to a stretch of the file.  There the template's words are aligned in
order, and it is found when enough of them stand there and all of its mandatory phrases do, each in order and with no
more than ``PHRASE_GAP`` other words in between.

The fixed base phrases are found at every place where their words stand consecutively, and keep their labels whatever
the templates say.

Rows: null and empty texts have no words, no labels and score 0; very long texts are scanned whole; repeated rows get
equal results; ties of IDF go by the word, and of equal shares all labels are given; an empty table gives no rows; extra
columns, also of the names used here, are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import ship_package

#: Phrase and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, notice as it stands in files, phrases that must be there.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license", "version 2 0"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge", "this software"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license", "version 3"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ["free software", "gnu general public license"]),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ["lesser general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ["redistribution and use", "source and binary forms"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["creative commons attribution sharealike 4 0"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify", "hereby granted"]),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
      in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
      and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
      in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
      WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
      OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
     ["permission is hereby granted free of charge", "the software is provided as is"]),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of
      source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
      notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
     ["redistribution and use", "redistributions in binary form"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
      permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
      OF MERCHANTABILITY AND FITNESS.""", ["permission to use copy modify", "the author disclaims all warranties"]),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
      http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
      WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
     ["apache license", "version 2 0"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
]

#: Rare words of a file that are looked up for a template, where it has as many.
RARE_WORDS = 8
#: Rare words of a template that must agree on where it begins.
AGREEING = 2
#: Words by which beginnings may differ.
DRIFT = 8
#: Other words inside a mandatory phrase.
PHRASE_GAP = 2
#: Share of a template's words that must stand there in order.
LEAST_MATCH = 0.75

_TO_WORDS = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text: A-Z lower-cased, runs of ASCII letters, digits and anything beyond ASCII."""
    return (text or "").encode().translate(_TO_WORDS).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]

    @property
    def needed(self) -> frozenset[bytes]:
        return frozenset(w for phrase in self.phrases for w in phrase)


def _templates() -> list[Template]:
    return [Template(label, words_of(notice), [words_of(p) for p in phrases]) for label, notice, phrases in TEMPLATES]


def _positions(words: list[bytes], word: bytes) -> list[int]:
    found, at = [], -1
    try:
        while True:
            at = words.index(word, at + 1)
            found.append(at)
    except ValueError:
        return found


class Scanner:
    def __init__(self, idf: dict[bytes, float]):
        self.idf, self.templates = idf, _templates()
        self.needed = [t.needed for t in self.templates]
        self.base = [(label, words_of(phrase), frozenset(words_of(phrase))) for phrase, label in BASE.items()]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(self.templates):
            for position, word in enumerate(template.words):
                self.postings[word].append((t, position))
        self.vocabulary = frozenset(self.postings) | {w for _, phrase, _ in self.base for w in phrase}

    def places(self, words: list[bytes], phrase: list[bytes]) -> list[int]:
        """Where ``phrase`` stands, looked up at its rarest word."""
        k = max(range(len(phrase)), key=lambda k: (self.idf.get(phrase[k], 0.0), k))
        return [p - k for p in _positions(words, phrase[k]) if p >= k and words[p - k : p - k + len(phrase)] == phrase]

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        starts, base = [], set()
        for label, phrase, needed in self.base:
            if needed <= present and (found := self.places(words, phrase)):
                starts += found
                base.add(label)
        labels, score = set(base), 1.0 if base else 0.0
        possible = {t for t, needed in enumerate(self.needed) if needed <= present}
        if possible:
            for label, matched in self.found(words, present, possible):
                labels.add(label)
                score = max(score, matched)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score

    def rarest(self, present: frozenset[bytes], possible: set[int]) -> list[bytes]:
        """The file's licence words by falling IDF, as far as a possible template still asks for words."""
        asked, out = dict.fromkeys(possible, RARE_WORDS), []
        for word in sorted(present, key=lambda w: (-self.idf.get(w, 0.0), w)):
            of = {t for t, _ in self.postings.get(word, ()) if asked.get(t)}
            if of:
                out.append(word)
                for t in of:
                    asked[t] -= 1
        return out

    def stretches(self, words: list[bytes], present: frozenset[bytes], possible: set[int]) -> Iterator[tuple[int, int, int]]:
        """Templates and stretches of the file in which enough rare words agree on a beginning."""
        votes: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for word in self.rarest(present, possible):
            places = _positions(words, word)
            for t, position in self.postings[word]:
                if t in possible:
                    votes[t] += [(p - position, word) for p in places]
        for t, given in votes.items():
            given.sort()
            size, next_start, last = len(self.templates[t].words), None, 0
            within: Counter[bytes] = Counter()
            first = 0
            for start, _ in given:
                if next_start is not None and start < next_start:
                    continue
                while last < len(given) and given[last][0] <= start + 2 * DRIFT:
                    within[given[last][1]] += 1
                    last += 1
                while given[first][0] < start:
                    within[given[first][1]] -= 1
                    first += 1
                if sum(n > 0 for n in within.values()) >= AGREEING:
                    yield t, max(0, start - DRIFT), max(0, start + 3 * DRIFT + size)
                next_start = start + DRIFT  # windows overlap by half, so that one holds all beginnings of a match

    def found(self, words: list[bytes], present: frozenset[bytes], possible: set[int]) -> list[tuple[str, float]]:
        """Labels, and shares of words that match, of those ``possible`` templates (all words of their phrases are there)."""
        best: dict[int, float] = {}
        for t, begin, end in self.stretches(words, present, possible):
            template, stretch = self.templates[t], words[begin:end]
            matched = aligned(template.words, stretch) / len(template.words)
            if matched >= LEAST_MATCH and matched > best.get(t, 0.0) and all(stands(phrase, stretch) for phrase in template.phrases):
                best[t] = matched
        return [(self.templates[t].label, share) for t, share in best.items()]


def aligned(template: list[bytes], stretch: list[bytes]) -> int:
    """How many words of ``template`` stand in ``stretch`` in order, at most (a longest common subsequence, a bit a word)."""
    at: dict[bytes, int] = defaultdict(int)
    for k, word in enumerate(template):
        at[word] |= 1 << k
    whole = (1 << len(template)) - 1
    open_ = whole
    for word in stretch:
        hit = open_ & at.get(word, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & whole
    return len(template) - open_.bit_count()


def stands(phrase: list[bytes], stretch: list[bytes]) -> bool:
    """Whether the words of ``phrase`` stand in order, with no more than ``PHRASE_GAP`` other words in between."""
    for start in _positions(stretch, phrase[0]):
        reach = [{start}]
        for word in phrase[1:]:
            reach.append({p for before in reach[-1] for p in range(before + 1, before + 2 + PHRASE_GAP) if p < len(stretch) and stretch[p] == word})
        if any(p - start - len(phrase) + 1 <= PHRASE_GAP for p in reach[-1]):
            return True
    return False


def document_frequencies(df: DataFrame, *, text: str = "text") -> dict[bytes, float]:
    """IDF of every template word, over all rows.

    Each task sums up what it reads; the sums have as many rows as the templates have distinct words (under 200).
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Scanner({}).vocabulary
        seen: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            n += batch.num_rows
            for x in batch.column(0):
                seen.update(vocabulary.intersection(words_of(x.as_py())))
        names = [*seen, b""]  # the empty word counts the rows
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([*seen.values(), n], pa.int64())], ["word", "n"])

    rows = df.select(df[text].alias("text")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r["word"]): r["n"] for r in rows}
    total = counts.pop(b"", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in Scanner({}).vocabulary}


def license_report(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and what `Scanner.scan` finds in every row.  One pass after the one that counts; no text is shuffled."""
    idf = document_frequencies(df, text=text)
    kind = df.schema[key].dataType.simpleString()
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(idf)
        for batch in batches:
            rows = [scanner.scan(x.as_py()) for x in batch.column(1)]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", *names])

    schema = f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
