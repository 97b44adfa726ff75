"""Licence scan by a positional rare-token index over licence texts.

Licence texts (`TEMPLATES`) are indexed by word: postings hold template and position.  A
word's IDF is counted over all documents of the scanned table.  Of each template whose
mandatory words a file holds, the `rare` highest-IDF words that the file holds are looked
up; file position minus template position is the place at which each occurrence puts
the template.  Places are intersected with a tolerance of `slack` words: a place
counts if more than half of the words looked up meet there.  It is accepted if the
template's mandatory key phrases stand there, word by word, and the words found make up at
least `share` of the template's IDF weight.

Phrases (`PHRASES` and the key phrases) are found in the same way, without tolerance: the
occurrences of the phrase's highest-IDF word are the only places where it can stand,
and all its words are compared there, so no place is lost.

Words: A-Z lower-cased, runs of letters, digits and characters beyond ASCII.  A null or
empty text has no words.  Every row, repeated or not and whatever its id, is a file of its
own.  A file is held as a list of its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import column, map_batches, raw, rows_in_pieces

#: Letters and digits, lower-cased; what separates words becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RARE, SLACK, SHARE = 12, 24, 0.8


def words_of(text: bytes | str | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    """A licence text, its label and the phrases that must stand in it."""

    label: str
    text: str
    phrases: tuple[str, ...]


# FIXED: phrases whose every place is reported, with their labels
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# FIXED: the licences' own notices, as their publishers word them
TEMPLATES = (
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
             ("gnu general public license as published by the free software foundation", "without any warranty")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
             ("may not use this file except in compliance with the license", "www apache org licenses license 2 0")),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
             ("for any purpose with or without fee is hereby granted",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
             ("redistribution and use in source and binary forms", "must reproduce the above copyright notice")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
             ("subject to the terms of the mozilla public license v 2 0",)),
    Template("cc-by-nc", "licensed under CC BY-NC", ("cc by nc",)),
    Template("cc-by-nd", "licensed under CC BY-ND", ("cc by nd",)),
    Template("cc-by-sa", "licensed under CC BY-SA", ("cc by sa",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution",)),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
             ("waived all copyright and related or neighboring rights",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
             ("free and unencumbered software released into the public domain",)),
)


class Index:
    """Words of templates and phrases, their postings, and (once counted) their IDF."""

    def __init__(self, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES):
        self.templates, self.phrases = templates, phrases
        texts = [words_of(t.text) for t in templates]
        keys = [[words_of(p) for p in t.phrases] for t in templates]
        base = [words_of(p) for p, _ in phrases]
        if not all(x and all(x) for x in keys) or not all(base):
            raise ValueError("every template needs key phrases, and every phrase words")
        self.words = {w: i for i, w in enumerate(sorted({w for x in (*texts, *base, *(k for ks in keys for k in ks)) for w in x}))}
        number = lambda x: np.array([self.words[w] for w in x], np.int64)
        self.texts, self.base = [number(x) for x in texts], [number(x) for x in base]
        self.keys = [[number(k) for k in x] for x in keys]
        #: words without which a template or phrase can't be there
        self.must = [set(np.concatenate(x).tolist()) for x in self.keys]
        self.base_must = [set(x.tolist()) for x in self.base]
        self.weigh(np.zeros(len(self.words), np.int64), 0)

    def weigh(self, df: np.ndarray, n: int) -> None:
        """IDF from document counts; equal ones are told apart by the word's number."""
        self.idf = np.log((n + 1) / (df + 1)) + 1
        self.order = np.lexsort((np.arange(len(df)), -self.idf))  # rarest first
        self.place = np.argsort(self.order)
        self.__dict__.pop("entry", None)

    @cached_property
    def entry(self) -> set[int]:
        """The rarest mandatory word of each template and phrase: a file without any of
        them holds none."""
        return {min(x, key=lambda w: self.place[w]) for x in (*self.must, *self.base_must)}

    def postings(self, template: int) -> dict[int, np.ndarray]:
        """Positions of each word in a template."""
        own = self.texts[template]
        return {int(w): np.flatnonzero(own == w) for w in np.unique(own)}

    def stands(self, phrase: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """All starts of a phrase: its rarest word is looked up, the others compared."""
        r = int(np.argmin(self.place[phrase]))
        start = np.flatnonzero(ids == phrase[r]) - r
        start = start[(start >= 0) & (start + len(phrase) <= len(ids))]
        for j, w in enumerate(phrase.tolist()):
            start = start[ids[start + j] == w]
        return start

    def placed(self, template: int, ids: np.ndarray, present: set[int], rare: int, slack: int, share: float) -> list[tuple[int, float]]:
        """(start of the first key phrase, share) at each accepted place of a template."""
        where = [self.stands(k, ids) for k in self.keys[template]]
        if not all(len(x) for x in where):
            return []
        postings = self.postings(template)
        looked_up = sorted((w for w in postings if w in present), key=lambda w: self.place[w])[:rare]
        votes = [((np.flatnonzero(ids == w)[:, None] - postings[w]).ravel(), w) for w in looked_up]
        shift = np.concatenate([x for x, _ in votes]) // slack
        word = np.repeat([w for _, w in votes], [len(x) for x, _ in votes])
        # a vote counts for its own stretch of `slack` places and for the one before
        both = np.unique(np.stack([np.r_[shift, shift - 1], np.r_[word, word]], 1), axis=0)
        stretch, n = np.unique(both[:, 0], return_counts=True)
        out: list[tuple[int, float]] = []
        weight = {w: float(self.idf[w]) for w in postings}
        total = math.fsum(weight.values())
        for s in stretch[2 * n > len(looked_up)].tolist():
            a, b = s * slack, (s + 2) * slack + len(self.texts[template])
            first = [x[(x >= a) & (x < b)] for x in where]
            if not all(len(x) for x in first):
                continue
            found = math.fsum(weight[w] for w in set(ids[max(0, a) : b].tolist()) if w in weight) / total
            if found >= share:
                out.append((int(first[0][0]), min(1.0, found)))
        best: dict[int, float] = {}
        for start, found in out:
            best[start] = max(found, best.get(start, 0.0))
        return sorted(best.items())

    def scan(self, words: list[bytes], rare: int, slack: int, share: float) -> tuple[list[tuple[str, int]], list[tuple[str, int, float]]]:
        """(label, start) of every phrase's places, (label, start, share) of every template's."""
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        present = set(np.unique(ids).tolist())
        if not present & self.entry:
            return [], []
        base = [(label, s) for (_, label), x, must in zip(self.phrases, self.base, self.base_must) if must <= present for s in self.stands(x, ids).tolist()]
        found = {(t.label, s, x) for i, t in enumerate(self.templates) if self.must[i] <= present for s, x in self.placed(i, ids, present, rare, slack, share)}
        return sorted(base, key=lambda x: (x[1], x[0])), sorted(found, key=lambda x: (x[1], x[0]))


def counted(docs: DataFrame, index: Index) -> Index:
    """The index, weighed by how many documents of the table hold each of its words.  At
    most a row per word of the licence texts reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, vocabulary = np.zeros(len(index.words), np.int64), 0, index.words
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 12, 1 << 20):
                for text in raw(piece, "text"):
                    n += 1
                    df[[vocabulary[w] for w in vocabulary.keys() & set(words_of(text))]] += 1
        at = np.r_[np.flatnonzero(df), -1]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.r_[df[at[:-1]], n], pa.int64())], names=["word", "n"])

    rows = map_batches(docs, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r.word: r.n for r in rows}
    n = df.pop(-1, 0)
    weighed = np.zeros(len(index.words), np.int64)
    weighed[list(df)] = list(df.values())
    index.weigh(weighed, n)
    return index


PLACE, MATCH = "struct<label: string, start: long>", "struct<label: string, start: long, share: double>"
_PLACE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_MATCH = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, rare: int = RARE, slack: int = SLACK, share: float = SHARE) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, n_words, places
    array<struct<label, start>> of the phrases and matches array<struct<label, start,
    share>> of the templates, both by start; starts are word numbers from 0."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = counted(docs, Index(templates, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 12, 1 << 20):
                n, base, found = [], [], []
                for text in raw(piece, "text"):
                    words = words_of(text)
                    x, y = index.scan(words, rare, slack, share)
                    n.append(len(words))
                    base.append([dict(zip(("label", "start"), p)) for p in x])
                    found.append([dict(zip(("label", "start", "share"), m)) for m in y])
                yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(n, pa.int64()), pa.array(base, _PLACE), pa.array(found, _MATCH)], names=["doc_id", "n_words", "places", "matches"])

    schema = T._parse_datatype_string(f"doc_id long, n_words long, places array<{PLACE}>, matches array<{MATCH}>")
    return map_batches(docs, run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of `scan`'s rows.  The score is 1 where a phrase stands whole,
    else the largest share of a template, 0 without any."""
    own = F.transform("places", lambda p: p["label"])
    every = F.concat(own, F.transform("matches", lambda m: m["label"]))
    starts = F.transform("places", lambda p: p["start"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(own).alias("base_labels"), joined(every).alias("labels"), score.alias("score"))
