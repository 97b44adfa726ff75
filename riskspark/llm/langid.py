"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle).

A profile is the list of the `top` most frequent letter n-grams (1 to 3 letters,
runs of non-letters being one space) in order of frequency, ties by code point.
A document's profile is compared to each language's: every n-gram adds the
distance between its two places, or `top` if the language lacks it.  The language
at the smallest distance is predicted, ties to the smaller name.

Profiles count every n-gram of every whole training text.  Null texts and texts
without a letter are `und` with score 0, as is everything if nothing was learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import column, held_out, map_batches, rows_in_pieces

TOP = 300
UND = "und"
#: Distinct n-grams a training task holds before it hands them on.
HELD = 1 << 20
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once per process."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def symbols(text: str) -> np.ndarray:
    """Code points plus one of the lower-cased text; each run of non-letters, and
    either end, is one 1.  Empty if there is no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.ones(len(cp) + 2, np.uint64)
    a[1:-1] = np.where(letters()[cp], cp + 1, 1)
    gap = a == 1
    a = a[~(gap & np.r_[False, gap[:-1]])]
    return a if len(a) > 1 else a[:0]


def ngrams(a: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 symbols but the single space; 21 bits a symbol."""
    if not len(a):
        return a
    two = (a[:-1] << np.uint64(21)) | a[1:]
    three = (two[:-1] << np.uint64(21)) | a[2:]
    return np.concatenate([a[a != 1], two, three])


def counted(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes with their summed counts."""
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    new = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    return c[new], np.add.reduceat(n, new)


def profiles(docs: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Each language's `top` n-gram codes, most frequent first, over all rows of
    docs(text, lang) with neither null.  At most `top` rows a language come to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            lang = np.repeat(np.array(list(held), object), [len(c) for c, _ in held.values()])
            code = np.concatenate([c for c, _ in held.values()]) if held else np.zeros(0, np.uint64)
            n = np.concatenate([n for _, n in held.values()]) if held else np.zeros(0, np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(code.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "code", "n"])

        for b in batches:
            for piece in rows_in_pieces(b, 4096, 1 << 20):
                own: dict[str, list[np.ndarray]] = {}
                for t, lang in zip(column(piece, "text").to_pylist(), column(piece, "lang").to_pylist()):
                    own.setdefault(lang, []).append(ngrams(symbols(t)))
                for lang, parts in own.items():
                    c, n = np.unique(np.concatenate(parts), return_counts=True)
                    if len(c):
                        held[lang] = counted([c, held[lang][0]], [n, held[lang][1]]) if lang in held else (c, n)
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield out()
        yield out()

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    total = map_batches(rows, count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = total.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("place") <= top)
    found: dict[str, list] = {}
    for r in best.orderBy("lang", "place").collect():
        found.setdefault(r.lang, []).append(r.code)
    return {lang: np.array(c, np.int64).view(np.uint64) for lang, c in found.items()}


class Ranker:
    """Places of every profiled n-gram in every language."""

    def __init__(self, found: dict[str, np.ndarray], top: int = TOP):
        self.langs, self.top = sorted(found), top
        self.codes = np.unique(np.concatenate([*found.values(), np.zeros(0, np.uint64)]))
        self.place = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.place[i, np.searchsorted(self.codes, found[lang])] = np.arange(len(found[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngrams(symbols(text or ""))
        if not len(codes) or not self.langs:
            return UND, 0.0
        c, n = np.unique(codes, return_counts=True)
        if len(c) > self.top:  # the most frequent, ties to the smaller code
            c = c[np.argsort(-n, kind="stable")[: self.top]]
        else:
            c = c[np.argsort(-n, kind="stable")]
        at = np.minimum(np.searchsorted(self.codes, c), len(self.codes) - 1)
        place = self.place[:, np.where(self.codes[at] == c, at, len(self.codes))]
        far = np.where(place < 0, self.top, np.abs(place - np.arange(len(c)))).sum(1)
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (self.top * len(c)))


def ranker(docs: DataFrame, mod: int = 5, rest: int = 0) -> Ranker:
    """Learned from the rows of `docs` that are not held out."""
    return Ranker(profiles(docs.where(~held_out("doc_id", mod, rest)).select(F.col("text").cast("string").alias("text"), "lang")))


def identify(docs: DataFrame, model: Ranker, mod: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = zip(*[model.predict(t) for t in column(b, "text").to_pylist()]) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    picked = docs.select("doc_id", held_out("doc_id", mod, rest).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(picked, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Ranker) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is not `und`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([model.predict(t)[0] != UND for t in column(b, "text").to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)
