"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least max(`shortest`, `least` * q) words that no neighbouring word
extends.  The last square of a run is branching: the suffixes at its start i and at
i + q share exactly q words, so they lie in different children of an LCP interval
of depth q.  For each LCP interval the suffixes of all children but the largest
are looked up at i + q and i - q in the inverse suffix array; a partner inside the
interval but in another child is a branching square.  Intervals and children are
index ranges of the LCP array, no tree is built.  Each square is rotated to the left as
long as it stays one; squares that reach the same stretch are one run, whose period
is the smallest.  Common lengths, to the right and to the left, come from the ranks that
prefix doubling leaves behind.

Two suffixes of a run agree in `shortest` - `shortest` // `least` words, so texts without
a repeated window of that length (or the power of two below it) have no run and
need no suffix array.

Words are what ASCII white space separates.  A null or blank text has no words and no
runs; its collapsed text is null or empty.  Every row, repeated or not and whatever its id,
is one document.  A text of n words takes at most about 4 n log2(n) bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import column, map_batches, raw, rows_in_pieces
from riskspark.llm.tokens import scramble

SHORTEST, LEAST = 24, 3
RUN = "struct<start: long, length: long, period: long>"
_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
#: Characters that separate words, as a regular expression.
SPACE = r"[\x20\x09-\x0D]+"


class SuffixArray:
    """Suffixes of `t` in order, their ranks, and what neighbours share."""

    def __init__(self, t: np.ndarray):
        n = self.n = len(t)
        rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
        #: levels[j][i] numbers the 2**j words from i; one more entry ends each
        self.levels: list[np.ndarray] = []
        span = 1
        while True:
            self.levels.append(np.r_[rank, -1].astype(np.int32))
            after = np.zeros(n, np.int64)
            after[: max(0, n - span)] = rank[span:] + 1
            key = rank * (n + 1) + after
            sa = np.argsort(key, kind="stable")
            ordered = key[sa]
            number = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
            rank = np.empty(n, np.int64)
            rank[sa] = number
            if number[-1] == n - 1:
                break
            span *= 2
        self.sa, self.isa = sa, rank
        self.lcp = np.r_[-1, self.common(sa[:-1], sa[1:]), -1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words shared from a and b on (a and b differ)."""
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            own = self.levels[j]
            out += (own[np.minimum(a + out, self.n)] == own[np.minimum(b + out, self.n)]).astype(np.int64) << j
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words shared up to but without a and b (a < b)."""
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            x = a - out - (1 << j)
            own = self.levels[j]
            same = (x >= 0) & (own[np.maximum(x, 0)] == own[np.maximum(x, 0) + b - a])
            out += same.astype(np.int64) << j
        return out

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last index of each LCP interval of depth > 0, and for each index
        of the LCP array the interval that it divides (-1: none)."""
        lcp = self.lcp.tolist()
        first, last, of = [], [], [-1] * (self.n + 1)
        open_: list[tuple[int, int]] = []  # (depth, interval)
        for k in range(1, self.n + 1):
            depth, left = lcp[k], k - 1
            while open_ and open_[-1][0] > depth:
                i = open_.pop()[1]
                last[i], left = k - 1, first[i]
            if depth > 0:
                if not open_ or open_[-1][0] < depth:
                    open_.append((depth, len(first)))
                    first.append(left)
                    last.append(0)
                of[k] = open_[-1][1]
        return np.array(first, np.int64), np.array(last, np.int64), np.array(of, np.int64)

    def branching(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and periods of all branching squares."""
        first, last, of = self.intervals()
        at = np.flatnonzero(of >= 0)
        at = at[np.argsort(of[at], kind="stable")]
        each = np.arange(len(first))
        # children: from the interval's first index and from each index that divides it
        own = np.r_[each, of[at]]
        start = np.r_[first, at]
        order = np.lexsort((start, own))
        own, start = own[order], start[order]
        follows = np.r_[own[1:] == own[:-1], False]
        end = np.where(follows, np.r_[start[1:], 0], last[own] + 1)
        size = end - start
        by_size = np.lexsort((size, own))
        small = np.ones(len(own), bool)
        small[by_size[np.r_[own[by_size][1:] != own[by_size][:-1], True]]] = False  # each interval's largest child
        own, start, size = own[small], start[small], size[small]
        child = np.repeat(np.arange(len(own)), size)
        p = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + start[child]
        depth_of = np.zeros(len(first), np.int64)
        depth_of[of[at]] = self.lcp[at]
        i, depth = self.sa[p], depth_of[own[child]]
        lo, hi, c0, c1 = first[own[child]], last[own[child]], start[child], start[child] + size[child]
        starts, periods = [], []
        for other, square in ((i + depth, i), (i - depth, i - depth)):
            inside = (other >= 0) & (other < self.n)
            r = self.isa[np.where(inside, other, 0)]
            hit = inside & (r >= lo) & (r <= hi) & ~((r >= c0) & (r < c1))
            starts.append(square[hit])
            periods.append(depth[hit])
        return np.concatenate(starts), np.concatenate(periods)


def runs_of(t: np.ndarray, shortest: int = SHORTEST, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of every run, by start and period."""
    if len(t) < max(2, shortest):
        return np.zeros((0, 3), np.int64)
    array = SuffixArray(t)
    i, q = array.branching()
    start = i - array.common_before(i, i + q)
    end = i + 2 * q
    full = end - start >= np.maximum(shortest, least * q)
    start, end, q = start[full], end[full], q[full]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
    out = np.stack([start, end - start, q], 1)[new]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def repeats(t: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which texts (codes `t`, one after another, ending at `ends`) hold a window of that
    many words, a power of two, twice.  Never misses one."""
    h, span = scramble(t.astype(np.uint64) + np.uint64(1)), 1
    while span < window and len(h) > span:
        h = scramble(h[:-span] * np.uint64(0x9E3779B97F4A7C15) + h[span:])
        span *= 2
    out = np.zeros(len(ends), bool)
    if span < window:
        return out
    at = np.arange(len(h))
    text = np.searchsorted(ends, at, side="right")
    whole = at + window <= ends[np.minimum(text, len(ends) - 1)]
    key, text = scramble(h[whole] ^ scramble(text[whole].astype(np.uint64) + np.uint64(7))), text[whole]
    order = np.argsort(key)
    again = key[order][1:] == key[order][:-1]
    out[text[order][1:][again]] = True
    return out


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def detect(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, n_words, runs
    array<struct<start, length, period>> by start and period, and collapsed, the words
    that stay, joined by one space."""
    if least < 2:
        raise ValueError("a run holds a square: least must be 2 or more")
    window = 1 << (max(1, shortest - shortest // least).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in rows_in_pieces(batch, 1 << 12, 1 << 20):
                code: defaultdict[bytes, int] = defaultdict(count().__next__)
                texts = raw(piece, "text")
                words = [(x or b"").split() for x in texts]
                size = np.fromiter(map(len, words), np.int64, len(words))
                t = np.fromiter((code[w] for x in words for w in x), np.int64, int(size.sum()))
                ends = np.cumsum(size)
                again = repeats(t, ends, window)
                found, kept = [], []
                for i, x in enumerate(words):
                    own = runs_of(t[ends[i] - size[i] : ends[i]], shortest, least) if again[i] else ()
                    found.append([{"start": a, "length": b, "period": c} for a, b, c in own.tolist()] if len(own) else [])
                    if len(own):
                        x = [w for w, gone in zip(x, dropped(own, len(x)).tolist()) if not gone]
                    kept.append(None if texts[i] is None else b" ".join(x))
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "doc_id"), pa.array(size), pa.array(found, _RUN), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    schema = T._parse_datatype_string(f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text)`, with every text whose id's crc32 h is a multiple of 10 made
    periodic: its word i >= a is word a + (i - a) % p, where g = floor(h / 10), a = g % n
    and p = 1 + floor((n - a) / (3 + g % 8)).  A null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def made(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        source = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(w, (source(i) + 1).cast("int"))), " ")

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.filter(F.split("text", SPACE), lambda x: x != "")
    # the one-element array binds the words once, whatever the number of uses
    return docs.withColumn("text", F.when(chosen, F.transform(F.array(words), made)[0]).otherwise(F.col("text")))


def most_periodic(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    def better(x: Column, y: Column) -> Column:
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (left > right) | ((left == right) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))

    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, x: F.when(best.isNull() | better(x, best), x).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of `detect`'s rows."""
    best = F.col("best")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", most_periodic(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
