"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most `radius` bits apart share a value within radius / 2 of
both.  So every distinct fingerprint emits all its variants within half the
radius, variants are shuffled, and fingerprints that meet at a variant are
linked.  Variants that go to the same shuffle target travel as one fingerprint:
the target is a GF(2)-linear code of the variant, hence code(variant) =
code(fingerprint) xor code(flipped bits), and the receiver writes out again just
those variants of a fingerprint that carry its own code.  The number of targets
grows with the fingerprints, so a target's work stays bounded, and targets run
in rounds, so the shuffle on disk stays bounded too.

Texts: A-Z lower-cased, words split at ASCII white space, `n`-word shingles with
repeats (fewer words: the whole sequence; none or a null text: fingerprint 0).
Rows of a table may repeat; every row gets its component.  A null doc_id never
names a component; a component without any doc_id has a null component_id.  `keep_one`
tells rows apart by doc_id and text: of rows that agree in both, one stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import LOWER, apart, column, components, cut, hand_back, map_batches, raw

#: Variants one target handles at most, about.
PER_TARGET = 1 << 21
#: Targets of one round; each fingerprint is shuffled at most this often a round.
PER_ROUND = 1 << 11
FEWEST_BITS = 6
#: Entries made at a time, fingerprints whose variants are looked at at a time, and hash slots.
AT_ONCE, PIECE, SLOT_BITS = 1 << 20, 1 << 13, 22


def fingerprint(text: bytes | None, n: int = 4) -> int:
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    first = (ends - size)[: max(1, len(words) - n + 1)]
    last = ends[min(n, len(words)) - 1 :]
    h, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(first), 1 << 16):
        part = np.array([h(joined[a:b], 42) for a, b in zip(first[i : i + (1 << 16)].tolist(), last[i : i + (1 << 16)].tolist())], np.uint64)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(first), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, key, fp) for every row; the key is the text's hash, fp the fingerprint as a
    signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, n) for t in raw(b, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "key"), pa.array(fp)], names=["doc_id", "key", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    return map_batches(rows, run, "doc_id long, key long, fp long")


class Ball:
    """Flip masks of up to `radius` bits, sorted by their `bits`-bit code."""

    def __init__(self, radius: int, bits: int):
        rng = np.random.default_rng(bits)
        self.code = rng.integers(0, 1 << bits, 64, dtype=np.int64)
        sets = [c for k in range(radius + 1) for c in combinations(range(64), k)]
        masks = np.array([sum(1 << i for i in c) for c in sets], np.uint64)
        codes = np.array([np.bitwise_xor.reduce(self.code[list(c)]) if c else 0 for c in sets], np.int64)
        order = np.argsort(codes, kind="stable")
        self.masks, self.codes, self.bits = masks[order], np.unique(codes), bits
        self.start = np.searchsorted(codes[order], np.arange((1 << bits) + 1))
        #: bit k of a fingerprint's code is the parity of its bits under plane k
        self.planes = [np.uint64(sum(1 << i for i in range(64) if self.code[i] >> k & 1)) for k in range(bits)]

    def of(self, fp: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fp), np.int64)
        for k, plane in enumerate(self.planes):
            out |= (np.bitwise_count(fp & plane).astype(np.int64) & 1) << k
        return out

    def variants(self, fp: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
        """All variants with code `target`, and the index of each one's source."""
        c = self.of(fp) ^ target
        n = self.start[c + 1] - self.start[c]
        src = np.repeat(np.arange(len(fp), dtype=np.int32), n)
        at = np.arange(len(src), dtype=np.int32) + np.repeat((self.start[c] - (np.cumsum(n) - n)).astype(np.int32), n)
        return fp[src] ^ self.masks[at], src


def slots(var: np.ndarray) -> np.ndarray:
    return (var * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def mark(var: np.ndarray, once: np.ndarray, again: np.ndarray) -> None:
    """Note the hash slots of values; a slot is in `again` at least where a value occurs a
    second time."""
    slot = slots(var)
    again[slot[once[slot]]] = True
    last = np.zeros(len(once), np.int32)
    at = np.arange(len(var), dtype=np.int32)
    last[slot] = at
    again[slot[last[slot] != at]] = True
    once[slot] = True


def meetings(fp: np.ndarray, ball: Ball, target: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smaller fingerprint) that join all that meet at a
    variant of this target.  Members of a meeting are joined to its smallest one:
    each of them is within half the radius of the variant, so this loses no
    component, and it avoids a group's pairs.  Links are verified by bit distance."""
    fp = np.unique(fp)
    # two looks at the variants, piece by piece: which hash slots come up again, then those alone
    once, again = np.zeros(1 << SLOT_BITS, bool), np.zeros(1 << SLOT_BITS, bool)
    pieces = [slice(i, i + PIECE) for i in range(0, len(fp), PIECE)]
    for piece in pieces:
        mark(ball.variants(fp[piece], target)[0], once, again)
    var, src = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for piece in pieces:
        v, s = ball.variants(fp[piece], target)
        keep = again[slots(v)]
        var.append(v[keep])
        src.append(s[keep] + np.int32(piece.start))
    del once, again
    var, src = np.concatenate(var), np.concatenate(src)
    order = np.lexsort((src, var))
    var, src = var[order], src[order]
    new = np.r_[True, var[1:] != var[:-1]] if len(var) else np.zeros(0, bool)
    head = src[np.flatnonzero(new)][np.cumsum(new) - 1] if len(var) else src
    pair = np.unique((src.astype(np.int64) * len(fp) + head)[src != head])
    a, b = pair // max(len(fp), 1), pair % max(len(fp), 1)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
    a, b = a[near], b[near]
    low = np.arange(len(fp))  # the smallest member of each one's component within this target
    while True:
        old = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == old).all():
            break
    linked = np.flatnonzero(low != np.arange(len(fp)))
    return fp[linked], fp[low[linked]]


def links(distinct: DataFrame, n_fingerprints: int, radius: int = 4) -> DataFrame:
    """Edges (a, b) over `distinct(fp)` whose components are those of all pairs
    at most `radius` bits apart."""
    if radius % 2:
        raise ValueError("the radius must be even: members of a meeting are then all within it")
    half = radius // 2
    n_variants = sum(math.comb(64, k) for k in range(half + 1))
    bits = max(FEWEST_BITS, math.ceil(math.log2(max(1, n_fingerprints * n_variants / PER_TARGET))))
    ball = Ball(half, bits)
    found = None
    for lo in range(0, 1 << bits, PER_ROUND):
        edges = _round(distinct, ball, lo, lo + PER_ROUND, radius)
        if 1 << bits > PER_ROUND:  # a later round starts when this one's edges are written
            edges = cut(edges, "simhash-round")
        found = edges if found is None else found.union(edges)
    return found


def _round(distinct: DataFrame, ball: Ball, lo: int, hi: int, radius: int) -> DataFrame:
    span = (hi - lo).bit_length() - 1  # targets of a round share the code's other bits

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = column(b, "fp").to_numpy(zero_copy_only=False).view(np.uint64)
            step = max(1, AT_ONCE >> span)
            for i in range(0, len(every), step):
                fp = every[i : i + step]
                code = ball.of(fp)
                # flips that lead to this round's targets: a slice of the sorted codes
                wanted = (code ^ lo) >> span << span
                first, last = np.searchsorted(ball.codes, wanted), np.searchsorted(ball.codes, wanted + (1 << span))
                n = last - first
                src = np.repeat(np.arange(len(fp)), n)
                target = ball.codes[np.arange(len(src)) + np.repeat(first - (np.cumsum(n) - n), n)] ^ code[src]
                order = np.argsort(target, kind="stable")
                target, own = target[order], fp[src[order]]
                at = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
                blobs = [own[x:y].tobytes() for x, y in zip(at, [*at[1:], len(own)])]
                yield pa.RecordBatch.from_arrays([pa.array(target[at], pa.int64()), pa.array(blobs, pa.binary())], names=["target", "fps"])

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fp = np.frombuffer(b"".join(rows["fps"]), np.uint64)
        a, b = meetings(fp, ball, int(key[0]), radius)
        hand_back()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return map_batches(distinct, emit, "target long, fps binary").groupBy("target").applyInPandas(meet, "a long, b long").distinct()


def with_components(fps: DataFrame, radius: int = 4) -> DataFrame:
    """A written table with (doc_id, fp), and root and component_id of each row."""
    groups = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-fps")
    roots = components(links(groups.select("fp"), groups.count(), radius))
    rooted = groups.join(roots, groups.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select(*fps.columns, "root", "component_id")


def near_duplicates(docs: DataFrame, n: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits),
    component_id (the smallest doc_id of the component)."""
    found = with_components(cut(fingerprints(docs, n), "simhash"), radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, n: int = 4, radius: int = 4) -> DataFrame:
    """Rows of `docs` without near-duplicates: of each component one row stays, that with the
    smallest doc_id (a null one comes last), then the smallest hash of its text."""
    found = cut(with_components(cut(fingerprints(docs, n), "simhash"), radius), "simhash-found")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    groups = found.groupBy("root").agg(F.count("*").alias("n"), F.min(place).alias("kept")).where("n > 1")
    # rows of a component of several, each id and text once
    told = cut(found.join(groups, "root").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), (place == F.col("kept")).alias("__kept")).distinct(), "simhash-told")
    hit, rest = apart(docs, told.select(F.col("__id").alias("doc_id")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    met = hit.join(told, same, "left")
    alone = met.where("__kept is null").select(*docs.columns)
    first = met.where("__kept").dropDuplicates(["__id", "__key"]).select(*docs.columns)
    return rest.unionByName(alone).unionByName(first)
