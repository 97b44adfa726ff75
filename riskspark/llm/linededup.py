"""Near-duplicate lines across documents by a segment-partition edit join.

A line is a sequence of symbols: its words (what white space separates) if it has at
least `words` of them, else its characters.  Two lines of the same kind are linked if
their edit distance (insert, delete, replace a symbol) is at most a threshold that grows
with the shorter one's length n: 1 + n // `per` words, at most `most`, or `tau` characters.
Equal lines are one.  A line of the index with threshold t is split into t + 1 even segments,
of which at least one occurs unchanged in any linked line.  A longer or equally long
line therefore probes, for each length l within the threshold of l and each segment of that
length, its substrings in the window where an alignment can put the segment; keys
are (kind, l, segment, substring).  Index and probe entries are shuffled on the key;
pairs that meet are sifted by the parity of their symbols' counts and verified by
banded bit-parallel edit distance on their symbols.

The target of a key counts the key's lines before it pairs them.  Lines of a key with
more than `HOT` pairs are only paired with their next `NEXT` neighbours there, and handed
on.  Once the pairs are verified, such a key is done if its lines lie in one component,
as those of a group of near copies soon do.  Else its lines are dealt to chunks, and each
pair of chunks is verified in a group of its own, where pairs already connected are passed
over and only links that join two parts are kept.

A class is a connected component of links; its first place, the smallest
(doc_id, line number), stays, all other places go.  Lines of fewer than `words` words
and fewer than `shortest` characters are only compared for equality, and lines of white
space are never touched.  Rows of the same doc_id and text are one place; rows of one
doc_id and different texts are ordered by the texts' hash, rows with a null doc_id
come last.  Null texts stay null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Bitmap, apart, column, components, cut, hand_back, map_batches, raw, rows_in_pieces

#: Entries one shuffle target gets, about, entries of a line, about, and the fewest targets.
PER_TARGET, PER_LINE, FEWEST_BITS = 1 << 21, 24, 6
#: Pairs a task looks at at a time, pairs of one key above which it is hot, and neighbours that
#: a line of a hot key is paired with.
AT_ONCE, HOT, NEXT = 1 << 18, 1 << 8, 2
#: Lines of one chunk of a hot key, pairs verified at a time there, and pairs of sketches compared at a time.
LINES, CHECKED, SIFTED = 1 << 15, 1 << 11, 1 << 16
#: Places above which a class is large: its first place is broadcast, a row for so many places.
MANY = 1 << 10
#: Part of the key, sketch with the threshold in its upper bits, line.
ENTRY = np.dtype([("k", "<u4"), ("s", "<u4"), ("h", "<u8")])
CLASSES = 29
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
WORDS, CHARACTERS = 0, 1
#: 1 for the bytes at which bytes.split cuts; the lowest n bytes of eight.
BLANK = bytes(b in b" \t\n\r\x0b\x0c" for b in range(256))
LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@dataclass(frozen=True)
class Rule:
    """What is compared, and how far apart lines may be; thresholds are 7 at most."""

    words: int = 8
    per: int = 24
    most: int = 7
    shortest: int = 20
    tau: int = 2

    def threshold(self, kind: int, n: np.ndarray) -> np.ndarray:
        """Of pairs whose shorter line has n symbols; -1 if such lines aren't compared."""
        n = np.asarray(n)
        if kind == WORDS:
            return np.where(n >= self.words, np.minimum(1 + n // self.per, self.most), -1)
        return np.where(n >= self.shortest, self.tau, -1)

    @property
    def widest(self) -> int:
        return max(self.most, self.tau)


RULE = Rule()


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line)


def lines_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for i, b in enumerate((BASE, INVERSE)):
            steps = np.full(1 << n.bit_length(), b, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x *= np.uint64(m)
        x ^= x >> np.uint64(33)
    return x


def segments(length: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the tau + 1 even segments of lines of these lengths, a column each."""
    m, i = tau + 1, np.arange(tau + 1)
    base, more = length[:, None] // m, length[:, None] % m
    return i * base + np.maximum(0, i - (m - more)), base + (i >= m - more)


def windows(delta: int, tau: int) -> np.ndarray:
    """(segment, shift) pairs: where a line `delta` symbols longer can hold a segment (from 0)
    with at most tau edits in all.  The place of the index itself is left out."""
    out = [(i, shift) for i in range(tau + 1) for shift in range(max(-i, delta - (tau - i)), min(i, delta + tau - i) + 1)]
    return np.array([x for x in out if delta or x[1]], np.int64).reshape(-1, 2)


class Symbols:
    """Lines of one kind as symbols, 64-bit hashes: those of line i are sym[start[i] : start[i] + size[i]]."""

    def __init__(self, kind: int, which: np.ndarray, size: np.ndarray, sym: np.ndarray):
        self.kind, self.which, self.size, self.sym = kind, which, size, sym
        self.start = np.cumsum(self.size) - self.size

    def sketches(self, classes: int = CLASSES) -> np.ndarray:
        """Parities of the counts of a line's symbols, in so many classes."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        bit = np.uint64(1) << ((self.sym >> np.uint64(32)) * np.uint64(classes) >> np.uint64(32))
        return np.bitwise_xor.reduceat(bit, self.start)

    def fine(self) -> np.ndarray:
        """Those parities in 256 classes, four words a line."""
        of = self.sym >> np.uint64(56)
        bit, word = np.uint64(1) << (of & np.uint64(63)), of >> np.uint64(6)
        return np.stack([np.bitwise_xor.reduceat(np.where(word == i, bit, np.uint64(0)), self.start) for i in range(4)], 1)


def words_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each line's number of words, as bytes.split cuts them, and the hashes of all words: those of at
    most 16 bytes by their first and last 8 and their size, others by XXH3."""
    data = b"\n" + b"\n".join(lines) + b"\n" + bytes(8)
    blank = np.frombuffer(data.translate(BLANK), np.uint8, len(data) - 8)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
    many = np.diff(np.searchsorted(start, ends), prepend=0)
    eight, size = np.ndarray(len(data) - 7, "<u8", data, strides=(1,)), end - start  # the 8 bytes from each place on
    out = scramble((eight[start] & LOWEST[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(BASE))
    long = np.flatnonzero(size > 8)
    out[long] = scramble(out[long] ^ eight[end[long] - 8])
    for i in long[size[long] > 16].tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]])
    return many, out


def kinds(lines: list[bytes], rule: Rule) -> list[Symbols]:
    """Lines (none of them white space) by what they are compared by."""
    if not lines:
        return []
    size, sym = words_of(lines)
    many, out = size >= rule.words, []
    if many.any():
        out.append(Symbols(WORDS, np.flatnonzero(many), size[many], sym if many.all() else sym[np.repeat(many, size)]))
    if not many.all():
        which = np.flatnonzero(~many)
        some = [lines[i].decode("utf-8", "replace") for i in which.tolist()]
        code = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.uint64)
        out.append(Symbols(CHARACTERS, which, np.fromiter(map(len, some), np.int64, len(some)), scramble(code + np.uint64(1))))
    return out


class Compared:
    """Lines made ready once for many comparisons."""

    def __init__(self, lines: list[bytes], rule: Rule):
        n, parts, at = len(lines), [np.zeros(0, np.uint64)], 0
        self.kind, self.tau, self.size, self.start = (np.zeros(n, np.int64) for _ in range(4))
        self.sketch, self.fine = np.zeros(n, np.uint64), np.zeros((n, 4), np.uint64)
        for x in kinds(lines, rule):
            self.kind[x.which], self.tau[x.which] = x.kind, rule.threshold(x.kind, x.size)
            self.size[x.which], self.start[x.which], self.sketch[x.which] = x.size, x.start + at, x.sketches(64)
            self.fine[x.which] = x.fine()
            parts.append(x.sym)
            at += len(x.sym)
        self.sym = np.concatenate(parts)

    def likely(self, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        """False for pairs that can't be linked: an edit changes two counts and one length at most."""
        tau = np.minimum(self.tau[a], self.tau[b])  # that of the shorter line
        return (np.bitwise_count(self.sketch[a] ^ self.sketch[b]) <= 2 * tau) & (np.abs(self.size[a] - self.size[b]) <= tau) & (self.kind[a] == self.kind[b])

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, tau = self.likely(a, b), np.minimum(self.tau[a], self.tau[b])
        some = np.flatnonzero(out)
        out[some] = np.bitwise_count(self.fine[a[some]] ^ self.fine[b[some]]).sum(1) <= 2 * tau[some]
        for t in np.unique(tau[out]).tolist():
            some = np.flatnonzero(out & (tau == t))
            out[some] = near(self.sym, self.start[a[some]], self.size[a[some]], self.start[b[some]], self.size[b[some]], t)
        return out


class Signatures:
    """Index and probe entries (key, sketch, line) of distinct lines."""

    def __init__(self, lines: list[bytes], hashes: list[int], rule: Rule):
        self.index, self.probe = [], []
        for x in kinds(lines, rule):
            self._add(x, np.array(hashes, np.uint64)[x.which], rule)

    def _add(self, x: Symbols, h: np.ndarray, rule: Rule) -> None:
        fwd, self.inv = powers(len(x.sym) + 1)
        self.sums = np.r_[np.zeros(1, np.uint64), np.cumsum(x.sym * fwd[:-1])]
        sketch = x.sketches().astype(np.uint32)
        for delta in range(rule.widest + 1):
            length = x.size - delta
            tau = rule.threshold(x.kind, length)
            for t in np.unique(tau[tau >= delta]).tolist():
                own = np.flatnonzero(tau == t)
                at, n = segments(length[own], t)
                mark = sketch[own] | np.uint32(t << CLASSES)
                whole = (np.repeat(np.arange(t + 1)[:, None], 2, 1) * [1, 0]) if not delta else None
                for role, place in ((self.index, whole), (self.probe, windows(delta, t))):
                    if place is not None and len(place):
                        i, shift = place.T
                        p, size = at[:, i] + shift, n[:, i]
                        ok = (p >= 0) & (p + size <= x.size[own, None])
                        if ok.all():  # as always where segments are longer than shifts
                            line, key = np.repeat(np.arange(len(own)), len(i)), self._key(x.kind, length[own, None], i, x.start[own, None] + p, size).ravel()
                        else:
                            line, col = np.nonzero(ok)
                            key = self._key(x.kind, length[own][line], i[col], x.start[own][line] + p[ok], size[ok])
                        role.append((key, mark[line], h[own][line]))

    def _key(self, kind: int, length: np.ndarray, i: np.ndarray, a: np.ndarray, n: np.ndarray) -> np.ndarray:
        own = (self.sums[a + n] - self.sums[a]) * self.inv[a]
        return scramble(own ^ ((length << 5) + (i << 1) + kind).astype(np.uint64))


def by_target(parts: list[tuple], bits: int) -> tuple[list[int], list[bytes]]:
    """Entries as bytes, by the first bits of their key."""
    key, sketch, h = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64),) * 3
    target = (key >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)  # 16 bits are sorted by radix
    order = np.argsort(target, kind="stable")
    rows = np.empty((len(key), 2), "<u8")  # an ENTRY each
    rows[:, 0] = ((key & np.uint64((1 << 32) - 1)) | (sketch.astype(np.uint64) << np.uint64(32)))[order]
    rows[:, 1] = h[order]
    ends = np.r_[0, np.cumsum(np.bincount(target, minlength=1 << bits))]
    full = np.flatnonzero(np.diff(ends))
    return full.tolist(), [rows[ends[t] : ends[t + 1]].tobytes() for t in full]


def distinct(rows: np.ndarray) -> np.ndarray:
    """Entries by key, each line of a key once."""
    rows = rows[np.argsort((rows["k"].astype(np.uint64) << np.uint64(32)) | (rows["h"] >> np.uint64(32)))]
    return rows[np.r_[True, (rows["k"][1:] != rows["k"][:-1]) | (rows["h"][1:] != rows["h"][:-1])]] if len(rows) else rows


def candidates(index: np.ndarray, probe: np.ndarray, most: int = HOT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (smaller line, larger line) that share a key and whose sketches
    differ in at most twice the threshold (an edit changes two counts at most); and the
    entries of hot keys (of more than `most` pairs), paired with their neighbours only."""
    index = distinct(index)
    if not len(index):  # a linked line's segment is in the index
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), index
    held = np.zeros(1 << 20, bool)
    held[index["k"] >> np.uint32(12)] = True
    probe = probe[held[probe["k"] >> np.uint32(12)]]
    again = np.r_[False, index["k"][1:] == index["k"][:-1]]
    again[:-1] |= again[1:]
    probe = distinct(np.concatenate([probe, index[again]]))  # lines of one length meet in the index
    lo, hi = np.searchsorted(index["k"], probe["k"]), np.searchsorted(index["k"], probe["k"], side="right")
    probe, lo, n = probe[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    key, first = np.unique(probe["k"], return_index=True)
    total = np.add.reduceat(n, first) if len(n) else n
    hot = key[total > most]
    if len(hot):
        cold = ~np.isin(probe["k"], hot)
        some = distinct(np.concatenate([index[np.isin(index["k"], hot)], probe[~cold]]))
        probe, lo, n = probe[cold], lo[cold], n[cold]
    else:
        some = np.zeros(0, ENTRY)
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for step in range(1, NEXT + 1):
        x, y = some[:-step], some[step:]
        same = x["k"] == y["k"]
        a.append(np.minimum(x["h"][same], y["h"][same]))
        b.append(np.maximum(x["h"][same], y["h"][same]))
    block = np.cumsum(n) // AT_ONCE
    for one in np.unique(block):
        own = np.flatnonzero(block == one)
        src = np.repeat(own, n[own])
        at = np.arange(len(src)) - np.repeat(np.cumsum(n[own]) - n[own], n[own]) + lo[src]
        x, y, s = index["h"][at], probe["h"][src], index["s"][at]
        differ = np.bitwise_count((s ^ probe["s"][src]) & np.uint32((1 << CLASSES) - 1))
        near = (x != y) & (differ <= 2 * (s >> np.uint32(CLASSES)))
        a.append(np.minimum(x[near], y[near]))
        b.append(np.maximum(x[near], y[near]))
    pairs = np.unique(np.rec.fromarrays([np.concatenate(a), np.concatenate(b)], names="a,b"))
    return pairs["a"], pairs["b"], some


def spanning(lines: list[bytes], hashes: np.ndarray, known: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Links between the components `known` that join them as all linked pairs of the lines
    do; fewer than there are components.  Pairs already connected are passed over; lines
    come by hash, as neighbours of similar lines connect little."""
    order = np.argsort(scramble(hashes.view(np.uint64)), kind="stable")
    hashes, known = hashes[order], known[order]
    x = Compared([lines[i] for i in order.tolist()], rule)
    root = np.unique(known, return_inverse=True)[1]
    parts, out, todo, n = len(np.unique(root)), [], [], 0

    def verify() -> None:
        nonlocal parts
        left, right = (np.concatenate(side) for side in zip(*todo))
        for at in range(0, len(left), CHECKED):
            a, b = left[at : at + CHECKED], right[at : at + CHECKED]
            apart_yet = root[a] != root[b]
            a, b = a[apart_yet], b[apart_yet]
            near = x.linked(a, b)
            for i, j in zip(a[near].tolist(), b[near].tolist()):
                if root[i] != root[j]:
                    root[root == root[j]] = root[i]
                    parts -= 1
                    out.append((i, j))

    step = max(1, SIFTED // max(1, len(lines)))  # so many lines are compared with all later ones at a time
    for i in range(0, len(lines), step):
        if parts == 1:
            break
        own, later = np.arange(i, min(i + step, len(lines)))[:, None], np.arange(i + 1, len(lines))
        a, b = np.nonzero((later > own) & (root[own] != root[later]) & x.likely(own, later))
        todo.append((a + i, b + i + 1))
        n += len(a)
        if n >= CHECKED:
            verify()
            todo, n = [], 0
    if n and parts > 1:
        verify()
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return known[a], known[b]


def hot_links(members: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) that are missing between the roots of each hot key's lines, verified, for a
    written table `members(slot, h, root, line)`, roots being the components so far."""
    chunks = {r.slot: -(-r["count"] // LINES) for r in members.groupBy("slot").count().collect()}  # a row a hot key

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A line to all pairs of chunks that its own is one of."""
        for b in batches:
            slot, h = column(b, "slot").to_numpy(), column(b, "h").to_numpy()
            n = np.array([chunks[s] for s in slot.tolist()], np.int64)
            own = (scramble(h.view(np.uint64)) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64)
            for j in range(int(n.max(initial=0))):
                met = (n > j) & ((own != j) | (n == 1))
                yield pa.RecordBatch.from_arrays([column(b, "slot"), pa.array(np.minimum(own, j)), pa.array(np.maximum(own, j)), column(b, "h"), column(b, "root"), column(b, "line")], names=["slot", "i", "j", "h", "root", "line"]).filter(pa.array(met))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = spanning(rows["line"].tolist(), rows["h"].to_numpy(np.int64), rows["root"].to_numpy(np.int64), rule)
        hand_back()
        return pd.DataFrame({"a": a, "b": b})

    dealt = map_batches(members, deal, "slot long, i long, j long, h long, root long, line binary")
    return cut(dealt.groupBy("slot", "i", "j").applyInPandas(meet, "a long, b long"), "line-hot-links")


def within(first: list[bytes], second: list[bytes], rule: Rule) -> np.ndarray:
    """Whether each pair of lines is linked."""
    place: dict[bytes, int] = {}
    for line in (*first, *second):
        place.setdefault(line, len(place))
    a, b = (np.array([place[x] for x in side], np.int64) for side in (first, second))
    return Compared(list(place), rule).linked(a, b)


def near(sym: np.ndarray, s1: np.ndarray, n1: np.ndarray, s2: np.ndarray, n2: np.ndarray, tau: int) -> np.ndarray:
    """Whether the edit distance of each pair of symbol runs is at most tau (tau <= 31).  A
    band of 2 tau + 1 diagonals is kept in one machine word a pair and moves down one row a
    column; the word's top bit is the band's lowest row, whose distance is followed."""
    swap = n1 < n2
    s1, s2 = np.where(swap, s2, s1), np.where(swap, s1, s2)
    n1, n2 = np.maximum(n1, n2), np.minimum(n1, n2)
    out = np.zeros(len(n1), bool)
    same = n1 - n2 <= tau
    for back in (False, True):  # what both begin with, and then what both end with, costs nothing
        for pick in _blocks(np.flatnonzero(same), n2):
            n = _alike(sym, s1[pick], n1[pick], s2[pick], n2[pick], back)
            n1[pick] -= n
            n2[pick] -= n
            if not back:
                s1[pick] += n
                s2[pick] += n
    small = same & (n1 <= tau)
    out[small] = True  # replacing everything is cheap enough
    for pick in _blocks(np.flatnonzero(same & ~small), n1):
        out[pick] = _band(sym, s1[pick], n1[pick], s2[pick], n2[pick], tau)
    return out


def _blocks(todo: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs by their size n, at most 8,192 and about a million symbols at a time."""
    todo = todo[np.argsort(n[todo], kind="stable")]
    size, i = n[todo], 0
    while i < len(todo):
        some = size[i : i + 8192]
        k = max(1, int(np.count_nonzero(np.arange(1, len(some) + 1) * some < 1 << 20)))
        yield todo[i : i + k]
        i += k


def _alike(sym: np.ndarray, s1: np.ndarray, n1: np.ndarray, s2: np.ndarray, n2: np.ndarray, back: bool) -> np.ndarray:
    """How many symbols the runs of each pair (the second is not the longer) agree in from their start, or from their end."""
    i = np.arange(int(n2.max(initial=0)) + 1)
    inside = i < n2[:, None]
    a, b = (np.where(inside, (s + n - 1)[:, None] - i if back else s[:, None] + i, 0) for s, n in ((s1, n1), (s2, n2)))
    return np.argmin(inside & (sym[a] == sym[b]), axis=1)


def _padded(sym: np.ndarray, start: np.ndarray, size: np.ndarray, left: int, width: int, fill: int) -> np.ndarray:
    """Symbol runs as columns, `left` rows down."""
    i = np.arange(width)[:, None] - left
    inside = (i >= 0) & (i < size)
    return np.where(inside, sym[np.where(inside, start + i, 0)], np.uint64(fill))


def _equal(sym: np.ndarray, s1: np.ndarray, m: np.ndarray, s2: np.ndarray, n: np.ndarray, tau: int) -> np.ndarray:
    """A row a column of the band: bit 63 - k is set where row j + tau - k has the column's symbol."""
    longest, bits = int(n.max()), 2 * tau + 1
    # fills that differ: a row beyond the line is never equal to a column
    r = _padded(sym, s1, m, tau, longest + 2 * tau, (1 << 64) - 1)
    c = _padded(sym, s2, n, 0, longest, (1 << 64) - 2)
    same = np.empty((*c.shape, bits), bool)
    for k in range(bits):
        same[:, :, k] = r[2 * tau - k : 2 * tau - k + longest] == c
    packed = np.packbits(same, axis=2)
    eq = packed[:, :, 0].astype(np.uint64) << np.uint64(56)
    for i in range(1, packed.shape[2]):
        eq |= packed[:, :, i].astype(np.uint64) << np.uint64(56 - 8 * i)
    return eq


def _band(sym: np.ndarray, s1: np.ndarray, m: np.ndarray, s2: np.ndarray, n: np.ndarray, tau: int) -> np.ndarray:
    one, top = np.uint64(1), np.uint64(63)
    eq = _equal(sym, s1, m, s2, n, tau)
    vp = np.full(len(m), ((1 << (tau + 1)) - 1) << (63 - tau), np.uint64)
    vn = np.zeros(len(m), np.uint64)
    dist = np.full(len(m), tau, np.int64)
    out, own = np.zeros(len(m), bool), np.arange(len(m))
    above = np.uint64(((1 << (2 * tau + 1)) - 1) << (62 - 2 * tau))  # rows of the band over its lowest
    inner = min(int(n.min()), int(m.min()) - tau)  # columns whose band ends on a row of each line
    for j in range(len(eq)):
        if 0 < j < inner and j % 8 == 0:  # no row of the band is less than its lowest by more than the steps up to it
            open_yet = dist - np.bitwise_count(vp & above) <= tau
            if 4 * np.count_nonzero(open_yet) < 3 * len(own):
                own, m, n, vp, vn, dist = (x[open_yet] for x in (own, m, n, vp, vn, dist))
                eq = eq[:, open_yet]
                if not len(own):
                    break
        d0 = (((eq[j] & vp) + vp) ^ vp) | eq[j] | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        if j < inner:
            dist += (d0 >> top ^ one).view(np.int64)
        else:
            down = j < m - tau  # the band's lowest row is still one of the line's rows
            live = j < n
            dist += np.where(down & live, (d0 >> top ^ one).view(np.int64), 0)
            last = np.clip(62 - (j - (m - tau)), 0, 63).astype(np.uint64)
            dist += np.where(~down & live, (hp >> last & one).astype(np.int64) - (hn >> last & one).astype(np.int64), 0)
        x = d0 >> one
        vp, vn = hn | ~(x | hp), x & hp
    out[own] = dist <= tau
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text); the key tells rows of one doc_id, or of none, apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def places(docs: DataFrame) -> DataFrame:
    """(doc_id, key, line_no, h) of every line of `keyed` rows that isn't white space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, no, h = [], [], []
            for r, t in enumerate(raw(b, "text")):
                for i, line in enumerate(lines_of(t)):
                    if line and not line.isspace():
                        row.append(r)
                        no.append(i)
                        h.append(line_hash(line))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").take(at), column(b, "key").take(at), pa.array(no, pa.int64()), pa.array(np.array(h, np.uint64).view(np.int64))], names=["doc_id", "key", "line_no", "h"])

    return map_batches(docs, run, "doc_id long, key long, line_no long, h long")


def distinct_lines(batch: pa.RecordBatch, rule: Rule, wanted: Bitmap | None = None) -> dict[int, bytes]:
    """A batch's lines by hash, without those that are compared for equality only or not wanted."""
    found: dict[int, bytes] = {}
    for t in raw(batch, "text"):
        for line in lines_of(t):
            # a character is a byte or more, a word two but for the last
            if len(line) >= min(rule.shortest, 2 * rule.words - 1) and not line.isspace():
                found[line_hash(line)] = line
    if wanted is None:
        return found
    hashes = np.fromiter(found, np.uint64, len(found))
    return {h: found[h] for h in hashes[wanted.among(hashes)].tolist()}


def pairs(docs: DataFrame, n_lines: int, rule: Rule) -> DataFrame:
    """Written table of distinct candidate pairs (slot null, a, b) of line hashes, and of
    the lines b of hot keys: (slot, 0, b)."""
    bits, most = max(FEWEST_BITS, math.ceil(math.log2(max(1, n_lines * PER_LINE / PER_TARGET)))), HOT

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 20, 1 << 20):
                found = distinct_lines(piece, rule)
                sig = Signatures(list(found.values()), list(found), rule)
                for role, part in ((0, sig.index), (1, sig.probe)):
                    t, blobs = by_target(part, bits)
                    yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array([role] * len(t), pa.int32()), pa.array(blobs, pa.binary())], names=["target", "role", "entries"])

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        of = [np.frombuffer(b"".join(rows["entries"][rows["role"] == role]), ENTRY) for role in (0, 1)]
        a, b, hot = candidates(*of, most)
        hand_back()
        slot = pd.array(np.r_[np.zeros(len(a), np.int64), (int(key[0]) << 32) + hot["k"].astype(np.int64)], "Int64")
        slot[: len(a)] = pd.NA
        return pd.DataFrame({"slot": slot, "a": np.r_[a.view(np.int64), np.zeros(len(hot), np.int64)], "b": np.r_[b, hot["h"]].view(np.int64)})

    met = map_batches(docs, emit, "target long, role int, entries binary").groupBy("target").applyInPandas(meet, "slot long, a long, b long")
    return cut(met.distinct(), "line-pairs")


def classes(docs: DataFrame, n_lines: int, rule: Rule = RULE) -> DataFrame:
    """(node, root) of every line that is not the smallest hash of its class."""
    met = pairs(docs, n_lines, rule)
    found, hot = met.where("slot is null").select("a", "b"), met.where("slot is not null").select("slot", F.col("b").alias("h"))
    hashes = cut(found.select(F.col("a").alias("h")).union(found.select("b")).union(hot.select("h")).distinct(), "line-hashes")
    wanted = Bitmap(hashes, 4 * hashes.count())  # one in a hundred others passes

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 20):
                own = distinct_lines(piece, rule, wanted)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(list(own), np.uint64).view(np.int64)), pa.array(list(own.values()), pa.binary())], names=["h", "line"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = within(column(b, "line").to_pylist(), column(b, "line2").to_pylist(), rule)
            yield pa.RecordBatch.from_arrays([column(b, "a"), column(b, "b")], names=["a", "b"]).filter(pa.array(linked))

    texts = map_batches(docs, fetch, "h long, line binary").join(hashes, "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    texts = cut(texts, "line-texts")
    both = found.join(texts.select(F.col("h").alias("a"), "line"), "a").join(texts.select(F.col("h").alias("b"), F.col("line").alias("line2")), "b")
    linked = map_batches(both.select("a", "b", "line", "line2"), verify, "a long, b long")
    roots = components(linked)
    if hot.isEmpty():
        return roots
    rooted = cut(hot.join(roots, hot.h == roots.node, "left").select("slot", "h", F.coalesce("root", "h").alias("root")), "line-hot")
    # the segments of near copies give many keys with the same lines: one of them is enough
    same = [F.bit_xor(F.xxhash64("h", F.lit(i))).alias(f"x{i}") for i in range(2)]
    several = rooted.groupBy("slot").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), *same).where("lo <> hi").groupBy("n", "x0", "x1").agg(F.min("slot").alias("slot")).select("slot")
    more = hot_links(cut(rooted.join(several, "slot").join(texts, "h").select("slot", "h", "root", "line"), "line-hot-texts"), rule)
    if more.isEmpty():
        return roots
    joined = components(more).toDF("old", "new")  # roots that turned out to be one class
    return roots.join(joined, roots.root == joined.old, "left").select("node", F.coalesce("new", "root").alias("root")).union(joined)


def dropped(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One row per document with lines to drop: doc_id, key and
    drops array<struct<line_no, first_doc_id, first_line_no>>."""
    docs = keyed(docs)
    occ = cut(places(docs), "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "line_no")
    at = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "key", "line_no")
    lines = cut(occ.groupBy("h").agg((F.min(at) != F.max(at)).alias("several")), "line-tally")
    roots = cut(classes(docs, lines.count(), rule), "line-roots")
    tied = roots.select(F.col("node").alias("h"), "root").union(roots.select("root", "root").distinct())
    # a line of one place that is like no other has nothing to drop
    live = lines.where("several").select("h").join(tied, "h", "full").select("h", F.coalesce("root", "h").alias("root"))
    met = cut(occ.join(live, "h").drop("h"), "line-live")
    least = cut(met.groupBy("root").agg(F.min(place).alias("kept"), F.count("*").alias("n")), "line-least")
    # the places of a large class stay where they are
    large, small = (least.where(x).select("root", "kept") for x in (F.col("n") > MANY, F.col("n") <= MANY))
    of_large = met.join(F.broadcast(large), "root")
    of_small = met.join(F.broadcast(large), "root", "left_anti").join(small, "root")
    gone = of_large.union(of_small).where(~place.eqNullSafe(F.col("kept")))
    drop = F.struct("line_no", F.col("kept.doc_id").alias("first_doc_id"), F.col("kept.line_no").alias("first_line_no"))
    return gone.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(drop)).alias("drops"))


def _dropping(docs: DataFrame, rule: Rule) -> DataFrame:
    """`docs` with the column __drops; only documents that have some are shuffled."""
    found = cut(dropped(docs, rule).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("drops").alias("__drops")), "line-drops")
    hit, rest = apart(docs, found.select(F.col("__id").alias("doc_id")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    met = hit.join(found, same, "left").drop("__id", "__key")
    return met.unionByName(rest.withColumn("__drops", F.lit(None).cast(found.schema["__drops"].dataType)))


def _left() -> Column:
    """The text without its dropped lines, in SQL functions."""
    gone = F.transform("__drops", lambda d: d["line_no"].cast("int"))

    def joined(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    text = F.col("text").cast("string")
    # the one-element array binds the lines once
    return F.when(F.col("__drops").isNull(), text).otherwise(F.transform(F.array(F.split(text, "\n", -1)), joined)[0])


def dedup(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text has lost its repeated
    lines; `n_chars`, if there, is the new text's number of characters."""
    out = _dropping(docs, rule).withColumn("text", _left()).select(*docs.columns)
    kind = dict(docs.dtypes).get("n_chars")
    return out.withColumn("n_chars", F.length("text").cast(kind)) if kind in ("bigint", "int") else out


def report(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_dropped, the text that stays, and
    drops array<struct<line_no, first_doc_id, first_line_no>>."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(1))
    drops = F.coalesce("__drops", F.array().cast("array<struct<line_no: long, first_doc_id: long, first_line_no: long>>"))
    return _dropping(docs, rule).select("doc_id", n_lines.cast("long").alias("n_lines"), F.size(drops).cast("long").alias("n_dropped"), _left().alias("text"), drops.alias("drops"))
