"""Order-preserving packing of documents into fixed token windows by dynamic
programming.

Each input partition's documents, in order, form one token stream.  Windows may
end at documents' ends (free), after sentences (`SENTENCE` padding tokens' worth)
or, inside long sentences, every `STEP` tokens (`INSIDE`).  With cut positions p
the best cost f(j) = min over p_j - p_i <= size of f(i) + size - (p_j - p_i) +
penalty(j); the minimum of f(i) + p_i over the sliding window comes from a
monotone queue.  Windows of exactly size / 2 or size / 4 tokens need no padding
and are tried as well.  The stream is handled batch by batch: a batch's windows
are settled up to its last window, whose tokens go to the next batch, so memory
is bounded by a batch.  What remains at a partition's end is cut into windows of
powers of two, which need no padding.

A null text is empty; every row, repeated or not, is a document of its own and
ends in the id `end`.  Sequence ids hold the partition's number above 2**32.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm.common import column, map_batches, rows_in_pieces

SIZE = 4096
SENTENCE, INSIDE, STEP = 16, 256, 512
#: Stems a worker keeps before it goes back to those of its last batch.
CACHE = 1 << 18
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Token ids of texts.  The tokenizer drops white space and no token spans it,
    so a text's ids are its white-space separated words' ids one after another.  Distinct
    words are tokenized in one go, and those of a batch kept for the next ones."""

    _made: dict[str, Ids] = {}

    @classmethod
    def of(cls, path: str) -> Ids:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.sentence_end = self.word_end.copy()
        for s, i in vocab.items():
            self.word_end[i] = s.endswith("</w>")
            self.sentence_end[i] = s.endswith("</w>") and s[0] in ".!?"
        #: stems kept, by number; where the ids of each start in `flat`, and how many they are
        self.kept: dict[str, int] = {}
        self.flat, self.start, self.n = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stems, and where each stem's ids start and how many they are."""
        at = np.fromiter(map(self.kept.get, stems, repeat(-1)), np.int64, len(stems))
        unknown = np.flatnonzero(at < 0)
        new = [stems[i] for i in unknown]
        flat, start, n = self._encode(new)
        at[unknown] = np.arange(len(new)) + len(self.n)
        self.kept.update(zip(new, at[unknown].tolist()))
        self.start = np.r_[self.start, start + len(self.flat)]
        self.flat, self.n = np.r_[self.flat, flat], np.r_[self.n, n]
        start, n = self.start[at], self.n[at]
        if len(self.kept) > CACHE:  # this batch's stems stay
            self.flat, self.n = take(self.flat, start, n), n
            self.start = start = np.cumsum(n) - n
            self.kept = dict(zip(stems, range(len(stems))))
        return self.flat, start, n

    def _encode(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        blobs, of, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # letters alone are one pre-token each, so have one word end each
        every = pa.array(stems, pa.string())
        letters = pc.ascii_is_alpha(every).to_numpy(zero_copy_only=False).copy()
        for i in np.flatnonzero(~pc.string_is_ascii(every).to_numpy(zero_copy_only=False)).tolist():
            letters[i] = stems[i].isalpha() and unicodedata.normalize("NFC", stems[i]).lower().isalpha()
        alone = np.flatnonzero(letters).tolist()
        single = np.ones(len(stems), bool)
        for i in range(0, len(alone), 2000):
            part = alone[i : i + 2000]
            ids = np.array(self.tok.encode_batch_fast([" ".join([stems[j] for j in part])], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) == len(part):
                single[part] = False
                blobs.append(ids)
                of.append(np.array(part))
                n.append(np.diff(np.r_[0, ends]))
        rest = np.flatnonzero(single)
        found = [e.ids for e in self.tok.encode_batch_fast([stems[j] for j in rest], add_special_tokens=False)]
        blobs.append(np.fromiter(chain.from_iterable(found), np.uint32))
        of.append(rest)
        n.append(np.fromiter(map(len, found), np.int64, len(found)))
        order, size = np.concatenate(of), np.concatenate(n)
        start, count = np.zeros(len(stems), np.int64), np.zeros(len(stems), np.int64)
        start[order], count[order] = np.cumsum(size) - size, size
        return np.concatenate(blobs), start, count

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's number of ids."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        encoded = split.flatten().dictionary_encode()
        words, index = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
        # ASCII case goes; a last "," or "." after a letter or digit is a pre-token of its own
        plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
        words = pc.if_else(plain, pc.ascii_lower(words), words)
        marked = pc.match_substring_regex(words, "[0-9A-Za-z][,.]$")
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        flat, start, n = self.stems([*stems.dictionary.to_pylist(), ",", "."])
        stem = stems.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        mark = len(n) - 2 + pc.ends_with(words, ".").to_numpy(zero_copy_only=False).astype(np.int64)
        has = marked.to_numpy(zero_copy_only=False).astype(np.int64)
        # a word is two runs: its stem's ids and its mark's, if it has one
        sizes = np.stack([n[stem], n[mark] * has], 1)
        flat, n = take(flat, np.stack([start[stem], start[mark]], 1).ravel(), sizes.ravel()), sizes.sum(1)
        each = n[index]
        out = take(flat, (np.cumsum(n) - n)[index], each)
        ends = np.r_[0, np.cumsum(each)]
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return out, ends[offsets[1:]] - ends[offsets[:-1]]


def take(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + n], one after another."""
    first = np.cumsum(n) - n
    return flat[np.arange(int(n.sum())) + np.repeat(start - first, n)]


def cuts(ends: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """Ends of the cheapest windows over cut positions `ends` (ascending, at most
    `size` apart) with penalties `cost`; they reach into the last `size` tokens."""
    places = np.r_[0, ends]
    pos, pen = places.tolist(), [0, *cost.tolist()]
    halves = []
    for h in (size // 2, size // 4):
        if h and h & (h - 1) == 0:  # the cut h tokens earlier, if there is one
            k = np.searchsorted(places, places - h)
            halves.append(np.where(places[k] == places - h, k, -1).tolist())
    f, back = [0] * len(pos), [0] * len(pos)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(i) + p_i, i), ascending
    for j in range(1, len(pos)):
        p = pos[j]
        while p - pos[queue[0][1]] > size:
            queue.popleft()
        best, i = queue[0]
        best += size - p
        for earlier in halves:
            k = earlier[j]
            if k >= 0 and f[k] < best:
                best, i = f[k], k
        f[j] = best + pen[j]
        back[j] = i
        g = f[j] + p
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, j))
    first = min(int(np.searchsorted(places, pos[-1] - size, side="right")), len(pos) - 1)
    last = min(range(first, len(pos)), key=lambda j: (f[j], -j))
    out = []
    while last:
        out.append(pos[last])
        last = back[last]
    return out[::-1]


def tail_cuts(n: int, size: int) -> list[int]:
    """Ends of windows over the last n < size tokens: powers of two, or one padded
    window if it is nearly full."""
    out, at = [], 0
    while at < n:
        left = n - at
        at += left if left > size - size // 64 else 1 << (left.bit_length() - 1)
        out.append(at)
    return out


class Packer:
    """One partition's stream.  `held` are the tokens not yet packed, `parts` the
    runs of documents in them: (doc_id, document's tokens, first token, length)."""

    def __init__(self, ids: Ids, end: int, size: int, first_sequence: int):
        self.ids, self.end, self.size, self.sequence = ids, end, size, first_sequence
        self.held, self.parts = np.zeros(0, np.uint32), []

    def add(self, doc_ids: list, texts: pa.Array) -> Iterator[tuple]:
        flat, n = self.ids.texts(texts)
        flat = np.insert(flat, np.cumsum(n), self.end)
        self.held = np.concatenate([self.held, flat])
        self.parts += [(d, k, 0, k) for d, k in zip(doc_ids, (n + 1).tolist())]
        known = np.cumsum([p[3] for p in self.parts])  # every document's end, those held over too
        kind = np.zeros(len(self.held) + 1, np.uint8)  # of each place: 1 after a sentence, 2 a document, 3 inside
        kind[1:] = self.ids.sentence_end[self.held]
        kind[known] = 2
        ends = np.flatnonzero(kind)
        gaps = np.diff(np.r_[0, ends])
        inner = [np.arange(e - g + STEP, e, STEP) for e, g in zip(ends[gaps > STEP].tolist(), gaps[gaps > STEP].tolist())]
        for places in inner:
            kind[places] = 3
        every = np.flatnonzero(kind)
        cost = np.array([0, SENTENCE, 0, INSIDE])[kind[every]]
        if len(self.held) > self.size:
            yield from self._emit(cuts(every, cost, self.size))

    def finish(self) -> Iterator[tuple]:
        while len(self.held) > self.size:
            yield from self._emit([self.size])
        yield from self._emit(tail_cuts(len(self.held), self.size))

    def _emit(self, ends: list[int]) -> Iterator[tuple]:
        at, begin, parts = 0, 0, deque(self.parts)
        for end in ends:
            while at < end:
                doc, total, start, n = parts.popleft()
                k = min(n, end - at)
                yield doc, start, k, zlib.crc32(self.held[at : at + k].tobytes()), total, self.sequence, at - begin
                at += k
                if k < n:
                    parts.appendleft((doc, total, start + k, n - k))
            begin = end
            self.sequence += 1
        self.held, self.parts = self.held[at:], list(parts)


def pack(docs: DataFrame, tokenizer: str, end: int = 2, size: int = SIZE) -> DataFrame:
    """One row per piece: a run of a document's ids and its place in a sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(Ids.of(tokenizer), end, size, TaskContext.get().partitionId() << 32)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) if found else [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in PIECES.split(", ")])

        for b in batches:
            for piece in rows_in_pieces(b, 1 << 20):
                yield rows(list(packer.add(column(piece, "doc_id").to_pylist(), column(piece, "text"))))
        yield rows(list(packer.finish()))

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, PIECES)
