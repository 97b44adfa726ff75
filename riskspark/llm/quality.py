"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

Words and runs of marks, case kept, are hashed to `BUCKETS` buckets.  Each bucket
has a fixed sparse random index vector; its word vector is the sum of the index
vectors of the words up to two places away, over all whole documents.  A document
is the weighted mean and spread of its words' unit vectors, frequent words weighing
less, with how alike neighbours' index and word vectors are on average, and any two words'
index vectors (words said over and over), the mean word length and the length.  The network learns from at most `sample` labelled documents, a fifth of which
only set the temperature that minimises their log loss.

Null and empty texts are pooled to zeros and scored like any other.  Labels that are
null or neither 0 nor 1 are left out; a doc_id with several labels has the largest.
With fewer than two labels of either kind the score is the share of ones (0.5 if
there are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import tokens
from riskspark.llm.common import column, cut, held_out, map_batches, raw, rows_in_pieces

BUCKETS, DIM, NEAR = 8192, 32, 2
#: Buckets that travel together; partial sums first meet in `SALTS` groups each.
CHUNK, SALTS = 256, 32
SAMPLE, THRESHOLD = 20_000, 0.3


def index_vectors() -> np.ndarray:
    """Fixed ternary vectors, four entries of +1 or -1 each."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIM), np.int32)
    for k in range(4):
        out[np.arange(BUCKETS), rng.integers(0, DIM, BUCKETS)] += rng.choice([-1, 1], BUCKETS).astype(np.int32)
    return out


def buckets(texts: list[bytes | None]) -> tuple[np.ndarray, tokens.Runs]:
    r = tokens.runs(texts, tokens.KINDS)
    return (r.hashes() % np.uint64(BUCKETS)).astype(np.int64), r


def contexts(bucket: np.ndarray, text: np.ndarray, index: np.ndarray) -> np.ndarray:
    """BUCKETS x (DIM + 1): sums of neighbours' index vectors, and occurrences."""
    own = index[bucket]
    near = np.zeros_like(own)
    for k in range(1, NEAR + 1):
        same = (text[k:] == text[:-k])[:, None]
        near[k:] += own[:-k] * same
        near[:-k] += own[k:] * same
    out = np.zeros((BUCKETS, DIM + 1), np.int64)
    if len(bucket):
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        out[found, :DIM] = np.add.reduceat(near[order], first, axis=0)
        out[found, DIM] = np.diff(np.r_[first, len(bucket)])
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """`contexts` over all documents; a table of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((BUCKETS, DIM + 1), np.int64)
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 20, 2 << 20):
                found, r = buckets(raw(piece, "text"))
                total += contexts(found, r.text, index)
        parts = total.reshape(-1, CHUNK, DIM + 1)
        full = np.flatnonzero(parts[:, :, DIM].any(1))
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array([salt] * len(full), pa.int64()), pa.array([_packed(parts[i]) for i in full], pa.binary())], names=["chunk", "salt", "sums"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpacked(x) for x in rows["sums"])
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "sums": [_packed(total)]})

    partial = map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "chunk long, salt long, sums binary")
    once = partial.groupBy("chunk", "salt").applyInPandas(add, "chunk long, sums binary")
    out = np.zeros((BUCKETS // CHUNK, CHUNK, DIM + 1), np.int64)
    for r in once.groupBy("chunk").applyInPandas(add, "chunk long, sums binary").collect():  # a row a chunk
        out[r.chunk] = _unpacked(bytes(r.sums))
    return out.reshape(BUCKETS, DIM + 1)


def _packed(part: np.ndarray) -> bytes:
    """The rows that aren't zero, in the narrowest integers that hold them."""
    full = np.flatnonzero(part.any(1))
    rows = part[full]
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if not rows.size or np.abs(rows).max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + len(full).to_bytes(4, "little") + full.astype(np.uint16).tobytes() + rows.astype(kind).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[1:5], "little")
    out = np.zeros((CHUNK, DIM + 1), np.int64)
    full = np.frombuffer(blob, np.uint16, n, 5)
    out[full] = np.frombuffer(blob, f"<i{blob[0]}", n * (DIM + 1), 5 + 2 * n).reshape(n, DIM + 1)
    return out


WIDTH = 2 * DIM + 5


class Pooler:
    """Unit word vectors and word weights; pools texts to WIDTH numbers."""

    def __init__(self, sums: np.ndarray):
        ctx, n = sums[:, :DIM].astype(np.float64), sums[:, DIM].astype(np.float64)
        self.vec = (ctx / np.maximum(np.linalg.norm(ctx, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        share = n / max(n.sum(), 1)
        index = index_vectors().astype(np.float64)
        self.index = (index / np.maximum(np.linalg.norm(index, axis=1, keepdims=True), 1)).astype(np.float32)
        self.weight = (1e-2 / (1e-2 + share)).astype(np.float32)

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        bucket, r = buckets(texts)
        w = self.weight[bucket][:, None]
        v = self.vec[bucket] * w
        total = np.maximum(tokens.sum_by_text(w, r.first), 1e-9)
        mean = tokens.sum_by_text(v, r.first) / total
        spread = np.sqrt(np.maximum(tokens.sum_by_text(v * self.vec[bucket], r.first) / total - mean * mean, 0))
        n = np.maximum(np.diff(r.first), 1)[:, None]
        inside = np.r_[False, r.text[1:] == r.text[:-1]] if len(bucket) else np.zeros(0, bool)
        alike = [np.where(inside, (t[bucket] * t[np.roll(bucket, 1)]).sum(1), 0)[:, None] for t in (self.index, self.vec)]
        pairs = np.maximum(n - 1, 1)
        whole = tokens.sum_by_text(self.index[bucket], r.first)
        said = ((whole * whole).sum(1, keepdims=True) - n) / np.maximum(n * (n - 1), 1)
        size = tokens.sum_by_text((r.end - r.start).astype(np.float32)[:, None], r.first) / n
        return np.concatenate([mean, spread, *(tokens.sum_by_text(a, r.first) / pairs for a in alike), said, np.log1p(size), np.log(n)], 1).astype(np.float32)


class Network:
    """Two layers: tanh units, then one logit over a temperature."""

    def __init__(self, inputs: int, hidden: int = 32, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.shift, self.scale = np.zeros(inputs), np.ones(inputs)
        self.p = [rng.normal(0, inputs**-0.5, (inputs, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.temperature, self.constant = 1.0, None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.p
        return np.tanh((x - self.shift) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Network:
        if min(y.sum(), len(y) - y.sum()) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        rng = np.random.default_rng(1)
        # at least one of either kind on both sides
        order = np.concatenate([rng.permutation(np.flatnonzero(y == k)) for k in (0, 1)])
        aside = np.zeros(len(y), bool)
        aside[order[::5]] = True
        if min(y[~aside].sum(), (1 - y[~aside]).sum()) == 0:
            aside[:] = False
        fx, fy = x[~aside].astype(np.float64), y[~aside].astype(np.float64)
        self.shift, self.scale = fx.mean(0), fx.std(0) + 1e-6
        m, v, t = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(epochs):
            order = rng.permutation(len(fy))
            for i in range(0, len(order), batch):
                own = order[i : i + batch]
                z = (fx[own] - self.shift) / self.scale
                h = np.tanh(z @ self.p[0] + self.p[1])
                g = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3][0], -30, 30))) - fy[own]) / len(own)
                back = g[:, None] * self.p[2] * (1 - h * h)
                t += 1
                for k, grad in enumerate((z.T @ back, back.sum(0), h.T @ g, np.array([g.sum()]))):
                    grad = grad + decay * self.p[k]
                    m[k] += 0.1 * (grad - m[k])
                    v[k] += 0.001 * (grad * grad - v[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        if aside.any():
            z, cy, grid = self.logits(x[aside].astype(np.float64)), y[aside], np.exp(np.linspace(-2, 3, 101))
            loss = [np.logaddexp(0, np.where(cy == 1, -z, z) / temp).mean() for temp in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self


def labelled(labels: DataFrame, name: str, mod: int, rest: int, sample: int) -> DataFrame:
    """At most `sample` (doc_id, label) rows that aren't held out, by hash order."""
    rows = labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", mod, rest))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(name).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def scored(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pooler = Pooler(word_vectors(docs))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in rows_in_pieces(b, 1 << 20, 2 << 20):
                x = pooler(raw(piece, "text"))
                yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    features = cut(map_batches(docs, pool, "doc_id long, x binary"), "quality-features")
    known = labelled(labels, "quality", mod, rest, sample)
    rows = features.join(known, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("label").alias("label")).orderBy("doc_id").collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(len(rows), WIDTH)
    net = Network(WIDTH).fit(x, np.array([r.label for r in rows], np.int64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = net.scores(np.frombuffer(b"".join(column(b, "x").to_pylist()), np.float32).reshape(b.num_rows, WIDTH).astype(np.float64))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "held_out"), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    picked = features.select("doc_id", held_out("doc_id", mod, rest).alias("held_out"), "x")
    return map_batches(picked, score, "doc_id long, held_out boolean, score double, predicted int")
