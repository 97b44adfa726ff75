"""M3 as a recurrent model: an LSTM over a row's history, trained on Spark.

Training is synchronous and data-parallel.  Rows are packed once into blocks of at most
``BLOCK`` rows, dealt to ``steps`` mini-batches by the hash of their key, so a mini-batch is
the same rows however the table is partitioned.  A step is a job over one mini-batch's
blocks: tasks sum the gradients of their blocks, a few reducers sum the tasks', and
the driver takes one Adam step.  The model of the epoch with the best validation AUC is
kept (on a share of the rows chosen by hash), and training stops when it no longer rises.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskspark import config
from riskspark.functions.scalar import hash_unit
from riskspark.operators.split import class_weights
from riskspark.session import fresh_folder

#: Rows of a block, reducers of a step's gradients, and bins of the validation's scores.
BLOCK, REDUCERS, BINS = 1024, 16, 4096
#: Rows that go through the network together (what they need fits a core's cache).
TOGETHER = 256


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Lstm:
    """Weights: gates (input, forget, cell, output) from [x, h, 1], and the output from [h, 1]."""

    gates: np.ndarray
    out: np.ndarray

    @classmethod
    def fresh(cls, width: int, hidden: int, seed: int) -> Lstm:
        rng = np.random.default_rng(seed)
        gates = rng.normal(size=(width + hidden + 1, 4 * hidden)) / np.sqrt(width + hidden)
        gates[-1] = 0.0
        gates[-1, hidden : 2 * hidden] = 1.0  # remember at first
        return cls(gates, np.r_[rng.normal(size=hidden) / np.sqrt(hidden), 0.0])

    @property
    def hidden(self) -> int:
        return len(self.out) - 1

    def flat(self) -> np.ndarray:
        return np.r_[self.gates.ravel(), self.out]

    def like(self, flat: np.ndarray) -> Lstm:
        return Lstm(flat[: self.gates.size].reshape(self.gates.shape), flat[self.gates.size :])

    def forward(self, x: np.ndarray, back: bool = True) -> tuple[np.ndarray, list]:
        """P(1) of rows x (rows, steps, features), and what going back needs if it is asked for.  Rows lie side by side, those that begin
        first in front, so that a step computes only rows that have begun.  One exponential gives all gates."""
        n, steps, _ = x.shape
        k = self.hidden
        live = (x != 0).any(2)  # a padding step leaves the state as it is
        begin = np.where(live.any(1), live.argmax(1), steps)
        order = begin.argsort(kind="stable")
        begun = np.searchsorted(begin[order], np.arange(steps), "right")
        x, live = x[order].transpose(1, 2, 0), live[order].T
        scale = np.repeat([-1.0, -1.0, -2.0, -1.0], k)
        gates = np.ascontiguousarray((self.gates * scale).T)
        h, c, seen = np.zeros((k, n)), np.zeros((k, n)), []
        for t in range(steps):
            m = int(begun[t])
            z = np.concatenate([x[t, :, :m], h[:, :m], np.ones((1, m))])
            s = logistic(gates @ z)
            i, f, g, o = s.reshape(4, k, m)
            g *= 2
            g -= 1
            before, all_live = c[:, :m], live[t, :m].all()
            now = f * before
            now += i * g
            if not all_live:
                now = np.where(live[t, :m], now, before)
            squashed = logistic(-2 * now)
            squashed *= 2
            squashed -= 1
            out = o * squashed
            if not all_live:
                out = np.where(live[t, :m], out, h[:, :m])
            if back:
                seen.append((z, s, before, squashed, None if all_live else live[t, :m]))
            h, c = (v if m == n else np.concatenate([v, np.zeros((k, n - m))], 1) for v in (out, now))
        last = np.concatenate([h, np.ones((1, n))])
        p = np.empty(n)
        p[order] = sigmoid(self.out @ last)
        return p, [order, last, seen]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """P(1) of any number of rows."""
        return np.concatenate([self.forward(x[i : i + TOGETHER], False)[0] for i in range(0, len(x), TOGETHER)] or [np.zeros(0)])

    def gradient(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient and sum of the weighted log losses of the rows."""
        grad, loss = np.zeros(self.gates.size + len(self.out)), 0.0
        for i in range(0, len(x), TOGETHER):
            g, own = self._gradient(*(v[i : i + TOGETHER] for v in (x, y, w)))
            grad += g
            loss += own
        return grad, loss

    def _gradient(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        p, (order, last, seen) = self.forward(x)
        loss = -(w * (y * np.log(np.maximum(p, 1e-12)) + (1 - y) * np.log(np.maximum(1 - p, 1e-12)))).sum()
        k, slope = self.hidden, (w * (p - y))[order]
        d_out, d_gates = last @ slope, np.zeros_like(self.gates)
        dh, dc, back = self.out[:-1, None] * slope, np.zeros((k, len(x))), np.ascontiguousarray(self.gates[-k - 1 : -1])
        for z, s, before, squashed, live in reversed(seen):
            m = z.shape[1]
            i, f, g, o = s.reshape(4, k, m)
            da = np.empty((4, k, m))
            of_out = dh[:, :m] * o
            np.multiply(of_out * squashed, 1 - o, out=da[3])
            own = 1 - squashed**2
            own *= of_out
            own += dc[:, :m]
            kept = own * f
            np.multiply(kept * before, 1 - f, out=da[1])
            of_in = own * i
            np.multiply(of_in, 1 - g**2, out=da[2])
            of_in *= g
            np.multiply(of_in, 1 - i, out=da[0])
            if live is not None:
                da *= live
                kept = np.where(live, kept, dc[:, :m])
            da = da.reshape(4 * k, m)
            d_gates += z @ da.T
            before_h = back @ da
            dh[:, :m] = before_h if live is None else np.where(live, before_h, dh[:, :m])
            dc[:, :m] = kept
        return np.r_[d_gates.ravel(), d_out], float(loss)


def logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in the place of x."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def arrays(seq: pa.Array) -> np.ndarray:
    """Arrow's lists of steps as (rows, steps, features)."""
    steps = seq.flatten()
    values = steps.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(seq), len(steps) // max(len(seq), 1), len(values) // max(len(steps), 1))


def packed(rows: DataFrame, steps: int, seed: int) -> DataFrame:
    """A written table ``(n, data, batch)`` of blocks; batch -1 is the validation share."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(batch: int, own: list) -> pa.RecordBatch:
            x, y, w = (np.concatenate(v) for v in zip(*own))
            return pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), "data": pa.array([pickle.dumps((x, y, w))], pa.binary()),
                                               "batch": pa.array([batch], pa.int32())})

        for part in batches:
            if not part.num_rows:
                continue
            of = part["batch"].to_numpy()
            columns = [arrays(part["seq"]), *(part[c].to_numpy(zero_copy_only=False) for c in ("label", "weight"))]
            for batch in np.unique(of):
                rows, own = np.flatnonzero(of == batch), held.setdefault(int(batch), [])
                while len(rows):
                    now = rows[: BLOCK - sum(len(v[0]) for v in own)]
                    own.append(tuple(c[now].astype(np.float32) for c in columns))
                    rows = rows[len(now) :]
                    if sum(len(v[0]) for v in own) == BLOCK:
                        yield block(int(batch), own)
                        own = held[int(batch)] = []
        for batch, own in held.items():
            if own:
                yield block(batch, own)

    blocks = rows.select("batch", "seq", "label", "weight").mapInArrow(pack, "n int, data binary, batch int")
    path = fresh_folder(rows.sparkSession, "blocks")  # a folder for each batch: a step reads its own rows only
    blocks.write.partitionBy("batch").parquet(path)
    return rows.sparkSession.read.schema(blocks.schema).parquet(path)


def summed(blocks: DataFrame, per_block, size: int) -> tuple[np.ndarray, int]:
    """Sum over the blocks of ``per_block(x, y, w)`` (a vector), and their rows; at most
    ``REDUCERS`` vectors reach the driver."""
    def of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(size), 0
        for part in batches:
            for data in part["data"]:
                x, y, w = pickle.loads(data)
                total += per_block(x.astype(np.float64), y.astype(np.float64), w.astype(np.float64))
                n += len(x)
        if n:
            yield pd.DataFrame({"v": [total.tobytes()], "n": [n]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"v": [sum(np.frombuffer(v) for v in rows["v"]).tobytes()], "n": [rows["n"].sum()]})

    parts = blocks.mapInPandas(of_task, "v binary, n long").withColumn("r", F.spark_partition_id() % REDUCERS)
    found = parts.groupBy("r").applyInPandas(add, "v binary, n long").collect()
    return sum((np.frombuffer(r["v"]) for r in found), np.zeros(size)), sum(r["n"] for r in found)


def binned_auc(counts: np.ndarray) -> float:
    """ROC-AUC from counts of negatives and positives by score bin."""
    neg, pos = counts.reshape(2, -1)
    below = np.cumsum(neg) - neg
    return float((pos * (below + neg / 2)).sum() / max(neg.sum() * pos.sum(), 1.0))


def fit_sequence_lstm(train: DataFrame, *, hidden: int = 32, steps: int = 8, epochs: int = 12, patience: int = 3, rate: float = 0.01,
                      validation_share: float = 0.15, key: str = "TransactionID", label: str = "label",
                      seed: int = config.RANDOM_SEED) -> Lstm:
    """M3: class-weighted (capped), early-stopped LSTM on ``(key, label, seq)`` rows."""
    weight = class_weights(train, label).first()["weight_pos"]
    held = hash_unit(seed, key) < validation_share
    batch = F.when(held, -1).otherwise(F.pmod(F.xxhash64(F.col(key)), F.lit(steps))).cast("int")
    rows = train.select(F.col("seq"), F.col(label).cast("double").alias("label"), batch.alias("batch"),
                        F.when(F.col(label) == 1, float(weight or 1.0)).otherwise(1.0).alias("weight"))
    blocks = packed(rows, steps, seed)
    first = blocks.first()
    if first is None:
        raise ValueError("no rows to train on")
    model = Lstm.fresh(pickle.loads(first["data"])[0].shape[2], hidden, seed)
    flat, m, v = model.flat(), 0.0, 0.0
    best, best_auc, stale, t = flat, -1.0, 0, 0
    for _ in range(epochs):
        for s in range(steps):
            now = model.like(flat)
            grad, n = summed(blocks.filter(F.col("batch") == s), lambda x, y, w, now=now: now.gradient(x, y, w)[0], len(flat))
            if not n:
                continue
            t += 1
            grad = grad / n
            grad *= min(1.0, 1.0 / max(float(np.linalg.norm(grad)), 1e-12))  # clipped to length 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            flat = flat - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        now = model.like(flat)
        counts, n = summed(blocks.filter("batch = -1"), lambda x, y, w, now=now: score_bins(now, x, y), 2 * BINS)
        auc = binned_auc(counts) if n else 0.0
        if auc > best_auc:
            best, best_auc, stale = flat, auc, 0
        else:
            stale += 1
            if stale >= patience:
                break
    return model.like(best)


def score_bins(model: Lstm, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    at = np.minimum((model.scores(x) * BINS).astype(np.int64), BINS - 1)
    return np.bincount(at + BINS * (y > 0.5), minlength=2 * BINS).astype(float)


def score_sequence_lstm(model: Lstm, df: DataFrame, keep=("TransactionID", "uid", "label")) -> DataFrame:
    """P(1) per row, by Arrow batch."""
    cols = [c for c in keep if c in df.columns]
    flat, shape = model.flat(), model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shape.like(flat)
        for rows in batches:
            p = own.scores(arrays(rows["seq"]).astype(np.float64)) if rows.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in cols), pa.array(p)], [*cols, "score"])

    schema = StructType([*df.select(*cols).schema.fields, StructField("score", DoubleType())])
    return df.select(*cols, "seq").mapInArrow(score, schema)
