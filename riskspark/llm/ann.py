"""Approximate nearest neighbours by an inverted multi-index.

Each half of the vectors is quantised on its own to `k` centroids (k-means on a
bounded sample of `sample` rows); a vector's cell is its pair of nearest centroids.
A query's distance to a centroid is how far the centroid's inner product with the
query's half falls short of the best one; pairs are traversed by summed distance
with a heap until their cells hold `share` of all vectors, and all entries of those
cells are reranked by exact inner product on the original vectors.  The share is
the same at every size, so recall doesn't fall as the table grows.

Vectors are laid out once, in blocks of about `block` entries of neighbouring cells; a
cell with more is spread over several.  Queries go to the blocks that hold a cell they
traverse and stream past them, `chunk` at a time, and pass on their best `top` of each
block; a block asked by more than `ASKED` queries is read by several tasks.

Rows with a null vec_id, and vectors that are null, zero, hold null or non-finite
components or don't have the table's most common length, take no part.  Of rows
that repeat a vec_id one counts (that with the smallest bytes).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import column, cut, map_batches

FOUND = "query_id long, vec_id long, score double"
#: Queries that one task takes past a block.
ASKED = 1 << 16


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v) with v the components as float64 bytes, for the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, v in zip(column(b, "vec_id").to_pylist(), column(b, "embedding").to_pylist()):
                if i is None or not v or None in v:
                    continue
                x = np.array(v, np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    rows = map_batches(table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), run, "vec_id long, v binary")
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    x = np.unique(x, axis=0)
    c = x[np.random.default_rng(0).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)


class Index:
    """Centroids of both halves, the cells' sizes, and the cells' first blocks."""

    def __init__(self, halves: tuple[np.ndarray, np.ndarray], dim: int, block: int):
        self.halves, self.dim, self.block = halves, dim, block
        self.shape = (len(halves[0]), len(halves[1]))
        self.sizes = np.zeros(self.shape[0] * self.shape[1], np.int64)

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.dim // 2], x[:, self.dim // 2 :]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (nearest(h, c) for h, c in zip(self.split(x), self.halves))
        return a * self.shape[1] + b

    def lay_out(self, sizes: dict[int, int]) -> None:
        """Cells in order, filled into blocks; a large cell gets blocks of its own."""
        self.first, self.parts = np.zeros(len(self.sizes), np.int64), np.ones(len(self.sizes), np.int64)
        at = used = 0
        for cell in sorted(sizes):
            n = self.sizes[cell] = sizes[cell]
            if used and used + n > self.block:
                at, used = at + 1, 0
            self.first[cell], self.parts[cell] = at, max(1, math.ceil(n / self.block))
            at, used = (at + int(self.parts[cell]), 0) if n > self.block else (at, used + int(n))
        self.blocks = at + (used > 0)

    def distances(self, q: np.ndarray) -> list[np.ndarray]:
        """How far each centroid of a half falls short of the best one, per query."""
        ip = [h @ c.T for h, c in zip(self.split(q), self.halves)]
        return [x.max(1, keepdims=True) - x for x in ip]

    def reach(self, d1: np.ndarray, d2: np.ndarray, enough: int) -> float:
        """Summed distance of the last pair that one query traverses."""
        o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        heap, held, far = [(s1[0] + s2[0], 0, 0)], 0, 0.0
        while heap and held < enough:
            far, i, j = heapq.heappop(heap)
            held += int(self.sizes[o1[i] * self.shape[1] + o2[j]])
            if j + 1 < len(o2):
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(o1):
                heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
        return far


def matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dim)


def best_of_block(qid: np.ndarray, q: np.ndarray, reach: np.ndarray, vid: np.ndarray, v: np.ndarray, index: Index, top: int) -> pd.DataFrame:
    """The `top` of each query among the block's entries in cells it traverses."""
    cell = index.cells(v)
    c1, c2 = np.divmod(cell, index.shape[1])
    out = []
    for i in range(0, len(q), 128):
        own = slice(i, i + 128)
        d1, d2 = index.distances(q[own])
        s = q[own] @ v.T
        s[(d1[:, c1] + d2[:, c2] > reach[own, None]) | (qid[own, None] == vid[None])] = -np.inf
        k = min(top, s.shape[1])
        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        a, b = np.nonzero((s >= (least - slack)[:, None]) & np.isfinite(s))
        score = (q[own][a] * v[b]).sum(1)  # the same sum wherever the pair is computed
        order = np.lexsort((vid[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        keep = rank < top
        out.append(pd.DataFrame({"query_id": qid[own][a[keep]], "vec_id": vid[b[keep]], "score": score[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(table: DataFrame, is_query, top: int = 20, k: int = 64, share: float = 0.5, sample: int = 20_000, block: int = 16_384, chunk: int = 2_048) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` nearest found of every row for
    which `is_query` holds, all other rows being candidates."""
    spark = table.sparkSession
    rows = cut(vectors(table), "vectors")
    lengths = rows.groupBy(F.length("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = lengths["n"] // 8, lengths["count"]
    rows = rows.where(F.length("v") == lengths["n"])
    fit = matrix([bytes(r.v) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()], dim)
    index = Index((kmeans(fit[:, : dim // 2], k), kmeans(fit[:, dim // 2 :], k)), dim, block)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = index.cells(matrix(column(b, "v").to_pylist(), dim))
            yield pa.RecordBatch.from_arrays([column(b, "vec_id"), column(b, "v"), pa.array(cell, pa.int64())], names=["vec_id", "v", "cell"])

    lists = cut(map_batches(rows, assign, "vec_id long, v binary, cell long"), "vector-lists")
    index.lay_out({r.cell: r["count"] for r in lists.groupBy("cell").count().collect()})  # k * k rows at most
    queries = lists.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    enough = max(math.ceil(share * total), min(total, 40 * top))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries with their block."""
        for b in batches:
            vid, cell = column(b, "vec_id").to_numpy(), column(b, "cell").to_numpy()
            at = index.first[cell] + (vid * 0x9E3779B1 >> 16) % index.parts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(at), column(b, "vec_id"), column(b, "v")], names=["block", "vec_id", "v"])

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        return pd.DataFrame({"block": rows["block"].iloc[:1], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "vs": [b"".join(rows["v"])]})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries, with how far they traverse, to all blocks that hold such a cell."""
        lowest = [np.flatnonzero((index.sizes > 0) & (index.first <= t) & (t < index.first + index.parts)) for t in range(index.blocks)]
        for b in batches:
            q = matrix(column(b, "v").to_pylist(), dim)
            qid = column(b, "query_id").to_numpy()
            d1, d2 = index.distances(q)
            reach = np.array([index.reach(x, y, enough) for x, y in zip(d1, d2)])
            for t, cells in enumerate(lowest):
                a, z = np.divmod(cells, index.shape[1])
                hit = np.concatenate([(d1[i : i + 256][:, a] + d2[i : i + 256][:, z]).min(1) for i in range(0, len(q), 256)]) <= reach if len(q) else np.zeros(0, bool)
                mask = pa.array(hit)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(qid), t)), column(b, "query_id"), column(b, "v"), pa.array(reach, pa.float64())], names=["block", "query_id", "v", "reach"]).filter(mask)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block comes first in its group, queries follow."""
        ids, vs, held = np.zeros(0, np.int64), np.zeros((0, dim)), []

        def met() -> pa.RecordBatch:
            qid, v, reach = zip(*held)
            found = best_of_block(np.array(qid, np.int64), matrix(v, dim), np.array(reach), ids, vs, index, top)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found["query_id"].to_numpy(np.int64)), pa.array(found["vec_id"].to_numpy(np.int64)), pa.array(found["score"].to_numpy(np.float64))], names=["query_id", "vec_id", "score"])

        for b in batches:
            for i, x, *query in zip(*(column(b, c).to_pylist() for c in ("ids", "vs", "query_id", "v", "reach"))):
                if i is not None:
                    if held:
                        yield met()
                    ids, vs = np.frombuffer(i, np.int64), matrix([x], dim)
                else:
                    held.append(query)
                    if len(held) == chunk:
                        yield met()
        if held:
            yield met()

    asked = cut(map_batches(queries, ask, "block long, query_id long, v binary, reach double"), "vector-asks")
    blocks = map_batches(lists, place, "block long, vec_id long, v binary").groupBy("block").applyInPandas(pack, "block long, ids binary, vs binary")
    salts = asked.groupBy("block").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("salts"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("query_id", "long"), ("v", "binary"), ("reach", "double"))]
    read = blocks.join(salts, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "ids", "vs", *none)
    passing = asked.join(salts, "block").select("block", F.pmod(F.xxhash64("query_id"), "salts").cast("int").alias("salt"), F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("vs"), "query_id", "v", "reach")
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = read.union(passing).repartition(lanes, "block", "salt").sortWithinPartitions("block", "salt", F.col("ids").isNull(), "query_id")
    found = map_batches(both, stream, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
