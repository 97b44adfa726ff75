"""Hard negatives by maximum-inner-product search in cover trees.

Vectors are quantised to integers, floor(`scale` * x), so scores are exact.  A candidate x gets
one more component, sqrt(M - |x|^2) with M the largest squared norm, an anchor q gets 0:
then |q - x|^2 = |q|^2 + M - 2 <q, x>, and a ball of candidates bounds the inner products of all in
it from both sides.  Candidates are laid out by their nearest of at most `PIVOTS` pivots
(farthest-first on a bounded sample of `sample` rows) and, within a pivot's ball, in
blocks of about `BLOCK` rows; each block is a cover tree, built level by level: a node
of covering radius r is split by a net of centres more than r / 2 apart, its own
centre among them, that cover its members within r / 2; each node keeps the distance of
its farthest member.  An anchor only goes to pivots whose balls reach one of its
score windows, and descends each tree best bound first: nodes outside all its windows, or
below the best found so far, are skipped, and leaves are verified exactly.

An anchor's positives are found first, in the blocks of its own pivot, then in others that
can hold better ones; each positive gives a window of scores for its negatives.  A
block's tree is read once, and the anchors that ask it stream past in Arrow batches; a block
asked by more than `ASKED` anchors is read by several tasks.

Rows with a null vec_id or label, and vectors that are null, empty, hold null or
non-finite components, don't have the table's most common length or have a squared norm
of 2**56 or more (their scores don't fit), take no part.  Of rows that repeat a vec_id one
counts: that of the smallest label, then the smallest bytes.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import column, cut, hand_back, map_batches

PIVOTS, BLOCK, LEAF = 1024, 8192, 16
#: Anchors that one task takes past a tree.
ASKED = 1 << 16
#: Squared norms below this are exact in float64 products; below LARGEST in int64 ones.
EXACT, LARGEST = 1 << 52, 1 << 56
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v holds int64 components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, label, v in zip(column(b, "vec_id").to_pylist(), column(b, "label").to_pylist(), column(b, "embedding").to_pylist()):
                if v and None not in v:
                    x = np.floor(scale * np.array(v, np.float64))
                    if np.isfinite(x).all() and float(x @ x) < LARGEST:
                        out.append((i, label, x.astype("<i8").tobytes()))
            ids, labels, rows = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(rows, pa.binary())], names=["vec_id", "label", "v"])

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    found = map_batches(rows.where("vec_id is not null and label is not null and embedding is not null"), run, "vec_id long, label long, v binary")
    return found.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(-1, dim)


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of x with q: x is float64 where that is exact."""
    return (x @ q.astype(x.dtype)).astype(np.int64)


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of n numbers each, one after another."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Space:
    """Distances between norm-augmented candidates, and what they say of inner products."""

    def __init__(self, m: float):
        self.m = m

    def augmented(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.c_[x, np.sqrt(np.maximum(0, self.m - (x * x).sum(1)))]

    def bounds(self, q2: float, s: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of candidates within `radius` of a centre
        whose own product with the anchor (squared norm q2) is s; with room for rounding."""
        whole = q2 + self.m
        d = np.sqrt(np.maximum(0, whole - 2 * s))
        room = 1e-6 * whole + 1
        return (whole - (d + radius) ** 2) / 2 - room, (whole - np.maximum(0, d - radius) ** 2) / 2 + room


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of x to all rows of y (a bounded number of rows)."""
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T))


def net(x: np.ndarray, members: np.ndarray, centre: int, d: np.ndarray, scale: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centre, members, their distances): centres are more than `scale` apart, the node's
    own is the first, and each member goes to a centre within `scale`."""
    out = [(centre, members[d <= scale], d[d <= scale])]
    left = members[d > scale]
    while len(left):
        some = left[:64]
        between = apart(x[some], x[some])
        chosen: list[int] = []
        for i in range(len(some)):
            if (between[i, chosen] > scale).all():
                chosen.append(i)
        far = apart(x[left], x[some[chosen]])
        far[chosen, np.arange(len(chosen))] = 0
        near = far.argmin(1)
        reach = far[np.arange(len(left)), near]
        covered = reach <= scale
        out += [(int(some[c]), left[covered & (near == k)], reach[covered & (near == k)]) for k, c in enumerate(chosen)]
        left = left[~covered]
    return out


class CoverTree:
    """Nodes in level order; a node's children are consecutive, and so are the rows of a leaf."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, space: Space):
        self.space = space
        x = space.augmented(v)
        start = np.arange(len(x))
        d = apart(x, x[:1])[:, 0]
        d[0] = 0
        nodes: list[tuple[int, np.ndarray, np.ndarray]] = [(0, start, d)]
        centres, radii, first, size, begin, end, order, k = [], [], [], [], [], [], [], 0
        at = 0
        alike = max(0.5, 1e-6 * math.sqrt(space.m))  # closer rows are equal, or can't be told apart by distance
        while k < len(nodes):
            centre, members, d = nodes[k]
            nodes[k] = (centre, members[:0], d[:0])
            radius = float(d.max())
            centres.append(centre)
            radii.append(radius)
            leaf = len(members) <= LEAF or radius < alike
            children = [] if leaf else net(x, members, centre, d, radius / 2)
            first.append(len(nodes))
            size.append(len(children))
            nodes += children
            begin.append(at)
            if leaf:
                order.append(members)
                at += len(members)
            end.append(at)
            k += 1
        order = np.concatenate(order)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.labels = ids[order], labels[order]
        width = np.int16 if np.abs(v).max(initial=0) < 1 << 15 else np.int32 if np.abs(v).max() < 1 << 31 else np.int64
        self.v = v[order].astype(width)
        self.centre, self.radius = place[centres], np.array(radii)
        self.first, self.size, self.begin, self.end = (np.array(a, np.int64) for a in (first, size, begin, end))

    def ready(self) -> CoverTree:
        """With rows in the type whose products are exact."""
        self.v = self.v.astype(np.float64 if self.space.m < EXACT else np.int64)
        return self

    def find(self, anchor: int, label: int, same: bool, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores lo..hi, the ids and scores of the first `top` rows, other than the
        anchor, of the same label (or of others); more scores first, then smaller ids."""
        q2 = float((q.astype(np.float64) ** 2).sum())
        least = lo.astype(np.float64)  # what a row must reach to be among the first
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in lo]

        def offer(rows: np.ndarray, s: np.ndarray) -> None:
            own = (s >= least.min()) & ((self.labels[rows] == label) == same) & (self.ids[rows] != anchor)
            rows, s = rows[own], s[own]
            for w in range(len(lo)):
                inside = (s >= least[w]) & (s <= hi[w])
                if inside.any():
                    ids, scores = np.r_[best[w][0], self.ids[rows[inside]]], np.r_[best[w][1], s[inside]]
                    first = np.lexsort((ids, -scores))[:top]
                    best[w] = ids[first], scores[first]
                    if len(first) == top:
                        least[w] = scores[first[-1]]

        node = np.zeros(1, np.int64)
        low, high = self.space.bounds(q2, products(self.v[self.centre[:1]], q), self.radius[:1])
        at_once = 32
        while len(node):
            alive = ((high[:, None] >= least) & (low[:, None] <= hi)).any(1)
            node, low, high = node[alive], low[alive], high[alive]
            by = np.argsort(-high, kind="stable")
            now, later = by[:at_once], by[at_once:]
            leaf = self.size[node[now]] == 0
            at_once *= 2
            leaves, inner = node[now[leaf]], node[now[~leaf]]
            rows = ranges(self.begin[leaves], self.end[leaves] - self.begin[leaves])
            offer(rows, products(self.v[rows], q))
            child = ranges(self.first[inner], self.size[inner])
            s = products(self.v[self.centre[child]], q)
            single = (self.size[child] == 0) & (self.end[child] - self.begin[child] == 1)  # the centre is the leaf
            offer(self.centre[child[single]], s[single])
            child, s = child[~single], s[~single]
            a, b = self.space.bounds(q2, s, self.radius[child])
            node, low, high = np.r_[node[later], child], np.r_[low[later], a], np.r_[high[later], b]
        return best


class Layout:
    """Pivots, their balls, and the blocks of each."""

    def __init__(self, v: np.ndarray, k: int, space: Space):
        x = space.augmented(v)
        chosen, d = [0], apart(x, x[:1])[:, 0]
        while len(chosen) < k and d.max() > 0:
            chosen.append(int(d.argmax()))
            d = np.minimum(d, apart(x, x[chosen[-1:]])[:, 0])
        self.space, self.v, self.x = space, v[chosen].astype(np.float64), x[chosen]
        n = len(chosen)
        self.radius, self.rows = np.full(n, -1.0), np.zeros(n, np.int64)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.space.augmented(v)
        d = np.concatenate([apart(x[i : i + 1024], self.x) for i in range(0, len(x), 1024)]) if len(x) else np.zeros((0, len(self.x)))
        home = d.argmin(1)
        return home, d[np.arange(len(x)), home]

    def settle(self, balls: list) -> None:
        for r in balls:
            self.radius[r.pivot], self.rows[r.pivot] = r.far, r.n
        self.parts = np.ceil(self.rows / BLOCK).astype(np.int64)
        self.first = np.cumsum(self.parts) - self.parts

    def block(self) -> Column:
        """The block of a row of `pivot` and `vec_id`."""
        firsts, parts = (F.array(*map(F.lit, a.tolist())) for a in (self.first, np.maximum(self.parts, 1)))
        return F.get(firsts, "pivot") + F.pmod(F.xxhash64("vec_id"), F.get(parts, "pivot"))

    def reached(self, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Pivots whose balls may hold a score inside a window."""
        q = q.astype(np.float64)
        low, high = self.space.bounds(float(q @ q), self.v @ q, self.radius)
        return np.flatnonzero((self.rows > 0) & ((high[:, None] >= lo) & (low[:, None] <= hi)).any(1))


ASKS = "block long, anchor_id long, label long, v binary, lo array<long>, hi array<long>"
FOUND = "anchor_id long, w int, vec_id long, score long"
_LONGS = pa.list_(pa.int64())


def visited(asks: DataFrame, trees: DataFrame, same: bool, top: int, dim: int) -> DataFrame:
    """What every asked block holds for its anchors' windows: FOUND, `top` rows a window
    and block at most.  Trees come first in their group, anchors stream past."""
    n = asks.groupBy("block").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("salts"))
    read = trees.join(n, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "tree", *(F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in ASKS.split(", ")[1:])))
    asked = asks.join(n, "block").select("block", F.pmod(F.xxhash64("anchor_id"), "salts").cast("int").alias("salt"), F.lit(None).cast("binary").alias("tree"), "anchor_id", "label", "v", "lo", "hi")
    spark = asks.sparkSession
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = read.union(asked).repartition(lanes, "block", "salt").sortWithinPartitions("block", "salt", F.col("tree").isNull(), "anchor_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: CoverTree | None = None
        for b in batches:
            out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
            for t, i, label, v, lo, hi in zip(*(column(b, c).to_pylist() for c in ("tree", "anchor_id", "label", "v", "lo", "hi"))):
                if t is not None:
                    tree = pickle.loads(t).ready()
                    continue
                found = tree.find(i, label, same, matrix([v], dim)[0], np.array(lo, np.int64), np.array(hi, np.int64), top)
                out += [(i, w, ids, s) for w, (ids, s) in enumerate(found) if len(ids)]
            each = [len(x[2]) for x in out]
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([x[0] for x in out], each).astype(np.int64)), pa.array(np.repeat([x[1] for x in out], each).astype(np.int32)),
                pa.array(np.concatenate([x[2] for x in out] or none)), pa.array(np.concatenate([x[3] for x in out] or none))], names=["anchor_id", "w", "vec_id", "score"])

    return map_batches(stream, run, FOUND)


def first_of(found: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each anchor's windows, with their rank."""
    rank = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, sample: int = 20_000) -> DataFrame:
    """For each anchor (a row of `table(vec_id, label, embedding)` for which `is_anchor` holds)
    and each of its first `positives` other rows of the same label, the first `negatives`
    rows of other labels that score between `low` and `high` per cent of the positive."""
    spark = table.sparkSession
    rows = cut(vectors(table, scale), "negatives-rows")
    lengths = rows.groupBy(F.length("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    dim, total = lengths["n"] // 8, lengths["count"]
    rows = rows.where(F.length("v") == lengths["n"])

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(column(b, "v").to_pylist(), dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array((x * x).sum(1).max(initial=0, keepdims=True))], names=["m"])

    space = Space(map_batches(rows.select("v"), norms, "m double").agg(F.max("m")).first()[0])
    fit = matrix([bytes(r.v) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()], dim)
    layout = Layout(fit, min(PIVOTS, max(1, total // BLOCK)), space)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, d = layout.nearest(matrix(column(b, "v").to_pylist(), dim))
            yield pa.RecordBatch.from_arrays([column(b, "vec_id"), column(b, "label"), column(b, "v"), pa.array(home, pa.int32()), pa.array(d, pa.float64())], names=["vec_id", "label", "v", "pivot", "d"])

    placed = cut(map_batches(rows, assign, "vec_id long, label long, v binary, pivot int, d double"), "negatives-placed")
    layout.settle(placed.groupBy("pivot").agg(F.max("d").alias("far"), F.count("*").alias("n")).collect())  # a row a pivot

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        tree = CoverTree(rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), matrix(rows["v"], dim), space)
        hand_back()
        return pd.DataFrame({"block": rows["block"].iloc[:1], "tree": [pickle.dumps(tree)]})

    trees = cut(placed.withColumn("block", layout.block()).groupBy("block").applyInPandas(build, "block long, tree binary"), "negatives-trees")
    anchors = cut(placed.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "v", "pivot"), "negatives-anchors")

    def asking(df: DataFrame, home: bool | None) -> DataFrame:
        """A row per anchor and block to ask; of the own pivot only, of the others, or any."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block, src = [np.zeros(0, np.int64)], []
                for v, own, lo, hi in zip(*(column(b, c).to_pylist() for c in ("v", "pivot", "lo", "hi"))):
                    reached = np.array([own]) if home else layout.reached(matrix([v], dim)[0], np.array(lo, np.int64), np.array(hi, np.int64))
                    if home is False:
                        reached = reached[reached != own]
                    n = layout.parts[reached]
                    block.append(ranges(layout.first[reached], n))
                    src.append(int(n.sum()))
                at = pa.array(np.repeat(np.arange(len(src)), src))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(block)), *(column(b, c).take(at) for c in ("anchor_id", "label", "v", "lo", "hi"))], names=[x.split()[0] for x in ASKS.split(", ")])

        return cut(map_batches(df.select("anchor_id", "label", "v", "pivot", "lo", "hi"), run, ASKS), "negatives-asks")

    def window(lo, hi) -> list[Column]:
        return [F.array(F.lit(lo) if isinstance(lo, int) else lo).alias("lo"), F.array(F.lit(hi)).alias("hi")]

    near = cut(first_of(visited(asking(anchors.select("*", *window(LOWEST, HIGHEST)), True), trees, True, positives, dim), positives).select(*(x.split()[0] for x in FOUND.split(", "))), "negatives-near")
    reach = near.groupBy("anchor_id").agg(F.when(F.count("*") >= positives, F.min("score")).alias("least"))
    wider = anchors.join(reach, "anchor_id", "left").withColumn("least", F.coalesce("least", F.lit(LOWEST)))
    far = visited(asking(wider.select(*anchors.columns, *window(F.col("least"), HIGHEST)), False), trees, True, positives, dim)
    chosen = first_of(near.union(far), positives).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))  # `positives` at most
    chosen = cut(chosen, "negatives-positives")
    windows = anchors.join(chosen, "anchor_id").select(*anchors.columns, *_windows(low, high))
    found = first_of(visited(asking(windows, None), trees, False, negatives, dim), negatives)
    positive = F.get("p", "w")
    return found.join(chosen, "anchor_id").select("anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def _windows(low: int, high: int) -> list[Column]:
    """ceil(low * score / 100) to floor(high * score / 100) of each positive, in whole numbers."""
    down = "(({0}) - pmod({0}, 100L)) div 100"
    lo, hi = down.format(f"-{low} * x.score"), down.format(f"{high} * x.score")
    return [F.expr(f"transform(p, x -> -({lo}))").alias("lo"), F.expr(f"transform(p, x -> {hi})").alias("hi")]


#: DuckDB SQL of `mine` with its defaults, for the query's rows.
SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""
