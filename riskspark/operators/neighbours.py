"""Nearest-neighbour graph by a forest of random-projection trees, and SMOTE.

Each tree divides the points until a leaf holds at most ``leaf`` of them: a node that
holds more is divided by a small subtree of random hyperplanes through the medians
of a sample of its points, round by round, all nodes of all trees at once.  Points
that no hyperplane parts (copies) are dealt by hash.  Inside a leaf all distances are
computed exactly, and each point passes on its ``k`` nearest; the trees' candidates
are merged.  No pair leaves a leaf but the k nearest of each point.  A class that fits
one leaf has its exact graph.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark import config
from riskspark.functions.scalar import hash_key, hash_unit
from riskspark.operators.selection import bottom_cuts, within_cuts
from riskspark.session import cut_lineage

#: Trees, points of a leaf, levels of a subtree, and sampled points of a node.
TREES, LEAF, LEVELS, SAMPLE = 12, 2048, 5, 1024
EDGES = "id long, rank int, neighbour long, d2 double"


def _subtree(x: np.ndarray, levels: int, rng: np.random.Generator) -> list | None:
    """[hyperplane, median, left, right], or None where points are not parted."""
    if levels == 0 or len(x) < 4:
        return None
    a, b = x[rng.choice(len(x), 2, replace=False)]
    w = a - b  # between two points, as in most random-projection forests
    p = x @ w
    m = float(np.median(p))
    left = p < m
    if not left.any() or left.all():
        w = rng.normal(size=x.shape[1])
        p = x @ w
        m = float(np.median(p))
        left = p < m
        if not left.any() or left.all():
            return None
    return [w, m, _subtree(x[left], levels - 1, rng), _subtree(x[~left], levels - 1, rng)]


def _descend(node: list | None, x: np.ndarray) -> np.ndarray:
    """Number of the subtree's leaf that each row reaches."""
    out = np.zeros(len(x), np.int64)
    todo = [(node, np.arange(len(x)), 1)]
    while todo:
        n, rows, at = todo.pop()
        if n is None or not len(rows):
            out[rows] = at
            continue
        left = x[rows] @ n[0] < n[1]
        todo += [(n[2], rows[left], 2 * at), (n[3], rows[~left], 2 * at + 1)]
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def leaves(points: DataFrame, trees: int, leaf: int, seed: int) -> DataFrame:
    """``(tree, node, id, x)`` of a written table ``points(id, x)``: every point once a tree, at
    most about ``leaf`` of them a node."""
    placed = points.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit("0"))
    while True:
        big = placed.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf)
        big = cut_lineage(big, columnar=True)
        if big.isEmpty():
            return placed
        placed = cut_lineage(placed, columnar=True)
        share = F.least(F.lit(1.0), F.lit(2.0 * SAMPLE) / F.col("n"))
        some = placed.join(big, ["tree", "node"]).filter(hash_unit(f"{seed}:{'sample'}", "id") < share)

        def grow(rows: pd.DataFrame) -> pd.DataFrame:
            tree, node = int(rows["tree"].iloc[0]), rows["node"].iloc[0]
            rows = rows.sort_values("id").head(4 * SAMPLE)
            rng = np.random.default_rng([seed, tree, *node.encode()])
            return pd.DataFrame({"tree": [tree], "node": [node], "sub": [pickle.dumps(_subtree(_matrix(rows["x"]), LEVELS, rng))]})

        subtrees = cut_lineage(some.groupBy("tree", "node").applyInPandas(grow, "tree int, node string, sub binary"), columnar=True)
        parts = F.ceil(F.col("n") / leaf).cast("long")
        held = placed.join(big.join(subtrees, ["tree", "node"], "left"), ["tree", "node"], "left") \
            .withColumn("parts", parts)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                node = rows["node"].astype(object).to_numpy()
                for (_, name), own in rows[rows["parts"].notna()].groupby(["tree", "node"], sort=False):
                    sub = own["sub"].iloc[0]
                    sub = pickle.loads(sub) if sub is not None else None
                    at = rows.index.get_indexer(own.index)
                    if sub is None:  # copies: dealt by a hash of their own in each round
                        number = [zlib.crc32(f"{name}:{i}".encode()) % int(2 * p) for i, p in zip(own["id"], own["parts"])]
                    else:
                        number = _descend(sub, _matrix(own["x"]))
                    node[at] = [f"{name}.{i}" for i in number]
                yield pd.DataFrame({"tree": rows["tree"], "node": node, "id": rows["id"], "x": rows["x"]})

        placed = cut_lineage(held.select("tree", "node", "id", "x", "sub", "parts").mapInPandas(assign, "tree int, node string, id long, x array<double>"), columnar=True)


def nearest(points: DataFrame, k: int = 5, *, trees: int = TREES, leaf: int = LEAF, seed: int = config.RANDOM_SEED) -> DataFrame:
    """``(id, rank, neighbour, d2)``: the ``k`` nearest other points of each one (by squared
    distance, then id) of ``points(id, x)`` with unique ids."""
    points = cut_lineage(points.select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x")), columnar=True)
    if points.count() <= leaf:
        trees = 1  # one leaf holds all

    def rank(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        ids, x = rows["id"].to_numpy(), _matrix(rows["x"])
        out = []
        for i in range(0, len(x), 256):
            part = x[i : i + 256]
            rough = (part * part).sum(1)[:, None] + (x * x).sum(1) - 2 * part @ x.T
            rough[np.arange(len(part)), np.arange(i, i + len(part))] = np.inf
            kth = np.partition(rough, min(k, len(x) - 1) - 1, axis=1)[:, min(k, len(x) - 1) - 1] if len(x) > 1 else np.full(len(part), -np.inf)
            room = 1e-9 * (1 + (part * part).sum(1) + float((x * x).sum(1).max()))
            a, b = np.nonzero(rough <= (kth + room)[:, None])
            d2 = ((part[a] - x[b]) ** 2).sum(1)  # exact where it decides
            order = np.lexsort((ids[b], d2, a))
            a, b, d2 = a[order], b[order], d2[order]
            first = np.arange(len(a)) - np.searchsorted(a, a) < k
            out.append(pd.DataFrame({"id": ids[i + a[first]], "neighbour": ids[b[first]], "d2": d2[first]}))
        return pd.concat(out)

    found = leaves(points, trees, leaf, seed).groupBy("tree", "node").applyInPandas(rank, "id long, neighbour long, d2 double")
    order = Window.partitionBy("id").orderBy("d2", "neighbour")
    merged = found.groupBy("id", "neighbour").agg(F.min("d2").alias("d2"))  # at most k a tree and point
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("id", "rank", "neighbour", "d2")


def smote(points: DataFrame, n_new: int, k: int = 5, *, seed: int = config.RANDOM_SEED, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``n_new`` synthetic points from ``points(id, x)`` of the rare class, as
    ``(id, copy, neighbour, u, x)``: every point in turn is a base (those with the smallest
    ``md5(seed:id)`` once more than the others), its neighbour one of its k nearest
    and the weight u in [0, 1) both from ``md5(seed:id:copy)``, and
    x = base + u * (neighbour - base).  A point without neighbours is repeated."""
    points = cut_lineage(points.select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x")), columnar=True)
    n = points.count()
    if not n or n_new <= 0:
        return points.sparkSession.createDataFrame([], "id long, copy int, neighbour long, u double, x array<double>")
    every, more = divmod(n_new, n)
    h = hash_key(seed, "id")
    once_more = within_cuts(bottom_cuts(points, F.lit(0), F.col("id"), h, lambda _: {0: more}), F.lit(0), F.col("id"), h)
    copies = F.lit(every) + F.when(once_more, 1).otherwise(0)
    graph = nearest(points, k, trees=trees, leaf=leaf, seed=seed).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "neighbour"))).alias("near"))  # k at most
    drawn = (points.withColumn("copy", F.explode(F.filter(F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0))), lambda i: i < copies)))
             .join(graph, "id", "left").withColumn("_key", F.concat_ws(":", F.col("id").cast("string"), F.col("copy").cast("string"))))
    pick = F.pmod(_digits(hash_key(seed, "_key"), 1), F.size("near"))
    drawn = drawn.withColumn("neighbour", F.coalesce(F.get("near", pick.cast("int"))["neighbour"], F.col("id"))) \
        .withColumn("u", _digits(hash_key(seed, "_key"), 17) / float(1 << 60))
    other = points.select(F.col("id").alias("neighbour"), F.col("x").alias("_y"))
    mixed = F.zip_with("x", "_y", lambda a, b: a + F.col("u") * (b - a))
    return drawn.join(other, "neighbour").select("id", "copy", "neighbour", "u", mixed.alias("x"))


def _digits(digest: Column, first: int) -> Column:
    """15 hex digits of a digest as a number."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def oversample(df: DataFrame, key: str, features: str, label: str = "label", ratio: float = 0.1, k: int = 5, *,
               seed: int = config.RANDOM_SEED, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """R7 on a table: its rows ``(key, label, features, synthetic)`` and as many synthetic
    positives (key null) as make positives ``ratio`` times the negatives."""
    rows = df.select(F.col(key).cast("long").alias(key), F.col(label).cast("int").alias(label), F.col(features).cast("array<double>").alias(features))
    n = rows.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    n_new = math.floor(ratio * n["neg"] + 0.5) - n["pos"]
    new = smote(rows.filter(F.col(label) == 1).select(F.col(key).alias("id"), F.col(features).alias("x")), n_new, k, seed=seed, trees=trees, leaf=leaf)
    made = new.select(F.lit(None).cast("long").alias(key), F.lit(1).alias(label), F.col("x").alias(features), F.lit(True).alias("synthetic"))
    return rows.withColumn("synthetic", F.lit(False)).unionByName(made)
