"""The neighbour graph against all pairs, and SMOTE's counts, places and edge rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import neighbours as NB


def points(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, x array<double>").repartition(3)


def all_pairs(x, k):
    out = {}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        out[i] = sorted((d[j], j) for j in range(len(x)) if j != i)[:k]
    return out


def graph(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r["rank"])):
        out.setdefault(r.id, []).append((r.d2, r.neighbour))
        assert r["rank"] == len(out[r.id])
    return out


def test_one_leaf_is_exact(spark):
    x = np.random.default_rng(1).normal(size=(300, 6)).round(1)  # with ties
    got, want = graph(NB.nearest(points(spark, x), 5)), all_pairs(x, 5)
    assert {i: [j for _, j in n] for i, n in got.items()} == {i: [j for _, j in n] for i, n in want.items()}


@pytest.mark.parametrize("kind", ["clusters", "noise"])
def test_recall_of_many_leaves(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2400, 16))
    if kind == "clusters":
        x = x * 0.2 + rng.normal(size=(40, 16))[rng.integers(0, 40, 2400)]
    got, want = graph(NB.nearest(points(spark, x), 5, leaf=300)), all_pairs(x, 5)
    recall = np.mean([len({j for _, j in got[i]} & {j for _, j in want[i]}) / 5 for i in want])
    print("recall", kind, recall)
    assert recall >= 0.9


def test_leaves_are_bounded_and_hold_every_point(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4))
    x[:400] = x[0]  # copies that no hyperplane parts
    placed = NB.leaves(points(spark, x), 3, 50, 42)
    sizes = [r.n for r in placed.groupBy("tree", "node").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 50
    assert placed.groupBy("tree").agg(F.count_distinct("id").alias("n"), F.count("*").alias("c")).select("n", "c").distinct().collect() == [(900, 900)]
    near = graph(NB.nearest(points(spark, x), 5, leaf=50))
    assert all(len(n) == 5 for n in near.values()) and all(d == 0 for i in range(400) for d, _ in near[i])


def test_smote_lies_between_a_point_and_a_neighbour(spark):
    x = np.random.default_rng(4).normal(size=(37, 5))
    near = all_pairs(x, 5)
    rows = NB.smote(points(spark, x), 100).collect()
    assert len(rows) == 100 and len({(r.id, r["copy"]) for r in rows}) == 100
    counts = np.bincount([r.id for r in rows], minlength=37)
    first = sorted(range(37), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[: 100 % 37]
    assert [int(c) for c in counts] == [3 if i in first else 2 for i in range(37)]
    for r in rows:
        assert r.neighbour in {j for _, j in near[r.id]} and 0 <= r.u < 1
        assert np.allclose(r.x, x[r.id] + r.u * (x[r.neighbour] - x[r.id]))
    again = NB.smote(points(spark, x).repartition(9), 100)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_edge_cases(spark):
    one = points(spark, np.array([[1.0, 2.0]]))
    assert [(r.id, r.neighbour, r.x) for r in NB.smote(one, 2).collect()] == [(0, 0, [1.0, 2.0])] * 2
    assert NB.smote(one.limit(0), 5).collect() == [] and NB.smote(one, 0).collect() == []
    assert NB.nearest(one, 5).collect() == []


def test_oversample_reaches_the_ratio(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 20 == 0), rng.normal(size=3).tolist()) for i in range(400)]
    out = NB.oversample(spark.createDataFrame(rows, "k long, label int, x array<double>"), "k", "x", ratio=0.2)
    n = {(r.label, r.synthetic): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert n == {(0, False): 380, (1, False): 20, (1, True): 56}
