"""Hard negatives: the cover trees against all pairs, the query against its contract, edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import negatives
from riskspark.llm.negatives import CoverTree, Space
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF01


def brute(rows, is_anchor, scale=256, low=80, high=100, top=5):
    """All pairs in whole numbers; `rows` are (vec_id, label, components)."""
    q = {i: [math.floor(scale * float(x)) for x in v] for i, _, v in rows}
    label = {i: y for i, y, _ in rows}
    out = []
    for a in q:
        if not is_anchor(a):
            continue
        s = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)
        for p, pid in [(-s_, b) for s_, b in s if label[b] == label[a]][:top]:
            fit = [(b, -s_) for s_, b in s if label[b] != label[a] and low * p <= 100 * -s_ <= high * p][:top]
            out += [(a, pid, k + 1, b, p, n) for k, (b, n) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, mod, **options):
    df = spark.createDataFrame([(i, y, [float(x) for x in v]) for i, y, v in rows], "vec_id long, label int, embedding array<double>")
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % mod == 0, **options).collect()))


def clustered(n, dim, groups, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim)) * rng.uniform(0.2, 3, (groups, 1))
    own = rng.integers(0, groups, n)
    x = centre[own] + rng.normal(size=(n, dim)) * 0.05
    x[: n // 3] = x[0]  # a third of all rows are equal
    return [(int(i), int(rng.integers(0, 4)), x[i].tolist()) for i in range(n)]


def test_query_against_its_contract(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, SF01, "embeddings").collect()]
    got = QUERIES["op12_hard_negatives"](spark, SF01)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    want = brute(rows, lambda i: i % 100 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


@pytest.mark.parametrize("shape", [(600, 5, 12, 1), (500, 3, 2, 2), (400, 24, 400, 3)])
def test_many_blocks_and_pivots(spark, monkeypatch, shape):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "ASKED", 3)
    rows = clustered(*shape)
    assert mined(spark, rows, 25, sample=200, low=50) == brute(rows, lambda i: i % 25 == 0, low=50)


def test_trees_find_what_all_rows_hold_and_skip_the_rest(monkeypatch):
    rows = clustered(3000, 8, 60, 7)
    v = np.floor(256 * np.array([x for _, _, x in rows])).astype(np.int64)
    ids, labels = np.arange(3000), np.array([y for _, y, _ in rows])
    space = Space(float((v * v).sum(1).max()))
    tree = CoverTree(ids, labels, v, space).ready()
    # each node covers its rows, and its radius is the farthest one's distance
    x = space.augmented(tree.v)
    for k in range(len(tree.centre)):
        ends, todo, found = [], [k], []
        while todo:
            n = todo.pop()
            found += list(range(tree.begin[n], tree.end[n]))
            todo += range(tree.first[n], tree.first[n] + tree.size[n])
        far = np.sqrt(((x[found] - x[tree.centre[k]]) ** 2).sum(1)).max()
        assert abs(far - tree.radius[k]) < 1e-3, ends
    seen = 0
    count = negatives.products

    def counting(x, q):
        nonlocal seen
        seen += len(x)
        return count(x, q)

    monkeypatch.setattr(negatives, "products", counting)
    for a in range(0, 3000, 100):
        s = v @ v[a]
        hi = np.sort(s)[[-1, -40, 1500]]
        lo = np.ceil(hi - np.abs(hi) * 0.05).astype(np.int64)
        for same in (True, False):
            got = tree.find(a, int(labels[a]), same, v[a], lo, hi, 5)
            for w in range(3):
                fit = [(-int(s[b]), b) for b in range(3000) if b != a and (labels[b] == labels[a]) == same and lo[w] <= s[b] <= hi[w]]
                assert list(zip((-got[w][1]).tolist(), got[w][0].tolist())) == sorted(fit)[:5]
    assert seen < 0.7 * 60 * 3000


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.85, 0.0]), (2, 2, [0.85, 0.0]), (3, None, [1.0, 1.0]), (None, 1, [1.0, 0.0]), (4, 2, None), (5, 2, []), (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]),
            (8, 2, [None, 1.0]), (9, 2, [1.0, 2.0, 3.0]), (10, 3, [0.85, 0.0]), (11, 1, [-1.0, 0.0]), (12, 2, [0.0, 0.0]), (13, 2, [1e300, 0.0]), (20, 5, [0.5, 0.5]), (40, 2, [-0.5, 0.0])]
    schema = "vec_id long, label int, embedding array<double>, anchor_id int, score string, pivot int, v int"
    df = spark.createDataFrame([(*r, 7, "x", 9, 8) for r in rows], schema)
    got = sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 20 == 0).collect()))
    kept = [r for r in dict.fromkeys((i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and v and len(v) == 2 and None not in v and all(map(math.isfinite, v)) and abs(v[0]) < 1e9)]
    want = brute(kept, lambda i: i % 20 == 0)
    assert got == want and [r[:4] for r in got if r[0] == 0][:2] == [(0, 1, 1, 2), (0, 1, 2, 10)]
    assert negatives.mine(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert negatives.mine(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).collect() == []
    assert negatives.mine(df.where("vec_id = 1"), F.col("vec_id") % 20 == 0).collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, (rng.normal(size=4) * 250_000).tolist()) for i in range(120)]  # squared norms beyond 2**52
    assert mined(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0)
