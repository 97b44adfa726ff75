"""Tree attribution: every subset by plain enumeration, additivity on a saved forest."""

import itertools
import math

import numpy as np
import pytest

from riskspark.operators import attribution as AT
from riskspark.operators import models as M
from riskspark.session import fresh_folder
from tests.test_models import rows_of


def grown(rng, depth, width):
    """A random tree as node arrays, with features that come up more than once on a path."""
    nodes = []

    def add(level, cover):
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(rng.random()), cover])
        if level and cover > 1 and rng.random() < 0.9:
            part = cover * rng.uniform(0.1, 0.9)
            nodes[me][:2] = int(rng.integers(width)), float(rng.normal())
            nodes[me][2] = add(level - 1, part)
            nodes[me][3] = add(level - 1, cover - part)
        return me

    add(depth, 100.0)
    return [np.array(c) for c in zip(*nodes)]


def known_value(tree, x, known):
    feature, threshold, left, right, value, cover = tree

    def at(n):
        if feature[n] < 0:
            return value[n]
        a, b = int(left[n]), int(right[n])
        if int(feature[n]) in known:
            return at(a if x[int(feature[n])] <= threshold[n] else b)
        return (cover[a] * at(a) + cover[b] * at(b)) / cover[n]

    return at(0)


def enumerated(trees, x):
    n = len(x)
    out = np.zeros(n)
    for f in range(n):
        others = [i for i in range(n) if i != f]
        for k in range(n):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                out[f] += w * np.mean([known_value(t, x, {*s, f}) - known_value(t, x, set(s)) for t in trees])
    return out


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_enumeration_of_all_subsets(seed):
    rng = np.random.default_rng(seed)
    trees = [grown(rng, 5, 4) for _ in range(3)]
    forest = [AT.Tree(t[0].astype(int), t[1], t[2].astype(int), t[3].astype(int), t[4], t[5]) for t in trees]
    x = rng.normal(size=(12, 4))
    phi, score = AT.shapley(forest, x)
    assert np.allclose(phi, [enumerated(trees, r) for r in x])
    assert np.allclose(score, [np.mean([known_value(t, r, set(range(4))) for t in trees]) for r in x])
    assert np.allclose(phi.sum(1) + np.mean([t.base for t in forest]), score)


def test_saved_forest_adds_up_to_its_score(spark):
    df = rows_of(spark, 240, set(range(0, 240, 7)))
    path = fresh_folder(spark, "forest")
    M.save_model(M.fit_random_forest(df, num_trees=8, max_depth=6), path)
    got = {r.TransactionID: r for r in AT.tree_attribution(path, df).collect()}
    want = {r.TransactionID: r.score for r in M.score_model(M.load_forest(path), df).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert abs(r.score - want[i]) < 1e-9 and abs(r.base + sum(r.phi) - want[i]) < 1e-9
    mean = {r.feature: r.attribution for r in AT.mean_attribution(AT.tree_attribution(path, df), ["a", "b"]).collect()}
    phi = np.abs([r.phi for r in got.values()]).mean(0).reshape(4, 2).sum(0)
    assert mean.keys() == {"a", "b"} and abs(mean["a"] - phi[0]) < 1e-9 and abs(mean["b"] - phi[1]) < 1e-9
    assert AT.tree_attribution(path, df.limit(0)).collect() == []


def test_leaves_of_value_0_are_passed_over(monkeypatch):
    """They add nothing, and neither sums nor splits above them alone are computed."""
    rng, calls, plain = np.random.default_rng(7), [], AT.leaf_terms
    t = grown(rng, 6, 4)
    leaves = np.flatnonzero(t[0] < 0)
    t[4][leaves[rng.random(len(leaves)) < 0.7]] = 0.0
    kept = int((t[4][leaves] != 0).sum())
    tree = AT.Tree(t[0].astype(int), t[1], t[2].astype(int), t[3].astype(int), t[4], t[5])
    monkeypatch.setattr(AT, "leaf_terms", lambda met, z: calls.append(met.shape) or plain(met, z))
    x = rng.normal(size=(3000, 4))
    monkeypatch.setattr(AT, "ROWS", 700)
    phi, score = AT.shapley([tree], x)
    assert 0 < len(calls) <= kept and all(masks <= 1 << features for features, masks in calls)
    assert np.allclose(phi[:9], [enumerated([t], r) for r in x[:9]]) and np.allclose(phi.sum(1) + tree.base, score)
    empty = AT.Tree(t[0].astype(int), t[1], t[2].astype(int), t[3].astype(int), t[4] * 0, t[5])
    assert not AT.shapley([empty], x)[0].any()


def test_many_splits_need_wide_masks():
    rng = np.random.default_rng(8)
    n = 18  # a chain of splits on 18 features: more than 16 bits
    feature = np.array([*range(n), *[-1] * (n + 1)])
    left = np.array([*range(n, 2 * n), *[-1] * (n + 1)])
    right = np.array([*range(1, n), 2 * n, *[-1] * (n + 1)])
    cover = np.array([float(n + 1 - i) for i in range(n)] + [1.0] * (n + 1))
    tree = AT.Tree(feature, np.zeros(2 * n + 1), left, right, rng.random(2 * n + 1), cover)
    x = rng.normal(size=(400, n)) - 1
    phi, score = AT.shapley([tree], x)
    few = AT.shapley([tree], x[:3])
    assert np.allclose(phi.sum(1) + tree.base, score) and np.allclose(phi[:3], few[0])
