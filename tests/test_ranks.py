"""Running totals, ranks and quantiles against plain loops, for any number of parts."""

import random
from itertools import groupby

import numpy as np
import pytest

from riskspark.config import ScaleConfig
from riskspark.operators.features import frequency_encode, ordinal_encode
from riskspark.operators.ranks import exact_quantiles, exact_rank, running_totals
from riskspark.operators.split import bootstrap, undersample

PARTS = [ScaleConfig(parts=1), ScaleConfig(parts=3), ScaleConfig(parts=50)]


@pytest.mark.parametrize("scale", PARTS)
def test_running_totals(spark, scale):
    rng = random.Random(8)
    rows = list({(rng.choice(["p", "q", None]), rng.choice([None, *range(60)])): rng.randrange(6) for _ in range(500)}.items())
    df = spark.createDataFrame([(g, v, w) for (g, v), w in rows], "g string, v int, w long")
    got = {(r.g, r.v): (r.cum_w, r.tot_w) for r in running_totals(df, ["g"], ["v"], ["w"], scale=scale).collect()}
    want, by = {}, lambda r: (r[0][0] is not None, r[0][0] or "")
    for _, own in groupby(sorted(rows, key=lambda r: (by(r), r[0][1] is not None, r[0][1] or 0)), key=by):
        own, cum = list(own), 0
        for (g, v), w in own:
            cum += w
            want[(g, v)] = (cum, sum(x for _, x in own))
    assert got == want


@pytest.mark.parametrize("scale", PARTS)
@pytest.mark.parametrize("keys", [[f"Windows {i}" for i in range(300)], [float(i % 97) * 1e6 + i for i in range(300)], [b"\x00" * i for i in range(90)]])
def test_rank_of_any_type(spark, scale, keys):
    df = spark.createDataFrame([(k,) for k in keys], ["k"])
    got = {bytes(r.k) if isinstance(r.k, bytearray) else r.k: (r["rank"], r.group_n) for r in exact_rank(df, [], ["k"], scale=scale).collect()}
    assert got == {k: (i + 1, len(keys)) for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("scale", PARTS)
def test_quantiles(spark, scale):
    rng = np.random.default_rng(12)
    sides = {"u": np.r_[rng.exponential(3, 211), np.full(90, 2.5)], "v": np.array([7.0]), "w": rng.integers(0, 3, 40).astype(float)}
    df = spark.createDataFrame([(g, float(x)) for g, xs in sides.items() for x in xs] + [("u", None), ("none", None)], "g string, x double")
    probs = [0.0, 0.01, 0.35, 0.5, 0.985, 1.0]
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "x", probs, ["g"], scale=scale).collect()}
    assert set(got) == {(g, p) for g in sides for p in probs}
    assert all(abs(q - np.quantile(sides[g], p)) < 1e-9 for (g, p), q in got.items())


@pytest.mark.parametrize("scale", PARTS)
def test_numeric_categories_go_by_value(spark, scale):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([10, 2, 100, 9, None, 2])], "i int, v int")
    assert [r.c for r in ordinal_encode(df, "v", "c", scale).orderBy("i").collect()] == [2, 0, 3, 1, -1, 0]


def test_lookups_of_nulls_and_unseen_values(spark):
    fit = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    df = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z"), (3, None), (4, "x")], "i int, v string")
    out = ordinal_encode(frequency_encode(df, "v", "n", fit_df=fit), "v", "c", fit_df=fit).orderBy("i")
    assert [(r.n, r.c) for r in out.collect()] == [(2, 0), (1, 1), (0, -1), (0, -1), (2, 0)]
    assert out.columns == ["i", "v", "n", "c"]


@pytest.mark.parametrize("scale", PARTS)
def test_sampling_by_text_keys(spark, scale):
    df = spark.createDataFrame([(f"row {i}", int(i % 10 == 0), "wide" * 9) for i in range(200)], "k string, label int, pad string")
    a = undersample(df, "k", ratio=3, scale=scale)
    assert a.filter("label = 1").count() == 20 and a.filter("label = 0").count() == 60 and a.columns == df.columns
    assert undersample(df, "k", ratio=50, scale=scale).count() == 200
    b = bootstrap(df, "k", n=70, scale=scale)
    assert b.count() == 70 and {r.k for r in b.collect()} <= {f"row {i}" for i in range(200)}
