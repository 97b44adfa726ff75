"""Quantiles and bottom-k cut-offs by selection against plain sorts."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.scalar import hash_key
from riskspark.operators import selection as SE
from riskspark.operators.ranks import exact_quantiles

PROBS = [0.0, 0.001, 0.01, 0.35, 0.5, 0.985, 0.999, 1.0]


def columns():
    rng = np.random.default_rng(12)
    n = 6000
    return {"skew": rng.exponential(3, n), "tied": np.where(rng.random(n) < 0.4, 2.5, rng.normal(size=n)), "steps": rng.integers(0, 3, n).astype(float),
            "sparse": np.where(rng.random(n) < 0.97, np.nan, rng.normal(size=n)), "one": np.where(np.arange(n) == 7, 7.0, np.nan),
            "none": np.full(n, np.nan), "huge": rng.normal(size=n) * 1e300}


@pytest.fixture(scope="module")
def frame(spark):
    own = columns()
    rows = [tuple(None if math.isnan(x) else float(x) for x in r) for r in zip(*own.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in own)).repartition(5)


@pytest.mark.parametrize("options", [{}, {"at_most": 40}, {"at_most": 1, "width": 0.2}, {"width": 1e-9}, {"width": 2.0}])
def test_quantiles_are_exact(frame, options):
    got = SE.select_quantiles(frame, {c: F.col(c) for c in frame.columns}, PROBS, **options)
    for c, x in columns().items():
        x = np.sort(x[~np.isnan(x)])
        assert set(got[c]) == (set(PROBS) if len(x) else set())
        for p, q in got[c].items():
            at = (len(x) - 1) * p
            lo, hi = x[math.floor(at)], x[math.ceil(at)]
            assert (q.lo, q.hi, q.n, q.frac) == (lo, hi, len(x), at - math.floor(at))
            assert q.q == lo + (hi - lo) * (at - math.floor(at))


def test_the_same_as_by_sorting(frame):
    got = SE.select_quantiles(frame, {"skew": F.col("skew")}, [0.25, 0.5], width=0.01)["skew"]
    want = {r.p: (r.q, r.n, r.q_lo, r.q_hi, r.q_frac) for r in exact_quantiles(frame, "skew", [0.25, 0.5]).collect()}
    assert {p: (q.q, q.n, q.lo, q.hi, q.frac) for p, q in got.items()} == want


def test_subsets_and_empty_tables(frame):
    got = SE.select_quantiles(frame, {"all": F.col("skew"), "low": F.when(F.col("tied") < 0, F.col("skew"))}, [0.5])
    own = columns()
    assert got["low"][0.5].q == pytest.approx(np.median(own["skew"][own["tied"] < 0]))
    assert SE.select_quantiles(frame.limit(0), {"x": F.col("skew")}, [0.5]) == {"x": {}}
    assert SE.select_quantiles(frame, {}, [0.5]) == {}
    some = SE.select_quantiles(frame, {"a": F.col("skew"), "b": F.col("tied"), "c": F.col("tied")}, {"a": [0.5], "b": [0.1, 0.9], "c": []})
    assert {k: set(v) for k, v in some.items()} == {"a": {0.5}, "b": {0.1, 0.9}, "c": set()}
    assert some["b"][0.9].q == pytest.approx(np.quantile(own["tied"], 0.9))


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),)] * 3, "x double")
    q = SE.select_quantiles(df, {"x": F.col("x")}, [0.0, 0.5, 1.0])["x"]
    assert q[0.0].q == 0.0 and q[0.5].q == 5.5 and math.isnan(q[1.0].q)


def test_few_values_are_kept(frame):
    kept = SE._kept(frame, [F.col("skew")], [[(1.0, 1.01)]])
    x = columns()["skew"]
    inside = (x >= 1.0) & (x <= 1.01)
    rows = {(r.b, r.v): r.c for r in kept.collect()}
    assert rows == {(0, None): int((x < 1.0).sum()), (2, None): int((x > 1.01).sum())} | {(1, v): 1 for v in x[inside]}


def digest(key):
    return hashlib.md5(f"42:{key}".encode()).hexdigest()


@pytest.mark.parametrize("at_most", [1, 30, None])
def test_bottom_cuts(spark, at_most):
    rows = [(f"k{i}", ["a", "b", None][i % 3] if i % 7 else "a", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, g string, i int").repartition(4)
    sizes = {"a": 100, "b": 10_000, None: 9}
    cuts = SE.bottom_cuts(df, F.col("g"), F.col("k"), hash_key(42, "k"), lambda n: sizes, at_most=at_most)
    taken = {r.k for r in df.where(SE.within_cuts(cuts, F.col("g"), F.col("k"), hash_key(42, "k"))).collect()}
    want = set()
    for g, n in sizes.items():
        want |= {k for _, k in sorted((digest(k), k) for k, x, _ in rows if x == g)[:n]}
    assert taken == want
    assert SE.bottom_cuts(df, F.col("g"), F.col("k"), hash_key(42, "k"), lambda n: {}, at_most=at_most) == {}
    assert SE.bottom_cuts(df.limit(0), F.col("g"), F.col("k"), hash_key(42, "k"), lambda n: {'a': 5}) == {}


def test_equal_digests_go_by_the_order(spark):
    df = spark.createDataFrame([(i, 1) for i in range(50)], "i int, g int")
    same = F.lit("0" * 32)
    cuts = SE.bottom_cuts(df, F.col("g"), F.col("i"), same, lambda n: {1: 20}, at_most=3)
    assert cuts == {1: ("0" * 32, 19)}
    assert df.where(SE.within_cuts(cuts, F.col("g"), F.col("i"), same)).count() == 20


def test_values_between_brackets_and_ties_are_counted_without_lambdas(spark, monkeypatch):
    """Spark interprets all that is below a lambda function; and a bracket of one value needs no rows."""
    plans, cut = [], SE.cut_lineage
    monkeypatch.setattr(SE, "cut_lineage", lambda df, **kw: plans.append(df) or cut(df, **kw))
    df = spark.range(3000).select((F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("double").alias("many")).cache()
    got = SE.select_quantiles(df, {"few": F.col("few"), "many": F.col("many"), "none": F.lit(None).cast("double")}, [0.5])
    assert (got["few"][0.5].q, got["many"][0.5].q, got["none"]) == (1.0, 1499.5, {})
    assert "lambda" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert {r["s"] for r in plans[0].collect()} == {1}
