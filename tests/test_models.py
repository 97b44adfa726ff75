"""Class weights, undersampling and model score invariants."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import models as M
from riskspark.operators.split import class_weights, undersample


def rows_of(spark, n, positives, steps=4, width=2):
    """Rows whose positives lie away from the rest in every value."""
    rng = random.Random(n)
    rows = [(i, int(i in positives), [[rng.uniform(-1, 1) + (3 if i in positives else 0) for _ in range(width)] for _ in range(steps)]) for i in range(n)]
    return spark.createDataFrame(rows, "TransactionID long, label int, seq array<array<double>>")


# positives, negatives -> weight of a positive
WEIGHTS = [(2, 9, 4.5), (1, 25, 25.0), (1, 26, 25.0), (3, 900, 25.0), (0, 7, 7.0), (5, 0, 0.0)]


@pytest.mark.parametrize("pos,neg,weight", WEIGHTS)
def test_positive_weight(spark, pos, neg, weight):
    df = spark.createDataFrame([(1,)] * pos + [(0,)] * neg, "label int")
    r = class_weights(df).first()
    assert (r.n_pos, r.weight_neg) == (pos, 1.0) and abs(r.weight_pos - (weight if pos else min(neg - 1, 25))) < 1e-12


@pytest.mark.parametrize("ratio,negatives", [(1, 6), (4, 24), (16, 84)])
def test_negatives_kept(spark, ratio, negatives):
    df = rows_of(spark, 90, {1, 2, 3, 50, 60, 89})
    a, b = (undersample(df, "TransactionID", ratio=ratio) for _ in range(2))
    assert {r.TransactionID for r in a.filter("label = 1").collect()} == {1, 2, 3, 50, 60, 89}
    assert a.filter("label = 0").count() == negatives
    assert {r.TransactionID for r in a.collect()} == {r.TransactionID for r in b.collect()}


def test_no_positives_keep_no_negatives(spark):
    assert undersample(rows_of(spark, 30, set()), "TransactionID").count() == 0


def test_forest_scores_rank_the_positives_first(spark):
    df = rows_of(spark, 240, set(range(0, 240, 8)))
    model = M.fit_random_forest(df.filter("TransactionID < 160"), num_trees=10, max_depth=5)
    s = M.score_model(model, df.filter("TransactionID >= 160"))
    assert s.count() == 80 and s.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    lo = s.filter("label = 1").agg(F.min("score")).first()[0]
    assert lo > s.filter("label = 0").agg(F.max("score")).first()[0]


def test_saved_forest_scores_alike(spark):
    from riskspark.session import fresh_folder
    df = rows_of(spark, 60, {0, 9, 30})
    model = M.fit_random_forest(df, num_trees=3, max_depth=3)
    M.save_model(model, path := fresh_folder(spark, "forest"))
    a, b = (sorted(tuple(r) for r in M.score_model(m, df).collect()) for m in (model, M.load_forest(path)))
    assert a == b


def test_isolation_forest_puts_the_far_row_first(spark):
    df = rows_of(spark, 200, set())
    nodes = M.fit_isolation_forest(df, n_trees=25)
    far = spark.createDataFrame([(999, 0, [[40.0] * 2] * 4)], df.schema)
    s = {r.TransactionID: r.score for r in M.score_isolation_forest(nodes, df.unionByName(far)).collect()}
    assert len(s) == 201 and min(s.values()) >= -1e-9 and max(s.values()) <= 1 + 1e-9 and s[999] == max(s.values())


def test_occlusion_covers_every_row(spark):
    df = rows_of(spark, 120, set(range(0, 120, 6)))
    model = M.fit_random_forest(df, num_trees=5, max_depth=4)
    got = {r.feature: r.attribution for r in M.occlusion_attribution(model, df, ["a", "b"]).collect()}
    assert set(got) == {"a", "b"} and all(v >= 0 for v in got.values()) and max(got.values()) > 0


def test_isolation_path_constant():
    assert M._c([2])[0] == 1.0 and M._c([1])[0] == 0.0
    assert abs(M._c([256])[0] - 10.2447) < 1e-3
