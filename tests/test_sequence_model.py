"""The recurrent model: gradients by differences, padding, the same weights however the rows lie."""

import numpy as np
import pytest

from riskspark.operators import sequence_model as SM


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    model = SM.Lstm.fresh(3, 4, 1)
    x, y, w = rng.normal(size=(5, 6, 3)), rng.integers(0, 2, 5).astype(float), rng.uniform(1, 3, 5)
    x[0, :3] = x[1, :] = 0  # padding in front, and a row of padding alone
    grad, _ = model.gradient(x, y, w)
    flat = model.flat()
    for i in rng.choice(len(flat), 60, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (model.like(flat + d).gradient(x, y, w)[1] for d in (step, -step))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-5 * max(1, abs(grad[i]))


def test_padding_in_front_changes_nothing():
    rng = np.random.default_rng(1)
    model = SM.Lstm.fresh(2, 3, 0)
    x = rng.normal(size=(7, 4, 2))
    padded = np.concatenate([np.zeros((7, 5, 2)), x], 1)
    assert np.allclose(model.forward(x)[0], model.forward(padded)[0])


def test_a_step_computes_only_rows_that_have_begun(monkeypatch):
    """Padding in front costs nothing, and a row's score and gradient are its own whatever rows come with it."""
    rng, seen, plain = np.random.default_rng(3), [], SM.logistic
    model = SM.Lstm.fresh(3, 4, 1)
    x, y, w = rng.normal(size=(40, 6, 3)), rng.integers(0, 2, 40).astype(float), rng.uniform(1, 3, 40)
    for i in range(40):
        x[i, : i % 7] = 0  # up to padding alone
    x[5, 5] = x[6, 2] = 0  # a step of zeros after the first
    monkeypatch.setattr(SM, "TOGETHER", 16)
    monkeypatch.setattr(SM, "logistic", lambda v: seen.append(v.shape[1]) or plain(v))
    grad, loss = model.gradient(x, y, w)
    assert sum(seen) == 2 * sum(6 - int((r != 0).any(1).argmax()) for r in x if r.any())
    single = [model.gradient(x[i : i + 1], y[i : i + 1], w[i : i + 1]) for i in range(40)]
    assert np.allclose(grad, sum(g for g, _ in single), atol=1e-12) and loss == pytest.approx(sum(v for _, v in single))
    assert np.allclose(model.scores(x), [model.forward(x[i : i + 1])[0][0] for i in range(40)], atol=1e-14)


def test_blocks_hold_all_rows_once(spark, monkeypatch):
    monkeypatch.setattr(SM, "BLOCK", 7)
    df = sequences(spark, 100).selectExpr("cast(TransactionID % 4 as int) - 1 batch", "seq", "cast(TransactionID as double) label", "1.0D weight")
    blocks = [(r.batch, r.n, SM.pickle.loads(r.data)) for r in SM.packed(df.repartition(3), 3, 1).collect()]
    want = {r.label: r.seq for r in df.collect()}
    assert sorted(v for _, _, (_, y, _) in blocks for v in y) == sorted(want) and max(n for _, n, _ in blocks) == 7
    for batch, n, (x, y, _) in blocks:
        assert len(x) == n and all(int(v) % 4 - 1 == batch and np.array_equal(r, np.float32(want[v])) for r, v in zip(x, y))


def test_binned_auc():
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 500), rng.integers(0, 40, 500) / 40
    at = (p * SM.BINS).astype(int) + SM.BINS * y
    pos, neg = p[y == 1], p[y == 0]
    want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert SM.binned_auc(np.bincount(at, minlength=2 * SM.BINS).astype(float)) == pytest.approx(want)


def sequences(spark, n):
    """Positive where the first of two marks comes before the second: only the order tells."""
    rng = np.random.default_rng(n)
    rows = []
    for i in range(n):
        seq = rng.normal(size=(6, 2)) * 0.1
        a, b = rng.choice(6, 2, replace=False)
        seq[a, 0], seq[b, 1] = 1.0, 1.0
        rows.append((i, int(a < b), seq.tolist()))
    return spark.createDataFrame(rows, "TransactionID long, label int, seq array<array<float>>")


def test_learns_the_order_of_events(spark):
    model = SM.fit_sequence_lstm(sequences(spark, 1500), hidden=12, steps=4, epochs=14, rate=0.03)
    rows = SM.score_sequence_lstm(model, sequences(spark, 401)).collect()
    pos, neg = (np.array([r.score for r in rows if r.label == y]) for y in (1, 0))
    auc = np.mean(pos[:, None] > neg)
    print("auc", auc)
    assert auc > 0.9 and all(0 <= r.score <= 1 for r in rows)


def test_the_same_weights_for_any_partitions(spark, monkeypatch):
    df = sequences(spark, 300)
    a = SM.fit_sequence_lstm(df.repartition(1), hidden=5, steps=2, epochs=2)
    monkeypatch.setattr(SM, "BLOCK", 17)
    b = SM.fit_sequence_lstm(df.repartition(6), hidden=5, steps=2, epochs=2)
    assert np.abs(a.flat() - b.flat()).max() < 1e-6


def test_no_rows(spark):
    df = sequences(spark, 20)
    with pytest.raises(ValueError):
        SM.fit_sequence_lstm(df.limit(0))
    assert SM.score_sequence_lstm(SM.Lstm.fresh(2, 3, 0), df.limit(0)).collect() == []
