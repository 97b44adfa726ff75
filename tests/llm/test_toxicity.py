"""Toxicity: gradients, window scores against a plain recurrence, held-out
accuracy, edge rows."""

import numpy as np

from riskspark.llm import toxicity as X
from riskspark.llm.queries import QUERIES, table

SF1 = "/root/testdata/sf0.1"  # a few hundred toxic labels are needed to learn each language's words


def net64(inputs, seed=1):
    net = X.Network(np.unique(inputs.word)[1:], seed, np.float64)  # one word unknown
    for k in net.p:
        net.p[k] = np.random.default_rng(seed).normal(0, 0.5, net.p[k].shape)
    net.p["word"][-1] = 0
    return net


def test_gradients_equal_differences():
    inputs = X.Inputs([b"an idiot ate my homework today", b"fine", b""])
    net = net64(inputs)
    start, text = inputs.windows()
    at, mask = inputs.places(start, text)
    g = np.array([0.3, -0.7, 0.2])
    _, keep = net.forward(inputs, at, mask)
    grads = net.backward(g, keep)
    rng = np.random.default_rng(0)
    for k, grad in grads.items():
        if isinstance(grad, tuple):
            dense = np.zeros_like(net.p[k])
            np.add.at(dense, grad[0], grad[1])
            grad = dense
        flat = net.p[k].reshape(-1)
        spots = rng.choice(np.flatnonzero(grad.reshape(-1)), 5)
        for i in spots:
            old = flat[i]
            flat[i] = old + 1e-6
            up = net.forward(inputs, at, mask)[0]
            flat[i] = old - 1e-6
            down = net.forward(inputs, at, mask)[0]
            flat[i] = old
            assert abs(((up - down) @ g) / 2e-6 - grad.reshape(-1)[i]) < 1e-6, k


def test_windows_overlap_and_cover_every_word():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 100):
        inputs = X.Inputs([b"x " * 5, b"w " * n, b"y"])
        start, text = inputs.windows()
        own = start[text == 1] - 5
        covered = {i for s in own for i in range(s, min(s + X.SPAN, n))}
        assert covered == set(range(n)) and (np.diff(own) == X.STRIDE).all() and len(own) >= 1
        assert n <= X.SPAN or own[-1] + X.SPAN < n + X.STRIDE


def test_scoring_equals_the_training_pass():
    inputs = X.Inputs([b"a few words here", None, b"many " * 200 + b"bad, bad words", "über ".encode() * 40])
    net = X.Network(np.unique(inputs.word)[2:], 2)
    z, text = net.logits(inputs, batch=5)
    start, of = inputs.windows()
    want, _ = net.forward(inputs, *inputs.places(start, of))
    assert (text == of).all() and np.abs(z - want)[text != 1].max() < 1e-4
    assert np.allclose(net.text_logits(inputs), [z[text == i].max() for i in range(4)])


def test_parts_are_the_whole():
    texts = [b"a few words", None, b"", b"more, and more words", "über".encode() * 9, b"x " * 70]
    whole, many = X.Inputs(texts), X.Inputs.of_many(texts, 9)
    for k in ("word", "size", "at", "tri", "first"):
        assert (getattr(whole, k) == getattr(many, k)).all(), k
    net = X.Network(np.unique(whole.word)[1:], 3)
    got = np.concatenate([net.text_logits(p) for p in whole.parts(2)])
    assert np.allclose(got, net.text_logits(whole), atol=1e-5)


def test_query_is_accurate_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, SF1).collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF1, "labels").collect()}
    assert len(got) == table(spark, SF1, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[d].score, got[d].predicted, y) for d, y in labels.items() if d in got and got[d].held_out]
    bad, good = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert bad and np.mean([[b > g for g in good] for b in bad]) >= 0.95
    assert np.mean([p == y for _, p, y in held]) >= 0.96


def test_edge_rows(spark):
    rows = [(i, f"plain words about thing {i} and more", 0) for i in range(60)] + [(100 + i, f"plain idiot words about thing {i}", 1) for i in range(30)]
    docs = spark.createDataFrame([(*r[:2], "x", 3, 1) for r in rows] + [(200, None, "x", 3, 1), (201, "", "x", 3, 1), (None, "idiot", "x", 3, 1), (3, "again", "x", 3, 1), (202, "w " * 200000 + "idiot " + "w " * 9, "x", 3, 1)], "doc_id long, text string, score string, y int, held_out int")
    labels = spark.createDataFrame([(r[0], 1, r[2], "t") for r in rows] + [(None, 1, 1, "t"), (1, 0, None, "t"), (2, 0, 9, "t"), (999, 1, 1, "t")], "doc_id long, quality int, toxic int, text string")
    got = X.scored(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    pred = {r.doc_id: r.predicted for r in found}
    assert all(pred[r[0]] == r[2] for r in rows if r[0] != 3) and pred[202] == 1 and pred[None] == 1
    assert X.scored(docs.limit(0), labels).collect() == []
    assert {r.score for r in X.scored(docs, labels.limit(0)).collect()} == {0.0}
