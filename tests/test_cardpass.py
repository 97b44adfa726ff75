"""The ordered card pass against a plain loop over each card, for any number of
range partitions: hot cards, equal times, null times and null cards included."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskspark.config import ScaleConfig
from riskspark.operators import cardpass
from riskspark.operators.cardpass import card_pass, chunk_of, hot_cards
from tests.conftest import SF001

SCHEMA = "uid string, TransactionDT long, TransactionID long, x double, dev string"


def table(kind):
    rng = random.Random(kind)
    rows = []
    for i in range(400):
        uid = {"hot": "h" if i % 3 else f"c{i % 11}", "one time": "h", "mixed": rng.choice(["a", "b", "c", None])}[kind]
        ts = {"hot": rng.randrange(90), "one time": 1000, "mixed": rng.choice([None, 5, 5, 9, rng.randrange(50)])}[kind]
        rows.append((uid, ts, i, rng.choice([None, 1e9 + rng.randrange(9) / 100, float(rng.randrange(5))]), f"d{rng.randrange(3)}"))
    return rows


def slow(rows, depth):
    out = {r[2]: dict(prev=None, rn=None, hist=None, mu=None, n=None, rn_x=None, rm_x=None, rsd_x=None) for r in rows}
    cards = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        if r[0] is not None:
            cards.setdefault(r[0], []).append(r)
    for own in cards.values():
        every = [r[3] for r in own if r[3] is not None]
        for i, r in enumerate(own):
            x = [p[3] for p in own[:i] if p[3] is not None]
            out[r[2]] = dict(prev=own[i - 1][4] if i else None, rn=i + 1, hist=[[p[3]] for p in own[max(0, i - depth) : i]],
                             mu=statistics.fmean(every) if every else None, n=len(every), rn_x=len(x),
                             rm_x=statistics.fmean(x) if x else None, rsd_x=statistics.stdev(x) if len(x) > 1 else None)
    return out


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6)
    return a == b


@pytest.mark.parametrize("chunk_rows", [None, 1, 7, 30, 150])
@pytest.mark.parametrize("kind", ["hot", "one time", "mixed"])
def test_equals_a_plain_loop(spark, kind, chunk_rows):
    rows = table(kind)
    got = card_pass(spark.createDataFrame(rows, SCHEMA), lags={"prev": "dev"}, row_number="rn", history=["x"], history_len=3,
                    card_aggs={"mu": F.avg("x"), "n": F.count("x")}, running=["x"], scale=ScaleConfig(chunk_rows=chunk_rows))
    want = slow(rows, 3)
    found = got.collect()
    assert sorted(r.TransactionID for r in found) == sorted(want)
    for r in found:
        w = want[r.TransactionID]
        have = dict(prev=r.prev, rn=r.rn, hist=r["_hist"], mu=r.mu, n=r.n, rn_x=r["_rn_x"], rm_x=r["_rm_x"], rsd_x=r["_rsd_x"])
        assert all(close(have[k], w[k]) for k in w), (r, w)


@pytest.mark.parametrize("kind", ["hot", "one time"])
def test_a_hot_card_is_divided(spark, kind):
    df = spark.createDataFrame(table(kind), SCHEMA)
    order = ("TransactionDT", "TransactionID")
    hot, spread = hot_cards(df, "uid", order, ScaleConfig(chunk_rows=40))
    assert [r.uid for r in hot.collect()] == ["h"] and not spread
    rows = df.join(hot, "uid").withColumn("chunk", chunk_of(order)).orderBy(*order).collect()
    chunks = [r.chunk for r in rows]
    assert chunks == sorted(chunks) and len(set(chunks)) >= len(rows) // 80
    assert max(chunks.count(c) for c in set(chunks)) <= 120
    assert hot_cards(df, "uid", order, ScaleConfig()) == (None, False)


def test_more_edges_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(cardpass, "BLOCK", 4)
    rows = table("one time")
    got = card_pass(spark.createDataFrame(rows, SCHEMA), lags={"prev": "dev"}, row_number="rn", scale=ScaleConfig(chunk_rows=5))
    want = slow(rows, 1)
    assert {r.TransactionID: (r.prev, r.rn) for r in got.collect()} == {i: (w["prev"], w["rn"]) for i, w in want.items()}


def test_rows_meet_in_one_exchange(spark):
    """W7 over a table: one exchange of the rows, whose input is read once by it."""
    from riskspark.operators.label import label_transactions
    from riskspark.sources.bindings import txn_view
    plan = label_transactions(txn_view(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Join" not in plan


def test_labels_and_sequences_do_not_depend_on_parts_or_chunks(spark):
    from riskspark.operators.features import build_sequences
    from riskspark.operators.label import label_transactions
    from riskspark.sources.bindings import txn_view
    txn = txn_view(spark, SF001)

    def run(scale):
        lab = label_transactions(txn, scale=scale)
        seqs, state, feats = build_sequences(lab, scale=scale)
        return (sorted(tuple(r) for r in lab.collect()),
                sorted((r.TransactionID, r.split, r.label, r.hist_len, tuple(round(float(x), 5) for step in r.seq for x in step)) for r in seqs.collect()),
                sorted((r.feature, r.stat, round(r.value, 9)) for r in state.collect()), feats)

    assert run(ScaleConfig(parts=2)) == run(ScaleConfig(parts=61, chunk_rows=40))
