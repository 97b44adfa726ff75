"""Encoders, behaviour features, column choice, cleaning, sequences."""

import math
import statistics

import pytest

from riskspark import config
from riskspark.config import ScaleConfig
from riskspark.operators import features as FE

HISTORY = "uid string, TransactionDT long, TransactionID long, f1 double, f2 double"


def test_all_encoders_at_once(spark):
    rows = [(0, "desktop", "Pixel", "amex", None), (1, "Mobile", None, "diners", "charge"), (2, "mobile", "Pixel", None, "charge"),
            (3, None, "Mac", "Visa", "credit"), (4, "desktop", "Pixel", "amex", "debit")]
    df = spark.createDataFrame(rows, "i int, DeviceType string, DeviceInfo string, card4 string, card6 string")
    got = [tuple(r)[5:] for r in FE.encode_categoricals(df).orderBy("i").collect()]
    # type: mobile 1, desktop 2; device: rows that hold it; cards: place in byte order (capitals first)
    assert got == [(2, 3, 1, -1), (0, 0, 2, 0), (1, 3, -1, 0), (0, 1, 0, 1), (2, 3, 1, 2)]


def test_encoders_take_missing_columns(spark):
    df = spark.createDataFrame([("x",)], "card6 string")
    assert FE.encode_categoricals(df).columns == ["card6", "card6_enc"]


CARDS = {"up": [1.0, 2.0, 6.0], "flat": [8.25, 8.25], "one": [300.0]}


@pytest.mark.parametrize("parts", [1, 4])
def test_behaviour_of_three_cards(spark, parts):
    rows, i = [], 0
    for uid, amounts in CARDS.items():
        for k, a in enumerate(amounts):
            rows.append((uid, 3600 * (20 + 9 * k), i, a))
            i += 1
    df = spark.createDataFrame(rows, "uid string, TransactionDT long, TransactionID long, TransactionAmt double")
    got = {(r.uid, r.txn_count_rolling): r for r in FE.behaviour_features(df, scale=ScaleConfig(parts=parts)).collect()}
    for uid, amounts in CARDS.items():
        for k, a in enumerate(amounts):
            r = got[uid, k + 1]
            assert r.account_age_dt == 9 * 3600 * k and r.hour_of_day == (20 + 9 * k) % 24
            if uid == "flat":
                assert r.amt_deviation is None
            else:
                sd = statistics.stdev(amounts) if len(amounts) > 1 else 1.0
                assert abs(r.amt_deviation - (a - statistics.fmean(amounts)) / sd) < 1e-12


@pytest.mark.parametrize("base", [1e7, 1e9])
def test_earlier_rows_only_near_large_amounts(spark, base):
    amounts = [base + x for x in (0.0, 0.01, 0.02, 0.0, 0.03)]
    df = spark.createDataFrame([("k", i, i, a) for i, a in enumerate(amounts)], "uid string, TransactionDT long, TransactionID long, TransactionAmt double")
    for parts in (1, 5):
        got = [r.amt_deviation for r in FE.behaviour_features(df, causal=True, scale=ScaleConfig(parts=parts)).orderBy("TransactionID").collect()]
        assert got[0] is None and abs(got[1] - 0.01) < 1e-6
        for i in (2, 3, 4):
            exact = [x - base for x in amounts[:i]]
            want = (amounts[i] - base - statistics.fmean(exact)) / statistics.stdev(exact)
            assert abs(got[i] - want) < 1e-2 * abs(want) + 1e-6


def test_feature_choice(spark):
    names = [*config.BASE_FEATURES, *config.LABEL_ONLY_COLUMNS, *config.ID_AND_TARGET_COLUMNS, "id_07", "id_88", "id_text", "other"]
    names = list(dict.fromkeys(names))
    values = {"id_text": "no number", "id_88": None, config.BASE_FEATURES[-1]: None}
    df = spark.createDataFrame([tuple(values.get(c, "3") for c in names)], ", ".join(f"`{c}` string" for c in names))
    assert FE.choose_features(df) == [*config.BASE_FEATURES[:-1], "id_07"]


def test_bounds_cut_both_tails_and_drop_what_is_not_finite(spark):
    xs = [float(i) for i in range(1001)] + [math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    bounds = FE.winsor_bounds(df, ["x"])
    assert bounds == {"x": (1.0, 999.0)}
    out = [r.x for r in FE.winsorise(df, bounds).orderBy("i").collect()]
    assert out[0] == 1.0 and out[1000] == 999.0 and out[2:999] == xs[2:999] and out[1001:] == [None] * 4


def test_state_is_applied_to_new_rows(spark):
    stats = {"clip_lo": 0.0, "clip_hi": 10.0, "median": 4.0, "mean": 2.0, "scale": 2.0}
    state = spark.createDataFrame([("x", k, v) for k, v in stats.items()] + [("y", "clip_lo", None), ("y", "clip_hi", None), ("y", "median", 1.0), ("y", "mean", 0.0), ("y", "scale", 1.0), ("gone", "mean", 1.0)], "feature string, stat string, value double")
    df = spark.createDataFrame([(1, "-5", 99.0), (2, "3", None), (3, "11", -1.0), (4, "1d", 0.5)], "i int, x string, y double")
    got = [(r.x, r.y) for r in FE.apply_state(df, state).orderBy("i").collect()]
    assert got == [(-1.0, 99.0), (0.5, 1.0), (4.0, -1.0), (1.0, 0.5)]


def test_short_histories_are_padded_in_front(spark):
    rows = [("p", 10 * i, i, float(i), -float(i)) for i in range(3)] + [("alone", 0, 9, 1.0, 1.0), (None, 0, 10, 1.0, 1.0), (None, 1, 11, 1.0, 1.0)]
    got = {r.TransactionID: r for r in FE.sequence_history(spark.createDataFrame(rows, HISTORY), ["f1", "f2"], history_len=4).collect()}
    assert set(got) == {1, 2} and got[2].hist_len == 2
    assert got[2].seq == [[0.0, 0.0], [0.0, 0.0], [0.0, 0.0], [1.0, -1.0]]


def test_history_keeps_last_ten_previous_rows(spark):
    rows = [("A", i * 10, i, 0, float(i)) for i in range(15)]
    df = spark.createDataFrame(rows, "uid string, TransactionDT long, TransactionID long, ato_proxy int, f1 double")
    last = FE.sequence_history(df, ["f1"]).filter("TransactionID = 14").first()
    assert [s[0] for s in last.seq] == [float(i) for i in range(4, 14)]


def test_fit_on_train_keeps_rows_and_split(spark):
    from riskspark.operators.label import label_transactions
    from riskspark.sources.bindings import txn_view
    from tests.conftest import SF001
    lab = label_transactions(txn_view(spark, SF001))
    a, sa, fa = FE.build_sequences(lab)
    b, sb, fb = FE.build_sequences(lab, fit_on="train")
    ka = sorted((r.TransactionID, r.split) for r in a.select("TransactionID", "split").collect())
    kb = sorted((r.TransactionID, r.split) for r in b.select("TransactionID", "split").collect())
    assert ka == kb and fa == fb
    # bounds of the train-only fit equal exact quantiles over the train rows' raw amounts
    train_uids = {r.uid for r in a.filter("split = 'train'").select("uid").distinct().collect()}
    amts = sorted(r.TransactionAmt for r in lab.collect() if r.uid in train_uids)
    import numpy as np
    lo = {r.stat: r.value for r in sb.filter("feature = 'TransactionAmt'").collect()}["clip_lo"]
    assert abs(lo - float(np.quantile(amts, 0.001))) < 1e-9
