"""Raw rows scored from a saved bundle, in batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators import models as M
from riskspark.operators.bundle import load_bundle, raw_sequences, save_bundle, score_raw
from riskspark.operators.features import build_sequences
from riskspark.operators.label import label_transactions
from riskspark.plans.pipeline import train_set
from riskspark.session import fresh_folder
from riskspark.sources.bindings import txn_view
from riskspark.streaming.raw_scoring import score_batch, score_raw_stream
from tests.conftest import SF001


@pytest.fixture(scope="module")
def fitted(spark):
    txn = txn_view(spark, SF001)
    seqs, state, feats, encoders = build_sequences(label_transactions(txn), with_encoders=True)
    model = M.fit_random_forest(train_set(seqs.filter("split = 'train'")), num_trees=5, max_depth=5)
    path = fresh_folder(spark, "bundle")
    save_bundle(path, encoders, state, feats, model)
    return txn, seqs, path


def flat(rows):
    return {r.TransactionID: [v for step in r.seq for v in step] for r in rows}


def scores(df):
    return {r.TransactionID: (r.ato_risk_score, r.recommended_action) for r in df.collect()}


def test_raw_rows_give_the_fitted_sequences_and_scores(spark, fitted):
    txn, seqs, path = fitted
    bundle = load_bundle(spark, path)
    want, got = flat(seqs.collect()), flat(raw_sequences(txn, bundle).collect())
    assert set(got) == set(want) and len(want) > 100
    assert all(len(got[i]) == len(want[i]) and all(abs(a - b) < 1e-6 for a, b in zip(got[i], want[i])) for i in want)
    direct = M.score_model(M.load_forest(bundle.model_path), seqs)
    assert scores(score_raw(txn, bundle)) == {r.TransactionID: s for r, s in ((r, scores_of(r)) for r in risk(direct))}


def risk(direct):
    from riskspark.operators.decide import risk_table
    return risk_table(direct).collect()


def scores_of(r):
    return r.ato_risk_score, r.recommended_action


def test_nothing_is_fitted_again(spark, fitted):
    """A few cards alone get the scores that they get among all; unknown values are missing."""
    txn, _, path = fitted
    bundle = load_bundle(spark, path)
    every = scores(score_raw(txn, bundle))
    cards = [r.uid for r in txn.select("uid").distinct().orderBy("uid").limit(3).collect()]
    some = scores(score_raw(txn.filter(F.col("uid").isin(cards)), bundle))
    assert some and all(every[i] == s for i, s in some.items())
    odd = txn.withColumn("DeviceInfo", F.lit("never seen")).withColumn("card4", F.lit(None).cast("string")).drop("id_02", "DeviceType")
    rows = raw_sequences(odd, bundle).collect()
    assert len(rows) == len(every) and not any(v is None for r in rows for step in r.seq for v in step)


def test_other_versions_and_half_written_bundles_are_refused(spark, fitted):
    from riskspark.sources.io import read_text, write_text
    _, _, path = fitted
    other = fresh_folder(spark, "bundle")
    write_text(spark, f"{other}/bundle.json", read_text(spark, f"{path}/bundle.json").replace('"version": 1', '"version": 0'))
    with pytest.raises(ValueError):
        load_bundle(spark, other)
    with pytest.raises(Exception):
        load_bundle(spark, fresh_folder(spark, "bundle"))


def test_stream_of_raw_rows(spark, fitted):
    txn, _, path = fitted
    bundle = load_bundle(spark, path)
    cut = txn.approxQuantile("TransactionDT", [0.6], 0.0)[0]
    first, second = (txn.filter(c).cache() for c in (F.col("TransactionDT") <= cut, F.col("TransactionDT") > cut))
    source, history, out = (fresh_folder(spark, n) for n in ("raw", "history", "scores"))
    first.coalesce(1).write.parquet(f"{source}/part=0")
    stream = spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")

    def run():
        score_raw_stream(stream, path, history, out).option("checkpointLocation", f"{source}-state").trigger(availableNow=True).start().awaitTermination()

    run()
    second.coalesce(1).write.parquet(f"{source}/part=1")
    run()
    assert scores(spark.read.parquet(f"{out}/batch=0")) == scores(score_raw(first, bundle))
    want = scores(score_raw(first.unionByName(second), bundle, new=second))
    assert scores(spark.read.parquet(f"{out}/batch=1")) == want and want
    score_batch(second, 1, path, history, out)  # a batch that is run again changes nothing
    assert scores(spark.read.parquet(f"{out}/batch=1")) == want
    assert spark.read.parquet(history).count() == txn.count()
