"""What a task of a training job reads: spread partitions, a step's own blocks, masks computed once."""

import numpy as np
from pyspark.sql import functions as F

from riskspark import config
from riskspark.operators import attribution as AT
from riskspark.operators import models as M
from riskspark.operators import sequence_model as SM
from riskspark.operators.split import spread
from tests.test_attribution import grown
from tests.test_models import rows_of


def biggest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_large_partitions_are_spread(spark):
    df = rows_of(spark, 300, {1, 2}).coalesce(1)
    got = spread(df, 50)
    assert biggest(got) <= 60 and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert spread(df, 300) is df and spread(df.limit(0), 5).count() == 0


def test_models_train_on_spread_rows(spark, monkeypatch):
    monkeypatch.setattr(config, "TASK_ROWS", 40)
    seen = []
    for kind in (M.RandomForestClassifier, M.GBTClassifier):
        monkeypatch.setattr(kind, "fit", lambda self, data: seen.append(biggest(data)))
    df = rows_of(spark, 300, set(range(0, 300, 5))).coalesce(1)
    M.fit_random_forest(df, num_trees=2, max_depth=2)
    M.fit_sequence_gbt(df, max_iter=2)
    assert len(seen) == 2 and max(seen) <= 55


def test_a_step_reads_only_its_batch(spark):
    df = rows_of(spark, 200, set(range(0, 200, 5))).selectExpr("cast(TransactionID % 4 as int) - 1 batch", "seq", "cast(label as double) label", "1.0D weight")
    blocks = SM.packed(df, 3, 1)
    files = {f for s in range(3) for f in blocks.filter(F.col("batch") == s).select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert blocks.agg(F.sum("n")).first()[0] == 200 and all("batch=-1" not in f for f in files)
    for s in (-1, 0, 1, 2):
        names = [r[0] for r in blocks.filter(F.col("batch") == s).select("_metadata.file_path").distinct().collect()]
        assert names and all(f"batch={s}/" in n for n in names)


def test_sums_are_computed_once_a_mask(monkeypatch):
    rng = np.random.default_rng(3)
    t = grown(rng, 6, 4)
    tree = AT.Tree(t[0].astype(int), t[1], t[2].astype(int), t[3].astype(int), t[4], t[5])
    sizes, plain = [], AT.leaf_terms
    monkeypatch.setattr(AT, "leaf_terms", lambda met, z: sizes.append(met.shape[1]) or plain(met, z))
    x = rng.normal(size=(5000, 4))
    phi, score = AT.shapley([tree], x)
    assert max(sizes) <= 128 and np.allclose(phi.sum(1) + tree.base, score)
    few = AT.shapley([tree], x[:7])
    assert np.allclose(phi[:7], few[0]) and np.allclose(score[:7], few[1])


def test_spread_rows_are_written_once(spark):
    df = spread(spark.range(100).repartition(2), 20)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 100
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
