"""Sources and sinks: CSV, Parquet, JSON, fitted state, materialise."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskspark.sources import io


def test_csv_parquet_json_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="rs-io-", dir="/tmp")
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "id long, s string, x double")
    io.write_csv(df, f"{d}/csv")
    back = io.read_csv(spark, f"{d}/csv", "id long, s string, x double")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    io.write_parquet(df, f"{d}/pq", partition_by=["s"])
    assert spark.read.parquet(f"{d}/pq").count() == 2
    io.write_json(df, f"{d}/js")
    assert spark.read.json(f"{d}/js").count() == 2


def test_materialize_reuses_unless_rebuild(spark):
    d = tempfile.mkdtemp(prefix="rs-mat-", dir="/tmp")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert io.materialize(spark, build, f"{d}/t").count() == 5
    assert io.materialize(spark, build, f"{d}/t").count() == 5
    assert len(calls) == 1
    io.materialize(spark, build, f"{d}/t", rebuild=True)
    assert len(calls) == 2


def folder():
    return tempfile.mkdtemp(prefix="rs-mat-", dir="/tmp")


def test_a_write_that_breaks_off_is_not_read(spark):
    d = f"{folder()}/t"
    io.commit_table(spark.range(5), d)
    # a crashed writer leaves a folder of rows beside the committed one, and nothing else
    spark.range(1000).write.parquet(f"{d}/version-crashed")
    assert io.committed(spark, d).count() == 5
    with pytest.raises(Exception):
        io.commit_table(spark.range(9).select(F.raise_error(F.lit("worker lost")).cast("long").alias("id")), d)
    assert io.committed(spark, d).count() == 5
    # nor is a folder that was never committed, or a version that lost a file
    spark.range(3).write.parquet(f"{d}2")
    assert io.committed(spark, f"{d}2") is None and io.materialize(spark, lambda: spark.range(4), f"{d}2").count() == 4
    part = next(p for p in os.listdir(f"{d}2") if p.startswith("version-"))
    os.remove(next(f"{d}2/{part}/{f}" for f in os.listdir(f"{d}2/{part}") if f.endswith(".parquet")))
    assert io.committed(spark, f"{d}2") is None


def test_a_changed_input_is_built_again(spark):
    d = folder()
    spark.range(5).write.parquet(f"{d}/in")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(f"{d}/in")

    for _ in range(2):
        assert io.materialize(spark, build, f"{d}/t", inputs=[f"{d}/in"]).count() == 5
    assert len(calls) == 1
    spark.range(7).write.mode("append").parquet(f"{d}/in")
    assert io.materialize(spark, build, f"{d}/t", inputs=[f"{d}/in"]).count() == 12
    assert io.materialize(spark, build, f"{d}/t", inputs=[f"{d}/in"]).count() == 12 and len(calls) == 2
    assert io.committed(spark, f"{d}/t", inputs=[]) is None  # made from other inputs


def test_readers_of_the_earlier_version_keep_it(spark):
    d = f"{folder()}/t"
    old = io.commit_table(spark.range(5), d)
    new = io.commit_table(spark.range(8), d, partition_by=None)
    assert (old.count(), new.count(), io.committed(spark, d).count()) == (5, 8, 8)
