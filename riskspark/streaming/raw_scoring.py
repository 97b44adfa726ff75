"""Raw transactions of a stream scored from a saved bundle.

Each micro-batch is scored with its cards' earlier rows, then joins them.  Both tables have a
folder per batch that a repeated batch overwrites, so a restart neither loses nor
doubles rows: history up to and without the batch is read, the batch written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskspark.operators.bundle import load_bundle, score_raw
from riskspark.sources.io import path_exists


def batches_before(spark: SparkSession, path: str, batch: int, like: DataFrame) -> DataFrame:
    """Rows of the batches before ``batch``."""
    if not path_exists(spark, path):
        return like.limit(0)
    return spark.read.schema(like.withColumn("batch", F.lit(0).cast("long")).schema).parquet(path).filter(F.col("batch") < batch).drop("batch")


def score_batch(rows: DataFrame, batch: int, bundle_path: str, history: str, out: str, uid: str = "uid") -> None:
    """Score one batch of raw rows and add it to the history."""
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        rows.write.mode("overwrite").parquet(f"{history}/batch={batch}")
        earlier = batches_before(spark, history, batch, rows)
        cards = rows.select(uid).distinct()
        known = earlier.join(cards, uid, "left_semi").select(*rows.columns).unionByName(rows)
        score_raw(known, load_bundle(spark, bundle_path), new=rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    finally:
        rows.unpersist()


def score_raw_stream(stream: DataFrame, bundle_path: str, history: str, out: str) -> DataStreamWriter:
    """A writer to start: scores of every micro-batch in ``out/batch=<n>``."""
    return stream.writeStream.foreachBatch(lambda rows, batch: score_batch(rows, batch, bundle_path, history, out))
