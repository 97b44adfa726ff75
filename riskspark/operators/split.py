"""Splitting, resampling and class weights.

All randomness is ``md5(seed:key)``: the same rows come out on every run and
in DuckDB.  Exact sizes come from cut-offs on the hash (a histogram of its first
digits, and a look at the border bucket), never from a sort of all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.functions.scalar import hash_key
from riskspark.operators.ranks import exact_rank
from riskspark.operators.selection import bottom_cuts, select_quantiles, within_cuts
from riskspark.session import cut_lineage


def test_side(keys: DataFrame, key: str, stratum: str, test_size: float = config.TEST_SIZE, seed=config.RANDOM_SEED) -> Column:
    """R1/R2 core, as a condition on rows with ``key`` and ``stratum``: whether a key is
    among the ``round(test_size * n)`` of its stratum with the smallest ``md5(seed:key)``."""
    def sizes(n: dict) -> dict:
        return {g: math.floor(test_size * c + 0.5) for g, c in n.items()}

    h = hash_key(seed, key)
    return within_cuts(bottom_cuts(keys, F.col(stratum), F.col(key), h, sizes), F.col(stratum), F.col(key), h)


def stratified_split(keys: DataFrame, key: str, stratum: str, test_size: float = config.TEST_SIZE,
                     seed=config.RANDOM_SEED) -> DataFrame:
    """``keys`` with their side: within each stratum the ``round(test_size * n)`` keys with
    the smallest ``md5(seed:key)`` are ``test``, the rest ``train``."""
    return keys.withColumn("split", F.when(test_side(keys, key, stratum, test_size, seed), "test").otherwise("train"))


def card_strata(labeled: DataFrame, uid: str = "uid", label: str = "ato_proxy") -> DataFrame:
    """A written table of the cards and whether they have a positive row.  Cards without a
    key are not cards."""
    return cut_lineage(labeled.filter(F.col(uid).isNotNull()).groupBy(uid)
                       .agg(F.max(label).cast("int").alias("has_pos")), columnar=True)


def card_split(labeled: DataFrame, uid: str = "uid", label: str = "ato_proxy",
               test_size: float = config.TEST_SIZE, seed=config.RANDOM_SEED) -> DataFrame:
    """Cards stratified by "has a positive row"; returns (uid, has_pos, split)."""
    return stratified_split(card_strata(labeled, uid, label), uid, "has_pos", test_size, seed)


def row_split(df: DataFrame, key: str, label: str, test_size: float = 0.5, seed=config.RANDOM_SEED) -> DataFrame:
    """R2: rows stratified by label (50/50 by default)."""
    return stratified_split(df, key, label, test_size, seed)


def time_split(df: DataFrame, ts: str = "TransactionDT", train_share: float = 0.8) -> DataFrame:
    """Rows up to the exact ``train_share`` quantile of time are train."""
    found = select_quantiles(df, {"t": F.col(ts)}, [train_share])["t"]
    cut = found[train_share].q if found else None
    return df.withColumn("split", F.when(F.col(ts) <= F.lit(cut), "train").otherwise("test"))


def undersample(df: DataFrame, key: str, label: str = "label", ratio: int = config.UNDERSAMPLE_RATIO,
                seed=config.RANDOM_SEED, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Every positive plus the ``min(n_neg, ratio * n_pos)`` negatives with the
    smallest ``md5(seed:key)`` (no replacement; rows of equal keys go together).  Rows
    without a label are neither.  ``df`` is evaluated three times: the histogram, the border
    bucket, the rows."""
    positive, h = F.col(label) == 1, hash_key(seed, key)
    cuts = bottom_cuts(df, positive, F.col(key), h, lambda n: {False: ratio * n.get(True, 0)})
    return df.filter(F.coalesce(positive, F.lit(False)) | within_cuts(cuts, positive, F.col(key), h))


def bootstrap(df: DataFrame, key: str, n: int | None = None, seed=config.RANDOM_SEED,
              scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """``n`` draws with replacement (default: as many as rows).  Draw ``i``
    takes the row whose 0-based index in ``key`` order is
    ``h(seed:i) mod n_rows``; ``draw`` tells the draws apart.  Keys are unique."""
    spark = df.sparkSession
    # keys alone are sorted and numbered
    indexed = exact_rank(df.select(key), [], [key], scale=scale).select(key, (F.col("rank") - 1).alias("_idx"))
    n_rows = df.count()
    total = n_rows if n is None else n
    draws = (spark.range(total).withColumnRenamed("id", "draw")
             .withColumn("_idx", F.pmod(F.conv(F.substring(hash_key(seed, "draw"), 1, 15), 16, 10)
                                        .cast("long"), F.lit(n_rows))))
    drawn = draws.join(indexed, "_idx").drop("_idx")
    return drawn if df.columns == [key] else drawn.join(df, key).select("draw", *df.columns)


def random_subset(df: DataFrame, key: str, k: int, seed=config.RANDOM_SEED) -> DataFrame:
    """``k`` rows without replacement (top-k by hash; the limit is the
    feature, each partition keeps at most ``k`` rows)."""
    return (df.withColumn("_h", hash_key(seed, key)).orderBy("_h", key).limit(k).drop("_h"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Capped weight ``min(n_neg / max(n_pos, 1), 25)`` and balanced
    weights ``n / (2 n_c)``; one row."""
    n_pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("n"), n_pos.alias("n_pos"))
    npos1 = F.greatest(F.col("n_pos"), F.lit(1))
    return agg.select(
        "n", "n_pos", (F.col("n") - F.col("n_pos")).alias("n_neg"),
        F.lit(1.0).alias("weight_neg"),
        F.least((F.col("n") - npos1) / npos1, F.lit(config.WEIGHT_CAP)).alias("weight_pos"),
        F.try_divide(F.col("n"), 2.0 * (F.col("n") - F.col("n_pos"))).alias("balanced_neg"),
        F.try_divide(F.col("n"), 2.0 * F.col("n_pos")).alias("balanced_pos"))


def with_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """R8 applied: a ``weightCol`` for Spark ML (capped scheme)."""
    w = class_weights(df, label).first()["weight_pos"]
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(w))).otherwise(1.0))


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of about ``rows`` rows (``config.TASK_ROWS``), if any has more.  Spark ML keeps the rows of a partition
    as one cached block, and every pass over the data reads it whole.  Spread rows are written, as a fit reads them several times."""
    rows = rows or config.TASK_ROWS
    n = (df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
         .agg(F.max("n").alias("most"), F.sum("n").alias("n")).first())
    return df if (n["most"] or 0) <= rows else cut_lineage(df.repartition(math.ceil(n["n"] / rows)))
