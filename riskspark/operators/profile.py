"""Profiling aggregates (A1-A12, A16, A17, T2, T4).  Each is one grouped
aggregation with map-side partial aggregation; wide profiles compute all
columns in one pass and unpivot the single result row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.scalar import day_bucket
from riskspark.operators.features import quantile_table, unpivot_features


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A1: rows per value, most frequent first."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(col))


def group_rate(df: DataFrame, key: str, flag: str) -> DataFrame:
    """A2: mean of a 0/1 flag per key (null key dropped)."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(flag).alias("rate"))


def group_rate_top(df: DataFrame, key: str, flag: str, min_count: int = 100, k: int = 10) -> DataFrame:
    """A3: rate and count per key, HAVING count > min_count, top k by rate."""
    g = (df.filter(F.col(key).isNotNull()).groupBy(key)
         .agg(F.avg(flag).alias("rate"), F.count(F.lit(1)).alias("count"))
         .filter(F.col("count") > min_count))
    return g.orderBy(F.col("rate").desc(), F.col("count").desc(), F.col(key)).limit(k)


def missing_profile(df: DataFrame, k: int = 20) -> DataFrame:
    """A4: share of nulls per column (NaN counts as missing), top k."""
    def miss(c, t):
        isnull = F.col(c).isNull()
        if t in ("double", "float"):
            isnull = isnull | F.isnan(c)
        return F.avg(isnull.cast("double")).alias(c)
    row = df.agg(*[miss(c, t) for c, t in df.dtypes])
    long = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_share"))
                                         for c in df.columns])))
    return long.orderBy(F.col("missing_share").desc(), "column").limit(k)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """A5: count, mean, sample std, min, exact quartiles, max per column."""
    base = unpivot_features(df, cols).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    probs = [0.25, 0.5, 0.75]
    q = [(c, *[own.get(p) for p in probs]) for c, own in quantile_table(df, cols, probs).items()]
    qp = df.sparkSession.createDataFrame(q, "feature string, q25 double, q50 double, q75 double")  # a row a column
    return base.join(F.broadcast(qp), "feature", "left")


def conditional_means(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Per column fill rate, mean where label = 0, mean where label = 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).isNotNull().cast("double")).alias(f"f_{c}"),
                 F.avg(F.when(F.col(label) == 0, F.col(c))).alias(f"m0_{c}"),
                 F.avg(F.when(F.col(label) == 1, F.col(c))).alias(f"m1_{c}")]
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"f_{c}").alias("fill_rate"), F.col(f"m0_{c}").alias("mean_0"),
                 F.col(f"m1_{c}").alias("mean_1")) for c in cols])))


def daily_trend(df: DataFrame, ts: str, flag: str) -> DataFrame:
    """Per day (P6) rate of a flag and volume."""
    return (df.withColumn("day", day_bucket(ts)).groupBy("day")
            .agg(F.avg(flag).alias("rate"), F.count(F.lit(1)).alias("volume")))


def card_summary(df: DataFrame, uid: str, flag: str, device: str) -> DataFrame:
    """Per card count, flag sum, whether any device info is present."""
    return (df.filter(F.col(uid).isNotNull()).groupBy(uid)
            .agg(F.count(F.lit(1)).alias("n_txn"), F.sum(flag).alias("n_fraud"),
                 F.max(F.col(device).isNotNull().cast("int")).alias("has_device")))


def span_summary(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Distinct keys, first / last time, span."""
    return df.agg(F.count_distinct(key).alias("n_keys"), F.min(ts).alias("t_min"), F.max(ts).alias("t_max"),
                  (F.max(ts) - F.min(ts)).alias("span"))


def signal_lift(labeled: DataFrame, signals=("signal_device", "signal_session", "signal_velocity"),
                fraud: str = "isFraud") -> DataFrame:
    """A10: fraud rate and volume where each signal is 0 / 1."""
    items = F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).alias("value")) for s in signals])
    long = labeled.select(fraud, F.inline(items))
    return long.groupBy("signal", "value").agg(F.avg(fraud).alias("fraud_rate"), F.count(F.lit(1)).alias("count"))


def label_summary(labeled: DataFrame, fraud: str = "isFraud", label: str = "ato_proxy") -> DataFrame:
    """A11 + A12: fraud / label totals, label share of fraud, label rate,
    signal-count distribution within fraud, and label sensitivity to 1/2/3
    required signals."""
    f = F.col(fraud) == 1
    sc = F.col("signal_count")
    return labeled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(f.cast("long")).alias("n_fraud"), F.sum(F.col(label).cast("long")).alias("n_label"),
        (F.sum(F.col(label)) / F.sum(f.cast("long"))).alias("label_share_of_fraud"),
        F.avg(F.col(label)).alias("label_rate"),
        *[F.sum((f & (sc == k)).cast("long")).alias(f"fraud_with_{k}_signals") for k in range(4)],
        *[F.sum((f & (sc >= k)).cast("long")).alias(f"label_if_{k}_required") for k in (1, 2, 3)])


def group_max(df: DataFrame, key: str, flag: str, out: str = "has_pos") -> DataFrame:
    """Card has any positive."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(flag).alias(out))


def histogram(df: DataFrame, col: str, bins: int = 50, lo: float | None = None, hi: float | None = None,
              density: bool = False) -> DataFrame:
    """Equi-width bins over [lo, hi] (default: data range), last bin
    right-closed (numpy convention); counts or densities."""
    x = F.col(col)
    if lo is None or hi is None:
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo, hi = (r["lo"] if lo is None else lo), (r["hi"] if hi is None else hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    inside = x.isNotNull() & (x >= lo) & (x <= hi)
    counts = df.filter(inside).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (F.broadcast(grid).join(counts, "bin", "left").fillna(0, ["count"])
           .withColumn("left", F.lit(lo) + F.col("bin") * F.lit(width))
           .withColumn("right", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))
    if density:
        total = F.sum("count").over(Window.partitionBy())  # over `bins` rows only
        out = out.withColumn("density", F.col("count") / (total * F.lit(width)))
    return out


def top_k(df: DataFrame, order_col: str, k: int, desc: bool = True, tie: str | None = None) -> DataFrame:
    """K rows with the largest (smallest) value; TakeOrderedAndProject."""
    o = F.col(order_col).desc() if desc else F.col(order_col).asc()
    return df.orderBy(o, *( [F.col(tie)] if tie else [])).limit(k)
