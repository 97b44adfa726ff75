"""Ordered running totals, exact quantiles and exact ranks without a
single-partition window, on one path whatever the size.

Rows are laid out by range on the full (group, order) tuple, so ties of a
prefix, nulls, strings and any number of groups are divided alike, and written
once with the number of their range partition.  Running sums are taken inside
each (group, part); the totals of the parts -- one row per part and group --
are prefix-summed and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.session import cut_lineage

PART = "_part"


def ascending(cols: list[str]) -> list[Column]:
    """The order used everywhere: ascending, nulls first."""
    return [F.col(c).asc_nulls_first() for c in cols]


def ordered_parts(df: DataFrame, keys: list[str], scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """``df`` as a written table in range partitions of ``keys``, numbered in
    ``_part``: rows of a smaller number come before those of a larger one."""
    n = scale.parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *ascending(keys)).withColumn(PART, F.spark_partition_id())
    return cut_lineage(laid, columnar=True)  # the tag must not be computed twice


def running_totals(df: DataFrame, by: list[str], order: list[str], sums: list[str], *,
                   scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order`` within ``by``) and
    ``tot_<c>`` (group total) for each column of ``sums``.

    ``order`` must be unique within a group (pre-aggregate ties); nulls of
    ``by`` are a group, nulls of ``order`` come first.
    """
    return laid_totals(ordered_parts(df, [*by, *order], scale), by, order, sums)


def laid_totals(d: DataFrame, by: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """The same of a written table that is laid out already: rows of a smaller ``_part`` come
    before those of a larger one."""
    run = (Window.partitionBy(*by, PART).orderBy(*ascending(order))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.select("*", *[F.sum(c).over(run).alias(f"_in_{c}") for c in sums])
    tot = d.groupBy(*by, PART).agg(*[F.sum(c).alias(f"_bt_{c}") for c in sums])
    # over one row per part and group: at most parts + groups rows in all
    whole = Window.partitionBy(*by)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, PART]],
                      *[F.coalesce(F.sum(f"_bt_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
                      *[F.sum(f"_bt_{c}").over(whole).alias(f"tot_{c}") for c in sums])
    same = F.lit(True)
    for c in [*by, PART]:
        same = same & inner[c].eqNullSafe(offs[f"_k_{c}"])
    return inner.join(offs, same).select(*[inner[c] for c in d.columns if c != PART],
                                         *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in sums],
                                         *[F.col(f"tot_{c}") for c in sums])


def quantiles_from_running(rt: DataFrame, by: list[str], value: str, count: str, cum: str, tot: str,
                           probs: list[float]) -> DataFrame:
    """Exact linear quantiles from a running-totals table of distinct values
    (``count`` rows at ``value``; ``cum`` inclusive running count; ``tot``
    group total).  Each row keeps only the probabilities whose neighbour it is,
    so nothing is multiplied out; rows with a zero count never match.  Returns
    ``by..., p, q, n, q_lo, q_hi, q_frac``."""
    start, end, n = F.col(cum) - F.col(count), F.col(cum), F.col(tot)

    def holds(k: Column) -> Column:
        return (start <= k) & (k < end)

    def near(p: Column) -> Column:
        return holds(F.floor((n - 1) * p)) | holds(F.ceil((n - 1) * p))

    pa = F.array(*[F.lit(float(p)) for p in probs])
    x = rt.select(*by, F.col(value).alias("_v"), start.alias("_s"), end.alias("_e"), n.alias("_tot"),
                  F.explode(F.filter(pa, near)).alias("p")).withColumn("_pos", (F.col("_tot") - 1) * F.col("p"))
    lo = (F.col("_s") <= F.floor("_pos")) & (F.floor("_pos") < F.col("_e"))
    hi = (F.col("_s") <= F.ceil("_pos")) & (F.ceil("_pos") < F.col("_e"))
    res = x.groupBy(*by, "p").agg(  # at most two rows per (group, p)
        F.max(F.when(lo, F.col("_v"))).alias("_vlo"), F.max(F.when(hi, F.col("_v"))).alias("_vhi"),
        F.first("_pos").alias("_pos"), F.first("_tot").alias("n"))
    frac = F.col("_pos") - F.floor("_pos")
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac
    return res.select(*by, "p", q.alias("q"), "n", F.col("_vlo").alias("q_lo"), F.col("_vhi").alias("q_hi"),
                      frac.alias("q_frac"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None, *,
                    scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Linear-interpolated quantiles (numpy / pandas / DuckDB ``quantile_cont``
    semantics), exact, nulls skipped.  Returns ``by..., p, q, n`` plus the two
    neighbouring values ``q_lo, q_hi`` and weight ``q_frac`` (so a quantile of
    any monotone transform of the values follows without another pass).

    Works on distinct values with counts (a value repeated a billion times is
    one row).
    """
    by = list(by or [])
    v = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    d = v.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    rt = running_totals(d, by, ["_v"], ["_c"], scale=scale)
    return quantiles_from_running(rt, by, "_v", "_c", "cum__c", "tot__c", probs)


def exact_rank(df: DataFrame, by: list[str], order: list[str], *, out: str = "rank",
               scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """1-based position of each row in ``order`` within ``by`` (order must be
    unique, of any type), plus ``group_n`` -- a distributed ``row_number``."""
    r = running_totals(df.withColumn("_one", F.lit(1)), by, order, ["_one"], scale=scale)
    return r.withColumnRenamed("cum__one", out).withColumnRenamed("tot__one", "group_n").drop("_one")
