"""Drift monitoring (D1-D5): PSI on reference-quantile bins and the
two-sample KS statistic, for all features in one job over long
``(feature, value)`` rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.functions.scalar import drift_band
from riskspark.operators.features import unpivot_features
from riskspark.operators.ranks import PART, laid_totals, ordered_parts, quantiles_from_running, running_totals
from riskspark.session import cut_lineage
from riskspark.sources.io import read_text, write_text


def _both(ref: DataFrame, cur: DataFrame) -> DataFrame:
    return (ref.select("feature", "value", F.lit(True).alias("is_ref"))
            .unionByName(cur.select("feature", "value", F.lit(False).alias("is_ref"))))


def _side_counts(rows: DataFrame) -> DataFrame:
    """The one pass over the raw rows: ``(feature, value) -> r, c`` counts of
    each side (a null value row holds the null counts)."""
    r = F.col("is_ref").cast("long")
    return (rows.groupBy("feature", F.col("value").cast("double").alias("value"))
            .agg(F.sum(r).alias("r"), F.sum(1 - r).alias("c")))


def drift_stats(ref: DataFrame, cur: DataFrame, bins: int = config.PSI_BINS,
                scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """D1 + D2 per feature from long ``(feature, value)`` rows of both sides:
    ``feature, psi, ks, n_ref, n_cur, n_null``."""
    return drift_of(_both(ref, cur), bins, scale)


def drift_of(rows: DataFrame, bins: int = config.PSI_BINS, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """The same from ``(feature, value, is_ref)`` rows.

    One scan of the raw rows (distinct value counts per side), one set of
    distributed running totals over the distinct values; from it the
    reference quantile edges (PSI), the CDF gap (KS) and the per-bin counts.
    PSI: edges = distinct exact reference quantiles at 0, 1/bins ... 1 with
    the outer ones opened to +-inf, bins [a, b), shares + 1e-6,
    sum((c - r) ln(c / r)); a constant reference gives 0.  Nulls are dropped
    and counted in ``n_null``.
    """
    counts = cut_lineage(_side_counts(rows))
    nulls = counts.filter(F.col("value").isNull()).select("feature", (F.col("r") + F.col("c")).alias("n_null"))
    d = counts.filter(F.col("value").isNotNull())
    rt = cut_lineage(running_totals(d, ["feature"], ["value"], ["r", "c"], scale=scale))
    return _stats(rt, _edges(rt, bins), nulls)


def _edges(rt: DataFrame, bins: int) -> dict[str, list[float]]:
    """Distinct exact reference quantiles of each feature (features x (bins + 1) at most)."""
    probs = [i / bins for i in range(bins + 1)]
    q = quantiles_from_running(rt.filter(F.col("r") > 0), ["feature"], "value", "r", "cum_r", "tot_r", probs).collect()
    uniq: dict = {}
    for row in q:
        uniq.setdefault(row["feature"], set()).add(row["q"])
    return {f: sorted(u) for f, u in uniq.items()}


def _stats(rt: DataFrame, edges: dict[str, list[float]], nulls: DataFrame) -> DataFrame:
    """PSI and KS from running totals of both sides over the distinct values."""
    spark = rt.sparkSession
    feats = sorted(edges)
    if not feats:
        return spark.createDataFrame([], "feature string, psi double, ks double, n_ref long, n_cur long, n_null long")
    inner = {f: e[1:-1] if len(e) >= 3 else [] for f, e in edges.items()}
    nbins = {f: len(e) - 1 for f, e in edges.items()}
    edge_map = F.create_map(*[x for f in feats
                              for x in (F.lit(f), F.array(*[F.lit(float(v)) for v in inner[f]]).cast("array<double>"))])
    binned = (rt.join(F.broadcast(spark.createDataFrame([(f,) for f in feats], "feature string")), "feature")
              .withColumn("bin", F.size(F.filter(F.element_at(edge_map, F.col("feature")), lambda e: F.col("value") >= e))))
    per_bin = binned.groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    grid = spark.createDataFrame([(f, b) for f in feats for b in range(max(nbins[f], 1))], "feature string, bin int")
    full = F.broadcast(grid).join(per_bin, ["feature", "bin"], "left").fillna(0, ["r", "c"])
    w = Window.partitionBy("feature")  # over the bins of one feature (<= bins rows)
    rp = F.coalesce(F.try_divide(F.col("r"), F.sum("r").over(w)), F.lit(0.0)) + config.PSI_EPS
    cp = F.coalesce(F.try_divide(F.col("c"), F.sum("c").over(w)), F.lit(0.0)) + config.PSI_EPS
    psi = full.select("feature", "r", "c", ((cp - rp) * F.log(cp / rp)).alias("_t")).groupBy("feature").agg(
        F.sum("_t").alias("_psi"), F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    gap = F.abs(F.try_divide(F.col("cum_r"), F.col("tot_r")) - F.try_divide(F.col("cum_c"), F.col("tot_c")))
    ks = rt.groupBy("feature").agg(F.max(gap).alias("ks"))
    few = F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(nbins[f] < 2))])
    return (psi.join(ks, "feature", "left").join(nulls, "feature", "left")
            .select("feature", F.when(F.element_at(few, F.col("feature")), F.lit(0.0)).otherwise(F.col("_psi")).alias("psi"),
                    "ks", "n_ref", "n_cur", F.coalesce(F.col("n_null"), F.lit(0)).alias("n_null")))


# ---- a saved reference: new batches are compared without reading its rows again ----------------

def save_profile(reference: DataFrame, path: str, bins: int = config.PSI_BINS, scale: ScaleConfig = DEFAULT_SCALE) -> None:
    """The reference side of long ``(feature, value)`` rows as a profile: its distinct values with
    counts, in range partitions, where each begins, the edges of the PSI bins, and the null
    counts.  The profile counts once its ``profile.json`` is written."""
    root, spark = path.rstrip("/"), reference.sparkSession
    counts = cut_lineage(reference.groupBy("feature", F.col("value").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("r")))
    laid = ordered_parts(counts.filter(F.col("value").isNotNull()), ["feature", "value"], scale)
    laid.write.mode("overwrite").parquet(f"{root}/values")
    laid = spark.read.schema(laid.schema).parquet(f"{root}/values")
    starts = laid.groupBy(PART).agg(F.min(F.struct("feature", "value")).alias("s")).orderBy(PART).collect()  # a row a part
    edges = _edges(laid_totals(laid, ["feature"], ["value"], ["r"]), bins)
    nulls = counts.filter(F.col("value").isNull()).select("feature", "r").collect()  # a row a feature
    write_text(spark, f"{root}/profile.json", json.dumps({
        "edges": edges, "starts": [[r[PART], r["s"]["feature"], r["s"]["value"]] for r in starts], "nulls": {r["feature"]: r["r"] for r in nulls}}))


def drift_against(path: str, current: DataFrame) -> DataFrame:
    """``drift_stats`` of a saved reference and a new batch of long ``(feature, value)`` rows.  The
    batch's distinct values go to the profile's own range partitions; the two runs
    are merged there and summed up inside them."""
    root, spark = path.rstrip("/"), current.sparkSession
    about = json.loads(read_text(spark, f"{root}/profile.json"))
    counts = cut_lineage(current.groupBy("feature", F.col("value").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("c")))
    at = F.struct("feature", "value")
    starts = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(v).alias("value")) for _, f, v in about["starts"]]) if about["starts"] else None
    numbers = F.array(*[F.lit(p) for p, _, _ in about["starts"]] or [F.lit(0)])
    # a value before the first start belongs to the first part
    part = F.lit(0) if starts is None else F.get(numbers, F.greatest(F.size(F.filter(starts, lambda s: s <= at)) - 1, F.lit(0)))
    reference = spark.read.schema("feature string, value double, r long, _part int").parquet(f"{root}/values")
    new = counts.filter(F.col("value").isNotNull()).select("feature", "value", F.lit(0).cast("long").alias("r"), "c", part.cast("int").alias(PART))
    both = reference.withColumn("c", F.lit(0).cast("long")).select("feature", "value", "r", "c", PART).unionByName(new)
    merged = cut_lineage(both.groupBy("feature", PART, "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c")), columnar=True)
    rt = cut_lineage(laid_totals(merged, ["feature"], ["value"], ["r", "c"]))
    kept = spark.createDataFrame(list(about["nulls"].items()), "feature string, r long")
    nulls = counts.filter(F.col("value").isNull()).select("feature", F.col("c").alias("r")).unionByName(kept).groupBy("feature").agg(F.sum("r").alias("n_null"))
    return _stats(rt, about["edges"], nulls)


def psi_table(ref: DataFrame, cur: DataFrame, bins: int = config.PSI_BINS,
              scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """D1 per feature: ``feature, psi, n_ref, n_cur, n_null``."""
    return drift_stats(ref, cur, bins, scale).select("feature", "psi", "n_ref", "n_cur", "n_null")


def ks_table(ref: DataFrame, cur: DataFrame, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """D2 per feature: max |F_ref(x) - F_cur(x)| over all observed x
    (right-continuous empirical CDFs)."""
    return ks_of(_both(ref, cur), scale)


def ks_of(rows: DataFrame, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """The same from ``(feature, value, is_ref)`` rows."""
    counts = _side_counts(rows).filter(F.col("value").isNotNull())
    rt = running_totals(counts, ["feature"], ["value"], ["r", "c"], scale=scale)
    gap = F.abs(F.try_divide(F.col("cum_r"), F.col("tot_r")) - F.try_divide(F.col("cum_c"), F.col("tot_c")))
    return rt.groupBy("feature").agg(F.max(gap).alias("ks"))


def drift_report(reference: DataFrame, current: DataFrame, features: list[str], bins: int = config.PSI_BINS,
                 scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """D3: ``feature, psi, ks, drift`` sorted by PSI descending."""
    ref = unpivot_features(reference, features)
    cur = unpivot_features(current, features)
    return report_of(_both(ref, cur), bins, scale)


def report_of(rows: DataFrame, bins: int = config.PSI_BINS, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """The same from ``(feature, value, is_ref)`` rows."""
    rep = drift_of(rows, bins, scale)
    return rep.select("feature", "psi", "ks", drift_band("psi").alias("drift")).orderBy(F.col("psi").desc())


def score_drift(reference: DataFrame, current: DataFrame, score: str = "score", bins: int = config.PSI_BINS,
                scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """PSI and KS of a model score between two batches (one row)."""
    return drift_report(reference, current, [score], bins, scale).withColumnRenamed("feature", "series")


def retraining_recommendation(score_report: DataFrame, feature_report: DataFrame) -> DataFrame:
    """Score significant -> retrain_now; score moderate or any significant
    feature -> investigate; else no_action (one row, one aggregate)."""
    rows = (feature_report.select(F.lit(None).cast("double").alias("_s"),
                                  (F.col("drift") == "significant").cast("long").alias("_sig"))
            .unionByName(score_report.select(F.col("psi").cast("double").alias("_s"), F.lit(0).cast("long").alias("_sig"))))
    a = rows.agg(F.max("_s").alias("score_psi"), F.coalesce(F.sum("_sig"), F.lit(0)).alias("n_features_significant"))
    band = drift_band("score_psi")
    return a.select("score_psi", band.alias("score_drift"), "n_features_significant",
                    F.when(band == "significant", "retrain_now")
                    .when((band == "moderate") | (F.col("n_features_significant") > 0), "investigate")
                    .otherwise("no_action").alias("recommended_action"))
