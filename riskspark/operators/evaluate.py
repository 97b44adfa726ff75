"""Evaluation of ranked scores.

Input contract: ``(model, label, score)``.  Every curve operator first
collapses rows to one point per distinct score (ties are one point), then
uses distributed running totals; operating points are plain aggregates
(``min_by`` / conditional sums), so nothing funnels through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.functions.scalar import np_round
from riskspark.operators.ranks import running_totals


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (``zero_division=0``)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def curve(scores: DataFrame, *, model: str = "model", label: str = "label", score: str = "score",
          scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """E5/E6 points: per model and distinct score ``t`` (predict ``score >= t``):
    ``p, n`` rows at t, ``tp, fp`` at the cut, ``P, N``, precision, recall,
    tpr, fpr.  Rows without a score or a label can't be ranked and are left out."""
    pts = (scores.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(model, score)
           .agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("_c"))
           .withColumn("n", F.col("_c") - F.col("p")).drop("_c"))
    rt = running_totals(pts, [model], [score], ["p", "n"], scale=scale)
    tp = F.col("tot_p") - F.col("cum_p") + F.col("p")
    fp = F.col("tot_n") - F.col("cum_n") + F.col("n")
    out = rt.select(model, F.col(score).alias("threshold"), "p", "n", tp.alias("tp"), fp.alias("fp"),
                    F.col("tot_p").alias("pos_total"), F.col("tot_n").alias("neg_total"),
                    (F.col("tot_p") - F.col("cum_p")).alias("tp_above"))
    return (out.withColumn("precision", _div0(F.col("tp"), F.col("tp") + F.col("fp")))
            .withColumn("recall", F.when(F.col("pos_total") == 0, F.lit(1.0))
                        .otherwise(F.col("tp") / F.col("pos_total")))
            .withColumn("tpr", F.col("recall"))
            .withColumn("fpr", _div0(F.col("fp"), F.col("neg_total"))))


def _auc() -> Column:
    num = F.sum(F.col("n") * (F.col("tp_above") + F.col("p") / 2.0))
    pairs = F.first("pos_total").cast("double") * F.first("neg_total")  # as a long it can overflow
    return F.try_divide(num, pairs)


def _ap() -> Column:
    return F.try_divide(F.sum(F.col("p") * F.col("precision")), F.first("pos_total"))


def roc_auc(c: DataFrame, model: str = "model") -> DataFrame:
    """Pairs ranked right, ties count half."""
    return c.groupBy(model).agg(_auc().alias("roc_auc"))


def average_precision(c: DataFrame, model: str = "model") -> DataFrame:
    """Step sum over thresholds of (recall gain) x precision."""
    return c.groupBy(model).agg(_ap().alias("pr_auc"))


def score_table(c: DataFrame, model: str = "model") -> DataFrame:
    """ROC-AUC and average precision per model, 4 decimals."""
    return c.groupBy(model).agg(np_round(_auc(), 4).alias("roc_auc"), np_round(_ap(), 4).alias("pr_auc"))


def _prf(tp: Column, fp: Column, P: Column) -> tuple[Column, Column, Column]:
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, P)
    f1 = _div0(2 * tp, 2 * tp + fp + (P - tp))
    return prec, rec, f1


def threshold_sweep(scores: DataFrame, thresholds=config.SWEEP_THRESHOLDS, *, model: str = "model",
                    label: str = "label", score: str = "score", digits: int = 4) -> DataFrame:
    """Precision / recall / F1 (and FPR) at ``score >= t`` for each t, in
    one aggregation pass."""
    aggs = [F.sum(F.col(label).cast("long")).alias("pos_total"), F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        hit = F.col(score) >= F.lit(float(t))
        aggs += [F.sum(F.when(hit, F.col(label)).otherwise(0)).cast("long").alias(f"tp{i}"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"pp{i}")]
    a = scores.groupBy(model).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                              (F.col(f"pp{i}") - F.col(f"tp{i}")).alias("fp")) for i, t in enumerate(thresholds)])
    long = a.select(model, "pos_total", (F.col("_n") - F.col("pos_total")).alias("neg_total"), F.inline(rows))
    prec, rec, f1 = _prf(F.col("tp"), F.col("fp"), F.col("pos_total"))
    return long.select(model, "threshold", np_round(prec, digits).alias("precision"),
                       np_round(rec, digits).alias("recall"), np_round(f1, digits).alias("f1"),
                       np_round(_div0(F.col("fp"), F.col("neg_total")), digits).alias("fpr"))


_POINT = ("threshold", "tp", "fp", "pos_total", "neg_total")


def best_f1_point() -> Column:
    """Aggregate: the curve point of the largest 2PR/(P+R+1e-9), the lowest
    threshold on ties."""
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + config.F1_EPS)
    return F.min_by(F.struct(*_POINT), F.struct((-f1).alias("a"), F.col("threshold").alias("b")))


def recall_point(target: float) -> Column:
    """Aggregate: the curve point of the highest threshold whose recall reaches
    ``target``, null when none does."""
    return F.max_by(F.struct(*_POINT), F.when(F.col("recall") >= target, F.col("threshold")))


def _operating_point(point: str) -> list[Column]:
    """Metrics and confusion matrix at a chosen curve point."""
    tp, fp, pos, neg = (F.col(f"{point}.{c}") for c in _POINT[1:])
    prec, rec, f1 = _prf(tp, fp, pos)
    rows = {"threshold": np_round(f"{point}.threshold", 4), "precision": np_round(prec, 4), "recall": np_round(rec, 4),
            "f1": np_round(f1, 4), "tn": neg - fp, "fp": fp, "fn": pos - tp, "tp": tp}
    return [F.when(F.col(point).isNotNull(), v).alias(k) for k, v in rows.items()]


def best_f1(c: DataFrame, model: str = "model") -> DataFrame:
    """Threshold maximising 2PR/(P+R+1e-9), lowest threshold on ties;
    metrics recomputed there (``score >= t``)."""
    return c.groupBy(model).agg(best_f1_point().alias("_pt")).select(model, *_operating_point("_pt"))


def recall_target(c: DataFrame, target: float = 0.90, model: str = "model") -> DataFrame:
    """Highest threshold whose recall reaches ``target``;
    ``reachable = 0`` (metrics null) when none does."""
    op = c.groupBy(model).agg(recall_point(target).alias("_pt"))
    return op.select(model, F.lit(float(target)).alias("target_recall"), F.col("_pt").isNotNull().cast("int").alias("reachable"),
                     *_operating_point("_pt")).select(model, "target_recall", "reachable", "threshold", "precision", "recall", "f1")


def confusion(scores: DataFrame, threshold: float = 0.5, *, model: str = "model", label: str = "label",
              score: str = "score") -> DataFrame:
    """TN FP FN TP and recall, FPR, FNR, precision at ``score >= t``."""
    hit = F.col(score) >= F.lit(float(threshold))
    y = F.col(label) == 1
    a = scores.groupBy(model).agg(
        F.sum(F.when(~hit & ~y, 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(hit & ~y, 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~hit & y, 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(hit & y, 1).otherwise(0)).cast("long").alias("tp"))
    return a.select("*", _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    _div0(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
                    _div0(F.col("fn"), F.col("fn") + F.col("tp")).alias("fnr"),
                    _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def class_report(scores: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """Precision / recall / F1 / support for class 0 and class 1."""
    model = kw.get("model", "model")
    cm = confusion(scores, threshold, **kw)
    rows = F.array(
        F.struct(F.lit(0).alias("cls"), F.col("tn").alias("tp_c"), F.col("fn").alias("fp_c"),
                 F.col("fp").alias("fn_c")),
        F.struct(F.lit(1).alias("cls"), F.col("tp").alias("tp_c"), F.col("fp").alias("fp_c"),
                 F.col("fn").alias("fn_c")))
    long = cm.select(model, F.inline(rows))
    tp, fp, fn = F.col("tp_c"), F.col("fp_c"), F.col("fn_c")
    return long.select(model, "cls", _div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
                       _div0(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support"))


def gate(table: DataFrame, at_recall: DataFrame, model: str = "model", min_recall: float = 0.90,
         min_auc: float = 0.93, min_threshold: float = 0.05) -> DataFrame:
    """pass/fail on recall and AUC; an operating threshold below .05 is
    'degenerate'."""
    j = table.join(at_recall, model, "left")
    ok = (F.col("reachable") == 1) & (F.col("recall") >= min_recall) & (F.col("roc_auc") >= min_auc)
    return j.select(model, "roc_auc", "threshold",
                    F.when(ok, "pass").otherwise("fail").alias("gate"),
                    F.when(F.col("threshold").isNull(), "unreachable")
                    .when(F.col("threshold") < min_threshold, "degenerate").otherwise("viable").alias("viability"))


def metrics_long(c: DataFrame, scores: DataFrame, threshold: float = 0.5, model: str = "model") -> DataFrame:
    """(model, metric, value) rows: AUCs plus the confusion rates at t."""
    st = score_table(c, model)
    cm = confusion(scores, threshold, model=model)
    a = st.select(model, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                            for m in ("roc_auc", "pr_auc")])))
    b = cm.select(model, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                            for m in ("recall", "fpr", "fnr", "precision")])))
    return a.unionByName(b)


def comparison(long: DataFrame, models: list[str], model: str = "model") -> DataFrame:
    """Metrics x models pivot (model names given, so no extra job)."""
    return long.groupBy("metric").pivot(model, models).agg(F.first("value"))


def evaluation_report(scores: DataFrame, *, model: str = "model", target: float = 0.90,
                      scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Sizes + E3 + E4 + E7 + E8 as one long table
    ``(model, section, key, value)``, ready for the JSON sink."""
    c = curve(scores, model=model, scale=scale)
    one = (c.groupBy(model).agg(np_round(_auc(), 4).alias("roc_auc"), np_round(_ap(), 4).alias("pr_auc"),
                                best_f1_point().alias("_f1"), recall_point(target).alias("_rt")))
    hits = []
    for i, t in enumerate(config.SWEEP_THRESHOLDS):
        hit = F.col("score") >= F.lit(float(t))
        hits += [F.sum(F.when(hit, F.col("label")).otherwise(0)).cast("long").alias(f"_tp{i}"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"_pp{i}")]
    # a model without any ranked row still has its sizes
    per = scores.groupBy(F.col(model).alias("_m")).agg(
        F.count(F.lit(1)).cast("double").alias("test_size"), F.sum("label").cast("double").alias("test_positives"), *hits)
    j = per.join(one, per["_m"].eqNullSafe(one[model]), "left")

    def item(section: str, key: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), value.cast("double").alias("value"))

    items = [item("sizes", k, F.col(k)) for k in ("test_size", "test_positives")]
    items += [item("model_scores", k, F.col(k)) for k in ("roc_auc", "pr_auc")]
    for i, t in enumerate(config.SWEEP_THRESHOLDS):
        tp = F.col(f"_tp{i}")
        prf = _prf(tp, F.col(f"_pp{i}") - tp, F.col("test_positives"))
        items += [item("threshold_sweep", f"{m}@{float(t):.1f}", np_round(v, 4)) for m, v in zip(("precision", "recall", "f1"), prf)]
    names = ("threshold", "precision", "recall", "f1", "tn", "fp", "fn", "tp")
    items += [item("best_f1", m, v) for m, v in zip(names, _operating_point("_f1"))]
    at = f"at_recall_{target:.2f}"
    items += [item(at, "reachable", F.col("_rt").isNotNull())]
    items += [item(at, m, v) for m, v in zip(names[:4], _operating_point("_rt"))]
    return j.select(F.col("_m").alias(model), F.inline(F.array(*items)))
