"""Registered queries: evaluation (E) and drift monitoring (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import config
from riskspark.functions.scalar import drift_band
from riskspark.operators import drift as DR
from riskspark.operators import evaluate as EV
from riskspark.plans.registry import register
from riskspark.plans.sqlparts import r6
from riskspark.session import fresh_folder
from riskspark.sources import bindings as B

MODELS = ["length", "digits"]


def _sp(spark, sf):
    return B.score_pairs(spark, sf)


def _curve(spark, sf):
    return EV.curve(_sp(spark, sf))


def r4(expr: str) -> str:
    """numpy-style 4-place rounding (half to even after scaling)."""
    return f"(round_even(({expr}) * 10000.0, 0) / 10000.0 + 0.0::double)"


CURVE_SQL = f"""with sp as {B.SCORE_PAIRS_SQL},
pts as (select model, score as threshold, sum(label) as p, count(*) - sum(label) as n from sp group by model, score),
cv0 as (select *, sum(p) over (partition by model order by threshold desc rows between unbounded preceding and current row) as tp,
  sum(n) over (partition by model order by threshold desc rows between unbounded preceding and current row) as fp,
  sum(p) over (partition by model) as pos_total, sum(n) over (partition by model) as neg_total from pts),
cv as (select *, tp - p as tp_above, case when tp + fp = 0 then 0.0 else tp / (tp + fp) end as prec,
  case when pos_total = 0 then 1.0 else tp / pos_total end as rec,
  case when neg_total = 0 then 0.0 else fp / neg_total end as fpr from cv0)"""

AUC = "sum(n * (tp_above + p / 2.0)) / (first(pos_total) * first(neg_total))"
AP = "sum(p * prec) / first(pos_total)"


@register("e1_roc_auc", f"{CURVE_SQL} select model, {r6(AUC)} as roc_auc from cv group by model")
def e1(spark, sf):
    return EV.roc_auc(_curve(spark, sf))


@register("e2_average_precision", f"{CURVE_SQL} select model, {r6(AP)} as pr_auc from cv group by model")
def e2(spark, sf):
    return EV.average_precision(_curve(spark, sf))


@register("e3_score_table", f"{CURVE_SQL} select model, {r4(AUC)} as roc_auc, {r4(AP)} as pr_auc from cv group by model")
def e3(spark, sf):
    return EV.score_table(_curve(spark, sf))


def _sweep_sql(thresholds=config.SWEEP_THRESHOLDS):
    ts = ", ".join(f"{t!r}::double" for t in thresholds)
    return f"""with sp as {B.SCORE_PAIRS_SQL},
a as (select model, cast(th.t as double) as threshold, sum(label) as pos_total, count(*) - sum(label) as neg_total,
  sum(case when score >= th.t then label else 0 end) as tp, sum(case when score >= th.t then 1 else 0 end) as pp
  from sp, (select unnest([{ts}]) as t) th group by model, th.t)
select model, threshold, {r4('case when pp = 0 then 0.0 else tp / pp end')} as precision,
  {r4('case when pos_total = 0 then 0.0 else tp / pos_total end')} as recall,
  {r4('case when pp + pos_total = 0 then 0.0 else 2.0 * tp / (pp + pos_total) end')} as f1,
  {r4('case when neg_total = 0 then 0.0 else (pp - tp) / neg_total end')} as fpr from a"""


@register("e4_threshold_sweep", _sweep_sql())
def e4(spark, sf):
    return EV.threshold_sweep(_sp(spark, sf))


#: 50 even steps from .10 to .95
_STEPS = tuple(round(0.1 + 0.85 * i / 49, 6) for i in range(50))


@register("e4b_threshold_sweep_50", _sweep_sql(_STEPS))
def e4b(spark, sf):
    return EV.threshold_sweep(_sp(spark, sf), _STEPS)


@register("e5_pr_curve", f"{CURVE_SQL} select model, {r6('threshold')} as threshold, {r6('prec')} as precision, {r6('rec')} as recall from cv")
def e5(spark, sf):
    return _curve(spark, sf).select("model", "threshold", "precision", "recall")


@register("e6_roc_curve", f"{CURVE_SQL} select model, {r6('threshold')} as threshold, {r6('fpr')} as fpr, {r6('rec')} as tpr from cv")
def e6(spark, sf):
    return _curve(spark, sf).select("model", "threshold", "fpr", "tpr")


OP_COLS = f"""{r4('threshold')} as threshold, {r4('case when tp + fp = 0 then 0.0 else tp / (tp + fp) end')} as precision,
  {r4('case when pos_total = 0 then 0.0 else tp / pos_total end')} as recall,
  {r4('case when 2 * tp + fp + (pos_total - tp) = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + (pos_total - tp)) end')} as f1"""


@register("e7_best_f1", f"""{CURVE_SQL},
b as (select *, row_number() over (partition by model order by 2 * prec * rec / (prec + rec + 1e-9) desc, threshold) as rk from cv)
select model, {OP_COLS}, cast(neg_total - fp as bigint) as tn, cast(fp as bigint) as fp,
  cast(pos_total - tp as bigint) as fn, cast(tp as bigint) as tp from b where rk = 1""")
def e7(spark, sf):
    return EV.best_f1(_curve(spark, sf))


@register("e8_recall_target", f"""{CURVE_SQL},
c as (select model, max(case when rec >= 0.9 then threshold end) as t from cv group by model)
select c.model, 0.9::double as target_recall, cast(c.t is not null as bigint) as reachable, {OP_COLS.replace('threshold)', 'cv.threshold)')}
from c left join cv on c.model = cv.model and cv.threshold = c.t""")
def e8(spark, sf):
    return EV.recall_target(_curve(spark, sf), 0.90)


CONF_SQL = f"""with sp as {B.SCORE_PAIRS_SQL},
cm as (select model, sum(case when score < 0.5 and label <> 1 then 1 else 0 end) as tn,
  sum(case when score >= 0.5 and label <> 1 then 1 else 0 end) as fp,
  sum(case when score < 0.5 and label = 1 then 1 else 0 end) as fn,
  sum(case when score >= 0.5 and label = 1 then 1 else 0 end) as tp from sp group by model)"""


@register("e9_confusion_matrix", f"""{CONF_SQL} select model, cast(tn as bigint) as tn, cast(fp as bigint) as fp,
  cast(fn as bigint) as fn, cast(tp as bigint) as tp,
  {r6('case when tp + fn = 0 then 0.0 else tp / (tp + fn) end')} as recall,
  {r6('case when fp + tn = 0 then 0.0 else fp / (fp + tn) end')} as fpr,
  {r6('case when fn + tp = 0 then 0.0 else fn / (fn + tp) end')} as fnr,
  {r6('case when tp + fp = 0 then 0.0 else tp / (tp + fp) end')} as precision from cm""")
def e9(spark, sf):
    return EV.confusion(_sp(spark, sf), 0.5)


@register("e10_class_report", f"""{CONF_SQL}, l as (select model, 0 as cls, tn as a, fn as b, fp as c from cm
  union all select model, 1, tp, fp, fn from cm)
select model, cast(cls as bigint) as cls, {r6('case when a + b = 0 then 0.0 else a / (a + b) end')} as precision,
  {r6('case when a + c = 0 then 0.0 else a / (a + c) end')} as recall,
  {r6('case when 2 * a + b + c = 0 then 0.0 else 2.0 * a / (2 * a + b + c) end')} as f1, cast(a + c as bigint) as support from l""")
def e10(spark, sf):
    return EV.class_report(_sp(spark, sf), 0.5)


@register("e11_gate", f"""{CURVE_SQL},
st as (select model, {r4(AUC)} as roc_auc from cv group by model),
c as (select model, max(case when rec >= 0.9 then threshold end) as t from cv group by model),
op as (select c.model, c.t, {r4('cv.rec')} as rec4 from c left join cv on c.model = cv.model and cv.threshold = c.t)
select st.model, st.roc_auc, {r4('op.t')} as threshold,
  case when op.t is not null and op.rec4 >= 0.9 and st.roc_auc >= 0.93 then 'pass' else 'fail' end as gate,
  case when op.t is null then 'unreachable' when {r4('op.t')} < 0.05 then 'degenerate' else 'viable' end as viability
from st join op on st.model = op.model""")
def e11(spark, sf):
    c = _curve(spark, sf)
    return EV.gate(EV.score_table(c), EV.recall_target(c, 0.90))


def _long_sql():
    return f"""{CURVE_SQL.replace('with sp as', 'with sp as', 1)},
st as (select model, {r4(AUC)} as roc_auc, {r4(AP)} as pr_auc from cv group by model),
cm as (select model, sum(case when score < 0.5 and label <> 1 then 1 else 0 end) as tn,
  sum(case when score >= 0.5 and label <> 1 then 1 else 0 end) as fp,
  sum(case when score < 0.5 and label = 1 then 1 else 0 end) as fn,
  sum(case when score >= 0.5 and label = 1 then 1 else 0 end) as tp from sp group by model),
lg as (select model, 'roc_auc' as metric, roc_auc as value from st union all select model, 'pr_auc', pr_auc from st
  union all select model, 'recall', case when tp + fn = 0 then 0.0 else tp / (tp + fn) end from cm
  union all select model, 'fpr', case when fp + tn = 0 then 0.0 else fp / (fp + tn) end from cm
  union all select model, 'fnr', case when fn + tp = 0 then 0.0 else fn / (fn + tp) end from cm
  union all select model, 'precision', case when tp + fp = 0 then 0.0 else tp / (tp + fp) end from cm)"""


@register("e12_model_comparison", f"""{_long_sql()}
select metric, {r6("max(case when model = 'length' then value end)")} as length,
  {r6("max(case when model = 'digits' then value end)")} as digits from lg group by metric""")
def e12(spark, sf):
    sp = _sp(spark, sf)
    return EV.comparison(EV.metrics_long(EV.curve(sp), sp, 0.5), MODELS)


def _report_sql():
    ts = ", ".join(str(t) for t in config.SWEEP_THRESHOLDS)
    return f"""{CURVE_SQL},
sz as (select model, count(*) as n, sum(label) as pos from sp group by model),
st as (select model, {r4(AUC)} as roc_auc, {r4(AP)} as pr_auc from cv group by model),
sw0 as (select model, th.t as threshold, sum(label) as pos_total,
  sum(case when score >= th.t then label else 0 end) as tp, sum(case when score >= th.t then 1 else 0 end) as pp
  from sp, (select unnest([{ts}]) as t) th group by model, th.t),
sw as (select model, printf('%.1f', threshold) as t, {r4('case when pp = 0 then 0.0 else tp / pp end')} as precision,
  {r4('case when pos_total = 0 then 0.0 else tp / pos_total end')} as recall,
  {r4('case when pp + pos_total = 0 then 0.0 else 2.0 * tp / (pp + pos_total) end')} as f1 from sw0),
b as (select *, row_number() over (partition by model order by 2 * prec * rec / (prec + rec + 1e-9) desc, threshold) as rk from cv),
bf as (select model, {OP_COLS}, neg_total - fp as tn, fp, pos_total - tp as fn, tp from b where rk = 1),
c as (select model, max(case when rec >= 0.9 then threshold end) as t from cv group by model),
rt as (select c.model, cast(c.t is not null as integer) as reachable, {OP_COLS.replace('threshold)', 'cv.threshold)')}
  from c left join cv on c.model = cv.model and cv.threshold = c.t)
select model, 'sizes' as section, 'test_size' as key, cast(n as double) as value from sz
union all select model, 'sizes', 'test_positives', cast(pos as double) from sz
union all select model, 'model_scores', 'roc_auc', roc_auc from st
union all select model, 'model_scores', 'pr_auc', pr_auc from st
union all select model, 'threshold_sweep', 'precision@' || t, precision from sw
union all select model, 'threshold_sweep', 'recall@' || t, recall from sw
union all select model, 'threshold_sweep', 'f1@' || t, f1 from sw
union all select model, 'best_f1', k, v from bf, (select unnest(['threshold', 'precision', 'recall', 'f1', 'tn', 'fp', 'fn', 'tp']) as k) ks,
  lateral (select case k when 'threshold' then threshold when 'precision' then precision when 'recall' then recall
    when 'f1' then f1 when 'tn' then tn when 'fp' then fp when 'fn' then fn else tp end as v) vv
union all select model, 'at_recall_0.90', k, v from rt, (select unnest(['reachable', 'threshold', 'precision', 'recall', 'f1']) as k) ks,
  lateral (select case k when 'reachable' then reachable when 'threshold' then threshold when 'precision' then precision
    when 'recall' then recall else f1 end as v) vv"""


@register("e13_evaluation_report", _report_sql())
def e13(spark, sf):
    return EV.evaluation_report(_sp(spark, sf))


# ---- D: drift ------------------------------------------------------------------------------------

def _long_sql(side_sql: str, feats: list[str]) -> str:
    return " union all ".join(f"select '{c}' as feature, cast({c} as double) as value from {side_sql} s" for c in feats)


def _drift_ctes(ref_sql: str, cur_sql: str, feats: list[str], px: str = "") -> str:
    """DuckDB PSI / KS / band CTEs; every CTE name starts with ``px``."""
    probs = ", ".join(str(i / config.PSI_BINS) for i in range(config.PSI_BINS + 1))
    n = {k: px + k for k in ("ref", "cur", "qs", "ed", "sides", "cnt", "grid", "full_", "tot", "psi0", "nul", "psi",
                             "kd", "kc", "ks", "rep")}
    return f"""{n['ref']} as ({_long_sql(ref_sql, feats)}), {n['cur']} as ({_long_sql(cur_sql, feats)}),
{n['qs']} as (select feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) as u from {n['ref']} group by feature),
{n['ed']} as (select feature, len(u) - 1 as nb, case when len(u) - 1 >= 2 then list_slice(u, 2, len(u) - 1) else [] end as inner_e from {n['qs']}),
{n['sides']} as (select feature, value, 0 as side from {n['ref']} union all select feature, value, 1 from {n['cur']}),
{n['cnt']} as (select s.feature, len(list_filter(e.inner_e, lambda x: s.value >= x)) as bin,
  sum(1 - side) as r, sum(side) as c from {n['sides']} s join {n['ed']} e on s.feature = e.feature where s.value is not null group by 1, 2),
{n['grid']} as (select feature, unnest(range(greatest(nb, 1))) as bin from {n['ed']}),
{n['full_']} as (select g.feature, g.bin, coalesce(k.r, 0) as r, coalesce(k.c, 0) as c from {n['grid']} g left join {n['cnt']} k
  on g.feature = k.feature and g.bin = k.bin),
{n['tot']} as (select feature, sum(r) as rr, sum(c) as cc from {n['full_']} group by feature),
{n['psi0']} as (select f.feature, sum(((f.c / t.cc + 1e-6) - (f.r / t.rr + 1e-6)) * ln((f.c / t.cc + 1e-6) / (f.r / t.rr + 1e-6))) as p,
  first(t.rr) as n_ref, first(t.cc) as n_cur from {n['full_']} f join {n['tot']} t on f.feature = t.feature group by f.feature),
{n['nul']} as (select feature, sum(case when value is null then 1 else 0 end) as n_null from {n['sides']} group by feature),
{n['psi']} as (select p0.feature, case when e.nb < 2 then 0.0 else p0.p end as psi, p0.n_ref, p0.n_cur, nl.n_null
  from {n['psi0']} p0 join {n['ed']} e on p0.feature = e.feature left join {n['nul']} nl on p0.feature = nl.feature),
{n['kd']} as (select feature, value, sum(case when side = 0 then 1 else 0 end) as r, sum(side) as c from {n['sides']}
  where value is not null group by feature, value),
{n['kc']} as (select feature, sum(r) over (partition by feature order by value rows between unbounded preceding and current row) as cr,
  sum(c) over (partition by feature order by value rows between unbounded preceding and current row) as cc,
  sum(r) over (partition by feature) as tr, sum(c) over (partition by feature) as tc from {n['kd']}),
{n['ks']} as (select feature, max(abs(cr / tr - cc / tc)) as ks from {n['kc']} group by feature),
{n['rep']} as (select p.feature, p.psi, k.ks, case when p.psi < 0.1 then 'stable' when p.psi < 0.25 then 'moderate'
  else 'significant' end as drift from {n['psi']} p left join {n['ks']} k on p.feature = k.feature)"""


_FEATS = B.DRIFT_FEATURES
_DRIFT = _drift_ctes(B.DRIFT_REF_SQL, B.DRIFT_CUR_SQL, _FEATS)
_SCORE_REF = "(select l_extendedprice * (1 - l_discount) as score from lineitem where l_shipdate < timestamp '2000-01-01')"
_SCORE_CUR = "(select l_extendedprice * (1 - l_discount) as score from lineitem where l_shipdate >= timestamp '2000-01-01')"
_SDRIFT = _drift_ctes(_SCORE_REF, _SCORE_CUR, ["score"])


def _long(spark, sf, cols):
    """(feature, value, is_ref) rows of some series, from one scan."""
    from riskspark.operators.features import unpivot_features
    return unpivot_features(B.drift_rows(spark, sf), cols, keep=["is_ref"])


@register("d1_psi", f"with {_DRIFT} select feature, {r6('psi')} as psi, cast(n_ref as bigint) as n_ref, "
          "cast(n_cur as bigint) as n_cur, cast(n_null as bigint) as n_null from psi")
def d1(spark, sf):
    return DR.drift_of(_long(spark, sf, _FEATS)).select("feature", "psi", "n_ref", "n_cur", "n_null")


@register("d2_ks_statistic", f"with {_DRIFT} select feature, {r6('ks')} as ks from ks")
def d2(spark, sf):
    return DR.ks_of(_long(spark, sf, _FEATS))


@register("d3_drift_report", f"with {_DRIFT} select feature, {r6('psi')} as psi, {r6('ks')} as ks, drift from rep order by psi desc")
def d3(spark, sf):
    return DR.report_of(_long(spark, sf, _FEATS))


@register("d3b_drift_from_profile", f"with {_DRIFT} select feature, {r6('psi')} as psi, {r6('ks')} as ks, drift from rep order by psi desc")
def d3b(spark, sf):
    """D3 of a new batch against a saved reference, whose rows are not read again."""
    path, long = fresh_folder(spark, "profile"), _long(spark, sf, _FEATS)
    DR.save_profile(long.filter("is_ref"), path)
    found = DR.drift_against(path, long.filter("not is_ref"))
    return found.select("feature", "psi", "ks", drift_band("psi").alias("drift")).orderBy(F.col("psi").desc())


@register("d5_score_drift", f"with {_SDRIFT} select feature as series, {r6('psi')} as psi, {r6('ks')} as ks, drift from rep")
def d5(spark, sf):
    return DR.report_of(_long(spark, sf, ["score"])).withColumnRenamed("feature", "series")


@register("d4_retraining_recommendation", f"""with {_DRIFT}, {_drift_ctes(_SCORE_REF, _SCORE_CUR, ["score"], "s_")},
a as (select (select max(psi) from s_rep) as score_psi, (select count(*) from rep where drift = 'significant') as n_sig)
select {r6('score_psi')} as score_psi, case when score_psi < 0.1 then 'stable' when score_psi < 0.25 then 'moderate' else 'significant' end as score_drift,
  n_sig as n_features_significant,
  case when score_psi >= 0.25 then 'retrain_now' when score_psi >= 0.1 or n_sig > 0 then 'investigate' else 'no_action' end as recommended_action
from a""")
def d4(spark, sf):
    rep = DR.report_of(_long(spark, sf, [*_FEATS, "score"]))  # the score is one more series
    return DR.retraining_recommendation(rep.filter("feature = 'score'"), rep.filter("feature <> 'score'"))


@register("p14d_decision_derived_thresholds", f"""{CURVE_SQL},
b as (select *, row_number() over (partition by model order by 2 * prec * rec / (prec + rec + 1e-9) desc, threshold) as rk from cv),
bt as (select model, {r4('threshold')} as block from b where rk = 1),
vt as (select model, max(case when rec >= 0.9 then threshold end) as t from cv group by model),
th as (select bt.model, bt.block, coalesce({r4('vt.t')}, bt.block) as verify from bt left join vt on bt.model = vt.model)
select sp.doc_id, sp.model, {r6('round_even(score * 100 * 100, 0) / 100')} as ato_risk_score,
  case when round_even(score * 100 * 100, 0) / 100 >= th.block * 100 then 'block'
       when round_even(score * 100 * 100, 0) / 100 >= th.verify * 100 then 'step_up_auth' else 'allow' end as recommended_action
from sp join th on sp.model = th.model""")
def p14d(spark, sf):
    from riskspark.operators import decide as DC
    sp = _sp(spark, sf)
    return DC.decide_with(sp, DC.derived_thresholds(EV.curve(sp)), key="doc_id")
