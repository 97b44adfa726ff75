"""Registered queries for sources / sinks (S1-S8) and fitted-statistics
alignment (J5).  Each writes data derived from the given tables into a fresh
folder under the shared checkpoint directory and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.operators import decide as D
from riskspark.operators import evaluate as EV
from riskspark.operators import features as FE
from riskspark.operators.label import label_transactions
from riskspark.operators.split import card_split
from riskspark.plans.q_cards import _W
from riskspark.plans.q_eval import _report_sql
from riskspark.plans.registry import register
from riskspark.plans.sqlparts import LAB, SPLIT_SQL, T, r6
from riskspark.session import cut_lineage, ensure_checkpoint_dir
from riskspark.sources import bindings as B
from riskspark.sources import io
from riskspark.sources.io import read_table


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskspark-io/{name}-{uuid.uuid4().hex}"


@register("s1_csv_scan", f"select event_id, user_id, event_type, {r6('value')} as value from events")
def s1(spark, sf):
    path = _scratch(spark, "events-csv")
    io.write_csv(read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path)
    return io.read_csv(spark, path, "event_id long, user_id long, event_type string, value double")


@register("s2_parquet_scan", f"""{T} select TransactionID, uid, TransactionDT, {r6('TransactionAmt')} as TransactionAmt,
  cast(isFraud as bigint) as isFraud, DeviceInfo, DeviceType, id_31, {r6('id_01')} as id_01, {r6('id_02')} as id_02,
  card4, card6 from t""")
def s2(spark, sf):
    return B.txn_view(spark, sf)


@register("s3_parquet_sink", f"{LAB} select TransactionID, uid, cast(signal_count as bigint) as signal_count, "
          "cast(ato_proxy as bigint) as ato_proxy from lab")
def s3(spark, sf):
    path = _scratch(spark, "labelled")
    io.write_parquet(label_transactions(B.txn_view(spark, sf)), path)
    return spark.read.parquet(path).select("TransactionID", "uid", "signal_count", "ato_proxy")


@register("s4_sequence_table", f"""{LAB}, {SPLIT_SQL},
h as (select TransactionID, uid, ato_proxy, list(TransactionAmt) over ({_W} rows between 10 preceding and 1 preceding) as la from lab)
select h.TransactionID, h.uid, cast(h.ato_proxy as bigint) as label, sp.split, cast(len(la) as bigint) as hist_len,
  {r6('list_sum(la)')} as s_amt from h join sp on h.uid = sp.uid where la is not null and len(la) > 0""")
def s4(spark, sf):
    lab = cut_lineage(label_transactions(B.txn_view(spark, sf)).select("TransactionID", "uid", "TransactionDT", "TransactionAmt", "ato_proxy"), columnar=True)
    seq = FE.sequence_history(lab, ["TransactionAmt"]).join(card_split(lab).select("uid", "split"), "uid")
    path = _scratch(spark, "sequences")
    io.write_parquet(seq.select("TransactionID", "uid", F.col("ato_proxy").alias("label"), "split", "hist_len", "seq"),
                     path, partition_by=["split"])
    back = spark.read.parquet(path)
    s = F.aggregate(F.transform("seq", lambda x: x[0]), F.lit(0.0), lambda a, b: a + b)
    return back.select("TransactionID", "uid", "label", "split", "hist_len", s.alias("s_amt"))


_RISK = "round_even(score * 100 * 100, 0) / 100"


@register("s5_csv_sink", f"""select doc_id, {r6(_RISK)} as ato_risk_score,
  case when {_RISK} >= 16.0 then 'block' when {_RISK} >= 5.5 then 'step_up_auth' else 'allow' end as recommended_action
from {B.SCORE_PAIRS_SQL} s where model = 'length'""")
def s5(spark, sf):
    risk = D.risk_table(B.score_pairs(spark, sf).filter(F.col("model") == "length"), key="doc_id")
    path = _scratch(spark, "risk-csv")
    io.write_csv(risk, path)
    return io.read_csv(spark, path, "doc_id long, ato_risk_score double, recommended_action string")


@register("s6_json_report", _report_sql())
def s6(spark, sf):
    path = _scratch(spark, "report-json")
    io.write_json(EV.evaluation_report(B.score_pairs(spark, sf)), path)
    return spark.read.schema("model string, section string, key string, value double").json(path)


@register("s7_fitted_state", f"""{T} select 'TransactionAmt' as feature, 'clip_lo' as stat, {r6('quantile_cont(TransactionAmt, 0.001)')} as value from t
union all select 'TransactionAmt', 'clip_hi', {r6('quantile_cont(TransactionAmt, 0.999)')} from t
union all select 'TransactionAmt', 'median', {r6('median(TransactionAmt)')} from t
union all select 'TransactionAmt', 'mean', {r6('avg(TransactionAmt)')} from t
union all select 'TransactionAmt', 'scale', {r6('stddev_pop(TransactionAmt)')} from t""")
def s7(spark, sf):
    df = B.txn_view(spark, sf)
    lo, hi = FE.winsor_bounds(df, ["TransactionAmt"])["TransactionAmt"]
    med = FE.medians(df, ["TransactionAmt"])["TransactionAmt"]
    mu, sd = FE.moments(df, ["TransactionAmt"])["TransactionAmt"]
    state = spark.createDataFrame([("TransactionAmt", k, float(v)) for k, v in
                                   (("clip_lo", lo), ("clip_hi", hi), ("median", med), ("mean", mu), ("scale", sd))],
                                  "feature string, stat string, value double")
    path = _scratch(spark, "state")
    io.save_state(state, path)
    return io.load_state(spark, path)


@register("s7b_apply_state", f"""{T}, st as (select quantile_cont(TransactionAmt, 0.001) as lo, quantile_cont(TransactionAmt, 0.999) as hi,
  median(TransactionAmt) as med, avg(TransactionAmt) as mu, stddev_pop(TransactionAmt) as sd from t)
select TransactionID, {r6("(coalesce(case when TransactionAmt > hi then hi when TransactionAmt < lo then lo else TransactionAmt end, med) - mu) / (case when sd = 0 then 1.0 else sd end)")} as TransactionAmt
from t, st""")
def s7b(spark, sf):
    """The saved state, loaded and applied to rows."""
    return FE.apply_state(B.txn_view(spark, sf).select("TransactionID", "TransactionAmt"), s7(spark, sf))


@register("s8_materialized_table", f"{LAB} select TransactionID, cast(ato_proxy as bigint) as ato_proxy from lab")
def s8(spark, sf):
    path = _scratch(spark, "materialized")
    build = lambda: label_transactions(B.txn_view(spark, sf)).select("TransactionID", "ato_proxy")
    made_from = [io.table_path(sf, "events")]
    io.materialize(spark, build, path, inputs=made_from)
    return io.materialize(spark, build, path, inputs=made_from)  # second call reuses the committed table


@register("j5_align_fitted_stats", f"""{T}, l as (select TransactionID, 'TransactionAmt' as feature, TransactionAmt as value from t
  union all select TransactionID, 'id_02', id_02 from t),
st as (select feature, avg(value) as mu, case when stddev_pop(value) = 0 then 1.0 else stddev_pop(value) end as sd
  from l group by feature)
select l.TransactionID, l.feature, {r6('(l.value - st.mu) / st.sd')} as z from l join st on l.feature = st.feature""")
def j5(spark, sf):
    long = FE.unpivot_features(B.txn_view(spark, sf), ["TransactionAmt", "id_02"], keep=["TransactionID"])
    stats = long.groupBy("feature").agg(F.avg("value").alias("mu"), F.stddev_pop("value").alias("_sd")) \
        .withColumn("sd", F.when(F.col("_sd") == 0, F.lit(1.0)).otherwise(F.col("_sd")))
    # one row per feature: a broadcast equi-join on the feature name (no cross join)
    return long.join(F.broadcast(stats), "feature").select(
        "TransactionID", "feature", ((F.col("value") - F.col("mu")) / F.col("sd")).alias("z"))
