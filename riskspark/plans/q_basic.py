"""Registered queries: projections (P), joins (J), profiles (A), sort/top-k/
set operations (T) over the canonical views."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import scalar as S
from riskspark.operators import decide as D
from riskspark.operators import features as FE
from riskspark.operators import profile as PR
from riskspark.operators.label import label_transactions
from riskspark.operators.split import card_split
from riskspark.plans.registry import register
from riskspark.plans.sqlparts import LAB, SPLIT_SQL, T, r6
from riskspark.session import cut_lineage
from riskspark.sources import bindings as B
from riskspark.sources.io import read_table


def _txn(spark, sf):
    return B.txn_view(spark, sf)


# ---- P: projections / scalar functions ------------------------------------------

@register("p1_lenient_cast", "select event_id, try_cast(k as double) as k_num, try_cast(props as double) as props_num, "
          "try_cast(k || 'd' as double) as d_num, try_cast('0x' || k || 'p3' as double) as hex_num, "
          "try_cast(k || 'e2' as double) as exp_num, try_cast('-' || k || '.5 ' as double) as neg_num "
          "from (select *, regexp_extract(props, ': (.*)}', 1) as k from events)")
def p1(spark, sf):
    ev = read_table(spark, sf, "events")
    k = F.regexp_extract("props", ": (.*)}", 1)
    text = {"k_num": k, "props_num": F.col("props"), "d_num": F.concat(k, F.lit("d")), "hex_num": F.concat(F.lit("0x"), k, F.lit("p3")),
            "exp_num": F.concat(k, F.lit("e2")), "neg_num": F.concat(F.lit("-"), k, F.lit(".5 "))}
    return ev.select("event_id", *[S.lenient_double(c).alias(n) for n, c in text.items()])


@register("p2_entity_key", """select c.c_custkey, o.o_orderkey,
  coalesce(cast(o.o_custkey as varchar), 'nan') || '_' || cast(c.c_custkey as varchar) as uid_no_card,
  cast(c.c_custkey as varchar) || '_' || coalesce(cast(o.o_orderkey as varchar), 'nan') as uid_no_addr
from customer c left join orders o on o.o_custkey = c.c_custkey""")
def p2(spark, sf):
    """Customers without an order have no card on one side, no address on the other."""
    cu, od = read_table(spark, sf, "customer"), read_table(spark, sf, "orders")
    j = cu.join(od, od.o_custkey == cu.c_custkey, "left")
    return j.select("c_custkey", "o_orderkey", S.entity_key("o_custkey", "c_custkey").alias("uid_no_card"),
                    S.entity_key("c_custkey", "o_orderkey").alias("uid_no_addr"))


@register("p3_device_type_code", f"""{T} select TransactionID,
  cast(case when DeviceType = 'mobile' then 1 when DeviceType = 'desktop' then 2 else 0 end as bigint) as DeviceType_enc from t""")
def p3(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.device_type_code("DeviceType").alias("DeviceType_enc"))


@register("p4_proxy_flag", f"""{T} select TransactionID,
  cast(coalesce(regexp_matches(id_31, 'proxy|anonymous|vpn', 'i'), false) as bigint) as is_proxy from t""")
def p4(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.proxy_flag("id_31").alias("is_proxy"))


@register("p5_hour_of_day", f"""{T} select TransactionID,
  {r6('((TransactionDT % 86400 + 86400) % 86400) / 3600.0')} as hour_of_day from t""")
def p5(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.hour_of_day("TransactionDT").alias("hour_of_day"))


@register("p6_day_bucket", f"{T} select TransactionID, cast(floor(TransactionDT / 86400) as bigint) as day from t")
def p6(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.day_bucket("TransactionDT").alias("day"))


_P7_X = ("case when k % 25 = 0 then 'inf'::double when k % 25 = 1 then '-inf'::double "
         "when k % 25 = 2 then 'nan'::double else value end")


@register("p7_non_finite_to_null", f"""select event_id,
  {r6(f"case when isnan(x) or isinf(x) then null else x end")} as x
from (select event_id, {_P7_X} as x
      from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k from events) e) s""")
def p7(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
    k = F.col("k")
    x = (F.when(k % 25 == 0, F.lit(float("inf"))).when(k % 25 == 1, F.lit(float("-inf")))
         .when(k % 25 == 2, F.lit(float("nan"))).otherwise(F.col("value")))
    return ev.select("event_id", S.finite_or_null(x).alias("x"))


@register("p8_clip", f"{T} select TransactionID, {r6('greatest(5.0, least(50.0, TransactionAmt))')} as amt_clipped from t")
def p8(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.clip("TransactionAmt", 5.0, 50.0).alias("amt_clipped"))


@register("p9_select_by_pattern", f"{T} select TransactionID, {r6('id_01')} as id_01, {r6('id_02')} as id_02, id_31 from t")
def p9(spark, sf):
    return FE.select_columns(_txn(spark, sf), pattern="id_*", keep=["TransactionID"])


def _p10_sql():
    from riskspark import config
    cands = config.BASE_FEATURES + ["id_01", "id_02", "id_31"]
    raw = {"TransactionAmt", "id_01", "id_02", "id_31"}
    parts = []
    for i, c in enumerate(cands):
        cond = f"count(try_cast({c} as double)) > 0" if c in raw else "count(*) > 0"
        parts.append(f"select {i} as ord, '{c}' as feature from t having {cond}")
    return f"{T} select cast(row_number() over (order by ord) - 1 as bigint) as pos, feature from ({' union all '.join(parts)}) u"


@register("p10_feature_selection", _p10_sql())
def p10(spark, sf):
    df = FE.behaviour_features(FE.encode_categoricals(_txn(spark, sf)))
    feats = FE.choose_features(df)
    return spark.createDataFrame([(i, c) for i, c in enumerate(feats)], "pos long, feature string")


@register("p11_drop_add_rename", f"""{T} select TransactionID, uid, TransactionDT, {r6('TransactionAmt')} as amount,
  cast(isFraud as bigint) as isFraud, DeviceInfo, DeviceType, {r6('id_01')} as id_01, {r6('id_02')} as id_02,
  card4, card6, {r6('TransactionAmt * 100')} as amount_cents from t""")
def p11(spark, sf):
    return (_txn(spark, sf).drop("id_31").withColumnRenamed("TransactionAmt", "amount")
            .withColumn("amount_cents", F.col("amount") * 100))


@register("p12_filter", f"{T} select TransactionID, {r6('TransactionAmt')} as TransactionAmt from t where isFraud = 1 and TransactionAmt > 100")
def p12(spark, sf):
    return _txn(spark, sf).filter((F.col("isFraud") == 1) & (F.col("TransactionAmt") > 100)) \
        .select("TransactionID", "TransactionAmt")


@register("p13_round", f"""{T} select TransactionID, {r6('round_even(TransactionAmt / 3 * 10000, 0) / 10000')} as amt_4dp,
  {r6('round_even(TransactionAmt * 100 / 7 * 100, 0) / 100')} as amt_2dp from t""")
def p13(spark, sf):
    a = F.col("TransactionAmt")
    return _txn(spark, sf).select("TransactionID", S.np_round(a / 3, 4).alias("amt_4dp"),
                                  S.np_round(a * 100 / 7, 2).alias("amt_2dp"))


_RISK = "round_even(score * 100 * 100, 0) / 100"


@register("p14_decision", f"""select doc_id, model, {r6(_RISK)} as ato_risk_score,
  case when {_RISK} >= 16.0 then 'block' when {_RISK} >= 5.5 then 'step_up_auth' else 'allow' end as action_rf,
  case when {_RISK} >= 95.0 then 'block' when {_RISK} >= 45.0 then 'step_up_auth' else 'allow' end as action_lstm,
  case when {_RISK} >= 16.0 then 'block' when {_RISK} >= 5.5 then 'step_up_auth' else 'allow' end as action_unknown
from {B.SCORE_PAIRS_SQL} s""")
def p14(spark, sf):
    sp = B.score_pairs(spark, sf)
    risk = S.np_round(F.col("score") * 100, 2)
    return sp.select("doc_id", "model", risk.alias("ato_risk_score"), S.decide(risk, "rf").alias("action_rf"),
                     S.decide(risk, "lstm").alias("action_lstm"), S.decide(risk, "other").alias("action_unknown"))


@register("p15_drift_band", f"""{T} select TransactionID, case when TransactionAmt / 1000.0 < 0.10 then 'stable'
  when TransactionAmt / 1000.0 < 0.25 then 'moderate' else 'significant' end as drift from t""")
def p15(spark, sf):
    return _txn(spark, sf).select("TransactionID", S.drift_band(F.col("TransactionAmt") / 1000.0).alias("drift"))


# ---- J: joins ----------------------------------------------------------------------

@register("j1_left_join", """select o.o_orderkey as TransactionID, o.o_custkey as cust_id, round(o.o_totalprice, 6) as o_totalprice,
  o.o_orderstatus, c.c_mktsegment, round(c.c_acctbal, 6) as c_acctbal
from orders o left join (select * from customer where c_acctbal > 0) c on o.o_custkey = c.c_custkey""")
def j1(spark, sf):
    return B.orders_view(spark, sf).join(B.identity_view(spark, sf), "cust_id", "left")


@register("j2_frequency_lookup", f"""{T}, f as (select DeviceInfo, count(*) as n from t where DeviceInfo is not null group by DeviceInfo)
select t.TransactionID, t.DeviceInfo, coalesce(f.n, 0) as DeviceInfo_enc from t left join f on t.DeviceInfo = f.DeviceInfo""")
def j2(spark, sf):
    return FE.frequency_encode(_txn(spark, sf), "DeviceInfo", "DeviceInfo_enc").select(
        "TransactionID", "DeviceInfo", "DeviceInfo_enc")


@register("j3_membership_semi_join", f"""{LAB}, {SPLIT_SQL}
select TransactionID, lab.uid from lab where lab.uid in (select uid from sp where split = 'test')""")
def j3(spark, sf):
    lab = cut_lineage(label_transactions(_txn(spark, sf)).select("TransactionID", "uid", "ato_proxy"), columnar=True)
    test_cards = card_split(lab).filter(F.col("split") == "test").select("uid")
    return lab.join(test_cards, "uid", "left_semi").select("TransactionID", "uid")


@register("j4_attach_scores", f"""select s.doc_id, {r6(_RISK)} as ato_risk_score,
  case when {_RISK} >= 16.0 then 'block' when {_RISK} >= 5.5 then 'step_up_auth' else 'allow' end as recommended_action,
  d.lang, d.source
from {B.SCORE_PAIRS_SQL} s join documents d on s.doc_id = d.doc_id where s.model = 'length'""")
def j4(spark, sf):
    sp = B.score_pairs(spark, sf).filter(F.col("model") == "length")
    risk = D.risk_table(sp, key="doc_id")
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    return D.attach_scores(risk, docs, key="doc_id")


# ---- A: profiles -------------------------------------------------------------------------

@register("a1_value_counts", f"{T} select DeviceInfo, count(*) as count from t where DeviceInfo is not null group by DeviceInfo")
def a1(spark, sf):
    return PR.value_counts(_txn(spark, sf), "DeviceInfo")


@register("a1b_value_counts_with_nulls", f"{T} select DeviceInfo, count(*) as count from t group by DeviceInfo")
def a1b(spark, sf):
    return PR.value_counts(_txn(spark, sf), "DeviceInfo", dropna=False)


@register("a2_group_rate", f"{T} select DeviceType, {r6('avg(isFraud)')} as rate from t where DeviceType is not null group by DeviceType")
def a2(spark, sf):
    return PR.group_rate(_txn(spark, sf), "DeviceType", "isFraud")


@register("a3_group_rate_having_topk", f"""{T} select DeviceInfo, {r6('rate')} as rate, count from (
  select DeviceInfo, avg(isFraud) as rate, count(*) as count from t where DeviceInfo is not null
  group by DeviceInfo having count(*) > 100) g order by rate desc, count desc, DeviceInfo limit 10""")
def a3(spark, sf):
    return PR.group_rate_top(_txn(spark, sf), "DeviceInfo", "isFraud", min_count=100, k=10)


def _a4_sql():
    cols = ["TransactionID", "uid", "TransactionDT", "TransactionAmt", "isFraud", "DeviceInfo", "DeviceType",
            "id_31", "id_01", "id_02", "card4", "card6"]
    dbl = {"TransactionAmt", "id_01", "id_02"}
    parts = [f"select '{c}' as column_name, avg(case when {c} is null{' or isnan(' + c + ')' if c in dbl else ''} then 1.0 else 0.0 end) as s from t"
             for c in cols]
    return f"{T} select column_name as \"column\", {r6('s')} as missing_share from ({' union all '.join(parts)}) u order by s desc, column_name limit 20"


@register("a4_missing_profile", _a4_sql())
def a4(spark, sf):
    return PR.missing_profile(_txn(spark, sf), k=20)


def _a5_sql():
    parts = []
    for c in ("TransactionAmt", "id_02"):
        parts.append(f"""select '{c}' as feature, count({c}) as count, {r6(f'avg({c})')} as mean, {r6(f'stddev_samp({c})')} as std,
  {r6(f'min({c})')} as min, {r6(f'max({c})')} as max, {r6(f'quantile_cont({c}, 0.25)')} as q25,
  {r6(f'quantile_cont({c}, 0.5)')} as q50, {r6(f'quantile_cont({c}, 0.75)')} as q75 from t""")
    return f"{T} {' union all '.join(parts)}"


@register("a5_describe", _a5_sql())
def a5(spark, sf):
    return PR.describe(_txn(spark, sf), ["TransactionAmt", "id_02"])


def _a6_sql():
    parts = [f"""select '{c}' as "column", {r6(f'avg(case when {c} is not null then 1.0 else 0.0 end)')} as fill_rate,
  {r6(f'avg(case when isFraud = 0 then {c} end)')} as mean_0, {r6(f'avg(case when isFraud = 1 then {c} end)')} as mean_1 from t"""
             for c in ("TransactionAmt", "id_01", "id_02")]
    return f"{T} {' union all '.join(parts)}"


@register("a6_conditional_means", _a6_sql())
def a6(spark, sf):
    return PR.conditional_means(_txn(spark, sf), ["TransactionAmt", "id_01", "id_02"], "isFraud")


@register("a7_daily_trend", f"""{T} select cast(floor(TransactionDT / 86400) as bigint) as day, {r6('avg(isFraud)')} as rate,
  count(*) as volume from t group by 1""")
def a7(spark, sf):
    return PR.daily_trend(_txn(spark, sf), "TransactionDT", "isFraud")


@register("a8_card_summary", f"""{T} select uid, count(*) as n_txn, cast(sum(isFraud) as bigint) as n_fraud,
  cast(max(case when DeviceInfo is not null then 1 else 0 end) as bigint) as has_device from t where uid is not null group by uid""")
def a8(spark, sf):
    return PR.card_summary(_txn(spark, sf), "uid", "isFraud", "DeviceInfo")


@register("a9_distinct_span", f"""{T} select count(distinct uid) as n_keys, min(TransactionDT) as t_min,
  max(TransactionDT) as t_max, max(TransactionDT) - min(TransactionDT) as span from t""")
def a9(spark, sf):
    return PR.span_summary(_txn(spark, sf), "uid", "TransactionDT")


@register("a10_signal_lift", f"""{LAB} select signal, cast(value as bigint) as value, {r6('avg(isFraud)')} as fraud_rate, count(*) as count from (
  select 'signal_device' as signal, signal_device as value, isFraud from lab
  union all select 'signal_session', signal_session, isFraud from lab
  union all select 'signal_velocity', signal_velocity, isFraud from lab) u group by signal, value""")
def a10(spark, sf):
    return PR.signal_lift(label_transactions(_txn(spark, sf)))


def _a11_sql():
    dist = ", ".join(f"cast(sum(case when isFraud = 1 and signal_count = {k} then 1 else 0 end) as bigint) as fraud_with_{k}_signals" for k in range(4))
    sens = ", ".join(f"cast(sum(case when isFraud = 1 and signal_count >= {k} then 1 else 0 end) as bigint) as label_if_{k}_required" for k in (1, 2, 3))
    return f"""{LAB} select count(*) as n_rows, cast(sum(case when isFraud = 1 then 1 else 0 end) as bigint) as n_fraud, cast(sum(ato_proxy) as bigint) as n_label,
  {r6('sum(ato_proxy) / sum(case when isFraud = 1 then 1 else 0 end)')} as label_share_of_fraud,
  {r6('avg(ato_proxy)')} as label_rate, {dist}, {sens} from lab"""


@register("a11_label_summary", _a11_sql())
def a11(spark, sf):
    return PR.label_summary(label_transactions(_txn(spark, sf)))


@register("a12_label_sensitivity", f"""{LAB} select cast(k as bigint) as required_signals, cast(sum(case when isFraud = 1 and signal_count >= k then 1 else 0 end) as bigint) as n_label
from lab, (select unnest([1, 2, 3]) as k) ks group by k""")
def a12(spark, sf):
    lab = label_transactions(_txn(spark, sf))
    row = lab.agg(*[F.sum(((F.col("isFraud") == 1) & (F.col("signal_count") >= k)).cast("long")).alias(f"k{k}")
                    for k in (1, 2, 3)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("required_signals"), F.col(f"k{k}").alias("n_label"))
                                         for k in (1, 2, 3)])))


@register("a13_medians", f"""{T} select 'TransactionAmt' as feature, {r6('median(TransactionAmt)')} as median from t
  union all select 'id_02', {r6('median(id_02)')} from t""")
def a13(spark, sf):
    m = FE.medians(_txn(spark, sf), ["TransactionAmt", "id_02"])
    return spark.createDataFrame(list(m.items()), "feature string, median double")


@register("a14_quantile_bounds", f"""{T} select 'TransactionAmt' as feature, {r6('quantile_cont(TransactionAmt, 0.001)')} as lo,
  {r6('quantile_cont(TransactionAmt, 0.999)')} as hi from t
  union all select 'id_02', {r6('quantile_cont(id_02, 0.001)')}, {r6('quantile_cont(id_02, 0.999)')} from t""")
def a14(spark, sf):
    b = FE.winsor_bounds(_txn(spark, sf), ["TransactionAmt", "id_02"])
    return spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in b.items()], "feature string, lo double, hi double")


@register("a15_mean_std", f"""{T} select 'TransactionAmt' as feature, {r6('avg(TransactionAmt)')} as mean, {r6('stddev_pop(TransactionAmt)')} as std from t
  union all select 'id_02', {r6('avg(id_02)')}, {r6('stddev_pop(id_02)')} from t""")
def a15(spark, sf):
    m = FE.moments(_txn(spark, sf), ["TransactionAmt", "id_02"])
    return spark.createDataFrame([(c, a, b) for c, (a, b) in m.items()], "feature string, mean double, std double")


@register("a16_group_max", f"{LAB} select uid, cast(max(ato_proxy) as bigint) as has_pos from lab where uid is not null group by uid")
def a16(spark, sf):
    return PR.group_max(label_transactions(_txn(spark, sf)), "uid", "ato_proxy")


@register("a17_histogram", f"""{T}, r as (select min(TransactionAmt) as lo, max(TransactionAmt) as hi from t),
b as (select cast(least(floor((TransactionAmt - lo) / ((hi - lo) / 50)), 49) as integer) as bin from t, r),
g as (select unnest(range(50)) as bin)
select cast(g.bin as bigint) as bin, coalesce(c.count, 0) as count, {r6('lo + g.bin * ((hi - lo) / 50)')} as "left",
  {r6('lo + (g.bin + 1) * ((hi - lo) / 50)')} as "right"
from g left join (select bin, count(*) as count from b group by bin) c on g.bin = c.bin, r""")
def a17(spark, sf):
    return PR.histogram(_txn(spark, sf), "TransactionAmt", bins=50)


@register("a17b_score_densities", f"""with s as (select is_ref, l_extendedprice as x from (
  select true as is_ref, l_extendedprice from {B.DRIFT_REF_SQL} r union all select false, l_extendedprice from {B.DRIFT_CUR_SQL} c) u),
r as (select min(x) as lo, (max(x) - min(x)) / 39 as w from s),
k as (select is_ref, cast(least(floor((x - lo) / w), 38) as integer) as bin, count(*) as count from s, r group by 1, 2),
g as (select is_ref, bin from (select unnest(range(39)) as bin) b, (select unnest([true, false]) as is_ref) i)
select g.is_ref, cast(g.bin as bigint) as bin, coalesce(k.count, 0) as count, {r6('lo + g.bin * w')} as "left",
  {r6('coalesce(k.count, 0) / (sum(coalesce(k.count, 0)) over (partition by g.is_ref) * w) * 1000')} as density_per_1000
from g left join k on g.is_ref = k.is_ref and g.bin = k.bin, r""")
def a17b(spark, sf):
    """Densities of both drift sides over their shared range, in 39 bins."""
    rows = B.drift_rows(spark, sf).select("is_ref", "l_extendedprice")
    r = rows.agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")).first()
    sides = [PR.histogram(rows.filter(F.col("is_ref") == side), "l_extendedprice", bins=39, lo=r["lo"], hi=r["hi"], density=True)
             .select(F.lit(side).alias("is_ref"), "bin", "count", "left", (F.col("density") * 1000).alias("density_per_1000")) for side in (True, False)]
    return sides[0].unionByName(sides[1])


# ---- T: sort / top-k / union / distinct -------------------------------------------------

@register("t1_sort_by_card_time", f"{T} select TransactionID, uid, TransactionDT from t order by uid, TransactionDT, TransactionID")
def t1(spark, sf):
    return _txn(spark, sf).select("TransactionID", "uid", "TransactionDT").orderBy("uid", "TransactionDT", "TransactionID")


@register("t2_top_k", f"{T} select TransactionID, {r6('TransactionAmt')} as TransactionAmt from t order by TransactionAmt desc, TransactionID limit 10")
def t2(spark, sf):
    return PR.top_k(_txn(spark, sf).select("TransactionID", "TransactionAmt"), "TransactionAmt", 10, tie="TransactionID")


@register("t3_union", f"""select 'reference' as side, {r6('l_extendedprice')} as l_extendedprice from {B.DRIFT_REF_SQL} r
  union all select 'current', {r6('l_extendedprice')} from {B.DRIFT_CUR_SQL} c""")
def t3(spark, sf):
    rows = B.drift_rows(spark, sf)
    return (rows.filter("is_ref").select(F.lit("reference").alias("side"), "l_extendedprice")
            .unionByName(rows.filter("not is_ref").select(F.lit("current").alias("side"), "l_extendedprice")))


@register("t4_distinct", f"{T} select distinct DeviceInfo from t")
def t4(spark, sf):
    return _txn(spark, sf).select("DeviceInfo").distinct()
