"""Registered queries: per-card windows (W), fitted features (F) and
splitting / resampling (R)."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark import config
from riskspark.functions import scalar as S
from riskspark.operators import features as FE
from riskspark.operators import neighbours as NB
from riskspark.operators import split as SP
from riskspark.operators.cardpass import card_pass
from riskspark.operators.label import label_transactions
from riskspark.plans.registry import register
from riskspark.plans.sqlparts import LAB, SPLIT_SQL, T, r6
from riskspark.session import cut_lineage
from riskspark.sources import bindings as B
from riskspark.sources.io import read_table

_W = "partition by uid order by TransactionDT, TransactionID"


def _txn(spark, sf):
    return B.txn_view(spark, sf)


def _lab(spark, sf):
    return label_transactions(_txn(spark, sf))


# ---- W1-W6: parts of the label operator ----------------------------------------------

@register("w1_previous_value", f"{T} select TransactionID, lag(DeviceInfo) over ({_W}) as prev_device, "
          f"lag(TransactionDT) over ({_W}) as prev_dt from t")
def w1(spark, sf):
    return card_pass(_txn(spark, sf), lags={"prev_device": "DeviceInfo", "prev_dt": "TransactionDT"}) \
        .select("TransactionID", "prev_device", "prev_dt")


def _lab_proj(name, cols):
    sql = f"{LAB} select TransactionID, {', '.join(f'cast({c} as bigint) as {c}' for c in cols)} from lab"

    @register(name, sql)
    def q(spark, sf):
        return _lab(spark, sf).select("TransactionID", *cols)
    return q


_lab_proj("w2_device_change", ["device_changed"])
_lab_proj("w3_device_signal", ["is_proxy", "signal_device"])
_lab_proj("w4_session_anomaly", ["signal_session"])
_lab_proj("w5_velocity", ["time_since_prev", "signal_velocity"])
_lab_proj("w6_signal_count_and_label", ["signal_count", "ato_proxy"])


# ---- causal variants: statistics of earlier rows only --------------------

_PREV = f"({_W} rows between unbounded preceding and 1 preceding)"


def _causal_label_sql():
    stats = ", ".join(
        f"count({c}) over {_PREV} as _cnt_{c}, avg({c}) over {_PREV} as _mu_{c}, "
        f"stddev_samp({c}) over {_PREV} as _sd_{c}, (max({c}) over {_PREV} > min({c}) over {_PREV}) as _sp_{c}"
        for c in ("id_01", "id_02"))
    anomalies = " or ".join(
        f"coalesce(abs(({c} - _mu_{c}) / _sd_{c}) > 2.0 and _cnt_{c} >= 3 and _sd_{c} > 0 and _sp_{c}, false)"
        for c in ("id_01", "id_02"))
    return f"{T}, w as (select *, {stats} from t) select TransactionID, cast(({anomalies}) as bigint) as signal_session from w"


@register("w4c_session_anomaly_causal", _causal_label_sql())
def w4c(spark, sf):
    return label_transactions(_txn(spark, sf), causal=True).select("TransactionID", "signal_session")


@register("w9c_amount_deviation_causal", f"""{T}, w as (select *, avg(TransactionAmt) over {_PREV} as mu,
  stddev_samp(TransactionAmt) over {_PREV} as sd from t)
select TransactionID, {r6('case when sd = 0 then null else (TransactionAmt - mu) / coalesce(sd, 1.0) end')} as amt_deviation from w""")
def w9c(spark, sf):
    return FE.behaviour_features(_txn(spark, sf), causal=True).select("TransactionID", "amt_deviation")


# ---- W8-W11: behaviour features -------------------------------------------------------

BEH_SQL = f"""b as (select *, row_number() over ({_W}) as txn_count_rolling,
  case when stddev_samp(TransactionAmt) over (partition by uid) = 0 then null
       else (TransactionAmt - avg(TransactionAmt) over (partition by uid))
            / coalesce(stddev_samp(TransactionAmt) over (partition by uid), 1.0) end as amt_deviation,
  TransactionDT - min(TransactionDT) over (partition by uid) as account_age_dt,
  ((TransactionDT % 86400 + 86400) % 86400) / 3600.0 as hour_of_day
from t)"""


def _beh_query(name, cols):
    sel = ", ".join(r6(c) + f" as {c}" if c in ("amt_deviation", "hour_of_day") else c for c in cols)

    @register(name, f"{T}, {BEH_SQL} select TransactionID, {sel} from b")
    def q(spark, sf):
        return FE.behaviour_features(_txn(spark, sf)).select("TransactionID", *cols)
    return q


_beh_query("w8_running_count", ["txn_count_rolling"])
_beh_query("w9_amount_deviation", ["amt_deviation"])
_beh_query("w10_account_age", ["account_age_dt"])
_beh_query("w11_behaviour_features", ["txn_count_rolling", "amt_deviation", "account_age_dt", "hour_of_day"])


# ---- W12 / F8: history windows, checked through position-weighted sums ------------------

_H = config.WINDOW_SIZE


@register("w12_history_sequence", f"""{T}, h as (select TransactionID, uid,
  list(TransactionAmt) over ({_W} rows between {_H} preceding and 1 preceding) as la,
  list(((TransactionDT % 86400 + 86400) % 86400) / 3600.0) over ({_W} rows between {_H} preceding and 1 preceding) as lh
from t)
select TransactionID, uid, cast(len(la) as bigint) as hist_len,
  {r6('list_sum(la)')} as s_amt, {r6(f'list_sum(list_transform(la, lambda x, i: x * ({_H} - len(la) + i)))')} as w_amt,
  {r6('list_sum(lh)')} as s_hour, {r6(f'list_sum(list_transform(lh, lambda x, i: x * ({_H} - len(lh) + i)))')} as w_hour
from h where la is not null and len(la) > 0""")
def w12(spark, sf):
    df = _txn(spark, sf).withColumn("hour_of_day", S.hour_of_day("TransactionDT"))
    sq = FE.sequence_history(df, ["TransactionAmt", "hour_of_day"], history_len=_H)

    def wsum(k):
        return F.aggregate(F.transform("seq", lambda x, i: x[k] * (i + 1)), F.lit(0.0), lambda a, b: a + b)

    def ssum(k):
        return F.aggregate(F.transform("seq", lambda x: x[k]), F.lit(0.0), lambda a, b: a + b)
    return sq.select("TransactionID", "uid", "hist_len", ssum(0).alias("s_amt"), wsum(0).alias("w_amt"),
                     ssum(1).alias("s_hour"), wsum(1).alias("w_hour"))


@register("f8_flatten_sequence", f"""{T}, h as (select TransactionID,
  flatten(list([TransactionAmt, ((TransactionDT % 86400 + 86400) % 86400) / 3600.0])
          over ({_W} rows between {_H} preceding and 1 preceding)) as fl
from t)
select TransactionID, cast({_H} * 2 as bigint) as n_values,
  {r6(f'list_sum(list_transform(fl, lambda x, i: x * ({_H} * 2 - len(fl) + i)))')} as w_flat
from h where fl is not null and len(fl) > 0""")
def f8(spark, sf):
    df = _txn(spark, sf).withColumn("hour_of_day", S.hour_of_day("TransactionDT"))
    sq = FE.flatten_sequence(FE.sequence_history(df, ["TransactionAmt", "hour_of_day"], history_len=_H))
    arr = vector_to_array("features")
    w = F.aggregate(F.transform(arr, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return sq.select("TransactionID", F.size(arr).cast("long").alias("n_values"), w.alias("w_flat"))


# ---- F1-F6 ---------------------------------------------------------------------------------

ENC_SQL = """fq as (select DeviceInfo, count(*) as n from t where DeviceInfo is not null group by DeviceInfo),
c4 as (select card4, row_number() over (order by card4) - 1 as code from (select distinct card4 from t where card4 is not null)),
c6 as (select card6, row_number() over (order by card6) - 1 as code from (select distinct card6 from t where card6 is not null)),
e as (select t.*, case when DeviceType = 'mobile' then 1 when DeviceType = 'desktop' then 2 else 0 end as DeviceType_enc,
  coalesce(fq.n, 0) as DeviceInfo_enc, coalesce(c4.code, -1) as card4_enc, coalesce(c6.code, -1) as card6_enc
  from t left join fq on t.DeviceInfo = fq.DeviceInfo left join c4 on t.card4 = c4.card4 left join c6 on t.card6 = c6.card6)"""


@register("f1_frequency_encode", f"{T}, {ENC_SQL} select TransactionID, DeviceInfo_enc from e")
def f1(spark, sf):
    return FE.frequency_encode(_txn(spark, sf), "DeviceInfo", "DeviceInfo_enc").select("TransactionID", "DeviceInfo_enc")


@register("f2_ordinal_encode", f"{T}, {ENC_SQL} select TransactionID, card4_enc, card6_enc from e")
def f2(spark, sf):
    df = FE.ordinal_encode(FE.ordinal_encode(_txn(spark, sf), "card4", "card4_enc"), "card6", "card6_enc")
    return df.select("TransactionID", "card4_enc", "card6_enc")


@register("f3_categorical_encode", f"{T}, {ENC_SQL} select TransactionID, cast(DeviceType_enc as bigint) as DeviceType_enc, "
          "DeviceInfo_enc, card4_enc, card6_enc from e")
def f3(spark, sf):
    return FE.encode_categoricals(_txn(spark, sf)).select(
        "TransactionID", "DeviceType_enc", "DeviceInfo_enc", "card4_enc", "card6_enc")


@register("f4_winsorise", f"""{T}, q as (select quantile_cont(TransactionAmt, 0.001) as a_lo, quantile_cont(TransactionAmt, 0.999) as a_hi,
  quantile_cont(id_02, 0.001) as i_lo, quantile_cont(id_02, 0.999) as i_hi from t)
select TransactionID, {r6('case when TransactionAmt is null then null else greatest(a_lo, least(a_hi, TransactionAmt)) end')} as TransactionAmt,
  {r6('case when id_02 is null then null else greatest(i_lo, least(i_hi, id_02)) end')} as id_02 from t, q""")
def f4(spark, sf):
    df = _txn(spark, sf)
    cols = ["TransactionAmt", "id_02"]
    return FE.winsorise(df, FE.winsor_bounds(df, cols)).select("TransactionID", *cols)


_TRAIN_ROWS = "tr as (select lab.* from lab join sp on lab.uid = sp.uid where sp.split = 'train')"


@register("f5_median_impute", f"""{LAB}, {SPLIT_SQL}, {_TRAIN_ROWS}, m as (select median(id_02) as med from tr)
select TransactionID, {r6('coalesce(id_02, med)')} as id_02 from lab, m""")
def f5(spark, sf):
    lab = cut_lineage(_lab(spark, sf).select("TransactionID", "uid", "ato_proxy", "id_02"), columnar=True)
    train_cards = SP.card_split(lab).filter(F.col("split") == "train").select("uid")
    meds = FE.medians(lab.join(train_cards, "uid", "left_semi"), ["id_02"])
    return FE.impute(lab, meds).select("TransactionID", "id_02")


@register("f6_standardise", f"""{LAB}, {SPLIT_SQL}, {_TRAIN_ROWS},
m as (select avg(TransactionAmt) as mu, case when stddev_pop(TransactionAmt) = 0 then 1.0 else stddev_pop(TransactionAmt) end as sd from tr)
select TransactionID, {r6('(TransactionAmt - mu) / sd')} as TransactionAmt from lab, m""")
def f6(spark, sf):
    lab = cut_lineage(_lab(spark, sf).select("TransactionID", "uid", "ato_proxy", "TransactionAmt"), columnar=True)
    train_cards = SP.card_split(lab).filter(F.col("split") == "train").select("uid")
    mom = FE.moments(lab.join(train_cards, "uid", "left_semi"), ["TransactionAmt"])
    return FE.standardise(lab, mom).select("TransactionID", "TransactionAmt")


# ---- F7: the whole feature build --------------------------------------------------------

_FEATS = ["TransactionAmt", "amt_deviation", "account_age_dt", "hour_of_day", "txn_count_rolling",
          "DeviceType_enc", "DeviceInfo_enc", "card4_enc", "card6_enc", "id_01", "id_02"]


def _f7_sql(train_only: bool = False):
    """``train_only``: code tables and clip bounds from train cards, too."""
    beh = BEH_SQL.replace("from t)", "from e)")
    fit = "tr" if train_only else "lab"
    enc = ENC_SQL.replace("from t left join", "from lab t left join").replace("from t where", f"from {fit} where")
    bounds_of = "(select b.* from b join sp on b.uid = sp.uid where sp.split = 'train') b" if train_only else "b"
    n = len(_FEATS)
    extra = f""",
  round(cast(fl[len(fl) - {n} + 1] as double), 4) + 0.0::double as last_amount, round(cast(fl[len(fl) - {n} + 7] as double), 4) + 0.0::double as last_device""" if train_only else ""
    qs = ", ".join(f"quantile_cont({c}, 0.001) as lo_{c}, quantile_cont({c}, 0.999) as hi_{c}" for c in _FEATS)
    clipped = ", ".join(f"case when {c} is null then null else greatest(lo_{c}, least(hi_{c}, {c})) end as {c}"
                        for c in _FEATS)
    meds = ", ".join(f"median({c}) as med_{c}" for c in _FEATS)
    filled = ", ".join(f"coalesce({c}, med_{c}) as {c}" for c in _FEATS)
    mom = ", ".join(f"avg({c}) as mu_{c}, case when stddev_pop({c}) = 0 then 1.0 else stddev_pop({c}) end as sd_{c}"
                    for c in _FEATS)
    scaled = ", ".join(f"cast(({c} - mu_{c}) / sd_{c} as float) as {c}" for c in _FEATS)
    vec = ", ".join(_FEATS)
    return f"""{LAB}, {SPLIT_SQL}, {_TRAIN_ROWS}, {enc},
{beh},
q as (select {qs} from {bounds_of}),
c as (select b.uid, b.TransactionID, b.TransactionDT, b.ato_proxy, sp.split, {clipped} from b join sp on b.uid = sp.uid, q),
md as (select {meds} from c where split = 'train'),
f as (select uid, TransactionID, TransactionDT, ato_proxy, split, {filled} from c, md),
mo as (select {mom} from f where split = 'train'),
z as (select uid, TransactionID, TransactionDT, ato_proxy, split, {scaled} from f, mo),
h as (select uid, TransactionID, ato_proxy, split,
  flatten(list([{vec}]) over ({_W} rows between {_H} preceding and 1 preceding)) as fl from z)
select uid, TransactionID, cast(ato_proxy as bigint) as label, split, cast(len(fl) / {len(_FEATS)} as bigint) as hist_len,
  round(list_sum(list_transform(fl, lambda x: cast(x as double))), 3) + 0.0::double as s_seq,
  round(list_sum(list_transform(fl, lambda x, i: cast(x as double) * ({_H * len(_FEATS)} - len(fl) + i))), 2) + 0.0::double as w_seq{extra}
from h where fl is not null and len(fl) > 0"""


@register("f7_build_sequences", _f7_sql())
def f7(spark, sf):
    seqs, _state, _feats = FE.build_sequences(_lab(spark, sf))
    flat = F.transform(F.flatten("seq"), lambda x: x.cast("double"))
    s = F.aggregate(flat, F.lit(0.0), lambda a, b: a + b)
    w = F.aggregate(F.transform(flat, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return seqs.select("uid", "TransactionID", "label", "split", F.col("hist_len").cast("long").alias("hist_len"),
                       F.round(s, 3).alias("s_seq"), F.round(w, 2).alias("w_seq"))


@register("f7c_build_sequences_train_only", _f7_sql(train_only=True))
def f7c(spark, sf):
    """F7 with every fitted table and constant from train cards; two values of the last step, too."""
    seqs, _state, feats = FE.build_sequences(_lab(spark, sf), fit_on="train")
    flat = F.transform(F.flatten("seq"), lambda x: x.cast("double"))
    s = F.aggregate(flat, F.lit(0.0), lambda a, b: a + b)
    w = F.aggregate(F.transform(flat, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    last = F.element_at("seq", -1)
    return seqs.select("uid", "TransactionID", "label", "split", F.col("hist_len").cast("long").alias("hist_len"), F.round(s, 3).alias("s_seq"), F.round(w, 2).alias("w_seq"),
                       F.round(last[feats.index("TransactionAmt")].cast("double"), 4).alias("last_amount"),
                       F.round(last[feats.index("DeviceInfo_enc")].cast("double"), 4).alias("last_device"))


@register("f9_min_max_scale", f"""with s as (select * from {B.SCORE_PAIRS_SQL} x where model = 'length'),
r as (select min(score) as lo, max(score) as hi from s)
select doc_id, {r6('(score - lo) / (hi - lo + 1e-9)')} as score_scaled from s, r""")
def f9(spark, sf):
    sp = B.score_pairs(spark, sf).filter(F.col("model") == "length")
    return FE.min_max_scale(sp, "score", "score_scaled").select("doc_id", "score_scaled")


# ---- R: splits and resampling ----------------------------------------------------------

@register("r1_card_split", f"{LAB}, {SPLIT_SQL} select uid, cast(has_pos as bigint) as has_pos, split from sp")
def r1(spark, sf):
    return SP.card_split(_lab(spark, sf))


@register("r2_row_split", """select doc_id, cast(toxic as bigint) as toxic, case when row_number() over
  (partition by toxic order by md5('42:' || doc_id), doc_id) <= round(0.5 * count(*) over (partition by toxic))
  then 'test' else 'train' end as split from labels""")
def r2(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id", "toxic")
    return SP.row_split(lab, "doc_id", "toxic", 0.5)


@register("r3_time_split", f"""{T}, q as (select quantile_cont(TransactionDT, 0.8) as cut from t)
select TransactionID, case when TransactionDT <= cut then 'train' else 'test' end as split from t, q""")
def r3(spark, sf):
    return SP.time_split(_txn(spark, sf)).select("TransactionID", "split")


@register("r4_undersample", f"""{LAB}, p as (select count(*) as np from lab where ato_proxy = 1),
n as (select TransactionID, ato_proxy, row_number() over (order by md5('42:' || TransactionID), TransactionID) as rk
      from lab where ato_proxy <> 1)
select TransactionID, cast(ato_proxy as bigint) as ato_proxy from lab where ato_proxy = 1
union all select TransactionID, cast(ato_proxy as bigint) from n, p where rk <= 20 * np""")
def r4(spark, sf):
    lab = cut_lineage(_lab(spark, sf).select("TransactionID", "ato_proxy"), columnar=True)
    return SP.undersample(lab, "TransactionID", "ato_proxy", ratio=config.UNDERSAMPLE_RATIO)


@register("r5_bootstrap", """with l as (select doc_id, row_number() over (order by doc_id) - 1 as idx, count(*) over () as n from labels),
d as (select unnest(range((select count(*) from labels))) as draw)
select d.draw, l.doc_id from d join l on ('0x' || substr(md5('42:' || d.draw), 1, 15))::BIGINT % l.n = l.idx""")
def r5(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id")
    return SP.bootstrap(lab, "doc_id")


@register("r6_random_subset", "select doc_id from documents order by md5('42:' || doc_id), doc_id limit 100")
def r6q(spark, sf):
    return SP.random_subset(read_table(spark, sf, "documents").select("doc_id"), "doc_id", 100)


_RARE = 5  # the class of embeddings that R7 fills up to a fifth of the others


@register("r7_smote", f"""with e as (select vec_id as id, list_transform(embedding, lambda x: cast(x as double)) as x, label from embeddings
  where vec_id is not null and embedding is not null),
p as (select id, x, row_number() over (order by md5('42:' || id), id) as rk from e where label = {_RARE}),
c as (select count(*) filter (label = {_RARE}) as pos, cast(floor(0.2 * count(*) filter (label <> {_RARE}) + 0.5) as bigint) - count(*) filter (label = {_RARE}) as n_new from e),
g as (select a.id, b.id as neighbour, row_number() over (partition by a.id order by list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) ** 2)), b.id) as rk
  from p a join p b on a.id <> b.id),
n as (select id, least(max(rk), 5) as k from g group by id),
d as (select id, x, unnest(range(n_new // pos + cast(rk <= n_new % pos as bigint))) as copy from p, c),
u as (select d.*, n.k, ('0x' || substr(md5('42:' || d.id || ':' || copy), 1, 15))::BIGINT % n.k + 1 as pick,
  ('0x' || substr(md5('42:' || d.id || ':' || copy), 17, 15))::BIGINT / (1::BIGINT << 60)::DOUBLE as u from d join n on d.id = n.id)
select u.id, u.copy, g.neighbour, {r6('u.u')} as u, {r6('list_sum(list_transform(range(1, len(u.x) + 1), lambda i: u.x[i] + u.u * (o.x[i] - u.x[i])))')} as s_x,
  {r6('list_sum(list_transform(range(1, len(u.x) + 1), lambda i: i * (u.x[i] + u.u * (o.x[i] - u.x[i]))))')} as w_x
from u join g on g.id = u.id and g.rk = u.pick join p o on o.id = g.neighbour""")
def r7(spark, sf):
    e = read_table(spark, sf, "embeddings").filter("vec_id is not null and embedding is not null")
    n = e.agg(F.count_if(F.col("label") == _RARE).alias("pos"), F.count_if(F.col("label") != _RARE).alias("others")).first()
    rare = e.filter(F.col("label") == _RARE).select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    new = NB.smote(rare, math.floor(0.2 * n["others"] + 0.5) - n["pos"])
    total = F.aggregate("x", F.lit(0.0), lambda a, b: a + b)
    weighted = F.aggregate(F.transform("x", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return new.select("id", "copy", "neighbour", "u", total.alias("s_x"), weighted.alias("w_x"))


@register("r8_class_weights", f"""{LAB}, c as (select count(*) as n, sum(ato_proxy) as n_pos from lab)
select n, cast(n_pos as bigint) as n_pos, cast(n - n_pos as bigint) as n_neg, 1.0::double as weight_neg, {r6('least((n - greatest(n_pos, 1)) / greatest(n_pos, 1), 25.0)')} as weight_pos,
  {r6('n / (2.0 * (n - n_pos))')} as balanced_neg, {r6('n / (2.0 * n_pos)')} as balanced_pos from c""")
def r8(spark, sf):
    return SP.class_weights(_lab(spark, sf), "ato_proxy")
