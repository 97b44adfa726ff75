"""Feature operators.

The sequence builder needs a single ordered pass per card: it collects the
*raw* inputs of the previous rows, and every fitted transform (clip bounds,
medians, mean/std) is a per-feature constant, so it is applied to the
collected history element-wise afterwards instead of re-windowing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.functions.scalar import (clip, device_type_code, finite_or_null, hour_of_day,
                                        lenient_double)
from riskspark.operators.cardpass import card_pass
from riskspark.operators.ranks import exact_rank
from riskspark.operators.selection import AT_MOST, select_quantiles
from riskspark.operators.split import card_strata, test_side
from riskspark.session import cut_lineage


# --- lookups -----------------------------------------------------------------

def lookup_join(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join a one-row-per-key table.  No hint: AQE broadcasts the table when
    its measured bytes are within ``spark.sql.autoBroadcastJoinThreshold`` and
    otherwise splits skewed keys of a shuffle join.  Null keys match nothing and
    are spread over the shuffle instead of meeting in one partition."""
    salt = F.when(F.col(key).isNull(), F.monotonically_increasing_id() % 4096).otherwise(0)
    side = table.withColumnRenamed(key, "_key").withColumn("_side", F.lit(0).cast("long"))
    left = df.withColumn("_salt", salt.cast("long"))
    return left.join(side, (left[key] == side["_key"]) & (left["_salt"] == side["_side"]), "left").drop("_salt", "_side", "_key")


def frequency_counts(df: DataFrame, col: str, out: str) -> DataFrame:
    """F1 state: value -> number of rows holding it.  A grouped count, never a window
    on the value."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def encode(df: DataFrame, table: DataFrame, col: str, out: str, missing: int) -> DataFrame:
    """A fitted code table ``(col, out)`` looked up; null and unseen values get ``missing``."""
    return lookup_join(df, table, col).withColumn(out, F.coalesce(F.col(out), F.lit(missing)).cast("long"))


def frequency_encode(df: DataFrame, col: str, out: str, fit_df: DataFrame | None = None) -> DataFrame:
    """value -> number of rows holding it (null / unseen -> 0), counted
    on ``fit_df`` (default ``df``)."""
    return encode(df, frequency_counts(df if fit_df is None else fit_df, col, out), col, out, 0)


def ordinal_codes(df: DataFrame, col: str, out: str, scale: ScaleConfig = DEFAULT_SCALE, at_most: int = AT_MOST) -> DataFrame:
    """F2 state: sorted distinct non-null values -> 0..k-1, in the order of the
    column's own type (numbers by value, strings by bytes).  Up to ``at_most`` values are
    numbered on the driver, more of them by a distributed rank."""
    vals = df.filter(F.col(col).isNotNull()).select(col).distinct()
    some = vals.orderBy(col).limit(at_most + 1).collect()
    if len(some) > at_most:
        return exact_rank(vals, [], [col], scale=scale).select(col, (F.col("rank") - 1).alias(out))
    schema = StructType([df.schema[col], StructField(out, LongType())])
    return df.sparkSession.createDataFrame([(r[0], i) for i, r in enumerate(some)], schema)


def ordinal_encode(df: DataFrame, col: str, out: str, scale: ScaleConfig = DEFAULT_SCALE,
                   fit_df: DataFrame | None = None) -> DataFrame:
    """category code in sorted order over the values of ``fit_df`` (default
    ``df``); null or unseen -> -1."""
    return encode(df, ordinal_codes(df if fit_df is None else fit_df, col, out, scale), col, out, -1)


#: Code of null and unseen values by kind of encoder.
MISSING = {"frequency": 0, "ordinal": -1}


def fit_encoders(df: DataFrame, *, device_info: str = "DeviceInfo", cards=("card4", "card6"),
                 scale: ScaleConfig = DEFAULT_SCALE) -> dict[str, tuple[str, DataFrame]]:
    """F1 / F2 state: ``{column: (kind, code table)}`` of the columns that ``df`` has."""
    out = {}
    if device_info in df.columns:
        out[device_info] = "frequency", frequency_counts(df, device_info, f"{device_info}_enc")
    for c in cards:
        if c in df.columns:
            out[c] = "ordinal", ordinal_codes(df, c, f"{c}_enc", scale)
    return out


def apply_encoders(df: DataFrame, encoders: dict[str, tuple[str, DataFrame]], device_type: str = "DeviceType") -> DataFrame:
    """F3 on new rows: P3 and the fitted code tables; columns that ``df`` lacks are all missing."""
    out = df
    if device_type in df.columns:
        out = out.withColumn(f"{device_type}_enc", device_type_code(device_type).cast("long"))
    for c, (kind, table) in encoders.items():
        if c in df.columns:
            out = encode(out, table, c, f"{c}_enc", MISSING[kind])
        else:
            out = out.withColumn(f"{c}_enc", F.lit(MISSING[kind]).cast("long"))
    return out


def encode_categoricals(df: DataFrame, *, device_type: str = "DeviceType", device_info: str = "DeviceInfo",
                        cards=("card4", "card6"), scale: ScaleConfig = DEFAULT_SCALE,
                        fit_df: DataFrame | None = None) -> DataFrame:
    """F3 = P3 + F1 + F2, fitted on ``fit_df`` (default: ``df`` itself)."""
    fitted = fit_encoders(df if fit_df is None else fit_df, device_info=device_info, cards=cards, scale=scale)
    return apply_encoders(df, fitted, device_type)


# --- behaviour -----------------------------------------------------------------

def amount_deviation(x, mu, sd) -> Column:
    """(x - card mean) / card sample std; std of one row -> 1, std 0 -> null."""
    return F.try_divide(x - mu, F.coalesce(sd, F.lit(1.0)))


def behaviour_features(df: DataFrame, *, uid: str = "uid", ts: str = "TransactionDT",
                       tie: str = "TransactionID", amount: str = "TransactionAmt", causal: bool = False,
                       scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """W11 = W8 running number + W9 amount deviation + W10 account age + P5 hour.

    ``causal=True``: the amount deviation uses only the card's earlier rows
    (mean / sample std of the history; none yet -> null, one row -> std 1).
    """
    amt = lenient_double(amount)
    whole = {} if causal else {"_amt_mu": F.avg("_amt"), "_amt_sd": F.stddev_samp("_amt")}
    out = card_pass(df.withColumn("_amt", amt), key=uid, order=(ts, tie), row_number="txn_count_rolling",
                    card_aggs={"_dt_min": F.min(ts)} | whole, running=["_amt"] if causal else None, scale=scale)
    if causal:
        out = out.withColumns({"_amt_mu": F.col("_rm__amt"), "_amt_sd": F.col("_rsd__amt")})
    return (out.withColumn("amt_deviation", amount_deviation(F.col("_amt"), F.col("_amt_mu"), F.col("_amt_sd")))
            .withColumn("account_age_dt", F.col(ts) - F.col("_dt_min"))
            .withColumn("hour_of_day", hour_of_day(ts))
            .select(*df.columns, "txn_count_rolling", "amt_deviation", "account_age_dt", "hour_of_day"))


# --- column choice ---------------------------------------------------------------

def select_columns(df: DataFrame, *, pattern: str | None = None, numeric_only: bool = False,
                   keep: list[str] | None = None) -> DataFrame:
    """Project ``keep`` plus the columns whose name matches a glob
    ``pattern`` (e.g. ``id_*``) and, optionally, have a numeric type --
    decided from the schema, so the scan reads only those columns."""
    import fnmatch
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    keep = list(keep or [])
    chosen = [c for c, t in df.dtypes
              if c not in keep and (pattern is None or fnmatch.fnmatchcase(c, pattern))
              and (not numeric_only or t in numeric or t.startswith("decimal"))]
    return df.select(*keep, *chosen)


def feature_candidates(columns: list[str]) -> list[str]:
    banned = set(config.LABEL_ONLY_COLUMNS) | set(config.ID_AND_TARGET_COLUMNS)
    wanted = config.BASE_FEATURES + [c for c in columns if c.startswith("id_")]
    return [c for c in dict.fromkeys(wanted) if c not in banned and c in columns]


def choose_features(df: DataFrame) -> list[str]:
    """P10: ordered candidates (9 fixed + every ``id_*``), banned columns out,
    and a column stays only if some value parses as a number (one agg)."""
    cands = feature_candidates(df.columns)
    if not cands:
        return []
    counts = df.agg(*[F.count(lenient_double(c)).alias(c) for c in cands]).first()
    return [c for c in cands if counts[c] > 0]


def unpivot_features(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """Wide -> long (feature, value) with lenient numeric values."""
    keep = keep or []
    items = F.array(*[F.struct(F.lit(c).alias("feature"), lenient_double(c).alias("value")) for c in cols])
    return df.select(*keep, F.inline(items))


# --- fitted column transforms --------------------------------------------------------

def quantile_table(df: DataFrame, cols: list[str], probs) -> dict:
    """Exact per-column quantiles ``{col: {p: q}}`` (bounded: cols x probs)."""
    found = select_quantiles(df, {c: lenient_double(c) for c in cols}, list(probs))
    return {c: {p: q.q for p, q in own.items()} for c, own in found.items()}


def winsor_bounds(df: DataFrame, cols: list[str], probs=config.CLIP_QUANTILES) -> dict:
    """``{col: (lo, hi)}`` at the .001 / .999 quantiles."""
    q = quantile_table(df, cols, probs)
    return {c: (q[c].get(probs[0]), q[c].get(probs[1])) for c in cols}


def winsorise(df: DataFrame, bounds: dict) -> DataFrame:
    """F4 = P1 + P7 + clip at fitted bounds."""
    return df.withColumns({c: clip(lenient_double(c), lo, hi) for c, (lo, hi) in bounds.items()})


def medians(df: DataFrame, cols: list[str]) -> dict:
    """Exact median per column, nulls skipped."""
    q = quantile_table(df, cols, [0.5])
    return {c: q[c].get(0.5) for c in cols}


def impute(df: DataFrame, meds: dict) -> DataFrame:
    """null -> fitted median."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in meds.items()})


def moments(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std (ddof 0); zero spread -> scale 1."""
    if not cols:
        return {}
    r = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        s = r[f"s_{c}"]
        out[c] = (r[f"m_{c}"], 1.0 if (s is None or s == 0) else s)
    return out


def standardise(df: DataFrame, mom: dict) -> DataFrame:
    """(x - mean) / scale with fitted constants."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in mom.items()})


def apply_state(df: DataFrame, state: DataFrame) -> DataFrame:
    """S7 re-applied: clip, impute and scale the columns of new rows by a fitted
    ``(feature, stat, value)`` table (five rows per feature come to the driver).
    A missing bound is no bound; features that ``df`` lacks are skipped."""
    fitted: dict = {}
    for r in state.collect():
        fitted.setdefault(r["feature"], {})[r["stat"]] = r["value"]

    def const(c: str, stat: str) -> Column:
        return F.lit(fitted[c].get(stat)).cast("double")

    return df.withColumns({
        c: (F.coalesce(clip(lenient_double(c), const(c, "clip_lo"), const(c, "clip_hi")), const(c, "median")) - const(c, "mean"))
        / const(c, "scale") for c in fitted if c in df.columns})


def min_max_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(s - min) / (max - min + 1e-9) over the batch."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return df.withColumn(out or col, (F.col(col) - F.lit(r["lo"])) / (F.lit(r["hi"]) - F.lit(r["lo"]) + 1e-9))


def flatten_sequence(df: DataFrame, seq: str = "seq", out: str = "features") -> DataFrame:
    """F8: (steps, F) -> steps*F, timestep-major, as an ML vector."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.flatten(seq).cast("array<double>")))


# --- sequences (W12, F7) --------------------------------------------------------------------

_RAW_FIXED = ["_r_amt", "_r_dt", "_r_dtype", "_r_dinfo", "_r_c4", "_r_c6"]


def _feature_from_raw(name: str, get, ctx: dict) -> Column:
    """Value of feature ``name`` from raw inputs ``get(i)`` (i = raw slot)."""
    idx = {"TransactionAmt": 0, "DeviceType_enc": 2, "DeviceInfo_enc": 3, "card4_enc": 4, "card6_enc": 5}
    if name in idx:
        return get(idx[name])
    if name == "amt_deviation":
        return amount_deviation(get(0), F.col("_amt_mu"), F.col("_amt_sd"))
    if name == "account_age_dt":
        return get(1) - F.col("_dt_min")
    if name == "hour_of_day":
        return hour_of_day(get(1))
    if name == "txn_count_rolling":
        return ctx["rownum"]
    return get(ctx["id_slot"][name])


def sequence_history(df: DataFrame, feature_cols: list[str], *, uid: str = "uid", ts: str = "TransactionDT",
                     tie: str = "TransactionID", history_len: int = config.WINDOW_SIZE,
                     scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """W12 on ready feature columns: for every row after a card's first, the
    up to ``history_len`` previous rows (this row excluded), front-padded with
    zero rows; adds ``seq`` (array<array<double>>) and ``hist_len``."""
    out = card_pass(df, key=uid, order=(ts, tie), history=feature_cols, history_len=history_len, scale=scale)
    zero = F.array(*[F.lit(0.0) for _ in feature_cols])
    pad = F.array_repeat(zero, F.lit(history_len) - F.size("_hist"))
    return (out.filter(F.size("_hist") > 0)
            .withColumn("hist_len", F.size("_hist"))
            .withColumn("seq", F.concat(pad, F.col("_hist"))).drop("_hist"))


def feature_frame(enc: DataFrame, extra: list[str] | None = None, *, uid: str = "uid", ts: str = "TransactionDT",
                  tie: str = "TransactionID", card_aggs: dict | None = None, scale: ScaleConfig = DEFAULT_SCALE) -> tuple[DataFrame, list[str]]:
    """Encoded rows -> ``uid, tie, ts, extra..., _f_<feature>...``, one value per candidate
    feature and row (P10's candidates), and the candidates.  One ordered pass per card."""
    id_cols = [c for c in enc.columns if c.startswith("id_")]
    raw = enc.select(
        "*",
        lenient_double("TransactionAmt").alias("_r_amt"), F.col(ts).cast("double").alias("_r_dt"),
        *[F.col(c).cast("double").alias(r) for c, r in
          zip(["DeviceType_enc", "DeviceInfo_enc", "card4_enc", "card6_enc"], _RAW_FIXED[2:])],
        *[lenient_double(c).alias(f"_r_{c}") for c in id_cols])
    raw_cols = _RAW_FIXED + [f"_r_{c}" for c in id_cols]
    frame = card_pass(raw, key=uid, order=(ts, tie), row_number="txn_count_rolling",
                      card_aggs={"_amt_mu": F.avg("_r_amt"), "_amt_sd": F.stddev_samp("_r_amt"),
                                 "_dt_min": F.min(ts)} | (card_aggs or {}), scale=scale)
    row_ctx = {"rownum": F.col("txn_count_rolling").cast("double"), "id_slot": {c: 6 + i for i, c in enumerate(id_cols)}}
    cands = feature_candidates(config.BASE_FEATURES + id_cols)
    return frame.select(
        uid, tie, ts, *(extra or []), *(card_aggs or {}),
        *[finite_or_null(_feature_from_raw(c, lambda i: F.col(raw_cols[i]), row_ctx).cast("double")).alias(f"_f_{c}")
          for c in cands]), cands


def scaled_sequences(frame: DataFrame, feats: list[str], fitted: dict, extra: list, *, uid: str = "uid", ts: str = "TransactionDT",
                     tie: str = "TransactionID", history_len: int = config.WINDOW_SIZE, scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """``uid, tie, extra..., hist_len, seq`` from a feature frame: every feature clipped, imputed
    and scaled by ``fitted[feature]`` (clip_lo, clip_hi, median, mean, scale), then the history
    of each row after a card's first, front-padded with zero rows.  The second ordered pass reads
    narrow, final values."""
    def value(c: str) -> Column:
        f = {k: F.lit(fitted[c].get(k)).cast("double") for k in ("clip_lo", "clip_hi", "median", "mean", "scale")}
        filled = F.coalesce(clip(F.col(f"_f_{c}"), f["clip_lo"], f["clip_hi"]), f["median"])
        return ((filled - f["mean"]) / f["scale"]).cast("float").alias(f"_z_{c}")

    names = frame.select(uid, *extra).columns[1:]
    final = frame.filter(F.col(uid).isNotNull()).select(uid, tie, ts, *extra, *[value(c) for c in feats])
    hist = card_pass(final, key=uid, order=(ts, tie), history=[f"_z_{c}" for c in feats],
                     history_len=history_len, scale=scale)
    n = F.size("_hist")
    zero = F.array(*[F.lit(0.0) for _ in feats])
    return (hist.filter(n > 0)
            .select(uid, tie, *names, n.alias("hist_len"),
                    F.concat(F.array_repeat(zero, F.lit(history_len) - n), F.col("_hist"))
                    .cast("array<array<float>>").alias("seq")))


def build_sequences(labeled: DataFrame, *, uid: str = "uid", ts: str = "TransactionDT",
                    tie: str = "TransactionID", label: str = "ato_proxy",
                    history_len: int = config.WINDOW_SIZE, test_size: float = config.TEST_SIZE,
                    seed=config.RANDOM_SEED, clip_fit_on: str = "all", fit_on: str = "all",
                    with_encoders: bool = False, scale: ScaleConfig = DEFAULT_SCALE):
    """encode -> behaviour -> choose -> winsorise -> card split ->
    train-median impute -> train standardise -> sequences.

    Two ordered passes per card: the first yields per-row features (a narrow
    table, checkpointed for the fits), the second collects the history of the
    final transformed values.  Materialising the 10-step history before the
    fits would write ~10x the feature data; a second narrow shuffle is cheaper.

    Returns ``(sequences, state, feature_cols)``; ``sequences`` has
    ``uid, TransactionID, label, split, hist_len, seq (array<array<float>>)``
    and ``state`` is the fitted ``(feature, stat, value)`` table; ``with_encoders`` adds the
    fitted code tables, which with the state are all that new rows need.
    The fitted statistics are aggregates over the checkpointed narrow frame.

    ``fit_on="all"`` (default) fits encoders, column choice and clip bounds on
    every row, as the reference does; ``fit_on="train"`` fits them on train
    cards only (medians and scaling are always train-only).
    """
    spark = labeled.sparkSession
    labeled = cut_lineage(labeled, columnar=True)  # several narrow fit actions read it; compute it once
    if fit_on == "train":
        clip_fit_on = "train"

    # R1 without joining the big frame: a condition on a card's hash and stratum
    cards = card_strata(labeled, uid, label)
    in_test = test_side(cards, uid, "has_pos", test_size, seed)
    fit_rows = labeled
    if fit_on == "train":  # only the small encoder tables are fitted through this semi-join
        fit_rows = labeled.join(cards.filter(~in_test).select(uid), uid, "left_semi")
    encoders = fit_encoders(fit_rows, scale=scale)
    frame, cands = feature_frame(apply_encoders(labeled, encoders), [label], uid=uid, ts=ts, tie=tie,
                                 card_aggs={"has_pos": F.max(F.col(label).cast("int"))}, scale=scale)
    # narrow per-row frame (keys + one value per candidate feature) is the only
    # thing materialised for the fits; the wide history is never written here
    side = F.when(F.col(uid).isNotNull(), F.when(in_test, "test").otherwise("train"))
    frame = cut_lineage(frame.withColumn("split", side).drop("has_pos"))

    # P10 on the per-row values (all rows, or train rows)
    p10_rows = frame if fit_on == "all" else frame.filter(F.col("split") == "train")
    counts = p10_rows.agg(*[F.count(f"_f_{c}").alias(c) for c in cands]).first()
    feats = [c for c in cands if counts[c] > 0]
    fcols = [f"_f_{c}" for c in feats]

    # fitted constants (bounded by the feature count), one exact-quantile pass:
    # clip bounds over all (or train) rows and train medians.  Clipping is
    # monotone, so the median of clipped values interpolates the clipped
    # neighbours of the raw median.
    lo_p, hi_p = config.CLIP_QUANTILES
    in_train = F.col("split") == "train"
    series = {("clip", c): F.col(c) if clip_fit_on == "all" else F.when(in_train, F.col(c)) for c in fcols}
    series |= {("median", c): F.when(in_train, F.col(c)) for c in fcols}
    found = select_quantiles(frame, series, {k: [lo_p, hi_p] if k[0] == "clip" else [0.5] for k in series})
    bounds = {c: tuple(found["clip", c][p].q if found["clip", c] else None for p in (lo_p, hi_p)) for c in fcols}

    def _clip_v(v, lo, hi):
        if v is None:
            return None
        if hi is not None and v > hi:
            v = hi
        if lo is not None and v < lo:
            v = lo
        return v

    meds = {}
    for c in fcols:
        r = found["median", c].get(0.5)
        if r is None:
            meds[c] = None
            continue
        a, b = _clip_v(r.lo, *bounds[c]), _clip_v(r.hi, *bounds[c])
        meds[c] = a + (b - a) * r.frac
    clipped = frame.withColumns({c: clip(F.col(c), *bounds[c]) for c in fcols})
    train = clipped.filter(F.col("split") == "train")
    mom = moments(impute(train, meds), fcols)

    fitted = {c: {"clip_lo": bounds[f"_f_{c}"][0], "clip_hi": bounds[f"_f_{c}"][1], "median": meds[f"_f_{c}"],
                  "mean": mom[f"_f_{c}"][0], "scale": mom[f"_f_{c}"][1]} for c in feats}
    seqs = scaled_sequences(frame, feats, fitted, [F.col(label).cast("int").alias("label"), F.col("split")], uid=uid, ts=ts, tie=tie,
                            history_len=history_len, scale=scale)
    state = spark.createDataFrame([(c, k, v) for c in feats for k, v in fitted[c].items()], "feature string, stat string, value double")
    if with_encoders:
        return seqs, state, feats, encoders
    return seqs, state, feats
