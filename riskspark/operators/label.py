"""Behavioural signals and the proxy label.

label = isFraud AND at least two of: device change / proxy network,
session value outside the card's own spread, two card events within 2 h.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.functions.scalar import as_flag, lenient_double, proxy_flag
from riskspark.operators.cardpass import card_pass

LABEL_OUTPUTS = ["prev_device", "device_changed", "is_proxy", "signal_device",
                 "signal_session", "prev_dt", "time_since_prev", "signal_velocity",
                 "signal_count", "ato_proxy"]


def session_stats_aggs(cols: list[str]) -> dict:
    """Whole-card count / mean / sample std / extremes of each session value."""
    aggs = {}
    for c in cols:
        v = F.col(f"_v_{c}")
        aggs |= {f"_cnt_{c}": F.count(v), f"_mu_{c}": F.avg(v), f"_sd_{c}": F.stddev_samp(v),
                 f"_max_{c}": F.max(v), f"_min_{c}": F.min(v)}
    return aggs


def causal_stats(src: str, c: str) -> dict:
    """The same of the earlier rows (running statistics of ``card_pass``)."""
    return {f"_{a}_{c}": F.col(f"_{b}_{src}")
            for a, b in (("cnt", "rn"), ("mu", "rm"), ("sd", "rsd"), ("max", "rmax"), ("min", "rmin"))}


def session_anomaly(cols: list[str]):
    """Any column with |z| > 2 on a card with >= 3 values and a spread."""
    if not cols:
        return F.lit(0)
    flags = []
    for c in cols:
        z = F.try_divide(F.col(f"_v_{c}") - F.col(f"_mu_{c}"), F.col(f"_sd_{c}"))
        flags.append((F.abs(z) > config.SESSION_Z) & (F.col(f"_cnt_{c}") >= config.SESSION_MIN_COUNT)
                     & (F.col(f"_sd_{c}") > 0) & (F.col(f"_max_{c}") > F.col(f"_min_{c}")))
    return as_flag(reduce(lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)), flags))


def label_transactions(txn: DataFrame, *, uid: str = "uid", ts: str = "TransactionDT",
                       tie: str = "TransactionID", device: str = "DeviceInfo",
                       network: str = "id_31", fraud: str = "isFraud",
                       session_cols: list[str] | None = None, causal: bool = False,
                       scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Add the three signals, their count and ``ato_proxy``.

    One ordered pass per card.
    ``causal=True`` judges each session value only against the card's
    earlier rows (the reference uses the whole card, future included).
    """
    cols = [c for c in (session_cols or config.SESSION_COLUMNS) if c in txn.columns]
    base = txn.columns
    df = txn.select("*", *[lenient_double(c).alias(f"_v_{c}") for c in cols])
    df = card_pass(df, key=uid, order=(ts, tie),
                   lags={"prev_device": device, "prev_dt": ts},
                   card_aggs=None if causal else session_stats_aggs(cols),
                   running=[f"_v_{c}" for c in cols] if causal else None, scale=scale)
    if causal:
        df = df.withColumns({k: v for c in cols for k, v in causal_stats(f"_v_{c}", c).items()})
    is_proxy = proxy_flag(network) if network in base else F.lit(0)
    out = (df
           .withColumn("device_changed", as_flag(F.col(device) != F.col("prev_device")))
           .withColumn("is_proxy", is_proxy)
           .withColumn("signal_device", F.greatest("device_changed", "is_proxy"))
           .withColumn("signal_session", session_anomaly(cols))
           .withColumn("time_since_prev", F.col(ts) - F.col("prev_dt"))
           .withColumn("signal_velocity", as_flag(F.col("time_since_prev") < config.VELOCITY_SECONDS))
           .withColumn("signal_count", F.col("signal_device") + F.col("signal_session")
                       + F.col("signal_velocity"))
           .withColumn("ato_proxy", as_flag((F.col(fraud) == 1) & (F.col("signal_count") >= 2))))
    return out.select(*base, *LABEL_OUTPUTS)
