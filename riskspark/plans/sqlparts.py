"""Shared SQL fragments for the DuckDB oracles."""

from riskspark import config
from riskspark.sources.bindings import TXN_SQL


def r6(expr: str) -> str:
    """6-place rounding; ``+ 0.0`` turns DuckDB's -0.0 into 0.0 (Spark's
    decimal rounding never yields a negative zero)."""
    return f"(round({expr}, 6) + 0.0::double)"


T = f"with t as {TXN_SQL}"

_W = "partition by uid order by TransactionDT, TransactionID"


def _label_body() -> str:
    stats = []
    for c in ("id_01", "id_02"):
        stats.append(
            f"count({c}) over (partition by uid) as _cnt_{c}, avg({c}) over (partition by uid) as _mu_{c}, "
            f"stddev_samp({c}) over (partition by uid) as _sd_{c}, "
            f"(max({c}) over (partition by uid) > min({c}) over (partition by uid)) as _sp_{c}")
    anomalies = " or ".join(
        f"coalesce(abs(({c} - _mu_{c}) / _sd_{c}) > 2.0 and _cnt_{c} >= 3 and _sd_{c} > 0 and _sp_{c}, false)"
        for c in ("id_01", "id_02"))
    return f"""
t as {TXN_SQL},
w as (select *, lag(DeviceInfo) over ({_W}) as prev_device,
        lag(TransactionDT) over ({_W}) as prev_dt, {", ".join(stats)}
      from t),
s as (select *,
        cast(coalesce(DeviceInfo <> prev_device, false) as integer) as device_changed,
        cast(coalesce(regexp_matches(id_31, 'proxy|anonymous|vpn', 'i'), false) as integer) as is_proxy,
        cast(({anomalies}) as integer) as signal_session,
        TransactionDT - prev_dt as time_since_prev,
        cast(coalesce(TransactionDT - prev_dt < 7200, false) as integer) as signal_velocity
      from w),
l as (select *, greatest(device_changed, is_proxy) as signal_device from s),
lab as (select *, signal_device + signal_session + signal_velocity as signal_count,
        cast(isFraud = 1 and signal_device + signal_session + signal_velocity >= 2 as integer) as ato_proxy
      from l)"""


LAB = "with " + _label_body()

LABEL_COLS_SQL = """TransactionID, uid, TransactionDT, round(TransactionAmt, 6) as TransactionAmt,
  cast(isFraud as bigint) as isFraud, DeviceInfo, DeviceType, id_31, round(id_01, 6) as id_01,
  round(id_02, 6) as id_02, card4, card6, prev_device, cast(device_changed as bigint) as device_changed,
  cast(is_proxy as bigint) as is_proxy, cast(signal_device as bigint) as signal_device,
  cast(signal_session as bigint) as signal_session, prev_dt, time_since_prev,
  cast(signal_velocity as bigint) as signal_velocity, cast(signal_count as bigint) as signal_count,
  cast(ato_proxy as bigint) as ato_proxy"""

# R1 card split over the labelled CTE ``lab``: rank by md5(seed:uid) within
# the has-a-positive stratum; the first round(0.2 * n) are test.
SPLIT_SQL = f"""cards as (select uid, max(ato_proxy) as has_pos from lab where uid is not null group by uid),
sp as (select uid, has_pos, case when row_number() over (partition by has_pos order by md5('{config.RANDOM_SEED}:' || uid), uid)
  <= round({config.TEST_SIZE} * count(*) over (partition by has_pos)) then 'test' else 'train' end as split from cards)"""
