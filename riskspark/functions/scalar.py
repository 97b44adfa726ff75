"""Column expressions (P-series).  All JVM-side built-ins, so they stay
inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from riskspark import config

__all__ = [
    "col_of", "lenient_double", "finite_or_null", "entity_key", "device_type_code",
    "proxy_flag", "hour_of_day", "day_bucket", "clip", "decide", "drift_band",
    "epoch_seconds", "hash_unit", "hash_key", "as_flag", "np_round",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_flag(cond: Column) -> Column:
    """Boolean -> 0/1 int with null treated as 0 (flags get summed later)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def finite_or_null(c) -> Column:
    """NaN and +-inf become NULL (Spark quantiles treat NaN as a value)."""
    c = col_of(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


#: Decimal text with an optional exponent: Java's parser also takes "1d" or "0x1p3".
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(c) -> Column:
    """Text that isn't a decimal number -> NULL, non-finite -> NULL."""
    c = col_of(c)
    text = (F.typeof(c) == "string") & ~c.cast("string").rlike(_NUMBER)  # constant false for other types
    return finite_or_null(F.when(text, F.lit(None)).otherwise(c.try_cast("double")))


def entity_key(card, addr) -> Column:
    """``card + '_' + addr``, a missing one printed as ``nan``."""
    return F.concat_ws("_", *[F.coalesce(col_of(c).cast("string"), F.lit("nan")) for c in (card, addr)])


def device_type_code(c) -> Column:
    """Mobile -> 1, desktop -> 2, anything else or null -> 0."""
    c = col_of(c)
    return F.when(c == "mobile", 1).when(c == "desktop", 2).otherwise(0)


def proxy_flag(c) -> Column:
    """Proxy / anonymous / vpn anywhere, case-insensitive; null -> 0."""
    return as_flag(col_of(c).rlike("(?i)" + config.PROXY_PATTERN))


def hour_of_day(dt) -> Column:
    """P5: hour in [0, 24) of a seconds clock (floor-mod like pandas)."""
    return F.pmod(col_of(dt), F.lit(86400)) / F.lit(3600.0)


def day_bucket(dt) -> Column:
    """Day number of a seconds clock (floor division)."""
    return F.floor(col_of(dt) / F.lit(86400)).cast("long")


def clip(c, lo, hi) -> Column:
    """Clip to [lo, hi]; nulls stay null, a null bound is no bound."""
    c = col_of(c)
    lo_c = col_of(lo) if not isinstance(lo, (int, float)) else F.lit(float(lo))
    hi_c = col_of(hi) if not isinstance(hi, (int, float)) else F.lit(float(hi))
    capped = F.when(hi_c.isNotNull() & (c > hi_c), hi_c).otherwise(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.when(lo_c.isNotNull() & (capped < lo_c), lo_c).otherwise(capped))


def decide(risk_0_100, backend: str = "rf", verify: float | None = None,
           block: float | None = None) -> Column:
    """Tiered action on a 0-100 risk score (inclusive lower bounds).

    Unknown backends fall back to the random-forest thresholds.
    """
    t = config.DECISION_THRESHOLDS.get(backend, config.DECISION_THRESHOLDS["rf"])
    v = (t["verify"] if verify is None else verify) * 100
    b = (t["block"] if block is None else block) * 100
    r = col_of(risk_0_100)
    return (F.when(r >= F.lit(b), "block").when(r >= F.lit(v), "step_up_auth")
            .otherwise("allow"))


def drift_band(psi) -> Column:
    """< .10 stable, < .25 moderate, else significant."""
    p = col_of(psi)
    return (F.when(p < config.PSI_STABLE_MAX, "stable")
            .when(p < config.PSI_MODERATE_MAX, "moderate").otherwise("significant"))


def epoch_seconds(c, dtype=None) -> Column:
    """Whole seconds since 1970 of a timestamp, independent of session TZ.

    ``timestamp_ntz`` is read as wall-clock UTC (date part * 86400 + clock);
    an instant ``timestamp`` uses its absolute epoch.  Numbers pass through.
    """
    c = col_of(c)
    if isinstance(dtype, TimestampType):
        return F.unix_seconds(c)
    if isinstance(dtype, TimestampNTZType):
        return (F.unix_date(F.to_date(c)).cast("long") * 86400
                + F.hour(c) * 3600 + F.minute(c) * 60
                + F.floor(F.second(c)).cast("long"))
    return c.cast("long")


def hash_key(seed, key) -> Column:
    """Deterministic md5 hex of ``seed:key`` (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_of(key).cast("string")))


def hash_unit(seed, key) -> Column:
    """Uniform [0, 1) from the first 15 hex digits of ``hash_key``."""
    h = F.conv(F.substring(hash_key(seed, key), 1, 15), 16, 10).cast("double")
    return h / F.lit(float(16 ** 15))


def np_round(c, digits: int) -> Column:
    """Numpy rounding -- scale, round half to even, unscale (so
    ``np_round(.12345, 4) = .1234``).  DuckDB twin:
    ``round_even(x * 10^d, 0) / 10^d``."""
    f = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(f)) / F.lit(f)
