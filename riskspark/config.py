"""Settings shared by all operators.

The values marked FIXED must equal the reference behaviour for results to
match; everything else is a tuning knob for large clusters.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- FIXED values (reference semantics) ------------------------------------
RANDOM_SEED = 42
WINDOW_SIZE = 10                 # history steps per sequence
TEST_SIZE = 0.20                 # share of cards held out
VELOCITY_SECONDS = 7200          # "too fast" gap between two card events
SESSION_Z = 2.0                  # |z| above which a session value is odd
SESSION_MIN_COUNT = 3            # values a card needs before z counts
PROXY_PATTERN = "proxy|anonymous|vpn"
CLIP_QUANTILES = (0.001, 0.999)
PSI_STABLE_MAX = 0.10
PSI_MODERATE_MAX = 0.25
PSI_EPS = 1e-6
PSI_BINS = 10
SWEEP_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
F1_EPS = 1e-9
WEIGHT_CAP = 25.0
UNDERSAMPLE_RATIO = 20
DECISION_THRESHOLDS = {
    "lstm": {"verify": 0.45, "block": 0.95},
    "rf": {"verify": 0.055, "block": 0.16},
}
SESSION_COLUMNS = ["id_01", "id_02", "id_03", "id_04", "id_05", "id_06",
                   "id_07", "id_08", "id_09", "id_10", "id_11"]
BASE_FEATURES = ["TransactionAmt", "amt_deviation", "account_age_dt",
                 "hour_of_day", "txn_count_rolling", "DeviceType_enc",
                 "DeviceInfo_enc", "card4_enc", "card6_enc"]
LABEL_ONLY_COLUMNS = ["signal_device", "signal_session", "signal_velocity",
                      "signal_count", "device_changed", "is_proxy",
                      "time_since_prev", "prev_device", "prev_dt"]
ID_AND_TARGET_COLUMNS = ["TransactionID", "uid", "isFraud", "ato_proxy"]
# ---------------------------------------------------------------------------
TASK_ROWS = 150_000              # training rows of a partition; more are spread (a tuning knob)


@dataclass(frozen=True)
class ScaleConfig:
    """parts: range partitions that ordered operators (ranks, curves) lay their rows
    out in; None: ``spark.sql.shuffle.partitions``.  chunk_rows: rows of one card that a
    card pass keeps together; None: about a million.  Results depend on neither."""

    parts: int | None = None
    chunk_rows: int | None = None


DEFAULT_SCALE = ScaleConfig()
