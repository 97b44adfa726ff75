"""One versioned bundle of everything that was fitted, and raw rows scored from it.

A bundle is a folder: the code tables of the categorical encoders, the
``(feature, stat, value)`` table, the feature order and window, and the model.  It
counts once its ``bundle.json`` is written, which comes last.  Raw transactions (of whole cards,
or new rows with their cards' earlier ones) go through the same steps as in training, with
every constant from the bundle: nothing is fitted again, so a row's score does not depend on
what other cards come with it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import config
from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.operators import decide as D
from riskspark.operators import models as M
from riskspark.operators.features import apply_encoders, feature_frame, scaled_sequences
from riskspark.sources.io import read_text, write_text

VERSION = 1


@dataclass
class Bundle:
    """Fitted state in memory: code tables, constants by feature, feature order, model folder."""

    encoders: dict[str, tuple[str, DataFrame]]
    fitted: dict[str, dict[str, float | None]]
    features: list[str]
    history_len: int
    model_path: str


def save_bundle(path: str, encoders: dict[str, tuple[str, DataFrame]], state: DataFrame, features: list[str], model, *,
                history_len: int = config.WINDOW_SIZE) -> None:
    """Write what ``build_sequences(..., with_encoders=True)`` and a model fit gave."""
    root, spark = path.rstrip("/"), state.sparkSession
    for c, (_, table) in encoders.items():
        table.write.mode("overwrite").parquet(f"{root}/encoder-{c}")
    state.write.mode("overwrite").parquet(f"{root}/state")
    M.save_model(model, f"{root}/model")
    write_text(spark, f"{root}/bundle.json", json.dumps({
        "version": VERSION, "features": features, "history_len": history_len, "encoders": {c: kind for c, (kind, _) in encoders.items()}}))


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    root = path.rstrip("/")
    about = json.loads(read_text(spark, f"{root}/bundle.json"))
    if about["version"] != VERSION:
        raise ValueError(f"a bundle of version {about['version']}, not {VERSION}")
    fitted: dict = {c: {} for c in about["features"]}
    for r in spark.read.parquet(f"{root}/state").collect():  # five rows a feature
        fitted[r["feature"]][r["stat"]] = r["value"]
    encoders = {c: (kind, spark.read.parquet(f"{root}/encoder-{c}")) for c, kind in about["encoders"].items()}
    return Bundle(encoders, fitted, about["features"], about["history_len"], f"{root}/model")


def raw_sequences(txn: DataFrame, bundle: Bundle, *, uid: str = "uid", ts: str = "TransactionDT", tie: str = "TransactionID",
                  scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """``uid, TransactionID, hist_len, seq`` of every row after its card's first.  Columns that
    the rows lack are missing values."""
    lacking = [c for c in bundle.features if c.startswith("id_") and c not in txn.columns]
    rows = apply_encoders(txn.withColumns({c: F.lit(None).cast("double") for c in lacking}), bundle.encoders)
    if "DeviceType_enc" not in rows.columns:
        rows = rows.withColumn("DeviceType_enc", F.lit(0).cast("long"))
    frame, _ = feature_frame(rows, uid=uid, ts=ts, tie=tie, scale=scale)
    return scaled_sequences(frame, bundle.features, bundle.fitted, [], uid=uid, ts=ts, tie=tie, history_len=bundle.history_len, scale=scale)


def score_raw(txn: DataFrame, bundle: Bundle, *, new: DataFrame | None = None, backend: str = "rf",
              scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """M6 from raw rows: ``TransactionID, ato_risk_score, recommended_action``, of all of them
    or of those whose TransactionID is in ``new`` (the others are their cards' history)."""
    seqs = raw_sequences(txn, bundle, scale=scale)
    if new is not None:
        seqs = seqs.join(new.select("TransactionID"), "TransactionID", "left_semi")
    return D.risk_table(M.score_model(M.load_forest(bundle.model_path), seqs), backend=backend)
