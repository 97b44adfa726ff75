"""M6 on a stream: fitted model + decision per micro-batch of sequence rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalar import decide, np_round
from riskspark.operators.features import flatten_sequence
from riskspark.operators.models import prob_one


def score_stream(sequences: DataFrame, model, backend: str = "rf", key: str = "TransactionID") -> DataFrame:
    """Streaming (or batch) DataFrame of ``(key, seq)`` -> ``(key,
    ato_risk_score, recommended_action)``.  Stateless, so every output mode
    works; Spark ML transformers run per micro-batch."""
    scored = prob_one(model.transform(flatten_sequence(sequences).select(key, "features")))
    risk = np_round(F.col("score") * 100, 2)
    return scored.select(key, risk.alias("ato_risk_score"), decide(risk, backend).alias("recommended_action"))
