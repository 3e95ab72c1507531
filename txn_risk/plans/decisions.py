"""Policy, score records and the rules shown beside a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.schemas import ALERT_THRESHOLD, BLOCK_THRESHOLD, SCORE

# Columns a score record takes from the transaction, beside the feature columns.
CARRIED = (
    "trans_num", "trans_date_trans_time", "unix_time", "cc_num", "merchant", "category", "city",
    "state", "is_fraud", "produced_at",
)

FAR_KM = 100.0
UNUSUAL_Z = 2.0


def decision(
    score: Column, alert: float = ALERT_THRESHOLD, block: float = BLOCK_THRESHOLD
) -> Column:
    return F.when(score >= block, "BLOCK").when(score >= alert, "ALERT").otherwise("APPROVE")


def score_records(
    scored: DataFrame, alert: float = ALERT_THRESHOLD, block: float = BLOCK_THRESHOLD
) -> DataFrame:
    """The stored form of scored feature rows.

    Flag and decision use the unrounded score. ``latency_ms`` runs from ``produced_at`` to the
    start of the micro-batch that scored the row; it is null without ``produced_at``.
    """
    now = F.current_timestamp()
    produced = F.try_to_timestamp(F.col("produced_at"))
    latency = (F.unix_micros(now) - F.unix_micros(produced)) / 1000.0
    made = {
        "geo_distance_km": F.round("geo_distance_km", 2),
        "amt_zscore_by_customer": F.round("amt_zscore_by_customer", 4),
        "fraud_score": F.round("score", 4),
        "is_fraud_predicted": (F.col("score") >= alert).cast("int"),
        "is_fraud_ground_truth": F.coalesce("is_fraud", F.lit(-1)),
        "decision": decision(F.col("score"), alert, block),
        "latency_ms": F.round(latency, 2),
        "processed_at": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
    }
    return scored.select(*[
        made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SCORE.fields
    ])


def risk_signals(scores: DataFrame) -> DataFrame:
    """Two rules on a stored score: far from home, and an unusual amount."""
    return scores.withColumns({
        "flag_far": F.col("geo_distance_km") > FAR_KM,
        "flag_amount": F.abs("amt_zscore_by_customer") > UNUSUAL_Z,
    })
