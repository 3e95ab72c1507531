"""What the operations screen shows of the score table, and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.functions import as_km, as_ms, as_percent, as_usd, exact_sum, mask_card, ratio
from txn_risk.sources.score_store import newest


def _flagged() -> Column:
    return F.col("decision").isin("BLOCK", "ALERT")



def live_kpis(scores: DataFrame) -> DataFrame:
    """One row of figures; zeros when there are no scores."""
    zero = F.lit(0.0)
    return scores.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_flagged()).alias("alerts"),
        F.count_if(F.col("decision") == "BLOCK").alias("blocked"),
        (ratio(F.count_if(_flagged()), F.count(F.lit(1)), 0) * 100).alias("fraud_rate_pct"),
        F.coalesce(F.avg("latency_ms"), zero).alias("avg_latency_ms"),
        F.coalesce(exact_sum(F.col("amt")), zero).alias("total_volume"),
    )


def decision_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


def filter_scores(
    scores: DataFrame, decisions: Sequence[str] = ("ALL",), min_amount: float = 0.0
) -> DataFrame:
    """Chosen decisions (all when ALL is among them or none is chosen) from an amount upwards."""
    out = scores
    if decisions and "ALL" not in decisions:
        out = out.where(F.col("decision").isin(*decisions))
    if min_amount > 0:
        out = out.where(F.col("amt") >= min_amount)
    return out


def timeline(scores: DataFrame, n: int = 100) -> DataFrame:
    return newest(scores, n).select(
        "processed_at", "fraud_score", "decision", "amt", "trans_num", "cc_num", "category",
        "geo_distance_km",
    )


def lookup(scores: DataFrame, trans_num: str) -> DataFrame:
    return scores.where(F.col("trans_num") == trans_num).limit(1)


def display_table(scores: DataFrame) -> DataFrame:
    """Scores as text for people."""
    return scores.select(
        "processed_at", "decision", "trans_num", mask_card(F.col("cc_num")).alias("card"),
        as_usd(F.col("amt")).alias("amount"), "category", "merchant",
        as_km(F.col("geo_distance_km")).alias("distance"),
        as_percent(F.col("fraud_score")).alias("score"),
        as_ms(F.col("latency_ms")).alias("latency"),
    )


def scoring_summary(scores: DataFrame) -> DataFrame:
    """Processed, flagged, flagged percent and mean latency of a scoring run."""
    flagged = F.count_if(F.col("is_fraud_predicted") == 1)
    return scores.agg(
        F.count(F.lit(1)).alias("processed"),
        flagged.alias("flagged"),
        (ratio(flagged, F.count(F.lit(1)), 0) * 100).alias("flagged_pct"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
    )


def replay_summary(rows: DataFrame, seconds: float | None = None) -> DataFrame:
    """Sent, frauds, fraud percent and, given the run time, rows per second."""
    frauds = F.count_if(F.col("is_fraud") == 1)
    rate = F.lit(None).cast("double") if not seconds else F.count(F.lit(1)) / F.lit(float(seconds))
    return rows.agg(
        F.count(F.lit(1)).alias("sent"),
        frauds.alias("fraud"),
        (ratio(frauds, F.count(F.lit(1)), 0) * 100).alias("fraud_pct"),
        rate.alias("rows_per_second"),
    )
