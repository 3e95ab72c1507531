"""Data profiles: shape, class balance, distributions and fraud rates of raw transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.functions import exact_avg, haversine_km, parse_timestamp, ratio
from txn_risk.operators.histogram import histogram
from txn_risk.operators.ordering import distribution


def _fraud() -> Column:
    return F.col("is_fraud") == 1

# The profile's shown range and bucket counts.
AMOUNT_SHOWN = 1500.0
TOP_STATES = 15
ENTITIES = ("cc_num", "merchant", "category", "state", "job")


def with_distance(rows: DataFrame, digits: int | None = 2) -> DataFrame:
    return rows.withColumn(
        "distance_km",
        haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"), digits),
    )


def with_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("trans_timestamp", parse_timestamp(F.col("trans_date_trans_time")))


def null_profile(rows: DataFrame) -> DataFrame:
    """``(column, type, n_rows, n_null)`` for every column, from one scan."""
    fields = rows.schema.fields
    counts = [F.count_if(F.col(f.name).isNull()).alias(f.name) for f in fields]
    cells = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("n_rows"), F.col(f"`{f.name}`").alias("n_null"),
        )
        for f in fields
    ])
    return rows.agg(F.count(F.lit(1)).alias("_rows"), *counts).select(F.inline(cells))


def time_span(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last transaction time as text, which sorts like the time it spells."""
    return rows.groupBy(*by).agg(
        F.min("trans_date_trans_time").alias("first_at"),
        F.max("trans_date_trans_time").alias("last_at"),
    )


def class_balance(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count_if(_fraud()).alias("fraud"),
        F.count(F.lit(1)).alias("total"),
        (ratio(F.count_if(_fraud()), F.count(F.lit(1)), 0) * 100).alias("fraud_pct"),
    )


def distinct_entities(
    rows: DataFrame, columns: Sequence[str] = ENTITIES, approximate: bool = False
) -> DataFrame:
    """Distinct values per column, exact or by sketch (one pass, no value-sized shuffle)."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return rows.agg(*[count(c).alias(c) for c in columns])


def _summary(rows: DataFrame, value: str, points: Mapping[str, float]) -> DataFrame:
    """Mean, maximum and the named quantiles of a two-decimal value per class."""
    return distribution(rows, value, points, ["is_fraud"]).select("is_fraud", "mean", *points, "max")


def amount_summary(rows: DataFrame) -> DataFrame:
    """Mean, median, 95th percentile and maximum amount per class."""
    return _summary(rows, "amt", {"median": 0.5, "p95": 0.95})


def distance_summary(rows: DataFrame) -> DataFrame:
    """Mean, median and maximum distance per class."""
    return _summary(with_distance(rows), "distance_km", {"median": 0.5})


def distance_describe(rows: DataFrame) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of distance per class."""
    quartiles = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    return distribution(with_distance(rows), "distance_km", quartiles, ["is_fraud"], deviation=True).select(
        "is_fraud", "n", "std", "min", "mean", *quartiles, "max"
    )


def _rates(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count("is_fraud").alias("total_txn"),
        F.count_if(_fraud()).alias("fraud_txn"),
        ratio(F.count_if(_fraud()), F.count("is_fraud"), 0).alias("fraud_rate"),
        exact_avg(F.col("amt")).alias("avg_amount"),
    )


def category_rates(rows: DataFrame) -> DataFrame:
    return _rates(rows, ["category"]).withColumn("fraud_rate_pct", F.col("fraud_rate") * 100).orderBy(
        F.col("fraud_rate").desc(), "category"
    )


def top_states(rows: DataFrame, n: int = TOP_STATES) -> DataFrame:
    return _rates(rows, ["state"]).orderBy(F.col("fraud_rate").desc(), "state").limit(n)


def state_extremes(rows: DataFrame) -> DataFrame:
    """Number of states and those with the highest and lowest fraud rate."""
    best: Column = F.struct("fraud_rate", F.col("state"))
    return _rates(rows, ["state"]).agg(
        F.count(F.lit(1)).alias("n_states"),
        F.max(best)["state"].alias("highest_state"),
        F.max("fraud_rate").alias("highest_rate"),
        F.min(best)["state"].alias("lowest_state"),
        F.min("fraud_rate").alias("lowest_rate"),
    )


def hourly_rates(rows: DataFrame) -> DataFrame:
    timed = with_time(rows).withColumn("hour", F.hour("trans_timestamp"))
    return _rates(timed, ["hour"]).drop("avg_amount").orderBy("hour")


def weekday_rates(rows: DataFrame) -> DataFrame:
    """Monday first."""
    timed = with_time(rows).select(
        F.weekday("trans_timestamp").alias("weekday"),
        F.date_format("trans_timestamp", "EEEE").alias("weekday_name"),
        "is_fraud", "amt",
    )
    return _rates(timed, ["weekday", "weekday_name"]).drop("avg_amount").orderBy("weekday")


def amount_density(rows: DataFrame, width: float = 50.0) -> DataFrame:
    """Amount density per class over the shown range 0 to 1,500."""
    return histogram(rows, "amt", width, ["is_fraud"], low=0.0, high=AMOUNT_SHOWN)


def distance_histogram(rows: DataFrame, width: float = 5.0) -> DataFrame:
    return histogram(with_distance(rows), "distance_km", width, ["is_fraud"])


def amount_box(rows: DataFrame) -> DataFrame:
    """Box-plot figures of the amount per class."""
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return distribution(rows, "amt", quartiles, ["is_fraud"]).select("is_fraud", "min", "mean", *quartiles, "max")
