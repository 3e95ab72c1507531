"""Report queries over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.functions import age_group, cents, exact_avg, month_bucket, ratio
from txn_risk.plans.measures import measures, measures_by_dimension
from txn_risk.schemas import COST_FALSE_ALARM, COST_MISSED_FRAUD

# Hour sets of the night report.
LATE_HOURS = (22, 23, 0, 1, 2, 3, 4)
DEEP_NIGHT_HOURS = (0, 1, 2, 3)
OFFICE_HOURS = (8, 9, 10, 11, 12, 13, 14, 15, 16, 17)

FAR_KM = 100.0
OUTLIER_Z = 3.0


def _fraud() -> Column:
    return F.col("is_fraud") == 1



def fact_slicer(
    start: str | None = None, end: str | None = None, categories: Sequence[str] = (),
    day: str | None = None,
) -> Column:
    """The reports' date and category slicers; dates are inclusive, no choice means all.

    ``day`` names the date column a stored fact is partitioned by, so that other days are not read.
    """
    keep = F.lit(True)
    if start:
        keep &= F.col("trans_timestamp") >= F.lit(start).cast("date")
        keep &= F.col(day) >= F.lit(start).cast("date") if day else F.lit(True)
    if end:
        keep &= F.col("trans_timestamp") < F.date_add(F.lit(end).cast("date"), 1)
        keep &= F.col(day) <= F.lit(end).cast("date") if day else F.lit(True)
    if categories:
        keep &= F.col("category").isin(*categories)
    return keep


def customer_slicer(states: Sequence[str] = (), age_groups: Sequence[str] = ()) -> Column:
    """The reports' state and age-group slicers, over :func:`with_age_group`."""
    keep = F.lit(True)
    if states:
        keep &= F.col("state").isin(*states)
    if age_groups:
        keep &= F.col("age_group").isin(*age_groups)
    return keep


def with_age_group(customers: DataFrame) -> DataFrame:
    return customers.withColumn("age_group", age_group(F.col("customer_age")))


def monthly_trend(fact: DataFrame) -> DataFrame:
    return measures(
        fact.withColumn("month", month_bucket(F.col("trans_timestamp"))), ["month"],
        ["total_amount", "fraud_rate", "fraud_amount"],
    )


def category_risk(fact: DataFrame) -> DataFrame:
    """Fraud rate and loss per category, ranked by rate."""
    out = measures(
        fact, ["category"],
        ["total_transactions", "fraud_transactions", "fraud_rate", "fraud_amount"],
    )
    # One row per category; the rank window is as small as the report.
    rank = F.row_number().over(Window.orderBy(F.col("fraud_rate").desc(), "category"))
    return out.withColumn("risk_rank", rank)


def label_split(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", ratio(F.col("n"), total, 0))


def state_risk(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return measures_by_dimension(
        fact, customers, "customer_id", ["state"],
        only=["total_transactions", "fraud_amount", "fraud_rate"],
    )


def distance_band(km: Column) -> Column:
    """Bands [0,10), [10,50), [50,100], above."""
    return (
        F.when(km < 10, "< 10").when(km < 50, "10 - 50").when(km <= 100, "50 - 100")
        .when(km > 100, "> 100")
    )


def distance_bands(fact: DataFrame) -> DataFrame:
    return measures(
        fact.withColumn("band", distance_band(F.col("geo_distance_km"))), ["band"],
        ["total_transactions", "fraud_transactions", "fraud_amount", "fraud_rate"],
    )


def top_merchants(fact: DataFrame, merchants: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` merchants with the greatest fraud loss.

    Facts are aggregated per key before the dimension is joined, so the join sees one row per
    merchant.
    """
    per_key = measures(
        fact, ["merchant_id"], ["fraud_transactions", "fraud_amount", "fraud_rate"]
    ).where(F.col("fraud_transactions") > 0)
    named = per_key.join(merchants.select("merchant_id", "merchant_name", "category"), "merchant_id")
    return named.orderBy(
        F.col("fraud_amount").desc(), F.col("fraud_transactions").desc(), "merchant_id"
    ).limit(n)


def age_gender(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return measures_by_dimension(
        fact, with_age_group(customers), "customer_id", ["age_group", "gender"],
        only=["total_transactions", "fraud_transactions", "fraud_rate"],
    )


def hourly_fraud(fact: DataFrame) -> DataFrame:
    return measures(
        fact, ["trans_hour"], ["total_transactions", "fraud_transactions", "fraud_rate"]
    )


def zscore_outliers(fact: DataFrame, z: float = OUTLIER_Z) -> DataFrame:
    """The points behind the amount / z-score chart above ``z``."""
    return fact.where(F.col("amt_zscore_by_customer") > z).select(
        "trans_num", "amount", "amt_zscore_by_customer", "is_fraud"
    )


def outlier_rate(fact: DataFrame, z: float = OUTLIER_Z) -> DataFrame:
    return measures(
        fact, (), ["total_transactions", "fraud_transactions", "fraud_rate"],
        where=F.col("amt_zscore_by_customer") > z,
    )


def night_share(
    fact: DataFrame, hours: Sequence[int] = LATE_HOURS,
    deep: Sequence[int] = DEEP_NIGHT_HOURS, office: Sequence[int] = OFFICE_HOURS,
) -> DataFrame:
    """Share of transactions and frauds in ``hours``; fraud-rate lift of ``deep`` over ``office``."""
    hour = F.col("trans_hour")

    def rows(chosen: Sequence[int]) -> Column:
        return F.count_if(hour.isin(*chosen))

    def frauds(chosen: Sequence[int]) -> Column:
        return F.count_if(_fraud() & hour.isin(*chosen))

    return fact.agg(
        ratio(rows(hours), F.count(F.lit(1)), 0).alias("transaction_share"),
        ratio(frauds(hours), F.count_if(_fraud()), 0).alias("fraud_share"),
        ratio(ratio(frauds(deep), rows(deep)), ratio(frauds(office), rows(office))).alias("lift"),
    )


def distance_lift(fact: DataFrame, far_km: float = FAR_KM) -> DataFrame:
    """Mean distance per class and the fraud-rate lift beyond ``far_km``."""
    far = F.col("geo_distance_km") > far_km
    near = F.col("geo_distance_km") <= far_km
    return fact.agg(
        exact_avg(F.when(_fraud(), F.col("geo_distance_km"))).alias("avg_fraud_distance_km"),
        exact_avg(F.when(F.col("is_fraud") == 0, F.col("geo_distance_km"))).alias(
            "avg_legit_distance_km"
        ),
        ratio(
            ratio(F.count_if(_fraud() & far), F.count_if(far)),
            ratio(F.count_if(_fraud() & near), F.count_if(near)),
        ).alias("lift"),
    )


def amount_contrast(fact: DataFrame) -> DataFrame:
    return measures(fact, (), ["avg_fraud_amount", "avg_legit_amount", "fraud_to_normal_ratio"])


def loss_share(fact: DataFrame, top: int = 2) -> DataFrame:
    """The ``top`` categories by fraud loss with their share of the whole loss."""
    loss = fact.where(_fraud()).groupBy("category").agg(
        F.sum(cents(F.col("amount"))).alias("_loss")
    )
    total = F.sum("_loss").over(Window.partitionBy(F.lit(0)))
    return (
        loss.select(
            "category", (F.col("_loss") / 100.0).alias("fraud_amount"),
            ratio(F.col("_loss") / 100.0, total / 100.0, 0).alias("loss_share"),
        )
        .orderBy(F.col("fraud_amount").desc(), "category")
        .limit(top)
    )


def weekend_uplift(fact: DataFrame) -> DataFrame:
    """Fraud rate on weekends, on weekdays, and their quotient."""
    weekend = F.col("is_weekend") == 1
    weekday = F.col("is_weekend") == 0
    on, off = (
        ratio(F.count_if(_fraud() & d), F.count_if(d), 0) for d in (weekend, weekday)
    )
    return fact.agg(
        on.alias("weekend_fraud_rate"), off.alias("weekday_fraud_rate"),
        ratio(on, off).alias("uplift"),
    )


def financial_impact(
    confusion: DataFrame, missed_cost: float = COST_MISSED_FRAUD,
    alarm_cost: float = COST_FALSE_ALARM,
) -> DataFrame:
    """Per threshold of a confusion table: frauds stopped, loss and cost against no model.

    ``confusion`` has ``threshold, tp, fp, fn, tn``.
    """
    positives = F.col("tp") + F.col("fn")
    return confusion.select(
        "threshold",
        F.col("fn").alias("missed_frauds"),
        F.col("fp").alias("false_alarms"),
        ratio(F.col("tp"), positives, 0).alias("prevented_share"),
        (positives * missed_cost).alias("loss_without_model"),
        (F.col("fn") * missed_cost).alias("loss_with_model"),
        (F.col("tp") * missed_cost).alias("loss_prevented"),
        (F.col("fn") * missed_cost + F.col("fp") * alarm_cost).alias("operating_cost"),
    )
