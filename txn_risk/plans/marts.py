"""Star schema: customer and merchant dimensions and the transaction fact with its features."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.functions import (
    age_by_year,
    customer_key,
    day_of_week_sunday1,
    exact_mean_place,
    full_name,
    haversine_km,
    hour_of_day,
    is_night,
    is_weekend,
    merchant_key,
)
from txn_risk.operators.baseline import key_stats, zscore_or_null
from txn_risk.operators.dedup import latest_per_key
from txn_risk.operators.trailing import TRAILING, attach_by_second, trailing_counts
from txn_risk.schemas import DIM_CUSTOMERS, DIM_MERCHANTS, FCT_FEATURES

_CUSTOMER = (
    "cc_num", "first_name", "last_name", "gender", "street", "city", "state", "zip_code",
    "customer_lat", "customer_long", "city_population", "job_title", "date_of_birth",
)
# What the fact is made of.
_FACT = (
    "trans_num", "cc_num", "merchant_name", "category", "trans_timestamp", "unix_time", "amount", "is_fraud",
    "customer_lat", "customer_long", "merchant_lat", "merchant_long", "ingested_at",
)


def customers(stg: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The latest record's attributes per card; age in calendar years at ``as_of`` (today)."""
    today = F.lit(as_of) if as_of else F.current_date()
    latest = latest_per_key(
        stg.select(*_CUSTOMER, "trans_timestamp", "trans_num"), ["cc_num"],
        ["trans_timestamp", "trans_num"], total=True,
    )
    return latest.select(
        customer_key(F.col("cc_num")).alias("customer_id"), *_CUSTOMER,
        age_by_year(F.col("date_of_birth"), today).alias("customer_age"),
    )


def merchants(stg: DataFrame) -> DataFrame:
    """Mean position and transaction count per merchant and category."""
    return (
        stg.groupBy("merchant_name", "category")
        .agg(
            exact_mean_place(F.col("merchant_lat")).alias("avg_merchant_lat"),
            exact_mean_place(F.col("merchant_long")).alias("avg_merchant_long"),
            F.count(F.lit(1)).alias("total_historical_transactions"),
        )
        .withColumn("merchant_id", merchant_key(F.col("merchant_name"), F.col("category")))
    )


def in_star(
    stg: DataFrame, cust: DataFrame | None = None, merch: DataFrame | None = None
) -> DataFrame:
    """Staged rows that have a customer and a merchant row.

    Dimensions built from the same staging hold every non-null key, so without ``cust`` / ``merch``
    the two inner joins reduce to null filters and need no shuffle. Pass dimensions kept elsewhere
    to join them for real.
    """
    if cust is None:
        out = stg.where(F.col("cc_num").isNotNull())
    else:
        out = stg.join(cust.select("cc_num"), "cc_num")
    if merch is None:
        return out.where(F.col("merchant_name").isNotNull() & F.col("category").isNotNull())
    return out.join(merch.select("merchant_name", "category"), ["merchant_name", "category"])


def card_behaviour(rows: DataFrame, amount: str = "amount") -> DataFrame:
    """``(cc_num, unix_time, n_trailing, mean, std)``, one row per card and second.

    The card's statistics join this narrow table rather than the wide rows, so the wide rows are
    shuffled once for both features.
    """
    counts = trailing_counts(rows, "cc_num", "unix_time")
    stats = key_stats(rows, "cc_num", amount).drop("count")
    return counts.join(stats, "cc_num")


def enrich(
    stg: DataFrame, cust: DataFrame | None = None, merch: DataFrame | None = None, by_day: bool = False,
) -> DataFrame:
    """Staged rows with keys, distance, 24-hour count, z-score and calendar features.

    ``by_day`` brings the rows of a day together, for a table that is stored by day.
    """
    rows = in_star(stg, cust, merch)
    ts: Column = F.col("trans_timestamp")
    used = attach_by_second(rows.select(*_FACT), card_behaviour(rows), "cc_num", "unix_time")
    if by_day:
        used = used.withColumn("_day", F.to_date(ts)).hint("rebalance", "_day")
    # Surrogate keys are made after the shuffles: two digests are wider than what they hash.
    return used.select(
        "trans_num", customer_key(F.col("cc_num")).alias("customer_id"),
        merchant_key(F.col("merchant_name"), F.col("category")).alias("merchant_id"),
        "trans_timestamp", "unix_time", "amount",
        "category", "is_fraud", "customer_lat", "customer_long", "merchant_lat", "merchant_long",
        haversine_km(
            F.col("customer_lat"), F.col("customer_long"),
            F.col("merchant_lat"), F.col("merchant_long"),
        ).alias("geo_distance_km"),
        F.col(TRAILING).alias("txn_freq_24h"),
        zscore_or_null(F.col("amount"), F.col("mean"), F.col("std")).alias(
            "amt_zscore_by_customer"
        ),
        hour_of_day(ts).alias("trans_hour"),
        day_of_week_sunday1(ts).alias("day_of_week"),
        is_weekend(ts).alias("is_weekend"),
        is_night(ts).alias("is_night"),
        "ingested_at",
    )


def _audited(df: DataFrame, contract: tuple[str, ...]) -> DataFrame:
    return df.withColumn("dbt_updated_at", F.current_timestamp()).select(*contract)


def dim_customers(stg: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    named = customers(stg, as_of).withColumn(
        "full_name", full_name(F.col("first_name"), F.col("last_name"))
    )
    return _audited(named, DIM_CUSTOMERS)


def dim_merchants(stg: DataFrame) -> DataFrame:
    return _audited(merchants(stg), DIM_MERCHANTS)


def fct_features(
    stg: DataFrame, cust: DataFrame | None = None, merch: DataFrame | None = None, by_day: bool = False,
) -> DataFrame:
    return _audited(enrich(stg, cust, merch, by_day), FCT_FEATURES)


@dataclass(frozen=True)
class Star:
    """The three marts, ready to query."""

    customers: DataFrame
    merchants: DataFrame
    fact: DataFrame

    def register(self) -> None:
        """Expose the marts to SQL callers under their contract names."""
        self.customers.createOrReplaceTempView("dim_customers")
        self.merchants.createOrReplaceTempView("dim_merchants")
        self.fact.createOrReplaceTempView("fct_transactions_fraud_features")


def star(stg: DataFrame, as_of: dt.date | None = None, by_day: bool = False) -> Star:
    """Marts over one staging table. Settle ``stg`` first when it is costly: three marts read it."""
    return Star(dim_customers(stg, as_of), dim_merchants(stg), fct_features(stg, by_day=by_day))
