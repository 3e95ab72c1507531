"""The given event, customer and nation tables read as card transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txn_risk.schemas import TIMESTAMP_TEXT, TRANSACTION
from txn_risk.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _category(kind: Column) -> Column:
    # One padded, mixed-case name and one unknown name, so cleaning and "other" are exercised.
    return (
        F.when(kind == "view", "shopping_net")
        .when(kind == "click", "misc_net")
        .when(kind == "purchase", " Grocery_POS ")
        .when(kind == "signup", "entertainment")
        .otherwise("unmapped")
    )


def as_transactions(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events``."""
    # The nation table is fixed at 25 rows; the customer table carries no hint.
    people = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = events.join(people, F.col("user_id") == F.col("c_custkey"))
    user, event = F.col("user_id"), F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    lat = F.pmod(user * 37, F.lit(2000))
    long = F.pmod(user * 53, F.lit(5000))
    text = user.cast("string")
    columns = {
        "trans_num": event.cast("string"),
        "trans_date_trans_time": F.date_format(ts, TIMESTAMP_TEXT),
        "unix_time": F.unix_timestamp(ts),
        "cc_num": user,
        "merchant": F.concat(F.lit("m_"), F.regexp_extract("props", r"(\d+)", 1)),
        "category": _category(F.col("event_type")),
        "amt": F.col("value"),
        "first": F.concat(F.lit(" F"), text),
        "last": F.concat(F.lit("L"), text, F.lit(" ")),
        "gender": F.when(F.pmod(user, F.lit(2)) == 0, "m").otherwise("F"),
        "street": F.concat(text, F.lit(" Main St")),
        # Varies by event, so that "latest record per card" matters.
        "city": F.concat(F.lit("City "), F.pmod(event, F.lit(40)).cast("string")),
        "state": F.lower("n_name"),
        "zip": 10000 + user,
        "lat": 25.0 + lat / 100.0,
        "long": -120.0 + long / 100.0,
        "city_pop": 1000 + user * 997,
        "job": F.concat(F.lit(" Job "), F.pmod(user, F.lit(12)).cast("string")),
        "dob": F.date_format(
            F.date_add(F.lit("1940-01-01").cast("date"), F.pmod(user * 97, F.lit(22000)).cast("int")),
            "yyyy-MM-dd",
        ),
        "merch_lat": 25.0 + (lat + F.pmod(event * 17, F.lit(401)) - 200) / 100.0,
        "merch_long": -120.0 + (long + F.pmod(event * 29, F.lit(401)) - 200) / 100.0,
        "is_fraud": ((F.col("value") >= 200) | (F.pmod(event, F.lit(211)) == 0)).cast("bigint"),
        "ingested_at": ts,
    }
    return rows.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in TRANSACTION.fields],
        columns["ingested_at"].alias("ingested_at"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "nation"),
    )
