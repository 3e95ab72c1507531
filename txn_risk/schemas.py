"""Declared schemas, column contracts and fixed values. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# Fixed values. One flat record per card transaction, as it arrives in files and on the topic.
TRANSACTION = _struct(
    trans_num=_S, trans_date_trans_time=_S, unix_time=_L, cc_num=_L, merchant=_S, category=_S,
    amt=_D, first=_S, last=_S, gender=_S, street=_S, city=_S, state=_S, zip=_L, lat=_D, long=_D,
    city_pop=_L, job=_S, dob=_S, merch_lat=_D, merch_long=_D, is_fraud=_L,
)

# The record as the replay puts it on the topic.
EVENT = T.StructType(TRANSACTION.fields + [T.StructField("produced_at", _S, True)])

# Fixed values. The raw warehouse table; the key is required, all else may be null.
RAW = T.StructType(
    [T.StructField("trans_num", _S, False)]
    + EVENT.fields[1:]
    + [T.StructField("ingested_at", T.TimestampType(), True)]
)

# Fixed values. CSV files carry an unnamed leading row index.
CSV_INDEX = "_row_index"
CSV_FILE = T.StructType(
    [T.StructField(CSV_INDEX, _L, True)]
    + [TRANSACTION[n] for n in (
        "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last",
        "gender", "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob",
        "trans_num", "unix_time", "merch_lat", "merch_long", "is_fraud",
    )]
)

# Fixed values. Keyed score table.
SCORE = _struct(
    trans_num=_S, trans_date_trans_time=_S, unix_time=_L, cc_num=_L, merchant=_S, category=_S,
    amt=_D, city=_S, state=_S, geo_distance_km=_D, txn_freq_24h=T.IntegerType(),
    amt_zscore_by_customer=_D, fraud_score=_D, is_fraud_predicted=T.IntegerType(),
    is_fraud_ground_truth=T.IntegerType(), decision=_S, latency_ms=_D, processed_at=_S,
)

# Fixed values. Output contracts of the star schema.
DIM_CUSTOMERS = (
    "customer_id", "cc_num", "first_name", "last_name", "full_name", "gender", "street", "city",
    "state", "zip_code", "customer_lat", "customer_long", "city_population", "job_title",
    "date_of_birth", "customer_age", "dbt_updated_at",
)
DIM_MERCHANTS = (
    "merchant_id", "merchant_name", "category", "avg_merchant_lat", "avg_merchant_long",
    "total_historical_transactions", "dbt_updated_at",
)
FCT_FEATURES = (
    "trans_num", "customer_id", "merchant_id", "trans_timestamp", "unix_time", "amount",
    "category", "is_fraud", "geo_distance_km", "txn_freq_24h", "amt_zscore_by_customer",
    "trans_hour", "day_of_week", "is_weekend", "is_night", "ingested_at", "dbt_updated_at",
)

# The merchant categories with their own flag column.
CATEGORIES = (
    "entertainment", "food_dining", "gas_transport", "grocery_net", "grocery_pos",
    "health_fitness", "home", "kids_pets", "misc_net", "misc_pos", "personal_care",
    "shopping_net", "shopping_pos", "travel",
)

# The feature vector's order.
NUMERIC_FEATURES = (
    "amt", "amt_log", "geo_distance_km", "txn_freq_24h", "amt_zscore_by_customer", "trans_hour",
    "day_of_week", "is_weekend", "is_night", "customer_age", "city_pop_log", "gender_code",
)
FEATURES = NUMERIC_FEATURES + tuple(f"cat_{c}" for c in CATEGORIES) + ("cat_other",)

# Business costs, policy cut-offs and feature defaults.
COST_MISSED_FRAUD = 500.0
COST_FALSE_ALARM = 15.0
BLOCK_THRESHOLD = 0.85
ALERT_THRESHOLD = 0.75
PUBLISHED_RECALL = 0.8545
PROMOTION_FLOOR = 0.70
DEFAULT_MEAN_AMOUNT = 70.0
DEFAULT_STD_AMOUNT = 160.0
DEFAULT_CITY_POP = 10000
DEFAULT_DOB = "1990-01-01"
DEFAULT_AGE = 35.0
DAY_SECONDS = 86400
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT = "yyyy-MM-dd"
