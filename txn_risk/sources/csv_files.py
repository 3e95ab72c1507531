"""Transaction CSV files in, star schema CSV files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txn_risk.functions import (
    age_at,
    customer_key,
    day_of_week_monday1,
    exact_mean_place,
    full_name,
    haversine_km,
    is_night,
    is_weekend,
    merchant_key,
    parse_date,
    parse_timestamp,
)
from txn_risk.operators.baseline import key_stats, zscore_or_zero
from txn_risk.operators.dedup import latest_per_key
from txn_risk.operators.trailing import with_trailing_rank
from txn_risk.plans.staging import RENAMES
from txn_risk.schemas import (
    CSV_FILE,
    CSV_INDEX,
    DIM_CUSTOMERS,
    DIM_MERCHANTS,
    FCT_FEATURES,
    TRANSACTION,
)


def read_transactions(spark: SparkSession, *paths: str) -> DataFrame:
    """Files with a header and a leading row index, which is dropped. Several paths are one union
    that keeps duplicates. A header of other names, or in another order, fails: columns go by place. The
    first file of each path is looked at here; the reader holds every file's header against the columns
    that a query uses."""
    names = CSV_FILE.fieldNames()[1:]
    for path in paths:
        head = spark.read.option("header", False).csv(path).limit(1).first()
        if head is not None and list(head)[1:] != names:
            raise ValueError(f"the header of {path} is {list(head)[1:]}, not {names}")
    rows = spark.read.schema(CSV_FILE).option("header", True).option("enforceSchema", False).csv(list(paths))
    return rows.drop(CSV_INDEX).select(*TRANSACTION.fieldNames())


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("trans_timestamp", parse_timestamp(F.col("trans_date_trans_time")))


def export_customers(rows: DataFrame) -> DataFrame:
    """Latest record per card; the age is the one at that transaction."""
    latest = latest_per_key(
        _timed(rows), ["cc_num"], ["trans_timestamp", "trans_num"]
    ).withColumn(
        "customer_age",
        age_at(F.col("trans_timestamp"), parse_date(F.col("dob"))).cast("long"),
    )
    named = latest.withColumns({
        "customer_id": customer_key(F.col("cc_num")),
        "full_name": full_name(F.col("first"), F.col("last")),
    })
    out = {k: v for k, v in RENAMES.items() if k != "trans_date_trans_time"}
    return named.withColumnsRenamed(out).select(*[c for c in DIM_CUSTOMERS if c != "dbt_updated_at"])


def export_merchants(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("merchant").isNotNull() & F.col("category").isNotNull())
        .groupBy(F.col("merchant").alias("merchant_name"), "category")
        .agg(
            exact_mean_place(F.col("merch_lat")).alias("avg_merchant_lat"),
            exact_mean_place(F.col("merch_long")).alias("avg_merchant_long"),
            F.count("trans_num").alias("total_historical_transactions"),
        )
        .withColumn("merchant_id", merchant_key(F.col("merchant_name"), F.col("category")))
        .select(*[c for c in DIM_MERCHANTS if c != "dbt_updated_at"])
    )


def export_fact(rows: DataFrame) -> DataFrame:
    """Fact as exported: rank-tie 24-hour count, z-score 0 for constant cards, 1 = Monday."""
    timed = _timed(rows).where(F.col("cc_num").isNotNull()).withColumn(
        "unix_time", F.coalesce("unix_time", F.unix_timestamp("trans_timestamp"))
    )
    stats = key_stats(rows, "cc_num", "amt").select("cc_num", "mean", "std")
    counted = with_trailing_rank(
        timed, "cc_num", "unix_time", "trans_num", "txn_freq_24h", per_key=stats
    )
    ts = F.col("trans_timestamp")
    made = {
        "customer_id": customer_key(F.col("cc_num")),
        "merchant_id": merchant_key(F.col("merchant"), F.col("category")),
        "amount": F.col("amt"),
        "geo_distance_km": haversine_km(
            F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")
        ),
        "amt_zscore_by_customer": F.round(
            zscore_or_zero(F.col("amt"), F.col("mean"), F.coalesce("std", F.lit(0.0))), 4
        ),
        "trans_hour": F.hour(ts),
        "day_of_week": day_of_week_monday1(ts),
        "is_weekend": is_weekend(ts),
        "is_night": is_night(ts),
    }
    return counted.withColumns(made).select(
        *[c for c in FCT_FEATURES if c not in ("ingested_at", "dbt_updated_at")]
    )


def export_star(rows: DataFrame, out_dir: str) -> None:
    """Write the three tables as CSV with a header, each as one directory of part files."""
    tables = {
        "dim_customers": export_customers(rows),
        "dim_merchants": export_merchants(rows),
        "fct_transactions_fraud_features": export_fact(rows),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}")
