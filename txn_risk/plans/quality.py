"""Data tests over staging and marts, the raw schema contract and retrain readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from txn_risk.operators.joins import orphans
from txn_risk.schemas import RAW

STAGING, CUSTOMERS, MERCHANTS, FACT = (
    "stg_transactions", "dim_customers", "dim_merchants", "fct_transactions_fraud_features",
)

# The declared tests, per model.
UNIQUE = {
    STAGING: ["trans_num"], CUSTOMERS: ["customer_id"], MERCHANTS: ["merchant_id"],
    FACT: ["trans_num"],
}
NOT_NULL = {
    STAGING: ["trans_num", "cc_num", "amount", "is_fraud"],
    CUSTOMERS: ["customer_id", "cc_num"],
    MERCHANTS: ["merchant_id", "merchant_name"],
    FACT: ["trans_num", "customer_id", "merchant_id", "is_fraud"],
}
ACCEPTED = {STAGING: {"is_fraud": [0, 1]}, FACT: {"is_fraud": [0, 1]}}
RELATIONSHIPS = {FACT: {"customer_id": CUSTOMERS, "merchant_id": MERCHANTS}}


def _row_checks(
    model: str, df: DataFrame, required: Sequence[str], accepted: Mapping[str, Sequence[int]]
) -> DataFrame:
    """All row-level checks of a model in one scan and one aggregate, one output row per check."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in required]
    counts += [
        F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)).alias(f"accepted_values:{c}")
        for c, values in accepted.items()
    ]
    names = [f"not_null:{c}" for c in required] + [f"accepted_values:{c}" for c in accepted]
    cells = F.array(*[
        F.struct(
            F.lit(n.split(":")[0]).alias("check"), F.lit(model).alias("model"),
            F.lit(n.split(":")[1]).alias("column"), F.col(f"`{n}`").alias("failures"),
        )
        for n in names
    ])
    return df.agg(*counts).select(F.inline(cells))


def _unique(model: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("failures"))
    )
    return repeated.select(
        F.lit("unique").alias("check"), F.lit(model).alias("model"),
        F.lit(column).alias("column"), "failures",
    )


def _relationship(model: str, df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    missing = orphans(df, parent, column).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures")
    )
    return missing.select(
        F.lit("relationships").alias("check"), F.lit(model).alias("model"),
        F.lit(column).alias("column"), "failures",
    )


def quality_report(models: Mapping[str, DataFrame]) -> DataFrame:
    """``(check, model, column, failures)``, the 20 declared tests for the models given."""
    parts = []
    for model, df in models.items():
        parts.append(_row_checks(model, df, NOT_NULL[model], ACCEPTED.get(model, {})))
        parts += [_unique(model, df, c) for c in UNIQUE[model]]
        parts += [
            _relationship(model, df, c, models[parent])
            for c, parent in RELATIONSHIPS.get(model, {}).items()
            if parent in models
        ]
    return reduce(DataFrame.unionByName, parts)


def schema_problems(schema: T.StructType, expected: T.StructType = RAW) -> list[str]:
    """Missing and mistyped fields against the declared contract; empty when it holds."""
    have = {f.name: f.dataType for f in schema.fields}
    problems = [f"missing {f.name}" for f in expected.fields if f.name not in have]
    problems += [
        f"{f.name} is {have[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in expected.fields
        if f.name in have and have[f.name] != f.dataType
    ]
    return problems


def retrain_readiness(
    transactions: DataFrame, min_rows: int = 1, min_days: int = 0
) -> DataFrame:
    """One row: volume, time span, positives and whether training may start."""
    ts = F.try_to_timestamp("trans_date_trans_time", F.lit("yyyy-MM-dd HH:mm:ss"))
    facts = transactions.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("is_fraud") == 1).alias("n_fraud"),
        F.min(ts).alias("first_at"),
        F.max(ts).alias("last_at"),
    ).withColumn("n_days", F.datediff(F.col("last_at").cast("date"), F.col("first_at").cast("date")))
    ready = (
        (F.col("n_rows") >= min_rows) & (F.col("n_fraud") > 0)
        & (F.coalesce("n_days", F.lit(0)) >= min_days)
    )
    return facts.withColumn("ready", ready)
