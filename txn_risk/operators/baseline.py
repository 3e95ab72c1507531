"""Mean and deviation of an amount per key, and the z-scores built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.schemas import DEFAULT_MEAN_AMOUNT, DEFAULT_STD_AMOUNT

# Deviations at or below this count as constant spending.
MIN_STD = 1e-5


def key_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, mean, std, count)``; a single row has a null deviation."""
    return df.groupBy(key).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.count(value).alias("count"),
    )


def fit_baseline(df: DataFrame, key: str = "cc_num", value: str = "amt") -> DataFrame:
    """Per-card profile; a single row's deviation is 0."""
    return key_stats(df, key, value).withColumn("std", F.coalesce("std", F.lit(0.0)))


def fit_global(df: DataFrame, value: str = "amt") -> DataFrame:
    """One row ``(global_mean, global_std)``; the deviation is 1 when it is not above 0."""
    std = F.stddev_samp(value)
    return df.agg(
        F.coalesce(F.avg(value), F.lit(DEFAULT_MEAN_AMOUNT)).alias("global_mean"),
        F.when(F.count(value) == 0, DEFAULT_STD_AMOUNT)
        .when(std > 0, std)
        .otherwise(1.0)
        .alias("global_std"),
    )


def zscore_or_null(value: Column, mean: Column, std: Column, digits: int = 4) -> Column:
    """Marts form: null where the deviation is missing or zero."""
    return F.round(F.try_divide(value - mean, F.nullif(std, F.lit(0.0))), digits)


def zscore_or_zero(value: Column, mean: Column, std: Column) -> Column:
    """Feature form: 0 where spending is constant."""
    return F.when(std > MIN_STD, F.try_divide(value - mean, std)).otherwise(0.0)


def as_profile(baseline: DataFrame, key: str = "cc_num") -> DataFrame:
    """A fitted baseline in the form :func:`zscore_from_profile` reads beside the rows."""
    return baseline.select(
        key, F.col("mean").alias("_mean"), F.col("std").alias("_std"), F.lit(True).alias("_seen")
    )


def zscore_from_profile(
    df: DataFrame, overall: DataFrame, out: str = "amt_zscore_by_customer", value: str = "amt"
) -> DataFrame:
    """Score rows that carry a left-joined profile; an unseen key uses the global baseline.

    ``overall`` is one row by construction, read as a scalar.
    """
    everyone = overall.select(F.struct("global_mean", "global_std")).scalar()
    # A seen key has no mean only if all its values are missing.
    mean = F.coalesce("_mean", "_all.global_mean")
    std = F.when(F.col("_seen"), F.col("_std")).otherwise(F.col("_all.global_std"))
    return (
        df.withColumn("_all", everyone)
        .withColumn(out, zscore_or_zero(F.col(value), mean, std))
        .drop("_mean", "_std", "_seen", "_all")
    )


def with_baseline_zscore(
    df: DataFrame, baseline: DataFrame, overall: DataFrame, out: str = "amt_zscore_by_customer",
    key: str = "cc_num", value: str = "amt",
) -> DataFrame:
    """Join the profile to the rows and score them.

    The profile grows with the number of cards, so its join carries no hint: it is broadcast only
    if its measured size is under the session's limit, else it is sorted and merged, and a busy
    card's partition is split.
    """
    joined = df.join(as_profile(baseline, key), key, "left")
    return zscore_from_profile(joined, overall, out, value)
