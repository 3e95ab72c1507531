"""Stratified folds of exactly balanced size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows that one range of hashes holds at most, about.
RANGE_ROWS = 4096


def stratified_folds(
    df: DataFrame, unique_id: str, label: str, folds: int = 5, seed: int = 42, out: str = "fold",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add a fold number 0 … folds-1; fold sizes differ by at most one row per label.

    Rows are shuffled by a hash of id and seed. Numbering a label's rows in one window would put
    nearly all rows into the task of the negative label. Instead ranges of the hash number their own
    rows and start where the ranges before them ended. The hash's first digits name the range, as many
    as the number of rows asks for, so a range keeps its size however many rows there are. Where ranges
    start is summed in two steps, by the first half of the digits and inside it.
    """
    digest = F.md5(F.concat_ws(":", F.col(unique_id).cast("string"), F.lit(str(seed))))
    # Known when the query runs: one more digit for each sixteenfold of rows.
    wanted = F.ceil(F.log(16.0, F.greatest(F.lit(16.0), F.count(F.lit(1)) / float(range_rows))))
    digits = df.agg(F.least(F.lit(16), wanted).cast("int").alias("digits")).scalar()
    dealt = df.withColumns({"_digest": digest, "_digits": digits}).withColumn(
        "_dealer", F.substring(F.col("_digest"), F.lit(1), F.col("_digits"))
    )
    sizes = dealt.groupBy(label, "_dealer").agg(F.count(F.lit(1)).alias("_size"), F.first("_digits").alias("_digits"))
    halved = sizes.withColumn("_half", F.substring(F.col("_dealer"), F.lit(1), F.ceil(F.col("_digits") / 2).cast("int")))

    def before(*by: str, order: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_size").over(frame), F.lit(0))

    halves = halved.groupBy(label, "_half").agg(F.sum("_size").alias("_size"))
    firsts = halves.select(
        F.col(label).alias("_label_of"), F.col("_half").alias("_half_of"),
        before(label, order="_half").alias("_first"),
    )
    inside = halved.withColumn("_inside", before(label, "_half", order="_dealer"))
    same_half = inside[label].eqNullSafe(firsts["_label_of"]) & (inside["_half"] == firsts["_half_of"])
    starts = inside.join(firsts, same_half).select(
        F.col(label).alias("_label"), F.col("_dealer").alias("_from"),
        (F.col("_first") + F.col("_inside")).alias("_start"),
    )
    position = F.row_number().over(
        Window.partitionBy(label, "_dealer").orderBy("_digest", unique_id)
    )
    numbered = dealt.withColumn("_position", position)
    on = numbered[label].eqNullSafe(starts["_label"]) & (numbered["_dealer"] == starts["_from"])
    return (
        numbered.join(starts, on)
        .withColumn(out, F.pmod(F.col("_start") + F.col("_position") - 1, F.lit(folds)).cast("int"))
        .drop("_digest", "_digits", "_dealer", "_position", "_label", "_from", "_start")
    )
