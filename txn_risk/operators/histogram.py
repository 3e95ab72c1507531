"""Fixed-width histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def histogram(
    df: DataFrame, value: str, width: float, by: Sequence[str] = (),
    low: float | None = None, high: float | None = None,
) -> DataFrame:
    """Rows per bucket ``[bucket, bucket + width)`` and group, with density within the group.

    ``low`` / ``high`` bound the values shown, both ends included.
    """
    inside = F.col(value).isNotNull()
    if low is not None:
        inside &= F.col(value) >= low
    if high is not None:
        inside &= F.col(value) <= high
    bucket = (F.floor(F.col(value) / width) * width).cast("double")
    counts = df.where(inside).groupBy(*by, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Totals are taken from the counted buckets, so the rows are read and shuffled once; the
    # window only sees one row per bucket.
    total = F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return counts.withColumn("density", F.col("n") / (total * width))
