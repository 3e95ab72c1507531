"""Joins of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def star_join(
    fact: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Attach dimension attributes for slicing (dimension filters fact, not the reverse).

    No broadcast hint: dimensions grow with the data. Adaptive execution broadcasts one whose
    measured size is small and otherwise splits the partitions of a busy key.
    """
    return fact.join(dim.select(key, *attributes), key)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key has no dimension row.

    Keys are made distinct before the join, so a busy key is one row on the wire.
    """
    missing = (
        fact.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(dim.select(key), key, "left_anti")
    )
    return missing.select(key, "n_rows")
