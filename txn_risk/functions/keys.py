"""Surrogate keys and names. Both keys hash cleaned fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def customer_key(cc_num: Column) -> Column:
    return F.md5(cc_num.cast("string"))


def merchant_key(name: Column, category: Column) -> Column:
    return F.md5(F.concat(name, F.lit("_"), category))


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is."""
    return F.concat(first, F.lit(" "), last)
