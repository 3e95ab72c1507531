"""Merchant category cleaning and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txn_risk.schemas import CATEGORIES


def clean_category(category: Column) -> Column:
    return F.trim(F.lower(category))


def category_flags(category: Column) -> dict[str, Column]:
    """One 0/1 column per known category plus ``cat_other``; missing counts as other."""
    clean = F.coalesce(clean_category(category), F.lit(""))
    flags = {f"cat_{name}": (clean == name).cast("int") for name in CATEGORIES}
    flags["cat_other"] = (~clean.isin(*CATEGORIES)).cast("int")
    return flags
