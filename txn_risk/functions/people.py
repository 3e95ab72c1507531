"""Card-holder attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def age_by_year(dob: Column, as_of: Column) -> Column:
    """Difference of calendar years, as the customer dimension counts it."""
    return (F.year(as_of) - F.year(dob)).cast("long")


def age_at(ts: Column, dob: Column) -> Column:
    """Whole 365.25-day years between birth and the transaction, never negative."""
    years = F.floor(F.datediff(ts.cast("date"), dob) / 365.25)
    return F.when(years.isNotNull(), F.greatest(F.lit(0), years)).cast("double")


def age_group(age: Column) -> Column:
    """Report bands; a missing age has no band."""
    return (
        F.when(age < 25, "< 25")
        .when(age <= 35, "25 - 35")
        .when(age <= 50, "36 - 50")
        .when(age <= 65, "51 - 65")
        .when(age > 65, "> 65")
    )


def gender_code(gender: Column) -> Column:
    """1 for M in either case, else 0 (missing included)."""
    return F.when(F.upper(gender) == "M", 1).otherwise(0)
