"""Numbers: money sums, ratios, logs and coercion of dirty input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def cents(value: Column) -> Column:
    """A two-decimal value as whole hundredths."""
    return F.rint(value * 100).cast("bigint")


def exact_sum(value: Column) -> Column:
    """Sum of two-decimal values; null when nothing was summed.

    Hundredths are summed as integers: unlike a sum of doubles it is the same for any partitioning
    and order of rows, and it is several times cheaper than a sum of decimals. It holds totals up
    to 9e16 and fails beyond.
    """
    return F.sum(cents(value)) / 100.0


def exact_avg(value: Column) -> Column:
    """Mean over the non-null values from an exact sum; null when there are none."""
    return F.try_divide(exact_sum(value), F.count(value).cast("double"))


def exact_mean_place(value: Column) -> Column:
    """Mean coordinate to nine decimals, exact likewise; decimals, as integers would overflow."""
    total = F.sum(value.cast("decimal(18,9)")).cast("double")
    return F.try_divide(total, F.count(value).cast("double"))


def ratio(a: Column, b: Column, otherwise: float | None = None) -> Column:
    """a / b; null on a zero or missing divisor, or ``otherwise`` if given."""
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return out if otherwise is None else F.coalesce(out, F.lit(float(otherwise)))


def log1p_floor0(value: Column) -> Column:
    """log(1 + x) with negatives taken as zero; null stays null."""
    return F.when(value.isNotNull(), F.log1p(F.greatest(F.lit(0.0), value.cast("double"))))


def coerce_double(value: Column) -> Column:
    """Number or 0.0 when the value is missing or not a number."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def coerce_int(value: Column) -> Column:
    """Whole part of a number, or 0."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))
