"""Text forms for people: masked card numbers and formatted figures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mask_card(cc_num: Column, filler: str = "..") -> Column:
    """First four and last four digits."""
    digits = cc_num.cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit(filler), F.right(digits, F.lit(4)))


def as_percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def as_usd(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def as_km(distance: Column) -> Column:
    return F.format_string("%.1f km", distance)


def as_ms(latency: Column) -> Column:
    return F.format_string("%.2f ms", latency)
