"""Timestamps and calendar parts. Times are wall-clock text read in the UTC session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txn_risk.schemas import DATE_TEXT, TIMESTAMP_TEXT


def parse_timestamp(text: Column) -> Column:
    """Strict: text in another shape fails the query (ANSI mode)."""
    return F.to_timestamp(text, TIMESTAMP_TEXT)


def parse_timestamp_lenient(text: Column) -> Column:
    """Text in another shape becomes null."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_TEXT))


def parse_date(text: Column, lenient: bool = False) -> Column:
    if lenient:
        return F.try_to_timestamp(text, F.lit(DATE_TEXT)).cast("date")
    return F.to_date(text, DATE_TEXT)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week_sunday1(ts: Column) -> Column:
    """1 = Sunday … 7 = Saturday, the marts' numbering."""
    return F.dayofweek(ts)


def day_of_week_monday0(ts: Column) -> Column:
    """0 = Monday … 6 = Sunday, the feature vector's numbering."""
    return F.weekday(ts)


def day_of_week_monday1(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday, the export's numbering."""
    return F.weekday(ts) + 1


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: Column) -> Column:
    """Hours 0 to 5."""
    return (F.hour(ts) <= 5).cast("int")


def month_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
