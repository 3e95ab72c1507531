"""Raw table to cleaned, typed, one-row-per-transaction staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.functions import clean_category, parse_date, parse_timestamp, parse_timestamp_lenient
from txn_risk.operators.dedup import latest_per_key, one_per_seldom_repeated

# Source name to staging name.
RENAMES = {
    "merchant": "merchant_name", "amt": "amount", "first": "first_name", "last": "last_name",
    "zip": "zip_code", "lat": "customer_lat", "long": "customer_long",
    "city_pop": "city_population", "job": "job_title", "merch_lat": "merchant_lat",
    "merch_long": "merchant_long", "trans_date_trans_time": "trans_timestamp",
    "dob": "date_of_birth",
}

# The staging contract.
STAGED = (
    "trans_num", "trans_timestamp", "unix_time", "cc_num", "merchant_name", "category", "amount",
    "first_name", "last_name", "gender", "street", "city", "state", "zip_code", "customer_lat",
    "customer_long", "city_population", "job_title", "date_of_birth", "merchant_lat",
    "merchant_long", "is_fraud", "ingested_at",
)

# White space that the warehouse's trim takes off, beyond blanks.
WHITE_SPACE = " \t\n\x0b\f\r\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_TEXT = ("merchant_name", "first_name", "last_name", "street", "city", "job_title")
_UPPER = ("gender", "state")
_WHOLE = ("unix_time", "cc_num", "zip_code", "city_population", "is_fraud")
_REAL = ("amount", "customer_lat", "customer_long", "merchant_lat", "merchant_long")


def clean(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Rename, cast, parse, trim and fold case.

    Strict by default: a value of the wrong shape fails the query. ``lenient`` makes it null.
    """
    def number(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind) if lenient else F.col(name).cast(kind)

    parse = parse_timestamp_lenient if lenient else parse_timestamp
    out: dict[str, Column] = {
        "trans_num": F.col("trans_num").cast("string"),
        "trans_timestamp": parse(F.col("trans_timestamp")),
        "date_of_birth": parse_date(F.col("date_of_birth"), lenient),
        "category": clean_category(F.col("category").cast("string")),
        "ingested_at": F.col("ingested_at"),
    }
    def trimmed(name: str) -> Column:
        return F.btrim(F.col(name).cast("string"), F.lit(WHITE_SPACE))

    out |= {c: trimmed(c) for c in _TEXT}
    out |= {c: F.upper(trimmed(c)) for c in _UPPER}
    out |= {c: number(c, "bigint") for c in _WHOLE}
    out |= {c: number(c, "double") for c in _REAL}
    renamed = raw.withColumnsRenamed(RENAMES)
    return renamed.select(*[out[c].alias(c) for c in STAGED])


def newest_copy(cleaned: DataFrame) -> DataFrame:
    """The most recently ingested record per ``trans_num``."""
    def newest(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, ["trans_num"], ["ingested_at", "trans_timestamp", "unix_time", "cc_num", "amount"])

    return one_per_seldom_repeated(cleaned, "trans_num", newest)


def stage(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Cleaned records, the most recently ingested one per ``trans_num``."""
    return newest_copy(clean(raw, lenient))
