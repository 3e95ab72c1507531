"""One row per key.

Both forms rank within the key and keep rank 1. Spark plans a WindowGroupLimit before the shuffle,
so a task sends at most one row per key it has seen: a key with a third of all rows costs no more
than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.session import settle

_RANK = "_rank"
# Repeated keys that are few enough to go to every task, and copies of a key that one task may rank.
FEW_KEYS = 100_000
FEW_COPIES = 10_000


def _first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], total: bool
) -> DataFrame:
    # An order that leaves ties would let a re-run task pick another row. Rows that still tie after
    # the hash are equal in every column. A caller whose order is total by itself says so, which
    # keeps unused columns out of the scan.
    if not total:
        order = [*order, F.xxhash64(*df.columns)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], total: bool = False
) -> DataFrame:
    """The row with the greatest ``by``, compared in turn; nulls come last."""
    return _first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in by], total)


def first_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], total: bool = False
) -> DataFrame:
    """The row with the smallest ``by``, compared in turn; nulls come last."""
    return _first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in by], total)


def one_per_seldom_repeated(
    df: DataFrame, key: str, pick: Callable[[DataFrame], DataFrame], few_keys: int = FEW_KEYS,
    few_copies: int = FEW_COPIES,
) -> DataFrame:
    """``pick(df)``, where ``pick`` is one of the forms above over ``key``, for wide rows whose key seldom repeats.

    The forms sort whole rows before the shuffle, which is for nothing if no key is busy. So the keys alone
    are counted first, in a job of its own. Rows of unrepeated keys then pass as they are; with more than
    ``few_keys`` repeated ones all rows are shuffled before they are sorted; a key with more than
    ``few_copies`` rows has the plain form. ``df`` is read for each step and must be the same each time.
    """
    repeated = settle(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated-keys")
    n_keys, most = repeated.agg(F.count(F.lit(1)), F.max("_n")).first()
    if not n_keys:
        return df
    if n_keys > few_keys:
        return pick(df.repartition(key) if most <= few_copies else df)
    keys = F.broadcast(repeated.select(F.col(key).alias("_key")))
    same = df[key].eqNullSafe(keys["_key"])
    return df.join(keys, same, "left_anti").unionByName(pick(df.join(keys, same, "left_semi")))
