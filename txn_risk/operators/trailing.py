"""How many earlier events a key had in the horizon before each event.

A window ``partitionBy(key).orderBy(time).rangeBetween(-h, -1)`` says the same in one line, but it
sends every row of a key to one task and recomputes the frame for each row, which is quadratic for
a busy key. Here each (key, second) is counted first, with map-side combine. Every such count
*enters* the trailing window at its second and *leaves* it one horizon later. Time is cut into
slots; an event leaves in its own slot or is carried into the next, so a slot can be swept alone:

    count(t) = carried into t's slot + entered in it before t - left in it before t

A slot holds at most two rows per second of its length however many events a key has, and the
sweep is a running sum, linear in those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.schemas import DAY_SECONDS

TRAILING = "n_trailing"
SLOT_SECONDS = 7 * DAY_SECONDS


def trailing_counts(
    df: DataFrame, key: str, at: str, horizon: int = DAY_SECONDS, slot: int | None = None
) -> DataFrame:
    """One row ``(key, at, n_trailing)`` per distinct second of a key.

    ``n_trailing`` counts events in ``[at - horizon, at - 1]``; events of the same second do not
    count. Events without a time are peers of each other only, as in an SQL range frame.

    ``slot`` (a week, at least the horizon) moves work between tasks, never a result: longer slots
    carry fewer events over, shorter ones spread a busy key wider.
    """
    slot = max(horizon, slot or SLOT_SECONDS)

    def start(t: Column) -> Column:
        return t - F.pmod(t, F.lit(slot))

    per_second = df.groupBy(key, at).agg(F.count(F.lit(1)).alias("_n"))
    second, n, none = F.col(at), F.col("_n"), F.lit(0)
    leaves = second + horizon
    carried = F.when(start(leaves) > start(second), n).otherwise(none)
    moves = F.array(
        F.struct(second.alias("t"), n.alias("enter"), none.alias("leave"), none.alias("carry")),
        F.struct(leaves.alias("t"), none.alias("enter"), n.alias("leave"), carried.alias("carry")),
    )
    swept = per_second.select(key, F.inline(moves))
    ordered = Window.partitionBy(key, start(F.col("t"))).orderBy("t")
    whole = ordered.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ordered.rangeBetween(Window.unboundedPreceding, -1)
    count = F.sum("carry").over(whole) + F.coalesce(
        F.sum(F.col("enter") - F.col("leave")).over(before), F.lit(0)
    )
    return (
        swept.withColumn(TRAILING, F.when(F.col("t").isNull(), F.col("enter")).otherwise(count))
        .where(F.col("enter") > 0)
        .select(key, F.col("t").alias(at), TRAILING)
    )


def attach_by_second(df: DataFrame, profile: DataFrame, key: str, at: str) -> DataFrame:
    """Inner-join a per-(key, second) profile back to the rows it was made from.

    The shuffle hashes both columns, so a busy key spreads over its seconds.
    """
    right = profile.withColumnsRenamed({key: "_key", at: "_at"})
    on = (df[key] == right["_key"]) & df[at].eqNullSafe(right["_at"])
    return df.join(right, on).drop("_key", "_at")


def _with_per_key(profile: DataFrame, per_key: DataFrame | None, key: str) -> DataFrame:
    """Join columns known per key to the narrow profile, not to the rows themselves: the rows are
    then shuffled once for both."""
    return profile if per_key is None else profile.join(per_key, key, "left")


def with_trailing_count(
    df: DataFrame, key: str, at: str, out: str, horizon: int = DAY_SECONDS,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Strict form: events of the same second are not counted.

    ``per_key`` (one row per key) is left-joined on the way.
    """
    profile = trailing_counts(df, key, at, horizon).withColumnRenamed(TRAILING, out)
    return attach_by_second(df, _with_per_key(profile, per_key, key), key, at)


def tie_share(unique_id: str) -> Column:
    """Evenly spread part number of a row, from a hash both engines know."""
    return F.substring(F.md5(F.col(unique_id).cast("string")), 1, 2)


def with_trailing_rank(
    df: DataFrame, key: str, at: str, unique_id: str, out: str, horizon: int = DAY_SECONDS,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Rank form: of events in the same second, those sorted earlier count as well.

    Ties are ordered by ``(tie_share, unique_id)``. The rank is the number of tied rows in earlier
    shares plus the row number inside the share, so even a second that holds a large part of all
    rows is ranked by up to 256 tasks.
    """
    shared = df.withColumn("_share", tie_share(unique_id))
    per_share = shared.groupBy(key, at, "_share").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key, at).orderBy("_share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_share.select(
        key, at, "_share", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    counts = _with_per_key(trailing_counts(df, key, at, horizon), per_key, key)
    profile = attach_by_second(offsets, counts, key, at)
    right = profile.withColumnsRenamed({key: "_key", at: "_at", "_share": "_part"})
    on = (
        (shared[key] == right["_key"])
        & shared[at].eqNullSafe(right["_at"])
        & (shared["_share"] == right["_part"])
    )
    within = Window.partitionBy(key, at, "_share").orderBy(unique_id)
    return (
        shared.join(right, on)
        .withColumn(
            out, F.col(TRAILING) + F.col("_offset") + F.row_number().over(within) - 1
        )
        .drop("_key", "_at", "_part", "_share", "_offset", TRAILING)
    )
