"""Running totals and quantiles over a global order, without a single-task window.

Everything follows from one counted table, one row per group and value: it is shuffled once, and every step
below reads that shuffle again. Nothing runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.functions import cents

# Pieces that the order of a group is cut into, hence the most subtotals kept per group.
PIECES = 1024
# A value's piece is looked up among every STEP-th cut first.
STEP = 32


def _on(by: Sequence[str], suffix: str) -> Column:
    """Equal groups, where the other side's group columns end in ``suffix``; null is a group. Without
    groups the other side has one row."""
    return reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(c + suffix)), by, F.lit(True))


def _renamed(by: Sequence[str], suffix: str) -> list[Column]:
    return [F.col(c).alias(c + suffix) for c in by]


def _with_pieces(counted: DataFrame, column: str, sums: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Add ``_piece``, which rises with the value, and ``all_<s>``.

    Cuts are a sample of the group's values, the one of least hash in each of ``PIECES`` hash buckets. Where they
    fall moves work between tasks, never a result; but all uses must have the same cuts, so these follow from the
    values alone. A quantile sketch would depend on the order in which parts are merged, and differ if a shuffle
    is read in another order or made again. Infinite values and NaN are the order's own ends and need no cut.
    """
    finite = F.when(~F.isnan(column) & (F.abs(F.col(column)) < float("inf")), F.col(column))
    hashed = F.xxhash64(column)
    # The hash settles to which bucket a value goes and whether it stands for it; -0.0 and 0.0 are one value.
    picked = F.min(F.when(finite.isNotNull(), F.struct(hashed.alias("hash"), (finite + 0.0).alias("value"))))
    sampled = counted.groupBy(*by, F.pmod(hashed, F.lit(PIECES)).alias("_bucket")).agg(
        picked.alias("_picked"), *[F.sum(s).alias(f"_sum_{s}") for s in sums],
    )
    # The condition makes each use of the cuts ask for all columns, so that all of them read one shuffle.
    counts = reduce(lambda a, b: a & b, [F.sum(f"_sum_{s}").isNotNull() for s in sums])
    values = F.array_sort(F.collect_list("_picked.value"))  # at most PIECES by construction
    cuts = sampled.groupBy(*by).agg(
        F.coalesce(F.when(counts, values), F.array().cast("array<double>")).alias("_cuts"),
        *[F.sum(f"_sum_{s}").alias(f"all_{s}") for s in sums],
    ).withColumn("_coarse", F.filter("_cuts", lambda _, i: i % STEP == 0))
    held = cuts.select(*_renamed(by, "_of"), "_cuts", "_coarse", *[f"all_{s}" for s in sums])
    value = F.col(column)
    joined = counted.join(held, _on(by, "_of")).withColumn("_at", F.size(F.filter("_coarse", lambda c: c <= value)))
    fine = F.size(F.filter(F.slice("_cuts", (F.col("_at") - 1) * STEP + 1, F.lit(STEP)), lambda c: c <= value))
    piece = F.when(F.col("_at") == 0, 0).otherwise((F.col("_at") - 1) * STEP + fine)
    return joined.withColumn("_piece", piece).drop("_cuts", "_coarse", "_at", *[f"{c}_of" for c in by])


def running_totals(
    counted: DataFrame, column: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False,
) -> DataFrame:
    """Add ``before_<s>`` and ``all_<s>`` per ``s`` in ``sums``: its total over the rows that come
    earlier in the order of ``column``, and over all rows of the group.

    ``counted`` must be an aggregate with one row per group and value (a double), and have no other columns
    than ``by``, ``column`` and ``sums``: all that is read below is then one shuffle. Rows are put into value
    ranges, summed inside each range by a window, and shifted by the totals of the ranges before.
    """
    counted = counted.select(*by, column, *sums)
    pieces = _with_pieces(counted, column, sums, by)

    def ordered(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    totals = pieces.groupBy(*by, "_piece").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    # At most PIECES rows per group by construction.
    frame = Window.partitionBy(*by or [F.lit(0)]).orderBy(ordered("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *_renamed(by, "_with"), F.col("_piece").alias("_piece_of"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(frame), F.lit(0)).alias(f"_off_{s}") for s in sums],
    )
    inside = Window.partitionBy(*by, "_piece").orderBy(ordered(column)).rowsBetween(Window.unboundedPreceding, -1)
    swept = pieces.select(
        "*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in sums]
    )
    out = swept.join(offsets, _on(by, "_with") & (F.col("_piece") == F.col("_piece_of")))
    before = {f"before_{s}": F.col(f"_in_{s}") + F.col(f"_off_{s}") for s in sums}
    return out.withColumns(before).drop(
        "_piece", "_piece_of", *[f"{c}_with" for c in by], *[f"_in_{s}" for s in sums], *[f"_off_{s}" for s in sums],
    )


def counted_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(…by, _value, n)``: how often each value that is not null occurs in each group."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def counted_quantiles(counted: DataFrame, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles ``(…by, quantile, value)`` of :func:`counted_values`."""
    ranked = running_totals(counted, "_value", ["n"], by)
    asked = F.array(*[F.lit(float(p)) for p in points])
    at = F.col("quantile") * (F.col("all_n") - 1)

    def holds(position: Column) -> Column:
        return (position >= F.col("before_n")) & (position < F.col("before_n") + F.col("n"))

    found = (
        ranked.withColumn("quantile", F.explode(asked))
        .withColumn("_at", at)
        .where(holds(F.floor("_at")) | holds(F.ceil("_at")))
        .groupBy(*by, "quantile")
        .agg(
            F.max("_at").alias("_at"),
            F.max(F.when(holds(F.floor("_at")), F.col("_value"))).alias("_low"),
            F.max(F.when(holds(F.ceil("_at")), F.col("_value"))).alias("_high"),
        )
    )
    part = F.col("_at") - F.floor("_at")
    return found.select(
        *by, "quantile", (F.col("_low") + part * (F.col("_high") - F.col("_low"))).alias("value")
    )


def quantiles(
    df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: ``(…by, quantile, value)``.

    Equal values are counted first, then ranked by running totals. The built-in exact percentile
    would gather every distinct value of a group in one buffer.
    """
    return counted_quantiles(counted_values(df, value, by), points, by)


def distribution(
    df: DataFrame, value: str, points: dict[str, float], by: Sequence[str] = (), deviation: bool = False,
) -> DataFrame:
    """``(…by, n, mean, min, max, …points[, std])`` of a two-decimal value per group, from one scan.

    The mean is exact; the sample deviation takes squared distances from it, so it does not cancel.
    """
    counted = counted_values(df, value, by)
    total = F.sum(cents(F.col("_value")) * F.col("n")) / 100.0
    out = counted.groupBy(*by).agg(
        F.sum("n").alias("n"), F.try_divide(total, F.sum("n").cast("double")).alias("mean"),
        F.min("_value").alias("min"), F.max("_value").alias("max"),
    )
    named = counted_quantiles(counted, list(points.values()), by).groupBy(*by).agg(*[
        F.max(F.when(F.col("quantile") == p, F.col("value"))).alias(n) for n, p in points.items()
    ])
    parts = [named]
    if deviation:
        from_mean = counted.join(out.select(*_renamed(by, "_of"), F.col("mean"), F.col("n").alias("_n")), _on(by, "_of"))
        squares = F.sum(F.col("n") * F.pow(F.col("_value") - F.col("mean"), F.lit(2)))
        parts.append(from_mean.groupBy(*by).agg(
            F.sqrt(F.try_divide(squares, (F.max("_n") - 1).cast("double"))).alias("std")
        ))
    for part in parts:
        own = [c for c in part.columns if c not in by]
        out = out.join(part.select(*_renamed(by, "_of"), *own), _on(by, "_of")).drop(*[f"{c}_of" for c in by])
    return out
