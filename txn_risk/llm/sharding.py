"""Range sharding by sampled splitters: shards of nearly equal bytes (or rows) and gapless slots.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.llm.words import settle, unused

# Sampled keys per fine range; a range then holds its share to about 1 / sqrt(KEYS_PER_RANGE).
KEYS_PER_RANGE = 24
_UNIT = float(1 << 53)


def _unit(*columns: Column) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(_UNIT)


def _literal(values: Sequence[int], kind: str) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")").cast(f"array<{kind}>")


def splitters(keys: DataFrame, ranges: int) -> list[int]:
    """Rising values of ``h`` that cut the rows into about ``ranges`` pieces of equal weight.

    A row is drawn with a probability in proportion to its weight (a heavy one several times), so
    about ``ranges`` * KEYS_PER_RANGE keys reach the driver whatever the number of rows. A key that
    fills whole quantiles gets a range of its own.
    """
    total = keys.agg(F.sum("weight")).first()[0]
    if not total:
        return []
    share = F.col("weight") * F.lit(ranges * KEYS_PER_RANGE / total)
    drawn = F.floor(share + _unit(F.col("u"), F.lit("draw")))
    sample = (
        keys.select("h", drawn.alias("times")).where("times > 0")
        .groupBy("h").agg(F.sum("times").alias("times")).collect()
    )
    sample.sort(key=lambda r: r.h)
    step = sum(r.times for r in sample) / ranges
    cuts: set[int] = set()
    seen, due = 0, step
    for row in sample:
        before, seen = seen, seen + row.times
        if seen < due:
            continue
        cuts.add(row.h)
        if seen - before >= 2 * step and row.h < (1 << 63) - 1:
            cuts.add(row.h + 1)
        while due <= seen:
            due += step
    return sorted(cuts)


def _range_of(h: Column, cuts: Sequence[int]) -> Column:
    """How many cuts are <= h, by binary search in an array of constants."""
    if not cuts:
        return F.lit(0)
    levels = len(cuts).bit_length()
    steps = F.array(*[F.lit(1 << (levels - 1 - i)) for i in range(levels)])
    held = _literal(cuts, "bigint")

    def narrowed(low: Column, step: Column) -> Column:
        at = low + step
        return F.when((at <= len(cuts)) & (F.get(held, at - 1) <= h), at).otherwise(low)

    return F.aggregate(steps, F.lit(0), narrowed)


def shard(
    docs: DataFrame, shards: int = 16, law: str = "bytes", id_col: str = "doc_id",
    text_col: str = "text", ranges_per_shard: int = 32,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Rows lie in the order of (hash of text, hash of row). Sampled splitters cut that order into fine
    ranges; a range far above its share, which only copies of one text can fill, is subdivided by
    the row hash. Exact totals of the ranges (at most a few times ``shards * ranges_per_shard`` rows
    reach the driver) place each range, a window inside it places each row, and a row goes to the
    shard that holds the middle of its bytes. So a shard differs from its share by one row at most,
    equal texts stay next to each other, and slots are gapless.

    ``law`` is ``bytes`` (sizes nearly equal) or ``rows`` (counts at most one apart). A null text
    has size 1 and the checksum 0; a null id is carried on; repeated rows are rows of their own; an
    empty table gives no rows; other columns are ignored. Slots start at 0 in every shard that has
    rows. ``grown_shard`` is null: only a law by key defines it.
    """
    if law not in ("bytes", "rows"):
        raise ValueError("law must be 'bytes' or 'rows'")
    text = docs[text_col].cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    narrow = settle(
        docs.select(
            docs[id_col].alias("doc_id"), size.alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            # Unique per row; the table is written before anything depends on it.
            F.xxhash64(docs[id_col], F.monotonically_increasing_id()).alias("u"),
            (size if law == "bytes" else F.lit(1).cast("bigint")).alias("weight"),
        ),
        "shard-keys",
    )
    ranges = shards * ranges_per_shard
    cuts = splitters(narrow, ranges)
    keyed = narrow.withColumn("range", _range_of(F.col("h"), cuts))

    totals = {
        r.range: r.weight for r in keyed.groupBy("range").agg(F.sum("weight").alias("weight")).collect()
    }
    total = sum(totals.values())
    share = max(1, total // ranges)
    one_text = {i + 1 for i in range(len(cuts) - 1) if cuts[i + 1] == cuts[i] + 1}
    parts = [
        -(-totals.get(i, 0) // share) if i in one_text and totals.get(i, 0) > 2 * share else 1
        for i in range(len(cuts) + 1)
    ]
    base = [0, *accumulate(parts)][:-1]
    inside = F.floor(_unit(F.col("u"), F.lit("part")) * F.get(_literal(parts, "int"), F.col("range")))
    pieces = keyed.withColumn(
        "piece", F.get(_literal(base, "int"), F.col("range")) + inside.cast("int")
    )

    held = {
        r.piece: r for r in pieces.groupBy("piece").agg(
            F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows")
        ).collect()
    }
    weight_before, rows_before, weights, rows = [], [], 0, 0
    for i in range(sum(parts)):
        weight_before.append(weights)
        rows_before.append(rows)
        if i in held:
            weights, rows = weights + held[i].weight, rows + held[i].rows
    order = Window.partitionBy("piece").orderBy("h", "u")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        F.get(_literal(weight_before, "bigint"), F.col("piece"))
        + F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    at = (2 * middle + F.col("weight")) * F.lit(shards)
    placed = pieces.select(
        "doc_id", "size", "text_crc32",
        # (middle of the row) * shards / total, in whole numbers.
        F.least(F.expr(f"{shards} - 1"), F.floor(at / F.lit(2.0 * max(total, 1)))).cast("int").alias("shard"),
        (F.get(_literal(rows_before, "bigint"), F.col("piece")) + F.row_number().over(order) - 1).alias("at"),
    )
    placed = settle(placed, "shard-places")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
        (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` to one folder per shard, ordered by slot inside each file.

    Needs unique ids. Each shard is written by many tasks; their number follows the input.
    """
    name, shard_, slot = (unused(docs, c) for c in ("_id", "shard", "slot"))
    where = places.select(F.col("doc_id").alias(name), F.col("shard").alias(shard_), F.col("slot").alias(slot))
    docs.join(where, docs[id_col] == where[name]).drop(name).sortWithinPartitions(
        shard_, slot
    ).write.partitionBy(shard_).parquet(path)
