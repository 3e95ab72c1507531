"""Connected components of a graph given as edges, and whole groups out of sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.words import discard, settle

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the least node reachable from it.

    Alternates "large star" and "small star": each node points its larger neighbours, then all its
    smaller ones, to its least neighbour. The number of rounds grows with the logarithm of the longest
    path. Each round is written to the shared folder, so neither lineage nor a lost executor costs more
    than a round. A node with very many neighbours is a key of a grouped minimum, which is combined
    before the shuffle, and of a join, which adaptive execution may split.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    held = settle(both.distinct(), "edges")
    last = None
    for _ in range(MOST_ROUNDS):
        ways = held.union(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("_m")).select(
            F.col("a").alias("_a"), F.least("a", "_m").alias("_m")
        )
        large = ways.join(least, ways["a"] == least["_a"]).where("b > a").select(
            F.col("b").alias("a"), F.col("_m").alias("b")
        ).where("a <> b").distinct()
        large = settle(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), "_m")
        small = large.join(least, large["a"] == least["_a"]).select(
            F.explode(F.array(F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b"))))
            .alias("e")
        ).select("e.*").where("a <> b").distinct()
        before, held = held, settle(small, "small-star")
        discard(before, large)
        state = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    roots = held.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    own = roots.select(F.col("root").alias("node"), "root").distinct()
    return roots.union(own)


def grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by ``by``: a table and the bounds of its groups."""
    carried: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(by).to_numpy()
        cut = np.flatnonzero(values[1:] != values[:-1])
        if len(cut) == 0 and (not carried or carried[-1].column(by)[-1].as_py() == values[0]):
            carried.append(batch)
            continue
        first = 0 if carried and carried[-1].column(by)[-1].as_py() != values[0] else None
        last = int(cut[-1]) + 1 if len(cut) else 0
        table = pa.Table.from_batches([*carried, *([batch.slice(0, last)] if last else [])])
        carried = [batch.slice(last)]
        if table.num_rows or first == 0:
            yield table, _bounds(table, by)
    if carried:
        table = pa.Table.from_batches(carried)
        yield table, _bounds(table, by)


def _bounds(table: pa.Table, by: str) -> np.ndarray:
    values = table.column(by).to_numpy()
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
