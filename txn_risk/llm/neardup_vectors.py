"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Every vector is projected onto many random directions. Two vectors of cosine ``c`` differ by a normal
deviate of variance ``2 - 2c`` on each, so they fall into a window around each other on most
projections. A few leading projections, cut into cells whose number follows the table, deal the vectors
into blocks; inside a block the other projections are sorted, each vector opens a window on each, and
pairs are counted. The least count is the one that true pairs reach with the asked recall. Pairs that
reach it are verified in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.links import components, grouped
from txn_risk.llm.words import settle

SEED = 20_24
# Standard deviations of the projections of unit vectors per cell.
CELL = 1.5
COUNTING = 24
WINDOW = 0.45
# Recall asked of each part: that a true pair shares a block somewhere, and reaches the least count.
RECALL = 0.998
BLOCK_TARGET = 400
# A block of more rows than this is dealt to several tasks.
BLOCK_LIMIT = 2_000


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def _numbers(values: list[int]) -> np.ndarray:
    return np.array(values, np.int64)


@dataclass(frozen=True)
class Plan:
    least_cosine: float
    cells: int  # leading projections that make a block
    tables: int  # independent sets of leading projections
    least_count: int

    @staticmethod
    def of(rows: int, least_cosine: float) -> "Plan":
        """Calibrated for pairs of exactly the least cosine; closer ones do better."""
        sd = math.sqrt(2 - 2 * least_cosine)
        # A cell edge falls between two projections |d| apart with chance |d| / CELL.
        same = 1 - sd * math.sqrt(2 / math.pi) / CELL
        cells = max(1, min(12, math.ceil(math.log(max(1, rows / BLOCK_TARGET)) / math.log(2.6))))
        tables = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same ** cells)))
        hit = 2 * _normal(WINDOW / sd) - 1
        reach, count = 0.0, COUNTING
        while count > 0:
            reach += math.comb(COUNTING, count) * hit ** count * (1 - hit) ** (COUNTING - count)
            if reach >= RECALL:
                break
            count -= 1
        return Plan(least_cosine, cells, tables, max(1, count))


def _directions(dimension: int, number: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, number))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]  # squares neither overflow nor vanish
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _cells(unit: np.ndarray, plan: Plan) -> np.ndarray:
    """For each vector its block in each table, as a whole number."""
    leading = unit @ _directions(unit.shape[1], plan.cells * plan.tables, SEED)
    shift = np.random.default_rng(SEED + 1).uniform(0, CELL, plan.cells * plan.tables)
    cell = np.clip(np.floor((leading + shift) / CELL), -7, 8).astype(np.int64) + 7
    out = np.zeros((len(unit), plan.tables), np.int64)
    for i in range(plan.cells):
        out = out * 16 + cell[:, i::plan.cells]
    return out


def _collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many projections of ``right`` fall into the windows around those of ``left``, per pair.

    Each projection is sorted once; a window is a stretch of that order, added as a difference. For a
    few vectors the windows are held against all of them.
    """
    if len(right) <= 64:
        return (np.abs(left[:, None, :] - right[None, :, :]) <= WINDOW).sum(axis=2)
    counts = np.zeros((len(left), len(right)), np.int16)
    rows = np.arange(len(left))
    for k in range(left.shape[1]):
        order = np.argsort(right[:, k])
        values = right[order, k]
        low = np.searchsorted(values, left[:, k] - WINDOW, "left")
        high = np.searchsorted(values, left[:, k] + WINDOW, "right")
        steps = np.zeros((len(left), len(right) + 1), np.int8)
        steps[rows, low] += 1
        steps[rows, high] -= 1
        inside = np.cumsum(steps[:, :-1], axis=1, dtype=np.int8)
        counts[:, order] += inside
    return counts


class _Forest:
    def __init__(self, n: int):
        self.of = np.arange(n)

    def find(self, i: int) -> int:
        while self.of[i] != i:
            self.of[i] = self.of[self.of[i]]
            i = self.of[i]
        return i


def _block(
    vectors: np.ndarray, cells: np.ndarray, table: int, copies: np.ndarray, side: np.ndarray, plan: Plan
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Number of vectors (copies counted) that each row links with here, and edges that connect them.

    A pair that shares an earlier table's block is left to that block.
    """
    vectors = _unit(vectors)
    count_on = vectors @ _directions(vectors.shape[1], COUNTING, SEED + 2)
    links = np.zeros(len(vectors), np.int64)
    forest, edges = _Forest(len(vectors)), []
    # A block dealt over several tasks arrives as two halves; side 2 stands for a half with itself.
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    alone = bool((side == 2).all())
    for at in range(0, len(left), 256):
        own = left[at:at + 256]
        counts = _collisions(count_on[own], count_on[right])
        good = counts >= plan.least_count
        if alone:
            good &= own[:, None] < right[None, :]
        i, j = np.nonzero(good)
        i, j = own[i], right[j]
        new = np.ones(len(i), bool)
        for t in range(table):
            new &= cells[i, t] != cells[j, t]
        i, j = i[new], j[new]
        for k in range(0, len(i), 50_000):
            a, b = i[k:k + 50_000], j[k:k + 50_000]
            linked = (vectors[a] * vectors[b]).sum(axis=1) >= plan.least_cosine
            a, b = a[linked], b[linked]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                p, q = forest.find(x), forest.find(y)
                if p != q:
                    forest.of[max(p, q)] = min(p, q)
                    edges.append((x, y))
    return links, edges


def find(
    vectors: DataFrame, least_cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their cosine, in double precision, is at least ``least_cosine``; all vectors are
    compared, of one length with another none. Equal vectors are one class, compared once and counted
    as often as they occur. A vector that is null, empty, zero or holds null or non-finite components
    links with nothing and is its own component. A null id is carried on, counts as a link of others,
    and names no component; repeated rows are vectors of their own. An empty table gives no rows; other
    columns are ignored.

    Pairs never leave a block: it emits the number of links of each row and a spanning forest. The
    index covers every row; with RECALL for blocks and for counts, a link of exactly the least cosine
    is found with a chance of at least RECALL ** 2, closer ones with more.
    """
    spark = vectors.sparkSession
    raw = F.col("embedding")
    usable = F.coalesce(
        (F.size(raw) > 0) & ~F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(raw, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(
        vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("embedding")
    ).select("vec_id", F.when(usable, raw).alias("embedding"), F.monotonically_increasing_id().alias("row"))
    rows = settle(rows, "vectors")
    classes = settle(
        rows.where("embedding is not null").groupBy("embedding").agg(
            F.min("row").alias("class"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
        ), "vector-classes",
    )
    plan = Plan.of(classes.count(), least_cosine)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for length, part in frame.groupby(frame["embedding"].map(len)):
                unit = _unit(np.stack(part["embedding"].to_numpy()))
                cells = _cells(unit, plan)
                for t in range(plan.tables):
                    yield pa.RecordBatch.from_pydict({
                        "class": pa.array(part["class"].to_numpy(), pa.int64()),
                        "copies": pa.array(part["copies"].to_numpy(), pa.int64()),
                        "embedding": pa.array(list(part["embedding"]), pa.list_(pa.float64())),
                        "cells": pa.array(list(cells), pa.list_(pa.int64())),
                        "table": pa.array([t] * len(part), pa.int32()),
                        "cell": pa.array(cells[:, t]),
                        "length": pa.array([length] * len(part), pa.int32()),
                    })

    dealt = classes.select("class", "copies", "embedding").mapInArrow(deal, (
        "class long, copies long, embedding array<double>, cells array<long>, table int, cell long, length int"
    ))
    block = ["table", "cell", "length"]
    # The plain columns give the sizes; rows in a block of their own meet nobody.
    keyed = settle(dealt, "vector-blocks")
    sizes = keyed.groupBy(*block).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(BLOCK_LIMIT)).cast("int")
    own = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    split = keyed.join(sizes.select(*block, chunks.alias("chunks")), block).withColumn("own", own)
    # Row of chunk i goes to the tasks (i, i), (i, j > i) as left side and (j < i, i) as right side.
    tasks = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "class", "copies", "embedding", "cells", "table",
        F.xxhash64(*block, F.least("own", "other"), F.greatest("own", "other")).alias("task"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, bounds in grouped(batches, "task"):
            names, copies, side, table = (rows_.column(c).to_numpy() for c in ("class", "copies", "side", "table"))
            vectors_, cells = (rows_.column(c).combine_chunks() for c in ("embedding", "cells"))
            at, flat = vectors_.offsets.to_numpy(), vectors_.values.to_numpy()
            cell = cells.values.to_numpy()[cells.offsets[0].as_py():].reshape(-1, plan.tables)
            a, b, n = [], [], []
            # Blocks whose names hash alike would come together: the table and length tell them apart, and
            # blocks of one table only add pairs to look at.
            kind = table.astype(np.int64) << 40 | np.diff(at)
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                mixed = kind[start:end].min() != kind[start:end].max()
                for k in np.unique(kind[start:end]) if mixed else kind[start:start + 1]:
                    own = np.flatnonzero(kind[start:end] == k) + start if mixed else np.arange(start, end)
                    values = np.stack([flat[at[i]:at[i + 1]] for i in own]) if mixed else (
                        flat[at[start]:at[end]].reshape(end - start, -1)
                    )
                    links, edges = _block(values, cell[own], int(table[own[0]]), copies[own], side[own], plan)
                    linked = np.flatnonzero(links)
                    a += [names[own][linked], names[own][_numbers([x for x, _ in edges])]]
                    b += [np.full(len(linked), -1), names[own][_numbers([y for _, y in edges])]]
                    n += [links[linked], np.zeros(len(edges), np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b, n)], names=["a", "b", "links"]
            )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = settle(
        tasks.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(judge, "a long, b long, links long"),
        "vector-links",
    )
    links = found.where("b = -1").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b >= 0").select("a", "b")).withColumnRenamed("node", "class")
    named = classes.join(roots, "class", "left").join(links, "class", "left").select(
        "class", "embedding", "copies", "least_id", F.coalesce("root", "class").alias("root"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    named = settle(named, "vector-components")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classed = named.join(least, "root").select("embedding", "copies", "links", "component_id")
    out = rows.where("embedding is not null").join(classed, "embedding").select(
        "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    ).unionByName(rows.where("embedding is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    ))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
