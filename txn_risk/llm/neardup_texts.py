"""N-gram Jaccard join on an R-tree of count vectors.

A document is the set of its word shingles. The shingles are hashed into GROUPS groups; the numbers per
group are a point, and two documents share at most the sum of the coordinates' minima. R-trees over
points with the coordinatewise maxima of their nodes prune whole subtrees by that bound; pairs that
survive are verified on the sets.

A tree over all documents would sit in one task. So documents are dealt first, without losing a link:
in one order of all shingles, two sets of similarity t share a shingle among the first
n - ceil(t n) + 1 of each, so each of those leads to a small tree of the documents that have it.
Shingles found often in a bounded sample come last in that order; any order keeps every link.

Pairs never leave a task. Trees first tell which documents of a group have a partner left; those bring
their sets, are verified there, and a group gives the links that join its components, no more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.links import components, grouped
from txn_risk.llm.words import discard, of_keys, settle, text_key, texts, unused

GROUPS = 64
LEAF = 24
# Documents whose shingles tell which are frequent, the number of them that makes one frequent, and the
# share of their shingles that is looked at, in the order of hashes: more than any prefix reaches, as
# prefixes pass over frequent ones.
SAMPLE_DOCS = 20_000
FREQUENT = 8
LOOKED_AT = 40
# A group of more documents, or of more shingles in their sets, is dealt over several tasks.
GROUP_LIMIT = 4_096
GROUP_SHINGLES = 1 << 22

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _Q
    h = (h ^ (h >> np.uint64(29))) * _P
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set of a text's shingles as rising 64-bit hashes.

    Words are what stands between ASCII white space, A-Z lower-cased; ``width`` words make a shingle,
    fewer words one as a whole; no word makes none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        h = _mixed(h + hashes[i:i + len(h)])
    return np.unique(h)


def needed(a, b, percent: int):
    """Least shared number for 100 * shared >= percent * union: shared >= percent (a + b) / (100 + percent)."""
    return -((-percent * (a + b)) // (100 + percent))


def _point(h: np.ndarray) -> bytes:
    """Counts per group in units that fit a byte, rounded up so that minima stay bounds; then the unit."""
    counts = np.bincount((h >> np.uint64(64 - GROUPS.bit_length() + 1)).astype(np.int64), minlength=GROUPS)
    unit = max(1, -(-int(counts.max()) // 255))
    return (-(-counts // unit)).astype(np.uint8).tobytes() + np.uint32(unit).tobytes()


def _points(raw: list[bytes]) -> np.ndarray:
    table = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, GROUPS + 4)
    unit = np.ascontiguousarray(table[:, GROUPS:]).view("<u4").astype(np.int64)
    return table[:, :GROUPS].astype(np.int64) * unit


def describe(
    docs: DataFrame, width: int, percent: int, frequent: np.ndarray, id_col: str, text_col: str
) -> DataFrame:
    """``(doc_id, key, n, point, prefix)`` for each row."""
    source = texts(docs, id_col, text_col).select("doc_id", text_key(F.col("text")).alias("key"), "text")
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, points, prefixes = [], [], []
                for text in part.column(2).to_pylist():
                    h = shingles(text, width)
                    n.append(len(h))
                    points.append(_point(h) if len(h) else None)
                    length = len(h) + (-percent * len(h)) // 100 + 1 if len(h) else 0
                    if len(last) and length:
                        late = last[np.minimum(np.searchsorted(last, h), len(last) - 1)] == h
                        h = np.concatenate([h[~late][:length], h[late][:length]])
                    prefixes.append(h[:length].view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(n, pa.int32()), pa.array(points, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ], names=["doc_id", "key", "n", "point", "prefix"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(read, f"doc_id {kind}, key binary, n int, point binary, prefix array<long>")


def frequent_shingles(docs: DataFrame, width: int, id_col: str, text_col: str) -> np.ndarray:
    """Shingles found in at least FREQUENT of a sample of about SAMPLE_DOCS documents.

    Only steers how work is dealt. At most LOOKED_AT percent of the sample's shingles, divided by FREQUENT.
    """
    total = docs.count()
    rate = min(1.0, SAMPLE_DOCS / max(1, total))
    some = docs.where(F.pmod(F.xxhash64(text_col, F.lit("sample")), F.lit(1 << 20)) < int(rate * (1 << 20)))
    counted = describe(some, width, 100 - LOOKED_AT, np.zeros(0, np.uint64), id_col, text_col).dropDuplicates(
        ["key"]
    ).select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    return np.sort(np.array(
        [r.shingle for r in counted.where(F.col("n") >= FREQUENT).collect()], np.int64
    ).view(np.uint64))


class CountTree:
    """R-tree over count points, packed by halving the widest coordinate.

    Node k covers ``order[start[k]:end[k]]``; ``top[k]`` has the coordinatewise maxima, ``least[k]`` and
    ``most[k]`` the range of set sizes.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = np.arange(len(sizes))
        self.start, self.end, self.child, self.top, self.least, self.most = [], [], [], [], [], []
        self._build(0, len(sizes))

    def _build(self, start: int, end: int) -> int:
        own = self.order[start:end]
        k = len(self.start)
        self.start.append(start)
        self.end.append(end)
        self.child.append(None)
        self.top.append(self.points[own].max(axis=0))
        self.least.append(int(self.sizes[own].min()))
        self.most.append(int(self.sizes[own].max()))
        if end - start > LEAF:
            values = np.column_stack([self.points[own], self.sizes[own]])
            widest = int(np.argmax(values.max(axis=0) - values.min(axis=0)))
            middle = (end - start) // 2
            self.order[start:end] = own[np.argpartition(values[:, widest], middle)]
            self.child[k] = (self._build(start, start + middle), self._build(start + middle, end))
        return k

    def pairs(self, percent: int, other: CountTree | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of point numbers whose bound reaches what a link needs, in arrays.

        With itself, each unordered pair once; with another tree, each pair of its points and ours.
        """
        tree = other or self
        stack = [(0, 0)]
        while stack:
            x, y = stack.pop()
            least = self.least[x] + tree.least[y]
            bound = np.minimum(self.top[x], tree.top[y]).sum()
            far = max(self.least[x] - tree.most[y], tree.least[y] - self.most[x])
            if bound < needed(self.least[x], tree.least[y], percent) or (
                far > 0 and 100 * min(self.most[x], tree.most[y]) < percent * max(self.least[x], tree.least[y])
            ):
                continue
            a, b = self.child[x], tree.child[y]
            if a is None and b is None:
                i, j = self.order[self.start[x]:self.end[x]], tree.order[tree.start[y]:tree.end[y]]
                shared = np.minimum(self.points[i][:, None, :], tree.points[j][None, :, :]).sum(axis=2)
                good = shared >= needed(self.sizes[i][:, None], tree.sizes[j][None, :], percent)
                if other is None and x == y:
                    good &= i[:, None] < j[None, :]
                p, q = np.nonzero(good)
                if len(p):
                    yield i[p], j[q]
            elif other is None and x == y:
                stack += [(a[0], a[0]), (a[0], a[1]), (a[1], a[1])]
            elif b is None or a is not None and self.end[x] - self.start[x] >= tree.end[y] - tree.start[y]:
                stack += [(a[0], y), (a[1], y)]
            else:
                stack += [(x, b[0]), (x, b[1])]


def _stars(percent: int):
    """First look at rows that carry their group's least document: that is paired with those its bound allows.

    Emits those pairs, and the rows of groups of three or more, where other pairs are still open. Each
    batch is done with by itself, however large its groups are.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, n, head, n_head, size = (
                batch.column(c).to_numpy().astype(np.int64) for c in ("rid", "n", "head_rid", "head_n", "m")
            )
            point = batch.column("point")
            shared = np.minimum(
                _points(point.to_pylist()), _points(batch.column("head_point").to_pylist())
            ).sum(axis=1)
            good = (shared >= needed(n, n_head, percent)) & (rid != head)
            open_ = size >= 3
            yield pa.RecordBatch.from_pydict({
                "shingle": pa.array(np.concatenate([head[good], batch.column("shingle").to_numpy()[open_]])),
                "rid": pa.array(np.concatenate([rid[good], rid[open_]])),
                "n": pa.array(np.concatenate([np.full(good.sum(), -1), n[open_]]).astype(np.int32)),
                "point": pa.array([None] * int(good.sum()) + point.filter(pa.array(open_)).to_pylist(), pa.binary()),
                "head": pa.array(np.concatenate([np.zeros(good.sum(), bool), (rid == head)[open_]])),
            })

    return read


def _met(values: np.ndarray, weights: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray, low: np.ndarray):
    """Per pair of rows: whether they meet in a group before ``low``, and how many leading shingles they share.

    Row k's groups are ``values[starts[k]:starts[k + 1]]``, with the number of shingles each stands for.
    """
    def held(rows):
        at = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in rows.tolist()])
        return np.repeat(np.arange(len(rows)), starts[rows + 1] - starts[rows]), at

    one, i = np.unique(a, return_inverse=True)
    two, j = np.unique(b, return_inverse=True)
    (row_x, x), (row_y, y) = held(one), held(two)
    both = np.intersect1d(values[x], values[y])
    if not len(both):
        return np.zeros(len(a), bool), np.zeros(len(a), np.int64)

    def matrix(n_rows, row, at, number):
        column = np.minimum(np.searchsorted(both, values[at]), len(both) - 1)
        good = both[column] == values[at]
        table = np.zeros((n_rows, len(both)))
        table[row[good], column[good]] = number[at[good]]
        return table

    left, right = matrix(len(one), row_x, x, weights), matrix(len(two), row_y, y, np.ones_like(weights))
    earlier = np.zeros(len(a), bool)
    for value in np.unique(low).tolist():
        k = int(np.searchsorted(both, value))
        own = low == value
        earlier[own] = ((left[:, :k] @ right[:, :k].T)[i, j] > 0)[own]
    return earlier, (left @ right.T)[i, j].astype(np.int64)


class _Rows:
    """Columns of rows that meet in trees, and the pairs of a task that are to be verified in it."""

    def __init__(self, table: pa.Table):
        self.rid, self.root, self.head, self.side, self.group = (
            table.column(c).to_numpy() for c in ("rid", "root", "head", "side", "shingle")
        )
        self.points = _points(table.column("point").to_pylist())
        self.sizes = table.column("n").to_numpy().astype(np.int64)
        meets, weights = (table.column(c).combine_chunks() for c in ("meets", "weights"))
        self.meets, self.weights = meets.flatten().to_numpy(), weights.flatten().to_numpy().astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(meets.value_lengths().to_numpy())])

    def candidates(
        self, start: int, end: int, percent: int, label: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different ``label`` that the trees let pass, neither of them the head.

        A pair is left to the least of the groups that it meets in. What two documents share is shared by
        their leading shingles or lies beyond those of one of them, so few shared leading ones rule it out.
        The caller may join labels between two yields.
        """
        own = np.arange(start, end)
        left, right = own[self.side[own] != 1], own[self.side[own] != 0]
        if not len(left) or not len(right):
            return
        tree = CountTree(self.points[left], self.sizes[left])
        alone = bool((self.side[own] == 2).all())
        other = None if alone else CountTree(self.points[right], self.sizes[right])
        for i, j in tree.pairs(percent, other):
            a, b = left[i], (left if alone else right)[j]
            good = (label[a] != label[b]) & ~self.head[a] & ~self.head[b]
            a, b = a[good], b[good]
            if not len(a):
                continue
            earlier, shared = _met(
                self.meets, self.weights, self.starts, a, b, np.minimum(self.group[a], self.group[b])
            )
            beyond = -((-percent * np.maximum(self.sizes[a], self.sizes[b])) // 100) - 1
            good = ~earlier & (shared + beyond >= needed(self.sizes[a], self.sizes[b], percent))
            if good.any():
                yield a[good], b[good]


def _live(percent: int):
    """Rows of each task that some pair of it still needs: those alone have to bring their sets."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, "task"):
            rows, live = _Rows(table), np.zeros(table.num_rows, bool)
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                for a, b in rows.candidates(start, end, percent, rows.root):
                    live[a] = live[b] = True
            yield from table.filter(pa.array(live)).to_batches()

    return read


def _trees(percent: int):
    """Links that join what is not joined yet, verified on the sets in the task: per group of m rows at most m - 1."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, "task"):
            rows, label, sets = _Rows(table), table.column("root").to_numpy().copy(), table.column("shingles")
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = [np.frombuffer(x.as_buffer(), np.uint64) for x in sets.slice(start, end - start)]
                part, found = label[start:end], []
                for a, b in rows.candidates(start, end, percent, label):
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        if label[x] != label[y] and _linked(own[x - start], own[y - start], percent):
                            part[part == label[x]] = label[y]
                            found.append((rows.rid[x], rows.rid[y]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(x, np.int64)) for x in zip(*found, strict=True)], names=["a", "b"]
                    )

    return read


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * shared >= percent * union for two sets, both rising and not empty."""
    if len(x) > len(y):
        x, y = y, x
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link, by their sets."""
    one = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("y"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"]
            )

    return pairs.join(one, "a").join(two, "b").mapInArrow(read, "a long, b long")


def link_classes(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: per row ``(doc_id, key, n)``; per distinct text ``(key, rid, least_id, root)``."""
    spark = docs.sparkSession
    frequent = frequent_shingles(docs, width, id_col, text_col)
    described = settle(describe(docs, width, percent, frequent, id_col, text_col), "shingle-prefixes")
    classes = settle(
        described.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("point").alias("point"),
            F.first("prefix").alias("prefix"),
        ).withColumn("rid", F.monotonically_increasing_id()), "text-classes",
    )
    rows = settle(described.select("doc_id", "key", "n"), "shingle-rows")
    discard(described)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The least document of a shingle is a minimum combined before the shuffle; rows meet it in a join that
    # adaptive execution may split, so no task has to hold the documents of a shingle.
    entries = classes.select(F.explode("prefix").alias("shingle"), "rid")
    points = classes.select("rid", "n", "point")
    heads = entries.groupBy("shingle").agg(
        F.min("rid").alias("head_rid"), F.count(F.lit(1)).alias("m")
    ).where("m > 1").join(points.toDF("head_rid", "head_n", "head_point"), "head_rid")
    looked = settle(
        entries.join(heads, "shingle").join(points, "rid").mapInArrow(
            _stars(percent), "shingle long, rid long, n int, point binary, head boolean"
        ), "first-look",
    )
    stars = looked.where("n < 0").select(F.col("shingle").alias("a"), F.col("rid").alias("b")).distinct()
    stars = settle(stars, "star-pairs")
    open_rows = looked.where("n > 0")

    source = texts(docs, id_col, text_col).select(text_key(F.col("text")).alias("key"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([shingles(t, width).tobytes() for t in part.column(1).to_pylist()], pa.binary()),
                ], names=["rid", "shingles"])

    def sets_of(asked: DataFrame) -> DataFrame:
        """The sets of the documents in ``asked(rid)``, made anew from their texts: few texts, not all sets."""
        names = classes.select("rid", "key").join(asked.distinct(), "rid", "left_semi")
        found = of_keys(source, names).join(names, "key").dropDuplicates(["key"]).select("rid", "text")
        return settle(found.mapInArrow(read, "rid long, shingles binary"), "shingle-sets")

    sets = sets_of(stars.select(F.col("a").alias("rid")).union(stars.select(F.col("b").alias("rid"))))
    edges = settle(_verified(stars, sets, percent), "star-links")
    roots = components(edges).withColumnRenamed("node", "rid")
    labelled = open_rows.join(roots, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    labelled = settle(labelled, "open-rows")
    discard(looked)
    # Pairs of one component are done with, so groups of one component are. Of groups with the same members
    # the one of the least shingle stays for all of them.
    chunks = F.greatest(F.ceil(F.col("m") / F.lit(GROUP_LIMIT)), F.ceil(F.col("volume") / F.lit(GROUP_SHINGLES)))
    sizes = labelled.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("m"), F.min("root").alias("low_root"), F.max("root").alias("high_root"),
        F.sum("n").alias("volume"), F.bit_xor(F.xxhash64("rid")).alias("x"),
        F.bit_xor(F.xxhash64("rid", F.lit("members"))).alias("y"),
    ).where("low_root <> high_root").groupBy("m", "x", "y").agg(
        F.min("shingle").alias("shingle"), F.count(F.lit(1)).cast("int").alias("weight"),
        F.first("volume").alias("volume"),
    ).select("shingle", "weight", chunks.cast("int").alias("chunks"))
    still = settle(labelled.join(sizes, "shingle"), "open-groups")
    lists = still.groupBy("rid").agg(F.collect_list(F.struct("shingle", "weight")).alias("_met")).select(
        "rid", F.col("_met.shingle").alias("meets"), F.col("_met.weight").alias("weights")
    )
    own = F.pmod(F.xxhash64("rid"), F.col("chunks")).cast("int")
    tasks = still.join(lists, "rid").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    ).select(
        "shingle", "rid", "n", "point", "head", "root", "meets", "weights",
        # Tasks of equal hash are looked at together, which adds pairs to verify and loses none.
        F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    shape = (
        "shingle long, rid long, n int, point binary, head boolean, root long, meets array<long>, "
        "weights array<int>, task long, side int"
    )
    live = settle(
        tasks.repartition(parts, "task").sortWithinPartitions("task", "rid").mapInArrow(_live(percent), shape),
        "live-rows",
    )
    discard(sets)
    sets = sets_of(live.select("rid"))
    more = settle(
        live.join(sets, "rid").repartition(parts, "task").sortWithinPartitions("task", "rid").mapInArrow(
            _trees(percent), "a long, b long"
        ), "tree-links",
    )
    roots = components(edges.unionByName(more)).withColumnRenamed("node", "rid")
    linked = settle(classes.select("key", "rid", "least_id").join(roots, "rid", "left").withColumn(
        "root", F.coalesce("root", "rid")
    ), "linked-classes")
    discard(classes, stars, sets, edges, labelled, still, live, more)
    return rows, linked


def join(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Two documents link when 100 * shared >= ``percent`` * union of their sets of ``width``-word shingles
    (fewer words: the whole sequence). ``component_id`` is the least id reachable by links, itself
    included. Equal texts are one class and link with each other. A null text, or one without words, has
    an empty set and is its own component. A null id is carried on and names no component; a component
    of null ids alone has a null id. Repeated rows give repeated results; an empty table gives no rows;
    other columns are ignored.

    No link is lost and none is invented but for equal 64-bit hashes of different shingles.
    """
    rows, classes = link_classes(docs, width, percent, id_col, text_col)
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "root").select("key", "component_id")
    linked = rows.where("n > 0").join(named, "key").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id"
    )
    return linked.unionByName(rows.where("n = 0").select(
        "doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id")
    ))


def without_near_copies(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component stays, the one with the least id (a known one before null, then the
    least text key); all columns stay. Rows equal in id and text are one document. Documents without
    words all stay."""
    rows, classes = link_classes(docs, width, percent, id_col, text_col)
    best = classes.groupBy("root").agg(
        F.min(F.struct(F.col("least_id").isNull().alias("unnamed"), "least_id", "key")).alias("best")
    ).select(F.col("best.key").alias("_best"), F.col("best.least_id").alias("_least"))
    wordless = rows.where("n = 0").select(F.col("key").alias("_empty")).distinct()
    key = unused(docs, "_key")
    keyed = docs.withColumn(key, text_key(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    kept = keyed.join(best, (keyed[key] == best["_best"]) & keyed[id_col].eqNullSafe(best["_least"])).select(
        *[keyed[c] for c in keyed.columns]
    ).dropDuplicates([key])
    blank = keyed.join(wordless, keyed[key] == wordless["_empty"], "left_semi")
    return kept.drop(key).unionByName(blank.drop(key))
