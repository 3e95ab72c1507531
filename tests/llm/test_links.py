"""Near duplicates and components against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.rows import BASE, documents, frame
from txn_risk.llm import neardup_texts, neardup_vectors
from txn_risk.llm.links import components


def test_components_of_paths_stars_and_pairs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (900, 3)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    linked = {frozenset(e) for e in edges}
    want = brute.grouped(nodes, lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(zip(nodes, want, strict=True))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_family(rng, size):
    words = BASE.split() * 3
    out = []
    for i in range(size):
        own = [w + str(k) for k, w in enumerate(words)]
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("width,percent,frequent,limit", [(4, 85, 8, 4096), (5, 80, 2, 20), (4, 85, 10 ** 6, 7)])
def test_jaccard_join_matches_all_pairs(spark, monkeypatch, width, percent, frequent, limit):
    monkeypatch.setattr(neardup_texts, "FREQUENT", frequent)
    monkeypatch.setattr(neardup_texts, "GROUP_LIMIT", limit)
    rng = random.Random(4)
    rows = documents() + [(2000 + i, t) for i, t in enumerate(near_family(rng, 60))]
    sizes, least = brute.jaccard_components(rows, width, percent)
    want = [(i, n, i if n == 0 else c) for (i, _), n, c in zip(rows, sizes, least, strict=True)]
    got = neardup_texts.join(frame(spark, rows), width, percent).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_document_of_each_component_stays(spark):
    rows = documents()
    sizes, least = brute.jaccard_components(rows, 5, 80)
    kept = neardup_texts.without_near_copies(frame(spark, rows), 5, 80)
    got = sorted(repr((r.doc_id, r.text)) for r in kept.select("doc_id", "text").collect())
    linked = {repr((i, t)) for (i, t), n, c in zip(rows, sizes, least, strict=True) if n and i == c}
    blank = [repr((i, t)) for (i, t), n in zip(rows, sizes, strict=True) if not n]
    assert got == sorted([*linked, *blank])
    assert set(kept.columns) == set(frame(spark, rows).columns)
    assert neardup_texts.join(frame(spark, [])).count() == 0


def test_tree_keeps_every_pair_within_its_bound():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(0, 9, (150, 16)), rng.integers(20, 40, (150, 16))])
    sizes = points.sum(axis=1)
    want = {
        (i, j) for i in range(300) for j in range(i)
        if np.minimum(points[i], points[j]).sum() >= neardup_texts.needed(sizes[i], sizes[j], 85)
        and 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j])
    }
    tree = neardup_texts.CountTree(points, sizes)
    got = {(max(i, j), min(i, j)) for a, b in tree.pairs(85) for i, j in zip(a.tolist(), b.tolist())}
    assert want <= got and all(
        np.minimum(points[i], points[j]).sum() >= neardup_texts.needed(sizes[i], sizes[j], 85) for i, j in got
    )
    left, right = np.arange(140), np.arange(140, 300)
    two = neardup_texts.CountTree(points[left], sizes[left]).pairs(85, neardup_texts.CountTree(points[right], sizes[right]))
    across = {(right[j], left[i]) for a, b in two for i, j in zip(a.tolist(), b.tolist())}
    assert {(i, j) for i, j in want if j < 140 <= i} <= across


def test_first_look_holds_no_more_than_a_batch():
    rng = random.Random(6)
    texts = near_family(rng, 300)
    sets = [neardup_texts.shingles(t, 4) for t in texts]
    points, sizes = [neardup_texts._point(h) for h in sets], [len(h) for h in sets]
    pulled = []

    def batches():
        for at in range(0, 300, 100):
            pulled.append(at)
            yield pa.RecordBatch.from_pydict({
                "shingle": pa.array([7] * 100), "rid": pa.array(range(at, at + 100)),
                "n": pa.array(sizes[at:at + 100], pa.int32()), "point": pa.array(points[at:at + 100]),
                "head_rid": pa.array([0] * 100), "head_n": pa.array(sizes[:1] * 100, pa.int32()),
                "head_point": pa.array(points[:1] * 100), "m": pa.array([300] * 100),
            })

    pairs, opened = set(), []
    for k, batch in enumerate(neardup_texts._stars(50)(batches())):
        assert len(pulled) == k + 1 and batch.num_rows <= 200
        for row in batch.to_pylist():
            if row["n"] < 0:
                pairs.add((row["shingle"], row["rid"]))
            else:
                opened.append(row["rid"])
                assert row["head"] == (row["rid"] == 0)
    assert len(pulled) == 3 and opened == list(range(300))
    linked = {j for j in range(1, 300) if len(np.intersect1d(sets[0], sets[j])) >= neardup_texts.needed(
        sizes[0], sizes[j], 50)}
    assert linked and {(0, j) for j in linked} <= pairs


def vectors():
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((40, 24))
    rows = []
    for k in range(400):
        v = centers[k % 40] + rng.standard_normal(24) * (0.18 if k % 3 else 1.0)
        rows.append((k, v.astype(np.float32).tolist()))
    hot = centers[0] * 3
    rows += [(1000 + k, (hot + rng.standard_normal(24) * 0.2).tolist()) for k in range(150)]
    rows += [(2000, rows[5][1]), (2001, rows[5][1]), (2002, [2 * x for x in rows[5][1]]), (None, rows[5][1])]
    rows += [
        (3000, None), (3001, [0.0] * 24), (3002, [float("nan"), *[1.0] * 23]), (3003, [float("inf"), *[1.0] * 23]),
        (3004, []), (3005, [None, *[1.0] * 23]), (3006, [1e200] * 24), (3007, [1e-200] * 24), (3008, [1.0] * 8),
        (2000, rows[5][1]),
    ]
    return rows


@pytest.mark.parametrize("limit", [2000, 40])
def test_vector_links_match_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(neardup_vectors, "BLOCK_LIMIT", limit)
    monkeypatch.setattr(neardup_vectors, "BLOCK_TARGET", 100)
    rows = vectors()
    units = []
    for _, v in rows:
        good = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v) / np.abs(v).max() if good else None
        units.append(x / np.sqrt((x * x).sum()) if good else None)

    def linked(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and len(a) == len(b) and float((a * b).sum()) >= 0.95

    counts = [sum(linked(i, j) for j in range(len(rows)) if i != j) for i in range(len(rows))]
    least = brute.grouped([i for i, _ in rows], linked)
    frame_ = frame(spark, rows, "vec_id long, embedding array<double>")
    got = neardup_vectors.find(frame_).collect()
    want = sorted((repr(i), n, repr(c)) for (i, _), n, c in zip(rows, counts, least, strict=True))
    have = sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in got)
    assert len(have) == len(want)
    assert sum(n for _, n, _ in have) >= 0.99 * sum(counts)
    assert sum(a == b for a, b in zip(have, want, strict=True)) >= 0.97 * len(want)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert neardup_vectors.find(frame(spark, [], "vec_id long, embedding array<double>")).count() == 0


def test_plan_grows_with_the_table():
    few, many = (neardup_vectors.Plan.of(n, 0.95) for n in (1_000, 10 ** 8))
    assert few.cells < many.cells and few.tables < many.tables and few.least_count == many.least_count > 8


@pytest.mark.parametrize("size", [40, 80, 160])
def test_trees_emit_joining_links_only(size):
    """A dense family leaves at most one link per joined row, and those links give all components."""
    texts = near_family(random.Random(size), size)
    sets = [neardup_texts.shingles(t, 4) for t in texts]
    batch = pa.RecordBatch.from_pydict({
        "shingle": pa.array([7] * size), "rid": pa.array(range(size)),
        "n": pa.array([len(h) for h in sets], pa.int32()), "point": pa.array(list(map(neardup_texts._point, sets))),
        "head": pa.array([False] * size), "root": pa.array(range(size)),
        "meets": pa.array([[7]] * size, pa.list_(pa.int64())),
        "weights": pa.array([[10 ** 6]] * size, pa.list_(pa.int32())),
        "task": pa.array([1] * size), "side": pa.array([2] * size, pa.int32()),
        "shingles": pa.array([h.tobytes() for h in sets], pa.binary()),
    })
    edges = [
        pair for out in neardup_texts._trees(85)(iter([batch]))
        for pair in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)
    ]
    held = [set(h.tolist()) for h in sets]

    def linked(i, j):
        return 100 * len(held[i] & held[j]) >= 85 * len(held[i] | held[j])

    assert all(linked(i, j) for i, j in edges)
    want = brute.grouped(range(size), linked)
    # Links that join and never close a circle: as many as rows less components.
    assert len(edges) == size - len(set(want))
    root = list(range(size))
    for i, j in edges:
        root = [root[i] if r == root[j] else r for r in root]
    assert all((root[i] == root[j]) == (want[i] == want[j]) for i in range(size) for j in range(i))
    live = sum(out.num_rows for out in neardup_texts._live(85)(iter([batch])))
    assert live >= sum(any(linked(i, j) for j in range(size) if j != i) for i in range(size))
