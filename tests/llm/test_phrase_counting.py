"""How a task of op11 counts phrases, without Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from txn_risk.llm import collocations


def test_counts_of_many_parts_leave_a_task_once():
    parts = [pa.table({"lang": ["en", "en", "de"], "phrase": ["a", "b", "a"], "times": [1, 2, k]}) for k in range(50)]
    got = [r for b in collocations._gathered(iter(parts), ["lang", "phrase"]) for r in b.to_pylist()]
    assert sorted((r["lang"], r["phrase"], r["times"]) for r in got) == [("de", "a", 1225), ("en", "a", 50), ("en", "b", 100)]


def test_counts_that_do_not_meet_are_not_held_for_long():
    taken = [0]

    def parts():
        for k in range(100):
            taken[0] += 1
            yield pa.table({"phrase": [f"{k} {i}" for i in range(10)], "times": [1] * 10})

    gathered = collocations._gathered(parts(), ["phrase"], most=100)
    first = next(gathered)
    assert taken[0] <= 10 and first.num_rows <= 100
    assert first.num_rows + sum(b.num_rows for b in gathered) == 1000


def test_a_word_has_one_hash_wherever_it_stands(monkeypatch):
    data = np.frombuffer(b"one two\nthree " * 40 + b"one", np.uint8)
    collocations._kept.cache_clear()
    near = collocations.Words(data)
    monkeypatch.setattr(collocations, "KEPT_POWERS", 16)
    collocations._kept.cache_clear()
    far = collocations.Words(data)
    collocations._kept.cache_clear()
    assert len(set(near.hashes.tolist())) == 3 and len(near.hashes) == 121
    assert (far.hashes == near.hashes).all() and far.starts[-1] == len(data) - 3 and far.ends[-1] == len(data)
