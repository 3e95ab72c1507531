"""The transform of op7: neighbours' common prefixes against plain comparison, and what an expansion looks at."""

from __future__ import annotations

import random

import numpy as np
import pytest

from txn_risk.llm import repeats


def _plain(data: bytes, length: int) -> list[int]:
    turned = sorted((data + data)[i:i + len(data)] for i in range(len(data)))
    out = [0]
    for a, b in zip(turned, turned[1:]):
        same = next((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))
        out.append(same if same < length else -1)
    return out


@pytest.mark.parametrize("length", [1, 5, 8, 9, 40])
def test_common_prefixes_of_neighbours(length):
    draw = random.Random(length)
    for _ in range(60):
        pieces = [bytes(draw.choices(b"abc", k=draw.randint(1, 60))) for _ in range(4)]
        whole = b"\0".join([*pieces, pieces[0][:50] + pieces[1]]) + b"\0"
        data = np.frombuffer(whole, np.uint8)
        assert repeats.boundaries(data, repeats.suffix_order(data, length), length).tolist() == _plain(whole, length)


def test_intervals_of_one_letter_are_not_looked_at_place_by_place(monkeypatch):
    rng = np.random.default_rng(2)
    passage = bytes(rng.integers(97, 123, 600, np.uint8))
    # Ten copies after different beginnings: before most intervals stands one letter, ten times.
    data = np.frombuffer(b"\0".join(bytes([97 + k]) * 9 + passage for k in range(10)) + b"\0", np.uint8)
    order = repeats.suffix_order(data, 400)
    seen = [0]

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def repeat(self, *args):
            out = np.repeat(*args)
            seen[0] += len(out)
            return out

    monkeypatch.setattr(repeats, "np", Counting())
    repeats.boundaries(data, order, 400)
    assert seen[0] <= 4 * len(data)
