"""What a fit holds in the driver: few bytes for each feature of each text."""

from __future__ import annotations

from collections import Counter

import numpy as np

from txn_risk.llm import quality
from txn_risk.llm.subwords import features

TEXTS = [f"Some words {k} of text number {k * k}, words of text and more words" for k in range(300)]
LONG = "tic tac " * 1_000 + "toe"


def _held(docs: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """Bytes of all arrays that the slices keep alive, each counted once."""
    blocks = {id(b): b for pair in docs for x in pair for b in [x if x.base is None else x.base]}
    return sum(b.nbytes for b in blocks.values())


def test_a_feature_of_a_text_takes_six_bytes_at_most():
    docs = quality.sparse(TEXTS, quality.BITS, grams=quality.GRAMS, repeats=True)
    assert _held(docs) <= 6 * sum(len(ids) for ids, _ in docs) + 64 * len(docs)


def test_features_and_counts_do_not_depend_on_which_texts_are_together():
    texts = ["", None, LONG, *TEXTS[:40], " ", LONG * 200, "end"]
    for together in (1, 500, 1 << 18):
        docs = quality.sparse(texts, quality.BITS, together, grams=quality.GRAMS, repeats=True)
        for text, (ids, times) in zip(texts, docs, strict=True):
            plain = Counter(f for _, what in features([text], quality.BITS, quality.GRAMS, repeats=True) for f in what.tolist())
            assert list(zip(ids.tolist(), times.tolist(), strict=True)) == sorted(plain.items())
