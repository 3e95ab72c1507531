"""Collocations against plain counts of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.rows import documents, frame
from txn_risk.llm import collocations

LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string"


def plain_counts(rows):
    counts = Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i:i + k])] += 1
    return counts


def plain(rows, least, share, top):
    f = plain_counts(rows)
    n, held = Counter(), Counter()
    for (lang, phrase), times in f.items():
        if len(phrase) == 1:
            n[lang] += times
        elif times >= least:
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    key = lang, phrase[i:i + size]
                    held[key] = max(held[key], times)
    found = []
    for (lang, phrase), a in f.items():
        if len(phrase) < 2 or a < least or (held[lang, phrase] and 100 * held[lang, phrase] >= share * a):
            continue
        cuts = ((f[lang, phrase[:k]], f[lang, phrase[k:]]) for k in range(1, len(phrase)))
        score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.append((lang, -score, -a, " ".join(phrase).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def made_rows(n=60, seed=1):
    rng = random.Random(seed)
    stock = ["alpha", "Beta", "gamma", "délta", "e", "zz", "\x00", "ß"]
    passage = " ".join(rng.choice(stock) + str(rng.randrange(30)) for _ in range(200))
    rows = []
    for i in range(n):
        words = [rng.choice(stock) for _ in range(rng.randrange(0, 90))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for w in words)
        rows.append((i, (passage + " " + text) if i % 3 == 0 else text, rng.choice(["en", "en", "de", None])))
    return rows


def all_rows():
    awkward = [(i, t, ("en", "de", None)[k % 3]) for k, (i, t) in enumerate(documents())]
    long = [(900, "one two three four five six seven " * 400, "en"), (901, "same " * 3000, "en"), (902, "." * 500, "en")]
    return made_rows() + awkward + long


@pytest.mark.parametrize("size", [1 << 20, 50])
def test_equals_plain_counts(spark, size):
    rows = all_rows()
    got = collocations.collocations(frame(spark, rows, SCHEMA), least=5, share=80, top=40, size=size)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 80, 40)


def test_top_ties_and_shares(spark):
    rows = made_rows(200, 3)
    for least, share, top in ((2, 50, 7), (30, 100, 2000)):
        got = collocations.collocations(frame(spark, rows, SCHEMA), least=least, share=share, top=top)
        assert sorted(map(tuple, got.collect())) == plain(rows, least, share, top)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_007_199_254_740_993
    frequent = spark.createDataFrame(
        [("x", "a", 1, 2 * big), ("x", "b", 1, big + 4), ("x", "a b", 2, big)], "lang string, phrase string, k int, f long"
    )
    row = collocations._scored(collocations._candidates(frequent, 80), frequent).first()
    assert (row.a, row.l, row.r, row.score) == (big, 2 * big, big + 4, 2000000 * big // (3 * big + 4))


def _counts(chunk, tail, times):
    out = Counter()
    for text, skip, n in zip(chunk, tail, times, strict=True):
        words = text.split(" ")
        for k in range(1, 5):
            for i in range(len(words) - k + 1):
                if i < len(words) - skip:
                    out["", tuple(words[i:i + k])] += n
    return out


@settings(max_examples=300, deadline=None)
@given(
    parts=st.lists(st.sampled_from(["a", "b ", " ", "c\t", "\n", ".", "dd ", "e  f ", "é ", "g h i j k "]), max_size=60),
    size=st.integers(1, 20), repeat=st.integers(1, 6),
)
def test_every_start_counts_once(parts, size, repeat):
    """Chunks of one text, cut into parts of ``size`` bytes, give each phrase as often as it occurs."""
    import numpy as np

    text = "".join(parts) * repeat
    cut = list(collocations._parts(text.encode().translate(collocations._PLAIN), size))
    held = [p for p, _ in cut]
    starts = np.cumsum([0, *(len(p) + 1 for p in held[:-1])])
    _, chunk, tail = collocations._chunks(b"\n".join(held), starts, np.asarray([t for _, t in cut]))
    got = _counts(chunk.to_pylist(), tail.tolist(), [1] * len(chunk))
    want = Counter({("", g): n for (_, g), n in plain_counts([(0, text, "x")]).items()})
    assert got == want


def test_chunks_are_bounded_and_recur(spark):
    rows = all_rows()
    dictionary = collocations.parse(frame(spark, rows, SCHEMA)).collect()
    assert max(len(r.chunk.split(" ")) for r in dictionary) <= collocations.STRETCH + collocations.OVERLAP
    assert any(r.times > 15 and r.chunk.count(" ") > 5 for r in dictionary)


def test_bitmap_has_no_false_negatives(spark):
    import numpy as np

    hashes = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000)
    held = collocations._bitmap(spark, spark.createDataFrame([(int(h),) for h in [*hashes, 0, -1]], "h long"))
    assert held.holds(np.append(hashes, [0, -1]).astype(np.int64).view(np.uint64)).all()
    others = np.random.default_rng(3).integers(0, 2**63, 20000).view(np.uint64)
    assert held.holds(others).mean() < 0.02


def test_empty_tables(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = spark.createDataFrame([(1, None, None), (None, "", "en"), (2, " .,. ", "en")], SCHEMA)
    assert collocations.collocations(empty).collect() == []
