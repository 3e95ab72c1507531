"""Spelling variants against brute force over all pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from tests.llm.rows import documents, frame
from txn_risk.llm import spelling

LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def plain_words(rows, rate, least_length, least_n):
    total = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % rate == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_n}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least_length=6, least_n=5, times=5, rate=199):
    n = plain_words(rows, rate, least_length, least_n)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= times * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df, **given):
    return sorted(tuple(r) for r in spelling.variants(df, **given).collect())


def variants_rows():
    texts = [
        ("letter " * 700 + "leter " * 130 + "lettter " * 20 + "lexter " * 5 + "LETTES " * 4 + "lettes", 1),
        ("aaaaaaa " * 6 + "aaaaaa " * 31 + "aaaaaaaa " * 5 + "baaaaaa " * 9 + "abaaaaa " * 9, 2),
        ("chain1 " + "chaina " * 5 + "chainb " * 25 + "cheinb " * 125 + "cheinbs " * 700, 3),
        ("straße " * 8 + "strasse " * 40 + "ÉtÉtÉt " * 5 + "étÉtÉt " * 5, 4),
        ("×÷×÷×÷ " * 5 + "日本letter日本letterx " * 5, 5),
    ]
    rows = [(i, t) for t, i in texts]
    rows += [(i, "planted spelling mistakes appear somewhere within repeated sentences ") for i in range(1000, 1900)]
    return rows


@pytest.mark.parametrize("rate", [199, 7])
def test_equals_brute_force(spark, rate):
    rows = variants_rows() + documents()
    ours = got(frame(spark, rows), rate=rate)
    assert ours == plain(rows, rate=rate)
    assert any(r[1] for r in ours) and any(r[1] and r[2] != r[1] for r in ours)


def test_every_length_and_count(spark):
    rows = [(1, "ab abc abd ac bc abcd a b c d ac ac ac ac ac ac")]
    given = dict(least_length=1, least_n=1, times=2)
    assert got(frame(spark, rows), **given) == plain(rows, 1, 1, 2)


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == plain(rows)


def test_groups_are_bounded_by_the_alphabet(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = [f"pre{a}fix" for a in letters] + ["prefix"]
    table = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    sizes = spelling.filed_rotations(table).groupBy("rest").count()
    assert sizes.agg({"count": "max"}).first()[0] == 91
    near = {r.word: r.n_near for r in spelling.neighbours(table).collect()}
    assert set(near.values()) == {90} and len(near) == 91


def test_batches_do_not_cut_groups(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 1)
    try:
        rows = variants_rows()
        assert got(frame(spark, rows)) == plain(rows)
    finally:
        spark.conf.set(size, before)


def test_empty_tables(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string, word string")) == []
    assert got(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")) == []
