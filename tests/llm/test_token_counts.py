"""Token counts against the libraries' own encoding of whole texts."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.rows import documents, frame
from txn_risk.llm import token_counts

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")


def whole(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", FILES)
def test_counts_are_those_of_whole_texts(spark, name):
    rows = documents()
    got = token_counts.count(
        frame(spark, rows), public_tokenizers.path(name), limit=40, size=64
    ).collect()
    of = whole(name)
    expected = [(i, len((t or "").encode()), of(t or "")) for i, t in rows]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(map(repr, expected))
    assert all(r.over_limit == (r.n_tokens > 40) for r in got)


PARTS = st.sampled_from([
    "a", "Word", "it's", "12", " ", "  ", "\n", "\t ", "é", "日本", "́", "<|endoftext|>", "<s>", "▁", ".",
    "'s", " ", "Σ", "İ", "\x00", "a b", "x y z",
])


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(PARTS, max_size=30), size=st.integers(1, 12))
def test_cuts_are_safe(name, parts, size):
    text = "".join(parts)
    counter = token_counts._counter(public_tokenizers.path(name))
    assert counter.cuts
    assert counter.count([text, text, ""], size) == [whole_of(name)(text)] * 2 + [0]


_WHOLE = {}


def whole_of(name):
    if name not in _WHOLE:
        _WHOLE[name] = whole(name)
    return _WHOLE[name]


def test_a_call_never_holds_much_more_than_asked():
    counter = token_counts._counter(public_tokenizers.path(FILES[0]))
    text = "word " * 5000
    parts = list(counter.parts(text, 100))
    assert "".join(parts) == text and max(map(len, parts)) < 110


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_tokens int")
    assert token_counts.count(empty, public_tokenizers.path(FILES[0]), 10).collect() == []
