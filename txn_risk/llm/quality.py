"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

Every hashed word and character n-gram has a learned vector; a document is their average; a softmax
layer gives the class. Scoring folds the output layer into the table, so that each feature is one
number and a document's logit is an average of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from txn_risk.llm.subwords import features
from txn_risk.llm.words import is_held_out, texts

BITS = 17
DIMENSION = 8
GRAMS = (3, 4)
EPOCHS = 4
RATE = 0.4
# Labelled rows that a fit reads at most, chosen by a hash of the id; and of their bytes.
FIT_ROWS = 5_000
FIT_BYTES = 24_000_000
# Characters of texts whose features are made at once in a fit, which bounds the arrays on the way.
SPARSE_CHARS = 1 << 18


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per feature: vector times the difference of the output rows
    bias: float
    bits: int
    grams: tuple[int, ...]

    def scores(self, texts_: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text; a text without words gets the bias alone."""
        total = np.zeros(len(texts_))
        count = np.zeros(len(texts_))
        for where, what in features(texts_, self.bits, self.grams, repeats=True):
            total += np.bincount(where, self.weights[what], len(texts_))
            count += np.bincount(where, minlength=len(texts_))
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def _together(texts_: list[str | None], size: int) -> Iterator[slice]:
    """Neighbouring texts of about ``size`` characters."""
    first = held = 0
    for k, text in enumerate(texts_, 1):
        held += len(text or "")
        if held >= size or k == len(texts_):
            yield slice(first, k)
            first, held = k, 0


def sparse(
    texts_: list[str | None], bits: int, together: int = SPARSE_CHARS, **kinds
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its features, rising, and how often each occurs.

    Neighbours share one array of either kind, as narrow as its numbers allow: a fit holds all of them at
    once, and many small arrays would leave gaps that the process does not give back.
    """
    out: list = [(np.zeros(0, np.int32), np.zeros(0, np.uint8))] * len(texts_)
    for group in _together(texts_, together):
        for where, what in features(texts_[group], bits, **kinds):
            key = where.astype(np.int64) << bits | what
            key, n = np.unique(key, return_counts=True)
            present = np.unique(key >> bits)
            cuts = np.append(np.searchsorted(key, present << bits), len(key))
            all_ids = (key & ((1 << bits) - 1)).astype(np.int32)
            all_times = n.astype(np.min_scalar_type(n.max()))
            for k, start, end in zip((present + group.start).tolist(), cuts[:-1], cuts[1:], strict=True):
                ids, times = all_ids[start:end], all_times[start:end]
                if len(out[k][0]):  # a long text comes in parts
                    ids, inverse = np.unique(np.concatenate([out[k][0], ids]), return_inverse=True)
                    times = np.bincount(inverse, np.concatenate([out[k][1], times])).astype(np.int64)
                out[k] = (ids, times)
    return out


def fit_rows(texts_: list[str | None], labels: list[int], seed: int = 7) -> Model:
    """Fit on texts and their 0/1 labels."""
    docs = sparse(texts_, BITS, grams=GRAMS, repeats=True)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (1 << BITS, DIMENSION)).astype(np.float32)
    output = np.zeros((2, DIMENSION), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            ids, times = docs[k]
            rate = RATE * (1 - done / steps)
            done += 1
            share = (times.astype(float) / max(int(times.sum()), 1)).astype(np.float32)
            hidden = share @ table[ids] if len(ids) else np.zeros(DIMENSION, np.float32)
            logits = output @ hidden + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[k]] -= 1
            towards = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= rate * error
            if len(ids):
                # Each feature moves as if it stood alone: its share of the average, times the number.
                table[ids] -= rate * np.outer(np.minimum(share * len(ids), 4), towards)
    return Model(table @ (output[1] - output[0]), float(bias[1] - bias[0]), BITS, GRAMS)


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[list[str], list[int]]:
    """Texts and labels to fit on: rows not held out, the first ``rows`` by a hash of the id, as many
    of them as ``most_bytes`` hold. Rows without a label or id are left out."""
    marks = labels.select(labels["doc_id"].alias("_id"), labels[label].cast("int").alias("label")).where(
        "_id is not null and label in (0, 1)"
    ).where(~is_held_out(F.col("_id"))).dropDuplicates(["_id"])
    chosen = marks.withColumn("_order", F.xxhash64("_id", F.lit("fit"))).orderBy("_order", "_id").limit(rows)
    source = texts(docs, id_col, text_col)
    found = source.join(F.broadcast(chosen), source["doc_id"] == chosen["_id"]).select("_order", "_id", "text", "label")
    kept, marks_, size = [], [], 0
    for r in found.orderBy("_order", "_id", "text").toLocalIterator():
        if size + len(r.text) > most_bytes:
            continue
        size += len(r.text)
        kept.append(r.text)
        marks_.append(r.label)
    return kept, marks_


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", **columns: str) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs``; without any, a model of score 1/2."""
    return fit_rows(*labelled(docs, labels, label, **columns))


def scorer(docs: DataFrame, model) -> "callable":
    """A function from a text column to its score column."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> pa.Array:
        parts = [held.value.scores(column.slice(i, 256).to_pylist()) for i in range(0, len(column), 256)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    udf = F.arrow_udf(score, T.DoubleType())
    return lambda text: udf(text.cast("string"))


def classify(
    docs: DataFrame, model, threshold: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Whole texts, white space and A-Z case aside. A null or empty text gets the score of the bias; a
    null id counts as held out or not like an empty one; repeated rows give repeated results; an empty
    table gives no rows; other columns are ignored.
    """
    source = texts(docs, id_col, text_col)
    scored = source.select("doc_id", scorer(docs, model)(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_rejected(docs: DataFrame, model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all columns stay."""
    return docs.where(scorer(docs, model)(docs[text_col]) >= threshold)


__all__ = ["Model", "classify", "fit", "fit_rows", "labelled", "scorer", "without_rejected"]
