"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the presence of hashed words, word beginnings and character n-grams is fitted in
numpy to confirmed toxic texts and to unlabelled ones. The risk is corrected by the share of toxic
texts among the unlabelled: with prior p, R = p R+(positive) + max(0, R-(unlabelled) - p R-(positive)).
When the second term falls below 0, the step goes the other way, so it cannot be driven down by memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from txn_risk.llm.quality import classify, sparse
from txn_risk.llm.subwords import features
from txn_risk.llm.words import is_held_out, texts

BITS = 20
STARTS = (4, 5, 6)
GRAMS: tuple[int, ...] = ()
# What a fit reads at most: confirmed rows and unlabelled rows, and bytes of either.
POSITIVE_ROWS = 3_000
UNLABELLED_ROWS = 6_000
FIT_BYTES = 16_000_000
# A feature must stand in this many confirmed texts, and in so many more of them than its rate among
# the unlabelled explains, in standard deviations; any other carries no evidence and gets no weight.
LEAST_TEXTS = 5
LEAST_DEVIATIONS = 5.0
# A feature of toxic texts alone is 1 / prior times as frequent among confirmed texts as among the
# unlabelled. It must reach this part of the way there; a language that is common in toxic texts does not.
LEAST_EXCESS = 0.25
SKETCH = 24
ROUNDS = 1000
RATE = 0.5
DECAY = 1e-5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts_: list[str | None]) -> np.ndarray:
        total = np.full(len(texts_), self.bias)
        for own in range(0, len(texts_), 64):
            part = texts_[own:own + 64]
            seen = []
            for where, what in features(part, BITS, GRAMS, STARTS):
                used = self.weights[what] != 0
                seen.append(where[used].astype(np.int64) << BITS | what[used])
            if seen:
                key = np.unique(np.concatenate(seen))
                total[own:own + 64] += np.bincount(key >> BITS, self.weights[key & ((1 << BITS) - 1)], len(part))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _stacked(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of each feature present."""
    ids = [ids for ids, _ in sparse(texts_, BITS, grams=GRAMS, starts=STARTS)]
    where = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return where.astype(np.int32), (np.concatenate(ids) if ids else np.zeros(0)).astype(np.int32)


def _apart(texts_: list[str]) -> list[str]:
    """``texts_`` without near copies of earlier ones: of a family of copies all words look telling.

    Two texts are taken for copies when most of their SKETCH least feature hashes agree.
    """
    kept: list[str] = []
    holders: dict[int, list[int]] = {}
    for text, (ids, _) in zip(texts_, sparse(texts_, BITS, grams=GRAMS, starts=STARTS), strict=True):
        sketch = ids[:SKETCH].tolist()  # rising
        met: dict[int, int] = {}
        for i in sketch:
            for k in holders.get(i, ()):
                met[k] = met.get(k, 0) + 1
        if sketch and max(met.values(), default=0) >= 0.7 * len(sketch):
            continue
        for i in sketch:
            holders.setdefault(i, []).append(len(kept))
        kept.append(text)
    return kept


def fit_rows(positive: list[str], unlabelled: list[str], prior: float) -> Model:
    """Full-batch AdaGrad on the corrected risk with the logistic loss."""
    size = 1 << BITS
    if not positive or not unlabelled:
        return Model(np.zeros(size), float(np.log((prior + 1e-3) / (1 - prior + 1e-3))))
    prior = min(max(prior, 1e-3), 0.9)
    positive, unlabelled = _apart(positive), _apart(unlabelled)
    p_at, p_id = _stacked(positive)
    u_at, u_id = _stacked(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    in_p = np.bincount(p_id, minlength=size)
    expected = np.bincount(u_id, minlength=size) * (n_p / n_u)
    common = (
        (in_p >= LEAST_TEXTS) & (in_p - expected >= LEAST_DEVIATIONS * np.sqrt(expected + 1))
        & (in_p >= expected * (1 + LEAST_EXCESS * (1 / prior - 1)))
    )
    kept = np.flatnonzero(common)
    number = np.full(size, -1, np.int32)
    number[kept] = np.arange(len(kept))
    p_at, p_id = p_at[common[p_id]], number[p_id[common[p_id]]]
    u_at, u_id = u_at[common[u_id]], number[u_id[common[u_id]]]

    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    w2, b2 = np.full(len(kept), 1e-8), 1e-8

    def logits(at, ids, n):
        return np.bincount(at, w[ids], n) + b

    def towards(at, ids, slope):
        return np.bincount(ids, slope[at], len(kept)), slope.sum()

    for _ in range(ROUNDS):
        g_p, g_u = logits(p_at, p_id, n_p), logits(u_at, u_id, n_u)
        s_p, s_u = (1 / (1 + np.exp(-np.clip(g, -30, 30))) for g in (g_p, g_u))
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        # Slopes of log(1 + exp(g)) and of log(1 + exp(-g)).
        u_w, u_b = towards(u_at, u_id, s_u / n_u)
        q_w, q_b = towards(p_at, p_id, prior * s_p / n_p)
        if negative >= 0:
            p_w, p_b = towards(p_at, p_id, prior * (s_p - 1) / n_p)
            d_w, d_b = p_w + u_w - q_w, p_b + u_b - q_b
        else:
            d_w, d_b = q_w - u_w, q_b - u_b
        d_w += DECAY * w
        w2 += d_w * d_w
        b2 += d_b * d_b
        w -= RATE * d_w / np.sqrt(w2)
        b -= RATE * d_b / np.sqrt(b2)
    weights = np.zeros(size)
    weights[kept] = w
    return Model(weights, b)


def _bounded(rows: DataFrame, most_bytes: int) -> list[str]:
    """Distinct texts, as many as ``most_bytes`` hold."""
    out, size = [], 0
    for r in rows.distinct().toLocalIterator():
        if size + len(r.text) <= most_bytes:
            size += len(r.text)
            out.append(r.text)
    return out


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Fit on at most POSITIVE_ROWS confirmed texts and UNLABELLED_ROWS texts of any kind, chosen by a
    hash of the id among rows not held out. The prior is the share of toxic rows among the labelled."""
    source = texts(docs, id_col, text_col).where(~is_held_out(F.col("doc_id")))
    marks = labels.select(labels["doc_id"].alias("_id"), labels[label].cast("int").alias("label")).where(
        "_id is not null and label in (0, 1)"
    ).where(~is_held_out(F.col("_id")))
    counts = {r.label: r.n for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64("_id", F.lit("toxic"))
    chosen = marks.where("label = 1").select("_id").distinct().orderBy(order, "_id").limit(POSITIVE_ROWS)
    positive = source.join(F.broadcast(chosen), source["doc_id"] == chosen["_id"]).select("text")
    total = source.count()
    # About UNLABELLED_ROWS rows by a hash; the limit only cuts what chance adds.
    share = min(1.0, UNLABELLED_ROWS / max(1, total))
    some = source.where(F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1 << 20)) < share * (1 << 20))
    return fit_rows(
        _bounded(positive, FIT_BYTES), _bounded(some.select("text").limit(2 * UNLABELLED_ROWS), FIT_BYTES), prior
    )


__all__ = ["Model", "classify", "fit", "fit_rows"]
