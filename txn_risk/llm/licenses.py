"""License scan by a positional index of rare words. Built-in DataFrame functions only.

The index holds, for the rarest words of every template, at which positions of which template they
stand. A file looks up its own occurrences of those words; every hit says where the template would
have to start. At each such start the template is laid over the file, the words that agree are
weighed by their rarity, and the template's mandatory phrases must stand in place.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.llm.words import WORD, ascii_lower, settle, texts

# Phrases and labels of the contract.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Customary license notices, label -> (wording, mandatory phrases).
NOTICES = {
    "agpl": ("licensed under the gnu affero general public license", ["affero general public license"]),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "apache-2.0-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ["apache license", "except in compliance"],
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ["source and binary forms", "following conditions"],
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0", ["cc by nc"]),
    "cc-by-sa": ("licensed under cc by sa 4 0", ["cc by sa"]),
    "cc0": ("released under cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    "gpl-notice": (
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license version"],
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted",
        ["hereby granted", "for any purpose"],
    ),
    "lgpl": ("licensed under the gnu lesser general public license", ["lesser general public license"]),
    "mit": ("released under the mit license", ["mit license"]),
    "mit-notice": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        ["hereby granted free of charge", "documentation files"],
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license",
        ["mozilla public license"],
    ),
}
# A notice counts when words of this share of its weight agree.
LEAST_SHARE = 0.7
# Rarest words of a notice that are looked up. A base phrase needs one, as all its words must agree.
ANCHORS = 3


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: tuple[str, ...]
    weights: tuple[float, ...]
    required: tuple[bool, ...]
    anchors: tuple[str, ...]


def _places(phrase: list[str], words: list[str]) -> list[int]:
    return [i for i in range(len(words)) if words[i:i + len(phrase)] == phrase]


def templates(rarity: dict[str, float], base: dict = BASE, notices: dict = NOTICES) -> list[Template]:
    """The templates with their words weighed by ``rarity`` (inverse document frequency)."""
    out = []
    for label, wording, phrases, is_base in [
        *[(label, phrase, [phrase], True) for phrase, label in base.items()],
        *[(label, wording, phrases, False) for label, (wording, phrases) in notices.items()],
    ]:
        words = re.findall(WORD, wording)
        required = [False] * len(words)
        for phrase in phrases:
            parts = phrase.split()
            for at in _places(parts, words):
                required[at:at + len(parts)] = [True] * len(parts)
        weights = [rarity[w] + 1e-6 for w in words]
        # Only words of mandatory phrases: a notice without them does not count anyway.
        by_rarity = sorted({w for w, r in zip(words, required) if r}, key=lambda w: (-rarity[w], w))
        out.append(Template(
            label, is_base, tuple(words), tuple(x / sum(weights) for x in weights), tuple(required),
            tuple(by_rarity[:1 if is_base else ANCHORS]),
        ))
    return out


def vocabulary(base: dict = BASE, notices: dict = NOTICES) -> list[str]:
    return sorted({w for t in (*base, *(n for n, _ in notices.values())) for w in re.findall(WORD, t)})


def positions(docs: DataFrame, vocab: list[str], id_col: str, text_col: str) -> DataFrame:
    """The positional index: ``(doc_id, n_words, hits)``; a hit is a word of ``vocab`` and its place."""
    text = F.col("text")
    # Two characters have a lower case that holds an ASCII letter; those texts take the slow way.
    lowered = F.when(text.rlike("[\u0130\u212A]"), ascii_lower(text)).otherwise(F.lower(text))
    words = texts(docs, id_col, text_col).select(
        "doc_id", F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+").alias("words")
    )
    # A separator at the start leaves an empty first part, one at the end an empty last one.
    lead = (F.get("words", F.lit(0)) == "").cast("int")
    trail = ((F.size("words") > 1) & (F.get("words", F.size("words") - 1) == "")).cast("int")
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(
            w.isin(vocab), F.struct(w.alias("word"), (i - F.col("lead")).alias("at"))
        )),
        lambda h: h.isNotNull(),
    )
    return words.select("doc_id", "words", lead.alias("lead"), trail.alias("trail")).select(
        "doc_id", (F.size("words") - F.col("lead") - F.col("trail")).cast("bigint").alias("n_words"),
        hits.alias("hits"),
    )


def rarities(index: DataFrame, vocab: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of ``vocab`` over all rows of the index."""
    seen = F.array_append(
        F.array_distinct(F.transform("hits", lambda h: h["word"])), F.lit(None).cast("string")
    )
    # A row per word of the vocabulary, and the number of documents under null.
    n = {
        r.word: r.n for r in index.select(F.explode(seen).alias("word")).groupBy("word").agg(
            F.count(F.lit(1)).alias("n")
        ).collect()
    }
    total = n.pop(None, 0)
    return {w: max(0.0, math.log((total + 1) / (n.get(w, 0) + 1))) for w in vocab}


def _array(values, of) -> Column:
    return F.array(*[of(v) for v in values])


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict = BASE, notices: dict = NOTICES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, matches``.

    Words follow ``WORD`` on the text with A-Z lower-cased. ``n_base`` counts all places of base
    phrases, ``first_word`` and ``last_word`` are the least and greatest start (null if none).
    ``labels`` adds those of notices found; ``score`` is the largest share of a template's weight that
    agrees at any candidate start (1 for a whole template, 0 without a candidate). ``matches`` lists
    label, start and share. A null or empty text has no words, empty labels and score 0; repeated rows
    give repeated results; an empty table gives no rows; other columns are ignored.

    One scan of the texts, which are not shuffled: the index is written to the shared folder, counted,
    and matched row by row.
    """
    vocab = vocabulary(base, notices)
    index = settle(positions(docs, vocab, id_col, text_col), "license-index")
    held = templates(rarities(index, vocab), base, notices)
    longest = max(len(t.words) for t in held)

    anchors = sorted({a for t in held for a in t.anchors})
    postings = F.array(*[
        F.struct(F.lit(word).alias("word"), F.lit(k).alias("template"), F.lit(i).alias("at"))
        for k, t in enumerate(held) for i, word in enumerate(t.words) if word in t.anchors
    ])
    wordings = _array([t.words for t in held], lambda ws: _array(ws, F.lit))
    weights = _array([t.weights for t in held], lambda ws: _array(ws, F.lit))
    required = _array([t.required for t in held], lambda rs: _array(rs, F.lit))
    labels = _array([t.label for t in held], F.lit)
    bases = _array([t.base for t in held], F.lit)

    def lookup(hit: Column, number: Column) -> Column:
        """Where templates would start, each with the hits around; hits lie in the order of places."""
        near = F.slice("hits", F.greatest(F.lit(1), number + 1 - longest), 2 * longest + 1)
        own = F.filter(postings, lambda p: p["word"] == hit["word"])
        return F.when(hit["word"].isin(anchors), F.transform(own, lambda p: F.struct(
            p["template"].alias("template"), (hit["at"] - p["at"]).alias("start"), near.alias("near")
        )))

    def agrees(place: Column, i: Column) -> Column:
        asked = F.get(F.get(wordings, place["template"]), i)
        return F.exists(place["near"], lambda h: (h["at"] == place["start"] + i) & (h["word"] == asked))

    def weighed(place: Column) -> Column:
        k = place["template"]
        steps = F.sequence(F.lit(0), F.size(F.get(wordings, k)) - 1)
        share = F.aggregate(steps, F.lit(0.0), lambda sum_, i: sum_ + F.when(
            agrees(place, i), F.get(F.get(weights, k), i)
        ).otherwise(0.0))
        whole = F.forall(steps, lambda i: ~F.get(F.get(required, k), i) | agrees(place, i))
        return F.struct(
            F.get(labels, k).alias("label"), F.get(bases, k).alias("base"), place["start"].alias("start"),
            F.least(F.lit(1.0), F.round(share, 9)).alias("share"), whole.alias("whole"),
        )

    places = F.flatten(F.filter(F.transform("hits", lookup), lambda p: p.isNotNull()))
    found = (
        index.select("doc_id", "n_words", places.alias("places"))
        .select("doc_id", "n_words", F.array_distinct(F.transform("places", weighed)).alias("tried"))
        .withColumn("matches", F.filter("tried", lambda m: m["whole"] & (m["base"] | (m["share"] >= LEAST_SHARE))))
        .withColumn("base_at", F.transform(F.filter("matches", lambda m: m["base"]), lambda m: m["start"]))
    )
    is_base = F.filter("matches", lambda m: m["base"])

    def joined(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id", "n_words",
        F.size("base_at").cast("bigint").alias("n_base"),
        F.array_min("base_at").cast("bigint").alias("first_word"),
        F.array_max("base_at").cast("bigint").alias("last_word"),
        joined(is_base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("tried", lambda m: m["share"])), F.lit(0.0)).alias("score"),
        F.transform("matches", lambda m: F.struct(
            m["label"].alias("label"), m["start"].cast("bigint").alias("start"), m["share"].alias("share")
        )).alias("matches"),
    )
