"""Small tables with every awkward case."""

from __future__ import annotations

import random

BASE = (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
    "phi chi psi omega one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
)
PASSAGE = " ".join(f"shared{i} passage{i}" for i in range(40))
ITEM = "what is the capital of the country whose flag has three stripes and a star"


def documents():
    rng = random.Random(3)
    noise = lambda n: " ".join(rng.choice(BASE.split()) + str(rng.randrange(50)) for _ in range(n))
    near = BASE.replace("omega", "changed")
    texts = [
        BASE, BASE, near, BASE.upper(), None, "", " \n\t ", "x", "x y", "x y z", "x  y\nz",
        noise(60) + " " + PASSAGE + " " + noise(20), PASSAGE + " " + noise(30), noise(10) + "\n" + PASSAGE,
        "Licensed under CC BY-NC 4.0. All rights reserved. all RIGHTS reserved!", "ccK by cc by",
        "This work is licensed under the GNU General Public License, version 3.", "by cc general public",
        "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
        noise(5) + " " + ITEM + " " + noise(5), ITEM, "tiny item", "prefix tiny item suffix tiny item",
        "ünïcödé 日本語 テキスト ß <|endoftext|> it's we'll 12,34   end ", noise(6000), "a" * 5000, "a" * 5000,
        "ab" * 700, "\x00" * 900, "idiot moron idiot", "The The The The The The The", "| a | b | c |",
    ]
    ids = list(range(10, 10 + len(texts)))
    rows = list(zip(ids, texts, strict=True))
    rows += [(None, "a text without a name"), (None, BASE), (rows[2][0], rows[2][1]), (500, rows[11][1])]
    return rows


BENCHMARK = [(1, ITEM), (2, "tiny item"), (3, None), (4, ""), (5, ITEM), (None, PASSAGE), (6, BASE)]
CLASHES = (
    "n_words", "score", "labels", "key", "rid", "size", "h", "u", "start", "length", "spans", "held_out", "_key",
    "n", "point", "shard", "hits", "words", "piece", "_id", "label", "row", "copies", "source", "runs",
)


def frame(spark, rows, schema="doc_id long, text string", clashes=True):
    from pyspark.sql import functions as F

    out = spark.createDataFrame(rows, schema).repartition(3)
    if clashes:
        out = out.withColumns({c: F.lit(c) for c in CLASHES if c not in out.columns})
    return out
