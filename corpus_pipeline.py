"""From raw documents to packed sequences: five stages, each an operator of ``txn_risk.llm``.

Each stage takes what the one before kept, as a written table. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txn_risk.llm import decontamination, neardup_texts, packing, quality, repeats
from txn_risk.llm.queries import vocabulary
from txn_risk.llm.words import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones not held out, does not reject."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.without_rejected(docs, model, 0.3).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    return neardup_texts.without_near_copies(docs, width=5, percent=80).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what occurs elsewhere as well: byte strings of 400 or more, and passages of over 50 words.

    Every row stays; a null text stays null, and an empty table gives no rows.
    """
    cut = repeats.without_repeats(docs, length=400, passage=repeats.PASSAGE)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ten words of a benchmark item, nor a whole shorter item."""
    return decontamination.without_contaminated(
        docs, _table(spark, sf_dir, "benchmark"), least_words=1
    ).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(), 2048)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

# Classifiers, components over shingles and tokenizers have no SQL; tests/llm holds the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "after-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
