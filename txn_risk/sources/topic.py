"""Transactions as keyed JSON messages. The broker connector is a package of the cluster; only the
two functions at the end need it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from txn_risk.schemas import EVENT, TRANSACTION


def encode(rows: DataFrame) -> DataFrame:
    """``(key, value)``: card number as text, so a card keeps its order, and the JSON record.

    Null fields stay in the JSON, and ``produced_at`` is ISO 8601 with a zone.
    """
    fields: list[Column] = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTION.fields]
    produced = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    record = F.struct(*fields, produced.alias("produced_at"))
    return rows.select(
        F.col("cc_num").cast("string").alias("key"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
    )


def decode(messages: DataFrame) -> DataFrame:
    """Message values as records plus ``_corrupt``, the text of a message that is not one.

    A message without a value, or whose record has no ``trans_num``, is no record either: nothing
    downstream could ever key it. Its ``_corrupt`` is its text, the empty string for none.
    """
    text = F.col("value").cast("string")
    with_corrupt = T.StructType(EVENT.fields + [T.StructField("_corrupt", T.StringType(), True)])
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": "_corrupt"})
    rows = messages.select(parsed.alias("r"), text.alias("_text")).select("r.*", "_text")
    reject = F.col("_corrupt").isNotNull() | F.col("trans_num").isNull()
    return rows.withColumn(
        "_corrupt", F.when(reject, F.coalesce("_corrupt", "_text", F.lit("")))
    ).drop("_text")


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("_corrupt").isNull()).drop("_corrupt")


def malformed(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("_corrupt").isNotNull()).select("_corrupt")


# A micro-batch starts at so many messages or after so long, whichever is first.
FLUSH_MESSAGES = 500
FLUSH_DELAY = "15s"


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
    min_per_trigger: int | None = FLUSH_MESSAGES, max_delay: str = FLUSH_DELAY,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of messages: ``earliest`` for the lake, ``latest`` for scoring.

    Offsets live in the query's checkpoint, written after the batch. A micro-batch takes what has come
    in once that is ``min_per_trigger`` messages or ``max_delay`` old. ``max_per_trigger`` bounds the
    size of one micro-batch, not the rate: the next follows at once.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in flush_options(min_per_trigger, max_delay, max_per_trigger).items():
        reader = reader.option(name, value)
    return reader.load()


def flush_options(
    min_per_trigger: int | None = FLUSH_MESSAGES, max_delay: str = FLUSH_DELAY,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """The connector's options for the flush rule."""
    out = {}
    if min_per_trigger is not None:
        out |= {"minOffsetsPerTrigger": str(min_per_trigger), "maxTriggerDelay": max_delay}
    if max_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return out


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Send a batch, each card in time order; acknowledged by all replicas, three retries, one request in flight."""
    # A card's messages keep their time order only if one task sends them all.
    ordered = encode(rows.repartition("cc_num").sortWithinPartitions("cc_num", "trans_date_trans_time", "trans_num"))
    (
        ordered.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", 3)
        .option("kafka.max.in.flight.requests.per.connection", 1)
        .option("topic", topic)
        .save()
    )
