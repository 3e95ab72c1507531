"""Streams from files or a topic: replay, lake ingest, and scoring with a score log."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.ml.base import Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from txn_risk.operators.baseline import as_profile
from txn_risk.plans.decisions import CARRIED, score_records
from txn_risk.plans.features import (
    ROW_INPUTS,
    Baseline,
    assembler,
    project_features,
    with_defaults,
)
from txn_risk.plans.training import score_column, time_prefix
from txn_risk.schemas import ALERT_THRESHOLD, BLOCK_THRESHOLD, EVENT
from txn_risk.sources.lake import with_partition_keys, write_batch
from txn_risk.sources.partitions import exists
from txn_risk.sources.score_store import append_scores
from txn_risk.streaming.trailing_state import with_trailing_count

# The topic's options hold the flush rule; a micro-batch may start as soon as they allow.
FLUSH_INTERVAL = "0 seconds"


def write_replay_files(
    rows: DataFrame, path: str, files: int, limit: int | None = None,
    order: Sequence[str] = ("trans_date_trans_time", "trans_num"),
) -> None:
    """Write transactions as Parquet files in time order (or any other), for a file stream to replay.

    Ranges are cut by time and sorted inside. A file stream takes files by modification time, so
    the files, which one job writes together, are stamped in their range order.
    """
    ordered = (
        time_prefix(rows, limit)
        .withColumn("produced_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .repartitionByRange(files, *order).sortWithinPartitions(*order)
    )
    ordered.select(*EVENT.fieldNames()).write.parquet(path)
    spark = rows.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(
        (s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    start = fs.getFileStatus(parts[0]).getModificationTime() if parts else 0
    for i, part in enumerate(parts):
        fs.setTimes(part, start + i * 1000, -1)


def read_replay(
    spark: SparkSession, path: str, schema: T.StructType = EVENT, files_per_trigger: int = 1
) -> DataFrame:
    """File stream of Parquet transactions; the trigger limit bounds a micro-batch."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def without_repeats(
    stream: DataFrame, delay: str = "1 day", key: str = "trans_num", arrived: Column | None = None,
) -> DataFrame:
    """Drop a row whose ``key`` has arrived before, at most ``delay`` earlier.

    Optional, since the score table and staging resolve repeats by key anyway. The engine's own operator
    keeps one state row per key and lets it expire. Its clock is the time of arrival (that of the micro-batch,
    unless a column ``arrived`` has it), so nothing is ever behind it: a transaction passes however late its
    event is and whether its time can be read or not. A repeat passes if it arrives later than ``delay``, or
    without a key. The state holds the keys of twice ``delay`` at most.
    """
    timed = stream.withColumns({
        "_arrived": F.current_timestamp() if arrived is None else arrived,
        "_key": F.coalesce(F.col(key).cast("string"), F.expr("uuid()")),
    })
    return timed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_arrived", "_key")


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Run to the end of the available input without ``interval``, else for good."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def admitted(rows: DataFrame, number: int, ledger: str, total: int) -> DataFrame:
    """What a micro-batch may pass so that all of them together pass ``total`` rows: exactly, and the same
    again if it is repeated. The micro-batch that reaches the total passes its earliest rows.

    The ledger keeps a row per micro-batch.
    """
    spark = rows.sparkSession
    before = 0
    if exists(spark, ledger):
        known = spark.read.schema("n long, batch long").parquet(ledger)
        before = known.where(F.col("batch") < number).agg(F.sum("n")).first()[0] or 0
    left = max(0, total - before)
    n = rows.count() if left else 0  # nothing more may pass, however many these are
    spark.createDataFrame([(min(n, left),)], "n long").coalesce(1).write.mode("overwrite").parquet(
        f"{ledger}/batch={number}"
    )
    if not left:
        return rows.limit(0)
    return rows if n <= left else time_prefix(rows, left)


def ingest_to_lake(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL,
    rejects: str | None = None, total: int | None = None,
) -> StreamingQuery:
    """Transactions to the date/hour lake, once per checkpoint.

    The hour of a row without a readable time is that of its micro-batch, which the checkpoint keeps: a
    micro-batch that runs again after a failure has the same rows in the same hours, and replaces its own
    folders, so the lake needs no log of the sink. Batch appends are seen, and expired files may go. A repeat
    sent by the producer is still a second record, which staging removes. Rows with a ``_corrupt`` text (see
    :func:`txn_risk.sources.topic.decode`) go to ``rejects`` as JSON lines, or fail the query if that
    is not given: none is dropped. With ``total``, exactly so many messages are taken in, rejects included;
    :func:`stop_after` ends the query then.
    """
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    routed = "_corrupt" in stream.columns

    def put(rows: DataFrame, number: int) -> None:
        if total is not None:
            rows = admitted(rows, number, f"{checkpoint}-admitted", total)
        good = rows.where("_corrupt is null").drop("_corrupt") if routed else rows
        if routed:
            bad = rows.where("_corrupt is not null").select(F.col("_corrupt").alias("message"))
            if rejects is not None:
                bad.write.mode("overwrite").json(f"{rejects}/batch={query}-{number}")
            elif not bad.isEmpty():
                raise ValueError("messages that are no records, and no folder for rejects")
        write_batch(good, path, f"{query}-{number}")

    return _start(with_partition_keys(stream).writeStream.foreachBatch(put), checkpoint, interval)


def stop_after(query: StreamingQuery, messages: int | None) -> None:
    """Wait for a query; with ``messages``, stop it after the micro-batch that reaches that total. That one
    may hold more; a sink with the same total passes no more (:func:`admitted`)."""
    if messages is None:
        query.awaitTermination()
        return
    seen: dict[int, int] = {}
    while query.isActive:
        for p in query.recentProgress:
            seen[p["batchId"]] = p["numInputRows"]
        if sum(seen.values()) >= messages:
            query.stop()
            return
        query.awaitTermination(1)


def stream_features(
    stream: DataFrame, baseline: Baseline,
) -> DataFrame:
    """The 27 features plus what a score record carries, by the batch's own column functions."""
    ready = with_defaults(stream.where(F.col("cc_num").isNotNull()))
    # Only what is used later crosses to Python.
    counted = with_trailing_count(ready.select(*CARRIED, *ROW_INPUTS))
    profiled = counted.join(as_profile(baseline.cards), "cc_num", "left")
    return project_features(profiled, baseline, CARRIED)


def scored_stream(
    stream: DataFrame, model: Model, baseline: Baseline, alert: float = ALERT_THRESHOLD,
    block: float = BLOCK_THRESHOLD,
) -> DataFrame:
    """Transactions to score records."""
    features = assembler().transform(stream_features(stream, baseline))
    return score_records(score_column(model, features), alert, block)


def write_scores(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL
) -> StreamingQuery:
    """Append score records to the score log, laid out by processing date.

    A micro-batch that runs again appends its records again; the log's readers keep one per key.
    """
    def put(rows: DataFrame, _number: int) -> None:
        append_scores(rows, path)

    return _start(records.writeStream.foreachBatch(put), checkpoint, interval)
