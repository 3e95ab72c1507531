"""Keyed score table on plain files.

Scoring appends to a log, laid out by processing date, so retries and parallel writers never overwrite
what somebody reads; the latest record per ``trans_num`` wins when it is read. A table keyed by
``trans_num`` lies in buckets of its keys; an upsert replaces those buckets that its records fall into.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from txn_risk.functions import coerce_double, coerce_int
from txn_risk.operators.dedup import latest_per_key
from txn_risk.schemas import SCORE
from txn_risk.session import discard, settle
from txn_risk.sources.partitions import (
    PartitionedTable, exists, file_system, files, folder_values, note, of_files, remove, unread,
)

# Days without a readable processing time.
NO_DATE = "none"
_LOG = T.StructType(SCORE.fields + [T.StructField("processed_date", T.StringType(), True)])


def processed_time() -> Column:
    """The processing time as an instant, whatever ISO form it was written in; null if unreadable."""
    return F.try_to_timestamp(F.col("processed_at"))


def with_date(records: DataFrame) -> DataFrame:
    """Add the log's partition, ``processed_date``."""
    day = F.coalesce(F.date_format(processed_time(), "yyyy-MM-dd"), F.lit(NO_DATE))
    return records.select(*SCORE.fieldNames()).withColumn("processed_date", day)


def append_scores(records: DataFrame, path: str) -> None:
    """Insert or replace: a record replaces an older one of its key by being later."""
    with_date(records).write.mode("append").partitionBy("processed_date").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LOG).parquet(path)


def latest_scores(log: DataFrame) -> DataFrame:
    """One record per transaction, the last processed."""
    timed = log.select(*SCORE.fieldNames()).withColumn("_processed", processed_time())
    return latest_per_key(timed, ["trans_num"], ["_processed", "processed_at"]).drop("_processed")


def newest_of_log(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The ``n`` last processed transactions of a log, reading its newest days only.

    A later record of a key lies in a later day, so what older days hold cannot change the answer. Days are
    listed from their folders and their keys read once each, newest first, until ``n`` are known.
    """
    log = read_log(spark, path)
    days = folder_values(files(spark, path), "processed_date")
    days.sort(key=lambda d: (d != NO_DATE, d), reverse=True)
    chosen: list[str] = []
    seen = spark.createDataFrame([], "trans_num string")
    for day in days:
        chosen.append(day)
        own = log.where(F.col("processed_date") == day).select("trans_num").distinct()
        more = settle(seen.unionByName(own.join(seen, "trans_num", "left_anti").limit(n)), "newest-keys")
        discard(seen)
        seen = more
        if seen.count() >= n:
            break
    discard(seen)
    return newest(latest_scores(log.where(F.col("processed_date").isin(chosen))), n)


# Buckets that a new table has, and rows that its fullest bucket may hold before their number doubles.
BUCKETS = 64
BUCKET_ROWS = 2_000_000
_TABLE = T.StructType(SCORE.fields + [T.StructField("bucket", T.IntegerType(), True)])


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, table: str, buckets: int) -> PartitionedTable:
    return PartitionedTable(spark, f"{table}/of={buckets}", _TABLE, ("bucket",))


def _layouts(spark: SparkSession, table: str) -> list[int]:
    """Numbers of buckets for which the table is complete, rising; more than one only while it is dealt anew."""
    fs, root = file_system(spark, table)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    found = sorted(int(n[3:]) for n in names if n.startswith("of=") and n[3:].isdigit())
    return [n for n in found if _layout(spark, table, n).complete()]


def _current(spark: SparkSession, table: str, buckets: int = BUCKETS) -> tuple[PartitionedTable, int]:
    n = max(_layouts(spark, table), default=buckets)
    return _layout(spark, table, n), n


def read_compacted(spark: SparkSession, table: str) -> DataFrame:
    """The keyed table, one record per transaction; empty before the first upsert."""
    return _current(spark, table)[0].read()


def lookup(spark: SparkSession, table: str, trans_num: str) -> DataFrame:
    """A transaction's record in the keyed table; only its bucket is read."""
    held, n = _current(spark, table)
    return held.read().where((F.col("bucket") == _bucket(F.lit(trans_num), n)) & (F.col("trans_num") == trans_num))


def upsert(updates: DataFrame, table: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Insert or replace by key; returns the buckets rewritten.

    The latest record of a key stays, so the same updates again leave the same rows. Only buckets that the
    updates hit are read and replaced; the files of all others stay as they are. One that would hold more than
    ``bucket_rows`` has the table dealt anew into twice as many. A second writer fails. Readers that have
    listed a bucket's files before it is replaced fail and may ask again.
    """
    spark = updates.sparkSession
    held, n = _current(spark, table, buckets)
    with PartitionedTable(spark, table, _TABLE, ("bucket",)).writing():
        held.finish()
        for old in _layouts(spark, table)[:-1]:  # a run died after it had dealt the table anew
            remove(spark, f"{table}/of={old}")
        new = settle(
            latest_scores(updates.select(*SCORE.fieldNames())).withColumn("bucket", _bucket(F.col("trans_num"), n)),
            "score-updates",
        )
        hit = [r.bucket for r in new.select("bucket").distinct().collect()]
        if not hit:
            return []
        if exists(spark, held.path):
            before = held.read().where(F.col("bucket").isin(hit))
            held.replace(latest_scores(before.unionByName(new)).withColumn("bucket", _bucket(F.col("trans_num"), n)))
        else:
            held.replace(new)  # one record per transaction already
        discard(new)
        fullest = held.read().where(F.col("bucket").isin(hit)).groupBy("bucket").count().agg(F.max("count")).first()[0]
        wanted = n
        while fullest > bucket_rows * (wanted // n):
            wanted *= 2
        if wanted > n:
            _layout(spark, table, wanted).replace(held.read().withColumn("bucket", _bucket(F.col("trans_num"), wanted)))
            remove(spark, held.path)
        return sorted(hit)


def compact(spark: SparkSession, log: str, table: str, **given: int) -> list[int]:
    """Upsert what the score log has got since the last time; returns the buckets rewritten.

    A ledger beside the table names the log's files already taken in; only the days that hold others are
    scanned, and of those days only the other files' rows are used. Files are entered once their records are
    stored: a run that dies takes them again, which changes nothing.
    """
    ledger = f"{table}/_log_files"
    new = settle(unread(files(spark, log), ledger), "new-log-files")
    days = folder_values(new, "processed_date")
    if not days:
        discard(new)
        return []
    rows = of_files(read_log(spark, log).where(F.col("processed_date").isin(days)), new)
    hit = upsert(rows, table, **given)
    note(new, ledger)
    discard(new)
    return hit


def newest(scores: DataFrame, n: int) -> DataFrame:
    """The ``n`` last processed records."""
    kept = scores.withColumn("_processed", F.col("processed_at").try_cast("timestamp"))
    return kept.orderBy(F.col("_processed").desc_nulls_last(), "trans_num").limit(n).drop("_processed")


def read_stores(stores: Sequence[DataFrame], n: int = 500) -> DataFrame:
    """The newest ``n`` transactions over several stores; for a key in more than one, the first store
    wins. A store may be a log with repeats: its keys are made unique first.

    Unreadable numbers become 0 and unreadable times null.
    """
    ranked = [newest(latest_scores(s), n).withColumn("_store", F.lit(i)) for i, s in enumerate(stores)]
    both = reduce(DataFrame.unionByName, ranked)
    # At most n rows per store from here on.
    kept = both.withColumn("_first", F.lit(0) - F.col("_store"))
    unique = latest_per_key(kept, ["trans_num"], ["_first", "processed_at"]).drop(
        "_store", "_first"
    )
    typed = unique.withColumn("processed_at", F.try_to_timestamp(F.col("processed_at"))).withColumns({
        **{c: coerce_double(F.col(c)) for c in (
            "amt", "fraud_score", "latency_ms", "geo_distance_km", "amt_zscore_by_customer",
        )},
        "txn_freq_24h": coerce_int(F.col("txn_freq_24h")),
    })
    return newest(typed, n)
