"""The date/hour partitioned Parquet lake and the raw warehouse table loaded from it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from txn_risk.functions import parse_timestamp_lenient
from txn_risk.operators.dedup import first_per_key, one_per_seldom_repeated
from txn_risk.schemas import EVENT, RAW
from txn_risk.session import discard, settle
from txn_risk.sources.partitions import (
    file_system, files, folder_values, note, of_files, remove, unread,
)

PARTITIONS = ("dt", "hour")
# The level below the hour, one folder per write, and in merged files the write a row came with.
BATCH = "batch"
SOURCE = "_source"

# Declared, so that "02" stays text and is not read back as a number.
LAKE = T.StructType(
    EVENT.fields + [T.StructField(c, T.StringType(), True) for c in PARTITIONS]
)


def with_partition_keys(rows: DataFrame) -> DataFrame:
    """Add ``dt`` (yyyy-MM-dd) and ``hour`` (HH) of the event time; unreadable times count as now."""
    at = F.coalesce(parse_timestamp_lenient(F.col("trans_date_trans_time")), F.current_timestamp())
    return rows.withColumns({
        "dt": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH"),
    })


def write_lake(rows: DataFrame, path: str) -> None:
    """Append as Snappy Parquet under ``dt=…/hour=…/batch=…``, as a batch of its own name."""
    write_batch(with_partition_keys(rows), path, uuid.uuid4().hex)


def write_batch(keyed: DataFrame, path: str, batch: str) -> None:
    """Write rows with their ``dt`` and ``hour`` as one batch, once however often it is repeated: the folders
    of a batch of the same name are replaced by the writer's commit, and no others.

    Rows are first brought together by hour, so an hour gets few files instead of one per task.
    The rebalance splits an hour that outgrows the advisory partition size over several tasks and
    merges small ones, so one busy hour is not one task.
    """
    (
        keyed.select(*EVENT.fieldNames(), *PARTITIONS).withColumn(BATCH, F.lit(batch)).hint("rebalance", *PARTITIONS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS, BATCH)
        .option("compression", "snappy").parquet(path)
    )


def merge_hours(spark: SparkSession, path: str, closed_before: dt.datetime, ledger: str | None = None) -> int:
    """Bring the batches of each closed hour together into one; returns the number of hours merged.

    An hour counts if it ended before ``closed_before`` and has several files, and with the ``ledger`` of a
    load only if all of them are in it; the merged files are entered there, so they are not loaded again.
    Merged rows carry the batch they came from. A run that dies between writing and removing leaves rows
    twice in the lake, never fewer (staging keeps one of each); the next run leaves out what was merged.
    """
    listed = files(spark, path).withColumns({
        c: F.regexp_extract("path", f"/{c}=([^/]+)/", 1) for c in (*PARTITIONS, BATCH)
    })
    ends = F.try_to_timestamp(F.concat_ws(" ", *PARTITIONS), F.lit("yyyy-MM-dd HH")) + F.expr("INTERVAL 1 HOUR")
    listed = settle(listed.where((ends <= F.lit(closed_before)) & (F.col(BATCH) != "")), "closed-files")
    hours = listed.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    if ledger is not None:
        hours = hours.join(unread(listed.select("path", "modified_at", "length", *PARTITIONS), ledger), [*PARTITIONS], "left_anti")
    hours = settle(hours, "closed-hours")
    days = sorted(r.dt for r in hours.select("dt").distinct().collect())
    n_hours = hours.count()
    if n_hours:
        schema = T.StructType(LAKE.fields + [T.StructField(c, T.StringType(), True) for c in (SOURCE, BATCH)])
        rows = spark.read.schema(schema).parquet(path).where(F.col("dt").isin(days)).join(
            hours, [*PARTITIONS], "left_semi"
        )
        merged_before = rows.where(F.col(SOURCE).isNotNull()).select(*PARTITIONS, F.col(SOURCE).alias(BATCH)).distinct()
        own = rows.join(merged_before, [*PARTITIONS, BATCH], "left_anti")
        name = f"merged-{uuid.uuid4().hex}"
        (
            own.withColumn(SOURCE, F.coalesce(SOURCE, BATCH)).withColumn(BATCH, F.lit(name))
            .select(*EVENT.fieldNames(), SOURCE, *PARTITIONS, BATCH).hint("rebalance", *PARTITIONS)
            .write.mode("append").partitionBy(*PARTITIONS, BATCH).option("compression", "snappy").parquet(path)
        )
        if ledger is not None:
            note(files(spark, path).where(F.col("path").contains(f"/{BATCH}={name}/")), ledger)
        # Names of folders stream to the driver, which alone can call the file system.
        for old in listed.join(hours, [*PARTITIONS], "left_semi").select(*PARTITIONS, BATCH).distinct().toLocalIterator():
            remove(spark, f"{path}/dt={old.dt}/hour={old.hour}/{BATCH}={old.batch}")
    discard(listed, hours)
    return n_hours


def read_lake(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """All Parquet files under ``path``, optionally only days ``[start, end]`` (pruned by
    directory). An unreadable file fails the query, unless told otherwise: a transient error would
    else look like missing rows. :func:`unreadable_files` names what a lenient read leaves out."""
    rows = (
        spark.read.schema(LAKE)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", skip_unreadable)
        .parquet(path)
    )
    rows = rows.select(*LAKE.fieldNames()) if BATCH in rows.columns else rows
    if start is not None:
        rows = rows.where(F.col("dt") >= start)
    if end is not None:
        rows = rows.where(F.col("dt") <= end)
    return rows


def unreadable_files(spark: SparkSession, path: str, listed: DataFrame, days: list[str] | None = None) -> DataFrame:
    """``path`` of each of the listed files of the lake that cannot be read to its end; with ``days``, only
    those are looked at. A sound file without rows is not among them; one that breaks off after some rows is.

    Each file is read whole in a Python worker, so it is bounded by that worker's memory.
    """
    def tried(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from io import BytesIO

        import pyarrow.parquet as pq

        for frame in frames:
            bad = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    file = pq.ParquetFile(BytesIO(content))
                    for k in range(file.num_row_groups):
                        file.read_row_group(k)
                except Exception:
                    bad.append(path)
            yield pd.DataFrame({"path": pd.Series(bad, dtype="object")})

    content = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        .where(F.lit(True) if days is None else F.col("dt").cast("string").isin(days))
        .select(F.col("_metadata.file_path").alias("path"), "content")
        .join(listed.select("path"), "path", "left_semi")
    )
    return content.mapInPandas(tried, "path string")


def raw_rows(
    lake: DataFrame, ingested_at: dt.datetime, modified_after: dt.datetime | None = None
) -> DataFrame:
    """Lake rows as one load of the raw table: first row per transaction, one load time.

    Every load rescans the lake, as staging keeps the latest load. ``modified_after`` limits it to
    files written since. A record without its key breaks the table's contract and fails the load.
    """
    rows = lake
    if modified_after is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") > F.lit(modified_after))
    # Repeats of a transaction are replays of one record; the earliest sent is kept.
    kept = one_per_seldom_repeated(
        rows.select(*EVENT.fieldNames()), "trans_num", lambda r: first_per_key(r, ["trans_num"], ["produced_at"]),
    )
    key = F.coalesce("trans_num", F.raise_error(F.lit("trans_num is required")))
    return kept.withColumns({
        "trans_num": key, "ingested_at": F.lit(ingested_at).cast("timestamp"),
    }).select(*RAW.fieldNames())


def append_raw(rows: DataFrame, path: str) -> None:
    """Append to the raw table, partitioned by ingest date."""
    (
        rows.withColumn("ingest_date", F.to_date("ingested_at"))
        .write.mode("append").partitionBy("ingest_date").parquet(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(RAW.fields + [T.StructField("ingest_date", T.DateType(), True)])
    return spark.read.schema(schema).parquet(path)


def load(
    spark: SparkSession, lake_path: str, raw_path: str, ingested_at: dt.datetime,
    modified_after: dt.datetime | None = None, skip_unreadable: bool = False, ledger: str | None = None,
) -> dict[str, int | str]:
    """Lake to raw table. Returns ``status``, ``files_loaded``, ``files_skipped``, ``rows_loaded`` and
    ``total_table_rows``.

    Every load rescans the lake, unless ``modified_after`` or a ``ledger`` limits it. A ledger is a folder that
    remembers the files loaded; a load with it scans only the days that hold others, and enters them once
    their rows are stored. So a load that dies is repeated and none is passed over. A file left out as
    unreadable is left out whole, and not entered.
    """
    listed = lake_files(spark, lake_path)
    if modified_after is not None:
        listed = listed.where(F.col("modified_at") > F.lit(modified_after))
    if ledger is not None:
        listed = unread(listed, ledger)
    listed = settle(listed, "lake-files")
    n_files = listed.count()
    if not n_files:
        return {"status": "EMPTY", "files_loaded": 0, "files_skipped": 0, "rows_loaded": 0}
    rows = read_lake(spark, lake_path, skip_unreadable=skip_unreadable)
    days = folder_values(listed, "dt") if ledger is not None else None
    skipped = 0
    if skip_unreadable:
        bad = settle(unreadable_files(spark, lake_path, listed, days), "unreadable-files")
        skipped = bad.count()
        listed = listed.join(bad, "path", "left_anti")
    if days is not None:
        rows = rows.where(F.col("dt").isin(days))
    if days is not None or skip_unreadable:
        rows, modified_after = of_files(rows, listed), None
    append_raw(raw_rows(rows, ingested_at, modified_after), raw_path)
    if ledger is not None:
        note(listed, ledger)
    table = read_raw(spark, raw_path)
    # One ingest date is scanned for the load, and no column at all for the table's size.
    loaded = table.where(
        (F.col("ingest_date") == F.to_date(F.lit(ingested_at)))
        & (F.col("ingested_at") == F.lit(ingested_at))
    ).count()
    return {
        "status": "SUCCESS" if not skipped else "PARTIAL", "files_loaded": n_files - skipped,
        "files_skipped": skipped, "rows_loaded": loaded,
        "total_table_rows": table.count(),
    }


lake_files = files


def expired_files(
    spark: SparkSession, path: str, now: dt.datetime, keep_days: int = 7
) -> DataFrame:
    """Files last modified before ``now`` minus ``keep_days``."""
    cutoff = now - dt.timedelta(days=keep_days)
    return lake_files(spark, path).where(F.col("modified_at") < F.lit(cutoff))


def remove_expired(
    spark: SparkSession, path: str, now: dt.datetime, keep_days: int = 7, dry_run: bool = True
) -> int:
    """Delete exactly the expired files and directories left empty; returns the number of files.

    The folder of a batch whose files have all expired goes in one call. Names stream to the driver one
    partition at a time, since only it can call the file system; the data is not read.
    """
    cutoff = now - dt.timedelta(days=keep_days)
    old = F.col("modified_at") < F.lit(cutoff)
    folders = lake_files(spark, path).groupBy(F.regexp_replace("path", "/[^/]+$", "").alias("folder")).agg(
        F.count_if(old).alias("n_old"), F.count_if(~old).alias("n_kept"),
        F.collect_list(F.when(old, F.col("path"))).alias("files"),  # of one folder, hence of one write
    ).where("n_old > 0")
    removed = 0
    fs, top = file_system(spark, path)
    top = fs.makeQualified(top)
    for row in folders.toLocalIterator():
        removed += row.n_old
        if dry_run:
            continue
        # Listed paths are URIs.
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.folder))
        if f"/{BATCH}=" in row.folder and not row.n_kept:
            fs.delete(folder, True)
            folder = folder.getParent()
        else:
            for file in row.files:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)), False)
        while not folder.equals(top) and not fs.listStatus(folder):
            parent = folder.getParent()
            fs.delete(folder, False)
            folder = parent
    return removed
