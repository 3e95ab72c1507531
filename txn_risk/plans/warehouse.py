"""The batch branch end to end: raw table to stored staging and marts, with the data tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from txn_risk.plans import marts, quality
from txn_risk.plans.staging import STAGED, newest_copy, stage
from txn_risk.session import discard, settle
from txn_risk.sources import lake
from txn_risk.sources.partitions import PartitionedTable, files, folder_values, note, of_files, unread

# Fact rows of a day lie together, so a report's date slicer reads only its days.
DAY = "trans_date"


# Staging lies by the day of the event; rows without a time lie together.
EVENT_DAY = "event_day"
NO_DAY = "none"


def _staging_table(spark: SparkSession, out_dir: str) -> PartitionedTable:
    kinds = {
        "bigint": ("unix_time", "cc_num", "zip_code", "city_population", "is_fraud"),
        "double": ("amount", "customer_lat", "customer_long", "merchant_lat", "merchant_long"),
        "timestamp": ("trans_timestamp", "ingested_at"), "date": ("date_of_birth",),
    }
    kind = {c: k for k, columns in kinds.items() for c in columns}
    fields = ", ".join(f"{c} {kind.get(c, 'string')}" for c in (*STAGED, EVENT_DAY))
    return PartitionedTable(
        spark, f"{out_dir}/{quality.STAGING}", T.StructType.fromDDL(fields), (EVENT_DAY,)
    )


def _by_day(staged: DataFrame) -> DataFrame:
    day = F.coalesce(F.date_format("trans_timestamp", "yyyy-MM-dd"), F.lit(NO_DAY))
    return staged.withColumn(EVENT_DAY, day)


def build(
    raw: DataFrame, out_dir: str, as_of: dt.date | None = None,
) -> marts.Star:
    """Write staging, then the three marts from it, under ``out_dir``; returns the stored marts.

    Always from the whole raw table: counts, statistics and latest records of a slice would be those
    of the slice. Staging is stored first because every mart reads it, each only some of its columns.
    """
    build_staging(raw, out_dir)
    return build_marts(raw.sparkSession, out_dir, as_of)


def build_staging(raw: DataFrame, out_dir: str) -> None:
    """Write staging of the whole raw table."""
    (
        _by_day(stage(raw)).hint("rebalance", EVENT_DAY)
        .write.mode("overwrite").partitionBy(EVENT_DAY).parquet(f"{out_dir}/{quality.STAGING}")
    )


def build_marts(spark: SparkSession, out_dir: str, as_of: dt.date | None = None) -> marts.Star:
    """The three marts from stored staging; returns them as stored."""
    made = marts.star(staging(spark, out_dir), as_of, by_day=True)
    made.customers.write.mode("overwrite").parquet(f"{out_dir}/{quality.CUSTOMERS}")
    made.merchants.write.mode("overwrite").parquet(f"{out_dir}/{quality.MERCHANTS}")
    (
        made.fact.withColumn(DAY, F.to_date("trans_timestamp"))
        .write.mode("overwrite").partitionBy(DAY).parquet(f"{out_dir}/{quality.FACT}")
    )
    return read(spark, out_dir)


def refresh_staging(spark: SparkSession, raw_path: str, out_dir: str) -> list[str]:
    """Bring stored staging up to date with the loads since the last time; returns the event days replaced.

    A ledger beside staging names the raw files already staged; only the ingest dates that hold others are
    scanned. A transaction loaded again may have another event time, so its earlier copy is looked for
    by key over all days (two columns); days that hold either copy are read and replaced whole, all others
    stay as they are. The result is that of staging the whole raw table.

    A run that dies is repeated by the next one, with the same result.
    """
    table = _staging_table(spark, out_dir)
    ledger = f"{out_dir}/_staged_files"
    with PartitionedTable(spark, out_dir, table.schema, ()).writing():
        table.finish()
        new = settle(unread(files(spark, raw_path), ledger), "new-raw-files")
        dates = folder_values(new, "ingest_date")
        if not dates:
            discard(new)
            return []
        rows = lake.read_raw(spark, raw_path).where(F.col("ingest_date").cast("string").isin(dates))
        fresh = settle(_by_day(stage(of_files(rows, new))), "fresh-rows")
        before = table.read()
        earlier = before.select("trans_num", EVENT_DAY).join(fresh.select("trans_num"), "trans_num", "left_semi")
        days = sorted(r[0] for r in fresh.select(EVENT_DAY).union(earlier.select(EVENT_DAY)).distinct().collect())
        merged = settle(newest_copy(before.where(F.col(EVENT_DAY).isin(days)).unionByName(fresh)), "merged-days")
        table.replace(merged)
        left = {r[0] for r in merged.select(EVENT_DAY).distinct().collect()}
        # A day whose last transaction has moved to another.
        table.drop([(d,) for d in days if d not in left])
        note(new, ledger)
        discard(new, fresh, merged)
    return days


def refresh(spark: SparkSession, raw_path: str, out_dir: str, as_of: dt.date | None = None) -> marts.Star:
    """Staging by the new loads alone, then the marts from stored staging.

    The marts are made from all of it: a card's statistics change with every transaction, and with them
    the z-scores of all its rows.
    """
    refresh_staging(spark, raw_path, out_dir)
    return build_marts(spark, out_dir, as_of)


def staging(spark: SparkSession, out_dir: str) -> DataFrame:
    return _staging_table(spark, out_dir).read().select(*STAGED)


def read(spark: SparkSession, out_dir: str) -> marts.Star:
    """The stored marts; the fact also has its day, :data:`DAY`."""
    return marts.Star(*[
        spark.read.parquet(f"{out_dir}/{name}")
        for name in (quality.CUSTOMERS, quality.MERCHANTS, quality.FACT)
    ])


def check(spark: SparkSession, out_dir: str) -> DataFrame:
    """The declared data tests over the stored tables."""
    star = read(spark, out_dir)
    return quality.quality_report({
        quality.STAGING: staging(spark, out_dir), quality.CUSTOMERS: star.customers,
        quality.MERCHANTS: star.merchants, quality.FACT: star.fact,
    })
