"""Tables of which only some partitions are replaced.

New partitions are written aside first and then put in place by one dynamic partition overwrite. So what is
written may read the table itself, and a run that died is finished by the next one: what lies aside is
either complete, and put in place again, or not, and dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


@dataclass(frozen=True)
class PartitionedTable:
    """A Parquet table under ``path``, in folders by the columns ``by``, which the ``schema`` declares."""

    spark: SparkSession
    path: str
    schema: T.StructType
    by: tuple[str, ...]

    @property
    def _aside(self) -> str:
        return f"{self.path}/_replacing"  # readers pass over names with an underscore

    def complete(self) -> bool:
        """Whether a first replacement has been put in place."""
        return exists(self.spark, f"{self.path}/_complete")

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def finish(self) -> None:
        """Put in place what an earlier run has left complete."""
        if exists(self.spark, f"{self._aside}/_SUCCESS"):
            rows = self.spark.read.schema(self.schema).parquet(self._aside)
            (
                rows.hint("rebalance", *self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*self.by).parquet(self.path)
            )
            if not self.complete():
                fs, mark = file_system(self.spark, f"{self.path}/_complete")
                fs.create(mark).close()
        remove(self.spark, self._aside)

    def replace(self, rows: DataFrame) -> None:
        """Replace each partition that ``rows`` have by their rows; other folders are not touched."""
        self.finish()
        shaped = rows.select(*self.schema.fieldNames()).hint("rebalance", *self.by)
        shaped.write.mode("overwrite").partitionBy(*self.by).parquet(self._aside)
        self.finish()

    def drop(self, values: Iterable[tuple]) -> None:
        """Remove whole partitions, one folder each."""
        for value in values:
            folder = "/".join(f"{c}={v}" for c, v in zip(self.by, value, strict=True))
            remove(self.spark, f"{self.path}/{folder}")

    @contextmanager
    def writing(self) -> Iterator[None]:
        """One writer at a time: a second one fails instead of losing the first one's rows.

        The mark is a file that only one of two can create (on a file system that offers that). A writer that
        was killed leaves it behind; the error names it, and who knows that no writer runs removes it.
        """
        fs, mark = file_system(self.spark, f"{self.path}/_writer")
        try:
            fs.create(mark, False).close()
        except Exception as e:
            if not fs.exists(mark):
                raise
            raise RuntimeError(f"another writer holds the table; if it died, remove {mark.toString()}") from e
        try:
            yield
        finally:
            fs.delete(mark, False)


# Read from a folder's listing, without opening a file.
FILES = "path string, modified_at timestamp, length long"


def files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, modified_at, length)`` of every Parquet file under ``path``, listed without opening any."""
    if not exists(spark, path):
        return spark.createDataFrame([], FILES)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified_at"), "length"
        )
    )


def unread(listed: DataFrame, ledger: str) -> DataFrame:
    """Those of the files that the ledger does not have as they are now: a file written anew counts as new."""
    spark = listed.sparkSession
    if not exists(spark, ledger):
        return listed
    return listed.join(spark.read.schema(FILES).parquet(ledger), ["path", "modified_at", "length"], "left_anti")


def note(read: DataFrame, ledger: str) -> None:
    """Enter files in the ledger, once what was read from them is stored: a run that dies before reads them
    again, and never passes over one."""
    read.select("path", "modified_at", "length").write.mode("append").parquet(ledger)


def folder_values(listed: DataFrame, column: str) -> list[str]:
    """The values of a partition column that the files lie in."""
    value = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    return sorted(r.value for r in listed.select(value.alias("value")).distinct().collect())


def of_files(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of a scan that lie in the chosen files."""
    kept = rows.columns
    return rows.withColumn("_file", F.col("_metadata.file_path")).join(
        chosen.select(F.col("path").alias("_file")), "_file", "left_semi"
    ).select(*kept)
