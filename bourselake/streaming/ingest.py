"""Incremental ingest: new landing files become lake partitions exactly once.

The files that one call finds are one delivery. It is taken in steps, each of which is
recorded in a commit table beside the checkpoint before the next one starts:

1. micro-batches store the new files, by batch number, beside the checkpoint;
2. ``whole=N``: all files are stored, in the batches up to N;
3. the lake's partitions are replaced from them, and a store's tables follow;
4. ``done=N``; the stored batches are dropped.

A call that was stopped is finished by the next one before that takes new files: from step 2
on, its delivery stays what it was, whatever has landed since. A call stopped before that
goes on as if it had not been stopped. Batches up to the last ``done`` never come back.

The files of one delivery are parts: of a partition that several of them hold, all rows
stay, however the files are cut. Where a landing may hold a partition twice in one call,
``identity`` names the columns that tell rows apart; of rows of one identity in several
files those of the latest file stay. A later delivery replaces whole partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourselake.plans import loading
from bourselake.session import drop_path, path_exists
from bourselake.sources import lake

FILE = "_file"


class Commits:
    """Which batches are stored whole and which are done, as names of empty files."""

    def __init__(self, spark: SparkSession, path: str):
        self.kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = self.kind(path)
        self.files = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def last(self, state: str) -> int:
        found = self.files.globStatus(self.kind(self.root, f"{state}=*")) or []
        return max((int(f.getPath().getName().split("=")[1]) for f in found), default=-1)

    def add(self, state: str, batch: int) -> None:
        self.files.mkdirs(self.root)
        self.files.createNewFile(self.kind(self.root, f"{state}={batch}"))


def latest_of(rows: DataFrame, identity: list[str]) -> DataFrame:
    """Of rows of one identity in several files those of the latest file, all of them.

    Only partitions that several files deliver are looked at row by row.
    """
    files = rows.groupBy(*lake.LOGICAL_PARTITION).agg(
        F.min(FILE).alias("_first"), F.max(FILE).alias("_last")
    )
    several = files.filter("_first <> _last").select(*lake.LOGICAL_PARTITION)
    once = rows.join(several, lake.LOGICAL_PARTITION, "left_anti")
    again = rows.join(several, lake.LOGICAL_PARTITION, "left_semi")
    newest = F.max(FILE).over(Window.partitionBy(*dict.fromkeys([*identity, *lake.LOGICAL_PARTITION])))
    kept = again.withColumn("_newest", newest).filter(F.col(FILE) == F.col("_newest"))
    return once.unionByName(kept.drop("_newest"))


def _take(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    max_files: int,
    identity: list[str] | None,
    follow: Callable[[DataFrame], None],
) -> None:
    pending = f"{checkpoint.rstrip('/')}-pending"
    commits = Commits(spark, f"{checkpoint.rstrip('/')}-commits")

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = lake.with_partitions(to_rows(batch))
        if identity and FILE not in rows.columns:
            raise ValueError(f"to_rows must keep {FILE} where rows have an identity")
        rows.write.mode("overwrite").parquet(f"{pending}/batch_no={number}")

    def finish(last: int) -> None:
        if path_exists(spark, pending):
            stored = spark.read.parquet(pending)
            rows = stored.filter(
                (F.col("batch_no") > commits.last("done")) & (F.col("batch_no") <= last)
            ).drop("batch_no")
            if identity:
                rows = latest_of(rows, identity).drop(FILE)
            if not rows.isEmpty():
                lake.write_partitions(rows, path, stored=True)
                follow(rows)
        commits.add("done", last)
        drop_path(spark, pending)

    if commits.last("whole") > commits.last("done"):
        finish(commits.last("whole"))
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
    if identity:
        time, name = (F.col(f"_metadata.file_{c}") for c in ("modification_time", "path"))
        arriving = arriving.select("*", F.struct(time.alias("time"), name.alias("path")).alias(FILE))
    query = (
        arriving.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = max(_batches(spark, pending), default=-1)
    if last > commits.last("done"):
        commits.add("whole", last)
        finish(last)


def _batches(spark: SparkSession, pending: str) -> list[int]:
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = kind(pending)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(kind(root, "batch_no=*")) or []
    return [int(f.getPath().getName().split("=")[1]) for f in found]


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    max_files: int = 1000,
    identity: list[str] | None = None,
) -> None:
    """Take all landing files not yet seen into the lake at ``path``, then stop.

    ``max_files`` only bounds a micro-batch. With ``identity``, ``to_rows`` gets the column
    ``_file`` and has to keep it.
    """
    _take(spark, landing, schema, to_rows, path, checkpoint, max_files, identity, lambda rows: None)


def ingest_into_store(
    store: loading.Store,
    landing: str,
    schema: StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    updated_at: datetime,
    max_files: int = 1000,
    identity: list[str] | None = None,
) -> None:
    """The same for a store: its presence and recorded days follow the delivered rows.

    A call stopped after the lake was written and before the tables is finished by the
    next one: replacing the same partitions by the same rows changes nothing.
    """
    _take(
        store.spark, landing, schema, to_rows, store.lake, checkpoint, max_files, identity,
        lambda rows: loading.record_delivery(store, rows, updated_at),
    )
