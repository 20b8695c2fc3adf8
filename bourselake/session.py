"""Session settings the lake relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # TIMESTAMP(NANOS) Parquet columns are read as bigint nanoseconds.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(master: str, shuffle_partitions: int, **extra: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("bourselake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key over all shuffle partitions, eight a core at least.

    Shuffles of the planner's own are merged by their packed bytes into about one task a
    core, whose sorts and hash tables then hold all of a core's rows at once. A number that
    is asked for stays.
    """
    context = rows.sparkSession.sparkContext
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(usual, 8 * context.defaultParallelism), *keys)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder path under the folder all executors share.

    That is the folder in ``spark.checkpoint.dir``; where it is unset, a folder
    of the session's warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{root.rstrip('/')}/bourselake/{name}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back.

    Overwriting a table that the same plan reads loses data if a task fails;
    staging first separates the two, and a retry starts from stored rows.
    """
    return _stored_at(spark, rows, scratch_path(spark, name))


def _stored_at(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that stages tables until the block ends, then removes them all."""
    root = scratch_path(spark, "staging")
    try:
        yield lambda rows, name: _stored_at(spark, rows, f"{root}/{name}")
    finally:
        drop_path(spark, root)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that lies in it, in whatever store it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at the path, in whatever store it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
