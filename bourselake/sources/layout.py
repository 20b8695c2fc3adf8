"""File layouts with one folder per key: export, import, sizes and bounds.

Two spellings are read: files dataset/symbol/schema/YYYY/MM[/DD].parquet, and the folders
dataset=/symbol=/schema_=/year=/month=/day= that an export writes (day 0 for monthly
schemas). The symbol is spelt with underscores in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType

from bourselake.functions import eventtime, symbols
from bourselake.operators import coverage
from bourselake.operators.coverage import KEY, PARTITION
from bourselake.session import scratch_path

# Fixed value: the layout of partition files, symbol spelt with underscores.
FILE_PATTERN = r"[^/]+/[^/]+/[^/]+/[0-9]{4}/[0-9]{2}(/[0-9]{2})?\.parquet$"
FOLDERS = [*KEY, *PARTITION]
FOLDER_PATTERN = "/".join(f"{name}=([^/]+)" for name in FOLDERS) + r"/[^/]+\.parquet$"
FOLDER_KINDS = "dataset string, symbol string, schema_ string, year int, month int, day int"
# What Spark says of a footer without bounds.
NO_BOUNDS = "No min/max found for Parquet file"
# Settings under which min and max of a column are taken from Parquet footers.
FOOTER_SETTINGS = {
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
}


def write_layout(rows: DataFrame, root: str) -> None:
    """Export rows (key, trade_date, payload) as folders, one per key and partition.

    A partition that holds a large share of the rows is written by several tasks, as
    several files of its folder.
    """
    year, month, day = coverage.partition_columns(F.col("schema_"), F.col("trade_date"))
    (
        rows.select("*", year, month, day)
        .withColumn("symbol", symbols.path_symbol(F.col("symbol")))
        .hint("rebalance", *FOLDERS)
        .sortWithinPartitions(*FOLDERS)
        .write.partitionBy(*FOLDERS)
        .parquet(root)
    )


def parse_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """Add the key and partition told by each file's path; other files drop out."""
    parts = F.split(F.regexp_replace(path, r"\.parquet$", ""), "/")
    # Daily files have one folder more: counted from the end, all shift by one.
    daily = F.length(F.element_at(parts, -2)) == 2

    in_folders = F.col(path).rlike(FOLDER_PATTERN)

    def part(name: str, plain: Column) -> Column:
        named = F.regexp_extract(path, FOLDER_PATTERN, FOLDERS.index(name) + 1)
        value = F.when(in_folders, named).otherwise(plain)
        return (value.cast("int") if name in PARTITION else value).alias(name)

    def place(back: int) -> Column:
        return F.try_element_at(parts, F.when(daily, -back - 1).otherwise(-back))

    return files.filter(in_folders | F.col(path).rlike(FILE_PATTERN)).select(
        "*",
        part("dataset", place(5)),
        part("symbol", place(4)),
        part("schema_", place(3)),
        part("year", place(2)),
        part("month", place(1)),
        part("day", F.when(daily, F.element_at(parts, -1)).otherwise("0")),
    )


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every Parquet file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", F.col("length").alias("size_bytes"))
    )


def read_layout(spark: SparkSession, root: str) -> DataFrame:
    """All rows below ``root`` with the key and partition of their file."""
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", True)
        .parquet(root)
    )
    return parse_paths(
        rows.withColumn("path", F.col("_metadata.file_path"))
    ).drop("path")


def partition_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows, files and bytes of every partition below ``root``, as its files are read."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
        .groupBy(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .agg(F.count("*").alias("file_rows"))
    )
    return (
        parse_paths(files)
        .groupBy(*FOLDERS)
        .agg(
            F.sum("file_rows").alias("n_rows"),
            F.count("*").alias("n_files"),
            F.sum("file_size").alias("size_bytes"),
        )
    )


@contextmanager
def footers_answer(spark: SparkSession) -> Iterator[None]:
    """Aggregates reach the Parquet footers inside the block; settings are put back."""
    before = {name: spark.conf.get(name, None) for name in FOOTER_SETTINGS}
    try:
        for name, value in FOOTER_SETTINGS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _file_columns(spark: SparkSession, root: str) -> list[StructField]:
    """Columns in the files of an export, in their order there; none without files."""
    try:
        found = spark.read.parquet(root).schema
    except AnalysisException as failed:
        if failed.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []
    return [field for field in found if field.name not in FOLDERS]


def footer_bounds(spark: SparkSession, root: str, column: str) -> DataFrame:
    """Least and largest value of a bigint column per folder of an export.

    A footer's bounds are looked up by the column's place, so the schema asked for must list
    all columns of the files in their order; the export wrote all files alike.
    """
    columns = _file_columns(spark, root) or [StructField(column, LongType())]
    folders = StructType.fromDDL(FOLDER_KINDS).fields
    rows = spark.read.schema(StructType([*columns, *folders])).parquet(root)
    return rows.groupBy(*FOLDERS).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def _footers_tell(spark: SparkSession, root: str) -> bool:
    """Whether places of columns and of their footers agree: no column has parts."""
    nested = (ArrayType, MapType, StructType)
    return not any(isinstance(f.dataType, nested) for f in _file_columns(spark, root))


def observed_range_files(
    spark: SparkSession, root: str, column: str = "ts_event_ns"
) -> DataFrame:
    """First and last date of each partition folder of an export, from footers alone.

    ``column`` holds integer nanoseconds. No row is read: each file's footer yields one pair
    of bounds, so the work grows with the number of files. A file whose values are all null
    has no bounds in its footer; with such a file among them the column is read instead, and
    its folder gets null bounds. So it is for rows with arrays, maps or structs. An export
    without rows gives no rows. The result is stored, because the settings that let
    aggregates reach footers hold only here.
    """
    path = scratch_path(spark, "footers")
    told = _footers_tell(spark, root)
    if told:
        try:
            with footers_answer(spark):
                bounds = footer_bounds(spark, root, column)
                bounds.write.parquet(path)
        except Py4JJavaError as failed:
            if NO_BOUNDS not in str(failed):
                raise
            told = False
    if not told:
        bounds = footer_bounds(spark, root, column)
        bounds.write.mode("overwrite").parquet(path)
    return (
        spark.read.schema(bounds.schema)
        .parquet(path)
        .select(
            *FOLDERS,
            eventtime.nanos_to_date(F.col("low")).alias("first_date"),
            eventtime.nanos_to_date(F.col("high")).alias("last_date"),
        )
    )


def key_bounds(bounds: DataFrame) -> DataFrame:
    """First and last date per key, of the bounds of its files; dotted symbols."""
    return (
        bounds.withColumn("symbol", symbols.symbol_from_path(F.col("symbol")))
        .groupBy(*KEY)
        .agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    )


def size_rollup(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Bytes and files per key."""
    return manifest.groupBy(*keys).agg(
        F.sum("size_bytes").cast("bigint").alias("size_bytes"),
        F.count("*").alias("n_files"),
    )
