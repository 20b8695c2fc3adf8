"""Dimension tables, built once per application and stored for all its queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bourselake.session import scratch_path

_STORED: dict[tuple[str, str], tuple[str, StructType]] = {}


def stored(
    spark: SparkSession, name: str, build: Callable[[SparkSession], DataFrame]
) -> DataFrame:
    """The dimension as a table in the shared folder; built on first use.

    Only for dimensions whose size is fixed by their definition. As a table its
    size is known to the optimizer and any executor can read it again.
    """
    key = (spark.sparkContext.applicationId, name)
    if key in _STORED:
        path, schema = _STORED[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:  # the shared folder was cleared
            del _STORED[key]
    rows = build(spark)
    path = scratch_path(spark, name)
    rows.coalesce(1).write.parquet(path)
    _STORED[key] = (path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path)


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """Calendar exceptions from CSV files with a header; see ``calendars.calendar_day``."""
    return (
        spark.read.schema("calendar string, day date, kind string, close_clock string")
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
