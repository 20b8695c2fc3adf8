"""Positions in a global order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourselake.session import staged

# monotonically_increasing_id keeps the partition above the lower 33 bits.
ROW_BITS = 33


def with_position(
    spark: SparkSession, rows: DataFrame, listing: list[str], order: list[str | Column]
) -> DataFrame:
    """Number the rows of each listing from 1 in the given order.

    Rows are range-partitioned by listing and order and sorted per partition.
    A row's position is its number in the partition plus the rows of its listing
    in earlier partitions; those counts are one row per listing and partition.
    The sorted rows are stored, because a second run of the range partitioning
    may cut elsewhere. Rows of equal order are numbered arbitrarily.
    """
    ordered = rows.repartitionByRange(*listing, *order).sortWithinPartitions(
        *listing, *order
    )
    stored = staged(
        spark, ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("_id", ROW_BITS).alias("_part")
    pieces = stored.groupBy(*listing, part).agg(
        F.min("_id").alias("_first_id"), F.count("*").alias("_size")
    )
    earlier = (
        Window.partitionBy(*listing)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.withColumn(
        "_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    )
    return (
        stored.withColumn("_part", part)
        .join(offsets, [*listing, "_part"])
        .withColumn("position", F.col("_id") - F.col("_first_id") + F.col("_before") + 1)
        .select(*rows.columns, "position")
    )
