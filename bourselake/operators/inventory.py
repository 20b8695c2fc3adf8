"""Inventory reports over the catalog: groups, gaps, totals, listing order."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.functions import symbols
from bourselake.functions.vocab import BAR_SCHEMA_RANK, OTHER_SCHEMA_RANK
from bourselake.operators import ranking


def schema_rank(schema: Column) -> Column:
    """Coarse bars first; schemas without a rank last."""
    ranks = F.create_map(*[F.lit(x) for x in chain(*BAR_SCHEMA_RANK.items())])
    return F.coalesce(F.element_at(ranks, schema), F.lit(OTHER_SCHEMA_RANK))


def with_contract_parts(items: DataFrame) -> DataFrame:
    """Root, year and month of supported contracts; null for anything else."""
    symbol = F.col("symbol")
    supported = symbols.is_supported_contract(symbol)
    return items.withColumns(
        {
            "contract_root": F.when(supported, symbols.contract_root(symbol)),
            "contract_year": F.when(supported, symbols.contract_year(symbol)),
            "contract_month": F.when(supported, symbols.contract_month(symbol)),
        }
    )


def with_sort_key(items: DataFrame) -> DataFrame:
    """Listing order: root, continuous before contracts before the rest, date."""
    symbol = F.col("symbol")
    supported = symbols.is_supported_contract(symbol)
    rolling = symbol.contains(".c.") | symbols.has_lookahead_bias(symbol)
    return items.withColumns(
        {
            "sort_root": F.when(supported, symbols.contract_root(symbol))
            .when(rolling, F.substring_index(symbol, ".", 1))
            .otherwise(symbol),
            "sort_kind": F.when(supported, 1).when(rolling, 0).otherwise(2),
            "sort_year": F.when(supported, symbols.contract_year(symbol)).otherwise(0),
            "sort_month": F.when(supported, symbols.contract_month(symbol)).otherwise(0),
            "sort_schema": schema_rank(F.col("schema_")),
        }
    )


SORT_KEY = [
    "sort_root", "sort_kind", "sort_year", "sort_month", "sort_schema", "schema_",
]


def inventory_order(
    spark: SparkSession, items: DataFrame, listing: list[str]
) -> DataFrame:
    """Place of each item in its listing."""
    return ranking.with_position(
        spark, with_sort_key(items), listing, [*SORT_KEY, "symbol"]
    )


def inventory_groups(items: DataFrame, listing: list[str]) -> DataFrame:
    """Contracts grouped by root and schema: count, first, last, bytes, issues.

    ``has_gaps`` tells whether a quarterly contract between the first and the
    last one is absent; serial-month contracts do not hide it.
    """
    number = F.col("contract_year") * 12 + F.col("contract_month") - 1
    quarter = F.when(F.col("contract_month") % 3 == 0, number)
    grouped = (
        with_contract_parts(items)
        .filter(F.col("contract_root").isNotNull())
        .withColumn("_no", number)
        .groupBy(*listing, F.col("contract_root").alias("root"), "schema_")
        .agg(
            F.count("*").alias("n_contracts"),
            F.min_by("symbol", "_no").alias("first_symbol"),
            F.max_by("symbol", "_no").alias("last_symbol"),
            F.sum("size_bytes").cast("bigint").alias("size_bytes"),
            F.sum("n_issues").cast("bigint").alias("n_issues"),
            F.count_distinct(quarter).alias("n_quarterly"),
            F.min("_no").alias("_first_no"),
            F.max("_no").alias("_last_no"),
        )
    )
    # Quarterly months between two month numbers, both included.
    through = F.floor((F.col("_last_no") + 1) / 3)
    before = F.floor(F.col("_first_no") / 3)
    return grouped.withColumn(
        "expected_quarterly", (through - before).cast("bigint")
    ).select(
        *listing,
        "root",
        "schema_",
        "n_contracts",
        "first_symbol",
        "last_symbol",
        "size_bytes",
        "n_issues",
        "n_quarterly",
        "expected_quarterly",
        (F.col("n_quarterly") < F.col("expected_quarterly")).alias("has_gaps"),
    )


def inventory_listing(items: DataFrame, listing: list[str]) -> DataFrame:
    """The grouped inventory: contract groups, and every other item as a single."""
    groups = inventory_groups(items, listing).select(F.lit("group").alias("kind"), "*")
    zero = F.lit(0).cast("bigint")
    singles = (
        items.filter(~symbols.is_supported_contract(F.col("symbol")))
        .groupBy(*listing, "symbol", "schema_")
        .agg(
            F.sum("size_bytes").cast("bigint").alias("size_bytes"),
            F.sum("n_issues").cast("bigint").alias("n_issues"),
        )
        .select(
            F.lit("single").alias("kind"),
            *listing,
            F.lit(None).cast("string").alias("root"),
            "schema_",
            zero.alias("n_contracts"),
            F.col("symbol").alias("first_symbol"),
            F.col("symbol").alias("last_symbol"),
            "size_bytes",
            "n_issues",
            zero.alias("n_quarterly"),
            zero.alias("expected_quarterly"),
            F.lit(False).alias("has_gaps"),
        )
    )
    return groups.unionByName(singles)


def chain_gaps(items: DataFrame, listing: list[str]) -> DataFrame:
    """Groups with absent quarterly contracts, and how many are absent."""
    return (
        inventory_groups(items, listing)
        .filter("has_gaps")
        .select(
            *listing,
            "root",
            "schema_",
            "first_symbol",
            "last_symbol",
            (F.col("expected_quarterly") - F.col("n_quarterly")).alias("n_absent"),
        )
    )


def inventory_totals(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("n_items"),
        F.sum("size_bytes").cast("bigint").alias("size_bytes"),
    )
