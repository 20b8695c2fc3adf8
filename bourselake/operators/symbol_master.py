"""The symbols of a table, each once, with everything their spelling tells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourselake.functions import symbols


def symbol_master(rows: DataFrame) -> DataFrame:
    """Distinct symbols with their kind, spellings and contract parts.

    The contract parts are null for symbols that are no contract.
    """
    symbol = F.col("symbol")
    root = symbols.contract_root(symbol)
    year, month = symbols.contract_year(symbol), symbols.contract_month(symbol)
    number = year * 12 + month - 1
    return (
        rows.select("symbol")
        .distinct()
        .select(
            "symbol",
            symbols.symbol_type(symbol).alias("stype"),
            symbols.canonical_symbol(symbol).alias("canonical"),
            symbols.path_symbol(symbol).alias("path_name"),
            symbols.has_lookahead_bias(symbol).alias("has_lookahead"),
            symbols.is_supported_contract(symbol).alias("is_supported"),
            root.alias("root"),
            year.alias("year"),
            month.alias("month"),
            symbols.vendor_symbol(root, year, month).alias("vendor_symbol"),
            symbols.symbol_at(root, symbols.next_quarter_no(number)).alias(
                "next_symbol"
            ),
        )
    )


def rejected_symbols(rows: DataFrame) -> DataFrame:
    """Distinct symbols that are no contract of a supported root."""
    return (
        rows.select("symbol")
        .distinct()
        .filter(~symbols.is_supported_contract(F.col("symbol")))
    )


def supported_roots(rows: DataFrame) -> DataFrame:
    """Distinct symbols that are bare supported roots, in any case."""
    return (
        rows.select("symbol").distinct().filter(symbols.is_supported_root(F.col("symbol")))
    )
