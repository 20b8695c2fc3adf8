"""Symbol expressions: contract parsing, kinds, spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bourselake.functions.vocab import MONTH_LETTERS, SUPPORTED_ROOTS

# Symbol patterns.
CONTRACT_PATTERN = r"(?i)^([A-Z0-9]{1,4})([FGHJKMNQUVXZ])([0-9]{2})$"
SUPPORTED_PATTERN = (
    rf"(?i)^({'|'.join(SUPPORTED_ROOTS)})[{MONTH_LETTERS}][0-9]{{2}}$"
)
CONTINUOUS_PATTERN = r"^[A-Z0-9]+\.[cvn]\.[0-9]+$"
PARENT_PATTERN = r"^[A-Z0-9]+\.(FUT|OPT|SPOT)$"


def _contract_part(symbol: Column, group: int) -> Column:
    """Upper-case part of a contract symbol; null if the symbol does not parse."""
    part = F.upper(F.regexp_extract(symbol, CONTRACT_PATTERN, group))
    return F.nullif(part, F.lit(""))


def contract_root(symbol: Column) -> Column:
    return _contract_part(symbol, 1)


def contract_month(symbol: Column) -> Column:
    """Month 1-12; the letter's place in the list of month letters."""
    return F.instr(F.lit(MONTH_LETTERS), _contract_part(symbol, 2))


def contract_year(symbol: Column) -> Column:
    """Two-digit years are always 20xx."""
    return _contract_part(symbol, 3).try_cast("int") + 2000


def month_letter(month: Column) -> Column:
    return F.substring(F.lit(MONTH_LETTERS), month, F.lit(1))


def contract_symbol(root: Column, year: Column, month: Column) -> Column:
    two_digits = F.lpad((year % 100).cast("string"), 2, "0")
    return F.concat(root, month_letter(month), two_digits)


def vendor_symbol(root: Column, year: Column, month: Column) -> Column:
    """Spelling with a one-digit year; the date window tells the decade."""
    return F.concat(root, month_letter(month), (year % 10).cast("string"))


def is_supported_contract(symbol: Column) -> Column:
    """Does the symbol parse, with a root of the vocabulary?"""
    return F.coalesce(symbol.rlike(SUPPORTED_PATTERN), F.lit(False))


def is_supported_root(symbol: Column) -> Column:
    return F.upper(symbol).isin(*SUPPORTED_ROOTS)


def symbol_type(symbol: Column) -> Column:
    return (
        F.when(symbol.rlike(CONTINUOUS_PATTERN), "continuous")
        .when(symbol.rlike(PARENT_PATTERN), "parent")
        .otherwise("raw_symbol")
    )


def path_symbol(symbol: Column) -> Column:
    return F.translate(symbol, ".", "_")


def symbol_from_path(name: Column) -> Column:
    return F.translate(name, "_", ".")


def canonical_symbol(symbol: Column) -> Column:
    """Upper-case the root of a dotted symbol, or the whole undotted symbol."""
    dot = F.instr(symbol, ".")
    root = F.upper(F.substring_index(symbol, ".", 1))
    return F.when(dot > 0, F.concat(root, F.substr(symbol, dot))).otherwise(
        F.upper(symbol)
    )


def has_lookahead_bias(symbol: Column) -> Column:
    """Volume and open-interest rolls use data not known at the time."""
    return symbol.contains(".v.") | symbol.contains(".n.")


def starts_with_ignoring_case(symbol: Column, prefix: str) -> Column:
    return F.lower(symbol).startswith(prefix.lower())


def next_quarter_no(month_number: Column) -> Column:
    """Month number of the first quarterly month strictly after this one."""
    return month_number + 3 - F.pmod(month_number + 1, F.lit(3))


def previous_quarter_no(month_number: Column) -> Column:
    """Month number of the last quarterly month strictly before this one."""
    return month_number - 1 - F.pmod(month_number, F.lit(3))


def symbol_at(root: Column, month_number: Column) -> Column:
    year = F.floor(month_number / 12).cast("int")
    return contract_symbol(root, year, F.pmod(month_number, F.lit(12)) + 1)
