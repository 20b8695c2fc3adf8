"""Futures contracts as a dimension, and the range joins that use it.

The dimension is bounded by its construction: 21 roots, 12 months, 100 years is
25,200 contracts, and a quarterly contract's window touches five months at most.
Both are broadcast for that reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.functions import daymask, symbols
from bourselake.functions.vocab import (
    DEFAULT_ROLLOVER_DAYS,
    FUTURES_CALENDAR,
    ROOTS_BY_RULE,
)

FIRST_YEAR = 2000  # two-digit years are 20xx
LAST_YEAR = 2099

# Sessions to step back from the last session of the month.
SESSIONS_BEFORE_MONTH_END = {"treasury": 7, "metals": 2}


def root_dim(spark: SparkSession) -> DataFrame:
    pairs = [(root, rule) for rule, roots in ROOTS_BY_RULE.items() for root in roots]
    return spark.createDataFrame(pairs, "root string, rule string")


def expirations(calendar: DataFrame) -> DataFrame:
    """(rule, month_no) -> expiration, for every month the contracts can have."""
    sessions = calendar.filter(F.col("calendar") == FUTURES_CALENDAR)
    # The quarter before the first contract year is needed for its first window.
    first, last = FIRST_YEAR * 12 - 3, LAST_YEAR * 12 + 11
    months = sessions.select(
        daymask.month_no(F.col("day")).alias("month_no"),
        "day",
        "prev_session",
        "session_no",
    ).filter(F.col("month_no").between(first, last))

    before_month = F.date_sub(daymask.month_first(F.col("month_no")), 1)
    third_friday = F.date_add(F.next_day(before_month, "Fri"), 14)
    fridays = months.filter(F.col("day") == third_friday).select(
        F.lit("third_friday").alias("rule"),
        "month_no",
        F.col("prev_session").alias("expiration"),
    )

    steps = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(n).alias("steps"))
            for rule, n in SESSIONS_BEFORE_MONTH_END.items()
        ]
    )
    month_ends = months.filter(F.col("day") == F.last_day("day")).select(
        "month_no", "session_no", F.inline(steps)
    )
    targets = month_ends.select(
        "rule", "month_no", (F.col("session_no") - F.col("steps")).alias("session_no")
    )
    numbered = sessions.filter("is_session").select(
        "session_no", F.col("day").alias("expiration")
    )
    stepped = targets.join(F.broadcast(numbered), "session_no").select(
        "rule", "month_no", "expiration"
    )
    return fridays.unionByName(stepped)


def contract_dim(
    spark: SparkSession,
    calendar: DataFrame,
    rollover_days: int = DEFAULT_ROLLOVER_DAYS,
) -> DataFrame:
    """One row per (root, month): spellings, expiration, window, neighbours."""
    expiry = expirations(calendar)
    number = F.col("month_no")
    previous = expiry.select(
        "rule", number.alias("_previous_no"), F.col("expiration").alias("_previous")
    )
    windows = (
        expiry.filter(number >= FIRST_YEAR * 12)
        .withColumn("_previous_no", symbols.previous_quarter_no(number))
        .join(F.broadcast(previous), ["rule", "_previous_no"])
    )
    root, year = F.col("root"), F.floor(number / 12).cast("int")
    month = F.pmod(number, F.lit(12)) + 1
    return windows.join(F.broadcast(root_dim(spark)), "rule").select(
        "root",
        "rule",
        symbols.contract_symbol(root, year, month).alias("symbol"),
        symbols.vendor_symbol(root, year, month).alias("vendor_symbol"),
        year.alias("year"),
        month.alias("month"),
        "month_no",
        (month % 3 == 0).alias("is_quarterly"),
        "expiration",
        F.date_sub("_previous", rollover_days).alias("window_start"),
        F.date_add("_previous", 1).alias("front_start"),
        symbols.symbol_at(root, symbols.previous_quarter_no(number)).alias(
            "previous_symbol"
        ),
        symbols.symbol_at(root, symbols.next_quarter_no(number)).alias("next_symbol"),
    )


def quarterly(contracts: DataFrame) -> DataFrame:
    return contracts.filter("is_quarterly")


def quarterly_contracts(spans: DataFrame) -> DataFrame:
    """All quarterly symbols of each (root, from_year, to_year) row, in order."""
    first = F.col("from_year") * 12 + 2
    last = F.col("to_year") * 12 + 11
    number = F.col("month_no")
    return (
        spans.filter(symbols.is_supported_root(F.col("root")))
        .filter(F.col("from_year") <= F.col("to_year"))
        .select(
            F.upper("root").alias("root"),
            F.explode(F.sequence(first, last, F.lit(3))).alias("month_no"),
        )
        .select(
            "root",
            F.floor(number / 12).cast("int").alias("year"),
            (F.pmod(number, F.lit(12)) + 1).alias("month"),
            symbols.symbol_at(F.col("root"), number).alias("symbol"),
        )
    )


def capped_window(as_of: Column, start: Column, expiration: Column) -> list[Column]:
    """Window end capped at the day before ``as_of``, and whether it has begun."""
    yesterday = F.date_sub(as_of, 1)
    return [
        F.least(expiration, yesterday).alias("window_end"),
        (start <= yesterday).alias("is_available"),
    ]


def join_on_windows(
    rows: DataFrame,
    windows: DataFrame,
    start: str,
    end: str,
    day: str,
) -> DataFrame:
    """Rows whose day lies in a window of their root.

    Each window is listed under the months it touches and rows are looked up by
    (root, month), a hash join; the exact bounds are the residual condition. A
    row has one month, so no pair appears twice.
    """
    by_month = windows.select(
        F.col("root").alias("_root"),
        *[c for c in windows.columns if c not in ("root", "month_no")],
        F.explode(
            F.sequence(daymask.month_no(F.col(start)), daymask.month_no(F.col(end)))
        ).alias("_month_no"),
    )
    return rows.join(
        F.broadcast(by_month),
        (F.col("root") == F.col("_root"))
        & (daymask.month_no(F.col(day)) == F.col("_month_no"))
        & F.col(day).between(F.col(start), F.col(end)),
    ).drop("_root", "_month_no")


def contract_slice(rows: DataFrame, contracts: DataFrame, day: str) -> DataFrame:
    """Rows inside each quarterly contract's active window.

    Consecutive windows overlap by the rollover days, so a row of the overlap
    belongs to both contracts.
    """
    windows = quarterly(contracts).select(
        "root", "symbol", "window_start", "expiration"
    )
    return join_on_windows(rows, windows, "window_start", "expiration", day)


def front_month(rows: DataFrame, contracts: DataFrame, day: str) -> DataFrame:
    """The quarterly contract with the nearest expiration on or after the day."""
    windows = quarterly(contracts).select(
        "root",
        F.col("symbol").alias("front_symbol"),
        "window_start",
        "front_start",
        "expiration",
    )
    return join_on_windows(rows, windows, "front_start", "expiration", day)
