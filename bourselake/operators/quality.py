"""Data-quality issues: extracted from notices, merged, filtered, summarised."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourselake.functions import symbols
from bourselake.operators.coverage import KEY

# Fixed values of the notice format.
NOTICE_MARKER = "reduced quality:"
DEFAULT_ISSUE_TYPE = "degraded"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
WHITESPACE = " \t\r\n"


def _first_per_date(issues: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first issue of each date; an aggregate, so it combines map-side."""
    kept = F.struct("issue_type", "message", "arrival")
    return (
        issues.groupBy(*keys, "issue_date")
        .agg(F.min_by(kept, F.struct(*order)).alias("_kept"))
        .select(*keys, "issue_date", "_kept.*")
    )


def extract_issues(notices: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Issues named in notice texts; the first one of each date wins.

    ``notices`` has the keys, ``arrival`` (the order of notices) and ``text``.
    Entries look like ``2024-01-05 (missing)``; without a type the default
    applies, and entries that are no date are skipped.
    """
    blanks = F.lit(WHITESPACE)
    # Between the first marker and the next one, up to the first full stop.
    section = F.split_part(
        F.split_part("text", F.lit(NOTICE_MARKER), F.lit(2)), F.lit("."), F.lit(1)
    )
    entry = F.trim(F.col("_entry"), blanks)
    day = F.substring_index(entry, " ", 1)
    named = F.split_part(
        F.split_part(entry, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1)
    )
    has_type = entry.contains("(") & entry.contains(")")
    issues = (
        notices.filter(F.col("text").contains(NOTICE_MARKER))
        .select(
            *keys,
            "arrival",
            F.col("text").alias("message"),
            F.posexplode(F.split(section, ",")).alias("_place", "_entry"),
        )
        .select(
            *keys,
            "arrival",
            "_place",
            "message",
            F.when(day.rlike(ISO_DATE), day.try_cast("date")).alias("issue_date"),
            F.when(has_type, named)
            .otherwise(DEFAULT_ISSUE_TYPE)
            .alias("issue_type"),
        )
        .filter(F.col("issue_date").isNotNull())
    )
    return _first_per_date(issues, keys, ["arrival", "_place"])


def merge_issues(
    existing: DataFrame, found: DataFrame, keys: list[str] = KEY
) -> DataFrame:
    """Add found issues to the store; an issue already stored for a date stays."""
    both = existing.withColumn("_source", F.lit(0)).unionByName(
        found.withColumn("_source", F.lit(1))
    )
    return _first_per_date(both, keys, ["_source", "arrival"])


def filter_issues(
    issues: DataFrame,
    start: date | None = None,
    end: date | None = None,
    prefix: str | None = None,
    schema: str | None = None,
    dataset: str | None = None,
) -> DataFrame:
    if start is not None:
        issues = issues.filter(F.col("issue_date") >= F.lit(start))
    if end is not None:
        issues = issues.filter(F.col("issue_date") <= F.lit(end))
    if prefix is not None:
        issues = issues.filter(
            symbols.starts_with_ignoring_case(F.col("symbol"), prefix)
        )
    if schema is not None:
        issues = issues.filter(F.col("schema_") == schema)
    if dataset is not None:
        issues = issues.filter(F.col("dataset") == dataset)
    return issues


def issue_counts(issues: DataFrame, keys: list[str] = KEY) -> DataFrame:
    return issues.groupBy(*keys).agg(F.count("*").alias("n_issues"))


def issue_digest(
    issues: DataFrame, keys: list[str] = KEY, shown: int = 3
) -> DataFrame:
    """Total per key and a line with the first dates, then "(+k more)".

    Issues are one per key and date, so a key's window holds at most one row
    per calendar day, and only the shown dates are collected.
    """
    by_date = Window.partitionBy(*keys).orderBy("issue_date")
    first = F.when(F.col("_place") <= shown, F.col("issue_date").cast("string"))
    summed = (
        issues.withColumn("_place", F.row_number().over(by_date))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_issues"),
            F.concat_ws(", ", F.sort_array(F.collect_list(first))).alias("_dates"),
        )
    )
    more = F.concat(F.lit(" (+"), F.col("n_issues") - shown, F.lit(" more)"))
    return summed.select(
        *keys,
        "n_issues",
        F.concat(
            "_dates", F.when(F.col("n_issues") > shown, more).otherwise("")
        ).alias("digest"),
    )
