"""Interval algebra over inclusive date ranges, per key.

Every operator takes the key columns by name. Ranges are first reduced to the
longest one per (key, start), combined map-side, so the per-key window sorts at
most as many rows as there are distinct start dates, however many ranges a key
holds. Requests meet gaps on (key, year), never on the key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourselake.functions import daymask
from bourselake.operators.calendars import with_sessions
from bourselake.session import spread


def _longest(ranges: DataFrame, keys: list[str]) -> DataFrame:
    return (
        ranges.filter(F.col("range_start") <= F.col("range_end"))
        .groupBy(*keys, "range_start")
        .agg(F.max("range_end").alias("range_end"))
    )


def _islands(ranges: DataFrame, keys: list[str]) -> DataFrame:
    by_start = Window.partitionBy(*keys).orderBy("range_start")
    earlier = by_start.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(
        F.col("range_start") > F.date_add(F.max("range_end").over(earlier), 1),
        F.lit(True),
    )
    return (
        spread(ranges, *keys)
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_island", F.sum("_opens").over(by_start))
        .groupBy(*keys, "_island")
        .agg(
            F.min("range_start").alias("range_start"),
            F.max("range_end").alias("range_end"),
        )
        .drop("_island")
    )


def merge_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges: overlapping or adjacent (end + 1 day) ones become one."""
    return _islands(_longest(ranges, keys), keys)


def split_months(ranges: DataFrame, columns: list[str]) -> DataFrame:
    """One row per range and month it touches, with the mask of its days."""
    start, end = F.col("range_start"), F.col("range_end")
    months = F.sequence(daymask.month_no(start), daymask.month_no(end))
    return (
        ranges.filter(start <= end)
        .withColumn("month_no", F.explode(months))
        .withColumn("day_mask", daymask.span_mask(F.col("month_no"), start, end))
        .select(*columns, "month_no", "day_mask")
    )


def ranges_to_months(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Day set of possibly overlapping ranges: (keys, month_no, day_mask)."""
    longest = spread(_longest(ranges, keys), *keys)
    return (
        split_months(longest, keys)
        .groupBy(*keys, "month_no")
        .agg(F.bit_or("day_mask").alias("day_mask"))
    )


def days_to_months(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Day set of the dates seen in rows; one integer per key and month."""
    return rows.groupBy(*keys, daymask.month_no(F.col(day)).alias("month_no")).agg(
        F.bit_or(daymask.day_bit(F.col(day))).alias("day_mask")
    )


def month_runs(months: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of a day set, cut at month ends."""
    return months.select(
        *keys, "month_no", F.inline(daymask.runs_in(F.col("day_mask")))
    ).select(
        *keys,
        daymask.date_of(F.col("month_no"), F.col("first")).alias("range_start"),
        daymask.date_of(F.col("month_no"), F.col("last")).alias("range_end"),
    )


def months_to_ranges(months: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges of a day set that has one row per key and month."""
    return _islands(month_runs(months, keys), keys)


def mask_runs(months: Column, by_day: Column) -> Column:
    """Runs of an ascending array of (month_no, day_mask), each from first to last day.

    Where ``by_day``, a run holds consecutive days of a month; elsewhere a month is one
    run. ``low`` and ``high`` number a run's ends, in days or months: runs follow each
    other without a gap where one's high is next to the other's low.
    """

    def days(month: Column) -> Column:
        number = month["month_no"]

        def run(part: Column) -> Column:
            start = daymask.date_of(number, part["first"])
            end = daymask.date_of(number, part["last"])
            return _run(start, end, F.unix_date(start), F.unix_date(end))

        return F.transform(daymask.runs_in(month["day_mask"]), run)

    def whole(month: Column) -> Column:
        number, mask = month["month_no"], month["day_mask"]
        start = daymask.date_of(number, daymask.lowest(mask))
        end = daymask.date_of(number, daymask.highest(mask))
        return _run(start, end, number, number)

    return F.when(by_day, F.flatten(F.transform(months, days))).otherwise(
        F.transform(months, whole)
    )


def _run(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        low.cast("int").alias("low"),
        high.cast("int").alias("high"),
    )


def join_runs(runs: Column) -> Column:
    """Maximal ranges of an ascending array of runs, read off neighbouring runs."""

    def opens(run: Column, at: Column) -> Column:
        before = F.get(runs, at - 1)
        return (at == 0) | (before["high"] + 1 < run["low"])

    def closes(run: Column, at: Column) -> Column:
        after = F.get(runs, at + 1)
        return (at == F.size(runs) - 1) | (run["high"] + 1 < after["low"])

    return F.zip_with(
        F.filter(runs, opens),
        F.filter(runs, closes),
        lambda a, b: F.struct(a["start"].alias("range_start"), b["end"].alias("range_end")),
    )


def _split_years(rows: DataFrame, start: str, end: str) -> DataFrame:
    years = F.sequence(F.year(start), F.year(end))
    return rows.filter(F.col(start) <= F.col(end)).withColumn("_year", F.explode(years))


def missing_ranges(
    requests: DataFrame, cached: DataFrame, keys: list[str]
) -> DataFrame:
    """Gaps of each requested range that no cached range covers.

    Requests are identified by their keys and bounds, kept as request_start and
    request_end; a request with nothing cached is one gap.

    The gaps between a key's cached ranges are found once per key, with a mark
    before its first and after its last requested day. Requests then meet them
    on (key, year); a year has at most 183 gaps, and a pair counts only in the
    year its overlap starts.
    """
    asked = requests.select(
        *keys,
        F.col("range_start").alias("request_start"),
        F.col("range_end").alias("request_end"),
    ).distinct()
    before = F.date_sub(F.min("request_start"), 1)
    after = F.date_add(F.max("request_end"), 1)
    marks = (
        asked.groupBy(*keys)
        .agg(F.array(before, after).alias("_marks"))
        .select(*keys, F.explode("_marks").alias("range_start"))
        .withColumn("range_end", F.col("range_start"))
    )
    by_start = Window.partitionBy(*keys).orderBy("range_start")
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = (
        spread(_longest(cached, keys).unionByName(marks), *keys)
        .select(
            *keys,
            F.date_add(F.max("range_end").over(so_far), 1).alias("_gap_start"),
            F.date_sub(F.lead("range_start").over(by_start), 1).alias("_gap_end"),
        )
    )
    start = F.greatest("request_start", "_gap_start")
    end = F.least("request_end", "_gap_end")
    return (
        _split_years(asked, "request_start", "request_end")
        .join(_split_years(gaps, "_gap_start", "_gap_end"), [*keys, "_year"])
        .filter((start <= end) & (F.year(start) == F.col("_year")))
        .select(
            *keys,
            "request_start",
            "request_end",
            start.alias("range_start"),
            end.alias("range_end"),
        )
    )


def subtract_ranges(
    ranges: DataFrame, cleared: DataFrame, keys: list[str]
) -> DataFrame:
    """What remains of the ranges after the cleared windows are taken out.

    The remnants are the gaps that the cleared windows leave in the ranges.
    """
    whole = merge_ranges(ranges, keys)
    return missing_ranges(whole, cleared, keys).drop("request_start", "request_end")


def day_islands(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Maximal runs of consecutive days with rows."""
    return months_to_ranges(days_to_months(rows, keys, day), keys)


def session_islands(
    rows: DataFrame, calendar: DataFrame, keys: list[str], day: str
) -> DataFrame:
    """Runs of days with rows in which no session without rows lies between.

    A run therefore bridges weekends and holidays. ``dataset`` must be a key.
    """
    seen = rows.select(*keys, F.col(day).alias("_day")).distinct()
    numbered = with_sessions(seen, calendar, "_day", ["is_session", "session_no"])
    by_day = Window.partitionBy(*keys).orderBy("_day")
    number = F.coalesce("session_no", F.datediff("_day", F.lit("1970-01-01")))
    sessions_before = number - F.col("is_session").cast("int")
    opens = F.coalesce(sessions_before > F.lag(number).over(by_day), F.lit(True))
    return (
        numbered.withColumn("_opens", opens.cast("int"))
        .withColumn("_island", F.sum("_opens").over(by_day))
        .groupBy(*keys, "_island")
        .agg(
            F.min("_day").alias("range_start"),
            F.max("_day").alias("range_end"),
            F.count("*").alias("days"),
        )
        .drop("_island")
    )


def month_islands(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Runs of consecutive months with rows, from first to last day seen."""
    months = rows.groupBy(*keys, daymask.month_no(F.col(day)).alias("month_no")).agg(
        F.min(day).alias("_first"), F.max(day).alias("_last")
    )
    by_month = Window.partitionBy(*keys).orderBy("month_no")
    run = F.col("month_no") - F.row_number().over(by_month)
    return (
        spread(months, *keys)
        .withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(
            F.min("_first").alias("range_start"),
            F.max("_last").alias("range_end"),
            F.count("*").alias("months"),
        )
        .drop("_run")
    )
