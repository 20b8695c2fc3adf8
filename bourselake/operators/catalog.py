"""The catalog: recorded ranges per key, checked against and rebuilt from rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourselake.functions import daymask, symbols
from bourselake.operators import coverage, intervals
from bourselake.operators.coverage import KEY

def entry_ranges(entries: DataFrame) -> DataFrame:
    """Catalog entries in long form, one row per recorded range."""
    return entries.select(*KEY, "stype", "updated_at", F.inline("ranges")).select(
        *KEY,
        "stype",
        "updated_at",
        F.col("start").alias("range_start"),
        F.col("end").alias("range_end"),
    )


def observed_range(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """First and last date with rows per key."""
    return rows.groupBy(*keys).agg(
        F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date")
    )


def observed_ranges(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Islands of days for tick schemas, of months for the others."""
    tick = coverage.is_tick(F.col("schema_"))
    daily = intervals.day_islands(rows.filter(tick), keys, "trade_date")
    monthly = intervals.month_islands(rows.filter(~tick), keys, "trade_date")
    return daily.unionByName(monthly.drop("months"))


def build_catalog(rows: DataFrame, updated_at: datetime) -> DataFrame:
    """Catalog in long form, recomputed from the rows."""
    return observed_ranges(rows).select(
        *KEY,
        symbols.symbol_type(F.col("symbol")).alias("stype"),
        "range_start",
        "range_end",
        F.lit(updated_at).alias("updated_at"),
    )


def refresh_catalog(
    catalog: DataFrame, touched: DataFrame, rows: DataFrame, updated_at: datetime
) -> DataFrame:
    """Recompute the entries of the touched keys from the rows; keep all others."""
    keys = touched.select(*KEY).distinct()
    fresh = build_catalog(rows.join(keys, KEY, "left_semi"), updated_at)
    kept = catalog.join(keys, KEY, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def list_catalog(
    catalog: DataFrame,
    sizes: DataFrame,
    issue_counts: DataFrame,
    dataset: str | None = None,
    schema: str | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """One row per key: ranges, size and issue count, optionally filtered.

    The ranges of a key are disjoint, so a key has at most one per two days.
    """
    wanted = catalog
    if dataset is not None:
        wanted = wanted.filter(F.col("dataset") == dataset)
    if schema is not None:
        wanted = wanted.filter(F.col("schema_") == schema)
    if prefix is not None:
        wanted = wanted.filter(
            symbols.starts_with_ignoring_case(F.col("symbol"), prefix)
        )
    span = F.struct(F.col("range_start").alias("start"), F.col("range_end").alias("end"))
    entries = wanted.groupBy(*KEY).agg(F.sort_array(F.collect_list(span)).alias("ranges"))
    zero = F.lit(0).cast("bigint")
    return (
        entries.join(sizes, KEY, "left")
        .join(issue_counts, KEY, "left")
        .select(
            *KEY,
            "ranges",
            F.coalesce("size_bytes", zero).alias("size_bytes"),
            F.coalesce("n_issues", zero).alias("n_issues"),
        )
    )


def orphan_partitions(partitions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Partitions on disk whose key has no catalog entry."""
    return partitions.join(catalog.select(*KEY).distinct(), KEY, "left_anti")


def validate_catalog(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Compare each key's recorded and actual bounds; both bounds are reported.

    finding: ok, mismatch (bounds differ, or more than one range), orphan (rows
    without entry) or no_rows (entry without rows).
    """
    return validate_bounds(catalog, observed_range(rows))


def _finding() -> Column:
    same = (
        F.col("recorded_start").eqNullSafe(F.col("first_date"))
        & F.col("recorded_end").eqNullSafe(F.col("last_date"))
        & (F.col("recorded_ranges") == 1)
    )
    return (
        F.when(F.coalesce("recorded_ranges", F.lit(0)) == 0, "orphan")
        .when(F.col("first_date").isNull(), "no_rows")
        .when(same, "ok")
        .otherwise("mismatch")
    )


def validate_bounds(catalog: DataFrame, actual: DataFrame) -> DataFrame:
    """As ``validate_catalog``, from each key's first and last date, however they are known."""
    recorded = catalog.groupBy(*KEY).agg(
        F.min("range_start").alias("recorded_start"),
        F.max("range_end").alias("recorded_end"),
        F.count("*").alias("recorded_ranges"),
    )
    return recorded.join(actual, KEY, "full").select(
        *KEY,
        "recorded_start",
        "recorded_end",
        F.coalesce("recorded_ranges", F.lit(0).cast("bigint")).alias("recorded_ranges"),
        "first_date",
        "last_date",
        _finding().alias("finding"),
    )


def fix_catalog(
    catalog: DataFrame, rows: DataFrame, single_range: bool = True
) -> DataFrame:
    """The catalog after validation and repair, in long form.

    Wrong and orphan keys get one [first, last] range as seen in the rows, which
    validates as ok, or the true islands of days if ``single_range`` is false. Right keys
    stay as they are. One range per key is found with a single join of both sides, islands
    with a single grouping of recorded ranges and observed day masks.
    """
    if not single_range:
        return _fix_with_islands(catalog, rows)
    findings = validate_catalog(catalog, rows)
    repaired = F.col("finding").isin("mismatch", "orphan")
    return findings.select(
        *KEY,
        F.when(repaired, F.col("first_date")).otherwise(F.col("recorded_start")).alias("range_start"),
        F.when(repaired, F.col("last_date")).otherwise(F.col("recorded_end")).alias("range_end"),
        symbols.symbol_type(F.col("symbol")).alias("stype"),
    )


def _fix_with_islands(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Recorded ranges and observed months of a key side by side, decided in one pass.

    Rows shrink to one mask per key and month map-side, so a key brings at most one item
    per calendar month and one per recorded range, however many rows it has.
    """
    observed = intervals.days_to_months(
        rows.filter(F.col("trade_date").isNotNull()), KEY, "trade_date"
    )
    recorded = catalog.select(*KEY, "range_start", "range_end")
    month = F.struct("month_no", "day_mask")
    span = F.struct("range_start", "range_end")
    # A range without bounds is still an entry: which side a row is of is told apart.
    both = observed.select(*KEY, month.alias("_month")).unionByName(
        recorded.select(*KEY, span.alias("_range")), allowMissingColumns=True
    )
    keys = both.groupBy(*KEY).agg(
        F.sort_array(F.collect_list("_month")).alias("_months"),
        F.collect_list("_range").alias("_ranges"),
        F.min("_range.range_start").alias("recorded_start"),
        F.max("_range.range_end").alias("recorded_end"),
        F.count("_range").alias("recorded_ranges"),
    )
    first, last = F.get("_months", F.lit(0)), F.try_element_at("_months", F.lit(-1))
    keys = keys.withColumns(
        {
            "first_date": daymask.date_of(first["month_no"], daymask.lowest(first["day_mask"])),
            "last_date": daymask.date_of(last["month_no"], daymask.highest(last["day_mask"])),
            "_runs": intervals.mask_runs(
                F.col("_months"), coverage.is_tick(F.col("schema_"))
            ),
        }
    )
    wrong = _finding().isin("mismatch", "orphan")
    islands = intervals.join_runs(F.col("_runs"))
    return keys.select(
        *KEY, F.inline(F.when(wrong, islands).otherwise(F.col("_ranges")))
    ).withColumn("stype", symbols.symbol_type(F.col("symbol")))


def rebuild_orphans(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """New entries for keys with rows but no entry.

    ``rows`` come from the file layout, where the symbol is spelt with ``_``;
    the entry gets the dotted symbol and its type.
    """
    orphans = orphan_partitions(
        observed_range(rows),
        catalog.withColumn("symbol", symbols.path_symbol(F.col("symbol"))),
    )
    dotted = symbols.symbol_from_path(F.col("symbol"))
    return orphans.select(
        "dataset",
        dotted.alias("symbol"),
        "schema_",
        symbols.symbol_type(dotted).alias("stype"),
        F.col("first_date").alias("range_start"),
        F.col("last_date").alias("range_end"),
    )


def verify_catalog(
    catalog: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Recorded ranges whose partitions are not all there; their days are all recorded."""
    checked = coverage.coverage_status(catalog, None, present, calendar)
    return checked.filter(F.col("status") != "COMPLETE")


def drop_stale(catalog: DataFrame, stale: DataFrame) -> DataFrame:
    """The catalog without the ranges found incomplete."""
    return catalog.join(
        stale.select(*KEY, "range_start", "range_end"),
        [*KEY, "range_start", "range_end"],
        "left_anti",
    )
