"""All registered queries, one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.functions import symbols
from bourselake.operators import (
    calendars,
    catalog,
    contracts,
    coverage,
    intervals,
    inventory,
    quality,
)
from bourselake.operators import symbol_master as masters
from bourselake.operators.coverage import KEY
from bourselake.plans import loading, updates
from bourselake.session import drop_path, scratch_path, staged
from bourselake.sources import catalog_store, lake, layout
from bourselake.streaming import ingest
from bourselake.workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BOOK = ["book", "dataset"]
HOLDING = [*BOOK, "symbol", "schema_"]
LAKE_COLUMNS = [
    *KEY, "event_id", "ts_event_ns", "trade_date", "price", "price_cents",
]
WINDOW = (date(2024, 1, 8), date(2024, 1, 19))


def query(build: Query) -> Query:
    """Register a query under its function name, its integers as bigint."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(spark, sf_dir)
        wide = [c for c, kind in rows.dtypes if kind == "int"]
        return rows.withColumns({c: F.col(c).cast("bigint") for c in wide})

    QUERIES[build.__name__] = run
    return run


# --- sources and sinks -----------------------------------------------------


def _lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ticks(spark, sf_dir).select(*LAKE_COLUMNS)


def _new_lake(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "lake")
    lake.write_partitions(lake.with_partitions(rows), path)
    return path


@query
def windowed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_lake(spark, _lake_rows(spark, sf_dir))
    return lake.read_lake(spark, path, *WINDOW).select(
        "event_id", *KEY, "ts_event_ns", "trade_date", "price_cents"
    )


@query
def served_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in the windows of the requests that are complete."""
    rows = _lake_rows(spark, sf_dir)
    status = coverage.coverage_status(
        views.tick_requests(spark, sf_dir),
        views.catalog(spark, sf_dir),
        coverage.present_partitions(rows),
        views.calendar(spark),
    )
    served = lake.rows_in_windows(rows, status.filter("status = 'COMPLETE'"))
    return served.select("event_id", *KEY, "trade_date", "price_cents")


@query
def partition_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    lake.load_window(_lake_rows(spark, sf_dir), path, *WINDOW)
    return lake.partition_row_counts(lake.read_lake(spark, path))


@query
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single symbols' purchases of three days are delivered again, prices doubled."""
    rows = _lake_rows(spark, sf_dir)
    path = _new_lake(spark, rows)
    again = lake.date_window(
        rows.filter((F.col("dataset") == "XNAS.ITCH") & F.col("symbol").startswith("N")),
        date(2024, 1, 10),
        date(2024, 1, 12),
    ).withColumn("price_cents", F.col("price_cents") * 2)
    lake.write_partitions(lake.with_partitions(again), path)
    return (
        lake.read_lake(spark, path)
        .groupBy(*lake.FOLDERS)
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("price_cents").cast("bigint").alias("price_cents"),
        )
    )


@query
def partition_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.with_partitions(views.rows_of_both(spark, sf_dir))
    grain = F.when(coverage.is_tick(F.col("schema_")), "day").otherwise("month")
    return (
        rows.groupBy(*KEY, "year", "month", "day")
        .agg(F.count("*").alias("n_rows"))
        .select(
            "*", grain.alias("grain"), coverage.partition_label().alias("label")
        )
    )


@query
def partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_partitions(views.rows_of_both(spark, sf_dir))
    return coverage.cached_partitions(
        views.requests(spark, sf_dir), present, views.calendar(spark)
    )


def _exported(
    spark: SparkSession, rows: DataFrame, read: Callable[[str], DataFrame]
) -> DataFrame:
    """What ``read`` makes of an export of the rows; the export is removed again."""
    root = scratch_path(spark, "layout")
    try:
        layout.write_layout(rows, root)
        return staged(spark, read(root), "layout_read")
    finally:
        drop_path(spark, root)


@query
def layout_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = layout.parse_paths(views.partition_files(spark, sf_dir))
    return files.select(*KEY, "year", "month", "day", "n_rows")


@query
def layout_export_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute rows exported as files, found again by listing, counted by reading."""
    return _exported(
        spark,
        views.minute_rows(spark, sf_dir),
        lambda root: layout.partition_counts(spark, root).select(
            *KEY, "year", "month", "day", "n_rows"
        ),
    )


@query
def layout_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions per key from a listing; its sizes agree with those of the files read."""

    def read(root: str) -> DataFrame:
        listed = layout.parse_paths(layout.file_manifest(spark, root))
        sizes = layout.size_rollup(listed, KEY).withColumnRenamed("size_bytes", "listed")
        seen = layout.partition_counts(spark, root).groupBy(*KEY).agg(
            F.count("*").alias("n_partitions"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_files").alias("files_read"),
            F.sum("size_bytes").alias("bytes_read"),
        )
        agree = (F.col("listed") == F.col("bytes_read")) & (
            F.col("n_files") == F.col("files_read")
        )
        return sizes.join(seen, KEY, "full").select(
            *KEY, "n_partitions", "n_rows", (agree & (F.col("listed") > 0)).alias("sizes_agree")
        )

    return _exported(spark, views.minute_rows(spark, sf_dir), read)


@query
def entry_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog written as one JSON file per key and read back into ranges."""
    root = scratch_path(spark, "entries")
    span = F.struct(F.col("range_start").alias("start"), F.col("range_end").alias("end"))
    entries = (
        views.catalog(spark, sf_dir)
        .groupBy(*KEY, "stype")
        .agg(F.sort_array(F.collect_list(span)).alias("ranges"))
        .withColumn("updated_at", F.lit(views.UPDATED_AT))
    )
    try:
        catalog_store.write_entry_files(entries, root)
        ranges = catalog.entry_ranges(catalog_store.read_entry_files(spark, root))
        return staged(spark, ranges.drop("updated_at"), "entries_read")
    finally:
        drop_path(spark, root)


@query
def size_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.size_rollup(views.manifest(spark, sf_dir), ["source", "lang"])


@query
def partition_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.with_partitions(views.rows_of_both(spark, sf_dir))
    return lake.partition_row_counts(rows)


@query
def empty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_days(views.rows_of_both(spark, sf_dir))
    return coverage.empty_requests(views.requests(spark, sf_dir), present)


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("n_bytes").cast("bigint").alias("size_bytes"))


def _catalog_list(spark: SparkSession, sf_dir: str, **wanted: str) -> DataFrame:
    listed = catalog.list_catalog(
        views.catalog(spark, sf_dir),
        _sizes(views.ticks(spark, sf_dir)),
        quality.issue_counts(_issues(spark, sf_dir)),
        **wanted,
    )
    return listed.select(
        *KEY,
        F.size("ranges").cast("bigint").alias("n_ranges"),
        F.element_at("ranges", 1)["start"].alias("first_date"),
        F.element_at("ranges", -1)["end"].alias("last_date"),
        "size_bytes",
        "n_issues",
    )


@query
def catalog_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_list(spark, sf_dir, dataset="GLBX.MDP3")


@query
def catalog_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_list(spark, sf_dir, schema="trades", prefix="m")


@query
def catalog_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.build_catalog(
        views.rows_of_both(spark, sf_dir), views.UPDATED_AT
    ).drop("updated_at")


@query
def catalog_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored catalog is refreshed for the keys with rows after its snapshot."""
    path = scratch_path(spark, "catalog")
    catalog_store.save_catalog(spark, views.catalog(spark, sf_dir), path)
    rows = views.ticks(spark, sf_dir)
    newer = rows.filter(F.col("trade_date") > views.snapshot_date(F.col("dataset")))
    refreshed = catalog.refresh_catalog(
        catalog_store.load_catalog(spark, path), newer, rows, views.UPDATED_AT
    )
    catalog_store.save_catalog(spark, refreshed.drop("updated_at"), path)
    return catalog_store.load_catalog(spark, path)


@query
def catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same refresh as a change: the keys with new rows are written, no other."""
    path = scratch_path(spark, "catalog")
    catalog_store.save_catalog(spark, views.catalog(spark, sf_dir), path)
    rows = views.ticks(spark, sf_dir)
    newer = rows.filter(F.col("trade_date") > views.snapshot_date(F.col("dataset")))
    touched = newer.select(*KEY).distinct()
    own = catalog_store.load_catalog(spark, path).join(touched, KEY, "left_semi")
    refreshed = catalog.refresh_catalog(own, newer, rows, views.UPDATED_AT)
    catalog_store.append_changes(spark, refreshed.drop("updated_at"), touched, path, KEY)
    return catalog_store.load_catalog(spark, path)


# --- filters ---------------------------------------------------------------


@query
def date_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return lake.date_window(events, *WINDOW).select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("trade_date")
    )


def _feed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct symbols of the feed; expressions on symbols run on these only."""
    return (
        views.symbol_feed(spark, sf_dir)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("volume").cast("bigint").alias("volume"),
        )
    )


@query
def symbol_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _feed_symbols(spark, sf_dir)
        .filter(symbols.starts_with_ignoring_case(F.col("symbol"), "Nq"))
        .select("symbol", "volume")
    )


@query
def supported_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _feed_symbols(spark, sf_dir).filter(
        symbols.is_supported_contract(F.col("symbol"))
    )
    return kept.groupBy(
        symbols.contract_root(F.col("symbol")).alias("root"),
        symbols.contract_year(F.col("symbol")).alias("year"),
        symbols.contract_month(F.col("symbol")).alias("month"),
    ).agg(
        F.sum("n_rows").cast("bigint").alias("n_rows"),
        F.sum("volume").cast("bigint").alias("volume"),
    )


@query
def supported_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.supported_roots(views.symbol_feed(spark, sf_dir))


@query
def rejected_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.rejected_symbols(views.symbol_feed(spark, sf_dir))


@query
def lookahead_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.ticks(spark, sf_dir)
        .groupBy("dataset", "symbol")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("has_lookahead", symbols.has_lookahead_bias(F.col("symbol")))
    )


def _bar_spans(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    return (
        views.bars(spark, sf_dir)
        .groupBy(*keys, "root")
        .agg(
            F.year(F.min("trade_date")).alias("from_year"),
            F.year(F.max("trade_date")).alias("to_year"),
        )
    )


@query
def available_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = updates.available_contracts(
        _bar_spans(spark, sf_dir, []), views.contracts(spark), date(2021, 6, 1)
    )
    return listed.select("root", "symbol", "window_start", "window_end", "expiration")


# --- calendar --------------------------------------------------------------


@query
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All calendars on every day the bars have, with the bars of that day."""
    days = (
        views.bars(spark, sf_dir)
        .groupBy(F.col("trade_date").alias("day"))
        .agg(F.count("*").alias("n_rows"))
    )
    dim = views.calendar(spark).select(
        "calendar",
        "day",
        "is_session",
        "is_early_close",
        *_clock("open_utc"),
        *_clock("close_utc"),
    )
    return days.join(F.broadcast(dim), "day")


def _clock(name: str) -> list:
    short = name.removesuffix("_utc")
    return [
        F.hour(name).cast("bigint").alias(f"{short}_hour"),
        F.minute(name).cast("bigint").alias(f"{short}_minute"),
    ]


@query
def calendar_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = views.ticks(spark, sf_dir).groupBy("dataset").agg(
        F.count("*").alias("n_rows")
    )
    return counted.withColumn("calendar", calendars.calendar_of(F.col("dataset")))


@query
def session_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.ticks(spark, sf_dir).select("event_id", "dataset", "trade_date")
    return calendars.with_sessions(
        rows, views.calendar(spark), "trade_date", ["is_session", "is_early_close"]
    )


def _dataset_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rows_of_both(spark, sf_dir).groupBy("dataset", "trade_date").agg(
        F.count("*").alias("n_rows")
    )


@query
def session_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendars.with_sessions(
        _dataset_days(spark, sf_dir), views.calendar(spark), "trade_date", ["close_utc"]
    )
    return days.select("dataset", "trade_date", "n_rows", *_clock("close_utc"))


@query
def prev_next_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.with_sessions(
        _dataset_days(spark, sf_dir),
        views.calendar(spark),
        "trade_date",
        ["prev_session", "next_session"],
    )


@query
def trading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = views.tick_requests(spark, sf_dir).select(
        "dataset", "symbol", "range_start", "range_end"
    )
    return calendars.trading_days(windows, views.calendar(spark))


@query
def trading_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = views.recorded_ranges(spark, sf_dir).select(
        "dataset", "symbol", "range_start", "range_end"
    )
    return calendars.trading_day_count(windows, views.calendar(spark))


# --- contracts and symbols -------------------------------------------------


@query
def quarterly_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _bar_spans(spark, sf_dir, ["book"])
    listed = contracts.quarterly_contracts(
        spans.groupBy(F.lower("root").alias("root")).agg(
            F.min("from_year").alias("from_year"), F.max("to_year").alias("to_year")
        )
    )
    return listed.select("root", "year", "month", "symbol")


@query
def contract_expirations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contract of the years each root has bars in, and its last day's bars."""
    counted = views.bars(spark, sf_dir).groupBy("root", "trade_date").agg(
        F.count("*").alias("n_rows")
    )
    years = counted.groupBy("root").agg(
        F.year(F.min("trade_date")).alias("_from"),
        F.year(F.max("trade_date")).alias("_to"),
    )
    dim = views.contracts(spark).select(
        "root", "symbol", "rule", "year", "month", "expiration"
    )
    listed = years.join(F.broadcast(dim), "root").filter(
        F.col("year").between(F.col("_from"), F.col("_to"))
    )
    last_day = counted.withColumnRenamed("trade_date", "expiration")
    return listed.join(last_day, ["root", "expiration"], "left").select(
        "root",
        "symbol",
        "rule",
        "year",
        "month",
        "expiration",
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )


@query
def contract_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _bar_spans(spark, sf_dir, [])
    dim = contracts.quarterly(views.contracts(spark)).select(
        "root", "symbol", "year", "window_start", "expiration", "previous_symbol"
    )
    in_years = F.col("year").between(F.col("from_year"), F.col("to_year"))
    return (
        spans.join(F.broadcast(dim), "root")
        .filter(in_years)
        .select("root", "symbol", "previous_symbol", "window_start", "expiration")
    )


@query
def contract_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.bars(spark, sf_dir).select("root", "trade_date", "volume")
    sliced = contracts.contract_slice(rows, views.contracts(spark), "trade_date")
    return sliced.groupBy("root", "symbol").agg(
        F.count("*").alias("n_rows"),
        F.sum("volume").cast("bigint").alias("volume"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )


@query
def front_month_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (
        views.bars(spark, sf_dir)
        .groupBy("root", F.col("trade_date").alias("day"))
        .agg(F.count("*").alias("n_rows"))
    )
    return updates.front_month_windows(
        days, views.contracts(spark), views.BARS_AS_OF
    )


@query
def symbol_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.symbol_master(views.symbol_feed(spark, sf_dir))


@query
def symbol_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.col("symbol")
    root = symbols.contract_root(symbol)
    year, month = symbols.contract_year(symbol), symbols.contract_month(symbol)
    return _feed_symbols(spark, sf_dir).select(
        "symbol",
        "volume",
        root.alias("root"),
        year.cast("bigint").alias("year"),
        month.cast("bigint").alias("month"),
        symbols.vendor_symbol(root, year, month).alias("vendor_symbol"),
    )


@query
def symbol_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_name = symbols.path_symbol(F.col("symbol"))
    return _feed_symbols(spark, sf_dir).select(
        "symbol",
        "volume",
        symbols.symbol_type(F.col("symbol")).alias("stype"),
        path_name.alias("path_name"),
        symbols.symbol_from_path(path_name).alias("restored"),
    )


@query
def symbol_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _feed_symbols(spark, sf_dir)
        .groupBy(symbols.canonical_symbol(F.col("symbol")).alias("canonical"))
        .agg(
            F.sum("volume").cast("bigint").alias("volume"),
            F.count("*").alias("n_spellings"),
        )
    )


@query
def next_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.col("symbol")
    parsed = _feed_symbols(spark, sf_dir).filter(symbols.is_supported_contract(symbol))
    number = symbols.contract_year(symbol) * 12 + symbols.contract_month(symbol) - 1
    root = symbols.contract_root(symbol)
    return parsed.select(
        "symbol",
        "volume",
        symbols.symbol_at(root, symbols.next_quarter_no(number)).alias("next_symbol"),
        symbols.symbol_at(root, symbols.previous_quarter_no(number)).alias(
            "previous_symbol"
        ),
    )


# --- intervals -------------------------------------------------------------


@query
def merge_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge_ranges(views.recorded_ranges(spark, sf_dir), KEY)


@query
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.missing_ranges(
        views.bar_requests(spark, sf_dir), views.recorded_ranges(spark, sf_dir), KEY
    )


@query
def subtract_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.subtract_ranges(
        views.recorded_ranges(spark, sf_dir), views.cleared_ranges(spark, sf_dir), KEY
    )


@query
def missing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    recorded = views.known_ranges(spark, sf_dir)
    present = coverage.present_partitions(views.rows_of_both(spark, sf_dir))
    return coverage.missing_union(
        views.requests(spark, sf_dir), recorded, present, views.calendar(spark)
    )


@query
def month_reload_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = coverage.month_reload_window(
        views.inner_requests(spark, sf_dir), views.recorded_ranges(spark, sf_dir)
    )
    return windows.select(
        *KEY, "year", "month", "load_start", "load_end"
    )


@query
def observed_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.observed_ranges(views.rows_of_both(spark, sf_dir))


@query
def session_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.session_islands(
        views.ticks(spark, sf_dir), views.calendar(spark), KEY, "trade_date"
    )


@query
def delete_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete every request's window, and three whole days of one dataset."""
    rows = _lake_rows(spark, sf_dir)
    path = _new_lake(spark, rows)
    whole_days = (
        rows.filter(F.col("dataset") == views.OTHER_DATASET)
        .select(*KEY)
        .distinct()
        .select(
            *KEY,
            F.lit(date(2024, 1, 10)).alias("range_start"),
            F.lit(date(2024, 1, 12)).alias("range_end"),
        )
    )
    windows = views.tick_requests(spark, sf_dir).unionByName(whole_days)
    deleted = lake.delete_windows(spark, path, windows)
    gone = deleted.groupBy(*KEY).agg(
        F.count("*").alias("n_deleted_partitions"),
        F.sum("n_rows").cast("bigint").alias("n_deleted_rows"),
    )
    left = lake.read_lake(spark, path).groupBy(*KEY).agg(
        F.count("*").alias("n_left_rows"),
        F.sum("price_cents").cast("bigint").alias("left_cents"),
    )
    counts = [
        "n_deleted_partitions", "n_deleted_rows", "n_left_rows", "left_cents",
    ]
    zero = F.lit(0).cast("bigint")
    return gone.join(left, KEY, "full").select(
        *KEY, *[F.coalesce(c, zero).alias(c) for c in counts]
    )


# --- coverage --------------------------------------------------------------


def _partition_rows(listed: DataFrame) -> DataFrame:
    return listed.select(
        *coverage.REQUEST,
        *coverage.PARTITION,
        "part_start",
        "part_end",
    )


@query
def expected_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partition_rows(
        coverage.expected_partitions(
            views.requests(spark, sf_dir), views.calendar(spark)
        )
    )


@query
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_partitions(views.rows_of_both(spark, sf_dir))
    return _partition_rows(
        coverage.missing_partitions(
            views.requests(spark, sf_dir), present, views.calendar(spark)
        )
    )


@query
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_partitions(views.rows_of_both(spark, sf_dir))
    return coverage.coverage_status(
        views.requests(spark, sf_dir),
        views.known_ranges(spark, sf_dir),
        present,
        views.calendar(spark),
    )


@query
def coverage_status_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status by the catalog alone, without a look at the partitions."""
    nothing = coverage.present_partitions(views.ticks(spark, sf_dir).filter("false"))
    return coverage.coverage_status(
        views.requests(spark, sf_dir),
        views.known_ranges(spark, sf_dir),
        nothing,
        views.calendar(spark),
        verify_files=False,
    )


@query
def observed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates come from the integer event time of the ticks."""
    rows = lake.normalise(
        views.ticks(spark, sf_dir).select(*KEY, F.col("ts_event_ns").alias("ts_event"))
    )
    return catalog.observed_range(
        rows.select(*KEY, "trade_date").unionByName(
            views.bars(spark, sf_dir).select(*KEY, "trade_date")
        )
    )


@query
def observed_range_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of every exported file of minute rows, from footers alone."""
    return _exported(
        spark,
        views.minute_rows(spark, sf_dir),
        lambda root: layout.observed_range_files(spark, root),
    )


# --- inventory -------------------------------------------------------------


@query
def inventory_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_groups(views.holdings(spark, sf_dir), BOOK)


@query
def inventory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick symbols of each dataset: contracts in groups, all others by themselves."""
    items = (
        views.ticks(spark, sf_dir)
        .groupBy("dataset", "symbol", "schema_")
        .agg(
            F.sum("n_bytes").cast("bigint").alias("size_bytes"),
            F.count_if(F.col("price_cents") < 100).alias("n_issues"),
        )
    )
    return inventory.inventory_listing(items, ["dataset"])


@query
def contract_chain_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.chain_gaps(views.holdings(spark, sf_dir), BOOK)


@query
def inventory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_totals(views.holdings(spark, sf_dir))


@query
def inventory_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing per dataset: each tick symbol beside the contracts held."""
    listed = (
        views.ticks(spark, sf_dir)
        .select("dataset", "symbol", "schema_")
        .unionByName(views.holdings(spark, sf_dir).select("dataset", "symbol", "schema_"))
        .distinct()
    )
    ordered = inventory.inventory_order(spark, listed, ["dataset"])
    return ordered.select("dataset", "symbol", "schema_", "position")


# --- quality ---------------------------------------------------------------


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.extract_issues(views.notices(spark, sf_dir))


@query
def quality_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(spark, sf_dir)


@query
def quality_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of the second half of January join the store of the first half."""
    notices = views.notices(spark, sf_dir)
    early = F.col("trade_date") < F.lit(date(2024, 1, 16))
    return quality.merge_issues(
        quality.extract_issues(notices.filter(early)),
        quality.extract_issues(notices.filter(~early)),
    ).select(*KEY, "issue_date", "issue_type", "arrival")


@query
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filter_issues(
        _issues(spark, sf_dir),
        start=date(2024, 1, 10),
        end=date(2024, 1, 20),
        prefix="n",
        schema="trades",
    ).select(*KEY, "issue_date", "issue_type")


@query
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_counts(_issues(spark, sf_dir))


@query
def quality_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_digest(_issues(spark, sf_dir))


# --- catalog upkeep --------------------------------------------------------


@query
def orphan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.with_partitions(views.ticks(spark, sf_dir).select(*KEY, "trade_date"))
    partitions = rows.select(*KEY, *coverage.PARTITION).distinct()
    orphans = catalog.orphan_partitions(partitions, views.catalog(spark, sf_dir))
    return orphans.select(*KEY, *coverage.PARTITION)


@query
def catalog_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.validate_catalog(
        views.catalog(spark, sf_dir), views.ticks(spark, sf_dir)
    )


@query
def catalog_validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog, taken for one of minutes, against the footers of exported files."""
    bounds = observed_range_files(spark, sf_dir)
    recorded = views.catalog(spark, sf_dir).withColumn("schema_", F.lit(views.MINUTES))
    return catalog.validate_bounds(recorded, layout.key_bounds(bounds))


@query
def catalog_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.fix_catalog(
        views.catalog(spark, sf_dir), views.ticks(spark, sf_dir), single_range=False
    )


@query
def catalog_fix_then_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.ticks(spark, sf_dir)
    return catalog.validate_catalog(
        catalog.fix_catalog(views.catalog(spark, sf_dir), rows), rows
    )


@query
def catalog_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = views.ticks(spark, sf_dir).withColumn(
        "symbol", symbols.path_symbol(F.col("symbol"))
    )
    return catalog.rebuild_orphans(views.catalog(spark, sf_dir), files)


@query
def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with one range per key, against the partitions there are."""
    rows = views.rows_of_both(spark, sf_dir)
    recorded = catalog.observed_range(rows).select(
        *KEY,
        F.col("first_date").alias("range_start"),
        F.col("last_date").alias("range_end"),
    )
    return catalog.verify_catalog(
        recorded, coverage.present_partitions(rows), views.calendar(spark)
    )


# --- plans -----------------------------------------------------------------


@query
def dataset_available_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.available_end(views.rows_of_both(spark, sf_dir))


def _holding_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.update_plan(
        views.holdings(spark, sf_dir),
        updates.available_end(views.bars(spark, sf_dir)),
        views.contracts(spark),
        views.BARS_AS_OF,
        keys=HOLDING,
    )


@query
def update_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holding_plan(spark, sf_dir)


def _series_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.update_plan(
        views.catalog(spark, sf_dir),
        updates.available_end(views.ticks(spark, sf_dir)),
        views.contracts(spark),
        views.TICKS_AS_OF,
    )


@query
def update_plan_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series_plan(spark, sf_dir)


@query
def update_plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_days(views.ticks(spark, sf_dir))
    outcomes = updates.update_outcomes(_series_plan(spark, sf_dir), present)
    return updates.outcome_counts(outcomes)


@query
def auto_roll_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolls = updates.auto_roll_plan(
        views.holdings(spark, sf_dir), views.contracts(spark), views.BARS_AS_OF, BOOK
    )
    return rolls.withColumn("schemas", F.concat_ws(",", "schemas"))


@query
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = [*BOOK, "root"]
    rows = views.contract_bars(spark, sf_dir)
    spans = rows.groupBy(*scope, "schema_").agg(
        F.year(F.min("trade_date")).alias("from_year"),
        F.year(F.max("trade_date")).alias("to_year"),
    )
    present = coverage.present_partitions(rows, [*scope, "symbol", "schema_"])
    recorded = views.holdings(spark, sf_dir).withColumn(
        "root", symbols.contract_root(F.col("symbol"))
    )
    return updates.batch_plan(
        spans,
        views.contracts(spark),
        recorded,
        present,
        views.calendar(spark),
        views.BARS_AS_OF,
        scope,
    )


@query
def ensure_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = coverage.present_partitions(views.rows_of_both(spark, sf_dir))
    return updates.ensure_split(
        views.requests(spark, sf_dir),
        views.known_ranges(spark, sf_dir),
        present,
        views.calendar(spark),
    )


@query
def request_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.resolve_requests(
        views.open_requests(spark, sf_dir), views.contracts(spark), views.BARS_AS_OF
    )


@query
def far_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of the second half of the century, with their dates."""
    counted = views.far_feed(spark, sf_dir).groupBy("symbol").agg(
        F.sum("volume").cast("bigint").alias("volume")
    )
    dim = views.contracts(spark).select(
        "symbol", "rule", "year", "month", "expiration", "window_start", "next_symbol"
    )
    return counted.join(F.broadcast(dim), "symbol", "left")


# --- load jobs -------------------------------------------------------------


def _snapshot_store(spark: SparkSession, sf_dir: str) -> loading.Store:
    """The ticks up to the snapshot dates, with the catalog of that time."""
    rows = _lake_rows(spark, sf_dir)
    loaded = F.col("trade_date") <= views.snapshot_date(F.col("dataset"))
    return loading.start_store(
        spark,
        scratch_path(spark, "store"),
        rows.filter(loaded),
        views.catalog(spark, sf_dir),
        views.UPDATED_AT,
    )


def _january(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.ticks(spark, sf_dir)
        .select(*KEY)
        .distinct()
        .select(
            *KEY,
            F.lit(views.TICKS_START).alias("range_start"),
            F.lit(views.TICKS_END).alias("range_end"),
        )
    )


def _store_summary(store: loading.Store) -> DataFrame:
    """Rows, recorded days and present partitions of every key."""
    rows = store.rows().groupBy(*KEY).agg(
        F.count("*").alias("n_rows"),
        F.sum("price_cents").cast("bigint").alias("price_cents"),
    )
    days = F.datediff("range_end", "range_start") + 1
    known = store.recorded().groupBy(*KEY).agg(F.sum(days).alias("n_recorded_days"))
    slots = store.present().groupBy(*KEY).agg(
        F.sum(F.bit_count("slot_mask")).alias("n_partitions")
    )
    zero = F.lit(0).cast("bigint")
    return (
        rows.join(known, KEY, "full")
        .join(slots, KEY, "full")
        .select(
            *KEY,
            *[
                F.coalesce(c, zero).alias(c)
                for c in ("n_rows", "price_cents", "n_recorded_days", "n_partitions")
            ],
        )
    )


@query
def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key's January is completed from the landing ticks."""
    store = _snapshot_store(spark, sf_dir)
    loading.load_job(
        store,
        _january(spark, sf_dir),
        _lake_rows(spark, sf_dir),
        views.calendar(spark),
        views.UPDATED_AT,
    )
    return _store_summary(store)


@query
def load_job_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice, the job loads nothing more and changes nothing."""
    store = _snapshot_store(spark, sf_dir)
    for _ in range(2):
        loaded = loading.load_job(
            store,
            _january(spark, sf_dir),
            _lake_rows(spark, sf_dir),
            views.calendar(spark),
            views.UPDATED_AT,
        )
    again = loaded.groupBy(*KEY).agg(F.count("*").alias("n_loaded_again"))
    none = F.coalesce("n_loaded_again", F.lit(0).cast("bigint"))
    return _store_summary(store).join(again, KEY, "left").withColumn("n_loaded_again", none)


@query
def clear_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request's window goes from rows, catalog and presence."""
    store = _snapshot_store(spark, sf_dir)
    loading.clear(store, views.tick_requests(spark, sf_dir), views.UPDATED_AT)
    return _store_summary(store)


@query
def verify_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded ranges that lack a partition are dropped; what is left."""
    store = _snapshot_store(spark, sf_dir)
    loading.verify_and_fix(store, views.calendar(spark), views.UPDATED_AT)
    return store.recorded()


@query
def update_all_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update plan of all series is carried out."""
    return loading.update_all(
        _snapshot_store(spark, sf_dir),
        _series_plan(spark, sf_dir),
        _lake_rows(spark, sf_dir),
        views.calendar(spark),
        views.UPDATED_AT,
    )


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake loaded up to the snapshot dates gets the sessions it lacks."""
    landing = _lake_rows(spark, sf_dir)
    loaded = F.col("trade_date") <= views.snapshot_date(F.col("dataset"))
    path = _new_lake(spark, landing.filter(loaded))
    wanted = (
        landing.select(*KEY)
        .distinct()
        .select(
            *KEY,
            F.lit(views.TICKS_START).alias("range_start"),
            F.lit(views.TICKS_END).alias("range_end"),
        )
    )
    missing = coverage.missing_partitions(
        wanted,
        coverage.present_partitions(lake.read_lake(spark, path)),
        views.calendar(spark),
    )
    lake.load_missing(spark, landing, path, missing)
    return (
        lake.read_lake(spark, path)
        .groupBy(*lake.FOLDERS)
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("price_cents").cast("bigint").alias("price_cents"),
        )
    )


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks arrive twice, by two streams, and are there once."""
    path = scratch_path(spark, "stream")
    # A glob, so that one file as well as a folder of files can be the source.
    for _ in range(2):
        ingest.ingest_available(
            spark,
            landing=f"{sf_dir}/events.parque[t]",
            schema=views.table(spark, sf_dir, "events").schema,
            to_rows=lambda events: views.ticks_from_events(events).select(*LAKE_COLUMNS),
            path=path,
            checkpoint=scratch_path(spark, "stream-state"),
        )
    return lake.partition_row_counts(lake.read_lake(spark, path))


@query
def stream_into_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks arrive by a stream; rows, recorded days and presence of the store."""
    store = loading.Store(spark, scratch_path(spark, "store"))
    ingest.ingest_into_store(
        store,
        landing=f"{sf_dir}/events.parque[t]",
        schema=views.table(spark, sf_dir, "events").schema,
        to_rows=lambda events: views.ticks_from_events(events).select(*LAKE_COLUMNS),
        checkpoint=scratch_path(spark, "stream-state"),
        updated_at=views.UPDATED_AT,
    )
    return _store_summary(store)


@query
def ensure_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests' gaps are loaded in waves; the rows of those now complete."""
    served = loading.ensure(
        _snapshot_store(spark, sf_dir),
        views.tick_requests(spark, sf_dir),
        _lake_rows(spark, sf_dir),
        views.calendar(spark),
        views.UPDATED_AT,
        waves=2,
    )
    return served.select("event_id", *KEY, "trade_date", "price_cents")


FLAGSHIP = coverage_status
