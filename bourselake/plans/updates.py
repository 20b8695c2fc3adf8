"""What to load next: updates, successor rolls, batches, gap loads."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourselake.functions import symbols
from bourselake.operators import contracts as futures
from bourselake.operators import coverage
from bourselake.operators.coverage import KEY
from bourselake.session import spread


def available_end(landing: DataFrame) -> DataFrame:
    """Last date with landing rows, per dataset."""
    return landing.groupBy("dataset").agg(F.max("trade_date").alias("available_end"))


def _with_expiration(items: DataFrame, contracts: DataFrame) -> DataFrame:
    expiry = contracts.select(
        F.col("symbol").alias("_symbol"), "root", "expiration", "next_symbol"
    )
    return items.join(
        F.broadcast(expiry), F.upper("symbol") == F.col("_symbol"), "left"
    ).drop("_symbol")


def update_plan(
    catalog: DataFrame,
    available: DataFrame,
    contracts: DataFrame,
    as_of: date,
    keys: list[str] = KEY,
    end: date | None = None,
) -> DataFrame:
    """Range to load per catalog key, or none if it is up to date.

    The range runs from the day after the last recorded one to the least of the
    wanted end (default: the day before ``as_of``), the dataset's available end
    and the contract's expiration.
    """
    wanted = F.lit(end) if end is not None else F.date_sub(F.lit(as_of), 1)
    last = spread(catalog, *keys).groupBy(*keys).agg(F.max("range_end").alias("last_date"))
    # One row per dataset: the fixed vocabulary bounds it, a shuffle would meet on it.
    bounded = _with_expiration(last, contracts).join(
        F.broadcast(available), "dataset", "left"
    )
    start = F.date_add("last_date", 1)
    until = F.least(wanted, "available_end", "expiration")  # least ignores nulls
    expired = F.coalesce(F.col("last_date") >= F.col("expiration"), F.lit(False))
    due = ~expired & (start <= until)
    return bounded.select(
        *keys,
        "last_date",
        "expiration",
        F.when(due, start).alias("range_start"),
        F.when(due, until).alias("range_end"),
        F.when(due, "due").otherwise("up_to_date").alias("state"),
    )


def update_outcomes(
    plan: DataFrame, present: DataFrame, keys: list[str] = KEY
) -> DataFrame:
    """Outcome per plan row: updated, up_to_date, or error if nothing has landed."""
    due = plan.filter(F.col("state") == "due")
    landed = coverage.rows_in_requests(due, present, keys)
    done = plan.filter(F.col("state") != "due").select(
        *keys, F.col("state").alias("outcome")
    )
    return landed.select(
        *keys, F.when(F.col("has_rows"), "updated").otherwise("error").alias("outcome")
    ).unionByName(done)


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n_items"))


def auto_roll_plan(
    catalog: DataFrame,
    contracts: DataFrame,
    as_of: date,
    scope: list[str],
) -> DataFrame:
    """Successors of fully loaded expired contracts that are not held yet.

    ``scope`` are the key columns besides symbol and schema_. One row per
    successor with its schemas (at most the schema vocabulary) and window.
    """
    dated = catalog.groupBy(*scope, "symbol", "schema_").agg(
        F.max("range_end").alias("last_date")
    )
    last = _with_expiration(dated, contracts)
    held = F.struct(F.upper("symbol").alias("symbol"), F.lit(True).alias("_held"))
    successor = F.struct(F.col("next_symbol").alias("symbol"), F.lit(False).alias("_held"))
    finished = F.col("last_date") >= F.col("expiration")
    named = last.select(
        *scope, "schema_", F.inline(F.when(finished, F.array(held, successor)).otherwise(F.array(held)))
    )
    # A null is equal to nothing: what is held under one keeps no successor out.
    key = [*scope, "symbol", "schema_"]
    is_held = F.col("_held") & reduce(and_, [F.col(c).isNotNull() for c in key])
    rolls = (
        spread(named, *scope, "symbol")
        .groupBy(*key)
        .agg(F.bool_or(is_held).alias("_is_held"), F.bool_and("_held").alias("_only_held"))
        .filter("not _is_held and not _only_held")
        .groupBy(*scope, "symbol")
        .agg(F.sort_array(F.collect_set("schema_")).alias("schemas"))
    )
    end, available = futures.capped_window(
        F.lit(as_of), F.col("window_start"), F.col("expiration")
    )
    windows = contracts.select("symbol", "window_start", end, available)
    return (
        rolls.join(F.broadcast(windows), "symbol")
        .filter("is_available")
        .filter(F.col("window_start") <= F.col("window_end"))
        .select(
            *scope,
            "symbol",
            "schemas",
            F.col("window_start").alias("range_start"),
            F.col("window_end").alias("range_end"),
        )
    )


def available_contracts(
    spans: DataFrame, contracts: DataFrame, as_of: date
) -> DataFrame:
    """Quarterly contracts of each span's root and years that have begun.

    ``spans`` has root, from_year, to_year and any other columns. The end of a
    live contract's window is capped at the day before ``as_of``.
    """
    end, available = futures.capped_window(
        F.lit(as_of), F.col("window_start"), F.col("expiration")
    )
    windows = futures.quarterly(contracts).select(
        F.col("root").alias("_root"),
        "symbol",
        "year",
        "expiration",
        "window_start",
        end,
        available,
    )
    in_years = F.col("year").between(F.col("from_year"), F.col("to_year"))
    return (
        spans.filter(symbols.is_supported_root(F.col("root")))
        .join(
            F.broadcast(windows), (F.upper("root") == F.col("_root")) & in_years
        )
        .filter("is_available")
        .drop("_root", "year", "is_available")
    )


def batch_plan(
    spans: DataFrame,
    contracts: DataFrame,
    recorded: DataFrame,
    present: DataFrame,
    calendar: DataFrame,
    as_of: date,
    scope: list[str],
    force: bool = False,
) -> DataFrame:
    """Contracts of a root and year range: load each, or skip if complete.

    A group is a scope, root and schema; its contracts are listed when all that is recorded
    and present of them is known, since they are many times the rows.
    """
    keys = [*scope, "symbol", "schema_"]
    by = [*scope, "schema_"] if "root" in scope else [*scope, "_of_root", "schema_"]
    end, available = futures.capped_window(
        F.lit(as_of), F.col("window_start"), F.col("expiration")
    )
    windows = (
        futures.quarterly(contracts)
        .select(F.col("root").alias("_of_root"), "symbol", "window_start", end, available)
        .filter("is_available")
        .select("_of_root", "symbol", *_window_as_range())
    )

    def listed(groups: DataFrame) -> DataFrame:
        root = [] if "root" in scope else [F.col("_of_root").alias("root")]
        years = groups.select(*scope, *root, "schema_", "_cached", F.inline("_years"))
        return available_contracts(years, contracts, as_of).select(
            *keys, *_window_as_range(), "_cached"
        )

    checked = coverage.symbol_windows_status(
        _years_by_group(spans, by), listed, windows, recorded, present, calendar, by, keys
    )
    skip = (F.col("status") == "COMPLETE") & ~F.lit(force)
    return checked.withColumn("action", F.when(skip, "skip").otherwise("load"))


def _window_as_range() -> list[Column]:
    return [F.col("window_start").alias("range_start"), F.col("window_end").alias("range_end")]


def _years_by_group(spans: DataFrame, by: list[str]) -> DataFrame:
    """Each group once, with ``_years``: its (from_year, to_year), without overlaps.

    The years contracts can have are bits of two masks. Spans that leave years out between
    them are cut into single years, at most a century.
    """
    first, last = futures.FIRST_YEAR, futures.LAST_YEAR
    given = spans.withColumn("_of_root", F.upper("root")).filter("from_year <= to_year")
    start = F.greatest(F.col("from_year"), F.lit(first)).cast("int")
    end = F.least(F.col("to_year"), F.lit(last)).cast("int")
    halves = {"_early": first, "_late": first + 50}
    pair = lambda a, b: F.struct(a.alias("from_year"), b.alias("to_year"))

    def bits(base: int) -> Column:
        low, high = F.greatest(start - base, F.lit(0)), F.least(end - base + 1, F.lit(50))
        one = F.lit(1).cast("bigint")
        mask = F.call_function("shiftleft", one, high) - F.call_function("shiftleft", one, low)
        return F.when(high > low, mask).otherwise(F.lit(0).cast("bigint"))

    def held(year: Column) -> Column:
        return F.when(year < first + 50, F.getbit("_early", year - first)).otherwise(
            F.getbit("_late", year - first - 50)
        )

    merged = (
        spread(given.filter(start <= end), *by)
        .groupBy(*by)
        .agg(
            F.min(start).alias("_from"),
            F.max(end).alias("_to"),
            *[F.bit_or(bits(base)).alias(name) for name, base in halves.items()],
        )
    )
    n_years = F.bit_count("_early") + F.bit_count("_late")
    every = F.filter(F.sequence("_from", "_to"), lambda y: held(y) == 1)
    years = F.when(
        n_years == F.col("_to") - F.col("_from") + 1, F.array(pair(F.col("_from"), F.col("_to")))
    ).otherwise(F.transform(every, lambda y: pair(y, y)))
    return merged.select(*by, years.alias("_years"))


def front_month_windows(
    roots: DataFrame, contracts: DataFrame, as_of: date
) -> DataFrame:
    """Current front contract of each (root, day) row and its capped window."""
    front = futures.front_month(roots, contracts, "day")
    end, _ = futures.capped_window(
        F.lit(as_of), F.col("window_start"), F.col("expiration")
    )
    return front.select(
        *roots.columns, "front_symbol", "window_start", "expiration", end
    )


def ensure_split(
    requests: DataFrame, recorded: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Split requests: complete ones are served, the others load their gaps.

    One row per served request, one per gap of the others.
    """
    found = coverage.status_and_gaps(requests, recorded, present, calendar)
    action = F.when(F.col("status") == "COMPLETE", "serve").otherwise("load")
    return found.select(
        *KEY,
        F.col("range_start").alias("request_start"),
        F.col("range_end").alias("request_end"),
        action.alias("action"),
        F.inline_outer("gaps"),
    )


def resolve_requests(requests: DataFrame, contracts: DataFrame, as_of: date) -> DataFrame:
    """Bounds of every request, or the reason why it has none.

    Both bounds are taken as they are. Without either, a supported contract gets its
    window, capped at the day before ``as_of``. All else is rejected: one bound alone,
    a symbol whose dates cannot be told, a contract that has not begun.
    """
    end, available = futures.capped_window(
        F.lit(as_of), F.col("window_start"), F.col("expiration")
    )
    windows = contracts.select(F.col("symbol").alias("_symbol"), "window_start", end, available)
    start, until = F.col("range_start"), F.col("range_end")
    both, neither = start.isNotNull() & until.isNotNull(), start.isNull() & until.isNull()
    reason = (
        F.when(~both & ~neither, "one_bound")
        .when(neither & F.col("_symbol").isNull(), "no_dates")
        .when(neither & ~F.col("is_available"), "not_begun")
    )
    auto = neither & F.col("is_available")
    return (
        requests.join(F.broadcast(windows), F.upper("symbol") == F.col("_symbol"), "left")
        .select(
            *[c for c in requests.columns if c not in ("range_start", "range_end")],
            F.when(both, start).when(auto, F.col("window_start")).alias("range_start"),
            F.when(both, until).when(auto, F.col("window_end")).alias("range_end"),
            reason.alias("reject_reason"),
        )
    )
