"""Market-data views derived row by row from the given tables.

``events`` become ticks and quality notices, ``lineitem`` becomes daily bars,
recorded ranges, contract holdings and a symbol feed, ``documents`` becomes a
file manifest. Nothing here limits the rows that are read.
"""

from __future__ import annotations

from datetime import date, datetime
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.functions import eventtime, symbols
from bourselake.functions.vocab import MONTH_LETTERS, SUPPORTED_ROOTS
from bourselake.operators import calendars, intervals
from bourselake.operators import contracts as futures
from bourselake.operators.coverage import KEY, partition_columns
from bourselake.session import spread
from bourselake.sources.dimensions import stored

TICKS_AS_OF = date(2024, 2, 1)
BARS_AS_OF = date(2021, 12, 31)
UPDATED_AT = datetime(2024, 2, 1)
BARS_START, BARS_END = date(2015, 1, 1), date(2021, 12, 31)
TICKS_START, TICKS_END = date(2024, 1, 1), date(2024, 1, 31)

# Event type or line status to dataset, how far each dataset was
# loaded when the catalog snapshot was taken, return flag to bar schema.
EVENT_DATASET = {
    "click": "GLBX.MDP3",
    "view": "OPRA.PILLAR",
    "purchase": "XNAS.ITCH",
    "signup": "DBEQ.BASIC",
}
OTHER_DATASET = "UNKNOWN.DATASET"
SNAPSHOT_DATE = {
    "GLBX.MDP3": date(2024, 1, 4),
    "OPRA.PILLAR": date(2024, 1, 12),
    "XNAS.ITCH": date(2024, 1, 31),
    "DBEQ.BASIC": date(2024, 1, 20),
    "UNKNOWN.DATASET": date(2024, 1, 26),
}
STATUS_DATASET = {"F": "IFUS.IMPACT"}
OTHER_BAR_DATASET = "GLBX.MDP3"
FLAG_SCHEMA = {"A": "ohlcv-1d", "N": "ohlcv-1h"}
OTHER_FLAG_SCHEMA = "ohlcv-1m"
MINUTES = "ohlcv-1m"
FEED_ROOTS = (*SUPPORTED_ROOTS, "AAPL", "CL", "VX", "ZC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    index = F.pmod(number, F.lit(len(values))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def _lookup(mapping: dict, key: Column, default) -> Column:
    entries = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    return F.coalesce(F.element_at(entries, key), F.lit(default))


def calendar(spark: SparkSession) -> DataFrame:
    return stored(spark, "calendar_day", calendars.calendar_day)


def contracts(spark: SparkSession) -> DataFrame:
    return stored(
        spark, "contract", lambda s: futures.contract_dim(s, calendar(s))
    )


def ticks_from_events(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    suffix = (
        F.when(user % 5 == 0, ".c.0")
        .when(user % 5 == 1, ".v.0")
        .when(user % 5 == 2, ".FUT")
        .otherwise(_pick(("H24", "M24", "U24", "Z24"), F.floor(user / 21)))
    )
    return events.select(
        _lookup(EVENT_DATASET, F.col("event_type"), OTHER_DATASET).alias("dataset"),
        F.concat(_pick(SUPPORTED_ROOTS, user), suffix).alias("symbol"),
        F.lit("trades").alias("schema_"),
        "event_id",
        "user_id",
        F.col("ts").alias("ts_event"),
        eventtime.micros_to_nanos(F.col("ts")).alias("ts_event_ns"),
        F.to_date("ts").alias("trade_date"),
        F.col("value").alias("price"),
        F.round(F.col("value") * 100).cast("bigint").alias("price_cents"),
        F.length("props").cast("bigint").alias("n_bytes"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _lookup(STATUS_DATASET, F.col("l_linestatus"), OTHER_BAR_DATASET).alias(
            "dataset"
        ),
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.lit("ohlcv-1d").alias("schema_"),
        _pick(SUPPORTED_ROOTS, F.col("l_partkey")).alias("root"),
        F.col("l_suppkey").alias("book"),
        _lookup(FLAG_SCHEMA, F.col("l_returnflag"), OTHER_FLAG_SCHEMA).alias("feed"),
        F.add_months(F.to_date("l_shipdate"), 240).alias("trade_date"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        (F.col("l_discount") >= 0.095).alias("is_degraded"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
    )


def minute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks as rows of a schema with one file a month, of which footers tell bounds."""
    return ticks(spark, sf_dir).select(
        "dataset", "symbol", F.lit(MINUTES).alias("schema_"), "trade_date", "ts_event_ns"
    )


def rows_of_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and date of every tick and bar."""
    columns = [*KEY, "trade_date"]
    both = ticks(spark, sf_dir).select(*columns)
    return both.unionByName(bars(spark, sf_dir).select(*columns))


def recorded_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping ranges per instrument, one per bar."""
    return bars(spark, sf_dir).select(
        *KEY,
        F.col("trade_date").alias("range_start"),
        F.date_add("trade_date", F.col("line") * 5).alias("range_end"),
    )


def cleared_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows cleared per instrument, one per returned bar."""
    return (
        bars(spark, sf_dir)
        .filter("is_returned")
        .select(
            *KEY,
            F.col("trade_date").alias("range_start"),
            F.date_add("trade_date", F.col("line")).alias("range_end"),
        )
    )


def tick_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset's request for every symbol, a window of up to five days."""
    datasets = F.array(*[F.lit(d) for d in (*EVENT_DATASET.values(), OTHER_DATASET)])
    first = F.col("first_user")
    start = F.date_add(F.lit(TICKS_START), (first * 7 % 26).cast("int"))
    return (
        ticks(spark, sf_dir)
        .groupBy("symbol", "schema_")
        .agg(F.min("user_id").alias("first_user"))
        .select(
            F.explode(datasets).alias("dataset"),
            "symbol",
            "schema_",
            start.alias("range_start"),
            F.date_add(start, (first % 5).cast("int")).alias("range_end"),
        )
    )


def bar_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven whole years of every instrument."""
    return (
        bars(spark, sf_dir)
        .select(*KEY)
        .distinct()
        .select(
            *KEY,
            F.lit(BARS_START).alias("range_start"),
            F.lit(BARS_END).alias("range_end"),
        )
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_requests(spark, sf_dir).unionByName(bar_requests(spark, sf_dir))


def inner_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per instrument that starts and ends inside months."""
    return (
        bars(spark, sf_dir)
        .groupBy(*KEY)
        .agg(
            F.date_add(F.min("trade_date"), 45).alias("range_start"),
            F.date_sub(F.max("trade_date"), 40).alias("range_end"),
        )
        .filter(F.col("range_start") <= F.col("range_end"))
    )


def snapshot_date(dataset: Column) -> Column:
    return _lookup(SNAPSHOT_DATE, dataset, SNAPSHOT_DATE[OTHER_DATASET])


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog as recorded when each dataset was loaded up to its snapshot date.

    One dataset records a single [first, last] range per key, the others record
    every island of days.
    """
    loaded = ticks(spark, sf_dir).filter(
        F.col("trade_date") <= snapshot_date(F.col("dataset"))
    )
    single = F.col("dataset") == "XNAS.ITCH"
    spans = (
        loaded.filter(single)
        .groupBy(*KEY)
        .agg(
            F.min("trade_date").alias("range_start"),
            F.max("trade_date").alias("range_end"),
        )
    )
    islands = intervals.day_islands(loaded.filter(~single), KEY, "trade_date")
    return spans.unionByName(islands).withColumn(
        "stype", symbols.symbol_type(F.col("symbol"))
    )


def known_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded ranges of ticks and bars."""
    return recorded_ranges(spark, sf_dir).unionByName(
        catalog(spark, sf_dir).drop("stype")
    )


def open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol of the feed, with both bounds, one of them, or none."""
    volume = F.col("volume")
    start = F.when(volume % 4 < 2, F.date_add(F.lit(BARS_START), (volume % 2000).cast("int")))
    return (
        symbol_feed(spark, sf_dir)
        .groupBy("symbol")
        .agg(F.sum("volume").alias("volume"))
        .select(
            "symbol",
            volume.cast("bigint").alias("volume"),
            start.alias("range_start"),
            F.when(volume % 2 == 0, F.lit(BARS_END)).alias("range_end"),
        )
    )


def far_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of 2060 to 2099, one per order line."""
    year = (60 + F.col("l_orderkey") % 40).cast("int")
    letter = F.substring(
        F.lit(MONTH_LETTERS), (F.col("l_suppkey") % 12 + 1).cast("int"), F.lit(1)
    )
    root = _pick(SUPPORTED_ROOTS, F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(root, letter, year.cast("string")).alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("volume"),
    )


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notice per event; those of error events name dates of poor quality."""
    kind = F.when(F.col("price") < 20, "degraded").otherwise("missing")
    later = F.date_add("trade_date", (F.col("user_id") % 7).cast("int"))
    named = F.concat(
        F.lit("The request has reduced quality: "),
        F.col("trade_date").cast("string"),
        F.lit(" ("),
        kind,
        F.lit("), "),
        later.cast("string"),
        F.lit(", , 2024-02-30 (missing). See the notes."),
    )
    failed = F.col("dataset") == OTHER_DATASET
    return ticks(spark, sf_dir).select(
        F.lit("GLBX.MDP3").alias("dataset"),
        "symbol",
        "schema_",
        F.col("event_id").alias("arrival"),
        F.when(failed, named).otherwise("Request done. No remarks.").alias("text"),
        "trade_date",
    )


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts held per book and feed, sliced out of the bars.

    The recorded range ends with the month of the last bar, or at expiration. Most holdings
    have one bar, so rows are dealt before they are grouped, not after.
    """
    sliced = futures.contract_slice(
        bars(spark, sf_dir).drop("symbol", "schema_"), contracts(spark), "trade_date"
    )
    first_month = F.trunc(F.min("trade_date"), "MM").cast("date")
    return spread(sliced, "book", "dataset", "symbol", "feed").groupBy(
        "book", "dataset", "symbol", F.col("feed").alias("schema_")
    ).agg(
        F.greatest(first_month, F.min("window_start")).alias("range_start"),
        F.least(F.last_day(F.max("trade_date")), F.min("expiration")).alias(
            "range_end"
        ),
        F.sum("volume").cast("bigint").alias("size_bytes"),
        F.count_if("is_degraded").alias("n_issues"),
    )


def contract_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars keyed by book, contract and feed, as holdings are."""
    return futures.contract_slice(
        bars(spark, sf_dir).drop("symbol", "schema_"), contracts(spark), "trade_date"
    ).withColumnRenamed("feed", "schema_")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the text length stands for the file size."""
    return table(spark, sf_dir, "documents").select(
        "source", "lang", F.col("n_chars").cast("bigint").alias("size_bytes")
    )


def partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths of all partitions of ticks and bars, with their row counts."""
    year, month, day = partition_columns(F.col("schema_"), F.col("trade_date"))
    counted = (
        rows_of_both(spark, sf_dir)
        .groupBy(*KEY, year, month, day)
        .agg(F.count("*").alias("n_rows"))
    )

    def two(name: str) -> Column:
        return F.lpad(F.col(name).cast("string"), 2, "0")

    path = F.concat_ws(
        "/",
        F.lit("/store"),
        "dataset",
        symbols.path_symbol(F.col("symbol")),
        "schema_",
        F.col("year").cast("string"),
        two("month"),
        F.when(F.col("day") > 0, two("day")),  # nulls are left out
    )
    return counted.select(F.concat(path, F.lit(".parquet")).alias("path"), "n_rows")


def symbol_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols in all spellings: contracts, rolls, parents, roots, rejects."""
    root = _pick(FEED_ROOTS, F.col("l_partkey"))
    letter = F.substring(
        F.lit(MONTH_LETTERS), (F.col("l_suppkey") % 12 + 1).cast("int"), F.lit(1)
    )
    year = (F.col("l_orderkey") % 30).cast("string")
    contract = F.concat(root, letter, F.lpad(year, 2, "0"))
    roll = F.concat(root, F.lit("."), _pick(("c", "v", "n"), F.col("l_suppkey")))
    form = F.col("l_linenumber")
    symbol = (
        F.when(form == 1, contract)
        .when(form == 2, F.lower(contract))
        .when(form == 3, F.concat(roll, F.lit(".0")))
        .when(form == 4, F.concat(F.lower(root), F.lit(".c.1")))
        .when(
            form == 5,
            F.concat(root, _pick((".FUT", ".OPT", ".SPOT"), F.col("l_suppkey"))),
        )
        .when(form == 6, F.concat(root, letter, F.substring(year, 1, 1)))
        .otherwise(F.when(F.col("l_suppkey") % 2 == 0, F.lower(root)).otherwise(root))
    )
    return table(spark, sf_dir, "lineitem").select(
        symbol.alias("symbol"), F.col("l_quantity").cast("bigint").alias("volume")
    )
