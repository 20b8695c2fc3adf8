"""Reading and writing the partitioned lake.

A lake is Parquet partitioned by dataset, schema_, year, month, day (day 0 for monthly
schemas) and symbol_bucket, a hash of the symbol: one symbol's load, deletion or read opens
one bucket of its days, not all symbols of them. How many buckets a lake has is kept as the
name of a marker file and never changes. Rows carry symbol, ts_event_ns, trade_date and
their payload; readers do not see the bucket.

Writes rebalance by partition: adaptive execution then splits a partition that holds a large
share of the rows over many tasks and files, and packs small ones.

A write that keeps rows of a folder reads and writes that folder in one job. Dynamic
overwrite allows that: tasks write aside, and folders are exchanged when all are done.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourselake.functions import daymask, eventtime
from bourselake.operators import coverage, intervals
from bourselake.operators.coverage import KEY, PARTITION
from bourselake.session import staged, staging

FOLDERS = ["dataset", "schema_", *PARTITION]
LOGICAL_PARTITION = [*KEY, *PARTITION]
BUCKET = "symbol_bucket"
STORED = [*FOLDERS, BUCKET]
#: Symbol buckets of a lake that was not created with another number.
BUCKETS = 4
MARKER = "_symbol_buckets-"
# Row groups small enough to be skipped inside a large file, which is sorted by symbol. What
# bounds cannot rule out, the symbol dictionary does, or a Bloom filter where a row group
# has too many symbols for a dictionary (none is written for the others).
LOOK_UPS = {
    "parquet.block.size": str(16 << 20),
    "parquet.bloom.filter.enabled#symbol": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def with_partitions(rows: DataFrame) -> DataFrame:
    """Add year, month and day of the partition each row belongs to."""
    year, month, day = coverage.partition_columns(F.col("schema_"), F.col("trade_date"))
    return rows.select("*", year, month, day)


def _files(spark: SparkSession, path: str):
    """Hadoop's path class, the path and its file system."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = kind(path)
    return kind, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bucket_count(spark: SparkSession, path: str) -> int:
    """Symbol buckets of the lake; a lake that does not exist yet gets its marker."""
    kind, root, files = _files(spark, path)
    found = files.globStatus(kind(root, f"{MARKER}*"))
    if found:
        return int(found[0].getPath().getName().removeprefix(MARKER))
    files.mkdirs(root)
    files.createNewFile(kind(root, f"{MARKER}{BUCKETS}"))
    return BUCKETS


def create(spark: SparkSession, path: str, buckets: int) -> None:
    """Begin a lake with this many symbol buckets; a lake of many symbols wants more."""
    kind, root, files = _files(spark, path)
    if files.exists(root):
        raise ValueError(f"{path} exists already")
    files.mkdirs(root)
    files.createNewFile(kind(root, f"{MARKER}{buckets}"))


def symbol_bucket(symbol: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int").alias(BUCKET)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether the lake has any partition; all may have been deleted."""
    kind, root, files = _files(spark, path)
    return bool(files.globStatus(kind(root, "dataset=*")))


def _overwrite_folders(rows: DataFrame, path: str) -> None:
    """Replace the folders present in ``rows``, with all the symbols they hold."""
    (
        rows.hint("rebalance", *STORED)
        .sortWithinPartitions(*STORED, "symbol", "ts_event_ns")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**LOOK_UPS)
        .partitionBy(*STORED)
        .parquet(path)
    )


def _folder_bounds(folders: DataFrame) -> Column | None:
    """Literal bounds on partition columns that hold for all given folders; one row is read."""
    day = F.make_date("year", "month", F.greatest("day", F.lit(1)))
    first, last, buckets = folders.agg(F.min(day), F.max(day), F.collect_set(BUCKET)).first()
    if first is None:
        return None
    return _in_partition_window(first, last) & F.col(BUCKET).isin(*buckets)


def write_partitions(rows: DataFrame, path: str, stored: bool = False) -> None:
    """Replace exactly the logical partitions in ``rows``, key and day or month.

    Other symbols in the same folders are carried over, so loading one symbol never loses
    another; only folders of its bucket are read and written. The path may not exist yet.
    Rows are stored once before anything is overwritten, so that their partitions and their
    contents agree; ``stored`` says that they come from a stored table already.
    """
    spark = rows.sparkSession
    buckets = bucket_count(spark, path)
    with staging(spark) as stage:
        fresh = rows if stored else stage(rows, "fresh")
        fresh = fresh.withColumn(BUCKET, symbol_bucket(F.col("symbol"), buckets))
        if has_rows(spark, path):
            replaced = fresh.select(*LOGICAL_PARTITION, BUCKET).distinct()
            bounds = _folder_bounds(replaced)
            if bounds is None:
                return
            carried = (
                _read_stored(spark, path)
                .filter(bounds)
                .join(replaced.select(*STORED).distinct(), STORED, "left_semi")
                .join(replaced.drop(BUCKET), LOGICAL_PARTITION, "left_anti")
            )
            fresh = fresh.unionByName(carried, allowMissingColumns=True)
        _overwrite_folders(fresh, path)


def _read_stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the lake; nanosecond timestamps are read as integers."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return spark.read.parquet(path)


def _in_partition_window(start: date | None, end: date | None) -> Column:
    """Predicate on partition columns only, so folders outside are never opened."""
    year_month = F.col("year") * 100 + F.col("month")
    monthly = F.col("day") == 0
    full = year_month * 100 + F.col("day")
    keep = F.lit(True)
    if start is not None:
        first = start.year * 100 + start.month
        keep = keep & (F.col("year") >= start.year) & (year_month >= first)
        keep = keep & (monthly | (full >= first * 100 + start.day))
    if end is not None:
        last = end.year * 100 + end.month
        keep = keep & (F.col("year") <= end.year) & (year_month <= last)
        keep = keep & (monthly | (full <= last * 100 + end.day))
    return keep


def read_lake(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    merge_schema: bool = False,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Rows of the inclusive date window; prunes partitions, then filters rows.

    With ``symbols`` only their buckets are opened; files are sorted by symbol, so that the
    scan skips the row groups of others.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    rows = spark.read.option("mergeSchema", merge_schema).parquet(path)
    rows = rows.filter(_in_partition_window(start, end))
    if symbols is not None and BUCKET in rows.columns:
        n = bucket_count(spark, path)
        named = spark.createDataFrame([(s,) for s in symbols], "symbol string")
        wanted = named.select(symbol_bucket(F.col("symbol"), n)).distinct().collect()
        rows = rows.filter(F.col(BUCKET).isin(*[r[0] for r in wanted]))
    if symbols is not None:
        rows = rows.filter(F.col("symbol").isin(*symbols))
    return date_window(rows.drop(BUCKET), start, end)


def read_files(
    spark: SparkSession,
    paths: list[str],
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Rows of the given Parquet files in the window; no files, an empty frame."""
    if not paths:
        return spark.createDataFrame([], StructType([]))
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    rows = spark.read.option("mergeSchema", True).parquet(*sorted(paths))
    return date_window(rows, start, end)


def date_window(
    rows: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Filter any table with event time; one without passes through unchanged."""
    keep = None
    if "ts_event_ns" in rows.columns:
        nanos = F.col("ts_event_ns")
        if start is not None:
            keep = nanos >= eventtime.day_start_nanos(start)
        if end is not None:
            after = eventtime.day_start_nanos(end) + eventtime.NANOS_PER_DAY
            keep = nanos < after if keep is None else keep & (nanos < after)
    else:
        keep = eventtime.window_predicate(rows, start, end)
    return rows if keep is None else rows.filter(keep)


def normalise(rows: DataFrame) -> DataFrame:
    """Add ts_event_ns and trade_date to rows with any kind of event time."""
    name = eventtime.event_time_column(rows)
    if name is None:
        raise ValueError("rows have no event-time column (ts_event or ts)")
    return rows.select(
        *[c for c in rows.columns if c not in ("ts_event_ns", "trade_date")],
        eventtime.event_nanos(rows).alias("ts_event_ns"),
        eventtime.event_date(rows).alias("trade_date"),
    )


def load_window(
    landing: DataFrame, path: str, start: date | None = None, end: date | None = None
) -> None:
    """Load an inclusive window of landing rows, replacing whole partitions.

    The window should cover whole partitions: a partition of the same key keeps no
    row that is not in the window. Other keys are not touched.
    """
    write_partitions(with_partitions(date_window(landing, start, end)), path)


def partition_row_counts(rows: DataFrame) -> DataFrame:
    """Rows per folder partition; a partition without rows does not appear."""
    return rows.groupBy(*FOLDERS).agg(F.count("*").alias("n_rows"))


def _wanted_days(partitions: DataFrame) -> DataFrame:
    """Day masks of logical partitions; a monthly partition is all its days."""
    day = F.col("day")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), day - 1)
    every = F.lit(daymask.ALL_DAYS).cast("bigint")
    return partitions.groupBy(
        *KEY, (F.col("year") * 12 + F.col("month") - 1).cast("int").alias("month_no")
    ).agg(F.bit_or(F.when(day > 0, bit).otherwise(every)).alias("day_mask"))


def _mark(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows with a flag ``_hit``: is the row's date in its key's day set?

    ``days`` holds one row per key and month, so no row is doubled.
    """
    bit = F.dayofmonth("trade_date") - 1
    mask = F.coalesce("day_mask", F.lit(0).cast("bigint"))
    return (
        rows.withColumn("month_no", daymask.month_no(F.col("trade_date")))
        .join(days, [*KEY, "month_no"], "left")
        .withColumn("_hit", F.getbit(mask, bit) == 1)
        .drop("month_no", "day_mask")
    )


def _span(days: DataFrame) -> tuple[date | None, date | None]:
    """First and last day of the months a stored day set spans; one row is read."""
    first = daymask.month_first(F.min("month_no"))
    last = F.last_day(daymask.month_first(F.max("month_no")))
    return tuple(days.agg(first, last).first())


def rows_in_windows(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows whose date lies in a (key, range_start, range_end) window, once each.

    The windows' outer bounds go to the scan; rows without a window of their key and
    month drop out in the join, and the planner broadcasts the day sets if they are small.
    """
    days = staged(rows.sparkSession, intervals.ranges_to_months(windows, KEY), "days")
    start, end = _span(days)
    if start is None:
        return rows.limit(0)
    return _only_days(date_window(rows, start, end), days)


def _only_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    bit = F.dayofmonth("trade_date") - 1
    return (
        rows.withColumn("month_no", daymask.month_no(F.col("trade_date")))
        .join(days, [*KEY, "month_no"])
        .filter(F.getbit("day_mask", bit) == 1)
        .select(*rows.columns)
    )


def load_days(landing: DataFrame, path: str, days: DataFrame) -> DataFrame:
    """Load the landing rows of a (key, month_no, day_mask) day set.

    Their logical partitions are replaced. Returns the loaded counts by partition; a
    partition without rows is not there and leaves no trace in the lake.
    """
    spark = landing.sparkSession
    days = staged(spark, days, "days")
    start, end = _span(days)
    wanted = landing.limit(0) if start is None else _only_days(date_window(landing, start, end), days)
    with staging(spark) as stage:
        fresh = stage(with_partitions(wanted), "fresh")
        counts = fresh.groupBy(*LOGICAL_PARTITION).agg(F.count("*").alias("n_rows"))
        counts = staged(spark, counts, "loaded")
        if not fresh.isEmpty():
            write_partitions(fresh, path, stored=True)
    return counts


def load_missing(
    spark: SparkSession, landing: DataFrame, path: str, missing: DataFrame
) -> DataFrame:
    """Load only the missing logical partitions; running it twice changes nothing.

    ``missing`` lists (dataset, symbol, schema_, year, month, day). The lake need not
    exist yet. Returns the loaded counts.
    """
    return load_days(landing, path, _wanted_days(missing))


def delete_windows(spark: SparkSession, path: str, windows: DataFrame) -> DataFrame:
    """Delete the rows of (key, range_start, range_end) windows from the lake.

    Rows outside the windows survive, also within a monthly partition. Folders
    left without rows are dropped. Returns the deleted logical partitions.
    """
    n = bucket_count(spark, path)
    nothing = "dataset string, symbol string, schema_ string, year int, month int, day int, n_rows bigint"
    with staging(spark) as stage:
        days = stage(intervals.ranges_to_months(windows, KEY), "days")
        start, end = _span(days)
        if start is None or not has_rows(spark, path):
            return spark.createDataFrame([], nothing)
        asked = days.select("dataset", "schema_", symbol_bucket(F.col("symbol"), n), "month_no")
        buckets = [r[0] for r in asked.select(BUCKET).distinct().collect()]
        lake = _read_stored(spark, path).filter(_in_partition_window(start, end))
        marked = _mark(lake.filter(F.col(BUCKET).isin(*buckets)), days)
        per_part = marked.groupBy(*LOGICAL_PARTITION, BUCKET).agg(
            F.count("*").alias("n"), F.count_if("_hit").alias("n_rows")
        )
        counts = stage(per_part, "counts")
        deleted = staged(
            spark, counts.filter("n_rows > 0").select(*LOGICAL_PARTITION, "n_rows"), "deleted"
        )
        folders = counts.groupBy(*STORED).agg(F.sum("n").alias("n"), F.sum("n_rows").alias("gone"))
        touched = stage(folders.filter("gone > 0"), "touched")
        kept_in = touched.filter("n > gone").select(*STORED)
        bounds = _folder_bounds(kept_in)
        if bounds is not None:
            survivors = _mark(lake.filter(bounds).join(kept_in, STORED, "left_semi"), days)
            _overwrite_folders(survivors.filter("not _hit").select(*lake.columns), path)
        # A dynamic overwrite leaves a partition it gets no rows for as it was.
        _drop_folders(spark, path, touched.filter("n = gone"))
    return deleted


def _drop_folders(spark: SparkSession, path: str, partitions: DataFrame) -> None:
    """Remove partition folders, streaming their names to the driver.

    The names are metadata: at most datasets x schemas x days x buckets of the windows.
    """
    kind, root, files = _files(spark, path)
    for row in partitions.select(*STORED).toLocalIterator():
        name = "/".join(f"{c}={row[c]}" for c in STORED)
        files.delete(kind(root, name), True)
        above = kind(root, name).getParent()
        # Folders above a deleted one go with the last one below them.
        while not above.equals(root) and not files.listStatus(above):
            files.delete(above, False)
            above = above.getParent()
