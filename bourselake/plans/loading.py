"""The load job: from requests to a lake, a catalog and a presence table that agree.

Each step reads stored tables and writes whole ones. A load goes in waves of months, and a
wave is recorded before the next one starts: a job that broke off loads only the waves that
are left when it is run again. The catalog records a partition only after its rows are in
the lake, and a journal lists the waves done.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.functions import daymask, symbols
from bourselake.operators import catalog as entries
from bourselake.operators import coverage, intervals, quality
from bourselake.operators.coverage import KEY
from bourselake.plans import updates
from bourselake.session import path_exists, staged, staging
from bourselake.sources import catalog_store, lake

RANGE = [*KEY, "range_start", "range_end"]
RANGE_KIND = "dataset string, symbol string, schema_ string, range_start date, range_end date"
ISSUE_KIND = (
    "dataset string, symbol string, schema_ string, issue_date date, issue_type string, "
    "message string, arrival bigint"
)
JOURNAL_KIND = (
    "wave int, first_month int, last_month int, n_partitions bigint, n_rows bigint, "
    "updated_at timestamp"
)
KNOWN_KIND = (
    "dataset string, symbol string, schema_ string, bucket int, full_mask bigint, "
    f"parts {coverage.PARTS}"
)
PRESENT_KIND = "dataset string, symbol string, schema_ string, bucket int, slot_mask bigint"


class Store:
    """A lake with its catalog and its presence table, below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.lake, self.catalog, self.masks, self.presence, self.issue_table, self.log = (
            f"{root}/{part}"
            for part in ("lake", "catalog", "masks", "presence", "issues", "journal")
        )

    def recorded(self) -> DataFrame:
        return self._table(self.catalog, RANGE_KIND).select(*RANGE)

    def known(self) -> DataFrame:
        """The recorded days as masks, kept beside the ranges: what status and gaps read."""
        return self._table(self.masks, KNOWN_KIND)

    def present(self) -> DataFrame:
        return self._table(self.presence, PRESENT_KIND)

    def issues(self) -> DataFrame:
        """Quality issues by key and date."""
        return self._table(self.issue_table, ISSUE_KIND)

    def journal(self) -> DataFrame:
        """The waves that load jobs have done, in order of ``updated_at`` and number."""
        if path_exists(self.spark, self.log):
            return self.spark.read.schema(JOURNAL_KIND).parquet(self.log)
        return self.spark.createDataFrame([], JOURNAL_KIND)

    def merge_notices(self, notices: DataFrame) -> None:
        """Keep the issues that notices (keys, arrival, text) name; stored ones stay."""
        found = quality.extract_issues(notices)
        merged = staged(self.spark, quality.merge_issues(self.issues(), found), "issues")
        catalog_store.save_catalog(self.spark, merged, self.issue_table)

    def _table(self, path: str, kind: str) -> DataFrame:
        if path_exists(self.spark, path):
            return catalog_store.load_catalog(self.spark, path)
        return self.spark.createDataFrame([], kind)

    def save(
        self,
        ranges: DataFrame,
        present: DataFrame,
        updated_at: datetime,
        known: DataFrame | None = None,
    ) -> None:
        """Write the next version of the tables; masks are made of the ranges if not given."""
        masks = coverage.recorded_buckets(ranges) if known is None else known
        for rows, path in self._stored_forms(ranges, present, masks, updated_at):
            catalog_store.save_catalog(self.spark, rows, path)

    def _stored_forms(
        self, ranges: DataFrame, present: DataFrame, known: DataFrame, updated_at: datetime
    ) -> list[tuple[DataFrame, str]]:
        bucket = F.col("bucket").cast("int").alias("bucket")
        listed = ranges.select(
            *RANGE,
            symbols.symbol_type(F.col("symbol")).alias("stype"),
            F.lit(updated_at).alias("updated_at"),
        )
        return [
            (known.select(*KEY, bucket, "full_mask", "parts"), self.masks),
            (listed, self.catalog),
            (present.select(*KEY, bucket, "slot_mask"), self.presence),
        ]

    def save_keys(
        self,
        touched: DataFrame,
        ranges: DataFrame,
        present: DataFrame,
        known: DataFrame,
        updated_at: datetime,
    ) -> None:
        """Replace what is stored of the touched keys; no other key is written.

        The tables must be staged, since they are read after the first of them is stored.
        """
        for rows, path in self._stored_forms(ranges, present, known, updated_at):
            catalog_store.append_changes(self.spark, rows, touched, path, KEY)

    def rows(self) -> DataFrame:
        return lake.read_lake(self.spark, self.lake)


def start_store(
    spark: SparkSession, root: str, rows: DataFrame, ranges: DataFrame, updated_at: datetime
) -> Store:
    """A store with these rows and recorded ranges; presence is read off the rows."""
    store = Store(spark, root)
    lake.write_partitions(lake.with_partitions(rows), store.lake)
    store.save(ranges, coverage.present_partitions(rows), updated_at)
    return store


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _month_no() -> Column:
    return (F.col("year") * 12 + F.col("month") - 1).cast("int").alias("month_no")


def _record(store: Store, loaded: DataFrame, known: DataFrame, updated_at: datetime) -> None:
    """Add loaded partitions to the presence table and known days to the recorded ranges."""
    spark = store.spark
    with staging(spark) as stage:
        touched = stage(known.select(*KEY).unionByName(loaded.select(*KEY)).distinct(), "touched")
        runs = intervals.month_runs(known, KEY)
        ranges = intervals.merge_ranges(_of_keys(store.recorded(), touched).unionByName(runs), KEY)
        masks = coverage.merge_recorded(
            _of_keys(store.known(), touched), coverage.recorded_buckets(runs)
        )
        day = F.make_date("year", "month", F.greatest(F.col("day"), F.lit(1)))
        added = coverage.present_partitions(loaded.select(*KEY, day.alias("trade_date")))
        merged = coverage.merge_present(
            _of_keys(store.present(), touched),
            added.withColumn("bucket", F.col("bucket").cast("int")),
        )
        store.save_keys(
            touched, stage(ranges, "ranges"), stage(merged, "present"), stage(masks, "masks"), updated_at
        )


def _of_keys(rows: DataFrame, touched: DataFrame) -> DataFrame:
    return rows.join(touched, KEY, "left_semi")


def record_delivery(store: Store, rows: DataFrame, updated_at: datetime) -> None:
    """Record partitions that ``rows`` have replaced whole, with nothing known of them before.

    Of tick schemas the delivered days are known; of others, each month from its first to
    its last delivered day, and no other day of it any more.
    """
    spark = store.spark
    days = intervals.days_to_months(rows, KEY, "trade_date")
    month = F.col("month_no")
    tick = coverage.is_tick(F.col("schema_"))
    span = daymask.span_mask(
        month,
        daymask.date_of(month, daymask.lowest(F.col("day_mask"))),
        daymask.date_of(month, daymask.highest(F.col("day_mask"))),
    )
    with staging(spark) as stage:
        known = stage(
            days.select(*KEY, "month_no", F.when(tick, F.col("day_mask")).otherwise(span).alias("day_mask")),
            "known",
        )
        first = daymask.month_first(month)
        months = known.filter(~tick).select(
            *KEY, first.alias("range_start"), F.last_day(first).alias("range_end")
        )
        touched = stage(rows.select(*KEY).distinct(), "touched")
        stored = _of_keys(store.recorded(), touched)
        left = stage(intervals.subtract_ranges(stored, months, KEY), "left")
        masks = stage(coverage.recorded_buckets(left), "masks")
        present = stage(_of_keys(store.present(), touched), "present")
        parts = rows.groupBy(*lake.LOGICAL_PARTITION).agg(F.count("*").alias("n_rows"))
        parts = stage(parts, "parts")
        store.save_keys(touched, left, present, masks, updated_at)
        _record(store, parts, known, updated_at)


def _load_wave(
    store: Store, days: DataFrame, landing: DataFrame, updated_at: datetime
) -> DataFrame:
    """Load a day set and record what has arrived; returns the row counts by partition."""
    loaded = lake.load_days(landing, store.lake, days)
    if loaded.isEmpty():
        return loaded
    tick = coverage.is_tick(F.col("schema_"))
    bit = _bit(F.greatest(F.col("day") - 1, F.lit(0)))
    arrived = loaded.groupBy(*KEY, _month_no()).agg(F.bit_or(bit).alias("_bits"))
    # Of a month that got rows the whole loaded window is known; of ticks each session.
    mask = F.when(tick, F.col("day_mask").bitwiseAND(F.col("_bits"))).otherwise(F.col("day_mask"))
    known = days.join(arrived, [*KEY, "month_no"]).select(*KEY, "month_no", mask.alias("day_mask"))
    _record(store, loaded, known, updated_at)
    return loaded


def _waves(days: DataFrame, waves: int) -> list[tuple[int, int]]:
    """First and last month of each wave; a row per month is read.

    A month is not cut. Of more months than waves, waves are about equal in days.
    """
    months = days.groupBy("month_no").agg(F.sum(F.bit_count("day_mask")).alias("n"))
    rows = sorted((r["month_no"], r["n"]) for r in months.collect())
    total, so_far, cut = sum(n for _, n in rows), 0, []
    for place, (month, n) in enumerate(rows):
        wave = place if len(rows) <= waves else min(waves - 1, so_far * waves // total)
        so_far += n
        if cut and cut[-1][0] == wave:
            cut[-1] = (wave, cut[-1][1], month)
        else:
            cut.append((wave, month, month))
    return [(first, last) for _, first, last in cut]


def load_job(
    store: Store,
    requests: DataFrame,
    landing: DataFrame,
    calendar: DataFrame,
    updated_at: datetime,
    waves: int = 1,
    notices: DataFrame | None = None,
) -> DataFrame:
    """Load what the requests lack, and nothing else; safe to run again.

    Gaps come from catalog and presence together. A monthly partition is loaded from its
    first to its last missing or recorded day, since it is replaced whole; of tick
    schemas the missing sessions are loaded. Partitions for which nothing has landed
    stay unrecorded. The months are loaded in waves, each recorded before the next. Quality
    ``notices`` of the requested keys (keys, arrival, text) become issues before the rows
    they warn of. Returns the loaded row counts by partition.
    """
    spark = store.spark
    if notices is not None:
        asked = requests.select(*KEY).distinct()
        store.merge_notices(notices.join(asked, KEY, "left_semi"))
    days = staged(
        spark,
        coverage.days_to_load(requests, store.known(), store.present(), calendar),
        "to-load",
    )
    done = None
    for wave, (first, last) in enumerate(_waves(days, waves)):
        part = days.filter(F.col("month_no").between(first, last))
        loaded = _load_wave(store, part, landing, updated_at)
        n, rows = loaded.agg(F.count("*"), F.sum("n_rows")).first()
        entry = [(wave, first, last, n, rows or 0, updated_at)]
        spark.createDataFrame(entry, JOURNAL_KIND).coalesce(1).write.mode("append").parquet(store.log)
        done = loaded if done is None else done.unionByName(loaded)
    if done is None:
        return lake.load_days(landing, store.lake, days)
    return done


def ensure(
    store: Store,
    requests: DataFrame,
    landing: DataFrame,
    calendar: DataFrame,
    updated_at: datetime,
    waves: int = 1,
) -> DataFrame:
    """Load what the requests lack, then serve the rows of those that are complete."""
    with staging(store.spark) as stage:
        asked = stage(requests.select(*RANGE).distinct(), "asked")
        load_job(store, asked, landing, calendar, updated_at, waves)
        status = coverage.coverage_status(asked, store.known(), store.present(), calendar)
        served = staged(store.spark, status.filter("status = 'COMPLETE'").select(*RANGE), "served")
    if not lake.has_rows(store.spark, store.lake):
        return landing.limit(0)
    return lake.rows_in_windows(store.rows(), served)


def clear(store: Store, windows: DataFrame, updated_at: datetime) -> DataFrame:
    """Delete windows from the lake, the recorded ranges and the presence table alike."""
    spark = store.spark
    windows = staged(spark, windows.select(*RANGE), "windows")
    deleted = lake.delete_windows(spark, store.lake, windows)
    ranges = intervals.subtract_ranges(store.recorded(), windows, KEY)
    # Only months that lost rows can have lost their partition.
    touched = staged(spark, deleted.select(*KEY, "year", "month").distinct(), "touched")
    left = store.rows().join(touched, [*KEY, "year", "month"], "left_semi")
    slots = F.when(
        coverage.is_tick(F.col("schema_")),
        F.lit(daymask.ALL_DAYS).cast("bigint"),
    ).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("month") - 1))
    bucket = F.when(
        coverage.is_tick(F.col("schema_")), F.col("year") * 12 + F.col("month") - 1
    ).otherwise(F.col("year"))
    gone = touched.groupBy(*KEY, bucket.cast("int").alias("bucket")).agg(
        F.bit_or(slots).alias("_gone")
    )
    none = F.lit(0).cast("bigint")
    cut = store.present().join(gone, [*KEY, "bucket"], "left").select(
        *KEY, "bucket", daymask.minus(F.col("slot_mask"), F.coalesce("_gone", none)).alias("slot_mask")
    )
    again = coverage.present_partitions(left).withColumn("bucket", F.col("bucket").cast("int"))
    present = coverage.merge_present(cut, again).filter("slot_mask <> 0")
    store.save(staged(spark, ranges, "ranges"), staged(spark, present, "present"), updated_at)
    return deleted


def verify_and_fix(store: Store, calendar: DataFrame, updated_at: datetime) -> DataFrame:
    """Drop recorded ranges whose partitions are not all there; returns those ranges."""
    stale = staged(
        store.spark,
        entries.verify_catalog(store.recorded(), store.present(), calendar),
        "stale",
    )
    left = entries.drop_stale(store.recorded(), stale)
    store.save(staged(store.spark, left, "ranges"), store.present(), updated_at)
    return stale


def update_all(
    store: Store,
    plan: DataFrame,
    landing: DataFrame,
    calendar: DataFrame,
    updated_at: datetime,
) -> DataFrame:
    """Run an update plan; the outcome of each key is taken from what was loaded.

    updated: rows arrived; error: due, but nothing arrived; up_to_date: not due.
    """
    plan = staged(store.spark, plan, "plan")
    due = plan.filter(F.col("state") == "due").select(*RANGE)
    loaded = load_job(store, due, landing, calendar, updated_at)
    counts = loaded.groupBy(*KEY).agg(F.sum("n_rows").alias("n_rows"))
    return plan.join(counts, KEY, "left").select(
        *KEY,
        F.when(F.col("state") != "due", F.col("state"))
        .when(F.col("n_rows") > 0, "updated")
        .otherwise("error")
        .alias("outcome"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )


def roll_all(
    store: Store,
    contracts: DataFrame,
    landing: DataFrame,
    calendar: DataFrame,
    as_of: date,
    updated_at: datetime,
) -> DataFrame:
    """Load the successors of expired contracts that are held whole, in the same schemas.

    rolled: rows of the successor arrived; error: it is due, but nothing arrived. A roll is
    planned once: a successor that is recorded is not planned again, and one that got
    nothing is.
    """
    spark = store.spark
    plan = updates.auto_roll_plan(store.recorded(), contracts, as_of, ["dataset"])
    wanted = staged(
        spark,
        plan.select("dataset", "symbol", F.explode("schemas").alias("schema_"), "range_start", "range_end"),
        "rolls",
    )
    loaded = load_job(store, wanted, landing, calendar, updated_at)
    counts = loaded.groupBy(*KEY).agg(F.sum("n_rows").alias("n_rows"))
    return wanted.join(counts, KEY, "left").select(
        *RANGE,
        F.when(F.col("n_rows") > 0, "rolled").otherwise("error").alias("outcome"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )
