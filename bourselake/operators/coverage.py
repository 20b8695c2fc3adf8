"""Which partitions a request needs, which exist, and what is missing.

A request is (dataset, symbol, schema_, range_start, range_end). Tick schemas
have one partition per session, other schemas one per month. Partitions are
slots in buckets: days in a month for tick schemas, months in a year for the
others, one bit each. Requests are split into buckets and meet the lake's masks
on (key, bucket); partitions are listed only where a list is asked for, counts
come from ``bit_count``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourselake.functions import daymask
from bourselake.functions.vocab import TICK_SCHEMAS
from bourselake.operators import calendars, intervals
from bourselake.session import spread

KEY = ["dataset", "symbol", "schema_"]
REQUEST = [*KEY, "range_start", "range_end"]
PARTITION = ["year", "month", "day"]
PARTS = "array<struct<month_no:int,day_mask:bigint>>"
RUNS = "array<struct<gap_start:date,gap_end:date>>"


def is_tick(schema: Column) -> Column:
    return schema.isin(*TICK_SCHEMAS)


def partition_columns(schema: Column, day: Column) -> list[Column]:
    """year, month, day of the partition; day is 0 for monthly schemas."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.when(is_tick(schema), F.dayofmonth(day)).otherwise(0).alias("day"),
    ]


def partition_label() -> Column:
    """YYYY-MM-DD for daily partitions, YYYY-MM for monthly ones."""
    first = F.make_date("year", "month", F.greatest("day", F.lit(1)))
    return F.when(F.col("day") > 0, F.date_format(first, "yyyy-MM-dd")).otherwise(
        F.date_format(first, "yyyy-MM")
    )


def _bucket(day: Column) -> Column:
    return F.when(is_tick(F.col("schema_")), daymask.month_no(day)).otherwise(
        F.year(day)
    )


def present_partitions(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Partitions with rows as (keys, bucket, slot_mask); combined map-side."""
    day = F.col("trade_date")
    slot = F.when(is_tick(F.col("schema_")), daymask.day_bit(day)).otherwise(
        daymask.month_bit(day)
    )
    return rows.groupBy(*keys, _bucket(day).alias("bucket")).agg(
        F.bit_or(slot).alias("slot_mask")
    )


def merge_present(
    stored: DataFrame, added: DataFrame, keys: list[str] = KEY
) -> DataFrame:
    """Add the partitions of newly loaded rows to a stored presence table."""
    return (
        stored.unionByName(added)
        .groupBy(*keys, "bucket")
        .agg(F.bit_or("slot_mask").alias("slot_mask"))
    )


def _request_buckets(
    requests: DataFrame, calendar: DataFrame, keys: list[str]
) -> DataFrame:
    """Requests split into buckets, with window and expected masks."""
    start, end = F.col("range_start"), F.col("range_end")
    asked = requests.select(*keys, "range_start", "range_end").distinct()
    split = asked.filter(start <= end).withColumn(
        "bucket", F.explode(F.sequence(_bucket(start), _bucket(end)))
    )
    return _with_masks(split.withColumn("_calendar", _tick_calendar()), calendar)


def _tick_calendar() -> Column:
    """Calendar whose sessions a tick schema has; null for other schemas."""
    return F.when(is_tick(F.col("schema_")), calendars.calendar_of(F.col("dataset")))


def _with_masks(split: DataFrame, calendar: DataFrame) -> DataFrame:
    """Window and expected masks of buckets; ``_calendar`` (null: monthly) goes."""
    start, end = F.col("range_start"), F.col("range_end")
    sessions = calendars.session_months(calendar).select(
        F.col("calendar").alias("_calendar"),
        F.col("month_no").alias("bucket"),
        "session_mask",
    )
    bucket = F.col("bucket")
    window = F.when(
        F.col("_calendar").isNotNull(), daymask.span_mask(bucket, start, end)
    ).otherwise(daymask.month_span_mask(bucket, start, end))
    every = F.lit(daymask.ALL_DAYS).cast("bigint")
    return split.join(F.broadcast(sessions), ["_calendar", "bucket"], "left").select(
        *[c for c in split.columns if c != "_calendar"],
        window.alias("window_mask"),
        window.bitwiseAND(F.coalesce("session_mask", every)).alias("expected_mask"),
    )


def _with_present(
    buckets: DataFrame, present: DataFrame, keys: list[str]
) -> DataFrame:
    seen = F.coalesce("slot_mask", F.lit(0).cast("bigint"))
    return buckets.join(present, [*keys, "bucket"], "left").select(
        *buckets.columns,
        seen.bitwiseAND(F.col("window_mask")).alias("present_mask"),
    )


def _list_partitions(buckets: DataFrame, mask: Column) -> DataFrame:
    """One row per set bit, with the partition's dates clamped to the request."""
    tick = is_tick(F.col("schema_"))
    first = daymask.month_first(
        F.when(tick, F.col("bucket")).otherwise(F.col("bucket") * 12 + F.col("_slot") - 1)
    )
    date = F.date_add(first, F.col("_slot") - 1)
    return buckets.withColumn("_slot", F.explode(daymask.days_in(mask))).select(
        *REQUEST,
        F.year(first).alias("year"),
        F.month(first).alias("month"),
        F.when(tick, F.col("_slot")).otherwise(0).alias("day"),
        F.when(tick, date)
        .otherwise(F.greatest(first, "range_start"))
        .alias("part_start"),
        F.when(tick, date)
        .otherwise(F.least(F.last_day(first), "range_end"))
        .alias("part_end"),
    )


def expected_partitions(requests: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions for tick schemas, months clamped to the request otherwise."""
    buckets = _request_buckets(requests, calendar, KEY)
    return _list_partitions(buckets, F.col("expected_mask"))


def missing_partitions(
    requests: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Expected partitions that have no rows."""
    buckets = _with_present(_request_buckets(requests, calendar, KEY), present, KEY)
    gap = daymask.minus(F.col("expected_mask"), F.col("present_mask"))
    return _list_partitions(buckets, gap)


def cached_partitions(
    requests: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Partitions with rows inside each request's window, sessions or not."""
    buckets = _with_present(_request_buckets(requests, calendar, KEY), present, KEY)
    return _list_partitions(buckets, F.col("present_mask"))


def recorded_buckets(ranges: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Recorded days as masks: (keys, bucket, full_mask, parts), to be stored with the ranges.

    Of tick schemas a bucket is a month and ``full_mask`` its recorded days. Of others it is
    a year: ``full_mask`` has the months recorded whole, ``parts`` the days of the others
    (month_no, day_mask). Ranges may overlap; there is no window over them, and one shuffle.
    """
    first = daymask.month_first(F.col("month_no"))
    whole = daymask.span_mask(F.col("month_no"), first, F.last_day(first))
    tick, day_mask = is_tick(F.col("schema_")), F.col("day_mask")
    bucket = F.when(tick, F.col("month_no")).otherwise(F.year(first)).alias("bucket")
    days = (
        intervals.split_months(ranges.select(*keys, "range_start", "range_end"), keys)
        .select(*keys, bucket, "month_no", "day_mask")
        .repartition(*keys, "bucket")
        .groupBy(*keys, "bucket", "month_no")
        .agg(F.bit_or("day_mask").alias("day_mask"))
    )
    full = F.when(tick, day_mask).when(day_mask == whole, daymask.month_bit(first))
    part = F.when(~tick & (day_mask != whole), F.struct("month_no", "day_mask"))
    none = F.lit(0).cast("bigint")
    return days.groupBy(*keys, "bucket").agg(
        F.coalesce(F.bit_or(full), none).alias("full_mask"), F.collect_list(part).alias("parts")
    )


def merge_recorded(stored: DataFrame, added: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Masks of both tables; a month that two parts complete stays in parts and counts."""
    return (
        stored.unionByName(added)
        .groupBy(*keys, "bucket")
        .agg(F.bit_or("full_mask").alias("full_mask"), F.flatten(F.collect_list("parts")).alias("parts"))
    )


def _request_slots(
    requests: DataFrame,
    recorded: DataFrame | None,
    present: DataFrame,
    calendar: DataFrame,
    keys: list[str],
    verify_files: bool = True,
) -> DataFrame:
    """Per request and bucket the expected slots and those that are cached.

    A partition is cached if every requested day of it is recorded and, with
    ``verify_files``, it has rows. ``recorded`` holds ranges or the masks that
    ``recorded_buckets`` makes of them; without it all days count as recorded. Requests,
    records and presence meet on (key, bucket), each shuffled once.
    """
    buckets = _request_buckets(requests, calendar, keys)
    none = F.lit(0).cast("bigint")
    seen = F.coalesce("slot_mask", none)
    ok = seen if verify_files else F.col("expected_mask")
    joined = buckets.join(present.select(*keys, "bucket", "slot_mask"), [*keys, "bucket"], "left")
    parts = F.lit(None).cast(PARTS)
    if recorded is not None:
        masks = recorded if "full_mask" in recorded.columns else recorded_buckets(recorded, keys)
        joined = joined.join(masks, [*keys, "bucket"], "left")
        parts = F.coalesce("parts", F.array().cast(PARTS))
        ok = ok.bitwiseAND(_recorded_slots(parts))
    known = F.coalesce("full_mask", none) if recorded is not None else F.col("expected_mask")
    return joined.select(
        *buckets.columns,
        F.col("expected_mask").bitwiseAND(ok).alias("cached_mask"),
        seen.alias("_seen"),
        known.alias("_full"),
        parts.alias("_parts"),
    )


def _recorded_slots(parts: Column) -> Column:
    """Slots of a request's bucket of which every requested day is recorded."""
    none, tick = F.lit(0).cast("bigint"), is_tick(F.col("schema_"))
    asked = lambda p: daymask.span_mask(p["month_no"], F.col("range_start"), F.col("range_end"))
    covered = F.filter(parts, lambda p: daymask.minus(asked(p), _part_days(parts, p)) == 0)
    # Parts are rare; the loop over them runs where there are any.
    partial = F.when(~tick & (F.size(parts) > 0), _month_bits(covered)).otherwise(none)
    return F.coalesce("full_mask", none).bitwiseOR(partial)


def _month_bits(parts: Column) -> Column:
    bits = F.transform(parts, lambda p: _one_bit(F.pmod(p["month_no"], F.lit(12))))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def _part_days(parts: Column, part: Column) -> Column:
    """All recorded days of the part's month; a merged table may have several parts of it."""
    none = F.lit(0).cast("bigint")
    same = F.filter(parts, lambda p: p["month_no"] == part["month_no"])
    return F.aggregate(same, none, lambda a, p: a.bitwiseOR(p["day_mask"]))


def _one_bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _gap_months(slots: DataFrame, verify_files: bool = True) -> Column:
    """Array of (month_no, day_mask): the days each month of the bucket lacks."""
    tick = is_tick(F.col("schema_"))
    gap = daymask.minus(F.col("expected_mask"), F.col("cached_mask"))
    none, every = (F.lit(n).cast("bigint") for n in (0, daymask.ALL_DAYS))

    def lacking(slot: Column) -> Column:
        month = (F.col("bucket") * 12 + slot - 1).cast("int")
        asked = daymask.span_mask(month, F.col("range_start"), F.col("range_end"))
        same = F.filter("_parts", lambda p: p["month_no"] == month)
        some = F.aggregate(same, none, lambda a, p: a.bitwiseOR(p["day_mask"]))
        known = F.when(F.getbit("_full", slot - 1) == 1, every).otherwise(F.coalesce(some, none))
        if verify_files:
            known = F.when(F.getbit("_seen", slot - 1) == 1, known).otherwise(none)
        return F.struct(month.alias("month_no"), daymask.minus(asked, known).alias("day_mask"))

    days = F.struct(F.col("bucket").cast("int").alias("month_no"), gap.alias("day_mask"))
    return F.when(gap == 0, F.array().cast(PARTS)).when(tick, F.array(days)).otherwise(
        F.transform(daymask.days_in(gap), lacking)
    )


def _gap_runs(slots: DataFrame) -> DataFrame:
    """The slots with ``_runs``: the runs of days a bucket lacks, as (gap_start, gap_end).

    Months without rows or records lack all their requested days, so neighbouring ones are
    one run of the bucket's mask; only months recorded in part are looked at by day.
    """
    start, end, year = F.col("range_start"), F.col("range_end"), F.col("bucket").cast("int")
    none = F.lit(0).cast("bigint")
    some = F.when(F.size("_parts") > 0, _month_bits(F.col("_parts"))).otherwise(none)
    known = F.col("_seen").bitwiseAND(F.col("_full").bitwiseOR(some))

    def run(first: Column, last: Column) -> Column:
        return F.struct(first.alias("gap_start"), last.alias("gap_end"))

    def days(month: Column, mask: Column) -> Column:
        return F.transform(
            daymask.runs_in(mask),
            lambda r: run(daymask.date_of(month, r["first"]), daymask.date_of(month, r["last"])),
        )

    def lacking(slot: Column) -> Column:
        month = year * 12 + slot - 1
        same = F.filter("_parts", lambda p: p["month_no"] == month)
        have = F.aggregate(same, none, lambda a, p: a.bitwiseOR(p["day_mask"]))
        mask = daymask.minus(daymask.span_mask(month, start, end), have)
        return F.struct(month.alias("month_no"), mask.alias("day_mask"))

    whole = F.transform(
        daymask.runs_in(F.col("_whole")),
        lambda r: run(
            F.greatest(F.make_date(year, r["first"], F.lit(1)), start),
            F.least(F.last_day(F.make_date(year, r["last"], F.lit(1))), end),
        ),
    )
    in_part = F.transform(daymask.days_in(F.col("_in_part")), lacking)
    parted = F.flatten(F.transform(in_part, lambda m: days(m["month_no"], m["day_mask"])))
    months = F.when(F.col("_in_part") == 0, whole).otherwise(F.concat(whole, parted))
    runs = (
        F.when(F.col("_gap") == 0, F.array().cast(RUNS))
        .when(is_tick(F.col("schema_")), days(year, F.col("_gap")))
        .otherwise(months)
    )
    return (
        slots.withColumn("_gap", daymask.minus(F.col("expected_mask"), F.col("cached_mask")))
        .withColumn("_in_part", F.col("_gap").bitwiseAND(known))
        .withColumn("_whole", daymask.minus(F.col("_gap"), F.col("_in_part")))
        .withColumn("_runs", runs)
    )


def _with_status(counted: DataFrame) -> DataFrame:
    missing = F.col("total_partitions") - F.col("cached_partitions")
    return counted.withColumn("missing_partitions", missing).withColumn(
        "status",
        F.when(F.col("missing_partitions") == 0, "COMPLETE")
        .when(F.col("cached_partitions") == 0, "EMPTY")
        .otherwise("PARTIAL"),
    )


def coverage_status(
    requests: DataFrame,
    recorded: DataFrame | None,
    present: DataFrame,
    calendar: DataFrame,
    keys: list[str] = KEY,
    verify_files: bool = True,
) -> DataFrame:
    """COMPLETE, PARTIAL or EMPTY per request, with partition counts.

    A request that expects no partition at all is COMPLETE: nothing to load.
    """
    slots = _request_slots(requests, recorded, present, calendar, keys, verify_files)
    return _with_status(slots.groupBy(*keys, "range_start", "range_end").agg(*_counts()))


def _counts() -> list[Column]:
    return [
        F.sum(F.bit_count(f"{mask}_mask").cast("bigint")).alias(f"{name}_partitions")
        for mask, name in (("expected", "total"), ("cached", "cached"))
    ]


def symbol_windows_status(
    groups: DataFrame,
    listed: Callable[[DataFrame], DataFrame],
    windows: DataFrame,
    recorded: DataFrame | None,
    present: DataFrame,
    calendar: DataFrame,
    by: list[str],
    keys: list[str],
) -> DataFrame:
    """``coverage_status`` of requests that are all windows of a group's symbols.

    ``windows`` (symbol, range_start, range_end, more columns) is bounded: one window a
    symbol. ``listed`` makes the requests of a table of distinct ``groups``, which have the
    columns ``by``. A group gets the cached partitions of its symbols as one map, of at most
    as many entries as there are windows. The requests, many times the rows, are listed after
    the last shuffle; what they expect depends on the window and the calendar alone.
    """
    counts = _cached_counts(windows, recorded, present, calendar, by, keys)
    entries = F.collect_list(F.struct("symbol", "n"))
    cached = counts.groupBy(*by).agg(F.map_from_entries(entries).alias("_cached"))
    requests = listed(groups.join(cached, by, "left"))
    sessions = F.element_at("_sessions", calendars.calendar_of(F.col("dataset")))
    total = F.when(is_tick(F.col("schema_")), sessions).otherwise(F.col("_months"))
    found = F.coalesce(F.try_element_at("_cached", F.col("symbol")), F.lit(0).cast("bigint"))
    return _with_status(
        requests.join(F.broadcast(_window_totals(windows, calendar)), "symbol").select(
            *keys,
            "range_start",
            "range_end",
            total.alias("total_partitions"),
            found.alias("cached_partitions"),
        )
    )


def _cached_counts(
    windows: DataFrame,
    recorded: DataFrame | None,
    present: DataFrame,
    calendar: DataFrame,
    by: list[str],
    keys: list[str],
) -> DataFrame:
    """(by, symbol, n): cached partitions of the symbol's window, where there are any.

    Presence and recorded days meet by month, dealt by group in one shuffle. A month's
    partition is cached if it has rows and all its asked days are recorded, of tick schemas
    each recorded session with rows is.
    """
    none, every = (F.lit(n).cast("bigint") for n in (0, daymask.ALL_DAYS))
    tick, month = is_tick(F.col("schema_")), F.col("month_no")
    sessions = calendars.session_months(calendar).withColumnRenamed("calendar", "_calendar")
    seen = F.when(tick, F.col("slot_mask").bitwiseAND(F.coalesce("session_mask", every)))
    rows = (
        _by_month(present, keys, "slot_mask")
        .withColumn("_calendar", _tick_calendar())
        .join(F.broadcast(sessions), ["_calendar", "month_no"], "left")
        .select(
            *keys,
            month,
            seen.otherwise(every).alias("seen"),
            (every if recorded is None else none).alias("have"),
        )
    )
    if recorded is not None:
        days = _recorded_months(recorded, keys)
        rows = rows.unionByName(
            days.select(*keys, month, none.alias("seen"), F.col("day_mask").alias("have"))
        )
    start, end = F.col("range_start"), F.col("range_end")
    months = F.explode(F.sequence(daymask.month_no(start), daymask.month_no(end)))
    asked = windows.filter(start <= end).withColumn("month_no", months)
    asked = asked.withColumn("asked", daymask.span_mask(month, start, end)).drop("range_start", "range_end")
    inside = rows.join(F.broadcast(asked), ["symbol", "month_no"]).select(
        *by,
        "symbol",
        "month_no",
        *[F.col(c).bitwiseAND(F.col("asked")).alias(c) for c in ("seen", "have")],
        "asked",
    )
    both = F.bit_count(F.col("seen").bitwiseAND(F.col("have")))
    whole = F.when((F.col("seen") != 0) & (F.col("have") == F.col("asked")), 1).otherwise(0)
    return (
        spread(inside, *by)
        .groupBy(*by, "symbol", "month_no")
        .agg(F.bit_or("seen").alias("seen"), F.bit_or("have").alias("have"), F.max("asked").alias("asked"))
        .withColumn("n", F.when(tick, both).otherwise(whole))
        .filter("n > 0")
        .groupBy(*by, "symbol")
        .agg(F.sum(F.col("n").cast("bigint")).alias("n"))
    )


def _by_month(masks: DataFrame, keys: list[str], mask: str) -> DataFrame:
    """Buckets as months: of tick schemas the mask is of days, of others all its months."""
    tick, bucket = is_tick(F.col("schema_")), F.col("bucket")
    slots = F.when(tick, F.array(F.lit(1))).otherwise(daymask.days_in(F.col(mask)))
    number = F.when(tick, bucket).otherwise(bucket * 12 + F.col("_slot") - 1)
    return masks.select(*keys, bucket, mask, F.explode(slots).alias("_slot")).select(
        *keys, number.cast("int").alias("month_no"), mask
    )


def _recorded_months(recorded: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, month_no, day_mask) of ranges, or of the masks ``recorded_buckets`` makes."""
    if "full_mask" not in recorded.columns:
        return intervals.split_months(recorded.select(*keys, "range_start", "range_end"), keys)
    days = F.when(is_tick(F.col("schema_")), F.col("full_mask")).otherwise(daymask.ALL_DAYS)
    full = _by_month(recorded, keys, "full_mask").select(*keys, "month_no", days.alias("day_mask"))
    return full.unionByName(recorded.select(*keys, F.inline("parts")))


def _window_totals(windows: DataFrame, calendar: DataFrame) -> DataFrame:
    """(symbol, _months, _sessions): partitions each window expects, sessions by calendar."""
    start, end, name = F.col("range_start"), F.col("range_end"), F.col("_calendar")
    names = F.array(F.lit(None).cast("string"), *[F.lit(c) for c in calendars.TRADING_HOURS])
    bound = lambda day: F.when(name.isNotNull(), daymask.month_no(day)).otherwise(F.year(day))
    split = (
        windows.select("symbol", start, end)
        .filter(start <= end)
        .withColumn("_calendar", F.explode(names))
        .withColumn("_name", name)
        .withColumn("bucket", F.explode(F.sequence(bound(start), bound(end))))
    )
    n = F.sum(F.bit_count("expected_mask").cast("bigint")).alias("n")
    sessions = F.when(F.col("_name").isNotNull(), F.struct("_name", "n"))
    return (
        _with_masks(split, calendar)
        .groupBy("symbol", "_name")
        .agg(n)
        .groupBy("symbol")
        .agg(
            F.max(F.when(F.col("_name").isNull(), F.col("n"))).alias("_months"),
            F.map_from_entries(F.collect_list(sessions)).alias("_sessions"),
        )
    )


def status_and_gaps(
    requests: DataFrame,
    recorded: DataFrame,
    present: DataFrame,
    calendar: DataFrame,
    keys: list[str] = KEY,
) -> DataFrame:
    """Status of each request with an array of its gaps as (gap_start, gap_end).

    The counts and the gaps come from the same rows; a request's array has at most as
    many gaps as it has days.
    """
    request = [*keys, "range_start", "range_end"]
    slots = _request_slots(requests, recorded, present, calendar, keys)
    counted = _with_status(
        _gap_runs(slots)
        .groupBy(*request)
        .agg(*_counts(), F.sort_array(F.flatten(F.collect_list("_runs"))).alias("_runs"))
    )
    # A run that ends a bucket goes on in the next one if that starts with a run: gaps start
    # where the run before does not end the day before, and end where the next does not.
    at = lambda i: F.try_element_at("_runs", i)
    starts = F.filter("_runs", lambda r, i: (i == 0) | (F.date_add(at(i)["gap_end"], 1) != r["gap_start"]))
    ends = F.filter(
        "_runs",
        lambda r, i: F.coalesce(F.date_add(r["gap_end"], 1) != at(i + 2)["gap_start"], F.lit(True)),
    )
    gaps = F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(a["gap_start"].alias("gap_start"), b["gap_end"].alias("gap_end")),
    )
    return counted.withColumn("gaps", gaps).drop("_runs")


def days_to_load(
    requests: DataFrame, recorded: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """(key, month_no, day_mask) that completes all requests and loses nothing.

    A monthly partition is replaced as a whole: its load spans the first to the last of
    the missing and the recorded days of that month. Of tick schemas the missing
    sessions are loaded, each a partition of its own.
    """
    slots = _request_slots(requests, recorded, present, calendar, KEY)
    known = F.when(is_tick(F.col("schema_")), F.lit(0).cast("bigint")).otherwise(
        F.when(F.getbit("_full", F.pmod("_gap.month_no", F.lit(12))) == 1, F.lit(daymask.ALL_DAYS)).otherwise(
            F.aggregate(
                F.filter("_parts", lambda p: p["month_no"] == F.col("_gap.month_no")),
                F.lit(0).cast("bigint"),
                lambda a, p: a.bitwiseOR(p["day_mask"]),
            )
        )
    )
    first = daymask.month_first(F.col("month_no"))
    inside = daymask.span_mask(F.col("month_no"), first, F.last_day(first))
    merged = (
        slots.withColumn("_gap", F.explode(_gap_months(slots)))
        .select(*KEY, F.col("_gap.month_no").alias("month_no"), F.col("_gap.day_mask").alias("gap"), known.alias("_known"))
        .groupBy(*KEY, "month_no")
        .agg(F.bit_or("gap").alias("gap"), F.bit_or("_known").alias("_known"))
        .filter("gap <> 0")
        .withColumn("_known", F.col("_known").bitwiseAND(inside))
    )
    month = F.col("month_no")
    span = F.col("gap").bitwiseOR(F.col("_known"))
    whole = daymask.span_mask(
        month,
        daymask.date_of(month, daymask.lowest(span)),
        daymask.date_of(month, daymask.highest(span)),
    )
    mask = F.when(is_tick(F.col("schema_")), F.col("gap")).otherwise(whole)
    return merged.select(*KEY, "month_no", mask.alias("day_mask"))


def _month_ranges(present: DataFrame) -> DataFrame:
    """Whole months with rows, as ranges, for monthly schemas."""
    month = F.col("bucket") * 12 + F.col("_slot") - 1
    return (
        present.filter(~is_tick(F.col("schema_")))
        .withColumn("_slot", F.explode(daymask.days_in(F.col("slot_mask"))))
        .select(
            *KEY,
            daymask.month_first(month).alias("range_start"),
            F.last_day(daymask.month_first(month)).alias("range_end"),
        )
    )


def missing_partition_ranges(
    requests: DataFrame, present: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Missing partitions of each request as merged date ranges."""
    tick = is_tick(F.col("schema_"))
    months = intervals.missing_ranges(
        requests.filter(~tick), _month_ranges(present), KEY
    )
    buckets = _with_present(
        _request_buckets(requests.filter(tick), calendar, KEY), present, KEY
    )
    gap = daymask.minus(F.col("expected_mask"), F.col("present_mask"))
    day_gaps = buckets.select(
        *KEY,
        F.col("range_start").alias("request_start"),
        F.col("range_end").alias("request_end"),
        F.col("bucket").alias("month_no"),
        gap.alias("day_mask"),
    )
    days = intervals.months_to_ranges(day_gaps, [*KEY, "request_start", "request_end"])
    return months.unionByName(days)


def missing_union(
    requests: DataFrame,
    cached: DataFrame,
    present: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """Ranges missing from the catalog or from the files, merged.

    A day is covered if it is recorded and its partition exists or is not
    expected; the gaps of what is covered are missing.
    """
    tick = is_tick(F.col("schema_"))
    recorded = (
        intervals.ranges_to_months(cached, KEY)
        .withColumn("_first", daymask.month_first(F.col("month_no")))
        .withColumn("bucket", _bucket(F.col("_first")))
        .withColumn("_calendar", F.when(tick, calendars.calendar_of(F.col("dataset"))))
    )
    sessions = calendars.session_months(calendar).withColumnRenamed(
        "calendar", "_calendar"
    )
    every, none = (F.lit(n).cast("bigint") for n in (daymask.ALL_DAYS, 0))
    seen = F.coalesce("slot_mask", none)
    closed_or_seen = daymask.minus(every, F.coalesce("session_mask", every)).bitwiseOR(
        seen
    )
    month_seen = F.getbit(seen, F.month("_first") - 1) == 1
    sound = F.when(tick, closed_or_seen).otherwise(F.when(month_seen, every).otherwise(none))
    covered = (
        recorded.join(F.broadcast(sessions), ["_calendar", "month_no"], "left")
        .join(present, [*KEY, "bucket"], "left")
        .select(
            *KEY, "month_no", F.col("day_mask").bitwiseAND(sound).alias("day_mask")
        )
    )
    return intervals.missing_ranges(requests, intervals.month_runs(covered, KEY), KEY)


def month_reload_window(requests: DataFrame, cached: DataFrame) -> DataFrame:
    """For each month with a gap, the window whose reload loses nothing.

    A monthly partition is replaced as a whole, so the reload spans the asked
    days and all days of that month already cached. One row per request, month.
    Requests meet a key's recorded months as one map, before they are cut into months.
    """
    asked = requests.filter(~is_tick(F.col("schema_"))).select(*REQUEST).distinct()
    month = F.col("month_no")
    by_month = F.map_from_entries(F.collect_list(F.struct("month_no", "day_mask")))
    recorded = intervals.ranges_to_months(cached, KEY).groupBy(*KEY).agg(by_month.alias("_recorded"))
    joined = spread(asked, *KEY).join(recorded, KEY, "left")
    have = F.coalesce(F.try_element_at("_recorded", month), F.lit(0).cast("bigint"))
    span = F.col("day_mask").bitwiseOR(F.col("_have"))
    return (
        intervals.split_months(joined, [*REQUEST, "_recorded"])
        .select(*REQUEST, "month_no", "day_mask", have.alias("_have"))
        .filter(daymask.minus(F.col("day_mask"), F.col("_have")) != 0)
        .select(
            *REQUEST,
            F.year(daymask.month_first(month)).alias("year"),
            F.month(daymask.month_first(month)).alias("month"),
            daymask.date_of(month, daymask.lowest(span)).alias("load_start"),
            daymask.date_of(month, daymask.highest(span)).alias("load_end"),
        )
    )


def present_days(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Days with rows, one integer per key and month; combined map-side."""
    return intervals.days_to_months(rows, keys, "trade_date")


def rows_in_requests(
    requests: DataFrame, days: DataFrame, keys: list[str] = KEY
) -> DataFrame:
    """Requests with a flag: does any row lie in the window?

    A request meets its key's months as one array, so a long window is one row.
    """
    start, end = F.col("range_start"), F.col("range_end")
    asked = requests.select(*keys, start, end).filter(start <= end).distinct()
    month = F.struct("month_no", F.col("day_mask").alias("seen"))
    months = (
        spread(days.filter(F.col("month_no").isNotNull()), *keys)
        .groupBy(*keys)
        .agg(F.collect_list(month).alias("_months"))
    )

    def hit(m: Column) -> Column:
        number = m["month_no"]
        inside = number.between(daymask.month_no(start), daymask.month_no(end))
        return inside & (daymask.span_mask(number, start, end).bitwiseAND(m["seen"]) != 0)

    has_rows = F.coalesce(F.exists("_months", hit), F.lit(False))
    return asked.join(months, keys, "left").select(*asked.columns, has_rows.alias("has_rows"))


def empty_requests(requests: DataFrame, days: DataFrame) -> DataFrame:
    """Requests whose whole window holds no row."""
    return rows_in_requests(requests, days).filter(~F.col("has_rows")).drop("has_rows")
