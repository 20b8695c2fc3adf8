"""Exchange calendars as a dimension table, and the joins that use it.

The dimension has one row per (calendar, day): three calendars over 110 years,
121 thousand rows whatever the size of the lake. That fixed size is why it is
broadcast everywhere.
"""

from __future__ import annotations

from datetime import date
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourselake.functions import daymask
from bourselake.functions.vocab import DATASET_CALENDAR, DEFAULT_CALENDAR

FIRST_DAY = date(1990, 1, 1)
# The last contracts are of December 2099; their month needs its neighbours.
LAST_DAY = date(2100, 1, 31)

# Time zone, open time, whether the open is on the previous day,
# regular close and early close, all local.
TRADING_HOURS = {
    "XNYS": ("America/New_York", "09:30", False, "16:00", "13:00"),
    "CMES": ("America/Chicago", "17:00", True, "17:00", "12:00"),
    "IEPA": ("America/New_York", "20:00", True, "18:00", "13:00"),
}

# One-off closures of XNYS.
XNYS_ONE_OFF_CLOSURES = (
    date(1994, 4, 27),
    date(2001, 9, 11),
    date(2001, 9, 12),
    date(2001, 9, 13),
    date(2001, 9, 14),
    date(2004, 6, 11),
    date(2007, 1, 2),
    date(2012, 10, 29),
    date(2012, 10, 30),
    date(2018, 12, 5),
    date(2025, 1, 9),
)

# One-off 13:00 closes of XNYS.
XNYS_ONE_OFF_EARLY_CLOSES = (date(1997, 12, 26), date(1999, 12, 31), date(2003, 12, 26))

EXCEPTION_KINDS = ("closed", "early", "open")


def calendar_of(dataset: Column) -> Column:
    """Calendar a dataset follows; unknown datasets follow the default."""
    known = F.create_map(*[F.lit(x) for x in chain(*DATASET_CALENDAR.items())])
    return F.coalesce(F.element_at(known, dataset), F.lit(DEFAULT_CALENDAR))


def _easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the Meeus/Jones/Butcher integer rule."""

    def quotient(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    golden = year % 19
    century, rest = quotient(year, 100), year % 100
    correction = quotient(century - quotient(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - quotient(century, 4) - correction + 15) % 30
    weekday = (
        (century % 4) * 2 + quotient(rest, 4) * 2 + 32 - epact - rest % 4
    ) % 7
    late = quotient(golden + epact * 11 + weekday * 22, 451)
    number = epact + weekday - late * 7 + 114
    return F.make_date(year, quotient(number, 31), number % 31 + 1)


def _holiday_rules(day: Column) -> dict[str, Column]:
    """Is this day the (observed) holiday? One boolean per United States holiday."""
    year, month, dom = F.year(day), F.month(day), F.dayofmonth(day)
    weekday = F.weekday(day)  # Monday is 0
    month_day = month * 100 + dom

    def nth(n: int, which: int, in_month: int) -> Column:
        first = 7 * (n - 1) + 1
        return (month == in_month) & (weekday == which) & dom.between(first, first + 6)

    def exact(md: int) -> Column:
        return (month_day == md) & (weekday < 5)

    def moved(sunday_to: int, saturday_to: int | None, md: int) -> Column:
        observed = exact(md) | ((month_day == sunday_to) & (weekday == 0))
        if saturday_to is None:
            return observed
        return observed | ((month_day == saturday_to) & (weekday == 4))

    july_third = (
        ((month_day == 703) & weekday.isin(0, 1, 3) & (year >= 1995))
        | ((month_day == 703) & (weekday == 2) & (year >= 2013))
        | ((month_day == 705) & (weekday == 4) & year.between(1995, 2012))
    )
    return {
        "new_year": moved(102, None, 101),
        "king": nth(3, 0, 1) & (year >= 1998),
        "presidents": nth(3, 0, 2),
        "good_friday": day == F.date_sub(_easter_sunday(year), 2),
        "memorial": (month == 5) & (weekday == 0) & (dom >= 25),
        "juneteenth": moved(620, 618, 619) & (year >= 2022),
        "independence": moved(705, 703, 704),
        "labor": nth(1, 0, 9),
        "thanksgiving": nth(4, 3, 11),
        "christmas": moved(1226, 1224, 1225),
        "july_third": july_third,
        "black_friday": (month == 11)
        & (weekday == 4)
        & dom.between(23, 29)
        & (year >= 1993),
        # On a Friday the 24th is the observed holiday itself.
        "christmas_eve": (month_day == 1224) & (weekday < 4) & (year >= 1993),
    }


# Full closures and early closes by calendar. How CMES and IEPA
# treat Juneteenth is an assumption (session with an early close).
FULL_CLOSURES = {
    "XNYS": (
        "new_year", "king", "presidents", "good_friday", "memorial", "juneteenth",
        "independence", "labor", "thanksgiving", "christmas",
    ),
    "CMES": ("new_year", "good_friday", "christmas"),
    "IEPA": ("new_year", "good_friday", "christmas"),
}
EARLY_CLOSES = {
    "XNYS": ("july_third", "black_friday", "christmas_eve"),
    "CMES": (
        "king", "presidents", "memorial", "juneteenth", "independence", "labor",
        "thanksgiving", "black_friday", "christmas_eve",
    ),
    "IEPA": (
        "king", "presidents", "memorial", "juneteenth", "independence", "labor",
        "thanksgiving",
    ),
}


def _any_of(names: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for name in names:
        hit = hit | F.col(name)
    return hit


def _at(day: Column, clock: Column) -> Column:
    """Local wall-clock time on a day, without time zone."""
    return F.concat_ws(" ", day.cast("string"), clock).cast("timestamp_ntz")


def _overlay(exceptions: DataFrame) -> DataFrame:
    """One exception per calendar and day: a closure before an early close before an open
    day; of several early closes the earliest. At most as many rows as the dimension."""
    rank = F.when(F.col("kind") == "closed", 0).when(F.col("kind") == "early", 1).otherwise(2)
    known = exceptions.filter(
        F.col("kind").isin(*EXCEPTION_KINDS)
        & F.col("calendar").isin(*TRADING_HOURS)
        & F.col("day").between(FIRST_DAY, LAST_DAY)
    )
    return known.groupBy("calendar", "day").agg(
        F.min_by("kind", rank).alias("_kind"),
        F.min(F.when(F.col("kind") == "early", F.col("close_clock"))).alias("_close"),
    )


def _with_exceptions(rows: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Let exceptions override what the rules say of a day."""
    kind = F.col("_kind")
    early = kind == "early"
    regular = F.create_map(
        *[F.lit(x) for n, h in TRADING_HOURS.items() for x in (n, h[3])]
    )
    shortened = F.create_map(
        *[F.lit(x) for n, h in TRADING_HOURS.items() for x in (n, h[4])]
    )
    clock = (
        F.when(early, F.coalesce("_close", F.element_at(shortened, F.col("calendar"))))
        .when(kind == "open", F.element_at(regular, F.col("calendar")))
        .otherwise(F.col("close_clock"))
    )
    joined = rows.join(F.broadcast(_overlay(exceptions)), ["calendar", "day"], "left")
    return joined.withColumns(
        {
            "is_session": F.coalesce(kind != "closed", F.col("is_session")),
            "is_early_close": F.coalesce(early, F.col("is_early_close")),
            "close_clock": clock,
        }
    ).drop("_kind", "_close")


def calendar_day(spark: SparkSession, exceptions: DataFrame | None = None) -> DataFrame:
    """One row per (calendar, day): session flags, hours, session numbering.

    ``exceptions`` (calendar, day, kind, close_clock) override the rules: kind ``closed``
    takes a session away, ``early`` makes it a session that closes at ``close_clock`` local
    time (null: the calendar's early close), ``open`` an ordinary session, weekends and
    holidays included. Other kinds, unknown calendars and days outside the dimension are
    passed over. Session numbers and neighbours follow the overridden days.
    """
    n_days = (LAST_DAY - FIRST_DAY).days + 1
    days = spark.range(n_days).select(
        F.date_add(F.lit(FIRST_DAY), F.col("id").cast("int")).alias("day")
    )
    rules = _holiday_rules(F.col("day"))
    flagged = days.select("day", *[c.alias(n) for n, c in rules.items()])

    entries = []
    for name, (zone, opens, day_before, closes, early) in TRADING_HOURS.items():
        closed = _any_of(FULL_CLOSURES[name])
        shortened = _any_of(EARLY_CLOSES[name])
        if name == "XNYS":
            closed = closed | F.col("day").isin(*XNYS_ONE_OFF_CLOSURES)
            shortened = shortened | F.col("day").isin(*XNYS_ONE_OFF_EARLY_CLOSES)
        session = (F.weekday("day") < 5) & ~closed
        entries.append(
            F.struct(
                F.lit(name).alias("calendar"),
                F.lit(zone).alias("zone"),
                session.alias("is_session"),
                (session & shortened).alias("is_early_close"),
                F.lit(opens).alias("open_clock"),
                F.lit(int(day_before)).alias("open_days_before"),
                F.when(shortened, early).otherwise(F.lit(closes)).alias("close_clock"),
            )
        )
    rows = flagged.select("day", F.inline(F.array(*entries)))
    if exceptions is not None:
        rows = _with_exceptions(rows, exceptions)

    upto = Window.partitionBy("calendar").orderBy("day")
    # Running backwards; a frame of following rows would be recomputed per row.
    back = Window.partitionBy("calendar").orderBy(F.desc("day"))
    session_day = F.when(F.col("is_session"), F.col("day"))
    utc = F.lit("UTC")
    open_local = _at(F.date_sub("day", F.col("open_days_before")), F.col("open_clock"))
    close_local = _at(F.col("day"), F.col("close_clock"))
    return rows.select(
        "calendar",
        "day",
        "is_session",
        "is_early_close",
        F.when(
            F.col("is_session"), F.convert_timezone(F.col("zone"), utc, open_local)
        ).alias("open_utc"),
        F.when(
            F.col("is_session"), F.convert_timezone(F.col("zone"), utc, close_local)
        ).alias("close_utc"),
        F.sum(F.col("is_session").cast("int")).over(upto).cast("int").alias(
            "session_no"
        ),
        F.last(session_day, ignorenulls=True).over(upto).alias("prev_session"),
        F.last(session_day, ignorenulls=True).over(back).alias("next_session"),
    )


def session_months(calendar: DataFrame) -> DataFrame:
    """(calendar, month_no) -> mask of its sessions; 2,556 rows."""
    return (
        calendar.filter("is_session")
        .groupBy("calendar", daymask.month_no(F.col("day")).alias("month_no"))
        .agg(F.bit_or(daymask.day_bit(F.col("day"))).alias("session_mask"))
    )


def with_sessions(
    rows: DataFrame, calendar: DataFrame, day: str, columns: list[str]
) -> DataFrame:
    """Attach calendar columns to rows by (dataset's calendar, day).

    Outside the dimension's years a day counts as an open, ordinary day.
    """
    fallback = {
        "is_session": F.lit(True),
        "is_early_close": F.lit(False),
        "prev_session": F.col(day),
        "next_session": F.col(day),
    }
    dim = calendar.select(
        F.col("calendar").alias("_calendar"),
        F.col("day").alias("_calendar_day"),
        *columns,
    )
    keyed = rows.withColumn("calendar", calendar_of(F.col("dataset")))
    joined = keyed.join(
        F.broadcast(dim),
        (F.col("calendar") == F.col("_calendar"))
        & (F.col(day) == F.col("_calendar_day")),
        "left",
    )
    filled = [
        F.coalesce(F.col(c), fallback[c]).alias(c) if c in fallback else F.col(c)
        for c in columns
    ]
    return joined.select(*rows.columns, "calendar", *filled)


def trading_days(ranges: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every session of each (dataset, range_start, range_end) row.

    Outside the dimension's years every day counts as a session.
    """
    months = with_session_months(ranges, calendar)
    return months.select(
        *ranges.columns,
        F.explode(daymask.days_in(F.col("session_mask"))).alias("_dom"),
        "month_no",
    ).select(
        *ranges.columns,
        daymask.date_of(F.col("month_no"), F.col("_dom")).alias("trade_date"),
    )


def with_session_months(ranges: DataFrame, calendar: DataFrame) -> DataFrame:
    """Split ranges into months, each with the masks of its days and sessions.

    Adds month_no, window_mask (days of the range in that month) and
    session_mask (those of them that are sessions).
    """
    start, end = F.col("range_start"), F.col("range_end")
    split = ranges.filter(start <= end).select(
        "*",
        F.explode(
            F.sequence(daymask.month_no(start), daymask.month_no(end))
        ).alias("month_no"),
        calendar_of(F.col("dataset")).alias("_calendar"),
    )
    sessions = session_months(calendar).select(
        F.col("calendar").alias("_calendar"), "month_no", "session_mask"
    )
    window = daymask.span_mask(F.col("month_no"), start, end)
    # Every month of the dimension has sessions; a month without is outside it.
    known = F.coalesce("session_mask", F.lit(daymask.ALL_DAYS).cast("bigint"))
    return split.join(F.broadcast(sessions), ["_calendar", "month_no"], "left").select(
        *ranges.columns,
        "month_no",
        window.alias("window_mask"),
        known.bitwiseAND(window).alias("session_mask"),
    )


def trading_day_count(ranges: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions in each range, as a difference of two running counts.

    Days outside the dimension's years count as sessions.
    """
    dim = calendar.select("calendar", "day", "session_no", "is_session")
    first = dim.select(
        F.col("calendar").alias("_calendar"),
        F.col("day").alias("_first"),
        (F.col("session_no") - F.col("is_session").cast("int")).alias("_before"),
    )
    last = dim.select(
        F.col("calendar").alias("_calendar"),
        F.col("day").alias("_last"),
        F.col("session_no").alias("_through"),
    )
    start, end = F.col("range_start"), F.col("range_end")
    clamped = ranges.filter(start <= end).withColumns(
        {
            "_calendar": calendar_of(F.col("dataset")),
            "_first": F.greatest(start, F.lit(FIRST_DAY)),
            "_last": F.least(end, F.lit(LAST_DAY)),
        }
    )
    inside = F.greatest(F.datediff("_last", "_first") + 1, F.lit(0))
    outside = F.datediff(end, start) + 1 - inside
    sessions = F.when(inside > 0, F.col("_through") - F.col("_before")).otherwise(0)
    return (
        clamped.join(F.broadcast(first), ["_calendar", "_first"], "left")
        .join(F.broadcast(last), ["_calendar", "_last"], "left")
        .select(*ranges.columns, (sessions + outside).cast("bigint").alias("trading_days"))
    )
