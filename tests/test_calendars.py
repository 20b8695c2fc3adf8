from datetime import date

import pytest
from pyspark.sql import functions as F

from bourselake.operators import calendars
from bourselake.workload import oracles

from .conftest import d


def look(calendar, name, day):
    return calendar.filter((F.col("calendar") == name) & (F.col("day") == d(day))).first()


@pytest.fixture(scope="module")
def table(calendar):
    near = calendar.filter(F.year("day").between(1993, 2026)).collect()
    return {(r.calendar, str(r.day)): r for r in near}


def test_one_row_per_calendar_and_day(calendar):
    assert calendar.count() == 3 * ((calendars.LAST_DAY - calendars.FIRST_DAY).days + 1)
    assert calendar.select("calendar", "day").distinct().count() == calendar.count()


@pytest.mark.parametrize("day", ["2024-01-15", "2024-02-19", "2024-07-04", "2024-01-16"])
def test_cmes_opens_on_most_holidays(table, day):
    assert table["CMES", day].is_session


@pytest.mark.parametrize("day", ["2024-01-01", "2024-12-25", "2024-01-13", "2024-01-14"])
def test_cmes_closures(table, day):
    row = table["CMES", day]
    assert not row.is_session
    assert row.close_utc is None


def test_cmes_hours_follow_daylight_saving(table):
    assert table["CMES", "2024-01-15"].close_utc.hour == 18
    assert table["CMES", "2024-01-15"].is_early_close
    assert table["CMES", "2024-07-04"].close_utc.hour == 17
    assert table["CMES", "2024-07-04"].is_early_close
    normal = table["CMES", "2024-01-16"]
    assert (normal.open_utc.day, normal.open_utc.hour, normal.close_utc.hour) == (15, 23, 23)


@pytest.mark.parametrize(
    "day",
    [
        "2024-01-15", "2024-02-19", "2024-05-27", "2024-07-04", "2024-09-02",
        "2024-11-28", "2024-12-25", "2024-01-13", "2025-01-09", "2012-10-29",
        "2021-12-24", "2022-06-20", "2023-01-02", "2008-03-21",
    ],
)
def test_xnys_closures(table, day):
    assert not table["XNYS", day].is_session


def test_xnys_is_open_where_no_holiday_is_observed(table):
    # New Year's Day on a Saturday is not moved; Juneteenth began in 2022.
    assert table["XNYS", "2010-12-31"].is_session
    assert table["XNYS", "2021-12-31"].is_session
    assert table["XNYS", "2021-06-18"].is_session


def test_xnys_hours(table):
    row = table["XNYS", "2024-01-16"]
    assert (row.open_utc.hour, row.open_utc.minute) == (14, 30)
    assert (row.close_utc.hour, row.close_utc.minute) == (21, 0)
    for day, hour in [("2024-07-03", 17), ("2024-11-29", 18), ("2024-12-24", 18)]:
        assert table["XNYS", day].is_early_close
        assert table["XNYS", day].close_utc.hour == hour


@pytest.mark.parametrize("name", ["CMES", "XNYS"])
def test_rules_give_the_published_closures(table, name):
    published = {
        "CMES": oracles.CMES_CLOSED,
        "XNYS": [x for x in oracles.XNYS_CLOSED if x < "2022"],
    }[name]
    first, last = min(published)[:4], max(published)[:4]
    closed = [
        day
        for (calendar, day), row in table.items()
        if calendar == name
        and first <= day[:4] <= last
        and d(day).weekday() < 5
        and not row.is_session
    ]
    assert sorted(closed) == sorted(published)


def test_neighbouring_sessions(table):
    closed = table["XNYS", "2024-01-15"]
    assert (str(closed.prev_session), str(closed.next_session)) == (
        "2024-01-12", "2024-01-16",
    )
    open_day = table["XNYS", "2024-01-16"]
    assert open_day.prev_session == open_day.next_session == open_day.day


def test_session_numbers_count_sessions(table):
    before, after = table["XNYS", "2024-01-11"], table["XNYS", "2024-01-17"]
    assert after.session_no - before.session_no == 3


def request(spark, rows):
    return spark.createDataFrame(
        [(ds, d(a), d(b)) for ds, a, b in rows],
        "dataset string, range_start date, range_end date",
    )


def test_counts_and_days_agree(spark, calendar):
    asked = request(
        spark,
        [
            ("OPRA.PILLAR", "2024-01-12", "2024-01-17"),
            ("GLBX.MDP3", "2024-01-12", "2024-01-17"),
            ("OPRA.PILLAR", "2024-01-13", "2024-01-15"),
            ("IFEU.IMPACT", "2023-12-20", "2024-03-31"),
            ("XEUR.EOBI", "2100-01-30", "2100-02-02"),
            ("NO.SUCH", "1989-12-30", "1990-01-03"),
            ("NO.SUCH", "1980-01-01", "1980-03-31"),
        ],
    )
    counts = calendars.trading_day_count(asked, calendar).collect()
    found = {(r.dataset, str(r.range_start)): r.trading_days for r in counts}
    assert found["OPRA.PILLAR", "2024-01-12"] == 3
    assert found["GLBX.MDP3", "2024-01-12"] == 4
    assert found["OPRA.PILLAR", "2024-01-13"] == 0
    assert found["NO.SUCH", "1980-01-01"] == 91  # no calendar: every day counts
    listed = calendars.trading_days(asked, calendar).groupBy("dataset", "range_start")
    by_list = {(r[0], str(r[1])): r[2] for r in listed.count().collect()}
    assert by_list == {k: n for k, n in found.items() if n}


def test_rows_get_session_columns(spark, calendar):
    rows = spark.createDataFrame(
        [("OPRA.PILLAR", d("2024-01-15")), ("GLBX.MDP3", d("2024-01-15")),
         ("MYSTERY", d("2024-01-16")), ("MYSTERY", d("1950-01-01"))],
        "dataset string, day date",
    )
    columns = ["is_session", "is_early_close", "close_utc", "prev_session", "next_session"]
    joined = calendars.with_sessions(rows, calendar, "day", columns).collect()
    got = {(r.dataset, str(r.day)): r for r in joined}
    assert not got["OPRA.PILLAR", "2024-01-15"].is_session
    assert got["GLBX.MDP3", "2024-01-15"].is_early_close
    assert got["MYSTERY", "2024-01-16"].calendar == "XNYS"
    outside = got["MYSTERY", "1950-01-01"]
    assert outside.is_session and not outside.is_early_close
    assert outside.close_utc is None
    assert outside.prev_session == date(1950, 1, 1)
