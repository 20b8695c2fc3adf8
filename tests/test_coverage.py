import random
from datetime import date, timedelta

import pytest

from bourselake.operators import coverage

from .conftest import KEYED, d, pairs, ranges, tick_rows

ES = ("GLBX.MDP3", "ES.c.0", "trades")
BARS = ("GLBX.MDP3", "ES.c.0", "ohlcv-1d")


def status(spark, calendar, rows, key, start, end):
    present = coverage.present_partitions(rows)
    asked = ranges(spark, [(start, end)], key)
    # All that the rows could cover is recorded; gaps come from the partitions.
    recorded = ranges(spark, [("1970-01-01", "2030-12-31")], key)
    row = coverage.coverage_status(asked, recorded, present, calendar).first()
    return row.status, row.total_partitions, row.cached_partitions, row.missing_partitions


def test_tick_request_is_complete_across_weekend_and_holiday(spark, calendar):
    days = ["2024-01-11", "2024-01-12", "2024-01-16"]
    rows = tick_rows(spark, [("OPRA.PILLAR", "SPX", "trades", x, 1) for x in days])
    key = ("OPRA.PILLAR", "SPX", "trades")
    assert status(spark, calendar, rows, key, "2024-01-11", "2024-01-16") == ("COMPLETE", 3, 3, 0)
    assert status(spark, calendar, rows, key, "2024-01-11", "2024-01-17") == ("PARTIAL", 4, 3, 1)
    assert status(spark, calendar, rows, key, "2024-01-17", "2024-01-18") == ("EMPTY", 2, 0, 2)


def test_request_without_sessions_is_complete(spark, calendar):
    rows = tick_rows(spark, [(*ES, "2024-01-16", 1)])
    assert status(spark, calendar, rows, ES, "2024-01-13", "2024-01-14") == ("COMPLETE", 0, 0, 0)


def test_months_are_the_partitions_of_bars(spark, calendar):
    rows = tick_rows(spark, [(*BARS, "2023-12-05", 1), (*BARS, "2024-02-10", 1)])
    assert status(spark, calendar, rows, BARS, "2023-12-20", "2024-02-01") == ("PARTIAL", 3, 2, 1)


def test_days_before_the_calendars_are_all_expected(spark, calendar):
    rows = tick_rows(spark, [(*ES, "1980-01-05", 1)])
    assert status(spark, calendar, rows, ES, "1980-01-01", "1980-01-31") == ("PARTIAL", 31, 1, 30)


def test_expected_partitions_are_clamped(spark, calendar):
    asked = ranges(spark, [("2024-01-20", "2024-03-10")], BARS)
    found = coverage.expected_partitions(asked, calendar)
    assert pairs(found, "part_start", "part_end") == [
        ("2024-01-20", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-10"),
    ]
    assert {r.day for r in found.collect()} == {0}


def test_missing_day_partitions_merge_into_ranges(spark, calendar):
    rows = tick_rows(spark, [(*ES, "2024-01-10", 1)])
    asked = ranges(spark, [("2024-01-08", "2024-01-16")], ES)
    gaps = coverage.missing_partition_ranges(
        asked, coverage.present_partitions(rows), calendar
    )
    assert pairs(gaps) == [
        ("2024-01-08", "2024-01-09"), ("2024-01-11", "2024-01-12"), ("2024-01-15", "2024-01-16"),
    ]


def test_missing_month_partitions_merge_and_clamp(spark, calendar):
    rows = tick_rows(spark, [(*BARS, "2024-03-10", 1)])
    asked = ranges(spark, [("2024-01-20", "2024-05-05")], BARS)
    gaps = coverage.missing_partition_ranges(
        asked, coverage.present_partitions(rows), calendar
    )
    assert pairs(gaps) == [("2024-01-20", "2024-02-29"), ("2024-04-01", "2024-05-05")]


def test_missing_union_takes_catalog_and_file_gaps(spark, calendar):
    asked = ranges(spark, [("2024-01-01", "2024-04-30")], BARS)
    recorded = ranges(spark, [("2024-01-01", "2024-03-15")], BARS)
    present = coverage.present_partitions(
        tick_rows(spark, [(*BARS, x, 1) for x in ("2024-01-05", "2024-03-05", "2024-04-05")])
    )
    gaps = coverage.missing_union(asked, recorded, present, calendar)
    assert pairs(gaps) == [("2024-02-01", "2024-02-29"), ("2024-03-16", "2024-04-30")]


@pytest.mark.parametrize(
    ("cached", "asked", "load"),
    [
        ([("2024-01-01", "2024-01-15")], ("2024-01-16", "2024-01-20"), ("2024-01-01", "2024-01-20")),
        ([], ("2024-01-16", "2024-01-20"), ("2024-01-16", "2024-01-20")),
        ([("2023-12-20", "2024-01-03"), ("2024-01-30", "2024-02-02")],
         ("2024-01-16", "2024-01-20"), ("2024-01-01", "2024-01-31")),
    ],
)
def test_month_reload_keeps_what_is_cached(spark, cached, asked, load):
    found = coverage.month_reload_window(
        ranges(spark, [asked], BARS), ranges(spark, cached, BARS)
    )
    assert pairs(found, "load_start", "load_end") == [load]


def test_fully_cached_months_are_not_reloaded(spark):
    found = coverage.month_reload_window(
        ranges(spark, [("2024-01-10", "2024-02-10")], BARS),
        ranges(spark, [("2024-01-01", "2024-01-31")], BARS),
    ).collect()
    assert [(r.year, r.month) for r in found] == [(2024, 2)]


def test_two_missing_days_are_two_single_loads(spark, calendar):
    rows = tick_rows(spark, [(*ES, f"2024-01-{i:02}", 1) for i in range(1, 16)])
    asked = ranges(spark, [("2024-01-16", "2024-01-17")], ES)
    missing = coverage.missing_partitions(
        asked, coverage.present_partitions(rows), calendar
    )
    assert pairs(missing, "part_start", "part_end") == [
        ("2024-01-16", "2024-01-16"), ("2024-01-17", "2024-01-17"),
    ]


def test_empty_requests(spark):
    days = coverage.present_days(tick_rows(spark, [(*BARS, "2024-01-20", 1)]))
    asked = ranges(
        spark, [("2024-01-01", "2024-01-19"), ("2024-01-01", "2024-01-20"), ("2024-02-01", "2025-02-01")], BARS
    )
    assert pairs(coverage.empty_requests(asked, days)) == [
        ("2024-01-01", "2024-01-19"), ("2024-02-01", "2025-02-01"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, calendar, seed):
    rng = random.Random(seed)
    first = date(2023, 11, 1)
    keys = [(ds, s, sc) for ds in ("GLBX.MDP3", "OPRA.PILLAR") for s in ("A", "B")
            for sc in ("trades", "ohlcv-1h")]
    seen = {
        (k, first + timedelta(rng.randrange(150))) for k in keys for _ in range(40)
    }
    rows = tick_rows(spark, [(*k, str(x), 1) for k, x in seen])
    asked = set()
    for k in keys:
        for _ in range(5):
            start = first + timedelta(rng.randrange(140))
            asked.add((*k, start, start + timedelta(rng.randrange(60))))
    requests = spark.createDataFrame(list(asked), KEYED + "range_start date, range_end date")
    sessions = {(r.calendar, r.day) for r in calendar.filter("is_session")
                .filter("year(day) between 2023 and 2024").collect()}

    # Of most keys all days are recorded, of every third one only some.
    recorded = spark.createDataFrame(
        [
            (*k, first, first + timedelta(300 if i % 3 else 70))
            for i, k in enumerate(keys)
        ],
        KEYED + "range_start date, range_end date",
    )
    last_known = {k: first + timedelta(300 if i % 3 else 70) for i, k in enumerate(keys)}
    present = coverage.present_partitions(rows)
    got = {
        (r.dataset, r.symbol, r.schema_, r.range_start, r.range_end): (
            r.total_partitions, r.cached_partitions, r.status)
        for r in coverage.coverage_status(requests, recorded, present, calendar).collect()
    }
    assert len(got) == len(asked)
    for ds, s, sc, start, end in asked:
        days = [start + timedelta(i) for i in range((end - start).days + 1)]
        held = {x for k, x in seen if k == (ds, s, sc)}
        name = "CMES" if ds == "GLBX.MDP3" else "XNYS"
        if sc == "trades":
            wanted = {x for x in days if (name, x) in sessions}
            have = {x for x in wanted & held if x <= last_known[ds, s, sc]}
        else:
            wanted = {(x.year, x.month) for x in days}
            unknown = {(x.year, x.month) for x in days if x > last_known[ds, s, sc]}
            have = (wanted & {(x.year, x.month) for x in held}) - unknown
        missing = len(wanted) - len(have)
        text = "COMPLETE" if not missing else "EMPTY" if not have else "PARTIAL"
        assert got[ds, s, sc, start, end] == (len(wanted), len(have), text)


def test_presence_adds_up(spark):
    one = tick_rows(spark, [(*ES, "2024-01-10", 1), (*BARS, "2024-01-10", 1)])
    two = tick_rows(spark, [(*ES, "2024-01-12", 1), (*BARS, "2024-05-10", 1)])
    merged = coverage.merge_present(
        coverage.present_partitions(one), coverage.present_partitions(two)
    )
    whole = coverage.present_partitions(one.unionByName(two))
    assert sorted(merged.collect()) == sorted(whole.collect())


def test_labels(spark):
    rows = spark.createDataFrame([(2024, 3, 0), (2024, 3, 7)], "year int, month int, day int")
    labels = [r[0] for r in rows.select(coverage.partition_label()).collect()]
    assert sorted(labels) == ["2024-03", "2024-03-07"]


def test_requests_in_reverse_expect_nothing(spark, calendar):
    asked = ranges(spark, [("2024-01-20", "2024-01-10")], ES)
    assert coverage.expected_partitions(asked, calendar).count() == 0
    assert d("2024-01-20") > d("2024-01-10")
