import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from bourselake.functions import daymask
from bourselake.operators import intervals
from bourselake.operators.coverage import KEY

from .conftest import KEYED, d, pairs, ranges, tick_rows

ORIGIN = date(2019, 11, 20)


@pytest.mark.parametrize(
    ("given", "merged"),
    [
        ([("2024-01-01", "2024-03-31"), ("2024-03-01", "2024-06-30")],
         [("2024-01-01", "2024-06-30")]),
        ([("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29")],
         [("2024-01-01", "2024-02-29")]),
        ([("2024-01-01", "2024-01-31"), ("2024-03-01", "2024-03-31")],
         [("2024-01-01", "2024-01-31"), ("2024-03-01", "2024-03-31")]),
        ([("2024-01-01", "2024-12-31"), ("2024-02-01", "2024-02-02"),
          ("2024-03-01", "2024-03-02")], [("2024-01-01", "2024-12-31")]),
    ],
)
def test_merge(spark, given, merged):
    assert pairs(intervals.merge_ranges(ranges(spark, given), KEY)) == merged


@pytest.mark.parametrize(
    ("cached", "gaps"),
    [
        ([("2024-03-01", "2024-12-31")], [("2024-01-01", "2024-02-29")]),
        ([("2024-01-01", "2024-03-31")], [("2024-04-01", "2024-06-30")]),
        ([("2024-03-01", "2024-04-30")],
         [("2024-01-01", "2024-02-29"), ("2024-05-01", "2024-06-30")]),
        ([("2023-01-01", "2025-01-01")], []),
        ([("2020-01-01", "2020-01-02"), ("2030-01-01", "2030-01-02")],
         [("2024-01-01", "2024-06-30")]),
        ([], [("2024-01-01", "2024-06-30")]),
    ],
)
def test_missing(spark, cached, gaps):
    asked = ranges(spark, [("2024-01-01", "2024-06-30")])
    assert pairs(intervals.missing_ranges(asked, ranges(spark, cached), KEY)) == gaps


def test_subtract_splits_a_range(spark):
    left = intervals.subtract_ranges(
        ranges(spark, [("2024-01-01", "2024-06-30")]),
        ranges(spark, [("2024-03-01", "2024-04-30")]),
        KEY,
    )
    assert pairs(left) == [("2024-01-01", "2024-02-29"), ("2024-05-01", "2024-06-30")]


def test_gaps_over_years_appear_once(spark):
    asked = ranges(spark, [("2010-06-01", "2024-06-01"), ("2015-01-01", "2015-01-03")])
    cached = ranges(spark, [("2012-12-31", "2013-01-01")])
    gaps = intervals.missing_ranges(asked, cached, KEY)
    assert pairs(gaps) == [
        ("2010-06-01", "2012-12-30"), ("2013-01-02", "2024-06-01"),
        ("2015-01-01", "2015-01-03"),
    ]


def random_ranges(spark, rng, n_keys, n_ranges, longest):
    rows = []
    for key in range(n_keys):
        for _ in range(rng.randrange(n_ranges + 1)):
            start = ORIGIN + timedelta(rng.randrange(800))
            end = start + timedelta(rng.randrange(longest))
            rows.append(("X", f"S{key}", "trades", start, end))
    return rows, spark.createDataFrame(rows, KEYED + "range_start date, range_end date")


def day_sets(rows):
    sets = {}
    for *_, symbol, _schema, start, end in [(r[0], r[1], r[2], r[-2], r[-1]) for r in rows]:
        days = sets.setdefault(symbol, set())
        days.update(start + timedelta(i) for i in range((end - start).days + 1))
    return sets


def runs(days):
    found = []
    for day in sorted(days):
        if found and day == found[-1][1] + timedelta(1):
            found[-1][1] = day
        else:
            found.append([day, day])
    return [tuple(x) for x in found]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_sets_of_days(spark, seed):
    rng = random.Random(seed)
    cached_rows, cached = random_ranges(spark, rng, 12, 25, 60)
    taken_rows, taken = random_ranges(spark, rng, 12, 10, 90)
    asked_rows, asked = random_ranges(spark, rng, 12, 4, 700)
    have, cut = day_sets(cached_rows), day_sets(taken_rows)

    merged = intervals.merge_ranges(cached, KEY).collect()
    assert sorted((r.symbol, r.range_start, r.range_end) for r in merged) == sorted(
        (s, a, b) for s, days in have.items() for a, b in runs(days)
    )

    left = intervals.subtract_ranges(cached, taken, KEY).collect()
    assert sorted((r.symbol, r.range_start, r.range_end) for r in left) == sorted(
        (s, a, b) for s, days in have.items() for a, b in runs(days - cut.get(s, set()))
    )

    gaps = intervals.missing_ranges(asked, cached, KEY).collect()
    wanted = set()
    for row in set(asked_rows):
        days = day_sets([row])[row[1]] - have.get(row[1], set())
        wanted.update((row[1], row[3], row[4], a, b) for a, b in runs(days))
    assert {
        (r.symbol, r.request_start, r.request_end, r.range_start, r.range_end)
        for r in gaps
    } == wanted
    assert len(gaps) == len(wanted)


def test_merge_is_idempotent(spark):
    _, cached = random_ranges(spark, random.Random(5), 6, 30, 40)
    once = intervals.merge_ranges(cached, KEY)
    assert sorted(once.collect()) == sorted(intervals.merge_ranges(once, KEY).collect())


def test_gaps_and_cached_days_make_up_the_request(spark):
    asked = ranges(spark, [("2024-01-10", "2024-08-20")])
    cached = ranges(
        spark, [("2023-12-01", "2024-01-15"), ("2024-03-03", "2024-03-03"), ("2024-08-01", "2024-09-01")]
    )
    gaps = intervals.missing_ranges(asked, cached, KEY).drop("request_start", "request_end")
    clipped = cached.select(
        *KEY,
        F.greatest("range_start", F.lit(d("2024-01-10"))).alias("range_start"),
        F.least("range_end", F.lit(d("2024-08-20"))).alias("range_end"),
    )
    whole = intervals.merge_ranges(gaps.unionByName(clipped), KEY)
    assert pairs(whole) == [("2024-01-10", "2024-08-20")]


def test_subtract_and_add_back_restores(spark):
    kept = ranges(spark, [("2024-01-01", "2024-06-30")])
    cleared = ranges(spark, [("2024-02-10", "2024-03-05")])
    left = intervals.subtract_ranges(kept, cleared, KEY)
    assert pairs(intervals.merge_ranges(left.unionByName(cleared), KEY)) == pairs(kept)


def test_islands_of_rows(spark, calendar):
    # 2024-01-12 is a Friday; XNYS is closed on the 15th, CMES is not.
    days = ["2024-01-11", "2024-01-12", "2024-01-16", "2024-01-17", "2024-01-19"]
    rows = tick_rows(
        spark,
        [(ds, "ES.c.0", "trades", x, 1) for ds in ("GLBX.MDP3", "OPRA.PILLAR") for x in days],
    )
    by_day = intervals.day_islands(rows.filter("dataset = 'GLBX.MDP3'"), KEY, "trade_date")
    assert pairs(by_day) == [
        ("2024-01-11", "2024-01-12"), ("2024-01-16", "2024-01-17"), ("2024-01-19", "2024-01-19"),
    ]
    by_session = intervals.session_islands(rows, calendar, KEY, "trade_date")
    assert pairs(by_session.filter("dataset = 'OPRA.PILLAR'")) == [
        ("2024-01-11", "2024-01-17"), ("2024-01-19", "2024-01-19"),
    ]
    assert pairs(by_session.filter("dataset = 'GLBX.MDP3'")) == [
        ("2024-01-11", "2024-01-12"), ("2024-01-16", "2024-01-17"), ("2024-01-19", "2024-01-19"),
    ]


def test_month_islands(spark):
    days = ["2024-01-05", "2024-02-27", "2024-04-01", "2024-12-31", "2025-01-01"]
    rows = tick_rows(spark, [("X", "A", "ohlcv-1d", x, 1) for x in days])
    assert pairs(intervals.month_islands(rows, KEY, "trade_date")) == [
        ("2024-01-05", "2024-02-27"), ("2024-04-01", "2024-04-01"), ("2024-12-31", "2025-01-01"),
    ]


def test_masks(spark):
    values = [0, 1, 1 << 30, (1 << 31) - 1, 0b1011001, 0b110]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m bigint")
    got = rows.orderBy("i").select(
        daymask.days_in(F.col("m")).alias("days"), daymask.runs_in(F.col("m")).alias("runs")
    ).collect()
    for value, row in zip(values, got, strict=True):
        days = [x + 1 for x in range(31) if value >> x & 1]
        assert row.days == days
        as_dates = {date(2024, 1, 1) + timedelta(x - 1) for x in days}
        assert [(r.first, r.last) for r in row.runs] == [
            (a.day, b.day) for a, b in runs(as_dates)
        ]


def test_one_window_never_sorts_more_rows_than_start_dates(spark):
    many = ranges(spark, [("2024-01-01", "2024-01-05")]).crossJoin(spark.range(5000)).drop("id")
    assert intervals._longest(many, KEY).count() == 1
