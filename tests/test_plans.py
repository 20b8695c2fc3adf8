import pytest

from bourselake.operators import coverage
from bourselake.operators.coverage import KEY
from bourselake.plans import updates

from .conftest import KEYED, d, pairs, ranges, tick_rows


def plan(spark, contract, symbol, last, as_of, available="2030-01-01", **options):
    recorded = ranges(spark, [("2024-01-01", last)], ("GLBX.MDP3", symbol, "ohlcv-1m"))
    ends = spark.createDataFrame(
        [("GLBX.MDP3", d(available))], "dataset string, available_end date"
    )
    row = updates.update_plan(recorded, ends, contract, d(as_of), **options).first()
    return row.state, str(row.range_start), str(row.range_end)


@pytest.mark.parametrize(
    ("symbol", "last", "as_of", "available", "expected"),
    [
        ("NQH24", "2024-03-10", "2024-06-01", "2030-01-01", ("due", "2024-03-11", "2024-03-15")),
        ("NQH24", "2024-03-15", "2024-06-01", "2030-01-01", ("up_to_date", "None", "None")),
        ("NQH24", "2024-03-31", "2024-06-01", "2030-01-01", ("up_to_date", "None", "None")),
        ("ES.c.0", "2024-03-31", "2024-06-01", "2030-01-01", ("due", "2024-04-01", "2024-05-31")),
        ("ES.c.0", "2026-01-28", "2026-02-10", "2026-01-30", ("due", "2026-01-29", "2026-01-30")),
        ("ES.c.0", "2026-01-30", "2026-02-10", "2026-01-30", ("up_to_date", "None", "None")),
        ("ES.c.0", "2024-05-31", "2024-06-01", "2030-01-01", ("up_to_date", "None", "None")),
    ],
)
def test_update_plan(spark, contract, symbol, last, as_of, available, expected):
    assert plan(spark, contract, symbol, last, as_of, available) == expected


def test_wanted_end_and_unknown_dataset(spark, contract):
    got = plan(spark, contract, "ES.c.0", "2024-03-31", "2024-06-01", end=d("2024-04-10"))
    assert got == ("due", "2024-04-01", "2024-04-10")
    recorded = ranges(spark, [("2024-01-01", "2024-01-10")], ("OTHER", "A", "trades"))
    nothing = spark.createDataFrame([], "dataset string, available_end date")
    row = updates.update_plan(recorded, nothing, contract, d("2024-02-01")).first()
    assert str(row.range_end) == "2024-01-31"


def test_available_end_and_outcomes(spark, contract):
    keys = [("X", n, "trades") for n in ("fresh", "silent", "done")]
    landing = tick_rows(
        spark,
        [(*keys[0], "2024-01-20", 1), (*keys[1], "2024-01-05", 1), (*keys[2], "2024-01-25", 1)],
    )
    ends = updates.available_end(landing)
    assert str(ends.first().available_end) == "2024-01-25"
    recorded = (
        ranges(spark, [("2024-01-01", "2024-01-10")], keys[0])
        .unionByName(ranges(spark, [("2024-01-01", "2024-01-10")], keys[1]))
        .unionByName(ranges(spark, [("2024-01-01", "2024-01-25")], keys[2]))
    )
    planned = updates.update_plan(recorded, ends, contract, d("2024-02-01"))
    outcomes = updates.update_outcomes(planned, coverage.present_days(landing))
    assert {r.symbol: r.outcome for r in outcomes.collect()} == {
        "fresh": "updated", "silent": "error", "done": "up_to_date",
    }
    assert updates.outcome_counts(outcomes).count() == 3


def rolls(spark, contract, held, as_of):
    rows = [("GLBX.MDP3", s, sc, d("2024-01-01"), d(end)) for s, sc, end in held]
    recorded = spark.createDataFrame(rows, KEYED + "range_start date, range_end date")
    found = updates.auto_roll_plan(recorded, contract, d(as_of), ["dataset"]).collect()
    return sorted((r.symbol, r.schemas, str(r.range_start), str(r.range_end)) for r in found)


def test_expired_contracts_roll_to_their_successor(spark, contract):
    held = [
        ("MNQH26", "ohlcv-1m", "2026-03-20"),
        ("MNQH26", "ohlcv-1h", "2026-03-31"),
        ("NQH26", "ohlcv-1m", "2026-03-19"),  # not loaded to expiration
        ("ES.c.0", "ohlcv-1m", "2026-03-20"),  # continuous never rolls
    ]
    assert rolls(spark, contract, held, "2026-03-25") == [
        ("MNQM26", ["ohlcv-1h", "ohlcv-1m"], "2026-03-06", "2026-03-24")
    ]


def test_held_successors_and_future_windows_do_not_roll(spark, contract):
    held = [
        ("ESH24", "ohlcv-1m", "2024-03-15"),
        ("ESM24", "ohlcv-1m", "2024-03-20"),
        ("ESH24", "ohlcv-1h", "2024-03-15"),
    ]
    assert rolls(spark, contract, held, "2024-04-01") == [
        ("ESM24", ["ohlcv-1h"], "2024-03-01", "2024-03-31")
    ]
    assert rolls(spark, contract, held[:1], "2024-03-01") == []


def test_batch_plan_skips_complete_contracts(spark, contract, calendar):
    spans = spark.createDataFrame(
        [("GLBX.MDP3", "NQ", "ohlcv-1d", 2024, 2024)],
        "dataset string, root string, schema_ string, from_year int, to_year int",
    )
    months = ["2023-12-10", "2024-01-10", "2024-02-10", "2024-03-10", "2024-04-10"]
    rows = tick_rows(spark, [("GLBX.MDP3", s, "ohlcv-1d", x, 1) for x in months
                             for s in ("NQH24", "NQM24")])
    present = coverage.present_partitions(rows)
    recorded = ranges(
        spark, [("2023-12-01", "2024-03-31")], ("GLBX.MDP3", "NQH24", "ohlcv-1d")
    ).unionByName(
        ranges(spark, [("2024-03-01", "2024-04-30")], ("GLBX.MDP3", "NQM24", "ohlcv-1d"))
    )
    for force in (False, True):
        planned = updates.batch_plan(
            spans, contract, recorded, present, calendar, d("2024-08-01"), ["dataset"], force
        )
        got = {r.symbol: (r.status, r.action) for r in planned.collect()}
        assert got == {
            "NQH24": ("COMPLETE", "load" if force else "skip"),
            "NQM24": ("PARTIAL", "load"),
            "NQU24": ("EMPTY", "load"),
        }


def test_ensure_serves_or_loads(spark, calendar):
    key = ("OPRA.PILLAR", "SPX", "trades")
    rows = tick_rows(spark, [(*key, x, 1) for x in ("2024-01-10", "2024-01-11")])
    asked = ranges(spark, [("2024-01-10", "2024-01-11"), ("2024-01-10", "2024-01-16")], key)
    recorded = ranges(spark, [("2024-01-10", "2024-01-16")], key)
    split = updates.ensure_split(asked, recorded, coverage.present_partitions(rows), calendar)
    assert sorted(
        (str(r.request_end), r.action, str(r.gap_start), str(r.gap_end)) for r in split.collect()
    ) == [
        ("2024-01-11", "serve", "None", "None"),
        ("2024-01-16", "load", "2024-01-12", "2024-01-12"),
        ("2024-01-16", "load", "2024-01-16", "2024-01-16"),
    ]
    assert pairs(asked) and KEY == ["dataset", "symbol", "schema_"]
