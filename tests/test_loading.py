"""The load job on a store: status, gaps, reloads, clearing and repair together."""

from datetime import datetime

import pytest

from bourselake.operators import catalog, coverage
from bourselake.plans import loading, updates
from bourselake.sources import lake
from bourselake.streaming import ingest

from .conftest import KEYED, d, pairs, ranges, tick_rows

BARS = ("GLBX.MDP3", "ES.c.0", "ohlcv-1m")
TRADES = ("GLBX.MDP3", "NQ.c.0", "trades")
NOW = datetime(2024, 2, 1)


@pytest.fixture
def store(spark, tmp_path):
    """Bars recorded to mid-January, and two sessions of trades."""
    rows = [(*BARS, "2024-01-02", 1), (*BARS, "2024-01-15", 2)]
    rows += [(*TRADES, "2024-01-08", 3), (*TRADES, "2024-01-09", 4)]
    known = ranges(spark, [("2024-01-01", "2024-01-15")], BARS).unionByName(
        ranges(spark, [("2024-01-08", "2024-01-09")], TRADES)
    )
    return loading.start_store(spark, str(tmp_path / "store"), tick_rows(spark, rows), known, NOW)


def landing(spark):
    days = [f"2024-01-{i:02}" for i in (2, 8, 9, 10, 15, 17, 19)]
    return tick_rows(spark, [(*k, x, 100) for k in (BARS, TRADES) for x in days])


def status(store, calendar, asked, **options):
    row = coverage.coverage_status(
        asked, store.recorded(), store.present(), calendar, **options
    ).first()
    return row.status, row.total_partitions, row.cached_partitions


def test_a_part_filled_month_is_not_complete(spark, store, calendar):
    asked = ranges(spark, [("2024-01-16", "2024-01-20")], BARS)
    assert status(store, calendar, asked) == ("EMPTY", 1, 0)
    split = updates.ensure_split(asked, store.recorded(), store.present(), calendar).collect()
    assert [(r.action, str(r.gap_start), str(r.gap_end)) for r in split] == [
        ("load", "2024-01-16", "2024-01-20")
    ]
    inside = ranges(spark, [("2024-01-03", "2024-01-10")], BARS)
    assert status(store, calendar, inside) == ("COMPLETE", 1, 1)


def test_files_are_verified_on_request(spark, store, calendar):
    asked = ranges(spark, [("2024-01-10", "2024-01-10")], TRADES)
    known = ranges(spark, [("2024-01-01", "2024-01-31")], TRADES)
    for verify, wanted in ((True, "EMPTY"), (False, "COMPLETE")):
        row = coverage.coverage_status(
            asked, known, store.present(), calendar, verify_files=verify
        ).first()
        assert row.status == wanted


def test_the_job_completes_a_month_and_loses_nothing(spark, store, calendar):
    asked = ranges(spark, [("2024-01-16", "2024-01-20")], BARS).unionByName(
        ranges(spark, [("2024-01-08", "2024-01-12")], TRADES)
    )
    loaded = loading.load_job(store, asked, landing(spark), calendar, NOW)
    assert sorted((r.schema_, r.month, r.day, r.n_rows) for r in loaded.collect()) == [
        ("ohlcv-1m", 1, 0, 7), ("trades", 1, 10, 1),
    ]
    # The whole month was brought again from its first recorded day.
    bars = store.rows().filter("schema_ = 'ohlcv-1m'")
    assert sorted((str(r.trade_date), r.price) for r in bars.collect()) == [
        (f"2024-01-{i:02}", 100.0) for i in (2, 8, 9, 10, 15, 17, 19)
    ]
    recorded = store.recorded()
    assert pairs(recorded.filter("schema_ = 'ohlcv-1m'")) == [("2024-01-01", "2024-01-20")]
    # Sessions without rows stay unrecorded.
    assert pairs(recorded.filter("schema_ = 'trades'")) == [("2024-01-08", "2024-01-10")]
    assert status(store, calendar, ranges(spark, [("2024-01-16", "2024-01-20")], BARS))[0] == "COMPLETE"
    again = loading.load_job(store, asked, landing(spark), calendar, NOW)
    assert again.count() == 0
    rebuilt = coverage.present_partitions(store.rows())
    assert sorted(map(tuple, rebuilt.select(*coverage.KEY, "bucket", "slot_mask").collect())) == sorted(
        map(tuple, store.present().select(*coverage.KEY, "bucket", "slot_mask").collect())
    )


def test_the_first_job_starts_from_nothing(spark, tmp_path, calendar):
    store = loading.Store(spark, str(tmp_path / "new"))
    asked = ranges(spark, [("2024-01-08", "2024-01-10")], TRADES)
    assert loading.load_job(store, asked, landing(spark), calendar, NOW).count() == 3
    assert status(store, calendar, asked) == ("COMPLETE", 3, 3)


def test_clearing_keeps_rows_catalog_and_presence_true(spark, store, calendar):
    loading.clear(store, ranges(spark, [("2024-01-09", "2024-01-15")], BARS), NOW)
    loading.clear(store, ranges(spark, [("2024-01-08", "2024-01-08")], TRADES), NOW)
    assert pairs(store.recorded().filter("schema_ = 'ohlcv-1m'")) == [("2024-01-01", "2024-01-08")]
    assert pairs(store.recorded().filter("schema_ = 'trades'")) == [("2024-01-09", "2024-01-09")]
    masks = {r.schema_: r.slot_mask for r in store.present().collect()}
    assert masks == {"ohlcv-1m": 1, "trades": 1 << 8}


def test_stale_ranges_are_dropped(spark, store, calendar):
    known = ranges(spark, [("2024-01-08", "2024-01-09"), ("2024-01-16", "2024-01-18")], TRADES)
    store.save(known, store.present(), NOW)
    stale = loading.verify_and_fix(store, calendar, NOW)
    assert pairs(stale) == [("2024-01-16", "2024-01-18")]
    assert pairs(store.recorded()) == [("2024-01-08", "2024-01-09")]


def test_updates_report_what_was_loaded(spark, store, calendar):
    plan = spark.createDataFrame(
        [
            (*TRADES, "due", d("2024-01-10"), d("2024-01-12")),
            (*BARS, "up_to_date", None, None),
            ("GLBX.MDP3", "YM.c.0", "trades", "due", d("2024-01-10"), d("2024-01-12")),
        ],
        KEYED + "state string, range_start date, range_end date",
    )
    done = loading.update_all(store, plan, landing(spark), calendar, NOW)
    assert {r.symbol: (r.outcome, r.n_rows) for r in done.collect()} == {
        "NQ.c.0": ("updated", 1), "ES.c.0": ("up_to_date", 0), "YM.c.0": ("error", 0),
    }


def test_fixing_makes_the_catalog_valid(spark):
    rows = tick_rows(spark, [(*TRADES, x, 1) for x in ("2024-01-08", "2024-01-10", "2024-01-19")])
    known = ranges(spark, [("2024-01-08", "2024-01-08"), ("2024-01-10", "2024-01-31")], TRADES)
    fixed = catalog.fix_catalog(known, rows)
    assert [r.finding for r in catalog.validate_catalog(fixed, rows).collect()] == ["ok"]


def test_requests_without_dates_resolve_or_are_rejected(spark, contract):
    rows = [
        ("NQH24", None, None), ("nqh24", None, None), ("ES.c.0", None, None), ("NQH24", d("2024-01-01"), None),
        ("ES.c.0", d("2024-01-01"), d("2024-01-31")), ("NQH30", None, None),
    ]
    asked = spark.createDataFrame(rows, "symbol string, range_start date, range_end date")
    found = updates.resolve_requests(asked, contract, d("2024-02-01")).collect()
    got = {(r.symbol, str(r.range_end), r.reject_reason) for r in found}
    assert got == {
        ("NQH24", "2024-01-31", None), ("nqh24", "2024-01-31", None), ("ES.c.0", "None", "no_dates"),
        ("NQH24", "None", "one_bound"), ("ES.c.0", "2024-01-31", None), ("NQH30", "None", "not_begun"),
    }


def test_contracts_reach_the_end_of_the_century(contract):
    years = contract.selectExpr("min(year)", "max(year)", "count(*)").first()
    assert tuple(years) == (2000, 2099, 21 * 12 * 100)
    last = contract.filter("symbol = 'NQZ99'").first()
    assert (str(last.expiration), last.next_symbol) == ("2099-12-18", "NQH00")


def agree(store, calendar):
    """Nothing stale, presence as the rows have it, and masks that say what the ranges say."""
    recorded, rows = store.recorded(), store.rows()
    asked = recorded.select(*coverage.KEY, "range_start", "range_end").unionByName(
        recorded.selectExpr(*coverage.KEY, "date_sub(range_start, 5) AS range_start", "date_add(range_end, 9) AS range_end")
    )
    both = [coverage.coverage_status(asked, k, store.present(), calendar) for k in (recorded, store.known())]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    assert "_island" not in both[1]._jdf.queryExecution().optimizedPlan().toString()
    assert catalog.verify_catalog(recorded, store.present(), calendar).count() == 0
    kept = [*coverage.KEY, "bucket", "slot_mask"]
    rebuilt = coverage.present_partitions(rows).select(*kept).collect()
    assert sorted(map(tuple, rebuilt)) == sorted(map(tuple, store.present().select(*kept).collect()))


def valid(store):
    found = catalog.validate_catalog(store.recorded(), store.rows()).collect()
    assert {r.finding for r in found} == {"ok"}


MONTHS = [f"2024-{x}" for x in "01-09 01-10 02-07 02-08 03-06 03-07 04-09 04-10 05-07 05-08".split()]


def five_months(spark):
    asked = ranges(spark, [("2024-01-09", "2024-05-08")], BARS).unionByName(
        spark.createDataFrame([(*TRADES, d(x), d(x)) for x in MONTHS], KEYED + "range_start date, range_end date")
    )
    return asked, tick_rows(spark, [(*k, x, 7) for k in (BARS, TRADES) for x in MONTHS])


def test_a_broken_job_loads_only_the_waves_that_are_left(spark, tmp_path, calendar, monkeypatch):
    store = loading.Store(spark, str(tmp_path / "waves"))
    asked, rows = five_months(spark)
    load, seen = lake.load_days, []

    def breaking(landing, path, days):
        seen.append(sorted({r.month_no % 12 + 1 for r in days.collect()}))
        if len(seen) == 3:
            raise RuntimeError("stopped in the third wave")
        return load(landing, path, days)

    monkeypatch.setattr(lake, "load_days", breaking)
    with pytest.raises(RuntimeError):
        loading.load_job(store, asked, rows, calendar, NOW, waves=5)
    assert [(r.wave, r.n_rows) for r in store.journal().orderBy("wave").collect()] == [(0, 4), (1, 4)]
    agree(store, calendar)
    done = seen[:2]
    loaded = loading.load_job(store, asked, rows, calendar, NOW, waves=5)
    assert done == [[1], [2]] and seen[3:] == [[3], [4], [5]]
    assert sorted({r.month for r in loaded.collect()}) == [3, 4, 5]
    assert store.rows().count() == 20 and store.journal().count() == 5
    agree(store, calendar)
    assert loading.load_job(store, asked, rows, calendar, NOW, waves=5).count() == 0


def test_waves_load_what_one_wave_loads(spark, tmp_path, calendar):
    asked, rows = five_months(spark)
    kept = []
    for waves in (1, 2, 40):
        store = loading.Store(spark, str(tmp_path / f"waves{waves}"))
        loading.load_job(store, asked, rows, calendar, NOW, waves=waves)
        assert store.journal().count() == min(waves, 5)
        kept.append((sorted(map(str, store.rows().collect())), sorted(map(str, store.recorded().collect()))))
    assert kept[0] == kept[1] == kept[2]


def test_notices_of_the_landing_become_issues_in_the_same_job(spark, store, calendar):
    notices = spark.createDataFrame(
        [
            (*TRADES, 1, "reduced quality: 2024-01-10 (missing), 2024-01-11. See."),
            (*TRADES, 2, "reduced quality: 2024-01-10 (pending)."),
            ("GLBX.MDP3", "YM.c.0", "trades", 1, "reduced quality: 2024-01-10 (missing)."),
        ],
        KEYED + "arrival bigint, text string",
    )
    asked = ranges(spark, [("2024-01-08", "2024-01-12")], TRADES)
    for _ in range(2):
        loading.load_job(store, asked, landing(spark), calendar, NOW, notices=notices)
        found = store.issues().collect()
        assert sorted((r.symbol, str(r.issue_date), r.issue_type) for r in found) == [
            ("NQ.c.0", "2024-01-10", "missing"), ("NQ.c.0", "2024-01-11", "degraded"),
        ]


def test_ensure_loads_and_serves_in_one_call(spark, store, calendar):
    asked = ranges(spark, [("2024-01-08", "2024-01-10")], TRADES).unionByName(
        ranges(spark, [("2024-01-11", "2024-01-12")], TRADES)
    )
    served = loading.ensure(store, asked, landing(spark), calendar, NOW)
    # Of the second window nothing has landed, so it is not served.
    assert sorted((str(r.trade_date), r.price) for r in served.collect()) == [
        ("2024-01-08", 3.0), ("2024-01-09", 4.0), ("2024-01-10", 100.0),
    ]
    agree(store, calendar)


def test_rolls_are_carried_out(spark, tmp_path, calendar, contract):
    old, new = (("GLBX.MDP3", s, "ohlcv-1d") for s in ("NQH24", "NQM24"))
    last = contract.filter("symbol = 'NQH24'").first()
    rows = tick_rows(spark, [(*old, str(last.window_start), 1), (*old, str(last.expiration), 2)])
    known = ranges(spark, [(str(last.window_start), str(last.expiration))], old)
    store = loading.start_store(spark, str(tmp_path / "rolls"), rows, known, NOW)
    arriving = tick_rows(spark, [(*new, "2024-04-02", 5), (*new, "2024-05-02", 6)])
    done = loading.roll_all(store, contract, arriving, calendar, d("2024-06-01"), NOW).collect()
    assert [(r.symbol, r.outcome, r.n_rows) for r in done] == [("NQM24", "rolled", 2)]
    assert loading.roll_all(store, contract, arriving, calendar, d("2024-06-01"), NOW).count() == 0


def test_a_stream_keeps_its_store_true(spark, tmp_path, calendar, monkeypatch):
    """Lake, presence and recorded days agree after each call, also after a stopped one."""
    place, state = str(tmp_path / "landing"), str(tmp_path / "state")
    store = loading.Store(spark, str(tmp_path / "store"))

    def take(rows):
        rows.coalesce(1).write.mode("append").parquet(place)
        ingest.ingest_into_store(store, place, rows.schema, lambda r: r, state, NOW, max_files=1)

    take(tick_rows(spark, [(*k, f"2024-01-{i:02}", i) for k in (BARS, TRADES) for i in (8, 9, 10, 11)]))
    agree(store, calendar)
    valid(store)
    assert pairs(store.recorded().filter("schema_ = 'trades'")) == [("2024-01-08", "2024-01-11")]
    # The month of bars is delivered again, shorter; what it had before is not known any more.
    with monkeypatch.context() as broken:
        broken.setattr(loading, "record_delivery", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            take(tick_rows(spark, [(*BARS, "2024-01-09", 90), (*TRADES, "2024-01-12", 12)]))
    take(tick_rows(spark, [(*TRADES, "2024-01-10", 100)]))
    agree(store, calendar)
    valid(store)
    assert pairs(store.recorded().filter("schema_ = 'ohlcv-1m'")) == [("2024-01-09", "2024-01-09")]
    assert pairs(store.recorded().filter("schema_ = 'trades'")) == [("2024-01-08", "2024-01-12")]
    prices = sorted(r.price for r in store.rows().filter("schema_ = 'trades'").collect())
    assert prices == [8.0, 9.0, 11.0, 12.0, 100.0]
    asked = ranges(spark, [("2024-01-08", "2024-01-12")], TRADES)
    assert status(store, calendar, asked)[0] == "COMPLETE"
