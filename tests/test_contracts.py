import pytest
from pyspark.sql import functions as F

from bourselake.operators import contracts
from bourselake.plans import updates

from .conftest import d


@pytest.fixture(scope="module")
def by_symbol(contract):
    rows = contract.filter(F.col("year").between(2008, 2026)).collect()
    return {r.symbol: r for r in rows}


@pytest.mark.parametrize(
    ("symbol", "expiration"),
    [
        ("NQH25", "2025-03-21"), ("ESZ24", "2024-12-20"), ("NQH24", "2024-03-15"),
        ("MNQH26", "2026-03-20"), ("ZNH25", "2025-03-20"), ("ZNZ24", "2024-12-19"),
        ("ZNH24", "2024-03-19"), ("GCJ25", "2025-04-28"), ("GCG24", "2024-02-27"),
        ("GCG25", "2025-02-26"), ("GCZ24", "2024-12-27"), ("NQH08", "2008-03-20"),
        ("NQM26", "2026-06-19"), ("ZNM25", "2025-06-19"), ("ZNZ21", "2021-12-21"),
    ],
)
def test_expirations(by_symbol, symbol, expiration):
    assert str(by_symbol[symbol].expiration) == expiration


@pytest.mark.parametrize(
    ("symbol", "start", "end"),
    [("NQH25", "2024-12-06", "2025-03-21"), ("NQH16", "2015-12-04", "2016-03-18")],
)
def test_windows(by_symbol, symbol, start, end):
    row = by_symbol[symbol]
    assert (str(row.window_start), str(row.expiration)) == (start, end)


def test_rollover_days_move_the_start(spark, calendar):
    dim = contracts.contract_dim(spark, calendar, rollover_days=0)
    assert str(dim.filter("symbol = 'NQH25'").first().window_start) == "2024-12-20"


def test_serial_months_start_at_the_previous_quarter(by_symbol):
    row = by_symbol["GCJ25"]
    assert (row.previous_symbol, row.next_symbol) == ("GCH25", "GCM25")
    assert str(row.window_start) == "2025-03-13"


def test_dimension_has_every_contract_once(contract):
    assert contract.count() == 21 * 12 * 100
    assert contract.select("symbol").distinct().count() == contract.count()
    assert contract.filter("expiration is null or window_start is null").count() == 0


@pytest.mark.parametrize(
    ("root", "day", "front"),
    [
        ("NQ", "2025-03-01", "NQH25"), ("NQ", "2025-03-21", "NQH25"),
        ("NQ", "2025-03-22", "NQM25"), ("ES", "2024-10-01", "ESZ24"),
        ("ES", "2024-12-25", "ESH25"), ("MNQ", "2026-03-22", "MNQM26"),
        ("ZN", "2025-01-15", "ZNH25"), ("GC", "2025-01-15", "GCH25"),
    ],
)
def test_front_month(spark, contract, root, day, front):
    rows = spark.createDataFrame([(root, d(day))], "root string, day date")
    found = contracts.front_month(rows, contract, "day").collect()
    assert [r.front_symbol for r in found] == [front]


def test_front_month_window_is_capped(spark, contract):
    rows = spark.createDataFrame([("NQ", d("2025-03-01"))], "root string, day date")
    row = updates.front_month_windows(rows, contract, d("2025-03-01")).first()
    assert (str(row.window_start), str(row.window_end)) == ("2024-12-06", "2025-02-28")


def test_rows_in_the_overlap_belong_to_two_contracts(spark, contract):
    days = ["2024-12-05", "2024-12-06", "2024-12-20", "2024-12-21"]
    rows = spark.createDataFrame([("NQ", d(x)) for x in days], "root string, day date")
    found = contracts.contract_slice(rows, contract, "day").collect()
    assert sorted((str(r.day), r.symbol) for r in found) == [
        ("2024-12-05", "NQZ24"),
        ("2024-12-06", "NQH25"),
        ("2024-12-06", "NQZ24"),
        ("2024-12-20", "NQH25"),
        ("2024-12-20", "NQZ24"),
        ("2024-12-21", "NQH25"),
    ]


def test_quarterly_contracts(spark):
    spans = spark.createDataFrame(
        [("nq", 2024, 2025), ("VX", 2024, 2024), ("ES", 2025, 2024)],
        "root string, from_year int, to_year int",
    )
    listed = contracts.quarterly_contracts(spans).orderBy("year", "month").collect()
    assert [r.symbol for r in listed] == [
        "NQH24", "NQM24", "NQU24", "NQZ24", "NQH25", "NQM25", "NQU25", "NQZ25",
    ]


def test_contracts_not_begun_are_not_available(spark, contract):
    spans = spark.createDataFrame([("NQ", 2024, 2025)], "root string, from_year int, to_year int")
    listed = updates.available_contracts(spans, contract, d("2024-12-07"))
    ends = {r.symbol: str(r.window_end) for r in listed.collect()}
    assert ends == {
        "NQH24": "2024-03-15", "NQM24": "2024-06-21", "NQU24": "2024-09-20",
        "NQZ24": "2024-12-06", "NQH25": "2024-12-06",
    }


def test_window_joins_are_hash_joins(spark, contract):
    rows = spark.createDataFrame([("NQ", d("2025-03-01"))], "root string, day date")
    plan = contracts.contract_slice(rows, contract, "day")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
