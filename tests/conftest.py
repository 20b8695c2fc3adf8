from __future__ import annotations

from datetime import date

import pytest

from bourselake.operators import calendars, contracts
from bourselake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        8,
        **{
            "spark.driver.memory": "6g",
            "spark.default.parallelism": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def calendar(spark):
    return calendars.calendar_day(spark).persist()


@pytest.fixture(scope="session")
def contract(spark, calendar):
    return contracts.contract_dim(spark, calendar).persist()


@pytest.fixture
def lake_path(tmp_path):
    return str(tmp_path / "lake")


def d(text: str) -> date:
    return date.fromisoformat(text)


KEYED = "dataset string, symbol string, schema_ string, "


def ranges(spark, rows, key=("GLBX.MDP3", "ES.c.0", "ohlcv-1d")):
    """(start, end) pairs of one key as a range table."""
    return spark.createDataFrame(
        [(*key, d(a), d(b)) for a, b in rows],
        KEYED + "range_start date, range_end date",
    )


def pairs(rows, start="range_start", end="range_end"):
    return sorted((str(r[start]), str(r[end])) for r in rows.collect())


def tick_rows(spark, rows):
    """(dataset, symbol, schema_, day, price) rows with event time at noon."""
    from bourselake.functions.eventtime import day_start_nanos

    noon = 12 * 3600 * 10**9
    return spark.createDataFrame(
        [
            (ds, sy, sc, day_start_nanos(d(day)) + noon, d(day), float(price))
            for ds, sy, sc, day, price in rows
        ],
        KEYED + "ts_event_ns bigint, trade_date date, price double",
    )
