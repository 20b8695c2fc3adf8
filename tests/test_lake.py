import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bourselake.functions import eventtime
from bourselake.operators import catalog, coverage
from bourselake.operators.coverage import KEY
from bourselake.sources import catalog_store, lake, layout
from bourselake.streaming import ingest

from .conftest import d, pairs, ranges, tick_rows

ES = ("GLBX.MDP3", "ES.c.0", "trades")
NQ = ("GLBX.MDP3", "NQ.c.0", "trades")
BARS = ("GLBX.MDP3", "ES.c.0", "ohlcv-1d")


def write(spark, path, rows):
    lake.write_partitions(lake.with_partitions(tick_rows(spark, rows)), path)


def held(spark, path):
    rows = lake.read_lake(spark, path).collect()
    return sorted((r.symbol, r.schema_, str(r.trade_date), r.price) for r in rows)


def test_window_is_inclusive_and_prunes(spark, lake_path):
    days = [f"2024-01-{i:02}" for i in range(1, 31)]
    write(spark, lake_path, [(*ES, x, 1) for x in days] + [(*BARS, x, 2) for x in days])
    rows = lake.read_lake(spark, lake_path, d("2024-01-10"), d("2024-01-12"))
    got = sorted((r.schema_, str(r.trade_date)) for r in rows.collect())
    assert got == [(s, f"2024-01-{i}") for s in ("ohlcv-1d", "trades") for i in (10, 11, 12)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts_event_ns), GreaterThanOrEqual(ts_event_ns" in plan
    assert "PartitionFilters: [isnotnull(year" in plan


def test_last_nanosecond_of_the_day_is_inside(spark):
    last = eventtime.day_start_nanos(d("2024-01-11")) - 1
    rows = spark.createDataFrame([(last,), (last + 1,)], "ts_event bigint")
    kept = lake.date_window(rows, d("2024-01-10"), d("2024-01-10")).collect()
    assert [r[0] for r in kept] == [last]
    dates = lake.normalise(rows).orderBy("ts_event_ns").collect()
    assert [str(r.trade_date) for r in dates] == ["2024-01-10", "2024-01-11"]


def test_dates_before_1970_floor(spark):
    rows = spark.createDataFrame([(-1,), (0,), (-eventtime.NANOS_PER_DAY,)], "ts bigint")
    got = {r.ts: str(r.trade_date) for r in lake.normalise(rows).collect()}
    assert got == {-1: "1969-12-31", 0: "1970-01-01", -eventtime.NANOS_PER_DAY: "1969-12-31"}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "decimal(20,0)"])
def test_any_kind_of_event_time(spark, kind):
    noon = eventtime.day_start_nanos(d("2024-01-10")) + 12 * 3600 * 10**9
    base = spark.createDataFrame([(noon,)], "n bigint")
    if kind == "decimal(20,0)":
        rows = base.select(F.col("n").cast(kind).alias("ts_event"))
    else:
        text = F.lit("2024-01-10 12:00:00")
        rows = base.select(text.cast(kind).alias("ts_event"))
    row = lake.normalise(rows).first()
    assert (row.ts_event_ns, str(row.trade_date)) == (noon, "2024-01-10")
    assert lake.date_window(rows, d("2024-01-10"), d("2024-01-10")).count() == 1
    assert lake.date_window(rows, d("2024-01-11"), None).count() == 0
    assert lake.date_window(rows, None, d("2024-01-09")).count() == 0


def test_table_without_event_time_passes_through(spark):
    rows = spark.createDataFrame([(1, 2.0)], "other_col bigint, price double")
    assert lake.date_window(rows, d("2024-01-01"), d("2024-01-02")).count() == 1
    with pytest.raises(ValueError, match="event-time"):
        lake.normalise(rows)


def test_nanosecond_parquet_reads_as_bigint(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    values = pa.array([10**18 + 7], pa.timestamp("ns"))
    pq.write_table(pa.table({"ts_event": values}), str(tmp_path / "ns.parquet"))
    row = lake.normalise(spark.read.parquet(str(tmp_path / "ns.parquet"))).first()
    assert (row.ts_event_ns, str(row.trade_date)) == (10**18 + 7, "2001-09-09")


def test_replace_touches_only_its_partitions(spark, lake_path):
    write(spark, lake_path, [(*ES, "2024-01-10", 1), (*ES, "2024-01-11", 1)])
    write(spark, lake_path, [(*ES, "2024-01-11", 5), (*NQ, "2024-01-11", 6)])
    expected = [
        ("ES.c.0", "trades", "2024-01-10", 1.0),
        ("ES.c.0", "trades", "2024-01-11", 5.0),
        ("NQ.c.0", "trades", "2024-01-11", 6.0),
    ]
    assert held(spark, lake_path) == expected
    write(spark, lake_path, [(*ES, "2024-01-11", 5), (*NQ, "2024-01-11", 6)])
    assert held(spark, lake_path) == expected


def test_load_missing_twice_changes_nothing(spark, lake_path, calendar):
    landing = [(*k, f"2024-01-{i:02}", i) for k in (ES, NQ) for i in range(8, 13)]
    write(spark, lake_path, [(*ES, "2024-01-08", 0), (*NQ, "2024-01-09", 0)])
    asked = ranges(spark, [("2024-01-08", "2024-01-10")], ES).unionByName(
        ranges(spark, [("2024-01-09", "2024-01-11")], NQ)
    )
    for again in (False, True):
        missing = coverage.missing_partitions(
            asked,
            coverage.present_partitions(lake.read_lake(spark, lake_path)),
            calendar,
        )
        counts = lake.load_missing(spark, tick_rows(spark, landing), lake_path, missing)
        assert counts.count() == (0 if again else 4)
        # What was there stays, also in folders that got new rows.
        assert held(spark, lake_path) == [
            ("ES.c.0", "trades", "2024-01-08", 0.0),
            ("ES.c.0", "trades", "2024-01-09", 9.0),
            ("ES.c.0", "trades", "2024-01-10", 10.0),
            ("NQ.c.0", "trades", "2024-01-09", 0.0),
            ("NQ.c.0", "trades", "2024-01-10", 10.0),
            ("NQ.c.0", "trades", "2024-01-11", 11.0),
        ]


def test_delete_keeps_other_symbols_and_drops_empty_folders(spark, lake_path):
    write(
        spark,
        lake_path,
        [(*ES, "2024-01-10", 1), (*ES, "2024-01-11", 1), (*NQ, "2024-01-11", 2),
         (*BARS, "2024-01-05", 3), (*BARS, "2024-01-25", 4)],
    )
    windows = ranges(spark, [("2024-01-10", "2024-01-11")], ES).unionByName(
        ranges(spark, [("2024-01-01", "2024-01-15")], BARS)
    )
    deleted = lake.delete_windows(spark, lake_path, windows)
    assert sorted((r.schema_, r.month, r.day) for r in deleted.collect()) == [
        ("ohlcv-1d", 1, 0), ("trades", 1, 10), ("trades", 1, 11),
    ]
    assert held(spark, lake_path) == [
        ("ES.c.0", "ohlcv-1d", "2024-01-25", 4.0),
        ("NQ.c.0", "trades", "2024-01-11", 2.0),
    ]
    folders = {r.day for r in lake.read_lake(spark, lake_path).select("day").distinct().collect()}
    assert folders == {0, 11}
    assert not os.path.exists(f"{lake_path}/dataset=GLBX.MDP3/schema_=trades/year=2024/month=1/day=10")


def test_files_are_read_together(spark, tmp_path):
    assert lake.read_files(spark, []).count() == 0
    for i, name in enumerate(("b", "a")):
        tick_rows(spark, [(*ES, f"2024-01-1{i}", i)]).write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("b", "a")]
    assert lake.read_files(spark, paths).count() == 2
    assert lake.read_files(spark, paths, start=d("2024-01-11")).first().price == 1.0


def test_rows_in_windows_come_once(spark):
    rows = tick_rows(spark, [(*ES, f"2024-01-{i:02}", i) for i in range(1, 20)])
    windows = ranges(spark, [("2024-01-03", "2024-01-05"), ("2024-01-04", "2024-01-06")], ES)
    kept = lake.rows_in_windows(rows, windows).collect()
    assert sorted(r.price for r in kept) == [3.0, 4.0, 5.0, 6.0]


def test_layout_is_read_with_keys_from_paths(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    daily = tmp_path / "GLBX.MDP3" / "ES_c_0" / "trades" / "2024" / "01"
    monthly = tmp_path / "GLBX.MDP3" / "NQH25" / "ohlcv-1m" / "2025"
    daily.mkdir(parents=True)
    monthly.mkdir(parents=True)
    pq.write_table(pa.table({"ts_event": [1, 2]}), daily / "05.parquet")
    pq.write_table(pa.table({"ts_event": [3]}), monthly / "03.parquet")
    got = sorted(tuple(r) for r in layout.read_layout(spark, str(tmp_path)).collect())
    assert got == [
        (1, "GLBX.MDP3", "ES_c_0", "trades", 2024, 1, 5),
        (2, "GLBX.MDP3", "ES_c_0", "trades", 2024, 1, 5),
        (3, "GLBX.MDP3", "NQH25", "ohlcv-1m", 2025, 3, 0),
    ]
    files = layout.parse_paths(layout.file_manifest(spark, str(tmp_path)))
    sizes = layout.size_rollup(files, KEY).collect()
    assert {(r.symbol, r.n_files): r.size_bytes for r in sizes} == {
        ("ES_c_0", 1): (daily / "05.parquet").stat().st_size,
        ("NQH25", 1): (monthly / "03.parquet").stat().st_size,
    }


def test_entry_files_are_imported(spark, tmp_path):
    folder = tmp_path / "GLBX.MDP3" / "ES_c_0" / "ohlcv-1m"
    folder.mkdir(parents=True)
    entry = {
        "dataset": "GLBX.MDP3",
        "symbol": "ES.c.0",
        "stype": "continuous",
        "schema": "ohlcv-1m",
        "ranges": [
            {"start": "2024-01-01", "end": "2024-01-31"},
            {"start": "2024-03-01", "end": "2024-03-31"},
        ],
        "updated_at": "2024-04-01 00:00:00+00:00",
        "cache_version": 1,
        "contract_specs": None,
        "quality_issues": [{"date": "2024-01-05", "issue_type": "degraded", "message": None}],
    }
    (folder / "meta.json").write_text(json.dumps(entry, indent=2))
    entries = catalog_store.read_entry_files(spark, str(tmp_path))
    assert entries.first().quality_issues[0].issue_type == "degraded"
    long = catalog.entry_ranges(entries)
    assert pairs(long) == [("2024-01-01", "2024-01-31"), ("2024-03-01", "2024-03-31")]
    assert long.first().stype == "continuous"


def test_catalog_versions(spark, tmp_path):
    path = str(tmp_path / "catalog")
    with pytest.raises(FileNotFoundError):
        catalog_store.load_catalog(spark, path)
    one = catalog.build_catalog(
        tick_rows(spark, [(*ES, "2024-01-10", 1), (*NQ, "2024-01-10", 1)]), datetime(2024, 2, 1)
    )
    assert catalog_store.save_catalog(spark, one, path) == 1
    rows = tick_rows(spark, [(*ES, "2024-01-10", 1), (*ES, "2024-01-11", 1)])
    two = catalog.refresh_catalog(
        catalog_store.load_catalog(spark, path), rows, rows, datetime(2024, 2, 2)
    )
    assert catalog_store.save_catalog(spark, two, path) == 2
    # A version whose job did not finish is not seen.
    os.makedirs(f"{path}/version=3")
    stored = catalog_store.load_catalog(spark, path)
    assert sorted((r.symbol, str(r.range_end), r.updated_at.day) for r in stored.collect()) == [
        ("ES.c.0", "2024-01-11", 2), ("NQ.c.0", "2024-01-10", 1),
    ]


def test_stream_equals_batch_and_takes_files_once(spark, tmp_path):
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    first = tick_rows(spark, [(*ES, f"2024-01-{i:02}", i) for i in range(1, 6)])
    second = tick_rows(spark, [(*ES, f"2024-01-{i:02}", i * 10) for i in range(4, 9)])

    def take():
        ingest.ingest_available(
            spark, landing, first.schema, lambda rows: rows, path, state, max_files=1
        )
        return sorted(
            (str(r.trade_date), r.price) for r in lake.read_lake(spark, path).collect()
        )

    first.repartition(3).write.mode("append").parquet(landing)
    batch = sorted((str(r.trade_date), r.price) for r in first.collect())
    assert take() == batch
    assert take() == batch
    second.coalesce(1).write.mode("append").parquet(landing)
    # Days delivered again replace what was there.
    kept = first.filter("trade_date < '2024-01-04'").union(second)
    assert take() == sorted((str(r.trade_date), r.price) for r in kept.collect())


def test_a_partition_spread_over_micro_batches_is_whole(spark, tmp_path):
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    for price in (1, 2, 3):
        rows = tick_rows(spark, [(*ES, "2024-01-10", price)])
        rows.coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        ingest.ingest_available(spark, landing, rows.schema, lambda r: r, path, state, max_files=1)
        assert sorted(p for *_, p in held(spark, path)) == [1.0, 2.0, 3.0]


def test_a_stopped_ingest_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    rows = tick_rows(spark, [(*ES, "2024-01-10", 1), (*ES, "2024-01-10", 2)])
    rows.repartition(2).write.parquet(landing)

    def take():
        ingest.ingest_available(spark, landing, rows.schema, lambda r: r, path, state, max_files=1)

    with monkeypatch.context() as broken:
        broken.setattr(lake, "write_partitions", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            take()
    take()
    assert sorted(p for *_, p in held(spark, path)) == [1.0, 2.0]


def test_a_call_stopped_after_the_lake_is_written_is_finished_before_new_files(spark, tmp_path, monkeypatch):
    """The old delivery is replaced by the new one, as if the call had not been stopped."""
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    first = tick_rows(spark, [(*ES, "2024-01-10", 3), (*ES, "2024-01-11", 3)])
    first.coalesce(1).write.mode("append").parquet(landing)

    def take():
        ingest.ingest_available(spark, landing, first.schema, lambda r: r, path, state, max_files=1)

    for step in ("drop_path", "Commits.add"):
        with monkeypatch.context() as broken:
            if step == "drop_path":
                broken.setattr(ingest, "drop_path", lambda *_: 1 / 0)
            else:
                add = ingest.Commits.add
                broken.setattr(ingest.Commits, "add", lambda self, s, n: 1 / 0 if s == "done" else add(self, s, n))
            with pytest.raises(ZeroDivisionError):
                take()
        again = tick_rows(spark, [(*ES, "2024-01-10", 4)])
        again.coalesce(1).write.mode("append").parquet(landing)
        take()
        assert [(day, p) for _, _, day, p in held(spark, path)] == [("2024-01-10", 4.0), ("2024-01-11", 3.0)]
        take()
        assert len(held(spark, path)) == 2
        first.coalesce(1).write.mode("append").parquet(landing)


def test_of_rows_delivered_twice_in_a_call_the_later_file_stays(spark, tmp_path):
    """Parts of a partition stay whole; rows of one identity come from the latest file."""
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    noon = F.col("ts_event_ns")
    old = tick_rows(spark, [(*ES, "2024-01-10", 1), (*ES, "2024-01-10", 1), (*NQ, "2024-01-10", 1)])
    old.coalesce(1).write.mode("append").parquet(landing)
    time.sleep(1.1)
    new = tick_rows(spark, [(*ES, "2024-01-10", 2)])
    new.union(new.withColumn("ts_event_ns", noon + 1)).coalesce(1).write.mode("append").parquet(landing)
    for name, identity, prices in (("a", [*KEY, "ts_event_ns"], [1, 2, 2]), ("b", None, [1, 1, 1, 2, 2])):
        ingest.ingest_available(
            spark, landing, old.schema, lambda r: r, path + name, state + name, max_files=1, identity=identity
        )
        assert sorted(p for *_, p in held(spark, path + name)) == prices
        assert "_file" not in lake.read_lake(spark, path + name).columns


def test_a_load_keeps_other_symbols_of_the_same_day(spark, lake_path):
    write(spark, lake_path, [(*ES, "2024-01-10", 1), (*NQ, "2024-01-10", 2)])
    again = tick_rows(spark, [(*ES, "2024-01-10", 9), (*ES, "2024-01-10", 8)])
    lake.load_window(again, lake_path, d("2024-01-10"), d("2024-01-10"))
    assert [(s, p) for s, _, _, p in held(spark, lake_path)] == [
        ("ES.c.0", 8.0), ("ES.c.0", 9.0), ("NQ.c.0", 2.0),
    ]


def test_the_first_load_starts_from_nothing(spark, lake_path, calendar):
    landing = tick_rows(spark, [(*ES, "2024-01-10", 1), (*ES, "2024-01-11", 2)])
    nothing = coverage.present_partitions(landing.limit(0))
    asked = ranges(spark, [("2024-01-10", "2024-01-12")], ES)
    missing = coverage.missing_partitions(asked, nothing, calendar)
    assert lake.load_missing(spark, landing, lake_path, missing).count() == 2
    assert len(held(spark, lake_path)) == 2


def test_a_lake_fed_by_a_stream_can_be_loaded_and_cleared(spark, tmp_path, calendar):
    landing, path, state = (str(tmp_path / n) for n in ("landing", "lake", "state"))
    rows = tick_rows(spark, [(*ES, f"2024-01-{i:02}", i) for i in (8, 9)])
    rows.write.parquet(landing)
    ingest.ingest_available(spark, landing, rows.schema, lambda r: r, path, state)
    more = tick_rows(spark, [(*ES, "2024-01-10", 10)])
    missing = coverage.missing_partitions(
        ranges(spark, [("2024-01-08", "2024-01-10")], ES),
        coverage.present_partitions(lake.read_lake(spark, path)),
        calendar,
    )
    lake.load_missing(spark, more, path, missing)
    assert [p for *_, p in held(spark, path)] == [10.0, 8.0, 9.0] or len(held(spark, path)) == 3
    lake.delete_windows(spark, path, ranges(spark, [("2024-01-08", "2024-01-08")], ES))
    assert sorted(p for *_, p in held(spark, path)) == [9.0, 10.0]


def test_nanosecond_files_read_without_a_prepared_session(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    pq.write_table(
        pa.table({"ts_event": pa.array([10**18], pa.timestamp("ns"))}), str(tmp_path / "n.parquet")
    )
    assert lake.read_files(spark, [str(tmp_path / "n.parquet")]).first()[0] == 10**18


def _file_names(path):
    from pathlib import Path

    return {p.relative_to(path).as_posix() for p in Path(path).rglob("*.parquet")}


def test_one_symbol_touches_one_bucket(spark, lake_path):
    """Loading and clearing one symbol leaves the files of other buckets as they are."""
    symbols = [f"S{i}" for i in range(30)]
    days = ["2024-01-08", "2024-01-09"]
    rows = [("GLBX.MDP3", s, "trades", day, 1) for s in symbols for day in days]
    lake.create(spark, lake_path, 16)
    lake.write_partitions(lake.with_partitions(tick_rows(spark, rows)), lake_path)
    n = lake.bucket_count(spark, lake_path)
    assert n == 16
    own = spark.createDataFrame([("S7",)], "symbol string").select(lake.symbol_bucket(F.col("symbol"), n)).first()[0]
    before = _file_names(lake_path)
    again = tick_rows(spark, [("GLBX.MDP3", "S7", "trades", "2024-01-09", 2)])
    lake.write_partitions(lake.with_partitions(again), lake_path)
    loaded = _file_names(lake_path)
    gone = {f for f in before - loaded}
    assert gone and all(f"day=9/symbol_bucket={own}/" in f for f in gone | (loaded - before))
    window = ranges(spark, [("2024-01-08", "2024-01-08")], ("GLBX.MDP3", "S7", "trades"))
    lake.delete_windows(spark, lake_path, window)
    cleared = _file_names(lake_path)
    assert all(f"day=8/symbol_bucket={own}/" in f for f in loaded ^ cleared)
    left = lake.read_lake(spark, lake_path)
    assert left.count() == 59 and left.filter("symbol = 'S7'").first().price == 2.0
    assert lake.BUCKET not in left.columns


def test_reading_one_symbol_opens_its_bucket_only(spark, lake_path):
    rows = [("GLBX.MDP3", f"S{i}", "trades", "2024-01-08", i) for i in range(30)]
    lake.write_partitions(lake.with_partitions(tick_rows(spark, rows)), lake_path)
    found = lake.read_lake(spark, lake_path, symbols=["S7"])
    assert [r.price for r in found.collect()] == [7.0]
    opened = {f.split("symbol_bucket=")[1].split("/")[0] for f in found.inputFiles()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "symbol_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len(opened) >= 1


def test_rows_are_stored_once_before_a_write(spark, lake_path, monkeypatch):
    """The rows go to scratch once; what is carried over goes straight into the lake."""
    from pyspark.sql import DataFrameWriter

    written, write = [], DataFrameWriter.parquet
    rows = tick_rows(spark, [("GLBX.MDP3", s, "trades", "2024-01-08", 1) for s in ("A", "B", "C")])
    lake.write_partitions(lake.with_partitions(rows), lake_path)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **o: (written.append(path), write(self, path, **o)))
    lake.write_partitions(lake.with_partitions(rows.filter("symbol = 'A'")), lake_path)
    assert len(written) == 2 and written[-1] == lake_path


def test_a_lake_that_lost_all_rows_can_be_loaded_again(spark, lake_path):
    rows = tick_rows(spark, [("GLBX.MDP3", "A", "trades", "2024-01-08", 1)])
    lake.write_partitions(lake.with_partitions(rows), lake_path)
    lake.delete_windows(spark, lake_path, ranges(spark, [("2024-01-01", "2024-01-31")], ("GLBX.MDP3", "A", "trades")))
    assert not lake.has_rows(spark, lake_path)
    lake.write_partitions(lake.with_partitions(rows), lake_path)
    assert lake.read_lake(spark, lake_path).count() == 1
