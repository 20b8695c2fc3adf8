"""Exported layouts, bounds from footers, entry files, look-ups inside a day, exceptions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bourselake.operators import calendars, catalog, intervals
from bourselake.operators.coverage import KEY
from bourselake.sources import catalog_store, dimensions, lake, layout

from .conftest import d, ranges, tick_rows

ES = ("GLBX.MDP3", "ES.c.0", "trades")
NQ = ("GLBX.MDP3", "NQH25", "ohlcv-1m")
DAYS = [
    (*ES, "2024-01-05", 1), (*ES, "2024-01-05", 2), (*ES, "2024-01-08", 3),
    (*NQ, "2024-01-03", 4), (*NQ, "2024-01-30", 5), (*NQ, "2024-03-01", 6),
]


@pytest.fixture
def exported(spark, tmp_path):
    root = str(tmp_path / "layout")
    layout.write_layout(tick_rows(spark, DAYS), root)
    return root


def test_export_is_read_back_with_its_keys(spark, exported):
    got = layout.partition_counts(spark, exported).collect()
    assert {(r.symbol, r.schema_, r.year, r.month, r.day, r.n_rows) for r in got} == {
        ("ES_c_0", "trades", 2024, 1, 5, 2),
        ("ES_c_0", "trades", 2024, 1, 8, 1),
        ("NQH25", "ohlcv-1m", 2024, 1, 0, 2),
        ("NQH25", "ohlcv-1m", 2024, 3, 0, 1),
    }
    rows = layout.read_layout(spark, exported)
    assert sorted(r.price for r in rows.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    listed = layout.parse_paths(layout.file_manifest(spark, exported))
    assert listed.agg(F.sum("size_bytes")).first()[0] == sum(r.size_bytes for r in got)


def test_bounds_come_from_footers(spark, exported):
    got = layout.observed_range_files(spark, exported).collect()
    assert {(r.symbol, r.month, r.day): (r.first_date, r.last_date) for r in got} == {
        ("ES_c_0", 1, 5): (d("2024-01-05"), d("2024-01-05")),
        ("ES_c_0", 1, 8): (d("2024-01-08"), d("2024-01-08")),
        ("NQH25", 1, 0): (d("2024-01-03"), d("2024-01-30")),
        ("NQH25", 3, 0): (d("2024-03-01"), d("2024-03-01")),
    }
    by_key = layout.key_bounds(layout.observed_range_files(spark, exported))
    want = catalog.observed_range(tick_rows(spark, DAYS))
    assert sorted(map(tuple, by_key.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("extra", ["int", "array<int>"])
def test_bounds_wherever_the_column_stands(spark, tmp_path, extra):
    """Other columns before it, of other types and with parts, do not take its place."""
    root = str(tmp_path / "wide")
    value = F.lit(7) if extra == "int" else F.array(F.lit(7), F.lit(8))
    rows = tick_rows(spark, DAYS)
    rows = rows.select(
        "trade_date", value.cast(extra).alias("extra"), "price", *KEY, "ts_event_ns"
    )
    layout.write_layout(rows, root)
    bounds = layout.key_bounds(layout.observed_range_files(spark, root))
    want = catalog.observed_range(rows)
    assert sorted(map(tuple, bounds.collect())) == sorted(map(tuple, want.collect()))


def test_footer_plan_reads_no_rows(spark, exported):
    settings = {name: spark.conf.get(name, None) for name in layout.FOOTER_SETTINGS}
    with layout.footers_answer(spark):
        plan = layout.footer_bounds(spark, exported, "ts_event_ns")
        text = plan._jdf.queryExecution().toString()
    assert "PushedAggregation: [MIN(ts_event_ns), MAX(ts_event_ns)]" in text
    assert {name: spark.conf.get(name, None) for name in settings} == settings


def test_bounds_of_nulls_and_empty_files(spark, tmp_path):
    rows = tick_rows(spark, DAYS)
    nulls = rows.withColumn("ts_event_ns", F.lit(None).cast("bigint"))
    layout.write_layout(nulls, str(tmp_path / "nulls"))
    got = layout.observed_range_files(spark, str(tmp_path / "nulls")).collect()
    assert len(got) == 4
    assert {(r.first_date, r.last_date) for r in got} == {(None, None)}
    layout.write_layout(rows.limit(0), str(tmp_path / "empty"))
    assert layout.observed_range_files(spark, str(tmp_path / "empty")).count() == 0


def test_entry_files_round_trip(spark, tmp_path):
    held = ranges(spark, [("2024-01-02", "2024-01-05"), ("2024-02-01", "2024-02-03")], ES)
    span = F.struct(F.col("range_start").alias("start"), F.col("range_end").alias("end"))
    entries = held.groupBy(*KEY).agg(F.sort_array(F.collect_list(span)).alias("ranges"))
    entries = entries.withColumns(
        {"stype": F.lit("continuous"), "updated_at": F.lit(datetime(2024, 2, 4))}
    )
    root = tmp_path / "entries"
    catalog_store.write_entry_files(entries, str(root))
    files = list(root.rglob("*.json"))
    assert len(files) == 1
    assert "in_symbol=ES_c_0" in str(files[0])
    assert len(files[0].read_text().splitlines()) > 5
    back = catalog.entry_ranges(catalog_store.read_entry_files(spark, str(root)))
    assert sorted(map(tuple, back.select(*held.columns).collect())) == sorted(
        map(tuple, held.collect())
    )


def test_one_symbol_reads_a_fraction_of_a_day(spark, lake_path, monkeypatch):
    """Of 200,000 rows of 50 symbols in one folder, one symbol reads less than a tenth."""
    monkeypatch.setitem(lake.LOOK_UPS, "parquet.block.size", str(64 << 10))
    lake.create(spark, lake_path, 1)
    rows = spark.range(200_000).select(
        F.lit("GLBX.MDP3").alias("dataset"),
        F.concat(F.lit("S"), F.col("id") % 50).alias("symbol"),
        F.lit("trades").alias("schema_"),
        F.col("id").alias("ts_event_ns"),
        F.lit(d("2024-01-05")).alias("trade_date"),
        F.rand(7).alias("price"),
    )
    lake.write_partitions(lake.with_partitions(rows), lake_path)
    found = lake.read_lake(spark, lake_path, symbols=["S7"]).drop("dataset")
    assert len(found.collect()) == 4_000
    node = found._jdf.queryExecution().executedPlan()
    while not node.children().isEmpty():
        node = node.children().head()
    assert node.metrics().apply("numOutputRows").value() < 20_000


def island_rows(spark, key, days):
    return tick_rows(spark, [(*key, day, 1) for day in days])


@pytest.mark.parametrize(
    ("key", "days"),
    [
        (ES, ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-03", "2024-03-01"]),
        (ES, ["2024-02-29", "2024-03-01", "2024-03-01", "2023-12-31", "2024-01-01"]),
        (NQ, ["2024-01-03", "2024-02-09", "2024-04-02", "2024-12-30", "2025-01-02"]),
        (NQ, ["2024-01-03"]),
    ],
)
def test_islands_of_fix_are_those_of_windows(spark, key, days):
    rows = island_rows(spark, key, days)
    nothing = ranges(spark, [], ES)
    got = catalog.fix_catalog(nothing, rows, single_range=False).drop("stype")
    want = catalog.observed_ranges(rows)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, want.select(got.columns).collect())
    )


def test_fix_keeps_right_and_rowless_keys(spark):
    held = ranges(spark, [("2024-01-02", "2024-01-03")], ES).unionByName(
        ranges(spark, [("2024-01-01", "2024-01-09"), ("2024-05-01", "2024-05-02")], NQ)
    )
    rows = island_rows(spark, ES, ["2024-01-02", "2024-01-03"])
    got = catalog.fix_catalog(held, rows, single_range=False).drop("stype")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, held.collect()))
    empty = catalog.fix_catalog(held.limit(0), rows.limit(0), single_range=False)
    assert empty.count() == 0


def test_fix_scans_each_side_once(spark):
    rows = island_rows(spark, ES, ["2024-01-02"])
    plan = catalog.fix_catalog(ranges(spark, [], ES), rows, single_range=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text
    assert "Join" not in text


EXCEPTIONS = """calendar,day,kind,close_clock
XNYS,2024-01-16,closed,
XNYS,2024-01-17,early,11:30
XNYS,2024-01-15,open,
CMES,2024-01-13,open,
CMES,2024-01-15,closed,
CMES,2024-01-15,open,
IEPA,2024-01-16,early,
IEPA,2024-01-17,early,12:00
IEPA,2024-01-17,early,11:00
NONE,2024-01-17,closed,
XNYS,2024-01-18,unheard of,
XNYS,1901-01-18,closed,
"""


def test_exceptions_override_rules(spark, tmp_path):
    (tmp_path / "exceptions.csv").write_text(EXCEPTIONS)
    known = dimensions.read_exceptions(spark, str(tmp_path / "exceptions.csv"))
    near = F.col("day").between("2024-01-10", "2024-01-20")
    found = calendars.calendar_day(spark, known).filter(near).collect()
    rules = calendars.calendar_day(spark).filter(near).collect()
    table = {(r.calendar, str(r.day)): r for r in found}
    assert len(table) == len(found) == len(rules)
    assert not table["XNYS", "2024-01-16"].is_session
    assert table["XNYS", "2024-01-16"].close_utc is None
    assert table["XNYS", "2024-01-16"].next_session == d("2024-01-17")
    assert table["XNYS", "2024-01-17"].is_early_close
    assert table["XNYS", "2024-01-17"].close_utc == datetime(2024, 1, 17, 16, 30)
    assert table["XNYS", "2024-01-15"].is_session
    assert table["XNYS", "2024-01-15"].close_utc == datetime(2024, 1, 15, 21, 0)
    assert table["CMES", "2024-01-13"].is_session
    assert not table["CMES", "2024-01-15"].is_session
    assert table["IEPA", "2024-01-16"].close_utc == datetime(2024, 1, 16, 18, 0)
    assert table["IEPA", "2024-01-17"].close_utc == datetime(2024, 1, 17, 16, 0)
    named = {tuple(line.split(",")[:2]) for line in EXCEPTIONS.splitlines()}
    flags = ("is_session", "is_early_close", "open_utc", "close_utc")
    for row in rules:
        if (row.calendar, str(row.day)) not in named - {("XNYS", "2024-01-18")}:
            mine = table[row.calendar, str(row.day)]
            assert [mine[f] for f in flags] == [row[f] for f in flags]


def test_no_exceptions_change_nothing(spark):
    nothing = spark.createDataFrame([], "calendar string, day date, kind string, close_clock string")
    near = F.col("day").between("2024-01-01", "2024-03-31")
    changed = calendars.calendar_day(spark, nothing).filter(near)
    rules = calendars.calendar_day(spark).filter(near)
    assert sorted(map(tuple, changed.collect()), key=str) == sorted(
        map(tuple, rules.collect()), key=str
    )


def test_join_runs_of_nothing(spark):
    empty = spark.createDataFrame([([],)], "months array<struct<month_no:int,day_mask:bigint>>")
    runs = empty.select(intervals.mask_runs(F.col("months"), F.lit(True)).alias("r"))
    assert runs.select(intervals.join_runs(F.col("r")).alias("j")).first().j == []


def _stored(spark, path):
    rows = catalog_store.load_catalog(spark, path).collect()
    return sorted((r.symbol, str(r.range_start), str(r.range_end)) for r in rows)


def test_a_change_writes_its_keys_only_and_is_the_same_when_compacted(spark, tmp_path):
    path = str(tmp_path / "catalog")
    es, nq = ES, ("GLBX.MDP3", "NQ.c.0", "trades")
    both = ranges(spark, [("2024-01-01", "2024-01-05")], es).unionByName(
        ranges(spark, [("2024-01-02", "2024-01-03"), ("2024-01-08", "2024-01-09")], nq)
    )
    assert catalog_store.save_catalog(spark, both, path) == 1
    new = ranges(spark, [("2024-01-01", "2024-01-10"), ("2024-02-01", "2024-02-02")], es)
    assert catalog_store.append_changes(spark, new, new, path, KEY) == 2
    assert [r.symbol for r in spark.read.parquet(f"{path}/change=2").collect()] == ["ES.c.0"]
    wanted = [
        ("ES.c.0", "2024-01-01", "2024-01-10"), ("ES.c.0", "2024-02-01", "2024-02-02"),
        ("NQ.c.0", "2024-01-02", "2024-01-03"), ("NQ.c.0", "2024-01-08", "2024-01-09"),
    ]
    assert _stored(spark, path) == wanted
    # A touched key without rows is deleted; of two changes of a key the later one counts.
    gone = ranges(spark, [("2024-01-01", "2024-01-01")], nq)
    catalog_store.append_changes(spark, new.filter("range_start < '2024-02-01'"), new, path, KEY)
    catalog_store.append_changes(spark, gone.limit(0), gone, path, KEY)
    assert _stored(spark, path) == wanted[:1]
    # A change that did not finish is not seen.
    (tmp_path / "catalog" / "change=5").mkdir()
    assert _stored(spark, path) == wanted[:1]
    assert not catalog_store.compact(spark, path)
    assert catalog_store.compact(spark, path, share=0.0, least=0)
    assert _stored(spark, path) == wanted[:1]
    assert not catalog_store.compact(spark, path, share=0.0, least=0)
    # Changes in the version are dropped with the version before it.
    catalog_store.save_catalog(spark, catalog_store.load_catalog(spark, path), path)
    assert not list((tmp_path / "catalog").glob("change=[2-4]"))
    assert _stored(spark, path) == wanted[:1]


def test_a_table_may_start_with_a_change(spark, tmp_path):
    path = str(tmp_path / "catalog")
    one = ranges(spark, [("2024-01-01", "2024-01-05")], ES)
    assert catalog_store.append_changes(spark, one, one, path, KEY) == 1
    assert _stored(spark, path) == [("ES.c.0", "2024-01-01", "2024-01-05")]
    assert catalog_store.load_catalog(spark, path).columns == one.columns
