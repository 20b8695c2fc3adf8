from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from bourselake.operators import catalog, coverage, inventory, quality, ranking
from bourselake.operators.coverage import KEY

from .conftest import KEYED, d, pairs, ranges, tick_rows

ES = ("GLBX.MDP3", "ES.c.0", "trades")
NQ = ("GLBX.MDP3", "NQH24", "ohlcv-1d")


def test_catalog_is_built_by_grain(spark):
    rows = tick_rows(
        spark,
        [(*ES, x, 1) for x in ("2024-01-10", "2024-01-11", "2024-01-15")]
        + [(*NQ, x, 1) for x in ("2024-01-10", "2024-02-20", "2024-04-01")],
    )
    built = catalog.build_catalog(rows, datetime(2024, 5, 1))
    assert pairs(built.filter("symbol = 'ES.c.0'")) == [
        ("2024-01-10", "2024-01-11"), ("2024-01-15", "2024-01-15"),
    ]
    assert pairs(built.filter("symbol = 'NQH24'")) == [
        ("2024-01-10", "2024-02-20"), ("2024-04-01", "2024-04-01"),
    ]
    assert {r.symbol: r.stype for r in built.collect()} == {
        "ES.c.0": "continuous", "NQH24": "raw_symbol",
    }


def findings(spark, recorded, rows):
    found = catalog.validate_catalog(recorded, rows).collect()
    return {r.symbol: (r.finding, str(r.recorded_end), str(r.last_date)) for r in found}


def test_validation_finds_each_kind(spark):
    def key(name):
        return ("X", name, "trades")

    recorded = (
        ranges(spark, [("2024-01-02", "2024-01-05")], key("right"))
        .unionByName(ranges(spark, [("2024-01-02", "2024-01-31")], key("end")))
        .unionByName(ranges(spark, [("2024-01-01", "2024-01-05")], key("start")))
        .unionByName(
            ranges(spark, [("2024-01-02", "2024-01-03"), ("2024-01-05", "2024-01-05")], key("split"))
        )
        .unionByName(ranges(spark, [("2024-01-02", "2024-01-05")], key("gone")))
    )
    rows = tick_rows(
        spark,
        [(*key(n), x, 1) for n in ("right", "end", "start", "split", "new")
         for x in ("2024-01-02", "2024-01-05")],
    )
    assert findings(spark, recorded, rows) == {
        "right": ("ok", "2024-01-05", "2024-01-05"),
        "end": ("mismatch", "2024-01-31", "2024-01-05"),
        "start": ("mismatch", "2024-01-05", "2024-01-05"),
        "split": ("mismatch", "2024-01-05", "2024-01-05"),
        "gone": ("no_rows", "2024-01-05", "None"),
        "new": ("orphan", "None", "2024-01-05"),
    }
    single = catalog.fix_catalog(recorded, rows, single_range=True)
    assert findings(spark, single, rows)["split"][0] == "ok"
    assert pairs(single.filter("symbol = 'split'")) == [("2024-01-02", "2024-01-05")]
    assert pairs(single.filter("symbol = 'gone'")) == [("2024-01-02", "2024-01-05")]
    islands = catalog.fix_catalog(recorded, rows, single_range=False)
    assert pairs(islands.filter("symbol = 'end'")) == [
        ("2024-01-02", "2024-01-02"), ("2024-01-05", "2024-01-05"),
    ]


def test_orphans_get_their_dotted_symbol_back(spark):
    files = tick_rows(spark, [("GLBX.MDP3", "ES_c_0", "trades", "2024-01-02", 1),
                              ("GLBX.MDP3", "NQ_FUT", "trades", "2024-01-03", 1)])
    recorded = ranges(spark, [("2024-01-02", "2024-01-02")], ES)
    row = catalog.rebuild_orphans(recorded, files).collect()
    assert [(r.symbol, r.stype, str(r.range_start)) for r in row] == [
        ("NQ.FUT", "parent", "2024-01-03")
    ]


def test_verify_and_drop_stale(spark, calendar):
    recorded = ranges(spark, [("2024-01-02", "2024-01-04"), ("2024-01-08", "2024-01-09")], ES)
    rows = tick_rows(spark, [(*ES, f"2024-01-{i:02}", 1) for i in (2, 3, 4, 8)])
    stale = catalog.verify_catalog(recorded, coverage.present_partitions(rows), calendar)
    assert pairs(stale) == [("2024-01-08", "2024-01-09")]
    assert stale.first().missing_partitions == 1
    assert pairs(catalog.drop_stale(recorded, stale)) == [("2024-01-02", "2024-01-04")]


def test_listing_filters(spark):
    recorded = ranges(spark, [("2024-01-02", "2024-01-04")], ES).unionByName(
        ranges(spark, [("2024-01-02", "2024-01-04"), ("2024-01-09", "2024-01-09")], NQ)
    )
    sizes = spark.createDataFrame([(*NQ, 10)], KEYED + "size_bytes bigint")
    counts = spark.createDataFrame([(*ES, 2)], KEYED + "n_issues bigint")

    def listed(**wanted):
        rows = catalog.list_catalog(recorded, sizes, counts, **wanted).collect()
        return sorted((r.symbol, len(r.ranges), r.size_bytes, r.n_issues) for r in rows)

    assert listed() == [("ES.c.0", 1, 0, 2), ("NQH24", 2, 10, 0)]
    assert listed(prefix="nq") == [("NQH24", 2, 10, 0)]
    assert listed(schema="trades") == [("ES.c.0", 1, 0, 2)]
    assert listed(dataset="OPRA.PILLAR") == []


def notices(spark, texts):
    rows = [(*ES, i, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, KEYED + "arrival int, text string")


def test_issues_are_read_from_notices(spark):
    found = quality.extract_issues(
        notices(
            spark,
            [
                "all fine: 2024-01-01 (missing).",
                "Data has reduced quality: 2024-01-05 (missing), 2024-01-04,, 2024-13-01 (x),"
                " soon (y), 2024-1-7. Ask about 2024-01-09 (missing).",
                "reduced quality: 2024-01-05 (degraded), 2024-01-06 (a)(b), 2024-01-08 (c",
            ],
        )
    )
    got = sorted((str(r.issue_date), r.issue_type, r.arrival) for r in found.collect())
    assert got == [
        ("2024-01-04", "degraded", 1),
        ("2024-01-05", "missing", 1),
        ("2024-01-06", "a", 2),
        ("2024-01-08", "degraded", 2),
    ]


def test_stored_issues_win(spark):
    stored = quality.extract_issues(notices(spark, ["-", "-", "reduced quality: 2024-01-05 (old)."]))
    found = quality.extract_issues(
        notices(spark, ["reduced quality: 2024-01-05 (new), 2024-01-03 (new)."])
    )
    merged = quality.merge_issues(stored, found)
    assert sorted((str(r.issue_date), r.issue_type) for r in merged.collect()) == [
        ("2024-01-03", "new"), ("2024-01-05", "old"),
    ]
    assert merged.columns == stored.columns


def test_issue_filters_counts_and_digest(spark):
    text = "reduced quality: " + ", ".join(f"2024-01-{i:02}" for i in range(1, 6)) + "."
    issues = quality.extract_issues(notices(spark, [text]))
    kept = quality.filter_issues(issues, start=d("2024-01-02"), end=d("2024-01-03"))
    assert kept.count() == 2
    assert quality.filter_issues(issues, prefix="es", schema="trades").count() == 5
    assert quality.filter_issues(issues, dataset="OPRA.PILLAR").count() == 0
    assert quality.issue_counts(issues).first().n_issues == 5
    assert quality.issue_digest(issues).first().digest == (
        "2024-01-01, 2024-01-02, 2024-01-03 (+2 more)"
    )
    assert quality.issue_digest(kept).first().digest == "2024-01-02, 2024-01-03"


ITEM = "dataset string, symbol string, schema_ string, size_bytes bigint, n_issues bigint"


def items(spark, symbols, schema="ohlcv-1d"):
    rows = [("GLBX.MDP3", s, schema, 10, i) for i, s in enumerate(symbols)]
    return spark.createDataFrame(rows, ITEM)


def test_groups_count_quarterly_gaps(spark):
    grouped = inventory.inventory_groups(
        items(spark, ["NQZ24", "NQH24", "NQU24", "ES.c.0", "AAPL", "VXH24"]), ["dataset"]
    ).collect()
    assert len(grouped) == 1
    row = grouped[0]
    assert (row.root, row.n_contracts, row.first_symbol, row.last_symbol) == (
        "NQ", 3, "NQH24", "NQZ24",
    )
    assert (row.size_bytes, row.n_issues) == (30, 0 + 1 + 2)
    assert (row.n_quarterly, row.expected_quarterly, row.has_gaps) == (3, 4, True)


def test_serial_months_do_not_hide_a_gap(spark):
    serial = items(spark, ["GCH24", "GCJ24", "GCU24"])
    assert inventory.chain_gaps(serial, ["dataset"]).first().n_absent == 1
    whole = items(spark, ["GCJ24", "GCM24", "GCU24", "GCV24"])
    assert inventory.chain_gaps(whole, ["dataset"]).count() == 0
    assert inventory.chain_gaps(items(spark, ["GCH24"]), ["dataset"]).count() == 0


def test_listing_order(spark):
    listed = items(spark, ["NQH25", "NQ.c.0", "ZZZ", "NQZ24", "AAPL", "ES.v.0"]).unionByName(
        items(spark, ["NQ.c.0", "NQH25"], "ohlcv-1m").unionByName(items(spark, ["NQ.c.0"], "trades"))
    )
    order = inventory.inventory_order(spark, listed, ["dataset"]).orderBy("position").collect()
    assert [(r.symbol, r.schema_) for r in order] == [
        ("AAPL", "ohlcv-1d"), ("ES.v.0", "ohlcv-1d"), ("NQ.c.0", "ohlcv-1d"),
        ("NQ.c.0", "ohlcv-1m"), ("NQ.c.0", "trades"), ("NQZ24", "ohlcv-1d"),
        ("NQH25", "ohlcv-1d"), ("NQH25", "ohlcv-1m"), ("ZZZ", "ohlcv-1d"),
    ]


def test_positions_over_many_partitions(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 5).alias("listing"),
        F.pmod(F.col("id") * 7919, F.lit(20011)).alias("number"),
    )
    numbered = ranking.with_position(spark, rows, ["listing"], ["number"])
    exact = Window.partitionBy("listing").orderBy("number")
    wrong = numbered.withColumn("exact", F.row_number().over(exact))
    assert numbered.count() == 20000
    assert wrong.filter("exact <> position").count() == 0


def test_totals(spark):
    row = inventory.inventory_totals(items(spark, ["A", "B"])).first()
    assert (row.n_items, row.size_bytes) == (2, 20)


def test_prefix_keeps_key_columns(spark):
    assert set(KEY) <= set(items(spark, ["A"]).columns)
    assert inventory.with_contract_parts(items(spark, ["A"])).filter(
        F.col("contract_root").isNull()
    ).count() == 1
