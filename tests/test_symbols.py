import pytest
from pyspark.sql import functions as F

from bourselake.functions import symbols


def evaluate(spark, column, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def parse(spark, values):
    s = F.col("s")
    parts = F.struct(
        symbols.contract_root(s).alias("r"),
        symbols.contract_month(s).alias("m"),
        symbols.contract_year(s).alias("y"),
    )
    return [tuple(x) for x in evaluate(spark, parts, values)]


def test_contracts_parse_in_any_case(spark):
    assert parse(spark, ["NQH25", "ESZ24", "MESH25", "M2KH25", "GCJ25", "nqh25"]) == [
        ("NQ", 3, 2025),
        ("ES", 12, 2024),
        ("MES", 3, 2025),
        ("M2K", 3, 2025),
        ("GC", 4, 2025),
        ("NQ", 3, 2025),
    ]


def test_what_is_no_contract_gives_nulls(spark):
    rejects = ["AAPL", "ES.c.0", "ES.FUT", "ESA25", "NQH5", "", "ABCDEH25", "NQH2025"]
    assert parse(spark, rejects) == [(None, None, None)] * len(rejects)


def test_vendor_symbol_has_a_one_digit_year(spark):
    s = F.col("s")
    vendor = symbols.vendor_symbol(
        symbols.contract_root(s), symbols.contract_year(s), symbols.contract_month(s)
    )
    assert evaluate(spark, vendor, ["NQH25", "ESZ10", "M2KU24", "AAPL"]) == [
        "NQH5", "ESZ0", "M2KU4", None,
    ]


def test_supported_needs_a_parse_and_a_known_root(spark):
    flag = symbols.is_supported_contract(F.col("s"))
    values = ["NQH25", "gcj25", "VXH25", "ZCH25", "AAPL", "ES.c.0"]
    assert evaluate(spark, flag, values) == [True, True, False, False, False, False]
    root = symbols.is_supported_root(F.col("s"))
    assert evaluate(spark, root, ["NQ", "es", "NQH25", "VX"]) == [True, True, False, False]


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("continuous", ["ES.c.0", "ES.v.0", "6E.n.12"]),
        ("parent", ["ES.FUT", "6E.FUT", "SPX.OPT", "BTC.SPOT"]),
        ("raw_symbol", ["ESZ24", "AAPL", "es.c.0", "ES.x.0", "ES.c", "ES.fut"]),
    ],
)
def test_symbol_types(spark, kind, values):
    assert set(evaluate(spark, symbols.symbol_type(F.col("s")), values)) == {kind}


def test_spellings(spark):
    s = F.col("s")
    assert evaluate(spark, symbols.path_symbol(s), ["ES.c.0"]) == ["ES_c_0"]
    assert evaluate(spark, symbols.symbol_from_path(s), ["ES_c_0"]) == ["ES.c.0"]
    assert evaluate(
        spark, symbols.canonical_symbol(s), ["es.c.0", "esu24", "es.FUT", "AAPL"]
    ) == ["ES.c.0", "ESU24", "ES.FUT", "AAPL"]


def test_lookahead_and_prefix(spark):
    s = F.col("s")
    assert evaluate(
        spark, symbols.has_lookahead_bias(s), ["ES.v.0", "ES.n.1", "ES.c.0", "ESZ24"]
    ) == [True, True, False, False]
    assert evaluate(
        spark, symbols.starts_with_ignoring_case(s, "nQ"), ["NQ.c.0", "nqz24", "ES"]
    ) == [True, True, False]


def test_neighbouring_quarters(spark):
    s = F.col("s")
    number = symbols.contract_year(s) * 12 + symbols.contract_month(s) - 1
    root = symbols.contract_root(s)
    after = symbols.symbol_at(root, symbols.next_quarter_no(number))
    before = symbols.symbol_at(root, symbols.previous_quarter_no(number))
    assert evaluate(
        spark, after, ["NQH25", "NQZ25", "GCJ25", "GCX25", "MNQH26", "GCF25", "GCG25"]
    ) == ["NQM25", "NQH26", "GCM25", "GCZ25", "MNQM26", "GCH25", "GCH25"]
    assert evaluate(
        spark, before, ["NQH25", "NQM25", "GCJ25", "GCF25", "GCX25", "GCG00"]
    ) == ["NQZ24", "NQH25", "GCH25", "GCZ24", "GCU25", "GCZ99"]
