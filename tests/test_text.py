"""Edge cases of the cleaning and naming expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhall.functions import text as tx
from tallyhall.operators import clean, entities


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_agency_band(spark):
    codes = ["0ab", "12", "1000", "2499", "2500", "3889", "3890", "5210", "8000", None]
    first, business, transport = (
        "Legislative, Judicial, Executive",
        "Business, Consumer Services, and Housing",
        "Transportation",
    )
    assert column(spark, codes, tx.agency_band) == [
        first, first, business, business, transport, "Natural Resources",
        "Environmental Protection", "Corrections and Rehabilitation", "General Government", None,
    ]


def test_extract_name(spark):
    names = [
        "Foo Dept (FD) -- DO NOT USE", "A (b) (c)", "X - DOF USE ONLY", "Y – ABC/DEF", "Plain", None,
    ]
    assert column(spark, names, tx.extract_name) == ["Foo Dept", "A", "X", "Y", "Plain", None]


def test_reorder_name(spark):
    names = {
        "Department of Finance": "Finance, Department of",
        "California State Board of Equalization": "Equalization, California State Board of",
        "Governor’s Office": "Governor's Office",
        "Milton Marks Little Hoover X": "Little Hoover Commission",
        "Office": "Office",
        "Commission on the Status of Women": "Status of Women, Commission on the",
        "State Personnel Board": "Personnel Board, State",
        "Secretary for Education": "Education, Secretary for",
    }
    assert column(spark, list(names), tx.reorder_name) == list(names.values())


def test_dates(spark):
    got = column(spark, ["01/02/2024", "1/2/2024", "13/40/2024", "", None], tx.parse_us_date)
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None, None]


def test_money(spark):
    assert column(spark, ["$1,234.56", "$0.00", None], tx.parse_money) == [1234.56, 0.0, None]
    with pytest.raises(Exception, match="abc"):
        column(spark, ["abc"], tx.parse_money)


def test_quotes_nan_and_blanks(spark):
    assert column(spark, ["''12'", "x", None], tx.strip_quote) == ["12'", "x", None]
    assert column(spark, ["nan", "n", None], tx.null_if_nan) == [None, "n", None]
    assert column(spark, [1.5, None], tx.stringify, "double") == ["1.5", "nan"]
    assert column(spark, ["\t a   b  "], tx.clean_name) == ["a b"]


def test_class_code(spark):
    got = column(spark, ["M2", "H1", None], tx.class_code)
    assert got[0].startswith("A military") and got[1:] == [None, None]


def test_lookback_start(spark):
    days = [dt.date(2024, 2, 29), dt.date(2025, 2, 1)]
    got = column(spark, days, tx.lookback_start, "date")
    assert got == [dt.date(2023, 2, 28), dt.date(2024, 2, 1)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Purchase Document #", "Begin  Date", "webAgencyCd"])
    assert tx.normalize_columns(df).columns == ["PURCHASE_DOCUMENT", "BEGIN_DATE", "WEBAGENCYCD"]
    kept = tx.normalize_columns(df, drop_hash=False).columns
    assert kept[0] == "PURCHASE_DOCUMENT_#"
    assert tx.camel_to_snake(df).columns[2] == "web_agency_cd"


def base(spark, names):
    rows = [("10", str(100 + i), str(1000 + i), None, None, n) for i, n in enumerate(names)]
    return spark.createDataFrame(
        rows, "a string, b string, l1 string, l2 string, l3 string, name string"
    )


def test_active_regex(spark):
    names = ["moved to", "Agency moved to 1234", "renum to", "renum. to", "Fish"]
    staged = entities.stage_entities(base(spark, names))
    full = {r.name_raw for r in entities.active(staged).collect()}
    assert full == {"Agency moved to 1234", "Fish"}
    found = {r.name_raw for r in entities.active(staged, match="search").collect()}
    assert found == {"Fish"}
    with pytest.raises(ValueError):
        entities.active(staged, match="glob")


def test_invalid_subagency_and_levels(spark):
    rows = [
        ("1", "2", None, None, None, "no subagency do not use"),
        ("1", "2", "33", None, None, "Dept (X) - ABC USE ONLY"),
        ("1", None, None, None, None, "Top, abolished"),
        ("1", "3", "4", "5", "6", "Deep"),
    ]
    schema = "a string, b string, l1 string, l2 string, l3 string, name string"
    got = {r.name_raw: r for r in entities.stage_entities(spark.createDataFrame(rows, schema)).collect()}
    bad, dept = got["no subagency do not use"], got["Dept (X) - ABC USE ONLY"]
    assert bad.subagency_code is None and bad.ucm_level == "agency" and bad.do_not_use
    assert dept.subagency_code is None and dept.ucm_level == "L1"
    assert (dept.parenthetical, dept.restricted_use) == ("(X)", "ABC USE ONLY")
    assert got["Top, abolished"].abolished and got["Deep"].ucm_level == "L3"


def test_keep_last(spark):
    rows = [("d", "x", 0, 1), ("d", "x", 1, 0), ("d", None, 0, 5), ("d", None, 0, 6), (None, "x", 0, 1)]
    df = spark.createDataFrame(rows, "doc string, dept string, part int, seq int")
    got = {tuple(r) for r in clean.dedup_keep_last(df, ["doc", "dept"], ["part", "seq"]).collect()}
    assert got == {("d", "x", 1, 0), ("d", None, 0, 6), (None, "x", 0, 1)}


def test_services_win_and_types(spark):
    goods = spark.createDataFrame(
        [("1", "2740", "1/2/2024", "$1,000.50", 1), ("2", "2740", "bad", None, 2)],
        "`Purchase Document #` string, Department string, `Start Date` string,"
        " `Grand Total` string, seq int",
    )
    services = spark.createDataFrame(
        [("1", "2740", "1/3/2024", "$2.00", 0)],
        "`Purchase Document #` string, Department string, `Start Date` string,"
        " `Grand Total` string, seq int",
    )
    out = clean.clean_purchases(goods, services, "seq", loaded_at=True)
    assert "LOADED_AT" in out.columns
    got = {r.PURCHASE_DOCUMENT: r for r in out.collect()}
    assert got["1"].GRAND_TOTAL == 2.0 and got["1"].ACQUISITION_TYPE == "IT Services"
    assert got["2"].START_DATE is None and got["2"].GRAND_TOTAL is None
    with pytest.raises(RuntimeError, match="expired"):
        clean.clean_contracts(goods.limit(0), goods)
