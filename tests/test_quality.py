"""Quality checks with planted faults."""

import pytest

from tallyhall.operators import clean, quality


def contract(spark, rows):
    return spark.createDataFrame(
        rows, "database string, schema string, table string, resource_type string, column string"
    )


def test_schema_report(spark):
    staged = spark.createDataFrame([("0123", "x")], ["department", "supplier_name"])
    mart = clean.purchases_mart(staged)
    actual = quality.actual_columns(mart, "db", "marts", "purchases").unionByName(
        quality.actual_columns(staged, "db", "marts", "good")
    )
    documented = [
        ("DB", "marts", "purchases", "model", "DEPARTMENT"),
        ("DB", "marts", "purchases", "model", "supplier_name"),
        ("DB", "marts", "purchases", "model", "vanished"),
        ("db", "marts", "good", "model", "department"),
        ("db", "marts", "good", "model", "supplier_name"),
        ("db", "raw", "purchases", "source", "department"),
        ("db", "raw", "blank", "source", None),
    ]
    report = quality.validate_schemas(contract(spark, documented), actual)
    got = {(r.schema, r.table): r for r in report.collect()}
    bad = got["MARTS", "PURCHASES"]
    assert bad.issues == ["DOCUMENTED_BUT_MISSING_COLUMNS", "UNDOCUMENTED_COLUMNS"]
    assert (bad.missing_columns, bad.undocumented_columns) == (["VANISHED"], ["AGENCY"])
    assert got["RAW", "PURCHASES"].issues == got["RAW", "BLANK"].issues == ["TABLE_NOT_FOUND"]
    assert got["MARTS", "GOOD"].issues == [] and not got["MARTS", "GOOD"].failed
    with pytest.raises(ValueError, match="3 tables"):
        quality.assert_schemas(report)
    errors = quality.validate_schemas(contract(spark, documented), actual, errors_only=True)
    assert errors.count() == 3


def test_undocumented_as_warning(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "agency"])
    actual = quality.actual_columns(df, "db", "s", "t")
    known = contract(spark, [("db", "s", "t", "model", "a")])
    assert quality.validate_schemas(known, actual).first().failed
    row = quality.validate_schemas(known, actual, undocumented_as_errors=False).first()
    assert row.issues == ["UNDOCUMENTED_COLUMNS"] and not row.failed


def test_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "b")], "k int, v string")
    assert quality.not_null(df, "v").count() == 2
    assert {(r.v, r.n_records) for r in quality.unique(df, "v").collect()} == {("a", 2)}
    found = {tuple(r) for r in quality.unique_combination(df, ["k", "v"]).collect()}
    assert found == {(1, "a", 2), (2, None, 2)}
    with pytest.raises(ValueError, match="2 failing"):
        quality.assert_no_rows(quality.not_null(df, "v"), "v")


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (5,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert quality.orphans(child, parent, "fk", "pk").first().orphans == 2
    with pytest.raises(ValueError, match="2 rows"):
        quality.assert_no_orphans(child, parent, "fk", "pk")
    quality.assert_no_orphans(child.filter("fk = 1"), parent, "fk", "pk")


def test_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "amount decimal(12,2), status string")
    got = {r.metric: r.value for r in quality.profile(empty, "amount", "status").collect()}
    assert got == {"count": 0.0, "avg": 0.0, "min": 0.0, "max": 0.0, "total": 0.0}
