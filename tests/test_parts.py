"""Tables in parts: what a batch can't reach keeps its files."""

import datetime as dt
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhall.operators import parts, tables

D = dt.date


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def name():
    return f"default.p_{uuid.uuid4().hex}"


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    for f in (parts.write_parts, parts.reload_range, parts.merge_keys, parts.append):
        monkeypatch.setattr(f, "__defaults__", (50,))


def days(spark):
    rows = spark.range(500).select(F.expr("date_add(date'2024-01-01', cast(id / 5 as int))").alias("d"), F.col("id").cast("int").alias("v"))
    return rows.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "d date, v int"))


def test_reload_keeps_other_files(spark):
    table = name()
    tables.reload_table(spark, table, days(spark), "d", D(2024, 1, 1), D(2024, 1, 1))
    before = parts.files(spark, table)
    assert len(before) > 8 and bag(spark.table(table)) == bag(days(spark))
    batch = spark.createDataFrame([(D(2024, 2, 3), 900), (D(2024, 2, 20), 901)], "d date, v int")
    want = bag(tables.range_reload(days(spark), batch, "d", D(2024, 2, 1), D(2024, 2, 4)))
    for _ in range(2):  # running again ends in the same state but for rows outside the range
        tables.reload_table(spark, table, batch.filter("v = 900"), "d", D(2024, 2, 1), D(2024, 2, 4))
    tables.reload_table(spark, table, batch, "d", D(2024, 2, 1), D(2024, 2, 4))
    assert bag(spark.table(table)) == want
    after = parts.files(spark, table)
    assert len(before & after) >= len(before) - 2 and after - before


def test_only_touched_parts_are_read(spark):
    table = name()
    parts.write_parts(days(spark), table, "d")
    touched = parts.reload_range(spark, table, days(spark).limit(0), D(2024, 3, 1), D(2024, 3, 2))
    assert 1 <= len(touched) <= 2
    assert spark.table(table).filter("d between '2024-03-01' and '2024-03-02'").count() == 0
    assert spark.table(table).filter("d is null").count() == 2
    version, _ = parts.stored(spark, table)
    plan = version.filter("_low <= date'2024-02-01' and _high >= date'2024-02-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_low" in plan


def test_merge_keeps_other_files(spark):
    model = f"m_{uuid.uuid4().hex}"
    df = days(spark).filter("d is not null")
    table = tables.materialize(df, model, "marts", "incremental", ["v", "d"])
    before = parts.files(spark, table)
    late = spark.createDataFrame([(D(2024, 1, 2), 5), (D(2024, 1, 2), 777), (D(2025, 1, 1), 1), (None, 3)], "d date, v int")
    tables.materialize(late, model, "marts", "incremental", ["v", "d"])
    assert bag(spark.table(table)) == bag(tables.keyed_merge(df, late, ["v", "d"]))
    after = parts.files(spark, table)
    assert len(before - after) == 1
    with pytest.raises(ValueError, match="full_refresh"):
        tables.materialize(df, model, "marts", "table")
    tables.materialize(df.filter("v < 9"), model, "marts", "incremental", ["v", "d"], full_refresh=True)
    assert spark.table(table).count() == 9
    tables.materialize(df.filter("v < 3"), model, "marts", "table", full_refresh=True)
    assert spark.table(table).count() == 3 and not parts.is_parted(spark, table)


def test_text_keys_and_odd_values(spark):
    table, rows = name(), [("a'b", 1), ("a/b=c", 2), ("", 3), ("é %41", 4), (None, 5), ("back\\slash", 6)]
    df = spark.createDataFrame(rows, "k string, v int")
    parts.write_parts(df, table, "k", 1)
    assert bag(spark.table(table)) == Counter(rows)
    new = spark.createDataFrame([("a/b=c", 20), ("zz", 7), (None, 8)], "k string, v int")
    touched = parts.merge_keys(spark, table, new, ["k"], lambda old, batch: tables.keyed_merge(old, batch, ["k"]), 1)
    assert bag(spark.table(table)) == bag(tables.keyed_merge(df, new, ["k"]))
    assert len(touched) <= 2


def test_new_and_missing_columns_and_types(spark):
    table = name()
    parts.write_parts(days(spark), table, "d")
    batch = spark.createDataFrame([(D(2024, 2, 1), "x")], "d date, note string")
    parts.reload_range(spark, table, batch, D(2024, 2, 1), D(2024, 2, 1))
    got = spark.table(table)
    assert got.columns == ["d", "v", "note"]
    assert bag(got.filter("d = '2024-02-01'")) == Counter([(D(2024, 2, 1), None, "x")])
    assert got.count() == 502 - 5 + 1
    with pytest.raises(ValueError, match="types"):
        parts.reload_range(spark, table, days(spark).withColumn("v", F.lit("x")), D(2024, 9, 1), D(2024, 9, 2))
    with pytest.raises(ValueError, match="clustering"):
        parts.merge_keys(spark, table, batch, ["note"], None)


def test_append_plain_tables_and_no_rows(spark):
    table = name()
    tables.write_append(days(spark), table)  # a plain table
    tables.reload_table(spark, table, days(spark).limit(0), "d", D(2024, 1, 1), D(2024, 1, 3))
    assert parts.is_parted(spark, table) and spark.table(table).count() == 502 - 15
    before = parts.files(spark, table)
    tables.write_append(spark.createDataFrame([(8, D(2024, 1, 1))], "v int, d date"), table)
    assert before < parts.files(spark, table) and spark.table(table).count() == 488
    empty = name()
    parts.write_parts(days(spark).limit(0), empty, "d")
    assert spark.table(empty).count() == 0 and parts.files(spark, empty) == set()
    assert parts.reload_range(spark, empty, days(spark), D(2024, 1, 1), D(2024, 1, 2)) == set()
    assert spark.table(empty).count() == 502
