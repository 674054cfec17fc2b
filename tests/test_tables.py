"""Replace, append, merge, reload and export on parquet tables."""

import datetime as dt
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhall.operators import skew, tables
from tallyhall.plans import jobs
from tallyhall.session import scratch_path

D = dt.date


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def name():
    return f"default.t_{uuid.uuid4().hex}"


def test_merge(spark):
    schema = "k string, j string, v int"
    old = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "x", 3)], schema)
    new = spark.createDataFrame([("b", "x", 20), ("c", "x", 30), (None, "x", 9)], schema)
    once = tables.keyed_merge(old, new, ["k", "j"])
    assert bag(once) == Counter(
        [("a", "x", 1), ("b", "x", 20), ("c", "x", 30), (None, "x", 3), (None, "x", 9)]
    )
    assert bag(tables.keyed_merge(once, new, ["k", "j"]))[(None, "x", 9)] == 2
    safe = tables.keyed_merge(tables.keyed_merge(old, new, ["k", "j"], True), new, ["k", "j"], True)
    assert bag(safe) == Counter([("a", "x", 1), ("b", "x", 20), ("c", "x", 30), (None, "x", 9)])


def test_merge_partitions(spark):
    schema, path = "d date, k string, v int", scratch_path(spark, "merge")
    day = [D(2024, 1, i) for i in (1, 2, 3)]
    first = [(day[0], "a", 1), (day[1], "a", 2), (day[1], None, 3), (None, "a", 4)]
    second = [(day[1], "a", 20), (day[2], "b", 30), (None, "a", 40)]
    for rows in (first, second):
        batch = spark.createDataFrame(rows, schema)
        tables.merge_partitions(spark, path, batch, ["k", "d"], "d")
    want = [(day[0], "a", 1), (day[1], "a", 20), (day[1], None, 3), (day[2], "b", 30),
            (None, "a", 4), (None, "a", 40)]
    assert bag(spark.read.schema(schema).parquet(path).select("d", "k", "v")) == Counter(want)
    with pytest.raises(ValueError):
        tables.merge_partitions(spark, path, batch, ["k"], "d")


SCHEMA = "d date, v int"
STORED = [(D(2024, 1, 1), 1), (D(2024, 2, 1), 2), (D(2024, 2, 28), 3), (D(2024, 3, 1), 4), (None, 5)]


def test_range_reload(spark):
    old = spark.createDataFrame(STORED, SCHEMA)
    new = spark.createDataFrame([(D(2024, 2, 2), 6)], SCHEMA)
    got = tables.range_reload(old, new, "d", D(2024, 2, 1), D(2024, 3, 1))
    assert bag(got) == Counter([(D(2024, 1, 1), 1), (None, 5), (D(2024, 2, 2), 6)])
    assert bag(tables.range_reload(None, new, "d", D(2024, 1, 1), D(2024, 1, 1))) == bag(new)


def test_reload_table(spark):
    table, new = name(), spark.createDataFrame([(D(2024, 2, 2), 6)], SCHEMA)
    tables.reload_table(spark, table, spark.createDataFrame(STORED, SCHEMA), "d", D(2024, 1, 1), D(2024, 1, 2))
    for _ in range(2):
        tables.reload_table(spark, table, new, "d", D(2024, 2, 1), D(2024, 3, 1))
        assert bag(spark.table(table)) == Counter([(D(2024, 1, 1), 1), (None, 5), (D(2024, 2, 2), 6)])


def test_reload_month_partitions(spark):
    path = scratch_path(spark, "months")
    month = F.coalesce(F.date_format("d", "yyyy-MM"), F.lit("none"))
    spark.createDataFrame(STORED, SCHEMA).withColumn("month", month).write.partitionBy("month").parquet(path)
    new = spark.createDataFrame([(D(2024, 2, 2), 6), (None, 7)], SCHEMA)
    tables.reload_month_partitions(spark, path, new, "d", D(2024, 2, 1), D(2024, 3, 1))
    got = spark.read.schema(SCHEMA + ", month string").parquet(path).select("d", "v")
    assert bag(got) == Counter([(D(2024, 1, 1), 1), (None, 5), (None, 7), (D(2024, 2, 2), 6)])


def test_replace_append_and_clusters(spark):
    table, rows = name(), spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    with pytest.raises(ValueError):
        tables.write_append(rows, table, cluster_by=["k"])
    tables.write_append(rows, table)
    tables.write_replace(rows.filter("id < 10"), table, cluster_by=["k"])
    tables.write_append(rows.filter("id >= 98").select("k", "id"), table)
    assert {r.id for r in spark.table(table).collect()} == {*range(10), 98, 99}
    tables.write_replace(rows.select("id"), table)  # another schema
    assert spark.table(table).columns == ["id"]
    shapes = rows.withColumn("geometry", F.lit(b"x"))
    with pytest.raises(ValueError, match="geometry"):
        tables.write_replace(shapes, table, cluster_by=["geometry"])


def test_replace_from_itself(spark):
    table = name()
    tables.write_replace(spark.range(10).toDF("id"), table)
    tables.write_replace(spark.table(table).filter("id > 4"), table)
    assert spark.table(table).count() == 5


def test_materialize(spark):
    view = f"v_{uuid.uuid4().hex}"
    assert tables.materialize(spark.range(9).toDF("id"), view, "marts", "view", limit=4) == view
    assert spark.table(view).count() == 4
    with pytest.raises(ValueError, match="limit"):
        tables.materialize(spark.range(9).toDF("id"), view, "marts", "table", limit=4)
    full = tables.materialize(spark.range(3).toDF("id"), view, "marts", "table")
    assert full == f"dev_marts.{view}" and spark.table(full).count() == 3
    for kind, keys in (("incremental", None), ("snapshot", ["id"])):
        with pytest.raises(ValueError):
            tables.materialize(spark.range(3).toDF("id"), view, "marts", kind, keys)


def test_history_is_kept(spark):
    rows, model = spark.range(5).toDF("id"), f"m_{uuid.uuid4().hex}"
    full = tables.materialize(rows, model, "marts", "incremental", ["id"])
    with pytest.raises(ValueError, match="full_refresh"):
        tables.materialize(rows.limit(1), model, "marts", "table")
    with pytest.raises(ValueError, match="more than once"):
        tables.materialize(rows.union(rows), model, "marts", "incremental", ["id"])
    tables.materialize(spark.range(4, 7).toDF("id"), model, "marts", "incremental", ["id"])
    assert spark.table(full).count() == 7
    tables.materialize(rows.limit(1), model, "marts", "table", full_refresh=True)
    assert spark.table(full).count() == 1


def test_managed_tables_and_unknown_columns(spark):
    managed, table = name(), name()
    spark.range(3).write.saveAsTable(managed)
    with pytest.raises(ValueError, match="managed"):
        tables.write_replace(spark.range(2).withColumn("x", F.lit(1)), managed)
    assert spark.table(managed).count() == 3
    tables.write_append(spark.range(3).toDF("id"), table)
    with pytest.raises(ValueError, match="columns"):
        tables.write_append(spark.range(3).withColumn("extra", F.lit(1)), table)


def test_schema_name():
    assert tables.schema_name(None, " DEV ", "dev") == "dev"
    assert tables.schema_name("Marts", "dev", "prd") == "marts"
    assert tables.schema_name("marts", "Dev", "dev") == "dev_marts"


def test_guard(spark):
    with pytest.raises(RuntimeError, match="nothing"):
        tables.guard_non_empty(spark.range(0), "nothing")


def test_contracts_and_purchases_jobs(spark):
    table = name()
    rows = spark.createDataFrame([("c1", None, "1/2/2024")], "`Contract ID` string, Buyer string, `Begin  Date` string")
    jobs.replace_contracts(rows, rows, table)
    with pytest.raises(RuntimeError):
        jobs.replace_contracts(rows, rows.limit(0), table)
    got = spark.table(table).collect()
    assert len(got) == 2 and got[0].BUYER == "nan" and got[0].BEGIN_DATE == D(2024, 1, 2)
    buy = spark.createDataFrame(
        [("1", "2740", "1/2/2024", 1)],
        "`Purchase Document #` string, Department string, `Start Date` string, seq int",
    )
    table = name()
    for _ in range(2):
        jobs.reload_purchases(buy, buy.limit(0), "seq", table, D(2024, 1, 1), D(2024, 1, 31))
    assert spark.table(table).count() == 1


@pytest.mark.parametrize("how", skew.HOW)
@pytest.mark.parametrize("crowd", [0, 2000])
def test_skew_join_of_a_crowded_right(spark, how, crowd):
    """One key holds most rows of the right side, and of both where ``crowd`` is set."""
    left = spark.range(400 + crowd).select(
        F.when(F.col("id") < 400, F.col("id") % 40).otherwise(3).alias("k"), F.col("id").alias("v")
    )
    left = left.unionByName(spark.createDataFrame([(None, -1), (99, -2)], "k long, v long"))
    right = spark.range(900).select(
        F.when(F.col("id") % 9 == 0, F.col("id") % 50).otherwise(3).alias("k"), F.col("id").alias("w")
    )
    got, want = skew.skew_join(left, right, ["k"], how, min_rows=100), left.join(right, ["k"], how)
    totals = [F.count(F.lit(1)), *[F.sum(F.xxhash64(*want.columns).cast("decimal(38,0)"))]]
    assert got.select(*want.columns).agg(*totals).first() == want.agg(*totals).first()


@pytest.mark.parametrize("how", skew.HOW)
def test_skew_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(60).select((F.col("id") % 40).alias("k"), F.col("id").alias("w"))
    right = right.unionByName(spark.createDataFrame([(None, 99)], "k long, w long"))
    got = skew.skew_join(left, right, ["k"], how, min_rows=20)
    want = left.join(right, ["k"], how)
    assert bag(got.select(*want.columns)) == bag(want)
    plain = skew.skew_join(left, right, ["k"], how)
    assert bag(plain.select(*want.columns)) == bag(want)
    with pytest.raises(ValueError):
        skew.skew_join(left, right, ["k"], "full")


def test_heavy_keys_are_never_lost(spark):
    rows = spark.range(40000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).cast("string").alias("k"))
    other = spark.range(9000).select(F.when(F.col("id") % 4 == 0, F.lit("x")).otherwise(F.concat(F.lit("y"), F.col("id") % 50)).alias("k"))
    found = skew.heavy_keys([rows.repartition(6), other.repartition(3)], ["k"], counters=40).collect()
    most = {(r.side, r.k): r._n for r in found}
    true = 13334  # every third row, and the id 7 itself
    assert true - 40000 / 40 <= most[(0, "7")] <= true
    assert most[(1, "x")] >= 2250 - 9000 / 40 and len(found) <= 40 * 9
    hot = skew.hot_keys([rows, other], ["k"], 2000)
    assert [tuple(r) for r in hot[0].collect()] == [("7", 7)] and [tuple(r) for r in hot[1].collect()] == [("x", 2)]


def test_small_tables_are_not_counted(spark):
    small = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert skew.hot_keys([small, small], ["k"], 1_000_000) == [None, None]
    got = skew.skew_join(small, small.withColumnRenamed("v", "w"), ["k"], "left")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and got.count() == 4
