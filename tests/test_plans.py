"""What the physical plans must and must not contain, and how hot groups are written."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhall.functions import geometry as geo
from tallyhall.functions import wkb
from tallyhall.operators import clean, quality, tables, usage
from tallyhall.plans.queries import QUERIES
from tallyhall.session import scratch_path
from tallyhall.sources.proxies import view

SF = "/root/testdata/sf0.001"
EAGER = {"export_partitions", "export_counties", "hierarchy_files", "ingest_features",
         "global_footprints_with_census", "reload_month_partitions", "materialize_incremental",
         "replace_and_append", "read_county", "stream_merge", "stream_daily_usage", "merge_partitions",
         "reload_purchases", "replace_contracts", "materialize_table", "load_geo_table", "load_tiles",
         "load_layers"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_is_pruned_and_filtered(spark):
    spec = usage.specs()["cortex_usage_daily_history"]
    text = plan(usage.usage_daily(view(spark, SF, spec.source), spec))
    assert "event_id" not in text and "props" not in text and "DataFilters: [" in text
    rows = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderstatus = 'F'")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan(
        quality.status_breakdown(rows, "o_orderpriority")
    )


def test_last_row_and_orphans_combine_before_the_shuffle(spark):
    rows = view(spark, SF, "purchases_landed")
    text = plan(clean.dedup_keep_last(rows, ["department"], ["seq"]))
    assert "partial_max_by" in text and "Window" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child, parent = view(spark, SF, "transactions"), spark.range(10).toDF("id")
        text = plan(quality.orphans(child, parent, "user_id", "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("SortMergeJoin")
    assert "partial_count" in text[join:]  # below the join


def test_overlap_kernel_runs_once(spark):
    assert plan(QUERIES["spatial_inner"](spark, SF)).count("ArrowEvalPython") == 1


def files_per_key(path, spark, key):
    rows = spark.read.parquet(path).select(key, F.col("_metadata.file_path").alias("f"))
    return {r[0]: r.n for r in rows.groupBy(key).agg(F.countDistinct("f").alias("n")).collect()}


def test_hot_county_is_cut_and_bad_rows_stay_out(spark):
    ring = np.array([[0, 0], [1, 0], [1, 1], [0, 0]], "f8")
    shape = wkb.write((wkb.POLYGON, [ring]))
    mixed = wkb.write((wkb.COLLECTION, [wkb.read(shape)]))
    noise = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "037").when(F.col("id") % 30 > 0, "001").alias("county_fips"),
        noise.alias("noise"),
        F.when(F.col("id") % 50 > 0, F.lit(bytearray(shape))).otherwise(F.lit(bytearray(mixed))).alias("geometry"),
    )
    path = scratch_path(spark, "counties")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.export_partitions(rows, path, "county_fips", geom="geometry")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = files_per_key(path, spark, "county_fips")
    assert len(files) == 2 and max(files.values()) > 2
    back = spark.read.parquet(path)
    want = rows.filter("county_fips is not null").filter(geo.geom_type(F.col("geometry")) != 7)
    assert back.count() == want.count() and back.filter(geo.geom_type(F.col("geometry")) == 7).isEmpty()
    schema = "noise string, geometry binary, county_fips string"
    one = tables.read_partition(spark, path, "county_fips", "001", schema)
    assert one.count() == want.filter("county_fips = '001'").count()  # zeros kept


def test_hot_cluster_key_is_cut(spark):
    name = f"default.c_{uuid.uuid4().hex}"
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = tables.write_replace(rows, name, cluster_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files_per_key(path, spark, "k")[5] > 2
    assert spark.table(name).count() == 20_000


def test_entity_budgets_shuffle_thrice_at_most(spark):
    text = plan(QUERIES["entity_budgets"](spark, SF))
    assert sum("Exchange " in line and "Broadcast" not in line for line in text.split("\n")) <= 3
