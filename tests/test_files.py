"""Readers of landed files, and streams over them."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tallyhall.plans import jobs, queries
from tallyhall.session import scratch_path
from tallyhall.sources import readers
from tallyhall.streaming import usage_stream


def feature(x, **properties):
    ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
    return {
        "type": "Feature",
        "properties": properties,
        "geometry": {"type": "Polygon", "coordinates": [ring]},
    }


def test_catalogue_keeps_zeros(spark, tmp_path):
    (tmp_path / "links.csv").write_text("Location,QuadKey,Url\nUnitedStates,0230,u\n")
    df = spark.read.schema("Location string, QuadKey string, Url string")
    assert df.csv(str(tmp_path / "links.csv"), header=True).first().QuadKey == "0230"
    (tmp_path / "full.csv").write_text(
        "Location,QuadKey,Url,Size,UploadDate\nUnitedStates,0230,u,1KB,2024-01-01\n"
    )
    assert readers.csv_catalogue(spark, str(tmp_path / "full.csv")).first().QuadKey == "0230"


def test_geojson_seq(spark, tmp_path):
    folder = tmp_path / "quadkey=0012"
    folder.mkdir()
    bad = feature(9, height=1.0)
    bad["geometry"]["coordinates"][0].pop()
    with gzip.open(folder / "part.json.gz", "wt") as out:
        for f in (feature(0, height=2.5), bad, feature(3, height=None)):
            out.write(json.dumps(f) + "\n")
    got = readers.geojson_seq(
        spark, str(tmp_path), "height double", strict=False, partition="quadkey string"
    ).collect()
    assert sorted((r.height is None, r.geometry is None) for r in got) == [
        (False, False), (False, True), (True, False),
    ]
    assert {r.quadkey for r in got} == {"0012"}


def test_geojson_collection(spark, tmp_path):
    features = [feature(i, release=f"r{i}") for i in range(3)]
    lines = ",\n".join(json.dumps(f) for f in features)
    (tmp_path / "by_line.geojson").write_text('{"type":"FeatureCollection","features":[\n' + lines + "\n]}")
    (tmp_path / "free.geojson").write_text(
        json.dumps({"type": "FeatureCollection", "features": features}, indent=2)
    )
    for name, by_line in (("by_line", True), ("free", False)):
        got = readers.geojson_collection(
            spark, str(tmp_path / f"{name}.geojson"), "release string", by_line=by_line
        ).collect()
        assert sorted(r.release for r in got) == ["r0", "r1", "r2"]
        assert all(r.geometry is not None for r in got)


def test_collection_layouts_and_bad_lines(spark, tmp_path):
    features = [feature(i, release=f"r{i}") for i in range(3)]
    swapped = [{"id": i, **f} for i, f in enumerate(features)]
    one_line = json.dumps({"type": "FeatureCollection", "name": "x", "features": features})
    by_line = ['{"type": "FeatureCollection",', '"name": "x",', '"features": [']
    by_line += [json.dumps(f) + "," for f in swapped] + ["]", "}"]
    for name, text in (("one", one_line), ("swapped", "\n".join(by_line))):
        (tmp_path / name).write_text(text)
        got = readers.geojson_collection(spark, str(tmp_path / name), "release string").collect()
        assert sorted(r.release for r in got) == ["r0", "r1", "r2"]
    broken = [json.dumps(features[0]) + ",", json.dumps(features[1])[:-9] + ",", json.dumps(features[2])]
    (tmp_path / "corrupt").write_text("\n".join(broken))
    with pytest.raises(Exception, match="no feature"):
        readers.geojson_collection(spark, str(tmp_path / "corrupt"), "release string").collect()
    loose = readers.geojson_collection(spark, str(tmp_path / "corrupt"), "release string", strict=False)
    assert sorted(r.release or "" for r in loose.collect()) == ["", "r0", "r2"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.geojson_seq(spark, str(tmp_path / "corrupt"), "release string").collect()


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    lines = [f"{i:04d} " + "x" * (i % 40) for i in range(2000)]
    (tmp_path / "manual.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.indented_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = df.collect()
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, got))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.line_no for r in got}) == len(lines)
    assert [r.line for r in sorted(got, key=lambda r: r.line_no)] == lines


def test_stream_merge_is_idempotent_and_adds_up(spark, tmp_path):
    landed = str(tmp_path / "landed")
    schema = "k string, v int"
    for i, rows in enumerate(([("a", 1), ("a", 2), ("b", 5)], [("a", 10), ("c", 7)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{landed}/{i}")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    stream = reader.option("recursiveFileLookup", "true").parquet(landed)
    path = str(tmp_path / "merged")
    for _ in range(2):  # the second start finds nothing new
        out = usage_stream.merge_stream(stream, ["k"], {"total": "v"}, path)
        assert {r.k: r.total for r in out.collect()} == {"a": 13, "b": 5, "c": 7}


def test_many_batches_open_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(usage_stream, "EVERY", 4)
    landed, schema, path = str(tmp_path / "landed"), "k string, v int", str(tmp_path / "merged")
    for i in range(11):
        spark.createDataFrame([(f"k{i % 3}", i), ("all", 1)], schema).coalesce(1).write.parquet(f"{landed}/{i}")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    stream = reader.option("recursiveFileLookup", "true").parquet(landed)
    want = {"all": 11, **{f"k{r}": sum(range(r, 11, 3)) for r in range(3)}}
    out = usage_stream.merge_stream(stream, ["k"], {"total": "v"}, path)
    assert {r.k: r.total for r in out.collect()} == want
    assert len({f.rsplit("/", 2)[1] for f in out.inputFiles()}) <= 1 + 3
    kinds = spark.read.parquet(f"{path}/data/batch=0").schema
    write = usage_stream._writer(path, kinds, lambda rows: rows.groupBy("k").agg(F.sum("total").alias("total"), F.max("batch").alias("batch")))
    again = spark.createDataFrame(spark.read.parquet(f"{path}/data/batch=7").collect(), kinds)
    write(again, 7)  # the batch whose turn the last compaction was runs again
    out = usage_stream.merge_stream(stream, ["k"], {"total": "v"}, path)
    assert {r.k: r.total for r in out.collect()} == want
    (tmp_path / "merged/base/upto=99").mkdir()  # a compaction that was cut short
    assert usage_stream.stored(spark, path, kinds).agg(F.sum("total")).first()[0] == sum(want.values())


def test_late_rows_are_dropped(spark, tmp_path):
    landed = str(tmp_path / "events")
    schema = "ts timestamp, k string, v int"
    days = [
        ("2024-01-01 10:00:00", 1), ("2024-01-05 10:00:00", 2), ("2024-01-05 11:00:00", 3),
        ("2024-01-01 11:00:00", 50), ("2024-01-09 00:00:00", 4),
    ]
    for i, (ts, v) in enumerate(days):
        row = spark.createDataFrame([(ts, "k", v)], "ts string, k string, v int")
        row.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{landed}/{i}")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    stream = reader.option("recursiveFileLookup", "true").parquet(landed)
    daily = usage_stream.daily_usage(stream, "ts", ["k"], "v")
    for _ in range(2):  # the second start finds nothing new
        out = usage_stream.run_totals(daily, ["k", "usage_date"], str(tmp_path / "totals"))
        got = {(str(r.usage_date), r.v) for r in out.collect()}
        assert got == {("2024-01-01", 1), ("2024-01-05", 5), ("2024-01-09", 4)}


def test_tile_lists_of_any_length(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    whole = sorted(map(tuple, queries.ingest_tiles(spark, sf).collect()))
    monkeypatch.setattr(jobs, "MAX_LISTED", 2)
    assert sorted(map(tuple, queries.ingest_tiles(spark, sf).collect())) == whole and len(whole) > 10
    links, features = queries._tile_files(spark, sf)
    listed = readers.csv_catalogue(spark, links).filter("Location = 'UnitedStates'")
    wrong = scratch_path(spark, "links")
    listed.withColumn("Url", F.concat("Url", F.lit("0"))).write.csv(wrong, header=True)
    masks = queries.centred_shapes(spark, sf, "place_boxes")
    for most in (2, 1000):
        monkeypatch.setattr(jobs, "MAX_LISTED", most)
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            jobs.ingest_tiles(spark, wrong, features, masks, "UnitedStates", "height double", queries.LANDED_ZOOM).collect()
