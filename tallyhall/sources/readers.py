"""Readers for landed files. Schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.functions.geometry import to_wkb
from tallyhall.sources.collections import collection_items, features

CATALOGUE = "Location string, QuadKey string, Url string, Size string, UploadDate string"


def table_scan(
    spark: SparkSession, folder: str, table: str, schema: str, cols: list[str]
) -> DataFrame:
    """Named columns of one table; only these are read from the files."""
    return spark.read.schema(schema).parquet(f"{folder}/{table}.parquet").select(*cols)


def csv_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Tile links. Tile keys stay text, they have leading zeros."""
    return spark.read.schema(CATALOGUE).csv(path, header=True, enforceSchema=False)


def _feature(properties: str) -> str:
    return f"type string, properties struct<{properties}>, geometry string"


def geojson_seq(
    spark: SparkSession,
    path: str | list[str],
    properties: str,
    strict: bool = True,
    partition: str = "",
    base: str = "",
) -> DataFrame:
    """One GeoJSON feature per line, compressed or not; geometry as WKB.

    ``path`` may list files or folders; one that is absent is an error. ``base`` is then
    the folder above the partition folders.

    ``partition`` declares folder columns, so that a tile key keeps its zeros. A line
    that is no JSON fails a strict read; else it gives a row of nulls.
    """
    extra = f", {partition}" if partition else ""
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    reader = reader.option("basePath", base) if base else reader
    raw = reader.schema(_feature(properties) + extra).json(path)
    rest = [c for c in raw.columns if c not in ("type", "properties", "geometry")]
    shape = to_wkb(F.col("geometry"), strict=strict, geojson=True)
    return raw.select("properties.*", shape.alias("geometry"), *rest)


def geojson_collection(
    spark: SparkSession, path: str, properties: str, strict: bool = True, by_line: bool = True
) -> DataFrame:
    """One row per feature of a FeatureCollection, in any layout.

    Features are found by their brackets (see :mod:`tallyhall.sources.collections`), so a
    file is split whatever its layout. A strict read gives every feature or fails: on text
    between features, on an item that is no feature, on a file that ends too early.

    A loose read (not ``strict``) gives a row of nulls for what is no feature. With
    ``by_line`` it takes the published layout, each feature on a line of its own, so that
    a damaged line costs that line alone; else it follows the brackets too.
    """
    if strict or not by_line:
        items = collection_items(spark, path, strict)
        found = items.select(features(items, properties, strict).alias("f"))
    else:
        found = _features_by_line(spark, path, properties)
    shape = to_wkb(F.col("f.geometry"), strict=strict, geojson=True)
    return found.select("f.properties.*", shape.alias("geometry"))


def _features_by_line(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of lines that hold a feature or a whole collection; null for other lines."""
    schema = f"{_struct(properties)}, features: array<struct<{_struct(properties)}>>, _bad: string"
    body = F.regexp_replace(F.trim("value"), r",\s*$", "")
    parsed = F.from_json("body", f"struct<{schema}>", {"columnNameOfCorruptRecord": "_bad"})
    lines = spark.read.text(path).select(body.alias("body")).filter("body <> ''")
    lines = lines.select("body", parsed.alias("f"))
    whole = F.col("f._bad").isNull()
    one = F.struct("f.type", "f.properties", "f.geometry")
    none = F.slice(F.array(one), 1, 0)
    frame = F.rlike("body", F.lit(_FRAME)) & ~F.contains("body", F.lit('"Feature"'))
    bad = F.array(F.lit(None).cast(f"struct<{_struct(properties)}>"))
    rows = (
        F.when(whole & (F.col("f.type") == "Feature"), F.array(one))
        .when(whole & (F.col("f.type") == "FeatureCollection"), F.coalesce("f.features", none))
        .when(frame, none)
        .otherwise(bad)
    )
    return lines.select(F.explode(rows).alias("f"))


#: Lines around the features of a collection: brackets and members of the collection.
_FRAME = r'^([\[\]{},\s]*|\{?\s*"[A-Za-z_]+"\s*:.*)$'


def _struct(properties: str) -> str:
    return f"type: string, properties: struct<{properties}>, geometry: string"


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per line; a line that is none is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def indented_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and an order that survives splitting.

    ``line_no`` grows along each file but is not gapless: twice the byte offset of
    the split plus the position inside it (a split has at most one line per byte). A task
    reads the lines of a split one after the other, so it counts them as they pass and
    nothing is shuffled.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("line_no"),
        F.col("value").alias("line"),
    )
    return lines.mapInArrow(_numbered, "doc string, line_no long, line string")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the offset of the split by twice that plus the number of its lines before."""
    now, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, start = batch.column("doc").dictionary_encode(), batch.column("line_no").to_numpy()
        names, code = doc.dictionary.to_pylist(), doc.indices.to_numpy()
        first = np.ones(len(start), bool)  # rows that begin another split
        first[1:] = (start[1:] != start[:-1]) | (code[1:] != code[:-1])
        begin = np.flatnonzero(first)
        place = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
        if (names[code[0]], start[0]) == now:
            place[: begin[1] if len(begin) > 1 else len(place)] += seen
        now, seen = (names[code[-1]], start[-1]), int(place[-1]) + 1
        yield pa.record_batch({"doc": batch.column("doc"), "line_no": 2 * start + place, "line": batch.column("line")})
