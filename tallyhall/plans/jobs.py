"""Loader jobs: from landed files to typed tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.functions import geometry as geo
from tallyhall.operators import clean, hierarchy, spatial, tables
from tallyhall.sources import readers

MAX_LISTED = 200_000  # catalogued files that one read names

ORGANISATION = (
    "webAgencyCd string, legalTitl string, allBudgetYearDols double, displayOnWebFlg string"
)
PROGRAM = "lines array<struct<programCode: string, programTitl: string, byDols: double>>"


def budget_tables(
    spark: SparkSession, path: str, organisation: str = ORGANISATION, program: str = PROGRAM
) -> tuple[DataFrame, DataFrame]:
    """Organisation and program tables from the three levels of landed records."""
    return hierarchy.flatten_budgets(
        readers.json_records(spark, f"{path}/agencies", organisation),
        readers.json_records(spark, f"{path}/departments", organisation),
        readers.json_records(spark, f"{path}/programs", program),
    )


def _chunks(values: Iterable[str], size: int) -> Iterator[list[str]]:
    values = iter(values)
    while chunk := list(islice(values, size)):
        yield chunk


def ingest_tiles(
    spark: SparkSession,
    catalogue: str,
    features: str,
    masks: DataFrame,
    location: str,
    properties: str,
    zoom: int = 9,
) -> DataFrame:
    """Features of the files a catalogue lists for a location, where their tile meets a mask.

    Exactly the listed files are opened, so a tile that two locations share gives only this
    one's features, no other file is read, and a listed file that is absent is an error. A
    read names at most MAX_LISTED files; a longer list is read in as many reads as it takes.
    """
    touching = spatial.tiles_touching(masks, zoom).select("quadkey")
    links = readers.csv_catalogue(spark, catalogue).filter(F.col("Location") == location)
    listed = links.select(F.col("QuadKey").alias("quadkey"), F.col("Url").alias("url"))
    wanted = listed.join(touching, "quadkey", "left_semi").select("url").distinct()
    kind, found = "location string, quadkey string", None
    for urls in _chunks((r["url"] for r in wanted.toLocalIterator()), MAX_LISTED):
        part = readers.geojson_seq(spark, urls, properties, strict=False, partition=kind, base=features)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = readers.geojson_seq(spark, features, properties, strict=False, partition=kind).limit(0)
    return found.drop("location")


def ingest_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of a landed collection as oriented WKB; a bad shape is an error."""
    return readers.geojson_collection(spark, path, properties, strict=True)


def typed_layer(df: DataFrame, epsg: int | None, geom: str = "geometry") -> DataFrame:
    """Geometry in degrees, oriented and checked. The source system must be known."""
    if epsg is None:
        raise ValueError("the coordinate system of the layer is not known")
    return df.withColumn(geom, geo.to_wkb(F.col(geom), source=epsg))


def ingest_layers(
    layers: dict[str, tuple[DataFrame, int | None]],
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Typed layers by name, and the reason for each layer that could not be typed."""
    loaded, failed = {}, {}
    for name, (df, epsg) in layers.items():
        try:
            loaded[name] = typed_layer(df, epsg)
        except ValueError as error:
            failed[name] = str(error)
    return loaded, failed


def load_geo_table(
    df: DataFrame,
    table: str,
    epsg: int | None,
    geom: str = "geometry",
    overwrite: bool = True,
    cluster_by: list[str] | None = None,
) -> None:
    """Write a typed layer to ``database.table``, replacing it or adding to it."""
    if "." not in table:
        raise ValueError("name the database of the table")
    typed = typed_layer(df, epsg, geom)
    tables.ensure_database(df.sparkSession, table.split(".")[0])
    if overwrite:
        tables.write_replace(typed, table, cluster_by)
    else:
        tables.write_append(typed, table, cluster_by)


def load_features(spark: SparkSession, path: str, properties: str, table: str, cluster_by: list[str] | None = None) -> None:
    """A landed collection as a table; it is replaced, or left as it was if any shape is bad."""
    found = ingest_features(spark, path, properties)
    tables.ensure_database(spark, table.split(".")[0])
    tables.write_replace(found, table, cluster_by)  # typed already: GeoJSON is in degrees


def load_tiles(
    spark: SparkSession,
    catalogue: str,
    features: str,
    masks: DataFrame,
    locations: list[str],
    properties: str,
    table: str,
    zoom: int = 9,
) -> None:
    """The tiles of each location where a mask is, as one table: the first replaces, others are added."""
    tables.ensure_database(spark, table.split(".")[0])
    for i, location in enumerate(locations):
        found = ingest_tiles(spark, catalogue, features, masks, location, properties, zoom)
        found = found.withColumn("location", F.lit(location))
        (tables.write_append if i else tables.write_replace)(found, table)


def load_layers(
    layers: dict[str, tuple[DataFrame, int | None]], database: str, geom: str = "geometry"
) -> tuple[list[str], dict[str, str]]:
    """Each layer as a table of its own; the tables written, and why others could not be."""
    loaded, failed = [], {}
    for name, (df, epsg) in layers.items():
        try:
            load_geo_table(df, f"{database}.{name}", epsg, geom)
            loaded.append(f"{database}.{name}")
        except ValueError as error:
            failed[name] = str(error)
    return loaded, failed


def reload_purchases(
    goods: DataFrame, services: DataFrame, seq: str, table: str, start, end
) -> None:
    """Clean a scrape of one date range and reload that range of the raw table."""
    batch = clean.clean_purchases(goods, services, seq, loaded_at=True)
    spark = goods.sparkSession
    tables.ensure_database(spark, table.split(".")[0])
    tables.reload_table(spark, table, batch, "START_DATE", start, end)


def replace_contracts(expired: DataFrame, active: DataFrame, table: str) -> None:
    """Replace the contract snapshot; refused when either listing is empty."""
    batch = clean.clean_contracts(expired, active, loaded_at=True)
    tables.ensure_database(expired.sparkSession, table.split(".")[0])
    tables.write_replace(batch, table)
