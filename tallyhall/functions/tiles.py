"""Web-Mercator tile arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhall.functions import fixed_values as fv


def tile_x(lon: Column, zoom: int) -> Column:
    return _cell(lon / 360.0 + 0.5, zoom)


def tile_y(lat: Column, zoom: int) -> Column:
    s = F.sin(F.radians(lat))
    return _cell(0.5 - 0.25 * F.ln((1 + s) / (1 - s)) / F.pi(), zoom)


def _cell(part: Column, zoom: int) -> Column:
    n = 1 << zoom
    inner = F.floor((part + fv.TILE_EPSILON) * n)
    return F.when(part <= 0, 0).when(part >= 1, n - 1).otherwise(inner).cast("int")


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """One digit 0-3 per zoom level, coarsest first."""
    digits = []
    for bit in range(zoom - 1, -1, -1):
        east, south = F.shiftright(x, bit) % 2, F.shiftright(y, bit) % 2
        digits.append((east + 2 * south).cast("string"))
    return F.concat(*digits) if digits else F.lit("")


def tile_bounds(x: Column, y: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    """West, south, east, north of a tile in degrees."""
    n = float(1 << zoom)

    def lat(row: Column) -> Column:
        return F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * row / n))))

    return (x / n * 360.0 - 180.0, lat(y + 1), (x + 1) / n * 360.0 - 180.0, lat(y))


def tile_ranges(zoom: int, minx="minx", miny="miny", maxx="maxx", maxy="maxy") -> list[Column]:
    """First and last tile columns and rows that bounds cover: ``_x0, _x1, _y0, _y1``."""
    south = F.greatest(F.lit(-fv.MERCATOR_LAT_LIMIT), F.col(miny))
    north = F.least(F.lit(fv.MERCATOR_LAT_LIMIT), F.col(maxy))
    w, e = F.greatest(F.lit(-180.0), F.col(minx)), F.least(F.lit(180.0), F.col(maxx))
    return [
        tile_x(w, zoom).alias("_x0"),
        tile_x(e - fv.LNGLAT_EPSILON, zoom).alias("_x1"),
        tile_y(north, zoom).alias("_y0"),
        tile_y(south + fv.LNGLAT_EPSILON, zoom).alias("_y1"),
    ]


def tiles_for_bounds(
    df: DataFrame, zoom: int, minx="minx", miny="miny", maxx="maxx", maxy="maxy"
) -> DataFrame:
    """Every tile each row's bounds cover: columns x, y, quadkey are added.

    Bounds with west > east wrap around the antimeridian.
    """
    west, east = F.col(minx), F.col(maxx)
    spans = F.when(
        west > east,
        F.array(
            F.struct(F.lit(-180.0).alias("w"), east.alias("e")),
            F.struct(west.alias("w"), F.lit(180.0).alias("e")),
        ),
    ).otherwise(F.array(F.struct(west.alias("w"), east.alias("e"))))
    names = ["_x0", "_x1", "_y0", "_y1"]
    # An empty range stays empty: sequence would count down.
    return (
        df.withColumn("_span", F.explode(spans))
        .select("*", *tile_ranges(zoom, "_span.w", miny, "_span.e", maxy))
        .filter("_x0 <= _x1 and _y0 <= _y1")
        .withColumn("x", F.explode(F.sequence("_x0", "_x1")))
        .withColumn("y", F.explode(F.sequence("_y0", "_y1")))
        .drop("_span", *names)
        .withColumn("quadkey", quadkey(F.col("x"), F.col("y"), zoom))
    )
