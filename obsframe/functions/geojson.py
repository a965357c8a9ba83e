"""GeoJSON text from columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def ring(points: Column) -> Column:
    """``[[lon, lat], ...]`` of an array of structs with ``Longitude`` and ``Latitude``."""
    return F.transform(points, lambda p: F.array(p["Longitude"], p["Latitude"]))


def feature(kind: str, coordinates: Column, properties: dict[str, Column]) -> Column:
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
            F.struct(*[value.alias(name) for name, value in properties.items()]).alias("properties"),
        ),
        KEEP_NULLS,
    )


def polygon(coordinates: Column, properties: dict[str, Column]) -> Column:
    """A Feature with one polygon ring and the given properties."""
    return feature("Polygon", F.array(coordinates), properties)


def outline(corners: Column, properties: dict[str, Column]) -> Column:
    """A Feature with the shape that corners make: a polygon of a closed ring, or the line or point that there is."""
    return (
        F.when(F.size(corners) > 3, feature("Polygon", F.array(corners), properties))
        .when(F.size(corners) == 2, feature("LineString", corners, properties))
        .when(F.size(corners) == 1, feature("Point", F.element_at(corners, 1), properties))
    )
