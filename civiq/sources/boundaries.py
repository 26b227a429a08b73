"""GeoJSON boundary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from civiq.functions.geometry import rings_to_edges
from civiq.sources.blocks import is_large, json_elements, scan
from civiq.sources.tables import read_csv

_POLYGON = "array<array<array<double>>>"
_FEATURE = "properties map<string,string>, geometry struct<type: string, coordinates: string>"
_CRS = "crs struct<properties: struct<name: string>>"
_COLLECTION = (
    "features array<struct<properties: map<string,string>, "
    "geometry: struct<type: string, coordinates: string>>>, " + _CRS
)


def read_boundaries(
    spark: SparkSession, path: str, properties: list[str], layout: str = "collection", index: str | None = None
) -> DataFrame:
    """Polygons of a GeoJSON file as (poly_id, properties…, epsg, edges).

    ``layout`` is ``"collection"`` for a FeatureCollection document or
    ``"lines"`` for one feature per line. ``poly_id``
    is the property ``index`` as a number, else (collection only) the position in the document.
    A document longer than a task's share, or any with ``"blocks"``, is read by as many tasks as it has blocks.
    A feature without a geometry has null edges; one that is no polygon raises.
    """
    if layout == "blocks" or layout == "collection" and is_large(spark, path):
        features = _features_in_blocks(spark, path)
    elif layout == "collection":
        documents = spark.read.schema(_COLLECTION).option("multiLine", True).json(path)
        features = documents.select("crs", F.posexplode("features").alias("position", "feature")).select(
            "crs", "position", "feature.*"
        )
    elif layout == "lines":
        if index is None:
            raise ValueError("features in lines have no position: name an index property")
        features = spark.read.schema(f"{_FEATURE}, {_CRS}").json(path)
    else:
        raise ValueError("layout must be 'collection', 'blocks' or 'lines'")

    coordinates = F.col("geometry.coordinates")
    rings = (
        F.when(F.col("geometry.type") == "Polygon", F.from_json(coordinates, _POLYGON))
        .when(F.col("geometry.type") == "MultiPolygon", F.flatten(F.from_json(coordinates, f"array<{_POLYGON}>")))
        .when(F.col("geometry.type").isNotNull(), F.raise_error(
            F.concat(F.lit("a boundary cannot be a "), F.col("geometry.type"))).cast(_POLYGON))
    )
    named = F.regexp_extract("crs.properties.name", r"EPSG:+(\d+)", 1)
    key = F.col("properties")[index].cast("bigint") if index else F.col("position").cast("bigint")
    return features.select(
        key.alias("poly_id"),
        *[F.col("properties")[p].alias(p) for p in properties],
        F.coalesce(named.try_cast("int"), F.lit(4326)).alias("epsg"),
        rings_to_edges(rings).alias("edges"),
    )


def _features_in_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(crs, position, properties, geometry) of FeatureCollections, found by the depth of their braces and brackets.

    A feature is an object in an array of the document; objects of other such arrays are told by their type and go.
    """
    elements, pieces = json_elements(scan(spark, path, "{"))
    parsed = elements.withColumn("feature", F.from_json("text", f"type string, {_FEATURE}")).filter("feature.type = 'Feature'")
    named = r'"name"\s*:\s*"([^"]*EPSG[^"]*)"'
    # The properties of the reference system: an object in a member of the document.
    outer = pieces.filter(~F.col("before") & (F.col("braces_before") == 2) & (F.col("brackets_before") == 0) & F.col("value").rlike(named))
    systems = outer.groupBy("file").agg(F.max(F.regexp_extract("value", named, 1)).alias("name"))
    crs = F.struct(F.struct("name").alias("properties")).alias("crs")
    return parsed.join(systems, "file", "left").select(crs, "position", "feature.properties", "feature.geometry")


def read_check_file(spark: SparkSession, path: str, order: str = "seq") -> DataFrame:
    """The name check table of one CSV file (scode, sname, dcode, dname), with the lines' order as ``order``."""
    return read_csv(spark, path).withColumn(order, F.monotonically_increasing_id())
