"""Boundary responses (A11) and boundary tables.

The source fetched one geocoder response per city over HTTP; here the responses
are staged files read in parallel. A response is a JSON document with
``features[0].geometry.{type, coordinates}`` (coordinates lon, lat); the city's
``name`` is taken from a top-level field of the document when present, else from the
file name (``<name>.json``), else from ``features[0].properties``; its ``country_code``
from a top-level field, else from the caller (the responses of one country lie in one
folder), else from ``features[0].properties``, upper-cased as place tables have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townpull.schema import POLYGONS_TYPE

_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def _ring_latlon(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(F.get(p, 1).alias("lat"), F.get(p, 0).alias("lon")))


def rings_to_latlon(geom_type: Column, coordinates_json: Column) -> Column:
    """Outer ring of each polygon as ``array<array<struct<lat, lon>>>``; holes are
    dropped; a geometry other than Polygon / MultiPolygon gives null."""
    poly = F.from_json(coordinates_json, _POLY)
    multi = F.from_json(coordinates_json, _MULTI)
    return (F.when(geom_type == "Polygon", F.array(_ring_latlon(F.get(poly, 0))))
            .when(geom_type == "MultiPolygon", F.transform(multi, lambda p: _ring_latlon(F.get(p, 0))))
            .otherwise(F.lit(None).cast(POLYGONS_TYPE)))


def parse_boundary_documents(docs: DataFrame, text_col: str = "value", file_col: str | None = None,
                             country_code: str | None = None) -> DataFrame:
    """Documents -> (name, country_code, polygons)."""
    t = F.col(text_col)
    stem = (F.regexp_extract(F.col(file_col), r"([^/]+?)(\.json)?$", 1) if file_col else F.lit(None))
    prop = "$.features[0].properties."
    name = F.coalesce(F.get_json_object(t, "$.name"), F.url_decode(stem) if file_col else F.lit(None),
                      F.get_json_object(t, prop + "name"), F.get_json_object(t, prop + "city"))
    country = F.coalesce(F.get_json_object(t, "$.country_code"), F.lit(country_code).cast("string"),
                         F.get_json_object(t, prop + "country_code"))
    return docs.select(
        name.alias("name"),
        F.upper(country).alias("country_code"),
        rings_to_latlon(F.get_json_object(t, "$.features[0].geometry.type"),
                        F.get_json_object(t, "$.features[0].geometry.coordinates")).alias("polygons"))


def scan_boundaries(spark: SparkSession, path: str, multi_line: bool = True,
                    country_code: str | None = None) -> DataFrame:
    """Staged boundary responses. ``multi_line=True`` reads one document per file
    (each file one row, files spread over tasks); ``False`` reads JSON Lines.
    ``country_code`` is that of responses which were asked for one country."""
    if multi_line:
        docs = spark.read.text(path, wholetext=True).withColumn("_file", F.col("_metadata.file_path"))
        return parse_boundary_documents(docs, "value", "_file", country_code)
    return parse_boundary_documents(spark.read.text(path), "value", None, country_code)


def _json_scalar(c: str) -> Column:
    arr = F.to_json(F.array(F.col(c)))  # '["text"]' -> '"text"' (escaped, or null)
    return F.regexp_extract(arr, r"^\[(.*)\]$", 1)


def boundary_documents(boundaries: DataFrame, properties: bool = False) -> DataFrame:
    """Inverse of ``parse_boundary_documents`` (for staging / tests): one JSON text per
    row with a Polygon (one ring) or MultiPolygon geometry in (lon, lat) order; name and
    country at the top, or in the feature's properties with the country in lower case."""
    rings = F.transform(F.col("polygons"), lambda r: F.array(F.transform(
        r, lambda p: F.array(p["lon"], p["lat"]))))
    poly_json = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(rings, 0).alias("coordinates")))
    multi_json = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates")))
    geom = F.when(F.size(F.col("polygons")) == 1, poly_json).otherwise(multi_json)
    if properties:
        doc = F.format_string('{"features":[{"properties":{"city":%s,"country_code":%s},"geometry":%s}]}',
                              _json_scalar("name"), F.lower(_json_scalar("country_code")), geom)
        return boundaries.select(doc.alias("value"))
    doc = F.format_string('{"name":%s,"country_code":%s,"features":[{"geometry":%s}]}',
                          _json_scalar("name"), _json_scalar("country_code"), geom)
    return boundaries.select(doc.alias("value"))
