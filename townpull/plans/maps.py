"""Map-ready layer tables (P5, D7): markers, lines, polygons and the view centre.

The source draws these with an HTML map library row by row; here each layer is a
DataFrame a renderer can stream. The id -> coordinate lookup of the lines is an
equi-join against only the ids that are assigned (a set bounded by the metros),
broadcast when proven small, so the town table is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpull.functions.style import (candidate_text, color_by_code, color_by_metro, marker_radius,
                                      safe_id, tooltip_text)
from townpull.operators.filters import filter_assigned
from townpull.operators.profile import map_center
from townpull.operators.sizing import join_small


def assignment_lines(df: DataFrame, assigned_col: str = "assigned_metro_id") -> DataFrame:
    """One line per row whose assigned id parses and exists as a geonameid:
    (id, lat, lon, metro_lat, metro_lon). Metros give a zero-length line to themselves."""
    rows = df.select(F.col("geonameid").alias("id"), F.col("latitude").alias("lat"),
                     F.col("longitude").alias("lon"), safe_id(F.col(assigned_col)).alias("_aid")) \
        .filter(F.col("_aid").isNotNull())
    wanted = rows.select(F.col("_aid").alias("_k")).distinct()
    coords = df.select(F.col("geonameid").alias("_k"), F.col("latitude").alias("metro_lat"),
                       F.col("longitude").alias("metro_lon"))
    # one coordinate per id (duplicate ids: the smallest coordinate pair)
    lookup = join_small(coords, wanted, "_k", "left_semi").groupBy("_k").agg(
        F.min(F.struct("metro_lat", "metro_lon")).alias("_c")).select("_k", "_c.*")
    out = join_small(rows, lookup.withColumnRenamed("_k", "_aid"), "_aid", "inner")
    return out.select("id", "lat", "lon", "metro_lat", "metro_lon")


def markers(df: DataFrame, color: str = "metro", draw_lines: bool = False) -> DataFrame:
    """Marker layer: (id, lat, lon, radius, color, tooltip). ``color="metro"`` (G12) or
    ``"code"`` (G13); with ``draw_lines`` and a ``candidates`` column the tooltip gets
    the candidate text (G17)."""
    # a table without the metro flag (plain places) is coloured by feature code
    col = color_by_metro() if color == "metro" and "isMetro" in df.columns else color_by_code()
    tip = tooltip_text()
    if draw_lines and "candidates" in df.columns:
        tip = F.concat(tip, candidate_text("candidates"))
    return df.select(F.col("geonameid").alias("id"), F.col("latitude").alias("lat"),
                     F.col("longitude").alias("lon"), marker_radius("population").alias("radius"),
                     col.alias("color"), tip.alias("tooltip"))


def polygon_layer(df: DataFrame, col: str = "polygons") -> DataFrame:
    """Polygon layer: one row per ring (id, ring_no, ring, tooltip)."""
    return df.select(F.col("geonameid").alias("id"), F.posexplode(col).alias("ring_no", "ring"),
                     tooltip_text().alias("tooltip"))


def map_layers(df: DataFrame, filter_assigned_only: bool = False, draw_lines: bool = True,
               color: str = "metro") -> dict[str, DataFrame]:
    """P5: the four layer tables of one map."""
    src = filter_assigned(df) if filter_assigned_only else df
    layers = {"markers": markers(src, color, draw_lines), "view": map_center(src)}
    if draw_lines and "assigned_metro_id" in src.columns:
        layers["lines"] = assignment_lines(src)
    if "polygons" in src.columns:
        layers["polygons"] = polygon_layer(src)
    return layers
