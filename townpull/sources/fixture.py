"""The ``places`` view derived from the driver's ``customer`` table.

There is no gazetteer among the test tables, so every registered query reads
``customer`` and derives place rows from it with this fixed rule (same text runs
in DuckDB as the oracle). The derivation is a pure projection: it scales with
``customer`` and keeps the scan pruned to two columns.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLACES_SQL = """SELECT CAST(c_custkey AS INT) AS geonameid,
 concat('Town-', CAST(c_custkey % 701 AS VARCHAR(10))) AS name,
 CAST(49e0 + ((c_custkey*7919) % 4001)/1e3 AS DOUBLE) AS latitude,
 CAST(16e0 + ((c_custkey*104729) % 5999)/1e3 AS DOUBLE) AS longitude,
 CASE WHEN c_custkey % 20 < 17 THEN 'P' WHEN c_custkey % 20 = 17 THEN 'A' WHEN c_custkey % 20 = 18 THEN 'S' ELSE 'L' END AS feature_class,
 CASE WHEN c_custkey % 20 = 17 THEN 'ADM2' WHEN c_custkey % 20 = 18 THEN 'HTL' WHEN c_custkey % 20 = 19 THEN 'AREA'
      WHEN c_custkey % 500 = 1 THEN 'PPLC' WHEN c_custkey % 50 = 2 THEN 'PPLA' WHEN c_custkey % 25 = 3 THEN 'PPLA2'
      WHEN c_custkey % 25 = 4 THEN 'PPLA3' WHEN c_custkey % 40 = 5 THEN 'PPLX' WHEN c_custkey % 40 = 6 THEN 'PPLH' ELSE 'PPL' END AS feature_code,
 concat('C', lpad(CAST(c_nationkey AS VARCHAR(10)), 2, '0')) AS country_code,
 lpad(CAST(c_custkey % 16 AS VARCHAR(10)), 2, '0') AS admin1_code,
 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE lpad(CAST(c_custkey % 380 AS VARCHAR(10)), 4, '0') END AS admin2_code,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lpad(CAST(c_custkey % 1200 AS VARCHAR(10)), 6, '0') END AS admin3_code,
 CAST(CASE WHEN c_custkey % 29 = 0 THEN 150000 + (c_custkey*7919) % 1500000 WHEN c_custkey % 11 = 0 THEN 0 ELSE (c_custkey*37) % 40000 END AS INT) AS population
FROM customer"""

PLACES_COLUMNS = ["geonameid", "name", "latitude", "longitude", "feature_class", "feature_code",
                  "country_code", "admin1_code", "admin2_code", "admin3_code", "population"]


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def places_from_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    m20 = k % 20
    code = (F.when(m20 == 17, "ADM2").when(m20 == 18, "HTL").when(m20 == 19, "AREA")
            .when(k % 500 == 1, "PPLC").when(k % 50 == 2, "PPLA").when(k % 25 == 3, "PPLA2")
            .when(k % 25 == 4, "PPLA3").when(k % 40 == 5, "PPLX").when(k % 40 == 6, "PPLH")
            .otherwise("PPL"))
    pop = (F.when(k % 29 == 0, F.lit(150000) + (k * 7919) % 1500000)
           .when(k % 11 == 0, F.lit(0)).otherwise((k * 37) % 40000))
    return customer.select(
        k.cast("int").alias("geonameid"),
        F.concat(F.lit("Town-"), (k % 701).cast("string")).alias("name"),
        (F.lit(49.0) + ((k * 7919) % 4001) / F.lit(1e3)).cast("double").alias("latitude"),
        (F.lit(16.0) + ((k * 104729) % 5999) / F.lit(1e3)).cast("double").alias("longitude"),
        F.when(m20 < 17, "P").when(m20 == 17, "A").when(m20 == 18, "S").otherwise("L").alias("feature_class"),
        code.alias("feature_code"),
        F.concat(F.lit("C"), _pad(F.col("c_nationkey"), 2)).alias("country_code"),
        _pad(k % 16, 2).alias("admin1_code"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(_pad(k % 380, 4)).alias("admin2_code"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(_pad(k % 1200, 6)).alias("admin3_code"),
        pop.cast("int").alias("population"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place rows derived from ``{sf_dir}/customer.parquet``."""
    return places_from_customer(read_table(spark, sf_dir, "customer"))


# Boundary fixture: a diamond ring around each given metro (half-axes in degrees).
DIAMOND_DLAT = 0.12
DIAMOND_DLON = 0.18


def diamond_ring(lat: Column, lon: Column, dlat: float = DIAMOND_DLAT, dlon: float = DIAMOND_DLON) -> Column:
    """Closed ring (N, E, S, W, N) of ``struct(lat, lon)`` around a point."""
    def p(a: Column, b: Column) -> Column:
        return F.struct(a.alias("lat"), b.alias("lon"))
    return F.array(p(lat + dlat, lon), p(lat, lon + dlon), p(lat - dlat, lon), p(lat, lon - dlon),
                   p(lat + dlat, lon))


def diamond_boundaries(metros: DataFrame, dlat: float = DIAMOND_DLAT, dlon: float = DIAMOND_DLON) -> DataFrame:
    """(geonameid, name, country_code, polygons) with one diamond ring per metro row."""
    return metros.select("geonameid", "name", "country_code", F.array(diamond_ring(
        F.col("latitude"), F.col("longitude"), dlat, dlon)).alias("polygons"))


def ring_of(*corners: tuple[Column, Column]) -> Column:
    """Closed ring through (lat, lon) corners."""
    return F.array(*(F.struct(a.alias("lat"), o.alias("lon")) for a, o in (*corners, corners[0])))


# Half-axes that no two places of the fixture's 0.001 degree lattice differ by, so that borders of
# different metros never coincide.
WIDE_DLAT = 0.1207
WIDE_DLON = 0.1811


def adjoining_squares(lat: Column, lon: Column, dlat: float = WIDE_DLAT, dlon: float = WIDE_DLON) -> Column:
    """Two districts west and east of a place that share the side through it; the eastern one has a
    vertex on that side which the western one lacks."""
    south, north, west, east = lat - dlat, lat + dlat, lon - dlon, lon + dlon
    return F.array(ring_of((south, west), (north, west), (north, lon), (south, lon)),
                   ring_of((south, lon), (lat, lon), (north, lon), (north, east), (south, east)))


def bow_tie(lat: Column, lon: Column, dlat: float = WIDE_DLAT, dlon: float = WIDE_DLON) -> Column:
    """A ring that crosses itself at a place: a west and an east wing whose signed areas cancel."""
    south, north, west, east = lat - dlat, lat + dlat, lon - dlon, lon + dlon
    return ring_of((south, west), (north, east), (south, east), (north, west))


def replicate_places(df: DataFrame, copies: int, tile_lat: float = 4.1, tile_lon: float = 6.1,
                     rows_per_band: int = 12) -> DataFrame:
    """Scale-up input for benchmarks: every place ``copies`` times, each copy shifted to
    its own non-overlapping tile (same density as the original), ids offset by 10^7 per
    copy. A generator (``explode(sequence)``), no join."""
    rep = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_rep")
    r = F.col("_rep")
    out = df.select("*", rep)
    shifted = {
        "geonameid": (F.col("geonameid") + r * 10_000_000).cast("int"),
        "latitude": F.col("latitude") - 30.0 + (r % rows_per_band) * tile_lat,
        "longitude": F.col("longitude") + F.floor(r / rows_per_band) * tile_lon,
    }
    return out.select(*[shifted.get(c, F.col(c)).alias(c) for c in df.columns])
