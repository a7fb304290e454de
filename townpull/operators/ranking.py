"""Strongest-metro selection over candidate pairs or lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpull.operators.radius_join import attach_candidates, best_of, build_cell_index, sort_candidates


def top_metros(pairs: DataFrame, k: int = 1, town: str = "geonameid") -> DataFrame:
    """The ``k`` strongest metros per town from (town, metro_id, distance, force)
    pairs, ranked by force desc, distance asc, metro_id asc; adds ``rank``.

    A window whose per-partition group limit Spark applies before the shuffle. This form
    serves pair tables from elsewhere; from places, ``strongest_metros`` ranks without one.
    A town's group is its candidate metros, bounded by the metros covering it.
    """
    w = Window.partitionBy(town).orderBy(F.col("force").desc(), F.col("distance"), F.col("metro_id"))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def strongest_metros(towns: DataFrame, metros: DataFrame, k: int = 1, metric: str = "haversine",
                     town: str = "geonameid", **index_kw) -> DataFrame:
    """W1 from places: the first ``k`` of each town's sorted candidate list, with ``rank``. The
    pairs are neither formed nor shuffled."""
    idx = build_cell_index(metros, metric, best=k, **index_kw)
    lists = attach_candidates(towns.select(town, "latitude", "longitude"), idx, "list")
    return lists.select(town, F.posexplode(F.slice("candidates", 1, k)).alias("_i", "_c")) \
        .select(town, "_c.*", (F.col("_i") + 1).alias("rank"))


def candidate_list(pairs: DataFrame, towns: DataFrame, town: str = "geonameid") -> DataFrame:
    """C8 from pairs: per town the sorted candidate array (empty when none), left-joined
    to the towns. (``attach_candidates(..., mode="list")`` builds the same list without
    forming pairs; this form serves pair tables from elsewhere.)"""
    entry = F.struct("metro_id", "metro_name", "force", "distance")
    lists = pairs.groupBy(town).agg(F.collect_list(entry).alias("candidates"))
    out = towns.join(lists, town, "left")
    return out.withColumn("candidates", sort_candidates(F.coalesce(F.col("candidates"), F.array().cast(
        "array<struct<metro_id:int,metro_name:string,force:double,distance:double>>"))))


def best_candidate(col: str | Column = "candidates") -> Column:
    """Metro id of the strongest candidate, null for an empty list."""
    c = F.col(col) if isinstance(col, str) else col
    return best_of(c)["metro_id"]
