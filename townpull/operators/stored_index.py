"""The cell index and places as stored tables, bucketed by cell.

A later job, or another day's, loads the index instead of building it, and places stored by the same
cells join it bucket by bucket: neither side is shuffled. Tables are plain Parquet folders with
bucketed files; a session that loads one declares it as an external table over the folder.

A bucket is read by one task. Where one cell holds a large share of the places, and the index fits the
broadcast bound, load it with ``broadcast=True`` (places are then read as files, split at will); else
join unstored places by ``attach_candidates``, where AQE splits a hot cell.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpull.operators.radius_join import CellIndex, _town_prep, attach_candidates
from townpull.operators.sizing import row_hash

DEFAULT_BUCKETS = 64
WRITE_LOTS = 16     # tasks that may write one cell's places


def _save_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    name = f"townpull_{uuid.uuid4().hex}"
    df.write.format("parquet").mode("overwrite").bucketBy(buckets, "cell").sortBy("cell").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")   # external: the files stay


def _load_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    name = f"townpull_{uuid.uuid4().hex}"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (cell) SORTED BY (cell) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def save_cell_index(index: CellIndex, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Write a built index below ``path``: ``cells`` (bucketed by cell), ``hot`` and ``about``."""
    spark = index.table.sparkSession
    _save_bucketed(index.table.repartition(buckets, "cell"), os.path.join(path, "cells"), buckets)
    hot = index.hot_cells if index.hot_cells is not None else index.table.select("cell").limit(0)
    hot.write.mode("overwrite").parquet(os.path.join(path, "hot"))
    if index.parts is not None:
        index.parts.write.mode("overwrite").parquet(os.path.join(path, "parts"))
    about = [(index.metric, index.cell_deg, index.broadcast, index.hot_cells is not None, index.entries, index.cells,
              index.max_per_cell, index.with_names, index.hot_polar_only, buckets, index.best, index.parts is not None)]
    spark.createDataFrame(about, "metric string, cell_deg double, broadcast boolean, hot boolean, entries long, cells long, "
                                 "max_per_cell long, with_names boolean, hot_polar_only boolean, buckets int, best int, split boolean") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "about"))


def load_cell_index(spark: SparkSession, path: str, broadcast: bool | None = None) -> CellIndex:
    """The index below ``path``; ``broadcast`` overrules what was decided when it was measured."""
    a = spark.read.parquet(os.path.join(path, "about")).first()
    hot = spark.read.parquet(os.path.join(path, "hot")) if a["hot"] else None
    more = a.asDict()   # indexes stored before hold every metro, in whole cells
    parts = spark.read.parquet(os.path.join(path, "parts")) if more.get("split") else None
    index = CellIndex(_load_bucketed(spark, os.path.join(path, "cells"), a["buckets"]), a["metric"], a["cell_deg"], a["broadcast"], hot,
                      a["entries"], a["cells"], a["max_per_cell"], a["with_names"], a["hot_polar_only"], more.get("best"), parts)
    return index if broadcast is None else replace(index, broadcast=broadcast)


def _marks(parts: DataFrame | None):
    """A number for how an index splits its cells (none: null)."""
    return None if parts is None else parts.agg(F.sum(F.xxhash64("base", "parts").cast("decimal(38,0)"))).first()[0]


def save_places_by_cell(places: DataFrame, path: str, metric: str = "haversine", cell_deg: float = 0.25,
                        buckets: int = DEFAULT_BUCKETS, index: CellIndex | None = None) -> None:
    """Write places with their ``cell``, bucketed by it. Places without coordinates are spread over all
    buckets by keys that are no cell. One shuffle, in which a hot cell is written by several tasks. With an
    ``index``, they are stored by its cells, split as it has them."""
    split = None
    if index is not None:
        metric, cell_deg, split = index.metric, index.cell_deg, index.parts
    rows = _town_prep(places, metric, cell_deg, spread_nulls=True, parts=split).select(*places.columns, F.col("_cell").alias("cell"))
    lot = F.pmod(row_hash(places), F.lit(WRITE_LOTS))
    _save_bucketed(rows.repartition(F.pmod(F.xxhash64("cell"), F.lit(buckets)), lot), os.path.join(path, "places"), buckets)
    mark = _marks(split)
    places.sparkSession.createDataFrame([(metric, cell_deg, buckets, mark)], "metric string, cell_deg double, buckets int, split decimal(38,0)") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "about"))


def attach_stored(spark: SparkSession, places_path: str, index: CellIndex, mode: str = "list", engine: str | None = None) -> DataFrame:
    """``attach_candidates`` for stored places: with an index of as many buckets that is not
    broadcast, a join without any shuffle. Places that are not stored by the parts of the index's cells are
    joined like unstored ones."""
    a = spark.read.parquet(os.path.join(places_path, "about")).first()
    if (a["metric"], a["cell_deg"]) != (index.metric, index.cell_deg):
        raise ValueError("places and index are stored by different cells")
    rows = _load_bucketed(spark, os.path.join(places_path, "places"), a["buckets"])
    same = a.asDict().get("split") == _marks(index.parts)
    return attach_candidates(rows, index, mode=mode, engine=engine, cell_col="cell" if same else None).drop("cell")
