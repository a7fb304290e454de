"""Stored cell index and places: same results, no shuffle on either side."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from townpull.operators import metro_rules as MR
from townpull.operators.filters import filter_populated_places, split_metros
from townpull.operators.radius_join import attach_candidates, build_cell_index
from townpull.operators.stored_index import attach_stored, load_cell_index, save_cell_index, save_places_by_cell
from townpull.plans.assign import with_radius
from townpull.sources.fixture import places


@pytest.fixture()
def sides(spark):
    metros, towns = split_metros(MR.flag_metros(filter_populated_places(places(spark, SF_SMALL)), "share_only"))
    lost = towns.limit(3).withColumn("latitude", F.lit(None).cast("double")).withColumn("geonameid", -F.col("geonameid"))
    return with_radius(metros), towns.unionByName(lost)


def rows_of(df):
    return sorted((r["geonameid"], tuple((c["metro_id"], round(c["distance"], 9)) for c in r["candidates"])) for r in df.collect())


@pytest.mark.parametrize("metric,chunk", [("haversine", 1000), ("mercator_cos", 1000), ("haversine", 1)])
def test_stored_equals_built(spark, sides, tmp_out, metric, chunk):
    metros, towns = sides
    index = build_cell_index(metros, metric, chunk_size=chunk)
    want = rows_of(attach_candidates(towns, index))
    at, by = os.path.join(tmp_out, "index"), os.path.join(tmp_out, "towns")
    save_cell_index(index, at, 8)
    save_places_by_cell(towns, by, metric, buckets=8)
    for broadcast in (None, False):
        loaded = load_cell_index(spark, at, broadcast)
        assert (loaded.entries, loaded.max_per_cell, loaded.hot_cells is None) == (index.entries, index.max_per_cell, index.hot_cells is None)
        assert rows_of(attach_stored(spark, by, loaded)) == want
        # places that are not stored join a loaded index, too
        assert rows_of(attach_candidates(towns, loaded)) == want


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_join_of_stored_sides_does_not_shuffle(spark, sides, tmp_out, engine):
    metros, towns = sides
    at, by = os.path.join(tmp_out, "index"), os.path.join(tmp_out, "towns")
    save_cell_index(build_cell_index(metros), at, 8)
    save_places_by_cell(towns, by, buckets=8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = attach_stored(spark, by, load_cell_index(spark, at, False), "best", engine)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Join" in plan and "Exchange" not in plan, plan
    assert df.count() == towns.count()


def test_other_cells_are_refused(spark, sides, tmp_out):
    metros, towns = sides
    save_places_by_cell(towns, tmp_out, cell_deg=0.5, buckets=4)
    with pytest.raises(ValueError, match="different cells"):
        attach_stored(spark, tmp_out, build_cell_index(metros))
