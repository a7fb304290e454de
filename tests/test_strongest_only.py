"""The index of strongest metros: the same winners as from all metros, few entries however dense the metros."""

import os
import random

import pytest
from pyspark.sql import functions as F

from townpull.operators import radius_join as RJ
from townpull.operators.ranking import strongest_metros
from townpull.operators.stored_index import attach_stored, load_cell_index, save_cell_index, save_places_by_cell

SCHEMA = "geonameid int, name string, latitude double, longitude double, population int"


def crowd(spark, seed=5):
    """Metros and towns in a few dense spots: plain, at the antimeridian, at a pole, on one point, off the map."""
    r = random.Random(seed)
    spots = [(52.1, 19.1, 0.4), (-17.0, 179.95, 0.3), (86.0, 10.0, 0.3), (84.95, -60.0, 0.2), (0.0, 0.0, 0.3), (10.0, 190.0, 0.2)]

    def at(k):
        lat, lon, w = spots[k % len(spots)]
        lon += r.uniform(-w, w)
        return lat + r.uniform(-w, w), lon - 360 if lon > 180 and k % len(spots) != 5 else lon

    metros = [(i, f"M{i}", *at(i), r.choice([0, 5_000, 200_000, 1_500_000])) for i in range(240)]
    metros += [(1000 + i, "same", 52.2, 19.2, 300_000 + i // 3) for i in range(9)] + [metros[7]]   # one point; a row twice
    metros += [(1100 + i, "pole", 89.8, 60.0 * i, 1_000_000) for i in range(3)]
    towns = [(5000 + i, f"T{i}", *at(i), 10) for i in range(300)]
    towns += [(9000, "on it", 52.2, 19.2, 1), (9001, "lost", None, 19.0, 1), (9002, "far", 30.0, 30.0, 1), (9003, "pole", 89.9, -170.0, 1)]
    return spark.createDataFrame(metros, SCHEMA), spark.createDataFrame(towns, SCHEMA)


def winners(df):
    return {r["geonameid"]: r["best"] and r["best"]["metro_id"] for r in df.collect()}


@pytest.mark.parametrize("metric", ["haversine", "mercator_cos"])
def test_same_winners_as_from_all_metros(spark, metric, monkeypatch, tmp_out):
    monkeypatch.setattr(RJ, "SPLIT_ENTRIES", 12)
    metros, towns = crowd(spark)
    want = winners(RJ.attach_candidates(towns, RJ.build_cell_index(metros, metric), "best"))
    idx = RJ.build_cell_index(metros, metric, best=1)
    assert idx.parts is not None and sum(v is not None for v in want.values()) > 250
    assert winners(RJ.attach_candidates(towns, idx, "best")) == want
    shuffled = RJ.build_cell_index(metros, metric, best=1, chunk_size=2, max_broadcast_entries=0)
    assert winners(RJ.attach_candidates(towns, shuffled, "best")) == want
    at, by, plain = (os.path.join(tmp_out, x) for x in ("index", "towns", "plain"))
    save_cell_index(idx, at, 4)
    save_places_by_cell(towns, by, buckets=4, index=idx)
    save_places_by_cell(towns, plain, metric, buckets=4)
    for stored in (by, plain):
        assert winners(attach_stored(spark, stored, load_cell_index(spark, at, False), "best")) == want


def test_first_three_as_from_all_metros(spark, monkeypatch):
    monkeypatch.setattr(RJ, "SPLIT_ENTRIES", 6)
    metros, towns = crowd(spark, 6)
    lists = RJ.attach_candidates(towns, RJ.build_cell_index(metros), "list")
    want = {(r["geonameid"], i, c["metro_id"]) for r in lists.collect() for i, c in enumerate(r["candidates"][:3], 1)}
    got = strongest_metros(towns, metros, 3).select("geonameid", "rank", "metro_id").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_entries_of_a_cell_stay_few(spark):
    """Four times the metros on the same ground: the entries grow with them, a town's metros do not."""
    r = random.Random(3)
    rows = [(i, "M", 50 + r.random(), 20 + r.random(), 1_000_000 + r.randrange(500_000)) for i in range(2400)]
    sizes = []
    for n in (600, 2400):
        idx = RJ.build_cell_index(spark.createDataFrame(rows[:n], SCHEMA), best=1)
        sizes.append((idx.entries / n, idx.entries / idx.cells))
        everything = RJ.build_cell_index(spark.createDataFrame(rows[:n], SCHEMA), chunk_size=10_000)
        assert everything.max_per_cell == n
    assert sizes[1][0] < 1.5 * sizes[0][0] and max(s for _, s in sizes) < 2 * RJ.SPLIT_ENTRIES, sizes


@pytest.mark.parametrize("best", [1, 3])
def test_entries_are_pruned_without_a_shuffle(spark, best):
    """Entries meet the bar of their part by a broadcast; a bar that is not small goes by a shuffle, with the same rows."""
    metros, _ = crowd(spark)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    entries = RJ.metro_cells(metros).select(F.col("cell").alias("base"), one.alias("parts"), none.alias("si"), none.alias("sj"), "m")
    kept = RJ._survivors(RJ.materialize(entries), "haversine", RJ.DEFAULT_CELL_DEG, best)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan, plan
    key = lambda df: sorted((r["base"], r["m"]["metro_id"]) for r in df.collect())
    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(RJ, "join_small", lambda big, small, on, how: big.join(small, on, how))
        shuffled = RJ._survivors(entries, "haversine", RJ.DEFAULT_CELL_DEG, best)
    assert 0 < len(key(kept)) < entries.count() and key(kept) == key(shuffled)


def test_pairs_of_hot_cells_are_not_shuffled(spark):
    """Pairs of a cell in chunks are not gathered by town again; the same pairs come out."""
    metros, towns = crowd(spark)
    towns = towns.filter(F.col("longitude").isNotNull())
    one, many = RJ.radius_join(towns, metros), RJ.radius_join(towns, metros, chunk_size=3)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_rk" not in plan and "collect_list" not in plan, plan
    key = lambda df: sorted((x[0], x[1], round(x[3], 9)) for x in df.collect())
    assert key(one) == key(many) and len(key(one)) > 1000


@pytest.mark.parametrize("metric", ["haversine", "mercator_cos"])
def test_bounds_of_parts_hold(spark, metric):
    """Bounds of all parts of a part are worked out in batches; they hold at points of the parts."""
    metros, _ = crowd(spark)
    cells = RJ.metro_cells(metros.filter("latitude between 50 and 54"), metric)
    entries = cells.select(F.col("cell").alias("base"), F.lit(1).cast("long").alias("parts"), F.lit(0).cast("long").alias("si"),
                           F.lit(0).cast("long").alias("sj"), "m")
    whole = RJ._quotients(entries, metric, 0.25, 1)
    got = RJ._quotients(entries, metric, 0.25, 4)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    r = F.col("m.radius")
    lat = F.floor(F.col("base") / 1440) * 0.25 - 90.0 + (F.col("si") + F.rand(1)) * 0.25 / F.col("parts")
    lon = F.pmod(F.col("base"), F.lit(1440)) * 0.25 - 180.0 + (F.col("sj") + F.rand(2)) * 0.25 / F.col("parts")
    for df, most in ((whole, 1), (got, 16)):
        at = RJ.materialize(df.withColumn("y", lat).withColumn("x", lon))
        at = at.withColumn("_tlat", F.col("y")).withColumn("_tlon", F.col("x")).withColumn("_tcos", F.cos(F.radians("y"))) \
            .withColumn("_ty", RJ.mercator_y(F.col("y")))
        q = at.withColumn("q", RJ._pair_distance(metric, F.col("m")) / r)
        assert q.filter((F.col("q") < F.col("low") - 1e-9) | (F.col("q") > F.col("high") + 1e-9)).count() == 0
        n = entries.count()
        assert 0 < q.count() <= most * n and q.filter((F.col("parts") == (1 if most == 1 else 4))).count() == q.count()
    # what is left out lies beyond the radius: every point within it has its part
    left = {(e["base"], e["si"], e["sj"], e["m"]["metro_id"]) for e in got.collect()}
    assert 100 < len(left) < 16 * n
