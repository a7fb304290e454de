"""Nested removal where many rings meet in a cell: the same places stay, and a place meets few entries."""

import random

import pytest
from pyspark.sql import functions as F

from townpull.operators import boundaries as BD
from townpull.sources.fixture import diamond_ring

SCHEMA = "geonameid int, latitude double, longitude double, feature_code string"


def crowd(spark, rings, n):
    r = random.Random(8)
    rows = [(i, 50 + r.random(), 20 + 1.5 * r.random(), "M") for i in range(rings)]
    rows += [(10_000 + i, 49.5 + 2 * r.random(), 19.5 + 2.5 * r.random(), "T") for i in range(n)] + [(99_999, None, 20.0, "T")]
    poly = F.when(F.col("feature_code") == "M", F.array(diamond_ring(F.col("latitude"), F.col("longitude"))))
    return spark.createDataFrame(rows, SCHEMA).withColumn("polygons", poly)


@pytest.mark.parametrize("engine,bound", [("arrow", 5_000_000), ("jvm", 0)])
def test_same_places_stay(spark, monkeypatch, engine, bound):
    df = crowd(spark, 150, 800)
    monkeypatch.setattr(BD, "SPLIT_RINGS", 10**9)
    want = sorted(r[0] for r in BD.remove_nested(df).select("geonameid").collect())
    monkeypatch.setattr(BD, "SPLIT_RINGS", 3)
    got = sorted(r[0] for r in BD.remove_nested(df, engine=engine, max_broadcast_vertices=bound).select("geonameid").collect())
    assert got == want and 99_999 in got and 300 < len(got) < 900


def test_dense_cells_hold_few_entries(spark):
    df = crowd(spark, 1500, 0)
    rc = BD._ring_cells(BD.boundary_rings(df.filter("feature_code = 'M'")), 0.25)
    cells, parts = BD._refine_rings(rc, 0.25)
    before = rc.groupBy("cell").count().agg(F.max("count")).first()[0]
    after = cells.groupBy("cell").count().agg(F.avg("count")).first()[0]
    assert parts is not None and before > 100 and after < 16, (before, after)


def test_candidate_lists_of_a_full_cell_are_not_shuffled(spark):
    from townpull.plans.assign import assign_metros
    r = random.Random(4)
    rows = [(i, "M" if i % 2 else "T", 50.1 + r.random() / 100, 20.1 + r.random() / 100, "P", "PPLA" if i % 2 else "PPL", "C", "1", "2", "3", 10)
            for i in range(2200)]
    pl = spark.createDataFrame(rows, "geonameid int, name string, latitude double, longitude double, feature_class string, feature_code string, "
                                     "country_code string, admin1_code string, admin2_code string, admin3_code string, population int")
    out = assign_metros(pl, rule="admin_seat", candidates=True)
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in out.filter("not isMetro").select(F.size("candidates")).collect()} == {1100}


def test_split_entries_tell_where_points_lie(spark):
    """Parts of entries are made in batches, not row by row; in its part a point meets the same answer as from the ring."""
    df = crowd(spark, 40, 0)
    rings = BD.boundary_rings(df)
    entries = BD.materialize(BD._ring_cells(rings, 0.25).select(F.col("cell").alias("base"), *(F.lit(k).cast("long").alias(c) for c, k in (("parts", 1), ("si", 0), ("sj", 0))), "r"))
    got = BD._split_entries(entries, 0.25)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "exists(" not in plan, plan
    parts = {}
    for e in got.collect():
        assert e["parts"] == 4 and e["nv"] == max(len(e["r"]["edges"]), 1)
        parts.setdefault((e["base"], e["si"], e["sj"]), []).append(e["r"])

    def crossings(y, x, edges):
        return sum((a > y) != (b > y) and x < o + (y - a) * (p - o) / (b - a) for (a, o), (b, p) in edges) % 2 == 1

    r, found = random.Random(3), 0
    whole = {x["id"]: [(p["lat"], p["lon"]) for p in x["ring"]] for x in rings.collect()}
    for _ in range(3000):
        y, x = 49.9 + 1.2 * r.random(), 19.9 + 1.6 * r.random()
        i, j = int((y + 90) / 0.25), int((x + 180) / 0.25)
        here = parts.get((i * 1440 + j, int(((y + 90) / 0.25 - i) * 4), int(((x + 180) / 0.25 - j) * 4)), [])
        by_part = {e["id"] for e in here if e["full"] or crossings(y, x, [(tuple(s["a"]), tuple(s["b"])) for s in e["edges"]])}
        assert by_part == {k for k, v in whole.items() if crossings(y, x, list(zip(v, v[1:])))}
        found += len(by_part)
    assert found > 2000
