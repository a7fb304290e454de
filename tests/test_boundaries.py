"""Boundary parsing, point-in-ring semantics and nested removal."""

import json
import os

from pyspark.sql import functions as F

from townpull.functions.geo import point_in_ring, ring_is_usable
from townpull.operators.boundaries import attach_boundaries, remove_nested
from townpull.sources.boundaries import scan_boundaries

SQ = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]  # (lat, lon) square


def _ring_df(spark, pts, ring=SQ):
    return spark.createDataFrame([(float(a), float(b), [{"lat": x, "lon": y} for x, y in ring]) for a, b in pts],
                                 "lat double, lon double, ring array<struct<lat:double,lon:double>>")


def test_point_in_ring_strict(spark):
    pts = [(1, 1), (0, 1), (2, 2), (1, 2), (3, 1), (-0.5, 1), (1.999, 0.001)]
    got = [r[0] for r in _ring_df(spark, pts).select(point_in_ring("lat", "lon", "ring")).collect()]
    assert got == [True, False, False, False, False, False, True]
    open_ring = _ring_df(spark, [(1, 1)], SQ[:-1]).select(point_in_ring("lat", "lon", "ring")).first()[0]
    assert open_ring is True


def test_ring_usable(spark):
    rings = [SQ, SQ[:2], [(0, 0), (1, 1), (2, 2)], [(0, 0), (0, 0), (1, 1), (0, 0)]]
    df = spark.createDataFrame([([{"lat": float(a), "lon": float(b)} for a, b in r],) for r in rings] + [(None,)],
                               "ring array<struct<lat:double,lon:double>>")
    assert [r[0] for r in df.select(ring_is_usable("ring")).collect()] == [True, False, False, False, False]


def test_scan_boundaries_documents(spark, tmp_out):
    d = os.path.join(tmp_out, "docs")
    os.makedirs(d)
    poly = {"features": [{"geometry": {"type": "Polygon", "coordinates": [
        [[21.0, 52.1], [21.1, 52.2], [21.2, 52.1], [21.0, 52.1]], [[21.05, 52.12], [21.06, 52.13], [21.07, 52.12]]]}}]}
    multi = {"name": "Two", "country_code": "PL", "features": [{"geometry": {"type": "MultiPolygon", "coordinates": [
        [[[0, 0], [0, 1], [1, 1], [0, 0]]], [[[5, 5], [5, 6], [6, 6], [5, 5]], [[5.1, 5.1], [5.2, 5.2], [5.1, 5.2]]]]}}]}
    point = {"features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}]}
    for fname, doc in [("Gdańsk.json", poly), ("two.json", multi), ("pt.json", point), ("none.json", {"features": []})]:
        with open(os.path.join(d, fname), "w", encoding="utf-8") as fh:
            json.dump(doc, fh, indent=2)
    rows = {r["name"]: r for r in scan_boundaries(spark, d).collect()}
    g = rows["Gdańsk"]["polygons"]
    assert len(g) == 1 and g[0][0]["lat"] == 52.1 and g[0][0]["lon"] == 21.0  # holes dropped, (lat, lon)
    assert len(rows["Two"]["polygons"]) == 2 and rows["Two"]["country_code"] == "PL"
    assert rows["pt"]["polygons"] is None and rows["none"]["polygons"] is None


def test_remove_nested_keeps_holders_and_edges(spark):
    ring = [{"lat": float(a), "lon": float(b)} for a, b in SQ]
    rows = [(1, "A", "PL", 1.0, 1.0, [ring]),          # holder: always kept
            (2, "B", "PL", 1.0, 1.0, None),            # inside -> dropped
            (3, "C", "PL", 0.0, 1.0, None),            # on edge -> kept
            (4, "D", "PL", 5.0, 5.0, None),            # outside -> kept
            (5, "E", "PL", 1.5, 1.5, []),              # empty list counts as no polygons -> dropped
            (6, "F", "PL", None, None, None),          # no coordinates -> kept
            (7, "G", "PL", 0.5, 0.5, [[{"lat": 0.0, "lon": 0.0}, {"lat": 0.0, "lon": 0.0}]]),  # unusable ring, holder
            (8, "H", "PL", 9.0, 9.0, [ring])]                # second ring over the same cells
    df = spark.createDataFrame(rows, "geonameid int, name string, country_code string, latitude double, "
                                     "longitude double, polygons array<array<struct<lat:double,lon:double>>>")
    for engine in ("arrow", "jvm"):
        for kw in ({}, {"chunk_size": 1}, {"max_broadcast_vertices": 0}, {"chunk_size": 1, "max_broadcast_vertices": 0}):
            kept = sorted(r[0] for r in remove_nested(df, engine=engine, **kw).select("geonameid").collect())
            assert kept == [1, 3, 4, 6, 7, 8], (engine, kw)


def test_remove_nested_engines_agree_on_random_rings(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = []
    for i in range(40):  # star-shaped, self-intersecting and open rings
        c_lat, c_lon = rng.uniform(49, 53), rng.uniform(16, 22)
        k = int(rng.integers(3, 12))
        ang = np.sort(rng.uniform(0, 2 * np.pi, k)) if i % 3 else rng.uniform(0, 2 * np.pi, k)
        rad = rng.uniform(0.05, 0.4, k)
        ring = [{"lat": float(c_lat + r * np.sin(a)), "lon": float(c_lon + r * np.cos(a))} for a, r in zip(ang, rad)]
        if i % 2:
            ring.append(ring[0])
        rows.append((100000 + i, f"R{i}", "PL", float(c_lat), float(c_lon), [ring]))
    pts = rng.uniform([49, 16], [53, 22], size=(3000, 2))
    rows += [(i, f"P{i}", "PL", float(a), float(b), None) for i, (a, b) in enumerate(pts)]
    df = spark.createDataFrame(rows, "geonameid int, name string, country_code string, latitude double, "
                                     "longitude double, polygons array<array<struct<lat:double,lon:double>>>")
    a = sorted(r[0] for r in remove_nested(df, engine="arrow").select("geonameid").collect())
    j = sorted(r[0] for r in remove_nested(df, engine="jvm").select("geonameid").collect())
    assert a == j and 40 < len(a) < 3040


def test_attach_boundaries_dedupe_and_fanout(spark):
    ring = [[{"lat": 0.0, "lon": 0.0}, {"lat": 0.0, "lon": 1.0}, {"lat": 1.0, "lon": 1.0}]]
    places = spark.createDataFrame([(1, "X", "PL"), (2, "X", "DE"), (3, "Y", "PL")],
                                   "geonameid int, name string, country_code string")
    b = spark.createDataFrame([("X", "PL", ring), ("X", "PL", ring + ring), ("X", "DE", ring)],
                              "name string, country_code string, polygons array<array<struct<lat:double,lon:double>>>")
    one = {r["geonameid"]: r["polygons"] for r in attach_boundaries(places, b).collect()}
    assert len(one) == 3 and len(one[1]) == 2 and len(one[2]) == 1 and one[3] is None
    fan = attach_boundaries(places, b, fanout=True).collect()
    assert len(fan) == 2 * 3 + 1  # both X rows fan out over the 3 X boundaries; Y stays once


def test_remove_nested_vertex_chunks_and_slices(spark, monkeypatch):
    import townpull.operators.arrow_eval as AE
    ring = [{"lat": float(a), "lon": float(b)} for a, b in SQ]
    rows = [(100 + i, "H", "PL", 9.0, 9.0, [ring]) for i in range(6)]
    rows += [(i, "P", "PL", float(0.1 + 0.3 * (i % 7)), float(0.1 + 0.3 * (i // 7)), None) for i in range(49)]
    df = spark.createDataFrame(rows, "geonameid int, name string, country_code string, latitude double, "
                                     "longitude double, polygons array<array<struct<lat:double,lon:double>>>")
    base = sorted(r[0] for r in remove_nested(df, engine="jvm").select("geonameid").collect())
    monkeypatch.setattr(AE, "MAX_PAIRS_PER_SLICE", 7)
    for kw in ({}, {"vertex_chunk": 5}, {"vertex_chunk": 5, "max_broadcast_vertices": 0}):
        got = sorted(r[0] for r in remove_nested(df, engine="arrow", **kw).select("geonameid").collect())
        assert got == base, kw


def test_map_layers_on_plain_places(spark):
    from townpull.plans.maps import map_layers
    from townpull.sources.fixture import places
    layers = map_layers(places(spark, "/root/testdata/sf0.001"))
    assert set(layers) == {"markers", "view"}
    colors = {r[0] for r in layers["markers"].select("color").distinct().collect()}
    assert colors <= {"red", "green", "blue"} and layers["view"].count() == 1


def test_scanned_responses_join_on_the_default_keys(spark, tmp_path):
    import json

    from townpull.operators.boundaries import attach_boundaries
    from townpull.sources.boundaries import scan_boundaries
    ring = [[[21.0, 52.0], [21.1, 52.0], [21.1, 52.1], [21.0, 52.0]]]
    for stem, doc in (("Warszawa", {"properties": {"country_code": "pl"}}), ("Paris", {"properties": {}})):
        (tmp_path / f"{stem}.json").write_text(json.dumps(
            {"features": [doc | {"geometry": {"type": "Polygon", "coordinates": ring}}]}))
    places = spark.createDataFrame([(1, "Warszawa", "PL"), (2, "Paris", "FR")], "geonameid int, name string, country_code string")
    got = {r["geonameid"]: r["polygons"] for r in attach_boundaries(places, scan_boundaries(spark, str(tmp_path))).collect()}
    assert got[1] and got[2] is None
    named = scan_boundaries(spark, str(tmp_path), country_code="FR")
    assert {(r["name"], r["country_code"]) for r in named.collect()} == {("Warszawa", "FR"), ("Paris", "FR")}


def test_boundary_ties_do_not_depend_on_order(spark):
    from pyspark.sql import functions as F

    from townpull.operators.boundaries import attach_boundaries
    kind = "name string, country_code string, polygons array<array<struct<lat:double,lon:double>>>"
    rows = [("A", "PL", [[(1.0, float(k)), (2.0, 2.0), (3.0, 1.0)]]) for k in range(9)]
    place = spark.createDataFrame([(1, "A", "PL")], "geonameid int, name string, country_code string")
    picked = {str(attach_boundaries(place, spark.createDataFrame(r, kind).repartition(3, F.rand(1))).first()["polygons"])
              for r in (rows, rows[::-1], rows[4:] + rows[:4])}
    assert len(picked) == 1


def test_a_ring_of_many_vertices_over_many_cells(spark):
    """The index holds a ring's border, not its vertices in each of its cells; both engines agree
    with the plain test on the whole ring."""
    import math

    from townpull.operators.boundaries import _ring_cells, boundary_rings
    n = 50_000
    ring = [(math.sin(2 * math.pi * k / n) * (8 + math.sin(40 * math.pi * k / n)),
             math.cos(2 * math.pi * k / n) * (12 + math.sin(26 * math.pi * k / n))) for k in range(n)]
    kind = "geonameid int, latitude double, longitude double, polygons array<array<struct<lat:double,lon:double>>>"
    points = [(i, -10 + 20 * (i * 7919 % 3001) / 3000, -14 + 28 * (i * 104729 % 2999) / 2998, None) for i in range(1, 1500)]
    df = spark.createDataFrame([(0, 0.0, 0.0, [ring]), *points], kind)
    cells = _ring_cells(boundary_rings(df), 0.25)
    r = cells.selectExpr("count(*) AS cells", "sum(nv) AS edges", "count_if(r.full) AS full", "count(DISTINCT cell) AS d").first()
    assert r["cells"] == r["d"] > 4000 and r["full"] > 4000 and r["edges"] < 40 * n
    import numpy as np
    ay, ax = np.array(ring).T
    by, bx = np.roll(ay, -1), np.roll(ax, -1)
    want = {0}
    for i, y, x, _ in points:
        s = (ay > y) != (by > y)
        if (x < ax[s] + (y - ay[s]) * (bx[s] - ax[s]) / (by[s] - ay[s])).sum() % 2 == 0:
            want.add(i)
    got = {r["geonameid"] for r in remove_nested(df).select("geonameid").collect()}
    assert got == want
    some = df.filter("geonameid % 25 = 0")
    got = {r["geonameid"] for r in remove_nested(some, engine="jvm").select("geonameid").collect()}
    assert got == {i for i in want if i % 25 == 0}
