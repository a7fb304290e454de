"""Grid radius join = brute force, on worldwide points (poles and the antimeridian included)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from townpull.operators.radius_join import attach_candidates, bbox_candidates, build_cell_index, radius_join
from townpull.operators.ranking import top_metros
from townpull.plans.assign import assign_metros

R_KM, R_M = 6371.0, 6378137.0


def _points(n, seed, lat_max=90.0):
    rng = np.random.default_rng(seed)
    lat = rng.uniform(-lat_max, lat_max, n)
    lon = rng.uniform(-180, 180, n)
    # crowd some points near poles, the antimeridian and each other
    lat[: n // 10] = rng.uniform(84, 90, n // 10) * rng.choice([-1, 1], n // 10)
    lon[n // 10: n // 5] = rng.choice([-1, 1], n // 10) * rng.uniform(179, 180, n // 10)
    return lat, lon


def _frames(spark, n_towns=3000, n_metros=300, seed=7):
    tl, to = _points(n_towns, seed)
    ml, mo = _points(n_metros, seed + 1)
    rng = np.random.default_rng(seed + 2)
    pop = rng.integers(0, 5_000_000, n_metros)
    # metros sit near some towns so that pairs exist everywhere
    idx = rng.integers(0, n_towns, n_metros // 2)
    ml[: n_metros // 2] = np.clip(tl[idx] + rng.normal(0, 0.3, n_metros // 2), -90, 90)
    mo[: n_metros // 2] = ((to[idx] + rng.normal(0, 0.3, n_metros // 2)) + 180) % 360 - 180
    towns = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(tl, to))],
                                  "geonameid int, latitude double, longitude double")
    metros = spark.createDataFrame([(100000 + i, f"M{i}", float(a), float(b), int(p))
                                    for i, (a, b, p) in enumerate(zip(ml, mo, pop))],
                                   "geonameid int, name string, latitude double, longitude double, population int")
    return towns, metros, (tl, to), (ml, mo, pop)


def _brute(t, m, metric):
    tl, to = np.radians(t[0])[:, None], np.radians(t[1])[:, None]
    ml, mo = np.radians(m[0])[None, :], np.radians(m[1])[None, :]
    r = 10 + 90 * (1 - np.exp(-m[2].astype(float) / 1443000.0))[None, :]
    if metric == "haversine":
        a = np.sin((ml - tl) / 2) ** 2 + np.cos(tl) * np.cos(ml) * np.sin((mo - to) / 2) ** 2
        d = R_KM * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))
    else:
        y = lambda p: np.log(np.tan(math.pi / 4 + p / 2))
        d = np.sqrt((R_M * (to - mo)) ** 2 + (R_M * (y(tl) - y(ml))) ** 2) * np.cos(tl) / 1000
    ti, mi = np.nonzero(d < r)
    # drop pairs within 1e-9 relative of the radius (float-order noise between engines)
    keep = np.abs(d[ti, mi] - r[0, mi]) > 1e-9 * r[0, mi]
    return {(int(a), 100000 + int(b)) for a, b in zip(ti[keep], mi[keep])}, d, r


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
@pytest.mark.parametrize("metric", ["haversine", "mercator_cos"])
@pytest.mark.parametrize("variant", ["broadcast", "shuffle", "hot_chunks"])
def test_grid_equals_brute_force(spark, metric, variant, engine, monkeypatch):
    import townpull.operators.radius_join as RJ
    monkeypatch.setattr(RJ, "DEFAULT_ENGINE", engine)
    towns, metros, t, m = _frames(spark)
    kw = {}
    if variant == "shuffle":
        kw["max_broadcast_entries"] = 0
    if variant == "hot_chunks":
        kw["chunk_size"] = 1
    got = {(r["geonameid"], r["metro_id"]) for r in radius_join(towns, metros, metric=metric, **kw).collect()}
    want, d, r = _brute(t, m, metric)
    assert want, "fixture should produce pairs"
    near = {(a, b) for (a, b) in got ^ want if abs(d[a, b - 100000] - r[0, b - 100000]) < 1e-6 * r[0, b - 100000]}
    assert (got ^ want) - near == set()


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_polar_only_hot_cells(spark, engine, monkeypatch):
    """Mercator: every metro sits in the two polar cells; when only those exceed the chunk
    size, polar towns are picked by a latitude filter that the scan can prune."""
    import townpull.operators.radius_join as RJ
    monkeypatch.setattr(RJ, "DEFAULT_ENGINE", engine)
    towns, metros, t, m = _frames(spark)
    idx = build_cell_index(metros, metric="mercator_cos", chunk_size=50)
    assert idx.hot_polar_only
    got = {(r["geonameid"], r["metro_id"]) for r in radius_join(towns, metros, metric="mercator_cos",
                                                                 chunk_size=50).collect()}
    want, d, r = _brute(t, m, "mercator_cos")
    near = {(a, b) for (a, b) in got ^ want if abs(d[a, b - 100000] - r[0, b - 100000]) < 1e-6 * r[0, b - 100000]}
    assert (got ^ want) - near == set()


def test_polar_filter_reaches_the_scan(spark, tmp_out, monkeypatch):
    import os

    from townpull.operators import radius_join as module
    towns, metros, _, _ = _frames(spark, 500, 80)
    path = os.path.join(tmp_out, "towns")
    towns.write.parquet(path)
    idx = build_cell_index(metros, metric="mercator_cos", chunk_size=20)
    assert idx.hot_polar_only
    stored = []   # the polar towns are stored before they are numbered
    monkeypatch.setattr(module, "materialize", lambda df: stored.append(df) or df)
    attach_candidates(spark.read.parquet(path), idx, "best")
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(latitude,85.0),LessThan(latitude,-85.0))]" in plan


def test_index_reports_hot_cells_and_no_broadcast(spark):
    towns, metros, _, _ = _frames(spark, 200, 100)
    idx = build_cell_index(metros, chunk_size=1, max_broadcast_entries=0)
    assert idx.hot_cells is not None and not idx.broadcast
    assert idx.max_per_cell > 1


def test_best_equals_top1_of_pairs(spark):
    towns, metros, _, _ = _frames(spark, 1500, 200, seed=11)
    idx = build_cell_index(metros)
    best = {r["geonameid"]: (r["best"]["metro_id"] if r["best"] else None)
            for r in attach_candidates(towns, idx, "best").collect()}
    top = {r["geonameid"]: r["metro_id"] for r in top_metros(radius_join(towns, metros)).collect()}
    assert {k: v for k, v in best.items() if v is not None} == top
    cands = attach_candidates(towns, idx, "list").collect()
    for row in cands:
        first = row["candidates"][0]["metro_id"] if row["candidates"] else None
        assert first == best[row["geonameid"]]


@pytest.mark.parametrize("mode", ["best", "list"])
def test_engines_agree(spark, mode):
    towns, metros, _, _ = _frames(spark, 2000, 250, seed=3)
    for kw in ({}, {"chunk_size": 1}):
        idx = build_cell_index(metros, **kw)
        a = attach_candidates(towns, idx, mode, engine="arrow").orderBy("geonameid").collect()
        j = attach_candidates(towns, idx, mode, engine="jvm").orderBy("geonameid").collect()
        col = "best" if mode == "best" else "candidates"
        for ra, rj in zip(a, j, strict=True):
            ca, cj = ra[col], rj[col]
            if mode == "best":
                ca, cj = ([ca] if ca else []), ([cj] if cj else [])
            # same metros in the same order; values equal up to last-ulp libm differences
            assert [c["metro_id"] for c in ca] == [c["metro_id"] for c in cj]
            for x, y in zip(ca, cj):
                assert x["force"] == pytest.approx(y["force"], rel=1e-12)
                assert x["distance"] == pytest.approx(y["distance"], rel=1e-12)


def test_hot_path_gives_same_assignment(spark):
    towns, metros, _, _ = _frames(spark, 1500, 200, seed=5)
    a = {r[0]: r[1] for r in attach_candidates(towns, build_cell_index(metros), "best")
         .select("geonameid", "best.metro_id").collect()}
    b = {r[0]: r[1] for r in attach_candidates(towns, build_cell_index(metros, chunk_size=1), "best")
         .select("geonameid", "best.metro_id").collect()}
    assert a == b


def _places(spark, rows):
    return spark.createDataFrame(rows, "geonameid int, name string, latitude double, longitude double, "
                                       "feature_code string, admin2_code string, population int, country_code string")


def test_strict_radius_tie_and_null_coordinates(spark):
    # metro with radius exactly G1(1443000) ; a town exactly on a computed distance is rare, so test
    # strictness through a town far outside and one inside; null coordinates never match
    rows = [(1, "Big", 50.0, 20.0, "PPLC", "A", 1_000_000, "PL"),
            (2, "In", 50.1, 20.0, "PPL", "B", 10, "PL"),
            (3, "Out", 55.0, 20.0, "PPL", "B", 10, "PL"),
            (4, "NoLat", None, 20.0, "PPL", "B", 10, "PL"),
            (5, "TieA", 48.0, 10.0, "PPLC", "C", 1_000_000, "DE"),
            (6, "TieB", 48.0, 10.2, "PPLC", "D", 1_000_000, "DE"),
            (7, "Mid", 48.0, 10.1, "PPL", "E", 10, "DE")]
    out = {r["geonameid"]: r for r in assign_metros(_places(spark, rows), rule="share_only").collect()}
    assert out[1]["assigned_metro_id"] == 1 and out[1]["isMetro"]
    assert out[2]["assigned_metro_id"] == 1
    assert out[3]["assigned_metro_id"] is None
    assert out[4]["assigned_metro_id"] is None
    assert out[7]["assigned_metro_id"] == 5  # equal force and distance: lower metro id wins
    assert out[2]["influence_radius"] is None


def test_empty_input_and_no_metros(spark):
    empty = _places(spark, [])
    assert assign_metros(empty, rule="share_only").count() == 0
    zero = _places(spark, [(1, "A", 50.0, 20.0, "PPL", "X", 0, "PL")])
    out = assign_metros(zero, rule="admin_seat").collect()
    assert len(out) == 1 and out[0]["isMetro"] is False and out[0]["assigned_metro_id"] is None


def test_properties_on_fixture(spark):
    from townpull.sources.fixture import places
    out = assign_metros(places(spark, "/root/testdata/sf0.01"), rule="share_only", candidates=True)
    rows = out.collect()
    ids = [r["geonameid"] for r in rows]
    assert len(ids) == len(set(ids)) == 1199
    metros = {r["geonameid"] for r in rows if r["isMetro"]}
    for r in rows:
        if r["isMetro"]:
            assert r["assigned_metro_id"] == r["geonameid"]
            continue
        if r["assigned_metro_id"] is not None:
            assert r["assigned_metro_id"] in metros
        for c in r["candidates"]:
            assert math.exp(-1.4) < c["force"] <= 1.0
            assert c["metro_id"] in metros
    assert sum(1 for r in rows if not r["isMetro"] and r["assigned_metro_id"] is not None) == 1035


def test_shuffle_path_splits_a_hot_town_cell(spark):
    """Index too big to broadcast + one cell holding ~90 % of the towns: AQE splits the
    hot partition of the town side (skew join) and the result equals the broadcast plan."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rng = np.random.default_rng(9)
        n = 20000
        lat = np.where(rng.random(n) < 0.9, 50.05 + rng.random(n) * 0.1, rng.uniform(45, 55, n))
        lon = np.where(lat < 50.15, 20.05 + rng.random(n) * 0.1, rng.uniform(15, 25, n))
        towns = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))],
                                      "geonameid int, latitude double, longitude double").repartition(8)
        metros = spark.createDataFrame([(100000 + i, f"M{i}", float(a), float(b), 500000)
                                        for i, (a, b) in enumerate(zip(rng.uniform(45, 55, 60), rng.uniform(15, 25, 60)))],
                                       "geonameid int, name string, latitude double, longitude double, population int")
        shuffled = attach_candidates(towns, build_cell_index(metros, max_broadcast_entries=0), "best")
        rows = shuffled.collect()  # runs the Dataset's own adaptive plan to its final form
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "skew=true" in plan, plan
        got = {r["geonameid"]: (r["best"]["metro_id"] if r["best"] else None) for r in rows}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    want = {r[0]: r[1] for r in attach_candidates(towns, build_cell_index(metros), "best")
            .select("geonameid", "best.metro_id").collect()}
    assert got == want and len(got) == 20000


def test_arrow_slicing_is_transparent(spark, monkeypatch):
    """Batches are evaluated in slices bounded by pair count; tiny slices change nothing."""
    import townpull.operators.arrow_eval as AE
    towns, metros, _, _ = _frames(spark, 1500, 200, seed=21)
    idx = build_cell_index(metros)
    want = attach_candidates(towns, idx, "list", engine="arrow").orderBy("geonameid").collect()
    monkeypatch.setattr(AE, "MAX_PAIRS_PER_SLICE", 5)
    got = attach_candidates(towns, idx, "list", engine="arrow").orderBy("geonameid").collect()
    assert got == want


def test_reassigning_an_output_replaces_derived_columns(spark):
    from townpull.sources.fixture import places
    first = assign_metros(places(spark, "/root/testdata/sf0.001"), rule="share_only")
    again = assign_metros(first, rule="share_only")
    assert again.columns == first.columns
    a = {r["geonameid"]: r["assigned_metro_id"] for r in first.collect()}
    b = {r["geonameid"]: r["assigned_metro_id"] for r in again.collect()}
    assert a == b


@pytest.mark.parametrize("way", [{}, {"max_broadcast_entries": 0}, {"chunk_size": 2}, {"chunk_size": 2, "max_broadcast_entries": 0}])
def test_boxes_equal_brute_force_and_are_dealt_out(spark, way):
    towns, metros, (tl, to), (ml, mo, pop) = _frames(spark, 1500, 200)
    lost = spark.createDataFrame([(9001, None, 3.0), (9002, 3.0, None)], towns.schema)
    delta = (10 + 90 * (1 - np.exp(-pop.astype(float) / 1443000.0))) / R_KM
    ratio = np.sin(delta) / np.cos(np.radians(ml))
    wide = (np.abs(ml) + np.degrees(delta) >= 90) | (ratio >= 1)
    lon_half = np.degrees(np.arcsin(np.minimum(ratio, 1))) * 1.000001 + 1e-9
    dlon = np.abs((to[:, None] - mo[None, :] + 180) % 360 - 180)
    inside = (np.abs(tl[:, None] - ml[None, :]) <= np.degrees(delta) * 1.000001 + 1e-9) & (wide | (dlon <= lon_half))
    out = bbox_candidates(towns.unionAll(lost).coalesce(1), metros, **way)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((int(a), 100000 + int(b)) for a, b in zip(*np.nonzero(inside))) and len(got) > 150
    plan = out._jdf.queryExecution().executedPlan().toString()
    if way.get("max_broadcast_entries") != 0:
        assert "RoundRobinPartitioning" in plan, plan
    elif "chunk_size" in way:
        assert "hashpartitioning(_cell" in plan and "_chunk" in plan.split("hashpartitioning(_cell")[1].split(")")[0], plan


def test_listed_candidates_are_dealt_out_evenly(spark, tmp_out):
    """A small file of towns is read by one task, which must not list the candidates of all of them."""
    import os

    from townpull.sources.fixture import places
    path = os.path.join(tmp_out, "places")
    places(spark, "/root/testdata/sf0.001").coalesce(1).write.parquet(path)
    plain = spark.read.parquet(path)
    out = assign_metros(plain, rule="admin_seat", candidates=True)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert plain.rdd.getNumPartitions() == 1 and len(sizes) > 1 and max(sizes) < sum(sizes) / 2, sizes
