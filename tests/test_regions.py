"""Unions of rings: shared borders, corners, self-crossing rings, the antimeridian and poles."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from townpull.functions.geo import ring_is_usable
from townpull.operators.boundaries import boundary_rings, remove_nested
from townpull.operators.regions import boundary_outline, crosses_itself, ring_verdicts, split_antimeridian

KIND = "geonameid int, latitude double, longitude double, polygons array<array<struct<lat:double,lon:double>>>"


def box(s, w, n, e, turn=0):
    ring = [(s, w), (s, e), (n, e), (n, w)]
    ring = ring[turn % 4:] + ring[:turn % 4]
    return [(float(a), float(b)) for a, b in (ring if turn % 2 else ring[::-1])]


def frame(spark, rings, points, per_holder=1):
    """Holders far away from everything (ids from 100000) with the rings, and the points by number."""
    rows = [(100_000 + i, -60.0, 100.0, [[(float(a), float(b)) for a, b in r] for r in rings[i:i + per_holder]])
            for i in range(0, len(rings), per_holder)]
    return spark.createDataFrame(rows + [(i, float(a), float(b), None) for i, (a, b) in enumerate(points)], KIND)


def removed(df, n, **kw):
    kept = {r[0] for r in remove_nested(df, **kw).select("geonameid").collect()}
    return {i for i in range(n) if i not in kept}


WAYS = ({}, {"engine": "jvm"}, {"chunk_size": 2}, {"chunk_size": 2, "engine": "jvm", "max_broadcast_vertices": 0})


@pytest.mark.parametrize("way", WAYS, ids=str)
def test_union_of_lattice_boxes(spark, way):
    """A lattice place lies in the union if all four quadrants around it do."""
    rng = random.Random(4)
    rings, boxes = [], []
    for i in range(60):
        s, w = rng.randrange(8), rng.randrange(8)
        n, e = s + rng.randint(1, 3), w + rng.randint(1, 3)
        boxes.append((s, w, n, e))
        rings.append(box(s, w, n, e, rng.randrange(8)))
    rings.append(rings[0])   # a district held twice
    points = [(a / 2, b / 2) for a in range(-1, 24) for b in range(-1, 24)]

    def held(y, x):
        return any(s < y < n and w < x < e for s, w, n, e in boxes)

    want = {i for i, (y, x) in enumerate(points)
            if held(y, x) or all(held(y + a, x + b) for a, b in itertools.product((-.25, .25), repeat=2))}
    strict = {i for i, (y, x) in enumerate(points) if held(y, x)}
    assert len(want) > len(strict) > 50   # some lie on borders only
    assert removed(frame(spark, rings, points, 3), len(points), **way) == want


@pytest.mark.parametrize("way", WAYS, ids=str)
def test_corner_where_districts_meet(spark, way):
    """Triangles around a place take all directions, or all but one of them."""
    k = 7
    rim = [(2 * math.sin(2 * math.pi * i / k), 2 * math.cos(2 * math.pi * i / k)) for i in range(k)]
    fan = [[(0.0, 0.0), rim[i], rim[(i + 1) % k]] for i in range(k)]
    points = [(0.0, 0.0), (9.0, 9.0), (1.0, 0.0)]
    assert 0 in removed(frame(spark, fan, points), 3, **way)
    assert 0 not in removed(frame(spark, fan[1:], points), 3, **way)


def test_border_with_other_vertices(spark):
    """One district's side against two shorter ones; the end of the common border stays."""
    rings = [box(0, 0, 2, 1), box(0, 1, 1, 2), box(1, 1, 2, 2)]
    points = [(0.5, 1.0), (1.0, 1.0), (1.5, 1.0), (1.0, 1.5), (0.0, 1.0), (2.0, 1.0), (1.0, 0.0), (1.0, 2.0)]
    for way in WAYS:
        assert removed(frame(spark, rings, points), len(points), **way) == {0, 1, 2, 3}
    # without the north-eastern one its borders are the region's
    assert removed(frame(spark, rings[:2], points), len(points)) == {0}


def test_self_crossing_rings_are_even_odd(spark):
    bow = [(-1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (1.0, -1.0)]
    star = [(math.sin(4 * math.pi * i / 5) * 3, 10 + math.cos(4 * math.pi * i / 5) * 3) for i in range(5)]
    points = [(0.0, 0.5), (0.0, -0.5), (0.5, 0.0), (0.0, 0.0), (0.0, 10.0), (0.0, 12.5), (0.0, 1.0)]
    for way in WAYS:
        assert removed(frame(spark, [bow, star], points), len(points), **way) == {0, 1, 5}
    df = spark.createDataFrame([(bow,), (star,), ([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.5, 0.5)],)],
                               "ring array<struct<lat:double,lon:double>>")
    assert [r[0] for r in df.select(ring_is_usable("ring")).collect()] == [True, True, False]


def brute_crossing(x, y):
    e = [((x[i], y[i]), (x[(i + 1) % len(x)], y[(i + 1) % len(x)])) for i in range(len(x))]
    e = [(a, b) for a, b in e if a != b]

    def side(a, b, c):
        return np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))

    def on(a, b, c):
        return side(a, b, c) == 0 and min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])

    n = len(e)
    if n < 3:
        return False
    for i in range(n):
        for j in range(i):
            (a, b), (c, d) = e[i], e[j]
            if i - j == 1 or i - j == n - 1:
                first, second = ((c, d), (a, b)) if i - j == 1 else ((a, b), (c, d))
                if side(*first, second[1]) == 0 and (on(*first, second[1]) or on(*second, first[0])):
                    return True
            elif side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0 or \
                    on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b):
                return True
    return False


def test_crossing_equals_all_pairs_of_edges():
    rng = random.Random(9)
    seen = set()
    for t in range(1500):
        n = rng.randint(3, 9)
        if t % 3:   # small lattice: touching, retracing and repeated vertices
            x, y = [float(rng.randrange(5)) for _ in range(n)], [float(rng.randrange(5)) for _ in range(n)]
        else:       # star-shaped: mostly simple
            ang = sorted(rng.uniform(0, 6.28) for _ in range(n))
            x, y = [math.cos(a) * rng.uniform(1, 1.2) for a in ang], [math.sin(a) * rng.uniform(1, 1.2) for a in ang]
        if t % 2:
            x, y = [*x, x[0]], [*y, y[0]]
        want = brute_crossing(x, y)
        seen.add(want)
        assert crosses_itself(np.array(x), np.array(y)) == want, (x, y)
    assert seen == {True, False}


def test_crossing_of_a_long_ring(spark):
    n = 40_000
    ang = [2 * math.pi * i / n for i in range(n)]
    plain = [(math.sin(a) * (5 + math.sin(50 * a)), math.cos(a) * (5 + math.sin(50 * a))) for a in ang]
    crossed = plain[:-10] + [(0.0, -9.0)] + plain[-10:]
    df = spark.createDataFrame([(1, plain), (2, crossed), (3, None), (4, [(0.0, 0.0), None, (1.0, 1.0), (0.0, 2.0)]), (5, [])],
                               "id int, ring array<struct<lat:double,lon:double>>")
    got = {r["id"]: (r["usable"], r["crossing"]) for r in ring_verdicts(df).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, False), 4: (False, False), 5: (False, False)}
    assert ring_verdicts(df.limit(0)).collect() == []


def test_rings_over_the_antimeridian_and_poles(spark):
    fiji = [(-15.0, 176.0), (-15.0, -177.0), (-20.0, -178.0), (-21.0, 179.0), (-19.5, 176.5)]
    cap = [(-70.0, float(x)) for x in range(-180, 180, 30)]
    north = [(80.0, float(x)) for x in range(150, -211, -30)]
    north = [(a, x + 360 if x <= -180 else x) for a, x in north][:-1]
    rng = np.random.default_rng(2)
    points = [(float(a), float(o)) for a, o in zip(rng.uniform(-22, -14, 900), rng.uniform(174, 186, 900))]
    points = [(a, o - 360 if o > 180 else o) for a, o in points]
    points += [(-17.0, 180.0), (-17.0, -180.0), (-15.0, 180.0), (-17.0, 0.0), (-80.0, 17.0), (-80.0, 180.0), (-80.0, -180.0), (-60.0, 17.0),
               (85.0, -33.0), (85.0, 150.0), (75.0, -33.0)]
    lat, lon = np.array(fiji).T
    lon = np.where(lon < 0, lon + 360, lon)
    want = set()
    for i, (y, x) in enumerate(points):
        if x < 0:
            x += 360
        by, bx = np.roll(lat, -1), np.roll(lon, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            hits = ((lat > y) != (by > y)) & (x < lon + (y - lat) * (bx - lon) / (by - lat))
        if hits.sum() % 2:
            want.add(i)
    want.discard(902)   # on the northern border
    want |= {904, 905, 906, 908, 909}
    df = frame(spark, [fiji, cap, north], points)
    for way in WAYS:
        assert removed(df, len(points), **way) == want, way
    split = split_antimeridian(boundary_rings(df.filter("polygons is not null")))
    assert split.count() == 2 + 2 + 2 and split.filter("lon_max > 180 and lon_min < -180").count() == 0


def test_outline_of_districts(spark):
    cells = {(a, b) for a in range(6) for b in range(6) if (a * 7 + b * 3) % 5}
    rings = spark.createDataFrame([(box(a, b, a + 1, b + 1, a + 2 * b),) for a, b in sorted(cells)] + [(box(0, 1, 1, 2),)],
                                  "ring array<struct<lat:double,lon:double>>")
    got = {tuple(r) for r in boundary_outline(rings).collect()}
    want = set()
    for a, b in cells:
        for (p, q), other in ((((a, b), (a, b + 1)), (a - 1, b)), (((a, b + 1), (a + 1, b + 1)), (a, b + 1)),
                              (((a + 1, b + 1), (a + 1, b)), (a + 1, b)), (((a + 1, b), (a, b)), (a, b - 1))):
            if other not in cells:
                want.add((*map(float, p), *map(float, q)))
    assert got == want
    assert boundary_outline(rings.limit(0)).collect() == []


def test_points_without_coordinates_stay(spark):
    df = frame(spark, [box(0, 0, 1, 1)], [(0.5, 0.5)]).unionAll(spark.createDataFrame([(7, None, 0.0, None), (8, 0.0, None, None)], KIND))
    for way in WAYS:
        assert {r[0] for r in remove_nested(df, **way).select("geonameid").filter(F.col("geonameid") < 100).collect()} == {7, 8}
