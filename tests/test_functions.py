"""Scalar expressions at their edges (G1-G7, G11-G18) and the id sort orders (F1)."""

import math

import pytest
from pyspark.sql import functions as F

from townpull.functions import geo as G
from townpull.functions import style as ST
from townpull.operators.setops import sort_by_id


def test_marker_radius_breakpoints(spark):
    pops = [None, -5, 0, 999, 1000, 25500, 49999, 50000, 125000, 199999, 200000, 10**9]
    df = spark.createDataFrame([(p,) for p in pops], "p long")
    got = [r[0] for r in df.select(ST.marker_radius("p")).collect()]
    want = [3, 3, 3, 3, 3, 5.5, 3 + 48999 / 49000 * 5, 8, 10, 8 + 149999 / 150000 * 4, 12, 12]
    assert got == pytest.approx(want)


def test_colours_and_text_with_nulls(spark):
    df = spark.createDataFrame([(True, "PPLA2", "X", 5, "01", None, "7"), (None, None, None, None, None, None, None),
                                (False, "PPLC", "Y", 0, "02", "0003", "1")],
                               "m boolean, code string, name string, pop int, a1 string, a2 string, a3 string")
    rows = df.select(ST.color_by_metro("m").alias("cm"), ST.color_by_code("code").alias("cc"),
                     ST.color_by_lookup("code").alias("cl"),
                     ST.tooltip_text("name", "pop", "code", "a1", "a2", "a3").alias("t")).collect()
    assert [r["cm"] for r in rows] == ["red", "blue", "blue"]
    assert [r["cc"] for r in rows] == ["red", "blue", "green"]
    assert [r["cl"] for r in rows] == ["red", "cadetblue", "purple"]
    assert rows[0]["t"] == "City: X<br>Population: 5<br>Feature: PPLA2<br>Admin1: 01, Admin2: nan, Admin3: 7"


def test_candidate_text_and_safe_id(spark):
    df = spark.createDataFrame([([{"metro_id": 7, "metro_name": "A", "force": 0.81234, "distance": 12.34}],), ([],),
                                (None,)], "c array<struct<metro_id:int,metro_name:string,force:double,distance:double>>")
    got = [r[0] for r in df.select(ST.candidate_text("c")).collect()]
    assert got == ["<br>Candidate Metros:<br>A | 7 (force: 0.812, dist: 12.3 km)", "", ""]
    ids = spark.createDataFrame([("12",), ("x",), (None,), ("12.5",)], "s string")
    assert [r[0] for r in ids.select(ST.safe_id("s")).collect()] == [12, None, None, 12]


def test_geo_values(spark):
    df = spark.createDataFrame([(52.2297, 21.0122, 50.0647, 19.945, 1_443_000, "0012", "x1")],
                               "a double, b double, c double, d double, p long, s string, j string")
    r = df.select(G.haversine_km("a", "b", "c", "d").alias("h"), G.influence_radius_km("p").alias("r"),
                  G.pull_force(F.lit(10.0), F.lit(20.0)).alias("f"), G.web_mercator_xy("b", "a").alias("xy"),
                  G.mercator_cos_km("a", "b", "a", "b").alias("zero"), G.to_int("s").alias("i"),
                  G.to_int("j", default=-1).alias("jd"), G.to_double("j").alias("jn")).first()
    assert r["h"] == pytest.approx(252.0, abs=1.0)          # Warsaw - Krakow
    assert r["r"] == pytest.approx(10 + 90 * (1 - math.exp(-1)))
    assert r["f"] == pytest.approx(math.exp(-0.7))
    assert r["xy"]["x"] == pytest.approx(6378137 * math.radians(21.0122))
    assert r["zero"] == 0.0 and r["i"] == 12 and r["jd"] == -1 and r["jn"] is None


def test_sort_by_id_numeric_and_text(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "geonameid int")
    assert [r[0] for r in sort_by_id(df).collect()] == [9, 10, 100]
    assert [r[0] for r in sort_by_id(df, numeric=False).collect()] == [10, 100, 9]


def test_ids_and_whole_numbers_from_doubles_and_text(spark):
    from townpull.functions.geo import to_int
    from townpull.functions.style import safe_id
    df = spark.createDataFrame([(756135.0, "756135.0"), (None, " 12.7 "), (float("nan"), "1e5"), (-3.9, "x"), (1e12, "99999999999")],
                               "d double, t string")
    rows = df.select(safe_id("d").alias("a"), safe_id("t").alias("b"), to_int("t").alias("c")).collect()
    assert [tuple(r) for r in rows] == [(756135, 756135, 756135), (None, 12, 12), (None, 100000, 100000), (-3, None, None),
                                        (None, None, None)]


def test_assignment_lines_with_double_ids(spark):
    from townpull.plans.maps import assignment_lines
    df = spark.createDataFrame([(1, 50.0, 20.0, 2.0), (2, 50.1, 20.1, 2.0), (3, 50.2, 20.2, None)],
                               "geonameid int, latitude double, longitude double, assigned_metro_id double")
    assert assignment_lines(df).count() == 2
