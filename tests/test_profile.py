"""Duplicate handling with identical copies and null names (pandas duplicated() semantics)."""

from collections import Counter

from townpull.operators.profile import admin_dedupe, duplicate_flag, duplicate_rows


def test_duplicate_flag_copies_and_nulls(spark):
    rows = [(5, "A"), (5, "A"), (5, "A"), (3, "A"), (7, "B"), (None, None), (1, None), (2, "C")]
    df = spark.createDataFrame(rows, "geonameid int, name string")
    for chunk in (1, 2, 1_000_000):
        got = Counter(tuple(r) for r in duplicate_flag(df, expand_chunk=chunk).collect())
        assert got == Counter({(3, "A", False): 1, (5, "A", True): 3, (7, "B", False): 1,
                               (1, None, False): 1, (None, None, True): 1, (2, "C", False): 1}), chunk
    first_copies = spark.createDataFrame([(4, "Z")] * 5, "geonameid int, name string")
    got = Counter(tuple(r) for r in duplicate_flag(first_copies, expand_chunk=2).collect())
    assert got == Counter({(4, "Z", False): 1, (4, "Z", True): 4})


def test_duplicate_rows_keeps_null_group(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, None), (4, None), (5, "B")], "geonameid int, name string")
    assert sorted(r[0] for r in duplicate_rows(df).collect()) == [1, 2, 3, 4]


def test_admin_dedupe_null_admin(spark):
    df = spark.createDataFrame([
        (1, "P", "PPLA", "01", "A"), (2, "P", "PPL", "01", "B"), (3, "P", "PPL", None, "C"),
        (4, "P", "PPLC", "02", None), (5, "P", "PPLX", "03", "D"), (6, "P", "PPL", "03", "D"),
        (7, "P", "PPLA2", "04", "D")],
        "geonameid int, feature_class string, feature_code string, admin2_code string, admin3_code string")
    assert sorted(r[0] for r in admin_dedupe(df).collect()) == [1, 7]
    assert sorted(r[0] for r in admin_dedupe(df, keep_null_admin=True).collect()) == [1, 3, 4, 7]


def test_duplicate_ids_matches_duplicate_rows(spark):
    from townpull.operators.profile import duplicate_ids
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, None), (4, None), (5, "B")], "geonameid int, name string")
    got = {r["geonameid"]: (r["n_ids"], r["ids"]) for r in duplicate_ids(df).collect()}
    assert got == {1: (2, [1, 2]), 2: (2, [1, 2]), 3: (2, [3, 4]), 4: (2, [3, 4])}


def test_every_id_of_a_name_in_bounded_lists(spark):
    from townpull.operators.profile import duplicate_ids, ids_by_name
    rows = [(i, "many") for i in range(0, 95, 2)] + [(1, "two"), (3, "two"), (5, "one"), (7, None), (9, None), (None, "two")]
    df = spark.createDataFrame(rows, "geonameid int, name string")
    got = ids_by_name(df, chunk=10).collect()
    assert all(len(r["ids"]) <= 10 for r in got)
    ids = {}
    for r in got:
        ids.setdefault(r["name"], []).extend(r["ids"])
    assert {k: sorted(v) for k, v in ids.items()} == {"many": list(range(0, 95, 2)), "two": [1, 3], "one": [5], None: [7, 9]}
    w4 = duplicate_ids(df, chunk=10).collect()
    assert len(w4) == len(rows) - 1
    for r in w4:
        assert r["geonameid"] is None or r["geonameid"] in r["ids"]
        if r["name"] != "many":
            assert r["ids"] == ([1, 3] if r["name"] == "two" else [7, 9])


def test_wide_lookups_are_not_broadcast(spark):
    from townpull.operators.sizing import broadcast_if_bounded, join_small, measure
    wide = spark.range(50).selectExpr("id", "repeat('x', 1000) AS t", "array(id, id) AS a")
    n, size = measure(wide)
    assert n == 50 and 50_000 < size < 100_000
    assert broadcast_if_bounded(wide, max_bytes=20_000)[1] is False
    assert broadcast_if_bounded(wide)[1] is True
    plan = join_small(spark.range(9), wide, "id")._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "SinglePartition" not in plan


def test_null_keys_spread_without_matching(spark):
    from townpull.operators.sizing import join_small
    big = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "i int, k string")
    small = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    got = sorted((r["i"], r["v"]) for r in join_small(big, small, "k", null_spread=True, max_rows=0).collect())
    assert got == [(1, 10), (2, None), (3, None), (4, None)]
