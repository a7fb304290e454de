"""Metro rules at their edges: exact threshold, null population, null admin2, scopes."""

from townpull.operators.metro_rules import flag_metros, seat_admin2


def _df(spark, rows):
    return spark.createDataFrame(rows, "geonameid int, feature_code string, admin2_code string, "
                                       "population int, country_code string, admin1_code string")


def _flags(df, **kw):
    return {r["geonameid"]: r["isMetro"] for r in flag_metros(df, **kw).collect()}


def test_share_rule_threshold_is_inclusive_and_null_safe(spark):
    df = _df(spark, [(1, "PPLC", "A", 1_000_000, "PL", "01"), (2, "PPL", "B", 100_000, "PL", "01"),
                     (3, "PPL", "C", 99_999, "PL", "01"), (4, "PPL", "D", None, "PL", "01")])
    assert _flags(df, rule="share_only") == {1: True, 2: True, 3: False, 4: False}


def test_share_excl_ppl_and_null_admin2(spark):
    df = _df(spark, [(1, "PPLA", "S", 1_000_000, "PL", "01"), (2, "PPL", "S", 500_000, "PL", "01"),
                     (3, "PPL", None, 500_000, "PL", "01"), (4, "PPLA2", "S", 500_000, "PL", "01"),
                     (5, "PPL", "T", 500_000, "PL", "01")])
    # a PPL in a seat's admin2 area is excluded; a null admin2 is never in a seat area
    assert _flags(df, rule="share_excl_ppl") == {1: True, 2: False, 3: True, 4: True, 5: True}
    assert sorted(r[0] for r in seat_admin2(df).collect()) == ["S"]


def test_admin_seat_rule(spark):
    df = _df(spark, [(1, "PPLA2", "X", 0, "PL", "01"), (2, "PPL", "Y", 100_001, "PL", "01"),
                     (3, "PPL", "Y", 100_000, "PL", "01"), (4, "PPLC", "Z", None, "PL", "01"),
                     (5, "PPL", "Z", 900_000, "PL", "01"), (6, "PPLA3", "W", 900_000, "PL", "01")])
    assert _flags(df, rule="admin_seat") == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}


def test_country_scope(spark):
    df = _df(spark, [(1, "PPL", "A", 1_000_000, "PL", "01"), (2, "PPL", "B", 50_000, "PL", "01"),
                     (3, "PPL", "C", 50_000, "LT", "01"), (4, "PPL", "D", 4_000, "LT", "01"),
                     (5, "PPL", "E", 10_000, None, "01")])
    assert _flags(df, rule="share_only", scope="global") == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert _flags(df, rule="share_only", scope="country") == {1: True, 2: False, 3: True, 4: False, 5: False}
