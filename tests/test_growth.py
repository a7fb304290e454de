"""Iterative growth: fixed point, monotone effective population, metros keep themselves."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from townpull.catalog import ORACLE_ROUNDS
from townpull.plans.assign import assign_metros
from townpull.plans.growth import growth_lines, iterative_growth
from townpull.sources.fixture import places


def test_growth_rounds_and_fixed_point(spark):
    pl = places(spark, SF_SMALL)
    out, rounds, converged = iterative_growth(pl, return_rounds=True)
    assert converged and len(rounds) <= ORACLE_ROUNDS
    # one more round changes nothing
    again = iterative_growth(pl, rounds=len(rounds), return_rounds=True)[0]
    key = lambda df: sorted((r["geonameid"], r["assigned_metro_id"], r["eff_population"]) for r in
                            df.fillna(-1, ["assigned_metro_id", "eff_population"]).collect())
    assert key(again) == key(out)
    rows = out.collect()
    metros = [r for r in rows if r["isMetro"]]
    assert all(r["assigned_metro_id"] == r["geonameid"] for r in metros)
    assert all(r["eff_population"] >= r["population"] for r in metros)
    # round 0 equals the plain assignment
    r0 = {r["geonameid"]: r["assigned_metro_id"] for r in rounds[0].collect()}
    p1 = {r["geonameid"]: r["assigned_metro_id"] for r in
          assign_metros(pl, rule="share_only").filter(~F.col("isMetro")).collect()}
    assert r0 == p1
    # growth only widens radii, so an assigned town stays assigned
    last = {r["geonameid"]: r["assigned_metro_id"] for r in rows if not r["isMetro"]}
    assert all(last[k] is not None for k, v in r0.items() if v is not None)
    lines = growth_lines(rounds, out.filter(F.col("isMetro")))
    assert {r["iteration"] for r in lines.select("iteration").distinct().collect()} == set(range(len(rounds)))


def test_growth_zero_iterations_is_plain_assignment(spark):
    pl = places(spark, SF_SMALL)
    g = {r["geonameid"]: r["assigned_metro_id"] for r in iterative_growth(pl, rounds=0).collect()}
    p = {r["geonameid"]: r["assigned_metro_id"] for r in assign_metros(pl, rule="share_only").collect()}
    assert g == p


def test_growth_settles_at_the_middle_scale(spark):
    _, rounds, converged = iterative_growth(places(spark, SF_MID), return_rounds=True)
    assert converged and 3 < len(rounds) <= ORACLE_ROUNDS


def test_rounds_evaluate_the_frontier_only(spark):
    """Later rounds look at fewer towns, and end where full rounds end."""
    from townpull.plans import growth
    pl = places(spark, SF_MID)
    out, rounds, _ = iterative_growth(pl, return_rounds=True)
    n = [r.filter("evaluated").count() for r in rounds]
    assert n[0] == rounds[0].count() and n[-1] < n[0] / 2 and sum(n[1:]) < 0.9 * n[0] * (len(n) - 1), n
    # each round's assignment is that of an index of all metros at the round's populations
    metros = out.filter("isMetro")
    eff = metros.withColumn("eff_population", F.col("population").cast("long"))
    for k, r in enumerate(rounds[:4]):
        full = growth._assign_round(rounds[0], growth._index(eff.drop("influence_radius"), "haversine", growth.DEFAULT_CELL_DEG))
        got = {x[0]: x[1] for x in r.select("geonameid", "assigned_metro_id").collect()}
        assert {x[0]: x[1] for x in full.select("geonameid", "assigned_metro_id").collect()} == got, k
        gain = r.groupBy(F.col("assigned_metro_id").alias("geonameid")).agg(F.sum("population").alias("g"))
        eff = metros.drop("eff_population").join(gain, "geonameid", "left").withColumn(
            "eff_population", F.col("population").cast("long") + F.coalesce("g", F.lit(0))).drop("g")


def test_size_estimates_do_not_pile_up(spark, monkeypatch):
    """A checkpoint hands on Spark's size estimate, the product of all tables joined before: over the rounds a number of
    millions of digits, with which planning took minutes."""
    from townpull.plans import growth
    monkeypatch.setattr(growth, "_state", lambda eff, n=iter(range(99)): next(n))   # no round is the last
    _, rounds, _ = iterative_growth(places(spark, SF_SMALL), rounds=6, return_rounds=True)
    bits = [r._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() for r in rounds]
    assert len(bits) == 7 and max(bits) < 64, bits


def test_dense_cells_are_thinned_out_where_many_pairs_are_met(spark, monkeypatch):
    """Rounds that meet few pairs keep all metros of a cell; both ways assign the same."""
    from townpull.operators import radius_join
    from townpull.plans import growth
    monkeypatch.setattr(radius_join, "SPLIT_ENTRIES", 1)
    refined = []
    plain = radius_join._refine
    monkeypatch.setattr(radius_join, "_refine", lambda *a: refined.append(1) or plain(*a))
    build = growth.build_cell_index
    monkeypatch.setattr(growth, "build_cell_index", lambda *a, **kw: build(*a, **{**kw, "at_most": None}))
    rows = {}
    for few in (0, 10**9):
        refined.clear()
        monkeypatch.setattr(growth, "REFINE_PAIRS", few)
        rows[few] = {tuple(r) for r in iterative_growth(places(spark, SF_SMALL)).select("geonameid", "eff_population", "assigned_metro_id").collect()}
        assert bool(refined) == (few == 0)
    assert rows[0] == rows[10**9]


def test_a_state_that_comes_back_raises(spark, monkeypatch):
    from townpull.plans import growth
    states = iter([1, 2, 1])
    monkeypatch.setattr(growth, "_state", lambda eff: next(states))
    with pytest.raises(RuntimeError, match="round 0 came back"):
        iterative_growth(places(spark, SF_SMALL))
