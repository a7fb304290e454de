"""Physical-plan checks: no all-pairs join, no Python in the hot path, towns not shuffled."""

from conftest import SF_MID
from townpull.operators import metro_rules as MR
from townpull.operators.boundaries import remove_nested
from townpull.operators.filters import filter_populated_places
from townpull.operators.radius_join import radius_join
from townpull.plans.assign import assign_metros, with_radius
from townpull.sources.fixture import places


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_assign_plan_jvm_engine(spark, monkeypatch):
    import townpull.operators.radius_join as RJ
    monkeypatch.setattr(RJ, "DEFAULT_ENGINE", "jvm")
    plan = _plan(assign_metros(places(spark, SF_MID), rule="share_only"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan  # no Python node at all
    assert "BroadcastHashJoin" in plan
    # one pass over the places: scan -> filter -> broadcast join -> project, no exchange
    town_side = plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in town_side


def test_assign_plan_arrow_engine(spark):
    plan = _plan(assign_metros(places(spark, SF_MID), rule="share_only"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time UDF
    assert plan.count("MapInArrow") == 1  # one Arrow-batched evaluation after the join
    assert "Exchange hashpartitioning" not in plan.split("MapInArrow")[1].split("BroadcastExchange")[0]


def test_radius_join_plan(spark):
    pop = filter_populated_places(places(spark, SF_MID))
    m, t = MR.flag_metros(pop, "share_only").filter("isMetro"), MR.flag_metros(pop, "share_only").filter("not isMetro")
    plan = _plan(radius_join(t, with_radius(m)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned(spark):
    df = filter_populated_places(places(spark, SF_MID)).select("geonameid", "population")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan or "[c_custkey#" in plan


def test_remove_nested_plan(spark):
    from pyspark.sql import functions as F
    from townpull.sources.fixture import diamond_ring
    f = MR.flag_metros(filter_populated_places(places(spark, SF_MID)), "share_only")
    df = f.withColumn("polygons", F.when(F.col("isMetro"), F.array(diamond_ring(F.col("latitude"), F.col("longitude")))))
    plan = _plan(remove_nested(df))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan
