"""Iterative metro growth (K1) and per-round layers (K2).

The source lists this as future work without semantics; the ones chosen here:

* round 0 is the plain assignment (radius from each metro's own population);
* round k gives every metro an effective population = own population + the
  population of the towns assigned to it in round k-1, recomputes the radius from
  it and reassigns every town (metros are never annexed);
* the loop stops at the fixed point, when no metro's effective population changes. A
  state that comes back after other states would go round for ever and raises;
  ``rounds=n`` stops after n reassignment rounds instead, wherever the loop is then.

Rounds are incremental. The frontier of a round is the metros whose effective population
has changed. Only cells that one of them reaches, before or after, are indexed (with all
their metros), only towns in such cells are evaluated again, and only towns that then change
their metro enter the next round's sums; all others carry their assignment over. The loop
ends when the frontier is empty. The loop state is the small metro table, written below the
checkpoint folder each round (lineage stays short, a lost executor re-reads it), and is
compared with earlier ones by a hash sum over the metros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpull.functions.geo import influence_radius_km
from townpull.operators.filters import filter_populated_places
from townpull.operators.metro_rules import flag_metros
from townpull.operators.radius_join import DEFAULT_CELL_DEG, attach_candidates, build_cell_index, spread_evenly, town_cell
from townpull.operators.sizing import broadcast_if_bounded, join_small
from townpull.session import scratch_path

REFINE_PAIRS = 10_000_000   # (town, metro) pairs a core that a round evaluates without thinning out its index


def _stored(df: DataFrame) -> DataFrame:
    """``df`` from a written copy. A checkpoint would take along Spark's estimate of its size, the product of the
    tables joined so far, which over the rounds grows to a number that planning takes minutes to multiply."""
    path = scratch_path(df.sparkSession, "growth")
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _index(eff: DataFrame, metric: str, cell_deg: float, **kw):
    m = eff.withColumn("influence_radius", influence_radius_km("eff_population"))
    if "was" in eff.columns:
        m = m.withColumn("reach", influence_radius_km("was")).withColumn("changed", F.coalesce(F.col("eff_population") != F.col("was"), F.lit(False)))
    return build_cell_index(m, metric, cell_deg, with_names=False, best=1, **kw)


def _assign_round(towns: DataFrame, idx, before: bool = False) -> DataFrame:
    """Assignment of the towns by ``idx``; after a first round (``before``) towns in cells that the index
    does not hold keep theirs. ``was``: the assignment before; ``evaluated``: whether it was made anew."""
    keep = ["geonameid", "latitude", "longitude", "population"]
    metro = F.col("best.metro_id")
    if not before:
        return attach_candidates(towns.select(*keep), idx, mode="best") \
            .select(*keep, metro.alias("assigned_metro_id"), F.lit(None).cast("int").alias("was"), F.lit(True).alias("evaluated"))
    rows = towns.select(*keep, F.col("assigned_metro_id").alias("was"),
                        town_cell(F.col("latitude").cast("double"), F.col("longitude").cast("double"), idx.metric, idx.cell_deg).alias("_tc"))
    cells = idx.covered.select(F.col("cell").alias("_tc"), F.lit(True).alias("evaluated"))
    cells = F.broadcast(cells) if idx.broadcast else cells
    rows = rows.join(cells, "_tc", "left").withColumn("evaluated", F.coalesce("evaluated", F.lit(False))).drop("_tc")
    out = attach_candidates(rows, idx, mode="best", skip=~F.col("evaluated"))
    return out.select(*keep, F.when(F.col("evaluated"), metro).otherwise(F.col("was")).alias("assigned_metro_id"), "was", "evaluated")


def _next_eff(eff: DataFrame, assigned: DataFrame) -> DataFrame:
    """Effective populations after the moves of a round, with those before as ``was``."""
    moved = assigned.filter(~F.col("assigned_metro_id").eqNullSafe(F.col("was")))
    people = F.coalesce(F.col("population").cast("long"), F.lit(0))
    gains = moved.select(F.explode(F.array(
        F.struct(F.col("assigned_metro_id").alias("geonameid"), people.alias("gain")),
        F.struct(F.col("was").alias("geonameid"), (-people).alias("gain")))).alias("x")).select("x.*")
    gains = gains.filter("geonameid is not null").groupBy("geonameid").agg(F.sum("gain").alias("_gain"))
    # both sides have at most a row a metro
    return eff.drop("was").withColumnRenamed("eff_population", "was").join(gains, "geonameid", "left") \
        .withColumn("eff_population", F.col("was") + F.coalesce("_gain", F.lit(0))).drop("_gain")


def _state(eff: DataFrame) -> tuple:
    """A number for the whole loop state (order-free hash sum and count)."""
    h = F.xxhash64("geonameid", "eff_population").cast("decimal(38,0)")
    return tuple(eff.agg(F.count(F.lit(1)), F.sum(h)).first())


def iterative_growth(places: DataFrame, rule: str = "share_only", metric: str = "haversine",
                     rounds: int | None = None, cell_deg: float = DEFAULT_CELL_DEG, populated_only: bool = True,
                     return_rounds: bool = False, **rule_kw):
    """K1: assignment at the fixed point of growth (or after ``rounds`` reassignments);
    ``return_rounds`` also returns the list of per-round town assignments (for K2), the last
    of which is the fixed point, and whether it is one.

    Output columns: the input columns, ``isMetro``, ``eff_population`` and
    ``influence_radius`` (metro rows), ``assigned_metro_id``. The loop reads a
    stored narrow projection of the towns; the full rows are read once, for the output.
    """
    df = filter_populated_places(places) if populated_only else places
    flagged = flag_metros(df, rule, **rule_kw)
    is_metro = F.col("isMetro")
    base = _stored(flagged.filter(is_metro).select("geonameid", "name", "latitude", "longitude", "population"))
    towns = _stored(spread_evenly(flagged.filter(~is_metro).select("geonameid", "latitude", "longitude", "population")))
    eff = base.withColumn("eff_population", F.col("population").cast("long"))
    n = base.count()
    # a row a grid cell; rounds that evaluate few pairs spare themselves the jobs that thin out dense cells
    cell = town_cell(F.col("latitude").cast("double"), F.col("longitude").cast("double"), metric, cell_deg)
    held = _stored(towns.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("towns")))
    few = REFINE_PAIRS * towns.sparkSession.sparkContext.defaultParallelism
    kw = {"at_most": n, "towns": held, "few_pairs": few}
    idx = _index(eff, metric, cell_deg, **kw)
    assigned = _stored(_assign_round(towns, idx))
    done, states, converged = [assigned], [_state(eff)], False
    while rounds is None or len(done) <= rounds:
        nxt = _stored(_next_eff(eff, assigned))
        state = _state(nxt)
        if state == states[-1]:
            converged = True
            break
        if state in states:
            raise RuntimeError(f"growth goes round: the state of round {states.index(state)} came back "
                               f"in round {len(done)}; pass rounds=n for a fixed number of rounds")
        states.append(state)
        eff = nxt
        idx = _index(eff, metric, cell_deg, **kw)
        assigned = _stored(_assign_round(assigned, idx, before=True))
        done.append(assigned)
    # one pass over the full rows: metros take their effective population, towns an index of all metros
    if "was" in eff.columns:
        # the full rows lie in the tasks of their source, which may be one
        idx = _index(eff.drop("was"), metric, cell_deg, **{**kw, "few_pairs": REFINE_PAIRS})
    effs = eff.select(F.col("geonameid").alias("_mk"), "eff_population")
    full = flagged.withColumn("_mk", F.when(is_metro, F.col("geonameid")))
    full = join_small(full, effs, "_mk", "left", null_spread=True).drop("_mk")
    out = attach_candidates(full, idx, mode="best", skip=is_metro)
    result = out.select(*flagged.columns, "eff_population",
                        F.when(is_metro, influence_radius_km("eff_population")).alias("influence_radius"),
                        F.when(is_metro, F.col("geonameid").cast("int")).otherwise(F.col("best.metro_id"))
                        .alias("assigned_metro_id"))
    return (result, done, converged) if return_rounds else result


def growth_lines(rounds: list[DataFrame], metros: DataFrame) -> DataFrame:
    """K2: assignment lines of every round, with an ``iteration`` column."""
    coords = metros.select(F.col("geonameid").alias("assigned_metro_id"), F.col("latitude").alias("metro_lat"),
                           F.col("longitude").alias("metro_lon"))
    coords, _ = broadcast_if_bounded(coords)   # worked out once, not once a round
    parts = []
    for i, r in enumerate(rounds):
        lines = r.filter(F.col("assigned_metro_id").isNotNull()).join(coords, "assigned_metro_id", "inner")
        parts.append(lines.select(F.lit(i).alias("iteration"), F.col("geonameid").alias("id"),
                                  F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                                  "metro_lat", "metro_lon"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
