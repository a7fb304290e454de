"""Metro assignment jobs (P1 winner only, P2 with candidate lists) and their parts.

Plan shape (P1, broadcast case): the place table is scanned for the metro side
(filter + rule; the global maximum is a scalar subquery), the metro cell index is
built once and written to the checkpoint folder, and the town side is a single
pass: scan -> filter -> rule -> broadcast-hash join on the cell key -> project.
Towns are never shuffled and never re-joined; the result is the union of the
metro rows (assigned to themselves) and the town rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from townpull.functions.geo import influence_radius_km
from townpull.operators.filters import filter_populated_places
from townpull.operators.metro_rules import flag_metros
from townpull.operators.radius_join import DEFAULT_CELL_DEG, attach_candidates, build_cell_index, spread_evenly
from townpull.schema import ADMIN_SEAT_MIN_POPULATION, METRO_SHARE

LIST_CHUNK = 50_000     # metros of a cell that towns meet in one row when all candidates are listed


def with_radius(metros: DataFrame) -> DataFrame:
    """G1 applied to metro rows."""
    return metros.withColumn("influence_radius", influence_radius_km("population"))


def attach_best(towns: DataFrame, metros: DataFrame, metric: str = "haversine", cell_deg: float = DEFAULT_CELL_DEG,
                **index_kw) -> DataFrame:
    """W1 + D4: towns with ``assigned_metro_id`` of the strongest metro (null if none).

    Ties on force go to the shorter distance, then the lower metro id.
    """
    idx = build_cell_index(metros, metric, cell_deg, best=1, **index_kw)
    out = attach_candidates(towns, idx, mode="best")
    return out.withColumn("assigned_metro_id", F.col("best.metro_id")).drop("best")


def assign_metros(places: DataFrame, rule: str = "share_excl_ppl", metric: str = "haversine",
                  scope: str = "global", share: float = METRO_SHARE,
                  min_pop: int = ADMIN_SEAT_MIN_POPULATION, cell_deg: float = DEFAULT_CELL_DEG,
                  populated_only: bool = True, self_assign: bool = True,
                  candidates: bool = False, loaded: Observation | None = None, **index_kw) -> DataFrame:
    """P1 (``candidates=False``) / P2 (``candidates=True``).

    Output: the input columns, then ``isMetro``, ``influence_radius`` (null on towns),
    ``assigned_metro_id`` (the metro itself on metro rows unless ``self_assign=False``),
    and with ``candidates=True`` a ``candidates`` array (null on metro rows).

    The place table is read in full once: the cell index is built from a narrow
    projection of the metro rows, and the output is one pass over all flagged rows
    in which metro rows skip the index lookup and are assigned to themselves; with ``candidates``
    the rows are dealt out evenly before they get their lists. ``loaded`` observes
    the rows read, before any filter, as ``loaded`` in whichever of these passes ends first.
    """
    df = filter_populated_places(places) if populated_only else places
    # re-assigning an earlier output replaces its derived columns
    df = df.drop(*[c for c in ("influence_radius", "assigned_metro_id", "candidates") if c in df.columns])
    seen = df
    if loaded is not None:
        seen = places.observe(loaded, F.count(F.lit(1)).alias("loaded"))
        seen = (filter_populated_places(seen) if populated_only else seen).select(*df.columns)
    flagged = flag_metros(seen, rule, share=share, scope=scope, min_pop=min_pop, basis=df)
    is_metro = F.col("isMetro")
    metros = with_radius(flagged.filter(is_metro).select("geonameid", "name", "latitude", "longitude", "population"))
    if candidates:   # a cell's metros in one list as far as it fits a row: lists of chunks would be shuffled to come together
        index_kw = {"chunk_size": LIST_CHUNK, **index_kw}
    idx = build_cell_index(metros, metric, cell_deg, with_names=candidates, best=None if candidates else 1, **index_kw)
    own = F.col("geonameid").cast("int") if self_assign else F.lit(None).cast("int")
    radius = F.when(is_metro, influence_radius_km("population"))
    if candidates:
        # lists are long where the rows of their towns are few bytes: one file of towns would be one task
        rows = spread_evenly(flagged) if idx.broadcast else flagged
        out = attach_candidates(rows, idx, mode="list", skip=is_metro)
        best = F.get(F.col("candidates"), 0)["metro_id"]
        return out.select(*flagged.columns, radius.alias("influence_radius"),
                          F.when(is_metro, own).otherwise(best).alias("assigned_metro_id"),
                          F.when(~is_metro, F.col("candidates")).alias("candidates"))
    out = attach_candidates(flagged, idx, mode="best", skip=is_metro)
    return out.select(*flagged.columns, radius.alias("influence_radius"),
                      F.when(is_metro, own).otherwise(F.col("best.metro_id")).alias("assigned_metro_id"))


def write_assigned(places: DataFrame, path: str, **kw) -> dict[str, int]:
    """P1 / P2 written to ``path`` as Parquet, and the stage counts (C5) of this very write: loaded,
    populated (assignment input), metros, non_metros, assigned. The counts are observed while the rows pass;
    no further job reads anything for them. ``kw`` as for ``assign_metros``."""
    loaded, done = Observation(), Observation()
    out = assign_metros(places, loaded=loaded, **kw)
    town = ~F.col("isMetro")
    out.observe(done, F.count(F.lit(1)).alias("populated"), F.count_if("isMetro").alias("metros"),
                F.count_if(town).alias("non_metros"), F.count_if(town & F.col("assigned_metro_id").isNotNull()).alias("assigned")) \
        .write.mode("overwrite").parquet(path)
    return {**loaded.get, **done.get}
