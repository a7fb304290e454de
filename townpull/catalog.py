"""Registered queries: one Spark callable per operator/job, and its DuckDB oracle.

Every query reads ``customer`` through the derived ``places`` view (see
``townpull.sources.fixture``) so its work grows with the input. Doubles that come
out of transcendental functions are rounded to 6 places in both engines.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townpull import sqltext as S
from townpull.operators.filters import filter_populated_places
from townpull.plans.assign import assign_metros, write_assigned
from townpull.sources.fixture import PLACES_COLUMNS, places

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, places_: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), places_).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _populated(spark: SparkSession, sf: str) -> DataFrame:
    return filter_populated_places(places(spark, sf))


# ---------------------------------------------------------------- P1 / P2 -----

def _assign_sql(rule: str, metric: str, scope: str = "global") -> str:
    return S.with_(S.PLACES, S.POP, *S.pairs_ctes(rule, metric, scope)) + f"""
SELECT {S.cols('m')}, m.isMetro, round(m.influence_radius, 6) AS influence_radius, m.geonameid AS assigned_metro_id
FROM metros m
UNION ALL
SELECT {S.cols('t')}, t.isMetro, CAST(NULL AS DOUBLE) AS influence_radius, b.mid AS assigned_metro_id
FROM towns t LEFT JOIN best b ON t.geonameid = b.tid"""


def _assign_query(rule: str, metric: str, scope: str = "global") -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return round_doubles(assign_metros(places(spark, sf), rule=rule, metric=metric, scope=scope))
    return q


for _rule, _metric, _scope, _name in [
    ("share_only", "haversine", "global", "p1_assign_share_only_haversine"),
    ("share_only", "mercator_cos", "global", "p1_assign_share_only_mercator"),
    ("share_excl_ppl", "haversine", "global", "p1_assign_share_excl_ppl_haversine"),
    ("admin_seat", "haversine", "global", "p1_assign_admin_seat_haversine"),
    ("share_excl_ppl", "haversine", "country", "p1_assign_share_excl_ppl_by_country"),
]:
    register(_name, _assign_sql(_rule, _metric, _scope))(_assign_query(_rule, _metric, _scope))


# ------------------------------------------------------------ B filters -----
from townpull.operators import filters as B  # noqa: E402
from townpull.operators import metro_rules as MR  # noqa: E402
from townpull.operators import profile as PR  # noqa: E402
from townpull.operators import setops as SO  # noqa: E402
from townpull.operators.radius_join import bbox_candidates, build_cell_index, radius_join  # noqa: E402
from townpull.operators.stored_index import attach_stored, load_cell_index, save_cell_index, save_places_by_cell  # noqa: E402
from townpull.operators.ranking import best_candidate, strongest_metros  # noqa: E402
from townpull.plans.assign import attach_best, with_radius  # noqa: E402
from townpull.plans.maps import assignment_lines  # noqa: E402

_P = S.with_(S.PLACES)
_PP = S.with_(S.PLACES, S.POP)


def _q(name: str, sql: str | None, fn: Query) -> None:
    register(name, sql)(fn)


_q("b1_populated_places", _PP + "SELECT * FROM pop", _populated)
_q("b2_population_zero", _P + "SELECT * FROM places WHERE population = 0",
   lambda sp, sf: B.filter_population(places(sp, sf), "zero"))
_q("b2_population_positive", _P + "SELECT * FROM places WHERE population > 0",
   lambda sp, sf: B.filter_population(places(sp, sf), "positive"))
_q("b3_feature_class_p", _P + "SELECT * FROM places WHERE feature_class = 'P'",
   lambda sp, sf: B.filter_feature(places(sp, sf), class_="P"))
_q("b3_feature_code_ppla", _P + "SELECT * FROM places WHERE feature_code = 'PPLA'",
   lambda sp, sf: B.filter_feature(places(sp, sf), code="PPLA"))
_q("b4_hotel_with_population", _P + "SELECT * FROM places WHERE feature_code = 'HTL' AND population > 0",
   lambda sp, sf: B.filter_populated_code(places(sp, sf), "HTL"))
_q("b5_name_lookup", _P + "SELECT * FROM places WHERE name = 'Town-7'",
   lambda sp, sf: B.filter_name(places(sp, sf), "Town-7", col="name"))
_q("b6_codes_in", _P + "SELECT * FROM places WHERE feature_code IN ('PPLC', 'PPLA', 'PPLA2')",
   lambda sp, sf: B.filter_codes(places(sp, sf), ["PPLC", "PPLA", "PPLA2"]))
_q("b6_codes_not_in", _P + "SELECT * FROM places WHERE feature_class = 'P' AND "
   "NOT COALESCE(feature_code IN ('PPLH', 'PPLX'), false)",
   lambda sp, sf: B.filter_codes(B.filter_feature(places(sp, sf), class_="P"), ["PPLH", "PPLX"], negate=True))
for _rule, _id in [("share_only", "b7"), ("share_excl_ppl", "b8"), ("admin_seat", "b9")]:
    _q(f"{_id}_metros_{_rule}", S.with_(S.PLACES, S.POP, *S.flag_cte(_rule)) + f"SELECT {S.COLS} FROM flag WHERE isMetro",
       (lambda r: lambda sp, sf: MR.metro_rule(_populated(sp, sf), r))(_rule))
_q("b7_metros_share_only_by_country",
   S.with_(S.PLACES, S.POP, *S.flag_cte("share_only", "country")) + f"SELECT {S.COLS} FROM flag WHERE isMetro",
   lambda sp, sf: MR.metro_rule(_populated(sp, sf), "share_only", scope="country"))
_q("b10_flag_metros", S.with_(S.PLACES, S.POP, *S.flag_cte("share_excl_ppl")) + "SELECT * FROM flag",
   lambda sp, sf: MR.flag_metros(_populated(sp, sf), "share_excl_ppl"))
_q("b11_split_towns", S.with_(S.PLACES, S.POP, *S.flag_cte("share_only")) + "SELECT * FROM flag WHERE NOT isMetro",
   lambda sp, sf: B.split_metros(MR.flag_metros(_populated(sp, sf), "share_only"))[1])
_q("b12_filter_assigned",
   f"SELECT * FROM ({_assign_sql('share_only', 'haversine')}) a WHERE isMetro OR assigned_metro_id IS NOT NULL",
   lambda sp, sf: B.filter_assigned(QUERIES["p1_assign_share_only_haversine"](sp, sf)))
_q("b14_project_columns", _P + "SELECT geonameid, name, population FROM places WHERE feature_code = 'PPLA'",
   lambda sp, sf: B.project_columns(B.filter_feature(places(sp, sf), code="PPLA"),
                                    keep=["geonameid", "name", "population", "latitude"], drop=["latitude"]))
_RENAMED = ["place_id", "place_name", "lat", "lon", "fclass", "fcode", "cc", "adm1", "adm2", "adm3", "pop"]
_q("b15_rename_headers", _P + "SELECT " + ", ".join(f"{a} AS {b}" for a, b in zip(PLACES_COLUMNS, _RENAMED))
   + " FROM places", lambda sp, sf: B.rename_headers(places(sp, sf), _RENAMED))

# ---------------------------------------------------------- C aggregates -----
_q("c1_max_population", _PP + "SELECT max(population) AS max_population FROM pop",
   lambda sp, sf: MR.max_population(_populated(sp, sf)))
_q("c1_max_population_by_country",
   _PP + "SELECT country_code, max(population) AS max_population FROM pop GROUP BY country_code",
   lambda sp, sf: MR.max_population(_populated(sp, sf), scope="country"))
_q("c2_population_threshold",
   _PP + "SELECT max(population) AS max_population, max(population) * 1e-1 AS threshold FROM pop",
   lambda sp, sf: MR.population_threshold(_populated(sp, sf)))
_q("c3_seat_admin2", _PP + "SELECT DISTINCT admin2_code FROM pop WHERE feature_code IN ('PPLA', 'PPLC') "
   "AND admin2_code IS NOT NULL", lambda sp, sf: MR.seat_admin2(_populated(sp, sf)))
_q("c4_distinct_codes_positive", _P + "SELECT DISTINCT feature_code FROM places WHERE population > 0",
   lambda sp, sf: PR.distinct_values(places(sp, sf), "feature_code", F.col("population") > 0))
_q("c4_distinct_classes_zero", _P + "SELECT DISTINCT feature_class FROM places WHERE population = 0",
   lambda sp, sf: PR.distinct_values(places(sp, sf), "feature_class", F.col("population") == 0))
_q("c5_stage_counts",
   f"SELECT (SELECT count(*) FROM ({S.PLACES_SQL}) l) AS loaded, count(*) AS populated, "
   "count(*) FILTER (WHERE isMetro) AS metros, count(*) FILTER (WHERE NOT isMetro) AS non_metros, "
   "count(*) FILTER (WHERE NOT isMetro AND assigned_metro_id IS NOT NULL) AS assigned "
   f"FROM ({_assign_sql('share_only', 'haversine')}) a",
   lambda sp, sf: PR.stage_counts(places(sp, sf), QUERIES["p1_assign_share_only_haversine"](sp, sf)))
def _c5_of_write(sp, sf):
    counts = write_assigned(places(sp, sf), scratch_path(sp, "assigned"), rule="share_only")
    return sp.createDataFrame([tuple(counts[c] for c in ("loaded", "populated", "metros", "non_metros", "assigned"))],
                              "loaded long, populated long, metros long, non_metros long, assigned long")


_q("c5_counts_of_write", ORACLE["c5_stage_counts"], _c5_of_write)
_q("c6_map_center", _PP + "SELECT round(avg(latitude), 6) AS mean_lat, round(avg(longitude), 6) AS mean_lon FROM pop",
   lambda sp, sf: round_doubles(PR.map_center(_populated(sp, sf))))


def _ids_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))


_IDS = S.with_(S.PLACES, "p AS (SELECT * FROM places WHERE feature_class = 'P')",
               "n AS (SELECT name, count(*) AS n_ids FROM p GROUP BY name)",
               "q AS (SELECT p.*, n_ids, CASE WHEN n_ids <= 8 THEN 0 ELSE geonameid // 8 END AS chunk "
               "FROM p JOIN n ON p.name = n.name)",
               "l AS (SELECT name, n_ids, chunk, string_agg(CAST(geonameid AS VARCHAR), ',' ORDER BY geonameid) AS ids "
               "FROM q GROUP BY name, n_ids, chunk)")
# chunks of 8 so that the larger scales have names on either side of the bound
_q("c7_ids_by_name", _IDS + "SELECT * FROM l",
   lambda sp, sf: _ids_text(PR.ids_by_name(B.filter_feature(places(sp, sf), class_="P"), chunk=8)))
_q("c10_group_has_ppla", _PP + "SELECT admin2_code, COALESCE(bool_or(feature_code = 'PPLA'), false) AS has_code "
   "FROM pop GROUP BY admin2_code",
   lambda sp, sf: PR.group_has(_populated(sp, sf), ["admin2_code"], "PPLA"))

# ------------------------------------------------------------- W windows -----
_PC = S.with_(S.PLACES, "p AS (SELECT * FROM places WHERE feature_class = 'P')")
_q("w2_duplicate_flag", _PC + "SELECT *, row_number() OVER (PARTITION BY name ORDER BY geonameid) > 1 AS is_duplicate "
   "FROM p", lambda sp, sf: PR.duplicate_flag(B.filter_feature(places(sp, sf), class_="P")))
_q("w3_duplicate_rows", _PC + "SELECT * FROM p WHERE name IN (SELECT name FROM p GROUP BY name HAVING count(*) > 1)",
   lambda sp, sf: PR.duplicate_rows(B.filter_feature(places(sp, sf), class_="P")))
_q("w4_duplicate_ids", _IDS + "SELECT q.*, l.ids FROM q JOIN l ON q.name = l.name AND q.chunk = l.chunk WHERE q.n_ids > 1",
   lambda sp, sf: _ids_text(PR.duplicate_ids(B.filter_feature(places(sp, sf), class_="P"), chunk=8)))
_W5 = S.with_(S.PLACES,
              "p AS (SELECT * FROM places WHERE feature_class = 'P' AND NOT COALESCE(feature_code IN ('PPLH', 'PPLX'), false))",
              "g2 AS (SELECT admin2_code, bool_or(feature_code = 'PPLA') AS has_a, bool_or(feature_code = 'PPLC') AS has_c "
              "FROM p WHERE admin2_code IS NOT NULL GROUP BY admin2_code)",
              "s1 AS (SELECT p.* FROM p JOIN g2 ON p.admin2_code = g2.admin2_code WHERE CASE WHEN g2.has_a THEN "
              "p.feature_code = 'PPLA' WHEN g2.has_c THEN p.feature_code = 'PPLC' ELSE true END)",
              "g3 AS (SELECT admin3_code, bool_or(feature_code = 'PPLA2') AS has_a2 FROM s1 "
              "WHERE admin3_code IS NOT NULL GROUP BY admin3_code)")
_q("w5_admin_dedupe", _W5 + "SELECT s1.* FROM s1 JOIN g3 ON s1.admin3_code = g3.admin3_code "
   "WHERE CASE WHEN g3.has_a2 THEN s1.feature_code = 'PPLA2' ELSE true END",
   lambda sp, sf: PR.admin_dedupe(places(sp, sf)))

# --------------------------------------------------------- F sort / sets -----
_q("f1_sort_by_id", _PP + "SELECT * FROM pop ORDER BY geonameid",
   lambda sp, sf: SO.sort_by_id(_populated(sp, sf)))
_q("f2_union_missing", S.with_(S.PLACES, S.POP, *S.flag_cte("share_only")) +
   f"SELECT *, round({S.radius_sql('population')}, 6) AS influence_radius FROM flag WHERE isMetro "
   "UNION ALL SELECT *, CAST(NULL AS DOUBLE) AS influence_radius FROM flag WHERE NOT isMetro",
   lambda sp, sf: round_doubles(SO.union_missing(
       *(lambda m, t: (with_radius(m), t))(*B.split_metros(MR.flag_metros(_populated(sp, sf), "share_only"))))))
_q("f3_concat_all", _P + "SELECT * FROM places WHERE population = 0 UNION ALL SELECT * FROM places WHERE population > 0 "
   "UNION ALL SELECT * FROM places WHERE feature_class = 'P'",
   lambda sp, sf: SO.concat_all(B.filter_population(places(sp, sf), "zero"), B.filter_population(places(sp, sf)),
                                B.filter_feature(places(sp, sf), class_="P")))
_q("f4_head_n", _P + "SELECT name, population FROM places WHERE feature_code = 'PPLA' ORDER BY geonameid LIMIT 20",
   lambda sp, sf: PR.head_n(places(sp, sf), 20))
_q("f5_distinct", _P + "SELECT DISTINCT country_code, admin1_code FROM places",
   lambda sp, sf: SO.distinct(places(sp, sf).select("country_code", "admin1_code")))


# ------------------------------------------------------------- D joins -------
def _metros_towns(sp, sf, rule="share_only"):
    m, t = B.split_metros(MR.flag_metros(_populated(sp, sf), rule))
    return with_radius(m), t


def _pairs_sql(metric: str, rule: str = "share_only") -> str:
    return S.with_(S.PLACES, S.POP, *S.pairs_ctes(rule, metric))


for _metric in ("haversine", "mercator_cos"):
    _q(f"d2_radius_join_{_metric}", _pairs_sql(_metric) + "SELECT tid AS geonameid, mid AS metro_id, mname AS metro_name, "
       "round(distance, 6) AS distance, round(force, 6) AS force FROM pairs",
       (lambda mt: lambda sp, sf: round_doubles(radius_join(*reversed(_metros_towns(sp, sf)), metric=mt)))(_metric))
_q("d3_bbox_candidates", _pairs_sql("haversine") +
   "SELECT t.geonameid, m.geonameid AS metro_id FROM towns t CROSS JOIN metros m WHERE "
   "abs(t.latitude - m.latitude) <= degrees(m.influence_radius / 6371e0) * 1.000001 + 1e-9 AND ("
   "abs(m.latitude) + degrees(m.influence_radius / 6371e0) >= 90 OR sin(m.influence_radius / 6371e0) / "
   "cos(radians(m.latitude)) >= 1 OR abs(((t.longitude - m.longitude + 180e0) % 360e0 + 360e0) % 360e0 - 180e0) <= "
   "degrees(asin(sin(m.influence_radius / 6371e0) / cos(radians(m.latitude)))) * 1.000001 + 1e-9)",
   lambda sp, sf: bbox_candidates(*reversed(_metros_towns(sp, sf))))
_q("d4_attach_best", _pairs_sql("haversine") +
   f"SELECT {S.cols('t')}, t.isMetro, b.mid AS assigned_metro_id FROM towns t LEFT JOIN best b ON t.geonameid = b.tid",
   lambda sp, sf: attach_best(*reversed(_metros_towns(sp, sf))))


def _d4_stored(sp, sf):
    """Index and towns are written by cell, loaded again and joined bucket by bucket."""
    towns, metros = reversed(_metros_towns(sp, sf))
    at, by = scratch_path(sp, "stored-index"), scratch_path(sp, "stored-towns")
    index = build_cell_index(metros, best=1)
    save_cell_index(index, at)
    save_places_by_cell(towns, by, index=index)
    out = attach_stored(sp, by, load_cell_index(sp, at, broadcast=False), "best")
    return out.select(*towns.columns, F.col("best.metro_id").alias("assigned_metro_id"))


_q("d4_attach_best_stored", ORACLE["d4_attach_best"], _d4_stored)
_q("d7_assignment_lines",
   f"WITH a AS ({_assign_sql('share_only', 'haversine')}) SELECT t.geonameid AS id, t.latitude AS lat, "
   "t.longitude AS lon, m.latitude AS metro_lat, m.longitude AS metro_lon FROM a t JOIN a m "
   "ON t.assigned_metro_id = m.geonameid",
   lambda sp, sf: assignment_lines(QUERIES["p1_assign_share_only_haversine"](sp, sf)))

# ---------------------------------------------- W1 ranking / C8 C9 lists -----
_q("w1_strongest_metro", _pairs_sql("haversine") +
   "SELECT tid AS geonameid, mid AS metro_id FROM best",
   lambda sp, sf: strongest_metros(*reversed(_metros_towns(sp, sf))).select("geonameid", "metro_id"))
_q("w1_top3_metros", _pairs_sql("haversine") +
   "SELECT geonameid, metro_id, rank FROM (SELECT tid AS geonameid, mid AS metro_id, CAST(row_number() OVER "
   "(PARTITION BY tid ORDER BY force DESC, distance, mid) AS INT) AS rank FROM pairs) q WHERE rank <= 3",
   lambda sp, sf: strongest_metros(*reversed(_metros_towns(sp, sf)), k=3).select("geonameid", "metro_id", "rank"))


def _p2(sp, sf):
    return assign_metros(places(sp, sf), rule="admin_seat", metric="haversine", candidates=True)


def _flat_candidates(df: DataFrame) -> DataFrame:
    c = F.col("candidates")
    ids = F.array_join(F.transform(c, lambda x: x["metro_id"].cast("string")), ",")
    return df.select(*PLACES_COLUMNS, "isMetro", F.round("influence_radius", 6).alias("influence_radius"),
                     "assigned_metro_id",
                     F.when(c.isNull(), F.lit(None)).otherwise(F.size(c)).cast("int").alias("n_candidates"),
                     F.when(c.isNull(), F.lit(None)).otherwise(ids).alias("candidate_ids"),
                     F.round(F.get(c, 0)["force"], 6).alias("top_force"))


_P2_SQL = _pairs_sql("haversine", "admin_seat") + f"""
, lists AS (SELECT tid, CAST(count(*) AS INT) AS n, string_agg(CAST(mid AS VARCHAR), ',' ORDER BY force DESC, distance, mid) AS ids,
   max(force) AS top FROM pairs GROUP BY tid)
SELECT {S.cols('m')}, m.isMetro, round(m.influence_radius, 6) AS influence_radius, m.geonameid AS assigned_metro_id,
  CAST(NULL AS INT) AS n_candidates, CAST(NULL AS VARCHAR) AS candidate_ids, CAST(NULL AS DOUBLE) AS top_force FROM metros m
UNION ALL
SELECT {S.cols('t')}, t.isMetro, CAST(NULL AS DOUBLE), b.mid, COALESCE(l.n, 0), COALESCE(l.ids, ''), round(l.top, 6)
FROM towns t LEFT JOIN best b ON t.geonameid = b.tid LEFT JOIN lists l ON t.geonameid = l.tid"""
_q("p2_assign_candidates_admin_seat", _P2_SQL, lambda sp, sf: _flat_candidates(_p2(sp, sf)))
_q("c8_candidate_list", S.with_(S.PLACES, S.POP, *S.pairs_ctes("admin_seat", "haversine")) +
   "SELECT t.geonameid, CAST(count(p.mid) AS INT) AS n_candidates, COALESCE(string_agg(CAST(p.mid AS VARCHAR), ',' "
   "ORDER BY p.force DESC, p.distance, p.mid), '') AS candidate_ids FROM towns t LEFT JOIN pairs p ON t.geonameid = p.tid "
   "GROUP BY t.geonameid",
   lambda sp, sf: _flat_candidates(_p2(sp, sf)).filter(~F.col("isMetro")).select(
       "geonameid", "n_candidates", "candidate_ids"))
_q("c9_best_of_candidates", S.with_(S.PLACES, S.POP, *S.pairs_ctes("admin_seat", "haversine")) +
   "SELECT t.geonameid, b.mid AS best_metro_id FROM towns t LEFT JOIN best b ON t.geonameid = b.tid",
   lambda sp, sf: _p2(sp, sf).filter(~F.col("isMetro")).select("geonameid", best_candidate("candidates").alias(
       "best_metro_id")))



# ----------------------------------------------------- A sources / sinks -----
from townpull.functions import geo as G  # noqa: E402
from townpull.functions import style as ST  # noqa: E402
from townpull.operators import boundaries as BD  # noqa: E402
from townpull.operators import regions as RG  # noqa: E402
from townpull.plans import growth as GR  # noqa: E402
from townpull.plans import maps as MP  # noqa: E402
from townpull.schema import assigned_schema  # noqa: E402
from townpull.session import scratch_path  # noqa: E402
from townpull.sources import boundaries as SB  # noqa: E402
from townpull.sources import files as FS  # noqa: E402
from townpull.sources.fixture import (WIDE_DLAT, WIDE_DLON, adjoining_squares, bow_tie, diamond_boundaries,  # noqa: E402
                                      diamond_ring, ring_of)

_PLACES_ALL = _P + "SELECT * FROM places"


def _a1(sp, sf):
    path = scratch_path(sp, "dump")
    FS.write_dump(places(sp, sf), path)
    return FS.scan_places(sp, path).select(*PLACES_COLUMNS)


def _a3(sp, sf):
    path = scratch_path(sp, "dump")
    FS.write_dump(places(sp, sf), path)
    return FS.load_lenient(sp, path).select(*PLACES_COLUMNS)


def _a4(sp, sf):
    text, zips = scratch_path(sp, "dump"), scratch_path(sp, "zips")
    FS.write_dump(places(sp, sf), text)
    FS.zip_text_parts(sp, text, zips).count()
    return FS.ingest_zipped_dumps(sp, zips).select(*PLACES_COLUMNS)


def _a2(sp, sf):
    root = scratch_path(sp, "dumps_by_country")
    pl = places(sp, sf)
    FS.to_dump_lines(pl, keep=["country_code"]).write.mode("overwrite").partitionBy("_country_code").text(root)
    return FS.scan_all_places(sp, os.path.join(root, "_country_code=*", "part-*")).select(*PLACES_COLUMNS)


_q("a1_scan_places", _PLACES_ALL, _a1)
_q("a2_scan_all_places_glob", _PLACES_ALL, _a2)
_q("a3_load_lenient", _PLACES_ALL, _a3)
_q("a4_ingest_zipped_dumps", _PLACES_ALL, _a4)

_ASSIGNED_SCHEMA = T.StructType([f for f in assigned_schema().fields if f.name in PLACES_COLUMNS + [
    "isMetro", "influence_radius", "assigned_metro_id"]])


def _a5(sp, sf):
    path = scratch_path(sp, "csv")
    FS.write_csv(QUERIES["p1_assign_share_only_haversine"](sp, sf), path)
    return FS.read_partitioned_csv(sp, path, _ASSIGNED_SCHEMA)


def _p6(sp, sf):
    root = scratch_path(sp, "by_country")
    FS.write_csv_by_country(QUERIES["p1_assign_share_only_haversine"](sp, sf), root)
    return FS.merge_sorted(FS.read_partitioned_csv(sp, root, _ASSIGNED_SCHEMA))


_q("a5_a7_csv_roundtrip", _assign_sql("share_only", "haversine"), _a5)
_q("p6_merge_output", _assign_sql("share_only", "haversine"), _p6)


def _a9(sp, sf):
    enc = FS.encode_nested(_p2(sp, sf), ["candidates"])
    return _flat_candidates(enc.withColumn("candidates", FS.decode_candidates("candidates")))


_q("a9_a10_nested_roundtrip", _P2_SQL.replace(
    "CAST(NULL AS INT) AS n_candidates, CAST(NULL AS VARCHAR) AS candidate_ids",
    "0 AS n_candidates, '' AS candidate_ids"), _a9)


# ------------------------------------------------------------ boundaries -----
def _b7_metros(sp, sf):
    return MR.metro_rule(_populated(sp, sf), "share_only")


_BOX_SQL = (S.with_(S.PLACES, S.POP, *S.flag_cte("share_only")) +
            "SELECT name, country_code, 1 AS n_rings, 5 AS n_vertices, round(latitude - 12e-2, 6) AS lat_min, "
            "round(latitude + 12e-2, 6) AS lat_max, round(longitude - 18e-2, 6) AS lon_min, "
            "round(longitude + 18e-2, 6) AS lon_max FROM flag WHERE isMetro")


def _box_summary(b: DataFrame) -> DataFrame:
    pts = F.flatten("polygons")
    lats, lons = F.transform(pts, lambda p: p["lat"]), F.transform(pts, lambda p: p["lon"])
    return round_doubles(b.select("name", "country_code", _n_rings().alias("n_rings"),
                                  F.size(pts).alias("n_vertices"), F.array_min(lats).alias("lat_min"),
                                  F.array_max(lats).alias("lat_max"), F.array_min(lons).alias("lon_min"),
                                  F.array_max(lons).alias("lon_max")))


def _a11(sp, sf):
    path = scratch_path(sp, "boundary_docs")
    SB.boundary_documents(diamond_boundaries(_b7_metros(sp, sf))).write.mode("overwrite").text(path)
    return _box_summary(SB.scan_boundaries(sp, path, multi_line=False))


def _a12(sp, sf):
    path = scratch_path(sp, "boundary_table")
    FS.write_parquet_table(diamond_boundaries(_b7_metros(sp, sf)), path)
    return _box_summary(FS.read_parquet_table(sp, path))


_q("a11_scan_boundaries", _BOX_SQL, _a11)
_q("a12_boundary_table_roundtrip", _BOX_SQL, _a12)
_q("a13_stage_checkpoint", _PP + "SELECT * FROM pop",
   lambda sp, sf: FS.stage_checkpoint(_populated(sp, sf), scratch_path(sp, "stage")))


def _with_diamonds(sp, sf):
    """Populated places; B7 metros carry their own diamond boundary, others none."""
    f = MR.flag_metros(_populated(sp, sf), "share_only")
    poly = F.when(F.col("isMetro"), F.array(diamond_ring(F.col("latitude"), F.col("longitude"))))
    return f.withColumn("polygons", poly)


_FLAG7 = S.with_(S.PLACES, S.POP, *S.flag_cte("share_only"))
_q("b13_split_has_boundary", _FLAG7 + "SELECT geonameid, country_code FROM flag WHERE isMetro",
   lambda sp, sf: B.split_boundaries(_with_diamonds(sp, sf))[0].select("geonameid", "country_code"))
_q("c11_boundary_rings", _FLAG7 + "SELECT geonameid AS id, 0 AS ring_no, 5 AS n_vertices, round(latitude - 12e-2, 6) "
   "AS lat_min, round(latitude + 12e-2, 6) AS lat_max FROM flag WHERE isMetro",
   lambda sp, sf: round_doubles(BD.boundary_rings(_with_diamonds(sp, sf)).select(
       "id", "ring_no", F.size("ring").alias("n_vertices"), "lat_min", "lat_max")))
_NESTED_SQL = _FLAG7 + """, m AS (SELECT * FROM flag WHERE isMetro)
SELECT geonameid, true AS has_boundary FROM m
UNION ALL
SELECT t.geonameid, false FROM flag t WHERE NOT t.isMetro AND NOT EXISTS (SELECT 1 FROM m WHERE
  abs(t.latitude - m.latitude) / 12e-2 + abs(t.longitude - m.longitude) / 18e-2 < 1e0)"""
_q("d6_remove_nested", _NESTED_SQL,
   lambda sp, sf: BD.remove_nested(_with_diamonds(sp, sf)).select("geonameid", B.has_polygons().alias("has_boundary")))

_FLAG9 = S.with_(S.PLACES, S.POP, *S.flag_cte("admin_seat"))


def _n_rings():
    """Ring count, null for rows without boundaries (independent of the ANSI size-of-null setting)."""
    return F.when(F.col("polygons").isNotNull(), F.size("polygons"))


def _b9_diamonds(sp, sf):
    return diamond_boundaries(MR.metro_rule(_populated(sp, sf), "admin_seat"))


_q("d5_attach_boundaries", _FLAG9 + "SELECT geonameid, 1 AS n_rings FROM flag WHERE isMetro",
   lambda sp, sf: BD.attach_boundaries(MR.metro_rule(_populated(sp, sf), "admin_seat"), _b9_diamonds(sp, sf))
   .select("geonameid", _n_rings().alias("n_rings")))
_q("d5_attach_boundaries_fanout", _FLAG9 + ", m AS (SELECT * FROM flag WHERE isMetro) "
   "SELECT a.geonameid, 1 AS n_rings FROM m a JOIN m b ON a.name = b.name",
   lambda sp, sf: BD.attach_boundaries(MR.metro_rule(_populated(sp, sf), "admin_seat"), _b9_diamonds(sp, sf),
                                       fanout=True).select("geonameid", _n_rings().alias("n_rings")))


def _scanned_diamonds(sp, sf):
    """Responses as a geocoder gives them: the country is only in the properties, in lower case."""
    path = scratch_path(sp, "boundary_responses")
    SB.boundary_documents(_b9_diamonds(sp, sf), properties=True).write.mode("overwrite").text(path)
    return SB.scan_boundaries(sp, path, multi_line=False)


_q("p3_enrich_boundaries", _FLAG9 + "SELECT geonameid, CASE WHEN isMetro THEN 1 END AS n_rings FROM flag",
   lambda sp, sf: BD.enrich_boundaries(_populated(sp, sf), _scanned_diamonds(sp, sf))
   .select("geonameid", _n_rings().alias("n_rings")))
_q("p4_remove_nested_after_enrich", _FLAG9 + """, m AS (SELECT * FROM flag WHERE isMetro)
SELECT geonameid, true AS has_boundary FROM m
UNION ALL
SELECT t.geonameid, false FROM flag t WHERE NOT t.isMetro AND NOT EXISTS (SELECT 1 FROM m WHERE
  abs(t.latitude - m.latitude) / 12e-2 + abs(t.longitude - m.longitude) / 18e-2 < 1e0)""",
   lambda sp, sf: BD.remove_nested(BD.enrich_boundaries(_populated(sp, sf), _b9_diamonds(sp, sf),
                                                        keys=("geonameid",)))
   .select("geonameid", B.has_polygons().alias("has_boundary")))


def _ring_variants(sp, sf):
    m = _b7_metros(sp, sf)
    lat, lon = F.col("latitude"), F.col("longitude")

    def pt(a, b):
        return F.struct(a.alias("lat"), b.alias("lon"))
    variants = F.array(
        F.struct(F.lit("diamond").alias("variant"), diamond_ring(lat, lon).alias("ring")),
        F.struct(F.lit("two_point").alias("variant"), F.array(pt(lat, lon), pt(lat + 0.1, lon)).alias("ring")),
        F.struct(F.lit("collinear").alias("variant"),
                 F.array(pt(lat, lon), pt(lat + 0.1, lon + 0.1), pt(lat + 0.2, lon + 0.2)).alias("ring")),
        F.struct(F.lit("with_null").alias("variant"),
                 F.array(pt(lat, lon), pt(lat + 0.1, lon), F.lit(None).cast("struct<lat:double,lon:double>"),
                         pt(lat, lon + 0.1)).alias("ring")))
    return m.select("geonameid", F.inline(variants)).select("geonameid", "variant",
                                                              G.ring_is_usable("ring").alias("usable"))


def _a9_polygons(sp, sf):
    text = FS.encode_nested(diamond_boundaries(_b7_metros(sp, sf)), ["polygons"])
    return _box_summary(text.withColumn("polygons", FS.decode_polygons("polygons")))


_q("a9_a10_polygons_roundtrip", _BOX_SQL, _a9_polygons)


def _points_in_diamonds(sp, sf):
    """Every metro's diamond against three points: its centre, one inside a tip and one outside."""
    lat, lon = F.col("latitude"), F.col("longitude")
    points = F.array(*(F.struct(F.lit(n).alias("point"), (lat + a).alias("lat"), (lon + b).alias("lon"))
                       for n, a, b in (("centre", 0.0, 0.0), ("tip", 0.11, 0.0), ("outside", 0.07, 0.1))))
    rows = _b7_metros(sp, sf).select("geonameid", diamond_ring(lat, lon).alias("ring"), F.inline(points))
    return rows.select("geonameid", "point", G.point_in_ring("lat", "lon", "ring").alias("inside"))


_q("g9_point_in_ring", _FLAG7 + ", m AS (SELECT * FROM flag WHERE isMetro) SELECT m.geonameid, v.point, v.inside "
   "FROM m CROSS JOIN (VALUES ('centre', true), ('tip', true), ('outside', false)) v(point, inside)", _points_in_diamonds)
_q("g10_ring_is_usable", _FLAG7 + ", m AS (SELECT * FROM flag WHERE isMetro) SELECT m.geonameid, v.variant, v.usable "
   "FROM m CROSS JOIN (VALUES ('diamond', true), ('two_point', false), ('collinear', false), ('with_null', false)) "
   "v(variant, usable)", _ring_variants)


# ---- regions: shared borders, rings that cross themselves, rings over the antimeridian
def _with_rings(sp, sf, polygons):
    f = MR.flag_metros(_populated(sp, sf), "share_only")
    return f.withColumn("polygons", F.when(F.col("isMetro"), polygons))


def _border_places(sp, sf):
    """Populated places whose metros hold two adjoining squares, and for each metro places on the
    common side, at that side's end, on the outer side and at an outer corner."""
    lat, lon = F.col("latitude"), F.col("longitude")
    df = _with_rings(sp, sf, adjoining_squares(lat, lon))
    spots = F.array(*(F.struct(F.lit(i * 10_000_000).alias("k"), a.alias("a"), o.alias("o")) for i, (a, o) in enumerate((
        (lat + 0.0503, lon), (lat, lon), (lat + WIDE_DLAT, lon), (lat + 0.0503, lon + WIDE_DLON),
        (lat - WIDE_DLAT, lon - WIDE_DLON)), 1)))
    extra = df.filter("isMetro").withColumn("s", F.explode(spots))
    new = {"geonameid": (F.col("geonameid") + F.col("s.k")).cast("int"), "latitude": F.col("s.a"), "longitude": F.col("s.o"),
           "isMetro": F.lit(False), "polygons": F.lit(None).cast(df.schema["polygons"].dataType)}
    return df.unionByName(extra.select(*(new[c].alias(c) if c in new else F.col(c) for c in df.columns)))


_q("d6_remove_nested_adjoining", _FLAG7 + f""", m AS (SELECT * FROM flag WHERE isMetro),
spot AS (SELECT geonameid, latitude, longitude FROM flag WHERE NOT isMetro
  UNION ALL SELECT geonameid + 10000000, latitude + 503e-4, longitude FROM m
  UNION ALL SELECT geonameid + 20000000, latitude, longitude FROM m
  UNION ALL SELECT geonameid + 30000000, latitude + {WIDE_DLAT}e0, longitude FROM m
  UNION ALL SELECT geonameid + 40000000, latitude + 503e-4, longitude + {WIDE_DLON}e0 FROM m
  UNION ALL SELECT geonameid + 50000000, latitude - {WIDE_DLAT}e0, longitude - {WIDE_DLON}e0 FROM m)
SELECT geonameid, true AS has_boundary FROM m
UNION ALL
SELECT geonameid, false FROM spot t WHERE NOT EXISTS (SELECT 1 FROM m WHERE
  t.latitude > m.latitude - {WIDE_DLAT}e0 AND t.latitude < m.latitude + {WIDE_DLAT}e0
  AND t.longitude > m.longitude - {WIDE_DLON}e0 AND t.longitude < m.longitude + {WIDE_DLON}e0)""",
   lambda sp, sf: BD.remove_nested(_border_places(sp, sf)).select("geonameid", B.has_polygons().alias("has_boundary")))


def _outline(sp, sf):
    rings = BD.boundary_rings(_with_rings(sp, sf, adjoining_squares(F.col("latitude"), F.col("longitude"))))
    return round_doubles(RG.boundary_outline(rings))


_q("c11_boundary_outline", _FLAG7 + f""", m AS (SELECT DISTINCT latitude AS y, longitude AS x FROM flag WHERE isMetro),
c AS (SELECT y, x, y - {WIDE_DLAT}e0 AS s, y + {WIDE_DLAT}e0 AS n, x - {WIDE_DLON}e0 AS w, x + {WIDE_DLON}e0 AS e FROM m),
edge(a, b, c, d) AS (SELECT s, w, s, x FROM c UNION ALL SELECT s, x, s, e FROM c UNION ALL SELECT s, e, n, e FROM c
  UNION ALL SELECT n, e, n, x FROM c UNION ALL SELECT n, x, n, w FROM c UNION ALL SELECT n, w, s, w FROM c
  -- the common side: the halves differ in their vertices, so both keep it
  UNION ALL SELECT s, x, n, x FROM c UNION ALL SELECT n, x, y, x FROM c UNION ALL SELECT y, x, s, x FROM c)
SELECT round(a, 6) AS lat_a, round(b, 6) AS lon_a, round(c, 6) AS lat_b, round(d, 6) AS lon_b FROM edge""", _outline)


def _grid_outline(sp, sf):
    """Outline of one-degree districts (every lattice square that holds a metro), which share whole sides."""
    m = _b7_metros(sp, sf).select(F.floor("latitude").cast("double").alias("s"), F.floor("longitude").cast("double").alias("w")).distinct()
    s, w = F.col("s"), F.col("w")
    rings = m.select(F.when((s + w) % 2 == 0, ring_of((s, w), (s, w + 1), (s + 1, w + 1), (s + 1, w)))
                     .otherwise(ring_of((s, w), (s + 1, w), (s + 1, w + 1), (s, w + 1))).alias("ring"))
    return RG.boundary_outline(rings)


_q("c11_district_outline", _FLAG7 + """, m AS (SELECT DISTINCT CAST(floor(latitude) AS DOUBLE) AS s, CAST(floor(longitude) AS DOUBLE) AS w
  FROM flag WHERE isMetro)
SELECT s AS lat_a, w AS lon_a, s AS lat_b, w + 1 AS lon_b FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.s = m.s - 1 AND o.w = m.w)
UNION ALL SELECT s, w + 1, s + 1, w + 1 FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.s = m.s AND o.w = m.w + 1)
UNION ALL SELECT s + 1, w + 1, s + 1, w FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.s = m.s + 1 AND o.w = m.w)
UNION ALL SELECT s + 1, w, s, w FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.s = m.s AND o.w = m.w - 1)""", _grid_outline)


_q("d6_remove_nested_crossing", _FLAG7 + f""", m AS (SELECT * FROM flag WHERE isMetro)
SELECT geonameid, true AS has_boundary FROM m
UNION ALL
SELECT t.geonameid, false FROM flag t WHERE NOT t.isMetro AND NOT EXISTS (SELECT 1 FROM m WHERE
  abs(t.latitude - m.latitude) / {WIDE_DLAT}e0 < abs(t.longitude - m.longitude) / {WIDE_DLON}e0
  AND abs(t.longitude - m.longitude) < {WIDE_DLON}e0)""",
   lambda sp, sf: BD.remove_nested(_with_rings(sp, sf, F.array(bow_tie(F.col("latitude"), F.col("longitude")))))
   .select("geonameid", B.has_polygons().alias("has_boundary")))


def _over_antimeridian(sp, sf):
    """The same places moved east by 161 degrees, so that many diamonds pass the antimeridian."""
    def wrapped(lon):
        return F.when(lon > 180.0, lon - 360.0).otherwise(lon)
    lat, lon = F.col("latitude"), F.col("longitude")
    ring = F.transform(diamond_ring(lat, lon + 161.0, WIDE_DLAT, WIDE_DLON),
                       lambda p: F.struct(p["lat"].alias("lat"), wrapped(p["lon"]).alias("lon")))
    return _with_rings(sp, sf, F.array(ring)).withColumn("longitude", wrapped(lon + 161.0))


_q("d6_remove_nested_antimeridian", _FLAG7 + f""", m AS (SELECT * FROM flag WHERE isMetro)
SELECT geonameid, true AS has_boundary FROM m
UNION ALL
SELECT t.geonameid, false FROM flag t WHERE NOT t.isMetro AND NOT EXISTS (SELECT 1 FROM m WHERE
  abs(t.latitude - m.latitude) / {WIDE_DLAT}e0 + abs(t.longitude - m.longitude) / {WIDE_DLON}e0 < 1e0)""",
   lambda sp, sf: BD.remove_nested(_over_antimeridian(sp, sf)).select("geonameid", B.has_polygons().alias("has_boundary")))


def _ring_verdicts(sp, sf):
    lat, lon = F.col("latitude"), F.col("longitude")

    def pt(a, o):
        return F.struct((lat + a).alias("lat"), (lon + o).alias("lon"))
    shapes = {"diamond": diamond_ring(lat, lon), "bow_tie": bow_tie(lat, lon),
              "two_point": F.array(pt(0.0, 0.0), pt(0.1, 0.0)),
              "notch": F.array(pt(0.0, 0.0), pt(0.0, 0.4), pt(0.4, 0.4), pt(0.1, 0.2), pt(0.4, 0.0)),
              "pierced": F.array(pt(0.0, 0.0), pt(0.0, 0.4), pt(0.4, 0.4), pt(-0.1, 0.2), pt(0.4, 0.0)),
              "spike": F.array(pt(0.0, 0.0), pt(0.0, 0.4), pt(0.4, 0.4), pt(0.0, 0.4), pt(-0.3, 0.1))}
    rings = _b7_metros(sp, sf).select("geonameid", F.inline(F.array(*(
        F.struct(F.lit(k).alias("variant"), r.alias("ring")) for k, r in shapes.items()))))
    return RG.ring_verdicts(rings).select("geonameid", "variant", "usable", "crossing")


_q("g10_ring_verdicts", _FLAG7 + """, m AS (SELECT * FROM flag WHERE isMetro) SELECT m.geonameid, v.variant, v.usable, v.crossing
FROM m CROSS JOIN (VALUES ('diamond', true, false), ('bow_tie', true, true), ('two_point', false, false), ('notch', true, false),
  ('pierced', true, true), ('spike', true, true)) v(variant, usable, crossing)""", _ring_verdicts)


# ------------------------------------------------------- G expressions -------
def _geo_exprs(sp, sf):
    p = _populated(sp, sf)
    lat, lon = F.col("latitude"), F.col("longitude")
    hav = G.haversine_km(lat, lon, F.lit(52.0), F.lit(19.0))
    rad = G.influence_radius_km("population")
    xy = G.web_mercator_xy(lon, lat)
    pt = G.point(lon, lat)
    return round_doubles(p.select(
        "geonameid", rad.alias("radius_km"), hav.alias("haversine_km"),
        G.pull_force(hav, rad).alias("force"), pt["x"].alias("pt_x"), pt["y"].alias("pt_y"),
        xy["x"].alias("merc_x"), xy["y"].alias("merc_y"),
        G.mercator_cos_km(lat, lon, F.lit(52.0), F.lit(19.0)).alias("mercator_cos_km"),
        G.to_int("admin2_code").alias("admin2_int"), G.to_double("admin3_code", 0.0).alias("admin3_num")))


_HAV_FIXED = ("(6371e0 * (2e0 * atan2(sqrt(pow(sin(radians(52e0 - latitude) / 2), 2) + cos(radians(latitude)) * "
              "cos(radians(52e0)) * pow(sin(radians(19e0 - longitude) / 2), 2)), sqrt(1e0 - (pow(sin(radians(52e0 - "
              "latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(52e0)) * pow(sin(radians(19e0 - longitude) / 2)"
              ", 2))))))")
_MERC_FIXED = ("(sqrt(pow(6378137e0 * (radians(longitude) - radians(19e0)), 2) + pow(6378137e0 * (ln(tan(pi() / 4e0 + "
               "radians(latitude) / 2)) - ln(tan(pi() / 4e0 + radians(52e0) / 2))), 2)) * cos(radians(latitude)) / 1e3)")
_q("g1_g7_geo_expressions", _PP + f"""SELECT geonameid, round({S.radius_sql('population')}, 6) AS radius_km,
 round({_HAV_FIXED}, 6) AS haversine_km, round(exp(-1.4e0 * {_HAV_FIXED} / {S.radius_sql('population')}), 6) AS force,
 round(longitude, 6) AS pt_x, round(latitude, 6) AS pt_y,
 round(6378137e0 * radians(longitude), 6) AS merc_x, round(6378137e0 * ln(tan(pi() / 4e0 + radians(latitude) / 2)), 6) AS merc_y,
 round({_MERC_FIXED}, 6) AS mercator_cos_km, TRY_CAST(admin2_code AS INTEGER) AS admin2_int,
 COALESCE(TRY_CAST(admin3_code AS DOUBLE), 0e0) AS admin3_num FROM pop""", _geo_exprs)


def _style_exprs(sp, sf):
    f = MR.flag_metros(_populated(sp, sf), "share_only")
    return round_doubles(f.select(
        "geonameid", ST.marker_radius("population").alias("marker_radius"),
        ST.color_by_metro().alias("color_metro"), ST.color_by_code().alias("color_code"),
        ST.color_by_lookup().alias("color_lookup"), ST.tooltip_text().alias("tooltip"),
        ST.popup_text().alias("popup"), ST.safe_id("admin2_code").alias("admin2_id")))


def _nan(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), 'nan')"


_LOOKUP_SQL = "CASE feature_code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ST.CODE_COLORS.items()) + \
    f" ELSE '{ST.CODE_COLOR_DEFAULT}' END"
_q("g11_g18_style_expressions", _FLAG7 + f"""SELECT geonameid,
 round(CASE WHEN population IS NULL OR population < 1000 THEN 3e0 WHEN population < 50000 THEN 3e0 + (population - 1000) / 49000e0 * 5
  WHEN population < 200000 THEN 8e0 + (population - 50000) / 150000e0 * 4 ELSE 12e0 END, 6) AS marker_radius,
 CASE WHEN isMetro THEN 'red' ELSE 'blue' END AS color_metro,
 CASE WHEN starts_with(feature_code, 'PPLA') THEN 'red' WHEN feature_code = 'PPLC' THEN 'green' ELSE 'blue' END AS color_code,
 {_LOOKUP_SQL} AS color_lookup,
 'City: ' || {_nan('name')} || '<br>Population: ' || {_nan('population')} || '<br>Feature: ' || {_nan('feature_code')}
  || '<br>Admin1: ' || {_nan('admin1_code')} || ', Admin2: ' || {_nan('admin2_code')} || ', Admin3: ' || {_nan('admin3_code')} AS tooltip,
 '<b>Nazwa:</b> ' || {_nan('name')} || '<br><b>Feature Code:</b> ' || {_nan('feature_code')} || '<br><b>Populacja:</b> '
  || {_nan('population')} || '<br><b>Geoname ID:</b> ' || {_nan('geonameid')} || '<br><b>Współrzędne:</b> (' || {_nan('latitude')}
  || ', ' || {_nan('longitude')} || ')<br><b>Admin1 code:</b> ' || {_nan('admin1_code')} || ' <br><b>Admin2 code:</b> '
  || {_nan('admin2_code')} || ' <br><b>Admin3 code:</b> ' || {_nan('admin3_code')} AS popup,
 TRY_CAST(admin2_code AS INTEGER) AS admin2_id FROM flag""", _style_exprs)
_q("g17_candidate_text", S.with_(S.PLACES, S.POP, *S.pairs_ctes("admin_seat", "haversine")) +
   "SELECT t.geonameid, COALESCE('<br>Candidate Metros:<br>' || string_agg(printf('%s | %d (force: %.3f, dist: %.1f km)', "
   "p.mname, p.mid, p.force, p.distance), '<br>' ORDER BY p.force DESC, p.distance, p.mid), '') AS candidate_text "
   "FROM towns t LEFT JOIN pairs p ON t.geonameid = p.tid GROUP BY t.geonameid",
   lambda sp, sf: _p2(sp, sf).filter(~F.col("isMetro")).select(
       "geonameid", ST.candidate_text("candidates").alias("candidate_text")))

# ------------------------------------------------------------ P5 layers ------
_q("p5_markers", f"SELECT geonameid AS id, latitude AS lat, longitude AS lon, round(CASE WHEN population IS NULL OR "
   "population < 1000 THEN 3e0 WHEN population < 50000 THEN 3e0 + (population - 1000) / 49000e0 * 5 WHEN population < "
   "200000 THEN 8e0 + (population - 50000) / 150000e0 * 4 ELSE 12e0 END, 6) AS radius, CASE WHEN isMetro THEN 'red' "
   f"ELSE 'blue' END AS color, 'City: ' || {_nan('name')} || '<br>Population: ' || {_nan('population')} || "
   f"'<br>Feature: ' || {_nan('feature_code')} || '<br>Admin1: ' || {_nan('admin1_code')} || ', Admin2: ' || "
   f"{_nan('admin2_code')} || ', Admin3: ' || {_nan('admin3_code')} AS tooltip FROM "
   f"({_assign_sql('share_only', 'haversine')}) a",
   lambda sp, sf: round_doubles(MP.map_layers(QUERIES["p1_assign_share_only_haversine"](sp, sf))["markers"]))
_q("p5_polygon_layer", _FLAG7 + f"SELECT geonameid AS id, 0 AS ring_no, 5 AS n_vertices, 'City: ' || {_nan('name')} || "
   f"'<br>Population: ' || {_nan('population')} || '<br>Feature: ' || {_nan('feature_code')} || '<br>Admin1: ' || "
   f"{_nan('admin1_code')} || ', Admin2: ' || {_nan('admin2_code')} || ', Admin3: ' || {_nan('admin3_code')} AS tooltip "
   "FROM flag WHERE isMetro",
   lambda sp, sf: MP.map_layers(_with_diamonds(sp, sf))["polygons"].select(
       "id", "ring_no", F.size("ring").alias("n_vertices"), "tooltip"))


# ------------------------------------------------------------- P8 profile ----
def _p8(sp, sf):
    pl = places(sp, sf)
    p_rows = B.filter_feature(pl, class_="P")
    n_dup = PR.duplicate_rows(p_rows).agg(F.count(F.lit(1))).scalar()
    n_codes = PR.distinct_values(pl, "feature_code", F.col("population") > 0).agg(F.count(F.lit(1))).scalar()
    n_head = PR.head_n(pl, 20).agg(F.count(F.lit(1))).scalar()
    pop, code = F.col("population"), F.col("feature_code")
    return pl.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(pop == 0).alias("n_zero_population"),
                  F.count_if(pop > 0).alias("n_positive_population"),
                  F.count_if((code == "HTL") & (pop > 0)).alias("n_hotels_populated"),
                  F.count_if(F.col("feature_class") == "P").alias("n_class_p")).select(
        "*", n_dup.alias("n_duplicate_name_rows"), n_codes.alias("n_codes_positive"), n_head.alias("n_ppla_head"))


_q("p8_profile_summary", _PC + ", pl AS (SELECT * FROM places) SELECT count(*) AS n_rows, "
   "count(*) FILTER (WHERE population = 0) AS n_zero_population, count(*) FILTER (WHERE population > 0) AS "
   "n_positive_population, count(*) FILTER (WHERE feature_code = 'HTL' AND population > 0) AS n_hotels_populated, "
   "count(*) FILTER (WHERE feature_class = 'P') AS n_class_p, (SELECT count(*) FROM p WHERE name IN (SELECT name FROM p "
   "GROUP BY name HAVING count(*) > 1)) AS n_duplicate_name_rows, (SELECT count(DISTINCT feature_code) FROM pl WHERE "
   "population > 0) AS n_codes_positive, (SELECT count(*) FROM (SELECT 1 FROM pl WHERE feature_code = 'PPLA' LIMIT 20) "
   "h) AS n_ppla_head FROM pl", _p8)


# -------------------------------------------------------------- K1 / K2 ------
def _growth_ctes(max_iter: int, rule: str = "share_only") -> list[str]:
    ctes = [S.PLACES, S.POP, *S.flag_cte(rule),
            "towns AS (SELECT * FROM flag WHERE NOT isMetro)",
            "eff0 AS (SELECT geonameid, name, latitude, longitude, population, CAST(population AS BIGINT) AS eff "
            "FROM flag WHERE isMetro)"]
    for k in range(max_iter + 1):
        ctes += [
            f"m{k} AS (SELECT *, {S.radius_sql('eff')} AS r FROM eff{k})",
            f"d{k} AS (SELECT t.geonameid AS tid, t.population AS tpop, m.geonameid AS mid, "
            f"{S.haversine_sql('t', 'm')} AS distance, m.r FROM towns t CROSS JOIN m{k} m)",
            f"p{k} AS (SELECT tid, tpop, mid, distance, exp(-1.4e0 * distance / r) AS force FROM d{k} WHERE distance < r)",
            f"b{k} AS (SELECT tid, tpop, mid FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY force DESC, "
            f"distance, mid) AS rn FROM p{k}) q WHERE rn = 1)"]
        if k < max_iter:
            ctes.append(f"eff{k + 1} AS (SELECT e.geonameid, e.name, e.latitude, e.longitude, e.population, "
                        f"CAST(e.population + COALESCE(g.gain, 0) AS BIGINT) AS eff FROM eff0 e LEFT JOIN "
                        f"(SELECT mid, sum(tpop) AS gain FROM b{k} GROUP BY mid) g ON e.geonameid = g.mid)")
    return ctes


def _growth_sql(max_iter: int, rule: str = "share_only") -> str:
    ctes = _growth_ctes(max_iter, rule)
    k = max_iter
    return S.with_(*ctes) + f"""SELECT {S.cols('f')}, f.isMetro, e.eff AS eff_population,
 round({S.radius_sql('e.eff')}, 6) AS influence_radius, f.geonameid AS assigned_metro_id
FROM flag f JOIN eff{k} e ON f.geonameid = e.geonameid WHERE f.isMetro
UNION ALL
SELECT {S.cols('t')}, t.isMetro, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), b.mid FROM towns t LEFT JOIN b{k} b ON t.geonameid = b.tid"""


# SQL unrolls more rounds than the loop needs: past the fixed point a round changes nothing
# (tests check that the driver's scales settle before the last one)
ORACLE_ROUNDS = 10
_q("k1_iterative_growth", _growth_sql(ORACLE_ROUNDS),
   lambda sp, sf: round_doubles(GR.iterative_growth(places(sp, sf))))


def _k2(sp, sf):
    out, rounds, _ = GR.iterative_growth(places(sp, sf), return_rounds=True)
    return GR.growth_lines(rounds, out.filter(F.col("isMetro")))


def _k2_sql(max_iter: int) -> str:
    """Lines of round 0 and of every round k whose rounds 1..k all changed some metro's
    effective population (the loop stops at the first round without change)."""
    def changed(k: int) -> str:
        return (f"(SELECT count(*) FROM eff{k} a JOIN eff{k - 1} b ON a.geonameid = b.geonameid "
                f"WHERE a.eff <> b.eff) > 0")
    parts = []
    for k in range(max_iter + 1):
        cond = " AND ".join(changed(j) for j in range(1, k + 1)) or "true"
        parts.append(f"SELECT {k} AS iteration, t.geonameid AS id, t.latitude AS lat, t.longitude AS lon, "
                     f"m.latitude AS metro_lat, m.longitude AS metro_lon FROM b{k} b JOIN towns t ON b.tid = t.geonameid "
                     f"JOIN flag m ON m.geonameid = b.mid AND m.isMetro WHERE {cond}")
    return S.with_(*_growth_ctes(max_iter)) + "\nUNION ALL\n".join(parts)


_q("k2_growth_lines", _k2_sql(ORACLE_ROUNDS), _k2)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """P1 with the parity rule and the haversine metric."""
    return QUERIES["p1_assign_share_only_haversine"](spark, sf)


__all__ = ["QUERIES", "ORACLE", "flagship", "register", "round_doubles", "PLACES_COLUMNS"]
