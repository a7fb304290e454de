"""SQL text of the DuckDB oracles (the same semantics written independently as SQL).

Only used to check the DataFrame implementations; nothing here runs on Spark.
"""

from __future__ import annotations

from townpull.schema import POPULATED_CODES
from townpull.sources.fixture import PLACES_COLUMNS, PLACES_SQL

PLACES = f"places AS ({PLACES_SQL})"
POP = "pop AS (SELECT * FROM places WHERE feature_code IN ({}))".format(
    ", ".join(f"'{c}'" for c in POPULATED_CODES))
COLS = ", ".join(PLACES_COLUMNS)


def cols(alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in PLACES_COLUMNS)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def radius_sql(pop: str) -> str:
    return f"(10e0 + 90e0 * (1e0 - exp(-({pop}) / 1443000e0)))"


def haversine_sql(t: str, m: str) -> str:
    a = (f"(pow(sin(radians({m}.latitude - {t}.latitude) / 2), 2) + cos(radians({t}.latitude)) * "
         f"cos(radians({m}.latitude)) * pow(sin(radians({m}.longitude - {t}.longitude) / 2), 2))")
    return f"(6371e0 * (2e0 * atan2(sqrt({a}), sqrt(1e0 - {a}))))"


def mercator_sql(t: str, m: str) -> str:
    def y(a: str) -> str:
        return f"ln(tan(pi() / 4e0 + radians({a}.latitude) / 2))"
    dx = f"(6378137e0 * (radians({t}.longitude) - radians({m}.longitude)))"
    dy = f"(6378137e0 * ({y(t)} - {y(m)}))"
    return f"(sqrt({dx} * {dx} + {dy} * {dy}) * cos(radians({t}.latitude)) / 1e3)"


def distance_sql(metric: str, t: str, m: str) -> str:
    return haversine_sql(t, m) if metric == "haversine" else mercator_sql(t, m)


def flag_cte(rule: str, scope: str = "global", src: str = "pop", name: str = "flag") -> list[str]:
    """CTEs ending in ``name`` = src + isMetro."""
    if scope == "global":
        thr = f"(SELECT max(population) FROM {src}) * 1e-1"
        seat_cte = (f"seats AS (SELECT DISTINCT admin2_code FROM {src} WHERE feature_code IN ('PPLA', 'PPLC') "
                    f"AND admin2_code IS NOT NULL)")
        in_seat = "COALESCE(x.admin2_code IN (SELECT admin2_code FROM seats), false)"
    else:
        thr = f"(SELECT max(population) FROM {src} s2 WHERE s2.country_code = x.country_code) * 1e-1"
        seat_cte = (f"seats AS (SELECT DISTINCT country_code, admin1_code, admin2_code FROM {src} "
                    f"WHERE feature_code IN ('PPLA', 'PPLC') AND admin2_code IS NOT NULL)")
        in_seat = ("EXISTS (SELECT 1 FROM seats s WHERE s.country_code = x.country_code AND "
                   "s.admin1_code = x.admin1_code AND s.admin2_code = x.admin2_code)")
    if rule == "share_only":
        mask = f"x.population >= {thr}"
    elif rule == "share_excl_ppl":
        mask = f"x.population >= {thr} AND NOT (x.feature_code = 'PPL' AND {in_seat})"
    else:
        mask = (f"x.feature_code IN ('PPLA', 'PPLA2', 'PPLC') OR (x.feature_code = 'PPL' AND "
                f"x.population > 100000 AND NOT {in_seat})")
    return [seat_cte, f"{name} AS (SELECT x.*, COALESCE({mask}, false) AS isMetro FROM {src} x)"]


def pairs_ctes(rule: str, metric: str, scope: str = "global", src: str = "pop") -> list[str]:
    """CTEs: flag, metros (with influence_radius), towns, pairs(tid, mid, mname, distance, force)."""
    return flag_cte(rule, scope, src) + [
        f"metros AS (SELECT *, {radius_sql('population')} AS influence_radius FROM flag WHERE isMetro)",
        "towns AS (SELECT * FROM flag WHERE NOT isMetro)",
        f"dist AS (SELECT t.geonameid AS tid, m.geonameid AS mid, m.name AS mname, "
        f"{distance_sql(metric, 't', 'm')} AS distance, m.influence_radius AS r FROM towns t CROSS JOIN metros m)",
        "pairs AS (SELECT tid, mid, mname, distance, exp(-1.4e0 * distance / r) AS force FROM dist WHERE distance < r)",
        "best AS (SELECT tid, mid FROM (SELECT tid, mid, row_number() OVER (PARTITION BY tid ORDER BY force DESC, "
        "distance, mid) AS rn FROM pairs) q WHERE rn = 1)",
    ]
