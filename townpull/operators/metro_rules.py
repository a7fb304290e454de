"""Metro selection: aggregates C1-C3 and rules B7-B10.

Three named rules (the source project's code paths disagree, see README):

* ``share_only``      population >= share * max(population)          (parity with its Spark code)
* ``share_excl_ppl``  the share rule, and a PPL must not lie in the admin2 area
                      of a PPLA/PPLC seat                              (the documented intent)
* ``admin_seat``      PPLA/PPLA2/PPLC, or a PPL with population > 100000 outside
                      every seat's admin2 area                         (its pandas code)

A null admin2 is never "in" a seat area. ``scope="global"`` takes the maximum and the
seat areas over the whole input; ``scope="country"`` per country_code (seat areas
keyed by country, admin1 and admin2).

Plans: the global maximum is a scalar subquery (partial aggregation, one value
shipped to the tasks); per-country maxima and seat areas are aggregated tables
joined back many-to-one, broadcast only behind a size check. No window spans a
country, so a country holding a third of the rows does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.operators.sizing import join_small
from townpull.schema import (ADMIN_SEAT_METRO_CODES, ADMIN_SEAT_MIN_POPULATION, METRO_SHARE,
                             SEAT_CODES)

RULES = ("share_only", "share_excl_ppl", "admin_seat")


def _scope_keys(scope: str) -> list[str]:
    if scope == "global":
        return []
    if scope == "country":
        return ["country_code"]
    raise ValueError("scope must be 'global' or 'country'")


def _seat_keys(scope: str) -> list[str]:
    return ["admin2_code"] if scope == "global" else ["country_code", "admin1_code", "admin2_code"]


def max_population(df: DataFrame, scope: str = "global") -> DataFrame:
    """Maximum population (one row, or one per country); null on empty input."""
    keys = _scope_keys(scope)
    agg = F.max(F.col("population")).alias("max_population")
    return df.groupBy(*keys).agg(agg) if keys else df.agg(agg)


def population_threshold(df: DataFrame, share: float = METRO_SHARE, scope: str = "global") -> DataFrame:
    """``share * max(population)`` as double, with the maximum alongside."""
    return max_population(df, scope).withColumn(
        "threshold", F.col("max_population").cast("double") * F.lit(float(share)))


def seat_admin2(df: DataFrame, scope: str = "global", codes=SEAT_CODES) -> DataFrame:
    """Distinct non-null admin2 areas (keys) that hold a seat code."""
    keys = _seat_keys(scope)
    return (df.filter(F.col("feature_code").isin(list(codes)) & F.col("admin2_code").isNotNull())
            .select(*keys).distinct())


def _with_threshold(df: DataFrame, share: float, scope: str, basis: DataFrame | None = None) -> tuple[DataFrame, Column]:
    basis = df if basis is None else basis
    if scope == "global":
        mx = basis.agg(F.max(F.col("population")).alias("m")).scalar()
        return df, mx.cast("double") * F.lit(float(share))
    thr = (population_threshold(basis, share, scope).filter(F.col("country_code").isNotNull())
           .select("country_code", F.col("threshold").alias("_thr")))
    return join_small(df, thr, "country_code", "left", null_spread=True), F.col("_thr")


def _with_seat_flag(df: DataFrame, scope: str, basis: DataFrame | None = None) -> tuple[DataFrame, Column]:
    keys = _seat_keys(scope)
    seats = seat_admin2(df if basis is None else basis, scope).withColumn("_seat", F.lit(True))
    joined = join_small(df, seats, keys, "left", null_spread=True)
    return joined, F.coalesce(F.col("_seat"), F.lit(False))


def flag_metros(df: DataFrame, rule: str = "share_excl_ppl", share: float = METRO_SHARE,
                scope: str = "global", min_pop: int = ADMIN_SEAT_MIN_POPULATION,
                flag: str = "isMetro", basis: DataFrame | None = None) -> DataFrame:
    """Add a never-null boolean ``isMetro`` under the named rule. The facts it needs (largest
    population, seat areas) are those of ``basis``, by default of ``df`` itself."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if flag in df.columns:  # re-flagging an already flagged table replaces the flag
        df = df.drop(flag)
    cols = df.columns
    pop = F.col("population")
    code = F.col("feature_code")
    if rule == "share_only":
        out, thr = _with_threshold(df, share, scope, basis)
        mask = pop >= thr
    elif rule == "share_excl_ppl":
        out, thr = _with_threshold(df, share, scope, basis)
        out, seat = _with_seat_flag(out, scope, df if basis is None else basis)
        mask = (pop >= thr) & ~((code == "PPL") & seat)
    else:
        out, seat = _with_seat_flag(df, scope, basis)
        mask = code.isin(ADMIN_SEAT_METRO_CODES) | ((code == "PPL") & (pop > min_pop) & ~seat)
    return out.select(*cols, F.coalesce(mask, F.lit(False)).alias(flag))


def metro_rule(df: DataFrame, rule: str = "share_excl_ppl", **kw) -> DataFrame:
    """The rows that are metros under ``rule``."""
    return flag_metros(df, rule, **kw).filter(F.col("isMetro")).drop("isMetro")
