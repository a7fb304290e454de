"""Profiling aggregates and duplicate / hierarchy clean-up.

Group-level facts (counts, first id, "does the group hold code X") are computed
with hash aggregates (partial aggregation before the shuffle) and joined back
many-to-one, broadcast only when the group table is proven small. No window
spans a name or an admin area, so a group holding a third of the rows is never
sorted or buffered inside one task, and lists of ids have a bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.operators.sizing import join_small, materialize


def distinct_values(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """C4: distinct values of ``col`` under an optional filter."""
    return (df.filter(where) if where is not None else df).select(col).distinct()


def stage_counts(loaded: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row of stage counts: loaded, populated (assignment input), metros,
    non-metros, towns assigned. Two aggregations; nothing is collected."""
    n_loaded = loaded.agg(F.count(F.lit(1))).scalar()
    return assigned.agg(
        F.count(F.lit(1)).alias("populated"),
        F.count_if(F.col("isMetro")).alias("metros"),
        F.count_if(~F.col("isMetro")).alias("non_metros"),
        F.count_if(~F.col("isMetro") & F.col("assigned_metro_id").isNotNull()).alias("assigned"),
    ).select(n_loaded.alias("loaded"), "*")


def map_center(df: DataFrame) -> DataFrame:
    """Mean latitude and longitude."""
    return df.agg(F.avg("latitude").alias("mean_lat"), F.avg("longitude").alias("mean_lon"))


IDS_PER_CHUNK = 1_000


def ids_by_name(df: DataFrame, key: str = "name", chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """Every id of each name, as rows (name, chunk, ids, n_ids).

    A name with at most ``chunk`` rows has one chunk, 0, with its ascending id list. The ids of
    a name with more lie in chunks of ids with the same ``id div chunk``, at most ``chunk``
    different ones, so no list grows with a name. Null names are one name; null ids are not
    listed (they count in ``n_ids``); ids that repeat are listed once.
    """
    g = df.select(_group_key(key).alias("_g"), F.col("geonameid"))
    sizes = g.groupBy("_g").agg(F.count(F.lit(1)).alias("n_ids"))
    rows = join_small(g, sizes, "_g", "inner").withColumn("chunk", _id_chunk(chunk))
    lists = rows.groupBy("_g", "n_ids", "chunk").agg(F.sort_array(F.collect_set("geonameid")).alias("ids"))
    return lists.select(F.col("_g.v").alias(key), "chunk", "ids", "n_ids")


def _id_chunk(chunk: int) -> Column:
    big = F.floor(F.col("geonameid") / F.lit(chunk)).cast("long")
    return F.when(F.col("n_ids") <= chunk, F.lit(0).cast("long")).otherwise(F.coalesce(big, F.lit(0).cast("long")))


def group_has(df: DataFrame, keys: Sequence[str], code: str, col: str = "feature_code") -> DataFrame:
    """Per group, whether any row has ``col = code``."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(col) == code), F.lit(False)).alias("has_code"))


def _group_key(key: str) -> Column:
    """Join-safe group key in which null is one value (as pandas' duplicated() treats NaN)."""
    return F.struct(F.col(key).isNull().alias("isnull"), F.col(key).alias("v"))


def duplicate_flag(df: DataFrame, key: str = "name", order: str = "geonameid", out: str = "is_duplicate",
                   expand_chunk: int = 1_000_000) -> DataFrame:
    """Flag the second and later occurrence of each ``key`` in ``order``.

    The first occurrence is the row with the smallest ``(order, whole row)`` (null
    ``order`` last); every other row is flagged. A fixed-width minimum of ``order`` per key
    (hash aggregate) decides all rows but those that hold it, about one per key; only among
    these are whole rows compared. Byte-identical copies of a first row cannot be told
    apart, so they are collapsed to one row and a count and re-expanded as one
    unflagged row plus ``count - 1`` flagged ones, in chunks of ``expand_chunk``
    spread over tasks: a group of copies holding a third of the table is neither
    sorted nor generated inside one task. Deterministic under recomputation.
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    keyed = df.withColumn("_g", _group_key(key))
    lowest = keyed.groupBy("_g").agg(F.min(order).alias("_low"))
    j = join_small(keyed, lowest, "_g", "left")
    holds = F.col(order).eqNullSafe(F.col("_low"))
    later = j.filter(~holds).select(*cols, F.lit(True).alias(out))
    # rows that hold their key's minimum, equal ones counted: a hash aggregate over whole rows
    held = materialize(j.filter(holds).groupBy("_g", *cols).agg(F.count(F.lit(1)).alias("_n")))
    first = held.groupBy("_g").agg(F.min(row).alias("_first"))
    head = F.col("_first").eqNullSafe(row)
    held = held.join(first, "_g")
    keep = held.filter(head).select(*cols, F.lit(False).alias(out))
    extra = held.withColumn("_n", F.when(head, F.col("_n") - 1).otherwise(F.col("_n"))).filter(F.col("_n") > 0) \
        .select("_g", *cols, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / F.lit(expand_chunk))))
                .alias("_c"), "_n")
    extra = extra.repartition("_g", "_c").select(
        *cols, F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(expand_chunk).cast("long"),
                                                               F.col("_n") - F.col("_c") * expand_chunk))).alias("_i"))
    return later.unionByName(keep).unionByName(extra.select(*cols, F.lit(True).alias(out)))


def duplicate_rows(df: DataFrame, key: str = "name") -> DataFrame:
    """Every row whose ``key`` occurs more than once."""
    cols = df.columns
    g = df.withColumn("_g", _group_key(key))
    dup = g.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_g")
    return join_small(g, dup, "_g", "left_semi").select(*cols)


def duplicate_ids(df: DataFrame, key: str = "name", chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """W3 rows with the ids of their duplicate group: ``n_ids``, ``chunk`` and the ``ids`` of
    the chunk that the row's own id is in. For a group of at most ``chunk`` rows these are all
    its ids; the other chunks of a larger group are in ``ids_by_name``, not repeated on each of
    its rows, which would grow with the square of the group."""
    cols = df.columns
    g = df.withColumn("_g", _group_key(key))
    lists = ids_by_name(df, key, chunk).where(F.col("n_ids") > 1) \
        .select(_group_key(key).alias("_g"), "chunk", "ids", "n_ids")
    sizes = lists.groupBy("_g").agg(F.max("n_ids").alias("n_ids"))
    rows = join_small(g, sizes, "_g", "inner").withColumn("chunk", _id_chunk(chunk))
    return join_small(rows.drop("n_ids"), lists, ["_g", "chunk"], "inner").select(*cols, "n_ids", "chunk", "ids")


def admin_dedupe(df: DataFrame, keep_null_admin: bool = False) -> DataFrame:
    """Admin-hierarchy clean-up of class-P places.

    Drop PPLH/PPLX; within each admin2 area keep only PPLA rows if it has any, else
    only PPLC rows if it has any, else all; then within each admin3 area keep only
    PPLA2 rows if it has any, else all. Rows with a null admin2 (step 1) or admin3
    (step 2) drop, as grouping does in the source, unless ``keep_null_admin``.
    """
    cols = df.columns
    code = F.col("feature_code")
    p = df.filter((F.col("feature_class") == "P") & ~F.coalesce(code.isin("PPLH", "PPLX"), F.lit(False)))

    if not keep_null_admin:  # these rows drop anyway: keep them out of the shuffle
        p = p.filter(F.col("admin2_code").isNotNull())
    g2 = (p.filter(F.col("admin2_code").isNotNull()).groupBy("admin2_code")
          .agg(F.bool_or(code == "PPLA").alias("_has_a"), F.bool_or(code == "PPLC").alias("_has_c")))
    s1 = join_small(p, g2, "admin2_code", "left", null_spread=True)
    has_a, has_c = F.coalesce(F.col("_has_a"), F.lit(False)), F.coalesce(F.col("_has_c"), F.lit(False))
    keep1 = F.when(has_a, code == "PPLA").when(has_c, code == "PPLC").otherwise(F.lit(True))
    null2 = F.col("admin2_code").isNull()
    s1 = s1.filter(F.coalesce(keep1, F.lit(False)) & (F.lit(keep_null_admin) | ~null2)).select(*cols)

    if not keep_null_admin:
        s1 = s1.filter(F.col("admin3_code").isNotNull())
    g3 = (s1.filter(F.col("admin3_code").isNotNull()).groupBy("admin3_code")
          .agg(F.bool_or(code == "PPLA2").alias("_has_a2")))
    s2 = join_small(s1, g3, "admin3_code", "left", null_spread=True)
    has_a2 = F.coalesce(F.col("_has_a2"), F.lit(False))
    keep2 = F.when(has_a2, code == "PPLA2").otherwise(F.lit(True))
    null3 = F.col("admin3_code").isNull()
    return s2.filter(F.coalesce(keep2, F.lit(False)) & (F.lit(keep_null_admin) | ~null3)).select(*cols)


def head_n(df: DataFrame, n: int = 20, code: str = "PPLA", cols: Sequence[str] = ("name", "population"),
           order: str = "geonameid") -> DataFrame:
    """the first ``n`` rows (by id) of a feature code; a top-k, planned as a
    per-partition take-ordered plus a final merge."""
    return df.filter(F.col("feature_code") == code).orderBy(order).limit(n).select(*cols)
