"""Size-checked broadcast and lineage cutting.

A side is broadcast only after its rows and bytes have been measured against bounds;
beyond either the join stays a shuffle join, where AQE splits skewed partitions.
Measuring runs a job, so the measured side is first written to the shared
checkpoint folder (reliable checkpoint) and read back by the join: it is computed
once and survives executor loss. The measure is one aggregate over the stored copy
(partial counts per task), never a limit through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townpull.session import checkpoint_root

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20
FIXED_WIDTH = 8   # bytes counted for a number, date or flag


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` takes: text by its length, nested values by their
    JSON text, everything else by a fixed width."""
    fixed, parts = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            parts.append(F.octet_length(F.col(f"`{f.name}`")))
        elif isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType):
            parts.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
        else:
            fixed += FIXED_WIDTH
    return sum((F.coalesce(p.cast("long"), F.lit(0)) for p in parts), F.lit(fixed).cast("long"))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one aggregate."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def broadcast_if_bounded(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                         checkpoint: bool = True, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(side, is_broadcast)``: the side hinted for broadcast only if it has
    at most ``max_rows`` rows and about ``max_bytes`` bytes."""
    side = materialize(small) if checkpoint else small
    rows, size = measure(side)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(side), True
    return side, False


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_BROADCAST_ROWS, null_spread: bool = False,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Many-to-one join of a large table with a derived lookup table.

    Broadcast when the lookup is proven small, otherwise a shuffle join (AQE
    skew-join handling splits hot keys of the large side). With ``null_spread`` (for
    joins in which a null key part never matches), the shuffle path joins on a key
    that gives such rows non-matching values made from the row itself, so they do not
    all hash to one partition and land in the same one when a task is run again; the
    broadcast path keeps the plain keys.
    """
    side, is_bc = broadcast_if_bounded(small, max_rows, max_bytes=max_bytes)
    keys = [on] if isinstance(on, str) else list(on)
    if is_bc or not null_spread:
        return big.join(side, keys, how)
    jk, key = spread_key(keys, big)
    right = side.dropna(subset=keys)   # a null key part never matches
    right = right.withColumn(jk[0], spread_key(keys, right)[1]).drop(*keys)
    return big.withColumn(jk[0], key).join(right, jk, how).drop(*jk)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (maps, which cannot be hashed, left out)."""
    return F.xxhash64(F.lit(7), *[F.col(f"`{f.name}`") for f in df.schema.fields
                                  if "map<" not in f.dataType.simpleString()])


def spread_key(cols: list[str], df: DataFrame, name: str = "_jk") -> tuple[list[str], Column]:
    """A single string join key over ``cols`` for a left join in which a null part
    never matches. Rows with a null part get a key from the hash of the row, which
    matches nothing, so in a shuffle join they spread over all partitions instead of
    hashing together (a column that is null on a third of the rows would otherwise make
    one hot task). Returns ``([name], column)``; apply the same call to both sides."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    key = F.when(any_null, F.concat(F.lit("\u0001"), row_hash(df).cast("string"))) \
        .otherwise(F.concat_ws("\u0000", *[F.col(c).cast("string") for c in cols]))
    return [name], key.alias(name)
