"""Sharding (operator 4): sampled splitters, DataFrame functions only.

Law ``bytes``: the shards' sizes differ by no more than about one row. Rows are ordered by
(hash of the text, hash of the id, id, size), so equal texts lie together, in one shard or
in neighbours, however many they are. Keys are drawn in proportion to the rows' sizes, their
quantiles split the order into ranges, and a range of over twice the mean size is sampled
again and subdivided. Each range is numbered by itself; its rows' places in the whole order
follow from the ranges' exact totals, and a shard is an equal part of the bytes there.

Only samples and the totals of the ranges reach the driver; both are bounded by the number
of ranges, not by the rows. Rows that are alike in id and text are one row with a count until
they are numbered.

Null and empty texts have size 1 and checksum 0. Repeated rows get a slot each. Rows without
an id are dealt like others. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpull.llm.common import stage, text_or_empty

SHARDS = 8
SAMPLES = 32      # keys drawn per range
ROUNDS = 4        # times that overfull ranges are subdivided at most
KEY = ("h", "g")


def _range_of(splitters: list[tuple[int, int]], spark) -> tuple[DataFrame, Column, int]:
    """A small table to join on ``prefix``, the number of a row's range after that join, and
    the bits of the prefix. The table has at most four times as many rows as splitters."""
    bits = max(1, (len(splitters) + 1).bit_length())
    rows, at = [], 0
    for prefix in range(-(1 << (bits - 1)), 1 << (bits - 1)):
        here = []
        base = at
        while at < len(splitters) and splitters[at][0] >> (64 - bits) == prefix:
            here.append(splitters[at])
            at += 1
        rows.append((prefix, base, here))
    table = spark.createDataFrame(rows, "prefix long, base int, here array<struct<h:long,g:long>>")
    behind = F.filter("here", lambda s: (s.h < F.col("h")) | ((s.h == F.col("h")) & (s.g <= F.col("g"))))
    return table, F.col("base") + F.size(behind), bits


def _with_range(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    table, number, bits = _range_of(splitters, rows.sparkSession)
    return rows.withColumn("prefix", F.shiftright("h", 64 - bits)) \
        .join(F.broadcast(table), "prefix").withColumn("range", number).drop("prefix", "base", "here")


def _draw(rows: DataFrame, step: float, seed: int) -> list[tuple[int, int, float]]:
    """(h, g, weight) of keys drawn with probability size / ``step``, sorted."""
    bytes_ = F.col("size") * F.col("copies")
    u = F.xxhash64(*KEY, F.lit(seed)).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    drawn = rows.where(u * step < bytes_).select(*KEY, F.greatest(bytes_.cast("double"), F.lit(step)).alias("w")).collect()
    return sorted((r.h, r.g, r.w) for r in drawn)


def _quantiles(drawn: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    total, at, out = sum(w for _, _, w in drawn), 0.0, []
    for h, g, w in drawn:
        if at > 0 and int(at * parts / total) != int((at + w) * parts / total):
            out.append((h, g))
        at += w
    return out


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``."""
    spark = docs.sparkSession
    ranges = ranges or max(8 * shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
                       F.xxhash64(text).alias("h"), F.xxhash64("doc_id").alias("g"))
    rows = stage(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "sharding-rows")
    total = rows.agg(F.sum(F.col("size") * F.col("copies")).alias("n")).first()["n"] or 0
    splitters: list[tuple[int, int]] = []
    share = max(1.0, total / ranges)
    if total:
        splitters = sorted(set(_quantiles(_draw(rows, max(1.0, share / SAMPLES), 0), ranges)))
    for attempt in range(1, ROUNDS + 1):
        dealt = _with_range(rows, splitters)
        totals = {r["range"]: (r["bytes"], r["rows"], r["keys"]) for r in dealt.groupBy("range").agg(
            F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"),
            F.count("*").alias("keys")).collect()}
        over = {k: v[0] for k, v in totals.items() if v[0] > 2 * share and v[2] > 1}
        if not over or attempt == ROUNDS:
            break
        inside = dealt.where(F.col("range").isin(sorted(over)))
        more = _quantiles(_draw(inside, max(1.0, share / SAMPLES / 4), attempt), -(-2 * sum(over.values()) // int(share)))
        if set(more) <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    before, at = [], (0, 0)
    for k in sorted(totals):
        before.append((k, *at))
        at = (at[0] + totals[k][0], at[1] + totals[k][1])
    before = spark.createDataFrame(before, "range int, bytes_before long, rows_before long")
    earlier = Window.partitionBy("range").orderBy(*KEY, F.col("doc_id"), "size", "text_crc32") \
        .rowsBetween(Window.unboundedPreceding, -1)
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    placed = dealt.withColumn("b", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(earlier), F.lit(0))) \
        .withColumn("r", F.coalesce(F.sum("copies").over(earlier), F.lit(0))) \
        .join(F.broadcast(before), "range") \
        .select("doc_id", "size", "text_crc32", (F.col("b") + F.col("bytes_before")).alias("b"),
                (F.col("r") + F.col("rows_before")).alias("r"), copy)
    middle = 2 * (F.col("b") + F.col("copy") * F.col("size")) + F.col("size")
    shard_no = F.least(F.floor(middle * shards / F.lit(float(2 * max(total, 1)))), F.lit(shards - 1)).cast("int")
    placed = stage(placed.select("doc_id", "size", "text_crc32", shard_no.alias("shard"),
                                 (F.col("r") + F.col("copy")).alias("place")), "sharding-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))   # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
