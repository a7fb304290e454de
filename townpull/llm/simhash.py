"""SimHash near-dedup (operator 1) by multi-index hashing.

Fingerprints are made per text in the scan. Equal fingerprints are one vertex from then
on. To find those at most ``bits`` apart, the 64 bits are cut into segments: if two differ
in at most r = m*q + a bits (m segments, 0 <= a < m), one of the first a + 1 segments
differs in at most q bits or one of the others in at most q - 1. So each fingerprint
enumerates these small Hamming balls, fetches the entries of the segment tables, and
checks the complete distance.

A segment value that more than ``hot`` fingerprints share is not fetched, which would emit
all pairs of a group. Everything that meets such a value is linked over midpoints instead:
two fingerprints differ in at most r bits exactly if some word lies within ceil(r/2) bits of
one and floor(r/2) of the other, so for even r fingerprints in the same ball of radius r/2
around any word are linked, all of them, and a star to the smallest of them says the same
as all pairs. This is linear in the group and exact; no pair is dropped.

Results: a null or empty text has no words and fingerprint zero, linked like any other;
repeated rows are returned each; a null doc_id keeps its fingerprint and counts for no
component's smallest id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import drop_worker_caches, free_name, slices, stage, text_or_empty
from townpull.llm.components import components

SHINGLE = 4       # words a shingle, by the contract
BITS = 4          # largest distance that links, by the contract
SEGMENTS = 3      # more are cheaper to enumerate, fewer give smaller buckets
HOT = 48          # fingerprints with one segment value from which midpoints are used
BLOCK = 1 << 16   # shingles counted at once


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is set if it is in over half the shingles' hashes."""
    import numpy as np
    import xxhash
    words = text.lower().split()   # on bytes: A-Z only, and the ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    starts, ends = starts[:n].tolist(), ends[k - 1:].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        some = slice(at, min(n, at + BLOCK))
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[some], ends[some])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(64) if 2 * int(votes[i]) > n))


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint ``fp`` (signed 64-bit) for ``docs`` (doc_id, text)."""
    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        drop_worker_caches()
        for b in batches:
            fp = np.array([fingerprint(t, k) for some in slices(b) for t in some.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(make, f"doc_id {kind}, fp long")


def _segments(m: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of m segments of 64 bits, as even as can be."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _masks(bits: int, radius: int) -> list[int]:
    """Words of ``bits`` bits of which at most ``radius`` are set."""
    return [sum(1 << i for i in some) for r in range(radius + 1) for some in combinations(range(bits), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_fingerprints(fps: DataFrame, bits: int = BITS, segments: int = SEGMENTS, hot: int = HOT) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fp`` that connect exactly those which a chain
    of distances of at most ``bits`` connects."""
    if bits % 2:
        raise ValueError("an even number of bits is needed for the midpoints")
    q, extra = divmod(bits, segments)
    own, probes = [], []
    for s, (low, n) in enumerate(_segments(segments)):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << n) - 1))
        own.append(F.lit(s << 33).bitwiseOR(value))
        radius = q if s <= extra else q - 1
        if radius >= 0:
            key = F.lit(s << 33).bitwiseOR(value)
            probes += [key.bitwiseXOR(F.lit(x)) if x else key for x in _masks(n, radius)]
    entries = fps.select("fp", F.explode(F.array(*own)).alias("key"))
    full = entries.groupBy("key").count().where(F.col("count") > hot).select("key")
    # an entry of a hot value is one mark without a fingerprint
    table = entries.join(full, "key", "left_anti").select("key", F.col("fp").alias("other")) \
        .unionAll(full.select("key", F.lit(None).cast("long").alias("other")))
    # Spark sizes what an explode gives out as what goes in: without the hint it broadcasts all probes
    met = fps.select("fp", F.explode(F.array(*probes)).alias("key")).hint("merge").join(table, "key") \
        .where(F.col("other").isNull() | ((F.col("other") < F.col("fp")) &
                                          (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= bits))) \
        .select("fp", "other").distinct()
    met = stage(met, "simhash-met")
    masks = [_signed(x) for x in _masks(64, bits // 2)]
    ball = met.where("other is null").select("fp").distinct() \
        .select("fp", F.explode(F.lit(masks)).alias("mask")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))
    least = ball.groupBy("mid").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most").select("mid", "b")
    stars = ball.hint("merge").join(least, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return met.where("other is not null").select(F.col("fp").alias("a"), F.col("other").alias("b")).unionAll(stars)


def simhash_groups(docs: DataFrame, k: int = SHINGLE, bits: int = BITS, segments: int = SEGMENTS,
                   hot: int = HOT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id."""
    rows = stage(fingerprints(docs, k), "simhash-fp")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    parts = components(link_fingerprints(distinct.select("fp"), bits, segments, hot))
    linked = parts.join(distinct, parts.v == distinct.fp).select("v", "root", "first")
    smallest = linked.groupBy("root").agg(F.min("first").alias("c"))
    linked = linked.join(smallest, "root").select(F.col("v").alias("fp"), "c")
    ids = distinct.join(linked, "fp", "left").select("fp", F.coalesce("c", "first").alias("component_id"))
    # read anew, so that the join below deals out both sides and a hot fingerprint can be split
    ids = stage(ids, "simhash-ids")
    return rows.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                       "component_id")


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Of each group the text that is first by (doc_id, hash of the text), once; rows without an id stay.

    Unlike texts that share an id are judged each by its own group, so all of them may stay. Of rows
    alike in id and text one does."""
    key, n = free_name(docs, "text_key"), free_name(docs, "rows")
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(text_or_empty()).alias("text_key")))
    groups = stage(simhash_groups(docs.select(row.alias("doc_id"), "text"), k, bits).select("doc_id", "component_id"), "simhash-groups")
    first = groups.where("doc_id = component_id").groupBy("doc_id").count() \
        .select("doc_id.doc_id", F.col("doc_id.text_key").alias(key), F.col("count").alias(n))
    first = stage(first, "simhash-first")
    kept = docs.where("doc_id is not null").withColumn(key, F.xxhash64(text_or_empty())).join(first, ["doc_id", key])
    again = kept.where(F.col(n) > 1).dropDuplicates(["doc_id", key])
    return docs.where("doc_id is null").unionAll(kept.where(F.col(n) == 1).select(*docs.columns)) \
        .unionAll(again.select(*docs.columns))
