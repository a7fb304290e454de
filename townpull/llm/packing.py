"""Packing (operator 2): cutting-stock column generation.

Each document's ids (with the end id) are cut into full sequences and one remainder.
Remainders fall into length classes of ``width`` ids. Over the histogram of the classes a
linear program chooses patterns (how many pieces of each class share a sequence): a
knapsack dynamic program prices new patterns with the dual values until none improves. The
counts of patterns are rounded down, what remains of the histogram is packed first-fit from
the longest, and the ranked pieces of each class are dealt to the patterns' places. The
histogram and the patterns are bounded by the number of classes, whatever the input; pieces
are ranked, placed and given offsets by Spark.

Null and empty texts are one end id. Repeated rows are packed each. A null doc_id stays
null. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from townpull.llm.common import stage, text_or_empty, tokenizer_path
from townpull.llm.wordids import crc, word_ids

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 1
WIDTH = 8            # ids per length class
MAX_COLUMNS = 3000   # patterns priced at most; fewer only cost padding


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and a number ``uid`` of every piece."""
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = word_ids(tokenizer_path(vocabulary, folder))
        end = end_id.to_bytes(4, "little")
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            of, start, length, total, sums = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                view = memoryview(ids)
                for at in range(0, n, capacity):
                    of.append(i)
                    start.append(at)
                    length.append(min(capacity, n - at))
                    total.append(n)
                    sums.append(crc(view[4 * at:4 * (at + capacity)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(of, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, sums, total)),
                 pa.array(np.arange(uid, uid + len(of)))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "uid"])
            uid += len(of)

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, uid long")


def best_pattern(values, sizes, room: int):
    """Unbounded knapsack: the counts of each size that fill at most ``room`` at most value."""
    import numpy as np
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        fits = sizes[:np.searchsorted(sizes, c, "right")]   # sizes ascend
        best[c], took[c] = best[c - 1], -1
        if len(fits):
            with_each = best[c - fits] + values[:len(fits)]
            k = int(with_each.argmax())
            if with_each[k] > best[c] + 1e-12:
                best[c], took[c] = with_each[k], k
    counts, c = np.zeros(len(sizes)), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= int(sizes[took[c]])
    return best[room], counts


def solve_patterns(demand: dict[int, int], room: int, max_columns: int = MAX_COLUMNS) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) with pattern: size -> pieces, that cover ``demand`` (size -> pieces) exactly."""
    import numpy as np
    sizes = np.array(sorted(s for s, n in demand.items() if n), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(s)] for s in sizes], float)
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))   # a column per pattern
    inverse = np.diag(1 / np.diag(basis))
    x = inverse @ need
    for _ in range(max_columns):
        value, column = best_pattern(np.maximum(inverse.sum(axis=0), 0), sizes, room)
        if value <= 1 + 1e-7:
            break
        u = inverse @ column
        ratio = np.full(m, np.inf)
        np.divide(x, u, out=ratio, where=u > 1e-9)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break
        x = x - max(ratio[r], 0) * u
        x[r] = max(ratio[r], 0)
        inverse[r] /= u[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(u[others], inverse[r])
        basis[:, r] = column
    times = np.floor(np.maximum(x, 0) + 1e-6).astype(np.int64)
    columns = basis.round().astype(np.int64)
    out, left = [], need.astype(np.int64)
    for j in np.argsort(-columns.T @ sizes, kind="stable"):   # the fullest first; never above the demand
        has = columns[:, j] > 0
        n = min(int(times[j]), int((left[has] // columns[has, j]).min()))
        if n:
            left = left - n * columns[:, j]
            out.append(({int(s): int(c) for s, c in zip(sizes[has], columns[has, j])}, n))
    open_bins: list[list] = []   # [free, pattern]
    for s, n in sorted(zip(sizes.tolist(), left.tolist()), reverse=True):
        per = room // s
        if n > 4 * m * per:   # far more than rounding leaves
            out.append(({s: per}, n // per))
            n %= per
        for _ in range(n):
            b = min((b for b in open_bins if b[0] >= s), key=lambda b: b[0], default=None)
            if b is None:
                open_bins.append(b := [room, {}])
            b[0] -= s
            b[1][s] = b[1].get(s, 0) + 1
    out += [(p, 1) for _, p in open_bins]
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> tuple[list[tuple], int]:
    """Rows (class, lo, hi, per, base): the pieces of ranks lo to hi of a class lie in the
    sequences from base on, ``per`` in each; and the number of sequences."""
    rows, taken, base = [], {}, 0
    for pattern, times in patterns:
        for s, per in pattern.items():
            lo = taken.get(s, 0)
            taken[s] = lo + per * times
            rows.append((s, lo, taken[s], per, base))
        base += times
    return rows, base


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY,
         folder: str | None = None, width: int = WIDTH) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their sequence_id and offset there."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, capacity, end_id, vocabulary, folder), "packing-pieces")
    size = F.ceil(F.col("length") / F.lit(width)).cast("int")
    full = -(-capacity // width)
    lots = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.withColumn("class", F.when(F.col("length") == capacity, F.lit(full + 1)).otherwise(size)) \
        .withColumn("lot", F.pmod(F.xxhash64("uid"), F.lit(lots)))
    counts = cut.groupBy("class", "lot").count()
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("count").alias("n")).collect()}
    whole = histogram.pop(full + 1, 0)
    rows, sequences = places(solve_patterns(histogram, capacity // width))
    if whole:
        rows.append((full + 1, 0, whole, 1, sequences))
    place = spark.createDataFrame(rows, "class int, lo long, hi long, per long, base long")
    before = Window.partitionBy("class").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("class", "lot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("class", "lot").orderBy(F.desc("length"), "uid")
    ranked = cut.withColumn("r", F.row_number().over(within) - 1).join(first, ["class", "lot"]) \
        .withColumn("rank", F.col("first") + F.col("r"))
    dealt = ranked.join(F.broadcast(place), "class").where("rank >= lo and rank < hi") \
        .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "uid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                        F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long").alias("offset"))
