"""Approximate nearest neighbours (operator 5): collision-counting hashing.

Every vector is projected on ``PROJECTIONS`` random directions, the same everywhere. The
vectors are dealt into blocks by a hash of their id; in a block each projection is a sorted
array. A query opens a window around its own projection in each array and counts how often
each vector falls in (a collision). The windows grow by ``GROWTH`` a round (virtual rehashing:
only what is new is counted). A vector with collisions in over ``SHARE`` of the arrays is
verified by its exact distance, all of them, without a cap. A query is done in a block when its
k-th distance is below the half width over ``SURE``, where a nearer vector would have been
verified with high probability, or when the windows hold everything.

The stated query set meets all rows in blocks: each (block of vectors, block of queries) is
one group of bounded size; each gives at most k rows a query, and the k best of these remain.

Vectors that are null, zero or hold null or non-finite components take no part, nor do
queries like that. Vectors are compared with those of the same length only. Repeated rows
(same id and vector) count once; two vectors under one id are two candidates. A query is no
candidate of its own, nor is another vector of its id. Rows without an id are no queries, and
as candidates they would have no name: they are left out. Ties go to the smaller id. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from townpull.llm.common import stage

K = 10
PROJECTIONS = 64
SHARE = 0.6        # of the projections that must collide; a window of 0.84 distances does on average
SURE = 1.2         # half width over distance at which a vector is held to be found
GROWTH = 1.25
BLOCK = 8192       # vectors per group
QUERIES = 1024     # queries per group
SEED = 11


def directions(dim: int, n: int = PROJECTIONS, seed: int = SEED):
    import numpy as np
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def nearest_in_block(ids, x, query_ids, q, k: int = K):
    """Lists (query number, id, distance) of the nearest found, at most k per query."""
    import numpy as np
    n, dim = x.shape
    a = directions(dim)
    px, pq = x @ a, q @ a
    order = np.argsort(px, axis=0, kind="stable").T.copy()
    ranked = np.take_along_axis(px.T, order, axis=1)
    m = len(order)
    need = int(np.ceil(SHARE * m))
    spread = float(np.sqrt(2 * np.maximum(0, (x * x).sum(axis=1).mean() - (x.mean(axis=0) ** 2).sum()))) or 1e-9
    first = spread / 8
    out = []
    for i in range(len(q)):
        own = ids == query_ids[i]
        counts = np.zeros(n, np.int32)
        checked = own.copy()
        best_d, best_id = np.empty(0), np.empty(0, ids.dtype)
        lo = np.array([np.searchsorted(ranked[j], pq[i, j]) for j in range(m)])
        hi = lo.copy()
        half = first
        # before the first round the windows are empty
        while True:
            new = []
            for j in range(m):
                l = int(np.searchsorted(ranked[j], pq[i, j] - half, "left"))
                h = int(np.searchsorted(ranked[j], pq[i, j] + half, "right"))
                l, h = min(l, int(lo[j])), max(h, int(hi[j]))
                if l < lo[j]:
                    new.append(order[j, l:lo[j]])
                if h > hi[j]:
                    new.append(order[j, hi[j]:h])
                lo[j], hi[j] = l, h
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            found = np.nonzero((counts >= need) & ~checked)[0]
            if len(found):
                checked[found] = True
                d = np.concatenate((best_d, np.sqrt(((x[found] - q[i]) ** 2).sum(axis=1))))
                names = np.concatenate((best_id, ids[found]))
                keep = np.lexsort((names, d))[:k]
                best_d, best_id = d[keep], names[keep]
            if len(best_d) == k and best_d[-1] * SURE <= half or bool((hi - lo == n).all()):
                break
            half *= GROWTH
        out += [(i, int(v), float(s)) for v, s in zip(best_id, best_d)]
    return out


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part, each once."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    some = F.exists(v, lambda c: c != 0)
    return vectors.where("vec_id is not null and embedding is not null").where(~odd & some) \
        .select("vec_id", v.alias("v")).dropDuplicates(["vec_id", "v"])


def nearest(vectors: DataFrame, every: int = 100, k: int = K, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id ``every`` divides."""
    rows = stage(clean_vectors(vectors).withColumn("dim", F.size("v")), "ann-vectors")
    asked = rows.where(F.col("vec_id") % every == 0).toDF("q_id", "q_v", "q_dim") \
        .select(F.col("q_id").alias("vec_id"), F.col("q_v").alias("v"), F.col("q_dim").alias("dim"))
    # one row per length of vectors
    sizes = rows.groupBy("dim").agg((F.ceil(F.count("*") / block)).cast("int").alias("blocks"),
                                    F.ceil(F.count(F.when(F.col("vec_id") % every == 0, 1)) / queries).cast("int").alias("lots"))
    sizes = F.broadcast(sizes)
    left = rows.join(sizes, "dim").where("lots > 0") \
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")) \
        .select("dim", "block", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "vec_id", "v")
    right = asked.join(sizes, "dim").withColumn("lot", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("lots")).cast("int")) \
        .select("dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "lot", "vec_id", "v")

    def search(mine, asking):
        import numpy as np
        import pyarrow as pa

        def matrix(t):
            flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return t.column("vec_id").to_numpy(), flat.reshape(t.num_rows, -1).astype(np.float64)

        found = []
        names = np.empty(0, np.int64)
        if mine.num_rows and asking.num_rows:
            ids, x = matrix(mine)
            names, q = matrix(asking)
            found = nearest_in_block(ids, x, names, q, k)
        return pa.table([pa.array([int(names[i]) for i, _, _ in found], pa.int64()), pa.array([v for _, v, _ in found], pa.int64()),
                         pa.array([s for _, _, s in found], pa.float64())], ["query_id", "vec_id", "score"])

    keys = ["dim", "block", "lot"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
