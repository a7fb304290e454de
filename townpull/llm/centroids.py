"""Centroid clustering (operator 11): k-means with ns-bounds.

Each vector keeps, for every centroid, the distance at which it was last evaluated and the round
of that evaluation. Centroids of all rounds are retained, so a stored distance is loosened by how
far the centroid has come since then as the crow flies (the norm of the total displacement), which
is never more than the sum of its drifts round by round. A vector whose own distance, loosened
upwards, is below all others, loosened downwards, stays where it is without any evaluation. If that
fails its own distance is evaluated, then only the centroids whose bound is not above it; ties and
rounding fall to the exact side, so that the result is that of the full scan.

Vectors are integers and all that is returned comes from exact integer arithmetic; bounds are
floating-point numbers with a margin. A round is one pass over the stored vectors without a shuffle,
and one sum per centroid; state and vectors are written together, to the shared folder, so that a lost
executor costs tasks. To the driver come only centroids and their sums (``k`` x dimensions).

Vectors that are null, of another length, or that hold null or non-finite components take no part;
nor do those with a component beyond +-``RANGE`` after scaling, whose distances would not fit 64 bits.
Repeated rows are vectors of their own. Rows without an id are clustered but never start a
centroid. Of vectors with one id the one that is first by its components starts the earlier centroid.
With fewer vectors than ``k`` there are as many centroids as vectors with an id; without centroids, as
in an empty table, the result is empty. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpull.llm.common import stage

K = 16
DIM = 64
SCALE = 64
ROUNDS = 3
SEED = 1
RANGE = 1 << 27
MARGIN = 1e-9       # of a bound, relative, for rounding


def clean_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<int>: floor(scale * component)) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    # a null component makes its comparison null, and so the vector's
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c) <= F.lit(RANGE / scale), F.lit(False)))
    return vectors.where(F.size("embedding") == dim).where(fits) \
        .select("vec_id", F.transform(v, lambda c: F.floor(c * scale).cast("int")).alias("x"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").orderBy(key, "x").limit(k).select("x").collect()   # k rows
    return [list(r["x"]) for r in first]


def displacements(history: list):
    """rounds x k: how far each centroid of the last round is from where it was in each round."""
    import numpy as np
    now = history[-1]
    return np.sqrt(np.array([((now - c).astype(np.float64) ** 2).sum(axis=1) for c in history]))


def distances(x, c):
    """Exact squared distances of the vectors x to the vectors c (pairwise, or to one)."""
    d = x - c
    return (d * d).sum(axis=-1)


def reassign(x, own, seen, when, history: list):
    """Nearest centroids of the last round for the vectors x (int64, n x dim), as (own, seen, when, evaluations).

    own: centroid of each vector; seen (n x k): distances as last evaluated; when (n x k): the
    round of that evaluation, -1 for none yet. The arrays are changed in place."""
    import numpy as np
    now, last = history[-1], len(history) - 1
    n, k = seen.shape
    moved = displacements(history)
    column = np.arange(k)
    some = np.arange(n)
    drift = moved[when, column]
    below = np.where(when < 0, 0.0, (seen - drift) * (1 - MARGIN) - MARGIN)
    above = np.where(when < 0, np.inf, (seen + drift) * (1 + MARGIN) + MARGIN)[some, own]
    below[some, own] = np.inf
    fails = np.nonzero(below.min(axis=1, initial=np.inf) <= above)[0]
    count = np.zeros(n, np.int32)
    if len(fails):
        # their own centroid first, which may settle it
        mine = distances(x[fails], now[own[fails]])
        seen[fails, own[fails]], when[fails, own[fails]] = np.sqrt(mine), last
        count[fails] += 1
        best, place = mine.copy(), own[fails].copy()
        tight = np.sqrt(mine) * (1 + MARGIN) + MARGIN
        for j in range(k):
            ask = np.nonzero(below[fails, j] <= tight)[0]
            if not len(ask):
                continue
            rows = fails[ask]
            d = distances(x[rows], now[j])
            seen[rows, j], when[rows, j] = np.sqrt(d), last
            count[rows] += 1
            nearer = (d < best[ask]) | ((d == best[ask]) & (j < place[ask]))
            best[ask[nearer]], place[ask[nearer]] = d[nearer], j
        own[fails] = place
    return own, seen, when, count


def _pass(state: DataFrame, history: list, k: int, label: str) -> DataFrame:
    """Write the state after one more assignment to the last centroids of ``history``."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def matrix(column, kind):
            return np.frombuffer(b"".join(column.to_pylist()), kind)

        def packed(a):
            return pa.array([r.tobytes() for r in a], pa.binary())

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = matrix(b.column("x"), "<i4").reshape(n, -1)
            own, seen, when, count = reassign(
                x.astype(np.int64), b.column("cluster").to_numpy().copy(),
                matrix(b.column("seen"), "<f8").reshape(n, k).copy(), matrix(b.column("at"), "i1").reshape(n, k).copy(), history)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("x"), pa.array(own, pa.int32()), packed(seen), packed(when),
                 pa.array(count + b.column("evaluated").to_numpy())],
                ["vec_id", "x", "cluster", "seen", "at", "evaluated"])

    return stage(state.mapInArrow(run, state.schema), label)


def _sums(state: DataFrame) -> list:
    """[(cluster, members, sums per component)], exact."""
    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        n, total = {}, {}
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("x").to_pylist()), "<i4").reshape(b.num_rows, -1)
            own = b.column("cluster").to_numpy()
            for j in np.unique(own).tolist():
                rows = x[own == j]
                n[j] = n.get(j, 0) + len(rows)
                total[j] = total.get(j, 0) + rows.sum(axis=0, dtype=np.int64)
        names = sorted(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), pa.array([n[j] for j in names], pa.int64()),
             pa.array([total[j].tolist() for j in names], pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = state.select("cluster", "x").mapInArrow(add, "cluster int, n long, total array<long>")
    sums = parts.select("cluster", "n", F.posexplode("total").alias("place", "s")).groupBy("cluster", "place") \
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()   # k x dimensions
    out = {}
    for r in sums:
        out.setdefault(r["cluster"], (r["n"], {}))[1][r["place"]] = int(r["s"])
    return [(j, n, [s[i] for i in range(len(s))]) for j, (n, s) in sorted(out.items())]


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE):
    """(state after the last assignment, centroids): vec_id, x (packed 32-bit), cluster, evaluated; None
    and [] where there is nothing to cluster."""
    import numpy as np
    rows = stage(clean_vectors(vectors, dim, scale), "centroid-vectors")
    start = first_centroids(rows, k, seed)
    if not start:
        return None, []
    k = len(start)

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            n = b.num_rows
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(n, -1) if n else []
            blank = [np.zeros(k, "<f8").tobytes()] * n, [np.full(k, -1, np.int8).tobytes()] * n
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(np.zeros(n, np.int32)),
                 *(pa.array(c, pa.binary()) for c in blank), pa.array(np.zeros(n, np.int32))],
                ["vec_id", "x", "cluster", "seen", "at", "evaluated"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    state = rows.mapInArrow(pack, f"vec_id {kind}, x binary, cluster int, seen binary, at binary, evaluated int")
    history = [np.array(start, np.int64)]
    for number in range(rounds):
        state = _pass(state, history, k, f"centroid-round{number}")
        now = history[-1].copy()
        for j, n, total in _sums(state):
            now[j] = [s // n for s in total]
        history.append(now)
    return _pass(state, history, k, "centroid-last"), history[-1].tolist()


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, and
    how many distances were evaluated for it in all assignments."""
    spark: SparkSession = vectors.sparkSession
    state, centroids = fit(vectors, k, rounds, seed, dim, scale)
    kind = vectors.select("vec_id").schema[0].dataType.simpleString()
    if state is None:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string, evaluated int")

    def measure(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        c = np.array(centroids, np.int64)
        for b in batches:
            if b.num_rows:
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), "<i4").reshape(b.num_rows, -1).astype(np.int64)
                d = distances(x, c[b.column("cluster").to_numpy()])
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("cluster"), pa.array(d), b.column("evaluated")],
                                                 ["vec_id", "cluster", "distance", "evaluated"])

    rows = state.select("vec_id", "x", "cluster", "evaluated").mapInArrow(measure, f"vec_id {kind}, cluster int, distance long, evaluated int")
    rows = stage(rows, "centroid-distances")
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia")).scalar()
    names = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    named = per.join(spark.createDataFrame(names, "cluster int, centroid_sha256 string"), "cluster")
    return rows.join(F.broadcast(named), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256", "evaluated")


def oracle_sql(k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE) -> str:
    """DuckDB SQL for vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: the full scan."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
near{t} AS (SELECT r, arg_min(j, d * {k} + j) AS j, min(d) AS d FROM (
    SELECT r, c{t}.j AS j, sum((x - c) * (x - c)) AS d FROM parts JOIN c{t} USING (place) GROUP BY r, c{t}.j) GROUP BY r)""")
        if t < rounds:
            steps.append(f"""
mean{t} AS (SELECT j, place, ((s - ((s % n) + n) % n) // n) AS m FROM (
    SELECT j, place, sum(x) AS s, count(*) AS n FROM parts JOIN near{t} USING (r) GROUP BY j, place)),
c{t + 1} AS (SELECT j, place, coalesce(m, c) AS c FROM c{t} LEFT JOIN mean{t} USING (j, place))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: floor({scale} * v::DOUBLE)::HUGEINT) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v)
    AND abs(v::DOUBLE) <= {RANGE / scale})) = {dim}),
parts AS (SELECT r, unnest(x) AS x, unnest(range(1, {dim + 1})) AS place FROM kept),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), x) - 1 AS j FROM kept WHERE vec_id IS NOT NULL
  ORDER BY j LIMIT {k}),
c0 AS (SELECT j, place, x AS c FROM parts JOIN first USING (r)),{','.join(steps)},
digest AS (SELECT j, sha256(string_agg(c::VARCHAR, ',' ORDER BY place)) AS s FROM c{rounds} GROUP BY j)
SELECT vec_id, j::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, s AS centroid_sha256
FROM kept JOIN near{rounds} USING (r) JOIN digest USING (j)"""
