"""Toxicity (operator 9): a linear classifier over character n-grams scaled by naive-Bayes
log-count ratios.

A text's features are the hashes of the n-grams of its lower-cased UTF-8 bytes that occur at
all (4 and 5 bytes, a blank put before and behind). Over the training rows each feature gets
the log ratio of its smoothed share of toxic and of other texts; the ``FEATURES`` that tell
the classes apart best (chi-square) are kept, a feature's value is its ratio, and logistic
regression with an L2 penalty is fitted to them.

The classifier is fitted on at most ``SAMPLE`` labelled rows, the first by a hash of their id
(a documented bound; scoring reads every whole text). Rows whose crc32(doc_id) mod 4 is 2 are
held out and never used for fitting; labels, lang, source and doc_id are never inputs.

Null and empty texts have no features and get the intercept's score. Rows without an id are
scored; labels without an id, or with a null label, are not used; of several labels of an id
the highest counts, and of several texts of an id the first by hash is fitted. Repeated rows are scored each. Without training rows every score is 0;
with one class alone it is that class's share. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import drop_worker_caches, free_name, slices, stage, text_or_empty

GRAMS = (4, 5)
BITS = 22          # of a feature's hash
SAMPLE = 8000      # labelled rows the classifier is fitted on, at most
FEATURES = 4000
LEAST = 5          # training texts that a kept feature is in
PENALTY = 1.0
STEPS = 400
THRESHOLD = 0.3


def grams(text: str, bits: int = BITS):
    """Hashes of all n-grams of a text, repeats included."""
    import numpy as np
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    out = []
    for n in GRAMS:
        m = len(b) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint32)
            for i in range(n):   # FNV-like, then mixed so that the high bits depend on all bytes
                h = (h ^ b[i:m + i]) * np.uint32(16777619)
            h ^= h >> np.uint32(15)
            h *= np.uint32(2246822519)
            h ^= h >> np.uint32(13)
            out.append(h >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    features: list[int]     # hashes, ascending
    weights: list[float]    # ratio times coefficient
    intercept: float
    constant: float | None = None   # the score of all texts where nothing could be fitted


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled rows that are not held out."""
    known = labels.where(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi") \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    # of unlike texts of an id the first by hash
    return texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")) \
        .select("text", "toxic")


def _count_features(rows: DataFrame) -> DataFrame:
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        drop_worker_caches()
        n = np.zeros((2, 1 << BITS), np.int32)
        for b in (some for batch in batches for some in slices(batch)):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[label, np.unique(grams(text))] += 1
        f = np.nonzero(n.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int32)), pa.array(n[1, f]), pa.array(n[0, f])],
                                         ["f", "toxic", "other"])

    return rows.mapInArrow(count, "f int, toxic int, other int") \
        .groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _kept_features(rows: DataFrame, features) -> DataFrame:
    def pick(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        place = np.full(1 << BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        for b in (some for batch in batches for some in slices(batch)):
            have = [place[grams(t)] for t in b.column(0).to_pylist()]
            have = [np.unique(p[p >= 0]).tolist() for p in have]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(have, pa.list_(pa.int32()))], ["toxic", "have"])

    return rows.mapInArrow(pick, "toxic int, have array<int>")


def fit_logistic(have: list[list[int]], toxic, scale, penalty: float = PENALTY, steps: int = STEPS):
    """Coefficients and intercept for rows with the features ``have``, each of value scale[f]."""
    import numpy as np
    y = np.asarray(toxic, float)
    index = np.array([f for h in have for f in h], np.int64)
    row = np.repeat(np.arange(len(have)), [len(h) for h in have])
    value = scale[index]
    w = np.zeros(len(scale) + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):   # Adam on the full sample
        z = np.bincount(row, weights=w[index] * value, minlength=len(y)) + w[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        slope = np.append(np.bincount(index, weights=g[row] * value, minlength=len(scale)) + penalty * w[:-1], g.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w -= 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    import numpy as np
    rows = stage(training_rows(docs, labels, sample).select("text", F.col("toxic").cast("int").alias("toxic")),
                 "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    p, q = sizes.get(1, 0), sizes.get(0, 0)
    if not p or not q:
        return Model([], [], 0.0, p / (p + q) if p + q else 0.0)
    t, o, n = F.col("toxic"), F.col("other"), F.col("toxic") + F.col("other")
    share = p / (p + q)
    chi = F.pow(t - n * share, 2) / (n * share * (1 - share) * (1 - n / (p + q) + 1e-9))
    ratio = F.log((t + 1) / (p + 2)) - F.log((o + 1) / (q + 2))
    best = _count_features(rows).where(n >= LEAST).select("f", chi.alias("chi"), ratio.alias("r")) \
        .orderBy(F.desc("chi"), "f").limit(features).collect()
    best = sorted((r["f"], r["r"]) for r in best)
    names = np.array([f for f, _ in best], np.int64)
    scale = np.array([r for _, r in best])
    got = _kept_features(rows, names).collect()   # at most ``sample`` rows
    got = sorted((r["toxic"], list(r["have"])) for r in got)
    w, intercept = fit_logistic([h for _, h in got], [y for y, _ in got], scale)
    return Model(names.tolist(), (w * scale).tolist(), intercept)


def score(text: Column, model: Model) -> Column:
    """The probability (0 to 1) that a text is toxic."""
    if model.constant is not None:
        return F.lit(float(model.constant))

    def run(batches):
        import numpy as np
        import pandas as pd
        place = np.full(1 << BITS, -1, np.int16)
        place[np.array(model.features, np.int64)] = np.arange(len(model.features), dtype=np.int16)
        w = np.array(model.weights)
        drop_worker_caches()
        for texts in batches:
            z = np.empty(len(texts))
            for i, t in enumerate(texts):
                p = place[grams(t)]
                z[i] = w[np.unique(p[p >= 0])].sum() + model.intercept
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    from collections.abc import Iterator as It

    import pandas as pd
    run.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    return F.pandas_udf(run, "double")(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    return docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold."""
    name = free_name(docs, "toxicity")
    return docs.withColumn(name, score(F.col("text"), model)).where(F.col(name) < threshold).drop(name)
