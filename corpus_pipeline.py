"""The corpus pipeline: filters and deduplicates ``documents`` and packs what is left.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes each stage's
result as Parquet to the shared checkpoint folder and the next one reads it from there, so
a lost executor costs tasks, not stages. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from townpull.llm import decontamination, packing, simhash, substring_dedup, toxicity
from townpull.llm.common import stage, table


BATCH_ROWS = 1000   # texts that a Python worker gets at a time, at most
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _texts(step):
    """A stage over whole texts: Spark's default of 10,000 rows an Arrow batch is for numbers; texts would fill
    tens of megabytes on either side of each task."""
    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if int(spark.conf.get(BATCH_CONF)) > BATCH_ROWS:
            spark.conf.set(BATCH_CONF, BATCH_ROWS)
        return step(spark, docs, sf_dir)
    return run


@_texts
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (operator 9)."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@_texts
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (operator 1)."""
    return simhash.keep_one_of_each(docs, simhash.SHINGLE, simhash.BITS)


@_texts
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated paragraphs and passages go from all documents but the first (operator 6)."""
    return substring_dedup.without_repeats(docs)


@_texts
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (operator 10)."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@_texts
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 2048 ids (operator 2)."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]

#: The stages cannot be expressed in SQL (a fitted classifier, XXH64 fingerprints, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
