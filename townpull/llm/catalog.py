"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from townpull.llm.common import table
from townpull.llm.decontamination import leaks
from townpull.llm.packing import pack
from townpull.llm import toxicity, url_filter
from townpull.llm import centroids, line_dedup, phrases
from townpull.llm.ann import nearest
from townpull.llm.sharding import shard
from townpull.llm.simhash import simhash_groups
from townpull.llm.substring_dedup import repeated_spans
from townpull.llm.token_binary import token_file_index
from townpull.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash_groups(table(spark, sf_dir, "documents"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text."""
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, written in coded files and read back."""
    return token_file_index(table(spark, sf_dir, "documents"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal size."""
    return shard(table(spark, sf_dir, "documents"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    outcomes = url_filter.label_outcomes(table(spark, sf_dir, "labels"))
    return url_filter.judge(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_filter"] = url_filter.oracle_sql()


@query
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs and passages of all documents, with the document that keeps them."""
    return repeated_spans(table(spark, sf_dir, "documents"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds of k-means."""
    return centroids.clusters(table(spark, sf_dir, "embeddings")).drop("evaluated")


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of two to four words of every lang."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every whole text."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


ORACLE["op11_centroid_clustering"] = centroids.oracle_sql()
ORACLE["op12_phrase_mining"] = phrases.oracle_sql()
ORACLE["op13_line_dedup"] = line_dedup.oracle_sql()
