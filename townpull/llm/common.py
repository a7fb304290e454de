"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townpull.session import scratch_path

TOKENIZER_DIR = None  # None: the installed ``public_tokenizers`` package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and continue from the copy.

    This cuts the lineage: the copy survives lost executors and is computed once.
    """
    path = os.path.join(scratch_path(df.sparkSession, label))
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def worker_cache(name: str) -> dict:
    """A dict that outlives a task in a reused Python worker.

    Package code is pickled by value, so module globals are fresh in each task; this one
    sits in ``sys.modules`` and keeps loaded tokenizers and word caches.
    """
    holder = sys.modules.setdefault("_townpull_worker", types.ModuleType("_townpull_worker"))
    return holder.__dict__.setdefault(name, {})


def drop_worker_caches() -> None:
    """Give back what stages before this one keep in the Python worker; called where a stage needs none of it."""
    import pyarrow as pa
    holder = sys.modules.get("_townpull_worker")
    for cache in vars(holder).values() if holder else ():
        if isinstance(cache, dict):
            cache.clear()
    pa.default_memory_pool().release_unused()


def slices(batch, rows: int = 256) -> Iterator:
    """A record batch in pieces of a few rows, so that few texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Where the vocabulary file lies: in ``folder``, or with the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
