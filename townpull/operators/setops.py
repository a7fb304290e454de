"""Sort and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by_id(df: DataFrame, key: str = "geonameid", numeric: bool = True) -> DataFrame:
    """ascending id (range-partitioned global sort). ``numeric=False`` sorts the
    id as text, as the pandas path does with string ids."""
    return df.orderBy(F.col(key) if numeric else F.col(key).cast("string"))


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """union by column name; columns missing on one side become null."""
    return a.unionByName(b, allowMissingColumns=True)


def concat_all(*dfs: DataFrame) -> DataFrame:
    """bag union of any number of frames (by name, missing columns null)."""
    return reduce(union_missing, dfs)


def recombine(rest: DataFrame, enriched: DataFrame) -> DataFrame:
    """Rows not enriched plus the enriched rows."""
    return union_missing(rest, enriched)


def distinct(df: DataFrame) -> DataFrame:
    """F5."""
    return df.distinct()
