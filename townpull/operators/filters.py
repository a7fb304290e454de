"""Row filters and projections.

All are narrow transformations: Catalyst pushes the comparisons into the scan
where the source supports it and nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.schema import POPULATED_CODES


def filter_populated_places(df: DataFrame, codes: Sequence[str] = POPULATED_CODES) -> DataFrame:
    """B1: keep rows whose feature_code is a populated-place code; null codes drop."""
    return df.filter(F.col("feature_code").isin(list(codes)))


def filter_population(df: DataFrame, mode: str = "positive") -> DataFrame:
    """B2: ``population = 0`` (``mode="zero"``) or ``population > 0`` (``"positive"``)."""
    if mode == "zero":
        return df.filter(F.col("population") == 0)
    if mode == "positive":
        return df.filter(F.col("population") > 0)
    raise ValueError("mode must be 'zero' or 'positive'")


def filter_feature(df: DataFrame, class_: str | None = None, code: str | None = None) -> DataFrame:
    """Equality on feature_class and/or feature_code."""
    cond = F.lit(True)
    if class_ is not None:
        cond = cond & (F.col("feature_class") == class_)
    if code is not None:
        cond = cond & (F.col("feature_code") == code)
    return df.filter(cond)


def filter_populated_code(df: DataFrame, code: str) -> DataFrame:
    """``feature_code = code AND population > 0``."""
    return df.filter((F.col("feature_code") == code) & (F.col("population") > 0))


def filter_name(df: DataFrame, name: str, col: str = "asciiname") -> DataFrame:
    """Exact name lookup."""
    return df.filter(F.col(col) == name)


def filter_codes(df: DataFrame, codes: Sequence[str], negate: bool = False,
                 col: str = "feature_code") -> DataFrame:
    """Codes in a list, or (``negate``) not in it; NOT IN keeps null codes."""
    member = F.col(col).isin(list(codes))
    return df.filter(~F.coalesce(member, F.lit(False)) if negate else member)


def split_metros(df: DataFrame, flag: str = "isMetro") -> tuple[DataFrame, DataFrame]:
    """(metros, towns) on a complete boolean flag."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))


def filter_assigned(df: DataFrame) -> DataFrame:
    """Metros and towns that have an assigned metro."""
    return df.filter(F.col("isMetro") | F.col("assigned_metro_id").isNotNull())


def has_polygons(col: str = "polygons") -> Column:
    return F.coalesce(F.size(F.col(col)) > 0, F.lit(False))


def split_boundaries(df: DataFrame, col: str = "polygons") -> tuple[DataFrame, DataFrame]:
    """(rows with at least one ring, rows without). ``[]`` counts as without."""
    return df.filter(has_polygons(col)), df.filter(~has_polygons(col))


def project_columns(df: DataFrame, keep: Sequence[str] | None = None,
                    drop: Sequence[str] | None = None) -> DataFrame:
    """Keep and/or drop columns."""
    out = df.select(*keep) if keep else df
    return out.drop(*drop) if drop else out


def rename_headers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional names for a headerless frame."""
    return df.toDF(*names)
