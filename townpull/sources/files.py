"""Sources and sinks for place tables.

Dumps are read with an explicit schema and quoting switched off (a name that starts
with a double quote would otherwise swallow the rest of its row); Spark's own CSV
output is read back with default quoting. Junk numbers and dates become null.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townpull.functions.geo import whole_number
from townpull.operators.sizing import materialize
from townpull.schema import CANDIDATE_TYPE, PLACE_COLUMNS, PLACE_SCHEMA, POLYGONS_TYPE
from townpull.sources import archives as AR

DUMP_OPTIONS = {"sep": "\t", "quote": "", "header": "false", "mode": "PERMISSIVE"}


def scan_places(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = PLACE_SCHEMA) -> DataFrame:
    """A1/A2: headerless tab-separated dump(s) with the fixed 19-field schema.

    ``path`` may be a file, a folder or a glob; uncompressed text splits across tasks.
    """
    return spark.read.schema(schema).options(**DUMP_OPTIONS).csv(path)


scan_all_places = scan_places


def load_lenient(spark: SparkSession, path: str | Sequence[str], null_population: str = "zero") -> DataFrame:
    """A3: every field read as text, then typed leniently: whole numbers may be written as
    ``1500.0`` or ``1e5``; junk coordinates and ids become null (never matched), junk or
    missing population becomes 0 (or null with ``null_population="null"``)."""
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in PLACE_COLUMNS])
    raw = spark.read.schema(text_schema).options(**DUMP_OPTIONS).csv(path)
    out = []
    for f in PLACE_SCHEMA.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(c)
            continue
        typed = whole_number(c, f.dataType.simpleString()) if isinstance(f.dataType, T.IntegralType) \
            else c.try_cast(f.dataType)
        if isinstance(f.dataType, T.FractionalType):
            typed = F.when(~F.isnan(typed) & (F.abs(typed) != float("inf")), typed)
        if f.name == "population" and null_population == "zero":
            typed = F.coalesce(typed, F.lit(0))
        out.append(typed.alias(f.name))
    return raw.select(*out)


def to_dump_lines(df: DataFrame, schema: T.StructType = PLACE_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """Format rows as dump lines (missing columns empty) — the inverse of ``scan_places``;
    ``keep`` columns are passed through (e.g. as output partition columns)."""
    cells = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) if f.name in df.columns else F.lit("")
             for f in schema.fields]
    return df.select(F.concat_ws("\t", *cells).alias("value"), *[F.col(k).alias(f"_{k}") for k in keep])


def write_dump(df: DataFrame, path: str, schema: T.StructType = PLACE_SCHEMA) -> None:
    to_dump_lines(df, schema).write.mode("overwrite").text(path)


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority of the file system that Spark resolves it to."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString()


def _zip_lines_fn(member_suffix: str, batch_rows: int):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile
        for pdf in batches:
            for uri, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for member in zf.namelist():
                        if not member.endswith(member_suffix):
                            continue
                        with zf.open(member) as fh:
                            buf: list[str] = []
                            for line in io.TextIOWrapper(fh, encoding="utf-8", newline="\n"):
                                buf.append(line.rstrip("\r\n"))
                                if len(buf) >= batch_rows:
                                    yield pd.DataFrame({"source": uri, "value": buf})
                                    buf = []
                            if buf:
                                yield pd.DataFrame({"source": uri, "value": buf})
    return fn


def inflate_archives(spark: SparkSession, folder: str, pattern: str = "*.zip", member_suffix: str = ".txt",
                     batch_rows: int = 50_000, by_range: bool | None = None) -> tuple[DataFrame, int, int]:
    """Lines (source, value) of the archives' members, the number of archives and their bytes.

    ``by_range`` reads each member by a task of its own (``archives.ZippedText``); by default where the
    file system allows it. Else Spark's binary-file source hands a whole packed archive (of at most 2 GB,
    as it is one cell) to a task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    listed = sorted((r["path"], r["length"]) for r in files.select("path", "length").collect())   # a row an archive
    n, size = len(listed), sum(length for _, length in listed)
    if by_range is None:
        by_range = all(AR.readable_here(path) for path, _ in listed[:1])
    if by_range and n:
        spark.dataSource.register(AR.ZippedText)
        found = spark.read.format(AR.FORMAT).option("archives", json.dumps([path for path, _ in listed])) \
            .option("memberSuffix", member_suffix).option("batchRows", batch_rows).load()
        return found.select("source", "value"), n, size
    # packed archives are dealt one by one; inflating is many times the work of moving them
    dealt = files.select("path", "content").repartition(max(1, n))
    return dealt.mapInPandas(_zip_lines_fn(member_suffix, batch_rows), "source string, value string"), n, size


def ingest_zipped_dumps(spark: SparkSession, folder: str, pattern: str = "*.zip",
                        member_suffix: str = ".txt", schema: T.StructType = PLACE_SCHEMA,
                        batch_rows: int = 50_000, split_bytes: int = 16 << 20, by_range: bool | None = None) -> DataFrame:
    """A4: dump rows from every ``.txt`` member of the zip archives in ``folder``.

    A member is inflated by a task of its own, block by block (a deflate member decompresses
    sequentially by format), whatever the size of its archive; see ``inflate_archives`` for file
    systems that only Spark reads. Where archives are larger than ``split_bytes`` packed, the lines
    are dealt anew to one partition per that many bytes, so a single world member is parsed and
    assigned by many tasks; that partition count is given by number, which adaptive execution does
    not coalesce.
    """
    lines, n, size = inflate_archives(spark, folder, pattern, member_suffix, batch_rows, by_range)
    parts = -(-size // split_bytes)
    if parts > n:
        lines = lines.repartition(parts)
    opts = {"sep": "\t", "quote": "", "mode": "PERMISSIVE"}
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv(F.col("value"), ddl, opts).alias("r"))
    return parsed.select("r.*")


def write_csv(df: DataFrame, path: str) -> None:
    """A5: a folder of part files with a header; overwrite."""
    df.write.option("header", True).mode("overwrite").csv(path)


def write_csv_by_country(df: DataFrame, root: str, key: str = "country_code", rows_per_task: int = 1_000_000,
                         max_records_per_file: int = 5_000_000) -> None:
    """One folder per country under ``root``.

    ``df`` is evaluated once, into the checkpoint folder. A count per country then says over
    how many lots its rows are dealt (by a hash of the id), so a country holding a third of
    the rows spreads over many writer tasks while small countries share one; dynamic
    partition overwrite replaces only the countries present in ``df``.
    """
    spark = df.sparkSession
    stored = materialize(df)
    lots = stored.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("int").alias("_lots"))
    lots = lots.withColumnRenamed(key, "_key")   # a row per country
    dealt = stored.join(F.broadcast(lots), stored[key].eqNullSafe(lots["_key"])) \
        .withColumn("_lot", F.pmod(F.xxhash64("geonameid"), F.col("_lots")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.repartition(n, F.col(key), F.col("_lot")).select(*df.columns)
    (spread.write.option("header", True).option("maxRecordsPerFile", max_records_per_file)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(key).csv(root))


def read_partitioned_csv(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Read Spark CSV output (optionally ``key=value`` folders) with an explicit
    schema. A missing path raises Spark's path-not-found error; a folder without
    data files raises ``ValueError``."""
    df = spark.read.schema(schema).option("header", True).csv(root)
    if df.select(F.lit(1)).limit(1).isEmpty() and not _has_files(spark, root):
        raise ValueError(f"no CSV part files under {root}")
    return df.select(*schema.fieldNames())


def _has_files(spark: SparkSession, root: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.csv*").load(root)
    return not files.select("path").limit(1).isEmpty()


def merge_sorted(df: DataFrame, key: str = "geonameid") -> DataFrame:
    """All parts as one table sorted by ``key`` (unsorted, with a warning, when
    the column is absent). The global sort is range-partitioned; parts come out in
    key order."""
    if key not in df.columns:
        warnings.warn(f"column {key!r} not found; output left unsorted", stacklevel=2)
        return df
    return df.orderBy(key)


def write_merged(df: DataFrame, path: str, key: str = "geonameid", single_file: bool = False) -> None:
    """Write ``merge_sorted(df)``; ``single_file`` funnels the sorted rows through one
    writer and is meant for small outputs only."""
    out = merge_sorted(df, key)
    (out.coalesce(1) if single_file else out).write.option("header", True).mode("overwrite").csv(path)


def encode_nested(df: DataFrame, cols: Sequence[str] = ("candidates", "polygons")) -> DataFrame:
    """Nested columns as JSON text; a null list is written as ``[]``."""
    out = df
    for c in cols:
        if c in df.columns:
            out = out.withColumn(c, F.to_json(F.coalesce(F.col(c), F.array())))
    return out


_CAND_TEXT = "array<struct<metro_id:string,metro_name:string,force:double,distance:double>>"


def _as_json(c: Column) -> Column:
    """Cell text as JSON. Text with Python's ``None`` / ``nan`` or backslash escapes, which
    Spark's JSON reader refuses, is read as a Python literal; only such cells go to Python."""
    def literal(cells: pd.Series) -> pd.Series:
        import ast
        import json
        import math
        import re

        def clean(v):
            if isinstance(v, dict):
                return {str(k): clean(x) for k, x in v.items()}
            if isinstance(v, list | tuple):
                return [clean(x) for x in v]
            return None if isinstance(v, float) and not math.isfinite(v) else v

        def one(t):
            if t is None:
                return None
            try:
                return json.dumps(clean(ast.literal_eval(t)))
            except (ValueError, SyntaxError, RecursionError, MemoryError):
                pass
            try:   # nan and inf are names, not literals
                bare = re.sub(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|-?\b(?:nan|NaN|inf|Infinity|null)\b""",
                              lambda m: m[1] or "None", t)
                return json.dumps(clean(ast.literal_eval(bare)))
            except (ValueError, SyntaxError, RecursionError, MemoryError):
                return t
        return cells.map(one)

    literal.__annotations__ = {"cells": pd.Series, "return": pd.Series}
    # the pattern walks a text character by character; most texts hold nothing it could find
    may = c.contains("\\") | c.contains("None") | c.contains("nan") | c.contains("inf")
    odd = may & F.regexp_like(c, F.lit(r"\\|\bNone\b|\bnan\b|\binf\b"))
    return F.coalesce(F.pandas_udf(literal, "string")(F.when(odd, c)), c)


def decode_candidates(col: str | Column) -> Column:
    """A10: candidate text (JSON, or the legacy Python-literal form with single quotes, ``None``
    and escapes) to ``array<struct<metro_id, metro_name, force, distance>>``; null, empty or
    junk text gives an empty array, a field that is ``None`` or junk is null."""
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.from_json(_as_json(c), _CAND_TEXT, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    typed = F.transform(parsed, lambda x: F.struct(whole_number(x["metro_id"], "int").alias("metro_id"),
                                                   x["metro_name"].alias("metro_name"),
                                                   x["force"].alias("force"), x["distance"].alias("distance")))
    return F.coalesce(typed, F.array().cast(CANDIDATE_TYPE))


def decode_polygons(col: str | Column) -> Column:
    """A10: polygon text to ``array<array<struct<lat, lon>>>``. Accepts the JSON written by
    ``encode_nested`` and the legacy ``[[(lat, lon), ...]]`` form; null, empty or junk
    gives an empty array."""
    c = F.col(col) if isinstance(col, str) else col
    as_json = F.from_json(c, POLYGONS_TYPE.simpleString())
    legacy = F.from_json(F.translate(c, "()", "[]"), "array<array<array<double>>>")
    legacy_rings = F.transform(legacy, lambda ring: F.transform(
        ring, lambda p: F.struct(F.get(p, 0).alias("lat"), F.get(p, 1).alias("lon"))))
    starts_struct = F.regexp_like(c, F.lit(r"^\s*\[\s*\[\s*\{"))
    value = F.when(starts_struct, as_json).otherwise(legacy_rings)
    return F.coalesce(value, F.array().cast(POLYGONS_TYPE))


def decode_nested(df: DataFrame) -> DataFrame:
    """Saved nested text columns as arrays; the candidate list may be called ``candidates`` or, as
    in files of the source, ``candidate_metro_ids``, and is ``candidates`` afterwards."""
    out = df
    if "candidates" not in df.columns and "candidate_metro_ids" in df.columns:
        out = out.withColumnRenamed("candidate_metro_ids", "candidates")
    if "candidates" in out.columns:
        out = out.withColumn("candidates", decode_candidates("candidates"))
    if "polygons" in out.columns:
        out = out.withColumn("polygons", decode_polygons("polygons"))
    return out


def write_parquet_table(df: DataFrame, path: str) -> None:
    """A stage table (e.g. boundaries with their nested rings) as Parquet."""
    df.write.mode("overwrite").parquet(path)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage_checkpoint(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate stage and continue from the written copy (cuts the
    lineage; a lost executor re-reads the files instead of recomputing the stage)."""
    write_parquet_table(df, path)
    return read_parquet_table(df.sparkSession, path)


def _zip_parts_fn(dst: str, member_suffix: str):
    def local(uri: str) -> str:   # Hadoop writes file:/x, pyarrow reads file:///x
        return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import zipfile

        import pyarrow.fs as pafs
        for pdf in batches:
            out = []
            for uri in pdf["path"]:
                fs, p = pafs.FileSystem.from_uri(local(uri))
                stem = os.path.basename(p).split(".")[0]
                dfs, dpath = pafs.FileSystem.from_uri(local(dst))
                dfs.create_dir(dpath, recursive=True)
                target = f"{dpath}/{stem}.zip"
                with fs.open_input_stream(p) as src, dfs.open_output_stream(target) as sink, \
                        zipfile.ZipFile(sink, "w", compression=zipfile.ZIP_DEFLATED) as zf, \
                        zf.open(stem + member_suffix, "w") as member:
                    while chunk := src.read(1 << 20):
                        member.write(chunk)
                out.append(target)
            yield pd.DataFrame({"archive": out})
    return fn


def zip_text_parts(spark: SparkSession, src_folder: str, dst_folder: str, pattern: str = "part-*",
                   member_suffix: str = ".txt") -> DataFrame:
    """Pack every text part file of ``src_folder`` into its own zip archive under
    ``dst_folder`` (one task per file, streamed in 1 MiB blocks). Returns the archive
    paths; the packing runs when the result is evaluated. Archives are written to their final names by
    the tasks themselves, without a commit: this prepares input for tests and examples."""
    paths = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(src_folder)
             .select("path"))
    paths = paths.repartition(max(1, paths.count()))
    dst = _qualified(spark, dst_folder)   # fails on a file system that pyarrow does not know
    return paths.mapInPandas(_zip_parts_fn(dst, member_suffix), "archive string")
