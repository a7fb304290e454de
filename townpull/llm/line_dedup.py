"""Line dedup (operator 13): lines that many documents hold go from all of them.

Texts are split at newlines. A line's key is the line without ASCII white space at its ends and
with A-Z lower-cased. The lines are exploded to hashes of their keys (128 bits), the distinct
documents of each hash are counted, and the places of lines whose key is in at least
``documents`` documents are brought back to their text, from which the other lines are put
together again by position. Texts themselves are never exploded: what is dealt out is a few
numbers a line, and the joined-back rows are one a text that loses something. DataFrame
functions only.

A hash that a third of all lines have is counted in parts (distinct pairs of hash and document,
then partial counts), and meets the small side of a join whose large side may be split.

Null and empty texts are one empty line. Keys of under ``chars`` code points, blank lines
included for ``chars`` >= 1, are never counted and stay. A document is a doc_id: rows of one id
count once, and rows without an id are together one document. Rows alike are returned each.
Extra columns are kept by ``without_common_lines`` and ignored by the query. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import free_name, stage, text_or_empty

CHARS = 1            # code points of a key that counts, at least
DOCUMENTS = 10       # documents that make a line common
BROADCAST_ROWS = 500_000   # of a few longs each, sent to every executor; more are joined by a shuffle
BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, UPPER.lower())


def _hash2(*cols: Column) -> tuple[Column, Column]:
    """128 bits as two 64-bit hashes of different seeds."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def line_places(docs: DataFrame, chars: int = CHARS) -> DataFrame:
    """(t1, t2: hash of id and text, doc_id, place, h1, h2: hash of the key) of every line that counts."""
    t1, t2 = _hash2(F.col("doc_id"), text_or_empty())
    lines = docs.select(t1.alias("t1"), t2.alias("t2"), "doc_id", F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("place", "line")) \
        .withColumn("line", line_key(F.col("line")))
    h1, h2 = _hash2(F.col("line"))
    return lines.where(F.char_length("line") >= chars).select("t1", "t2", "doc_id", "place", h1.alias("h1"), h2.alias("h2"))


def common_places(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """(t1, t2, gone: places of the lines that go) of the texts that lose lines."""
    places = stage(line_places(docs, chars), "line-places")
    common = places.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= documents).select("h1", "h2")
    common = stage(common, "line-common")
    gone = places.join(_small(common), ["h1", "h2"], "left_semi")
    # as many as a text has lines; those of rows alike are one
    return stage(gone.groupBy("t1", "t2").agg(F.collect_set("place").alias("gone")), "line-gone")


def _kept(docs: DataFrame, chars: int, documents: int) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns (names of their own) of each text's lines, the places of those that
    go (null: none), and the text that stays."""
    name = {c: free_name(docs, f"line_{c}") for c in ("t1", "t2", "lines", "gone", "text")}
    gone = common_places(docs, chars, documents).toDF(name["t1"], name["t2"], name["gone"])
    t1, t2 = _hash2(F.col("doc_id"), text_or_empty())
    # the split is below the join, so that it is done once a text and not once a line
    rows = docs.withColumns({name["t1"]: t1, name["t2"]: t2, name["lines"]: F.split(text_or_empty(), "\n", -1)})
    rows = rows.join(_small(gone), [name["t1"], name["t2"]], "left")
    lines = F.col(name["lines"])
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), name["gone"])
    rest = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    return rows.withColumn(name["text"], F.when(F.col(name["gone"]).isNull(), text_or_empty()).otherwise(rest)), name


def without_common_lines(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """``docs`` without the common lines; null texts and texts that lose nothing are as they were."""
    rows, name = _kept(docs, chars, documents)
    new = F.when(F.col(name["gone"]).isNull(), F.col("text")).otherwise(F.col(name["text"])).alias("text")
    return rows.select(*(new if c == "text" else c for c in docs.columns))


def line_dedup(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    rows, name = _kept(docs.select("doc_id", "text"), chars, documents)
    return rows.select("doc_id", F.size(name["lines"]).cast("long").alias("n_lines"),
                       F.coalesce(F.size(name["gone"]), F.lit(0)).cast("long").alias("n_dropped"),
                       F.sha2(F.col(name["text"]).cast("binary"), 256).alias("kept_sha256"))


def oracle_sql(chars: int = CHARS, documents: int = DOCUMENTS) -> str:
    """DuckDB SQL for doc_id, n_lines, n_dropped, kept_sha256."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM rows),
keyed AS (SELECT *, translate(trim(line, {blank}), '{UPPER}', '{UPPER.lower()}') AS k FROM cut),
common AS (SELECT k FROM keyed WHERE length(k) >= {chars} GROUP BY k
  HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'none')) >= {documents}),
marked AS (SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""
