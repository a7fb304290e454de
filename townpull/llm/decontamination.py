"""Benchmark decontamination (operator 10): spaced-seed hashing, DataFrame functions only.

Texts are words (split at ASCII white space, A-Z lower-cased). Each mask of ``MASKS`` picks some
of nine successive words; their hash ignores the rest. Hashes at every place of the benchmark
items meet those at every place of the documents. A hit fixes how the item lies on the document;
there the words around it are compared one by one, and a pair counts if some window of
``WINDOW`` words of the item (the whole item, if shorter) agrees in at least ``SHARE`` of them.
The masks are such that every window with up to two words of 13 replaced, in any places, holds
a hit, so nothing that the check accepts is lost: 11 of 13 are needed.

Items of 5 to 12 words have masks by their length, such that each set of replacements that the
check allows (one word of 5 to 9, two of 10 to 12) leaves a hit; shorter ones are looked for as they
are. Each item is looked for by its own masks only. Empty items match nothing.

Null and empty texts hold nothing. Repeated rows are judged each; the result names each
(doc_id, item_id) once with its best window. Rows or items without an id are searched and
come back with a null. Extra columns are ignored; an empty table on either side gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import free_name, stage, text_or_empty

MASKS = ("111001101", "110110101", "110100111")
#: By the length of items below WINDOW words; of shorter ones no word may be replaced.
SHORT_MASKS = {
    5: ("111", "11011"),
    6: ("1111", "11011"),
    7: ("11011",),
    8: ("111011", "11011111"),
    9: (*MASKS, "111111"),
    10: (*MASKS, "111111", "11010111", "10111011"),
    11: (*MASKS, "1111101", "11011101111"),
    12: (*MASKS, "11111111"),
}
WINDOW = 13
SHARE = 0.8
BROADCAST_ROWS = 2_000_000   # seeds of the benchmark (two longs and an int each) sent to every executor
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, UPPER.lower()), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def masks_of(n: int) -> tuple[str, ...]:
    """The masks of an item of n words."""
    return MASKS if n >= WINDOW else SHORT_MASKS.get(n, ("1" * n,))


def _seeds(array: str, at: Column, masks: list[str], n: Column | None = None, lengths: list[int] | None = None) -> Column:
    """The hashes at one place, one per mask (null where the mask reaches past the end, or where it is
    none of an item's of n words, ``lengths`` being all that there are, WINDOW for it and more)."""
    out = []
    for k, mask in enumerate(masks):
        picked = [F.get(array, at + i) for i, c in enumerate(mask) if c == "1"]
        fits = at + len(mask) <= F.size(array)
        if n is not None:
            fits &= F.least(n, F.lit(WINDOW)).isin([x for x in lengths if mask in masks_of(x)])
        out.append(F.when(fits, F.xxhash64(F.lit(k), *picked)))
    return F.array(*out)


def _needed(n: Column) -> Column:
    return F.ceil(F.least(n, F.lit(WINDOW)) * F.lit(SHARE) - 1e-9).cast("int")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text), item_id, matched (words of the best window) of each
    place where a document holds words of an item."""
    items = benchmark.select("item_id", words(text_or_empty()).alias("item")).where(F.size("item") > 0)
    items = stage(items.withColumn("item_no", F.xxhash64("item_id", F.to_json("item"))).dropDuplicates(["item_no"]), "leak-items")
    # at most WINDOW different lengths
    lengths = sorted(r["n"] for r in items.select(F.least(F.size("item"), F.lit(WINDOW)).alias("n")).distinct().collect())
    masks = sorted({m for n in lengths for m in masks_of(n)}) or list(MASKS)
    seeds = items.select("item_no", F.size("item").alias("n"), F.posexplode("item").alias("q", "w"), "item") \
        .select("item_no", "n", "q", F.explode(_seeds("item", F.col("q"), masks, F.col("n"), lengths)).alias("seed")).where("seed is not null")
    seeds = stage(seeds.distinct(), "leak-seeds")
    seeds = F.broadcast(seeds) if seeds.count() <= BROADCAST_ROWS else seeds
    key = F.xxhash64(text_or_empty())
    spread = docs.select("doc_id", key.alias("text_key"), words(text_or_empty()).alias("words")) \
        .where(F.size("words") > 0) \
        .select("doc_id", "text_key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("p"))
    hits = spread.select("doc_id", "text_key", "words", "p", F.explode(_seeds("words", F.col("p"), masks)).alias("seed")) \
        .join(seeds, "seed")
    # the document's words from WINDOW before the hit to WINDOW behind it, and where that part begins in the item
    back = F.least(F.col("q"), F.col("p"), F.lit(WINDOW))
    around = hits.select("doc_id", "text_key", "item_no", "p", "q",
                         F.slice("words", F.col("p") - back + 1, back + 2 * WINDOW).alias("part"),
                         (F.col("q") - back).alias("first"))
    around = around.join(items.select("item_no", "item_id", "item"), "item_no")
    same = F.transform(F.sequence(F.lit(0), F.least(F.size("part"), F.size("item") - F.col("first")) - 1),
                       lambda i: F.when(F.get("part", i) == F.get("item", F.col("first") + i), F.lit(1)).otherwise(F.lit(0)))
    width = F.least(F.size("item"), F.lit(WINDOW))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.greatest(F.size("same") - width + 1, F.lit(1))),
                                   lambda s: F.aggregate(F.slice("same", s, width), F.lit(0), lambda a, b: a + b)))
    return around.withColumn("same", same).withColumn("matched", best) \
        .where(F.col("matched") >= _needed(F.size("item"))) \
        .select("doc_id", "text_key", "item_id", F.col("matched").cast("int").alias("matched"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched): each document with each item that it leaks, once."""
    return find_leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that leak no item."""
    key = free_name(docs, "text_key")
    found = stage(find_leaks(docs, benchmark).select(F.col("text_key").alias(key)).distinct(), "leaks")
    return docs.withColumn(key, F.xxhash64(text_or_empty())).join(found, key, "left_anti").select(*docs.columns)


def brute_force_leaks(docs: list[tuple], items: list[tuple]) -> dict[tuple, int]:
    """The same in plain Python, for tests: every item laid on every place of every text."""
    lower = str.maketrans(UPPER, UPPER.lower())

    def cut(t):
        return [w for w in (t or "").translate(lower).replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
                .replace("\f", " ").replace("\r", " ").split(" ") if w]

    out: dict[tuple, int] = {}
    for d, text in docs:
        w = cut(text)
        for item_id, item in items:
            b = cut(item)
            if not b:
                continue
            n = min(len(b), WINDOW)
            for at in range(-len(b) + 1, len(w)):
                same = [0 <= at + i < len(w) and w[at + i] == x for i, x in enumerate(b)]
                need = math.ceil(n * SHARE - 1e-9)
                if sum(same) < need:
                    continue
                m = max(sum(same[k:k + n]) for k in range(len(b) - n + 1))
                if m >= need:
                    out[d, item_id] = max(out.get((d, item_id), 0), m)
    return out
