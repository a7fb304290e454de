"""Phrase collocation mining (operator 12): dynamic itemset counting.

The documents are dealt into ``shards`` as numbered words, once, and the shards are scanned one
after the other, in cycles. Single words are counted from the first scan on. As soon as both
subphrases of a longer phrase (all but its last word, all but its first) have been seen ``least``
times, in whichever shard that happens, the phrase is active from the next scan on, and it is counted
until each shard has been scanned once since: so phrases of all lengths are counted in the same
scans. No phrase can occur more often than its parts, so that every phrase that occurs ``least``
times is activated and its count is complete after its cycle. Scans end when nothing active has
shards to go.

A scan learns what is active from two bitmaps of fixed size over phrase hashes: those that
have reached the threshold, and those that did so in the last cycle (a phrase whose parts both did before
has been counted to its end). Where different hashes share a bit a phrase is counted without need; since
counts are kept by shard, and two counts of a phrase in one shard are the same number, that changes
no result. So nothing that grows with the data is broadcast unmeasured.

Counts of a lot of words are sorted arrays, cut at fixed bounds of the hashes and sent as few packed rows;
a range of hashes is merged by one group of bounded size (as many ranges as the shuffle has partitions,
more for more words), so a frequent phrase is one entry a lot and no key is hot.

Words are A-Z lower-cased runs without blank or tab, within the pieces between ``.,;:!?`` and line
breaks. Words and phrases are identified by 64-bit hashes of language and words; the best are spelt in
the end by a second look at the texts for the words that are needed. Counts of the phrases' parts are those of the
scans; scores are computed in decimal arithmetic of 38 digits.

A null lang is ``und`` (together with documents of that name); null, empty and blank texts have
no words. Rows alike are counted each. Rows without an id are counted. Extra columns are
ignored. An empty table, or one without frequent phrases, gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpull.llm.common import slices, text_or_empty
from townpull.llm.substring_dedup import _mix, stage
from townpull.session import scratch_path

LONGEST = 4
LEAST = 30
KEEP = 2000
COVER = 80           # percent of its occurrences in a longer candidate that drop a phrase
FACTOR = 2_000_000   # of a score
SHARDS = 3
BITS = 25            # of a bitmap's size: 4 MB
LOT_BYTES = 4 << 20  # of text whose words are hashed together
LOT_WORDS = 2 << 20  # words whose phrases are counted together
SEEN = 21            # bits of the size of a task's table of what it has spelt
RANGE_WORDS = 8 << 20   # words of all documents to a range of hashes, at most
ENTRIES = "kind int, step int, length int, p long, hashes binary, counts binary"
BROADCAST_ROWS = 2_000_000   # of a hash and a number
BREAK = b"\xff"      # no byte of UTF-8
WIDE = "decimal(20,0)"
SCORE = f"cast({FACTOR} as decimal(10,0)) * cast(a as {WIDE}) div (cast(l as {WIDE}) + cast(r as {WIDE}))"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(UPPER + MARKS, UPPER.lower() + BREAK * len(MARKS))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words, with BREAK between pieces."""
    return text.translate(FOLD).replace(BREAK, b" \xff ").split()


def longer(h, w):
    """Hash of the phrases of hashes h with one more word each."""
    import numpy as np
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) ^ w)


def _marked(bitmap, h, bits: int):
    """Which of the hashes h have their bit in the bitmap (bytes)."""
    import numpy as np
    slot = h >> np.uint64(64 - bits)
    return np.frombuffer(bitmap, np.uint8)[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0


def _hashed(lang: str, texts: list[bytes]):
    """The words of some texts of a language and their hashes, 0 between pieces."""
    import numpy as np
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = words_of(BREAK.join(texts))
    w = np.fromiter(map(digest, words), np.uint64, len(words))
    gaps = w == np.uint64(digest(BREAK))
    w = longer(np.array([digest(lang.encode(), 1)], np.uint64), w)
    w[w == 0] = 1
    w[gaps] = 0
    return words, w


def _by_lang(batches: Iterator, keys: int) -> Iterator:
    """Lots of about LOT_BYTES of text as {key columns (the last one lang): texts}; the text follows the keys."""
    groups, size = {}, 0
    for batch in batches:
        for b in slices(batch, 1024):
            for *key, text in zip(*(b.column(i).to_pylist() for i in range(keys)), b.column(keys).cast("binary").to_pylist()):
                groups.setdefault(tuple(key), []).append(text)
                size += len(text)
                if size >= LOT_BYTES:
                    yield groups
                    groups, size = {}, 0
    if groups:
        yield groups


def _lang() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")


def _unseen(table, h):
    """Which of the distinct hashes h the table of the last hash in each place does not hold, and holds now.
    One that was pushed out is new again."""
    import numpy as np
    at = (h & np.uint64(len(table) - 1)).astype(np.int64)
    new = table[at] != h
    table[at[new]] = h[new]
    return new


def deal_words(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Written rows (shard, lang, tokens: 64-bit hashes of words with 0 between pieces, n_words)."""
    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for groups in _by_lang(batches, 2):
            rows = []
            for (shard, lang), texts in groups.items():
                _, w = _hashed(lang, texts)
                rows.append((lang, w.astype("<u8").tobytes(), int((w != 0).sum()), shard))
            lang, tokens, n, shard = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(tokens, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(shard, pa.int32())], ["lang", "tokens", "n_words", "shard"])

    schema = "lang string, tokens binary, n_words long, shard int"
    shard = F.pmod(F.xxhash64("doc_id", text_or_empty()), F.lit(shards)).cast("int")
    rows = docs.select(shard.alias("shard"), _lang(), text_or_empty().alias("text")).mapInArrow(make, schema)
    path = os.path.join(scratch_path(docs.sparkSession, "phrase-words"))
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def spell_words(docs: DataFrame, need: DataFrame, bits: int = BITS) -> DataFrame:
    """(w, word) of the words whose hashes are in ``need`` (w)."""
    marked = _bitmap(need.select(F.col("w").alias("h")), bits).tobytes()

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        seen = np.zeros(1 << SEEN, np.uint64)
        for groups in _by_lang(batches, 1):
            for (lang,), texts in groups.items():
                words, w = _hashed(lang, texts)
                at = np.nonzero(_marked(marked, w, bits) & (w != 0))[0]
                h, first = np.unique(w[at], return_index=True)
                new = _unseen(seen, h)
                h, at = h[new], at[first[new]]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([words[i] for i in at], pa.binary())], ["w", "word"])

    found = docs.select(_lang(), text_or_empty().alias("text")).mapInArrow(make, "w long, word binary")
    return found.join(_small(need), "w", "left_semi").groupBy("w").agg(F.min("word").cast("string").alias("word"))


def _lots(batches: Iterator, size: int = LOT_WORDS) -> Iterator:
    """Arrays of the words of some rows, with a 0 at both ends and between rows."""
    import numpy as np
    some, n, gap = [], 0, np.zeros(1, np.uint64)
    for b in batches:
        for cell in b.column("tokens"):
            w = np.frombuffer(cell.as_buffer(), "<u8")
            if n and n + len(w) > size:
                yield np.concatenate([gap, *some])
                some, n = [], 0
            some += [w, gap]
            n += len(w) + 1
    if n:
        yield np.concatenate([gap, *some])


def _active(w, reached, late, bits: int, longest: int) -> Iterator:
    """(length, places, hashes) of the phrases of two words and more in w whose both subphrases are
    marked in ``reached``, and one of them in ``late``."""
    import numpy as np
    places = np.nonzero(w)[0]
    h = w[places]
    for length in range(2, longest + 1):
        on = _marked(reached, h, bits)
        places, h = places[on], h[on]
        new = _marked(late, h, bits)
        # both subphrases stand at successive places
        pair = np.nonzero(np.diff(places) == 1)[0]
        new = new[pair] | new[pair + 1]
        last = places[pair] + length - 1
        places, h = places[pair], longer(h[pair], w[last])
        yield length, places[new], h[new]


def _packed(rows: list[tuple]):
    """A record batch of ENTRIES from (kind, step, length, p, hashes, counts)."""
    import pyarrow as pa
    kinds = [pa.int32()] * 3 + [pa.int64()] + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      ["kind", "step", "length", "p", "hashes", "counts"])


def _summed(hashes: list, counts: list):
    """Distinct hashes, ascending, with the sums of their counts."""
    import numpy as np
    h, n = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *counts])
    if not len(h):
        return h, n
    order = np.argsort(h)
    h = h[order]
    first = np.nonzero(np.concatenate(([True], h[1:] != h[:-1])))[0]
    return h[first], np.add.reduceat(n[order], first)


def scan(shard: DataFrame, step: int, words: bool, reached: bytes, late: bytes, cuts: int, bits: int = BITS, longest: int = LONGEST) -> DataFrame:
    """ENTRIES of kind 0: counts, by lot of words and range of hashes (2 ** cuts of them), of the words, if
    they are still counted, and the active phrases of a shard."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        bounds = np.arange(1, 1 << cuts, dtype=np.uint64) << np.uint64(64 - cuts) if cuts else np.zeros(0, np.uint64)

        def rows(h, length):
            h, n = np.unique(h, return_counts=True)
            at = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
            return _packed([(0, step, length, p, h[a:e].astype("<u8").tobytes(), n[a:e].astype("<i8").tobytes())
                            for p, (a, e) in enumerate(zip(at, at[1:])) if e > a])

        for w in _lots(batches):
            if words:
                yield rows(w[w != 0], 1)
            for length, _, h in _active(w, reached, late, bits, longest):
                if len(h):
                    yield rows(h, length)

    return shard.select("tokens").mapInArrow(count, ENTRIES)


def _entries(t, kind: int) -> Iterator:
    """(step, hashes, counts) of the rows of a kind of a group."""
    import numpy as np
    for k, step, h, n in zip(*(t.column(c).to_pylist() for c in ("kind", "step", "hashes", "counts"))):
        if k == kind:
            yield step, np.frombuffer(h, "<u8"), np.frombuffer(n, "<i8")


def _merge(rows: DataFrame, step: int, least: int) -> DataFrame:
    """ENTRIES by range: of kind 1 the sums of the step's kind 0; of kind 3 the hashes that, with those of kind 1
    of other shards, have come to ``least`` and are not of kind 2 already; of kind 2 these and all before."""
    def run(key, t):
        import numpy as np
        import pyarrow as pa
        length, p = (k.as_py() for k in key)
        new = _summed(*zip(*((h, n) for _, h, n in _entries(t, 0)))) if 0 in t.column("kind").to_pylist() else _summed([], [])
        before = [(h, n) for _, h, n in _entries(t, 1)]
        h, n = _summed([new[0], *(x for x, _ in before)], [new[1], *(x for _, x in before)])
        known = np.concatenate([np.zeros(0, np.uint64), *(x for _, x, _ in _entries(t, 2))])
        hit = np.setdiff1d(h[n >= least], known)
        out = [(1, step, length, p, new[0].tobytes(), new[1].tobytes()), (2, step, length, p, np.union1d(known, hit).tobytes(), b""),
               (3, step, length, p, hit.tobytes(), b"")]
        out = [r for r in out if r[4]]
        return pa.Table.from_batches([_packed(out)])

    return rows.groupBy("length", "p").applyInArrow(run, ENTRIES)


def _totals(rows: DataFrame, shards: int) -> DataFrame:
    """(h, length, n) of every hash of kind 2, over one count of each shard."""
    def run(key, t):
        import numpy as np
        import pyarrow as pa
        length, _ = (k.as_py() for k in key)
        names = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h, _ in _entries(t, 2))]))
        best = np.zeros((shards, len(names)), np.int64)
        for step, h, n in _entries(t, 1):
            if len(names):
                at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                on = names[at] == h
                best[step % shards, at[on]] = np.maximum(best[step % shards, at[on]], n[on])
        return pa.table([pa.array(names.view(np.int64)), pa.array(np.full(len(names), length, np.int32)), pa.array(best.sum(axis=0))],
                        ["h", "length", "n"])

    return rows.groupBy("length", "p").applyInArrow(run, "h long, length int, n long")


def _bitmap(hashes: DataFrame, bits: int):
    """The bits of the hashes (h); what comes to the driver is bounded by the bitmap."""
    import numpy as np
    slot = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.select(F.shiftright(slot, 6).alias("at"), F.expr("1L").alias("one"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit")) \
        .groupBy("at").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("mask")).toArrow()
    out = np.zeros(1 << max(0, bits - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def _reached_bitmap(rows: DataFrame, bits: int, longest: int):
    """The bits of the packed hashes of kind 3 of phrases that may be parts of others."""
    def spread(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for cell in b.column("hashes"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(cell.as_buffer(), "<i8"))], ["h"])

    some = rows.where((F.col("kind") == 3) & (F.col("length") < longest)).select("hashes")
    return _bitmap(some.mapInArrow(spread, "h long"), bits)


def range_bits(dealt: DataFrame) -> int:
    """Leading bits of a hash that name its range."""
    total = dealt.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    groups = max(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // RANGE_WORDS)
    return (groups - 1).bit_length()


def frequent(dealt: DataFrame, shards: int = SHARDS, least: int = LEAST, longest: int = LONGEST, bits: int = BITS,
             log: list | None = None) -> DataFrame:
    """(h, length, n) of every word and phrase that occurs ``least`` times.

    ``log`` gets (step, shard, entries counted by length) of each scan."""
    import numpy as np
    cuts = range_bits(dealt)
    none = np.zeros(1 << max(0, bits - 6), np.uint64)
    steps, marks, known = [], [], none
    while len(steps) < shards or any(m.any() for m in marks[-shards:]):
        step = len(steps)
        late = reduce(np.bitwise_or, marks[-shards:], none)
        rows = scan(dealt.where(F.col("shard") == step % shards), step, step < shards, known.tobytes(), late.tobytes(), cuts, bits, longest)
        # the last scans are of different shards
        for s in steps[max(0, step - shards + 1):]:
            rows = rows.unionAll(s.where("kind = 1"))
        if steps:
            rows = rows.unionAll(steps[-1].where("kind = 2"))
        found = stage(_merge(rows, step, least), f"phrase-scan{step}")
        steps.append(found)
        if log is not None:
            log.append((step, step % shards, {r["length"]: r["n"] for r in found.where("kind = 1").groupBy("length").agg(
                F.sum(F.octet_length("hashes") / 8).cast("long").alias("n")).collect()}))
        marks.append(_reached_bitmap(found, bits, longest))
        known = known | marks[-1]
    rows = reduce(DataFrame.unionAll, [s.where("kind = 1") for s in steps], steps[-1].where("kind = 2"))
    return stage(_totals(rows, shards), "phrase-counts")


def spell(dealt: DataFrame, marked, cuts: int, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """(h, lang, words: hashes) of the phrases of two words and more that are marked, once each."""
    on = marked.tobytes()

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        seen = np.zeros(1 << SEEN, np.uint64)
        bounds = np.arange(1, 1 << cuts, dtype=np.uint64) << np.uint64(64 - cuts) if cuts else np.zeros(0, np.uint64)
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

        def rows(lang, w):
            for length, places, h in _active(w, on, on, bits, longest):
                some = np.nonzero(_marked(on, h, bits))[0]
                h, first = np.unique(h[some], return_index=True)
                new = _unseen(seen, h)
                h, at = h[new], places[some[first[new]]]
                words = np.stack([w[at + i] for i in range(length)], axis=1)
                cut = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
                out = [(lang, length, p, h[a:e].tobytes(), words[a:e].tobytes()) for p, (a, e) in enumerate(zip(cut, cut[1:])) if e > a]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                                 ["lang", "length", "p", "hashes", "words"])

        some, n, gap = {}, 0, np.zeros(1, np.uint64)
        for b in batches:
            for lang, cell in zip(b.column("lang").to_pylist(), b.column("tokens")):
                w = np.frombuffer(cell.as_buffer(), "<u8")
                some.setdefault(lang, []).extend((w, gap))
                n += len(w)
                if n >= LOT_WORDS:
                    for lang, parts in some.items():
                        yield from rows(lang, np.concatenate([gap, *parts]))
                    some, n = {}, 0
        for lang, parts in some.items():
            yield from rows(lang, np.concatenate([gap, *parts]))

    def once(key, t):
        import numpy as np
        import pyarrow as pa
        length = key[0].as_py()
        h = [np.frombuffer(x, "<u8") for x in t.column("hashes").to_pylist()]
        words = np.concatenate([np.frombuffer(x, "<u8") for x in t.column("words").to_pylist()]).reshape(-1, length)
        names = t.column("lang").to_pylist()
        of = np.repeat(np.arange(len(h)), [len(x) for x in h])
        h, first = np.unique(np.concatenate(h), return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1, dtype=np.int32) * length), pa.array(words[first].ravel().view(np.int64)))
        return pa.table([pa.array(h.view(np.int64)), pa.array([names[i] for i in of[first]], pa.string()), lists], ["h", "lang", "words"])

    return dealt.select("lang", "tokens").mapInArrow(find, "lang string, length int, p long, hashes binary, words binary") \
        .groupBy("length", "p").applyInArrow(once, "h long, lang string, words array<long>")


def parts(phrases: DataFrame) -> DataFrame:
    """Per phrase of ``phrases`` (h, words): h and its contiguous parts, a row each: first (place of its
    first word), size (words), part (its hash)."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            h = b.column("h").to_numpy()
            words = b.column("words").to_pylist()
            sizes = np.array([len(x) for x in words])
            for length in np.unique(sizes).tolist():
                rows = np.nonzero(sizes == length)[0]
                w = np.array([words[i] for i in rows], np.int64).view(np.uint64)
                for first in range(length):
                    part = w[:, first]
                    for size in range(1, length - first + 1):
                        if size > 1:
                            part = longer(part, w[:, first + size - 1])
                        if size < length:
                            same = np.full(len(rows), 1, np.int8)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(h[rows]), pa.array(same * first), pa.array(same * size), pa.array(same * length),
                                 pa.array(part.view(np.int64))], ["h", "first", "size", "length", "part"])

    return phrases.select("h", "words").mapInArrow(run, "h long, first tinyint, size tinyint, length tinyint, part long")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, keep: int = KEEP, cover: int = COVER,
                 shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's ``keep`` best phrases of 2 to ``longest`` words of
    ``docs`` (doc_id, text, lang)."""
    dealt = deal_words(docs, shards)
    counts = frequent(dealt, shards, least, longest, bits)
    marked = _bitmap(counts, bits)
    numbers = _small(counts.select("h", "n"))
    found = spell(dealt, marked, range_bits(dealt), longest, bits).join(numbers, "h").withColumnRenamed("n", "a")
    found = stage(found, "phrase-found")
    pieces = stage(parts(found), "phrase-parts")

    # the most frequent longer phrase around each phrase
    around = pieces.where("size > 1").join(found.select("h", "a"), "h").groupBy("part").agg(F.max("a").alias("most"))
    left = found.join(_small(around.select(F.col("part").alias("h"), "most")), "h", "left") \
        .where(F.col("most").isNull() | (F.lit(100).cast(WIDE) * F.col("most") < F.lit(cover).cast(WIDE) * F.col("a"))) \
        .select("h", "lang", "words", "a")
    left = stage(left, "phrase-left")

    head = pieces.where("first = 0").select("h", F.col("size").alias("k"), F.col("part").alias("head")) \
        .join(left.select("h", "a"), "h")
    tail = pieces.where("first > 0 and first + size = length").select("h", F.col("first").alias("k"), F.col("part").alias("tail"))
    numbers = counts.select(F.col("h").alias("of"), "n")
    cuts = head.join(tail, ["h", "k"])
    cuts = cuts.join(_small(numbers.toDF("head", "l")), "head").join(_small(numbers.toDF("tail", "r")), "tail")
    score = F.expr(SCORE)
    best = cuts.select("h", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("h").agg(F.min("cut").alias("cut"))

    best = left.join(best, "h").select("h", "lang", "words", "a", "cut.l", "cut.r", "cut.score")
    # all that may be among the best, ties of the last included; only these are spelt
    place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    best = stage(best.withColumn("place", place).where(F.col("place") <= keep).drop("place"), "phrase-best")
    need = best.select("h", F.posexplode("words").alias("place", "w"))
    spelt = stage(spell_words(docs, stage(need.select("w").distinct(), "phrase-need"), bits), "phrase-spelt")
    names = need.join(_small(spelt), "w").groupBy("h") \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    n = stage(dealt.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-langs")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.join(names, "h").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).join(_small(n), "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, longest: int = LONGEST, keep: int = KEEP, cover: int = COVER) -> str:
    """DuckDB SQL for lang, rank, phrase, a, l, r, n, score: every phrase is counted."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {size} AS size, unnest(list_transform(range(1, len(w) - {size - 2}), lambda i: w[i:i + {size - 1}])) AS p FROM pieces"
        for size in range(1, longest + 1))
    return f"""
WITH rows AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER.decode()}', '{UPPER.lower().decode()}') AS t
  FROM documents),
cut AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM rows),
pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda s: s <> '') AS w FROM cut),
grams AS ({grams}),
f AS (SELECT lang, p, size, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
inner_parts AS (SELECT lang, f, unnest(flatten(list_transform(range(2, size), lambda m:
  list_transform(range(1, size - m + 2), lambda i: p[i:i + m - 1])))) AS p FROM f WHERE size > 2),
around AS (SELECT lang, p, max(f) AS most FROM inner_parts GROUP BY ALL),
stays AS (SELECT f.* FROM f LEFT JOIN around ON f.lang = around.lang AND f.p = around.p
  WHERE size > 1 AND (most IS NULL OR 100 * most < {cover} * f.f)),
cuts AS (SELECT lang, p, f, size, unnest(range(1, size)) AS k FROM stays),
scored AS (SELECT cuts.lang, cuts.p, cuts.f AS a, k, x.f AS l, y.f AS r, ({FACTOR} * cuts.f) // (x.f + y.f) AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.p = cuts.p[1:k] JOIN f y ON y.lang = cuts.lang AND y.p = cuts.p[k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT best.*, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY best.lang
  ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM best)
SELECT ranked.lang AS lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= {keep}"""
