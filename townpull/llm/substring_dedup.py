"""Substring dedup (operator 6): paragraph MinHash banding.

Paragraphs are the lines of at least ``SHINGLE`` words, and, since texts may be hard-wrapped, also
the blocks of successive lines of under ``WRAPPED`` words each, joined. Each gets the minima of ``rows`` x
``bands`` hash functions over its five-word shingles; paragraphs that agree in a band collide.
Equal paragraphs are one from the start. Of the paragraphs in a band's bucket all pairs are
compared where they are few. In a larger bucket each is compared with the one that has the
most copies, the pivot (once, in however many bands); two that may be similar though one is unlike the pivot must share
rare shingles by which they differ from it, and are found by a join on these (an exact prefix
filter, see ``_beside``), so a bucket of thousands of variants costs about a comparison each
and no similar pair is left out. A pair whose exact
Jaccard similarity is at least 0.8 is an edge; the components of the edges are the groups of
paragraphs. Bands are tuned so that a pair at the threshold collides with a probability of at
least ``RECALL``.

A passage may repeat within longer lines. So what is left of the texts is also compared, whatever
its lines, by windows of ``RUN_WORDS`` words: a window whose words occur at an earlier place goes. To
hash few of them, the least-hashed of the ``ANCHOR``-word sequences in each window are picked, which
equal windows pick alike, and only windows around anchors that repeat are looked at. So every passage
of at least ``RUN_WORDS`` repeated words is found, to its ends, and nothing that does not repeat.

Of each group the occurrence in the smallest doc_id (then the first there) stays, the others
are removals. Blocks and lines by themselves are decided first, then lines within the blocks that
stay, then passages among what remains, so what stays for a group is not taken away by a choice
made apart from it. That holds word by word: a word that goes as part of a copy has one that stays, though
a passage whose words are kept in several places need not stay in one piece (and a near copy's own words go
with it). Lines of under ``SHINGLE`` words go only as parts of blocks or passages. Words are the
ASCII white-space separated, A-Z lower-cased words of the text.

Null and empty texts have no paragraphs and lose nothing. Rows alike in id and text are one
occurrence and lose the same. Rows without an id come first and keep theirs. Extra columns are
kept by the stage and ignored by the query. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from townpull.llm import common
from townpull.llm.common import free_name, text_or_empty
from townpull.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
APART = (1 - SIMILARITY) / (1 + SIMILARITY)   # differing shingles over both sizes' sum, at the threshold
RECALL = 0.995
BAND_ROWS = 5
WRAPPED = 20        # lines of fewer words may be parts of a wrapped paragraph
RUN_WORDS = 16
ANCHOR = 8          # words of an anchor; each window of RUN_WORDS words holds one
FEW = 24            # members of a bucket up to which all pairs are compared
LOT_WORDS = 60_000  # words of short texts that are hashed together
SLOTS = 20          # bits of the size of the table of how often elements differ from a pivot
BROADCAST_ROWS = 2_000_000   # hashes that repeat (a long each) sent to every executor
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """As ``common.stage``; the shuffle files behind the copy go at once, as nothing reads them again."""
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return common.stage(df, label)
    finally:
        conf.unset(CLEANUP) if was is None else conf.set(CLEANUP, was)


def _small(hashes: DataFrame) -> DataFrame:
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_ROWS else hashes


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The least number of bands of ``rows`` minima with which such a pair collides surely enough."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands


def _mix(h):
    import numpy as np
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(w, k: int = SHINGLE):
    """Hash of the k words from each place on (places near the end take what follows there)."""
    import numpy as np
    n = max(0, len(w) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = _mix(h ^ w[i:n + i])
    return h


def anchor_places(w, spans):
    """Places of the ANCHOR-word sequences picked in the texts at ``spans`` of the words w, with their
    hashes: of those in each window of RUN_WORDS words the one of the least hash (the last such)."""
    import numpy as np
    h = shingle_hashes(w, ANCHOR)
    within = RUN_WORDS - ANCHOR + 1
    n = max(0, len(h) - within + 1)
    least, at = h[:n].copy(), np.arange(n)
    for d in range(1, within):
        other = h[d:n + d]
        better = other <= least
        least[better] = other[better]
        at[better] = np.nonzero(better)[0] + d
    ok = np.zeros(n, bool)
    for a, b in spans:
        ok[a:max(a, b - RUN_WORDS + 1)] = True
    picked = np.unique(at[ok])
    return picked, h[picked]


def _run_hashes(w, start, end):
    """Hash of the words from each start to its end."""
    import numpy as np
    place = np.arange(len(w), dtype=np.uint64)
    # words weighted by their place within the run, by way of prefix sums of h and of place * h
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
            for x in (w, w * place, _mix(w) * place * place)]
    a, b, c = (s[end] - s[start] for s in sums)
    at = start.astype(np.uint64)
    m = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64))) for x in (_mix(w), _mix(w) * place)]
    m0, m1 = (s[end] - s[start] for s in m)
    first = b - at * a                                             # sum of h * (place in the run)
    second = c - np.uint64(2) * at * m1 + at * at * m0             # sum of mix(h) * (place in the run) ** 2
    return _mix(_mix(_mix(a) ^ first) ^ second ^ (end - start).astype(np.uint64))


def word_hashes(words: list[bytes]):
    import numpy as np
    import xxhash
    return np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)


def paragraphs(text: bytes) -> tuple[list[bytes], list[tuple[int, int, int, int]]]:
    """The words of a text, and (start, end, level, start of the block) of its paragraphs of at least
    SHINGLE words. Level 0 is a block of several lines of under WRAPPED words up to a blank line, 1 a
    line by itself, 2 a line of such a block."""
    flat, out, block = [], [], []

    def close():
        level = 2 if len(block) > 1 else 1
        if level == 2 and block[-1][1] - block[0][0] >= SHINGLE:
            out.append((block[0][0], block[-1][1], 0, block[0][0]))
        out.extend((a, b, level, block[0][0]) for a, b in block if b - a >= SHINGLE)
        block.clear()

    for row in text.lower().split(b"\n"):
        some = row.split()
        line = (len(flat), len(flat) + len(some))
        flat += some
        if len(some) >= WRAPPED or not some:
            close()
        if some:
            block.append(line)
        if len(some) >= WRAPPED:
            close()
    close()
    return flat, out


def units(docs: DataFrame, bands: int | None = None, rows: int = BAND_ROWS) -> DataFrame:
    """Rows of paragraphs (line): doc_id, text_key, start, n (words), h (hash of the words), level, block (see
    ``paragraphs``) and the bands; and a row for each text's anchors: their places ``at`` and hashes ``anchors``."""
    bands = bands or tune_bands(rows=rows)

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        rng = np.random.default_rng(5)
        factor = rng.integers(1, 1 << 31, bands * rows).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        shift = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

        def signatures(sh, start, end):
            """bands x lines: the bands' hashes of the shingles from each start to its end."""
            low = np.append((sh >> np.uint64(32)).astype(np.uint32), np.uint32(0xFFFFFFFF))
            at = np.stack((start, end), axis=1).ravel()
            out = np.empty((bands, len(start)), np.uint64)
            for j in range(bands):
                acc = np.full(len(start), j + 1, np.uint64)
                for i in range(j * rows, (j + 1) * rows):
                    acc = _mix(acc ^ np.minimum.reduceat(low * factor[i] + shift[i], at)[::2].astype(np.uint64))
                out[j] = acc
            return out

        def lot(keys, texts):
            """One record batch for some texts, whose words are hashed together with gaps between."""
            flat = []
            spans, line = [], []        # of the texts; (text, start, end, level, block) of the paragraphs, in the lot's places
            for i, text in enumerate(texts):
                at = len(flat)
                some, found = paragraphs(text)
                flat += some
                line += [(i, a + at, b + at, level, block) for a, b, level, block in found]
                spans.append((at, len(flat)))
            w = word_hashes(flat)
            first = np.array([a for a, _ in spans], np.int64)
            line = np.array(line, np.int64).reshape(-1, 5)
            sh = shingle_hashes(w)
            sig = signatures(sh, line[:, 1], line[:, 2] - SHINGLE + 1) if len(line) else np.zeros((bands, 0), np.uint64)
            begins, anchors = anchor_places(w, spans)
            of = np.searchsorted(np.array([b for _, b in spans], np.int64), begins, side="right")
            count = np.bincount(of, minlength=len(texts))
            some = np.nonzero(count)[0]
            none = len(some)
            who = np.concatenate((line[:, 0], some))
            h = _run_hashes(w, line[:, 1], line[:, 2]) if len(line) else np.zeros(0, np.uint64)
            kind = np.arange(len(who)) < len(line)
            lists = pa.ListArray.from_arrays(
                np.concatenate((np.arange(len(line) + 1) * bands, np.full(none, len(line) * bands))).astype(np.int32),
                pa.array(sig.T.ravel().view(np.int64)))
            ends = pa.array(np.concatenate((np.zeros(len(line) + 1), np.cumsum(count[some]))).astype(np.int32))
            at = pa.ListArray.from_arrays(ends, pa.array((begins - first[of]).astype(np.int32)))
            anchors = pa.ListArray.from_arrays(ends, pa.array(anchors.view(np.int64)))
            numbers = (line[:, 1] - first[line[:, 0]], line[:, 2] - line[:, 1], h.view(np.int64), line[:, 3], line[:, 4])
            start, n, h, level, block = (np.concatenate((x, np.full(none, -1))) for x in numbers)
            return pa.RecordBatch.from_arrays(
                [*(k.take(pa.array(who)) for k in keys), pa.array(kind), *(pa.array(x.astype(np.int32)) for x in (start, n)),
                 pa.array(h), *(pa.array(x.astype(np.int32)) for x in (level, block)), lists, at, anchors],
                ["doc_id", "text_key", "line", "start", "n", "h", "level", "block", "bands", "at", "anchors"])

        for b in batches:
            texts = b.column(2).cast(pa.binary())
            at = 0
            while at < b.num_rows:
                stop, size = at, 0
                while stop < b.num_rows and (stop == at or size < 6 * LOT_WORDS):
                    size += len(texts[stop].as_buffer())
                    stop += 1
                yield lot([b.column(0).slice(at, stop - at), b.column(1).slice(at, stop - at)],
                          texts.slice(at, stop - at).to_pylist())
                at = stop

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text")) \
        .mapInArrow(make, f"doc_id {kind}, text_key long, line boolean, start int, n int, h long, "
                           "level int, block int, bands array<long>, at array<int>, anchors array<long>")


def line_shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, shingles array<long>) of the lines named by ``wanted`` (doc_id, text_key, h)."""
    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            out_h, out_s = [], []
            for text, want in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()):
                want = set(want)
                flat, found = paragraphs(text)
                w = word_hashes(flat)
                start, end = (np.array([f[i] for f in found], np.int64) for i in (0, 1))
                for a, b, h in zip(start, end, _run_hashes(w, start, end).view(np.int64).tolist() if found else []):
                    if h in want:
                        want.discard(h)
                        out_h.append(h)
                        out_s.append(np.unique(shingle_hashes(w[a:b])).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out_h, pa.int64()), pa.array(out_s, pa.list_(pa.int64()))],
                                             ["h", "shingles"])

    # as many as a text has lines
    by_text = wanted.groupBy("doc_id", "text_key").agg(F.collect_list("h").alias("want")) \
        .select(F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key"), "want")
    texts = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    on = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_key") == F.col("want_key"))
    return texts.join(by_text, on).select("text", "want").mapInArrow(make, "h long, shingles array<long>") \
        .dropDuplicates(["h"])


def similar_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Edges (a, b) between the hashes of paragraphs of ``lines`` (doc_id, text_key, h, bands) whose
    components are those of all similar pairs that collide."""
    # equal lines have equal bands
    distinct = stage(lines.groupBy("h").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key")).alias("at"),
                                            F.min("bands").alias("bands")), "dedup-distinct")
    member = distinct.select("h", F.explode("bands").alias("band"))
    bucket = stage(member.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "dedup-buckets")
    met = stage(member.join(_small(bucket), "band"), "dedup-met")
    wanted = distinct.select("h", "at.*").join(met.select("h").distinct(), "h", "left_semi")
    sets = stage(line_shingles(docs, wanted.select("doc_id", "text_key", "h")), "dedup-shingles")
    few = met.where(F.col("size") <= FEW).select("band", "h")
    pairs = few.select("band", F.col("h").alias("a")).join(few.select("band", F.col("h").alias("b")), "band").where("b < a")
    big = met.where(F.col("size") > FEW).select("band", "h").join(distinct.select("h", "copies"), "h")

    # each member of a large bucket against the one with the most copies, the pivot; once, in however many bands
    pivot = big.groupBy("band").agg(F.max(F.struct("copies", "h")).alias("top")).select("band", F.col("top.h").alias("pivot"))
    met_ = big.join(pivot, "band").where("h <> pivot").select("h", "pivot").distinct() \
        .join(sets.select("h", F.col("shingles").alias("x")), "h") \
        .join(sets.select(F.col("h").alias("pivot"), F.col("shingles").alias("p")), "pivot") \
        .withColumn("apart", F.concat(F.array_except("x", "p"), F.array_except("p", "x")))
    size, n = F.size("x"), F.size("apart")
    placed = stage(met_.select("h", "pivot", size.alias("size"), "apart", n.alias("n"),
                               (n <= (size + F.size("p")) * APART + 1e-9).alias("like")), "dedup-placed")
    star = placed.where("like").select(F.greatest("h", "pivot").alias("a"), F.least("h", "pivot").alias("b")).distinct()
    return _verified(pairs.select("a", "b").distinct(), sets).unionAll(star).unionAll(_verified(_beside(placed), sets))


def _slots(pivot, d):
    """Place in a table of 2 ** SLOTS of the element d of a pivot's members."""
    import numpy as np
    return (_mix(pivot ^ _mix(d)) >> np.uint64(64 - SLOTS)).astype(np.int64)


def _elements(batch):
    """Row number, slot and value of each element of ``apart`` (the last column; the first is the pivot)."""
    import numpy as np
    import pyarrow.compute as pc
    lists = batch.column(batch.num_columns - 1)
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    d = lists.flatten().to_numpy().view(np.uint64)
    return row, _slots(batch.column(0).to_numpy().view(np.uint64)[row], d), d


def _often(each: DataFrame):
    """Two arrays over the slots: how many elements fall there, and how many of them of members unlike the pivot."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        n, unlike = np.zeros(1 << SLOTS, np.int64), np.zeros(1 << SLOTS, np.int64)
        for b in batches:
            row, slot, _ = _elements(b)
            n += np.bincount(slot, minlength=len(n))
            unlike += np.bincount(slot[~b.column(1).to_numpy(zero_copy_only=False)[row]], minlength=len(n))
        s = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s, n[s], unlike[s])], ["slot", "n", "unlike"])

    import numpy as np
    # bounded by the slots
    got = each.select("pivot", "like", "apart").mapInArrow(count, "slot long, n long, unlike long") \
        .groupBy("slot").agg(F.sum("n").alias("n"), F.sum("unlike").alias("unlike")).toArrow()
    out = np.zeros((2, 1 << SLOTS), np.int64)
    for i, name in enumerate(("n", "unlike")):
        out[i, got.column("slot").to_numpy()] = got.column(name).to_numpy()
    return out


def _beside(placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of members with one pivot, at least one of which is unlike it, that may be similar.

    With ``apart`` the shingles by which a member differs from the pivot, two members differ in
    as many shingles as their ``apart`` do. Similar ones may differ in at most APART times the
    sum of their sizes, so they share at least o = (n1 + n2 - that) / 2 elements of ``apart``, which
    is over 0 as one of them is unlike the pivot; and so, in any order of the elements, one of
    the first n1 - o + 1 of the one is among the first n2 - o + 1 of the other. Only these are dealt out: for o
    stands the least that any partner allows, by the least n - APART times size of the pivot's unlike members
    (for an unlike one: of all its members). Where all members are like their pivot nothing is left to find; and
    since o is at most n2, a member is too near the pivot for all unlike ones where n2 + APART times its size is
    below their least n1 - APART times size.

    The order is from rare to frequent, so that members that differ from the pivot in places of their own do not meet.
    Elements are counted in a table of fixed size; those that share a slot there only stand elsewhere in
    the order, which may be any. An element that is alone in its slot, or of which no unlike member is there, meets none."""
    spare = F.col("n") - F.col("size") * APART
    far = placed.groupBy("pivot").agg(F.min(F.when(~F.col("like"), spare)).alias("far"), F.min(spare).alias("near")).where("far is not null")
    each = placed.join(_small(stage(far, "dedup-far")), "pivot").where(F.col("n") + F.col("size") * APART >= F.col("far") - 1e-9)
    often, unlike = _often(each)
    import numpy as np
    rank = np.minimum(255, 8 * np.log2(np.maximum(often, 1))).astype(np.uint8)
    meets = np.packbits(np.stack((often > 1, unlike > 0)), axis=1)   # of an unlike member, of one like the pivot

    def prefix(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        on = np.unpackbits(meets, axis=1).view(bool)
        for b in batches:
            row, slot, d = _elements(b)
            size, n, least = (b.column(i).to_numpy() for i in (2, 3, 5))
            like = b.column(4).to_numpy(zero_copy_only=False)
            order = np.lexsort((_mix(d), rank[slot], row))
            row, slot, d = row[order], slot[order], d[order]   # the rows stay where they were
            place = np.arange(len(row)) - (np.cumsum(n) - n)[row] + 1
            shared = np.ceil((least + n - size * APART) / 2 - 1e-6)
            some = (place <= (n - shared + 1)[row]) & on[like[row].astype(int), slot]
            at = pa.array(row[some])
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(5)), pa.array(d[some].view(np.int64)),
                                              pa.array(place[some].astype(np.int32))], ["pivot", "h", "size", "n", "like", "d", "place"])

    least = F.when(F.col("like"), F.col("far")).otherwise(F.col("near"))
    first = each.select("pivot", "h", "size", "n", "like", least.alias("least"), "apart") \
        .mapInArrow(prefix, "pivot long, h long, size int, n int, like boolean, d long, place int")
    first = stage(first, "dedup-apart")
    x = first.where("not like").select("pivot", "d", F.col("h").alias("x"), F.col("size").alias("xs"), F.col("n").alias("xn"),
                                       F.col("place").alias("xp"))
    y = first.select("pivot", "d", F.col("h").alias("y"), F.col("size").alias("ys"), F.col("n").alias("yn"),
                     F.col("place").alias("yp"))
    shared = F.ceil((F.col("xn") + F.col("yn") - (F.col("xs") + F.col("ys")) * APART) / 2 - 1e-9)
    may = (F.col("x") != F.col("y")) & (F.col("xp") <= F.col("xn") - shared + 1) & (F.col("yp") <= F.col("yn") - shared + 1)
    return x.join(y, (x["pivot"] == y["pivot"]) & (x["d"] == y["d"]) & may) \
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact Jaccard similarity is high enough."""
    x = pairs.join(sets.select(F.col("h").alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col("h").alias("b"), F.col("shingles").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return x.where(both >= SIMILARITY * (F.size("x") + F.size("y") - both) - 1e-9).select("a", "b")


def _gone_paragraphs(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, text_key, start, n, group_id and kept_doc_id of the paragraphs that go: first whole
    blocks and lines by themselves, then, among what these leave, lines."""
    roots = components(similar_lines(docs, lines.select("doc_id", "text_key", "h", "bands")))
    roots = stage(roots.select(F.col("v").alias("h"), "root"), "dedup-roots")
    spots = lines.select("doc_id", "text_key", "start", "n", "level", "block", "h").join(roots, "h", "left") \
        .withColumn("group_id", F.coalesce("root", "h")).drop("h", "root")
    # only numbers are dealt out to count; what repeats is then read once more
    repeated = spots.groupBy("group_id").agg(F.count("*").alias("size")).where("size > 1").select("group_id")
    spots = stage(spots.join(_small(stage(repeated, "dedup-groups")), "group_id", "left_semi"), "dedup-spots")
    place = ["doc_id", "text_key", "start", "n", "group_id"]
    where = F.struct("doc_id", "text_key", "start")
    outer = spots.where("level < 2")
    kept = outer.groupBy("group_id").agg(F.min(F.struct("doc_id", "text_key", "start", "n", "level")).alias("kept"))
    kept = stage(kept, "dedup-kept-blocks")
    first = F.struct("kept.doc_id", "kept.text_key", "kept.start")
    gone = stage(outer.join(kept, "group_id").where(~where.eqNullSafe(first)).select(*place, "level"), "dedup-gone-blocks")

    block = gone.where("level = 0").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("start").alias("s"))
    inner = spots.where("level = 2").join(block, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
                                          & (F.col("block") == F.col("s")), "left_anti").select(*place)
    rest = stage(inner.unionAll(kept.where("kept.level = 1").select("kept.doc_id", "kept.text_key", "kept.start", "kept.n",
                                                                    "group_id")), "dedup-rest")
    # a block that is kept stands for its group's lines, unless one of them is a part of it
    joined = kept.where("kept.level = 0").select("group_id", "kept")
    part = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_key") == F.col("kept.text_key")) & \
        F.col("start").between(F.col("kept.start"), F.col("kept.start") + F.col("kept.n") - 1)
    own = rest.join(joined, "group_id").where(part).select("group_id").distinct()
    alone = joined.join(own, "group_id", "left_anti").select("group_id", first.alias("stays"))
    stays = rest.groupBy("group_id").agg(F.min(where).alias("line")).join(alone, "group_id", "left") \
        .select("group_id", F.coalesce("stays", "line").alias("stays"))
    stays = stage(stays, "dedup-kept-lines")
    lost = rest.join(stays, "group_id").where(~where.eqNullSafe(F.col("stays"))).select(*place)
    last = kept.join(stays, "group_id", "full").select(
        "group_id", F.when(F.col("stays").isNull(), F.col("kept.doc_id")).otherwise(F.col("stays.doc_id")).alias("kept_doc_id"))
    return gone.select(*place).unionAll(lost).join(stage(last, "dedup-kept"), "group_id") \
        .select("doc_id", "text_key", "start", "n", "group_id", "kept_doc_id").repartition("doc_id", "text_key").distinct()


def _windows(docs: DataFrame, anchors: DataFrame, gone: DataFrame) -> DataFrame:
    """doc_id, text_key, start, h (hash of RUN_WORDS words) of each window that holds a repeated one of the
    ``anchors`` (doc_id, text_key, at, anchors) and no word of a paragraph that goes."""
    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            row, starts, hashes = [], [], []
            for i, (text, at, lost, size) in enumerate(zip(batch.column(2).cast(pa.binary()).to_pylist(),
                                                           *(batch.column(c).to_pylist() for c in (3, 4, 5)))):
                w = word_hashes(text.lower().split())
                n = len(w) - RUN_WORDS + 1
                if n < 1:
                    continue
                at, near = np.array(at, np.int64), np.zeros(n + 1, np.int64)
                np.add.at(near, np.clip(at - (RUN_WORDS - ANCHOR), 0, n), 1)
                np.add.at(near, np.clip(at + 1, 0, n), -1)
                out = np.zeros(len(w) + 1, np.int64)
                for a, k in zip(lost or [], size or []):
                    out[a + 1:a + k + 1] = 1
                out = np.cumsum(out)
                some = np.nonzero((np.cumsum(near)[:n] > 0) & (out[RUN_WORDS:] == out[:n]))[0]
                row.append(np.full(len(some), i))
                starts.append(some)
                hashes.append(shingle_hashes(w, RUN_WORDS)[some])
            row, starts, hashes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, starts, hashes))
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row),
                                              pa.array(starts.astype(np.int32)), pa.array(hashes.view(np.int64))],
                                             ["doc_id", "text_key", "start", "h"])

    often = anchors.select(F.explode("anchors").alias("h")).groupBy("h").agg(F.count("*").alias("size"))
    often = stage(often.where("size > 1").select("h"), "dedup-often")
    # as many as a text has words
    each = anchors.select("doc_id", "text_key", F.explode(F.arrays_zip("at", "anchors")).alias("x"))
    want = each.select("doc_id", "text_key", F.col("x.at").alias("start"), F.col("x.anchors").alias("h")).join(_small(often), "h", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set("start").alias("at")) \
        .select(F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key"), "at")
    lost = gone.groupBy("doc_id", "text_key").agg(F.collect_list("start").alias("lost"), F.collect_list("n").alias("size"))
    want = want.join(lost, F.col("want_id").eqNullSafe(F.col("doc_id")) & (F.col("want_key") == F.col("text_key")), "left") \
        .select("want_id", "want_key", "at", "lost", "size")
    want = stage(want, "dedup-want")
    texts = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    on = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_key") == F.col("want_key"))
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return texts.join(want, on).select("doc_id", "text_key", "text", "at", "lost", "size") \
        .mapInArrow(make, f"doc_id {kind}, text_key long, start int, h long")


def _gone_passages(windows: DataFrame) -> DataFrame:
    """Spans of words each of whose windows occurs at an earlier place; one is a copy of successive
    words of one text, or of its own text's."""
    where = F.struct("doc_id", "text_key", "start")
    kept = windows.groupBy("h").agg(F.min(where).alias("kept"), F.count("*").alias("size")).where("size > 1").drop("size")
    gone = windows.join(stage(kept, "dedup-kept-windows"), "h").where(~where.eqNullSafe(F.col("kept")))
    # dealt out by text at once, so that the join may split a hot window; rows alike count once
    gone = gone.repartition("doc_id", "text_key").dropDuplicates(["doc_id", "text_key", "start"])
    text = Window.partitionBy("doc_id", "text_key").orderBy("start")
    own = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_key") == F.col("kept.text_key"))
    on = (F.col("before.start") + 1 == F.col("start")) & F.col("before.kept.doc_id").eqNullSafe(F.col("kept.doc_id")) & \
        (F.col("before.kept.text_key") == F.col("kept.text_key")) & \
        (own | (F.col("before.kept.start") + 1 == F.col("kept.start")))
    # where a text overlaps its own copy, as one word over and over does, the first copy stays whole
    begin = F.when(own, F.greatest("start", F.col("kept.start") + RUN_WORDS)).otherwise(F.col("start"))
    return gone.withColumn("before", F.lag(F.struct("start", "kept")).over(text)) \
        .withColumn("new", F.when(on, 0).otherwise(1)).withColumn("run", F.sum("new").over(text)) \
        .withColumn("begin", begin).groupBy("doc_id", "text_key", "run").agg(
            F.min("begin").alias("start"), (F.max("start") + RUN_WORDS).alias("end"),
            F.min(F.struct("start", F.col("h").alias("group_id"), F.col("kept.doc_id").alias("kept_doc_id"))).alias("f")) \
        .select("doc_id", "text_key", "start", (F.col("end") - F.col("start")).cast("int").alias("n_words"),
                "f.group_id", "f.kept_doc_id")


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, start, n_words, what ('paragraph' or 'passage'), group_id and kept_doc_id of
    every span of words that goes. Spans of one text may overlap."""
    found = stage(units(docs), "dedup-units")
    gone = stage(_gone_paragraphs(docs, found.where("line")), "dedup-gone")
    windows = stage(_windows(docs, found.where("not line").select("doc_id", "text_key", "at", "anchors"), gone), "dedup-windows")
    runs = stage(_gone_passages(windows), "dedup-runs")
    place = ["doc_id", "text_key", "start"]
    return gone.select(*place, F.col("n").alias("n_words"), F.lit("paragraph").alias("what"), "group_id", "kept_doc_id") \
        .unionAll(runs.select(*place, "n_words", F.lit("passage").alias("what"), "group_id", "kept_doc_id"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_words, what, group_id, kept_doc_id of every span that goes."""
    return removals(docs).select("doc_id", "start", "n_words", "what", "group_id", "kept_doc_id")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated spans taken out of their texts; texts of which no word is left go.

    ``n_chars``, where there is such a column, is counted anew for texts that change."""
    import pandas as pd
    spans = removals(docs).groupBy("doc_id", "text_key") \
        .agg(F.sort_array(F.collect_list(F.struct("start", "n_words"))).alias("_spans"))   # bounded by the text
    spans = stage(spans, "dedup-spans")

    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        import re
        word = re.compile("[^\x20\x09-\x0d]+")
        out = []
        for t, gone in zip(text, spans):
            if t is None:
                out.append(None)
                continue
            bounds = [m.span() for m in word.finditer(t)]
            kept, at = [], 0
            for s in gone:
                a, b = s["start"], s["start"] + s["n_words"]
                if b <= at:
                    continue
                a = max(a, at)
                kept.append(t[bounds[at][0] if at else 0:bounds[a][0]] if a > at else "")
                at = b
            kept.append(t[bounds[at][0]:] if at < len(bounds) else "")
            out.append("".join(kept))
        return pd.Series(out)

    cut.__annotations__ = {"text": pd.Series, "spans": pd.Series, "return": pd.Series}
    cut = F.pandas_udf(cut, "string")
    id_, key, gone, cut_ = (free_name(docs, c) for c in ("spans_id", "text_key", "spans", "text_cut"))
    rows = docs.withColumn(key, F.xxhash64(text_or_empty()))
    spans = spans.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("_spans").alias(gone))
    rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col(id_)) & (rows[key] == spans[key]), "left")
    touched = F.col(gone).isNotNull()
    # texts that lose nothing are not sent to Python
    rows = rows.withColumn(cut_, cut(F.when(touched, F.col("text").cast("string")), F.when(touched, F.col(gone))))
    blank = F.length(F.trim(F.translate(cut_, "\t\n\x0b\f\r", "     "))) == 0
    rows = rows.where(F.col(cut_).isNull() | ~blank)
    new = {"text": F.coalesce(cut_, "text").alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.char_length(cut_).cast(kind), F.col("n_chars")).alias("n_chars")
    return rows.select(*(new.get(c, c) for c in docs.columns))
