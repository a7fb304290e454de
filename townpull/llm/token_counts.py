"""Token counts (operator 3): byte-pair merging with a heap and a linked list.

A text is cut where no merge can reach across; in each piece the adjacent pair of the
lowest rank is popped again and again (leftmost first on ties) until none is left. The
count is the number of symbols at the start minus the merges; characters outside the
vocabulary count one symbol for each UTF-8 byte. No ids are made.

Nulls and empty texts: 0 tokens, 0 bytes. Repeated rows are counted each. A null doc_id is
kept as null. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import text_or_empty, tokenizer_path, worker_cache

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MAX_ENTRIES = 400_000   # of the worker's cache of pieces; a full one is emptied and refilled
LONG = 200              # longer pieces are merged each time they occur


class MergeCounter:
    """Counts by a table of pieces and their scores (a higher score is merged earlier)."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.known: dict[str, int] = {}
        joined = {c for p in ranks if len(p) > 1 for c in p}
        # characters that only stand alone cut a text; so does a space after anything but a space
        self.apart = "".join(c for c in "\n\r\t" if c not in joined)
        inner = any(SPACE in p.lstrip(SPACE) for p in ranks)
        self.cut = re.compile("\0never" if inner else
                              f"[{re.escape(self.apart)}]|{SPACE}*[^{SPACE}{re.escape(self.apart)}]+|{SPACE}+"
                              if self.apart else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.whole = inner

    def merged(self, s: str) -> int:
        """Symbols that remain of one piece."""
        n, ranks = len(s), self.ranks
        left = list(range(-1, n - 1))
        right = [*range(1, n), -1]
        end = list(range(1, n + 1))          # symbol i is s[i:end[i]]; 0 marks one merged away
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            r = ranks.get(s[i:end[j]]) if j >= 0 else None
            if r is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

        for i in range(n - 1):
            offer(i)
        merges = 0
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = right[i]
            if end[i] != mid or j < 0 or end[j] != stop:
                continue                      # one of the two has changed since
            end[i], end[j] = stop, 0
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
            merges += 1
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        lost = sum(len(c.encode()) - 1 for i, c in enumerate(s) if end[i] == i + 1 and c not in ranks)
        return n - merges + lost

    def piece(self, s: str) -> int:
        got = self.known.get(s)
        if got is None:
            got = self.merged(s)
            if len(s) <= LONG:
                if len(self.known) >= MAX_ENTRIES:
                    self.known.clear()
                self.known[s] = got
        return got

    def count(self, text: str) -> int:
        if not text:
            return 0
        spaced = SPACE + text.replace(" ", SPACE)
        if self.whole:
            return self.merged(spaced)
        pieces = self.cut.findall(spaced)
        found = list(map(self.known.get, pieces))
        if None in found:
            return sum(f if f is not None else self.piece(p) for f, p in zip(found, pieces))
        return sum(found)


def piece_ranks(path: str) -> dict[str, float]:
    """Merge order of a sentencepiece BPE vocabulary: piece -> rank, the lowest merges first.

    Only models that leave the text as it is (identity normalizer, one space put in front,
    byte fallback) are taken; others raise.
    """
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "  Á Ａ\n ."
    if m.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model changes texts; this counter does not")
    n = m.get_piece_size()
    if not any(m.is_byte(i) for i in range(n)):
        raise ValueError("the model has no byte fallback")
    return {m.id_to_piece(i): -m.get_score(i) for i in range(n)
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}


def worker_counter(path: str) -> MergeCounter:
    cache = worker_cache("merge_counter")
    if path not in cache:
        cache[path] = MergeCounter(piece_ranks(path))
    return cache[path]


def token_counts(docs: DataFrame, limit: int = 4096, model: str = MODEL, folder: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text of ``docs`` (doc_id, text)."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        counter = worker_counter(tokenizer_path(model, folder))
        for b in batches:
            ns = [counter.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(ns, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"),
                       F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
