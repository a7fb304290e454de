"""Token-id files (operator 7): interleaved range asymmetric numeral systems.

Documents are dealt by ranges of doc_id and sorted, so that the files hold the ids in
ascending order. Each range is cut into blocks of whole documents. One table of symbol
frequencies, counted over all documents and scaled to a power of two, is shared by all
blocks. A block is coded by ``LANES`` interleaved coder states: id i belongs to lane
i mod LANES, so one step codes LANES ids at once. After every ``EVERY`` steps the states and
the place in the word stream are kept as a checkpoint from which a reader can decode on
without what lies before; a CRC-32 of the words and one of the ids guard each block.

The files are Parquet written by Spark: ``table`` (symbol, frequency) and ``blocks`` (range,
block, place of its first id in the range, documents, checkpoints, words, checksums).

Null and empty texts are one end id. Repeated doc_ids are written each, in the order of
their texts' length and hash. Rows without a doc_id come first. Extra columns are ignored. An
empty table gives files without blocks and an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpull.llm.common import slices, stage, text_or_empty, tokenizer_path
from townpull.llm.wordids import crc, word_ids
from townpull.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
LANES = 4096
EVERY = 128            # steps between checkpoints
BLOCK_IDS = 1 << 20    # a block is closed once it has so many ids
PRECISION = 20         # bits of the frequency table's total
LOW = 1 << 31          # states lie in [LOW, LOW << 32)


def scaled_frequencies(counts: dict[int, int], precision: int = PRECISION) -> dict[int, int]:
    """Frequencies of at least 1 in proportion to ``counts`` whose sum is 2**precision."""
    if not counts:
        return {}
    total, room = sum(counts.values()), 1 << precision
    if len(counts) > room:
        raise ValueError("more symbols than the table's total")
    out = {s: max(1, n * room // total) for s, n in counts.items()}
    rest = room - sum(out.values())
    for s in sorted(out, key=lambda s: (-counts[s], s)):   # the most frequent give or take the difference
        step = rest if rest > 0 else -min(-rest, out[s] - 1)
        out[s] += step
        rest -= step
        if not rest:
            break
    return out


class Tables:
    """Frequencies and first slots by symbol, and the symbol of each slot."""

    def __init__(self, frequencies: dict[int, int]):
        import numpy as np
        symbols = np.array(sorted(frequencies), np.int64)
        f = np.array([frequencies[int(s)] for s in symbols], np.uint64)
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.f, self.first = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.f[symbols] = f
        self.first[symbols] = np.concatenate(([0], np.cumsum(f)[:-1])) if len(symbols) else 0
        self.slot = np.repeat(symbols, f.astype(np.int64)).astype(np.uint32)


def encode_block(ids, t: Tables, precision: int = PRECISION, lanes: int = LANES, every: int = EVERY):
    """Words (little-endian 32-bit bytes) and checkpoints [(step, word, states bytes), ...]; the
    first checkpoint is the block's start."""
    import numpy as np
    n = len(ids)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    shift, out, marks = np.uint64(precision), [], []
    symbols = np.asarray(ids).astype(np.intp)   # once a block, not at each look-up
    words = 0
    for step in range(steps - 1, -1, -1):
        s = symbols[step * lanes:(step + 1) * lanes]
        x, f = state[:len(s)], t.f.take(s)
        over = np.flatnonzero(x >> np.uint64(63 - precision) >= f)
        if len(over):
            high = x.take(over)
            out.append(high.astype("<u4"))   # the low 32 bits
            words += len(over)
            x[over] = high >> np.uint64(32)
        # (q << shift) + (x - q * f) + first
        state[:len(s)] = x + x // f * ((np.uint64(1) << shift) - f) + t.first.take(s)
        if step % every == 0:
            marks.append((step, words, state.astype("<u8").tobytes()))
    stream = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    return stream.tobytes(), [(step, words - w, b) for step, w, b in reversed(marks)]


def decode_block(stream: bytes, marks, n: int, t: Tables, precision: int = PRECISION, lanes: int = LANES,
                 start: int = 0, stop: int | None = None):
    """The ids of a block from checkpoint ``start`` up to checkpoint ``stop`` (None: the end)."""
    import numpy as np
    words = np.frombuffer(stream, "<u4")
    step, at, b = marks[start]
    last = -(-n // lanes) if stop is None else marks[stop][0]
    begin = step * lanes
    ids = np.empty(max(0, min(n, last * lanes) - begin), np.uint32)
    state = np.frombuffer(b, "<u8").copy()
    low_bits, shift = np.uint64((1 << precision) - 1), np.uint64(precision)
    for step in range(step, last):
        m = min(lanes, n - step * lanes)
        x = state[:m]
        slot = x & low_bits
        s = t.slot.take(slot.view(np.intp))
        ids[step * lanes - begin:step * lanes - begin + m] = s
        s = s.astype(np.intp)
        x = t.f.take(s) * (x >> shift) + slot - t.first.take(s)
        under = np.flatnonzero(x < np.uint64(LOW))
        if len(under):
            x[under] = x.take(under) << np.uint64(32) | words[at:at + len(under)]
            at += len(under)
        state[:m] = x
    return ids


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def make_blocks(docs: DataFrame, end_id: int = END_ID, vocabulary: str = VOCABULARY, folder: str | None = None,
                block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order within and between ranges, with their
    ids (little-endian 16-bit where the vocabulary allows, else 32-bit).

    The texts are dealt before they are encoded: the sample from which Spark takes the ranges
    then costs a scan and not a second run of the tokenizer."""
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = word_ids(tokenizer_path(vocabulary, folder))
        packed = id_type(encoder.lib.get_vocab_size())
        end = end_id.to_bytes(4, "little")
        part, block, place = TaskContext.get().partitionId(), 0, 0
        names, lengths, ids, size = [], [], [], 0
        kind = pa.int64()

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([place], pa.int64()),
                 pa.array([names], pa.list_(kind)), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([b"".join(ids)], pa.binary())],
                ["part", "block", "place", "doc_ids", "lengths", "ids"])

        for b in batches:
            kind = b.column(0).type
            for some in slices(b):
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    x = np.frombuffer(encoder.ids(text) + end, "<u4")
                    names.append(doc)
                    lengths.append(len(x))
                    ids.append(x.astype(packed).tobytes())
                    size += len(x)
                    if size >= block_ids:
                        yield row()
                        block, place = block + 1, place + size
                        names, lengths, ids, size = [], [], [], 0
        if names:
            yield row()

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    order = [F.col("doc_id"), F.octet_length("text"), F.xxhash64("text")]
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        cut, f"part int, block int, place long, doc_ids array<{kind}>, lengths array<long>, ids binary")


def count_symbols(blocks: DataFrame, kind: str) -> DataFrame:
    """(symbol, n) over all blocks."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        n = np.zeros(0, np.int64)
        for b in batches:
            for x in b.column(0):
                more = np.bincount(np.frombuffer(x.as_buffer(), kind))
                if len(more) > len(n):
                    n, more = more, n
                n[:len(more)] += more
        s = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(n[s], pa.int64())], ["symbol", "n"])

    return blocks.select("ids").mapInArrow(count, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str = VOCABULARY,
                 folder: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``path``."""
    spark = docs.sparkSession
    from tokenizers import Tokenizer
    kind = id_type(Tokenizer.from_file(tokenizer_path(vocabulary, folder)).get_vocab_size())
    blocks = stage(make_blocks(docs, end_id, vocabulary, folder, block_ids), "token-blocks")
    # bounded by the vocabulary
    frequencies = scaled_frequencies({r["symbol"]: r["n"] for r in count_symbols(blocks, kind).collect()})
    spark.createDataFrame(sorted(frequencies.items()), "symbol int, frequency long").coalesce(1) \
        .write.parquet(os.path.join(path, "table"))

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        t = Tables(frequencies)
        mark = pa.list_(pa.struct([("step", pa.int64()), ("word", pa.int64()), ("states", pa.binary())]))
        for b in batches:
            for i in range(b.num_rows):
                ids = np.frombuffer(b.column("ids")[i].as_buffer(), kind)
                words, marks = encode_block(ids, t)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, 1) for c in ("part", "block", "place", "doc_ids", "lengths")),
                     pa.array([len(ids)], pa.int64()), pa.array([[{"step": s, "word": w, "states": x} for s, w, x in marks]], mark),
                     pa.array([words], pa.binary()), pa.array([crc(words)], pa.int64()),
                     pa.array([crc(ids.astype("<u4").tobytes())], pa.int64())],
                    ["part", "block", "place", "doc_ids", "lengths", "n_ids", "marks", "words", "words_crc32", "ids_crc32"])

    doc = blocks.schema["doc_ids"].dataType.simpleString()
    blocks.mapInArrow(encode, f"part int, block int, place long, doc_ids {doc}, lengths array<long>, n_ids long, "
                              "marks array<struct<step:long,word:long,states:binary>>, words binary, "
                              "words_crc32 long, ids_crc32 long") \
        .write.option("compression", "none").parquet(os.path.join(path, "blocks"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (and the ids)."""
    # bounded by the vocabulary
    frequencies = {r["symbol"]: r["frequency"] for r in spark.read.parquet(os.path.join(path, "table")).collect()}
    blocks = spark.read.parquet(os.path.join(path, "blocks"))

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        t = Tables(frequencies)
        for b in batches:
            for i in range(b.num_rows):
                words, n = b.column("words")[i].as_py(), b.column("n_ids")[i].as_py()
                if crc(words) != b.column("words_crc32")[i].as_py():
                    raise ValueError("a block's words are damaged")
                marks = [(m["step"], m["word"], m["states"]) for m in b.column("marks")[i].as_py()]
                ids = decode_block(words, marks, n, t).astype("<u4")
                if crc(ids.tobytes()) != b.column("ids_crc32")[i].as_py():
                    raise ValueError("a block's ids are damaged")
                lengths = np.array(b.column("lengths")[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = memoryview(ids.tobytes())
                cuts = [raw[4 * a:4 * e] for a, e in zip(starts.tolist(), ends.tolist())]
                k = len(lengths)
                out = [pa.array([b.column("part")[i].as_py()] * k, pa.int32()), b.column("doc_ids").slice(i, 1).flatten(),
                       pa.array(starts + b.column("place")[i].as_py()), pa.array(lengths), pa.array(map(crc, cuts), pa.int64())]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([np.frombuffer(c, "<u4").tolist() for c in cuts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    more = ", ids array<long>" if with_ids else ""
    rows = blocks.mapInArrow(decode, f"part int, doc_id {kind}, start long, n_tokens long, ids_crc32 long{more}")
    # one row per range, as many as there are write tasks
    sizes = sorted(blocks.groupBy("part").agg(F.max(F.col("place") + F.col("n_ids")).alias("n")).collect())
    bases, base = [], 0
    for r in sizes:
        bases.append((r["part"], base))
        base += r["n"]
    parts = spark.createDataFrame(bases, "part int, base long")
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("base")).drop("part", "base")


def token_file_index(docs: DataFrame) -> DataFrame:
    """Write the files of ``docs`` to a new shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids_crc32")
