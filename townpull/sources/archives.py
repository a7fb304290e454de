"""Zip archives as a Spark data source: a partition for every member, read by range.

The central directory at an archive's end says where each member's bytes lie. It is read once
when the scan is planned; a task then opens the archive, goes to its member and inflates it block
by block, so that members of one archive are read by several tasks and none holds more than
a block and a batch of lines, however large the archive or the member. Checksums are verified.

The file system must be one that pyarrow reads by itself (``readable_here`` tells); archives
elsewhere go through Spark's binary-file source (``files.inflate_archives``).
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 1 << 20         # packed bytes read at a time
INFLATED = 4 << 20      # bytes inflated at a time
FORMAT = "zipped_text"


def pyarrow_uri(uri: str) -> str:
    """Hadoop writes file:/x, pyarrow reads file:///x."""
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def readable_here(uri: str) -> bool:
    """Whether pyarrow knows the file system of a qualified path."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    try:
        pafs.FileSystem.from_uri(pyarrow_uri(uri))
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


@dataclass
class Member(InputPartition):
    uri: str
    name: str
    offset: int      # of its local header
    packed: int      # bytes
    method: int
    crc: int


def members(uri: str, suffix: str) -> list[Member]:
    """The members of an archive whose names end with ``suffix``."""
    import zipfile

    import pyarrow.fs as pafs
    fs, path = pafs.FileSystem.from_uri(pyarrow_uri(uri))
    with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
        found = [i for i in z.infolist() if i.filename.endswith(suffix) and not i.is_dir()]
    for i in found:
        if i.flag_bits & 1:
            raise ValueError(f"{i.filename} in {uri} is encrypted")
        if i.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise ValueError(f"{i.filename} in {uri} is packed by method {i.compress_type}; only stored and deflated members are read")
    return [Member(uri, i.filename, i.header_offset, i.compress_size, i.compress_type, i.CRC) for i in found]


def inflated(m: Member) -> Iterator[bytes]:
    """The member's bytes, in pieces of bounded size."""
    import pyarrow.fs as pafs
    fs, path = pafs.FileSystem.from_uri(pyarrow_uri(m.uri))
    with fs.open_input_file(path) as f:
        f.seek(m.offset)
        name, extra = struct.unpack("<26x2H", f.read(30))
        f.seek(m.offset + 30 + name + extra)
        left, crc = m.packed, 0
        engine = zlib.decompressobj(-zlib.MAX_WBITS) if m.method else None
        while left:
            block = f.read(min(BLOCK, left))
            if not block:
                raise ValueError(f"{m.name} in {m.uri} ends early")
            left -= len(block)
            while block:
                piece = engine.decompress(block, INFLATED) if engine else block
                block = engine.unconsumed_tail if engine else b""
                crc = zlib.crc32(piece, crc)
                yield piece
        if engine:
            piece = engine.flush()
            crc = zlib.crc32(piece, crc)
            yield piece
        if crc != m.crc:
            raise ValueError(f"{m.name} in {m.uri} is damaged")


def lines(pieces: Iterator[bytes]) -> Iterator[list[str]]:
    """Lists of whole lines, without their ends."""
    rest: list[bytes] = []
    for piece in pieces:
        first, *more = piece.split(b"\n")
        rest.append(first)
        if more:
            rows = [b"".join(rest), *more[:-1]]
            rest = [more[-1]]
            yield [r.rstrip(b"\r").decode("utf-8", "replace") for r in rows]
    last = b"".join(rest)
    if last:
        yield [last.rstrip(b"\r").decode("utf-8", "replace")]


class ZippedTextReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options.get("archives", "[]"))
        self.suffix = options.get("membersuffix", options.get("memberSuffix", ".txt"))
        self.rows = int(options.get("batchrows", options.get("batchRows", 50_000)))

    def partitions(self):
        return [m for uri in self.paths for m in members(uri, self.suffix)]

    def read(self, partition):
        import pyarrow as pa
        if not isinstance(partition, Member):   # a scan without partitions
            return

        def batch(values):
            return pa.RecordBatch.from_arrays([pa.array([partition.uri] * len(values), pa.string()),
                                               pa.array([partition.name] * len(values), pa.string()),
                                               pa.array(values, pa.string())], ["source", "member", "value"])

        for some in lines(inflated(partition)):
            for at in range(0, len(some), self.rows):
                yield batch(some[at:at + self.rows])


class ZippedText(DataSource):
    """Lines (source, member, value) of the members of ``archives`` (a JSON list of qualified paths)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "source string, member string, value string"

    def reader(self, schema):
        return ZippedTextReader(self.options)
