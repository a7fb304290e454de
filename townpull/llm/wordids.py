"""Token ids of whole texts by the tokenizers library, with bounded caches of words.

The byte-level pre-tokenizer never lets a token run across the place before a space that
is followed by a character other than white space, so a text can be cut there, each part
encoded once, and the ids joined. Parts that start with white space (runs of blanks) stay
with the part before. A part made of plain runs of letters, digits or marks is cut into
these pre-tokens, which the library's BPE model gets directly; every other part, and every
text that holds the string of a special token, goes through the library's full ``encode``.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

from townpull.llm.common import worker_cache

MAX_ENTRIES = 500_000   # of a generation of a cache; when it is full the one before is dropped
LONG = 60               # longer pieces are encoded but not cached
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"   # letters whose class no Unicode version changes
MARKS = "!-&(-/:-@\\[-`{-~"     # ASCII marks without the apostrophe
# runs that are pre-tokens of their own whatever follows them
PLAIN = re.compile(f" ?[{LETTERS}]+| ?[0-9]+| ?[{MARKS}]+|\n(?=[{LETTERS}0-9{MARKS}])")


def byte_letters() -> list[str]:
    """The printable character that byte-level BPE uses for each byte: the byte's own
    Latin-1 character where that is visible, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    out, free = [chr(b) for b in range(256)], 256
    for b in range(256):
        if b not in shown:
            out[b], free = chr(free), free + 1
    return out


class WordIds:
    """Ids as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_letters()))
        self.model = self.lib.model
        self.packed = [struct.Struct(f"<{n}I").pack for n in range(16)]
        self.known: dict[str, bytes] = {}   # plain pre-tokens
        self.older: dict[str, bytes] = {}   # the generation before; what is met again moves up
        self.odd: dict[str, bytes] = {}     # other parts, without the space before them

    def whole(self, text: str) -> bytes:
        ids = self.lib.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, runs: list[str]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, runs))
        if None in found:
            for i, f in enumerate(found):
                if f is None:
                    s = runs[i]
                    f = known.get(s)
                    if f is None:
                        f = self.older.get(s)
                        if f is None:
                            f = self._merge(s)
                        if len(s) <= LONG:
                            if len(known) >= MAX_ENTRIES:
                                self.older, self.known = known, {}
                                known = self.known
                            known[s] = f
                    found[i] = f
        return found

    def _merge(self, s: str) -> bytes:
        spelt = s.encode().decode("latin-1").translate(self.letters)   # a character for each byte
        ids = [t.id for t in self.model.tokenize(spelt)]
        return self.packed[len(ids)](*ids) if len(ids) < len(self.packed) else struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        """Ids of a part that starts the text or follows a cut, its space included."""
        runs = PLAIN.findall(part)
        if "".join(runs) == part:
            return b"".join(self._plain(runs))
        got = self.odd.get(part)
        if got is None:
            got = self.whole(part)
            if len(part) <= LONG:
                if len(self.odd) >= MAX_ENTRIES // 8:
                    self.odd.clear()
                self.odd[part] = got
        return got

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        runs = PLAIN.findall(text)
        if "".join(runs) == text:
            return b"".join(self._plain(runs))
        pieces = [""]
        for p in text.split(" "):
            if p and not p[0].isspace():
                pieces.append(" " + p)
            else:  # a run of white space: keep it together
                pieces[-1] += " " + p
        pieces = [p for p in pieces if p]
        pieces[0] = pieces[0][1:]  # the split put a space before the first part, too
        return b"".join(self._part(p) for p in pieces if p)


def word_ids(path: str) -> WordIds:
    """The encoder of this Python worker for a vocabulary file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    cache = worker_cache("word_ids")
    if path not in cache:
        cache[path] = WordIds(path)
    return cache[path]


def crc(b: bytes) -> int:
    return zlib.crc32(b) & 0xFFFFFFFF
