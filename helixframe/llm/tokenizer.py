"""Public byte-level BPE files: loading, pre-tokens, merging of single pre-tokens, cached encoding.

The library's ``encode`` spends most of its time around the merges (copies, offsets, one call per text). Here
texts are cut into pre-tokens by an equal pattern of the standard library, and each distinct pre-token is
merged once by the library's own model while it stays in a cache.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
from array import array
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

# The pre-token pattern of the byte-level files (public_tokenizers.PATTERN) in the words of Python's ``re``:
# letters are word characters that are no digits, other characters are neither blank nor word, or are ``_``.
PRE_TOKEN = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# Both patterns agree on Latin, Greek and Cyrillic, but for digits that are no decimals. Chunks with any other
# character are left to the library, whose Unicode tables may be of another age than Python's.
OTHER = re.compile("[²³¹¼½¾Ԥ-\U0010ffff]")
# A run of non-blanks with the one space before it, or blanks: no pre-token crosses these borders.
CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Blanks for Python that the library takes for ordinary characters.
ODD_BLANKS = re.compile("[\x1c-\x1f]")

# Pre-tokens that a worker remembers, and how long they may be.
CACHED, CACHED_LENGTH = 500_000, 48


@lru_cache(maxsize=2)
def load(path: str = BYTE_BPE) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def special_strings(path: str = BYTE_BPE) -> tuple[str, ...]:
    return tuple(t.content for t in load(path).get_added_tokens_decoder().values())


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary, as a table for ``str.translate``:
    printable Latin-1 characters stand for themselves, other bytes for code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def is_plain(text: str, path: str = BYTE_BPE) -> bool:
    """True if the pattern cuts the text as the library does: no special string, odd blank or other character."""
    return not (OTHER.search(text) or ODD_BLANKS.search(text) or any(s in text for s in special_strings(path)))


def pre_tokens(text: str, path: str = BYTE_BPE) -> list[str]:
    """Pieces of ``text``, joined again the text itself, that are encoded independently of each other.

    They are pre-tokens, but for chunks with characters left to the library, and for texts with a special
    string (blanks before it belong together) or an odd blank, which stay whole.
    """
    if is_plain(text, path):
        return PRE_TOKEN.findall(text)
    if ODD_BLANKS.search(text) or any(s in text for s in special_strings(path)):
        return [text]
    out = []
    for chunk in CHUNK.findall(text):
        if OTHER.search(chunk):
            out.append(chunk)
        else:
            out.extend(PRE_TOKEN.findall(chunk))
    return out


class Merger:
    """Merges single pieces with the library, and remembers what ``of_ids`` makes of their ids.

    ``fixed`` entries stay. The others live in two generations of half the limit each: a full one becomes the
    older one, whose entries move back when they are asked for, so that frequent pieces are not merged again.
    """

    def __init__(self, of_ids, fixed: dict | None = None, path: str = BYTE_BPE, limit: int = CACHED):
        self.of_ids, self.fixed, self.path, self.half = of_ids, fixed or {}, path, max(1, limit // 2)
        self.model, self.letters = load(path).model, byte_letters()
        self.young, self.old = dict(self.fixed), {}

    def _new(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            if is_plain(piece, self.path):
                ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
            else:
                ids = load(self.path).encode(piece, add_special_tokens=False).ids
            found = self.of_ids(ids)
        if len(piece) <= CACHED_LENGTH:
            if len(self.young) - len(self.fixed) >= self.half:
                self.young, self.old = dict(self.fixed), self.young
            self.young[piece] = found
        return found

    def __call__(self, pieces: list[str]) -> list:
        found = list(map(self.young.get, pieces))
        if None in found:  # every piece makes at least one id, so that no found value is false
            found = [f or self.young.get(p) or self._new(p) for f, p in zip(found, pieces, strict=True)]
        return found


class CachedEncoder:
    """Ids of whole texts, as unsigned integers of type code ``kind`` in little-endian order."""

    def __init__(self, path: str = BYTE_BPE, kind: str = "I", limit: int = CACHED):
        self.path = path
        self.merge = Merger(lambda ids: self._bytes(kind, ids), path=path, limit=limit)

    @staticmethod
    def _bytes(kind: str, ids: list[int]) -> bytes:
        out = array(kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(self.merge(pre_tokens(text, self.path)))


@lru_cache(maxsize=1)
def worker_encoder(path: str = BYTE_BPE, kind: str = "I") -> CachedEncoder:
    """The encoder that the tasks of one Python worker share."""
    return CachedEncoder(path, kind)


def give_back() -> None:
    """Drop what this Python worker holds of tokenizers and return freed memory to the system.

    Spark hands a worker from stage to stage; without this, pre-tokens and vocabularies of a stage that has ended count
    beside all that follows in the executor.
    """
    for held in (worker_encoder, special_strings, load):
        held.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)
