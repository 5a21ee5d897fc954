"""K-mers of many sequences at a time, cut by numpy from Arrow batches.

A column expression reads a sequence from its front for every k-mer that it cuts; here the codes of all places of a
batch come from a few additions over whole arrays. The codes are those of ``seq.kmer_code``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bases, and k-mers, that are held as arrays at a time.
PIECE = 1 << 20
# A filter has so many bits a code or more, in chunks of 1 << CHUNK_BITS; eight times as many up to 1 << FREE_BITS (16 MB),
# and at most 1 << MOST_BITS (128 MB).
BITS_PER_CODE, CHUNK_BITS, FREE_BITS, MOST_BITS = 8, 20, 27, 30

_DIGIT = np.full(256, 4, np.uint8)
_DIGIT[[ord(c) for c in "ACGT"]] = range(4)


def _codes(digits: np.ndarray, k: int) -> np.ndarray:
    """The code of the ``k`` digits from every place on, joined from those of 1, 2, 4, ... digits."""
    base = 10 if k <= 18 else 4
    n = len(digits) - k + 1
    width, part, done, codes = 1, digits.astype(np.int64), 0, None
    while True:
        if k & width:
            # ``width`` digits more, behind those that are done
            more = part[done:done + n]
            codes = more if codes is None else codes * base**width + more
            done += width
        if done == k:
            return codes[:n]
        part = part[:-width] * base**width + part[width:]
        width *= 2


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all sequences, one behind the other, and where each begins (and the last ends); a null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    letters = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    if len(letters) and letters.max() > 127:   # a letter is a place, whatever its bytes
        return _sequences(pa.array([s.encode("ascii", "replace").decode() for s in column.to_pylist()], pa.large_string()))
    return _DIGIT[letters], at - at[0]


def _cut(batch: pa.RecordBatch, carry: list[str], k: int, stride: int, limit: int | None, both: bool, first: str | None,
         kept: tuple[np.ndarray, int] | None) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Row, strand, place and code of the k-mers of a batch, some million at a time."""
    digits, begin = _sequences(batch.column(len(carry)))
    lengths = np.diff(begin)
    own = np.maximum(lengths - k + 1, 0)
    if limit is not None:
        own = np.minimum(own, limit)
    counts = -(-own // stride)
    ends = np.cumsum(counts)
    row = 0
    while row < len(counts):
        done = ends[row - 1] if row else 0
        to = max(row + 1, int(min(np.searchsorted(ends, done + PIECE, "right"), np.searchsorted(begin, begin[row] + PIECE, "right") - 1)))
        n = counts[row:to]
        if n.sum():
            some = digits[begin[row]:begin[to]]
            rows = np.repeat(np.arange(row, to), n)
            places = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * stride
            for strand in (0, 1) if both else (0,):
                if strand:
                    some = np.where(some < 4, 3 - some, 4)[::-1]
                    where = (begin[to] - begin[1:][rows]) + places
                else:
                    where = begin[rows] - begin[row] + places
                codes = _codes(some, k)[where]
                good = None
                unknown = some > 3
                if unknown.any():
                    before = np.concatenate([[0], np.cumsum(unknown)])
                    good = before[where + k] == before[where]
                if first is not None:
                    begins = some[where] == _DIGIT[ord(first)]
                    good = begins if good is None else good & begins
                if kept is not None:
                    slots = _slots(codes, kept[1])
                    held = (kept[0][slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    good = held if good is None else good & held
                yield (rows, strand, places, codes) if good is None else (rows[good], strand, places[good], codes[good])
        row = to


def _rows(batches, carry: list[str], k: int, stride: int, limit: int | None, both: bool, first: str | None, keep, names: list[str]):
    kept = None if keep is None else (np.frombuffer(keep[0].value, np.uint8), keep[1])
    for batch in batches:
        for rows, strand, places, codes in _cut(batch, carry, k, stride, limit, both, first, kept):
            columns = [batch.column(i).take(pa.array(rows)) for i in range(len(carry))]
            columns += [pa.array(np.full(len(rows), strand, np.int32))] if both else []
            columns += [pa.array(places.astype(np.int32)), pa.array(codes)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def cut_kmers(df: DataFrame, carry: list[str], k: int, place: str, stride: int = 1, limit: int | None = None, both: bool = False,
              first: str | None = None, keep=None) -> DataFrame:
    """A row per k-mer of ``seq`` over A, C, G and T: ``carry``, ``strand`` (with ``both``: of the sequence and of its
    reverse complement), its ``place`` in that sequence (0-based, int) and its ``code``.

    Places are 0, ``stride``, 2 * ``stride``, ..., at most ``limit`` of them; with ``first`` only k-mers that begin with
    that base, with ``keep`` (``code_filter``) those that may be in the filter."""
    plain = df.select(*carry, "seq")
    extra = [T.StructField("strand", T.IntegerType())] if both else []
    schema = T.StructType([*plain.schema.fields[:-1], *extra, T.StructField(place, T.IntegerType()), T.StructField("code", T.LongType())])
    return plain.mapInArrow(partial(_rows, carry=list(carry), k=k, stride=stride, limit=limit, both=both, first=first, keep=keep,
                                    names=schema.names), schema)


def _by_chunk(codes: np.ndarray, bits: int) -> pa.RecordBatch:
    """The slots of ``codes`` as a row per chunk: its slots as bytes, which costs the exchange little."""
    slots = np.sort(_slots(codes, bits).astype(np.uint32))
    chunks, begin = np.unique(slots >> np.uint32(CHUNK_BITS), return_index=True)
    inside = slots & np.uint32((1 << CHUNK_BITS) - 1)
    held = [part.tobytes() for part in np.split(inside, begin[1:])] if len(slots) else []
    return pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), pa.array(held, pa.binary())], names=["chunk", "slots"])


def _filter_slots(batches, k: int, stride: int, both: bool, bits: int):
    for batch in batches:
        for _, _, _, codes in _cut(batch, [], k, stride, None, both, None, None):
            yield _by_chunk(codes, bits)


def _code_slots(batches, bits: int):
    for batch in batches:
        yield _by_chunk(batch.column(0).to_numpy(), bits)


def _filter_chunks(batches):
    """Rows sorted by chunk to a row per chunk: its bits."""
    now, held = None, np.zeros(1 << CHUNK_BITS, bool)

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())],
                                          names=["chunk", "bits"])
    for batch in batches:
        for chunk, slots in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if chunk != now:
                if now is not None:
                    yield done()
                now = chunk
                held[:] = False
            held[np.frombuffer(slots.as_buffer(), np.uint32)] = True
    if now is not None:
        yield done()


def _filter_bits(n_codes: int) -> int:
    bits = (max(n_codes, 1) * BITS_PER_CODE - 1).bit_length()
    return min(max(bits, min(bits + 3, FREE_BITS), CHUNK_BITS), MOST_BITS)


def _filter_of(slots: DataFrame, bits: int):
    chunks = slots.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_filter_chunks, "chunk int, bits binary").collect()
    held = bytearray(1 << (bits - 3))
    size = 1 << (CHUNK_BITS - 3)
    for chunk in chunks:
        held[chunk.chunk * size:(chunk.chunk + 1) * size] = chunk.bits
    return slots.sparkSession.sparkContext.broadcast(bytes(held)), bits


def code_filter(df: DataFrame, k: int, n_codes: int, stride: int = 1, both: bool = False):
    """A filter for ``cut_kmers`` that lets the codes of the k-mers of ``seq`` pass, and few others: one hash into at
    most 128 MB of bits, broadcast.  None where there are so many codes that it would let most others pass."""
    if n_codes > 1 << (MOST_BITS - 1):
        return None
    bits = _filter_bits(n_codes)
    return _filter_of(df.select("seq").mapInArrow(partial(_filter_slots, k=k, stride=stride, both=both, bits=bits), "chunk int, slots binary"), bits)


def filter_of_codes(codes: DataFrame, n_codes: int):
    """The same for the column ``code`` of a table."""
    if n_codes > 1 << (MOST_BITS - 1):
        return None
    bits = _filter_bits(n_codes)
    return _filter_of(codes.select("code").where("code IS NOT NULL").mapInArrow(partial(_code_slots, bits=bits), "chunk int, slots binary"), bits)
