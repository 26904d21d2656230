"""Byte and word kernels on Arrow columns, used inside tasks.

Texts are UTF-8 bytes. A block is a run of rows whose texts are small together,
so that the arrays made from it stay small; one very long text is a block of its
own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a public 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offsets


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of rows."""
    buf, offsets = column_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def table_of(chars: bytes, others: bool = False) -> np.ndarray:
    """256 flags: whether a byte is in ``chars`` (or, with ``others``, is not)."""
    flags = np.zeros(256, bool)
    flags[list(chars)] = True
    return ~flags if others else flags


# Separators and word bytes of the contracts.
NOT_SPACE = table_of(bytes([0x20, *range(0x09, 0x0E)]), others=True)
ALNUM = table_of(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each document) of the maximal runs of word bytes.

    ``buf`` is lowered; no word crosses documents.
    """
    flag = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    if len(buf):
        before[0] = False
        before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    if len(buf):
        after[-1] = False
        after[:-1] = flag[1:]
    ends = np.flatnonzero(flag & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _MULTIPLIER), dtype=np.uint64)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(first, lengths)
    values = _BYTE_VALUE[buf[place + np.repeat(starts, lengths)]] * powers[place]
    return mix(np.add.reduceat(values, first))


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's k-word shingles and how many each document has.

    ``counts``: words before each document. A document of fewer than k words,
    but not none, has one shingle: all its words.
    """
    n = np.diff(counts)
    long, made = n >= k, np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    powers = [np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)) for j in range(k)]
    out = np.zeros(int(made.sum()), np.uint64)
    at = np.cumsum(made) - made
    if len(hashes) >= k:
        rolled = sum(hashes[j:len(hashes) - k + 1 + j] * powers[j] for j in range(k))
        inside = np.repeat(long, made)
        pick = np.arange(len(out)) - np.repeat(at - counts[:-1], made)
        out[inside] = rolled[pick[inside]]
    for d in np.flatnonzero(~long & (n > 0)):
        own = hashes[counts[d]:counts[d + 1]]
        out[at[d]] = sum(int(h) * pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j, h in enumerate(own)) + len(own) & ((1 << 64) - 1)
    return mix(out), np.concatenate([[0], np.cumsum(made)])
