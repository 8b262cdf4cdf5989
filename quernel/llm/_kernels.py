"""Vectorised text kernels over Arrow string buffers.

A batch's text column is used as it lies in memory: one byte buffer and the
offsets of its texts. Words are found and hashed for many texts at once, in
pieces of bounded size, so a batch of long texts doesn't multiply in memory.
The module travels with the tasks; executors need only numpy and pyarrow.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text that are worked on at once (a longer text is worked on alone).
PIECE = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_ALNUM = np.zeros(256, bool)
_NOT_ALNUM[:128] = True
_NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(32)
_LOWER += np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of whole texts small on both sides of the pipe."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S33
    h *= _M2
    return h ^ (h >> _S33)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _ODD), ("down", _BACK)):
            table = np.full(max(n, PIECE + 4096), base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def pieces(ends: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or one longer text."""
    lo, n = 0, len(ends) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(data: np.ndarray, starts_of_texts: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word; no word spans two texts."""
    inside = ~separator[data]
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = starts_of_texts[(starts_of_texts > 0) & (starts_of_texts < n)]
    before[cuts] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashed_words(column: pa.Array, alnum: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, hashes, word_offsets, first_bytes) for ranges of texts.

    Hashes are of the words with A-Z lowered; text ``lo + i`` has the words
    from ``word_offsets[i]`` to ``word_offsets[i + 1]``.
    """
    data, ends = buffers(column)
    separator = _NOT_ALNUM if alnum else _SPACE
    for lo, hi in pieces(ends):
        base = ends[lo]
        part, local = data[base : ends[hi]], ends[lo : hi + 1] - base
        first, past = word_bounds(part, local[:-1], separator)
        up, down = _powers(len(part) + 1)
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_LOWER[part] * up[: len(part)], out=total[1:])
        h = (total[past] - total[first]) * down[first]
        h = mixed(h + (past - first).astype(np.uint64) * _M2)
        yield lo, hi, h, np.searchsorted(first, local), first


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring word pairs, in order."""
    return mixed(h[:-1] * _M1 + ((h[1:] << np.uint64(31)) | (h[1:] >> _S33)) * _M2)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of windows of ``n`` words, in order; none if there are fewer."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = mixed(out * _M1 + h[i : len(h) - n + 1 + i])
    return out
