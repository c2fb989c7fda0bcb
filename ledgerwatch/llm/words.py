"""Words of Arrow text columns as 64-bit hashes, by whole-array arithmetic on their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))
_powers = np.zeros(0, np.uint64)
_inverses = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of consecutive texts. Word k has hash[k] and bytes start[k]:end[k] of `data`; text d has words first[d]:first[d+1]."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls empty; offsets begin at 0."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    bounds, data = column.buffers()[1], column.buffers()[2]
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return content, offsets - offsets[0]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, PIECE_BYTES + 1)
        _powers, _inverses = (np.multiply.accumulate(np.full(size, x, np.uint64)) for x in (_POWER, _INVERSE))
    return _powers, _inverses


def split_words(column: pa.Array, lower: bool = True, piece: int = PIECE_BYTES) -> Iterator[Words]:
    """The words of a text column, in pieces of about `piece` bytes of whole texts. A-Z count as a-z if `lower`."""
    content, offsets = string_buffers(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece, "right")) - 1)
        yield _words(slice(row, stop), content[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], lower)
        row = stop


def _words(rows: slice, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(rows, data, offsets, none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64))
    inside = ~_BLANK[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    begin = offsets[:-1][offsets[:-1] < size]
    start[begin] = inside[begin]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    powers, inverses = _tables(size + 1)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUES[_LOWER[data] if lower else data] * powers[:size], out=total[1:])
    hashed = mix((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * _ODD)
    return Words(rows, data, offsets, hashed, starts, ends, np.searchsorted(starts, offsets))


def word_text(words: Words, k: int) -> str:
    return words.data[words.start[k] : words.end[k]].tobytes().decode("utf-8", "replace")
