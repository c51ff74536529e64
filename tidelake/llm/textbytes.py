"""Text columns as byte arrays: slices, hashes of segments, words and shingles; numpy only.

Hashes are 64 bits wide: the segment's polynomial in an odd base, over a random value per byte, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 2**64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(fold: bool) -> np.ndarray:
    """A random value per byte; with ``fold`` A-Z have those of a-z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if fold:
        values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grow = lambda base: np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])
            self.up, self.down = grow(np.uint64(_BASE)), grow(np.uint64(_INVERSE))
        return self.up, self.down


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each data[start:end], none of which is empty."""
    up, down = powers.of(len(data) + 1)
    run = np.cumsum(values[data] * up[:len(data)], dtype=np.uint64)
    before = np.where(starts > 0, run[starts - 1], np.uint64(0))
    return mixed((run[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about ``most`` bytes; a longer row is a run alone."""
    if not len(texts):
        return
    data, offsets = buffers(texts)
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (one more entry at the end).

    ``between`` tells for each byte whether it parts words.
    """
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_MULTIPLIERS = mixed(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` successive words; also of runs that cross rows, which callers leave out."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k:k + n] * _MULTIPLIERS[k]
    return mixed(total)


def whole_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of one sequence that is shorter than a shingle; it never equals that of a shingle by construction of its seed."""
    total = hashes * _MULTIPLIERS[32:32 + len(hashes)]
    return mixed(np.asarray([total.sum(dtype=np.uint64) + np.uint64(len(hashes))]))[0]
