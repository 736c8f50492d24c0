"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A batch is cut into slices of whole documents with SLICE_BYTES of text each (a longer document is a slice
of its own), so that memory depends on the longest document and never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_RANDOM = np.random.default_rng(20240229)
_VALUE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_MULTIPLIERS = _RANDOM.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words [^\x20\x09-\x0D]+ and words of letters, digits and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of rows in the bytes) of each slice; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row, rows = 0, len(texts)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total); words never cross rows."""
    if not len(data):
        return (none := np.zeros(0, np.int64)), none, np.zeros(len(offsets), np.int64)
    word = inside[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    start[cuts] = word[cuts]
    end[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span (spans in order, apart from each other)."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + (1 << 20), "right")))
        at, to = int(starts[first]), int(ends[last - 1])
        power = np.full(to - at, _BASE)
        power[0] = 1
        np.cumprod(power, out=power)
        sums = np.zeros(to - at + 1, np.uint64)
        np.cumsum(_VALUE[data[at:to]] * power, out=sums[1:])
        left, right = starts[first:last] - at, ends[first:last] - at
        back = np.full(int(left[-1]) + 1, _BACK)
        back[0] = 1
        np.cumprod(back, out=back)
        out[first:last] = mixed((sums[right] - sums[left]) * back[left])
        first = last
    return out


def joined(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of so many consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n] * _MULTIPLIERS[0]
    for k in range(1, size):
        out += words[k : n + k] * _MULTIPLIERS[k]
    return mixed(out)
