"""Words, shingles and their 64-bit hashes for a whole batch of texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_CODES = np.random.Generator(np.random.PCG64(20_240_117)).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words of a chunk of texts: `first[i]:first[i + 1]` are the words of text `i`; `start`, `end` are byte places."""

    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers, so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    out = np.full(count, _STEP, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about `limit` bytes; a null is an empty text.

    A text is never cut: one that is longer than the limit makes a run of its own.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, stop, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def find_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of bytes that are `inside`, never across two texts."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, np.searchsorted(start, offsets), start, end)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs without white space, never across two texts."""
    return find_runs(data, offsets, ~_SPACE[data])


def word_hashes(words: Words, lower: bool = True) -> np.ndarray:
    """A hash per word; A-Z count as a-z if `lower`."""
    lengths = words.end - words.start
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = words.data[place + np.repeat(words.start, lengths)]
    codes = _BYTE_CODES[_LOWER[letters] if lower else letters]
    return mix(np.add.reduceat(codes * _powers(int(lengths.max()))[place], first))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the words `i .. i + width - 1` for each `i` that has so many words after it."""
    count = max(0, len(hashes) - width + 1)
    total = np.full(count, width * int(_STEP) % 2**64, dtype=np.uint64)
    for k, factor in enumerate(_powers(width + 1)[1:]):
        total += hashes[k : k + count] * factor
    return mix(total)


def span_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words `start .. end - 1` of each span; spans may differ in width."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(len(hashes)), out=sums[1:])
    back = np.full(len(hashes) + 1, pow(int(_STEP), -1, 2**64), dtype=np.uint64)
    back[:1] = 1
    back = np.multiply.accumulate(back)
    return mix((sums[end] - sums[start]) * back[start] + mix((end - start).astype(np.uint64)))


def shingle_sets(words: Words, hashes: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles per text; a text of fewer words is one shingle, one without words has none."""
    windows = window_hashes(hashes, width)
    sets = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if last - first >= width:
            sets.append(np.unique(windows[first : last - width + 1]))
        else:
            sets.append(window_hashes(hashes[first:last], last - first) if last > first else hashes[:0])
    return sets
