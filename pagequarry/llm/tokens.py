"""Words and word n-grams of whole Arrow batches as 64-bit hashes, in numpy.

All work is done on the UTF-8 bytes of a slice of rows at once, so no Python
object is made per word. A slice holds about a megabyte, or one longer text;
a word's hash is a polynomial over its bytes read from prefix sums, then mixed.
Equal words have equal hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.default_rng(20240611)
_BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
# Odd multipliers for the places of an n-gram.
PLACES = _random.integers(1, 1 << 63, 32, dtype=np.uint64) | np.uint64(1)

# Bytes that are no part of a word: [\x20\x09-\x0D], and for letter words all of ASCII but letters and digits.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
NO_LETTERS = np.zeros(256, bool)
NO_LETTERS[:128] = [not chr(c).isalnum() for c in range(128)]


class Slice(NamedTuple):
    """Rows ``first..last`` of a batch: their bytes and where each row's text begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Hash, begin and end of each word; words of row r are ``rows[r]..rows[r + 1]``."""

    hashes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit; works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of strings into slices; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, content = texts.buffers()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(places, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield Slice(row, last, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row])
        row = last


def words(part: Slice, separators: np.ndarray = BLANKS, fold: bool = False) -> Words:
    """Maximal runs of bytes that are no separators; no word spans two rows. ``fold`` lower-cases A-Z."""
    data, offsets = part.data, part.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(_range_hashes(data, begins, ends, fold), begins, ends, np.searchsorted(begins, offsets))


def _range_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    values, out, at = _FOLDED_VALUES if fold else _BYTE_VALUES, np.empty(len(begins), np.uint64), 0
    while at < len(begins):
        low = int(begins[at])
        stop = max(at + 1, int(np.searchsorted(ends, low + SLICE_BYTES, "right")))
        size = int(ends[stop - 1]) - low
        up, down = _powers(SLICE_BYTES if size <= SLICE_BYTES else size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[low:low + size]] * up[:size], out=sums[1:])
        b = begins[at:stop] - low
        out[at:stop] = (sums[ends[at:stop] - low] - sums[b]) * down[b]
        at = stop
    return mix(out)


def ngrams(found: Words, places: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words at ``places`` after each word, e.g. (0, 1, 2) or, with gaps, (0, 2).

    Returns hashes, the index of each one's first word, and the rows' offsets
    among them. A window that leaves its row gives none.
    """
    reach, n = places[-1] + 1, len(found.hashes)
    counts = np.diff(found.rows)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(counts - reach + 1, 0))])
    if n < reach:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), offsets
    total = np.zeros(n - reach + 1, np.uint64)
    for k, place in enumerate(places):
        total += found.hashes[place:place + len(total)] * PLACES[k]
    at = np.arange(len(total)) + reach <= np.repeat(found.rows[1:], counts)[:len(total)]
    return mix(total[at] + PLACES[len(places):len(places) + 1] * np.uint64(reach)), np.flatnonzero(at), offsets


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each row; an empty row has 0."""
    return _reduce(np.add, values, offsets)


def _reduce(function: np.ufunc, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = function.reduceat(values, offsets[full])
    return out


def row_least(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return _reduce(np.minimum, values, offsets)


def row_greatest(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return _reduce(np.maximum, values, offsets)


def as_longs(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's signed longs."""
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))
