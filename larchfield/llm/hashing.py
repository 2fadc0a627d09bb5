"""Word hashes of whole text columns, without a Python loop over rows or words.

A word is a run of ASCII letters, digits and non-ASCII bytes of the lower-cased
text. Its hash is a polynomial over its bytes modulo 2**64, mixed at the end.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from larchfield.llm.common import text_buffer

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BYTES = np.array(
    [chr(b).isalnum() if b < 128 else True for b in range(256)], dtype=bool
)
SYMBOL_BYTES = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)], dtype=bool)
WORD_PATTERN = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 2**64)
    up, down = (np.full(size, b, np.uint64) for b in (_BASE, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in reading order, and where each row's words start.

    The second array has one entry more than there are rows. Null and empty
    texts have no words.
    """
    hashes, bounds, _, _, _ = word_spans(texts)
    return hashes, bounds


def word_spans(
    texts: pa.Array, inside_bytes: np.ndarray = _WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and row bounds, with the bytes, row offsets and word starts.

    ``inside_bytes`` tells of each byte whether it belongs to a word.
    """
    data, offsets = text_buffer(pc.utf8_lower(texts))
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), data, offsets, none
    inside = inside_bytes[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = ~inside[:-1]
    fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(inside & fresh)
    last = np.ones(len(data), bool)
    last[:-1] = ~inside[1:]
    ends_at = offsets[1:-1]
    last[ends_at[ends_at > 0] - 1] = True
    ends = np.flatnonzero(inside & last)
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends] - before) * down[starts])
    return hashes, np.searchsorted(starts, offsets), data, offsets, starts


def word_hash(word: str) -> int:
    """The hash of one lower-case word, stated plainly."""
    value = 0
    for place, byte in enumerate(word.encode()):
        value += (byte + 1) * pow(_BASE, place, 2**64)
    return int(mix(np.array([value % 2**64], np.uint64))[0])


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row number of each element, given where the rows start."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words per row, and where each row's start.

    A row with fewer words has one shingle of all its words; a row without words
    has none.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(made)])
    row = rows_of(starts)
    first = bounds[:-1][row] + np.arange(starts[-1]) - starts[:-1][row]
    length = np.minimum(counts, width)[row]
    total = np.zeros(len(first), np.uint64)
    for place in range(width):
        at = np.minimum(first + place, max(len(words) - 1, 0))
        part = mix(words[at] + np.uint64(place * 0x51ED270B + 1))
        total += np.where(place < length, part, np.uint64(0)) if place else part
    return mix(total), starts
