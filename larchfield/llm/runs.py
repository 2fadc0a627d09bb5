"""Periodic runs of words, found by internal pattern matching."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of, text_buffer
from larchfield.llm.hashing import rows_of

#: A run is at least this long, and this many periods long.
LEAST_WORDS = 6
LEAST_PERIODS = 4
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (bytes), the number of each word in reading order, and row bounds.

    Words are what lies between spaces, tabs, line feeds, carriage returns, form
    feeds and vertical tabs. Equal numbers mean equal bytes.
    """
    data, offsets = text_buffer(texts)
    inside = ~_SEPARATOR[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    fresh[edges] = inside[edges]
    starts = np.flatnonzero(fresh)
    packed = data[inside]
    # A word ends where the next one starts once separators are gone.
    at = np.append(np.cumsum(inside)[starts] - 1, len(packed)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(packed.tobytes())]
    )
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(starts, offsets)


class WaveletTree:
    """Orthogonal range successor over a permutation, for many queries at once.

    One bit vector per binary digit, most significant first, with zeros sorted
    before ones; ``ranks[d][i]`` counts the zeros among the first ``i``.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.digits = range(max(1, int(self.size).bit_length()) - 1, -1, -1)
        self.ranks = []
        for digit in self.digits:
            zero = (values >> digit) & 1 == 0
            self.ranks.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of entries lo..hi are less than ``bound``."""
        lo, hi, count = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for digit, rank in zip(self.digits, self.ranks, strict=True):
            one = (bound >> digit) & 1 == 1
            low, high, zeros = rank[lo], rank[hi], rank[-1]
            count += np.where(one, high - low, 0)
            lo, hi = np.where(one, zeros + lo - low, low), np.where(one, zeros + hi - high, high)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value with ``nth`` smaller ones among entries lo..hi."""
        lo, hi, nth, value = lo.copy(), hi.copy(), nth.copy(), np.zeros(len(lo), np.int64)
        for digit, rank in zip(self.digits, self.ranks, strict=True):
            low, high, zeros = rank[lo], rank[hi], rank[-1]
            one = nth >= high - low
            nth -= np.where(one, high - low, 0)
            value |= one.astype(np.int64) << digit
            lo, hi = np.where(one, zeros + lo - low, low), np.where(one, zeros + hi - high, high)
        return value

    def neighbours(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest smaller and least greater of entries lo..hi around one of them; -1 if none."""
        before = self.below(lo, hi, value)
        out = []
        for nth, some in ((before - 1, before > 0), (before + 1, before + 1 < hi - lo)):
            found = np.full(len(lo), -1, np.int64)
            found[some] = self.smallest(lo[some], hi[some], nth[some])
            out.append(found)
        return out[0], out[1]


def classes(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (first, second); in that order each entry's class start and class size."""
    span = int(second.max(initial=0)) + 2
    if (int(first.max(initial=0)) + 1) * span < 1 << 63:
        key = first * span + second + 1
        order = np.argsort(key)
        key = key[order]
        fresh = np.append(True, key[1:] != key[:-1])[: len(order)]
    else:
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(order)]
    at = np.flatnonzero(fresh)
    sizes = np.diff(np.append(at, len(order)))
    return order, np.repeat(at, sizes), np.repeat(sizes, sizes)


def block_queries(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """The suffix array of repeated word pairs, and the interval of every dyadic block that repeats.

    Returns positions in suffix order, then for each query the block's start, the
    interval of suffixes that begin with it, and its length. Blocks of 2, 4, 8, ...
    words start at multiples of their length in each row. Suffixes are ordered by
    doubling prefixes; only those that share their prefix with another suffix of
    the same row are sorted on.
    """
    size = len(ids)
    row = rows_of(bounds)
    end = bounds[1:][row]
    place = np.arange(size) - bounds[:-1][row]
    paired = np.flatnonzero(np.arange(size) + 2 <= end)
    # Rows are part of the first key, so that classes never span rows.
    firsts = row[paired] * (int(ids.max(initial=0)) + 1) + ids[paired]
    order, start, count = classes(firsts, ids[paired + 1])
    several = count > 1
    suffixes = paired[order[several]]
    if not len(suffixes):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    starts = np.cumsum(np.append(True, np.diff(start[several]) != 0)) - 1
    sizes = np.bincount(starts)
    begin = np.cumsum(sizes) - sizes
    rank = np.full(size, -1, np.int64)
    rank[suffixes] = begin[starts]
    slots = np.arange(len(suffixes))
    lows, highs = begin[starts], (begin + sizes)[starts]
    found: list[tuple[np.ndarray, ...]] = []
    width, longest = 2, int(np.diff(bounds).max())
    while len(slots):
        members = suffixes[slots]
        aligned = place[members] % width == 0
        at = members[aligned]
        found.append((at, lows[aligned], highs[aligned], np.full(len(at), width)))
        if 2 * width >= longest // 2 + 1:
            break
        # Classes of twice the width: by the class of the second half.
        beyond = members + width
        second = np.full(len(members), -1, np.int64)
        fits = beyond + width <= end[members]
        second[fits] = rank[beyond[fits]]
        order, start, count = classes(rank[members], second)
        suffixes[slots] = members[order]
        open_class = (second[order] >= 0) & (count > 1)
        low = slots[start]
        rank[members] = -1
        rank[members[order[open_class]]] = low[open_class]
        slots, lows, highs = slots[open_class], low[open_class], (low + count)[open_class]
        width *= 2
    queries = [np.concatenate(parts) for parts in zip(*found, strict=True)]
    return suffixes, *queries


def candidates(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, period): the block of words at ``start`` comes again ``period`` words on.

    A run of smallest period q and 4 q words or more holds a whole aligned block
    of 2**k >= q words (k least, blocks of two words for q = 1) and q words beside
    it. By primitivity the block's nearest occurrence on that side is q words
    away, inside the neighbouring window of 2**k starts. Occurrences in such a
    window form a progression, so the nearest one gives its step.
    """
    suffixes, at, lo, hi, width = block_queries(ids, bounds)
    if not len(at):
        return np.zeros((0, 2), np.int64)
    # The tree is over the suffixes' places among all that repeat, not in the text.
    kept = np.sort(suffixes)
    tree = WaveletTree(np.searchsorted(kept, suffixes))
    left, right = tree.neighbours(lo, hi, np.searchsorted(kept, at))
    out = []
    for near, sign in ((left, 1), (right, -1)):
        some = near >= 0
        other, own = kept[near[some]], at[some]
        gap = sign * (own - other)
        close = gap <= width[some]
        out.append(np.stack([np.minimum(own, other)[close], gap[close]], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def same_length(ids: np.ndarray, at: int, gap: int, stop: int, step: int) -> int:
    """How many words from ``at`` on, in direction ``step``, equal those ``gap`` words later."""
    total, chunk = 0, 32
    room = stop - at if step > 0 else at - stop + 1
    while total < room:
        size = min(chunk, room - total)
        begin = at + total if step > 0 else at - total - size + 1
        differ = ids[begin : begin + size] != ids[begin + gap : begin + gap + size]
        if differ.any():
            return total + int(np.argmax(differ if step > 0 else differ[::-1]))
        total, chunk = total + size, 2 * chunk
    return total


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each row that has any, by start, then period."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    pairs = candidates(ids, bounds)
    rows = np.searchsorted(bounds, pairs[:, 0], side="right") - 1
    known: dict[tuple[int, int], int] = {}
    for row, (at, period) in zip(rows.tolist(), pairs.tolist(), strict=True):
        # Candidates come in order, so one inside the last run of its period is that run.
        if at < known.get((row, period), -1):
            continue
        first, last = int(bounds[row]), int(bounds[row + 1])
        back = same_length(ids, at - 1, period, first, -1)
        on = same_length(ids, at, period, last - period, 1)
        length = back + on + period
        known[row, period] = at + on
        if length >= max(LEAST_WORDS, LEAST_PERIODS * period):
            found.setdefault(row, []).append((at - back - first, length, period))
    return {row: smallest_periods(runs) for row, runs in found.items()}


def smallest_periods(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs by start and period; of equal stretches only that with the smallest period."""
    least: dict[tuple[int, int], int] = {}
    for start, length, period in runs:
        least[start, length] = min(period, least.get((start, length), period))
    return sorted((start, length, period) for (start, length), period in least.items())


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period; of equal ones the first, then the shortest period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


Rewrite = Callable[[int | None, np.ndarray], np.ndarray]


def plant(doc_id: int | None, ids: np.ndarray) -> np.ndarray:
    """Every tenth document by crc32 of its id repeats its words from a place on with a period."""
    if doc_id is None or not len(ids):
        return ids
    h = crc32(str(doc_id).encode())
    if h % 10:
        return ids
    g, n = h // 10, len(ids)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([ids[:a], ids[a + np.arange(n - a) % p]])


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
DETAIL = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"


def sha(data: bytes | memoryview) -> str:
    return hashlib.sha256(data).hexdigest()


def collapsed(words: pa.Array, ids: np.ndarray, bounds: np.ndarray, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The words of each row outside the repetitions of its runs, joined by single spaces."""
    kept = np.ones(len(ids), bool)
    for row, found in runs.items():
        for start, length, period in found:
            first = bounds[row] + start
            kept[first + period : first + length] = False
    at = np.concatenate([[0], np.cumsum(kept)])[bounds]
    lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), words.take(pa.array(ids[kept])))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def find_periodic(docs: DataFrame, rewrite: Rewrite | None = None, detail: bool = False) -> DataFrame:
    """Periodic runs of the words of every document, and the text without their repetitions.

    A run is a longest stretch of words with smallest period q that is six words
    and four periods long at least. Per row: doc_id, n_runs, the run with the
    greatest length / period (ties: smallest start, then period) as start, length,
    period and exponent_milli = floor(1000 length / period), the SHA-256 of all
    runs as lines ``start,length,period`` and of the kept words joined by spaces.
    A word goes if some run holds it behind that run's first q words. ``detail``
    adds the runs and the kept text themselves. ``rewrite`` changes a document's
    word numbers before the search, by doc_id.

    Whole texts are searched, each by itself in one task: dyadic blocks look up
    their nearest occurrences in a wavelet tree over the suffix array, whose size
    is a few numbers per word that stands in a repeated pair of words.

    One row per row of ``docs``. A null, empty or blank text has no words: no
    runs, null run columns, hashes of the empty text. Null doc_ids are carried
    along and not rewritten by ``plant``; repeated rows give equal rows. Other
    columns are ignored; an empty table gives no rows.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text"):
            doc_ids = batch.column("doc_id").to_pylist()
            words, ids, bounds = words_of(batch.column("text"))
            if rewrite is not None:
                for i, doc_id in enumerate(doc_ids):
                    ids[bounds[i] : bounds[i + 1]] = rewrite(doc_id, ids[bounds[i] : bounds[i + 1]])
            runs = find_runs(ids, bounds)
            texts = collapsed(words, ids, bounds, runs)
            rows = []
            for i, (doc_id, text) in enumerate(zip(doc_ids, texts, strict=True)):
                found = runs.get(i, [])
                start, length, period = best_run(found) if found else (None, None, None)
                milli = 1000 * length // period if found else None
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
                rows.append((doc_id, len(found), start, length, period, milli, sha(lines), sha(text.as_buffer())))
            columns = [pa.array(c, pa.string() if n.endswith("sha256") else pa.int64())
                       for n, c in zip(NAMES, zip(*rows, strict=True), strict=True)]
            names = list(NAMES)
            if detail:
                kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
                listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.get(i, [])]
                          for i in range(len(rows))]
                columns += [pa.array(listed, pa.list_(kind)), texts.cast(pa.large_string()).cast(pa.string())]
                names += ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, SCHEMA + DETAIL if detail else SCHEMA)
