"""Benchmark decontamination by shared words of windows and exact checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of
from larchfield.llm.hashing import rows_of, word_hashes

TERMS = 1 << 14
PASSAGE = 64
VERBATIM, PARAPHRASE, ANSWER = 0.7, 0.5, 0.8
RARE = 0.5
CHUNK = 32
SLACK = 40
COMMON = 256
SLICE = 2048
EXPANDED = 4_000_000
ITEM_BLOCK = 2048


def terms_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(50)).astype(np.int64)


def passage_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """First words of the passages: ``width`` words each, the last of a row shorter."""
    counts = np.diff(bounds)
    made = -(-counts // width)
    first = np.concatenate([[0], np.cumsum(made)])
    row = rows_of(first)
    return bounds[:-1][row] + width * (np.arange(first[-1]) - first[:-1][row])


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed logarithmic inverse passage frequency of each of 16,384 hashed terms.

    Counted over all passages of all documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages = np.zeros(TERMS, np.int64), 0
        for batch in batches_of(batches, "text"):
            words, bounds = word_hashes(batch.column("text"))
            starts = passage_starts(bounds, PASSAGE)
            if not len(starts):
                continue
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
            key = np.sort(passage.astype(np.uint64) * np.uint64(TERMS) + (words >> np.uint64(50)))
            fresh = np.append(True, key[1:] != key[:-1])
            total += np.bincount((key[fresh] % np.uint64(TERMS)).astype(np.int64), minlength=TERMS)
            passages += len(starts)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1)), pa.array(np.append(total[full], passages))], ["term", "n"]
        )

    counted = texts_of(docs).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    total = found.pop(-1, 0)
    out = np.zeros(TERMS)
    out[list(found)] = list(found.values())
    return (np.log((total + 1) / (out + 1)) + 0.1).astype(np.float32)


@dataclass
class Items:
    """Passages of at most 64 words of benchmark items, with words and answers."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]


def answer_text(text: str) -> str:
    """The last sentence; of a single sentence its last quarter, three words at least."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if re.search(r"\w", s)]
    if len(sentences) > 1:
        return sentences[-1]
    words = text.split()
    return " ".join(words[-max(3, len(words) // 4) :])


def read_items(rows: list) -> Items:
    """Items of rows (item_id, text, answer); those without words are left out."""
    rows = [r for r in rows if r[1]]
    words, bounds = word_hashes(pa.array([r[1] for r in rows], pa.string()))
    answers, ends = word_hashes(pa.array([r[2] or answer_text(r[1]) for r in rows], pa.string()))
    out = Items([], [], [])
    for at, row in enumerate(rows):
        own = words[bounds[at] : bounds[at + 1]]
        if not len(own):
            continue
        for part in np.array_split(own, -(-len(own) // PASSAGE)):
            out.ids.append(row[0])
            out.words.append(part)
            out.answers.append(answers[ends[at] : ends[at + 1]])
    return out


def common_length(left: list[int], right: list[int]) -> int:
    """Length of the longest common subsequence, by bits over ``left``."""
    masks: dict[int, int] = {}
    for place, word in enumerate(left):
        masks[word] = masks.get(word, 0) | 1 << place
    full = (1 << len(left)) - 1
    state = full
    for word in right:
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return len(left) - state.bit_count()


class Search:
    """Windows that hold enough of an item's words for ``check`` to accept them.

    Windows are runs of 32-word chunks, so long that every span of up to three
    times the item's words and 40 more lies in one. A window is a candidate of an
    item if the item's words in it may have half of the item's weight by inverse
    frequency, which ``check`` asks of every leak: the commonest words count
    once per window, the others at most once too often per chunk. So no window
    that ``check`` accepts is left out.
    """

    def __init__(self, items: Items, idf: np.ndarray) -> None:
        sizes = np.array([len(w) for w in items.words])
        self.reach = -(-(3 * sizes + SLACK) // CHUNK) + 1
        self.count = len(sizes)
        self.vocabulary, word = np.unique(np.concatenate(items.words), return_inverse=True)
        weight = idf[terms_of(self.vocabulary)].astype(np.float64)
        owner = np.repeat(np.arange(self.count), sizes)
        need = RARE * np.bincount(owner, weight[word], minlength=self.count)
        key, times = np.unique(word * self.count + owner, return_counts=True)
        word, owner = key // self.count, key % self.count
        share = times * weight[word] / need[owner]
        # Commonest words first.
        order = np.argsort(weight, kind="stable")
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        place = self.rank[word]
        self.common = min(COMMON, len(order))
        low = place < self.common
        self.dense = np.zeros((self.common, self.count), np.float32)
        self.dense[place[low], owner[low]] = share[low]
        by_word = np.argsort(place[~low], kind="stable")
        self.owners, self.shares = owner[~low][by_word], share[~low][by_word]
        self.edges = np.searchsorted(place[~low][by_word], np.arange(len(order) + 1))

    def sums(self, chunk: np.ndarray, word: np.ndarray, chunks: int) -> np.ndarray:
        """Shares of the rarer words of each chunk, added up from the first chunk on."""
        key = np.sort(chunk * len(self.rank) + word)
        key = key[np.append(True, key[1:] != key[:-1])[: len(key)]]
        chunk, word = key // len(self.rank), key % len(self.rank)
        made = self.edges[word + 1] - self.edges[word]
        total = np.zeros(chunks * self.count)
        ends, start = np.cumsum(made), 0
        while start < len(made):
            floor = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, floor + EXPANDED, side="right")))
            part = made[start:stop]
            first = np.repeat(self.edges[word[start:stop]] - np.cumsum(part) + part, part)
            at = first + np.arange(len(first))
            total += np.bincount(
                np.repeat(chunk[start:stop], part) * self.count + self.owners[at], self.shares[at], len(total)
            )
            start = stop
        out = np.zeros((chunks + 1, self.count))
        np.cumsum(total.reshape(chunks, self.count), axis=0, out=out[1:])
        return out

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item passage, first word, end) of the candidate windows."""
        most = int(self.reach.max())
        sizes = -(-np.diff(bounds) // CHUNK)
        # Rows are set apart by empty chunks, so that no window reaches the next row.
        offset = np.concatenate([[0], np.cumsum(np.where(sizes > 0, sizes + most, 0))])
        row = rows_of(bounds)
        chunk = offset[row] + (np.arange(len(words)) - bounds[row]) // CHUNK
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == words)
        chunk, place = chunk[known], self.rank[at[known]]
        for start in range(0, int(offset[-1]), SLICE):
            chunks = SLICE + most
            a, b = np.searchsorted(chunk, [start, start + chunks])
            if a == b:
                continue
            own, word = chunk[a:b] - start, place[a:b]
            low = word < self.common
            seen = np.zeros((chunks + 1, self.common), np.int16)
            seen[own[low] + 1, word[low]] = 1
            np.cumsum(seen, axis=0, dtype=np.int16, out=seen)
            rare = self.sums(own[~low], word[~low], chunks)
            for reach in np.unique(self.reach):
                picked = np.flatnonzero(self.reach == reach)
                there = (seen[reach : reach + SLICE] > seen[:SLICE]).astype(np.float32)
                score = there @ self.dense[:, picked] + (rare[reach : reach + SLICE] - rare[:SLICE])[:, picked]
                for window, item in zip(*np.nonzero(score >= 1 - 1e-4), strict=True):
                    r = int(np.searchsorted(offset, start + window, side="right")) - 1
                    first = int(bounds[r] + (start + window - offset[r]) * CHUNK)
                    end = min(first + int(reach) * CHUNK, int(bounds[r + 1]))
                    if first < end:
                        yield r, int(picked[item]), first, end


def check(words: np.ndarray, item: np.ndarray, answer: np.ndarray, idf: np.ndarray) -> float:
    """Share of the item's words that a region has in order; 0 if it is no leak.

    A leak has 70 % of the words, or 50 % and 80 % of the answer's words in order.
    Either way it has half of the item's words by inverse frequency, since short
    frequent words meet in any order by chance.
    """
    weight = idf[terms_of(item)]
    if weight[np.isin(item, words)].sum() < RARE * weight.sum():
        return 0.0
    there = words[np.isin(words, item)].tolist()
    share = common_length(item.tolist(), there) / len(item)
    if share >= VERBATIM:
        return share
    if share < PARAPHRASE or not len(answer):
        return 0.0
    return share if common_length(answer.tolist(), words.tolist()) >= ANSWER * len(answer) else 0.0


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Find benchmark items in documents, verbatim or paraphrased.

    A window leaks an item if its longest common subsequence of words has 70 % of
    the item's words, or 50 % and the answer is there: 80 % of the answer's words
    in order; half of the words by inverse frequency must be there in any case.
    The answer is the item's ``answer`` column if it has one, else its last
    sentence. Windows fit the item: every span of up to three times its words and
    40 more lies in one, at every 32 words of a document. All windows that can
    pass are checked. Items of more than 64 words are searched by their passages.
    Items are read in blocks of 2,048, each against all documents.

    Adds ``leaked_items`` (array of item ids in order; empty if clean),
    ``leak_share`` (largest share found, else 0) and ``contaminated`` to the
    columns of ``docs``, replacing any of these names. Null and empty texts are
    clean; texts of any length are searched whole; items that are null or without
    words match nothing; repeated rows are judged alike; an empty table on either
    side gives clean rows or none.
    """
    added = ("leaked_items", "leak_share", "contaminated")
    docs = docs.drop(*added)
    idf = inverse_frequencies(docs)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")
    )
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    number = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = docs.withColumns({"leaked_items": F.array().cast("array<long>"), "leak_share": F.lit(0.0)})
    for block in range(blocks):
        rows = items.where(number == block).orderBy("item_id", "text").collect()
        out = search_block(out, read_items([tuple(r) for r in rows]), idf)
    ordered = F.array_sort(F.array_distinct("leaked_items"))
    return out.withColumns({"leaked_items": ordered, "contaminated": F.size("leaked_items") > 0})


def search_block(docs: DataFrame, items: Items, idf: np.ndarray) -> DataFrame:
    """Add what one block of items leaks to ``leaked_items`` and ``leak_share``."""
    if not items.ids:
        return docs
    finder, names = Search(items, idf), docs.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", 1_000_000):
            words, bounds = word_hashes(batch.column("text"))
            leaked = [list(x) for x in batch.column("leaked_items").to_pylist()]
            share = batch.column("leak_share").to_pylist()
            for row, i, first, end in finder.candidates(words, bounds):
                best = check(words[first:end], items.words[i], items.answers[i], idf)
                if best:
                    leaked[row].append(items.ids[i])
                    share[row] = max(share[row], best)
            replaced = {
                "leaked_items": pa.array(leaked, pa.list_(pa.int64())),
                "leak_share": pa.array(share, pa.float64()),
            }
            columns = [replaced[c] if c in replaced else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(search, docs.schema)
