"""Toxicity scores by a convolutional text classifier, trained in numpy by many tasks at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of, materialise, scratch_path
from larchfield.llm.hashing import mix, rows_of, word_hashes

#: Training rows and words of a cell, the part of them that one network is fitted on at a time, on average.
CELL_ROWS = 4000
CELL_WORDS = 4_000_000
#: Cells are fitted in so many turns, between which the networks are averaged.
SLOTS = 4
HASH_BITS = 22
#: Bits of the table that keeps most unlabelled texts out of the join with labels.
FILTER_BITS = 26
SEEN = 8
#: Words of a smaller share of documents, as a mean over both labels, stay unknown.
SHARE = 0.0005
#: Rows that the embedding has at most: the words of the largest shares.
WORDS = 1 << 18
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Rounds of fitting and averaging; every training row takes part in every ``SLOTS``-th or more.
ROUNDS = 12
BATCH = 64
RATE = 0.01
#: Spread of embeddings at first, decay of weights per step, and share of words hidden in a step.
SPREAD = 0.02
DECAY = 0.3
HIDDEN = 0.1
#: Words whose filter answers are held at a time.
PLACES = 1 << 18
#: Scores of this value and above are predicted toxic; every language's threshold is moved here.
BAR = 0.7
#: A language's own threshold and that of all languages count alike with so many documents of its rarer label.
PRIOR = 40
#: Sums over tasks are sums of whole numbers, so that their order has no say: weights and parameters times these.
WEIGHT_ONE = 1 << 30
VALUE_ONE = 1 << 24
#: Logits are counted in steps of 1 / STEPS from -FARTHEST to FARTHEST.
STEPS = 256
FARTHEST = 64


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash bucket of every word in reading order, and row bounds."""
    words, bounds = word_hashes(texts)
    return (words >> np.uint64(64 - HASH_BITS)).astype(np.int32), bounds


def held_out() -> Column:
    """Rows whose labels no fit may see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Network:
    """Embeddings of known words, filters of several widths, and the output layer.

    Row 0 of ``embedding`` stands for unknown words and for padding and stays 0.
    ``filters[w]`` has a matrix for each of the w words it covers.
    """

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    offset: np.ndarray

    @classmethod
    def random(cls, words: int) -> Network:
        dice = np.random.default_rng(11)
        embedding = dice.normal(0, SPREAD, (words + 1, DIMENSIONS))
        embedding[0] = 0
        return cls(
            embedding.astype(np.float32),
            {w: dice.normal(0, 0.3 / w**0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS},
            np.zeros(FILTERS * len(WIDTHS), np.float32),
            dice.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), self.bias, self.output, self.offset]

    def part(self, own: np.ndarray) -> Network:
        """A copy that knows only the words of these rows of the embedding."""
        filters = {w: m.copy() for w, m in self.filters.items()}
        return Network(self.embedding[own], filters, self.bias.copy(), self.output.copy(), self.offset.copy())

    def pooled(self, words: np.ndarray, bounds: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The maximum of every filter over each row, and where it is reached.

        Rows are padded by unknown words, so that each has at least one place.
        A filter's answer is a sum of one table row per word it covers.
        """
        padded, starts = pad(words, bounds)
        # The last of a row's places that count is its last word, or the padding of an empty row.
        ends = starts[:-1] + np.maximum(np.diff(bounds), 1)
        maxima = np.full((len(bounds) - 1, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        argmax = np.zeros(maxima.shape, np.int64) if places else None
        for i, (width, matrices) in enumerate(self.filters.items()):
            tables = [self.embedding @ m for m in matrices]
            columns = slice(i * FILTERS, (i + 1) * FILTERS)
            for begin in range(0, len(padded) - max(WIDTHS) + 1, PLACES):
                valid = min(PLACES, len(padded) - max(WIDTHS) + 1 - begin)
                answer = tables[0][padded[begin : begin + valid]]
                for j in range(1, width):
                    answer += tables[j][padded[begin + j : begin + j + valid]]
                low, high = np.maximum(starts[:-1] - begin, 0), np.minimum(ends - begin, valid)
                rows = np.flatnonzero(low < high)
                if not len(rows):
                    continue
                edges = np.stack([low[rows], np.minimum(high[rows], valid - 1)], axis=1).ravel()
                top = np.maximum.reduceat(answer, edges, axis=0)[::2]
                # A row that ends with the answers loses its last place to the clipped edge.
                last = high[rows] == valid
                top[last] = np.maximum(top[last], answer[valid - 1])
                if argmax is not None:
                    found = begin + first_places(answer, low[rows], high[rows])
                    argmax[rows, columns] = np.where(top > maxima[rows, columns], found, argmax[rows, columns])
                maxima[rows, columns] = np.maximum(maxima[rows, columns], top)
        return maxima, argmax

    def logits(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        maxima, _ = self.pooled(words, bounds)
        return np.maximum(maxima + self.bias, 0) @ self.output + self.offset

    def gradients(
        self, words: np.ndarray, bounds: np.ndarray, target: np.ndarray, weight: np.ndarray | float = 1.0
    ) -> list[np.ndarray]:
        """Of the mean weighted logistic loss; only the places of maxima take part."""
        maxima, argmax = self.pooled(words, bounds, places=True)
        active = np.maximum(maxima + self.bias, 0)
        error = (sigmoid(active @ self.output + self.offset) - target) * weight / len(target)
        back = error[:, None] * self.output * (active > 0)
        padded, _ = pad(words, bounds)
        table = np.zeros_like(self.embedding)
        matrices = {w: np.zeros_like(m) for w, m in self.filters.items()}
        for i, (width, own) in enumerate(self.filters.items()):
            columns = slice(i * FILTERS, (i + 1) * FILTERS)
            part, at = back[:, columns], argmax[:, columns]
            for j in range(width):
                word = padded[at + j]
                matrices[width][j] = np.einsum("rfd,rf->df", self.embedding[word], part)
                np.add.at(table, word, part[:, :, None] * own[j].T[None])
        table[0] = 0
        return [table, *matrices.values(), back.sum(axis=0), active.T @ error, error.sum(keepdims=True)]


def pad(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with as many unknown ones behind each row as the widest filter covers."""
    gap = max(WIDTHS)
    starts = bounds + gap * np.arange(len(bounds))
    padded = np.zeros(int(starts[-1]), np.int32)
    padded[np.arange(len(words)) + gap * rows_of(bounds)] = words
    return padded, starts


def first_places(answer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row and filter the first place that reaches the row's maximum."""
    return np.stack([s + answer[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def rows_at(words: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some rows, and where each row's start."""
    sizes = np.diff(bounds)[chosen]
    starts = np.append(0, np.cumsum(sizes))
    return words[np.repeat(bounds[chosen] - starts[:-1], sizes) + np.arange(starts[-1])], starts


@dataclass
class ToxicityModel:
    """A network over known words, naive Bayes for languages, and a logit threshold for each."""

    buckets: np.ndarray
    network: Network
    languages: np.ndarray
    thresholds: np.ndarray

    def known(self, hashed: np.ndarray) -> np.ndarray:
        """Row of each word in the embedding; 0 if unknown."""
        lookup = self.__dict__.get("lookup")
        if lookup is None:
            lookup = np.zeros(1 << HASH_BITS, np.int32)
            lookup[self.buckets] = np.arange(1, len(self.buckets) + 1)
            self.__dict__["lookup"] = lookup
        return lookup[hashed]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "lookup"}

    def language(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return spoken(self.languages, words, bounds)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability-like score in which every language's threshold is ``BAR``."""
        hashed, bounds = hashed_words(texts)
        words = self.known(hashed)
        raised = self.network.logits(words, bounds).astype(np.float64)
        return sigmoid(raised - self.thresholds[self.language(words, bounds)] + np.log(BAR / (1 - BAR)))


def spoken(weights: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The likeliest language of each row by sums of word weights; ties to the first."""
    sums = [np.bincount(rows_of(bounds), column[words], minlength=len(bounds) - 1) for column in weights.T]
    return np.argmax(np.stack(sums, axis=1), axis=1) if sums else np.zeros(len(bounds) - 1, np.int64)


def may_be_among(ids: DataFrame, column: Column) -> Column:
    """Whether a doc_id may be one of ``ids``: true for all of those, and for few others.

    A table of 2**FILTER_BITS bits, one of them set for each id, goes to the tasks; the
    more ids, the more others pass.
    """

    def place(of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(1 << FILTER_BITS))

    set_bits = ids.select(place(F.col("doc_id")).alias("p")).groupBy(F.floor(F.col("p") / 8).alias("byte"))
    found = set_bits.agg(F.bit_or(F.pow(F.lit(2), F.col("p") % 8).cast("int")).alias("bits")).toArrow()
    table = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    table[found.column("byte").to_numpy()] = found.column("bits").to_numpy()

    @F.arrow_udf("boolean")
    def marked(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False)
        return pa.array((table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return marked(place(column))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled document that is not held out, as hashed words, written once.

    ``row`` numbers the rows. ``keys`` are four minimal hashes of a text's word
    triples; near copies share some. Of differing labels of a doc_id the greater counts.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    marked = materialise(marked, "toxic-labels")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    rows = rows.where(F.col("doc_id").isNotNull() & ~held_out()).where(may_be_among(marked, F.col("doc_id")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches_of(batches, "text"):
            words, bounds = hashed_words(batch.column("text"))
            texts = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [
                pa.array(at + np.arange(len(texts))),
                batch.column("doc_id"),
                batch.column("toxic"),
                batch.column("lang"),
                pa.array([t.tobytes() for t in texts], pa.binary()),
                pa.array([copy_keys(t) for t in texts], pa.list_(pa.int64())),
            ]
            at += len(texts)
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "toxic", "lang", "words", "keys"])

    schema = "row long, doc_id long, toxic int, lang string, words binary, keys array<long>"
    found = rows.join(marked.hint("merge"), "doc_id").select("doc_id", "toxic", "lang", "text").mapInArrow(extract, schema)
    return materialise(found, "labelled", "zstd")


def copy_keys(words: np.ndarray) -> list[int]:
    """Four minimal hashes of a text's word triples, each told from the others."""
    words = words.astype(np.uint64)
    triples = words[:-2] + (words[1:-1] << np.uint64(21)) + (words[2:] << np.uint64(42)) if len(words) > 2 else words
    return [
        int((mix(triples ^ np.uint64(k * 0x9E3779B97F4A7C15 & (2**64 - 1))).min(initial=2**64 - 1) & np.uint64(2**64 - 4)).view(np.int64)) + k - 1
        for k in range(1, 5)
    ]


def copy_weights(rows: DataFrame) -> DataFrame:
    """(row, weight): one over the rows that share the commonest of a row's keys.

    Near copies weigh about as much together as one text: else the rare words of a
    text that was copied often would pass for signs of its label.
    """
    keys = rows.select("row", F.explode("keys").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"))
    return materialise(keys.join(sizes, "key").groupBy("row").agg((1 / F.max("n")).alias("weight")), "copy-weights")


def dealt(rows: DataFrame) -> DataFrame | None:
    """Training rows dealt to cells by a hash, written by turn; None unless both labels have rows.

    Four in five rows are to ``learn`` from, the others to ``test`` with; where one
    label lacks either, every row does both. The rarer label's rows are copied, by the
    root of how much rarer it is, so that cells hold some of them, and repeated in their
    cells for the rest; ``copy`` 0 is the row itself.
    """
    aside = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 4
    totals = (
        rows.groupBy("toxic", aside.alias("aside"))
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("words") / 4).cast("long").alias("words"))
        .collect()
    )
    if len({r["toxic"] for r in totals}) < 2:
        return None
    apart = len(totals) == 4
    count, words = ([sum(r[c] for r in totals if r["toxic"] == t and not (apart and r["aside"])) for t in (0, 1)] for c in ("n", "words"))
    times = [max(1, round((max(count) / n) ** 0.5)) for n in count]
    size = max(2 * max(count) / CELL_ROWS, sum(n * t for n, t in zip(words, times)) / CELL_WORDS)
    slots = min(SLOTS, int(np.ceil(size)))
    cells = slots * int(np.ceil(size / slots))
    learn, test = (~aside, aside) if apart else (F.lit(True), F.lit(True))
    copies = F.when(learn, F.when(F.col("toxic") == 1, times[1]).otherwise(times[0])).otherwise(1)
    cell = F.pmod(F.xxhash64("doc_id", "words", "copy"), F.lit(cells))
    placed = (
        rows.drop("keys")
        .join(copy_weights(rows).hint("merge"), "row")
        .withColumns({"learn": learn, "test": test, "copy": F.explode(F.sequence(F.lit(0), copies - 1))})
        .withColumns({"cell": cell, "slot": (cell % slots).cast("int")})
        .repartition(cells, "cell")
        .sortWithinPartitions("cell", "doc_id", F.xxhash64("words"), "copy", "lang")
        .select("cell", "copy", "learn", "test", "toxic", "weight", "lang", "words", "slot")
    )
    path = scratch_path(rows.sparkSession, "cells")
    placed.write.option("compression", "zstd").partitionBy("slot").parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)


def words_in(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words of a batch's rows, and where each row's start."""
    texts = [np.frombuffer(w, np.int32) for w in batch.column("words").to_pylist()]
    return np.concatenate([np.zeros(0, np.int32), *texts]), np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)


def known_buckets(rows: DataFrame, least: float, every: dict[int, float]) -> np.ndarray:
    """Hash buckets of words in so many documents, and in ``SHARE`` of them as a mean over both labels.

    Documents count by their weights, ``every`` has the sum of each label's. Of more
    than ``WORDS`` buckets those of the largest shares are taken.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in batches_of(batches, "words"):
            words, bounds = words_in(batch)
            pairs = np.unique(rows_of(bounds) << HASH_BITS | words)
            row = pairs >> HASH_BITS
            whole = np.round(batch.column("weight").to_numpy() * WEIGHT_ONE).astype(np.int64)
            np.add.at(seen, (batch.column("toxic").to_numpy()[row], pairs & ((1 << HASH_BITS) - 1)), whole[row])
        found = np.flatnonzero(seen.any(axis=0))
        yield from pa.table({"bucket": found, "clean": seen[0, found], "toxic": seen[1, found]}).to_batches(100_000)

    counted = rows.select("toxic", "weight", "words").mapInArrow(count, "bucket long, clean long, toxic long")
    sums = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = F.round((F.col("clean") / every[0] + F.col("toxic") / every[1]) / (2 * WEIGHT_ONE), 9)
    common = sums.where((F.col("clean") + F.col("toxic") >= int((least - 0.001) * WEIGHT_ONE)) & (share >= SHARE))
    taken = common.orderBy(F.desc(share), "bucket").limit(WORDS).select("bucket").toArrow()
    return np.sort(taken.column("bucket").to_numpy().astype(np.int64))


def fit_cell(
    network: Network,
    words: np.ndarray,
    bounds: np.ndarray,
    toxic: np.ndarray,
    weight: np.ndarray,
    times: tuple[int, int],
    rate: float,
    dice: np.random.Generator,
) -> None:
    """Adam over the rows in shuffled batches; each label's rows so many ``times``."""
    parameters = network.parameters()
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    mixed = dice.permutation(np.repeat(np.arange(len(toxic)), np.array(times)[toxic.astype(int)]))
    for step, at in enumerate(range(0, len(mixed), BATCH), 1):
        rows = mixed[at : at + BATCH]
        batch, starts = rows_at(words, bounds, rows)
        batch = np.where(dice.random(len(batch)) < HIDDEN, 0, batch)
        slopes = network.gradients(batch, starts, toxic[rows], weight[rows])
        for p, g, a, b in zip(parameters, slopes, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8) + DECAY * p)


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each cell; rows come ordered by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            if held and held[-1].column("cell")[0].as_py() != int(cells[a]):
                yield held[-1].column("cell")[0].as_py(), pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[-1].column("cell")[0].as_py(), pa.concat_batches(held)


def fit_round(
    cells: DataFrame, model: ToxicityModel, scale: tuple[float, float], times: tuple[int, int], rate: float, turn: int
) -> Network:
    """The mean of the networks that each cell's rows make of the present one.

    A word's row is the mean over the cells that have the word; means are weighted
    by the cells' rows. The driver receives one mean network.
    """
    names = [f"v{i}" for i in range(DIMENSIONS)]
    size = len(model.network.embedding)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Row 0 of the embedding stays 0; the other parameters stand behind the embedding.
        sums = np.zeros((size + -(-sum(p.size for p in model.network.parameters()[1:]) // DIMENSIONS), DIMENSIONS + 1), np.int64)
        for cell, batch in whole_cells(batches):
            words, bounds = words_in(batch)
            words = model.known(words)
            own = np.union1d(words, [0])
            network = model.network.part(own)
            toxic = batch.column("toxic").to_numpy().astype(np.float32)
            weight = (batch.column("weight").to_numpy() * np.array(scale)[toxic.astype(int)]).astype(np.float32)
            fit_cell(network, np.searchsorted(own, words), bounds, toxic, weight, times, rate, np.random.default_rng([12, turn, cell]))
            rest = np.concatenate([p.ravel() for p in network.parameters()[1:]])
            rest = np.append(rest, np.zeros(-len(rest) % DIMENSIONS, np.float32)).reshape(-1, DIMENSIONS)
            values = np.vstack([network.embedding[1:], rest]).astype(np.float64)
            numbers = np.append(own[1:], size + np.arange(len(rest)))
            sums[numbers, 1:] += np.round(values * VALUE_ONE).astype(np.int64) * len(toxic)
            sums[numbers, 0] += len(toxic)
        numbers = np.flatnonzero(sums[:, 0])
        columns = {"number": numbers, **dict(zip(("n", *names), sums[numbers].T, strict=True))}
        yield from pa.table({c: pa.array(np.ascontiguousarray(v), pa.int64()) for c, v in columns.items()}).to_batches(10_000)

    rows = cells.select("cell", "toxic", "weight", "words")
    fitted = rows.mapInArrow(fit, ", ".join(f"{c} long" for c in ("number", "n", *names)))
    means = fitted.groupBy("number").agg(*((F.sum(c) / F.sum("n") / VALUE_ONE).cast("float").alias(c) for c in names)).toArrow()
    if not means.num_rows:
        return model.network
    numbers = means.column("number").to_numpy()
    values = np.stack([means.column(c).to_numpy() for c in names], axis=1)
    network = model.network.part(np.arange(size))
    network.embedding[numbers[numbers < size]] = values[numbers < size]
    rest, at = values[numbers >= size][np.argsort(numbers[numbers >= size])].ravel(), 0
    for p in network.parameters()[1:]:
        p[...] = rest[at : at + p.size].reshape(p.shape)
        at += p.size
    return network


def language_weights(rows: DataFrame, model: ToxicityModel, least: int = 20) -> np.ndarray:
    """Naive Bayes log weights (word, language) from all documents' languages, by their weights.

    Languages of fewer than ``least`` documents have no column. Unknown words weigh nothing.
    """
    size = len(model.buckets)
    weighed = rows.where("lang is not null").groupBy("lang").agg(F.sum(F.round(F.col("weight") * WEIGHT_ONE).cast("long")).alias("n"))
    names = sorted(r["lang"] for r in weighed.where(F.col("n") >= int((least - 0.001) * WEIGHT_ONE)).collect())
    weights = np.zeros((size + 1, len(names)))
    if not names:
        return weights

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(names), size + 1), np.int64)
        for batch in batches_of(batches, "words"):
            words, bounds = words_in(batch)
            whole = np.round(batch.column("weight").to_numpy() * WEIGHT_ONE).astype(np.int64)
            place = np.array([names.index(n) for n in batch.column("lang").to_pylist()], np.int64)
            at = rows_of(bounds)
            np.add.at(seen, (place[at], model.known(words)), whole[at])
        for i in range(len(names)):
            found = np.flatnonzero(seen[i])
            yield from pa.table({"word": found, "place": np.full(len(found), i), "n": seen[i][found]}).to_batches(100_000)

    told = rows.where(F.col("lang").isin(names)).select("weight", "lang", "words")
    counted = told.mapInArrow(count, "word long, place long, n long").groupBy("word", "place").agg(F.sum("n").alias("n")).toArrow()
    weights[counted.column("word").to_numpy(), counted.column("place").to_numpy()] = counted.column("n").to_numpy() / WEIGHT_ONE
    weights[1:] += 1
    weights[1:] = np.log(weights[1:] / weights[1:].sum(axis=0)) if size else 0
    weights[0] = 0
    return weights


def best_threshold(raised: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that parts the labels with the fewest errors, as shares of either label.

    Among equal ones the middle of the widest gap, so that both sides keep away from it.
    """
    order = np.argsort(raised, kind="stable")
    raised, toxic = raised[order].astype(np.float64), toxic[order] == 1
    return best_cut(raised, raised, toxic.astype(np.float64), (~toxic).astype(np.float64))


def best_cut(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """``best_threshold`` between steps of logits ``low`` to ``high``, each with its weight of either label."""
    if len(low) < 2:
        return float((low[0] + high[0]) / 2)
    missed = np.cumsum(toxic)[:-1] / toxic.sum()
    alarms = 1 - np.cumsum(clean)[:-1] / clean.sum()
    errors = np.round(missed + alarms, 12)
    gaps = np.where(errors == errors.min(), low[1:] - high[:-1], -1)
    at = int(np.argmax(gaps))
    return float((high[at] + low[at + 1]) / 2)


def best_thresholds(rows: DataFrame, model: ToxicityModel) -> np.ndarray:
    """A threshold for every predicted language, from the logits of all rows.

    It lies between the logit that best parts the labels in all languages and that
    of its own, the nearer to its own the more documents it has. The driver
    receives the rows' weights by language and step of logits.
    """

    def raise_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "words"):
            words, bounds = words_in(batch)
            words = model.known(words)
            raised = model.network.logits(words, bounds).astype(np.float64)
            columns = [
                pa.array(model.language(words, bounds)),
                pa.array(np.floor(np.clip(raised, -FARTHEST, FARTHEST) * STEPS).astype(np.int64)),
                pa.array(raised),
                batch.column("toxic"),
                pa.array(np.round(batch.column("weight").to_numpy() * WEIGHT_ONE).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["place", "step", "raised", "toxic", "n"])

    raised = rows.select("toxic", "weight", "words").mapInArrow(raise_rows, "place long, step long, raised double, toxic int, n long")
    found = raised.groupBy("place", "step").agg(
        F.min("raised").alias("low"),
        F.max("raised").alias("high"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    steps = found.toPandas().sort_values(["step", "place"])
    both = steps.groupby("step").agg({"low": "min", "high": "max", "toxic": "sum", "clean": "sum"})

    def cut(part) -> float:
        return best_cut(*(part[c].to_numpy().astype(np.float64) for c in ("low", "high", "toxic", "clean")))

    general = cut(both)
    thresholds = np.full(max(1, model.languages.shape[1]), general)
    for i in range(model.languages.shape[1]):
        own = steps[steps["place"] == i]
        rarer = min(own["toxic"].sum(), own["clean"].sum()) / WEIGHT_ONE
        if rarer:
            # The fewer documents a language has, the more the threshold of all counts.
            thresholds[i] = (rarer * cut(own) + PRIOR * general) / (rarer + PRIOR)
    return thresholds


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """Fit on every labelled document that is not held out; None if one label has no documents.

    Known words, language weights and thresholds are sums over all of them. Four in
    five train the network, whole texts of any length: tasks fit it on cells of some
    thousand rows, and the mean of what they make of it is the network of the next
    round. The others calibrate it. The driver holds the model, whose size does not
    grow with the documents, and its means; documents stay in the tasks.
    """
    cells = dealt(labelled_rows(docs, labels))
    if cells is None:
        return None
    rows = cells.where("copy = 0")
    weights = F.sum(F.round(F.col("weight") * WEIGHT_ONE).cast("long"))
    learned = {r["toxic"]: r for r in cells.where("learn").groupBy("toxic").agg(weights.alias("w"), F.count("*").alias("n")).collect()}
    every = {r["toxic"]: r["w"] / WEIGHT_ONE for r in rows.groupBy("toxic").agg(weights.alias("w")).collect()}
    most = max(r["n"] for r in learned.values())
    times = tuple(max(1, round(most / learned[t]["n"])) for t in (0, 1))
    total = sum(learned[t]["n"] * times[t] for t in (0, 1))
    # Both labels count alike, and a row counts 1 on average.
    scale = tuple(total / 2 / (learned[t]["w"] * times[t] / WEIGHT_ONE) for t in (0, 1))
    # Words in SEEN documents or more; in fewer, two at least, where a label has under 240.
    buckets = known_buckets(rows, min(SEEN, max(2, int(min(every.values())) // 30)), every)
    model = ToxicityModel(buckets, Network.random(len(buckets)), np.zeros((0, 0)), np.zeros(1))
    slots = cells.where("learn").agg(F.max("slot")).collect()[0][0] + 1
    for turn in range(ROUNDS):
        own = cells.where((F.col("slot") == turn % slots) & F.col("learn"))
        model.network = fit_round(own, model, scale, times, RATE * (1 - turn / ROUNDS), turn)
    model.languages = language_weights(rows, model)
    model.thresholds = best_thresholds(cells.where("test and copy = 0"), model)
    return model


def score_documents(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, from its whole text.

    A score is the network's probability with the threshold of the text's
    predicted language moved to 0.7; ``predicted`` is 1 from 0.7 on. Nothing but
    the text enters it. Null and empty texts and texts of unknown words alone get
    the score of an empty text; without a model scores are 0. A null doc_id is
    not held out; repeated rows and equal texts score alike; other columns are
    ignored; an empty table gives no rows. Texts of any length are scored whole.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", 1_000_000):
            found = np.zeros(batch.num_rows) if model is None else model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= BAR).cast("int").alias("predicted"))
