"""Mixture-controlled packing by deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larchfield.llm.common import batches_of, materialise, scratch_path, worker_state
from larchfield.llm.runs import words_of

SEQUENCE = 2048
WINDOW_SEQUENCES = 32
END_ID = 1
CACHED_WORDS = 400_000
#: Bytes of text that are coded at a time. Larger slices look remembered words up less often, but take more memory.
SLICE = 4_000_000
LEARNED = 20_000


class WordTokenizer:
    """Token ids of texts by a tokenizer whose tokens never span white space.

    The tokenizers' own encoder runs once for each distinct run of characters
    without ASCII white space; the ids of a text are those of its runs in order.
    Special tokens inside a run are told apart by the encoder. At most
    ``CACHED_WORDS`` runs are remembered, as Arrow and numpy arrays: ``words``, and
    the ids of the i-th from ``starts[i]`` on, ``lengths[i]`` of them.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = pa.array([], pa.large_binary())
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary()))
        coded = self.tokenizer.encode(pc.binary_join(listed, b" ")[0].as_py().decode(), add_special_tokens=False)
        first = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(coded.ids))[::2]
        ends = np.cumsum(pc.utf8_length(words.cast(pa.large_string())).to_numpy() + 1)
        return np.array(coded.ids, np.uint32), np.diff(np.searchsorted(first, ends), prepend=0)

    def coded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and start and length in them of each of the distinct words."""
        at = pc.index_in(words, value_set=self.words)
        missing = words.filter(at.is_null())
        learned = [
            self.learn(missing.slice(start, LEARNED)) for start in range(0, len(missing), LEARNED)
        ]
        ids = np.concatenate([self.ids, *(i for i, _ in learned)])
        lengths = np.concatenate([self.lengths, *(n for _, n in learned)])
        starts = np.cumsum(lengths) - lengths
        place = at.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(missing))
        if len(lengths) <= CACHED_WORDS:
            self.words = pa.concat_arrays([self.words, missing])
            self.ids, self.lengths = ids, lengths
        return ids, starts[place], lengths[place]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned 32-bit ids of all texts, each closed by ``END_ID``, and row bounds."""
        words, numbers, bounds = words_of(texts)
        ids, starts, lengths = self.coded(words)
        # One more word is the closing id, which stands behind the last word of each row.
        ids, starts, lengths = np.append(ids, np.uint32(END_ID)), np.append(starts, len(ids)), np.append(lengths, 1)
        runs = np.insert(numbers, bounds[1:], len(words))
        sizes = lengths[runs]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(starts[runs] - ends + sizes, sizes) + np.arange(total)]
        return flat, np.append(0, ends[bounds[1:] + np.arange(len(texts))])


def tokenizer_at(path: str) -> WordTokenizer:
    return worker_state(("packing", path), lambda: WordTokenizer(path))


@dataclass(frozen=True)
class Phase:
    """Windows ``first`` to ``last`` (exclusive) with fixed quanta.

    In each window queue ``j`` earns ``quanta[j] / den`` tokens of deficit and
    spends all whole ones; the rest is carried on.
    """

    first: int
    last: int
    served: tuple[int, ...]
    quanta: tuple[int, ...]
    den: int

    def total(self, queue: int, window: int) -> int:
        """Tokens of a queue served before ``window``."""
        return self.served[queue] + (window - self.first) * self.quanta[queue] // self.den

    def totals(self, window: int) -> np.ndarray:
        """``total`` of every queue; in Python's integers where 64 bits may not do."""
        served, whole, rest, most = self._parts
        past = window - self.first
        kind = np.int64 if past * most < 1 << 62 else object
        return served + past * whole + (past * rest.astype(kind) // self.den).astype(np.int64)

    @cached_property
    def _parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        split = np.array([divmod(q, self.den) for q in self.quanta], object).reshape(-1, 2)
        rest = split[:, 1]
        return np.array(self.served, np.int64), split[:, 0].astype(np.int64), rest, max(rest, default=0)


def plan_phases(sizes: list[int], window: int, shares: list[float] | None = None) -> list[Phase]:
    """The deficit round-robin in closed form: phases between which queues run dry.

    Without ``shares`` every queue has its own share of all tokens as target, so
    that all run dry in the last window: one phase. With ``shares`` a queue that
    runs dry leaves its quantum to the others in proportion.
    """
    total = sum(sizes)
    if not total:
        return []
    if shares is None:
        windows = -(-total // window)
        return [Phase(0, windows, (0,) * len(sizes), tuple(sizes), windows)]
    weights = [max(0, round(s * 10**9)) for s in shares]
    served, first, phases = [0] * len(sizes), 0, []
    while sum(served) < total:
        left = [n - s for n, s in zip(sizes, served, strict=True)]
        active = [w if rest else 0 for w, rest in zip(weights, left, strict=True)]
        if not any(active):  # only queues without a target are left
            active = left
        den = sum(active)
        quanta = [window * a for a in active]
        whole = min(rest * den // q for rest, q in zip(left, quanta, strict=True) if q)
        if whole:
            phases.append(Phase(first, first + whole, tuple(served), tuple(quanta), den))
            served = [phases[-1].total(j, first + whole) for j in range(len(sizes))]
            first += whole
        else:
            give = [min(rest, q // den) for rest, q in zip(left, quanta, strict=True)]
            if not any(give):
                give = [min(rest, 1) for rest in left]
            spare = window - sum(give)
            for j in range(len(sizes)):
                more = min(left[j] - give[j], spare)
                give[j], spare = give[j] + more, spare - more
            phases.append(Phase(first, first + 1, tuple(served), tuple(give), 1))
            served = [s + g for s, g in zip(served, give, strict=True)]
            first += 1
    return phases


class Layout:
    """Where each token of each queue stands in the packed stream."""

    def __init__(self, phases: list[Phase], queues: int) -> None:
        self.phases, self.queues = phases, queues
        self.starts = lru_cache(maxsize=64)(self._starts)

    def _starts(self, phase: Phase, window: int) -> np.ndarray:
        """Stream places at which the queues' parts of a window begin, and its end."""
        before, after = phase.totals(window), phase.totals(window + 1)
        return int(before.sum()) + np.concatenate([[0], np.cumsum(after - before)])

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int]]:
        """(place, length) of the runs that tokens ``start``.. of a queue fill."""
        at, end = start, start + length
        for phase in self.phases:
            while at < end and at < phase.total(queue, phase.last):
                step = phase.quanta[queue]
                window = phase.first + ((at - phase.served[queue] + 1) * phase.den - 1) // step
                stop = min(end, phase.total(queue, window + 1))
                place = int(self.starts(phase, window)[queue]) + at - phase.total(queue, window)
                while at < stop:
                    run = min(stop - at, SEQUENCE - place % SEQUENCE)
                    yield place, run
                    at, place = at + run, place + run


def tokenised(docs: DataFrame, column: str, tokenizer: str, slice_bytes: int = SLICE) -> DataFrame:
    """Ids and place of each document, written once; ``slice_bytes`` of text are coded at a time.

    ``start`` counts the tokens of the same source that the same task has seen.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokenizer_at(tokenizer), TaskContext.get().partitionId()
        seen: dict[str | None, int] = {}
        for batch in batches_of(batches, "text", slice_bytes):
            ids, bounds = coder.encode(batch.column("text"))
            tokens = np.diff(bounds)
            starts = []
            for name, count in zip(batch.column("source").to_pylist(), tokens.tolist(), strict=True):
                starts.append(seen.get(name, 0))
                seen[name] = starts[-1] + count
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer((4 * bounds).tobytes()), pa.py_buffer(ids.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([part] * batch.num_rows, pa.int64()),
                    batch.column("source"),
                    pa.array(starts, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    packed.cast(pa.binary()),
                ],
                ["doc_id", "part", "source", "start", "tokens", "ids"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(column).cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    path = scratch_path(docs.sparkSession, "tokens")
    schema = "doc_id long, part long, source string, start long, tokens long, ids binary"
    rows.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def number_queues(parts: DataFrame) -> DataFrame:
    """Every source with its queue and tokens: most rows first, a null source last.

    Only one row per source is ordered.
    """
    totals = parts.groupBy("source").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.desc("rows"), "source"))
    return materialise(totals.select("source", (place - 1).cast("int").alias("queue"), "n"), "queues")


def wanted_shares(queues: DataFrame, shares: dict[str, float], size: int) -> list[float]:
    """The share of each queue; a name that is no source is an error."""
    named = queues.where(F.col("source").isin(list(shares))).collect() if shares else []
    unknown = set(shares) - {r["source"] for r in named}
    if unknown and size:
        raise ValueError(f"shares of unknown sources: {sorted(unknown)}")
    out = [0.0] * size
    for r in named:
        out[r["queue"]] = shares[r["source"]]
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    source: str = "source",
    shares: dict[str, float] | None = None,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens, mixed by source.

    Each source is a queue of its documents' ids, each closed by id 1. A window
    of 32 sequences takes from every queue the tokens it has earned: its target
    share of the window plus the deficit carried from earlier windows, always
    less than one token. Targets are the sources' shares of all tokens, so all
    queues end in the last window; ``shares`` names other targets (sources left
    out come last). The running totals of this round-robin have a closed form,
    so each document finds its places from its queue's running offset alone: the
    windows' deficits carry over partitions without a task that sees them all.
    Sequences are cut from the stream one after the other, so only the last one
    of all is shorter than 2048. Every source has a queue of its own, and so have
    rows of a null source. The driver holds one total per source; where a
    window's parts begin is worked out once per window and task.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, queue. A null or empty text is its closing id alone; a
    null doc_id is carried along; repeated rows are packed each on its own; texts
    of any length are cut where windows and sequences end; a source in ``shares``
    that no row has is an error; an empty table gives no rows. Other columns are
    ignored.
    """
    rows = tokenised(docs, source, tokenizer, slice_bytes)
    grouped = rows.groupBy("part", "source").agg(F.sum("tokens").alias("n"), F.count("*").alias("rows"))
    parts = materialise(grouped, "source-parts")
    queues = number_queues(parts)
    sizes = [int(n) for n in queues.select("queue", "n").toPandas().sort_values("queue")["n"]]
    wanted = None if shares is None else wanted_shares(queues, shares, len(sizes))
    phases = plan_phases(sizes, SEQUENCE * WINDOW_SEQUENCES, wanted)
    numbered = parts.alias("p").join(queues.alias("q"), F.col("p.source").eqNullSafe(F.col("q.source")))
    parts = numbered.select("part", F.col("p.source").alias("name"), "queue", F.col("p.n").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialise(
        parts.select(F.col("part").alias("of"), "name", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
        "queue-bases",
    )
    own = (F.col("part") == F.col("of")) & F.col("source").eqNullSafe(F.col("name"))
    placed = rows.join(bases, own).select(
        "doc_id", "queue", (F.col("base") + F.col("start")).alias("start"), "tokens", "ids"
    )
    layout = (phases, len(sizes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("packing cut")
        plan = Layout(*layout)
        for batch in batches_of(batches, "ids"):
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "queue", "start", "tokens", "ids"))
            for doc_id, queue, start, tokens, ids in zip(*columns, strict=True):
                done, view = 0, memoryview(ids)
                for place, run in plan.pieces(queue, start, tokens):
                    crc = zlib.crc32(view[4 * done : 4 * (done + run)])
                    sequence, offset = divmod(place, SEQUENCE)
                    out.append((doc_id, done, run, crc, tokens, sequence, offset, queue))
                    done += run
            fields = list(zip(*out, strict=True)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(f, k) for f, k in zip(fields, PIECE_TYPES, strict=True)], PIECE_NAMES
            )

    return placed.mapInArrow(cut, PIECES)


PIECES = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
    + [T.StructField("queue", T.IntegerType())]
)
PIECE_NAMES = PIECES.names
PIECE_TYPES = [pa.int64()] * 7 + [pa.int32()]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
