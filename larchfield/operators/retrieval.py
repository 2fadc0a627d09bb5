"""Rows to prose, token chunks, vectors, exact top-k search, confidence."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larchfield.functions.text import token_count, tokens
from larchfield.session import materialise

Encoder = Callable[[list[str]], np.ndarray]

# --- documents ------------------------------------------------------------------


def _dollars(value: Column, places: int = 0) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, places))


def policy_document(dim: DataFrame, target: str = "nl_document") -> DataFrame:
    """One self-contained prose document per policy row.

    Sentences name every field in words, so that text search finds a policy by
    meaning: cover with a sufficiency label, deductible with its tier, umbrella
    cover stated either way.
    """

    def text(column: str, missing: str) -> Column:
        if column not in dim.columns:
            return F.lit(missing)
        return F.coalesce(F.col(column).cast("string"), F.lit("None"))

    def number(column: str) -> Column:
        value = F.col(column).try_cast("double") if column in dim.columns else F.lit(0.0)
        return F.coalesce(value, F.lit(0.0))

    # The sentences of a policy document.
    limits = F.split(text("policy_csl", "N/A"), "/")
    person, event = (F.get(limits, F.lit(i)).try_cast("int") for i in (0, 1))
    csl = F.when(
        (F.size(limits) == 2) & person.isNotNull() & event.isNotNull(),
        F.concat(
            F.lit("The combined single limit (CSL) is "),
            text("policy_csl", "N/A"),
            F.lit(", meaning $"),
            person.cast("string"),
            F.lit("K per person and $"),
            event.cast("string"),
            F.lit(
                "K per occurrence. This single limit covers both bodily injury and property"
                " damage claims."
            ),
            F.when(event >= 1000, " This policy can cover large property damage claims up to $1,000,000.")
            .when(event >= 500, " This policy can cover property damage claims up to $500,000.")
            .otherwise(" This policy covers property damage claims up to $300,000."),
        ),
    ).otherwise(F.concat(F.lit("Coverage limit: "), text("policy_csl", "N/A"), F.lit(".")))

    whole_deductible = number("policy_deductable").cast("long")
    tier = (
        F.when(whole_deductible <= 500, "low")
        .when(whole_deductible <= 1000, "standard")
        .otherwise("high")
    )
    deductible = F.concat(
        F.lit("The deductible is "),
        _dollars(whole_deductible),
        F.lit(" ("),
        tier,
        F.lit(" deductible tier)."),
    )

    zero = (
        F.coalesce(F.col("_umbrella_limit_zero_flag"), F.lit(False))
        if "_umbrella_limit_zero_flag" in dim.columns
        else F.lit(True)
    )
    umbrella = F.when(
        ~zero & (number("umbrella_limit") > 0),
        F.concat(
            F.lit("This policy HAS umbrella coverage with an additional limit of "),
            _dollars(number("umbrella_limit")),
            F.lit(
                ". Umbrella coverage provides extra liability protection beyond the base"
                " CSL limit."
            ),
        ),
    ).otherwise(
        "This policy does NOT have umbrella coverage."
        " No additional liability protection beyond the base CSL limit."
    )

    document = F.concat(
        F.lit("Policy "),
        text("policy_number", "Unknown"),
        F.lit(" is an active auto insurance policy bound on "),
        F.substring(text("policy_bind_date", ""), 1, 10),
        F.lit(", issued in "),
        text("policy_state_full", "Unknown"),
        F.lit(" ("),
        text("policy_state_code", ""),
        F.lit("). "),
        csl,
        F.lit(" "),
        deductible,
        F.lit(" The annual premium is "),
        _dollars(number("policy_annual_premium"), 2),
        F.lit(". "),
        umbrella,
        F.lit(" Car ID: "),
        text("car_id", "N/A"),
        F.lit(". Customer ID: "),
        text("customer_id", "N/A"),
        F.lit("."),
    )
    return dim.withColumn(target, document)


def token_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Smallest, largest, mean and 95th percentile of the token counts."""
    return df.select(token_count(text).alias("n")).agg(
        F.min("n").alias("min_tokens"),
        F.max("n").alias("max_tokens"),
        F.round(F.avg("n"), 1).alias("mean_tokens"),
        F.round(F.percentile("n", 0.95), 1).alias("p95_tokens"),
    )


# --- chunks -----------------------------------------------------------------------


def chunk(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Overlapping windows of ``size`` tokens, one row per window.

    A text of at most ``size`` tokens is one chunk and stays exactly as it is.
    Otherwise windows start every ``size - overlap`` tokens, the last one being
    the first to reach the end. A NULL text is one NULL chunk of 0 tokens. Adds ``chunk_index``, ``chunk_text`` and
    ``chunk_token_count``; other columns are kept.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap

    def piece(content: Column, count: Column) -> Column:
        return F.struct(content.alias("chunk_text"), count.alias("chunk_token_count"))

    def windows(words: Column) -> Column:
        count = F.size(words)
        last = F.ceil((count - size) / step).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: piece(
                F.array_join(F.slice(words, i * step + 1, size), " "),
                F.least(F.lit(size), count - i * step),
            ),
        )
        return F.when(count <= size, F.array(piece(F.col(text), count))).otherwise(cut)

    # As a lambda argument the token array is computed once per text, not per window.
    pieces = F.get(F.transform(F.array(tokens(text)), windows), F.lit(0))
    # A NULL text stays visible as one chunk without tokens.
    pieces = F.coalesce(pieces, F.array(piece(F.col(text), F.lit(0))))
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(pieces).alias("chunk_index", "_piece")).select(
        *kept, "chunk_index", "_piece.*"
    )


def build_corpus(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Chunks together with the sizes they were cut with."""
    return chunk(df, text, size, overlap).withColumns(
        {"chunk_size_tokens": F.lit(size), "overlap_tokens": F.lit(overlap)}
    )


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """Chunks, chunks per source, sources that split, token range and mean, per chunking.

    Every source has a chunk 0 and, if it split, exactly one chunk 1, so both
    counts of sources are plain sums and need no distinct.
    """
    sources = F.count_if(F.col("chunk_index") == 0)
    return corpus.groupBy("chunk_size_tokens", "overlap_tokens").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.round(F.try_divide(F.count(F.lit(1)), sources), 3).alias("avg_chunks_per_source"),
        F.count_if(F.col("chunk_index") == 1).alias("sources_split"),
        F.min("chunk_token_count").alias("min_tokens"),
        F.max("chunk_token_count").alias("max_tokens"),
        F.round(F.avg("chunk_token_count"), 1).alias("mean_tokens"),
    )


# --- vectors ----------------------------------------------------------------------


#: Rows whose dense term counts are held at a time.
HASHED_ROWS = 1_000


def hashed_vectors(df: DataFrame, text: str, target: str = "embedding", width: int = 384) -> DataFrame:
    """Unit-length hashed term counts, without a model; a NULL text has no vector.

    The vectors are those of ``HashingTF`` and ``Normalizer`` over lower-case tokens.
    Each distinct token of a batch is hashed once.
    """

    def encode(texts: pa.Array) -> pa.Array:
        parts = [_hashed_counts(texts.slice(at, HASHED_ROWS), width) for at in range(0, len(texts), HASHED_ROWS)]
        matrix = np.concatenate([np.zeros((0, width), np.float32), *parts])
        starts = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * width)
        return pa.ListArray.from_arrays(starts, pa.array(matrix.ravel()), mask=texts.is_null())

    # A caller's filter on the vector would otherwise be moved below it and count every text once more.
    once = F.arrow_udf(encode, T.ArrayType(T.FloatType(), False)).asNondeterministic()
    return df.withColumn(target, once(F.lower(text)))


def _hashed_counts(texts: pa.Array, width: int) -> np.ndarray:
    """Unit-length counts of the hashed tokens of lower-case texts, a row per text."""
    # Splits at what ``tokens`` splits at; white space at an end leaves an empty piece.
    words = pc.utf8_split_whitespace(texts.fill_null(""))
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    at = coded.indices.to_numpy()
    bucket = term_hashes(coded.dictionary).astype(np.int64) % width
    full = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[at] > 0
    places = (rows * width + bucket[at])[full]
    counts = np.bincount(places, minlength=len(texts) * width).reshape(-1, width)
    norms = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    # Counts are whole numbers, so that a norm below 1 is that of a text without tokens.
    return (counts / np.maximum(norms, 1.0)[:, None]).astype(np.float32)


def term_hashes(words: pa.Array) -> np.ndarray:
    """32-bit Murmur3 hashes of the words' UTF-8 bytes with seed 42, as ``HashingTF`` takes them."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    joined = b"".join(words.cast(pa.binary()).to_pylist())
    data = np.frombuffer(joined + bytes(4), np.uint8).astype(np.uint32)

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    def mixed(block: np.ndarray) -> np.ndarray:
        return turned(block * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    def bytes_at(place: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Little-endian number of the ``count`` bytes, four at most, from each place on."""
        parts = (np.where(i < count, data[place + i], 0).astype(np.uint32) << np.uint32(8 * i) for i in range(4))
        return reduce(np.bitwise_or, parts)

    state = np.full(len(lengths), 42, np.uint32)
    for block in range(int(lengths.max(initial=0)) // 4):
        whole = np.flatnonzero(lengths >= 4 * block + 4)
        one = state[whole] ^ mixed(bytes_at(starts[whole] + 4 * block, np.full(len(whole), 4)))
        state[whole] = turned(one, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = lengths % 4
    state ^= mixed(bytes_at(starts + lengths - rest, rest))
    state ^= lengths.astype(np.uint32)
    state = (state ^ (state >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    state = (state ^ (state >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (state ^ (state >> np.uint32(16))).view(np.int32)


def embed(
    df: DataFrame,
    text: str,
    encoder_factory: Callable[[], Encoder] | None = None,
    target: str = "embedding",
    batch: int = 256,
) -> DataFrame:
    """Add unit-length vectors of ``text``.

    ``encoder_factory`` runs once per task and returns a function from a list of
    texts to a matrix. Without one, hashed term counts are used.
    """
    if encoder_factory is None:
        return hashed_vectors(df, text, target)
    schema = df.select("*", F.lit(None).cast("array<float>").alias(target)).schema

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_factory()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch].copy()
                matrix = np.asarray(encoder(part[text].tolist()), dtype=np.float32)
                part[target] = list(_unit_rows(matrix))
                yield part

    return df.mapInPandas(encode, schema)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best_places(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query, place and score of the k best rows of one block for each query; equal scores go by id.

    Scores are cut to 12 decimals: the last bits of a matrix product depend on
    where a row lies in its block, and copies of a vector must tie.
    """
    found, places, found_scores = [], [], []
    for start in range(0, len(queries), 256):
        scores = np.round(queries[start : start + 256] @ vectors.T, 12)
        for query, row in enumerate(scores, start):
            # All rows that reach the k-th best score, so that ties are decided by id.
            near = (
                np.flatnonzero(row >= np.partition(row, -k)[-k])
                if len(ids) > k
                else np.arange(len(ids))
            )
            near = near[np.lexsort((ids[near], -row[near]))][:k]
            found.append(np.full(len(near), query))
            places.append(near)
            found_scores.append(row[near])
    return tuple(np.concatenate([np.zeros(0, kind), *parts]) for kind, parts in ((int, found), (int, places), (float, found_scores)))


def _best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> pd.DataFrame:
    """The k best rows of one block for each query, by id."""
    found, places, scores = _best_places(queries, ids, vectors, k)
    return pd.DataFrame({"query_id": query_ids[found], "doc_id": ids[places], "score": scores})


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates per query; the limit also runs before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _stacked(column: pd.Series) -> np.ndarray:
    if column.empty:
        return np.zeros((0, 0))
    return _unit_rows(np.stack(column.to_numpy()).astype(np.float64))


def _flat(column: pa.ListArray) -> np.ndarray:
    """``_stacked`` without an object per vector."""
    if len(column) and pc.count_distinct(pc.list_value_length(column)).as_py() > 1:
        raise ValueError("vectors differ in length")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit_rows(values.reshape(len(column), -1)) if len(column) else np.zeros((0, 0))


#: Up to so many queries are held by every task and meet each vector where it is read.
FEW = 16
#: Centres that corpus vectors are gathered round: so many rows and vectors reach the driver.
CENTRES = 64
#: Scores are cut to 12 decimals; a bound must miss by more than that to count.
SLACK = 1e-9


def topk_cosine(queries: DataFrame, corpus: DataFrame, k: int = 5, block: int = 2_000) -> DataFrame:
    """Exact k nearest corpus rows per query by cosine, as ``(query_id, doc_id, score, rank)``.

    ``queries`` has ``query_id, embedding`` and ``corpus`` has ``doc_id,
    embedding``; zero vectors score 0, rows without a vector take no part.

    Up to 16 queries go to the corpus, which is read once: each batch of it sends
    on k rows per query, and no vector is written or shuffled. For more queries
    corpus vectors are gathered round 64 of them; a cluster's radius is the
    distance of its farthest vector. A query first searches one promising
    cluster, whose k-th score no result can fall below. By Cauchy and Schwarz no
    vector of a cluster scores more than the centre's score plus the radius, so
    the query goes on only to clusters where that reaches the k-th score. Where
    vectors have clusters, most of the corpus is never sent; where they have none,
    every cluster is searched. Clusters and queries are cut into blocks; every
    cell of two blocks is one small group that sends on k rows per query.
    """
    narrow = queries.select("query_id", "embedding").filter("embedding is not null")
    vectors = corpus.select("doc_id", "embedding").filter("embedding is not null")
    result = f"query_id {dict(narrow.dtypes)['query_id']}, doc_id {dict(vectors.dtypes)['doc_id']}, score double"
    few = narrow.limit(FEW + 1).toArrow()
    if few.num_rows <= FEW:
        return _ranked(_scanned(few, vectors, k, result), k)
    picked = vectors.orderBy(F.xxhash64("doc_id")).limit(CENTRES).collect()
    if not picked:
        return _ranked(queries.sparkSession.createDataFrame([], result), k)
    centres = _unit_rows(np.array([row.embedding for row in picked], dtype=np.float64))
    placed = materialise(_gathered(vectors, centres), "vector-clusters")
    sizes = {
        row._cluster: row
        for row in placed.groupBy("_cluster").agg(F.count("*").alias("rows"), F.max("_gap").alias("radius")).collect()
    }
    asked = materialise(_with_bounds(narrow, centres, sizes, k), "query-bounds")
    grid = _Grid(placed, {c: math.ceil(row.rows / (block * 25)) for c, row in sizes.items()}, asked, block)
    home = asked.select("query_id", "embedding", F.col("home").alias("_cluster"))
    first = materialise(_ranked(grid.search(home, k, result), k).drop("rank"), "home-hits")
    more = grid.search(_reached(asked, first, k), k, result)
    return _ranked(first.unionByName(more), k)


def _scanned(few: pa.Table, vectors: DataFrame, k: int, result: str) -> DataFrame:
    """The best k of every batch of the corpus for a few queries."""
    if not few.num_rows:
        return vectors.sparkSession.createDataFrame([], result)
    query_ids, queries = few.column("query_id").combine_chunks(), _flat(few.column("embedding").combine_chunks())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            ids = batch.column("doc_id")
            found, places, scores = _best_places(queries, ids.to_pandas().to_numpy(), _flat(batch.column("embedding")), k)
            yield pa.RecordBatch.from_arrays(
                [query_ids.take(pa.array(found)), ids.take(pa.array(places)), pa.array(scores)], ["query_id", "doc_id", "score"]
            )

    return vectors.mapInArrow(search, result)


def _gathered(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Each vector with its nearest centre and the distance from it."""

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            unit = _stacked(frame["embedding"])
            cluster = np.argmax(unit @ centres.T, axis=1) if len(frame) else np.zeros(0, int)
            gap = np.linalg.norm(unit - centres[cluster], axis=1) if len(frame) else np.zeros(0)
            yield frame.assign(_cluster=cluster.astype(np.int32), _gap=gap)

    return vectors.mapInPandas(nearest, vectors.withColumns({"_cluster": F.lit(0), "_gap": F.lit(0.0)}).schema)


def _with_bounds(queries: DataFrame, centres: np.ndarray, sizes: dict[int, Row], k: int) -> DataFrame:
    """Queries with the clusters, the most that each can score, and the one to search first."""
    present = np.array(sorted(sizes))
    radius = np.array([sizes[c].radius for c in present])
    enough = np.array([sizes[c].rows >= k for c in present])

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            near = _stacked(frame["embedding"]) @ centres[present].T
            # Clusters that cannot fill k ranks come last as a first choice.
            home = present[np.argmax(near - 10.0 * ~enough, axis=1)]
            yield frame.assign(
                home=home.astype(np.int32), clusters=[present.tolist()] * len(frame), bounds=(near + radius).tolist()
            )

    added = {"home": F.lit(0), "clusters": F.array(F.lit(0)), "bounds": F.array(F.lit(0.0))}
    return queries.mapInPandas(bound, queries.withColumns(added).schema)


def _reached(asked: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Queries with each further cluster that may hold one of their k best."""
    kth = first.groupBy(F.col("query_id").alias("_of")).agg(F.min("score").alias("_least"), F.count("*").alias("_n"))
    floor = F.when(F.col("_n") >= k, F.col("_least"))
    offered = asked.join(kth, F.col("query_id") == F.col("_of"), "left").select(
        "query_id", "embedding", "home", floor.alias("_floor"), F.explode(F.arrays_zip("clusters", "bounds")).alias("_offer")
    )
    may = F.col("_floor").isNull() | (F.col("_offer.bounds") >= F.col("_floor") - SLACK)
    return offered.filter((F.col("_offer.clusters") != F.col("home")) & may).select(
        "query_id", "embedding", F.col("_offer.clusters").alias("_cluster")
    )


class _Grid:
    """Cells of a block of queries and a block of one cluster's vectors.

    Rows go to blocks by hash of their id, so blocks are even. A vector is sent to
    those query blocks that have a query for its cluster.
    """

    def __init__(self, placed: DataFrame, parts: dict[int, int], asked: DataFrame, block: int) -> None:
        self.placed = placed
        self.parts = F.element_at(F.create_map(*(F.lit(x) for pair in parts.items() for x in pair)), F.col("_cluster"))
        self.query_blocks = max(1, math.ceil(asked.count() / block))

    def search(self, queries: DataFrame, k: int, result: str) -> DataFrame:
        """The best k of every cell for queries (query_id, embedding, _cluster)."""
        block = F.pmod(F.xxhash64("query_id"), F.lit(self.query_blocks)).cast("int")
        asked = queries.withColumn("_qb", block)
        # Named anew, so that the two sides of the cogroup can be told apart.
        wanted = asked.select("_cluster", "_qb").distinct().toDF("_cluster", "_qb")
        left = asked.withColumn("_cb", F.explode(F.sequence(F.lit(0), self.parts - 1)))
        right = self.placed.withColumn("_cb", F.pmod(F.xxhash64("doc_id"), self.parts).cast("int")).join(wanted, "_cluster")
        keys = ("_cluster", "_cb", "_qb")

        def cell(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if own.empty or held.empty:
                return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
            return _best(
                own["query_id"].to_numpy(),
                _stacked(own["embedding"]),
                held["doc_id"].to_numpy(),
                _stacked(held["embedding"]),
                k,
            )

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, result)


# --- answers ----------------------------------------------------------------------


# Similarity of unrelated and of near-identical text.
UNRELATED, IDENTICAL = 0.30, 0.95


def confidence(topk: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Mean of the three best scores, scaled to 0..1 with four places."""
    scaled = (F.avg("score") - UNRELATED) / (IDENTICAL - UNRELATED)
    return (
        topk.filter("rank <= 3")
        .groupBy(*keys)
        .agg(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)), 4).alias("confidence"))
    )


def _by_rank(value: Column | str) -> Column:
    """Values of at most k rows per group as an array in rank order."""
    value = F.col(value) if isinstance(value, str) else value
    pairs = F.sort_array(F.collect_list(F.struct("rank", value.alias("value"))))
    return F.transform(pairs, lambda pair: pair["value"])


def sources(topk: DataFrame, source: str, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Distinct sources per question, best first."""
    return topk.groupBy(*keys).agg(
        F.array_distinct(_by_rank(F.col(source).cast("string"))).alias("source_policies")
    )


def rag_prompt(
    topk: DataFrame, source: str, text: str, question: str, instructions: str | None = None
) -> DataFrame:
    """One prompt per question with its numbered sources in rank order.

    ``topk`` carries the question, and per rank the source id, chunk text and
    score.
    """
    # Fixed value: the head of a source block.
    block = F.format_string(
        "[SOURCE %d | Policy %s | score=%s]\n%s",
        F.col("rank"),
        F.col(source).cast("string"),
        F.format_number("score", 3),
        F.col(text),
    )
    head = instructions or (
        "Answer the question from the policy excerpts below and from nothing else.\n"
        "Name the policy numbers you rely on. Say so if the excerpts do not settle it.\n"
        "A limit X/Y is $XK per person and $YK per occurrence; it covers bodily injury and"
        " property damage together."
    )
    return topk.groupBy("query_id", question).agg(
        F.concat(
            F.lit(head + "\n\nPOLICY EXCERPTS\n"),
            F.array_join(_by_rank(block), "\n\n"),
            F.lit("\n\nQUESTION\n"),
            F.first(question),
        ).alias("prompt"),
        F.count(F.lit(1)).alias("chunks_retrieved"),
    )


def confidence_pivot(history: DataFrame, approaches: Sequence[str]) -> DataFrame:
    """Mean confidence per question, one column per approach, and their means.

    Approaches are named by the caller, so no extra pass looks for them. The row
    without question holds the means over all questions.
    """
    figures = [
        F.round(F.avg(F.when(F.col("approach") == name, F.col("confidence"))), 4).alias(name)
        for name in approaches
    ]
    return (
        history.rollup("question").agg(F.grouping_id().alias("_all"), *figures)
        .withColumn("question", F.when(F.col("_all") == 1, "average").otherwise(F.col("question")))
        .drop("_all")
    )


def query_history(
    answers: DataFrame, chunk_size: int, overlap: int, at: Column | None = None
) -> DataFrame:
    """History rows from ``approach, question, answer, confidence, source_policies, chunks_retrieved``."""
    return answers.select(
        F.expr("uuid()").alias("query_id"),
        "approach",
        "question",
        "answer",
        F.col("confidence").cast("float").alias("confidence"),
        "source_policies",
        F.col("chunks_retrieved").cast("int").alias("chunks_retrieved"),
        F.lit(chunk_size).alias("chunk_size_tokens"),
        F.lit(overlap).alias("overlap_tokens"),
        (F.current_timestamp() if at is None else at).alias("retrieved_at"),
    )
