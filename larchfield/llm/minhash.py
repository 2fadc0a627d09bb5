"""Near-duplicate documents by consistent weighted sampling of TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of, free_name, materialise, worker_state
from larchfield.llm.components import components
from larchfield.llm.hashing import mix, rows_of, shingle_hashes, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 3
WORD_BUCKETS = 1 << 16
VARIATES = 1 << 14
SMALL_BUCKET = 32
# Of 48 samples a pair at 0.8 shares fewer than 24 with a probability of 8e-7.
LEAST_SAME = 24
BLOCK = 1024
BLOCK_BYTES = 4_000_000


def word_bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each of 65,536 hashed word buckets occurs, and how many there are.

    Counted over all documents. The table has a fixed size whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near-dedup")
        total, seen = np.zeros(WORD_BUCKETS + 1, np.int64), 0
        for batch in batches_of(batches, "text", 1_000_000):
            words, bounds = word_hashes(batch.column("text"))
            key = rows_of(bounds) * WORD_BUCKETS + word_bucket(words)
            total[:-1] += np.bincount(np.unique(key) % WORD_BUCKETS, minlength=WORD_BUCKETS)
            seen += batch.num_rows
        total[-1] = seen
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(WORD_BUCKETS + 1, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out[:-1], int(out[-1])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each word bucket."""
    counts, total = document_frequencies(docs)
    return (np.log((total + 1) / (counts + 1)) + 1).astype(np.float32)


def features(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, shingle, TF-IDF weight, and where rows start.

    A shingle is five consecutive words (all words of a shorter text). Its weight
    is how often it occurs times the mean inverse document frequency of its words.
    """
    words, bounds = word_hashes(texts)
    shingles, starts = shingle_hashes(words, bounds, WORDS)
    row = rows_of(starts)
    sums = np.concatenate([[0.0], np.cumsum(idf[word_bucket(words)], dtype=np.float64)])
    first = bounds[:-1][row] + np.arange(len(row)) - starts[:-1][row]
    length = np.minimum(np.diff(bounds), WORDS)[row]
    mean = (sums[first + length] - sums[first]) / np.maximum(length, 1)
    order = np.lexsort((shingles, row))
    row, shingles, mean = row[order], shingles[order], mean[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(row)))
    row = row[at]
    weights = (times * mean[at]).astype(np.float32)
    return row, shingles[at], weights, np.searchsorted(row, np.arange(len(texts) + 1))


@lru_cache(maxsize=1)
def variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers of the sampler: r and c are Gamma(2, 1), beta is uniform.

    A shingle uses the entry that its hash names for each sample. Two shingles
    share an entry now and then; the sample still tells them apart.
    """
    random = np.random.default_rng(20)
    size = (BANDS * ROWS, VARIATES)
    r = random.gamma(2.0, 1.0, size).astype(np.float32)
    log_c = np.log(random.gamma(2.0, 1.0, size)).astype(np.float32)
    return r, log_c, random.random(size, dtype=np.float32)


def samples(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Improved consistent weighted samples: a hash for each row and sample.

    For weight w: t = floor(ln w / r + beta), ln y = r (t - beta), and the shingle
    with the least ln a = ln c - ln y - r is drawn together with its t. Two rows
    draw the same with a probability equal to their weighted Jaccard similarity.
    Rows must not be empty.
    """
    r_all, c_all, b_all = variates()
    log_w = np.log(weights)
    out = np.empty((len(starts) - 1, BANDS * ROWS), np.uint64)
    counts = np.diff(starts)
    for k in range(BANDS * ROWS):
        entry = ((shingles * np.uint64(2 * k + 1)) >> np.uint64(20)).astype(np.int64) & (VARIATES - 1)
        r, beta = r_all[k][entry], b_all[k][entry]
        t = np.floor(log_w / r + beta)
        log_a = c_all[k][entry] - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, starts[:-1])
        hit = np.flatnonzero(log_a == np.repeat(least, counts))
        # Of equal values the least shingle is drawn; shingles are in order.
        drawn = hit[np.searchsorted(hit, starts[:-1])]
        out[:, k] = mix(shingles[drawn] ^ mix(t[drawn].astype(np.int64).astype(np.uint64)))
    return out


def text_keys(words: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128-bit hashes of the word sequences."""
    place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
    keys = np.zeros((len(bounds) - 1, 2), np.uint64)
    for half, salt in enumerate((0x9E3779B1, 0x85EBCA77)):
        part = mix(words * np.uint64(2 * salt + 1) + mix(place.astype(np.uint64) + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
        keys[:, half] = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return [k.tobytes() for k in keys]


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, mark of the text, key of the word sequence and samples of every document, written once.

    Documents without words have null key and samples.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near-dedup")
        for batch in batches_of(batches, "text", 1_000_000):
            texts = batch.column("text")
            words, bounds = word_hashes(texts)
            keys = text_keys(words, bounds)
            _, shingles, weights, starts = features(texts, idf)
            full = np.flatnonzero(np.diff(starts))
            drawn: list = [None] * batch.num_rows
            if len(full):
                made = samples(shingles, weights, np.append(starts[:-1][full], starts[-1]))
                for at, values in zip(full, (made >> np.uint64(32)).astype(np.uint32).view(np.int32), strict=True):
                    drawn[at] = values
            named = [k if v is not None else None for k, v in zip(keys, drawn, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(named, pa.binary()), pa.array(drawn, pa.list_(pa.int32()))],
                ["doc_id", "mark", "key", "samples"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("mark"), text.alias("text"))
    schema = "doc_id long, mark string, key binary, samples array<int>"
    return materialise(rows.mapInArrow(sign, schema), "signatures")


def band_members(nodes: DataFrame) -> DataFrame:
    """Each key in the bucket of each of its bands: (bucket, band, key).

    Bands of three samples split all samples.
    """
    bands = np.arange(BANDS * ROWS).reshape(BANDS, ROWS)
    hashed = [
        F.xxhash64(F.lit(ROWS), F.lit(number), *(F.get("samples", F.lit(int(i))) for i in band))
        for number, band in enumerate(bands)
    ]
    return nodes.select(F.posexplode(F.array(*hashed)).alias("band", "bucket"), "key").select("bucket", "band", "key")


def candidate_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs to verify first in buckets (bucket, band, key), and the members of large buckets.

    In a bucket of up to 32 keys all pairs are taken. In a larger one every
    member is paired with one leader first: the key that shares most buckets with
    others, which in a family of copies is the one that the others resemble.
    What that leaves apart is compared by ``residual_links``.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(members.join(sizes, "bucket"), "bucket-members")
    weight = shared.groupBy("key").agg(F.sum("n").alias("weight"))
    small = shared.where(F.col("n") <= SMALL_BUCKET)
    pairs = small.select("bucket", F.col("key").alias("a")).join(
        small.select("bucket", F.col("key").alias("b")), "bucket"
    )
    large = shared.where(F.col("n") > SMALL_BUCKET)
    leaders = (
        large.join(weight, "key")
        .groupBy("bucket")
        .agg(F.max(F.struct("weight", "key")).alias("top"))
        .select("bucket", F.col("top.key").alias("leader"))
    )
    led = materialise(large.join(leaders, "bucket").select("bucket", "band", "key", "leader"), "bucket-leaders")
    stars = led.select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))
    return pairs.select("a", "b").where("a < b").union(stars.where("a < b")).distinct(), led


def residual_links(
    large: DataFrame, nodes: DataFrame, roots: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float
) -> DataFrame:
    """Pairs (a, b) of components that verified links of members of large buckets join.

    Every member outside the bucket's largest component meets all members, in a
    grid of blocks of at most 1,024 keys and about ``BLOCK_BYTES`` of text. Texts
    come along, so a cell verifies its pairs itself and sends on a spanning forest
    of what it has linked: fewer links than it has members, however many pairs
    are alike.
    """
    labelled = large.select("bucket", "band", "key").join(roots.withColumnRenamed("node", "key"), "key", "left")
    sized = texts.select("key", F.octet_length("text").alias("bytes"))
    labelled = labelled.withColumn("root", F.coalesce("root", "key")).join(sized, "key")
    labelled = materialise(labelled, "bucket-roots")
    tops = (
        labelled.groupBy("bucket", "root")
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "root", "bytes")).alias("top"), F.sum("n").alias("total"), F.sum("bytes").alias("bytes"))
        .select(
            "bucket",
            F.col("top.root").alias("main"),
            blocks(F.col("total") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("lefts"),
            blocks(F.col("total"), F.col("bytes")).alias("rights"),
            (F.col("total") - F.col("top.n")).alias("others"),
        )
        .where("others > 0")
    )
    apart = labelled.drop("bytes").join(tops, "bucket").join(nodes, "key").join(texts, "key")
    fields = ("bucket", "band", "key", "root", "main", "samples", "text")
    block = F.xxhash64("key", F.lit(1))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        spread = rows.withColumn(own[:-1], F.pmod(block, F.col(own)).cast("int"))
        spread = spread.withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return spread.select(*fields, "left", "right").groupBy("bucket", "left", "right")

    def link(left: pa.Table, right: pa.Table) -> pa.Table:
        return link_blocks(left, right, idf, threshold)

    left = dealt(apart.where("root <> main"), "lefts", "rights")
    # Columns named anew tell the two sides of this self-join apart.
    right = dealt(apart.toDF(*apart.columns), "rights", "lefts")
    return left.cogroup(right).applyInArrow(link, "a binary, b binary")


def blocks(rows: Column, size: Column) -> Column:
    """How many blocks hold so many keys with so many bytes of text."""
    return F.greatest(F.ceil(rows / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")


def link_blocks(left: pa.Table, right: pa.Table, idf: np.ndarray, threshold: float) -> pa.Table:
    """Pairs of components of one block of a bucket's grid: a forest of those its verified pairs join.

    A pair is tried if 24 of the 48 samples are the same, only in the first bucket
    that both keys share, and only while its keys are in different components;
    pairs that share more samples come first.
    """
    size = left.num_rows
    both = pa.concat_tables([left, right.select(left.column_names)]).combine_chunks()
    if not size or not right.num_rows:
        return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
    key, part = codes(both.column("key")), codes(both.column("root"))
    drawn = both.column("samples").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    drawn = drawn.reshape(-1, BANDS * ROWS)
    main = np.array([r == m for r, m in zip(right["root"].to_pylist(), right["main"].to_pylist(), strict=True)])
    early = int(left["band"][0].as_py()) * ROWS
    other, turned = drawn[size:], np.ascontiguousarray(drawn[size:].T)
    similar = Similarity(both.column("text").combine_chunks(), idf)
    found: list[tuple[int, int]] = []
    for at in range(size):
        same = np.zeros(len(other), np.uint8)
        for k in range(BANDS * ROWS):
            same += turned[k] == drawn[at, k]
        # Of two members outside the main component each pair comes up twice.
        hit = np.flatnonzero((same >= LEAST_SAME) & (main | (key[size:] > key[at])))
        if early and len(hit):
            shared = (other[hit, :early] == drawn[at, :early]).reshape(len(hit), -1, ROWS)
            hit = hit[~shared.all(axis=2).any(axis=1)]
        hit = hit[np.argsort(-same[hit].astype(np.int64), kind="stable")] + size
        tried = 16
        while len(hit := hit[part[hit] != part[at]]):
            now, hit = hit[:tried], hit[tried:]
            tried *= 4
            for match in now[similar.to(at, now) >= threshold]:
                if part[match] != part[at]:
                    part[part == part[match]] = part[at]
                    found.append((at, int(match)))
    first, second = np.array(found, np.int64).reshape(-1, 2).T
    names = both.column("root").combine_chunks()
    return pa.table({"a": names.take(pa.array(first)), "b": names.take(pa.array(second))})


class Similarity:
    """Weighted Jaccard similarity of one of some texts to several others."""

    def __init__(self, texts: pa.Array, idf: np.ndarray) -> None:
        _, shingles, weights, self.starts = features(texts, idf)
        names, self.shingles = np.unique(shingles, return_inverse=True)
        self.weights = weights.astype(np.float64)
        self.totals = np.add.reduceat(np.append(self.weights, 0.0), self.starts[:-1]) * (np.diff(self.starts) > 0)
        self.own = np.zeros(len(names))

    def to(self, one: int, others: np.ndarray) -> np.ndarray:
        mine = slice(self.starts[one], self.starts[one + 1])
        self.own[self.shingles[mine]] = self.weights[mine]
        sizes = np.diff(self.starts)[others]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[others] - ends + sizes, sizes) + np.arange(int(ends[-1]))
        lesser = np.minimum(self.own[self.shingles[at]], self.weights[at])
        shared = np.bincount(np.repeat(np.arange(len(others)), sizes), lesser, minlength=len(others))
        self.own[self.shingles[mine]] = 0.0
        return shared / np.maximum(self.totals[one] + self.totals[others] - shared, 1e-12)


def codes(values: pa.ChunkedArray) -> np.ndarray:
    """The rank of each value among the distinct ones, in byte order."""
    encoded = values.combine_chunks().dictionary_encode()
    names = encoded.dictionary.to_pylist()
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    return rank[encoded.indices.to_numpy()]


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) of keys whose weighted Jaccard similarity is enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches_of(batches, "text_a", 500_000):
            for batch in batches_of([whole], "text_b", 500_000):
                similarity = weighted_jaccard(batch.column("text_a"), batch.column("text_b"), idf)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(similarity)], ["a", "b", "similarity"]
                )

    joined = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
    )
    found = joined.select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a binary, b binary, similarity double"
    )
    return found.where(F.col("similarity") >= threshold)


def weighted_jaccard(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Sum of lesser over sum of greater weights, row by row."""
    row_a, shingle_a, weight_a, _ = features(left, idf)
    row_b, shingle_b, weight_b, _ = features(right, idf)
    row, shingle = np.concatenate([row_a, row_b]), np.concatenate([shingle_a, shingle_b])
    weight = np.concatenate([weight_a, weight_b]).astype(np.float64)
    order = np.lexsort((shingle, row))
    row, shingle, weight = row[order], shingle[order], weight[order]
    twice = np.flatnonzero((row[1:] == row[:-1]) & (shingle[1:] == shingle[:-1]))
    size = len(left)
    shared = np.bincount(row[twice], np.minimum(weight[twice], weight[twice + 1]), minlength=size)
    total = np.bincount(row, weight, minlength=size)
    return shared / np.maximum(total - shared, 1e-12)


def key_texts(docs: DataFrame, signed: DataFrame, keys: DataFrame) -> DataFrame:
    """One text for each of the wanted keys: that of the key's least doc_id."""
    holders = (
        signed.where("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("holder"))
        .join(keys, "key")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("holder_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(holders, F.col("holder_id").eqNullSafe(F.col("holder"))).select("key", "text")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where rows of several texts share a doc_id, only the key's own text."""
        for batch in batches_of(batches, "text"):
            found = text_keys(*word_hashes(batch.column("text")))
            yield batch.filter(pa.array([a == b for a, b in zip(found, batch.column("key").to_pylist(), strict=True)]))

    texts = joined.mapInArrow(own, "key binary, text string")
    return materialise(texts.groupBy("key").agg(F.min("text").alias("text")), "key-texts")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The near-duplicate class of every document: doc_id and class_id.

    Words are runs of letters and digits of the lower-cased text; documents with
    the same words are one key. Keys are compared by weighted Jaccard similarity
    of TF-IDF shingles of five words. Candidates share one of 16 bands of three
    improved consistent weighted samples (a pair at 0.8 is missed with a
    probability of 1 in 90,000) and are verified exactly on whole texts. Classes are
    the components of verified links; class_id is the least doc_id of the class.

    Members of a bucket with more than 32 keys are compared with one leader
    first. Then every member outside the bucket's largest component is compared
    with all members that are in another component, by samples (a pair at 0.8 is
    missed with a probability of 1 in 1,200,000 more) and then exactly, inside
    blocks of a grid that send on links only. The comparisons of this step, though
    not its rows, grow with the members apart times the members of the bucket.

    One row per row of ``docs``. A text that is null, empty or without words is
    a class of its own, also when repeated (class_id is its doc_id); repeated
    rows share a class; a null doc_id is carried along and names a class only if
    the class has no other id. An empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    return with_classes(rooted_rows(docs, threshold))


def merged(roots: DataFrame, joined: DataFrame) -> DataFrame:
    """Components (node, root) after those that ``joined`` (node, root) puts together.

    Nodes of ``joined`` are roots, or keys that had no link.
    """
    target = joined.select(F.col("node").alias("of"), F.col("root").alias("to"))
    moved = roots.join(target, F.col("root") == F.col("of"), "left")
    single = joined.join(roots.select(F.col("node").alias("of")), F.col("node") == F.col("of"), "left_anti")
    return moved.select("node", F.coalesce("to", "root").alias("root")).union(single)


def rooted_rows(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, mark of the text, key and root key of the class, a row per row of ``docs``."""
    idf = inverse_frequencies(docs)
    signed = signatures(docs, idf)
    nodes = signed.where("key is not null").groupBy("key").agg(F.first("samples").alias("samples"))
    nodes = materialise(nodes, "signature-keys")
    pairs, large = candidate_pairs(band_members(nodes))
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    texts = key_texts(docs, signed, wanted)
    links = materialise(verified(pairs, texts, idf, threshold).select("a", "b"), "verified")
    roots = materialise(components(links), "roots")
    if not large.isEmpty():
        joined = materialise(residual_links(large, nodes, roots, texts, idf, threshold), "residual-links")
        roots = materialise(merged(roots, materialise(components(joined), "roots")), "roots")
    return signed.join(roots, F.col("key") == F.col("node"), "left").select(
        "doc_id", "mark", "key", F.coalesce("root", "key").alias("root")
    )


def with_classes(rooted: DataFrame) -> DataFrame:
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    joined = rooted.alias("r").join(least.alias("l"), F.col("r.root") == F.col("l.root"), "left")
    return joined.select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id")
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class: of its least doc_id, of that the text with the least MD5.

    A null doc_id leads only a class without other ids. Of rows that share both
    id and text one stays, that with the least hash of its columns. Documents
    without words all stay. Other columns pass through, whatever their names.
    """
    rooted = materialise(rooted_rows(docs, threshold).where("root is not null"), "rooted")
    held = rooted.groupBy("root", "doc_id", "mark").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark"))
    lead = held.groupBy("root").agg(first.alias("lead"))
    held = held.join(lead, "root")
    leads = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("mark") == F.col("lead.mark"))
    of_id, of_mark = (free_name(docs.columns, name) for name in ("of_id", "of_mark"))
    named = [F.col("doc_id").alias(of_id), F.col("mark").alias(of_mark)]
    gone = materialise(held.where(~leads).select(*named), "gone")
    repeated = materialise(held.where(leads & (F.col("n") > 1)).select(*named), "repeated")
    mark = F.md5(F.col("text").cast("string"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (mark == F.col(of_mark))
    single = docs.join(gone.union(repeated), same, "left_anti")
    own = [F.col(f"`{c}`") for c in docs.columns]
    order = F.xxhash64(*(F.to_json(F.struct(c)) for c in own))
    # One row is kept per task already, so a row repeated without end is never gathered.
    once = docs.join(repeated, same, "left_semi").groupBy(F.col("doc_id").cast("long"), mark)
    once = once.agg(F.min_by(F.struct(*own), order).alias("row"))
    return single.union(once.select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))
