"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of
from larchfield.llm.hashing import SYMBOL_BYTES, rows_of, word_hashes, word_spans

BUCKETS = 1 << 18
PER_GRADE = 4000
STEPS = 200
PENALTY = 2e-4
SEEN = 5
REPEATED = 1


def sparse(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the features of each text.

    Features are hashed words, runs of symbols, and words that repeat the one
    before; the value is ln(1 + count) for words and ln(1 + count per 100 words)
    for the others. Rows are in order.
    """
    words, bounds = word_hashes(texts)
    symbols, symbol_bounds, _, _, _ = word_spans(texts, SYMBOL_BYTES)
    word_row = rows_of(bounds)
    again = np.flatnonzero((words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1]))
    row = np.concatenate([word_row, rows_of(symbol_bounds), word_row[again]]).astype(np.uint64)
    # Even buckets are words, odd ones symbols and repetitions.
    bucket = np.concatenate(
        [
            (words >> np.uint64(46)) & ~np.uint64(1),
            (symbols >> np.uint64(46)) | np.uint64(1),
            np.full(len(again), REPEATED, np.uint64),
        ]
    )
    key, count = np.unique(row * np.uint64(BUCKETS) + bucket, return_counts=True)
    row, bucket = (key // np.uint64(BUCKETS)).astype(np.int64), (key % np.uint64(BUCKETS)).astype(np.int64)
    per = np.maximum(np.diff(bounds), 1)[row] / 100
    value = np.log1p(np.where(bucket % 2 == 1, count / per, count))
    return row, bucket, value.astype(np.float32)


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds: P(grade > k) = sigmoid(x w - theta_k).

    ``cut`` is the tail probability from which a document is kept.
    """

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def tails(self, texts: pa.Array) -> np.ndarray:
        """Probability that the grade exceeds each threshold, a row per text."""
        row, bucket, value = sparse(texts)
        raised = np.bincount(row, value * self.weights[bucket], minlength=len(texts))
        return sigmoid(raised[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, mass: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with an L2 penalty, by Adam over the whole sample.

    Each grade contributes to all thresholds (the cumulative logits are fitted
    together, with shared weights); thresholds are kept in order by positive
    steps. ``mass`` weighs the documents.
    """
    levels = int(grade.max()) if len(grade) else 1
    above = (grade[:, None] > np.arange(levels)[None, :]).astype(float)
    mass = mass / mass.sum()
    base = np.clip((above * mass[:, None]).sum(axis=0), 1e-3, 1 - 1e-3)
    start = np.log(1 / base - 1)
    params = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, theta = params[:size], params[size:]
        gaps = np.exp(theta[1:])
        cuts = theta[0] + np.append(0, np.cumsum(gaps))
        raised = np.bincount(row, value * weights[column], minlength=len(grade))
        error = (sigmoid(raised[:, None] - cuts[None, :]) - above) * mass[:, None]
        gradient = np.empty_like(params)
        gradient[:size] = np.bincount(column, value * error.sum(axis=1)[row], minlength=size) + PENALTY * weights
        cut_gradient = -error.sum(axis=0)
        tail = np.cumsum(cut_gradient[::-1])[::-1]
        gradient[size] = tail[0]
        gradient[size + 1 :] = tail[1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    theta = params[size:]
    return params[:size], theta[0] + np.append(0, np.cumsum(np.exp(theta[1:])))


def grades() -> Column:
    """Grade of a labelled document: 0 toxic, 1 poor, 2 good; null without labels."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def train(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> OrdinalModel | None:
    """Fit on at most ``per_grade`` labelled documents of each grade, whole texts.

    The sample is chosen by a hash of doc_id. Documents weigh as much as their
    grade has labels for each sampled one, so that probabilities hold for all
    labelled documents. Only features of five sampled documents or more have
    weights. The driver receives the sample's sparse features.
    """
    graded = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), grades().alias("grade"))
        .where("grade is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    order = F.xxhash64("doc_id", F.lit(9))
    counts = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    pick = F.lit(False)
    for grade, count in counts.items():
        bar = min(2**63 - 1, (2**63 - 1) * per_grade // count)
        pick = pick | ((F.col("grade") == grade) & (F.shiftrightunsigned(order, 1) <= bar))
    # At most 4 * per_grade rows of two numbers: a bound that does not grow.
    picked = graded.where(pick).orderBy(order, "doc_id").limit(4 * per_grade)
    chosen = picked.select("doc_id", F.col("grade").cast("long").alias("grade"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text"):
            row, bucket, value = sparse(batch.column("text"))
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            packed = [
                pa.array([v[a:b].tobytes() for a, b in spans], pa.binary())
                for v in (bucket.astype(np.int32), value)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), *packed], ["doc_id", "grade", "b", "v"]
            )

    found = (
        rows.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "grade", "text")
        .mapInArrow(extract, "doc_id long, grade long, b binary, v binary")
        .collect()
    )
    found = sorted(found, key=lambda r: (r["doc_id"], bytes(r["b"])))
    grade = np.array([r["grade"] for r in found])
    if len(set(grade.tolist())) < 2:
        return None
    buckets = [np.frombuffer(r["b"], np.int32) for r in found]
    row = np.repeat(np.arange(len(found)), [len(b) for b in buckets])
    bucket = np.concatenate(buckets).astype(np.int64)
    value = np.concatenate([np.frombuffer(r["v"], np.float32) for r in found])
    common = np.bincount(bucket, minlength=BUCKETS) >= SEEN
    column = np.cumsum(common) - 1
    used = common[bucket]
    sampled = np.bincount(grade, minlength=3)
    mass = np.array([counts[g] / sampled[g] for g in grade.tolist()])
    # Every fifth document tells where to cut; the others are fitted.
    aside = np.arange(len(found)) % 5 == 0
    learn = used & ~aside[row]
    fitted, thresholds = fit_ordinal(
        row[learn], column[bucket[learn]], value[learn], grade, np.where(aside, 0.0, mass), int(common.sum())
    )
    weights = np.zeros(BUCKETS)
    weights[common] = fitted
    raised = np.bincount(row, value * weights[bucket], minlength=len(grade))[aside]
    top = sigmoid(raised - thresholds[-1])
    return OrdinalModel(weights, thresholds, best_cut(top, grade[aside] == grade.max()))


def best_cut(probability: np.ndarray, good: np.ndarray) -> float:
    """The probability that parts good from other documents with the fewest errors.

    Errors are counted as shares of either side, which may differ much in number.
    """
    if good.all() or not good.any():
        return 0.5
    order = np.argsort(probability, kind="stable")
    lost = np.concatenate([[0], np.cumsum(good[order])]) / good.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(~good[order])]) / (~good).sum()
    at = int(np.argmin(lost + passed))
    edges = np.concatenate([[0.0], probability[order], [1.0]])
    return float((edges[at] + edges[at + 1]) / 2)


def grade_documents(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """Expected grade and probability of the top grade of every document.

    Adds expected_grade (sum of the tail probabilities), tail_probability
    (that the grade is the highest) and keep (tail_probability of the model's cut
    or more, which was set on labelled documents that were not fitted) to the columns of ``docs``, replacing any of these names. Whole texts are read.
    Null and empty texts have no features and get the model's base rate but are
    not kept; without a model all values are null. Repeated rows are graded
    alike; an empty table gives no rows.
    """
    docs = docs.drop("expected_grade", "tail_probability", "keep")
    names = docs.columns

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text"):
            if model is None:
                expected = top = pa.nulls(batch.num_rows, pa.float64())
            else:
                tails = model.tails(batch.column("text"))
                expected, top = pa.array(tails.sum(axis=1)), pa.array(tails[:, -1].copy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), expected, top],
                [*names, "expected_grade", "tail_probability"],
            )

    schema = docs.select(*names).schema.add("expected_grade", "double").add("tail_probability", "double")
    graded = docs.mapInArrow(grade, schema)
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    return graded.withColumn("keep", (F.col("tail_probability") >= (0.5 if model is None else model.cut)) & ~empty)
