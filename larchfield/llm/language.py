"""Language identification: the family first, then its languages one against one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import batches_of, free_name, text_buffer, worker_state

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "ur", "mr", "gu", "pa", "ne"],
    "semitic": ["ar", "he", "am"],
}
ORDERS = (1, 2, 3, 4)
BUCKETS = 4096
#: Text that is cut into n-grams at a time.
SLICE_BYTES = 400_000
PER_LANGUAGE = 500
UNKNOWN = "und"
_LETTERS = np.array(
    [b if chr(b).isalpha() or b > 127 else 32 for b in range(256)], dtype=np.uint64
)


def family_of(lang: str) -> str:
    """The family of a language; one outside the table is a family of its own."""
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def gram_rows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: feature of every n-gram, where rows start, and their counts.

    N-grams are over bytes of the lower-cased text in which all but letters are
    spaces; none crosses from one row to the next.
    """
    data, offsets = text_buffer(pc.utf8_lower(texts))
    codes = _LETTERS[data]
    lengths = np.diff(offsets)
    for n in ORDERS:
        made = np.maximum(lengths - n + 1, 0)
        total = max(len(codes) - n + 1, 0)
        gram = np.full(total, n, np.uint64)
        for k in range(n):
            gram = gram * np.uint64(0x100000001B3) + codes[k : k + total]
        gram ^= gram >> np.uint64(29)
        feature = ((gram * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) % np.uint64(BUCKETS)
        yield feature.astype(np.int64), offsets[:-1], made


def frequencies(texts: pa.Array) -> np.ndarray:
    """Relative frequencies of hashed n-grams, a row per text."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for feature, starts, made in gram_rows(texts):
        for row in np.flatnonzero(made):
            part = feature[starts[row] : starts[row] + made[row]]
            out[row] += np.bincount(part, minlength=BUCKETS) / made[row]
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 20) -> np.ndarray:
    """Weights, the last one the bias, of a soft-margin linear SVM.

    Dual coordinate descent for squared hinge loss; ``y`` is +1 or -1.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weights, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = (x * x).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ weights) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights


@dataclass
class Contest:
    """One-against-one classifiers over some classes; columns into the weights."""

    classes: list[str]
    pairs: list[tuple[int, int, int]] = field(default_factory=list)

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most votes and its mean probability; ties to the surer class."""
        votes = np.zeros((len(margins), len(self.classes)))
        sure = np.zeros_like(votes)
        for a, b, column in self.pairs:
            p = 1 / (1 + np.exp(-np.clip(2 * margins[:, column], -30, 30)))
            votes[:, a] += p >= 0.5
            votes[:, b] += p < 0.5
            sure[:, a] += p
            sure[:, b] += 1 - p
        rivals = max(len(self.classes) - 1, 1)
        best = (votes + sure / (rivals + 1)).argmax(axis=1)
        if len(self.classes) == 1:
            return best, np.ones(len(margins))
        return best, sure[np.arange(len(margins)), best] / rivals


@dataclass
class LanguageModel:
    """Hashed weights of all contests: among families, and within each family."""

    families: Contest
    within: list[Contest]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        margins = np.tile(self.bias, (len(texts), 1))
        for feature, starts, made in gram_rows(texts):
            full = np.flatnonzero(made)
            if not len(full):
                continue
            # Rows stand one after the other; what lies between two rows' n-grams
            # is summed apart and left out.
            edges = np.stack([starts[full], starts[full] + made[full]], axis=1).ravel()
            edges = edges[:-1] if edges[-1] >= len(feature) else edges
            for column in range(self.weights.shape[1]):
                values = self.weights[:, column][feature]
                margins[full, column] += np.add.reduceat(values, edges)[::2] / made[full]
        family, family_score = self.families.decide(margins)
        names = np.empty(len(texts), object)
        score = np.zeros(len(texts))
        for index, contest in enumerate(self.within):
            rows = np.flatnonzero(family == index)
            best, inner = contest.decide(margins[rows])
            names[rows] = np.array(contest.classes, object)[best]
            score[rows] = family_score[rows] * inner
        return list(names), score


def fit(x: np.ndarray, langs: list[str]) -> LanguageModel | None:
    """Fit all contests on hashed frequencies; nothing can be fitted on no rows."""
    if not len(langs):
        return None
    lang = np.array(langs, object)
    family = np.array([family_of(v) for v in langs], object)
    scale = 1 / np.maximum(x.std(axis=0), 1e-4) / np.sqrt(x.shape[1])
    # In place: the sample is the largest thing the driver holds.
    scaled = np.multiply(x, scale, out=x)
    mean = scaled.mean(axis=0)
    scaled -= mean
    columns: list[np.ndarray] = []

    def contest(labels: np.ndarray, rows: np.ndarray) -> Contest:
        made = Contest(sorted(set(labels[rows])))
        for a, b in combinations(range(len(made.classes)), 2):
            own, other = made.classes[a], made.classes[b]
            picked = rows[(labels[rows] == own) | (labels[rows] == other)]
            columns.append(linear_svm(scaled[picked], np.where(labels[picked] == own, 1.0, -1.0)))
            made.pairs.append((a, b, len(columns) - 1))
        return made

    every = np.arange(len(lang))
    families = contest(family, every)
    within = [contest(lang, every[family == name]) for name in families.classes]
    stacked = np.array(columns).reshape(len(columns), x.shape[1] + 1)
    weights, bias = stacked[:, :-1], stacked[:, -1] - stacked[:, :-1] @ mean
    return LanguageModel(families, within, (weights * scale).T.astype(np.float32).copy(), bias)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on at most ``per_language`` labelled documents of each language.

    Only documents that are not held out take part, with their whole texts. The
    sample is chosen by a hash of doc_id, so it is the same in every run; the
    features are made in the tasks, and the driver receives at most 24 KB, as a rule
    a quarter of that, per sampled document.
    """
    labelled = docs.where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))
    )
    order = F.xxhash64("doc_id", F.lit(5))
    counts = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("lang").count().collect()
    pick = F.lit(False)
    for row in counts:
        bar = min(2**63 - 1, (2**63 - 1) * 3 * per_language // (2 * row["count"]))
        pick = pick | ((F.col("lang") == row["lang"]) & (F.shiftrightunsigned(order, 1) <= bar))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language")
        for batch in batches_of(batches, "text", SLICE_BYTES):
            x = frequencies(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("ord"), pa.array([packed(v) for v in x], pa.binary())],
                ["lang", "ord", "x"],
            )

    # Copies of a row are one row, so the sample has at most twice ``per_language`` rows a language
    # but for documents that share a doc_id and differ.
    sample = labelled.where(pick).select("lang", order.alias("ord"), "text")
    rows = sample.mapInArrow(features, "lang string, ord long, x binary").distinct().collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["ord"], bytes(r["x"])))
    taken: dict[str, int] = {}
    chosen = []
    for row in rows:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= per_language:
            chosen.append(row)
    langs = [row["lang"] for row in chosen]
    x = np.zeros((len(chosen), BUCKETS), np.float32)
    for place, row in enumerate(chosen):
        unpack(row["x"], x[place])
    del rows, chosen
    return fit(x, langs)


def packed(values: np.ndarray) -> bytes:
    """The places and values of a row that are not zero."""
    full = np.flatnonzero(values)
    return full.astype(np.uint16).tobytes() + values[full].astype(np.float32).tobytes()


def unpack(data: bytes, out: np.ndarray) -> None:
    count = len(data) // 6
    out[np.frombuffer(data, np.uint16, count)] = np.frombuffer(data, np.float32, count, 2 * count)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Predict the language of every document from its whole text alone.

    Adds held_out, lang_pred and score to the columns of ``docs``, replacing any
    of these names. A text that is null or has no letter is ``und`` with score 0,
    and so is every text if there was nothing to learn from; other texts of any
    length get a learned language. Repeated rows are predicted each on its own,
    a null doc_id counts as held out by the checksum of an empty text, and an
    empty table gives no rows. Other columns pass through, whatever their names.
    """
    docs = docs.drop("held_out", "lang_pred", "score")

    def predict(texts: pa.Array) -> pa.Array:
        worker_state("language")
        names: list[str] = []
        scores: list[np.ndarray] = []
        for batch in batches_of(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text", SLICE_BYTES):
            found, score = model.predict(batch.column("text"))
            names.extend(found)
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores), pa.float64())], ["lang_pred", "score"]
        )

    # Only texts go to Python; all other columns stay where they are.
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A caller's filter on a prediction would otherwise be moved below it and predict every text once more.
    once = F.arrow_udf(predict, "struct<lang_pred: string, score: double>").asNondeterministic()
    found = unknown if model is None else F.when(lettered, once(text)).otherwise(unknown)
    own = [F.col(f"`{c}`") for c in docs.columns]
    flag = free_name(docs.columns, "found")
    rows = docs.select(*own, held_out(F.col("doc_id")).alias("held_out"), found.alias(flag))
    return rows.select(*own, "held_out", f"{flag}.lang_pred", f"{flag}.score")
