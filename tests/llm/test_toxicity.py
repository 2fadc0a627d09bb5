"""The convolutional classifier: its layers against plain loops, its scores on held-out documents."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from larchfield.llm import toxicity
from larchfield.llm.hashing import word_hash, word_hashes

SYLLABLES = ("ba", "do", "ki", "lu", "me", "no", "ra", "su", "ti", "ve")
BAD = {"en": ("vilex", "grimp", "scorv"), "de": ("pfuix", "grollx", "schmax")}
DOCS = "doc_id long, text string, lang string, source string, score string"


def prose(dice, lang, count):
    tail = "en" if lang == "de" else "ly"
    return ["".join(dice.choice(SYLLABLES, 2)) + tail for _ in range(count)]


@pytest.fixture(scope="module")
def corpus():
    dice, rows, labels = np.random.default_rng(4), [], []
    for i in range(1500):
        lang = "de" if i % 3 == 0 else "en"
        words = prose(dice, lang, int(dice.integers(20, 120)))
        toxic = i % 5 == 0
        if toxic:
            for word in dice.choice(BAD[lang], 3):
                words.insert(int(dice.integers(0, len(words))), str(word) + ",")
        rows.append((i, " ".join(words), lang, "s", "x"))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows, labels = corpus
    return toxicity.train(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))


def held(doc_id):
    return crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_documents_are_told_apart(spark, corpus, model):
    rows, labels = corpus
    found = {r["doc_id"]: r for r in toxicity.score_documents(spark.createDataFrame(rows, DOCS), model).collect()}
    assert {i for i, r in found.items() if r["held_out"]} == {i for i, _ in labels if held(i)}
    aside = [(found[i]["predicted"], toxic) for i, toxic in labels if held(i)]
    assert np.mean([p == t for p, t in aside]) > 0.98
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_held_out_rows_and_other_columns_have_no_say(spark, corpus, model):
    rows, labels = corpus
    turned = [(i, 1 - t if held(i) else t) for i, t in labels]
    mixed = [(i, t, lang, f"source {i}", "y") for i, t, lang, _, _ in rows]
    again = toxicity.train(spark.createDataFrame(mixed, DOCS), spark.createDataFrame(turned, "doc_id long, toxic int"))
    texts = pa.array([r[1] for r in rows[:50]])
    assert model.score(texts).tolist() == again.score(texts).tolist()


def test_pooling_equals_plain_loops(monkeypatch):
    texts = ["a b c d e f g", "", None, "h", "b a", "c d " * 30]
    words, bounds = word_hashes(pa.array(texts))
    known = np.unique(words)
    ids = (np.searchsorted(known, words) + 1).astype(np.int32)
    network = toxicity.Network.random(len(known))
    network.embedding[1:] = np.random.default_rng(1).normal(0, 1, (len(known), toxicity.DIMENSIONS))
    want = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        row = np.concatenate([network.embedding[ids[a:b]], np.zeros((3, toxicity.DIMENSIONS))])
        want.append([
            max(sum(row[i + j] @ m[j][:, f] for j in range(w)) for i in range(max(b - a, 1)))
            for w, m in network.filters.items() for f in range(toxicity.FILTERS)
        ])
    for places in (1 << 18, 4, 1):
        monkeypatch.setattr(toxicity, "PLACES", places)
        assert np.allclose(network.pooled(ids, bounds)[0], want, atol=1e-4)


def test_gradients_equal_differences():
    ids, bounds = np.array([1, 2, 3, 4, 2, 5, 1], np.int32), np.array([0, 4, 7])
    network = toxicity.Network.random(5)
    for p in network.parameters():
        p += np.random.default_rng(3).normal(0, 0.5, p.shape).astype(np.float32)
    network.embedding[0] = 0
    target = np.array([1, 0], np.float32)

    def loss():
        p = toxicity.sigmoid(network.logits(ids, bounds).astype(float))
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    for p, slope in zip(network.parameters(), network.gradients(ids, bounds, target)):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 12)]:
            if p is network.embedding and at[0] == 0:
                continue
            kept = p[at]
            p[at] = kept + 1e-3
            up = loss()
            p[at] = kept - 1e-3
            down = loss()
            p[at] = kept
            assert slope[at] == pytest.approx((up - down) / 2e-3, abs=2e-3, rel=2e-2)


def test_thresholds_part_the_labels_in_the_widest_gap():
    raised = np.array([-3.0, -2.0, 1.0, 4.0, 5.0])
    assert toxicity.best_threshold(raised, np.array([0, 0, 0, 1, 1])) == 2.5


def test_odd_rows(spark, model):
    long = " ".join(prose(np.random.default_rng(8), "en", 30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", "x"), (None, f"{long} vilex, grimp scorv", "en", "s", "x"),
            (4, long, "en", "s", "x"), (4, long, "en", "s", "x"), (5, "!!!", "de", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = [tuple(r) for r in toxicity.score_documents(docs, model).collect()]
    empty = next(r for r in found if r[0] == 2)
    assert [r[2] for r in found if r[0] in (1, 5)] == [empty[2]] * 2 and empty[3] == 0
    assert next(r for r in found if r[0] is None)[1:] == (False, next(r for r in found if r[0] is None)[2], 1)
    assert len([r for r in found if r[0] == 4]) == 2 and not any(r[3] for r in found if r[0] == 4)
    assert toxicity.score_documents(docs.limit(0), model).collect() == []
    assert {r["score"] for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_every_labelled_document_is_learned_from(spark, corpus, monkeypatch):
    rows, labels = corpus
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "CELL_ROWS", 150)
    cells = toxicity.dealt(toxicity.labelled_rows(docs, marks))
    taken = {(r["cell"], r["learn"]): r["count"] for r in cells.where("copy = 0").groupBy("cell", "learn").count().collect()}
    assert sum(taken.values()) == sum(not held(i) for i, _ in labels) and len({c for c, _ in taken}) > 4
    model = toxicity.train(docs, marks)
    again = toxicity.train(docs.repartition(3), marks)
    texts = pa.array([r[1] for r in rows[:50]])
    assert model.score(texts).tolist() == again.score(texts).tolist()


def test_long_documents_are_learned_from_whole(spark):
    dice, rows, labels = np.random.default_rng(6), [], []
    for i in range(60):
        words = prose(dice, "en", 4100)
        if i % 2:
            words[4000:4003] = BAD["en"]
        rows.append((i, " ".join(words), "en", "s", "x"))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {word_hash(w) >> 64 - toxicity.HASH_BITS for w in BAD["en"]} <= set(model.buckets.tolist())


def test_near_copies_weigh_like_one_text(spark):
    rows = [(i, "one two three four five", "en", "s", "x") for i in range(12)] + [(50, "six seven eight nine", "en", "s", "x")]
    marks = spark.createDataFrame([(r[0], 0) for r in rows], "doc_id long, toxic int")
    kept = toxicity.labelled_rows(spark.createDataFrame(rows, DOCS), marks)
    weights = toxicity.copy_weights(kept).collect()
    assert sum(r["weight"] for r in weights) == pytest.approx(1 + (not held(50)))
