"""Special tokens, odd white space, and columns named like working columns."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest

from larchfield.llm import language, lines, minhash, packing, warc

ODD_TEXTS = [
    "<|endoftext|> hi", "a<|startoftext|>b<|endoftext|>", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> it's we'll",
    "İstanbul ǅ ﬁne", "é ́x ́", "x\x1cy\x1fz\x85q r s", "\t\r\n\x0b\x0c ", "don't 1234 !!! a_b", "﻿日本語 한국",
    "", None, "word " * 5000, "<|endoftext|>" * 300, "a" * 5000,
]


@pytest.mark.parametrize("cached", [400_000, 3])
def test_ids_equal_the_tokenizer(monkeypatch, cached):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    path = packing.default_tokenizer()
    plain, coder = Tokenizer.from_file(path), packing.WordTokenizer(path)
    for texts in (ODD_TEXTS, ODD_TEXTS[::-1], [None], []):
        ids, bounds = coder.encode(pa.array(texts, pa.string()))
        want = [[*plain.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert plain.encode("<|endoftext|> hi", add_special_tokens=False).ids == [49407, 1883]


def test_special_tokens_are_packed_as_dealt(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    plain = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string, source string, ids string")
    pieces = packing.pack(docs, path).collect()
    for i, text in enumerate(ODD_TEXTS):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == len(ids) == own[0]["doc_tokens"]
        assert all(p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in own)


CLASHES = ["of_id", "of_mark", "found", "_key", "_at", "_gone", "_lines", "_numbers", "row", "key", "at", "gone", "parts", "id", "a b", "d.x", "lettered", "_lettered"]


def clashing(spark, rows):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, lang, *(f"{c}-{i}" for c in CLASHES)) for i, t, lang in rows], schema)


def values_kept(found):
    return all(r[c] == f"{c}-{r['doc_id']}" for r in found for c in CLASHES)


def test_line_dedup_keeps_columns_of_any_name(spark):
    shared = "one line\ntwo lines\nthree lines"
    found = lines.dedup_lines(clashing(spark, [(1, shared, "en"), (2, f"own\n{shared}\nend", "en"), (3, None, None)])).collect()
    assert values_kept(found)
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in found} == {1: (shared, 0), 2: ("own\nend", 3), 3: (None, 0)}


def test_tabs_count_in_lines(spark):
    rows = [(1, "a\nb\nc", None), (2, "a\nb\t\nc", None), (3, " a \nb\r\nc", None)]
    found = lines.dedup_lines(clashing(spark, rows)).collect()
    assert {r["doc_id"]: r["lines_removed"] for r in found} == {1: 0, 2: 0, 3: 3}


def test_language_is_predicted_once_for_a_filter_on_it(spark):
    """A pipeline drops unknown languages; the texts must not go to Python a second time for that."""
    rows = [(i, ("the cat and the dog " if i % 2 else "der Hund und die Katze ") * 5, ("en", "de")[1 - i % 2]) for i in range(40)]
    docs = spark.createDataFrame([*rows, (40, "123", None), (41, None, "en")], "doc_id long, text string, lang string")
    kept = language.identify(docs, language.train(docs)).where("lang_pred <> 'und'").select("doc_id", "lang_pred")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {tuple(r) for r in kept.collect()} == {(i, lang) for i, _, lang in rows}


def test_language_keeps_columns_of_any_name(spark):
    docs = clashing(spark, [(i, f"the text of number {i}" if i % 2 else f"der Text der Nummer {i}", "en" if i % 2 else "de") for i in range(60)])
    found = language.identify(docs, language.train(docs)).collect()
    assert values_kept(found) and len(found) == 60


def test_held_out_rows_do_not_move_the_sample(spark):
    rows = [(i, f"the text of number {i}" if i % 2 else f"der Text der Nummer {i}", "en" if i % 2 else "de") for i in range(80)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    more = rows + [(i, "words held out", "en") for i in range(1000, 3000) if held(i)]
    one, other = (language.train(clashing(spark, r), per_language=10) for r in (rows, more))
    texts = pa.array([t for _, t, _ in rows])
    assert one.predict(texts)[1].tolist() == other.predict(texts)[1].tolist()


def test_archives_are_read_by_a_task_each(spark):
    manifest = spark.createDataFrame([(f"a{i}.warc.gz", 1, 1) for i in range(300)], "archive string, records long, bytes long")
    assert warc.spread(manifest).rdd.getNumPartitions() == 300
    assert warc.spread(manifest.limit(0)).rdd.getNumPartitions() == 1


def test_members_are_read_piece_by_piece():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            assert 0 < n <= 7
            return super().read(n)

    squeeze = [zlib.compressobj(wbits=31) for _ in range(3)]
    texts = [b"first" * 50, b"", b"third"]
    data = b"".join(s.compress(t) + s.flush() for s, t in zip(squeeze, texts))
    assert list(warc.members(Slow(data), 7)) == texts
    with pytest.raises(warc.WarcError, match="inside"):
        list(warc.members(Slow(data[:-3]), 7))


def test_block_similarity_equals_the_pairwise_one():
    texts = pa.array(["a b c d e f g h i", "a b c d e f g h j", "x", "", "a b c d e f g h i " * 3, None, "k l m n o p"], pa.string())
    idf = np.random.default_rng(1).random(minhash.WORD_BUCKETS).astype(np.float32) + 1
    some = minhash.Similarity(texts, idf)
    for i in range(len(texts)):
        want = minhash.weighted_jaccard(pa.array([texts[i].as_py()] * len(texts), pa.string()), texts, idf)
        assert np.allclose(some.to(i, np.arange(len(texts))), want)


def test_a_block_sends_on_a_forest():
    dice = np.random.default_rng(3)
    base = [f"w{x}" for x in dice.integers(0, 500, 300)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in dice.choice(300, 1 + i % 9, replace=False):
            words[at] = f"n{i}x{at}"
        texts.append(" ".join(words))
    column = pa.array(texts)
    idf = np.ones(minhash.WORD_BUCKETS, np.float32)
    _, shingles, weights, starts = minhash.features(column, idf)
    drawn = (minhash.samples(shingles, weights, starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    keys = [bytes([i]) * 16 for i in range(60)]
    table = pa.table({
        "bucket": pa.array([1] * 60), "band": pa.array([0] * 60), "key": pa.array(keys, pa.binary()),
        "root": pa.array(keys, pa.binary()), "main": pa.array([b"none"] * 60, pa.binary()),
        "samples": pa.array(list(drawn), pa.list_(pa.int32())), "text": column,
    })
    links = minhash.link_blocks(table, table, idf, 0.8)
    groups = {k: k for k in keys}

    def root(k):
        while groups[k] != k:
            k = groups[k]
        return k

    for a, b in zip(links["a"].to_pylist(), links["b"].to_pylist()):
        assert root(a) != root(b)
        groups[root(a)] = root(b)
    some = minhash.Similarity(column, idf)
    for i in range(60):
        for j in np.flatnonzero(some.to(i, np.arange(60)) >= 0.8):
            assert root(keys[i]) == root(keys[j])
    assert 10 < links.num_rows < 60


def test_one_of_repeated_rows_is_kept_with_columns_of_any_name(spark):
    rows = [(i, f"text number {i} with words of its own", None) for i in range(4)] + [(1, "text number 1 with words of its own", None)] * 40
    rows += [(None, "text number 2 with words of its own", None)]
    found = minhash.keep_one(clashing(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in found) == [0, 1, 2, 3] and values_kept(found)
