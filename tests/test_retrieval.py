import json
import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larchfield.functions.text import TOKEN_PATTERN, tokens
from larchfield.operators import completion, retrieval
from larchfield.plans import registry
from larchfield.plans.fixtures import Lake
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from tests.conftest import SF_TINY


def loop_chunks(text, size, overlap):
    words = text.split()
    if len(words) <= size:
        return [text]
    out, start = [], 0
    while True:
        out.append(" ".join(words[start : start + size]))
        if start + size >= len(words):
            return out
        start += size - overlap


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=8), st.integers(1, 12), st.data())
def test_chunks_equal_the_plain_loop(spark, lengths, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    texts = ["  " + " \n ".join(f"w{i}" for i in range(n)) for n in lengths]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in retrieval.chunk(df, "text", size, overlap).orderBy("id", "chunk_index").collect():
        assert r.chunk_token_count == len(r.chunk_text.split())
        got.setdefault(r.id, []).append(r.chunk_text)
    assert got == {i: loop_chunks(t, size, overlap) for i, t in enumerate(texts)}


def test_overlap_must_be_smaller_than_size(spark):
    with pytest.raises(ValueError):
        retrieval.chunk(spark.range(1).withColumn("text", F.lit("a")), "text", 4, 4)


def test_corpus_statistics(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a")], "id int, text string")
    stats = retrieval.corpus_stats(retrieval.build_corpus(df, "text", 2, 1)).first()
    assert (stats.chunks, stats.avg_chunks_per_source, stats.sources_split) == (5, 2.5, 1)
    assert (stats.min_tokens, stats.max_tokens, stats.mean_tokens) == (1, 2, 1.8)


def brute_force(queries, corpus, k):
    def unit(v):
        norm = np.linalg.norm(v)
        return v / norm if norm else v

    out = {}
    for qid, q in queries:
        scores = [(-float(unit(np.array(q)) @ unit(np.array(c))), cid) for cid, c in corpus]
        out[qid] = [cid for _, cid in sorted((round(s, 9), cid) for s, cid in scores)[:k]]
    return out


@pytest.mark.parametrize("block", [100, 3])
def test_top_k_equals_brute_force(spark, block):
    rng = random.Random(7)
    corpus = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(200)]
    # Many equal vectors: ties must go by id.
    corpus += [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(5000, [0.0] * 6)]
    queries = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(9)] + [(9, [2.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    found = retrieval.topk_cosine(
        spark.createDataFrame(queries, "query_id int, embedding array<double>"),
        spark.createDataFrame(corpus, "doc_id long, embedding array<double>").repartition(5),
        k=4,
        block=block,
    )
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == brute_force(queries, corpus, 4)


def clustered(rng, count, start=0):
    """Vectors close to one of eight axes."""
    out = []
    for i in range(count):
        vector = [rng.gauss(0, 0.02) for _ in range(8)]
        vector[i % 8] += 1.0
        out.append((start + i, vector))
    return out


def test_top_k_sends_clustered_queries_to_few_clusters(spark, monkeypatch):
    rng = random.Random(3)
    corpus, queries = clustered(rng, 800), clustered(rng, 24)
    shipped = []
    search = retrieval._Grid.search

    def noted(self, asked, k, result):
        shipped.append(asked.select("_cluster").count())
        return search(self, asked, k, result)

    monkeypatch.setattr(retrieval._Grid, "search", noted)
    found = retrieval.topk_cosine(
        spark.createDataFrame(queries, "query_id int, embedding array<double>"),
        spark.createDataFrame(corpus, "doc_id long, embedding array<double>"),
        k=5,
    )
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got == brute_force(queries, corpus, 5)
    # Of 63 further clusters only those on the query's own axis can reach its fifth score.
    assert shipped[0] == 24 and shipped[1] <= 24 * 20


def test_top_k_of_fewer_rows_than_k(spark):
    corpus = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])]
    queries = [(1, [1.0, 0.1]), (2, [0.0, 0.0])]
    found = retrieval.topk_cosine(
        spark.createDataFrame(queries, "query_id int, embedding array<float>"),
        spark.createDataFrame([*corpus, (4, None)], "doc_id long, embedding array<float>"),
        k=5,
    )
    assert [(r.query_id, r.doc_id) for r in found.orderBy("query_id", "rank").collect()] == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)
    ]


def test_top_k_without_queries_is_empty(spark):
    none = spark.createDataFrame([], "query_id int, embedding array<double>")
    corpus = spark.createDataFrame([(1, [1.0])], "doc_id long, embedding array<double>")
    assert retrieval.topk_cosine(none, corpus).isEmpty()
    asked = spark.createDataFrame([(1, [1.0])], "query_id int, embedding array<double>")
    assert retrieval.topk_cosine(asked, corpus.limit(0)).isEmpty()


def test_vectors_have_unit_length(spark):
    df = spark.createDataFrame([("a b b c",), ("x",)], "t string")

    def factory():
        return lambda texts: [[len(t), 1.0, 2.0] for t in texts]

    for out in (retrieval.embed(df, "t"), retrieval.embed(df, "t", factory, batch=1)):
        for r in out.collect():
            assert abs(np.linalg.norm(r.embedding) - 1) < 1e-6


def test_hashed_vectors_are_those_of_the_transformers(spark):
    """Tokens of all lengths, any white space, upper case, other scripts; a filter does not count twice."""
    texts = ["a b b c", "", "  ", " Policy\t100/300,\u00a0\u2003x\x1cy ", "Ä ß 語 日本語 \U0001f600 x\u200by", " ".join("abcdefghijklmnop"[:n] for n in range(1, 17))]
    df = spark.createDataFrame(list(enumerate(texts * 300)), "id int, t string")
    words = df.withColumn("words", tokens(F.lower("t")))
    counted = HashingTF(numFeatures=384, inputCol="words", outputCol="counts").transform(words)
    unit = Normalizer(p=2.0, inputCol="counts", outputCol="unit").transform(counted)
    want = unit.select("id", vector_to_array("unit", "float32").alias("want"))
    got = retrieval.embed(df, "t").filter("embedding is not null")
    assert str(got._jdf.queryExecution().optimizedPlan()).count("encode(") == 1
    assert got.join(want, "id").filter("embedding <=> want").count() == len(texts) * 300
    none = retrieval.embed(spark.createDataFrame([(None,), ("a",)], "t string"), "t")
    assert sorted(r.embedding is None for r in none.collect()) == [False, True]


def test_confidence_is_clipped(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 0.99), (1, 2, 0.99), (1, 3, 0.99), (1, 4, 0.0), (2, 1, 0.1), (3, 1, 0.625)],
        "query_id int, rank int, score double",
    )
    assert rows(retrieval.confidence(df)) == [(1, 1.0), (2, 0.0), (3, 0.5)]


def test_sources_and_prompt_follow_the_rank(spark):
    hits = spark.createDataFrame(
        [(1, "why?", 2, "B", "text b", 0.5), (1, "why?", 1, "A", "text a", 0.75), (1, "why?", 3, "A", "more a", 0.25)],
        "query_id int, question string, rank int, policy string, chunk string, score double",
    )
    assert retrieval.sources(hits, "policy").first().source_policies == ["A", "B"]
    row = retrieval.rag_prompt(hits, "policy", "chunk", "question").first()
    assert row.chunks_retrieved == 3
    assert (
        "[SOURCE 1 | Policy A | score=0.750]\ntext a\n\n[SOURCE 2 | Policy B | score=0.500]\ntext b\n\n"
        "[SOURCE 3 | Policy A | score=0.250]\nmore a"
    ) in row.prompt
    assert row.prompt.endswith("why?")


def test_document_of_a_row_with_gaps(spark):
    df = spark.createDataFrame(
        [(7, datetime(2020, 5, 4), "Ohio", "OH", "bad", 400.0, 1234.5, 5e6, False)],
        "policy_number int, policy_bind_date timestamp_ntz, policy_state_full string, policy_state_code string,"
        " policy_csl string, policy_deductable double, policy_annual_premium double, umbrella_limit double,"
        " _umbrella_limit_zero_flag boolean",
    )
    text = retrieval.policy_document(df).first().nl_document
    assert text.startswith("Policy 7 is an active auto insurance policy bound on 2020-05-04, issued in Ohio (OH). Coverage limit: bad.")
    assert "The deductible is $400 (low deductible tier). The annual premium is $1,234.50." in text
    assert "HAS umbrella coverage with an additional limit of $5,000,000." in text
    assert text.endswith("Car ID: N/A. Customer ID: N/A.")


def test_history_rows_have_ten_columns(spark):
    answers = spark.createDataFrame(
        [("a", "q", "yes", 0.5, ["1"], 5)],
        "approach string, question string, answer string, confidence double, source_policies array<string>, chunks_retrieved int",
    )
    row = retrieval.query_history(answers, 64, 32)
    assert len(row.columns) == 10
    assert (row.first().chunk_size_tokens, row.first().overlap_tokens, row.first().confidence) == (64, 32, 0.5)


def test_answers_in_every_shape(spark):
    blocks = [{"type": "reasoning", "summary": []}, {"type": "text", "text": " one "}, {"type": "text", "text": "two"}]
    shapes = ["  plain\n", json.dumps(blocks), "[]", "[not json", None, json.dumps([{"type": "tool_use"}]), "[1] a note"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, a string").orderBy("i")
    picked = df.select(completion.extract_text("a").alias("all"), completion.extract_text("a", "first").alias("first")).collect()
    assert [r["all"] for r in picked] == ["plain", "one  two", "", "[not json", "", "", "[1] a note"]
    assert [r["first"] for r in picked] == ["plain", "one", "", "[not json", "", "", "[1] a note"]


def test_failing_client_loses_no_row(spark, rows):
    def factory():
        seen = {}

        def client(prompt):
            seen[prompt] = seen.get(prompt, 0) + 1
            if prompt == "never" or (prompt == "second" and seen[prompt] < 2):
                raise RuntimeError("429 too many")
            return prompt.upper()

        return client

    df = spark.createDataFrame([("fine",), ("second",), ("never",)], "prompt string").coalesce(1)
    out = completion.complete(df, "prompt", factory, retries=2, wait=0, rate_limit_wait=0)
    assert rows(out, "prompt", "response", "generation_status") == [
        ("fine", "FINE", "success"),
        ("never", "[LLM_ERROR after 3 attempts: 429 too many]", "error"),
        ("second", "SECOND", "success"),
    ]


class CountingClient:
    """Notes every call in a file, and brings its task down once, late in the work."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, prompt):
        with open(f"{self.folder}/calls", "a") as calls:
            calls.write(f"{prompt}\n")
        if prompt == "bad":
            raise RuntimeError("no answer")
        if prompt == "p17" and not (self.folder / "failed").exists():
            (self.folder / "failed").touch()
            raise SystemExit("lost")
        return prompt.upper()


def test_answers_are_asked_for_once_across_lost_tasks_and_runs(spark, rows, tmp_path):
    prompts = [(i, f"p{i % 25}") for i in range(60)] + [(60, None), (61, "bad"), (62, "")]
    df = spark.createDataFrame(prompts, "id int, prompt string")
    run = lambda: completion.complete(
        df, "prompt", lambda: CountingClient(tmp_path), retries=0, wait=0, log=f"{tmp_path}/log"
    )
    with pytest.raises(Exception, match="lost|aborted|SystemExit"):
        run().collect()
    before = (tmp_path / "calls").read_text().split("\n")
    assert "p17" in before
    want = [(i, None if p is None else "[LLM_ERROR after 1 attempts: no answer]" if p == "bad" else p.upper()) for i, p in prompts]
    out = run()
    assert rows(out, "id", "response") == sorted(want, key=repr)
    assert rows(out, "id", "response") == sorted(want, key=repr)
    calls = (tmp_path / "calls").read_text().split("\n")[:-1]
    # The call that was lost with its task had no answer to keep; failed calls are tried by each run.
    assert calls.count("p17") == 2 and all(calls.count(f"p{i}") == 1 for i in range(25) if i != 17)
    assert calls.count("") == 1


def test_issue_prompt_without_ratio(spark):
    log = spark.createDataFrame(
        [("sales", "c", "R", "d", "odd severity", 3, None, None)],
        "table_name string, column_name string, rule_name string, issue_description string, severity string,"
        " affected_records long, affected_ratio double, suggested_fix string",
    )
    prompt = completion.dq_prompt(log).first().prompt
    assert "Records: 3 (N/A)" in prompt and "What was done: odd severity" in prompt


def test_tasks_merge_several_batches(spark):
    """Small Arrow batches: a task must keep the best over all of its batches."""
    rng = random.Random(11)
    corpus = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(300)]
    queries = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = retrieval.topk_cosine(
            spark.createDataFrame(queries, "query_id int, embedding array<double>"),
            spark.createDataFrame(corpus, "doc_id long, embedding array<double>").repartition(2),
            k=7,
        )
        got = {}
        for r in found.orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_force(queries, corpus, 7)


def test_search_for_answers_runs_once(spark):
    """Prompts, confidence and sources read the written hits."""
    files = registry.retrieved(Lake(spark, SF_TINY), registry.LARGE).inputFiles()
    assert files and all("policy-hits" in f for f in files)


def test_few_queries_write_and_shuffle_no_vectors(spark, monkeypatch):
    """The corpus is read once; more queries than that go by clusters and find the same."""
    rng = random.Random(12)
    corpus = [(f"d{i}", [rng.uniform(-1, 1) for _ in range(5)]) for i in range(150)]
    queries = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(retrieval.FEW + 1)]

    def found(asked):
        ranked = retrieval.topk_cosine(
            spark.createDataFrame(asked, "query_id int, embedding array<float>"),
            spark.createDataFrame(corpus, "doc_id string, embedding array<float>").repartition(3),
            k=6,
        )
        return [(r.query_id, r["rank"], r.doc_id, r.score) for r in ranked.orderBy("query_id", "rank").collect()]

    many = found(queries)
    monkeypatch.setattr(retrieval, "materialise", None)
    assert found(queries[:-1]) == many[:-6] and len(many) == 6 * len(queries)


def test_vectors_of_unlike_length_are_refused(spark):
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "doc_id long, embedding array<double>")
    with pytest.raises(Exception, match="differ in length"):
        retrieval.topk_cosine(asked, corpus.coalesce(1)).collect()


def test_search_for_answers_writes_no_vectors(spark, monkeypatch):
    written = []
    write = registry.materialise
    monkeypatch.setattr(registry, "materialise", lambda df, label, *a: written.append(df.columns) or write(df, label, *a))
    registry.retrieved(Lake(spark, SF_TINY), registry.SMALL)
    assert written and not any("embedding" in columns for columns in written)


def test_plain_and_other_texts_have_the_same_tokens(spark):
    texts = ["", " ", "  a  b ", "x\ty\n z\x1cw", "a\u00a0b c", "Ä ß\u2003日本 q", "~!@ #\x7f $", None, "a\x00b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    want = F.regexp_extract_all("t", F.lit(TOKEN_PATTERN), F.lit(0))
    assert df.filter(~tokens("t").eqNullSafe(want)).isEmpty()


def test_stored_answers_of_a_bucket_share_a_file(spark, tmp_path):
    """A file per answer would take a block of the disk each."""
    df = spark.range(400).select(F.concat(F.lit("p"), "id").alias("prompt"))
    run = lambda: completion.complete(df, "prompt", lambda: CountingClient(tmp_path), log=f"{tmp_path}/log")
    (tmp_path / "failed").touch()
    assert run().filter("response <=> upper(prompt)").count() == 400
    log = completion.AnswerLog(f"{tmp_path}/log", 1024)
    files = [f.name for f in (tmp_path / "log").rglob("*") if f.is_file()]
    buckets = [int(f.name) for f in (tmp_path / "log").iterdir()]
    assert len(files) == len(buckets) < 400 and any(f.endswith(".json.gz") for f in files)
    assert sum(len(log.known(b)[0]) for b in buckets) == 400
    assert run().count() == 400
    assert len((tmp_path / "calls").read_text().split()) == 400
