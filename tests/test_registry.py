"""Registered queries against their DuckDB checks on the smallest tables."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from larchfield.plans.fixtures import BASE_TABLES
from larchfield.plans.registry import QUERIES
from tests.conftest import SF_TINY

# Without a check in SQL: model answers, hashed vectors, JSON bundles.
WITHOUT_SQL = {
    "kpi_bundle",
    "rag_prompt",
    "embed_chunks",
    "rag_answers",
    "insight_prompt",
    "business_insights",
}

# One query per kind of operator, so that the suite stays short; the driver runs all.
CHECKED = [
    "ingest_events", "ingest_json_events", "reconcile_counts", "merge_synonyms", "expand_codes",
    "parse_timestamps", "extract_measure", "convert_units", "valid_email", "quarantine_sales",
    "quarantine_policy", "expectations", "dq_issue_log", "dq_issue_seq", "scd2_events",
    "scd2_stream", "dim_customer", "dim_car", "fact_claims", "asof_dim_join",
    "mart_claim_performance", "mart_unsold_inventory", "kpi_policy_overview", "kpi_customer_dims",
    "fuel_risk", "fuel_prompt", "segment_prompt", "demand_signal", "alert_scored", "alert_summary", "alert_regions",
    "claims_enriched", "claim_stats", "critic_weights", "anomaly_critic", "score_histogram",
    "flagged_claims", "brief_prompt", "policy_documents", "chunks_small", "corpus_stats",
    "topk_cosine", "confidence_pivot", "latest_per_key", "extract_text",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_TINY}/{name}.parquet'")
    return connection


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_TINY)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=repr)
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(row[i]) for i in order) for row in result.fetchall()), key=repr)
    assert got == want


def test_every_query_has_a_check_or_a_reason(duck):
    checks = entry_points.oracle_sql()
    assert set(QUERIES) - set(checks) == WITHOUT_SQL
    assert set(CHECKED) <= set(checks)
    for text in checks.values():
        duck.execute("EXPLAIN " + text)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL - {"embed_chunks"}))
def test_query_without_check_has_rows(spark, name):
    rows = entry_points.queries()[name](spark, SF_TINY).collect()
    expected = {"kpi_bundle": 4, "business_insights": 4, "insight_prompt": 4, "rag_prompt": 5, "rag_answers": 10}
    assert len(rows) == expected.get(name, len(rows)) > 0
    assert not any("LLM_ERROR" in str(r) for r in rows)


def test_entry_has_rows(spark):
    assert not entry_points.entry(spark).isEmpty()


def test_broadcast_free_plans_give_the_same_result(spark, duck):
    """With every join a shuffle join, as on large tables, results do not change."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in settings:
        spark.conf.set(key, "-1")
    try:
        for name in ("mart_claim_performance", "alert_summary", "anomaly_critic"):
            test_query_equals_sql(spark, duck, name)
    finally:
        for key in settings:
            spark.conf.unset(key)
