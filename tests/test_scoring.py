import numpy as np
import pytest
from pyspark.sql import functions as F

from larchfield.operators import scoring, star
from larchfield.plans.fixtures import Lake
from tests.conftest import SF_TINY


def critic(matrix):
    """Independent CRITIC weights with constant columns left out."""
    span = matrix.max(axis=0) - matrix.min(axis=0)
    kept = span > 0
    scaled = matrix[:, kept] / span[kept]
    r = np.corrcoef(scaled.T)
    information = scaled.std(axis=0) * (1 - r).sum(axis=1)
    weights = np.zeros(matrix.shape[1])
    weights[kept] = information / information.sum()
    return weights


@pytest.fixture(scope="module")
def ruled(spark):
    claims = scoring.derive_amounts(Lake(spark, SF_TINY).clean("claims"))
    return scoring.score_rules(claims, scoring.fit_stats(claims))


def test_critic_weights_equal_numpy(ruled):
    matrix = np.array([tuple(r) for r in ruled.select(*scoring.RULES).collect()])
    got = {r.rule_name: r.critic_weight for r in scoring.critic_weights(ruled).collect()}
    assert np.allclose([got[c] for c in scoring.RULES], critic(matrix), atol=1e-9)


def test_constant_rule_has_no_weight(spark):
    rng = np.random.default_rng(1)
    matrix = np.c_[rng.random((50, 2)), np.full(50, 1 / 3)]
    df = spark.createDataFrame(matrix.tolist(), "a double, b double, c double")
    got = {r.rule_name: r.critic_weight for r in scoring.critic_weights(df, ["a", "b", "c"], "run-7").collect()}
    assert got["c"] == 0
    assert np.allclose([got["a"], got["b"]], critic(matrix)[:2], atol=1e-9)
    cells = {(r.rule_a, r.rule_b): r.r for r in scoring.rule_correlations(df, ["a", "b", "c"]).collect()}
    assert cells["a", "c"] is None and cells["c", "c"] == 1


def test_collinear_rules_are_flagged(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, (i % 3) / 2) for i in range(30)], "a double, b double, c double")
    flagged = scoring.rule_correlations(df, ["a", "b", "c"]).filter("is_collinear")
    assert sorted((r.rule_a, r.rule_b) for r in flagged.collect()) == [("a", "b"), ("b", "a")]


CLAIM = (
    "claimid string, injury string, vehicle string, property string, bodily_injuries string,"
    " number_of_vehicles_involved string, witnesses string, police_report_available string,"
    " property_damage string, authorities_contacted string, incident_type string, incident_severity string"
)


def test_rules_on_sparse_claims(spark):
    rows = [
        ("full", "900", "100", "50", "0", "3", "0", "NO", None, "None", "Vehicle Theft", "Major Damage"),
        ("none", None, None, None, None, None, None, None, None, None, None, None),
        ("theft", "10", "100", "abc", "2", "1", "1", "yes", "NO", "Police", "vehicle theft", "Major Damage"),
    ]
    claims = scoring.derive_amounts(spark.createDataFrame(rows, CLAIM))
    got = {r.claimid: r for r in scoring.score_rules(claims, scoring.fit_stats(claims)).collect()}
    assert got["full"].r4_staged_accident == 1 and got["full"].r5_doc_gap == 1.5
    assert got["full"].r6_theft_with_injury == 0 and got["theft"].r6_theft_with_injury == 1
    assert got["none"].r5_doc_gap == 1 and got["none"].r4_staged_accident == 0
    assert got["none"].total_claim_amount == 0 and got["theft"].total_claim_amount == 110
    assert all(got["none"][rule] == 0 for rule in scoring.RULES if rule != "r5_doc_gap")
    # A single ghost injury lies on its own mean.
    assert got["full"].r7_ghost_injury == 0


def test_scores_above_100_are_counted_but_in_no_bucket(spark):
    df = spark.createDataFrame([(105.0,), (100.0,), (64.9,), (0.0,)], "anomaly_score double")
    out = scoring.score_histogram(df).orderBy("bucket_start").collect()
    assert [r.claim_count for r in out] == [1, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert (out[0].bucket, out[0].pct_below_medium, out[0].pct_below_high) == ("0-10", 25.0, 50.0)


def test_empty_histogram_has_all_buckets(spark):
    out = scoring.score_histogram(spark.createDataFrame([], "anomaly_score double"))
    assert out.count() == 10 and out.agg(F.sum("claim_count")).first()[0] == 0


def test_weights_must_sum_to_one(ruled):
    with pytest.raises(ValueError):
        scoring.weighted_score(ruled, {"r1_amount_zscore": 0.5})


def test_trigger_thresholds(spark):
    values = dict.fromkeys(scoring.RULES, 0.39) | {"r5_doc_gap": 0.3, "r6_theft_with_injury": 1.0, "r1_amount_zscore": 0.4}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} double" for c in values))
    assert scoring.triggered_rules(df).first().triggered_rules == "R1:HighAmount, R5:DocGap, R6:TheftWithInjury"


def test_claim_count_without_customers_uses_policy(spark, rows):
    claims = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", None)], "claimid string, policyid string")
    out = scoring.enrich_claims(claims)
    assert rows(out, "claimid", "customer_claim_count", "customer_region") == [("a", 2, None), ("b", 2, None), ("c", 1, None)]


def test_agreement_covers_all_flagged(spark):
    tiers = [("HIGH", "LOW"), ("LOW", "MEDIUM"), ("HIGH", "HIGH"), ("LOW", "LOW")]
    df = spark.createDataFrame(tiers, "priority_tier string, priority_tier_bw string")
    assert scoring.method_agreement(df).first().asDict() == {"critic_only": 1, "both": 1, "business_only": 1}


def test_scores_table_and_missing_briefs(spark):
    lake = Lake(spark, SF_TINY)
    scores = scoring.score_output(
        scoring.enrich_claims(lake.scored, lake.dim_policy, lake.dim_customer), "run"
    )
    assert tuple(scores.columns[: len(scoring.SCORE_COLUMNS)]) == scoring.SCORE_COLUMNS
    none = spark.createDataFrame([], "claimid string, ai_investigation_brief string")
    flagged = scoring.flagged_claims(scores, none)
    assert flagged.count() == scores.filter("priority_tier <> 'LOW'").count() > 0
    assert flagged.filter("ai_investigation_brief IS NOT NULL").isEmpty()


@pytest.fixture
def shuffled(spark):
    """Joins that shuffle both sides and keep all their partitions."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_share(df):
    """Share of the fullest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def orphans(spark):
    """Claims of 4,000 policies of which two exist, those two, and a customer with two versions."""
    claims = spark.range(4000).select(
        F.concat(F.lit("c"), "id").alias("claimid"),
        F.col("id").alias("policyid"),
        F.lit("Major").alias("incident_severity"),
        F.lit(5.0).alias("injury"),
        *(F.lit("2020-01-01").cast("timestamp").alias(c) for c in ("incident_date", "claim_logged_on", "claim_processed_on")),
        F.lit(None).cast("string").alias("incident_state_full"),
        F.lit(1).alias("number_of_vehicles_involved"),
        F.lit("Y").alias("claim_rejected"),
    )
    policy = spark.createDataFrame(
        [(1, 7, "100/300", "p1"), (2, 8, "250/500", "p2")],
        "policy_number long, customer_id long, policy_csl string, policy_sk string",
    ).withColumns({"valid_from": F.lit(1), "valid_to": F.lit(None).cast("int")})
    customer = spark.createDataFrame(
        [(7, "East", "k1", 1, 2), (7, "West", "k2", 2, None)],
        "customer_id long, region string, customer_sk string, valid_from int, valid_to int",
    )
    return claims, policy, customer


def test_claims_without_policy_spread_over_tasks(spark, shuffled):
    """They have no customer, and must not be gathered under that null key."""
    found = scoring.enrich_claims(*orphans(spark))
    assert largest_share(found) < 0.5
    shown = found.select("policyid", "customer_id", "customer_region", "policy_csl", "customer_claim_count", "total_claim_amount")
    assert sorted(tuple(r) for r in shown.where("policyid < 4").collect()) == [
        (0, None, None, None, 1, 5.0),
        (1, 7, "West", "100/300", 1, 5.0),
        (2, 8, None, "250/500", 1, 5.0),
        (3, None, None, None, 1, 5.0),
    ]
    assert found.count() == 4000


def test_facts_without_policy_spread_over_tasks(spark, shuffled):
    found = star.fact_claims(*orphans(spark))
    assert largest_share(found) < 0.5
    shown = sorted((r.claim_id, r.policy_sk, r.customer_sk) for r in found.where("claim_id < 'c3'").collect() if r.policy_sk)
    assert shown == [("c1", "p1", "k1"), ("c1", "p1", "k2"), ("c2", "p2", None)]
    assert found.count() == 4001


def test_scores_read_written_claims(spark):
    """Statistics, weights and scores share one table instead of joining claims anew."""
    files = Lake(spark, SF_TINY).scored.inputFiles()
    assert files and not any(SF_TINY in f for f in files)


def test_scores_of_joined_claims_keep_the_population(spark):
    """Statistics and weights come from the plain claims, so a join that repeats rows moves no score."""
    claims = Lake(spark, SF_TINY).keep("clean_claims").clean_claims
    plain = {r.claimid: r.anomaly_score for r in scoring.score_claims(claims).collect()}
    part = scoring.derive_amounts(claims.where("car_id % 2 = 0"))
    found = scoring.score_claims(part.unionByName(part), population=claims).collect()
    assert found and all(r.anomaly_score == plain[r.claimid] for r in found)
