"""Claim anomaly scoring: eight rules, CRITIC and business weights, tiers.

Rules compare a claim with population statistics. These come from one pass over
the narrow claim columns (``fit_stats``), are written to the scratch folder, and
re-enter as a scalar subquery and a join with a table of known size. Scoring
itself is a projection, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.functions.numeric import clip01
from larchfield.operators.history import current_rows
from larchfield.operators.star import enrich
from larchfield.session import materialise

# Rule columns in weight order.
RULES = (
    "r1_amount_zscore",
    "r2_severity_mismatch",
    "r3_injury_ratio",
    "r4_staged_accident",
    "r5_doc_gap",
    "r6_theft_with_injury",
    "r7_ghost_injury",
    "r8_injury_per_person",
)

# Business weights in the order of RULES.
BUSINESS_WEIGHTS = dict(zip(RULES, (0.18, 0.16, 0.14, 0.10, 0.07, 0.05, 0.13, 0.17)))

# Label and display threshold of each rule.
TRIGGERS = {
    "r1_amount_zscore": ("R1:HighAmount", 0.4),
    "r2_severity_mismatch": ("R2:SeverityMismatch", 0.4),
    "r3_injury_ratio": ("R3:InjuryRatio", 0.4),
    "r4_staged_accident": ("R4:StagedAccident", 0.4),
    "r5_doc_gap": ("R5:DocGap", 0.3),
    "r6_theft_with_injury": ("R6:TheftWithInjury", 1.0),
    "r7_ghost_injury": ("R7:GhostInjury", 0.4),
    "r8_injury_per_person": ("R8:InjuryPerPerson", 0.4),
}

# Columns of the scores table, in order.
SCORE_COLUMNS = (
    "claimid",
    "customer_id",
    "policyid",
    "incident_date",
    "incident_severity",
    "incident_type",
    "total_claim_amount",
    "vehicle_claim",
    "property_claim",
    "injury_claim",
    "claim_processing_days",
    "property_damage",
    "police_report_available",
    "authorities_contacted",
    "number_of_vehicles_involved",
    "witnesses",
    "claim_rejected",
    "customer_claim_count",
    "customer_region",
    "policy_csl",
    "r1_amount_zscore",
    "r2_severity_mismatch",
    "r3_injury_ratio",
    "r4_staged_accident",
    "r5_doc_gap",
    "anomaly_score",
    "priority_tier",
    "triggered_rules",
)


@dataclass(frozen=True)
class Thresholds:
    """Lowest score of the two upper tiers."""

    medium: float = 40.0
    high: float = 65.0


# --- enrichment ---------------------------------------------------------------


def derive_amounts(claims: DataFrame) -> DataFrame:
    """Numeric claim parts, their total (missing parts count 0), processing days."""
    numeric = (
        "injury",
        "vehicle",
        "property",
        "witnesses",
        "number_of_vehicles_involved",
        "bodily_injuries",
    )
    df = claims.withColumns(
        {c: F.col(c).try_cast("double") for c in numeric if c in claims.columns}
    )
    parts = [F.col(c) if c in df.columns else F.lit(None).cast("double") for c in numeric[:3]]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    dates = [c for c in ("claim_logged_on", "claim_processed_on", "incident_date") if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("date") for c in dates})
    if "claim_processing_days" in df.columns:
        days = F.col("claim_processing_days").try_cast("double")
    elif {"claim_logged_on", "claim_processed_on"} <= set(dates):
        days = F.datediff("claim_processed_on", "claim_logged_on").cast("double")
    else:
        days = F.lit(None).cast("double")
    return df.withColumns(
        {
            "total_claim_amount": total,
            "injury_claim": parts[0],
            "vehicle_claim": parts[1],
            "property_claim": parts[2],
            "claim_processing_days": days,
        }
    )


def customer_counts(claims: DataFrame, policy: DataFrame | None) -> DataFrame:
    """Claims per customer as (_count_key, customer_claim_count).

    Claims are reduced to one row per policy before they meet the policies, so
    the joined claims are not worked out a second time. Without policies the
    policy itself stands in for the customer.
    """
    per_policy = (
        claims.filter(F.col("policyid").isNotNull())
        .groupBy(F.col("policyid").alias("_count_key"))
        .agg(F.count("claimid").alias("customer_claim_count"))
    )
    if policy is None:
        return per_policy
    owners = policy.select(F.col("policy_number").alias("_policy"), F.col("customer_id").alias("_customer"))
    return (
        per_policy.join(owners.filter("_customer IS NOT NULL"), F.col("_count_key") == F.col("_policy"))
        .groupBy(F.col("_customer").alias("_count_key"))
        .agg(F.sum("customer_claim_count").alias("customer_claim_count"))
    )


def add_claim_count(df: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Claims per customer; 1 where the customer is unknown.

    The counts are one row per customer, which grows with the data, so they are
    not broadcast by hand.
    """
    return (
        df.drop("customer_claim_count")
        .join(counts, F.col(key) == F.col("_count_key"), "left")
        .drop("_count_key")
        .withColumn("customer_claim_count", F.coalesce("customer_claim_count", F.lit(1)))
    )


def policy_facts(policy: DataFrame, customer: DataFrame | None, counts: DataFrame) -> DataFrame:
    """Current policies with what a claim takes from them and from their customer.

    Customers and counts meet the policies, not the claims: policies are fewer and
    narrower, and claims without a policy have no customer key to be gathered by.
    """
    wanted = [c for c in ("customer_id", "policy_csl") if c in policy.columns]
    owners = policy.select("policy_number", *wanted)
    owners = enrich(owners, customer, ("customer_id", "customer_id"), {"region": "customer_region"})
    return add_claim_count(owners, counts, "customer_id")


def enrich_claims(
    claims: DataFrame, dim_policy: DataFrame | None = None, dim_customer: DataFrame | None = None
) -> DataFrame:
    """Current claims with policy cover, customer region, amounts and claim count.

    With policies, claims cross one shuffle, by policy. Amounts are worked out
    behind it, so that it carries the plain claims.
    """

    def current(dim: DataFrame | None) -> DataFrame | None:
        return None if dim is None else current_rows(dim)

    claims, policy, customer = current_rows(claims), current(dim_policy), current(dim_customer)
    taken = ("customer_id", "policy_csl", "customer_region")
    by_policy = policy is not None and {"policy_number", "customer_id"} <= set(policy.columns)
    if by_policy and "policyid" in claims.columns and not set(taken) & set(claims.columns):
        facts = policy_facts(policy, customer, customer_counts(claims, policy))
        columns = {c: c for c in (*taken, "customer_claim_count")}
        df = enrich(claims.drop("customer_claim_count"), facts, ("policyid", "policy_number"), columns)
        return derive_amounts(df.withColumn("customer_claim_count", F.coalesce("customer_claim_count", F.lit(1))))
    df = enrich(
        derive_amounts(claims),
        policy,
        ("policyid", "policy_number"),
        {"customer_id": "customer_id", "policy_csl": "policy_csl"},
    )
    df = enrich(df, customer, ("customer_id", "customer_id"), {"region": "customer_region"})
    key = "policyid" if policy is None else "customer_id"
    return add_claim_count(df, customer_counts(claims, policy), key)


# --- population statistics ------------------------------------------------------


def injury_ratio() -> Column:
    return F.try_divide(F.col("injury_claim"), F.col("vehicle_claim") + 1.0)


def is_ghost_injury() -> Column:
    """Injury paid although nobody was reported hurt."""
    return (F.col("bodily_injuries") == 0) & (F.col("injury_claim") > 0)


def injury_per_person() -> Column:
    injury = F.col("injury_claim")
    return F.coalesce(
        F.when(F.col("bodily_injuries") > 0, injury / F.col("bodily_injuries")).otherwise(injury),
        F.lit(0.0),
    )


def population_stats(df: DataFrame) -> DataFrame:
    """Mean and population deviation of every measure, per severity and overall.

    One pass: the rollup yields a row per severity and, with ``scope`` equal to
    ``all``, a row for all claims. Deviations of 0 or NULL become 1, missing
    means 0.
    """
    measures = {
        "amount": F.col("total_claim_amount"),
        "ratio": injury_ratio() if "vehicle_claim" in df.columns else F.lit(None).cast("double"),
        "ghost": F.when(is_ghost_injury(), F.col("injury_claim")),
        "per_person": injury_per_person(),
    }
    if "bodily_injuries" not in df.columns:
        df = df.withColumn("bodily_injuries", F.lit(None).cast("double"))

    def fallback(value: Column, default: float) -> Column:
        return F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(default))

    figures = []
    for name, value in measures.items():
        figures.append(fallback(F.avg(value), 0.0).alias(f"{name}_mean"))
        figures.append(fallback(F.stddev_pop(value), 1.0).alias(f"{name}_std"))
    return (
        df.rollup("incident_severity")
        .agg(F.grouping_id().alias("_all"), *figures)
        .filter("_all = 1 OR incident_severity IS NOT NULL")
        .withColumn("scope", F.when(F.col("_all") == 1, "all").otherwise("severity"))
        .drop("_all")
    )


def fit_stats(df: DataFrame) -> DataFrame:
    """``population_stats`` computed now and kept as a small table."""
    return materialise(population_stats(df), "claim-stats")


# Lowest deviation each rule divides by.
FLOORS = {"amount": 0.0, "peer": 1.0, "ratio": 0.001, "ghost": 1.0, "per_person": 1.0}


def _scale(measure: str, floor: str) -> Column:
    """Factor that turns a distance from the mean into units of two deviations."""
    return 0.5 / F.greatest(f"{measure}_std", F.lit(FLOORS[floor]))


def _population(stats: DataFrame) -> Column:
    """Means and scales over all claims as one struct value."""
    fields = []
    for measure in ("amount", "ratio", "ghost", "per_person"):
        fields.append(F.col(f"{measure}_mean"))
        fields.append(_scale(measure, measure).alias(f"{measure}_scale"))
    return stats.filter("scope = 'all'").agg(F.first(F.struct(*fields))).scalar()


# --- the eight rules --------------------------------------------------------------
# Divisions by statistics are done once, in the statistics: a checked division
# per row and rule would bloat the generated code.


def z_score(value: Column, mean: Column, scale: Column) -> Column:
    """Distance above the mean in units of two deviations, limited to 0..1."""
    return clip01((value - mean) * scale)


def r1(population: Column) -> Column:
    return z_score(
        F.col("total_claim_amount"), population["amount_mean"], population["amount_scale"]
    )


def r2(population: Column) -> Column:
    """Against claims of the same severity, else against all claims."""
    mean = F.coalesce(F.col("_peer_mean"), population["amount_mean"])
    scale = F.coalesce(F.col("_peer_scale"), population["amount_scale"])
    return z_score(F.col("total_claim_amount"), mean, scale)


def r3(population: Column) -> Column:
    return z_score(injury_ratio(), population["ratio_mean"], population["ratio_scale"])


def _points(*tests: Column) -> Column:
    """How many tests hold; an unknown test does not."""
    points = [F.when(t, 1).otherwise(0) for t in tests]
    return sum(points[1:], points[0])


def _test(df: DataFrame, column: str, test: Column) -> Column:
    return test if column in df.columns else F.lit(False)


def r4(df: DataFrame) -> Column:
    """Several vehicles, no witness, no police report: points over three."""
    police = "police_report_available"
    points = _points(
        _test(df, "number_of_vehicles_involved", F.col("number_of_vehicles_involved") > 1),
        _test(df, "witnesses", F.col("witnesses") == 0),
        _test(df, police, F.upper(F.col(police)) != "YES"),
    )
    return F.round(points / 3, 4)


def r5(df: DataFrame) -> Column:
    """Missing papers. Three points over two, so the rule reaches 1.5."""
    police = "police_report_available"
    points = _points(
        _test(df, "property_damage", F.col("property_damage").isNull()),
        _test(df, police, F.col(police).isNull() | (F.upper(F.col(police)) != "YES")),
        _test(df, "authorities_contacted", F.lower(F.col("authorities_contacted")) == "none"),
    )
    return points * F.lit(0.5)


def r6(df: DataFrame) -> Column:
    if not {"incident_type", "bodily_injuries"} <= set(df.columns):
        return F.lit(0.0)
    theft = F.lower(F.col("incident_type")) == "vehicle theft"
    return F.when(theft & (F.col("bodily_injuries") > 0), 1.0).otherwise(0.0)


def r7(df: DataFrame, population: Column) -> Column:
    if "bodily_injuries" not in df.columns:
        return F.lit(0.0)
    peers = z_score(F.col("injury_claim"), population["ghost_mean"], population["ghost_scale"])
    return F.when(is_ghost_injury(), peers).otherwise(0.0)


def r8(df: DataFrame, population: Column) -> Column:
    if "bodily_injuries" not in df.columns:
        return F.lit(0.0)
    return z_score(
        injury_per_person(), population["per_person_mean"], population["per_person_scale"]
    )


def score_rules(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the eight rule columns.

    ``stats`` is the table from ``fit_stats``. Severities are joined without a
    hint: the table's true size decides between broadcast and shuffle.
    """
    population = F.col("_population")
    peers = stats.filter("scope = 'severity'").select(
        F.col("incident_severity").alias("_peer_severity"),
        F.col("amount_mean").alias("_peer_mean"),
        _scale("amount", "peer").alias("_peer_scale"),
    )
    # The subquery is one column, so that it is planned and run once for all rules.
    joined = df.withColumn("_population", _population(stats)).join(
        peers, F.col("incident_severity") == F.col("_peer_severity"), "left"
    )
    values = (
        r1(population),
        r2(population),
        r3(population),
        r4(df),
        r5(df),
        r6(df),
        r7(df, population),
        r8(df, population),
    )
    return joined.withColumns(dict(zip(RULES, values))).drop(
        "_population", "_peer_severity", "_peer_mean", "_peer_scale"
    )


# --- weights ------------------------------------------------------------------------


def rule_moments(df: DataFrame, columns: Sequence[str] = RULES) -> DataFrame:
    """One row: range and deviation of each column, correlation of each pair.

    Without any rows there is no row. A single pass keeps sums, ranges and sums
    of products; all of them merge across tasks. Deviations and correlations are
    arithmetic on that row. A column without spread has correlation NULL with
    every other.
    """
    span = range(len(columns))
    pairs = list(combinations(span, 2))
    filled = df.select(*(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns))
    sums = filled.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(c).alias(f"sum_{i}") for i, c in enumerate(columns)),
        *((F.max(c) - F.min(c)).alias(f"range_{i}") for i, c in enumerate(columns)),
        *(F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"cross_{i}_{j}")
          for i, j in [*((i, i) for i in span), *pairs]),
    )

    def covariance(i: int, j: int) -> Column:
        return F.col(f"cross_{i}_{j}") / F.col("n") - F.col(f"mean_{i}") * F.col(f"mean_{j}")

    # An empty input has no row to divide by, hence the filter.
    means = sums.filter("n > 0").withColumns(
        {f"mean_{i}": F.col(f"sum_{i}") / F.col("n") for i in span}
    )
    spread = means.withColumns(
        {
            f"std_{i}": F.when(
                (F.col(f"range_{i}") > 0) & (covariance(i, i) > 0), F.sqrt(covariance(i, i))
            ).otherwise(0.0)
            for i in span
        }
    )
    return spread.select(
        *(f"std_{i}" for i in span),
        *(f"range_{i}" for i in span),
        *(
            F.when(
                (F.col(f"std_{i}") > 0) & (F.col(f"std_{j}") > 0),
                covariance(i, j) / (F.col(f"std_{i}") * F.col(f"std_{j}")),
            ).alias(f"corr_{i}_{j}")
            for i, j in pairs
        ),
    )


def _pair(i: int, j: int) -> Column:
    return F.lit(1.0) if i == j else F.col(f"corr_{min(i, j)}_{max(i, j)}")


def weights_row(df: DataFrame, columns: Sequence[str] = RULES) -> DataFrame:
    """CRITIC weights as one row with one column per rule.

    CRITIC (Diakoulaki et al., 1995): deviation of the min-max scaled column
    times the sum of 1 - r over the other columns, scaled to sum to 1. A constant
    column has weight 0 and adds no conflict to the others.
    """
    count = len(columns)
    information = []
    for i in range(count):
        spread = F.when(
            F.col(f"range_{i}") > 0, F.col(f"std_{i}") / F.col(f"range_{i}")
        ).otherwise(0.0)
        conflicts = [F.coalesce(1 - _pair(i, j), F.lit(0.0)) for j in range(count) if j != i]
        information.append(spread * sum(conflicts[1:], conflicts[0]))
    return (
        rule_moments(df, columns)
        .select(*(c.alias(n) for n, c in zip(columns, information)))
        .withColumn("_total", sum(map(F.col, columns[1:]), F.col(columns[0])))
        .select(*(F.coalesce(F.try_divide(n, "_total"), F.lit(0.0)).alias(n) for n in columns))
    )


def critic_weights(
    df: DataFrame, columns: Sequence[str] = RULES, run_id: str | None = None
) -> DataFrame:
    """CRITIC weights as rows ``(rule_name, critic_weight)``, plus the run if given."""
    rows = weights_row(df, columns).unpivot([], list(columns), "rule_name", "critic_weight")
    return rows if run_id is None else rows.withColumn("_run_id", F.lit(run_id))


def rule_correlations(df: DataFrame, columns: Sequence[str] = RULES, cut: float = 0.9) -> DataFrame:
    """Correlation of every rule pair with a flag for near-duplicates."""
    cells = [
        F.struct(F.lit(a).alias("rule_a"), F.lit(b).alias("rule_b"), _pair(i, j).alias("r"))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return (
        rule_moments(df, columns)
        .select(F.inline(F.array(*cells)))
        .withColumn(
            "is_collinear",
            (F.col("rule_a") != F.col("rule_b")) & F.coalesce(F.abs("r") > cut, F.lit(False)),
        )
    )


def weighted_score(
    df: DataFrame,
    weights: Mapping[str, float] | DataFrame,
    thresholds: Thresholds = Thresholds(),
    score: str = "anomaly_score",
    tier: str = "priority_tier",
) -> DataFrame:
    """Score 0..100 and tier from fixed weights or a one-row weight frame."""
    if isinstance(weights, DataFrame):
        row = weights.agg(F.first(F.struct(*weights.columns))).scalar()
        df = df.withColumn("_weights", row)
        of = {name: F.col("_weights")[name] for name in weights.columns}
    else:
        if abs(sum(weights.values()) - 1.0) > 1e-9:
            raise ValueError("weights must sum to 1")
        of = {name: F.lit(value) for name, value in weights.items()}
    terms = [of[name] * F.col(name) for name in of]
    points = F.col(score)
    return df.withColumn(
        score, F.round(sum(terms[1:], terms[0]) * 100.0, 2)
    ).withColumn(
        tier,
        F.when(points >= thresholds.high, "HIGH")
        .when(points >= thresholds.medium, "MEDIUM")
        .otherwise("LOW"),
    ).drop("_weights")


def triggered_rules(df: DataFrame, target: str = "triggered_rules") -> DataFrame:
    """Labels of the rules at or above their display threshold, comma-separated."""
    labels = [F.when(F.col(c) >= cut, label) for c, (label, cut) in TRIGGERS.items()]
    return df.withColumn(target, F.concat_ws(", ", *labels))


def score_claims(
    claims: DataFrame,
    thresholds: Thresholds = Thresholds(),
    stats: DataFrame | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """Both scores and the triggered rules. Writes two small tables on the way.

    Statistics and weights read only the claims themselves. Pass claims that are
    joined to something together with the plain ones as ``population``, which the
    statistics and weights are then taken from. Claims are read three times, so
    they should be a written table.
    """

    def derived(df: DataFrame) -> DataFrame:
        return df if "total_claim_amount" in df.columns else derive_amounts(df)

    own = derived(claims)
    everyone = own if population is None else derived(population)
    stats = fit_stats(everyone) if stats is None else stats
    weights = materialise(weights_row(score_rules(everyone, stats)), "claim-weights")
    scored = weighted_score(score_rules(own, stats), weights, thresholds)
    scored = weighted_score(
        scored, BUSINESS_WEIGHTS, thresholds, "anomaly_score_bw", "priority_tier_bw"
    )
    return triggered_rules(scored)


# --- reports ------------------------------------------------------------------------


def is_flagged(tier: str = "priority_tier") -> Column:
    return F.col(tier).isin("HIGH", "MEDIUM")


def score_histogram(
    df: DataFrame, score: str = "anomaly_score", thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Claims per ten points, empty buckets included, with the share below each tier.

    Buckets are closed on the left and end at 100, so a score of 100 or more is
    in none of them; the shares still count it.
    """
    points = F.col(score)
    counts = df.groupBy(F.floor(points / 10).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(points < thresholds.medium).alias("_medium"),
        F.count_if(points < thresholds.high).alias("_high"),
    )
    totals = counts.agg(
        F.sum("_n").alias("n"),
        F.sum("_medium").alias("medium"),
        F.sum("_high").alias("high"),
    )
    total = totals.select(F.struct("n", "medium", "high")).scalar()
    start = F.col("id") * 10
    return (
        df.sparkSession.range(10)
        .join(counts, F.col("id") == F.col("_bucket"), "left")
        .select(
            start.cast("int").alias("bucket_start"),
            F.concat(start.cast("string"), F.lit("-"), (start + 10).cast("string")).alias("bucket"),
            F.coalesce("_n", F.lit(0)).alias("claim_count"),
            F.round(F.try_divide(total["medium"] * 100, total["n"]), 1).alias("pct_below_medium"),
            F.round(F.try_divide(total["high"] * 100, total["n"]), 1).alias("pct_below_high"),
        )
    )


def method_agreement(df: DataFrame) -> DataFrame:
    """Claims flagged by one weighting only, or by both."""
    critic, business = is_flagged("priority_tier"), is_flagged("priority_tier_bw")
    return df.agg(
        F.count_if(critic & ~business).alias("critic_only"),
        F.count_if(critic & business).alias("both"),
        F.count_if(~critic & business).alias("business_only"),
    )


def score_output(df: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """The scores table: fixed columns, flag and run."""
    return df.select(*(c for c in SCORE_COLUMNS if c in df.columns)).withColumns(
        {
            "is_flagged": is_flagged(),
            "_anomaly_run_id": F.lit(run_id),
            "_gold_run_id": F.lit(run_id),
            "_gold_load_ts": F.current_timestamp() if at is None else at,
            "_stage": F.lit("claim_anomaly_scores"),
        }
    )


def flagged_claims(scores: DataFrame, briefs: DataFrame) -> DataFrame:
    """Flagged claims with their brief, NULL where none was written."""
    return (
        scores.filter("is_flagged")
        .join(briefs.select("claimid", "ai_investigation_brief"), "claimid", "left")
        .withColumn("_stage", F.lit("claim_anomaly_explanations"))
    )


def tier_summary(df: DataFrame) -> DataFrame:
    """Claims, mean score and mean amount per tier."""
    return (
        df.groupBy("priority_tier")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.round(F.avg(F.col("anomaly_score").cast("decimal(18,4)")), 2)
            .cast("double")
            .alias("avg_score"),
            F.round(F.avg(F.col("total_claim_amount").try_cast("decimal(18,4)")), 2)
            .cast("double")
            .alias("avg_claim_amount"),
        )
        .orderBy(F.desc("avg_score"))
    )


def top_claims(df: DataFrame, n: int = 5, tier: str = "HIGH") -> DataFrame:
    """Highest scores of a tier; equal scores go by claim id."""
    return (
        df.filter(F.col("priority_tier") == tier)
        .orderBy(F.desc("anomaly_score"), "claimid")
        .select(
            "claimid",
            "anomaly_score",
            "triggered_rules",
            "total_claim_amount",
            "incident_severity",
            "number_of_vehicles_involved",
            "witnesses",
        )
        .limit(n)
    )
