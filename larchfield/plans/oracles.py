"""The same results in DuckDB SQL, stated independently of the operators.

Each check is one SELECT over named steps; only the steps it needs, directly or
through other steps, are put in front of it.
"""

from __future__ import annotations

import re
from itertools import combinations

from larchfield.functions.text import WHITE_SPACE
from larchfield.operators.scoring import BUSINESS_WEIGHTS, RULES, TRIGGERS
from larchfield.plans.entities import REGIONS, STATES
from larchfield.plans.fixtures import AS_OF, BASE_TABLES, DEMAND_DAYS, FAST_DAYS, VIEWS


def rnd(value: str, places: int) -> str:
    """Round half up on the decimal digits, as Spark does on doubles."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def money_sum(value: str, places: int = 2) -> str:
    return f"CAST(round(sum(CAST({value} AS DECIMAL(18,4))), {places}) AS DOUBLE)"


def money_avg(value: str, places: int = 2) -> str:
    total = f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE)"
    return rnd(f"({total} / count({value}))", places)


def pct(part: str, whole: str, places: int = 2) -> str:
    return rnd(f"(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100)", places)


def named(codes: dict[str, str], value: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    title = f"upper({value}[1]) || lower({value}[2:])"
    return f"CASE upper({value}) {whens} ELSE {title} END"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '[^{WHITE_SPACE}]+')"


def strip(text: str) -> str:
    return f"trim({text}, '{WHITE_SPACE}')"


STEPS: dict[str, str] = {
    name: text.format(**{t: t for t in (*BASE_TABLES, *VIEWS)}) for name, text in VIEWS.items()
}


def _reason(*cases: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN NOT coalesce({test}, false) THEN {text}" for test, text in cases)
    return f"CASE {whens} END AS _reject_reason"


_customer_rules = _reason(
    ("customer_id IS NOT NULL", "'R1: customer_id is null'"),
    (f"region IN {in_list(REGIONS.values())}", "'R2: invalid region code'"),
)
_sales_tests = {
    "is_valid_pk": ("sales_id IS NOT NULL", "'PK: sales_id is null'"),
    "is_valid_r2": ("car_id IS NOT NULL", "'R2: car_id is null'"),
    "is_valid_r3": (
        "original_selling_price > 0",
        "'R3: original_selling_price is null or <= 0'",
    ),
    "is_valid_r4": (
        "(sold_on IS NULL OR ad_placed_on IS NULL OR sold_on >= ad_placed_on)",
        "'R4: sold_on is before ad_placed_on'",
    ),
}

STEPS |= {
    "customers_t": f"""
        SELECT *, {_customer_rules}
        FROM (SELECT * REPLACE ({named(REGIONS, 'region')} AS region) FROM fx_customers_raw)""",
    "customers_log_t": f"""
        SELECT *, {_customer_rules}
        FROM (SELECT * REPLACE ({named(REGIONS, 'region')} AS region) FROM fx_customers_log)""",
    "claims_t": f"""
        SELECT *, {_reason(("claimid IS NOT NULL", "'R1: ClaimID is null'"),
                           ("policyid IS NOT NULL", "'R2: PolicyID is null'"))}
        FROM (SELECT * REPLACE (nullif(property_damage, '?') AS property_damage,
                                nullif(police_report_available, '?') AS police_report_available),
                     {named(STATES, 'incident_state')} AS incident_state_full
              FROM fx_claims)""",
    "sales_t": f"SELECT *, {_reason(*_sales_tests.values())} FROM fx_sales",
    "claims_log_t": f"""
        SELECT *, {_reason(("claimid IS NOT NULL", "'R1: ClaimID is null'"),
                           ("policyid IS NOT NULL", "'R2: PolicyID is null'"))}
        FROM (SELECT *, {named(STATES, 'incident_state')} AS incident_state_full FROM fx_claims_log)""",
    "sales_log_t": f"SELECT *, {_reason(*_sales_tests.values())} FROM fx_sales_log",
    "cars_t": f"""
        SELECT *, {_reason(("car_id IS NOT NULL", "'R1: car primary key is null'"),
                           ("km_driven <= 500000", "'R2: km_driven exceeds 500000'"))}
        FROM (SELECT car_id, name, model, fuel, transmission, km_driven, seq,
                     TRY_CAST(regexp_extract(mileage, '([\\d.]+)', 1) AS DOUBLE) AS mileage,
                     regexp_extract(mileage, '([a-zA-Z/]+)', 1) AS mileage_unit,
                     TRY_CAST(regexp_extract(engine, '(\\d+)', 1) AS INTEGER) AS engine_cc,
                     TRY_CAST(regexp_extract(max_power, '([\\d.]+)', 1) AS DOUBLE)
                         AS max_power_bhp,
                     torque AS torque_raw,
                     CASE WHEN contains(lower(torque), 'kgm') THEN
                         {rnd("TRY_CAST(regexp_extract(torque, '([0-9]+[.]?[0-9]*)', 1) AS DOUBLE) * 9.80665::DOUBLE", 2)}
                     ELSE TRY_CAST(regexp_extract(torque, '([0-9]+[.]?[0-9]*)', 1) AS DOUBLE)
                     END AS torque_nm
              FROM fx_cars)""",
    "policy_t": f"""
        SELECT *, umbrella_limit = 0 AS zero_umbrella,
               {_reason(("policy_number IS NOT NULL", "'R1: policy_number is null'"),
                        ("customer_id IS NOT NULL", "'R2: customer_id is null (orphan policy)'"),
                        (f"policy_state_full IN {in_list(STATES.values())}",
                         "'R3: unknown state = ' || coalesce(policy_state_full, 'null')"))}
        FROM (SELECT *, {named(STATES, 'policy_state')} AS policy_state_full FROM fx_policy)""",
}
for _entity in ("customers", "customers_log", "claims", "claims_log", "sales", "sales_log", "cars", "policy"):
    STEPS[f"{_entity}_c"] = f"SELECT * FROM {_entity}_t WHERE _reject_reason IS NULL"


def _warning(table: str, rule: str, column: str, broken: str, text: str, fix: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule_name, '{column}' AS column_name,
        count(*) FILTER (WHERE {broken}) AS failed_records, count(*) AS total_records,
        '{text.replace("'", "''")}' AS description, '{fix.replace("'", "''")}' AS fix
        FROM {table}_c"""


STEPS["warnings"] = " UNION ALL ".join(
    _warning(*row)
    for row in (
        ("customers", "R3_valid_education", "education",
         "education NOT IN ('primary', 'secondary', 'tertiary')",
         "Customer education tier is unknown/invalid",
         "Map unknown values to default 'Unknown' in ETL"),
        ("customers", "R4_positive_balance", "balance", "balance < 0",
         "Customer account balance is negative",
         "Investigate negative transactions in core financial sub-system"),
        ("customers", "R5_valid_marital", "marital",
         "marital NOT IN ('single', 'married', 'divorced')",
         "Customer marital status is unknown/invalid",
         "Enforce strict dropdown selection in source CRM"),
        ("claims", "R5_valid_incident_severity", "incident_severity",
         "incident_severity NOT IN ('Major Damage', 'Minor Damage', 'Trivial Damage')",
         "Claim severity category is not recognized",
         "Update mapping dictionary if business added new severity tiers"),
        ("claims", "R3_valid_dates", "multiple_date_columns", "false",
         "One or more date columns contain Excel serial fragments",
         "Stop regional teams from exporting dates with 'mm:ss.0' formatting"),
        ("sales", "R5_valid_seller", "seller_type",
         "lower(seller_type) NOT IN ('individual', 'dealer', 'trustmark dealer')",
         "Seller type is not classified as individual or dealer",
         "Standardize seller inputs to authorized values only"),
        ("policy", "R4_umbrella_limit_zero_warn", "umbrella_limit", "umbrella_limit = 0",
         "Policy umbrella limit is exactly zero (Verify with business if intended)",
         "Confirm with Underwriting if $0 umbrella limits are active products"),
    )
)

_ISSUE_SELECT = """issue_id, table_name, column_name, rule_name, issue_description, severity,
    affected_records, affected_ratio, suggested_fix"""

STEPS |= {
    "reject_counts": " UNION ALL ".join(
        f"""SELECT '{e}' AS table_name, _reject_reason AS reason, count(*) AS n,
                   (SELECT count(*) FROM {e}_t) AS total
            FROM {e}_t WHERE _reject_reason IS NOT NULL GROUP BY _reject_reason"""
        for e in ("customers", "claims", "sales", "cars", "policy")
    ),
    "quarantine_issues": f"""
        SELECT md5(table_name || '|' || reason) AS issue_id, table_name,
               split_part(reason, ' ', 2) AS column_name, split_part(reason, ':', 1) AS rule_name,
               reason AS issue_description, 'Error (Quarantined)' AS severity,
               n AS affected_records, {rnd('(n / total)', 4)} AS affected_ratio,
               CASE WHEN contains(split_part(reason, ' ', 2), 'id')
                        THEN 'Map missing primary keys from source system'
                    WHEN contains(reason, 'null') THEN 'Enforce NOT NULL constraints upstream'
                    WHEN contains(reason, 'exceeds')
                        THEN 'Validate outlier thresholds with business'
                    ELSE 'Review source system data entry rules' END AS suggested_fix
        FROM reject_counts""",
    "warning_issues": f"""
        SELECT md5(table_name || '|' || rule_name) AS issue_id, table_name, column_name, rule_name,
               description AS issue_description, 'Warning (Passed to Silver)' AS severity,
               failed_records AS affected_records,
               {rnd('(failed_records / total_records)', 4)} AS affected_ratio,
               fix AS suggested_fix
        FROM warnings WHERE failed_records > 0""",
    "issues": f"""
        SELECT md5('sales|missing_file_sales_3') AS issue_id, 'sales' AS table_name,
               'N/A' AS column_name, 'missing_file_sales_3' AS rule_name,
               'sales_3.csv file doesn''t exist' AS issue_description,
               'Warning (Missing File)' AS severity, CAST(0 AS BIGINT) AS affected_records,
               CAST(0 AS DOUBLE) AS affected_ratio,
               'Check Bronze extraction zone for missing payload' AS suggested_fix
        UNION ALL SELECT {_ISSUE_SELECT} FROM quarantine_issues
        UNION ALL SELECT {_ISSUE_SELECT} FROM warning_issues""",
    "event_versions": """
        SELECT user_id, event_id, event_type, value, ts AS "__START_AT",
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
        FROM (SELECT * FROM events QUALIFY
              row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)""",
    "dim_customer": """
        SELECT md5(concat_ws('|', customer_id, CAST(seq AS VARCHAR))) AS customer_sk, *,
               seq AS valid_from, valid_to IS NULL AS is_current
        FROM (SELECT *, lead(seq) OVER (PARTITION BY customer_id ORDER BY seq) AS valid_to
              FROM customers_log_c)""",
    "dim_policy": """
        SELECT md5(concat_ws('|', policy_number, CAST(policy_bind_date AS VARCHAR))) AS policy_sk,
               *, policy_bind_date AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
               true AS is_current
        FROM policy_c WHERE policy_bind_date IS NOT NULL""",
    "dim_car": """
        SELECT md5(concat_ws('|', car_id, CAST(seq AS VARCHAR))) AS car_sk, *,
               seq AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
        FROM cars_c""",
    "now_customers": "SELECT * FROM dim_customer WHERE is_current",
    "fact_claims": """
        SELECT claimid AS claim_id, policy_sk, customer_sk, incident_date, incident_state_full,
               number_of_vehicles_involved, incident_severity, claim_processed_on,
               claim_logged_on,
               CAST(date_diff('day', claim_logged_on, claim_processed_on) AS INTEGER)
                   AS processing_time_days,
               CASE WHEN claim_rejected = 'Y' THEN 1 ELSE 0 END AS is_rejected_int
        FROM claims_c
        LEFT JOIN dim_policy p ON policyid = p.policy_number
        LEFT JOIN dim_customer c ON p.customer_id = c.customer_id""",
    "fact_sales": f"""
        SELECT sales_id, car_sk, region, state, city, ad_placed_on, sold_on,
               original_selling_price,
               CAST(date_diff('day', ad_placed_on, coalesce(sold_on, TIMESTAMP '{AS_OF}'))
                    AS INTEGER) AS days_on_market,
               CASE WHEN sold_on IS NULL THEN 1 ELSE 0 END AS is_unsold
        FROM sales_c LEFT JOIN dim_car USING (car_id)""",
    "aging": """
        SELECT sales_id, region, state, city, model, name AS car_name, fuel, transmission,
               days_on_market, original_selling_price, ad_placed_on,
               CASE WHEN days_on_market >= 90 THEN 'CRITICAL' WHEN days_on_market >= 60 THEN 'HIGH'
                    WHEN days_on_market >= 30 THEN 'WATCH' ELSE 'OK' END AS aging_tier,
               round(original_selling_price * 0.15::DOUBLE) AS at_risk_revenue
        FROM fact_sales JOIN dim_car USING (car_sk) WHERE is_unsold = 1""",
    "demand": f"""
        SELECT model, fuel, transmission, region, count(*) AS total_sold,
               {rnd('avg(days_on_market)', 1)} AS avg_days_to_sell,
               {rnd('quantile_cont(days_on_market, 0.5)', 1)} AS median_days_to_sell
        FROM fact_sales JOIN dim_car USING (car_sk)
        WHERE is_unsold = 0 AND CAST(sold_on AS DATE) >=
              (SELECT CAST(max(sold_on) AS DATE) FROM fact_sales) - {DEMAND_DAYS}
        GROUP BY ALL HAVING count(*) >= 3""",
    "alerts": f"""
        SELECT *, CAST(rank() OVER (ORDER BY risk_score DESC) AS INTEGER) AS priority_rank,
               CASE WHEN demand_region IS NOT NULL
                    THEN concat('Consider moving to ', demand_region, ' — sold in ',
                                CAST(demand_median_days AS VARCHAR), ' days there')
                    ELSE 'No fast-moving region identified — review pricing'
               END AS recommended_action
        FROM (SELECT sales_id, a.region AS stuck_region, state, city, car_name, a.model, a.fuel,
                     days_on_market, aging_tier, original_selling_price, at_risk_revenue,
                     ad_placed_on, d.region AS demand_region,
                     d.median_days_to_sell AS demand_median_days,
                     {rnd('''(CAST(CAST(days_on_market / 90::DOUBLE AS DECIMAL(18,6)) * 50 AS DOUBLE)
                           + original_selling_price / 1000000::DOUBLE * 30
                           + CASE WHEN d.region IS NULL THEN 0 ELSE 20 END)''', 1)} AS risk_score
              FROM aging a LEFT JOIN (SELECT * FROM demand
                                      WHERE median_days_to_sell <= {FAST_DAYS}) d
                ON a.model = d.model AND a.fuel = d.fuel AND a.transmission = d.transmission
               AND a.region <> d.region
              WHERE aging_tier <> 'OK')""",
    "alert_groups": """
        SELECT aging_tier, stuck_region, count(DISTINCT sales_id) AS cars_at_risk,
               sum(DISTINCT at_risk_revenue) AS total_at_risk_revenue,
               count(DISTINCT CASE WHEN demand_region IS NOT NULL THEN sales_id END)
                   AS redistributable_cars,
               sum(DISTINCT CASE WHEN demand_region IS NOT NULL THEN at_risk_revenue END)
                   AS recoverable_revenue,
               coalesce(max(CASE WHEN demand_region IS NOT NULL
                   THEN concat('Move to ', demand_region, ' (sells in ~',
                               CAST(CAST(trunc(demand_median_days) AS INTEGER) AS VARCHAR),
                               ' days)') END),
                   'Review pricing — no fast-moving region found') AS best_action
        FROM alerts GROUP BY aging_tier, stuck_region""",
    "alert_sums": """
        SELECT count(*) AS total_unsold,
               count(*) FILTER (WHERE aging_tier = 'CRITICAL') AS critical_cars,
               count(*) FILTER (WHERE aging_tier = 'HIGH') AS high_cars,
               count(*) FILTER (WHERE aging_tier = 'WATCH') AS watch_cars,
               round(sum(at_risk_revenue)) AS total_at_risk_revenue
        FROM aging""",
}

# --- claim scores ---


def _z(value: str, mean: str, std: str) -> str:
    return f"coalesce(least(1.0::DOUBLE, greatest(0.0::DOUBLE, ({value} - {mean}) / {std} / 2.0::DOUBLE)), 0)"


def _or(value: str, default: float) -> str:
    return f"coalesce(nullif({value}, 0), {default}::DOUBLE)"


_MEASURES = {
    "amount": "total_claim_amount",
    "ratio": "(injury_claim / nullif(vehicle_claim + 1.0::DOUBLE, 0))",
    "ghost": "CASE WHEN bodily_injuries = 0 AND injury_claim > 0 THEN injury_claim END",
    "per_person": "person_cost",
}
_FIGURES = ", ".join(
    f"{_or(f'avg({v})', 0)} AS {n}_mean, {_or(f'stddev_pop({v})', 1)} AS {n}_std"
    for n, v in _MEASURES.items()
)
_POLICE = "upper(police_report_available) <> 'YES'"
_WEIGHTED = " + ".join(f"w{i} * {name}" for i, name in enumerate(RULES))
_BUSINESS = " + ".join(f"{w}::DOUBLE * {name}" for name, w in BUSINESS_WEIGHTS.items())


def _corr(i: int, j: int) -> str:
    return "1.0" if i == j else f"c{min(i, j)}{max(i, j)}"


def _information(i: int) -> str:
    conflict = " + ".join(f"(1 - {_corr(i, j)})" for j in range(8) if j != i)
    return f"s{i} / g{i} * ({conflict})"


def _tier(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 65 THEN 'HIGH' WHEN {score} >= 40 THEN 'MEDIUM' ELSE 'LOW' END"
    )


def _enriched(claims: str) -> str:
    return f"""
        SELECT a.*, p.customer_id, p.policy_csl, c.region AS customer_region,
               coalesce(CASE WHEN p.customer_id IS NOT NULL
                             THEN count(*) OVER (PARTITION BY p.customer_id) END, 1)
                   AS customer_claim_count
        FROM {claims} a
        LEFT JOIN dim_policy p ON a.policyid = p.policy_number
        LEFT JOIN now_customers c ON p.customer_id = c.customer_id"""


STEPS |= {
    "amounts": """
        SELECT *, coalesce(injury, 0) + coalesce(vehicle, 0) + coalesce(property, 0)
                      AS total_claim_amount,
               injury AS injury_claim, vehicle AS vehicle_claim, property AS property_claim,
               CAST(date_diff('day', claim_logged_on, claim_processed_on) AS DOUBLE)
                   AS claim_processing_days,
               coalesce(CASE WHEN bodily_injuries > 0 THEN injury / bodily_injuries
                             ELSE injury END, 0) AS person_cost
        FROM claims_c""",
    "enriched": _enriched("amounts"),
    "population": f"SELECT {_FIGURES} FROM amounts",
    "peers": f"""SELECT incident_severity, {_FIGURES} FROM amounts
                 WHERE incident_severity IS NOT NULL GROUP BY incident_severity""",
    "rules": f"""
        SELECT a.*,
               {_z('total_claim_amount', 'g.amount_mean', 'g.amount_std')} AS r1_amount_zscore,
               {_z('total_claim_amount', 'coalesce(s.amount_mean, g.amount_mean)',
                   'coalesce(greatest(s.amount_std, 1), g.amount_std)')} AS r2_severity_mismatch,
               {_z(_MEASURES['ratio'], 'g.ratio_mean', 'greatest(g.ratio_std, 0.001::DOUBLE)')}
                   AS r3_injury_ratio,
               round((coalesce(CAST(number_of_vehicles_involved > 1 AS INT), 0)
                    + coalesce(CAST(witnesses = 0 AS INT), 0)
                    + coalesce(CAST({_POLICE} AS INT), 0)) / 3::DOUBLE, 4) AS r4_staged_accident,
               (CAST(property_damage IS NULL AS INT) + CAST(coalesce({_POLICE}, true) AS INT)
                    + coalesce(CAST(lower(authorities_contacted) = 'none' AS INT), 0)) / 2::DOUBLE
                   AS r5_doc_gap,
               CASE WHEN lower(incident_type) = 'vehicle theft' AND bodily_injuries > 0
                    THEN 1.0::DOUBLE ELSE 0 END AS r6_theft_with_injury,
               CASE WHEN bodily_injuries = 0 AND injury_claim > 0 THEN
                   {_z('injury_claim', 'g.ghost_mean', 'greatest(g.ghost_std, 1)')}
                   ELSE 0 END AS r7_ghost_injury,
               {_z('person_cost', 'g.per_person_mean', 'greatest(g.per_person_std, 1)')}
                   AS r8_injury_per_person
        FROM amounts a CROSS JOIN population g LEFT JOIN peers s USING (incident_severity)""",
    "moments": "SELECT "
    + ", ".join(
        f"stddev_pop({c}) AS s{i}, max({c}) - min({c}) AS g{i}" for i, c in enumerate(RULES)
    )
    + ", "
    + ", ".join(f"corr({RULES[i]}, {RULES[j]}) AS c{i}{j}" for i, j in combinations(range(8), 2))
    + " FROM rules",
    "information": "SELECT " + ", ".join(f"{_information(i)} AS i{i}" for i in range(8)) + " FROM moments",
    "weights": "SELECT "
    + ", ".join(f"i{i} / ({' + '.join(f'i{j}' for j in range(8))}) AS w{i}" for i in range(8))
    + " FROM information",
    "scored": f"""
        SELECT *, {_tier('anomaly_score')} AS priority_tier,
               {_tier('anomaly_score_bw')} AS priority_tier_bw,
               concat_ws(', ', {', '.join(f"CASE WHEN {c} >= {cut} THEN '{label}' END" for c, (label, cut) in TRIGGERS.items())}) AS triggered_rules
        FROM (SELECT r.*, round(100 * ({_WEIGHTED}), 2) AS anomaly_score,
                     round(100 * ({_BUSINESS}), 2) AS anomaly_score_bw
              FROM rules r CROSS JOIN weights)""",
    "gold_scores": _enriched("scored"),
}

# --- text and vectors ---


def _chunks(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_index,
               CASE WHEN len(tk) <= {size} THEN text
                    ELSE array_to_string(list_slice(tk, i * {step} + 1, i * {step} + {size}), ' ')
               END AS chunk_text,
               {size} AS chunk_size_tokens, {overlap} AS overlap_tokens,
               CAST(CASE WHEN len(tk) <= {size} THEN len(tk)
                         ELSE least({size}, len(tk) - i * {step}) END AS INTEGER)
                   AS chunk_token_count
        FROM (SELECT doc_id, text, tk,
                     unnest(generate_series(0, greatest(0,
                         CAST(ceil((len(tk) - {size}) / {step}) AS BIGINT)))) AS i
              FROM (SELECT doc_id, text, {tokens('text')} AS tk FROM documents))"""


def _dollars(value: str) -> str:
    return f"printf('$%s', format('{{:,d}}', CAST({value} AS BIGINT)))"


def _fields(pairs: dict[str, str]) -> str:
    return " || chr(10) || ".join(f"'{k}: ' || {v}" for k, v in pairs.items())


def _shown(value: str) -> str:
    return f"coalesce(CAST({value} AS VARCHAR), 'None')"


def _amount(value: str) -> str:
    return f"format('{{:,.2f}}', coalesce({value}, 0))"


def _three(value: str) -> str:
    return f"printf('%.3f', {value})"


STEPS |= {
    "chunked_large": _chunks(250, 0),
    "chunked_small": _chunks(64, 32),
    "centres": """
        SELECT label AS query_id, list(x ORDER BY i) AS q
        FROM (SELECT label, i, avg(x) AS x
              FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
                           generate_subscripts(embedding, 1) AS i FROM embeddings)
              GROUP BY label, i)
        GROUP BY label""",
    "nearest": """
        SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank
        FROM (SELECT query_id, vec_id AS doc_id, score,
                     row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
              FROM (SELECT query_id, vec_id,
                           list_cosine_similarity(q, CAST(embedding AS DOUBLE[])) AS score
                    FROM centres, embeddings))
        WHERE rank <= 5""",
    "query_log": """
        SELECT event_type AS question,
               CASE WHEN hour(ts) < 12 THEN 'first' ELSE 'second' END AS approach,
               value / 100 AS confidence, ts AS retrieved_at, event_id AS answer_id
        FROM events""",
}

_EVENT_TEXT = """CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
    CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props"""

_SCORES = """claimid, customer_id, policyid, CAST(CAST(incident_date AS DATE) AS VARCHAR)
        AS incident_date, incident_severity, incident_type, total_claim_amount, vehicle_claim,
    property_claim, injury_claim, claim_processing_days, property_damage, police_report_available,
    authorities_contacted, number_of_vehicles_involved, witnesses, claim_rejected,
    customer_claim_count, customer_region, policy_csl,
    round(r1_amount_zscore, 6) AS r1_amount_zscore,
    round(r2_severity_mismatch, 6) AS r2_severity_mismatch,
    round(r3_injury_ratio, 6) AS r3_injury_ratio, r4_staged_accident, r5_doc_gap, anomaly_score,
    priority_tier, triggered_rules"""

_ALERT_FIGURES = """cars_at_risk, total_at_risk_revenue, redistributable_cars,
    recoverable_revenue"""

CHECKS: dict[str, str] = {
    # sources
    "ingest_events": f"""SELECT {_EVENT_TEXT}, true AS has_source_file,
        true AS has_load_timestamp, CAST(NULL AS VARCHAR) AS _rescued_data
        FROM events WHERE event_type <> 'error'
        UNION ALL SELECT CAST(event_id AS VARCHAR), NULL, CAST(user_id AS VARCHAR), NULL, NULL,
        NULL, true, true, event_id || ',' || user_id || ',extra'
        FROM events WHERE event_type = 'error'""",
    "ingest_json_events": f"""SELECT {_EVENT_TEXT}, CAST(NULL AS VARCHAR) AS _rescued_data
        FROM events""",
    "reconcile_files": """
        WITH e AS (SELECT *, event_id % 4 AS part FROM events),
        m AS (SELECT count(DISTINCT user_id) > 1 AS mixed FROM events WHERE event_id IN (4, 8))
        SELECT count(*) AS raw_count, count(*) AS bronze_count,
               NOT (part = 0 AND (SELECT mixed FROM m)) AS content_equal, '' AS schema_problems,
               NOT (part = 0 AND (SELECT mixed FROM m)) AS passed
        FROM e GROUP BY part""",
    "reconcile_counts": """SELECT event_type, count(*) AS raw_count, count(*) AS bronze_count,
        '' AS schema_problems, true AS passed FROM events GROUP BY event_type""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, count(*) AS record_count FROM {e}_c"
        for e in ("customers", "claims", "sales", "cars", "policy")
    ),
    # cleansing
    "unify_cased_columns": """SELECT o_orderkey AS orderkey,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority ELSE 'none' END AS priority,
        o_orderstatus AS status FROM orders""",
    "merge_synonyms": """SELECT balance, customer_id, region AS region_raw,
        CAST(NULL AS VARCHAR) AS city, education, marital FROM fx_customers_raw""",
    "expand_codes": f"""SELECT claimid, incident_state,
        {named(STATES, 'incident_state')} AS state_name FROM fx_claims""",
    "expand_region_codes": f"""SELECT customer_id, region, balance,
        {named(REGIONS, 'region')} AS region_name FROM fx_customers_raw""",
    "null_tokens": """SELECT event_id, CASE WHEN d <> 'Null' THEN d END AS d,
        nullif(flag, '?') AS flag FROM fx_dates_raw""",
    "parse_timestamps": """SELECT event_id, coalesce(try_strptime(d, '%d-%m-%Y %H:%M'),
        try_strptime(d, '%Y-%m-%d %H:%M:%S'), try_strptime(d, '%d-%m-%Y'),
        try_strptime(d, '%Y-%m-%d')) AS d FROM fx_dates_raw""",
    "flag_corrupt": """SELECT event_id, d, regexp_matches(d, '^[0-9]{1,3}:[0-9]{2}[.][0-9]+$')
        AS _is_corrupt_date FROM fx_dates_raw""",
    "drop_blank_rows": """SELECT event_id, event_type AS kind, 'feed' AS _source_file
        FROM events WHERE event_type <> 'error'""",
    "extract_measure": """SELECT car_id,
        CAST(regexp_extract(mileage, '[0-9.]+') AS DOUBLE) AS mileage,
        regexp_extract(mileage, '[a-zA-Z/]+') AS mileage_unit,
        CAST(regexp_extract(engine, '[0-9]+') AS INTEGER) AS engine_cc,
        CAST(regexp_extract(max_power, '[0-9.]+') AS DOUBLE) AS max_power_bhp FROM fx_cars""",
    "convert_units": "SELECT car_id, torque AS torque_raw, torque_nm "
    "FROM fx_cars JOIN (SELECT car_id, torque_nm FROM cars_t) USING (car_id)",
    "try_cast_cols": """SELECT p_partkey, TRY_CAST(p_type AS DOUBLE) AS as_text,
        TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) AS as_number FROM part""",
    "with_flags": """SELECT policy_number, umbrella_limit, policy_state,
        umbrella_limit = 0 AS umbrella_zero, policy_number IS NULL AS is_orphan FROM fx_policy""",
    "valid_email": """SELECT c_custkey, email, coalesce(
        regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$'), false)
            AS is_valid
        FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN
                  lower(replace(c_name, '#', '.')) || CASE WHEN c_acctbal < 0 THEN '' ELSE '@' END
                  || lower(c_mktsegment) || CASE WHEN c_acctbal > 9000 THEN '.c' ELSE '.com' END
              END AS email FROM customer)""",
    # quality
    "dq_rules": "SELECT sales_id, "
    + ", ".join(f"coalesce({test}, false) AS {n}" for n, (test, _) in _sales_tests.items())
    + " FROM fx_sales",
    "quarantine_customers": """SELECT customer_id, region, balance, _reject_reason
        FROM customers_t WHERE _reject_reason IS NOT NULL""",
    "quarantine_sales": """SELECT sales_id, car_id, _reject_reason FROM sales_t
        WHERE _reject_reason IS NOT NULL""",
    "quarantine_cars": """SELECT car_id, km_driven, _reject_reason FROM cars_t
        WHERE _reject_reason IS NOT NULL""",
    "quarantine_policy": """SELECT policy_number, customer_id, policy_state_full, _reject_reason
        FROM policy_t WHERE _reject_reason IS NOT NULL""",
    "quarantine_claims": """SELECT claimid, policyid, _reject_reason FROM claims_t
        WHERE _reject_reason IS NOT NULL""",
    "clean_customers": """SELECT customer_id, region, education, marital, job, balance
        FROM customers_c""",
    "expectations": """SELECT table_name, rule_name, failed_records, total_records
        FROM warnings""",
    "dq_quarantine_stats": "SELECT * FROM quarantine_issues",
    "dq_warning_stats": "SELECT * FROM warning_issues",
    "dq_issue_log": "SELECT * FROM issues",
    "dq_issue_seq": """SELECT *, CAST(row_number() OVER (
        ORDER BY severity, table_name, issue_id) AS INTEGER) AS issue_seq FROM issues""",
    "dash_compliance_log": """SELECT upper(table_name[1]) || table_name[2:] AS entity,
        column_name AS "column", issue_description, severity, affected_records AS affected_rows,
        concat(CAST(round(affected_ratio * 100, 2) AS VARCHAR), '%') AS impact_rate,
        suggested_fix AS suggested_action FROM issues""",
    "dash_severity_entity": """SELECT upper(table_name[1]) || table_name[2:] AS entity, severity,
        CAST(sum(affected_records) AS BIGINT) AS total_records
        FROM issues GROUP BY table_name, severity""",
    "dash_kpis": """SELECT
        CAST(sum(affected_records) FILTER (WHERE severity LIKE 'Error%') AS BIGINT)
            AS total_quarantined,
        CAST(sum(affected_records) FILTER (WHERE severity LIKE 'Warning%') AS BIGINT)
            AS total_warnings FROM issues""",
    # history, dimensions, facts
    "scd2_events": "SELECT * FROM event_versions",
    "scd2_stream": "SELECT * FROM event_versions",
    "scd2_claims": """SELECT claimid, incident_severity, incident_state_full, seq AS "__START_AT",
        lead(seq) OVER (PARTITION BY claimid ORDER BY seq) AS "__END_AT"
        FROM claims_log_c WHERE seq IS NOT NULL""",
    "scd2_sales": """SELECT sales_id, sold_on, seq AS "__START_AT",
        lead(seq) OVER (PARTITION BY sales_id ORDER BY seq) AS "__END_AT"
        FROM (SELECT DISTINCT sales_id, sold_on, seq FROM sales_log_c)""",
    "history_rejects": """
        SELECT 'policy' AS table_name, 'no version: seq is null' AS _reject_reason,
               count(*) FILTER (WHERE policy_bind_date IS NULL) AS rejected,
               count(DISTINCT policy_number) FILTER (WHERE policy_bind_date IS NOT NULL) AS versions,
               CAST(0 AS BIGINT) AS repeated, count(*) AS total FROM policy_c
        UNION ALL
        SELECT 'claims', 'no version: seq is null', count(*) FILTER (WHERE seq IS NULL),
               count(DISTINCT (claimid, seq)) FILTER (WHERE seq IS NOT NULL),
               CAST(0 AS BIGINT), count(*) FROM claims_log_c""",
    "stream_quarantine": f"""
        SELECT claimid, CAST(policyid AS VARCHAR) AS policyid,
               {named(STATES, 'incident_state')} AS incident_state_full,
               nullif(property_damage, '?') AS property_damage,
               car_id % 59 = 0 AS _is_corrupt_date, 'silver_claims' AS _stage,
               CAST(incident_date AS VARCHAR) AS incident_date,
               CASE WHEN car_id % 59 <> 0 THEN CAST(claim_logged_on AS VARCHAR) END AS claim_logged_on,
               CASE WHEN car_id % 61 <> 0 THEN CAST(claim_processed_on AS VARCHAR) END
                   AS claim_processed_on,
               CASE WHEN policyid IS NULL THEN 'R2: PolicyID is null' END AS _reject_reason
        FROM fx_claims""",
    "stream_expectations": """
        SELECT CAST(1 - car_id % 2 AS INTEGER) AS batch_id, rule_name,
               count(*) FILTER (WHERE CASE rule_name WHEN 'R3_valid_dates' THEN car_id % 59 = 0
                   ELSE incident_severity = 'Unclassified' END) AS failed_records,
               count(*) AS total_records
        FROM claims_c, (VALUES ('R3_valid_dates'), ('R5_valid_incident_severity')) r(rule_name)
        GROUP BY ALL""",
    "stream_fact_claims": """
        SELECT * FROM fact_claims SEMI JOIN (SELECT claimid AS claim_id FROM claims_c WHERE car_id % 2 = 0) USING (claim_id)
        UNION ALL BY NAME
        SELECT claimid AS claim_id, policy_sk, customer_sk, incident_date, incident_state_full,
               number_of_vehicles_involved, incident_severity, claim_processed_on, claim_logged_on,
               CAST(date_diff('day', claim_logged_on, claim_processed_on) AS INTEGER)
                   AS processing_time_days,
               CASE WHEN claim_rejected = 'Y' THEN 1 ELSE 0 END AS is_rejected_int
        FROM claims_c
        LEFT JOIN dim_policy p ON policyid = p.policy_number
        LEFT JOIN (SELECT * FROM dim_customer WHERE valid_from < TIMESTAMP '1998-01-01') c
          ON p.customer_id = c.customer_id
        WHERE car_id % 2 = 1""",
    "stream_fact_sales": """
        SELECT f.* REPLACE (CASE WHEN s.car_id % 2 = 0 OR s.car_id % 3 <> 0 THEN f.car_sk END AS car_sk)
        FROM fact_sales f JOIN sales_c s USING (sales_id)""",
    "scd2_current": """SELECT user_id, event_id, event_type, value FROM event_versions
        WHERE "__END_AT" IS NULL""",
    "dim_customer": """SELECT customer_sk, customer_id, region, education, marital, job, balance,
        valid_from, valid_to, is_current FROM dim_customer""",
    "dim_policy": """SELECT policy_sk, policy_number, customer_id,
        policy_state AS policy_state_code, policy_state_full, policy_csl, policy_annual_premium,
        valid_from, valid_to, is_current FROM dim_policy""",
    "dim_car": """SELECT car_sk, car_id, name, model, fuel, transmission, km_driven, mileage,
        mileage_unit, engine_cc, max_power_bhp, torque_raw, torque_nm, valid_from, valid_to,
        is_current FROM dim_car""",
    "fact_claims": "SELECT * FROM fact_claims",
    "fact_car_sales": "SELECT * FROM fact_sales",
    "asof_dim_join": """SELECT o_orderkey, o_custkey, o_orderdate, customer_sk AS customer_customer_sk,
        balance AS customer_balance
        FROM orders LEFT JOIN dim_customer ON o_custkey = customer_id
         AND o_orderdate >= valid_from
         AND (valid_to IS NULL OR o_orderdate < valid_to)""",
    # marts
    "mart_claim_performance": f"""SELECT region, policy_csl, incident_severity,
        CAST(year(incident_date) AS INTEGER) AS incident_year,
        CAST(month(incident_date) AS INTEGER) AS incident_month,
        count(claim_id) AS total_claims_filed,
        {rnd('avg(processing_time_days)', 1)} AS avg_processing_time_days,
        {pct('sum(is_rejected_int)', 'count(claim_id)')} AS rejection_rate_pct
        FROM fact_claims JOIN dim_policy USING (policy_sk) JOIN dim_customer USING (customer_sk)
        GROUP BY ALL""",
    "mart_unsold_inventory": f"""SELECT model, count(sales_id) AS stagnant_vehicle_count,
        {money_avg('original_selling_price')} AS avg_original_selling_price,
        {rnd('avg(days_on_market)', 1)} AS avg_days_on_market,
        max(days_on_market) AS max_days_on_market
        FROM fact_sales JOIN dim_car USING (car_sk)
        WHERE is_unsold = 1 AND days_on_market > 60 GROUP BY model""",
    "mart_customer_metrics": """SELECT region, count(*) AS total_active_customers,
        count(*) FILTER (WHERE education = 'tertiary') AS tertiary_edu_count
        FROM now_customers GROUP BY region""",
    # key figures
    "kpi_policy_overview": f"""SELECT count(*) AS total_policies,
        count(DISTINCT customer_id) AS unique_customers,
        {money_avg('policy_annual_premium')} AS avg_annual_premium,
        {money_sum('policy_annual_premium')} AS total_annual_premium,
        {money_avg('policy_deductable')} AS avg_deductable,
        {money_avg('umbrella_limit')} AS avg_umbrella_limit,
        count(*) FILTER (WHERE zero_umbrella) AS zero_umbrella_count FROM dim_policy""",
    "kpi_policy_states": f"""SELECT policy_state_full, count(*) AS policy_count,
        {money_avg('policy_annual_premium')} AS avg_premium FROM dim_policy
        GROUP BY ALL ORDER BY policy_count DESC, policy_state_full LIMIT 5""",
    "kpi_policy_csl": """SELECT policy_csl, count(*) AS "count" FROM dim_policy GROUP BY ALL""",
    "kpi_premium_buckets": """SELECT CASE WHEN policy_annual_premium < 500 THEN '<$500'
        WHEN policy_annual_premium < 1000 THEN '$500-$1k'
        WHEN policy_annual_premium < 2000 THEN '$1k-$2k' ELSE '>$2k' END AS premium_bucket,
        count(*) AS "count" FROM dim_policy GROUP BY ALL""",
    "kpi_claims_overview": f"""SELECT count(*) AS total_claims,
        CAST(sum(is_rejected_int) AS BIGINT) AS total_rejected,
        {pct('sum(is_rejected_int)', 'count(*)')} AS rejection_rate_pct,
        {rnd('avg(processing_time_days)', 2)} AS avg_processing_days,
        max(processing_time_days) AS max_processing_days,
        min(processing_time_days) AS min_processing_days FROM fact_claims""",
    "kpi_claims_severity": f"""SELECT incident_severity, count(*) AS claim_count,
        {rnd('avg(processing_time_days)', 2)} AS avg_processing_days,
        CAST(sum(is_rejected_int) AS BIGINT) AS rejected_count,
        {pct('sum(is_rejected_int)', 'count(*)')} AS rejection_rate_pct
        FROM fact_claims GROUP BY ALL""",
    "kpi_claims_states": f"""SELECT incident_state_full, count(*) AS claim_count,
        {rnd('avg(processing_time_days)', 2)} AS avg_processing_days,
        {pct('sum(is_rejected_int)', 'count(*)')} AS rejection_rate_pct
        FROM fact_claims GROUP BY ALL ORDER BY claim_count DESC, incident_state_full LIMIT 5""",
    "kpi_claims_vehicles": """SELECT number_of_vehicles_involved, count(*) AS "count"
        FROM fact_claims GROUP BY ALL""",
    "kpi_customer_overview": f"""SELECT count(*) AS total_customers,
        {money_avg('balance')} AS avg_balance, {money_sum('balance')} AS total_balance,
        {rnd('max(balance)', 2)} AS max_balance, {rnd('min(balance)', 2)} AS min_balance
        FROM now_customers""",
    "kpi_customer_jobs": f"""SELECT job, count(*) AS "count",
        {money_avg('balance')} AS avg_balance FROM now_customers GROUP BY ALL
        ORDER BY "count" DESC, job LIMIT 6""",
    "kpi_customer_marital": f"""SELECT marital, count(*) AS "count",
        {money_avg('balance')} AS avg_balance FROM now_customers GROUP BY ALL""",
    "kpi_customer_education": """SELECT education, count(*) AS "count"
        FROM now_customers GROUP BY ALL""",
    "kpi_customer_regions": f"""SELECT region, count(*) AS "count",
        {money_avg('balance')} AS avg_balance FROM now_customers GROUP BY ALL""",
    "kpi_customer_cross_sell": """SELECT carloan, hhinsurance, count(*) AS "count"
        FROM now_customers GROUP BY ALL""",
    "kpi_customer_dims": f"""
        SELECT 'marital' AS dimension, marital AS value, count(*) AS "count",
               {money_avg('balance')} AS avg_balance FROM now_customers GROUP BY marital
        UNION ALL SELECT 'education', education, count(*), NULL FROM now_customers
               GROUP BY education
        UNION ALL SELECT 'region', region, count(*), {money_avg('balance')} FROM now_customers
               GROUP BY region""",
    "customer_segments": f"""SELECT job, count(*) AS customer_count,
        {money_avg('balance', 0)} AS avg_balance,
        {pct("count(*) FILTER (WHERE carloan = 'yes')", 'count(*)', 1)} AS carloan_pct,
        {pct("count(*) FILTER (WHERE hhinsurance = 'yes')", 'count(*)', 1)} AS hhinsurance_pct
        FROM now_customers WHERE job IS NOT NULL GROUP BY job
        ORDER BY customer_count DESC, job LIMIT 6""",
    "kpi_fleet": f"""SELECT count(*) AS total_vehicles, {money_avg('km_driven', 0)} AS avg_km_driven,
        {money_avg('mileage')} AS avg_mileage, {money_avg('engine_cc', 0)} AS avg_engine_cc,
        {money_avg('max_power_bhp')} AS avg_max_power_bhp FROM dim_car""",
    "kpi_fleet_fuel": """SELECT fuel, count(*) AS "count" FROM dim_car GROUP BY ALL""",
    "kpi_fleet_transmission": """SELECT transmission, count(*) AS "count" FROM dim_car
        GROUP BY ALL""",
    "kpi_sales_overview": f"""SELECT count(*) AS total_listings,
        CAST(sum(is_unsold) AS BIGINT) AS unsold_count,
        {rnd('((1 - avg(is_unsold)) * 100)', 2)} AS sold_rate_pct,
        {money_avg('original_selling_price')} AS avg_selling_price,
        {money_sum('original_selling_price')} AS total_gmv,
        {rnd('avg(days_on_market)', 1)} AS avg_days_on_market FROM fact_sales""",
    "kpi_sales_region": f"""SELECT region, count(*) AS listings,
        {money_avg('original_selling_price')} AS avg_price,
        {rnd('avg(days_on_market)', 1)} AS avg_days_on_market,
        {rnd('((1 - avg(is_unsold)) * 100)', 2)} AS sold_rate_pct
        FROM fact_sales GROUP BY region""",
    "fuel_risk": f"""SELECT fuel, count(*) AS total_vehicles,
        {money_avg('km_driven', 0)} AS avg_km_driven,
        {money_avg('max_power_bhp', 1)} AS avg_power_bhp, count(claimid) AS total_claims
        FROM dim_car c LEFT JOIN (SELECT car_id, claimid FROM claims_c) USING (car_id)
        GROUP BY fuel""",
    # inventory alert
    "aging_inventory": "SELECT * FROM aging",
    "demand_signal": "SELECT * FROM demand",
    "alert_scored": "SELECT * FROM alerts",
    "alert_summary": f"SELECT aging_tier, stuck_region, {_ALERT_FIGURES} FROM alert_groups",
    "alert_totals": "SELECT * FROM alert_sums",
    "alert_regions": f"""SELECT stuck_region, aging_tier, {_ALERT_FIGURES}, best_action,
        {pct('coalesce(recoverable_revenue, 0)', 'total_at_risk_revenue', 1)} AS recovery_pct
        FROM alert_groups WHERE aging_tier IN ('CRITICAL', 'HIGH')
        ORDER BY aging_tier, total_at_risk_revenue DESC, stuck_region LIMIT 6""",
    "alert_digest": f"""SELECT s.*, r.recoverable_revenue,
        {pct('r.recoverable_revenue', 's.total_at_risk_revenue', 1)} AS recovery_pct
        FROM alert_sums s, (SELECT coalesce(sum(recoverable_revenue), 0) AS recoverable_revenue
                            FROM alert_groups WHERE aging_tier IN ('CRITICAL', 'HIGH')) r""",
    "alert_check": """
        SELECT * FROM (
            SELECT 'cars' AS counted, * FROM alert_sums
            UNION ALL
            SELECT 'offers', (SELECT count(*) FROM aging),
                   count(*) FILTER (WHERE aging_tier = 'CRITICAL'),
                   count(*) FILTER (WHERE aging_tier = 'HIGH'),
                   count(*) FILTER (WHERE aging_tier = 'WATCH'), round(sum(at_risk_revenue))
            FROM alerts)
        WHERE critical_cars + high_cars + watch_cars > total_unsold""",
    # claim scores
    "claims_enriched": """SELECT claimid, policyid, customer_id, customer_region, policy_csl,
        total_claim_amount, injury_claim, vehicle_claim, property_claim, claim_processing_days,
        customer_claim_count FROM enriched""",
    "claim_stats": "SELECT incident_severity, scope, "
    + ", ".join(
        f"round({n}_{f}, 4) AS {n}_{f}" for n in _MEASURES for f in ("mean", "std")
    )
    + """ FROM (SELECT 'all' AS scope, CAST(NULL AS VARCHAR) AS incident_severity, * FROM population
        UNION ALL BY NAME SELECT 'severity' AS scope, * FROM peers)""",
    "critic_weights": " UNION ALL ".join(
        f"SELECT '{c}' AS rule_name, round(w{i}, 6) AS critic_weight FROM weights"
        for i, c in enumerate(RULES)
    ),
    "rule_correlations": " UNION ALL ".join(
        f"""SELECT '{a}' AS rule_a, '{b}' AS rule_b, round(CAST({_corr(i, j)} AS DOUBLE), 6) AS r,
            {'false' if i == j else f'abs({_corr(i, j)}) > 0.9'} AS is_collinear FROM moments"""
        for i, a in enumerate(RULES)
        for j, b in enumerate(RULES)
    ),
    "anomaly_critic": "SELECT claimid, anomaly_score, priority_tier FROM scored",
    "anomaly_business": "SELECT claimid, anomaly_score_bw, priority_tier_bw FROM scored",
    "triggered_rules": "SELECT claimid, triggered_rules FROM scored",
    "score_histogram": f"""SELECT CAST(b * 10 AS INTEGER) AS bucket_start,
        concat(b * 10, '-', b * 10 + 10) AS bucket,
        (SELECT count(*) FROM scored WHERE floor(anomaly_score / 10) = b) AS claim_count,
        (SELECT {pct('count(*) FILTER (WHERE anomaly_score < 40)', 'count(*)', 1)} FROM scored)
            AS pct_below_medium,
        (SELECT {pct('count(*) FILTER (WHERE anomaly_score < 65)', 'count(*)', 1)} FROM scored)
            AS pct_below_high
        FROM range(10) t(b)""",
    "method_agreement": """SELECT
        count(*) FILTER (WHERE priority_tier <> 'LOW' AND priority_tier_bw = 'LOW') AS critic_only,
        count(*) FILTER (WHERE priority_tier <> 'LOW' AND priority_tier_bw <> 'LOW') AS both,
        count(*) FILTER (WHERE priority_tier = 'LOW' AND priority_tier_bw <> 'LOW')
            AS business_only FROM scored""",
    "flagged_claims": f"""SELECT {_SCORES}, true AS is_flagged, 'run-1' AS _anomaly_run_id,
        'run-1' AS _gold_run_id, 'claim_anomaly_explanations' AS _stage,
        'Brief on ' || claimid AS ai_investigation_brief
        FROM gold_scores WHERE priority_tier <> 'LOW'""",
    "tier_summary": f"""SELECT priority_tier, count(*) AS claim_count,
        {money_avg('anomaly_score')} AS avg_score,
        {money_avg('total_claim_amount')} AS avg_claim_amount FROM scored GROUP BY priority_tier""",
    "top_claims": """SELECT claimid, anomaly_score, triggered_rules, total_claim_amount,
        incident_severity, number_of_vehicles_involved, witnesses FROM scored
        WHERE priority_tier = 'HIGH' ORDER BY anomaly_score DESC, claimid LIMIT 5""",
    # text and retrieval
    "policy_documents": f"""SELECT policy_number, concat('Policy ', policy_number,
        ' is an active auto insurance policy bound on ', strftime(policy_bind_date, '%Y-%m-%d'),
        ', issued in ', policy_state_full, ' (', policy_state, '). ',
        'The combined single limit (CSL) is ', policy_csl, ', meaning $',
        split_part(policy_csl, '/', 1), 'K per person and $', split_part(policy_csl, '/', 2),
        'K per occurrence. This single limit covers both bodily injury and property damage claims.',
        CASE policy_csl
            WHEN '500/1000'
                THEN ' This policy can cover large property damage claims up to $1,000,000.'
            WHEN '250/500' THEN ' This policy can cover property damage claims up to $500,000.'
            ELSE ' This policy covers property damage claims up to $300,000.' END,
        ' The deductible is ', {_dollars('policy_deductable')}, ' (',
        CASE WHEN policy_deductable <= 500 THEN 'low' WHEN policy_deductable <= 1000
             THEN 'standard' ELSE 'high' END,
        ' deductible tier). The annual premium is $',
        format('{{:,.2f}}', policy_annual_premium), '. ',
        CASE WHEN umbrella_limit > 0 THEN concat(
            'This policy HAS umbrella coverage with an additional limit of ',
            {_dollars('umbrella_limit')}, '. Umbrella coverage provides extra liability protection',
            ' beyond the base CSL limit.')
        ELSE concat('This policy does NOT have umbrella coverage. No additional liability ',
            'protection beyond the base CSL limit.') END,
        ' Car ID: N/A. Customer ID: ', customer_id, '.') AS nl_document FROM dim_policy""",
    "token_stats": f"""SELECT CAST(min(n) AS INTEGER) AS min_tokens,
        CAST(max(n) AS INTEGER) AS max_tokens, {rnd('avg(n)', 1)} AS mean_tokens,
        {rnd('quantile_cont(n, 0.95)', 1)} AS p95_tokens
        FROM (SELECT len({tokens('text')}) AS n FROM documents)""",
    "chunks_large": "SELECT * FROM chunked_large",
    "chunks_small": "SELECT * FROM chunked_small",
    "corpus_stats": f"""SELECT chunk_size_tokens, overlap_tokens, count(*) AS chunks,
        {rnd('(count(*) / count(DISTINCT doc_id))', 3)} AS avg_chunks_per_source,
        count(DISTINCT CASE WHEN chunk_index > 0 THEN doc_id END) AS sources_split,
        min(chunk_token_count) AS min_tokens, max(chunk_token_count) AS max_tokens,
        {rnd('avg(chunk_token_count)', 1)} AS mean_tokens
        FROM (SELECT * FROM chunked_large UNION ALL SELECT * FROM chunked_small) GROUP BY ALL""",
    "topk_cosine": "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM nearest",
    "retrieval_confidence": """SELECT query_id,
        round(least(1, greatest(0, (avg(score) - 0.30::DOUBLE) / (0.95::DOUBLE - 0.30::DOUBLE))), 4)
            AS confidence FROM nearest WHERE rank <= 3 GROUP BY query_id""",
    "retrieval_sources": """SELECT query_id, string_agg(label, ',' ORDER BY first_rank)
            AS source_policies
        FROM (SELECT query_id, CAST(label AS VARCHAR) AS label, min(rank) AS first_rank
              FROM nearest JOIN embeddings ON doc_id = vec_id GROUP BY ALL)
        GROUP BY query_id""",
    "confidence_pivot": """SELECT coalesce(question, 'average') AS question,
        round(avg(confidence) FILTER (WHERE approach = 'first'), 4) AS "first",
        round(avg(confidence) FILTER (WHERE approach = 'second'), 4) AS "second"
        FROM query_log GROUP BY ROLLUP (question)""",
    "latest_per_key": """SELECT * FROM query_log QUALIFY row_number() OVER (
        PARTITION BY question, approach ORDER BY retrieved_at DESC, answer_id DESC) = 1""",
    "dq_prompt": "SELECT issue_id, concat('Explain this data quality issue to a compliance officer"
    " in plain business words, under the headings FINDING, BUSINESS IMPACT, ROOT CAUSE, ACTION"
    " TAKEN, PREVENTION.', chr(10), chr(10), "
    + _fields(
        {
            "System": "table_name",
            "Column": "column_name",
            "Rule": "rule_name",
            "What happened": "issue_description",
            "What was done": """CASE severity
                WHEN 'Error (Quarantined)'
                    THEN 'The rows were set apart and wait for somebody to look at them'
                WHEN 'Warning (Missing File)'
                    THEN 'The source file never arrived, so nothing was loaded from it'
                ELSE 'The rows went on with a note attached' END""",
            "Records": "concat(affected_records, ' (', printf('%.1f%%', affected_ratio * 100), ')')",
            "Suggested fix": "suggested_fix",
        }
    )
    + ") AS prompt FROM issues",
    "extract_text": f"""SELECT conv_id, turn,
        CASE WHEN role = 'user' THEN {strip('text')} ELSE {strip("text || ' ' || role")} END
            AS all_text,
        {strip('text')} AS first_text FROM conversations""",
}
for _i, _rule in enumerate(RULES, 1):
    CHECKS[f"rule_r{_i}"] = f"SELECT claimid, round({_rule}, 6) AS {_rule} FROM rules"

CHECKS["fuel_prompt"] = (
    "SELECT fuel, concat('Assess the underwriting risk of this fuel type in one or two sentences.',"
    " chr(10), chr(10), "
    + _fields(
        {
            c: _shown(c)
            for c in ("fuel", "total_vehicles", "avg_km_driven", "avg_power_bhp", "total_claims")
        }
    )
    + f") AS prompt FROM ({CHECKS['fuel_risk']})"
)
CHECKS["segment_prompt"] = (
    "SELECT job, concat('Name one concrete retention or upsell step for this customer segment.',"
    " chr(10), chr(10), "
    + _fields({c: _shown(c) for c in ("job", "avg_balance", "carloan_pct", "hhinsurance_pct")})
    + f") AS prompt FROM ({CHECKS['customer_segments']})"
)
CHECKS["brief_prompt"] = (
    "SELECT claimid, concat('Write an investigation brief of at most 400 words on this flagged"
    " insurance claim: why it is suspicious, which risk factors are present, and three to five"
    " next steps. Rely only on the figures below (rules run from 0, no signal, to 1).',"
    " chr(10), chr(10), "
    + _fields(
        {
            "Claim": _shown("claimid"),
            "Customer": _shown("customer_id"),
            "Policy": _shown("policyid"),
            "Incident date": _shown("CAST(incident_date AS DATE)"),
            "Severity": _shown("incident_severity"),
            "Type": _shown("incident_type"),
            "Total claimed": _amount("total_claim_amount"),
            "Vehicle part": _amount("vehicle_claim"),
            "Property part": _amount("property_claim"),
            "Injury part": _amount("injury_claim"),
            "Processing days": _shown("claim_processing_days"),
            "Vehicles involved": _shown("number_of_vehicles_involved"),
            "Witnesses": _shown("witnesses"),
            "Authorities": _shown("authorities_contacted"),
            "Property damage": "coalesce(property_damage, 'Unknown')",
            "Police report": "coalesce(police_report_available, 'Unknown')",
            "Rejected": _shown("claim_rejected"),
            "Claims of this customer": _shown("customer_claim_count"),
            "Region": _shown("customer_region"),
            "Policy limits": _shown("policy_csl"),
            "Score": "printf('%.1f / 100', anomaly_score)",
            "Tier": "priority_tier",
            "Rules triggered": "coalesce(nullif(triggered_rules, ''), 'None')",
            "R1 amount": _three("r1_amount_zscore"),
            "R2 severity": _three("r2_severity_mismatch"),
            "R3 injury ratio": _three("r3_injury_ratio"),
            "R4 staged": _three("r4_staged_accident"),
            "R5 documents": _three("r5_doc_gap"),
            "R6 theft": _three("r6_theft_with_injury"),
            "R7 ghost injury": _three("r7_ghost_injury"),
            "R8 per person": _three("r8_injury_per_person"),
        }
    )
    + ") AS prompt FROM gold_scores WHERE priority_tier <> 'LOW'"
)


def _needed(text: str) -> list[str]:
    """Steps a text uses, each after the steps it uses itself."""
    order: list[str] = []
    for word in dict.fromkeys(re.findall(r"\w+", text)):
        if word in STEPS:
            order.extend(s for s in (*_needed(STEPS[word]), word) if s not in order)
    return order


# The names of the figures in each bundle.
_BUNDLES = {
    "policy_portfolio": {
        "overview": "kpi_policy_overview",
        "top5_states": "kpi_policy_states",
        "csl_distribution": "kpi_policy_csl",
        "premium_buckets": "kpi_premium_buckets",
    },
    "claims_performance": {
        "overview": "kpi_claims_overview",
        "by_severity": "kpi_claims_severity",
        "top5_states": "kpi_claims_states",
        "vehicles_involved_distribution": "kpi_claims_vehicles",
    },
    "customer_profile": {
        "overview": "kpi_customer_overview",
        "top6_jobs": "kpi_customer_jobs",
        "marital_distribution": "kpi_customer_marital",
        "education_distribution": "kpi_customer_education",
        "product_cross_sell": "kpi_customer_cross_sell",
        "region_distribution": "kpi_customer_regions",
    },
    "vehicle_fleet_sales": {
        "car_overview": "kpi_fleet",
        "fuel_distribution": "kpi_fleet_fuel",
        "transmission_distribution": "kpi_fleet_transmission",
        "sales_overview": "kpi_sales_overview",
        "sales_by_region": "kpi_sales_region",
    },
}

CHECKS["kpi_fields"] = " UNION ALL ".join(
    f"""SELECT '{domain}' AS domain, '{figure}' AS figure, field, TRY_CAST(value AS DOUBLE) AS number,
        CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text
        FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({CHECKS[name]}))
              ON COLUMNS(*) INTO NAME field VALUE value)"""
    for domain, figures in _BUNDLES.items()
    for figure, name in figures.items()
)

# The stand-in client answers with the number of characters of its prompt.
CHECKS["dq_explanations"] = f"""
    SELECT q.*, concat(length(p.prompt), ' characters') AS ai_explanation,
           'success' AS generation_status, 'stand-in' AS model_name, '{AS_OF}' AS generated_at,
           'run-1' AS _gold_run_id
    FROM ({CHECKS['dq_issue_seq']}) q JOIN ({CHECKS['dq_prompt']}) p USING (issue_id)"""

CHECKS["claim_briefs"] = f"""
    SELECT claimid, concat(length(prompt), ' characters') AS brief, 'success' AS generation_status
    FROM ({CHECKS['brief_prompt']})"""


def oracle(name: str) -> str:
    text = CHECKS[name]
    steps = ",\n".join(f"{s} AS MATERIALIZED ({STEPS[s]})" for s in _needed(text))
    return f"WITH {steps}\n{text}" if steps else text
