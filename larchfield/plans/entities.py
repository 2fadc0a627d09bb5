"""The five source entities: preparation, rules and expectations.

Each ``prepare_*`` takes the all-string bronze frame (or a typed one) and adds no
shuffle, so batch and stream share it. Columns that a source lacks are skipped
when the plan is built, never per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.operators.cleanse import (
    add_audit,
    convert_units,
    drop_blank_rows,
    expand_codes,
    extract_measure,
    flag_corrupt,
    merge_synonyms,
    null_tokens,
    parse_timestamps,
    try_cast_cols,
    unify_cased_columns,
    with_flags,
)
from larchfield.operators.quality import Expectation, Rule

# Region codes.
REGIONS = {"E": "East", "W": "West", "C": "Central", "S": "South", "N": "North"}

# State codes the insurer works in.
STATES = {
    "IL": "Illinois",
    "NC": "North Carolina",
    "OH": "Ohio",
    "PA": "Pennsylvania",
    "SC": "South Carolina",
    "VA": "Virginia",
    "WV": "West Virginia",
    "IN": "Indiana",
    "NY": "New York",
    "CA": "California",
    "TX": "Texas",
    "FL": "Florida",
    "GA": "Georgia",
    "MI": "Michigan",
    "NJ": "New Jersey",
    "AZ": "Arizona",
    "WA": "Washington",
    "MA": "Massachusetts",
    "MN": "Minnesota",
    "MO": "Missouri",
    "TN": "Tennessee",
    "WI": "Wisconsin",
    "CO": "Colorado",
}

# Limits and factors.
MAX_KM = 500_000
KGM_TO_NM = 9.80665

# Customer column names used by different source systems.
CUSTOMER_SYNONYMS = {
    "customer_id": ["customerid", "customer_id", "cust_id"],
    "region_raw": ["region", "reg"],
    "city": ["city_in_state", "city"],
    "education": ["education", "edu"],
    "marital": ["marital_status", "marital"],
}


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def prepare_customers(bronze: DataFrame) -> DataFrame:
    df = merge_synonyms(unify_cased_columns(bronze), CUSTOMER_SYNONYMS)
    df = expand_codes(df, "region_raw", "region", REGIONS).drop("region_raw")
    return add_audit(try_cast_cols(df, ["balance"]), "silver_customers")


def prepare_claims(bronze: DataFrame) -> DataFrame:
    dates = ["incident_date", "claim_logged_on", "claim_processed_on"]
    df = unify_cased_columns(bronze)
    if "incident_state" in df.columns:
        df = expand_codes(df, "incident_state", "incident_state_full", STATES)
        df = df.withColumnRenamed("incident_state", "incident_state_code")
    if dict(df.dtypes).get("claim_processed_on") == "string":
        df = null_tokens(df, {"claim_processed_on": ["NULL"]}, ignore_case=True)
    df = null_tokens(df, {"property_damage": ["?"], "police_report_available": ["?"]})
    # The damage shows only in the text, so it is looked for before parsing.
    df = parse_timestamps(flag_corrupt(df, dates), dates)
    return add_audit(df, "silver_claims")


def prepare_sales(bronze: DataFrame) -> DataFrame:
    df = drop_blank_rows(unify_cased_columns(bronze))
    df = parse_timestamps(df, ["ad_placed_on", "sold_on"])
    unsold = F.col("sold_on").isNull() if "sold_on" in df.columns else F.lit(True)
    df = with_flags(df, {"is_unsold": unsold})
    return add_audit(try_cast_cols(df, ["original_selling_price", "km_driven"]), "silver_sales")


def prepare_cars(bronze: DataFrame) -> DataFrame:
    df = unify_cased_columns(bronze)
    df = extract_measure(df, "mileage", "mileage", unit="mileage_unit")
    df = extract_measure(df, "engine", "engine_cc", as_type="int", pattern=r"(\d+)")
    df = extract_measure(df, "max_power", "max_power_bhp")
    df = convert_units(df, "torque", "torque_nm", "kgm", KGM_TO_NM, raw="torque_raw")
    return add_audit(try_cast_cols(df, ["km_driven"]), "silver_cars")


def prepare_policy(bronze: DataFrame) -> DataFrame:
    df = unify_cased_columns(bronze)
    state = next((c for c in ("policy_state", "state") if c in df.columns), None)
    if state:
        df = expand_codes(df, state, "policy_state_full", STATES)
        df = df.withColumnRenamed(state, "policy_state_code")
    df = try_cast_cols(df, ["policy_annual_premium", "policy_deductable", "umbrella_limit"])
    if "umbrella_limit" in df.columns:
        df = with_flags(df, {"_umbrella_limit_zero_flag": "umbrella_limit = 0"})
    return add_audit(df, "silver_policy")


@dataclass(frozen=True)
class Entity:
    """One source table: how it is prepared and what its rows must satisfy."""

    name: str
    key: str
    prepare: Callable[[DataFrame], DataFrame]
    rules: tuple[Rule, ...]
    expectations: tuple[Expectation, ...] = ()


# Fixed values in the entities below: rule order, reject reasons, descriptions
# and suggested fixes.
CUSTOMERS = Entity(
    name="customers",
    key="customer_id",
    prepare=prepare_customers,
    rules=(
        Rule("is_valid_r1", "customer_id IS NOT NULL", "R1: customer_id is null", ("customer_id",)),
        Rule(
            "is_valid_r2",
            f"region IN ({_sql_list(REGIONS.values())})",
            "R2: invalid region code",
            ("region",),
        ),
    ),
    expectations=(
        Expectation(
            "R3_valid_education",
            "education",
            "education IS NULL OR education IN ('primary', 'secondary', 'tertiary')",
            "Customer education tier is unknown/invalid",
            "Map unknown values to default 'Unknown' in ETL",
        ),
        Expectation(
            "R4_positive_balance",
            "balance",
            "balance IS NULL OR balance >= 0",
            "Customer account balance is negative",
            "Investigate negative transactions in core financial sub-system",
        ),
        Expectation(
            "R5_valid_marital",
            "marital",
            "marital IS NULL OR marital IN ('single', 'married', 'divorced')",
            "Customer marital status is unknown/invalid",
            "Enforce strict dropdown selection in source CRM",
        ),
    ),
)

CLAIMS = Entity(
    name="claims",
    key="claimid",
    prepare=prepare_claims,
    rules=(
        Rule("is_valid_r1", "claimid IS NOT NULL", "R1: ClaimID is null", ("claimid",)),
        Rule("is_valid_r2", "policyid IS NOT NULL", "R2: PolicyID is null", ("policyid",)),
    ),
    expectations=(
        Expectation(
            "R5_valid_incident_severity",
            "incident_severity",
            "incident_severity IS NULL OR "
            "incident_severity IN ('Major Damage', 'Minor Damage', 'Trivial Damage')",
            "Claim severity category is not recognized",
            "Update mapping dictionary if business added new severity tiers",
        ),
        Expectation(
            "R3_valid_dates",
            "multiple_date_columns",
            "NOT _is_corrupt_date",
            "One or more date columns contain Excel serial fragments",
            "Stop regional teams from exporting dates with 'mm:ss.0' formatting",
        ),
    ),
)

SALES = Entity(
    name="sales",
    key="sales_id",
    prepare=prepare_sales,
    rules=(
        Rule("is_valid_pk", "sales_id IS NOT NULL", "PK: sales_id is null", ("sales_id",)),
        Rule("is_valid_r2", "car_id IS NOT NULL", "R2: car_id is null", ("car_id",)),
        Rule(
            "is_valid_r3",
            "original_selling_price > 0",
            "R3: original_selling_price is null or <= 0",
            ("original_selling_price",),
        ),
        Rule(
            "is_valid_r4",
            "sold_on IS NULL OR ad_placed_on IS NULL OR sold_on >= ad_placed_on",
            "R4: sold_on is before ad_placed_on",
            ("sold_on", "ad_placed_on"),
        ),
    ),
    expectations=(
        Expectation(
            "R5_valid_seller",
            "seller_type",
            "seller_type IS NULL OR "
            "lower(seller_type) IN ('individual', 'dealer', 'trustmark dealer')",
            "Seller type is not classified as individual or dealer",
            "Standardize seller inputs to authorized values only",
        ),
    ),
)

CARS = Entity(
    name="cars",
    key="car_id",
    prepare=prepare_cars,
    rules=(
        Rule("is_valid_r1", "car_id IS NOT NULL", "R1: car primary key is null", ("car_id",)),
        Rule(
            "is_valid_r2",
            f"km_driven IS NULL OR km_driven <= {MAX_KM}",
            f"R2: km_driven exceeds {MAX_KM}",
            ("km_driven",),
        ),
    ),
)

POLICY = Entity(
    name="policy",
    key="policy_number",
    prepare=prepare_policy,
    rules=(
        Rule("is_valid_r1", "policy_number IS NOT NULL", "R1: policy_number is null", ("policy_number",)),
        Rule(
            "is_valid_r2",
            "customer_id IS NOT NULL",
            "R2: customer_id is null (orphan policy)",
            ("customer_id",),
        ),
        Rule(
            "is_valid_r3",
            f"policy_state_full IN ({_sql_list(STATES.values())})",
            "R3: unknown state = ",
            ("policy_state_full",),
            shows="policy_state_full",
        ),
    ),
    expectations=(
        Expectation(
            "R4_umbrella_limit_zero_warn",
            "umbrella_limit",
            "_umbrella_limit_zero_flag IS NULL OR NOT _umbrella_limit_zero_flag",
            "Policy umbrella limit is exactly zero (Verify with business if intended)",
            "Confirm with Underwriting if $0 umbrella limits are active products",
        ),
    ),
)

ENTITIES = {e.name: e for e in (CUSTOMERS, CLAIMS, SALES, CARS, POLICY)}
