"""Key figures per business domain.

Dimensions are expected to hold current rows only. Orderings carry the group as
tie-break, so that top-N cuts give the same rows on every run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.functions.numeric import money_avg, money_sum, share_pct


def distribution(
    df: DataFrame, by: list[str | Column], count: str, *figures: Column, top: int | None = None
) -> DataFrame:
    """Rows per group with further figures, largest group first."""
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *figures)
    names = [c for c in grouped.columns[: len(by)]]
    ordered = grouped.orderBy(F.desc(count), *names)
    return ordered if top is None else ordered.limit(top)


def int_avg(column: str, places: int) -> Column:
    return F.round(F.avg(column), places)


def rejection_pct() -> Column:
    return share_pct(F.sum("is_rejected_int"), F.count("is_rejected_int"))


def sold_rate_pct() -> Column:
    return F.round((1 - F.avg("is_unsold")) * 100, 2)


# --- policies ---------------------------------------------------------------


def policy_overview(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_policies"),
        F.countDistinct("customer_id").alias("unique_customers"),
        money_avg("policy_annual_premium").alias("avg_annual_premium"),
        money_sum("policy_annual_premium").alias("total_annual_premium"),
        money_avg("policy_deductable").alias("avg_deductable"),
        money_avg("umbrella_limit").alias("avg_umbrella_limit"),
        F.sum(F.col("_umbrella_limit_zero_flag").cast("int")).alias("zero_umbrella_count"),
    )


def policy_states(dim: DataFrame, top: int = 5) -> DataFrame:
    premium = money_avg("policy_annual_premium").alias("avg_premium")
    return distribution(dim, ["policy_state_full"], "policy_count", premium, top=top)


def policy_csl(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["policy_csl"], "count")


def premium_buckets(dim: DataFrame) -> DataFrame:
    premium = F.col("policy_annual_premium")
    # Bucket limits and labels.
    bucket = (
        F.when(premium < 500, "<$500")
        .when(premium < 1000, "$500-$1k")
        .when(premium < 2000, "$1k-$2k")
        .otherwise(">$2k")
    )
    return (
        dim.groupBy(bucket.alias("premium_bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("premium_bucket")
    )


def policy_kpis(dim: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": policy_overview(dim),
        "top5_states": policy_states(dim),
        "csl_distribution": policy_csl(dim),
        "premium_buckets": premium_buckets(dim),
    }


# --- claims -----------------------------------------------------------------


def claims_overview(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum("is_rejected_int").alias("total_rejected"),
        rejection_pct().alias("rejection_rate_pct"),
        int_avg("processing_time_days", 2).alias("avg_processing_days"),
        F.max("processing_time_days").alias("max_processing_days"),
        F.min("processing_time_days").alias("min_processing_days"),
    )


def claims_by_severity(fact: DataFrame) -> DataFrame:
    return distribution(
        fact,
        ["incident_severity"],
        "claim_count",
        int_avg("processing_time_days", 2).alias("avg_processing_days"),
        F.sum("is_rejected_int").alias("rejected_count"),
        rejection_pct().alias("rejection_rate_pct"),
    )


def claims_states(fact: DataFrame, top: int = 5) -> DataFrame:
    return distribution(
        fact,
        ["incident_state_full"],
        "claim_count",
        int_avg("processing_time_days", 2).alias("avg_processing_days"),
        rejection_pct().alias("rejection_rate_pct"),
        top=top,
    )


def claims_vehicles(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("number_of_vehicles_involved")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("number_of_vehicles_involved")
    )


def claims_kpis(fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": claims_overview(fact),
        "by_severity": claims_by_severity(fact),
        "top5_states": claims_states(fact),
        "vehicles_involved_distribution": claims_vehicles(fact),
    }


# --- customers --------------------------------------------------------------


def customer_overview(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_customers"),
        money_avg("balance").alias("avg_balance"),
        money_sum("balance").alias("total_balance"),
        F.round(F.max("balance"), 2).alias("max_balance"),
        F.round(F.min("balance"), 2).alias("min_balance"),
    )


def customer_jobs(dim: DataFrame, top: int = 6) -> DataFrame:
    return distribution(dim, ["job"], "count", money_avg("balance").alias("avg_balance"), top=top)


def customer_marital(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["marital"], "count", money_avg("balance").alias("avg_balance"))


def customer_education(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["education"], "count")


def customer_cross_sell(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["carloan", "hhinsurance"], "count")


def customer_regions(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["region"], "count", money_avg("balance").alias("avg_balance"))


def customer_dims(dim: DataFrame) -> DataFrame:
    """Marital, education and region distributions in one pass over the dimension.

    Grouping sets count all three at once; education carries no balance.
    """
    grouped = dim.groupingSets(
        [["marital"], ["education"], ["region"]], "marital", "education", "region"
    ).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("count"),
        money_avg("balance").alias("avg_balance"),
    )
    # grouping_id has a bit set for every column that is not in the set.
    marital, education, region = 0b011, 0b101, 0b110
    of_set = F.col("_set")
    return grouped.select(
        F.when(of_set == marital, "marital")
        .when(of_set == education, "education")
        .otherwise("region")
        .alias("dimension"),
        F.when(of_set == marital, F.col("marital"))
        .when(of_set == education, F.col("education"))
        .when(of_set == region, F.col("region"))
        .alias("value"),
        "count",
        F.when(of_set != education, F.col("avg_balance")).alias("avg_balance"),
    ).orderBy("dimension", F.desc("count"), "value")


def customer_kpis(dim: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": customer_overview(dim),
        "top6_jobs": customer_jobs(dim),
        "marital_distribution": customer_marital(dim),
        "education_distribution": customer_education(dim),
        "product_cross_sell": customer_cross_sell(dim),
        "region_distribution": customer_regions(dim),
    }


# --- vehicles and sales -----------------------------------------------------


def fleet_overview(dim: DataFrame) -> DataFrame:
    def mean(column: str, places: int) -> Column:
        present = column in dim.columns
        return money_avg(column, places) if present else F.lit(None).cast("double")

    return dim.agg(
        F.count(F.lit(1)).alias("total_vehicles"),
        mean("km_driven", 0).alias("avg_km_driven"),
        mean("mileage", 2).alias("avg_mileage"),
        mean("engine_cc", 0).alias("avg_engine_cc"),
        mean("max_power_bhp", 2).alias("avg_max_power_bhp"),
    )


def fleet_fuel(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["fuel"], "count")


def fleet_transmission(dim: DataFrame) -> DataFrame:
    return distribution(dim, ["transmission"], "count")


def sales_overview(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.sum("is_unsold").alias("unsold_count"),
        sold_rate_pct().alias("sold_rate_pct"),
        money_avg("original_selling_price").alias("avg_selling_price"),
        money_sum("original_selling_price").alias("total_gmv"),
        int_avg("days_on_market", 1).alias("avg_days_on_market"),
    )


def sales_by_region(fact: DataFrame) -> DataFrame:
    return distribution(
        fact,
        ["region"],
        "listings",
        money_avg("original_selling_price").alias("avg_price"),
        int_avg("days_on_market", 1).alias("avg_days_on_market"),
        sold_rate_pct().alias("sold_rate_pct"),
    )


def vehicle_kpis(dim: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "car_overview": fleet_overview(dim),
        "fuel_distribution": fleet_fuel(dim),
        "transmission_distribution": fleet_transmission(dim),
        "sales_overview": sales_overview(fact),
        "sales_by_region": sales_by_region(fact),
    }


# --- bundles and per-group figures for prompts --------------------------------


# Bundle ids, domains and titles.
DOMAINS = {
    "policy_portfolio": ("INS-001", "Policy Portfolio Health & Geographic Exposure"),
    "claims_performance": (
        "INS-002",
        "Claims Operations: Throughput, Rejection & Risk Hotspots",
    ),
    "customer_profile": ("INS-003", "Customer Demographic & Cross-Sell Opportunity Analysis"),
    "vehicle_fleet_sales": ("INS-004", "Vehicle Fleet Composition & Sales Market Dynamics"),
}


# Lists that keep the order of their group; all others go by size.
IN_GROUP_ORDER = ("premium_buckets", "vehicles_involved_distribution")
SIZE_COLUMNS = ("count", "policy_count", "claim_count", "listings")


def _json_value(name: str, frame: DataFrame) -> Column:
    row = F.struct(*frame.columns)
    if name.endswith("overview"):
        return F.first(row)
    if name in IN_GROUP_ORDER:
        return F.sort_array(F.collect_list(row))
    size = next(c for c in frame.columns if c in SIZE_COLUMNS)
    by_size = F.sort_array(F.collect_list(F.struct((-F.col(size)).alias("k"), row.alias("v"))))
    return F.transform(by_size, lambda item: item["v"])


def as_json(figures: dict[str, DataFrame]) -> DataFrame:
    """One row ``kpi_json``: every frame under its name.

    Overviews are one row and become objects, the others become arrays. Frames
    are aggregates already, one row per category; a scalar subquery brings each
    into the single output row, so nothing is joined or collected.
    """
    spark = next(iter(figures.values())).sparkSession
    parts = [
        frame.agg(_json_value(name, frame).alias("v")).scalar().alias(name)
        for name, frame in figures.items()
    ]
    return spark.range(1).select(F.to_json(F.struct(*parts)).alias("kpi_json"))


def kpi_bundle(domains: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """One row per domain: id, domain, title, figures as JSON, status."""
    rows = []
    for domain, figures in domains.items():
        insight_id, title = DOMAINS[domain]
        rows.append(
            as_json(figures).select(
                F.lit(insight_id).alias("insight_id"),
                F.lit(domain).alias("domain"),
                F.lit(title).alias("summary_title"),
                "kpi_json",
                F.when(F.col("kpi_json").isNotNull(), "SUCCESS").otherwise("ERROR").alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def fuel_risk(cars: DataFrame, claims: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Vehicles, mean use and claims per fuel, over the join of cars and claims.

    A car counts once per claim it has, and once if it has none, as in the plain
    join. Claims are counted per key first, so the join never fans out.
    """
    per_key = claims.groupBy(F.col(on[1]).alias("_claim_key")).agg(
        F.count("claim_id").alias("_claims"), F.count(F.lit(1)).alias("_matches")
    )
    joined = cars.join(per_key, F.col(on[0]) == F.col("_claim_key"), "left").withColumn(
        "_weight", F.coalesce("_matches", F.lit(1))
    )

    def mean(column: str, places: int) -> Column:
        if column not in cars.columns:
            return F.lit(None).cast("double")
        value = F.col(column).try_cast("decimal(18,4)")
        weight = F.when(value.isNotNull(), F.col("_weight"))
        total = F.sum(value * F.col("_weight"))
        return F.round(F.try_divide(total.cast("double"), F.sum(weight)), places)

    return (
        joined.groupBy("fuel")
        .agg(
            F.sum("_weight").alias("total_vehicles"),
            mean("km_driven", 0).alias("avg_km_driven"),
            mean("max_power_bhp", 1).alias("avg_power_bhp"),
            F.coalesce(F.sum("_claims"), F.lit(0)).alias("total_claims"),
        )
        .orderBy(F.desc("total_claims"), "fuel")
    )


def customer_segments(dim: DataFrame, top: int = 6) -> DataFrame:
    """Largest job groups with balance and product penetration."""

    def holders(column: str) -> Column:
        return share_pct(F.count_if(F.col(column) == "yes"), F.count(F.lit(1)), 1)

    return distribution(
        dim.filter(F.col("job").isNotNull()),
        ["job"],
        "customer_count",
        money_avg("balance", 0).alias("avg_balance"),
        holders("carloan").alias("carloan_pct"),
        holders("hhinsurance").alias("hhinsurance_pct"),
        top=top,
    )
