"""Presentation marts over facts and dimensions.

Facts are reduced to one row per dimension key and grouping value before they
meet the dimension. A policy or car that holds a third of all facts therefore
crosses the shuffle as a handful of partial rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.functions.numeric import money, share_pct


def mart_claim_performance(
    facts: DataFrame, dim_policy: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Claims, mean processing days and rejection rate by region, cover, severity and month."""
    per_key = facts.groupBy(
        "policy_sk",
        "customer_sk",
        "incident_severity",
        F.year("incident_date").alias("incident_year"),
        F.month("incident_date").alias("incident_month"),
    ).agg(
        F.count("claim_id").alias("claims"),
        F.sum("processing_time_days").alias("days"),
        F.count("processing_time_days").alias("timed"),
        F.sum("is_rejected_int").alias("rejected"),
    )
    return (
        per_key.join(dim_policy.select("policy_sk", "policy_csl"), "policy_sk")
        .join(dim_customer.select("customer_sk", "region"), "customer_sk")
        .groupBy("region", "policy_csl", "incident_severity", "incident_year", "incident_month")
        .agg(
            F.sum("claims").alias("total_claims_filed"),
            F.round(F.try_divide(F.sum("days"), F.sum("timed")), 1).alias(
                "avg_processing_time_days"
            ),
            share_pct(F.sum("rejected"), F.sum("claims")).alias("rejection_rate_pct"),
        )
    )


def mart_unsold_inventory(facts: DataFrame, dim_car: DataFrame, min_days: int = 60) -> DataFrame:
    """Listings unsold for more than ``min_days``, by car model."""
    price = money("original_selling_price")
    per_car = (
        facts.filter((F.col("is_unsold") == 1) & (F.col("days_on_market") > min_days))
        .groupBy("car_sk")
        .agg(
            F.count("sales_id").alias("listings"),
            F.sum(price).alias("price"),
            F.count(price).alias("priced"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("days_on_market").alias("days"),
            F.max("days_on_market").alias("longest"),
        )
    )
    return (
        per_car.join(dim_car.select("car_sk", "model"), "car_sk")
        .groupBy("model")
        .agg(
            F.sum("listings").alias("stagnant_vehicle_count"),
            F.round(F.try_divide(F.sum("price"), F.sum("priced")), 2)
            .cast("double")
            .alias("avg_original_selling_price"),
            F.round(F.sum("days") / F.sum("rows"), 1).alias("avg_days_on_market"),
            F.max("longest").alias("max_days_on_market"),
        )
        .orderBy(F.desc("avg_days_on_market"), "model")
    )


def mart_customer_metrics(dim_customer: DataFrame) -> DataFrame:
    """Current customers and those with tertiary education, by region."""
    return (
        dim_customer.filter("is_current")
        .groupBy("region")
        .agg(
            F.count("customer_sk").alias("total_active_customers"),
            F.count_if(F.col("education") == "tertiary").alias("tertiary_edu_count"),
        )
        .orderBy(F.desc("total_active_customers"), "region")
    )
