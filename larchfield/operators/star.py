"""Dimensions, facts and the joins between them.

Facts left join their dimensions on plain equality. No side is force-broadcast:
Catalyst picks the join from table sizes, and AQE splits the partitions of a hot
key. The fact side may be a stream; dimensions are then static.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.operators.history import END, START



def build_dim(history: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Dimension rows from history: surrogate key, validity and current flag."""
    return history.withColumns(
        {
            surrogate: F.md5(F.concat_ws("|", F.col(key), F.col(START).cast("string"))),
            "is_current": F.col(END).isNull(),
        }
    ).withColumnsRenamed({START: "valid_from", END: "valid_to"})


def _slim(dim: DataFrame, key: str, columns: Sequence[str], prefix: str) -> DataFrame:
    """Key, validity and the wanted columns, renamed so that joins cannot clash."""
    return dim.select(
        F.col(key).alias(f"{prefix}_key"),
        F.col("valid_from").alias(f"{prefix}_from"),
        F.col("valid_to").alias(f"{prefix}_to"),
        *(F.col(c).alias(f"{prefix}_{c}") for c in columns),
    )


def valid_at(at: Column, start: str, end: str) -> Column:
    """Whether ``at`` lies in the validity interval, whose end belongs to the next version."""
    return (at >= F.col(start)) & (F.col(end).isNull() | (at < F.col(end)))


def asof_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    at: str,
    columns: Sequence[str],
    prefix: str = "dim",
    how: str = "left",
) -> DataFrame:
    """Join the dimension version valid at ``at``.

    ``on`` is ``(fact column, dimension key)``. Adds ``<prefix>_<column>`` for
    each wanted column.
    """
    slim = _slim(dim, on[1], columns, prefix)
    match = (F.col(on[0]) == F.col(f"{prefix}_key")) & valid_at(
        F.col(at), f"{prefix}_from", f"{prefix}_to"
    )
    return fact.join(slim, match, how).drop(f"{prefix}_key", f"{prefix}_from", f"{prefix}_to")


def _dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    columns: Sequence[str],
    prefix: str,
    asof: str | None,
) -> DataFrame:
    if asof:
        return asof_dim_join(fact, dim, on, asof, columns, prefix)
    slim = _slim(dim, on[1], columns, prefix).drop(f"{prefix}_from", f"{prefix}_to")
    return fact.join(slim, F.col(on[0]) == F.col(f"{prefix}_key"), "left").drop(f"{prefix}_key")


def fact_claims(
    claims: DataFrame, dim_policy: DataFrame, dim_customer: DataFrame, asof: bool = False
) -> DataFrame:
    """Claims with the keys of their policy and, through it, their customer.

    Every version of a dimension row matches, as in the reference data model;
    ``asof`` keeps the version valid at the incident instead. Without it policies
    meet their customers first: claims then cross one shuffle, by policy, and
    those without a policy are not gathered under a customer key they lack.
    """
    if asof:
        at = "incident_date"
        joined = _dim_join(
            claims, dim_policy, ("policyid", "policy_number"), ["policy_sk", "customer_id"], "pol", at
        )
        joined = _dim_join(
            joined, dim_customer, ("pol_customer_id", "customer_id"), ["customer_sk"], "cust", at
        )
    else:
        owners = dim_policy.select(
            F.col("policy_number").alias("pol_key"),
            F.col("policy_sk").alias("pol_policy_sk"),
            F.col("customer_id").alias("pol_customer_id"),
        )
        owners = _dim_join(
            owners, dim_customer, ("pol_customer_id", "customer_id"), ["customer_sk"], "cust", None
        )
        joined = claims.join(owners, F.col("policyid") == F.col("pol_key"), "left")
    rejected = F.coalesce(F.col("claim_rejected").cast("string").try_cast("boolean"), F.lit(False))
    return joined.select(
        F.col("claimid").alias("claim_id"),
        F.col("pol_policy_sk").alias("policy_sk"),
        F.col("cust_customer_sk").alias("customer_sk"),
        "incident_date",
        "incident_state_full",
        "number_of_vehicles_involved",
        "incident_severity",
        "claim_processed_on",
        "claim_logged_on",
        F.datediff("claim_processed_on", "claim_logged_on").alias("processing_time_days"),
        rejected.cast("int").alias("is_rejected_int"),
    )


def fact_car_sales(
    sales: DataFrame, dim_car: DataFrame, as_of: Column | None = None, asof: bool = False
) -> DataFrame:
    """Listings with their car key and days on market up to the sale or ``as_of``."""
    today = F.current_timestamp() if as_of is None else as_of
    joined = _dim_join(
        sales, dim_car, ("car_id", "car_id"), ["car_sk"], "car", "ad_placed_on" if asof else None
    )
    return joined.select(
        "sales_id",
        F.col("car_car_sk").alias("car_sk"),
        "region",
        "state",
        "city",
        "ad_placed_on",
        "sold_on",
        "original_selling_price",
        F.datediff(F.coalesce(F.col("sold_on"), today), "ad_placed_on").alias("days_on_market"),
        F.col("sold_on").isNull().cast("int").alias("is_unsold"),
    )


def enrich(
    df: DataFrame,
    dim: DataFrame | None,
    on: tuple[str, str],
    columns: dict[str, str],
) -> DataFrame:
    """Left join a few columns of a dimension, renamed as ``{source: target}``.

    ``on`` is ``(left column, dimension key)``. Where the dimension or its key is
    missing, the targets are NULL strings, so later steps keep their schema.
    """
    stubs = {
        target: F.lit(None).cast("string")
        for source, target in columns.items()
        if dim is None or on[1] not in dim.columns or source not in dim.columns
    }
    if dim is not None and on[1] in dim.columns and on[0] in df.columns:
        found = [F.col(s).alias(t) for s, t in columns.items() if t not in stubs]
        slim = dim.select(F.col(on[1]).alias("_dim_key"), *found)
        df = df.join(slim, F.col(on[0]) == F.col("_dim_key"), "left").drop("_dim_key")
    else:
        stubs = {t: F.lit(None).cast("string") for t in columns.values()}
    return df.withColumns({t: stub for t, stub in stubs.items() if t not in df.columns})
