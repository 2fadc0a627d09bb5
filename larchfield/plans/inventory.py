"""Unsold-inventory alert: ageing, regional demand, redistribution, digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.functions.numeric import share_pct
from larchfield.operators.ranking import global_rank_desc
from larchfield.session import materialise

# Ageing tiers by days on market, and the revenue share at risk.
TIERS = (("CRITICAL", 90), ("HIGH", 60), ("WATCH", 30))
AT_RISK_SHARE = 0.15

# Action texts.
NO_DEMAND = "No fast-moving region identified — review pricing"
NO_ACTION = "Review pricing — no fast-moving region found"


def aging_tier(days: Column) -> Column:
    label = F.lit("OK")
    for name, least in reversed(TIERS):
        label = F.when(days >= least, name).otherwise(label)
    return label


def aging_inventory(facts: DataFrame, dim_car: DataFrame) -> DataFrame:
    """One row per unsold listing of a current car, with tier and revenue at risk."""
    cars = dim_car.filter("is_current").select(
        "car_sk", "model", F.col("name").alias("car_name"), "fuel", "transmission"
    )
    return (
        facts.filter("is_unsold = 1")
        .join(cars, "car_sk")
        .select(
            "sales_id",
            "region",
            "state",
            "city",
            "model",
            "car_name",
            "fuel",
            "transmission",
            "days_on_market",
            "original_selling_price",
            "ad_placed_on",
            aging_tier(F.col("days_on_market")).alias("aging_tier"),
            F.round(F.col("original_selling_price") * AT_RISK_SHARE, 0).alias("at_risk_revenue"),
        )
    )


def demand_signal(
    facts: DataFrame, dim_car: DataFrame, days: int = 90, min_n: int = 3
) -> DataFrame:
    """How fast each kind of car sold per region in the last ``days`` of the data.

    The window ends at the latest sale, a scalar subquery. Sales are counted per
    car, region and days-on-market value before they meet the car dimension, so
    neither a hot car nor a hot group is ever gathered: the exact median is taken
    from (value, frequency) pairs.
    """
    sold = facts.filter("is_unsold = 0")
    since = F.date_sub(sold.agg(F.max("sold_on")).scalar(), days)
    per_car = (
        sold.filter(F.col("sold_on") >= since)
        .groupBy("car_sk", "region", "days_on_market")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    cars = dim_car.filter("is_current").select("car_sk", "model", "fuel", "transmission")
    return (
        per_car.join(cars, "car_sk")
        .groupBy("model", "fuel", "transmission", "region")
        .agg(
            F.sum("_n").alias("total_sold"),
            F.round(
                F.try_divide(
                    F.sum(F.col("days_on_market") * F.col("_n")),
                    F.sum(F.when(F.col("days_on_market").isNotNull(), F.col("_n"))),
                ),
                1,
            ).alias("avg_days_to_sell"),
            F.round(F.percentile("days_on_market", 0.5, F.col("_n")), 1).alias(
                "median_days_to_sell"
            ),
        )
        .filter(F.col("total_sold") >= min_n)
    )


def redistribution(aging: DataFrame, demand: DataFrame, fast_days: float = 21) -> DataFrame:
    """Stuck cars with every other region where their kind sells fast, and a risk score.

    One car gives one row per such region, or one row without region.
    """
    kind = ["model", "fuel", "transmission"]
    fast = demand.filter(F.col("median_days_to_sell") <= fast_days).select(
        *(F.col(c).alias(f"_{c}") for c in kind),
        F.col("region").alias("demand_region"),
        F.col("median_days_to_sell").alias("demand_median_days"),
    )
    stuck = aging.filter(F.col("aging_tier") != "OK")
    match = F.col("region") != F.col("demand_region")
    for name in kind:
        match = match & (F.col(name) == F.col(f"_{name}"))
    # The quotient of days keeps the precision of a decimal division.
    score = F.expr(
        "round((days_on_market / 90.0) * 50 + (original_selling_price / 1000000.0) * 30"
        " + if(demand_region is not null, 20, 0), 1)"
    )
    return stuck.join(fast, match, "left").select(
        "sales_id",
        F.col("region").alias("stuck_region"),
        "state",
        "city",
        "car_name",
        "model",
        "fuel",
        "days_on_market",
        "aging_tier",
        "original_selling_price",
        "at_risk_revenue",
        "ad_placed_on",
        "demand_region",
        "demand_median_days",
        score.alias("risk_score"),
    )


def alert_scored(aging: DataFrame, demand: DataFrame, fast_days: float = 21) -> DataFrame:
    """``redistribution`` with SQL ``rank()`` by risk over all rows and an action text.

    Writes the scored rows to the scratch folder, because the rank reads them
    twice: once narrow for the distribution of scores, once to attach ranks.
    """
    scored = materialise(redistribution(aging, demand, fast_days), "alerts")
    action = F.when(
        F.col("demand_region").isNotNull(),
        F.concat(
            F.lit("Consider moving to "),
            "demand_region",
            F.lit(" — sold in "),
            F.col("demand_median_days").cast("string"),
            F.lit(" days there"),
        ),
    ).otherwise(NO_DEMAND)
    ranked = global_rank_desc(scored, "risk_score", 10.0, "priority_rank")
    return ranked.withColumn("recommended_action", action)


def _figures(scored: DataFrame, move: Column) -> DataFrame:
    """Cars, revenue and best move per tier and region; equal revenues of different cars count once.

    Distinct cars and distinct revenues are counted in steps, each of which groups
    by one thing more than the next, so no row is copied for a second DISTINCT:
    moves to listings, listings to revenues, revenues to tiers and regions.
    """
    place = ["aging_tier", "stuck_region"]
    movable = F.col("demand_region").isNotNull()
    # As a rule a listing has one revenue; if not, it is a car at one of them only.
    listings = scored.groupBy(*place, "sales_id").agg(
        F.collect_set(F.struct("at_risk_revenue", movable.alias("movable"))).alias("offers"),
        F.max(movable).alias("car_movable"),
        F.max(move).alias("move"),
    )
    revenues = (
        listings.select(*place, "car_movable", "move", F.posexplode("offers").alias("nth", "offer"))
        .groupBy(*place, F.col("offer.at_risk_revenue").alias("revenue"))
        .agg(
            F.count_if(F.col("nth") == 0).alias("cars"),
            F.count_if((F.col("nth") == 0) & F.col("car_movable")).alias("movable_cars"),
            F.max("offer.movable").alias("recoverable"),
            F.max("move").alias("move"),
        )
    )
    return revenues.groupBy(*place).agg(
        F.sum("cars").alias("cars_at_risk"),
        F.round(F.sum("revenue"), 0).alias("total_at_risk_revenue"),
        F.sum("movable_cars").alias("redistributable_cars"),
        F.round(F.sum(F.when(F.col("recoverable"), F.col("revenue"))), 0).alias("recoverable_revenue"),
        F.max("move").alias("move"),
    )


def alert_summary(scored: DataFrame) -> DataFrame:
    """Cars and revenue by tier and region, most urgent first."""
    urgency = F.array_position(F.array(*(F.lit(name) for name, _ in TIERS)), F.col("aging_tier"))
    return (
        _figures(scored, F.lit(None).cast("string"))
        .drop("move")
        .orderBy(urgency, F.desc("total_at_risk_revenue"), "stuck_region")
    )


def alert_totals(aging: DataFrame) -> DataFrame:
    """Unsold cars in all and per tier, and revenue at risk. Each car counts once."""
    return aging.agg(
        F.count(F.lit(1)).alias("total_unsold"),
        *(
            F.count_if(F.col("aging_tier") == name).alias(f"{name.lower()}_cars")
            for name, _ in TIERS
        ),
        F.round(F.sum("at_risk_revenue"), 0).alias("total_at_risk_revenue"),
    )


def alert_regions(scored: DataFrame, top: int | None = 6) -> DataFrame:
    """Digest lines for the urgent tiers: figures and the best move per region.

    ``recovery_pct`` is each region's recoverable share of its revenue at risk.
    """
    move = F.when(
        F.col("demand_region").isNotNull(),
        F.concat(
            F.lit("Move to "),
            "demand_region",
            F.lit(" (sells in ~"),
            F.col("demand_median_days").cast("int").cast("string"),
            F.lit(" days)"),
        ),
    )
    lines = (
        _figures(scored.filter(F.col("aging_tier").isin("CRITICAL", "HIGH")), move)
        .withColumn("best_action", F.coalesce("move", F.lit(NO_ACTION)))
        .drop("move")
        .withColumn(
            "recovery_pct",
            share_pct(
                F.coalesce(F.col("recoverable_revenue"), F.lit(0.0)),
                F.col("total_at_risk_revenue"),
                1,
            ),
        )
        .orderBy("aging_tier", F.desc("total_at_risk_revenue"), "stuck_region")
    )
    return lines if top is None else lines.limit(top)


def alert_digest(scored: DataFrame, aging: DataFrame) -> DataFrame:
    """Header of the digest: totals, recoverable revenue and its share."""
    recoverable = (
        alert_regions(scored, top=None)
        .agg(F.coalesce(F.sum("recoverable_revenue"), F.lit(0.0)))
        .scalar()
    )
    return alert_totals(aging).withColumn("recoverable_revenue", recoverable).withColumn(
        "recovery_pct",
        F.coalesce(
            share_pct(F.col("recoverable_revenue"), F.col("total_at_risk_revenue"), 1), F.lit(0.0)
        ),
    )


def check_alert(totals: DataFrame) -> DataFrame:
    """Rows that contradict themselves: more cars in tiers than in all."""
    tiers = sum(F.col(f"{name.lower()}_cars") for name, _ in TIERS)
    return totals.filter(tiers > F.col("total_unsold"))
