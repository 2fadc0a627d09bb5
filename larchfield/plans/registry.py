"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larchfield.functions.text import is_valid_email
from larchfield.operators import cleanse, completion, history, issues, quality, retrieval, scoring, star
from larchfield.operators.star import asof_dim_join
from larchfield.plans import inventory, kpis, marts
from larchfield.plans.entities import CUSTOMER_SYNONYMS, ENTITIES, KGM_TO_NM, REGIONS, STATES
from larchfield.plans.fixtures import AS_OF, FAST_DAYS, Lake
from larchfield.session import apply_runtime_defaults, materialise, scratch_path
from larchfield.sources.files import any_case, ingest_new_files
from larchfield.sources.tables import overwrite_table, reconcile, table_counts
from larchfield.streaming.facts import publish_dim, stream_facts
from larchfield.streaming.history import scd2_stream
from larchfield.streaming.split import COUNTS, read_batches, split_stream

Query = Callable[[Lake], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def query_named(name: str) -> Callable[[Query], Query]:
    """Register under another name than the function's, which an import may hold."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def runnable(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Lake(apply_runtime_defaults(spark), folder))


def union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- sources and sinks --------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def events_as_text(lake: Lake) -> DataFrame:
    return lake.table("events").select(*(F.col(c).cast("string") for c in EVENT_COLUMNS))


def load_landed(lake: Lake, landing: str, fmt: str) -> DataFrame:
    """All files below ``landing``, loaded as new files of their entity."""
    return ingest_new_files(
        lake.spark,
        landing,
        fmt,
        any_case("part", fmt),
        scratch_path(lake.spark, "bronze"),
        scratch_path(lake.spark, "bronze-checkpoint"),
    )


def bronze_events(lake: Lake) -> DataFrame:
    """Events written as CSV files, then loaded."""
    landing = scratch_path(lake.spark, "landing")
    events_as_text(lake).write.option("header", True).csv(landing)
    return load_landed(lake, landing, "csv")


@query
def ingest_events(lake: Lake) -> DataFrame:
    """Events from three folders whose files differ in header and in the case of names.

    Errors come as rows with one value more than their header names.
    """
    landing = scratch_path(lake.spark, "landing")
    events = events_as_text(lake)
    even = F.col("event_id").cast("long") % 2 == 0
    fine = F.col("event_type") != "error"
    turned = events.where(fine & ~even).select(*reversed(EVENT_COLUMNS))
    wide = F.concat_ws(",", "event_id", "user_id", F.lit("extra"))
    broken = events.where(~fine).select(wide.alias("event_id,user_id"))
    events.where(fine & even).write.option("header", True).csv(f"{landing}/a")
    turned.withColumnRenamed("event_id", "Event_ID").write.option("header", True).csv(f"{landing}/b")
    # With another separator the commas are written as they are.
    broken.write.options(header=True, sep="\t").csv(f"{landing}/c")
    return load_landed(lake, landing, "csv").select(
        *EVENT_COLUMNS,
        F.col("_source_file").rlike(r"^part.*\.csv$").alias("has_source_file"),
        F.col("_load_timestamp").isNotNull().alias("has_load_timestamp"),
        "_rescued_data",
    )


@query
def ingest_json_events(lake: Lake) -> DataFrame:
    """Events from JSON files of two folders that spell a key in different case."""
    landing = scratch_path(lake.spark, "landing")
    events = events_as_text(lake)
    even = F.col("event_id").cast("long") % 2 == 0
    events.where(even).write.json(f"{landing}/a")
    events.where(~even).withColumnRenamed("event_id", "Event_ID").write.json(f"{landing}/b")
    return load_landed(lake, landing, "json").select(*EVENT_COLUMNS, "_rescued_data")


@query
def reconcile_counts(lake: Lake) -> DataFrame:
    found = reconcile(events_as_text(lake), bronze_events(lake), "event_type")
    return found.drop("content_equal")


@query
def reconcile_files(lake: Lake) -> DataFrame:
    """Files against what was loaded from them, where two rows of one file were mixed up on the way.

    The users of event 4 and event 8, which stand in one file, are swapped in the
    loaded table: counts agree, contents do not.
    """
    landing = scratch_path(lake.spark, "landing")
    events = events_as_text(lake).select("event_id", "user_id", "event_type")
    for part in range(4):
        own = events.where(F.pmod(F.col("event_id").cast("long"), F.lit(4)) == part)
        own.coalesce(1).write.option("header", True).csv(f"{landing}/{part}")
    loaded = load_landed(lake, landing, "csv").drop("_rescued_data")
    schema = "event_id string, user_id string, event_type string"
    reader = lake.spark.read.options(header=True, recursiveFileLookup=True, pathGlobFilter="part*.csv")
    raw = reader.schema(schema).csv(landing).select("*", F.col("_metadata.file_name").alias("_source_file"))
    user = {i: loaded.where(F.col("event_id") == i).agg(F.max("user_id")).scalar() for i in ("4", "8")}
    mixed = F.when(F.col("event_id") == "4", user["8"]).when(F.col("event_id") == "8", user["4"])
    found = reconcile(raw, loaded.withColumn("user_id", F.coalesce(mixed, "user_id")))
    return found.drop("_source_file")


@query_named("table_counts")
def table_counts_report(lake: Lake) -> DataFrame:
    return table_counts({name: lake.clean(name) for name in ENTITIES})


# --- cleansing ------------------------------------------------------------------


@query
def unify_cased_columns(lake: Lake) -> DataFrame:
    twins = lake.table("orders").select(
        F.col("o_orderkey").alias("OrderKey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("Priority"),
        F.col("o_orderstatus").alias("STATUS"),
    )
    # Names equal up to case can only be made by position.
    doubled = twins.select("OrderKey", "Priority", "STATUS", F.lit("none").alias("other"))
    return cleanse.unify_cased_columns(doubled.toDF("OrderKey", "Priority", "STATUS", "PRIORITY"))


@query
def merge_synonyms(lake: Lake) -> DataFrame:
    raw = lake.view("fx_customers_raw")
    old = F.col("job") == "BUILDING"
    messy = raw.select(
        F.when(old, F.col("customer_id")).alias("customerid"),
        F.when(~old, F.col("customer_id")).alias("cust_id"),
        F.col("region").alias("reg"),
        F.when(old, F.col("education")).alias("education"),
        F.col("education").alias("edu"),
        F.col("marital").alias("marital_status"),
        "balance",
    )
    return cleanse.merge_synonyms(messy, CUSTOMER_SYNONYMS)


@query
def expand_codes(lake: Lake) -> DataFrame:
    claims = cleanse.expand_codes(lake.view("fx_claims"), "incident_state", "state_name", STATES)
    return claims.select("claimid", "incident_state", "state_name")


@query
def expand_region_codes(lake: Lake) -> DataFrame:
    """The same with the code list as a table."""
    codes = lake.spark.createDataFrame(list(REGIONS.items()), "code string, name string")
    raw = lake.view("fx_customers_raw").select("customer_id", "region", "balance")
    return cleanse.expand_codes(raw, "region", "region_name", codes)


@query
def null_tokens(lake: Lake) -> DataFrame:
    dates = cleanse.null_tokens(lake.view("fx_dates_raw"), {"d": ["NULL"]}, ignore_case=True)
    return cleanse.null_tokens(dates, {"flag": ["?"]})


@query
def parse_timestamps(lake: Lake) -> DataFrame:
    raw = lake.view("fx_dates_raw").select("event_id", "d")
    return cleanse.parse_timestamps(raw, ["d"], as_type="timestamp_ntz")


@query
def flag_corrupt(lake: Lake) -> DataFrame:
    return cleanse.flag_corrupt(lake.view("fx_dates_raw").select("event_id", "d"), ["d"])


@query
def drop_blank_rows(lake: Lake) -> DataFrame:
    raw = lake.table("events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("  ").alias("kind"),
        F.lit("feed").alias("_source_file"),
    )
    return cleanse.drop_blank_rows(raw)


@query
def extract_measure(lake: Lake) -> DataFrame:
    cars = lake.view("fx_cars").select("car_id", "mileage", "engine", "max_power")
    cars = cleanse.extract_measure(cars, "mileage", "mileage", unit="mileage_unit")
    cars = cleanse.extract_measure(cars, "engine", "engine_cc", as_type="int", pattern=r"(\d+)")
    return cleanse.extract_measure(cars, "max_power", "max_power_bhp")


@query
def convert_units(lake: Lake) -> DataFrame:
    cars = lake.view("fx_cars").select("car_id", "torque")
    return cleanse.convert_units(cars, "torque", "torque_nm", "kgm", KGM_TO_NM, raw="torque_raw")


@query
def try_cast_cols(lake: Lake) -> DataFrame:
    raw = lake.table("part").select("p_partkey", F.col("p_type").alias("as_text"), "p_brand")
    numbered = raw.withColumn("as_number", F.regexp_extract("p_brand", r"(\d+)", 1)).drop("p_brand")
    return cleanse.try_cast_cols(numbered, ["as_text", "as_number"])


@query
def with_flags(lake: Lake) -> DataFrame:
    policy = lake.view("fx_policy").select("policy_number", "umbrella_limit", "policy_state")
    return cleanse.with_flags(
        policy,
        {
            "umbrella_zero": "umbrella_limit = 0",
            "is_orphan": F.col("policy_number").isNull(),
        },
    )


@query
def valid_email(lake: Lake) -> DataFrame:
    address = F.concat(
        F.lower(F.regexp_replace("c_name", "#", ".")),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.lit("@")),
        F.lower("c_mktsegment"),
        F.when(F.col("c_acctbal") > 9000, F.lit(".c")).otherwise(F.lit(".com")),
    )
    mail = F.when(F.col("c_mktsegment") != "MACHINERY", address)
    return (
        lake.table("customer")
        .select("c_custkey", mail.alias("email"))
        .withColumn("is_valid", is_valid_email("email"))
    )


# --- quality --------------------------------------------------------------------


@query
def dq_rules(lake: Lake) -> DataFrame:
    spec = ENTITIES["sales"]
    flagged = quality.evaluate_rules(spec.prepare(lake.source("sales")), spec.rules)
    return flagged.select("sales_id", *(r.name for r in spec.rules))


@query
def quarantine_customers(lake: Lake) -> DataFrame:
    return lake.rejected("customers").select("customer_id", "region", "balance", "_reject_reason")


@query
def quarantine_sales(lake: Lake) -> DataFrame:
    return lake.rejected("sales").select("sales_id", "car_id", "_reject_reason")


@query
def quarantine_cars(lake: Lake) -> DataFrame:
    return lake.rejected("cars").select("car_id", "km_driven", "_reject_reason")


@query
def quarantine_policy(lake: Lake) -> DataFrame:
    return lake.rejected("policy").select(
        "policy_number", "customer_id", "policy_state_full", "_reject_reason"
    )


@query
def quarantine_claims(lake: Lake) -> DataFrame:
    return lake.rejected("claims").select("claimid", "policyid", "_reject_reason")


@query
def clean_customers(lake: Lake) -> DataFrame:
    return lake.clean("customers").select(
        "customer_id", "region", "education", "marital", "job", "balance"
    )


WARNED = ("customers", "claims", "sales", "policy")


@query
def expectations(lake: Lake) -> DataFrame:
    return union(
        quality.expect_all(lake.clean(name), ENTITIES[name].expectations).select(
            F.lit(name).alias("table_name"), "rule_name", "failed_records", "total_records"
        )
        for name in WARNED
    )


@query
def dq_quarantine_stats(lake: Lake) -> DataFrame:
    return union(issues.entity_issues(lake.tagged(name), name) for name in ENTITIES)


@query
def dq_warning_stats(lake: Lake) -> DataFrame:
    return union(
        issues.warning_stats(lake.clean(name), name, ENTITIES[name].expectations)
        for name in WARNED
    )


@query
def dq_issue_log(lake: Lake) -> DataFrame:
    return issues.dq_issue_log(
        [
            issues.missing_file_issue(lake.spark, "sales", "sales_3.csv"),
            *(
                issues.entity_issues(lake.tagged(name), name, spec.expectations)
                for name, spec in ENTITIES.items()
            ),
        ]
    )


@query
def dq_issue_seq(lake: Lake) -> DataFrame:
    return issues.sequence_issues(dq_issue_log(lake))


@query
def dash_compliance_log(lake: Lake) -> DataFrame:
    return issues.dq_report(dq_issue_log(lake))


@query
def dash_severity_entity(lake: Lake) -> DataFrame:
    return issues.dq_by_severity(dq_issue_log(lake))


@query
def dash_kpis(lake: Lake) -> DataFrame:
    return issues.dq_kpis(dq_issue_log(lake))


# --- history, dimensions, facts ---------------------------------------------------

VERSION_COLUMNS = ["user_id", "event_id", "event_type", "value", history.START, history.END]


@query
def scd2_events(lake: Lake) -> DataFrame:
    events = lake.table("events")
    return history.scd2(events, ["user_id"], "ts", [F.desc("event_id")]).select(*VERSION_COLUMNS)


@query_named("scd2_stream")
def scd2_stream_events(lake: Lake) -> DataFrame:
    """The same from three deliveries, each of which brings late versions of the others' keys."""
    events = lake.table("events")
    landing, target, checkpoint = (
        scratch_path(lake.spark, name) for name in ("landing", "versions", "versions-checkpoint")
    )
    reader = lake.spark.readStream.schema(events.schema).option("recursiveFileLookup", True)
    for delivery in range(3):
        part = events.where(F.pmod("event_id", F.lit(3)) == delivery)
        part.write.parquet(f"{landing}/{delivery}")
        found = scd2_stream(
            reader.parquet(landing), target, ["user_id"], "ts", checkpoint, [F.desc("event_id")], 32
        )
    return found.select(*VERSION_COLUMNS)


@query
def scd2_claims(lake: Lake) -> DataFrame:
    """Claims of all deliveries; what came again is a version, not another claim."""
    found = history.scd2(lake.deliveries("claims"), ["claimid"], "seq")
    return found.select("claimid", "incident_severity", "incident_state_full", history.START, history.END)


@query
def scd2_sales(lake: Lake) -> DataFrame:
    """Listings and their sale; a delivery repeated with the same sequence counts once."""
    order = [F.col("sold_on").asc_nulls_last()]
    found = history.scd2(lake.deliveries("sales"), ["sales_id"], "seq", order)
    return found.select("sales_id", "sold_on", history.START, history.END)


@query
def history_rejects(lake: Lake) -> DataFrame:
    """Clean rows that no history can hold, for want of a sequence, with the versions and the total."""

    def balance(entity: str, key: str) -> DataFrame:
        rows = lake.deliveries(entity)
        versions = history.scd2(rows, [key], "seq", [F.col(key)]).agg(F.count("*").alias("versions"))
        rejected = history.without_sequence(rows, "seq").groupBy("_reject_reason")
        repeated = rows.where("seq IS NOT NULL").groupBy(key, "seq").count().agg(F.sum(F.col("count") - 1))
        return rejected.agg(F.count("*").alias("rejected")).select(
            F.lit(entity).alias("table_name"),
            "_reject_reason",
            "rejected",
            versions.scalar().alias("versions"),
            F.coalesce(repeated.scalar(), F.lit(0)).alias("repeated"),
            rows.agg(F.count("*")).scalar().alias("total"),
        )

    return union([balance("policy", "policy_number"), balance("claims", "claimid")])


def in_deliveries(lake: Lake, rows: DataFrame, load) -> None:
    """Land ``rows`` in two deliveries, odd and even cars, and call ``load(stream, delivery)`` after each."""
    landing = scratch_path(lake.spark, "landing")
    reader = lake.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True)
    # The rows are worked out once; each delivery is a copy of its part.
    rows = materialise(rows, "deliveries")
    for delivery in range(2):
        part = rows.where(F.pmod(F.col("car_id").cast("long"), F.lit(2)) == 1 - delivery)
        part.write.parquet(f"{landing}/{delivery}")
        found = scd2_stream(
            reader.parquet(landing), target, ["user_id"], "ts", checkpoint, [F.desc("event_id")], 32
        )
    return found.select(*VERSION_COLUMNS)


@query
def scd2_claims(lake: Lake) -> DataFrame:
    """Claims of all deliveries; what came again is a version, not another claim."""
    found = history.scd2(lake.deliveries("claims"), ["claimid"], "seq")
    return found.select("claimid", "incident_severity", "incident_state_full", history.START, history.END)


@query
def scd2_sales(lake: Lake) -> DataFrame:
    """Listings and their sale; a delivery repeated with the same sequence counts once."""
    order = [F.col("sold_on").asc_nulls_last()]
    # Three kinds of delivery read the listings, and the history reads the deliveries twice.
    lake.keep_view("fx_sales")
    found = history.scd2(lake.deliveries("sales"), ["sales_id"], "seq", order)
    return found.select("sales_id", "sold_on", history.START, history.END)


@query
def history_rejects(lake: Lake) -> DataFrame:
    """Clean rows that no history can hold, for want of a sequence, with the versions and the total."""

    def balance(entity: str, key: str) -> DataFrame:
        rows = lake.deliveries(entity)
        versions = history.scd2(rows, [key], "seq", [F.col(key)]).agg(F.count("*").alias("versions"))
        rejected = history.without_sequence(rows, "seq").groupBy("_reject_reason")
        repeated = rows.where("seq IS NOT NULL").groupBy(key, "seq").count().agg(F.sum(F.col("count") - 1))
        return rejected.agg(F.count("*").alias("rejected")).select(
            F.lit(entity).alias("table_name"),
            "_reject_reason",
            "rejected",
            versions.scalar().alias("versions"),
            F.coalesce(repeated.scalar(), F.lit(0)).alias("repeated"),
            rows.agg(F.count("*")).scalar().alias("total"),
        )

    return union([balance("policy", "policy_number"), balance("claims", "claimid")])


def in_deliveries(lake: Lake, rows: DataFrame, load) -> None:
    """Land ``rows`` in two deliveries, odd and even cars, and call ``load(stream, delivery)`` after each."""
    landing = scratch_path(lake.spark, "landing")
    reader = lake.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True)
    # The rows are worked out once; each delivery is a copy of its part.
    delivery_of = 1 - F.pmod(F.col("car_id").cast("long"), F.lit(2))
    whole = scratch_path(lake.spark, "deliveries")
    rows.withColumn("_delivery", delivery_of).write.partitionBy("_delivery").parquet(whole)
    for delivery in range(2):
        part = lake.spark.read.schema(rows.schema).parquet(f"{whole}/_delivery={delivery}")
        part.write.parquet(f"{landing}/{delivery}")
        load(reader.parquet(landing), delivery)


def split_text_claims(lake: Lake) -> dict[str, str]:
    """Text claims of two deliveries split by a stream; the folders of its tables."""
    paths = {name: scratch_path(lake.spark, f"stream-{name}") for name in ("clean", "quarantine", "counts")}
    checkpoint = scratch_path(lake.spark, "split-checkpoint")

    def load(stream: DataFrame, delivery: int) -> None:
        split_stream(
            stream, ENTITIES["claims"], paths["clean"], paths["quarantine"], checkpoint, paths["counts"]
        ).awaitTermination()

    in_deliveries(lake, lake.view("fx_claims_text"), load)
    return paths


@query
def stream_quarantine(lake: Lake) -> DataFrame:
    """Claims in text, as streams bring them, parsed and split; both branches."""
    paths = split_text_claims(lake)
    dates = ["incident_date", "claim_logged_on", "claim_processed_on"]

    def shown(path: str, reason) -> DataFrame:
        found = read_batches(lake.spark, path)
        return found.select(
            "claimid", "policyid", "incident_state_full", "property_damage", "_is_corrupt_date", "_stage",
            *(F.col(c).cast("string").alias(c) for c in dates),
            reason.alias("_reject_reason"),
        )

    return shown(paths["clean"], F.lit(None).cast("string")).unionByName(
        shown(paths["quarantine"], F.col("_reject_reason"))
    )


@query
def stream_expectations(lake: Lake) -> DataFrame:
    """Expectation counts that the stream took while it wrote, per batch and rule."""
    found = read_batches(lake.spark, split_text_claims(lake)["counts"], f"{COUNTS}, batch_id int", ids=True)
    return found.select("batch_id", "rule_name", "failed_records", "total_records")


def streamed_facts(lake: Lake, rows: DataFrame, first: dict, second: dict, build) -> DataFrame:
    """Facts of two deliveries; dimensions are published anew in between."""
    dims = {name: scratch_path(lake.spark, f"dim-{name}") for name in first}
    target, checkpoint = (scratch_path(lake.spark, n) for n in ("stream-facts", "facts-checkpoint"))

    def load(stream: DataFrame, delivery: int) -> None:
        for name, frame in (first, second)[delivery].items():
            publish_dim(frame, dims[name], delivery)
        stream_facts(stream, dims, build, target, checkpoint).awaitTermination()

    in_deliveries(lake, rows, load)
    return read_batches(lake.spark, target)


@query
def stream_fact_claims(lake: Lake) -> DataFrame:
    """The first delivery meets customers without their later versions."""
    lake.keep("dim_customer")
    early = lake.dim_customer.where("valid_from < TIMESTAMP '1998-01-01 00:00:00'")
    return streamed_facts(
        lake,
        lake.clean("claims"),
        {"policy": lake.dim_policy, "customer": early},
        {"customer": lake.dim_customer},
        lambda batch, dims: star.fact_claims(batch, dims["policy"], dims["customer"]),
    )


@query
def stream_fact_sales(lake: Lake) -> DataFrame:
    """The first delivery comes before a third of the cars are known."""
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return streamed_facts(
        lake,
        lake.clean("sales"),
        {"car": lake.dim_car.where("car_id % 3 <> 0")},
        {"car": lake.dim_car},
        lambda batch, dims: star.fact_car_sales(batch, dims["car"], as_of),
    )


@query
def scd2_current(lake: Lake) -> DataFrame:
    return history.current_rows(scd2_events(lake))


@query
def dim_customer(lake: Lake) -> DataFrame:
    return lake.dim_customer.select(
        "customer_sk", "customer_id", "region", "education", "marital", "job", "balance",
        "valid_from", "valid_to", "is_current",
    )


@query
def dim_policy(lake: Lake) -> DataFrame:
    return lake.dim_policy.select(
        "policy_sk", "policy_number", "customer_id", "policy_state_code", "policy_state_full",
        "policy_csl", "policy_annual_premium", "valid_from", "valid_to", "is_current",
    )


@query
def dim_car(lake: Lake) -> DataFrame:
    return lake.dim_car.select(
        "car_sk", "car_id", "name", "model", "fuel", "transmission", "km_driven", "mileage",
        "mileage_unit", "engine_cc", "max_power_bhp", "torque_raw", "torque_nm",
        "valid_from", "valid_to", "is_current",
    )


@query
def fact_claims(lake: Lake) -> DataFrame:
    return lake.fact_claims


@query
def fact_car_sales(lake: Lake) -> DataFrame:
    return lake.fact_sales


@query_named("asof_dim_join")
def asof_join(lake: Lake) -> DataFrame:
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return asof_dim_join(
        orders,
        lake.dim_customer,
        ("o_custkey", "customer_id"),
        "o_orderdate",
        ["customer_sk", "balance"],
        "customer",
    )


# --- marts and key figures ----------------------------------------------------------


@query
def mart_claim_performance(lake: Lake) -> DataFrame:
    return marts.mart_claim_performance(lake.fact_claims, lake.dim_policy, lake.dim_customer)


@query
def mart_unsold_inventory(lake: Lake) -> DataFrame:
    return marts.mart_unsold_inventory(lake.fact_sales, lake.dim_car)


@query
def mart_customer_metrics(lake: Lake) -> DataFrame:
    return marts.mart_customer_metrics(lake.dim_customer)


for _name, _figure in {
    "kpi_policy_overview": kpis.policy_overview,
    "kpi_policy_states": kpis.policy_states,
    "kpi_policy_csl": kpis.policy_csl,
    "kpi_premium_buckets": kpis.premium_buckets,
}.items():
    query_named(_name)(lambda lake, figure=_figure: figure(lake.current("dim_policy")))

for _name, _figure in {
    "kpi_claims_overview": kpis.claims_overview,
    "kpi_claims_severity": kpis.claims_by_severity,
    "kpi_claims_states": kpis.claims_states,
    "kpi_claims_vehicles": kpis.claims_vehicles,
}.items():
    query_named(_name)(lambda lake, figure=_figure: figure(lake.fact_claims))

for _name, _figure in {
    "kpi_customer_overview": kpis.customer_overview,
    "kpi_customer_jobs": kpis.customer_jobs,
    "kpi_customer_marital": kpis.customer_marital,
    "kpi_customer_education": kpis.customer_education,
    "kpi_customer_regions": kpis.customer_regions,
    "kpi_customer_cross_sell": kpis.customer_cross_sell,
    "kpi_customer_dims": kpis.customer_dims,
    "customer_segments": kpis.customer_segments,
}.items():
    query_named(_name)(lambda lake, figure=_figure: figure(lake.current("dim_customer")))

for _name, _figure in {
    "kpi_fleet": kpis.fleet_overview,
    "kpi_fleet_fuel": kpis.fleet_fuel,
    "kpi_fleet_transmission": kpis.fleet_transmission,
}.items():
    query_named(_name)(lambda lake, figure=_figure: figure(lake.current("dim_car")))

for _name, _figure in {
    "kpi_sales_overview": kpis.sales_overview,
    "kpi_sales_region": kpis.sales_by_region,
}.items():
    query_named(_name)(lambda lake, figure=_figure: figure(lake.fact_sales))


@query
def kpi_bundle(lake: Lake) -> DataFrame:
    lake.keep("dim_policy", "dim_customer", "dim_car", "fact_claims", "fact_sales")
    return kpis.kpi_bundle(
        {
            "policy_portfolio": kpis.policy_kpis(lake.current("dim_policy")),
            "claims_performance": kpis.claims_kpis(lake.fact_claims),
            "customer_profile": kpis.customer_kpis(lake.current("dim_customer")),
            "vehicle_fleet_sales": kpis.vehicle_kpis(lake.current("dim_car"), lake.fact_sales),
        }
    )


@query
def kpi_fields(lake: Lake) -> DataFrame:
    """Every figure of the bundle, read back from its JSON."""
    figures = F.from_json("kpi_json", "map<string,string>")
    one = F.when(F.col("rows").startswith("{"), F.concat(F.lit("["), "rows", F.lit("]"))).otherwise(F.col("rows"))
    found = (
        kpi_bundle(lake)
        .select("domain", F.explode(figures).alias("figure", "rows"))
        .select("domain", "figure", F.explode(F.from_json(one, "array<map<string,string>>")).alias("row"))
        .select("domain", "figure", F.explode("row").alias("field", "value"))
    )
    number = F.col("value").try_cast("double")
    text = F.when(number.isNull(), F.col("value"))
    return found.select("domain", "figure", "field", number.alias("number"), text.alias("text"))


@query
def fuel_risk(lake: Lake) -> DataFrame:
    claims = lake.clean("claims").select("car_id", F.col("claimid").alias("claim_id"))
    return kpis.fuel_risk(lake.current("dim_car"), claims, ("car_id", "car_id"))


# --- inventory alert ------------------------------------------------------------------


@query
def aging_inventory(lake: Lake) -> DataFrame:
    return lake.aging


@query
def demand_signal(lake: Lake) -> DataFrame:
    return lake.demand


@query
def alert_scored(lake: Lake) -> DataFrame:
    lake.keep("dim_car", "fact_sales")
    return inventory.alert_scored(lake.aging, lake.demand, FAST_DAYS)


@query
def alert_summary(lake: Lake) -> DataFrame:
    return inventory.alert_summary(lake.keep("dim_car", "fact_sales").moves)


@query
def alert_totals(lake: Lake) -> DataFrame:
    return inventory.alert_totals(lake.aging)


@query
def alert_regions(lake: Lake) -> DataFrame:
    return inventory.alert_regions(lake.keep("dim_car", "fact_sales").moves)


@query
def alert_digest(lake: Lake) -> DataFrame:
    lake.keep("dim_car", "fact_sales", "aging")
    return inventory.alert_digest(lake.moves, lake.aging)


@query
def alert_check(lake: Lake) -> DataFrame:
    """Totals that contradict themselves: those counted per car hold, those per offer do not."""
    lake.keep("dim_car", "fact_sales", "aging")
    cars = inventory.alert_totals(lake.aging)
    unsold = lake.aging.agg(F.count("*")).scalar()
    offers = inventory.alert_totals(lake.moves).withColumn("total_unsold", unsold)
    return inventory.check_alert(
        union(frame.withColumn("counted", F.lit(name)) for name, frame in (("cars", cars), ("offers", offers)))
    )


# --- claim scores -----------------------------------------------------------------------


def claim_rules(lake: Lake) -> DataFrame:
    claims = scoring.derive_amounts(lake.clean("claims"))
    return scoring.score_rules(claims, scoring.fit_stats(claims))


@query
def claims_enriched(lake: Lake) -> DataFrame:
    return scoring.enrich_claims(lake.clean("claims"), lake.dim_policy, lake.dim_customer).select(
        "claimid", "policyid", "customer_id", "customer_region", "policy_csl",
        "total_claim_amount", "injury_claim", "vehicle_claim", "property_claim",
        "claim_processing_days", "customer_claim_count",
    )


@query
def claim_stats(lake: Lake) -> DataFrame:
    stats = scoring.population_stats(scoring.derive_amounts(lake.clean("claims")))
    return rounded(stats, 4, *(c for c in stats.columns if c.endswith(("_mean", "_std"))))


for _position, _rule in enumerate(scoring.RULES, 1):
    query_named(f"rule_r{_position}")(
        lambda lake, rule=_rule: rounded(claim_rules(lake).select("claimid", rule), 6, rule)
    )


@query
def critic_weights(lake: Lake) -> DataFrame:
    return rounded(scoring.critic_weights(claim_rules(lake)), 6, "critic_weight")


@query
def rule_correlations(lake: Lake) -> DataFrame:
    return rounded(scoring.rule_correlations(claim_rules(lake)), 6, "r")


@query
def anomaly_critic(lake: Lake) -> DataFrame:
    return lake.scored.select("claimid", "anomaly_score", "priority_tier")


@query
def anomaly_business(lake: Lake) -> DataFrame:
    return scoring.weighted_score(
        claim_rules(lake),
        scoring.BUSINESS_WEIGHTS,
        score="anomaly_score_bw",
        tier="priority_tier_bw",
    ).select("claimid", "anomaly_score_bw", "priority_tier_bw")


@query
def triggered_rules(lake: Lake) -> DataFrame:
    return scoring.triggered_rules(claim_rules(lake)).select("claimid", "triggered_rules")


@query
def score_histogram(lake: Lake) -> DataFrame:
    return scoring.score_histogram(lake.scored)


@query
def method_agreement(lake: Lake) -> DataFrame:
    return scoring.method_agreement(lake.scored)


def scored_table(lake: Lake) -> DataFrame:
    """Enriched scores, written like any gold table before reports read them.

    Scores are worked out behind the joins, whose shuffle then carries plain claims,
    a quarter of the policies at a time. The table has the columns of the scores
    table and the rules that briefs show besides.
    """
    lake.keep("clean_claims", "dim_policy")
    enriched = scoring.enrich_claims(lake.clean_claims, lake.dim_policy, lake.dim_customer)
    scored = scoring.score_claims(enriched, population=lake.clean_claims)
    scored = scored.select(*dict.fromkeys((*scoring.SCORE_COLUMNS, *scoring.RULES)))
    return overwrite_table(scored, scratch_path(lake.spark, "scored-claims"), "policyid", 4)


@query
def flagged_claims(lake: Lake) -> DataFrame:
    scores = scoring.score_output(scored_table(lake), "run-1")
    briefs = scores.select("claimid").distinct().withColumn(
        "ai_investigation_brief", F.concat(F.lit("Brief on "), "claimid")
    )
    flagged = scoring.flagged_claims(scores, briefs).drop("_gold_load_ts")
    return rounded(
        flagged, 6, "r1_amount_zscore", "r2_severity_mismatch", "r3_injury_ratio"
    ).withColumns({"incident_date": F.col("incident_date").cast("string")})


@query
def tier_summary(lake: Lake) -> DataFrame:
    return scoring.tier_summary(lake.scored)


@query
def top_claims(lake: Lake) -> DataFrame:
    return scoring.top_claims(lake.scored)


# --- text and retrieval -------------------------------------------------------------------


def documents_of_policies(lake: Lake) -> DataFrame:
    return retrieval.policy_document(lake.current("dim_policy")).select(
        "policy_number", "nl_document"
    )


@query
def policy_documents(lake: Lake) -> DataFrame:
    return documents_of_policies(lake)


@query
def token_stats(lake: Lake) -> DataFrame:
    return retrieval.token_stats(lake.table("documents"))


# Chunk size and overlap of the two approaches.
LARGE, SMALL = (250, 0), (64, 32)


def _corpus(lake: Lake, sizes: tuple[int, int]) -> DataFrame:
    return retrieval.build_corpus(lake.table("documents").select("doc_id", "text"), "text", *sizes)


@query
def chunks_large(lake: Lake) -> DataFrame:
    return _corpus(lake, LARGE)


@query
def chunks_small(lake: Lake) -> DataFrame:
    return _corpus(lake, SMALL)


@query
def corpus_stats(lake: Lake) -> DataFrame:
    return union(retrieval.corpus_stats(_corpus(lake, sizes)) for sizes in (LARGE, SMALL))


def label_centres(lake: Lake) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    return (
        lake.table("embeddings")
        .select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("cells"))
        .select("query_id", F.transform("cells", lambda cell: cell["x"]).alias("embedding"))
    )


def nearest(lake: Lake, k: int = 5) -> DataFrame:
    corpus = lake.table("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return retrieval.topk_cosine(materialise(label_centres(lake), "label-centres"), corpus, k)


@query
def topk_cosine(lake: Lake) -> DataFrame:
    return rounded(nearest(lake), 6, "score")


@query
def retrieval_confidence(lake: Lake) -> DataFrame:
    return retrieval.confidence(nearest(lake))


@query
def retrieval_sources(lake: Lake) -> DataFrame:
    labels = lake.table("embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    listed = retrieval.sources(nearest(lake).join(labels, "doc_id"), "label")
    return listed.withColumn("source_policies", F.array_join("source_policies", ","))


# Searches for what the fixture's policies hold: its states, limits, deductibles and umbrellas.
QUESTIONS = (
    "policies of Texas with a deductible of 500",
    "Which contracts in Virginia hold the limits 250/500?",
    "annual premium of Ohio policies that have no umbrella",
    "umbrella of 6,000,000 together with limits 100/300 in Illinois",
    "deductible 2000, limits 500/1000, North Carolina",
)


def retrieved(lake: Lake, sizes: tuple[int, int]) -> DataFrame:
    """The five best policy chunks for every question."""

    def chunks(documents: DataFrame) -> DataFrame:
        corpus = retrieval.build_corpus(documents, "nl_document", *sizes)
        return corpus.withColumn("doc_id", F.concat_ws("#", "policy_number", "chunk_index"))

    documents = documents_of_policies(lake)
    asked = lake.spark.createDataFrame(
        list(enumerate(QUESTIONS, 1)), "query_id int, question string"
    )
    corpus = retrieval.embed(chunks(documents), "chunk_text")
    # Vectors are read once, by the search, and not written.
    found = materialise(retrieval.topk_cosine(retrieval.embed(asked, "question"), corpus), "policy-ranks")
    # Texts are cut once more, of those documents only that have a chunk among the hits.
    owners = found.select(F.substring_index("doc_id", "#", 1).alias("_owner")).distinct()
    hit = documents.join(owners, F.col("policy_number").cast("string") == F.col("_owner"), "left_semi")
    texts = chunks(hit).select("doc_id", "policy_number", "chunk_text")
    # A few rows that prompts, confidence and sources each read; the search runs once for all.
    return materialise(found.join(texts, "doc_id").join(asked, "query_id"), "policy-hits")


@query
def rag_prompt(lake: Lake) -> DataFrame:
    return retrieval.rag_prompt(
        retrieved(lake, SMALL), "policy_number", "chunk_text", "question"
    )


@query
def embed_chunks(lake: Lake) -> DataFrame:
    corpus = retrieval.build_corpus(documents_of_policies(lake), "nl_document", *SMALL)
    return retrieval.embed(corpus, "chunk_text")


@query
def rag_answers(lake: Lake) -> DataFrame:
    """Prompts answered by a stand-in client, as history rows of both approaches."""
    histories = []
    lake.keep("dim_policy")
    for size, overlap in (LARGE, SMALL):
        hits = retrieved(lake, (size, overlap))
        prompts = retrieval.rag_prompt(hits, "policy_number", "chunk_text", "question")
        answered = (
            completion.complete(prompts, "prompt", EchoClient, response="raw")
            .withColumn("answer", completion.extract_text("raw", "first"))
            .withColumn("approach", F.lit(f"{size}/{overlap} token chunks"))
        )
        facts = retrieval.confidence(hits).join(
            retrieval.sources(hits, "policy_number"), "query_id"
        )
        histories.append(
            retrieval.query_history(answered.join(facts, "query_id"), size, overlap)
        )
    return union(histories)


class EchoClient:
    """Stand-in for a model endpoint: answers with the size of the prompt."""

    def __call__(self, prompt: str) -> str:
        return f'[{{"type": "text", "text": "{len(prompt)} characters"}}]'


def history_rows(lake: Lake) -> DataFrame:
    """Query history made of events: kind as question, half of the day as approach."""
    return lake.table("events").select(
        F.col("event_type").alias("question"),
        F.when(F.hour("ts") < 12, "first").otherwise("second").alias("approach"),
        (F.col("value") / 100).alias("confidence"),
        F.col("ts").alias("retrieved_at"),
        F.col("event_id").alias("answer_id"),
    )


@query
def confidence_pivot(lake: Lake) -> DataFrame:
    return retrieval.confidence_pivot(history_rows(lake), ["first", "second"])


@query
def latest_per_key(lake: Lake) -> DataFrame:
    return history.latest_per(
        history_rows(lake), ["question", "approach"], "retrieved_at", [F.desc("answer_id")]
    )


@query
def dq_prompt(lake: Lake) -> DataFrame:
    return completion.dq_prompt(dq_issue_log(lake)).select("issue_id", "prompt")


def answered(lake: Lake, prompts: DataFrame) -> DataFrame:
    """Answers of the stand-in client, by way of an answer log."""
    log = scratch_path(lake.spark, "answers")
    return completion.complete(prompts, "prompt", EchoClient, response="raw", log=log)


@query
def dq_explanations(lake: Lake) -> DataFrame:
    """The explanation report: issues in order with a stand-in answer each."""
    log = materialise(dq_issue_log(lake), "issue-log")
    prompts = completion.dq_prompt(issues.sequence_issues(log))
    found = answered(lake, prompts).withColumn("ai_explanation", completion.extract_text("raw"))
    return found.select(
        *issues.ISSUE_COLUMNS,
        "issue_seq",
        "ai_explanation",
        "generation_status",
        F.lit("stand-in").alias("model_name"),
        F.lit(AS_OF).alias("generated_at"),
        F.lit("run-1").alias("_gold_run_id"),
    )


@query
def claim_briefs(lake: Lake) -> DataFrame:
    """Briefs on flagged claims; those with equal prompts are asked for once."""
    flagged = scored_table(lake).filter(scoring.is_flagged())
    prompts = completion.brief_prompt(flagged).select("claimid", "prompt")
    found = answered(lake, prompts)
    return found.select("claimid", completion.extract_text("raw").alias("brief"), "generation_status")


@query
def brief_prompt(lake: Lake) -> DataFrame:
    flagged = scored_table(lake).filter(scoring.is_flagged())
    return completion.brief_prompt(flagged).select("claimid", "prompt")


def fuel_figures(lake: Lake) -> DataFrame:
    return completion.facts_prompt(
        fuel_risk(lake),
        "Assess the underwriting risk of this fuel type in one or two sentences.",
        ["fuel", "total_vehicles", "avg_km_driven", "avg_power_bhp", "total_claims"],
    )


@query
def fuel_prompt(lake: Lake) -> DataFrame:
    return fuel_figures(lake).select("fuel", "prompt")


@query
def segment_prompt(lake: Lake) -> DataFrame:
    segments = kpis.customer_segments(lake.current("dim_customer"))
    return completion.facts_prompt(
        segments,
        "Name one concrete retention or upsell step for this customer segment.",
        ["job", "avg_balance", "carloan_pct", "hhinsurance_pct"],
    ).select("job", "prompt")


@query
def business_insights(lake: Lake) -> DataFrame:
    """Key figures per domain with a stand-in summary each."""
    prompts = completion.insight_prompt(kpi_bundle(lake).drop("status"))
    answered = completion.complete(prompts, "prompt", EchoClient, response="raw")
    return answered.select(
        "insight_id",
        "domain",
        "summary_title",
        completion.extract_text("raw").alias("executive_summary"),
        "kpi_json",
        F.current_timestamp().alias("generation_ts"),
        F.lit("stand-in").alias("model_name"),
        F.upper("generation_status").alias("status"),
    )


@query
def insight_prompt(lake: Lake) -> DataFrame:
    return completion.insight_prompt(kpi_bundle(lake)).select("insight_id", "prompt")


def typed_answers(lake: Lake) -> DataFrame:
    """Conversation turns in the shapes a model answers in."""
    blocks = F.to_json(
        F.array(
            F.struct(F.lit("reasoning").alias("type"), F.lit("thinking").alias("text")),
            F.struct(F.lit("text").alias("type"), F.col("text").alias("text")),
            F.struct(F.lit("text").alias("type"), F.col("role").alias("text")),
        )
    )
    return lake.table("conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.concat(F.lit("  "), "text", F.lit("\n")))
        .otherwise(blocks)
        .alias("answer"),
    )


@query
def extract_text(lake: Lake) -> DataFrame:
    return typed_answers(lake).select(
        "conv_id",
        "turn",
        completion.extract_text("answer").alias("all_text"),
        completion.extract_text("answer", "first").alias("first_text"),
    )
