"""Insurance tables derived from the TPC-H-like test tables.

Each view is one SQL text that Spark and DuckDB both run, so the same text feeds
the queries and their checks. The views add the dirt the operators deal with:
missing keys, codes in mixed case, unknown values, spreadsheet date fragments.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larchfield.operators.history import scd2
from larchfield.operators.quality import split_quarantine, tag_rejects
from larchfield.operators.scoring import score_claims
from larchfield.operators.star import build_dim, fact_car_sales, fact_claims
from larchfield.plans.entities import ENTITIES
from larchfield.plans.inventory import aging_inventory, demand_signal, redistribution
from larchfield.session import materialise

# The day on which unsold listings are judged; listings end two weeks earlier.
AS_OF = "2001-08-15 00:00:00"

# The synthetic sales are slower than real ones: wider window, slower "fast".
DEMAND_DAYS, FAST_DAYS = 730, 400

VIEWS = {
    "fx_customers_raw": """
        SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS customer_id,
               CASE WHEN c_custkey % 31 = 0 THEN NULL
                    WHEN c_custkey % 29 = 0 THEN 'Z'
                    WHEN c_custkey % 2 = 0 THEN
                        CASE n_regionkey WHEN 0 THEN 'e' WHEN 1 THEN 'W' WHEN 2 THEN 'c'
                                         WHEN 3 THEN 'S' ELSE 'N' END
                    ELSE CASE n_regionkey WHEN 0 THEN 'EAST' WHEN 1 THEN 'west'
                                          WHEN 2 THEN 'Central' WHEN 3 THEN 'south'
                                          ELSE 'NORTH' END
               END AS region,
               CASE c_custkey % 5 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary'
                                  WHEN 2 THEN 'tertiary' WHEN 3 THEN NULL
                                  ELSE 'unknown' END AS education,
               CASE c_custkey % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'married'
                                  WHEN 2 THEN 'divorced' ELSE 'widowed' END AS marital,
               c_mktsegment AS job,
               c_acctbal AS balance,
               CASE WHEN c_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS carloan,
               CASE WHEN c_custkey % 7 < 3 THEN 'yes' ELSE 'no' END AS hhinsurance
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
    """,
    # Rich customers have a second version three years later.
    "fx_customers_log": """
        SELECT customer_id, region, education, marital, job, balance, carloan, hhinsurance,
               TIMESTAMP '1995-01-01 00:00:00' AS seq
        FROM {fx_customers_raw}
        UNION ALL
        SELECT customer_id, region, education, marital, job, balance + 100, carloan, hhinsurance,
               TIMESTAMP '1998-01-01 00:00:00'
        FROM {fx_customers_raw}
        WHERE balance > 5000
    """,
    "fx_policy": """
        SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END AS policy_number,
               CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               CASE o_custkey % 6 WHEN 0 THEN 'IL' WHEN 1 THEN 'nc' WHEN 2 THEN 'OH'
                                  WHEN 3 THEN 'VA' WHEN 4 THEN 'ZZ' ELSE 'TX' END AS policy_state,
               CASE o_orderkey % 3 WHEN 0 THEN '100/300' WHEN 1 THEN '250/500'
                                   ELSE '500/1000' END AS policy_csl,
               CAST(CASE o_orderkey % 3 WHEN 0 THEN 500 WHEN 1 THEN 1000
                                        ELSE 2000 END AS DOUBLE) AS policy_deductable,
               o_totalprice / 100 AS policy_annual_premium,
               CAST(CASE WHEN o_orderkey % 4 = 0 THEN 6000000 ELSE 0 END AS DOUBLE)
                   AS umbrella_limit,
               CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE o_orderdate END AS policy_bind_date
        FROM {orders}
    """,
    "fx_cars": """
        SELECT p_partkey AS car_id, p_name AS name, p_brand AS model, p_type AS fuel,
               CASE WHEN p_size % 2 = 0 THEN 'Manual' ELSE 'Automatic' END AS transmission,
               CAST(p_size * 10400 AS DOUBLE) AS km_driven,
               concat(CAST(p_size AS VARCHAR(10)),
                      CASE WHEN p_size % 2 = 0 THEN ' kmpl' ELSE ' km/kg' END) AS mileage,
               concat(CAST(p_size * 50 AS VARCHAR(10)), ' CC') AS engine,
               concat(CAST(p_size * 3 AS VARCHAR(10)), '.5 bhp') AS max_power,
               concat(CAST(p_size AS VARCHAR(10)),
                      CASE WHEN p_size % 3 = 0 THEN '.5 kgm at 2000rpm'
                           ELSE 'Nm@ 2000rpm' END) AS torque,
               TIMESTAMP '1995-01-01 00:00:00' AS seq
        FROM {part}
    """,
    "fx_sales": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)),
                         CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS sales_id,
               CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_partkey END AS car_id,
               CASE n_regionkey WHEN 0 THEN 'East' WHEN 1 THEN 'West' WHEN 2 THEN 'Central'
                                WHEN 3 THEN 'South' ELSE 'North' END AS region,
               n_name AS state, n_name AS city, o_orderdate AS ad_placed_on,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_on,
               CASE WHEN l_suppkey % 83 = 0 THEN 0.0 ELSE l_extendedprice * 10 END
                   AS original_selling_price,
               CASE l_returnflag WHEN 'A' THEN 'Individual' WHEN 'N' THEN 'Dealer'
                                 ELSE 'broker' END AS seller_type
        FROM {lineitem}
        JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey
    """,
    "fx_claims": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)),
                         CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS claimid,
               CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE l_orderkey END AS policyid,
               l_partkey AS car_id,
               CASE WHEN l_partkey % 53 = 0 THEN 'Unclassified'
                    ELSE CASE l_returnflag WHEN 'A' THEN 'Major Damage'
                                           WHEN 'N' THEN 'Minor Damage'
                                           ELSE 'Trivial Damage' END
               END AS incident_severity,
               CASE WHEN l_partkey % 7 = 0 THEN 'Vehicle Theft' ELSE 'Collision' END
                   AS incident_type,
               CASE l_suppkey % 4 WHEN 0 THEN 'SC' WHEN 1 THEN 'ny' WHEN 2 THEN 'WV'
                                  ELSE 'atlantis' END AS incident_state,
               l_extendedprice * l_discount AS injury, l_extendedprice * l_tax AS vehicle,
               CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_quantity * 10 END AS property,
               CAST(l_linenumber % 3 AS DOUBLE) AS bodily_injuries,
               CAST(1 + l_linenumber % 4 AS DOUBLE) AS number_of_vehicles_involved,
               CAST(l_suppkey % 4 AS DOUBLE) AS witnesses,
               CASE WHEN l_partkey % 6 = 0 THEN '?' WHEN l_linestatus = 'F' THEN 'YES'
                    ELSE 'NO' END AS police_report_available,
               CASE WHEN l_partkey % 5 = 0 THEN '?' ELSE 'NO' END AS property_damage,
               CASE WHEN l_suppkey % 5 = 0 THEN 'None' ELSE 'Police' END AS authorities_contacted,
               CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS claim_rejected,
               o_orderdate AS incident_date, o_orderdate AS claim_logged_on,
               l_shipdate AS claim_processed_on
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    """,
    # Claims as a regional export spells them: all text, four date formats, damaged dates.
    "fx_claims_text": """
        SELECT claimid, CAST(policyid AS VARCHAR(20)) AS policyid,
               CAST(car_id AS VARCHAR(20)) AS car_id, incident_severity, incident_state,
               CASE car_id % 4
                    WHEN 0 THEN substr(CAST(incident_date AS VARCHAR(19)), 1, 10)
                    WHEN 1 THEN CAST(incident_date AS VARCHAR(19))
                    WHEN 2 THEN concat_ws('-', substr(CAST(incident_date AS VARCHAR(19)), 9, 2),
                                          substr(CAST(incident_date AS VARCHAR(19)), 6, 2),
                                          substr(CAST(incident_date AS VARCHAR(19)), 1, 4))
                    ELSE concat(substr(CAST(incident_date AS VARCHAR(19)), 9, 2), '-',
                                substr(CAST(incident_date AS VARCHAR(19)), 6, 2), '-',
                                substr(CAST(incident_date AS VARCHAR(19)), 1, 4), ' 00:00')
               END AS incident_date,
               CASE WHEN car_id % 59 = 0 THEN '27:00.0'
                    ELSE CAST(claim_logged_on AS VARCHAR(19)) END AS claim_logged_on,
               CASE WHEN car_id % 61 = 0 THEN 'Null'
                    ELSE CAST(claim_processed_on AS VARCHAR(19)) END AS claim_processed_on,
               property_damage, police_report_available
        FROM {fx_claims}
    """,
    # Deliveries of claims: some come again a week later with another severity.
    "fx_claims_log": """
        SELECT claimid, policyid, car_id, incident_severity, incident_state, incident_date,
               TIMESTAMP '2002-01-01 00:00:00' AS seq
        FROM {fx_claims}
        UNION ALL
        SELECT claimid, policyid, car_id, 'Major Damage', incident_state, incident_date,
               TIMESTAMP '2002-01-08 00:00:00'
        FROM {fx_claims} WHERE car_id % 5 = 0
        UNION ALL
        SELECT claimid, policyid, car_id, incident_severity, incident_state, incident_date, NULL
        FROM {fx_claims} WHERE car_id % 31 = 0
    """,
    # Listings delivered before they were sold, with the sale, and some a third time unchanged.
    "fx_sales_log": """
        SELECT sales_id, car_id, region, ad_placed_on, CAST(NULL AS TIMESTAMP) AS sold_on,
               original_selling_price, seller_type, TIMESTAMP '2002-01-01 00:00:00' AS seq
        FROM {fx_sales}
        UNION ALL
        SELECT sales_id, car_id, region, ad_placed_on, sold_on, original_selling_price, seller_type,
               TIMESTAMP '2002-01-02 00:00:00'
        FROM {fx_sales} WHERE sold_on IS NOT NULL
        UNION ALL
        SELECT sales_id, car_id, region, ad_placed_on, sold_on, original_selling_price, seller_type,
               TIMESTAMP '2002-01-02 00:00:00'
        FROM {fx_sales} WHERE sold_on IS NOT NULL AND car_id % 3 = 0
    """,
    "fx_dates_raw": """
        SELECT event_id,
               CASE event_id % 6 WHEN 0 THEN '27:00.0' WHEN 1 THEN '05-03-2016 14:10'
                                 WHEN 2 THEN '2016-03-05 01:02:03' WHEN 3 THEN '05-03-2016'
                                 WHEN 4 THEN '2016-03-05' ELSE 'Null' END AS d,
               CASE WHEN event_id % 4 = 0 THEN '?' ELSE event_type END AS flag
        FROM {events}
    """,
}

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


class Lake:
    """The layers of one data folder, each frame built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name in self._views:
            return self._views[name]
        text = VIEWS[name]
        inputs = {n: self.table(n) for n in BASE_TABLES if f"{{{n}}}" in text}
        inputs |= {n: self.view(n) for n in VIEWS if f"{{{n}}}" in text}
        return self.spark.sql(text, **inputs)

    def keep_view(self, name: str) -> Lake:
        """Write a view once that others read several times."""
        self._views[name] = materialise(self.view(name), name.replace("_", "-"), "zstd")
        return self

    # --- silver ---

    def source(self, entity: str) -> DataFrame:
        views = {"customers": "fx_customers_raw"}
        return self.view(views.get(entity, f"fx_{entity}"))

    def tagged(self, entity: str) -> DataFrame:
        spec = ENTITIES[entity]
        return tag_rejects(spec.prepare(self.source(entity)), spec.rules)

    def split(self, entity: str) -> tuple[DataFrame, DataFrame]:
        spec = ENTITIES[entity]
        return split_quarantine(spec.prepare(self.source(entity)), spec.rules)

    def clean(self, entity: str) -> DataFrame:
        return self.split(entity)[0]

    def rejected(self, entity: str) -> DataFrame:
        return self.split(entity)[1]

    def deliveries(self, entity: str) -> DataFrame:
        """Clean rows of every delivery of an entity, as versions by ``seq``."""
        if entity == "policy":
            return self.clean(entity).withColumn("seq", F.col("policy_bind_date"))
        spec, logged = ENTITIES[entity], f"fx_{entity}_log"
        log = self.view(logged) if logged in VIEWS else self.source(entity)
        log = log.withColumn("seq", F.col("seq").cast("timestamp_ntz"))
        return split_quarantine(spec.prepare(log), spec.rules)[0]

    # --- gold ---

    @cached_property
    def dim_customer(self) -> DataFrame:
        history = scd2(self.deliveries("customers"), ["customer_id"], "seq")
        return build_dim(history, "customer_id", "customer_sk")

    @cached_property
    def dim_policy(self) -> DataFrame:
        history = scd2(self.clean("policy"), ["policy_number"], "policy_bind_date")
        return build_dim(history, "policy_number", "policy_sk")

    @cached_property
    def dim_car(self) -> DataFrame:
        return build_dim(scd2(self.deliveries("cars"), ["car_id"], "seq"), "car_id", "car_sk")

    @cached_property
    def fact_claims(self) -> DataFrame:
        return fact_claims(self.clean_claims, self.dim_policy, self.dim_customer)

    @cached_property
    def fact_sales(self) -> DataFrame:
        as_of = F.lit(AS_OF).cast("timestamp_ntz")
        return fact_car_sales(self.clean("sales"), self.dim_car, as_of)

    def keep(self, *names: str) -> Lake:
        """Write the named frames once, as gold tables are, so that several readers share them."""
        for name in names:
            setattr(self, name, materialise(getattr(self, name), name.replace("_", "-"), "zstd"))
        return self

    @cached_property
    def clean_claims(self) -> DataFrame:
        return self.clean("claims")

    def current(self, dim: str) -> DataFrame:
        return getattr(self, dim).filter("is_current")

    # --- alert and scores ---

    @cached_property
    def aging(self) -> DataFrame:
        return aging_inventory(self.fact_sales, self.dim_car)

    @cached_property
    def demand(self) -> DataFrame:
        return demand_signal(self.fact_sales, self.dim_car, DEMAND_DAYS)

    @cached_property
    def moves(self) -> DataFrame:
        return redistribution(self.aging, self.demand, FAST_DAYS)

    @cached_property
    def scored(self) -> DataFrame:
        # Statistics, weights and scores read the claims once each.
        return score_claims(self.keep("clean_claims").clean_claims)
