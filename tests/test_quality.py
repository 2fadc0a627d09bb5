import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from larchfield.operators import issues, quality
from larchfield.plans.entities import CARS, CUSTOMERS, ENTITIES, POLICY
from larchfield.plans.fixtures import Lake
from tests.conftest import SF_TINY


def test_null_region_is_quarantined_not_lost(spark, rows):
    df = spark.createDataFrame([("1", None), (None, "East"), (None, None), ("2", "West")], "customer_id string, region string")
    clean, rejected = quality.split_quarantine(df, CUSTOMERS.rules)
    assert rows(clean) == [("2", "West")]
    assert rows(rejected, "_reject_reason") == [
        ("R1: customer_id is null",), ("R1: customer_id is null",), ("R2: invalid region code",)
    ]


def test_missing_column_fails_every_row(spark, rows):
    clean, rejected = quality.split_quarantine(spark.createDataFrame([("1",)], "car_id string"), CARS.rules)
    assert clean.isEmpty()
    assert rows(rejected, "_reject_reason") == [("R2: km_driven exceeds 500000",)]


def test_reason_shows_the_value(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "Zz"), (2, 2, None), (3, 3, "Ohio")], "policy_number int, customer_id int, policy_state_full string"
    )
    assert rows(quality.split_quarantine(df, POLICY.rules)[1], "_reject_reason") == [
        ("R3: unknown state = Zz",), ("R3: unknown state = null",)
    ]


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_split_keeps_every_row_once(spark, name):
    lake = Lake(spark, SF_TINY)
    clean, rejected = lake.split(name)
    whole = ENTITIES[name].prepare(lake.source(name))
    assert clean.count() + rejected.count() == whole.count()
    assert clean.columns == whole.columns


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_one_pass_issues_equal_separate_ones(spark, rows, name):
    lake, spec = Lake(spark, SF_TINY), ENTITIES[name]
    clean, rejected = lake.split(name)
    parts = issues.quarantine_stats(rejected, clean, name)
    if spec.expectations:
        parts = parts.unionByName(issues.warning_stats(clean, name, spec.expectations))
    assert rows(issues.entity_issues(lake.tagged(name), name, spec.expectations)) == rows(parts)


def test_fix_follows_the_text_of_the_reason(spark):
    rejected = spark.createDataFrame([("R2: invalid region code",), ("R2: km_driven exceeds 5",), ("R9: x is null",)], "_reject_reason string")
    stats = {r.issue_description: r for r in issues.quarantine_stats(rejected, rejected.limit(0), "t").collect()}
    # The second word "invalid" contains "id", so the key fix is suggested.
    assert stats["R2: invalid region code"].suggested_fix == issues.FIX_KEYS
    assert stats["R2: km_driven exceeds 5"].suggested_fix == issues.FIX_OUTLIERS
    assert stats["R9: x is null"].suggested_fix == issues.FIX_NULLS
    assert stats["R9: x is null"].affected_ratio == 0.3333


def test_empty_tables_give_no_issue(spark):
    nothing = spark.createDataFrame([], "_reject_reason string, balance double, education string, marital string")
    assert issues.quarantine_stats(nothing, nothing, "t").isEmpty()
    assert issues.warning_stats(nothing, "t", CUSTOMERS.expectations).isEmpty()


def test_log_skips_missing_parts_and_is_numbered(spark):
    log = issues.dq_issue_log([issues.missing_file_issue(spark, "sales", "sales_3.csv"), None])
    first = issues.sequence_issues(log).first()
    assert (first.issue_seq, first.rule_name, first.affected_records) == (1, "missing_file_sales_3", 0)


def test_observed_counts_equal_counted(spark):
    lake = Lake(spark, SF_TINY)
    clean, expectations = lake.clean("customers"), CUSTOMERS.expectations
    observation = Observation("expectations")
    quality.observe_expectations(clean, expectations, observation).write.format("noop").mode("overwrite").save()
    counted = {r.rule_name: r.failed_records for r in quality.expect_all(clean, expectations).collect()}
    assert {k: v for k, v in observation.get.items() if k != "total_records"} == counted


def test_rule_flags_are_never_null(spark):
    flagged = quality.evaluate_rules(spark.createDataFrame([(None, None)], "car_id string, km_driven double"), CARS.rules)
    assert flagged.filter(F.col("is_valid_r1").isNull() | F.col("is_valid_r2").isNull()).isEmpty()
