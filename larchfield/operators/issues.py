"""Data-quality issue log and the reports on it.

The log holds one row per rule or reject reason, never one per bad record.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larchfield.operators.quality import Expectation
from larchfield.operators.ranking import global_row_number

# Severities.
QUARANTINED = "Error (Quarantined)"
PASSED = "Warning (Passed to Silver)"
MISSING_FILE = "Warning (Missing File)"

# Suggested fixes for quarantined records, first match wins.
FIX_KEYS = "Map missing primary keys from source system"
FIX_NULLS = "Enforce NOT NULL constraints upstream"
FIX_OUTLIERS = "Validate outlier thresholds with business"
FIX_OTHER = "Review source system data entry rules"

ISSUE_COLUMNS = (
    "issue_id",
    "table_name",
    "column_name",
    "rule_name",
    "issue_description",
    "severity",
    "affected_records",
    "affected_ratio",
    "suggested_fix",
)


def _ratio(part: Column, whole: Column) -> Column:
    """Share with four places; 0 of 0 is the count itself over one."""
    return F.round(part / F.greatest(whole, F.lit(1)), 4)


def _quarantine_fields(table: str, reason: Column, affected: Column, total: Column) -> dict[str, Column]:
    column = F.get(F.split(reason, " "), F.lit(1))
    return {
        "issue_id": F.md5(F.concat_ws("|", F.lit(table), reason)),
        "table_name": F.lit(table),
        "column_name": column,
        "rule_name": F.get(F.split(reason, ":"), F.lit(0)),
        "issue_description": reason,
        "severity": F.lit(QUARANTINED),
        "affected_records": affected,
        "affected_ratio": _ratio(affected, total),
        "suggested_fix": F.when(column.contains("id"), FIX_KEYS)
        .when(reason.contains("null"), FIX_NULLS)
        .when(reason.contains("exceeds"), FIX_OUTLIERS)
        .otherwise(FIX_OTHER),
    }


def _warning_fields(
    table: str, expectation: Expectation, affected: Column, total: Column
) -> dict[str, Column]:
    return {
        "issue_id": F.md5(F.lit(f"{table}|{expectation.name}")),
        "table_name": F.lit(table),
        "column_name": F.lit(expectation.column),
        "rule_name": F.lit(expectation.name),
        "issue_description": F.lit(expectation.description),
        "severity": F.lit(PASSED),
        "affected_records": affected,
        "affected_ratio": _ratio(affected, total),
        "suggested_fix": F.lit(expectation.fix),
    }


def _issue(fields: dict[str, Column]) -> Column:
    return F.struct(*(fields[name].alias(name) for name in ISSUE_COLUMNS))


def quarantine_stats(quarantine: DataFrame, clean: DataFrame, table: str) -> DataFrame:
    """One issue per reject reason with its share of all records.

    The totals are scalar subqueries: on stored tables they are answered from
    file footers, and no join is needed to attach them.
    """
    records = quarantine.agg(F.count(F.lit(1))).scalar() + clean.agg(F.count(F.lit(1))).scalar()
    counts = quarantine.groupBy("_reject_reason").agg(F.count(F.lit(1)).alias("_n"))
    fields = _quarantine_fields(table, F.col("_reject_reason"), F.col("_n"), records)
    return counts.select(*(fields[name].alias(name) for name in ISSUE_COLUMNS))


def warning_stats(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """One issue per expectation that some kept record breaks, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_records"),
        *(F.count_if(e.broken()).alias(e.name) for e in expectations),
    )
    found = F.array(
        *(_issue(_warning_fields(table, e, F.col(e.name), F.col("_records"))) for e in expectations)
    )
    return counts.select(F.inline(found)).filter("affected_records > 0")


def entity_issues(
    tagged: DataFrame, table: str, expectations: Sequence[Expectation] = ()
) -> DataFrame:
    """Both kinds of issues of one entity from a single pass over its tagged rows.

    Rows are counted per reject reason; clean rows are the group without reason,
    and only there do broken expectations count.
    """
    counts = tagged.groupBy("_reject_reason").agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.count_if(e.broken()).alias(e.name) for e in expectations),
    )
    total = counts.agg(F.sum("_n")).scalar()
    reason = F.col("_reject_reason")
    rejected = _issue(_quarantine_fields(table, reason, F.col("_n"), total))
    warned = [
        _issue(_warning_fields(table, e, F.col(e.name), F.col("_n"))) for e in expectations
    ]
    found = F.when(reason.isNotNull(), F.array(rejected))
    if warned:
        found = found.otherwise(F.array(*warned))
    return counts.select(F.inline(found)).filter("affected_records > 0")


def missing_file_issue(spark: SparkSession, table: str, file_name: str) -> DataFrame:
    """The one-row issue for an input file that was never delivered."""
    stem = file_name.rsplit(".", 1)[0]
    return spark.range(1).select(
        F.md5(F.lit(f"{table}|missing_file_{stem}")).alias("issue_id"),
        F.lit(table).alias("table_name"),
        F.lit("N/A").alias("column_name"),
        F.lit(f"missing_file_{stem}").alias("rule_name"),
        F.lit(f"{file_name} file doesn't exist").alias("issue_description"),
        F.lit(MISSING_FILE).alias("severity"),
        F.lit(0).cast("long").alias("affected_records"),
        F.lit(0.0).alias("affected_ratio"),
        F.lit("Check Bronze extraction zone for missing payload").alias("suggested_fix"),
    )


def dq_issue_log(parts: Sequence[DataFrame | None]) -> DataFrame:
    """Union of all issues, warnings first, then by records affected.

    A part that is ``None`` stands for a table that does not exist.
    """
    present = [p.select(*ISSUE_COLUMNS) for p in parts if p is not None]
    return reduce(DataFrame.unionByName, present).orderBy(
        F.desc("severity"), F.desc("affected_records"), "issue_id"
    )


def sequence_issues(log: DataFrame) -> DataFrame:
    """Number issues by severity, table and id, errors before warnings.

    A reason may embed a bad value, so the log can grow with dirty data; the
    first two hex digits of the id split it into evenly filled buckets.
    """
    return global_row_number(
        log,
        {
            "_severity": F.coalesce("severity", F.lit("")),
            "_table": F.coalesce("table_name", F.lit("")),
            "_id_head": F.substring("issue_id", 1, 2),
        },
        [F.col("issue_id")],
        "issue_seq",
    )


def is_error() -> Column:
    return F.col("severity").like("Error%")


def dq_report(log: DataFrame) -> DataFrame:
    """The compliance list: errors first, then by records affected."""
    return log.orderBy(
        F.when(is_error(), 1).otherwise(2), F.desc("affected_records"), "issue_id"
    ).select(
        F.initcap("table_name").alias("entity"),
        F.col("column_name").alias("column"),
        "issue_description",
        "severity",
        F.col("affected_records").alias("affected_rows"),
        F.concat(F.round(F.col("affected_ratio") * 100, 2).cast("string"), F.lit("%")).alias(
            "impact_rate"
        ),
        F.col("suggested_fix").alias("suggested_action"),
    )


def dq_by_severity(log: DataFrame) -> DataFrame:
    """Affected records per table and severity."""
    return (
        log.groupBy("table_name", "severity")
        .agg(F.sum("affected_records").alias("total_records"))
        .select(F.initcap("table_name").alias("entity"), "severity", "total_records")
        .orderBy(F.desc("total_records"), "entity", "severity")
    )


def dq_kpis(log: DataFrame) -> DataFrame:
    """Quarantined and warned totals."""

    def total(test: Column) -> Column:
        return F.sum(F.when(test, F.col("affected_records")).otherwise(0))

    return log.agg(
        total(is_error()).alias("total_quarantined"),
        total(F.col("severity").like("Warning%")).alias("total_warnings"),
    )
