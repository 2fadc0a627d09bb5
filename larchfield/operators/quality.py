"""Declarative row rules: evaluate, split, count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row must satisfy the SQL predicate ``passes``, else it is quarantined.

    A NULL outcome counts as failed, and so does a missing column named in
    ``needs``. The reject reason is ``reason``, followed by the row's value of
    ``shows`` if that is given.
    """

    name: str
    passes: str
    reason: str
    needs: tuple[str, ...] = ()
    shows: str | None = None


@dataclass(frozen=True)
class Expectation:
    """A row should satisfy ``holds``; rows that do not are kept and counted."""

    name: str
    column: str
    holds: str
    description: str
    fix: str

    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.holds), F.lit(False))


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One boolean column per rule, never NULL."""
    return df.withColumns(
        {
            rule.name: F.coalesce(F.expr(rule.passes), F.lit(False))
            if all(c in df.columns for c in rule.needs)
            else F.lit(False)
            for rule in rules
        }
    )


def reject_reason(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    """Reason of the first failed rule, NULL when all passed."""

    def text(rule: Rule) -> Column:
        if rule.shows is None:
            return F.lit(rule.reason)
        shown = F.col(rule.shows).cast("string") if rule.shows in columns else F.lit(None)
        return F.concat(F.lit(rule.reason), F.coalesce(shown, F.lit("null")))

    # coalesce stops at the first rule that yields a reason.
    return F.coalesce(*(F.when(~F.col(rule.name), text(rule)) for rule in rules))


def tag_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule columns plus ``_reject_reason``, which is NULL on clean rows."""
    flagged = evaluate_rules(df, rules)
    return flagged.withColumn("_reject_reason", reject_reason(rules, df.columns))


def split_quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)``; every input row lands in exactly one of them."""
    tagged = tag_rejects(df, rules)
    clean = tagged.filter(F.col("_reject_reason").isNull())
    rejected = tagged.filter(F.col("_reject_reason").isNotNull())
    return clean.drop("_reject_reason", *(r.name for r in rules)), rejected


def expect_all(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Failed and total rows per expectation, from one pass over the data."""
    names = [e.name for e in expectations]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *(F.count_if(e.broken()).alias(e.name) for e in expectations),
    )
    return counts.unpivot("total_records", names, "rule_name", "failed_records")


def observe_expectations(
    df: DataFrame, expectations: Sequence[Expectation], observation: Observation | str
) -> DataFrame:
    """Same counts taken while rows flow through, for batch or stream."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("total_records"),
        *(F.count_if(e.broken()).alias(e.name) for e in expectations),
    )
