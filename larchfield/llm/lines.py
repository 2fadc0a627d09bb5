"""Removal of repeated three-line windows, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import materialise

WINDOW = 3


def kept_lines(text: Column) -> Column:
    """The lines of a text that take part: without carriage returns and outer spaces, and not empty."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.trim(F.regexp_replace(x, "\r", "")))
    return F.filter(lines, lambda x: x != "")


def window_hashes(lines: Column) -> Column:
    """128-bit hashes of all windows of three consecutive lines."""

    def at(i: Column) -> Column:
        three = [F.get(lines, i + k) for k in range(WINDOW)]
        return F.struct(
            F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit(11), *reversed(three)).alias("h2")
        )

    count = F.size(lines)
    none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    return F.when(
        count >= WINDOW, F.transform(F.sequence(F.lit(0), count - WINDOW), at)
    ).otherwise(none)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Remove later occurrences of three-line windows that repeat anywhere.

    Lines are split at line feeds and compared without carriage returns and outer
    spaces (tabs count); lines empty then take no part in windows. A window's first occurrence is the one with the least (doc_id,
    text hash, position). Every other occurrence covers its three lines; the
    union of covered lines is removed; blank lines stay. Texts without a covered line are returned byte for
    byte.

    Returns the columns of ``docs`` with the cleaned ``text`` plus
    ``lines_removed`` (long). A text that is null stays null, and an empty one or
    one of fewer than three lines stays as it is. A null doc_id orders first.
    Rows repeated in full are occurrences of one document: they share the same
    first occurrence and are cleaned alike. A text wholly covered becomes empty.
    Other columns pass through, whatever their names; one named ``lines_removed``
    is replaced.
    """
    docs = docs.drop("lines_removed")
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), kept_lines(F.col("text")).alias("lines")
    )
    windows = keyed.select(
        "doc_id", "text_key", F.posexplode(window_hashes(F.col("lines"))).alias("pos", "w")
    ).select("doc_id", "text_key", "pos", "w.h1", "w.h2")
    windows = materialise(windows, "line-windows")
    place = F.struct("doc_id", "text_key", "pos")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
    )
    covered = materialise(
        windows.join(repeated, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("at")),
        "line-covered",
    )
    # All columns of the input travel in one, so that none can clash with a working column.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("key"),
    )
    marked = rows.alias("d").join(
        # What is covered grows with the input, so one plan holds at every size.
        covered.hint("merge").alias("c"),
        F.col("d.id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.key") == F.col("c.text_key")),
        "left",
    )
    changed = F.col("at").isNotNull()
    staged = (
        marked.select("row", F.col("c.at").alias("at"))
        .withColumn("parts", F.when(changed, F.split("row.text", "\n", -1)))
        .withColumn("gone", covered_lines(F.col("at"), line_numbers(F.col("parts"))))
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get(F.col("parts"), i)), "\n")
    text = F.when(changed, cleaned).otherwise(F.col("row.text")).alias("text")
    return staged.select(
        *(text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns),
        F.when(changed, F.size("gone")).otherwise(0).cast("long").alias("lines_removed"),
    )


def line_numbers(lines: Column) -> Column:
    """Numbers of the non-blank lines: windows count positions over these."""
    blank = lambda x: F.trim(F.regexp_replace(x, "\r", "")) == ""
    marked = F.transform(lines, lambda x, i: F.when(~blank(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def covered_lines(at: Column, numbers: Column) -> Column:
    """Numbers of the lines under the windows that begin at positions ``at``."""
    positions = F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2))))
    return F.transform(positions, lambda p: F.get(numbers, p))
