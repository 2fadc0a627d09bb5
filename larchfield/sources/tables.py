"""Table sink and the checks between a source and what was loaded from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larchfield.session import shuffles_dropped
from larchfield.sources.files import PROVENANCE


def overwrite_table(df: DataFrame, path: str, by: str | None = None, slices: int = 1) -> DataFrame:
    """Replace the table at ``path``, its schema included, and return it.

    Running it again gives the same table. ``df`` must not read from ``path``. With
    ``slices`` it is written in so many steps, split by the hash of column ``by``;
    the shuffles of a step are dropped before the next, so that those of one slice
    lie on the disks at a time.
    """
    for part in range(slices):
        own = df if by is None else df.filter(F.pmod(F.xxhash64(by), F.lit(slices)) == part)
        with shuffles_dropped(df.sparkSession):
            own.write.mode("append" if part else "overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table at ``path``; None if nothing is there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def schema_problems(raw: DataFrame, bronze: DataFrame) -> list[str]:
    """Raw columns that the loaded table lacks or holds with another type."""
    loaded = {c: t for c, t in bronze.dtypes if c not in PROVENANCE}
    return [
        f"missing column {c}" if c not in loaded else f"type of {c}: raw {t}, bronze {loaded[c]}"
        for c, t in raw.dtypes
        if c not in PROVENANCE and loaded.get(c) != t
    ]


def fingerprint(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two numbers that stand for the content of a group of rows, whatever their order.

    Sums of two unlike 64-bit hashes of a row's columns, in order of their names
    and as text. A null differs from every text, and a value from the same value
    in another column. Rows that come twice count twice.
    """
    shown = [
        F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in sorted(columns)
    ]
    return tuple(
        F.sum(F.xxhash64(F.lit(seed), *order).cast("decimal(38,0)")) for seed, order in ((1, shown), (2, shown[::-1]))
    )


def reconcile(raw: DataFrame, bronze: DataFrame, by: str = "_source_file") -> DataFrame:
    """Rows and content per source file on both sides, in one job for all files.

    ``content_equal`` compares fingerprints over the data columns that both sides
    have, so a value that was changed or swapped with another row's shows where
    counts do not. ``passed`` needs equal counts, equal content and no schema
    problem. Each side is reduced to one row per file before they meet.
    """
    problems = F.lit("; ".join(schema_problems(raw, bronze)))
    shared = [c for c in raw.columns if c in bronze.columns and c not in (*PROVENANCE, by)]

    def reduced(df: DataFrame, side: str) -> DataFrame:
        first, second = fingerprint(shared)
        content = F.struct(first.alias("first"), second.alias("second"))
        return df.groupBy(by).agg(F.count(F.lit(1)).alias(f"{side}_count"), content.alias(f"{side}_content"))

    both = reduced(raw, "raw").join(reduced(bronze, "bronze"), by, "full")
    return both.select(
        by,
        F.coalesce("raw_count", F.lit(0)).alias("raw_count"),
        F.coalesce("bronze_count", F.lit(0)).alias("bronze_count"),
        F.col("raw_content").eqNullSafe(F.col("bronze_content")).alias("content_equal"),
        problems.alias("schema_problems"),
    ).withColumn(
        "passed",
        (F.col("raw_count") == F.col("bronze_count")) & F.col("content_equal") & (F.col("schema_problems") == ""),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def require_rows(counts: DataFrame) -> None:
    """Fail if a table is empty. Runs a job; fetches the names of empty tables."""
    empty = [row.table_name for row in counts.filter("record_count = 0").collect()]
    if empty:
        raise ValueError(f"tables without rows: {', '.join(sorted(empty))}")


def require_passed(report: DataFrame) -> None:
    """Fail if a reconciliation found a difference. Fetches at most five rows."""
    failed = report.filter("NOT passed").limit(5).collect()
    if failed:
        raise ValueError(f"load differs from source: {failed}")
