"""Positions over a whole table without sorting it in one task.

A window without PARTITION BY moves every row to one task. Here rows are first
counted per bucket, the buckets being a coarse form of the sort order. Only the
bucket totals, whose number is bounded by the bucket expression and not by the
rows, go through an unpartitioned window; rows are numbered inside buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)


def _rows_before(totals: DataFrame, count: str, order: Sequence[Column]) -> Column:
    return F.coalesce(F.sum(count).over(Window.orderBy(*order).rowsBetween(*BEFORE)), F.lit(0))


def global_row_number(
    df: DataFrame, buckets: Mapping[str, Column], order: Sequence[Column], target: str
) -> DataFrame:
    """1, 2, 3 ... in the order of ``buckets`` and then ``order``.

    ``buckets`` must sort like the wanted order, ascending, hold no NULLs, and
    together with ``order`` make rows unique.
    """
    names = list(buckets)
    tagged = df.withColumns(dict(buckets))
    totals = tagged.groupBy(*names).agg(F.count(F.lit(1)).alias("_in_bucket"))
    offsets = totals.select(
        *names, _rows_before(totals, "_in_bucket", [F.col(n) for n in names]).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return (
        tagged.withColumn("_inside", inside)
        .join(offsets, names)
        .withColumn(target, (F.col("_before") + F.col("_inside")).cast("int"))
        .drop("_inside", "_before", *names)
    )


def global_rank_desc(df: DataFrame, score: str, bucket_width: float, target: str) -> DataFrame:
    """SQL ``rank()`` over the whole table, highest score first, NULLs last.

    Rows are reduced to one row per distinct score before anything is ordered,
    so a score shared by a third of all rows costs one row.
    """
    per_score = (
        df.filter(F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_bucket", F.floor(F.col(score) / bucket_width))
    )
    totals = per_score.groupBy("_bucket").agg(F.sum("_rows").alias("_in_bucket"))
    offsets = totals.select(
        "_bucket", _rows_before(totals, "_in_bucket", [F.desc("_bucket")]).alias("_before")
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc(score)).rowsBetween(*BEFORE)
    ranks = (
        per_score.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(offsets, "_bucket")
        .select(
            F.col(score).alias("_score"),
            (F.col("_before") + F.col("_inside") + 1).alias(target),
        )
    )
    scored = totals.agg(F.coalesce(F.sum("_in_bucket"), F.lit(0))).scalar()
    return (
        df.join(ranks, F.col(score) == F.col("_score"), "left")
        .drop("_score")
        .withColumn(target, F.coalesce(F.col(target), scored + 1).cast("int"))
    )
