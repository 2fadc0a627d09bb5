"""History fed by a stream and kept up to date bucket by bucket.

The target holds finished history rows in a fixed number of buckets by a hash of
the key. A micro-batch reads and rewrites only the buckets that its keys fall
into, so its work follows the batch and not the age of the table. Late versions
fall into place because their bucket's history is worked out again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larchfield.operators.history import END, START, scd2, without_sequence
from larchfield.sources.tables import is_written, read_or_none
from larchfield.streaming.split import write_batch

BUCKETS = 256


def target_schema(versions: DataFrame, seq: str) -> T.StructType:
    """Columns of the target: those of the versions, the validity and the bucket."""
    kind = versions.schema[seq].dataType
    fields = [*versions.schema.fields, T.StructField(END, kind), T.StructField(START, kind)]
    return T.StructType(fields).add("_bucket", T.IntegerType())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_history(
    batch: DataFrame,
    target: str,
    batch_id: int,
    keys: Sequence[str],
    seq: str,
    tiebreak: Sequence[Column] = (),
    buckets: int = BUCKETS,
) -> None:
    """Bring the history at ``target`` up to date with one batch of versions.

    Rows of the touched buckets and of the batch are ordered together. The new
    buckets are first written beside the target, in a folder named by the batch,
    and then replace their partitions. A batch that failed before that folder was
    complete has changed nothing and is worked out again; one that failed later,
    or is repeated, replaces the same partitions by the same rows.

    ``buckets`` is fixed for a target. The driver receives the numbers of touched
    buckets. Rows without a sequence go to ``<target>-rejected``.
    """
    spark = batch.sparkSession
    staged = f"{target}-staged/batch_id={batch_id}"
    schema = target_schema(batch, seq)
    if not is_written(spark, staged):
        write_batch(without_sequence(batch, seq), f"{target}-rejected", batch_id)
        new = batch.filter(F.col(seq).isNotNull())
        touched = [row.n for row in new.select(bucket_of(keys, buckets).alias("n")).distinct().collect()]
        known = read_or_none(spark, target, schema)
        if known is not None:
            # Partition values as literals: only the files of these buckets are read.
            old = known.filter(F.col("_bucket").isin(touched)).select(*new.columns)
            new = old.unionByName(new)
        history = scd2(new, keys, seq, tiebreak).withColumn("_bucket", bucket_of(keys, buckets))
        # AQE merges small buckets and splits large ones, so a hot key is written by several tasks.
        history.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(staged)
    (
        spark.read.schema(schema)
        .parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_bucket")
        .parquet(target)
    )


def merge_stream(
    versions: DataFrame,
    target: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    tiebreak: Sequence[Column] = (),
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Merge every micro-batch of versions that is available now into the target."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_history(batch, target, batch_id, keys, seq, tiebreak, buckets)

    return (
        versions.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """The history as of the last batch."""
    return spark.read.parquet(target).drop("_bucket")


def scd2_stream(
    versions: DataFrame,
    target: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    tiebreak: Sequence[Column] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Load what is available now and return the history."""
    merge_stream(versions, target, keys, seq, checkpoint, tiebreak, buckets).awaitTermination()
    return read_history(versions.sparkSession, target)
