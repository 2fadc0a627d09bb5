"""Quarantine split of a stream into two tables, with its expectation counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larchfield.operators.quality import observe_expectations, tag_rejects
from larchfield.plans.entities import Entity

COUNTS = "rule_name string, failed_records long, total_records long"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str | None = None, ids: bool = False) -> DataFrame:
    """All batches written so far; ``ids`` keeps the column batch_id.

    With a schema no footer is read to find it; without one the columns are those
    of one batch, since a running stream's columns do not change.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = reader.option("basePath", path).parquet(path)
    return found if ids else found.drop("batch_id")


def split_stream(
    bronze: DataFrame, entity: Entity, clean: str, quarantine: str, checkpoint: str, counts: str | None = None
) -> StreamingQuery:
    """Prepare each micro-batch once and write both branches.

    The prepared batch is kept while both are written. Batches land in folders
    named by their id, so a batch that is run again after a failure leaves no
    duplicates. While the clean rows are written, those that break the entity's
    expectations are counted; ``counts`` receives a row per batch and rule, under
    the same law.
    """
    flags = [rule.name for rule in entity.rules]

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_rejects(entity.prepare(batch), entity.rules).persist()
        try:
            kept = tagged.filter(F.col("_reject_reason").isNull()).drop("_reject_reason", *flags)
            observed = Observation(f"expectations of {entity.name}")
            if counts is not None:
                kept = observe_expectations(kept, entity.expectations, observed)
            write_batch(kept, clean, batch_id)
            write_batch(tagged.filter(F.col("_reject_reason").isNotNull()), quarantine, batch_id)
            if counts is not None:
                found = observed.get
                rows = [(e.name, found[e.name], found["total_records"]) for e in entity.expectations]
                write_batch(batch.sparkSession.createDataFrame(rows, COUNTS).coalesce(1), counts, batch_id)
        finally:
            tagged.unpersist()

    return (
        bronze.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
