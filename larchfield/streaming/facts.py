"""Facts from a stream joined with published snapshots of dimensions.

A dimension is published as a numbered snapshot that never changes afterwards.
Each micro-batch pins the newest snapshots before it reads them, so a batch that
is run again joins the same versions, whatever has been published since.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larchfield.sources.tables import is_written, read_or_none
from larchfield.streaming.split import write_batch

Facts = Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]
PINS = "dimension string, version long"


def publish_dim(dim: DataFrame, path: str, version: int) -> None:
    """Write a snapshot, then make its number known. Numbers must rise."""
    dim.write.mode("overwrite").parquet(f"{path}/rows/version={version}")
    known = dim.sparkSession.createDataFrame([(version,)], "version long").coalesce(1)
    known.write.mode("overwrite").parquet(f"{path}/published/{version}")


def newest_version(spark: SparkSession, path: str) -> int:
    published = read_or_none(spark, f"{path}/published/*", "version long")
    newest = None if published is None else published.agg(F.max("version")).first()[0]
    if newest is None:
        raise ValueError(f"no snapshot published at {path}")
    return newest


def read_dim(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/rows/version={version}")


def pinned_versions(spark: SparkSession, pins: str, dims: Mapping[str, str], batch_id: int) -> dict[str, int]:
    """The snapshot of each dimension that the batch joins; chosen once and kept."""
    path = f"{pins}/batch_id={batch_id}"
    if not is_written(spark, path):
        rows = [(name, newest_version(spark, folder)) for name, folder in dims.items()]
        spark.createDataFrame(rows, PINS).coalesce(1).write.mode("overwrite").parquet(path)
    return {row.dimension: row.version for row in spark.read.schema(PINS).parquet(path).collect()}


def write_facts(
    batch: DataFrame, batch_id: int, dims: Mapping[str, str], build: Facts, target: str
) -> None:
    """Join one micro-batch with its pinned snapshots and write it to its own folder."""
    spark = batch.sparkSession
    versions = pinned_versions(spark, f"{target}-pins", dims, batch_id)
    frames = {name: read_dim(spark, dims[name], version) for name, version in versions.items()}
    write_batch(build(batch, frames), target, batch_id)


def stream_facts(
    rows: DataFrame, dims: Mapping[str, str], build: Facts, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the facts of every micro-batch that is available now.

    ``dims`` names the folders of published dimensions; ``build`` makes facts of a
    batch and the dimensions by name.
    """
    return (
        rows.writeStream.foreachBatch(lambda batch, i: write_facts(batch, i, dims, build, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
