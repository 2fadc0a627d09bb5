"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators count on. AQE coalesces small shuffle
# partitions, splits skewed join partitions and re-plans joins from real sizes.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode; wide stages
    # that would exceed it run much faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str, master: str | None = None, partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the runtime defaults, UTC clock and any extra settings.

    ``partitions`` is how many partitions a shuffle starts with. AQE merges small
    ones but splits only skewed joins, so take the largest shuffle divided by
    about 200 MB; Spark's own default is 200.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session somebody else built."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder:
    on a cluster, executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="larchfield-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/larchfield/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query run inside as soon as it ends.

    For writes, which run once. Otherwise the files lie on the executors' disks until
    the driver happens to collect the garbage that refers to them.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the scratch folder now and read it back.

    The written table survives lost executors, cuts lineage, and has an exact
    size: Catalyst broadcasts it when it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("errorifexists").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
