"""Vector bin packing of documents into shards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larchfield.llm.common import materialise

CELLS = 4096
HEAVY_PARTS = 1024
RANK_ROWS = 20_000


def pack_items(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Greedy vector bin packing: the shard of each item.

    Dimensions are scaled to a shard's equal share. Items are placed from the
    largest down; each goes where the dot product with the residual capacity is
    highest, ties to the lower shard. ``vectors`` has a bounded number of rows.
    """
    share = vectors.sum(axis=0) / shards
    scaled = vectors / np.where(share > 0, share, 1.0)
    residual = np.ones((shards, vectors.shape[1]))
    placed = np.zeros(len(vectors), np.int64)
    for item in np.argsort(-scaled.max(axis=1), kind="stable"):
        shard = int(np.argmax(residual @ scaled[item]))
        placed[item] = shard
        residual[shard] -= scaled[item]
    return placed


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, as binary."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def pack_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put every document into one of ``shards`` shards with near equal totals.

    Size is the text's UTF-8 bytes plus 1; bytes, whitespace tokens and rows are
    balanced together (law ``bytes``: byte totals near equal). Documents with
    equal texts form a group and go to one shard. A group with more than
    1/1024 of all bytes, tokens or rows stands for itself and is split by a hash
    of doc_id into parts of about that size, as no shard could hold a group with
    a third of all rows. All other groups are dealt by a hash into 4096 cells.
    Cells and parts are the items of the packing, so the driver sees at most
    4096 + 2 * 3 * 1024 rows at any input size.

    Returns doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each
    shard), grown_shard (null under this law) and tokens. Null and empty texts
    have size 1 and group together; a null doc_id is a value like any other;
    repeated rows are placed each on its own; an empty table gives no rows.
    Other columns of ``docs`` are ignored, whatever their names.
    """
    raw = text_bytes(F.col("text"))
    rows = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.unhex(F.md5(raw)).alias("digest"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")).cast("long").alias("tokens"),
        ).withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(CELLS)).cast("int")),
        "shard-rows",
    )
    return place(rows, shards)


def place(rows: DataFrame, shards: int) -> DataFrame:
    spark = rows.sparkSession
    sums = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")]
    groups = materialise(rows.groupBy("digest", "cell").agg(*sums), "shard-groups")
    total = groups.agg(*(F.sum(c).alias(c) for c in "btr")).first()
    limits = [max(1, (total[c] or 0) // HEAVY_PARTS) for c in "btr"]
    parts = F.greatest(
        *(F.ceil(F.col(c) / F.lit(limit)) for c, limit in zip("btr", limits, strict=True))
    )
    # At most 3 * 1024 groups can exceed 1/1024 of a total. Single rows are not split.
    heavy = (
        groups.withColumn("parts", F.least(parts, F.col("r")).cast("int"))
        .where((F.col("parts") > 1))
        .select("digest", "parts")
    )
    salted = rows.join(F.broadcast(heavy), "digest", "left").withColumn(
        "part",
        F.when(
            F.col("parts").isNotNull(),
            F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("parts")).cast("int"),
        ).otherwise(-1),
    )
    key = F.when(F.col("part") < 0, F.col("cell")).otherwise(
        -1 - F.pmod(F.xxhash64("digest", "part"), F.lit(2**62))
    )
    salted = salted.withColumn("item", key.cast("long"))
    items = salted.groupBy("item").agg(*sums).orderBy("item").collect()
    vectors = np.array([[x["b"], x["t"], x["r"]] for x in items], float).reshape(-1, 3)
    chosen = pack_items(vectors, shards) if len(items) else []
    where = spark.createDataFrame(
        [(int(x["item"]), int(s)) for x, s in zip(items, chosen, strict=True)],
        T.StructType([T.StructField("item", T.LongType()), T.StructField("shard", T.IntegerType())]),
    )
    placed = salted.join(F.broadcast(where), "item").select(
        "doc_id", "size", "text_crc32", "tokens", "shard"
    )
    return with_slots(placed, int(total["r"] or 0)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def with_slots(placed: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0 without ordering a whole shard.

    Rows are dealt by a hash into buckets of about 20,000; only bucket counts
    are summed along a shard. Rows equal in every column are interchangeable.
    """
    from pyspark.sql.window import Window

    buckets = max(1, count // RANK_ROWS)
    dealt = placed.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(3)), F.lit(buckets))
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", (F.col("base") + F.col("at")).cast("long"))
    )
