"""Raw CSV and JSON files, read as text columns with provenance.

The files of one entity come from systems that name and order columns
differently. All of them are read as lines that carry the full path of their
file. A CSV line is parsed by the header of its own file, a JSON line by its own
keys, so neither folders nor file names decide how a row is read.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larchfield.session import materialise

RESCUED = "_rescued_data"
PROVENANCE = ("_source_file", "_load_timestamp", RESCUED)


def any_case(name: str, suffix: str) -> str:
    """Glob for files whose name starts with ``name`` in any letter case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in name) + f"*.{suffix}"


def _lines(spark: SparkSession, base: str, glob: str, stream: bool = False, **options: str) -> DataFrame:
    """Lines of all files below ``base`` that match ``glob``, each with the path of its file."""
    reader = (spark.readStream if stream else spark.read).format("text")
    found = reader.options(pathGlobFilter=glob, recursiveFileLookup="true", **options).load(base)
    return found.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("_source_file"),
    )


def _filled(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(F.trim("value")) > 0)


def file_headers(lines: DataFrame) -> DataFrame:
    """The first line of each file that is not blank: path and header.

    One row per file leaves the tasks: the least (block, place in the task).
    """
    placed = _filled(lines).select("path", "block", F.monotonically_increasing_id().alias("place"), "value")
    first = placed.groupBy("path").agg(F.min(F.struct("block", "place", "value")).alias("first"))
    return first.select("path", F.col("first.value").alias("header"))


class Names:
    """Column names without regard to case; the spelling met first stays."""

    def __init__(self, known: Iterable[str] = ()) -> None:
        self.spelling = {name.lower(): name for name in known}

    def add(self, name: str) -> str:
        """The key of a column in a file. Names of provenance columns are set apart."""
        if name.lower() in {*PROVENANCE, "batch_id"}:
            name = f"{name}_in_file"
        self.spelling.setdefault(name.lower(), name)
        return name.lower()

    def project(self, sources: dict[str, list[Column]], rescue: str | None) -> list[Column]:
        columns = [
            (F.coalesce(*sources[key]) if key in sources else F.lit(None).cast("string")).alias(name)
            for key, name in self.spelling.items()
        ]
        columns += [F.col("_source_file"), F.current_timestamp().alias("_load_timestamp")]
        return columns + ([F.col("_rescued").alias(rescue)] if rescue else [])


def parse_csv(lines: DataFrame, names: Names, rescue: str | None = RESCUED) -> DataFrame:
    """CSV lines as text columns, each parsed by the header of its own file.

    The header is the first line that is not blank; a later line equal to it is a
    header again and no row. Columns of a header that are equal up to case become
    one with the first non-NULL value; nameless ones are called ``_c`` and their
    place. A row with more or fewer values than names keeps its line in ``rescue``.

    The driver sees the distinct headers, not the files. The table (path, header)
    is written down; Catalyst broadcasts it only below its size limit.
    """
    headers = materialise(file_headers(lines), "file-headers")
    layouts = sorted(row.header for row in headers.select("header").distinct().collect())
    rows = _filled(lines).join(headers, "path").where("value <> header")
    parsed, sources, rescued = [], {}, [F.lit(None).cast("string")]
    for number, header in enumerate(layouts):
        titles = next(csv.reader([header.lstrip("﻿")]))
        schema = ", ".join([*(f"slot_{i} string" for i in range(len(titles))), "rescued string"])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "rescued"}
        as_row = F.from_csv("value", schema, options)
        parsed.append(F.when(F.col("header") == header, as_row).alias(f"layout_{number}"))
        for i, title in enumerate(titles):
            key = names.add(title or f"_c{i}")
            sources.setdefault(key, []).append(F.col(f"layout_{number}.slot_{i}"))
        rescued.append(F.col(f"layout_{number}.rescued"))
    split = rows.select("_source_file", *parsed).withColumn("_rescued", F.coalesce(*rescued))
    return split.select(*names.project(sources, rescue))


def parse_json(lines: DataFrame, names: Names, rescue: str | None = RESCUED) -> DataFrame:
    """JSON lines as text columns, with keys compared without regard to case.

    A line holds an object or a list of objects. Of keys equal up to case the first
    non-NULL value counts, in the order of their spellings. A line or member that is
    no object is kept in ``rescue``. The driver sees the distinct keys, as in
    schema inference.
    """
    record = "map<string,string>"
    listed = F.trim("value").startswith("[")
    members = F.when(listed, F.from_json("value", f"array<{record}>")).otherwise(
        F.array(F.from_json("value", record))
    )
    rows = _filled(lines).select("_source_file", "value", F.explode_outer(members).alias("record"))
    keys = rows.select(F.explode(F.map_keys("record")).alias("key")).distinct()
    sources: dict[str, list[Column]] = {}
    for spelling in sorted(row.key for row in keys.collect()):
        sources.setdefault(names.add(spelling), []).append(F.col("record").getItem(spelling))
    rescued = F.when(F.col("record").isNull(), F.col("value")).alias("_rescued")
    return rows.select("_source_file", "record", rescued).select(*names.project(sources, rescue))


PARSERS = {"csv": parse_csv, "json": parse_json}


def read_files(
    spark: SparkSession, base: str, fmt: str, glob: str, rescue: str | None = RESCUED
) -> DataFrame:
    """All files of one entity as text columns plus provenance.

    Columns are the union over all files, by name without regard to case; a file
    without a column has NULL there.
    """
    lines = _lines(spark, base, glob)
    if lines.isEmpty():
        raise FileNotFoundError(f"no file with lines matches {glob} below {base}")
    return PARSERS[fmt](lines, Names(), rescue)


def ingest_new_files(
    spark: SparkSession,
    base: str,
    fmt: str,
    glob: str,
    target: str,
    checkpoint: str,
    rescue: str | None = RESCUED,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Append all files not seen before to the table at ``target`` and return the table.

    One stream per entity, which reads new files only and knows them by full path.
    Each micro-batch is written to a folder named by its id, and so are the columns
    it met for the first time; a batch run again replaces itself. New columns are
    NULL in older rows.
    """
    limit = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}

    def load(batch: DataFrame, batch_id: int) -> None:
        known = _known_columns(batch.sparkSession, target, before=batch_id)
        names = Names(known)
        rows = PARSERS[fmt](batch, names, rescue)
        added = list(names.spelling.values())[len(known) :]
        if added:
            listed = [(len(known) + i, name) for i, name in enumerate(added)]
            columns = batch.sparkSession.createDataFrame(listed, "place int, name string").coalesce(1)
            columns.write.mode("overwrite").parquet(f"{target}/columns/batch_id={batch_id}")
        rows.write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")

    (
        _lines(spark, base, glob, stream=True, **limit)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return read_bronze(spark, target, rescue)


def _known_columns(spark: SparkSession, target: str, before: int | None = None) -> Sequence[str]:
    """Names stored beside the table, in the order met; none for a new table."""
    try:
        stored = spark.read.schema("place int, name string, batch_id long").parquet(f"{target}/columns")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if before is not None:
        stored = stored.where(F.col("batch_id") < before)
    return [row.name for row in stored.orderBy("place").collect()]


def read_bronze(spark: SparkSession, target: str, rescue: str | None = RESCUED) -> DataFrame:
    """The table that ``ingest_new_files`` fills, by its stored columns."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _known_columns(spark, target)])
    schema = schema.add("_source_file", "string").add("_load_timestamp", "timestamp")
    schema = schema.add(rescue, "string") if rescue else schema
    return spark.read.schema(schema).parquet(f"{target}/rows").drop("batch_id")
