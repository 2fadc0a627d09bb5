"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larchfield.session import apply_runtime_defaults, materialise, scratch_path, scratch_root

T = TypeVar("T")

__all__ = ["batches_of", "free_name", "materialise", "scratch_path", "scratch_root", "table", "text_buffer", "tuned", "worker_state"]


#: Rows that go to a Python worker at a time. Texts make rows wide, and a batch is held on both sides.
ARROW_ROWS = 1000


def tuned(spark: SparkSession) -> SparkSession:
    """The runtime defaults and small Arrow batches, on a session somebody else built."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return apply_runtime_defaults(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict = {}


def worker_state(owner: object, make: Callable[[], T] = lambda: None) -> T:
    """What an operator keeps in a Python worker from task to task.

    A worker serves one operator after the other, so it keeps one owner's state:
    the next owner's call drops what the one before has left, and hands freed
    memory back.
    """
    if _KEPT.get("owner") != owner:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT.update(owner=owner, value=make())
    return _KEPT["value"]


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it until no column has it, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def batches_of(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2_000_000
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each.

    A single longer value stays whole in a batch of its own.
    """
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(column)))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            floor = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, floor + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(values: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(values.buffers()[1], kind) if values.buffers()[1] else np.zeros(1, kind)
    return raw[values.offset : values.offset + len(values) + 1].astype(np.int64)


def text_buffer(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and the start of each row with a final end.

    Nulls count as empty.
    """
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if values.null_count:
        values = values.fill_null("")
    offsets = _offsets(values)
    data = values.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]
