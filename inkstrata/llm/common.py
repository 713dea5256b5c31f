"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest share of an Arrow batch that is held in Python form at once.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 512


_held: dict[str, Callable[[], object]] = {}
_owner: list[str] = []
_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory of this worker to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def hold(owner: str, release: Callable[[], object] | None = None) -> None:
    """Says that this Python worker now works for ``owner``.

    Workers outlive tasks and stages; what they remember for other operators is
    released, so that the memories of several stages do not add up, and what an
    operator has freed goes back to the system when another one begins.
    """
    for other in [name for name in _held if name != owner]:
        _held.pop(other)()
    if _owner != [owner]:
        give_back()
        _owner[:] = [owner]
    if release is not None:
        _held[owner] = release


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, whose worker gives its freed memory back at the end of a task, as it may wait long for the next one."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return released


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: few rows, and fewer where rows are long."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(most, rows * SLICE_BYTES // max(batch.nbytes, 1)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [text or "" for text in column.to_pylist()]


def schema_with(df: DataFrame, keep: list[str], more: str) -> T.StructType:
    """The kept fields of ``df`` and those of the DDL string ``more``."""
    return T.StructType([df.schema[name] for name in keep] + list(T.StructType.fromDDL(more)))


def hot_above(spark: SparkSession, rows: int) -> int:
    """The number of facts from which on a key is hot, of ``rows`` facts in all."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, rows // (4 * tasks))


def join_totals(facts: DataFrame, totals: DataFrame, key: str, count: str, rows: int) -> DataFrame:
    """``facts`` joined to ``totals``, one row a ``key`` with the number ``count`` of its facts.

    Keys that hold more than a quarter of a task's share of all ``rows`` facts are less
    than four for each task, by counting; they are broadcast, so that none of their facts
    is shuffled. All other keys are shuffled. ``facts`` are read twice.
    """
    hot = totals.where(F.col(count) > hot_above(facts.sparkSession, rows))
    rest = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(totals, key)
    return facts.join(F.broadcast(hot), key).unionByName(rest)
