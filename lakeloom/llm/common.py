"""What the operators share: reading tables, tasks over Arrow batches and the memory they hold, and written tables."""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.sources.stage import new_path, shared_dir, written  # noqa: F401

T = TypeVar("T")
#: Rows of a batch. Texts are long and a batch is held several times on its way, so map_arrow sets fewer than Spark does, unless the session names a number.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, as new names; extra columns, whatever their names, never meet the operator's own."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


_HELD: dict[object, object] = {}


def held(key: object, build: Callable[[], T]) -> T:
    """What a worker built for the tasks it runs now. It holds one such thing at most; whatever else it held goes first."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def drop_held() -> None:
    _HELD.clear()


def release() -> None:
    """Gives unused memory back to the machine: workers outlive their tasks, and an executor's memory is that of all its workers."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only in glibc
        ctypes.CDLL(None).malloc_trim(0)


def drop_shuffles(spark: SparkSession) -> None:
    """Frees the disk of exchanges that no frame in use needs: Spark drops their files once the driver's JVM has collected what made them, which it seldom does by itself."""
    spark.sparkContext._jvm.System.gc()


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, holds: bool = False) -> DataFrame:
    """mapInArrow, after which a worker gives its memory back. Only functions that use held() `hold` what they built from task to task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            drop_held()
        yield from fn(batches)
        release()

    conf = df.sparkSession.conf
    if conf.get(BATCH, None) is None:
        conf.set(BATCH, "2000")
    return df.mapInArrow(run, schema)


def id_crc(doc_id: int | None) -> int:
    """crc32 of a doc_id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of every row; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
