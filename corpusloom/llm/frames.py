"""Passing whole rows through an Arrow function that adds one column."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Bytes of rows that Spark hands to an Arrow function at once, where ``small_batches`` was called.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands at most about ``BATCH_BYTES`` (a row at least) to Arrow functions at once.

    Spark's own limits, 10,000 rows and 64 MB, let batches of texts grow to tens of MB, and an executor holds several for
    each task: in the JVM's buffers, which double as they grow, and in the workers. A lower limit stays as it is.
    """
    now = spark.conf.get(_BATCH, None)
    if now is not None:
        now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)
    if now is None or not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with underscores behind it for as long as a column has it (in any case)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release() -> None:
    """Give memory that is free back to the system: workers outlive their tasks, and allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable) -> Callable:
    """The Arrow function, with its memory released at the end of a task."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return released


def add_column(frame: DataFrame, name: str, kind: str, text_col: str, make: Callable[[], Callable[..., pa.Array]], before: bool = False) -> DataFrame:
    """The frame with one more column, which ``make()(texts)`` gives for each batch of ``text_col``.

    With ``before`` the frame has the column already, and ``make()(texts, column)`` gives it anew.
    """
    schema = frame.schema if before else T.StructType([*frame.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    at = frame.columns.index(text_col)
    old = frame.columns.index(name) if before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add = None
        for batch in batches:
            add = add or make()
            if before:
                yield batch.set_column(old, name, add(batch.column(at), batch.column(old)))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, add(batch.column(at))], names=[*batch.schema.names, name])

    return frame.mapInArrow(lean(run), schema)
