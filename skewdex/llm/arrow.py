"""Small helpers for operators whose row work runs in Arrow batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The code travels with the tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows are handed back in batches of about this many bytes, whatever the number of rows.
BATCH_BYTES = 8 << 20


class Rows:
    """Collects result rows by column and hands them out in batches of bounded size."""

    def __init__(self, schema: pa.Schema, batch_bytes: int = BATCH_BYTES):
        self.schema, self.batch_bytes = schema, batch_bytes
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, *values, size: int = 64) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.size += size

    def full(self) -> bool:
        return self.size >= self.batch_bytes

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self._clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def release() -> None:
    """Give back what is free: the worker waits for its next task without it, beside those of other cores."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps up to 64 MB
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, whose memory is given back when it has ended and nothing of it is held any more."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return through


def map_rows(df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable], *, size: int = 64) -> DataFrame:
    """Run ``step(emit, *row)`` over every row of ``df``, as Arrow batches.

    ``make`` is called once per task and returns ``step``; ``emit(*values, size=bytes)`` adds
    a row of the result. An optional attribute ``step.close(emit)`` is called at the end. Both
    may be generators, so that rows leave the task while they go on.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, step = Rows(out), make()

        def emit(*values, size=size):
            rows.add(*values, size=size)

        def batches_of(work) -> Iterator[pa.RecordBatch]:
            for _ in work if work is not None else ():  # a generator hands its rows out as it goes
                if rows.full():
                    yield rows.take()
            if rows.full():
                yield rows.take()

        for batch in batches:
            for at in range(batch.num_rows):
                yield from batches_of(step(emit, *(column[at].as_py() for column in batch.columns)))
        if close := getattr(step, "close", None):
            yield from batches_of(close(emit))
        if rows.size:
            yield rows.take()

    return df.mapInArrow(released(run), schema)


def kept(key: tuple, build: Callable):
    """What ``build`` returns, made once per Python worker and kept for its later tasks."""
    store = vars(sys).setdefault("_kept_by_worker", {})
    if key not in store:
        store[key] = build()
    return store[key]


def task_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
