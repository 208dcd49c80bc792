"""Row-local Python steps over Arrow batches of (id, text), without a shuffle."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[str | None], tuple]],
    result: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id`` and what ``make()(text)`` returns, for every row.

    ``make`` runs once per task, so it may build a model or a cache. Batches are cut by
    Spark's Arrow settings; one text and its result are the most that a batch adds.
    """
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = StructType([given.schema["doc_id"], *_parse_datatype_string(result).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in lightly(batches):
            rows = [step(text.as_py()) for text in batch.column(1)]
            columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), list(arrow)[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), *columns], schema=arrow)

    return given.mapInArrow(run, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside the block: rows with several whole texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def kept_in_worker(name: str, make: Callable):
    """What ``make()`` gives, built once per Python worker: Spark uses a worker for many tasks.

    Functions travel by value here, so the modules' own globals don't outlive a task. A worker
    keeps one thing: the next operator's takes the place of the last one's.
    """
    holder = sys.modules.setdefault("_tandemtext_worker", types.ModuleType("_tandemtext_worker"))
    if getattr(holder, "name", None) != name:
        nothing_kept()
        holder.name, holder.kept = name, make()
    return holder.kept


def nothing_kept() -> None:
    """Drops what an earlier operator left in this Python worker; for operators that keep nothing themselves.

    Else tables and caches of a hundred megabytes stay beside the work of all later stages. Those that refer to
    themselves go only when the collector runs.
    """
    holder = sys.modules.get("_tandemtext_worker")
    if getattr(holder, "name", None) is not None:
        holder.name = holder.kept = None
        gc.collect()
        hand_back()


def hand_back() -> None:
    """Gives the system what Arrow's pool and the C library hold free; else a worker stays as large as it ever was."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU's library has it
    if trim:
        trim(0)


def lightly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, whose memory goes back to the system: an idle worker holds no more than it keeps."""
    try:
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()
    finally:
        hand_back()


class Remembered(dict):
    """A dictionary that computes what it lacks and starts anew when it is full."""

    def __init__(self, compute: Callable, most: int) -> None:
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value
