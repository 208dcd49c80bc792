"""Mapping sentences through an outside translator, with retries.

The translator is the caller's: ``make_translator()`` is called once per task
and returns a function from text to text. The policy around it is what is
built here. Calls are dear and need not repeat themselves, so write the result
(``stage`` or a table) before using it twice.
"""

from __future__ import annotations

import re
import time
import uuid
from datetime import datetime, timezone
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.text import SPACE_CHARS, head
from ..session import scratch_path, stage
from ..sources.progress import append_entry, compact, latest, read_entries
from .lookup import salted_left_join
from .ordinal import whole_div, with_ordinal

DELAY = 2.5
RETRIES = 3
STRICT, KEEP_SOURCE = "strict", "keep_source"

Translator = Callable[[str], str | None]


def _attempt(call: Translator, text: str, policy: str, delay: float, retries: int) -> tuple:
    """One sentence through the policy: (translated, ok, attempts, error)."""
    error = None
    for attempt in range(1, retries + 1):
        if delay:
            time.sleep(delay)
        try:
            result = call(text)
        except Exception as exc:  # whatever the caller's client raises
            error = str(exc)
        else:
            if policy == KEEP_SOURCE:
                # An empty string is an answer, no result at all is not.
                return (text, True, attempt, "empty result") if result is None else (result, True, attempt, None)
            if not result:
                error = "empty result"
            elif result.strip(SPACE_CHARS) == text.strip(SPACE_CHARS):
                error = "unchanged"
            else:
                return (result, True, attempt, None)
        if delay and attempt < retries:
            time.sleep(delay * attempt)
    if policy == KEEP_SOURCE:
        return (text, True, retries, error)
    return (None, False, retries, error)


# About as many bytes of rows become Python objects at a time.
BYTES_AT_ONCE = 1 << 20


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about ``BYTES_AT_ONCE``, so that a task's memory doesn't follow the number of its rows."""
    for batch in batches:
        step = max(1, batch.num_rows * BYTES_AT_ONCE // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _columns(rows: list[tuple], fields: list[pa.Field]) -> list[pa.Array]:
    return [pa.array(values, field.type) for values, field in zip(zip(*rows), fields)]


def apply_translator(
    df: DataFrame,
    make_translator: Callable[[], Translator],
    col: str = "line",
    policy: str = STRICT,
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
) -> DataFrame:
    """Add ``translated, ok, attempts, error`` to every row.

    ``strict``: an exception, an empty or an unchanged result is tried again; after
    the last try the row fails and never carries its source text. ``keep_source``:
    only exceptions are tried again, otherwise the source text stands in.

    Each task pauses ``delay`` seconds before a call, so the overall rate is
    tasks / delay; ``workers`` sets the number of tasks to respect a rate limit.
    """
    if policy not in (STRICT, KEEP_SOURCE):
        raise ValueError(f"unknown policy {policy!r}")
    if retries < 1:
        raise ValueError("retries must be >= 1")
    added = T.StructType.fromDDL(schemas.TRANSLATION)

    names, fields = df.columns + added.fieldNames(), list(to_arrow_schema(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make_translator()
        for batch in _small(batches):
            rows = [_attempt(call, text, policy, delay, retries) for text in _column(batch, col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *_columns(rows, fields)], names=names)

    spread = df.repartition(workers) if workers else df
    mapped = spread.mapInArrow(run, T.StructType(df.schema.fields + added.fields))
    return mapped.withColumn("error", F.when(F.col("error").isNotNull(), F.concat(F.col("error"), F.lit(": "), head(col, 50))))


def memory_translation(lines: DataFrame, memory: DataFrame, keys: list[str], col: str = "line") -> DataFrame:
    """Translate from a table ``memory(source_text, translated)``; a miss is a failure.

    One hit per text: of several, the smallest translation. Joined on the text
    itself; a text that fills much of the corpus is salted. ``lines`` are evaluated twice: write them first if they are dear.
    """
    best = memory.groupBy(F.col("source_text").alias(col)).agg(F.min("translated").alias("translated"))
    joined = salted_left_join(lines, best, [col], keys)
    return joined.withColumn("ok", F.col("translated").isNotNull() & (F.col("translated") != ""))


def atomic_chunks(lines: DataFrame) -> DataFrame:
    """Chunks in which every line succeeded; one failure voids its chunk, others go on."""
    good = F.bool_and(F.coalesce("ok", F.lit(False)))
    entries = F.sort_array(F.collect_list(F.struct("line_no", "line", "translated")))
    return (
        lines.groupBy("chunk_id")
        .agg(good.alias("_ok"), entries.alias("_lines"))
        .filter("_ok")
        .select(
            "chunk_id",
            F.transform("_lines", lambda e: e["line"]).alias("source_lines"),
            F.transform("_lines", lambda e: e["translated"]).alias("translated_lines"),
        )
    )


_BREAKS = re.compile(r"\r\n|\r|\n")


def _reread(lines: list[str]) -> list[str]:
    """What reading written lines back yields: non-blank lines, stripped."""
    cut = (part.strip(SPACE_CHARS) for line in lines for part in _BREAKS.split(line))
    return [line for line in cut if line]


def _translate_chunk(call: Translator, lines: list[str], delay: float, retries: int) -> tuple:
    """A chunk up to its first failure: (translated lines or None, ok, calls, error, pairs)."""
    done, calls = [], 0
    for line in lines:
        translated, ok, attempts, error = _attempt(call, line, STRICT, delay, retries)
        calls += attempts
        if not ok:
            return None, False, calls, f"{error}: {line[:50]}", 0
        done.append(translated)
    both = list(zip(_reread(lines), _reread(done)))
    return done, True, calls, None, 0 if any(a == b for a, b in both) else len(both)


def translate_chunks(
    packed: DataFrame,
    make_translator: Callable[[], Translator],
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
) -> DataFrame:
    """Strictly translate whole chunks, giving up a chunk at its first failed line.

    ``packed(chunk_id, lines)`` has one chunk per row, so no shuffle is needed to
    keep a chunk whole and no call is made after a failure. The result is written at once:
    ``(chunk_id, lines, translated_lines, ok, attempts, error, part, before, pairs)``. A chunk that is
    done has as many ``pairs`` as both its sides have lines when read back, none if any of them are
    the same; ``before`` counts those of earlier chunks in the same ``part``. Where ``packed`` is in
    order by range, as from ``pack_chunks``, parts and their rows are too.
    """
    schema = (
        "chunk_id BIGINT, lines ARRAY<STRING>, translated_lines ARRAY<STRING>, ok BOOLEAN, attempts INT, error STRING, "
        "part INT, before BIGINT, pairs INT"
    )

    fields = list(to_arrow_schema(T.StructType.fromDDL(schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, part, before = make_translator(), TaskContext.get().partitionId(), 0
        for batch in _small(batches):
            rows = []
            for lines in _column(batch, "lines"):
                done, ok, calls, failure, pairs = _translate_chunk(call, lines, delay, retries)
                rows.append((done, ok, calls, failure, part, before, pairs))
                before += pairs
            yield pa.RecordBatch.from_arrays([*batch.columns, *_columns(rows, fields[2:])], schema=pa.schema(fields))

    source = packed.select("chunk_id", "lines")
    if workers:
        source = source.repartitionByRange(workers, "chunk_id").sortWithinPartitions("chunk_id")
    return stage(source.mapInArrow(run, schema), "translated-chunks")


RESULT = (
    "chunk_id BIGINT, lines ARRAY<STRING>, translated_lines ARRAY<STRING>, ok BOOLEAN, attempts INT, error STRING, "
    "pairs INT, finished_at TIMESTAMP"
)
# Tasks of one job; more chunks are dealt into several.
MOST_TASKS = 10_000


def translate_durably(
    packed: DataFrame,
    make_translator: Callable[[], Translator],
    folder: str,
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
    chunks_per_task: int = 1,
) -> DataFrame:
    """As ``translate_chunks``, kept below ``folder`` as tasks finish; chunks that are finished there are not translated again.

    The folder survives executors and the driver: a run that is started again with the same folder calls the
    translator only for chunks without a finished result, failed ones included, and so do several runs at a time,
    but for what they do simultaneously. At most ``chunks_per_task`` chunks of each running task are lost. ``workers`` is the number
    of tasks that may run at once, in waves; without it the cluster decides. Returns ``read_results``.
    Turn speculative execution off: it pays for calls twice.
    """
    spark, entry = packed.sparkSession, uuid.uuid4().hex
    fields = list(to_arrow_schema(T.StructType.fromDDL(RESULT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make_translator()
        for batch in _small(batches):
            rows = [(*_translate_chunk(call, lines, delay, retries), datetime.now(timezone.utc)) for lines in _column(batch, "lines")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *_columns(rows, fields[2:])], schema=pa.schema(fields))

    open_chunks = packed.select("chunk_id", "lines").join(finished_chunks(spark, folder), "chunk_id", "left_anti")
    numbered = with_ordinal(open_chunks, ["chunk_id"], "_nr", start=0)
    n, wave = numbered.count(), (workers or MOST_TASKS) * chunks_per_task
    if n > wave:
        # A folder for each wave, which reads nothing else.
        waves = scratch_path(spark, "waves")
        numbered.withColumn("_wave", whole_div("_nr", wave)).write.partitionBy("_wave").parquet(waves)
    for low in range(0, n, wave):
        tasks = -(-min(wave, n - low) // chunks_per_task)
        place = whole_div(F.col("_nr") - F.lit(low), chunks_per_task).cast("int")
        here = spark.read.schema(numbered.schema).parquet(f"{waves}/_wave={low // wave}") if n > wave else numbered
        dealt = here.repartitionById(tasks, place)
        results = dealt.select("chunk_id", "lines").mapInArrow(run, RESULT)
        append_entry(results, folder, entry, as_tasks_finish=True, last=low + wave >= n)
    return read_results(spark, folder)


def _best_results(rows: DataFrame) -> DataFrame:
    """The first finished result of a chunk, so later ones change nothing; without one, the last failure."""
    at = F.unix_micros("finished_at")
    return latest(rows, "chunk_id", [~F.col("ok"), F.when(F.col("ok"), at).otherwise(-at), F.col("_file")])


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """One row per chunk that any run below ``folder`` has worked on, with the columns of ``RESULT``."""
    return _best_results(read_entries(spark, folder, RESULT)).drop("entry", "_file")


def finished_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return read_entries(spark, folder, RESULT).filter("ok").select("chunk_id").distinct()


def compact_results(spark: SparkSession, folder: str, idle: bool = False) -> int:
    """Merge the small files of finished runs; see ``progress.compact``."""
    return compact(spark, folder, RESULT, _best_results, idle)
