"""Incremental article ingest: new files become numbered chunks, exactly once.

Chunks go on across micro-batches and runs. The sentences of the last, still open chunk of a batch, fewer than
a chunk has, are kept as state under the batch's id and stand in front of the next batch's; only whole chunks are published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.chunking import CHUNK_SIZE, assign_chunks
from ..operators.filters import filter_english
from ..plans.corpus import numbered_sentences

# After a batch: all sentences so far, and those of them that are in whole chunks.
STATE = "n_sentences BIGINT, n_closed BIGINT, size INT"
SENTENCES = "doc_id BIGINT, pos INT, sentence STRING, ordinal BIGINT"


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in (missing.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def _state_before(spark: SparkSession, path: str, batch_id: int) -> tuple[int | None, int, int | None]:
    """The last complete batch before this one, the sentences up to it and its chunk size.

    Batches follow one another, so it is nearly always the one before; only if that one has no state are others listed.
    """
    row = _existing(spark, f"{path}/state/batch_id={batch_id - 1}", STATE).first()
    if row:
        return batch_id - 1, row["n_sentences"], row["size"]
    states = _existing(spark, f"{path}/state", f"{STATE}, batch_id BIGINT").filter(F.col("batch_id") < batch_id)
    row = states.orderBy(F.desc("batch_id")).first()
    return (row["batch_id"], row["n_sentences"], row["size"]) if row else (None, 0, None)


def chunk_sink(
    path: str, size: int = CHUNK_SIZE, profile: str = "prod", keep: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that numbers the sentences of one micro-batch after all earlier ones.

    Whole chunks, the open chunk's sentences and the running totals are stored under the batch id and overwritten
    when the batch is replayed. A batch starts from the state of the one before only, so a replay writes the same rows
    again. The state is written last: it marks the batch as complete. A sink belongs to one stream, since batch ids
    start over with a new checkpoint, and to one chunk size.
    """
    keep = keep or (lambda sentences: filter_english(sentences, method="patterns"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous, before, used = _state_before(spark, path, batch_id)
        if used not in (None, size):
            raise ValueError(f"{path} has chunks of {used} sentences, not of {size}")
        numbered = numbered_sentences(batch, profile, keep)
        columns = [f.split()[0] for f in SENTENCES.split(", ")]
        fresh = numbered.withColumn("ordinal", F.col("ordinal") + F.lit(before)).select(*columns)
        carried = _existing(spark, f"{path}/open/batch_id={previous}", SENTENCES)
        total = before + numbered.count()
        closed = total - total % size
        rows = carried.select(*columns).unionByName(fresh)
        whole = assign_chunks(rows.filter(F.col("ordinal") <= closed), size)
        whole.write.mode("overwrite").parquet(f"{path}/sentences/batch_id={batch_id}")
        # Less than a chunk is left of the batch, which many tasks read; one file holds it.
        rows.filter(F.col("ordinal") > closed).repartition(1).write.mode("overwrite").parquet(f"{path}/open/batch_id={batch_id}")
        spark.createDataFrame([(total, closed, size)], STATE).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/state/batch_id={batch_id}"
        )

    return write


def ingest_articles(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    size: int = CHUNK_SIZE,
    profile: str = "prod",
    keep: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process the article files that are there now and stop; later runs take only new files."""
    reader = spark.readStream.schema(schemas.ARTICLES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(chunk_sink(sink, size, profile, keep))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, sink: str, with_open: bool = True) -> DataFrame:
    """Sentences with their chunk ids and the batch that published them, of complete batches only.

    ``with_open`` adds the sentences of the chunk that the next batch will fill up, as a short last chunk.
    """
    states = spark.read.schema(f"{STATE}, batch_id BIGINT").parquet(f"{sink}/state")
    chunked = f"{SENTENCES}, chunk_id BIGINT, line_no INT, batch_id BIGINT"
    whole = spark.read.schema(chunked).parquet(f"{sink}/sentences").join(states.select("batch_id"), "batch_id", "left_semi")
    last = states.orderBy(F.desc("batch_id")).first()
    if not with_open or last is None:
        return whole
    rows = spark.read.schema(SENTENCES).parquet(f"{sink}/open/batch_id={last['batch_id']}")
    open_chunk = assign_chunks(rows, last["size"]).withColumn("batch_id", F.lit(last["batch_id"]).cast("bigint"))
    return whole.unionByName(open_chunk)
