"""Chunk, pair, manifest and result files."""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import strip
from ..operators.chunking import reread_lines
from ..operators.ordinal import whole_div
from ..session import stage

CHUNKS_PER_BUCKET = 100_000


def write_chunks(chunked: DataFrame, path: str, chunks_per_bucket: int = CHUNKS_PER_BUCKET, run_id: str = "0") -> None:
    """Chunk rows as Parquet in folders of neighbouring chunk ids, so one chunk is found without a full scan.

    Each run has a folder of its own, which a repeated run writes anew.
    """
    path = f"{path}/run_id={run_id}"
    bucket = whole_div(F.col("chunk_id") - 1, chunks_per_bucket)
    chunked.withColumn("chunk_bucket", bucket).write.mode("overwrite").partitionBy("chunk_bucket").parquet(path)


def read_chunks(
    spark: SparkSession, path: str, chunk_ids: tuple[int, int] | None = None, chunks_per_bucket: int = CHUNKS_PER_BUCKET
) -> DataFrame:
    """Written chunks, optionally only an id range (inclusive); its buckets are pruned."""
    df = spark.read.parquet(path)
    if chunk_ids:
        low, high = chunk_ids
        df = df.filter(
            F.col("chunk_bucket").between((low - 1) // chunks_per_bucket, (high - 1) // chunks_per_bucket)
            & F.col("chunk_id").between(low, high)
        )
    return df.drop("chunk_bucket", "run_id")


SOURCE, TRANSLATED = "source", "translated"


def export_chunk_text(
    packed: DataFrame,
    path: str,
    column: str = "sentences",
    kind: str = SOURCE,
    chunk_ids: tuple[int, int] | None = None,
    chunks_per_bucket: int = CHUNKS_PER_BUCKET,
    mode: str = "errorifexists",
) -> None:
    """Chunks as text files in folders ``kind=.../chunk_bucket=...``: for tools that read plain files.

    A line is the chunk's id, a tab and a sentence on one line. ``chunk_ids`` exports an id range (inclusive).
    """
    if kind not in (SOURCE, TRANSLATED):
        raise ValueError(f"unknown kind {kind!r}")
    if chunk_ids:
        packed = packed.filter(F.col("chunk_id").between(*chunk_ids))
    bucket = whole_div(F.col("chunk_id") - 1, chunks_per_bucket).alias("chunk_bucket")
    lines = packed.select("chunk_id", bucket, F.explode(reread_lines(column)).alias("_line"))
    value = F.concat(F.col("chunk_id").cast("string"), F.lit("\t"), F.col("_line"))
    rows = lines.select(F.lit(kind).alias("kind"), "chunk_bucket", value.alias("value"))
    rows.write.mode(mode).partitionBy("kind", "chunk_bucket").text(path)


def read_exported_text(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, kind, line_no, line) of what ``export_chunk_text`` wrote; a chunk is bounded by the chunk size."""
    raw = spark.read.option("basePath", path).text(path).select(
        "kind",
        F.regexp_extract("value", r"^(\d+)\t", 1).cast("bigint").alias("chunk_id"),
        F.regexp_replace("value", r"^\d+\t", "").alias("line"),
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_r"),
    )
    order = Window.partitionBy("kind", "chunk_id").orderBy("_f", "_b", "_r")
    return raw.select("chunk_id", "kind", F.row_number().over(order).alias("line_no"), "line")


def read_chunk_text(
    spark: SparkSession, path: str, number: str = r"chunk(?:_id=|_)(\d+)", files: str = "*.txt", translated: str = r"^translated_"
) -> DataFrame:
    """Non-blank, stripped lines of chunk text files: (chunk_id, kind, line_no, line).

    The chunk id is the last number in the path, files without one are none; the kind comes from the file's
    name, so source and translated chunks may share a folder. Lines of one chunk keep their order; a chunk is
    bounded by the chunk size.
    """
    found = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit(number))
    raw = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter=files).select(
        F.try_element_at(found, F.lit(-1)).cast("bigint").alias("chunk_id"),
        F.when(F.regexp_like("_metadata.file_name", F.lit(translated)), TRANSLATED).otherwise(SOURCE).alias("kind"),
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_r"),
        strip("value").alias("line"),
    )
    order = Window.partitionBy("chunk_id", "kind").orderBy("_f", "_b", "_r")
    return raw.filter("line <> '' and chunk_id is not null").select(
        "chunk_id", "kind", F.row_number().over(order).alias("line_no"), "line"
    )


def read_pairs_jsonl(spark: SparkSession, path: str, source_field: str = "source_text") -> DataFrame:
    """Sentence pairs, one JSON object per line; blank lines are skipped, a bad line fails the read."""
    schema = T.StructType.fromDDL(schemas.PAIRS)
    for field in schema.fields:
        if field.name == "source_text":
            field.name = source_field
    schema = T.StructType(list(schema.fields))
    read = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return read.withColumnRenamed(source_field, "source_text")


def write_extracted_sentences(extracted: DataFrame, path: str, mode: str = "append") -> None:
    """Sentences with their sequence ids as they were before any language filter."""
    extracted.select("seq_id", "doc_id", "sentence").write.mode(mode).parquet(path)


def _write_lines(df: DataFrame, path: str, order: list[str], mode: str) -> None:
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_pairs_jsonl(pairs: DataFrame, path: str, source_field: str = "source_text", mode: str = "errorifexists") -> None:
    """Pairs in sequence order over the written files, text unescaped."""
    _write_lines(pairs.withColumnRenamed("source_text", source_field), path, ["seq_id"], mode)


def write_article_pairs(pairs: DataFrame, path: str, source_field: str = "source_text", mode: str = "errorifexists") -> None:
    _write_lines(
        pairs.withColumnRenamed("source_text", source_field), path, ["article_index", "sentence_index"], mode
    )


def default_pairs_path(input_path: str) -> str:
    """``translated_<stem>.jsonl`` beside the input."""
    folder, name = posixpath.split(input_path)
    return posixpath.join(folder, f"translated_{name.rsplit('.', 1)[0]}.jsonl")


def write_batch_manifests(manifest: DataFrame, path: str, created_at: Column, mode: str = "errorifexists") -> None:
    """One folder per batch, empty batches included."""
    stamped = manifest.withColumn("created_at", created_at.cast("timestamp"))
    stamped.write.mode(mode).partitionBy("batch_number").json(path)


def write_spot_check(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    results.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _write_framed(elements: DataFrame, path: str, head: str, tail: str, mode: str) -> None:
    """JSON element texts (column ``value``), one per line between ``head`` and ``tail`` in every file.

    Every element but a partition's first has a comma in front. Head and tail are rows of their own: each
    partition gets one of both and is put in order, without any Python.
    """
    placed = elements.select(
        F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_r"), F.col("value").cast("string").alias("value")
    )
    held = stage(placed, "elements")
    parts = held.groupBy("_p").agg(F.min("_r").alias("_first"))
    # An empty table still is one file.
    none = held.sparkSession.range(1).select(F.lit(0).alias("_p"), F.lit(0).cast("bigint").alias("_first"))
    parts = parts.unionByName(none.join(held.limit(1).select(F.lit(1).alias("_some")), F.lit(True), "left_anti"))
    first = F.broadcast(parts)  # one row per partition
    value = F.when(F.col("_r") > F.col("_first"), F.concat(F.lit(","), "value")).otherwise(F.col("value"))
    body = held.join(first, "_p").select("_p", F.lit(1).alias("_k"), "_r", value.alias("value"))
    frame = F.explode(F.array(F.struct(F.lit(0).alias("_k"), F.lit(head).alias("value")), F.struct(F.lit(2).alias("_k"), F.lit(tail).alias("value"))))
    ends = parts.select("_p", frame.alias("_e")).select("_p", "_e._k", F.lit(0).cast("bigint").alias("_r"), "_e.value")
    count = max(1, parts.count())
    # Partitions keep their numbers, so none is split or merged.
    numbered = F.dense_rank().over(Window.orderBy("_p")) - 1
    places = F.broadcast(parts.select("_p", numbered.alias("_to")))
    rows = body.unionByName(ends).join(places, "_p").repartitionById(count, F.col("_to"))
    rows.sortWithinPartitions("_to", "_k", "_r").select("value").write.mode(mode).text(path)


def write_json_arrays(elements: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON texts as array files: one array per written file, one element per line."""
    _write_framed(elements, path, "[", "]", mode)


def write_manifest_json(manifest: DataFrame, path: str, mode: str = "errorifexists", run_ts: str | None = None) -> None:
    """Chunk entries as JSON manifests: one object per written file, one entry per line.

    ``run_ts``, an ISO time, goes into the metadata as the time of creation and of the last change.
    """
    fields = [c for c in manifest.columns if c != "chunk_id"]
    entry = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    keyed = manifest.select(F.concat(F.lit('"'), F.col("chunk_id").cast("string"), F.lit('": '), entry).alias("value"))
    metadata = json.dumps({"created_at": run_ts, "last_updated": run_ts} if run_ts else {})
    _write_framed(keyed, path, '{\n"chunks": {', f'}},\n"metadata": {metadata}\n}}', mode)
