"""Fixed-size chunks, their manifest, and resuming."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_lines
from .ordinal import whole_div, with_ordinal

CHUNK_SIZE = 100


# Ids are counted in this many ranges at a time.
RANGES = 1024


def _nth_text(ids: DataFrame, n: int) -> tuple[str | None, int]:
    """The n-th of the texts in column ``id``, all different, and how many there are; the last one if they are fewer.

    Ids are counted by the character after what all that remain begin with, and only those of the
    character that the n-th has remain. Each step is one map-side combined count, with as many groups as there are characters.
    """
    prefix, before, known = "", 0, None
    rest = ids.filter("id IS NOT NULL")
    while True:
        place = F.substring("id", len(prefix) + 1, 1).alias("place")
        groups = rest.groupBy(place).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()
        if known is None:
            known = sum(g["n"] for g in groups)
            n = min(n, known)
            if not known:
                return None, 0
        for group in sorted(groups, key=lambda g: g["place"]):
            if before + group["n"] >= n:
                break
            before += group["n"]
        if group["low"] == group["high"]:
            return group["low"], known
        prefix = os.path.commonprefix([group["low"], group["high"]])
        rest = ids.filter(F.startswith("id", F.lit(prefix)))


def limit_articles(df: DataFrame, n: int | None, order_by: str = "doc_id") -> DataFrame:
    """The first ``n`` articles by their unique id; 0 or None means all, NULL ids come last.

    The n-th id is found by counting ids in ever narrower ranges, or of texts by ever longer
    beginnings, so nothing is sorted or gathered, and is then a plain upper bound for the scan of the texts.
    """
    if not n:
        return df
    if df.schema[order_by].dataType.typeName() == "string":
        last, known = _nth_text(df.select(F.col(order_by).alias("id")), n)
        first = df.filter(F.col(order_by) <= F.lit(last))
        return first.unionByName(df.filter(F.col(order_by).isNull()).limit(max(0, n - known)))
    ids = df.select(F.col(order_by).cast("decimal(20,0)").alias("id"))
    low, high, known = ids.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if n >= known:
        unknown = df.filter(F.col(order_by).isNull())
        return df.filter(F.col(order_by).isNotNull()).unionByName(unknown.limit(n - known))
    low, high, before = int(low), int(high), 0
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        place = F.expr(f"CAST((id - {low}) DIV {width} AS BIGINT)")
        counts = ids.filter(F.col("id").between(low, high)).groupBy(place.alias("place")).count()
        for place, count in sorted(map(tuple, counts.collect())):
            if before + count >= n:
                break
            before += count
        low, high = low + place * width, min(high, low + (place + 1) * width - 1)
    return df.filter(F.col(order_by) <= F.lit(high))


def chunk_number(ordinal: Column | str, size: int = CHUNK_SIZE, base: int = 0) -> Column:
    """1-based chunk of a 1-based ordinal, after ``base`` existing chunks."""
    if size <= 0:
        raise ValueError("chunk size must be >= 1")
    column = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return whole_div(column - 1, size) + 1 + F.lit(base)


def assign_chunks(numbered: DataFrame, size: int = CHUNK_SIZE, base: int = 0) -> DataFrame:
    """Chunk id and line number from the running ordinal; chunks cross article borders."""
    return numbered.withColumn("chunk_id", chunk_number("ordinal", size, base)).withColumn(
        "line_no", (F.pmod(F.col("ordinal") - 1, F.lit(size)) + 1).cast("int")
    )


def _path(chunk_id: Column | str, stem: str, chunks_dir: str) -> Column:
    column = F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id
    return F.concat(F.lit(f"{chunks_dir}/{stem}chunk_"), column.cast("string"), F.lit(".txt"))


def source_path(chunk_id: Column | str = "chunk_id", chunks_dir: str = "chunks") -> Column:
    return _path(chunk_id, "", chunks_dir)


def translated_path(chunk_id: Column | str = "chunk_id", chunks_dir: str = "chunks") -> Column:
    return _path(chunk_id, "translated_", chunks_dir)


def chunk_manifest(chunked: DataFrame, chunks_dir: str = "chunks", run_ts: Column | None = None) -> DataFrame:
    """One entry per chunk, not yet translated, created at ``run_ts``. Counts are combined map-side."""
    created = F.lit(None) if run_ts is None else run_ts
    return (
        chunked.groupBy("chunk_id")
        .agg(F.count(F.lit(1)).cast("int").alias("sentence_count"))
        .select(
            "chunk_id",
            source_path("chunk_id", chunks_dir).alias("file_path"),
            "sentence_count",
            F.lit(False).alias("is_translated"),
            F.lit(None).cast("string").alias("translated_file"),
            created.cast("timestamp").alias("created_at"),
            F.lit(None).cast("timestamp").alias("translated_at"),
        )
    )


def pack_chunks(chunked: DataFrame) -> DataFrame:
    """One row per chunk with its sentences in order: the content of a chunk file.

    A group never exceeds the chunk size. Chunks come in ranges of ids, sorted, from the one
    exchange that packing needs anyway, so what follows can number their lines in place.
    """
    entries = F.sort_array(F.collect_list(F.struct("ordinal", "sentence")))
    ranged = chunked.select("chunk_id", "ordinal", "sentence").repartitionByRange("chunk_id")
    packed = ranged.groupBy("chunk_id").agg(F.transform(entries, lambda e: e["sentence"]).alias("sentences"))
    return packed.sortWithinPartitions("chunk_id")


def reread_lines(sentences: Column | str) -> Column:
    """What reading a chunk file back yields: its non-blank lines, stripped.

    A sentence that holds a line break becomes several lines.
    """
    return F.flatten(F.transform(sentences, lambda s: text_lines(s)))


def chunk_lines(packed: DataFrame) -> DataFrame:
    return packed.select("chunk_id", F.posexplode(reread_lines("sentences")).alias("_p", "line")).select(
        "chunk_id", (F.col("_p") + 1).alias("line_no"), "line"
    )


def unfinished(manifest: DataFrame) -> DataFrame:
    """Chunks whose flag is false or missing."""
    return manifest.filter(~F.coalesce("is_translated", F.lit(False)))


def chunk_status(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if(F.coalesce("is_translated", F.lit(False))).alias("translated"), F.count(F.lit(1)).alias("total")
    )


def mark_translated(manifest: DataFrame, done: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The manifest with the chunks of ``done(chunk_id, translated_file)`` marked finished at ``run_ts``.

    Where ``done`` has ``translated_at``, as the completion log has, that time counts instead. Unknown ids have no effect.
    Nothing is written: workers that run side by side record what they finish with ``log_completed``, and
    each derives the manifest from the log. A manifest of an older run may lack the times.
    """
    for name in ("created_at", "translated_at"):
        if name not in manifest.columns:
            manifest = manifest.withColumn(name, F.lit(None).cast("timestamp"))
    at = (F.lit(None) if run_ts is None else run_ts).cast("timestamp")
    own = F.col("translated_at").cast("timestamp") if "translated_at" in done.columns else F.lit(None).cast("timestamp")
    finished = done.groupBy("chunk_id").agg(
        F.max("translated_file").alias("_file"), F.max(F.coalesce(own, at)).alias("_at"), F.lit(True).alias("_done")
    )
    changed = ("is_translated", "translated_file", "translated_at")
    return manifest.join(finished, "chunk_id", "left").select(
        *[c for c in manifest.columns if c not in changed],
        (F.coalesce("is_translated", F.lit(False)) | F.coalesce("_done", F.lit(False))).alias("is_translated"),
        F.coalesce("_file", "translated_file").alias("translated_file"),
        F.when(F.col("_done"), F.coalesce("_at", "translated_at")).otherwise(F.col("translated_at")).alias("translated_at"),
    )


def pending_articles(articles: DataFrame, processed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Articles not chunked by an earlier run. One without an id can't be told from another: it is always pending."""
    return articles.join(processed.select(key).distinct(), key, "left_anti")


def chunk_count(manifest: DataFrame) -> int:
    """How many chunks exist: the base for the next run's numbers."""
    return manifest.count()
