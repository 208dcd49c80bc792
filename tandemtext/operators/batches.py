"""Round-robin batches of chunks and their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunking import unfinished
from .ordinal import whole_div, with_ordinal


def round_robin_batches(chunks: DataFrame, num_batches: int) -> DataFrame:
    """Deal chunks, in id order, to ``num_batches`` batches numbered from 0."""
    if num_batches <= 0:
        raise ValueError("at least one batch is needed")
    ranked = with_ordinal(chunks.select("chunk_id"), ["chunk_id"], "_rank", start=0)
    return ranked.select(
        "chunk_id",
        F.pmod(F.col("_rank"), F.lit(num_batches)).cast("int").alias("batch_number"),
        whole_div("_rank", num_batches).alias("batch_pos"),
    )


# The texts of a batch manifest.
PURPOSE = "parallel_translation"
SPAN, EMPTY = ("Translate chunks ", " to "), "Empty batch"


def batch_manifest(batches: DataFrame, num_batches: int) -> DataFrame:
    """One header row per batch, empty batches included: how many chunks, which first and last.

    The ids themselves are the rows of ``batches``: no row grows with the corpus at any size.
    """
    whole = batches.groupBy("batch_number").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.min("chunk_id").alias("first_chunk"), F.max("chunk_id").alias("last_chunk")
    )
    numbers = batches.sparkSession.range(num_batches).select(F.col("id").cast("int").alias("batch_number"))
    span = F.concat(
        F.lit(SPAN[0]), F.col("first_chunk").cast("string"), F.lit(SPAN[1]), F.col("last_chunk").cast("string")
    )
    return numbers.join(whole, "batch_number", "left").select(
        "batch_number",
        F.lit(num_batches).alias("total_batches"),
        F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"),
        "first_chunk",
        "last_chunk",
        F.struct(
            F.lit(PURPOSE).alias("purpose"),
            F.when(F.col("chunk_count") > 0, span).otherwise(F.lit(EMPTY)).alias("instructions"),
        ).alias("metadata"),
    )


def batch_work(chunks: DataFrame, batches: DataFrame | None = None, batch_number: int | None = None) -> DataFrame:
    """The chunks to work on.

    With ``batches(batch_number, chunk_id)`` their ids are taken as they are, finished or not;
    without, all unfinished chunks.
    """
    if batches is None:
        return unfinished(chunks)
    if batch_number is not None:
        batches = batches.filter(F.col("batch_number") == batch_number)
    return chunks.join(batches.select("chunk_id"), "chunk_id", "left_semi")
