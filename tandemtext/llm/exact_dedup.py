"""Exact deduplication: local combining, salted digest groups, then their winners.

Equal texts meet in three steps, each of which compares whole texts, not digests: Spark's
map-side aggregation inside a task, groups of (digest, salt) where the salt comes from the
task, and one group per digest, which by then has at most one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, SPACES, copies_for, salt, salt_mask


def normalised(text: Column) -> Column:
    """White space runs become one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The smallest id of a group of equal texts stays. NULL texts equal empty ones. A NULL id
    is never smallest; a group of NULL ids only keeps its rows. Rows that repeat an id and its
    text are one document: all of them are kept or dropped together, and each counts in
    ``group_size``. Other columns are ignored. Two different texts with one SHA-256, which
    nobody has seen yet, stop the query with an error.
    """
    text = F.col(text_column).alias("_text")
    rows = docs.select(F.col(id_column).alias("doc_id"), text).select("doc_id", normalised(F.col("_text")).alias("_norm"))
    digest = F.unhex(F.sha2("_norm", 256)).alias("_digest")
    place = salt(F.xxhash64("doc_id")).alias("_salt")

    local = rows.select(
        "doc_id", "_norm", digest, place, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_task")
    )
    counted = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), salt_mask("_salt").alias("_mask")]
    salted = local.groupBy("_digest", "_task", "_norm").agg(*counted)
    winners = salted.groupBy("_digest", "_norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.bit_or("_mask").alias("_mask")
    )
    # Texts are left behind here: from now on a digest stands for one compared text.
    sole = winners.groupBy("_digest").agg(
        F.min("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.bit_or("_mask").alias("_mask"),
        F.count(F.lit(1)).alias("_texts"),
    )
    checked = sole.withColumn(
        "group_size",
        F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts with one digest"))),
    )
    spread = checked.select("_digest", "keep_id", "group_size", copies_for("_mask").alias("_salt"))
    members = rows.select("doc_id", digest, place)
    return members.join(spread, ["_digest", "_salt"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


ORACLE = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM norm
"""
