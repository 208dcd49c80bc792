"""Reading articles and choosing their text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal

# Likely names of the text column, most likely first, and names that never hold text.
TEXT_COLUMNS = ["text", "content", "body", "article", "articles", "hiligaynon", "hil", "news", "data"]
METADATA_COLUMNS = ["id", "index", "idx", "split", "source", "lang"]


def pick_text_column(columns: Sequence[str], explicit: str | None = None) -> str:
    """The article column, decided from names alone; no data is read."""
    if explicit is not None:
        if explicit not in columns:
            raise ValueError(f"no column {explicit!r} in {list(columns)}")
        return explicit
    for name in TEXT_COLUMNS:
        if name in columns:
            return name
    for name in columns:
        if name not in METADATA_COLUMNS:
            return name
    raise ValueError(f"no article column among {list(columns)}")


def read_articles(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    text_column: str | None = None,
    id_column: str | None = "doc_id",
    keep: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """``(doc_id, text)`` plus the columns to ``keep``; all others are pruned from the scan.

    Without ``id_column`` articles are numbered from 0 in file order, for inputs
    whose only identity is their position.
    """
    raw = spark.read.format(fmt).options(**options).load(path)
    text = F.col(pick_text_column(raw.columns, text_column)).alias("text")
    if id_column is not None:
        # Ids that are texts stay so; all others are numbers.
        kind = raw.schema[id_column].dataType.typeName()
        number = F.col(id_column) if kind == "string" else F.col(id_column).cast("bigint")
        return raw.select(number.alias("doc_id"), text, *keep)
    # Rows of one file block are read in order by one task.
    placed = raw.select(
        text,
        *keep,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return with_ordinal(placed, ["_file", "_block", "_line"], "doc_id", start=0).select("doc_id", "text", *keep)


def spread_rows(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Give every core work when a small input comes in fewer splits than there are cores.

    Splitting text is heavy per row, and one Parquet row group is one task. Inputs
    with enough splits pass through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
