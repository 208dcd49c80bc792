"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.common import table
from tandemtext.llm.language_id import keep_identified, train
from tandemtext.llm.line_dedup import without_repeated_lines
from tandemtext.llm.minhash_dedup import near_duplicates
from tandemtext.llm.packing import pack_documents
from tandemtext.llm.pii import redact_personal_data, train_tagger
from tandemtext.llm.queries import BYTE_MODEL, vocabulary
from tandemtext.session import scratch_path


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; those without a letter go, and those of letters that the model never saw.

    NULL and empty texts have no letter. Each row is judged by itself, so repeated rows go or stay together. Columns of any name pass through.
    """
    return keep_identified(docs, train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows are cut; every document stays, some of them empty.

    NULL texts stay NULL. Rows that repeat an id and its text lose the same lines. Columns of any name pass through.
    """
    return _counted(without_repeated_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Documents without words, NULL texts among them, are near nothing and stay. Rows that repeat an id stay or go together. Columns of any name pass through.
    """
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    return rows.join(kept, F.col("_row")["doc_id"].eqNullSafe(F.col("_kept")), "left_semi").select("_row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes ``<KIND>``; NULL texts stay NULL, each row stands alone, columns of any name pass through."""
    return _counted(redact_personal_data(docs, train_tagger(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences; NULL texts are empty, repeated rows are packed each. Workers have held other stages before, so their cache of words is smaller."""
    return pack_documents(docs, vocabulary(BYTE_MODEL), most_words=300_000)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_dedup", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Trained models and tokenizers can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written below the shared scratch folder first."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
