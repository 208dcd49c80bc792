"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_dedup,
    exact_dedup,
    filter_audit,
    language_id,
    line_dedup,
    lm_score,
    merge_encoding,
    minhash_dedup,
    mixing,
    packing,
    pii,
    prefix_trie,
    url_filter,
)
from .common import table

# Where the vocabulary files are, read on the driver only; the bytes, about a MB, travel with the job.
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op1_exact_dedup", exact_dedup.ORACLE)
def op1(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op4_line_dedup", line_dedup.ORACLE)
def op4(spark, sf_dir):
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query("op9_piece_encoding")
def op9(spark, sf_dir):
    return merge_encoding.encoding_digests(table(spark, sf_dir, "documents"), vocabulary(PIECE_MODEL))


@query("op10_packing")
def op10(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(BYTE_MODEL))


@query("op8_language_id")
def op8(spark, sf_dir):
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"))


# The labels of the query: hosts that hold one of these words are bad. Of the others, those with a hyphen are of no known
# kind and teach nothing; the rest are good.
BAD_WORDS = ("ads-", "adult", "bets", "casino", "cheap", "loans", "pills", "poker", "porn", "spam", "viagra")


def labelled_urls(pages: DataFrame) -> DataFrame:
    host = url_filter.host_of(F.col("url"))
    bad = F.lit(False)
    for word in BAD_WORDS:
        bad = bad | host.contains(word)
    unknown = (host == "") | host.contains("-")
    return pages.filter("url IS NOT NULL").select("url", F.when(bad, 1).when(~unknown, 0).alias("bad"))


@query("op2_url_filter")
def op2(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, labelled_urls(pages))


@query("op7_minhash_dedup", minhash_dedup.ORACLE)
def op7(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_lm_score")
def op5(spark, sf_dir):
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


@query("op6_embedding_dedup", embedding_dedup.ORACLE)
def op6(spark, sf_dir):
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_personal_data")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.train_tagger(docs))


@query("op11_filter_audit", filter_audit.ORACLE)
def op11(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_mixing", mixing.ORACLE)
def op12(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", prefix_trie.ORACLE)
def op13(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
