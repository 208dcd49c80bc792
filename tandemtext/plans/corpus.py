"""The corpus pipeline as compositions of the operators.

Order matters for cost: English sentences are dropped before anything is sent
to a translator, and articles are put in order before they are split, so the
splitting expressions run once, on rows that are already where they belong.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.language import THRESHOLD
from ..functions.sentences import split_sentences
from ..operators.assemble import assemble_results, assemble_translated
from ..operators.chunking import (
    CHUNK_SIZE,
    assign_chunks,
    chunk_manifest,
    limit_articles,
    mark_translated,
    pack_chunks,
    reread_lines,
    translated_path,
)
from ..operators.filters import filter_english
from ..operators.language_model import LanguageModel, train_language_model
from ..operators.ordinal import arrange_ids, with_ordinal
from ..operators.translate import DELAY, KEEP_SOURCE, RETRIES, Translator, apply_translator, translate_chunks, translate_durably
from ..session import stage
from ..sources.articles import read_articles


def load_documents(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return read_articles(spark, f"{sf_dir}/documents.parquet", keep=keep)


def numbered_sentences(
    articles: DataFrame, profile: str = "prod", keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Sentences of all articles, optionally filtered row by row, with running numbers from 1.

    ``keep`` must be row-local: it runs between the sort and the numbering.
    """
    sentences = split_sentences(arrange_ids(articles.select("doc_id", "text"), "doc_id"), profile=profile)
    kept = keep(sentences) if keep else sentences
    return with_ordinal(kept, ["doc_id", "pos"], arranged=True)


def chunked_sentences(
    articles: DataFrame,
    profile: str = "prod",
    method: str = "patterns",
    threshold: float = THRESHOLD,
    model: LanguageModel | None = None,
    size: int = CHUNK_SIZE,
    base: int = 0,
    limit: int | None = None,
) -> DataFrame:
    """Articles to chunked, non-English sentences; with ``limit`` only of the first articles.

    The word-level method joins, so its sentences are written first and arranged after the filter.
    """
    articles = limit_articles(articles, limit)
    if method == "words":
        sentences = split_sentences(articles.select("doc_id", "text"), profile=profile)
        kept = filter_english(sentences, model=model)
        numbered = with_ordinal(kept, ["doc_id", "pos"])
    else:
        numbered = numbered_sentences(
            articles, profile, lambda s: filter_english(s, method=method, threshold=threshold)
        )
    return assign_chunks(numbered, size, base)


def default_chunks(articles: DataFrame, labelled: DataFrame, size: int = CHUNK_SIZE, base: int = 0, limit: int | None = None) -> DataFrame:
    """The first phase as it is meant to run: the live rule set, then every word's language.

    ``labelled(text, lang)`` trains the word model; a sentence is dropped only if all of its words are English.
    """
    return chunked_sentences(articles, method="words", model=train_language_model(labelled), size=size, base=base, limit=limit)


def translate_and_assemble(
    chunked: DataFrame,
    make_translator: Callable[[], Translator],
    base_ms: int,
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
    run_ts: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Chunked sentences to ``(manifest, pairs)``; ``base_ms`` must differ from other runs' (``next_base``)."""
    lines = pack_chunks(chunked).select("chunk_id", reread_lines("sentences").alias("lines"))
    translated = translate_chunks(lines, make_translator, delay, retries, workers)
    done = translated.filter("ok").select("chunk_id", translated_path("chunk_id").alias("translated_file"))
    manifest = mark_translated(chunk_manifest(chunked, run_ts=run_ts), done, run_ts)
    return manifest, assemble_translated(translated, base_ms)


def resume_translation(
    chunked: DataFrame,
    make_translator: Callable[[], Translator],
    folder: str,
    base_ms: int,
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
    chunks_per_task: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """As ``translate_and_assemble`` with every finished chunk kept below ``folder``, from which a broken run goes on.

    Times of translation are those at which chunks were finished.
    """
    lines = pack_chunks(chunked).select("chunk_id", reread_lines("sentences").alias("lines"))
    results = translate_durably(lines, make_translator, folder, delay, retries, workers, chunks_per_task)
    done = results.filter("ok").select(
        "chunk_id", translated_path("chunk_id").alias("translated_file"), F.col("finished_at").alias("translated_at")
    )
    return mark_translated(chunk_manifest(chunked), done), assemble_results(results, base_ms)


def article_pairs(
    articles: DataFrame,
    make_translator: Callable[[], Translator],
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
) -> DataFrame:
    """Article to pairs in one pass: split, drop English, translate, keep the source where that fails.

    Row-local from scan to result; the filter runs before the translator.
    """
    kept = filter_english(split_sentences(articles.select("doc_id", "text"), profile="drop_punct"), method="lexicon")
    keys = (F.col("doc_id").alias("article_index"), F.col("pos").cast("bigint").alias("sentence_index"))
    return _lenient_pairs(kept, make_translator, delay, retries, workers, *keys)


def _lenient_pairs(
    kept: DataFrame, make_translator: Callable[[], Translator], delay: float, retries: int, workers: int | None, *keys
) -> DataFrame:
    translated = apply_translator(kept, make_translator, "sentence", KEEP_SOURCE, delay, retries, workers)
    return translated.select(*keys, F.col("sentence").alias("source_text"), F.col("translated").alias("english"))


def record_pairs(
    records: DataFrame,
    make_translator: Callable[[], Translator],
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
) -> DataFrame:
    """Text records (``article_index, sentence_index, text``) to pairs.

    Records are taken as sentences already; English ones are dropped, and the
    source text stands in where the translator fails.
    """
    sentences = records.select("article_index", "sentence_index", F.col("text").alias("sentence"))
    kept = filter_english(sentences, method="lexicon")
    return _lenient_pairs(kept, make_translator, delay, retries, workers, "article_index", "sentence_index")


def sequence_pairs(
    articles: DataFrame,
    make_translator: Callable[[], Translator],
    base_ms: int,
    delay: float = DELAY,
    retries: int = RETRIES,
    workers: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(extracted, pairs)``: all sentences with sequence ids, and pairs of those that are not English.

    Ids are given before the filter, so the ids of pairs have gaps. Article
    indices are the article ids.
    """
    numbered = numbered_sentences(articles, "drop_punct")
    extracted = numbered.select((F.col("ordinal") + (base_ms - 1)).alias("seq_id"), "doc_id", "sentence")
    kept = filter_english(extracted, method="patterns")
    keys = (F.col("seq_id").alias("sequence_id"), F.col("doc_id").alias("article_index"))
    return extracted, _lenient_pairs(kept, make_translator, delay, retries, workers, *keys)
