"""Row filters of the sentence stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.language import THRESHOLD, is_english_by_lexicon, is_english_by_patterns
from ..functions.text import first_words
from .language_model import LanguageModel, flag_english

PREDICATES = {"patterns": is_english_by_patterns, "lexicon": is_english_by_lexicon}


def filter_min_length(df: DataFrame, col: str = "sentence", min_length: int = 10) -> DataFrame:
    return df.filter(F.length(col) >= min_length)


def filter_english(
    df: DataFrame,
    col: str = "sentence",
    method: str = "words",
    threshold: float = THRESHOLD,
    model: LanguageModel | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Drop English sentences.

    ``method="words"`` asks a trained model about every word; ``"patterns"`` and ``"lexicon"`` are row-local
    function-word ratios.
    """
    if method == "words":
        if model is None:
            raise ValueError("method='words' needs a language model")
        return flag_english(df, model, keys, col).filter(~F.col("is_english")).drop("is_english")
    if method not in PREDICATES:
        raise ValueError(f"unknown method {method!r}")
    return df.filter(~PREDICATES[method](col, threshold))


def article_split_stats(sentences: DataFrame, article: str = "doc_id", method: str = "patterns") -> DataFrame:
    """Per article: sentences found, kept, skipped, and how each skipped one begins.

    ``sentences`` is one row per article with an array column ``sentences``, so
    nothing is shuffled.
    """
    english = PREDICATES[method]
    skipped = F.filter("sentences", lambda s: english(s))
    return sentences.select(article, F.size("sentences").alias("found"), skipped.alias("_skipped")).select(
        article,
        "found",
        (F.col("found") - F.size("_skipped")).alias("kept"),
        F.size("_skipped").alias("skipped"),
        F.transform("_skipped", lambda s: first_words(s, 3)).alias("skipped_heads"),
    )
