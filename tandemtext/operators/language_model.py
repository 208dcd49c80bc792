"""Word-level language detection as Spark jobs.

A sentence is English only if every one of its words is. Words are classified
by a character n-gram naive Bayes model that is trained from labelled text, and
each distinct word is classified once. A word that no language of the model could have
written, because none knows any of its n-grams, isn't given the nearest language but stays
undetected, and its sentence is kept. Scores are rounded integers, so sums do
not depend on the order in which partial results arrive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, _col, strip
from ..session import stage
from .lookup import fits_in_memory, fresh, salted_left_join, split_flags
from .ordinal import with_ordinal

NGRAM_SIZES = (3,)
SCALE = 10000
# Total and number of a language become one decimal number, in which the latter has the last 18 digits.
NUMBERS = 10**18


def bare_word(c: Column | str) -> Column:
    """Letters only, lower case; empty for a token without letters."""
    return F.regexp_replace(F.lower(_col(c)), r"\P{L}+", "")


def bare_words(c: Column | str) -> Column:
    """``bare_word`` of every word; an empty array for blank text.

    The whole text is cleaned at once: single spaces stay between words, so a word without letters leaves an empty one.
    """
    spaced = F.regexp_replace(F.lower(strip(c)), SPACE + "+", " ")
    cleaned = F.split(F.regexp_replace(spaced, r"[^\p{L} ]+", ""), " ")
    return F.when(strip(c) == "", F.array().cast("array<string>")).otherwise(cleaned)


def word_ngrams(word: Column | str, sizes: tuple[int, ...] = NGRAM_SIZES) -> Column:
    """All n-grams of a word with ``_`` at both ends, repeats included.

    Sizes up to 3 give a non-empty result for every non-empty word.
    """
    padded = F.concat(F.lit("_"), _col(word), F.lit("_"))

    def of_size(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - (k - 1))
        grams = F.transform(starts, lambda i: F.substring(padded, i, F.lit(k)))
        return F.when(F.length(padded) >= k, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_size(k) for k in sizes])


@dataclass(frozen=True)
class LanguageModel:
    """``profile(lang, ngram, n, score, lang_no, unseen)`` and ``languages(lang, lang_no, unseen)``.

    ``unseen`` is the score of an n-gram that a language lacks; ``lang_no`` counts languages by name.
    """

    profile: DataFrame
    languages: DataFrame
    sizes: tuple[int, ...] = NGRAM_SIZES


def _score(count: Column, total: Column, vocabulary: Column) -> Column:
    return F.round(F.log((count + 1) / (total + vocabulary)) * SCALE).cast("bigint")


def train_language_model(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: tuple[int, ...] = NGRAM_SIZES
) -> LanguageModel:
    """Smoothed n-gram log probabilities per language.

    Words are counted first, so n-grams are formed once per distinct word and
    language, not once per occurrence.
    """
    counted = (
        labelled.select(F.col(lang_col).alias("lang"), F.explode(bare_words(text_col)).alias("word"))
        .filter((F.col("word") != "") & F.col("lang").isNotNull())
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grams = stage(
        counted.select("lang", "n", F.explode(word_ngrams("word", sizes)).alias("ngram"))
        .groupBy("lang", "ngram")
        .agg(F.sum("n").alias("n")),
        "ngrams",
    )
    vocabulary = grams.agg(F.count_distinct("ngram")).scalar()
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total")).withColumn("vocabulary", vocabulary)
    languages = with_ordinal(
        totals.withColumn("unseen", _score(F.lit(0), F.col("total"), F.col("vocabulary"))), ["lang"], "lang_no"
    )
    profile = grams.join(languages, "lang").select(
        "lang", "ngram", "n", _score(F.col("n"), F.col("total"), F.col("vocabulary")).alias("score"), "lang_no", "unseen"
    )
    return LanguageModel(profile, languages.select("lang", "lang_no", "unseen"), sizes)


def count_words(df: DataFrame, words_col: Column | str) -> DataFrame:
    """``(word, n)``: in how many rows of ``df`` each non-empty word stands; combined map-side."""
    return (
        df.select(F.explode(words_col).alias("word"))
        .filter("word <> ''")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distinct_words(df: DataFrame, text_col: str) -> DataFrame:
    return count_words(df, F.array_distinct(bare_words(text_col)))


def classify_words(vocabulary: DataFrame, model: LanguageModel, least_known: float = 0.0) -> DataFrame:
    """``lang`` for every row of ``vocabulary(word, n)``: best total score, then name; NULL where detection fails.

    A language can win only if it knows at least one of the word's n-grams, and at least ``least_known`` of
    all of them; a word without such a language is undetected, as are all words where nothing was learned.

    A profile of small measured size meets the n-grams where the words are: if they come from
    ``count_words``, they are dealt by word already and nothing is shuffled. A larger one is joined by n-gram, frequent ones salted.
    """
    listed = vocabulary.select("word", "n", word_ngrams("word", model.sizes).alias("_grams"))
    grams = listed.select("word", "n", F.size("_grams").cast("bigint").alias("_length"), F.explode("_grams").alias("ngram"))
    profile = model.profile.select("ngram", "lang_no", "unseen", (F.col("score") - F.col("unseen")).alias("gain"))
    if fits_in_memory(profile):
        joined = grams.join(F.broadcast(profile), "ngram", "left")
    else:
        joined = salted_left_join(stage(grams, "word-ngrams"), profile, ["ngram"], ["word"])
    totals = joined.groupBy("word", "n", "_length", "lang_no").agg(
        F.sum("gain").alias("gain"), F.max("unseen").alias("unseen"), F.count("lang_no").alias("known")
    )
    # One number for both, so the best is a plain maximum: the higher total, then the earlier name.
    total = (F.col("gain") + F.col("_length") * F.col("unseen")).cast("decimal(19,0)")
    rank = total * F.lit(NUMBERS).cast("decimal(19,0)") + (F.lit(NUMBERS - 1) - F.col("lang_no")).cast("decimal(19,0)")
    detected = (F.col("known") > 0) & (F.col("known") >= F.lit(least_known) * F.col("_length"))
    best = totals.groupBy("word", "n").agg(F.max(F.when(detected, rank.cast("decimal(38,0)"))).alias("_best"))
    number = F.lit(NUMBERS - 1) - F.pmod("_best", F.lit(NUMBERS).cast("decimal(19,0)")).cast("bigint")
    named = best.select("word", "n", number.alias("lang_no"))
    return named.join(model.languages.select("lang_no", "lang"), "lang_no", "left").select("word", "n", "lang")


def flag_english(
    sentences: DataFrame,
    model: LanguageModel,
    keys: list[str] | None = None,
    sentence_col: str = "sentence",
    english: str = "en",
    least_known: float = 0.0,
) -> DataFrame:
    """Add ``is_english``: true when the sentence has words and all are English.

    NULL and blank sentences aren't English, nor are those with a token that can't be detected: one without letters,
    or one whose n-grams the model doesn't know (``classify_words``). Sentences are written once with a row number of their own, so no key needs to
    be unique or known; ``keys`` is ignored, and columns of any name pass through. Most sentences are decided where they
    are: one frequent word that isn't English or a letterless token is enough, as are frequent
    English words only. Only the others look up their rarer words and are shuffled.
    """
    row, cut_words, rest, other = (fresh(sentences, name) for name in ("_row", "_words", "_rest", "_other"))
    cut = stage(
        sentences.select(
            "*",
            F.monotonically_increasing_id().alias(row),
            F.coalesce(F.array_distinct(bare_words(sentence_col)), F.array().cast("array<string>")).alias(cut_words),
        ),
        "words",
    )
    classified = classify_words(count_words(cut, cut_words), model, least_known)
    is_other = ~F.coalesce(F.col("lang") == F.lit(english), F.lit(False))
    dictionary = stage(classified.select("word", "n", is_other.alias("other")), "word-language")
    hot_other, hot_english, rare = split_flags(dictionary, "word", "other")
    settled = (F.size(cut_words) == 0) | F.array_contains(cut_words, "") | F.exists(cut_words, hot_other)
    judged = cut.withColumn(rest, F.when(~settled, F.filter(cut_words, lambda w: ~hot_english(w))))
    flag = F.when(F.col(rest).isNull(), False).when(F.size(rest) == 0, True)
    decided = judged.filter(flag.isNotNull()).select(*sentences.columns, flag.alias("is_english"))

    open_rows = judged.filter(F.size(rest) > 0)
    others = (
        open_rows.select(row, F.explode(rest).alias("word"))
        .join(rare.filter("other").select("word").hint("shuffle_hash"), "word")
        .select(row)
        .distinct()
        .withColumn(other, F.lit(True))
    )
    looked_up = open_rows.join(others, row, "left").select(*sentences.columns, F.col(other).isNull().alias("is_english"))
    return decided.unionByName(looked_up)
