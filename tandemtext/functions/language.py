"""English predicates built from function words, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NO_WORD, _col, bind, strip, word_count

THRESHOLD = 0.3

# Function-word groups; a word in two groups counts twice.
WORD_GROUPS = [
    ["the", "and", "that", "with", "for", "this", "from", "have", "not"],
    ["was", "were", "are", "is", "been", "being", "be"],
    ["will", "would", "could", "should", "may", "might", "must", "can"],
    ["he", "she", "it", "they", "we", "you", "i"],
    ["his", "her", "their", "our", "your", "my", "its"],
    ["in", "on", "at", "to", "for", "by", "with", "from", "into", "through", "during"],
]

# Indicator words looked for anywhere in the text; repeats weigh double.
INDICATORS = [
    "the", "and", "that", "with", "for", "this", "from", "have", "not", "but",
    "what", "all", "were", "when", "there", "can", "an", "been", "has", "had",
    "one", "their", "also", "who", "more", "will", "each", "about", "which",
    "her", "she", "into", "its", "only", "other", "new", "them", "then",
    "because", "these", "time", "very", "just", "like", "people", "so",
    "than", "first", "may", "way", "even", "see", "after", "good", "know",
    "year", "most", "would", "world", "city", "some", "where", "between",
    "made", "then", "did", "need", "life", "here", "long", "take", "come",
    "great", "still", "public", "house", "own", "under", "water", "work",
    "while", "such", "being", "well", "how", "many", "any", "days", "go",
    "came", "made", "may", "should", "us", "now", "over", "most", "into",
]


def _words_by_weight() -> dict[int, list[str]]:
    seen: dict[str, int] = {}
    for group in WORD_GROUPS:
        for word in group:
            seen[word] = seen.get(word, 0) + 1
    weights: dict[int, list[str]] = {}
    for word, weight in seen.items():
        for level in range(1, weight + 1):
            weights.setdefault(level, []).append(word)
    return weights


def _function_words(tokens: Column) -> Column:
    def hits(listed: list[str]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(*listed)))

    first, *rest = [hits(listed) for listed in _words_by_weight().values()]
    return sum(rest, first)


def _indicators(low: Column) -> Column:
    hits = [F.contains(low, F.lit(word)).cast("int") for word in INDICATORS]
    return sum(hits[1:], hits[0])


def function_word_count(c: Column | str) -> Column:
    """Whole-word hits over all groups, from runs of word characters cut once."""
    return bind(F.split(F.lower(_col(c)), NO_WORD + "+"), _function_words)


def indicator_count(c: Column | str) -> Column:
    """Indicator entries contained anywhere in the text, one per entry."""
    return bind(F.lower(_col(c)), _indicators)


def _reaches(count: Column, c: Column | str, threshold: float) -> Column:
    return F.coalesce((strip(c) != "") & (count / word_count(c) >= F.lit(threshold)), F.lit(False))


def is_english_by_patterns(c: Column | str, threshold: float = THRESHOLD) -> Column:
    """Function words make up at least ``threshold`` of the words; blank text is not English."""
    return _reaches(function_word_count(c), c, threshold)


def is_english_by_lexicon(c: Column | str, threshold: float = THRESHOLD) -> Column:
    """As above with indicator hits added.

    The first test already implies the second, so the many substring searches
    run only for texts it leaves open.
    """
    return is_english_by_patterns(c, threshold) | _reaches(
        function_word_count(c) + indicator_count(c), c, threshold
    )
