"""Unicode-aware text units as column expressions.

White space and word characters are spelled out as classes, so the JVM regex
engine needs no Unicode flag and agrees with code-point semantics elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WORD = r"[\p{L}\p{N}_]"
NO_WORD = r"[^\p{L}\p{N}_]"
WORD_STARTS = rf"(?<!{WORD})"
WORD_ENDS = rf"(?!{WORD})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row.

    A filter repeats a sub-expression wherever it is used; a lambda variable is not repeated.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def words(c: Column | str) -> Column:
    """White-space separated words; an empty array for blank text."""
    return F.filter(F.split(strip(c), SPACE + "+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    bare = strip(c)
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE + "+")))


def first_words(c: Column | str, n: int = 3) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def text_lines(c: Column | str) -> Column:
    """Lines of a text, stripped, blank ones dropped."""
    return F.filter(F.transform(F.split(_col(c), r"\r\n|\r|\n"), strip), lambda line: line != "")


def same_text(a: Column | str, b: Column | str) -> Column:
    """True where two texts are equal but for white space at the ends."""
    return strip(a) == strip(b)


def head(c: Column | str, n: int = 50) -> Column:
    """The first ``n`` characters, for messages."""
    return F.substring(_col(c), 1, n)
