"""Abbreviation-aware sentence splitting in Catalyst expressions.

Five rule sets ("profiles") are supported:

``prod``            punctuation stays, a short list of abbreviations
``drop_punct``      splits at any run of ``.!?`` and loses it, long list
``full``            punctuation stays, long list with version numbers
``full_lookahead``  as ``full``, but an abbreviation before a capital ends a sentence
``simple``          as ``full`` without stripping and without a minimum length

``prod`` is a single ``split``: its abbreviations have bounded length, so they
fit into look-behinds. The long lists hold numbers of any length; they are
marked first with two noncharacters around every protected match.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import SPACE, WORD, WORD_ENDS, WORD_STARTS, _col, strip

# Abbreviations that carry a period, by profile family.
SHORT_LIST = ["Mr", "Mrs", "Ms", "Dr", "Prof", "no", "vol", "pg", "p"]
LONG_LIST = [
    "Dr", "Mr", "Mrs", "Ms", "Prof", "Sr", "Jr", "St", "Fr", "Rev",
    "Gov", "Sen", "Rep", "Pres", "Gen", "Col", "Lt", "Sgt", "Cpl", "Capt",
    "Cmdr", "Adm", "Amb", "Hon",
    "PhD", "MD", "BA", "BS", "MA", "MS",
    "Inc", "Ltd", "Co", "Corp",
    "vs", "etc", "i.e", "e.g",
    "Fig", "fig", "Vol", "vol", "No", "no", "pp", "pg", "p",
    "ed", "eds", "est", "approx", "ca", "cf", "viz", "al", "et al",
]
EXTRA_BUSINESS = ["LLC"]
PERIOD_TOKEN = "<<ABBR_PERIOD>>"

# Noncharacters: never assigned, reserved by Unicode for a program's own marks.
OPEN, CLOSE, DOT = chr(0xFDD0), chr(0xFDD1), chr(0xFDD2)

_ELLIPSIS = r"\.\.\.+"
_SENTENCE_GAP = rf"(?<=[.!?]){SPACE}+"


@dataclass(frozen=True)
class Profile:
    name: str
    min_length: int | None
    version_numbers: bool = True
    drops_punctuation: bool = False
    skips_before_comma_or_end: bool = True
    skips_before_capital: bool = False
    strips: bool = True


PROFILES = {
    p.name: p
    for p in (
        Profile("prod", None),
        Profile("drop_punct", 10, version_numbers=False, drops_punctuation=True, skips_before_comma_or_end=False),
        Profile("full", 10),
        Profile("full_lookahead", 10, skips_before_capital=True),
        Profile("simple", None, skips_before_comma_or_end=False, strips=False),
    )
}


def profile_of(profile: str | Profile) -> Profile:
    if isinstance(profile, Profile):
        return profile
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; choose from {sorted(PROFILES)}")
    return PROFILES[profile]


def _dotted(names: list[str]) -> str:
    return "(?:" + "|".join(n.replace(".", r"\.") for n in names) + r")\."


def _dotted_by_letter(names: list[str]) -> str:
    """As ``_dotted`` for names of which none with its period begins another; a letter is tried once for all its names."""
    ends: dict[str, list[str]] = {}
    for n in names:
        ends.setdefault(n[0], []).append(n[1:].replace(".", r"\."))
    return "(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in ends.items()) + r")\."


def match_pattern(profile: str | Profile) -> str:
    """Everything the profile recognises, exceptions not yet applied.

    The long lists begin with the characters that a match can begin with: at most positions of a text that
    is all that is tried.
    """
    p = profile_of(profile)
    if p.name == "prod":
        return (
            rf"{WORD_STARTS}[A-Z]\.{SPACE}(?=[A-Z])|{WORD_STARTS}[A-Z]{{1,3}}\.(?={WORD})"
            rf"|etc\.|{_dotted(SHORT_LIST)}"
        )
    names = LONG_LIST + (EXTRA_BUSINESS if p.version_numbers else [])
    digits = r"\p{Nd}+"
    version = rf"{digits}\.{digits}\.{digits}{WORD_ENDS}|" if p.version_numbers else ""
    small = "".join(sorted({n[0] for n in names if not "A" <= n[0] <= "Z"}))
    return (
        rf"(?=[\p{{Nd}}A-Z{small}]){WORD_STARTS}"
        rf"(?:{version}{digits}\.{digits}{WORD_ENDS}|{digits}\.|[A-Z]\.|{_dotted_by_letter(names)})"
        rf"|{_ELLIPSIS}"
    )


def _mark_matches(text: Column, p: Profile) -> Column:
    return F.regexp_replace(text, f"({match_pattern(p)})", f"{OPEN}$1{CLOSE}")


def _mark_protected(text: Column, p: Profile) -> Column:
    """Marks around matches whose periods are protected under the profile."""
    inside = f"([^{OPEN}{CLOSE}]*)"
    marked = _mark_matches(text, p)
    if p.drops_punctuation:
        return marked
    # "etc." and an ellipsis may end a sentence, so they are never protected.
    dropped = [rf"{OPEN}(etc\.|{_ELLIPSIS}){CLOSE}"]
    following = []
    if p.skips_before_comma_or_end:
        following += [",", r"\z"]
    if p.skips_before_capital:
        following.append(rf" +{OPEN}?\p{{IsUppercase}}")
    for pattern in dropped:
        marked = F.regexp_replace(marked, pattern, "$1")
    if following:
        marked = F.regexp_replace(marked, rf"{OPEN}{inside}{CLOSE}(?={'|'.join(following)})", "$1")
    return marked


def _replace_marked_periods(marked: Column, replacement: str) -> Column:
    # After a period inside a match only digits, periods, "e"/"g" and one space can
    # follow; naming them keeps the look-ahead short on long unmarked text.
    return F.regexp_replace(marked, rf"\.(?=[\p{{Nd}}.eg]*{SPACE}?{CLOSE})", replacement)


def _without_marks(piece: Column, marks: str, instead: str = "") -> Column:
    """``translate``, which builds a text character by character, only where a piece has a mark."""
    marked = reduce(operator.or_, [piece.contains(m) for m in marks])
    return F.when(marked, F.translate(piece, marks, instead)).otherwise(piece)


def protect_abbreviations(text: Column | str, profile: str | Profile = "simple", token: str = PERIOD_TOKEN) -> Column:
    """The text with every protected period replaced by ``token``."""
    marked = _replace_marked_periods(_mark_protected(_col(text), profile_of(profile)), token)
    return F.translate(marked, OPEN + CLOSE, "")


def _prod_gap() -> str:
    names = "|".join(SHORT_LIST)
    initial = rf"(?<={WORD_STARTS}[A-Z]\.){SPACE}[A-Z]"
    return rf"(?<=[.!?])(?<!(?:{names})\.)(?!{initial}){SPACE}+"


def sentence_array(text: Column | str, profile: str | Profile = "prod") -> Column:
    """The sentences of a text, in order, as an array."""
    p, text = profile_of(profile), _col(text)
    if p.name == "prod":
        # Stripped text has no blank piece unless it is empty, and no piece with outer space.
        return F.filter(F.split(strip(text), _prod_gap()), lambda s: s != "")
    if p.drops_punctuation:
        pieces = F.split(_replace_marked_periods(_mark_protected(text, p), DOT), rf"[.!?]+{SPACE}*")
        pieces = F.transform(pieces, lambda s: strip(_without_marks(s, DOT + OPEN + CLOSE, ".")))
    else:
        pieces = F.split(_mark_protected(text, p), _SENTENCE_GAP)
        pieces = F.transform(pieces, lambda s: _without_marks(s, OPEN + CLOSE))
        if p.strips:
            pieces = F.transform(pieces, strip)
    if p.min_length:
        return F.filter(pieces, lambda s: F.length(s) >= p.min_length)
    return pieces


def split_sentences(df: DataFrame, text_col: str = "text", profile: str | Profile = "prod") -> DataFrame:
    """One row per sentence: every other column of ``df``, then ``pos`` (from 0) and ``sentence``.

    Row-local, no shuffle. The array is exploded where it is built, so the long
    regular expressions run once per article.
    """
    keys = [c for c in df.columns if c != text_col]
    return df.select(*keys, F.posexplode(sentence_array(text_col, profile)).alias("pos", "sentence"))


def abbreviation_matches(
    df: DataFrame, text_col: str = "text", profile: str | Profile = "full", pattern: str | None = None
) -> DataFrame:
    """Every abbreviation match with its start and end offset in code points."""
    keys = [c for c in df.columns if c != text_col]
    marked = F.regexp_replace(_col(text_col), f"({pattern or match_pattern(profile)})", f"{OPEN}$1{CLOSE}")
    # Outside and matched pieces alternate; the lengths before a match add up to its offset. Only lengths and
    # matches are moved, and a text with many matches takes time in proportion.
    pieces = F.split(marked, f"[{OPEN}{CLOSE}]")
    numbered = df.select(*keys, F.monotonically_increasing_id().alias("_row"), pieces.alias("_pieces"))
    placed = numbered.select(*keys, "_row", F.posexplode("_pieces").alias("_k", "_piece")).select(
        *keys, "_row", "_k", F.length("_piece").alias("_n"), F.when(F.col("_k") % 2 == 1, F.col("_piece")).alias("match")
    )
    upto = Window.partitionBy("_row").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("_n").over(upto).cast("int")
    return (
        placed.withColumn("end_offset", end)
        .filter("match IS NOT NULL")
        .select(
            *keys,
            F.floor(F.col("_k") / 2).cast("int").alias("match_no"),
            "match",
            (F.col("end_offset") - F.col("_n")).alias("start_offset"),
            "end_offset",
        )
    )
