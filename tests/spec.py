"""The splitting and language rules in plain Python, to test the expressions against.

Works on positions: find the protected periods, then cut the text.
"""

from __future__ import annotations

import re

from tandemtext.functions.language import INDICATORS, WORD_GROUPS
from tandemtext.functions.sentences import EXTRA_BUSINESS, LONG_LIST, SHORT_LIST


def _recogniser(profile: str) -> re.Pattern:
    # The patterns of the rule sets, in their order.
    if profile == "prod":
        names = "|".join(SHORT_LIST)
        return re.compile(rf"\b[A-Z]\.\s(?=[A-Z])|\b[A-Z]{{1,3}}\.\b|etc\.|(?:{names})\.")
    names = LONG_LIST + ([] if profile == "drop_punct" else EXTRA_BUSINESS)
    numbers = [] if profile == "drop_punct" else [r"\b\d+\.\d+\.\d+\b"]
    parts = numbers + [r"\b\d+\.\d+\b", r"\.{3,}", r"\b\d+\.", r"\b[A-Z]\."]
    return re.compile("|".join(parts + [rf"\b{re.escape(n)}\." for n in names]))


def matches(text: str, profile: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in _recogniser(profile).finditer(text)]


def protected_periods(text: str, profile: str) -> set[int]:
    found: set[int] = set()
    for hit, start, end in matches(text, profile):
        if profile != "drop_punct":
            if hit == "etc." or "..." in hit:
                continue
            if profile != "simple" and (end == len(text) or text[end] == ","):
                continue
            if profile == "full_lookahead":
                rest = text[end:]
                if rest.startswith(" ") and rest.lstrip(" ")[:1].isupper():
                    continue
        found.update(i for i in range(start, end) if text[i] == ".")
    return found


def with_token(text: str, profile: str, token: str) -> str:
    kept = protected_periods(text, profile)
    return "".join(token if i in kept else ch for i, ch in enumerate(text))


def sentences(text: str, profile: str) -> list[str]:
    kept = protected_periods(text, profile)
    stops = [i for i, ch in enumerate(text) if ch in ".!?" and i not in kept]
    pieces, begin, i = [], 0, 0
    if profile == "drop_punct":
        while i < len(stops):
            first = last = stops[i]
            while i + 1 < len(stops) and stops[i + 1] == last + 1:
                i += 1
                last = stops[i]
            pieces.append(text[begin:first])
            begin = last + 1
            while begin < len(text) and text[begin].isspace():
                begin += 1
            i += 1
    else:
        for stop in stops:
            end = stop + 1
            while end < len(text) and text[end].isspace():
                end += 1
            if end > stop + 1:
                pieces.append(text[begin : stop + 1])
                begin = end
    pieces.append(text[begin:])
    if profile == "simple":
        return pieces
    pieces = [p.strip() for p in pieces if p.strip()]
    return pieces if profile == "prod" else [p for p in pieces if len(p) >= 10]


def is_english(text: str, lexicon: bool, threshold: float = 0.3) -> bool:
    words = text.split()
    if not words:
        return False
    low = text.lower()
    tokens = re.findall(r"\w+", low)
    score = sum(tokens.count(w) for group in WORD_GROUPS for w in group)
    if lexicon:
        score += sum(w in low for w in INDICATORS)
    return score / len(words) >= threshold
