import random
import re

import pytest
from pyspark.sql import functions as F

import spec
from tandemtext.functions.sentences import (
    LONG_LIST,
    PERIOD_TOKEN,
    PROFILES,
    abbreviation_matches,
    match_pattern,
    protect_abbreviations,
    sentence_array,
    split_sentences,
)

# One text per rule of the profile "full": what the periods of a rule do and don't end.
BY_RULE = {
    "title": "The choir sang for Mrs. Okafor at noon. Afterwards Mr. Lindqvist spoke.",
    "rank": "Orders from Capt. Mbeki reached Sgt. Ruiz too late. Nobody moved.",
    "degree": "Her sister holds an MBA. from Porto and a PhD. from Lund. Both are framed.",
    "business": "Shares of Norbrook Ltd. rose while Tamarind Corp. fell. Trading stopped early.",
    "decimal": "Rain reached 12.75 millimetres by dawn. Wind stayed under 3.2 knots.",
    "version": "Release 4.0.12 fixes the login page. Release 4.1.0 is planned for May.",
    "list number": "Steps: 1. peel the mango 2. slice it thinly. Serve it cold at once.",
    "latin": "Small birds, e.g. wrens, nest early, i.e. in March. Others wait.",
    "reference": "The map in Fig. 7 and the table in Vol. 3 disagree. We trust the map.",
    "ellipsis": "The old ferry turned slowly... Then the engine died.",
    "et cetera": "They packed ropes, lamps, etc. Nobody packed any food.",
    "before a comma": "Paid to Harbour Inc., the fee was small. It was never returned.",
    "at the end": "The parcel was signed for by Tamarind Corp.",
    "initial": "A note from E. Solberg lay on the desk. It was unsigned.",
    "marks": "Stop that right now! Who left the gate open? The goats, of course.",
    "short piece": "Hm. Only the second of these two is long enough.",
    "white space": "Lamps went out.\n\nSomeone laughed.\tA door closed.   Silence again.",
    "nothing": "",
    "no mark": "a line without any closing mark",
    "mixed": "Did Lt. Varga call 9.30 late? Prof. Iyer, of Delta Inc., said so. The rest of vol. 2 is lost...",
}
# How many sentences a reader of the rules expects.
EXPECTED = {
    "title": 2, "rank": 2, "decimal": 2, "version": 2, "ellipsis": 2, "marks": 3, "short piece": 1,
    "white space": 4, "nothing": 0, "no mark": 1, "at the end": 1,
}

PROD = [
    ("The baker R. Haugen opens at six.", None),
    ("Ask Prof. T. Nakata about the tides.", None),
    ("Letters from K. Obi and L. Farah were kept.", None),
    ("The harbour froze. P. Quist stayed.", ["The harbour froze.", "P. Quist stayed."]),
    # Short names protect even inside a word.
    ("We tuned the piano. It rained.", None),
    ("Snow fell... Then etc. came the thaw.", ["Snow fell...", "Then etc.", "came the thaw."]),
]


def split(texts, values, profile):
    rows = texts(values).select("doc_id", sentence_array("text", profile).alias("s")).orderBy("doc_id").collect()
    return [r["s"] for r in rows]


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_rules_one_by_one(texts, profile):
    for (rule, text), got in zip(BY_RULE.items(), split(texts, list(BY_RULE.values()), profile)):
        assert got == spec.sentences(text, profile), rule
        if profile == "full" and rule in EXPECTED:
            assert len(got) == EXPECTED[rule], (rule, got)


def test_exact_results(texts):
    for (text, expected), got in zip(PROD, split(texts, [c[0] for c in PROD], "prod")):
        assert got == spec.sentences(text, "prod") == (expected or [text])


def test_a_capital_after_a_name_ends_the_sentence_with_lookahead(texts):
    text = "Yesterday Mrs. Okafor called the office."
    assert split(texts, [text], "full") == [[text]]
    assert split(texts, [text], "full_lookahead") == [["Yesterday Mrs.", "Okafor called the office."]]


def random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    bits = [n + "." for n in LONG_LIST + ["LLC", "A", "B", "US", "USA", "piano", "Stop", "É", "ñ", "xDr"]]
    bits += ["3.5", "2.5.1", "1.2.3.4", "7.", "v2.5.", "10", ".", "..", "...", "....", "!", "?", "?!", ",", "(", ")", "_"]
    bits += ["word", "Word", "Éa", "e.g", "et", "al", "ǅ", "½", "٣.", "٣.٤", "p", "no", "it's", "x²"]
    gaps = [" ", " ", " ", "", "  ", "\n", "\t", " ", "\r\n", "　", "\x1f"]
    return ["".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_split_agrees_with_spec(texts, profile):
    values = random_texts(11, 3000)
    for text, got in zip(values, split(texts, values, profile)):
        assert got == spec.sentences(text, profile), repr(text)


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_protected_text_agrees_with_spec(texts, profile):
    values = random_texts(12, 3000)
    rows = texts(values).select("doc_id", protect_abbreviations("text", profile).alias("t")).orderBy("doc_id").collect()
    for text, row in zip(values, rows):
        assert row["t"] == spec.with_token(text, profile, PERIOD_TOKEN), repr(text)


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_match_offsets_agree_with_spec(texts, profile):
    values = random_texts(13, 1500) + ["8.25!", "a rise of 8.25 points by noon"]
    found: dict[int, list] = {}
    for r in abbreviation_matches(texts(values), profile=profile).collect():
        found.setdefault(r["doc_id"], []).append((r["match_no"], r["match"], r["start_offset"], r["end_offset"]))
    for i, text in enumerate(values):
        want = [(k, *m) for k, m in enumerate(spec.matches(text, profile))]
        assert sorted(found.get(i, [])) == want, repr(text)


def test_matches_of_a_given_pattern(texts):
    row = abbreviation_matches(texts(["8.25!"]), pattern=r"\d+\.\d+").first()
    assert (row["match"], row["start_offset"], row["end_offset"]) == ("8.25", 0, 4)


def test_positions_and_keys(texts):
    rows = split_sentences(texts(["One is here. Two is here.", None, " \n "]), profile="prod").collect()
    assert [(r["doc_id"], r["pos"], r["sentence"]) for r in rows] == [(0, 0, "One is here."), (0, 1, "Two is here.")]


def test_long_text_without_marks_is_linear(texts):
    text = "word and more. " * 40000
    for profile in PROFILES:
        n = texts([text]).select(F.size(sentence_array("text", profile)).alias("n")).first()["n"]
        assert n in (40000, 40001)


def test_many_matches_in_one_text(texts):
    rows = abbreviation_matches(texts(["a 1.5 " * 50_000])).orderBy("match_no").collect()
    assert len(rows) == 50_000
    assert all((r["match"], r["start_offset"], r["end_offset"]) == ("1.5", 6 * i + 2, 6 * i + 5) for i, r in enumerate(rows))


def test_unknown_profile():
    with pytest.raises(ValueError):
        sentence_array("text", "none")


def test_patterns_need_no_python(texts):
    plan = split_sentences(texts(["a"]), profile="drop_punct")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Exchange", plan)


@pytest.mark.parametrize("profile", ["drop_punct", "full", "full_lookahead", "simple"])
def test_long_lists_are_tried_where_a_match_can_begin_only(texts, profile):
    names = LONG_LIST + ([] if profile == "drop_punct" else ["LLC"])
    pattern = match_pattern(profile)
    # One character decides before anything else is tried, and each letter is tried once for all its names.
    assert pattern.startswith("(?=[") and all(pattern.count(f"|{n}|") == 0 for n in names)
    plain = "|".join(n.replace(".", r"\.") for n in names)
    version = "" if profile == "drop_punct" else r"\p{Nd}+\.\p{Nd}+\.\p{Nd}+(?![\p{L}\p{N}_])|"
    plain = (
        rf"(?<![\p{{L}}\p{{N}}_])(?:{version}\p{{Nd}}+\.\p{{Nd}}+(?![\p{{L}}\p{{N}}_])|\p{{Nd}}+\.|[A-Z]\.|(?:{plain})\.)|\.\.\.+"
    )
    rng = random.Random(8)
    bits = [n + "." for n in names] + ["1", "23", "٣", ".", "...", " ", "x", "é", "_", "Z.", "et al", "i.e", "\ufdd0", "\ufdd2", "e.", "P"]
    rows = texts(["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(600)])
    found = F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(0))
    assert rows.filter(~found.eqNullSafe(F.regexp_extract_all("text", F.lit(f"({plain})"), F.lit(0)))).count() == 0
    assert rows.filter(F.size(found) > 0).count() > 300
