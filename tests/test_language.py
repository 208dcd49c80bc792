import random

from pyspark.sql import functions as F

import spec
from tandemtext.functions.language import is_english_by_lexicon, is_english_by_patterns
from tandemtext.functions.text import first_words, same_text, word_count, words
from tandemtext.operators.filters import article_split_stats, filter_english, filter_min_length
from tandemtext.operators import language_model
from tandemtext.operators.language_model import bare_word, bare_words, classify_words, distinct_words, flag_english, train_language_model


def test_predicates_agree_with_spec(texts):
    rng = random.Random(5)
    bits = "the The with_ for, from with. was i I it's that café ang sa mga balay tubig into Into than 42 , . - most".split()
    values = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(3000)] + ["", " \t ", " the "]
    rows = texts(values).select(
        "doc_id", is_english_by_patterns("text").alias("p"), is_english_by_lexicon("text").alias("l")
    )
    for r in rows.collect():
        text = values[r["doc_id"]]
        assert r["p"] == spec.is_english(text, lexicon=False), repr(text)
        assert r["l"] == spec.is_english(text, lexicon=True), repr(text)


def test_null_text_is_kept(spark):
    df = spark.createDataFrame([(None,), ("the and that",)], "sentence STRING")
    assert [r[0] for r in filter_english(df, method="patterns").collect()] == [None]


def test_words_and_heads(texts):
    row = texts(["  one\ttwo three four\n"]).select(
        words("text").alias("w"), word_count("text").alias("n"), first_words("text").alias("h"), same_text("text", F.lit("one")).alias("s")
    ).first()
    assert row["w"] == ["one", "two", "three", "four"] and row["n"] == 4 and row["h"] == "one two three" and not row["s"]


def test_min_length_counts_characters(spark):
    df = spark.createDataFrame([("é" * 9,), ("é" * 10,)], "sentence STRING")
    assert filter_min_length(df).count() == 1


def test_article_stats(spark):
    df = spark.createDataFrame([(1, ["the and that with a dog", "ang balay sang tawo"]), (2, [])], "doc_id BIGINT, sentences ARRAY<STRING>")
    rows = {r["doc_id"]: r for r in article_split_stats(df).collect()}
    assert (rows[1]["found"], rows[1]["kept"], rows[1]["skipped"]) == (2, 1, 1)
    assert rows[1]["skipped_heads"] == ["the and that"]
    assert rows[2]["found"] == 0


def test_bare_words_are_those_of_each_word(texts):
    values = ["", " \u2003 ", "42", "a 42  b-c\u00a0D!\t", "ΟΔΟΣ, ΟΔΟΣ. ΣΑΣ'Σ", "İstanbul ǅ x\u0301y", " Straße\u2028ÉTÉ ", "!", "_a_ 日本 語"]
    rows = texts(values).select(bare_words("text").alias("all"), F.transform(words("text"), bare_word).alias("each")).collect()
    assert [r["all"] for r in rows] == [r["each"] for r in rows] and rows[3]["all"] == ["a", "", "bc", "d"]


LABELLED = [("en", "the weather there is with the other brother"), ("hil", "ang balay sang tawo nga ginbakal sang mga kabataan")]


def test_word_model_classifies_its_own_words(spark):
    model = train_language_model(spark.createDataFrame(LABELLED, "lang STRING, text STRING"))
    vocabulary = distinct_words(spark.createDataFrame([("weather, Balay! 42",)], "t STRING"), "t")
    got = {r["word"]: r["lang"] for r in classify_words(vocabulary, model).collect()}
    assert got == {"weather": "en", "balay": "hil"}


def test_a_sentence_is_english_only_if_every_word_is(spark):
    model = train_language_model(spark.createDataFrame(LABELLED, "lang STRING, text STRING"))
    values = ["the weather is there", "the balay is there", "the weather 42", "", "Brother."]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id BIGINT, sentence STRING")
    got = {r["doc_id"]: r["is_english"] for r in flag_english(df, model, ["doc_id"]).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: True}
    kept = filter_english(df, model=model, keys=["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]


def test_null_keys_and_texts_are_kept(spark):
    model = train_language_model(spark.createDataFrame(LABELLED, "lang STRING, text STRING"))
    rows = [(1, None), (None, "ang balay sang tawo"), (None, "the weather is there"), (1, "brother"), (None, None)]
    got = flag_english(spark.createDataFrame(rows, "doc_id BIGINT, sentence STRING"), model).collect()
    assert sorted((r["sentence"] or "", r["is_english"]) for r in got) == [
        ("", False), ("", False), ("ang balay sang tawo", False), ("brother", True), ("the weather is there", True)
    ]


def test_hundreds_of_languages(spark):
    labelled = [(f"l{i:03}", f"q{i:03}q z{i:03}z") for i in range(600)]
    model = train_language_model(spark.createDataFrame(labelled, "lang STRING, text STRING"))
    letters = spark.createDataFrame([("aa", "ab"), ("bb", "ba")], "lang STRING, text STRING")
    small = train_language_model(letters)
    assert model.languages.count() in (0, 600)  # digits are no letters: all words are alike
    got = {r["word"]: r["lang"] for r in classify_words(distinct_words(spark.createDataFrame([("ab ba zz",)], "t STRING"), "t"), small).collect()}
    assert got == {"ab": "aa", "ba": "bb", "zz": None}


# Little English and more German: an unknown word would get English, whose score of the unseen is best.
UNEVEN = [("en", "the weather there is"), ("de", "der Hund und die Katze gehen heute mit dem Kind in den Garten " * 3)]


def test_a_word_of_no_known_language_keeps_its_sentence(spark):
    model = train_language_model(spark.createDataFrame(UNEVEN, "lang STRING, text STRING"))
    values = ["漢字 仮名", "привет мир", "the weather", "the weather мир", "der Hund", "xyzzyq", "the weather xyzzyq"]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id BIGINT, sentence STRING")
    got = {r["doc_id"]: r["is_english"] for r in flag_english(df, model).collect()}
    assert got == {i: i == 2 for i in range(len(values))}
    kept = {r["sentence"] for r in filter_english(df, model=model).collect()}
    assert kept == set(values) - {"the weather"}


def test_least_known_share(spark):
    model = train_language_model(spark.createDataFrame(UNEVEN, "lang STRING, text STRING"))
    # Two of five n-grams of "thezz" are known, all of "weather".
    vocabulary = spark.createDataFrame([("thezz", 1), ("weather", 1)], "word STRING, n BIGINT")
    found = lambda share: {r["word"]: r["lang"] for r in classify_words(vocabulary, model, share).collect()}
    assert found(0.4) == {"thezz": "en", "weather": "en"}
    assert found(0.41) == {"thezz": None, "weather": "en"}


def test_a_model_of_nothing_detects_nothing(spark):
    model = train_language_model(spark.createDataFrame([], "lang STRING, text STRING"))
    df = spark.createDataFrame([("the weather",)], "sentence STRING")
    assert [r["is_english"] for r in flag_english(df, model).collect()] == [False]


def test_a_large_profile_is_joined_with_salts(spark, monkeypatch):
    model = train_language_model(spark.createDataFrame(LABELLED + UNEVEN, "lang STRING, text STRING"))
    vocabulary = distinct_words(spark.createDataFrame([("weather Balay Katze мир the other kind gehen",)], "t STRING"), "t")
    small = sorted(map(tuple, classify_words(vocabulary, model).collect()))
    monkeypatch.setattr(language_model, "fits_in_memory", lambda table: False)
    assert sorted(map(tuple, classify_words(vocabulary, model).collect())) == small


def test_helper_names_pass_through(spark):
    model = train_language_model(spark.createDataFrame(LABELLED, "lang STRING, text STRING"))
    df = spark.createDataFrame([("the weather", 7, "w", "r", "o")], "sentence STRING, _row INT, _words STRING, _rest STRING, _OTHER STRING")
    assert [tuple(r) for r in flag_english(df, model).collect()] == [("the weather", 7, "w", "r", "o", True)]
