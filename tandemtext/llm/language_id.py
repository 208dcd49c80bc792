"""Language identification, words first: log frequencies of known words, shorter and shorter character n-grams else.

The model is fitted on a bounded sample of labelled texts: ``SAMPLE_DOCS`` documents in
expectation, and ``LEAST_DOCS`` of every language that has so many, chosen by a hash of their ids. What
they hold is counted in full, n-grams too, so rare languages keep their words. The model doesn't grow with
the number of rows and may be sent to every task; prediction then reads each text once, whole, where it lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .arrow import kept_in_worker, lightly, per_text
from .common import crc_remainder, sampled

SAMPLE_DOCS, LEAST_DOCS = 5_000, 500
ORDERS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
# Added to every count, so that a language that lacks a word is unlikely, not impossible.
SMOOTHING = 0.1
MOST_WORDS = 150_000
# Numbers of a table that is kept as whole rows in a worker; others stay as gains.
DENSE = 4_000_000
LETTERS = regex.compile(r"\p{L}+")


class Table:
    """Log frequencies of keys by language: a base for each language, and gains where a language has the key.

    Keys are 64-bit hashes in order, so a table takes some 20 bytes for each (language, key) pair, however many
    languages there are.
    """

    def __init__(self, counts: list[dict[str, int]]) -> None:
        """``counts`` of each language."""
        langs = np.repeat(np.arange(len(counts), dtype=np.int32), [len(c) for c in counts])
        hashes = np.fromiter((xxh3_64_intdigest(key) for c in counts for key in c), dtype=np.uint64, count=len(langs))
        values = np.fromiter((n for c in counts for n in c.values()), dtype=np.float64, count=len(langs))
        order = np.argsort(hashes, kind="stable")
        self.keys, starts = np.unique(hashes[order], return_index=True)
        self.starts = np.append(starts, len(langs)).astype(np.int64)
        self.langs = langs[order]
        self.gains = np.log(values[order] / SMOOTHING + 1).astype(np.float32)
        totals = np.bincount(langs, weights=values, minlength=len(counts))
        self.base = np.log(SMOOTHING / (totals + SMOOTHING * max(1, len(self.keys)))).astype(np.float32)
        self.places: dict[int, int] | None = None

    def _open(self) -> None:
        """Places by hash, and whole rows where they are few: made where they are used, once per worker."""
        self.places = dict(zip(self.keys.tolist(), range(len(self.keys))))
        self.rows = None
        if len(self.keys) * len(self.base) <= DENSE:
            self.rows = np.repeat(self.base[None, :], len(self.keys), axis=0)
            self.rows[np.repeat(np.arange(len(self.keys)), np.diff(self.starts)), self.langs] += self.gains

    def mean(self, keys: list[str]) -> np.ndarray | None:
        """Over those of ``keys`` that are known; None where none is."""
        if self.places is None:
            self._open()
        get = self.places.get
        found = [place for key in keys if (place := get(xxh3_64_intdigest(key))) is not None]
        if not found:
            return None
        if self.rows is not None:
            return self.rows[found[0]] if len(found) == 1 else np.add.reduce(self.rows[found]) / np.float32(len(found))
        gains = np.zeros_like(self.base)
        for place in found:
            here = slice(self.starts[place], self.starts[place + 1])
            gains[self.langs[here]] += self.gains[here]
        return self.base + gains / np.float32(len(found))


def _grams(word: str, order: int) -> list[str]:
    """N-grams of the padded word; the padding alone says nothing."""
    padded = f" {word} "
    return list(word) if order == 1 else [padded[i : i + order] for i in range(len(padded) - order + 1)]


class Model:
    """Per-language log frequencies of words and of n-grams of padded words."""

    def __init__(self, counts: list[tuple[str, str, int]]) -> None:
        """``counts``: (language, word, count)."""
        self.key = hashlib.sha256(repr(sorted(counts)).encode()).hexdigest()
        self.languages = sorted({lang for lang, _, _ in counts})
        words: dict[str, dict[str, int]] = {lang: {} for lang in self.languages}
        for lang, word, n in counts:
            words[lang][word] = words[lang].get(word, 0) + n
        self.tables = [Table(list(words.values()))]
        for order in ORDERS:
            found = []
            for held in words.values():
                grams: dict[str, int] = {}
                for word, n in held.items():
                    for gram in _grams(word, order):
                        grams[gram] = grams.get(gram, 0) + n
                found.append(grams)
            self.tables.append(Table(found))

    def word(self, word: str) -> np.ndarray | None:
        """None for a word that holds no known n-gram."""
        found = self.tables[0].mean([word])
        for table, order in zip(self.tables[1:], ORDERS):
            if found is not None:
                break
            grams = _grams(word, order)
            found = table.mean(grams) if grams else None
        return found


class Predictor:
    """Texts to (language, score); rows of seen words are kept until there are too many."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.languages)), dtype=np.float32)
        self.unknown: set[str] = set()

    def _row(self, word: str) -> int:
        row = self.index[word] = len(self.index)
        if row == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        found = self.model.word(word)
        if found is None:
            self.rows[row] = 0
            self.unknown.add(word)
        else:
            self.rows[row] = found
        return row

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the model knows a word of the text, or an n-gram of one."""
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.model.languages:
            return UNKNOWN, 0.0, False
        if len(self.index) > MOST_WORDS:
            self._clear()
        for word in set(words).difference(self.index):
            self._row(word)
        places = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        total = self.rows[places].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        known = not self.unknown or not self.unknown.issuperset(words)
        return self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum()), known


def _predictor(model: Model) -> Predictor:
    return kept_in_worker(f"language_{model.key}", lambda: Predictor(model))


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """Fit on a bounded sample of rows that have a text and a label; no labelled rows give a model that knows nothing.

    A language is sampled by its share of the rows, but for ``LEAST_DOCS`` of its rows or all that it has. All
    words of the sample count.
    """
    held = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    )
    labelled = held.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = labelled.groupBy("lang").count().collect()  # one row for each language
    if not sizes:
        return Model([])
    n = sum(size for _, size in sizes)
    shares = [(lang, min(1.0, max(SAMPLE_DOCS / n, LEAST_DOCS / size))) for lang, size in sizes]
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))
    chosen = labelled.join(share, "lang").filter(sampled(F.xxhash64("id", F.lit("language")), F.col("share")))
    counted = (
        chosen.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .filter("word <> ''")
        .groupBy("lang", "word")
        .count()
    )
    return Model([tuple(row) for row in counted.collect()])


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the language's share of the likelihood, uniform before) for every row.

    NULL texts and texts without a letter are ``und`` with score 0. Ties go to the first
    language by name. Every row stands alone: repeated rows and NULL ids are fine, other columns
    are ignored, texts are read whole.
    """
    return per_text(docs, lambda: _predictor(model), "lang_pred string, score double", id_column, text_column)


def held_out_predictions(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Predictions for all documents by a model that never saw those with crc32(doc_id) mod 5 = 0."""
    fold = crc_remainder("doc_id", folds)
    model = train(docs.filter(fold != 0))
    found = predict(docs, model)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.0, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, of a score of ``least``; each row is judged where it lies.

    Texts in which the model knows no word, and no n-gram of any length, have none: their scores are all the same.
    A model that knows no language can't reject one: then every text with a letter stays. NULL and empty texts go. Repeated
    rows go or stay together, ids play no part, and columns of any name pass through.
    """
    place = docs.columns.index(text_column)
    learned = bool(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _predictor(model).judge
        for batch in lightly(batches):
            if learned:
                found = [judge(text.as_py()) for text in batch.column(place)]
                kept = [known and score >= least for _, score, known in found]
            else:
                kept = [bool(LETTERS.search(text.as_py() or "")) for text in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
