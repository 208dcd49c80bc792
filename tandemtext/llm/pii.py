"""Personal data: exact rules first, then a character-level bidirectional LSTM with CRF transitions.

The tagger is trained on windows around the spans that the rules find in a bounded sample of documents, in
their own and in looser spellings (a telephone number without its plus, a card number with dots, ...), so it
finds spellings that the rules miss. Every span of a kind holds a digit or an at sign: windows that are
further than a window's half from the next of these can only be tagged "outside" and aren't run.
Windows overlap by half. Where two meet, both score every position, the one in whose middle it lies more than the
other; the sums make one stretch, and one best path through it is what the tagger says, so a
span that crosses windows is decided as a whole. A tagged span counts if it has the digits of its kind and
doesn't touch a span of the rules.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import lightly, nothing_kept
from .bilstm_crf import Tagger
from .common import sampled

KINDS = ("email", "ip", "card", "phone")
# Fixed values of the rules. Starts that a longer run of the same characters has ruled out are not tried again.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")
# What the rules find, as patterns of the JVM: they choose training documents and may take a few too many.
PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?<=[0-9])"
NATIVE_EMAIL = "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z0-9-]"
NATIVE_IP = rf"(?<![0-9]){PART}[.]{PART}[.]{PART}[.]{PART}(?![0-9])"
NATIVE_CARD = r"[0-9](?:[ -]?[0-9])++"
NATIVE_PHONE = r"[+][0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])"

WIDTH, STRIDE = 64, 32
EDGE = (WIDTH - STRIDE) // 2
# Documents with spans that give training windows, in expectation, those without spans, the windows of one of them, and of all.
SAMPLE_DOCS, OTHER_DOCS, WINDOWS_PER_DOC, MOST_WINDOWS = 3_000, 1_000, 6, 3_000
ROUNDS = 6
BATCH = 2_048
# Texts that are held as Python objects at once.
ROWS_AT_ONCE = 1_000
SYMBOLS = 130  # ASCII, any other character, outside the text
LABELS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small_part(part: str) -> bool:
    rest = part.lstrip("0")
    return len(rest) <= 3 and int(rest or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match begins where the run of local characters before its at sign does, or where the last match ended."""
    ended, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > ended and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at + 1) if begin < at and at >= ended else None
        if found:
            yield begin, found.end()
            ended = found.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the rules, by start and kind."""
    spans = [(a, b, 0) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(map(_small_part, m.group().split("."))):
            spans.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if 12 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                spans.append((m.start(), m.end(), 3))
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def plausible(text: str, kind: int) -> bool:
    """What a tagged span must have to count."""
    digits = _digits(text)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+\.[^\s@]+", text)) and text[-1].isalnum()
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(map(_small_part, parts)) and not re.search(r"[A-Za-z]", text)
    if re.search(r"[^0-9 ().+/-]", text):
        return False
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    # An unbroken run of digits is a number like any other.
    return 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", text)) >= 3


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), 128).astype(np.uint8)


def _windows(codes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Symbols of windows; window k covers STRIDE * k - STRIDE + ... for k from 0, so that a text's start has a middle."""
    places = numbers[:, None] * STRIDE - STRIDE + np.arange(WIDTH)[None, :]
    inside = (places >= 0) & (places < len(codes))
    return np.where(inside, codes[np.clip(places, 0, max(0, len(codes) - 1))], SYMBOLS - 1)


def _numbers(text: str) -> np.ndarray:
    """Windows that can hold part of a span: those near a digit or at sign."""
    anchors = np.array([m.start() for m in ANCHOR.finditer(text)], dtype=np.int64)
    if not len(anchors):
        return anchors
    middle = np.unique((anchors + STRIDE - EDGE) // STRIDE)
    last = (len(text) - 1 + STRIDE - EDGE) // STRIDE
    near = np.unique(np.concatenate([middle - 1, middle, middle + 1]))
    return near[(near >= 0) & (near <= last)]


def _follows(numbers: np.ndarray) -> np.ndarray:
    """Whether each window of a text begins in the middle of the one before it."""
    return np.diff(numbers, prepend=-2) == 1


def _tagged(labels: np.ndarray, numbers: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(start, end, kind) from the labels of the half windows of one text."""
    # The first half of each window, and the second one of each stretch's last.
    halves = np.sort(np.concatenate([numbers, numbers[~np.append(_follows(numbers)[1:], False)] + 1]))
    places = (halves[:, None] * STRIDE - STRIDE + np.arange(STRIDE)[None, :]).ravel()
    labels = labels.ravel()
    spans: list[tuple[int, int, int]] = []
    marked = np.flatnonzero((labels > 0) & (places >= 0) & (places < size))
    for i in marked.tolist():
        place, kind, begins = int(places[i]), (int(labels[i]) - 1) // 2, labels[i] % 2 == 1
        if spans and not begins and spans[-1][1] == place and spans[-1][2] == kind:
            spans[-1] = (spans[-1][0], place + 1, kind)
        else:
            spans.append((place, place + 1, kind))
    return spans


def added_spans(text: str, tagged: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Tagged spans, trimmed, that are plausible, complete and apart from the rules' spans.

    Both lists are by start, and tagged spans don't overlap, so one pass over both is enough.
    """
    found = []
    # The furthest end of the rules' spans that start before each of them and with it.
    starts, ends = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    for start, end, kind in tagged:
        while start < end and (text[start].isspace() or text[start] in ".,;:!?"):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        # Not a part of a longer word or number.
        if end <= start or start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
            continue
        before = bisect_left(starts, end)
        if plausible(text[start:end], kind) and not (before and ends[before - 1] > start):
            found.append((start, end, kind))
    return found


def _looser(span: str, kind: int, which: int) -> str:
    """Another spelling of a span, of those that the rules miss; the span itself for some."""
    if kind == 0:
        return span if which % 2 else span.replace("@", " @ ")
    if kind == 1:
        return span if which % 2 else span.replace(".", " . ")
    if kind == 2:
        digits = _digits(span)
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return (span, ".".join(groups), "/".join(groups))[which % 3]
    digits = _digits(span)
    head, a, b, c = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    return (span, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{head}-{a}-{b}-{c}".lstrip("-"), f"{a}.{b}.{c}")[which % 5]


def training_windows(text: str, salt: int) -> list[tuple[bytes, bytes]]:
    """(symbols, labels) of windows around a text's spans, respelled, and of some without any."""
    spans = [s for s in base_spans(text) if s[2] != 2 or luhn(_digits(text[s[0] : s[1]]))]
    made: list[tuple[bytes, bytes]] = []
    for i, (start, end, kind) in enumerate(spans[: WINDOWS_PER_DOC // 2]):
        if end - start > STRIDE:
            continue
        spelled = _looser(text[start:end], kind, salt + i)
        lead = (7 * salt + 11 * i) % (WIDTH - min(WIDTH - 1, len(spelled)))
        before, after = text[max(0, start - lead) : start], text[end : end + WIDTH]
        # Other spans nearby would be labelled wrongly: they become spaces.
        before, after = ANCHOR.sub(" ", before), ANCHOR.sub(" ", after)
        body = (before + spelled + after)[:WIDTH]
        labels = np.zeros(WIDTH, dtype=np.uint8)
        labels[len(before) : len(before) + len(spelled)] = 2 + 2 * kind
        labels[len(before)] = 1 + 2 * kind
        symbols = np.full(WIDTH, SYMBOLS - 1, dtype=np.uint8)
        symbols[: len(body)] = _codes(body)
        made.append((symbols.tobytes(), labels.tobytes()))
    if not spans and text:
        numbers = _numbers(text)
        numbers = numbers[:2] if len(numbers) else np.array([(salt * 31) % (1 + len(text) // STRIDE)])
        codes = _codes(text)
        made += [(w.astype(np.uint8).tobytes(), bytes(WIDTH)) for w in _windows(codes, numbers)]
    return made


def untrained() -> Tagger:
    allowed = np.ones((LABELS, LABELS), dtype=bool)
    first = np.ones(LABELS, dtype=bool)
    for kind in range(len(KINDS)):
        begin, inside = 1 + 2 * kind, 2 + 2 * kind
        allowed[:, inside] = False
        allowed[[begin, inside], inside] = True
        # A window may begin inside a span.
    return Tagger(SYMBOLS, LABELS, allowed, first)


def has_spans(text: Column) -> Column:
    """Whether the rules find something, without Python."""
    cards = F.regexp_extract_all(text, F.lit(NATIVE_CARD), F.lit(0))
    bare = F.transform(cards, lambda c: F.translate(c, " -", ""))
    card = F.exists(bare, lambda c: F.length(c).between(12, 19) & F.call_function("luhn_check", c))
    return text.rlike(NATIVE_EMAIL) | text.rlike(NATIVE_IP) | text.rlike(NATIVE_PHONE) | card


def train_tagger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS) -> Tagger | None:
    """Fit on a bounded number of windows of a bounded sample; None where no document has spans.

    Documents with spans are sampled apart from those with other digits or at signs, so their number doesn't
    depend on how rare they are. Executors cut the windows of 64 characters; the driver gets no texts.
    """
    held = docs.filter(F.col(text_column).rlike("[0-9@]")).select(
        F.xxhash64(id_column, text_column).alias("salt"), F.col(text_column).alias("text"), has_spans(F.col(text_column)).alias("spans")
    )
    sizes = dict(held.groupBy("spans").count().collect())
    share = F.when(F.col("spans"), SAMPLE_DOCS / sizes.get(True, 1)).otherwise(OTHER_DOCS / sizes.get(False, 1))
    chosen = held.filter(sampled(F.xxhash64("salt"), share)).select("salt", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            rows = [
                (salt, *window)
                for salt, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for window in training_windows(text, salt % 997)
            ]
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["salt", "symbols", "labels"])

    windows = chosen.mapInArrow(run, "salt bigint, symbols binary, labels binary")
    rows = windows.orderBy("salt", "symbols").limit(MOST_WINDOWS).collect()
    symbols = np.frombuffer(b"".join(bytes(r.symbols) for r in rows), dtype=np.uint8).reshape(-1, WIDTH)
    labels = np.frombuffer(b"".join(bytes(r.labels) for r in rows), dtype=np.uint8).reshape(-1, WIDTH)
    if not labels.any():
        return None
    tagger = untrained()
    tagger.train(symbols.astype(np.int64), labels.astype(np.int64), rounds)
    return tagger


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """For each text the spans of the rules, and those with the tagger's, by start and kind."""
    bases = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in bases]
    numbers = [_numbers(t) for t in texts]
    found = []
    held: list[np.ndarray] = []
    pending: list[int] = []

    def flush() -> None:
        if not pending:
            return
        follows = [_follows(numbers[i]) for i in pending]
        labels = tagger.decode_overlapping(np.concatenate(held), np.concatenate(follows), BATCH)
        begin = 0
        for i, joined in zip(pending, follows):
            end = begin + len(joined) + int((~joined).sum())
            part, begin = labels[begin:end], end
            extra = added_spans(texts[i], _tagged(part, numbers[i], len(texts[i])), bases[i])
            found[i] = (bases[i], sorted(bases[i] + extra, key=lambda s: (s[0], s[2], s[1])))
        held.clear()
        pending.clear()

    waiting = 0
    for i, text in enumerate(texts):
        found.append((bases[i], bases[i]))
        if len(numbers[i]):
            held.append(_windows(_codes(text), numbers[i]))
            pending.append(i)
            waiting += len(numbers[i])
            if waiting >= BATCH:
                flush()
                waiting = 0
    flush()
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the name of its first kind."""
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a bounded number of rows."""
    nothing_kept()
    for batch in lightly(batches):
        for begin in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(begin, ROWS_AT_ONCE)


def _mapped(docs: DataFrame, tagger: Tagger | None, answer, result: str, kinds: list[pa.DataType]) -> DataFrame:
    """``_key`` and ``answer(text, base, spans)`` for rows of (_key, text)."""
    names = [part.split()[0] for part in result.split(", ")]
    schema = f"_key {docs.schema['_key'].dataType.simpleString()}, {result}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = [t if t is not None else "" for t in batch.column(1).to_pylist()]
            if texts:
                rows = [answer(t, base, spans) for t, (base, spans) in zip(texts, all_spans(texts, tagger))]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_key", *names])

    return docs.mapInArrow(run, schema)


def find_personal_data(
    docs: DataFrame, tagger: Tagger | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row; counts and digest are the rules'.

    NULL and empty texts have no spans. Positions are code points, ends exclusive. Rows stand alone: repeated
    rows, NULL ids and texts of any length are fine; other columns are ignored.
    """

    def answer(text, base, spans):
        counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
        return *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)

    result = ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"
    given = docs.select(F.col(id_column).alias("_key"), F.col(text_column).alias("text"))
    found = _mapped(given, tagger, answer, result, [pa.int64()] * len(KINDS) + [pa.string()] * 2)
    return found.withColumnRenamed("_key", "doc_id")


def redact_personal_data(docs: DataFrame, tagger: Tagger | None, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by ``<KIND>``.

    NULL texts stay NULL. Rows stand alone: repeated rows, NULL ids and columns of any name pass through.
    """
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = batch.column(place).to_pylist()
            spans = all_spans([t or "" for t in texts], tagger)
            clean = [t and redacted(t, found) for t, (_, found) in zip(texts, spans)]
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(clean, field.type))

    return docs.mapInArrow(run, docs.schema)
