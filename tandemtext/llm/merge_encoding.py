"""Exact encoding with merge-type vocabularies of the SentencePiece kind, by backtracking.

Longest matches come from an Aho-Corasick automaton. A token may follow another only if
merging their joined characters anew gives the same two tokens; otherwise a shorter match is
tried, and a position from which all matches failed is marked in a bit field and left
for good. Vocabularies in which no piece has a word mark inside are cut before every run
of word marks without changing the result, so each distinct word is encoded once per worker.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from .arrow import Remembered, kept_in_worker, per_text

MARK = "▁"
# Cached words and token pairs of one Python worker.
MOST_WORDS = 1_200_000
MOST_PAIRS = 300_000


class Vocabulary:
    """Pieces, ranks and byte tokens of a merge-type model; plain data that travels with the job."""

    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(len(self.pieces))]
        self.ids = {p: i for i, (p, odd) in enumerate(zip(self.pieces, special)) if not odd}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.unknown = sp.unk_id()
        self.has_bytes = sp.is_byte(self.byte_ids[0])
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a word mark inside: words can't be encoded alone")
        if sp.normalize("  a\tb  ﬁ ") != f"{MARK}{MARK}{MARK}a\tb{MARK}{MARK}ﬁ{MARK}":
            raise ValueError("the model normalises its text; only identity with a leading mark is supported")


def unit_pattern(vocabulary: Vocabulary) -> re.Pattern:
    """Words with their leading marks; control characters that no piece holds stand alone."""
    alone = "".join(re.escape(c) for c in map(chr, range(32)) if not any(c in p for p in vocabulary.ids))
    return re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))


class Encoder:
    """Words to token ids. Built once per task from a vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.characters = {p for p in vocabulary.ids if len(p) == 1}
        self.codes = {i: b for b, i in vocabulary.byte_ids.items()} if vocabulary.has_bytes else {}
        # Neighbours that no piece holds are never merged across: texts may be cut between them.
        self.joined = {a + b for piece in vocabulary.ids for a, b in zip(piece, piece[1:])}
        self.pairs = Remembered(lambda pair: self.merge(pair[0] + pair[1]) == list(pair), MOST_PAIRS)
        self.found = ahocorasick.Automaton()
        for piece in vocabulary.ids:
            # Pieces that merging never builds from their own characters can't be in any result.
            if self.merge(piece) == [piece]:
                self.found.add_word(piece, piece)
        self.found.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Merge neighbours by the best score, the leftmost first, until nothing merges."""
        parts, scores = list(text), self.v.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def known(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all in the vocabulary."""
        if len(text) == 1:
            return [text]
        # Compatible neighbours throughout mean the one exact result, and longest matches often are.
        longest = [piece for _, piece in self.found.iter_long(text)]
        if all(map(self.pairs.__getitem__, zip(longest, longest[1:]))):
            return longest
        starts: list[list[str]] = [[] for _ in text]
        for end, piece in self.found.iter(text):  # ends ascend, so each start gets its matches by length
            starts[end - len(piece) + 1].append(piece)
        size, pairs = len(text), self.pairs
        failed = bytearray(size + 1)  # as a field of bits; a byte each is as small as it needs to be here
        taken: list[str] = []
        tried: list[int] = []  # for each taken piece, how many shorter matches are left at its start
        at, left = 0, len(starts[0])
        while at < size:
            options, chosen = starts[at], None
            while left:
                left -= 1
                piece = options[left]
                if not failed[at + len(piece)] and (not taken or pairs[taken[-1], piece]):
                    chosen = piece
                    break
            if chosen is None:
                failed[at] = 1
                at -= len(taken.pop())  # some path exists: single characters always match
                left = tried.pop()
                continue
            taken.append(chosen)
            tried.append(left)
            at += len(chosen)
            left = len(starts[at]) if at < size else 0
        return taken

    def cut(self, text: str) -> list[str]:
        """The text in parts that are encoded independently."""
        joined = self.joined
        places = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in joined]
        return [text[a:b] for a, b in zip([0, *places], [*places, len(text)])]

    def tokens(self, text: str) -> list[int]:
        """Ids of a text with marks in place; characters outside the vocabulary become byte tokens."""
        piece_ids = self.v.ids
        if self.characters.issuperset(text):
            return [piece_ids[p] for p in self.known(text)] if text else []
        ids: list[int] = []
        begin = 0
        for i, c in enumerate(text):
            if c not in self.characters:
                ids += [piece_ids[p] for p in self.known(text[begin:i])] if i > begin else []
                ids += [self.v.byte_ids[b] for b in c.encode()] if self.v.has_bytes else [self.v.unknown]
                begin = i + 1
        ids += [piece_ids[p] for p in self.known(text[begin:])] if begin < len(text) else []
        return ids

    def decoded(self, ids: list[int]) -> str:
        """Pieces joined, byte tokens read as UTF-8, marks as spaces."""
        out: list[str] = []
        held = bytearray()
        codes = self.codes
        for i in ids:
            if i in codes:
                held.append(codes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.v.pieces[i].replace(MARK, " "))
        return "".join(out) + held.decode("utf-8", "replace")


def encode_texts(docs: DataFrame, model: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string for every row.

    Texts are encoded whole, without begin or end ids. NULL and empty texts give no ids and
    an empty text. Any length, repeated rows and NULL ids are fine: each row stands alone.
    """
    return per_text(docs, _maker(model, _full), "ids array<int>, decoded string", id_column, text_column)


def encoding_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """As ``encode_texts``, but the number of ids and SHA-256 digests of ids and decoded text."""
    return per_text(docs, _maker(model, _digests), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _full(parts) -> tuple:
    return [int(i) for ids, _ in parts if ids for i in ids.split(",")], _without_lead(parts)


def _digests(parts) -> tuple:
    ids = ",".join([ids for ids, _ in parts])
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return ids.count(",") + 1 if ids else 0, digest(ids), digest(_without_lead(parts))


def _without_lead(parts) -> str:
    """The decoded text; the space of the mark set before every text goes."""
    return "".join([text for _, text in parts])[1:]


def _words(model: bytes):
    encoder = Encoder(Vocabulary(model))

    def word(unit: str) -> tuple[str, str]:
        parts = encoder.cut(unit) if len(unit) > 1 else [unit]
        if len(parts) > 1:
            found = [words[part] for part in parts]
            return ",".join([ids for ids, _ in found]), "".join([text for _, text in found])
        ids = encoder.tokens(unit)
        return ",".join(map(str, ids)), encoder.decoded(ids)

    words = Remembered(word, MOST_WORDS)
    return words, unit_pattern(encoder.v).findall


def _maker(model: bytes, finish):
    def make():
        words, units = kept_in_worker(f"pieces_{hashlib.sha256(model).hexdigest()}", lambda: _words(model))

        def step(text: str | None) -> tuple:
            if not text:
                return finish([])
            return finish([words[u] for u in units(MARK + text.replace(" ", MARK))])

        return step

    return make
