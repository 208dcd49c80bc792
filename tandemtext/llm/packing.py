"""Packing documents into training sequences by order-preserving dynamic programming.

Every task packs the rows of its scan partition in their order, so nothing is shuffled and a
task that is run again gives the same sequences. Cuts lie at ends of documents or sentences;
inside a sentence only where it is too long for a sequence, and in the last tokens of a
partition, where a finer cut saves padding. The cheapest cuts come from dynamic programming:
a window of ``d`` tokens costs its padding (``size - d``, or none if ``d`` is a power of two)
and the penalty of its cut. Padding is linear in the window's start, so the best start is
the head of a monotone queue; the few power-of-two starts are looked up besides.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string
from tokenizers import Tokenizer

from .arrow import Remembered, kept_in_worker, lightly

SIZE = 2048
END_ID = 1
# Costs in tokens of padding: what a cut after a sentence, a cut inside one, and a sequence more may save at least.
SENTENCE_CUT, HARD_CUT, SEQUENCE = 4, 24, 48
# Tokens whose cuts are decided together; the last window is carried over to the next ones.
BLOCK = 1 << 20
# Words kept by a Python worker, about 200 bytes each.
MOST_WORDS = 1_500_000
# Up to this character all Unicode versions agree on what letters and numbers are.
LAST_FAMILIAR = 0x24F


def _word_pattern() -> re.Pattern:
    """How the byte-level format splits text before its merges, for texts of familiar characters."""
    familiar = [chr(i) for i in range(LAST_FAMILIAR + 1)]
    kind = lambda k: re.escape("".join(c for c in familiar if unicodedata.category(c)[0] == k))
    letters, numbers, spaces = kind("L"), kind("N"), "\t-\r \x85\xa0"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


class CachedTokenizer:
    """Ids of whole texts as little-endian 32-bit numbers; each distinct word is encoded once per worker."""

    def __init__(self, model: bytes, most_words: int = MOST_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        self.tokenizer = Tokenizer.from_buffer(model)
        self.words = Remembered(self._whole, most_words)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = _word_pattern().findall
        self.unfamiliar = re.compile(f"[^\\x00-{chr(LAST_FAMILIAR)}]").search

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its token ends a sentence or a line."""
        ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 2, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.rstrip("\"')]").endswith((".", "!", "?", "Ċ"))
        return ends

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not text.isascii() and self.unfamiliar(text) or any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.words.__getitem__, self.split(text)))


def best_cuts(positions: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """The cheapest ascending cuts from the first position to the last, as indices into them."""
    at, penalty, n = positions.tolist(), penalties.tolist(), len(positions)
    index = np.full(at[-1] + 1, -1, dtype=np.int64)
    index[positions] = np.arange(n)
    # Pairs (end, start) that a power of two lies between, by their ends.
    pairs = []
    for power in (1 << k for k in range(size.bit_length())):
        ends = np.searchsorted(positions, power) + np.flatnonzero(index[positions[positions >= power] - power] >= 0)
        pairs.append(np.stack([ends, index[positions[ends] - power]]))
    ends, starts = np.concatenate(pairs, axis=1)
    order = np.argsort(ends, kind="stable")
    ends, starts, p = [*ends[order].tolist(), n], starts[order].tolist(), 0
    back = [0] * n
    keys = [0] * n  # cost of the best cuts up to a position, plus the position
    queue, head, tail = [0] * n, 0, 0  # starts with ascending keys
    for j in range(1, n):
        key, here = keys[j - 1], at[j]
        while tail > head and keys[queue[tail - 1]] >= key:
            tail -= 1
        queue[tail] = j - 1
        tail += 1
        while at[queue[head]] < here - size:
            head += 1
        start = queue[head]
        least = keys[start] + size - here
        while ends[p] == j:
            i = starts[p]
            if keys[i] - at[i] < least:
                least, start = keys[i] - at[i], i
            p += 1
        keys[j], back[j] = least + here + SEQUENCE + penalty[j], start
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Takes documents in order and gives rows (doc_id, start, length, crc32, doc_tokens, sequence, offset)."""

    def __init__(self, ends: np.ndarray, size: int, first_sequence: int) -> None:
        self.ends, self.size, self.sequence = ends, size, first_sequence
        self.held: list[tuple] = []  # id, ids that are left, how many went before, how many there are
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.held.append((doc_id, ids, 0, len(ids)))
        self.tokens += len(ids)

    def _positions(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([ids for _, ids, _, _ in self.held])
        kinds = np.full(self.tokens + 1, -1, dtype=np.int64)
        kinds[1:][self.ends[np.minimum(every, len(self.ends) - 1)]] = SENTENCE_CUT
        kinds[np.cumsum([len(ids) for _, ids, _, _ in self.held])] = 0
        kinds[0] = 0
        if last:
            kinds[-self.size :][kinds[-self.size :] < 0] = HARD_CUT
        soft = np.flatnonzero(kinds >= 0)
        for a, b in zip(soft[:-1][np.diff(soft) > self.size // 4], soft[1:][np.diff(soft) > self.size // 4]):
            kinds[a + self.size // 8 : b : self.size // 8] = HARD_CUT
        positions = np.flatnonzero(kinds >= 0)
        return positions, kinds[positions]

    def rows(self, last: bool) -> list[tuple]:
        if not self.tokens:
            return []
        positions, penalties = self._positions(last)
        cuts = positions[best_cuts(positions, penalties, self.size)].tolist()
        if not last:
            cuts.pop()  # what is in the last window may go on with the next document
        out: list[tuple] = []
        begin, which, used = 0, 0, 0  # used: tokens of the document that are placed
        for end in cuts[1:]:
            offset = 0
            while offset < end - begin:
                doc_id, ids, before, total = self.held[which]
                take = min(len(ids) - used, end - begin - offset)
                piece = ids[used : used + take]
                out.append((doc_id, before + used, take, zlib.crc32(piece.tobytes()), total, self.sequence, offset))
                offset, used = offset + take, used + take
                if used == len(ids):
                    which, used = which + 1, 0
            begin, self.sequence = end, self.sequence + 1
        self.held = self.held[which:]
        if used:
            doc_id, ids, before, total = self.held[0]
            self.held[0] = (doc_id, ids[used:], before + used, total)
        self.tokens = sum(len(ids) for _, ids, _, _ in self.held)
        return out


RESULT = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(
    docs: DataFrame,
    model: bytes,
    size: int = SIZE,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and ``end_id``; a NULL or empty text is ``end_id`` alone.
    Every id lies in one piece. Sequences keep the order of the rows in a partition; sequence ids
    are unique, and continue within a partition. A Python worker keeps the ids of ``most_words`` words at most. Rows that repeat an id are packed each on its
    own; NULL ids are kept. No rows give no pieces. Other columns are ignored.
    """
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = StructType([given.schema["doc_id"], *_parse_datatype_string(RESULT).fields])
    arrow = to_arrow_schema(schema)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept_in_worker(f"bytes_{hashlib.sha256(model).hexdigest()}", lambda: CachedTokenizer(model, most_words))
        packer = Packer(tokenizer.sentence_ends(), size, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in lightly(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.frombuffer(tokenizer.encode(text.as_py() or "") + end, dtype="<u4"))
                if packer.tokens >= BLOCK and (rows := packer.rows(last=False)):
                    yield table(rows)
        if rows := packer.rows(last=True):
            yield table(rows)

    return given.mapInArrow(run, schema)
