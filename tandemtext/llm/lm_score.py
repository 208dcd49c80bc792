"""Language-model scores by a weighted backoff automaton over smoothed n-grams.

The model is the n-gram counts of the whole training part, so it grows with the corpus and is
never sent anywhere whole. Documents are dealt into blocks of bounded size. A block sends the keys
of its distinct n-grams with their local counts to buckets of keys; a bucket adds them up and
answers each block in the order asked, so no key travels twice. From the answers a
block builds the part of the automaton that its own texts can visit, as sorted arrays, and walks
all its texts from left to right, one step of many texts at a time; a text carries its state from word to word.

States are the n-grams seen in training, with an arc for each word that followed and a failure arc,
taken at a cost, to the state of the shorter history:

    p(w | h) = (c(hw) + MASS * p(w | shorter h)) / (c(h) + MASS),    p(w) = (c(w) + 1) / (N + V + 1)

which sums to one over all words, the unknown one included. An unseen ``hw`` leaves MASS / (c(h) + MASS)
as the weight of the failure arc.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder

ORDER = 2
MASS = 32.0
# Characters of a block; a task needs about 40 bytes of memory for each.
BLOCK_CHARS = 12_000_000
FOLDS, HELD_OUT = 7, 2
# Tokens that are walked one after the other; more pieces at a time make fewer, larger steps.
PIECE = 256
# No word has a space inside, so this can't be one.
END = b" "
MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number


class Block:
    """The documents of one block as word numbers, and its distinct n-grams of every order in the order of their keys."""

    def __init__(self, texts: list[bytes | None], train: np.ndarray, order: int) -> None:
        numbers: dict[bytes, int] = {END: 0}
        number = numbers.setdefault
        parts, lengths = [], []
        for text in texts:
            words = text.lower().split() if text else []  # bytes: just ASCII letters and white space
            part = [number(w, len(numbers)) for w in words]
            part.append(0)
            parts.append(np.array(part, dtype=np.int64))
            lengths.append(len(part))
        self.tokens = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), dtype=">u8").reshape(-1, 2).astype(np.uint64)
        weights = np.repeat(train, self.lengths).astype(np.int64)
        place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)

        # Of each order: keys by n-gram, its number at every position, its last position, how often it was learned.
        rank = np.lexsort((digests[:, 1], digests[:, 0]))
        self.keys = [digests[rank]]
        renumbered = np.empty(len(rank), dtype=np.int64)
        renumbered[rank] = np.arange(len(rank))
        self.at = [renumbered[self.tokens]]
        self.example = [self._examples(self.at[0], len(rank))]
        self.counts = [np.bincount(self.at[0], weights=weights, minlength=len(rank)).astype(np.int64)]
        width = np.int64(len(rank))
        for n in range(2, order + 1):
            here = np.flatnonzero(place >= n - 1)
            codes = self.at[-1][here - 1] * width + self.at[0][here]
            distinct, number_at = np.unique(codes, return_inverse=True)
            mixed = (self.keys[-1][distinct // width, 0] * MIX) ^ self.keys[0][distinct % width, 0]
            mixed = (mixed ^ (mixed >> np.uint64(31))) * MIX
            mixed ^= mixed >> np.uint64(29)
            rank = np.argsort(mixed, kind="stable")
            back = np.empty(len(rank), dtype=np.int64)
            back[rank] = np.arange(len(rank))
            at = np.full(len(self.tokens), -1, dtype=np.int64)
            at[here] = back[number_at]
            self.keys.append(mixed[rank][:, None])
            self.at.append(at)
            self.example.append(self._examples(at, len(rank)))
            self.counts.append(np.bincount(at[here], weights=weights[here], minlength=len(rank)).astype(np.int64))

    @staticmethod
    def _examples(at: np.ndarray, count: int) -> np.ndarray:
        found = np.zeros(count, dtype=np.int64)
        seen = np.flatnonzero(at >= 0)
        found[at[seen]] = seen
        return found


class Automaton:
    """The states that a block's texts can visit, with their arcs and failure arcs.

    State 0 is the root; the others are the n-grams, shorter than the order, that were seen in training. An
    arc leads from a history by a word to the longest state that ends there, with the log10 probability as its
    weight. Arcs are sorted by state and word. A word without an arc at the root is unknown.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], learned: int, distinct: int) -> None:
        self.order, self.words, self.starts, self.lengths = len(totals), block.at[0], block.starts, block.lengths
        self.width = np.int64(max(1, len(totals[0])))
        self.unknown = float(-np.log10(learned + distinct + 1))
        first = np.cumsum([1, *(len(t) for t in totals)])  # the number of the first state of each length
        self.failure = np.zeros(first[self.order - 1], dtype=np.int64)
        self.cost = np.zeros(len(self.failure))
        chance = (totals[0] + 1) / (learned + distinct + 1)
        codes, weights, targets = [], [], []
        for n in range(self.order):
            last, history = block.example[n], np.zeros(len(totals[n]), dtype=np.int64)
            if n:
                history = first[n - 1] + block.at[n - 1][last - 1]
                counts = totals[n - 1][block.at[n - 1][last - 1]]
                chance = (totals[n] + MASS * chance[block.at[n - 1][last]]) / (counts + MASS)
            if n + 1 < self.order:
                here = slice(first[n], first[n + 1])
                self.cost[here] = np.log10(MASS / (totals[n] + MASS))
                if n:
                    self.failure[here] = first[n - 1] + block.at[n - 1][last]
            seen = np.flatnonzero(totals[n] > 0)
            codes.append(history[seen] * self.width + block.at[0][last[seen]])
            weights.append(np.log10(chance[seen]))
            # The longest n-grams are no states: what follows them begins at their longest end.
            longest = first[n - 1] + block.at[n - 1][last[seen]] if n else np.zeros(len(seen), dtype=np.int64)
            targets.append(first[n] + seen if n + 1 < self.order else longest)
        rank = np.argsort(np.concatenate(codes))
        self.codes, self.weights, self.targets = (np.concatenate(c)[rank] for c in (codes, weights, targets))
        self.base = np.where(totals[0] > 0, np.log10((totals[0] + 1) / (learned + distinct + 1)), self.unknown)

    def _step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probabilities of one word of each text, and the states after them."""
        total, states = np.zeros(len(states)), states.copy()
        left = np.arange(len(states))
        while len(left):
            code = states[left] * self.width + words[left]
            arc = np.searchsorted(self.codes, code)
            hit = arc < len(self.codes)
            hit[hit] = self.codes[arc[hit]] == code[hit]
            found, arc = left[hit], arc[hit]
            total[found] += self.weights[arc]
            states[found] = self.targets[arc]
            left = left[~hit]
            lost = left[states[left] == 0]
            total[lost] += self.unknown
            left = left[states[left] != 0]
            total[left] += self.cost[states[left]]
            states[left] = self.failure[states[left]]
        return total, states

    def walk(self) -> np.ndarray:
        """Log10 probabilities of all tokens.

        Long texts are walked in pieces at the same time. A piece begins as many words early as a state has at most,
        from the root: whatever was before, its state is then that of the whole walk.
        """
        counts = -(-self.lengths // PIECE)
        text = np.repeat(np.arange(len(counts)), counts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        lead = np.where(number > 0, self.order - 1, 0)
        begin = self.starts[text] + number * PIECE - lead
        size = np.minimum((number + 1) * PIECE, self.lengths[text]) - number * PIECE + lead
        rank = np.argsort(-size, kind="stable")
        begin, size, lead = begin[rank], size[rank], lead[rank]
        gained, states = np.zeros(len(self.words)), np.zeros(len(rank), dtype=np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -step, side="left"))
            place = begin[:active] + step
            total, states[:active] = self._step(states[:active], self.words[place])
            own = step >= lead[:active]
            gained[place[own]] = total[own]
        return gained


def _shrunk(counts: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(counts.max())) if len(counts) else np.dtype(np.uint8)
    return kind.char.encode() + counts.astype(kind).tobytes()


def _grown(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], dtype=np.dtype(data[:1].decode())).astype(np.int64)


def _blocked(table: pa.Table, order: int) -> Block:
    texts = table.column("text").cast(pa.binary()).to_pylist()
    return Block(texts, np.array(table.column("learn").to_pylist(), dtype=bool), order)


def _bucket_edges(keys: np.ndarray, buckets: int) -> list[int]:
    bounds = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)
    return [0, *np.searchsorted(keys[:, 0], bounds).tolist(), len(keys)]


ASKED = "block bigint, bucket int, n int, keys binary, counts binary"
ANSWER = "block bigint, bucket int, n int, counts binary, learned bigint, known bigint"


def score_texts(
    docs: DataFrame,
    order: int = ORDER,
    block_chars: int = BLOCK_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from the rows whose crc32(id as text) mod 7 is not 2 and scores all. NULL and empty texts
    are their end token; a NULL id counts as an empty text in the checksum. Repeated rows are
    learned from and scored each. Other columns are ignored. No rows give no rows.

    ``docs`` should be a table as it was read: rows are dealt to blocks by their places in it, which have to be the same
    if an executor is lost. Answers that don't fit a block stop the query.
    """
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    size = given.agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("rows")).first()
    blocks = max(1, -(-((size["chars"] or 0) + size["rows"]) // block_chars))
    buckets = blocks
    # By the place of a row: not even equal rows share a block for being equal.
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    dealt = given.select("doc_id", "text", (crc_remainder("doc_id", FOLDS) != HELD_OUT).alias("learn"), block)

    def ask(key, table):
        held = _blocked(table, order)
        rows = []
        for n, (keys, counts) in enumerate(zip(held.keys, held.counts), 1):
            for bucket, (a, b) in enumerate(pairwise(_bucket_edges(keys, buckets))):
                # Words and n-grams of a bucket go different ways; words are sent even if none, to hear of N and V.
                if n == 1 or b > a:
                    rows.append((key[0].as_py(), bucket, n, keys[a:b].tobytes(), _shrunk(counts[a:b])))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "bucket", "n", "keys", "counts"])

    def add_up(key, table):
        bucket, n = key[0].as_py(), key[1].as_py()
        width = 2 if n == 1 else 1
        keys = [np.frombuffer(k.as_py(), dtype=np.uint64).reshape(-1, width) for k in table.column("keys")]
        counts = np.concatenate([_grown(c.as_py()) for c in table.column("counts")])
        every = np.concatenate(keys)
        rank = np.lexsort(every.T[::-1]) if width > 1 else np.argsort(every[:, 0], kind="stable")
        placed = every[rank]
        first = np.ones(len(rank), dtype=bool)
        first[1:] = (placed[1:] != placed[:-1]).any(axis=1)
        sums = np.add.reduceat(counts[rank], np.flatnonzero(first)) if len(rank) else np.zeros(0, dtype=np.int64)
        totals = np.empty(len(rank), dtype=np.int64)
        totals[rank] = sums[np.cumsum(first) - 1]
        ends = np.cumsum([len(k) for k in keys])
        answers = [_shrunk(part) for part in np.split(totals, ends[:-1])]
        size, learned, known = len(answers), int(sums.sum()), int((sums > 0).sum())
        return pa.table(
            [
                table.column("block"),
                pa.array([bucket] * size, pa.int32()),
                pa.array([n] * size, pa.int32()),
                pa.array(answers, pa.binary()),
                pa.array([learned] * size, pa.int64()),
                pa.array([known] * size, pa.int64()),
            ],
            names=["block", "bucket", "n", "counts", "learned", "known"],
        )

    def walk(key, texts, answers):
        held = _blocked(texts, order)
        rows = sorted(answers.select(["n", "bucket", "counts", "learned", "known"]).to_pylist(), key=lambda r: (r["n"], r["bucket"]))
        learned = sum(r["learned"] for r in rows if r["n"] == 1)
        known = sum(r["known"] for r in rows if r["n"] == 1)
        totals = []
        for n in range(1, order + 1):
            parts = [_grown(r["counts"]) for r in rows if r["n"] == n]
            totals.append(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))
            if len(totals[-1]) != len(held.keys[n - 1]):
                raise RuntimeError("the answers don't fit the block")
        automaton = Automaton(held, totals, learned, known)
        base, total = automaton.base[held.at[0]], automaton.walk()
        seen = (totals[0][held.at[0]] > 0).astype(np.int64)
        add = lambda values: np.add.reduceat(values, held.starts)
        ids = texts.column("doc_id")
        return pa.table(
            [
                ids,
                pa.array(~np.array(texts.column("learn").to_pylist(), dtype=bool)),
                pa.array(held.lengths),
                pa.array(add(seen)),
                pa.array(np.full(len(ids), learned, dtype=np.int64)),
                pa.array(add(base)),
                pa.array(add(total)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    kind = given.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    asked = dealt.groupBy("block").applyInArrow(ask, ASKED)
    answered = asked.groupBy("bucket", "n").applyInArrow(add_up, ANSWER)
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(walk, result)
