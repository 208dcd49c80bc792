"""Near-duplicates of documents: universal hash minima, bands, checks on full shingle sets, components.

1. One pass over the texts gives each document a digest of its shingle set, band keys and an
   8-bit signature. Equal sets form a class; only the class's smallest id goes on.
2. In the first bands every document is compared with the smallest one of its bucket. So a group of
   any size costs one comparison per document and band, and grows together at once.
   Links are checked on the full sets of both texts and joined to components.
3. What is left are buckets of any band that hold more than one component. There, members of
   different components are compared by signature, in blocks of bounded size; those alike, directly or
   through others, form a family. Inside a family, what isn't in its largest component is
   compared on full sets, again in blocks, and only links that join components are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .arrow import Remembered, arrow_rows, lightly, nothing_kept
from .common import give_back, salt, salt_mask
from .components import connected_components

WORDS = 5
# Links need 100 * intersection >= NEED * union.
NEED = 75
# With 4 minima a band, a pair at 0.75 shares none of 32 bands with probability 5e-6, none of the first 8 with 5 %.
BANDS, ROWS, FIRST_BANDS = 32, 4, 8
MINIMA = BANDS * ROWS
# Of 128 minima a pair at 0.75 shares 96 on average, and fewer than 76 with probability 2e-5.
LEAST_SHARED = 76
BLOCK = 512
PAIRS_PER_PLACE, MOST_PLACES = 32, 4_096
ROWS_PER_BATCH = 1_000
LINKS = "u bigint, v bigint"


def _constants(count: int, seed: int) -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(seed.to_bytes(4, "little")).digest(8 * count), dtype="<u8")


MULTIPLIERS, ADDENDS = _constants(MINIMA, 1) | np.uint64(1), _constants(MINIMA, 2)
MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    # Bytes: lower() and split() then know just ASCII letters and white space.
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        total = _mixed(total + hashes[i : i + count])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set, 32 bits each."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(shingles), 1024):
        part = shingles[begin : begin + 1024]
        np.minimum(least, (part[None, :] * MULTIPLIERS[:, None] + ADDENDS[:, None]).min(axis=1), out=least)
    return least >> np.uint64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for part in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys * MIX + part)
    return keys.view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, signature; of documents without words the last three are NULL."""
    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, signature binary"
    fields = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept()
        for batch in lightly(batches):
            rows = []
            for text in batch.column(1).cast(pa.binary()):
                found = shingle_set(text.as_py())
                if len(found):
                    least = minima(found)
                    digest = hashlib.md5(found.tobytes()).digest()
                    rows.append((len(found), digest, band_keys(least), least.astype(np.uint8).tobytes()))
                else:
                    rows.append((0, None, None, None))
            if rows:
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), fields)]
                names = ["doc_id", "n_shingles", "set_key", "bands", "signature"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.mapInArrow(run, schema)


def similar_enough(a: np.ndarray, b: np.ndarray, need: int = NEED) -> bool:
    if 100 * min(len(a), len(b)) < need * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= need * (len(a) + len(b) - shared)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough.

    ``u`` may be in any number of pairs: its text goes once to each place of at most ``PAIRS_PER_PLACE`` of them, not to
    each pair, and a task holds its set while the texts of its ``v`` pass by. Only the largest have fuller places.
    """
    salted = pairs.withColumn("_salt", salt(F.xxhash64("v")))
    hubs = salted.groupBy("u").agg(F.count(F.lit(1)).alias("_n"), salt_mask("_salt").alias("_mask"))
    hubs = hubs.withColumn("_places", F.least(F.ceil(F.col("_n") / PAIRS_PER_PLACE), F.lit(MOST_PLACES)).cast("int")).drop("_n")
    placed = give_back(salted, hubs, ["u"]).withColumn("_place", F.pmod(F.xxhash64("v"), "_places").cast("int"))
    texts = placed.join(docs.select(F.col("doc_id").alias("v"), "text"), "v")
    hub_texts = docs.select(F.col("doc_id").alias("u"), "text").join(hubs.drop("_mask"), "u")
    hub_texts = hub_texts.withColumn("_place", F.explode(F.expr("sequence(0, _places - 1)")))
    keys = ["u", "_place"]
    # A NULL ``v`` comes first in its group: the text is that of ``u``.
    both = hub_texts.select(*keys, F.lit(None).cast("bigint").alias("v"), "text").unionByName(texts.select(*keys, "v", "text"))
    together = both.repartition(*keys).sortWithinPartitions(*keys, "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept()
        held, hub = None, []
        for batch in lightly(batches):
            good = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3).cast(pa.binary()))
            for u, place, v, text in rows:
                if (u, place) != held:
                    held, hub = (u, place), []
                found = shingle_set(text.as_py())
                if v is None:
                    hub.append(found)
                elif any(similar_enough(h, found) for h in hub):
                    good.append((u, v))
            if good:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*good)], names=["u", "v"])

    return together.mapInArrow(run, LINKS).distinct()


def _shared(a: bytes, b: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)))


def first_candidates(nodes: DataFrame) -> DataFrame:
    """(u, v): each node with the smallest of its bucket, in the first bands, if their signatures agree enough."""
    rows = nodes.select("node", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("_bucket")).withColumn(
        "_salt", salt(F.xxhash64("node"))
    )
    buckets = (
        rows.groupBy("_bucket")
        .agg(F.min("node").alias("_first"), F.count(F.lit(1)).alias("_n"), salt_mask("_salt").alias("_mask"))
        .filter("_n > 1")
        .drop("_n")
    )
    pairs = give_back(rows, buckets, ["_bucket"]).filter("node <> _first")
    pairs = pairs.select(F.col("_first").alias("u"), F.col("node").alias("v")).distinct()
    signs = nodes.select("node", "signature")
    both = pairs.join(signs.select(F.col("node").alias("u"), F.col("signature").alias("_su")), "u").join(
        signs.select(F.col("node").alias("v"), F.col("signature").alias("_sv")), "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_kept()
        for batch in lightly(batches):
            signatures = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            good = [_shared(a, b) >= LEAST_SHARED for a, b in signatures]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.select("u", "v", "_su", "_sv").mapInArrow(run, LINKS)


class Sets:
    """Disjoint sets of labels."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        up = self.parent.setdefault(x, x)
        while up != x:
            self.parent[x] = self.parent[up]
            x, up = up, self.parent[up]
        return x

    def join(self, x, y) -> bool:
        """Whether the two were apart."""
        x, y = self.root(x), self.root(y)
        self.parent[x] = y
        return x != y


def _by_group(batches: Iterator[pa.RecordBatch], width: int, answer) -> Iterator[pa.RecordBatch]:
    """(u, v) rows of ``answer(group)`` for each run of rows that are equal in the first ``width`` columns."""
    nothing_kept()
    group: list[tuple] = []
    found: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["u", "v"])

    for batch in lightly(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[:width] != group[0][:width]:
                found += answer(group)
                group = []
            group.append(row)
        if found:
            yield batch_of(found)
            found = []
    if group and (found := list(answer(group))):
        yield batch_of(found)


def _alike(signs: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` whose signatures agree enough with signature ``i``."""
    return others[np.count_nonzero(signs[others] == signs[i], axis=1) >= LEAST_SHARED]


def in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """(key, a, b, first, node, component, signature): groups in which members of one key's different components meet.

    ``rows`` has all but a, b and first, and is a written table. What isn't in the largest component of its key is cut into blocks of
    ``BLOCK`` that meet each other and the blocks of the largest component, which doesn't meet itself. No group holds
    more than two blocks. Group (a, b) is block a of the others, marked as first, with a later block b of them or a
    block of the largest component, numbered after them.
    """
    salted = rows.withColumn("_salt", salt(F.xxhash64("node")))
    sizes = salted.groupBy(key, "component").agg(F.count(F.lit(1)).alias("_count"), salt_mask("_salt").alias("_mask"))
    largest = sizes.groupBy(key).agg(
        F.max_by("component", F.struct("_count", "component")).alias("_main"),
        F.max("_count").alias("_n_main"),
        F.sum("_count").alias("_n"),
        F.bit_or("_mask").alias("_mask"),
    )
    # A key of one component has nothing to compare.
    largest = largest.filter("_n > _n_main")
    placed = (
        give_back(salted, largest, [key])
        .withColumn("_other", F.col("component") != F.col("_main"))
        .withColumn("_others", F.ceil((F.col("_n") - F.col("_n_main")) / BLOCK).cast("int"))
        .withColumn("_mains", F.ceil(F.col("_n_main") / BLOCK).cast("int"))
        .withColumn("_block", F.pmod(F.xxhash64("node"), F.when(F.col("_other"), F.col("_others")).otherwise(F.col("_mains"))).cast("int"))
    )

    def group(a: Column, b: Column, first: bool) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), F.lit(first).alias("first"))

    as_first = F.transform(F.expr("sequence(_block, _others + _mains - 1)"), lambda b: group(F.col("_block"), b, True))
    as_second = F.transform(F.expr("sequence(0, _block)"), lambda a: group(a, F.col("_block"), False))
    as_main = F.transform(F.expr("sequence(0, _others - 1)"), lambda a: group(a, F.col("_others") + F.col("_block"), False))
    earlier = F.filter(as_second, lambda g: g["a"] < g["b"])
    dealt = placed.withColumn("_g", F.explode(F.when(F.col("_other"), F.concat(as_first, earlier)).otherwise(as_main)))
    return dealt.select(key, "_g.a", "_g.b", "_g.first", "node", "component", "signature")


def _met(group: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of the group's first block the later rows of other components whose signatures agree enough."""
    _, a, b, first, _, components, signatures = (list(c) for c in zip(*(row[:7] for row in group)))
    signs = np.frombuffer(b"".join(signatures), dtype=np.uint8).reshape(len(group), -1)
    components, first = np.array(components), np.array(first)
    second = np.flatnonzero(~first)
    for i in np.flatnonzero(first).tolist():
        # A block by itself: each pair once. Two blocks: all pairs across.
        rest = np.arange(i + 1, len(group)) if a[0] == b[0] else second
        yield i, _alike(signs, i, rest[components[rest] != components[i]])


def families(nodes: DataFrame) -> DataFrame:
    """(node, family): nodes that may still be linked across components have the same family.

    ``nodes`` has ``component``. In the buckets of all bands that hold several components, members of different
    ones are compared by signature, in blocks. A group answers with pairs that span what it found alike, at most one for
    each of its nodes.
    """
    rows = nodes.select("node", "component", F.explode("bands").alias("_bucket")).withColumn(
        "_salt", salt(F.xxhash64("node"))
    )
    mixed = (
        rows.groupBy("_bucket")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), salt_mask("_salt").alias("_mask"))
        .filter("_low < _high")
        .drop("_low", "_high")
    )
    # Written first: few buckets are mixed.
    held = stage(give_back(rows, mixed, ["_bucket"]).join(nodes.select("node", "signature"), "node"), "mixed")
    keys = ["_bucket", "a", "b"]
    together = in_blocks(held, "_bucket").repartition(*keys).sortWithinPartitions(*keys, "node")

    def spanning(group: list[tuple]) -> Iterator[tuple]:
        sets = Sets()
        for i, alike in _met(group):
            for j in alike.tolist():
                if sets.join(i, j):
                    yield group[i][4], group[j][4]

    pairs = together.mapInArrow(lambda batches: _by_group(batches, 3, spanning), LINKS)
    return connected_components(pairs).withColumnRenamed("component", "family")


def linked_in_families(nodes: DataFrame, members: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v): links between components, found in families of any size by comparing full sets.

    The largest component of a family is linked in itself already; only the others are compared, with each other
    and with the largest one, in blocks of ``BLOCK``. Texts go once to each block they meet. A group
    answers with links that join components, at most one for each.
    """
    held = stage(members.join(nodes.select("node", "component", "signature"), "node"), "families")
    dealt = in_blocks(held, "family")
    # Written first: with its size known, Spark broadcasts it if it is small, and the texts stay where they are.
    texts = stage(dealt.select("node").distinct(), "family_nodes").join(
        docs.select(F.col("doc_id").alias("node"), "text"), "node"
    )
    keys = ["family", "a", "b"]
    together = dealt.join(texts, "node").select(*keys, "first", "node", "component", "signature", "text")
    together = together.repartition(*keys).sortWithinPartitions(*keys, "node")

    def links(group: list[tuple]) -> Iterator[tuple]:
        full, sets = Remembered(lambda i: shingle_set(group[i][7].encode()), 2 * BLOCK), Sets()
        for i, alike in _met(group):
            for j in alike.tolist():
                u, v = group[i][5], group[j][5]
                if sets.root(u) != sets.root(v) and similar_enough(full[i], full[j]):
                    sets.join(u, v)
                    yield group[i][4], group[j][4]

    return together.mapInArrow(lambda batches: _by_group(batches, 3, links), LINKS)


def _found(given: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Each written once: rows with a set, rows without, classes of equal sets, and components of their nodes."""
    prints = stage(fingerprints(given), "prints").withColumn("_salt", salt(F.xxhash64("doc_id")))
    with_set = prints.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = stage(
        with_set.groupBy("set_key").agg(F.min("doc_id").alias("node"), salt_mask("_salt").alias("_mask")), "classes"
    )
    # A class is stood for by its smallest id; both columns are keys, so copies don't meet in one task.
    nodes = with_set.select("set_key", F.col("doc_id").alias("node"), "bands", "signature").join(
        classes.select("set_key", "node"), ["set_key", "node"]
    )
    nodes = stage(nodes.drop("set_key").dropDuplicates(["node", "bands"]), "nodes")

    texts = given.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    links = stage(confirmed(stage(first_candidates(nodes), "candidates"), texts), "confirmed")
    components = connected_components(links)
    joined = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stage(joined, "nodes")
    more = stage(linked_in_families(joined, families(joined), texts), "confirmed")
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    alone = prints.filter("set_key IS NULL OR doc_id IS NULL")
    return with_set, alone, classes, components


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Links are pairs whose sets of five-word shingles have a Jaccard similarity of 0.75 or more. NULL
    texts and those without words have an empty set, link with nothing and stay; so do rows with
    a NULL id. Texts of fewer than five words are one shingle. Rows that repeat an id are one
    document, which links with what any of its rows links with. Ids are integers; other columns are ignored.
    """
    given = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    with arrow_rows(docs.sparkSession, ROWS_PER_BATCH):
        with_set, alone, classes, components = _found(given)

    named = classes.join(components, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component_id"), "_mask"
    )
    linked = give_back(with_set.select("doc_id", "n_shingles", "set_key", "_salt"), named, ["set_key"]).select(
        "doc_id", "n_shingles", "component_id"
    )
    alone = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), links AS (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""
