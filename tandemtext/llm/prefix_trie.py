"""The prefix trie of rebuilt conversations, with a count-min sketch that keeps unshared tails out of the shuffle.

A prefix is known by a chained digest of its turns. A sketch of all prefixes is counted first; it never counts
too little, so a prefix of estimate one belongs to one conversation for certain, and so do all that continue
it: their nodes are emitted where they are. Only prefixes that may be shared are grouped. What a node
sums over its subtree comes from its members' own paths: every node below it has a smallest member, which passes
through it, so sums run along a conversation and are then added per prefix, whatever the depth.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, salt, salt_mask, words_of

# Conversations of one group of ids share the head of the group's first one.
GROUP = 20
MOST_HEAD = 3

# The sketch: rows of saturating counters (0, 1, more), as many as PER_PREFIX for each prefix, at most MOST_CELLS a row.
# At the limit it takes 32 MB; more prefixes only mean that more of them are grouped without need.
SKETCH_ROWS = 2
PER_PREFIX = 8
LEAST_CELLS = 1 << 16
MOST_CELLS = 1 << 24
BLOCK = 1 << 16
# Ids that are written next to each other before they are hashed.
ID_BITS = 12

ROOT = hashlib.sha256(b"").digest()[:16]
PATHS = "conv_id BIGINT, depth BIGINT, prefix BINARY, parent BINARY, words BIGINT, more BOOLEAN"
ROWS_OUT = 8192


def turn_digest(role: Column, text: Column) -> Column:
    """A SHA-256 of role and text, with the role's length in front, as hexadecimal text."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, prefix, parent, words, more): one row per conversation and depth, from 0.

    One shuffle, by group of ids, of digests and word counts: texts stay where they are. A task reads
    its sorted groups as a stream and holds three turns of the group's head and one pending row, so
    neither long conversations nor large partitions cost memory.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        (F.col("conv_id") - F.col("conv_id") % GROUP).cast("bigint").alias("_base"),
        "turn",
        turn_digest(role, text).alias("_digest"),
        F.size(words_of(text)).cast("bigint").alias("_words"),
    )
    order = ["_base", (F.col("conv_id") != F.col("_base")), "conv_id", F.col("turn").asc_nulls_first(), "_digest"]
    dealt = turns.repartition("_base").sortWithinPartitions(*order).select("_base", "conv_id", "_digest", "_words")
    schema = pa.schema(
        [("conv_id", pa.int64()), ("depth", pa.int64()), ("prefix", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("more", pa.bool_())]
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        base = conv = pending = None
        heads: list[tuple[str, int]] = []
        skip = 0

        def add(digest: str, words: int) -> None:
            nonlocal pending
            _, depth, prefix, _, _ = pending
            out.append((*pending, True))
            pending = (conv, depth + 1, hashlib.sha256(prefix + bytes.fromhex(digest)).digest()[:16], prefix, words)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for group, c, digest, words in zip(*(column.to_pylist() for column in batch.columns)):
                if c != conv:
                    if pending:
                        out.append((*pending, False))
                    if group != base:
                        base, heads = group, []
                    conv, pending = c, (c, 0, ROOT, None, 0)
                    skip = zlib.crc32(str(c).encode()) % (MOST_HEAD + 1) if c != base else 0
                    for head in heads[:skip]:
                        add(*head)
                if c == base and len(heads) < MOST_HEAD:
                    heads.append((digest, words))
                if skip:
                    skip -= 1
                else:
                    add(digest, words)
                if len(out) >= ROWS_OUT:
                    yield flush()
        if pending:
            out.append((*pending, False))
        if out:
            yield flush()

    return dealt.mapInArrow(chain, PATHS)


def cells_of(prefixes: pa.Array, cells: int) -> np.ndarray:
    """The counters of each prefix, a row of the result for each row of the sketch; prefixes are digests, so they are spread evenly."""
    halves = np.frombuffer(b"".join(prefixes.to_pylist()), dtype="<u8").reshape(-1, 2)
    step = halves[:, 1] | np.uint64(1)
    return np.stack([(halves[:, 0] + np.uint64(r) * step) % np.uint64(cells) for r in range(SKETCH_ROWS)]).astype(np.int64)


def sketch(paths: DataFrame, cells: int) -> bytes:
    """Saturated counts of all prefixes, ``SKETCH_ROWS * cells`` bytes.

    A task counts into a sketch of its own and sends the blocks that hold something; a block's
    parts are added up one after the other, so memory doesn't grow with the number of tasks.
    """
    size = SKETCH_ROWS * cells

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.uint8)
        for batch in batches:
            if batch.num_rows:
                found = cells_of(batch.column(0), cells) + np.arange(SKETCH_ROWS)[:, None] * cells
                at, n = np.unique(found, return_counts=True)
                held[at] = np.minimum(held[at] + np.minimum(n, 2), 2)
        for block in range(0, size, BLOCK):
            part = held[block : block + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["block", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, None
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(part.as_py(), np.uint8)
                if at == block:
                    held = np.minimum(held + part, 2)
                    continue
                if held is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([held.tobytes()], pa.binary())], ["block", "part"])
                block, held = at, part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([held.tobytes()], pa.binary())], ["block", "part"])

    schema = "block BIGINT, part BINARY"
    parts = paths.select("prefix").mapInArrow(count, schema)
    whole = parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, schema)
    held = bytearray(size)
    for at, part in whole.collect():
        held[at : at + len(part)] = part
    return bytes(held)


def screened(paths: DataFrame, least: int = LEAST_CELLS, most: int = MOST_CELLS) -> DataFrame:
    """``paths`` with ``sole`` and ``parent_sole``: whether the sketch proves that one conversation has the prefix, or its parent."""
    wanted = PER_PREFIX * paths.count()
    cells = min(max(least, 1 << max(wanted - 1, 0).bit_length()), most)
    sent = paths.sparkSession.sparkContext.broadcast(sketch(paths, cells))
    schema = PATHS + ", sole BOOLEAN, parent_sole BOOLEAN"

    def proven(prefixes: pa.Array) -> pa.Array:
        held = np.frombuffer(sent.value, np.uint8)
        there = prefixes.fill_null(ROOT)
        found = held[cells_of(there, cells) + np.arange(SKETCH_ROWS)[:, None] * cells]
        return pa.array(found.min(axis=0) == 1)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flags = [proven(batch.column(2)), proven(batch.column(3))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, "sole", "parent_sole"])

    return paths.mapInArrow(screen, schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) from (prefix, conv_id), each pair once.

    Ids are sorted and joined in blocks of neighbours, at most 4,096 each; a node's blocks are then hashed in
    their order as a stream. SHA-256 has to see them one after the other, but none of them is held.
    """
    blocks = ends.groupBy("prefix", F.shiftright("conv_id", ID_BITS).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    dealt = blocks.repartition("prefix").sortWithinPartitions("prefix", "block").select("prefix", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, state = None, None
        for batch in batches:
            done = []
            for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != prefix:
                    if state:
                        done.append((prefix, state.hexdigest()))
                    prefix, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["prefix", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([prefix], pa.binary()), pa.array([state.hexdigest()])], ["prefix", "ends_sha256"])

    return dealt.mapInArrow(digest, "prefix BINARY, ends_sha256 STRING")


def prefix_trie(conversations: DataFrame, least_cells: int = LEAST_CELLS, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in the order of ``turn``, NULL first; those of one conversation that share a turn number are
    ordered by the digest of role and text, so repeated rows are turns of their own. NULL roles and texts are empty. Rows with a NULL
    conv_id belong to no conversation and are left out. A table without conversations has no nodes. Other columns are ignored.
    """
    paths = stage(rebuilt_paths(conversations), "trie-paths")
    rows = stage(screened(paths, least_cells, most_cells), "trie-screened")

    # Grouped exactly: prefixes that may be shared, each met again by its members over salts.
    shared = rows.filter("NOT sole").withColumn("_salt", salt(F.xxhash64("conv_id")))
    groups = shared.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("least"),
        F.max("more").alias("continued"),
        salt_mask("_salt").alias("_mask"),
    )
    borders = rows.filter("sole AND (depth = 0 OR NOT parent_sole)").select(
        "*", F.lit(1).cast("bigint").alias("n_convs"), F.col("conv_id").alias("least"), F.col("more").alias("continued")
    )
    walked = give_back(shared, groups, ["prefix"]).select(*borders.columns).unionByName(borders)

    # Along each conversation, from its deepest prefix that counts here up to the root.
    up = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    whole = Window.partitionBy("conv_id")
    own = F.col("least") == F.col("conv_id")
    saved = F.when(own, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    walked = walked.select(
        "conv_id",
        "depth",
        "prefix",
        "more",
        "sole",
        "n_convs",
        # The parent of a prefix whose parent has one member is that member's too.
        F.when(F.col("parent_sole") & (F.col("depth") > 0), F.col("conv_id")).otherwise(F.lead("least").over(up)).alias("above"),
        F.coalesce(F.lag(own).over(up), F.lit(False)).alias("first_of_child"),
        # One leaf per conversation at most: that at which it ends, if it is the first to end there and none goes on.
        F.coalesce(F.max(F.when(~F.col("more"), own & ~F.col("continued"))).over(whole), F.lit(True)).alias("has_leaf"),
        F.sum(saved).over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("saved_below"),
    )
    count = lambda flag: F.sum(F.col(flag).cast("bigint"))
    nodes = (
        walked.filter("NOT sole")
        .groupBy("prefix")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("above").alias("parent_conv_id"),
            F.max("n_convs").alias("n_convs"),
            count("first_of_child").alias("n_children"),
            count("has_leaf").alias("n_leaves"),
            F.sum("saved_below").alias("saved_tokens"),
        )
    )
    ends = end_digests(rows.filter("NOT sole AND NOT more").select("prefix", "conv_id"))
    nothing = F.sha2(F.lit(""), 256)
    of_many = nodes.join(ends, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).drop("prefix")

    # Nodes of one conversation are a chain: nothing is saved below them, and they lead to one leaf.
    alone = walked.filter("sole").select("conv_id", "depth", "more", F.col("above").alias("parent_conv_id"))
    tails = rows.filter("sole AND parent_sole AND depth > 0").select(
        "conv_id", "depth", "more", F.col("conv_id").alias("parent_conv_id")
    )
    of_one = alone.unionByName(tails).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.lit(1).cast("bigint").alias("n_convs"),
        F.col("more").cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(F.col("more"), nothing).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"),
    )
    return of_many.select(*of_one.columns).unionByName(of_one)


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS v, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda s, x: xor(t[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own), crc
), turns AS (
  SELECT v.c, o.p AS p, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.p <= v.h
  UNION ALL
  SELECT v.c, 1000000 + o.p, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.p > v.h
), placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         md5(length(role)::VARCHAR || ':' || role || text) AS d
  FROM turns
), paths AS (
  SELECT c, depth, words, string_agg(d, '') OVER (PARTITION BY c ORDER BY depth) AS prefix FROM placed
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
), sized AS (
  SELECT *, max(depth) OVER (PARTITION BY c) = depth AS ends, min(c) OVER (PARTITION BY prefix) AS first FROM paths
), nodes AS (
  SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, bool_and(ends) AS leaf,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM sized GROUP BY prefix, depth
), below AS (
  SELECT a.prefix, sum(n.leaf::INT)::BIGINT AS n_leaves, sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens,
         count(*) FILTER (n.depth = a.depth + 1) AS n_children
  FROM nodes n JOIN sized a ON a.c = n.conv_id AND a.depth <= n.depth GROUP BY a.prefix
)
SELECT conv_id, n.depth, p.first AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes n JOIN below USING (prefix) LEFT JOIN sized p ON p.c = n.conv_id AND p.depth = n.depth - 1
"""
