"""Near-duplicates of embeddings by product quantisation with coarse inverted lists.

The quantiser is fitted on a bounded sample; every vector is indexed. A vector lies in the list of its
nearest coarse centre, with codes for the subspaces of its residual. As a query it visits all lists that
could hold a neighbour: those whose border with its own list is near enough. There, dot products
with the coded vectors come from tables of one query and each code; each coded vector carries what its
own coding error can hide, so no link is lost at this step. What passes is compared exactly.

Equal vectors are searched once. Vectors are written in packs in the order of their lists, and packs of which one visits a
list of the other are read together, block by block: nothing is copied or shuffled for a visit. A block answers with counts and
with links that span its components, not with all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .arrow import arrow_rows
from .common import give_back, salt, salt_mask, sampled
from .components import connected_components

LEAST = 0.9
# Vectors the quantiser is fitted on, in expectation; coarse centres at most; subspaces and codes of each.
SAMPLE, MOST_LISTS, SUBSPACES, CODES = 10_000, 2_048, 8, 64
ROUNDS = 8
BLOCK = 1_024
# A pack has so many vectors and bytes of them at most, a file of packs about so many bytes, and a task has so many pairs of packs at once.
PACK_ROWS, PACK_BYTES, PART_BYTES, PACKS_AT_ONCE = 4_096, 1 << 20, 8 << 20, 8
# A neighbour's offset has this many standard deviations of its length along a given direction at most.
DEVIATIONS = 5.0
# Estimates are 32-bit sums of a few numbers below one.
ROUNDING = 1e-5


def _centres(points: np.ndarray, count: int, random: np.random.Generator) -> np.ndarray:
    """Plain k-means."""
    centres = points[random.choice(len(points), count, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=count)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _distances(points, centres).argmin(axis=1)


class Quantiser:
    """Coarse centres, what lies between each two of them, and codebooks; at most some ten MB."""

    def __init__(self, sample: np.ndarray, total: int, least: float = LEAST) -> None:
        random = np.random.default_rng(11)
        size, self.width = sample.shape
        lists = max(1, min(MOST_LISTS, int(total**0.5), size // 8 or 1))
        self.coarse = _centres(sample, lists, random)
        residuals = sample - self.coarse[_nearest(sample, self.coarse)]
        self.cuts = np.array_split(np.arange(self.width), min(SUBSPACES, self.width))
        self.books = [_centres(residuals[:, cut], min(CODES, size), random) for cut in self.cuts]
        self.least = least
        # How far a linked vector lies, and how far of that it may go towards the border of another list: all of it,
        # or DEVIATIONS of the share that the direction between the two centres has in the sample's variance,
        # where no direction counts as less than an average one. Kept as a difference of squared distances.
        reach = np.sqrt(max(0.0, 2 - 2 * least))
        centred = sample - sample.mean(axis=0)
        covariance = centred.T @ centred / size
        variance = max(float(np.trace(covariance)), 1e-18)
        products = self.coarse @ covariance @ self.coarse.T
        along = products.diagonal()[:, None] - 2 * products + products.diagonal()[None, :]
        apart = np.maximum(_distances(self.coarse, self.coarse), 0)
        spread = np.maximum(along / variance, apart / self.width)
        self.allowed = 2 * reach * np.minimum(np.sqrt(apart), DEVIATIONS * np.sqrt(spread)) + 1e-9

    def reach(self, units: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector, unless it is given, and a table that is true for lists that a vector has to visit."""
        away = _distances(units, self.coarse)
        own = away.argmin(axis=1) if own is None else own
        further = away - away[np.arange(len(units)), own][:, None]
        return own, further <= self.allowed[own]

    def place(self, units: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The list of each vector, and all lists that it has to visit."""
        own, visits = self.reach(units)
        return own, [np.flatnonzero(row).tolist() for row in visits]

    def code(self, units: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and for each vector the least estimate that a link with it can have."""
        residuals = units - self.coarse[own]
        codes = np.stack([_nearest(residuals[:, cut], book) for cut, book in zip(self.cuts, self.books)], axis=1)
        coded = self.coarse[own] + np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        error = units - coded
        along = (units * error).sum(axis=1)
        across = np.sqrt(np.maximum(0, (error**2).sum(axis=1) - along**2))
        # q = a x + b y with y across x: q . coded = a (1 - along) - b (y . error), and a >= least.
        least = self.least * (1 - along) - np.sqrt(max(0.0, 1 - self.least**2)) * across
        return codes.astype(np.uint8), np.where(along < 1, least, -np.inf)

    def estimates(self, queries: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Dot products of queries with the coded vectors of one list, by table look-ups."""
        total = np.repeat((queries @ self.coarse[which]).astype(np.float32)[None, :], len(codes), axis=0)
        for i, (cut, book) in enumerate(zip(self.cuts, self.books)):
            total += (book @ queries[:, cut].T).astype(np.float32)[codes[:, i]]  # whole rows of the table
        return total.T


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # The largest component first, so that squares neither vanish nor overflow.
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


def usable(vector: Column) -> Column:
    """Not NULL, without NULL or non-finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _spread(adjacent: np.ndarray, queries: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each query and member reaches inside the group."""
    high = np.iinfo(np.int64).max
    while True:
        new_queries = np.minimum(queries, np.where(adjacent, members[None, :], high).min(axis=1))
        new_members = np.minimum(members, np.where(adjacent, new_queries[:, None], high).min(axis=0))
        if (new_queries == queries).all() and (new_members == members).all():
            return queries, members
        queries, members = new_queries, new_members


def compare(quantiser: Quantiser, which: int, q_ids, q_units, m_ids, m_units, m_codes, m_least, m_sizes) -> list[tuple]:
    """(id, linked vectors, smallest id reached) of one group of queries and members of a list."""
    rows, columns = np.nonzero(quantiser.estimates(q_units, which, m_codes) >= (m_least - ROUNDING).astype(np.float32)[None, :])
    adjacent = np.zeros((len(q_ids), len(m_ids)), dtype=bool)
    for begin in range(0, len(rows), 1 << 16):
        r, c = rows[begin : begin + (1 << 16)], columns[begin : begin + (1 << 16)]
        exact = np.einsum("ij,ij->i", q_units[r], m_units[c])
        adjacent[r, c] = (exact >= quantiser.least) & (q_ids[r] != m_ids[c])
    links = adjacent @ m_sizes
    if not links.any():
        return []
    to_queries, to_members = _spread(adjacent, q_ids, m_ids)
    found = [(int(i), int(n), int(to)) for i, n, to in zip(q_ids, links, to_queries) if n]
    return found + [(int(i), 0, int(to)) for i, to in zip(m_ids, to_members) if to < i]


def _array(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def _column(batch: pa.RecordBatch, name: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)


def linked_groups(nodes: DataFrame, quantiser: Quantiser, total: int) -> DataFrame:
    """(id, links, least) from every two packs that have to meet; ``nodes`` has node, vector, members.

    A pack is one row: neighbouring vectors in the order of their lists. Packs are written once and two of them meet by
    reading that table again, so a vector is shuffled once, however many lists it visits. Written at once.
    """
    spark, width, parts = nodes.sparkSession, quantiser.width, len(quantiser.cuts)
    kind = np.float32 if nodes.schema["vector"].dataType.elementType.typeName() == "float" else np.float64

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column(1).to_pylist(), dtype=np.float64)
            raw = pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())
            own = pa.array(quantiser.reach(_units(vectors))[0], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), raw, batch.column(2), own], names=["node", "raw", "members", "list"])

    indexed = nodes.select("node", "vector", "members").mapInArrow(index, "node bigint, raw binary, members bigint, list int")
    # One row for each list, of which there are at most MOST_LISTS.
    sizes = dict(map(tuple, indexed.groupBy("list").count().collect()))
    sizes = [sizes.get(i, 0) for i in range(len(quantiser.coarse))]
    spread = F.pmod(F.xxhash64("node"), F.get(F.lit(sizes), "list"))
    place = F.get(F.lit([sum(sizes[:i]) for i in range(len(sizes))]), "list") + F.coalesce(spread, F.lit(0))
    enough = int((4 * spark.sparkContext.defaultParallelism) ** 0.5) + 1
    count = max(1, -(-total * width * np.dtype(kind).itemsize // PART_BYTES), min(-(-total // BLOCK), enough))
    dealt = indexed.repartitionById(count, F.least(place * count / max(1, total), F.lit(count - 1)).cast("int"))
    most = max(1, min(PACK_ROWS, PACK_BYTES // (width * np.dtype(kind).itemsize)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by([("list", "ascending"), ("node", "ascending")])
        for begin in range(0, len(table), most):
            rows = table.slice(begin, most)
            units = _units(_array(rows["raw"], width, kind))
            own = rows["list"].to_numpy()
            visited = quantiser.reach(units, own)[1].any(axis=0)
            codes, least = quantiser.code(units, own)
            values = [rows["node"].to_numpy(), b"".join(rows["raw"].to_pylist()), rows["members"].to_numpy(), own, codes, least]
            lists = [np.unique(own), np.flatnonzero(visited)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v if isinstance(v, bytes) else v.tobytes()], pa.binary()) for v in values]
                + [pa.array([v.tolist()], pa.list_(pa.int32())) for v in lists],
                names=[*held, "holds", "visits"],
            )

    held = ["node", "raw", "members", "list", "codes", "least"]
    schema = ", ".join(f"{c} binary" for c in held) + ", holds array<int>, visits array<int>"
    packed = stage(dealt.mapInArrow(pack, schema), "packed")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found: list[tuple] = []
            for row in range(batch.num_rows):
                q_ids = _column(batch, "asking", row, np.int64)
                if last is None or not np.array_equal(last[0], q_ids):
                    q_units = _units(_column(batch, "asking_raw", row, kind).reshape(-1, width))
                    last = q_ids.copy(), q_units, quantiser.reach(q_units, _column(batch, "asking_list", row, np.int32))[1]
                m_ids, m_sizes = (_column(batch, c, row, np.int64) for c in ("node", "members"))
                m_units = _units(_column(batch, "raw", row, kind).reshape(-1, width))
                m_codes = _column(batch, "codes", row, np.uint8).reshape(-1, parts)
                m_least, m_lists = _column(batch, "least", row, np.float64), _column(batch, "list", row, np.int32)
                which, begins = np.unique(m_lists, return_index=True)
                for k, begin, end in zip(which.tolist(), begins, [*begins[1:], len(m_lists)]):
                    asking = np.flatnonzero(last[2][:, k])
                    for at in range(0, len(asking), BLOCK):
                        q = asking[at : at + BLOCK]
                        for low in range(begin, end, BLOCK):
                            m = slice(low, min(end, low + BLOCK))
                            found += compare(
                                quantiser, k, last[0][q], last[1][q], m_ids[m], m_units[m], m_codes[m], m_least[m], m_sizes[m]
                            )
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "links", "least"])

    queries = packed.select(
        F.col("node").alias("asking"), F.col("raw").alias("asking_raw"), F.col("list").alias("asking_list"), "visits"
    )
    meeting = queries.join(packed.drop("visits").hint("shuffle_replicate_nl"), F.arrays_overlap("visits", "holds")).drop("visits", "holds")
    with arrow_rows(spark, PACKS_AT_ONCE):
        return stage(meeting.mapInArrow(search, "id bigint, links bigint, least bigint"), "found")


def small_groups(nodes: DataFrame, least: float) -> DataFrame:
    """(id, links, least) among vectors of one length, of which there are at most ``BLOCK``: all pairs in place."""

    def search(key, held):
        ids, sizes = np.array(held.column("node")), np.array(held.column("members"))
        units = _units(np.array(held.column("vector").to_pylist(), dtype=np.float64))
        adjacent = np.stack([np.einsum("j,ij->i", u, units) >= least for u in units])
        np.fill_diagonal(adjacent, False)
        adjacent |= adjacent.T
        reached, _ = _spread(adjacent, ids, ids)
        found = [(i, n, to) for i, n, to in zip(ids.tolist(), (adjacent @ sizes).tolist(), reached.tolist()) if n]
        return pa.table([pa.array(c, pa.int64()) for c in list(zip(*found)) or [(), (), ()]], names=["id", "links", "least"])

    return nodes.groupBy("width").applyInArrow(search, "id bigint, links bigint, least bigint")


def linked_vectors(nodes: DataFrame, least: float) -> DataFrame:
    """(id, links, least) of ``nodes(node, vector, members, width)``; only vectors of one length can link.

    The commonest length and all others with more than ``BLOCK`` vectors have a quantiser of their own, one
    after the other; the rest are groups of a bounded size, compared in place.
    """
    counts = nodes.groupBy("width").agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), "width").limit(1)
    large = {r["width"]: r["n"] for r in counts.filter(F.col("n") > BLOCK).unionByName(first).collect()}
    found = small_groups(nodes.filter(~F.col("width").isin(list(large))), least)
    for width, total in sorted(large.items()):
        own = nodes.filter(F.col("width") == width)
        chosen = own.filter(sampled(F.xxhash64("node", F.lit("codes")), SAMPLE / total))
        sample = [row[0] for row in chosen.orderBy("node").select("vector").collect()]
        sample = sample or [own.select("vector").first()[0]]
        quantiser = Quantiser(_units(np.array(sample, dtype=np.float64)), total, least)
        found = found.unionByName(linked_groups(own, quantiser, total))
    return found


def near_duplicate_vectors(
    vectors: DataFrame, least: float = LEAST, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Links are pairs of rows with a cosine of ``least`` or more, in double precision; vectors of different lengths
    have no cosine, those of any one length are compared with each other. Vectors that are NULL,
    empty, zero, or hold NULL or non-finite components link with nothing and
    stay, as do rows with a NULL id. Repeated rows are vectors of their own that link with each other and
    have one component. Ids are integers; other columns are ignored. No rows give no rows.
    """
    given = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("vector"))
    marked = given.withColumn("_good", usable(F.col("vector")) & F.col("vec_id").isNotNull())
    alone = marked.filter("NOT _good").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    good = marked.filter("_good").select("vec_id", "vector").withColumn("_salt", salt(F.xxhash64("vec_id")))
    # Stands for a vector where rows get their answers back: its numbers, and no zero has a sign.
    digest = F.unhex(F.sha2(F.transform("vector", lambda x: x + F.lit(0.0)).cast("string"), 256)).alias("_digest")
    nodes = stage(
        good.groupBy("vector").agg(
            F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("members"), salt_mask("_salt").alias("_mask")
        ).withColumn("width", F.size("vector")),
        "vectors",
    )
    found = stage(linked_vectors(nodes, least), "linked")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("u"), F.col("least").alias("v")))
    named = nodes.join(links, F.col("node") == F.col("id"), "left").drop("id").join(components, "node", "left")
    answers = named.select(
        digest,
        (F.coalesce("links", F.lit(0)) + F.col("members") - 1).cast("bigint").alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
        "_mask",
    )
    rows = good.select("vec_id", "_salt", digest)
    linked = give_back(rows, answers, ["_digest"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(l.b, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least l ON l.a = v.vec_id
"""
