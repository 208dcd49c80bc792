"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, salt, salt_mask

EDGES_PER_FILE = 1_000_000


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Adds ``_m``, the smallest ``v`` of each ``u``; a node with most of the edges is met in many tasks."""
    salted = edges.withColumn("_salt", salt(F.xxhash64("v")))
    least = salted.groupBy("u").agg(F.min("v").alias("_m"), salt_mask("_salt").alias("_mask"))
    return give_back(salted, least, ["u"])


def large_star(edges: DataFrame) -> DataFrame:
    """Connects every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = _least_neighbour(both).filter("v > u")
    return larger.select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Connects a node and its smaller neighbours to the smallest of them; ``u > v`` in all edges."""
    found = _least_neighbour(edges)
    others = found.filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return others.unionByName(found.filter("v = _m").select("u", "v"))


def _in_few_files(edges: DataFrame, least: int) -> DataFrame:
    """A round's few edges don't need a file for each shuffle partition; ``least`` files, and one for each core, stay.

    A file in a local folder starts several processes. No partition grows: a task goes through some one by one.
    """
    return edges.coalesce(max(1, least, edges.sparkSession.sparkContext.defaultParallelism))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(u, v)``; the component is its smallest node.

    Each round is written once, so no lineage grows and lost executors cost one round at most.
    Rounds go on until the edges no longer change, which takes about the logarithm of the longest
    path. Self-links, repeated links and links with a NULL end add nothing; no links give no rows.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    edges = links.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct()
    # How many there are isn't known yet.
    edges = stage(_in_few_files(edges, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        grown = large_star(edges).distinct()
        edges = stage(_in_few_files(small_star(grown).distinct(), state[0] // EDGES_PER_FILE), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
