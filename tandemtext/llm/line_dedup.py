"""Line deduplication by windows of three consecutive lines.

Every window of a document is hashed; windows that occur more than once anywhere keep their
first occurrence, and the lines that later occurrences cover are removed. Only hashes and
positions are shuffled to find them; the texts move once, to meet their removed positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import copies_for, salt, salt_mask

LINES = 3


def repeated_places(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(_id, _version, _places): the line numbers of each document that later occurrences cover.

    ``docs`` has ``_id``, ``_version`` (a hash of the text) and ``_text``.
    """
    # Non-blank lines with their numbers among all lines.
    numbered = F.expr("transform(split(_text, '\\n'), (x, i) -> struct(i AS i, trim(x) AS x))")
    held = docs.filter(F.col("_text").contains("\n")).select(
        "_id", "_version", F.filter(numbered, lambda y: y["x"] != "").alias("_lines")
    )
    window = f"slice(_lines, p + 1, {lines})"
    windows = F.expr(
        f"transform(sequence(0, size(_lines) - {lines}), p -> struct("
        f"unhex(md5(array_join(transform({window}, y -> y.x), '\\n'))) AS h, transform({window}, y -> y.i) AS at))"
    )
    places = (
        held.filter(F.size("_lines") >= lines)
        .select("_id", "_version", F.posexplode(windows).alias("_p", "_w"))
        .select("_id", "_version", "_p", F.col("_w.h").alias("_hash"), F.col("_w.at").alias("_at"))
        .withColumn("_salt", salt(F.xxhash64("_id", "_version", "_p")))
    )
    here = F.struct("_id", "_version", "_p")
    repeated = (
        places.groupBy("_hash")
        .agg(F.min(here).alias("_first"), F.count(F.lit(1)).alias("_n"), salt_mask("_salt").alias("_mask"))
        .filter("_n > 1")
        .select("_hash", "_first", copies_for("_mask").alias("_salt"))
    )
    later = places.join(repeated, ["_hash", "_salt"]).filter(~here.eqNullSafe(F.col("_first")))
    # Overlapping windows merge: what is collected is the set of covered lines of one document, however often it is repeated.
    return later.groupBy("_id", "_version").agg(F.array_distinct(F.flatten(F.collect_set("_at"))).alias("_places"))


def _cut(rows: DataFrame, id_column: str, text_column: str, lines: int) -> tuple[DataFrame, list[Column]]:
    """Rows as ``_row`` with their lines and covered places, and the columns of ``rows`` with repeated lines cut."""
    packed = rows.select(
        F.struct(*rows.columns).alias("_row"),
        F.col(id_column).alias("_id"),
        F.xxhash64(text_column).alias("_version"),
        F.col(text_column).alias("_text"),
    )
    places = repeated_places(packed.select("_id", "_version", "_text"), lines).select(
        F.col("_id").alias("_i"), F.col("_version").alias("_v"), "_places"
    )
    joined = packed.join(places, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_version") == F.col("_v")), "left")
    every = F.split("_text", "\n")
    split = joined.select(
        "_row", "_text", "_places", F.when(F.col("_text").isNull(), F.array().cast("array<string>")).otherwise(every).alias("_all")
    )
    left = F.expr("transform(array_except(sequence(0, size(_all) - 1), _places), i -> _all[i])")
    text = F.when(F.col("_places").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    return split, [(text if c == text_column else F.col("_row")[c]).alias(c) for c in rows.columns]


def without_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lines: int = LINES
) -> DataFrame:
    """As ``remove_repeated_lines``, with the columns of ``docs`` and no others, whatever their names."""
    split, columns = _cut(docs, id_column, text_column, lines)
    return split.select(*columns)


def remove_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lines: int = LINES
) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from the text, plus ``n_lines`` and ``n_removed``.

    Lines are compared without spaces at their ends; blank lines don't take part and stay.
    First is the smallest (id, hash of the text, position). NULL texts stay NULL with no lines,
    texts of fewer than three non-blank lines are unchanged, NULL ids come first. Rows that
    repeat an id and its text hold the same places and don't count as later than each other.
    Other columns pass through, but for any named like the two added ones.
    """
    split, columns = _cut(docs.drop("n_lines", "n_removed"), id_column, text_column, lines)
    return split.select(
        *columns,
        F.size("_all").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_places"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the remaining text (NULL: empty)."""
    cleaned = remove_repeated_lines(docs.select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


ORACLE = r"""
WITH every AS (
  SELECT doc_id, text, i - 1 AS i, string_split(text, chr(10))[i] AS x
  FROM documents, range(1, len(string_split(text, chr(10))) + 1) AS r(i)
), lines AS (
  SELECT doc_id, i, trim(x, ' ') AS x, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS p
  FROM every WHERE trim(x, ' ') <> ''
), windows AS (
  SELECT doc_id, p, i AS a, lead(i, 1) OVER w AS b, lead(i, 2) OVER w AS c,
         x || chr(10) || lead(x, 1) OVER w || chr(10) || lead(x, 2) OVER w AS body
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT * FROM windows WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest([a, b, c]) AS i FROM later
), kept AS (
  SELECT e.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(CASE WHEN g.i IS NULL THEN e.x END, chr(10) ORDER BY e.i), '') AS t
  FROM every e LEFT JOIN gone g USING (doc_id, i) GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS text_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
