"""How filters interact: what each one removes in every order in which they can be applied.

Documents become cells first: one count per part and mask of failed filters, at most 2^n per part. A
recursive query then extends prefixes of orders by letters not used yet, joins the cells of
the part, carries the bits that were applied, and adds the metrics of that step at each level.
Its rows are orders and parts, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, salt, salt_mask, words_of

# n filters have n! orders; each is a row per part and step.
MOST_FILTERS = 7

FEWEST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
SYMBOLS = "[#$%&*|]"
REPEATS = "E"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The failure conditions that look at one text only, by letter."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(words) < FEWEST_WORDS,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(LEAST_DISTINCT) * F.size(words),
        "C": F.lit(100) * capitals > F.lit(MOST_CAPITALS) * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def bit_of(letters: str, letter: str) -> int:
    return 1 << letters.index(letter)


def mask_of(letters: str, conditions: Mapping[str, Column]) -> Column:
    """The bits of the conditions that hold; a condition that is NULL doesn't."""
    mask = F.lit(0)
    for letter, condition in conditions.items():
        mask = mask.bitwiseOR(F.when(condition, F.lit(bit_of(letters, letter))).otherwise(F.lit(0)))
    return mask


def judged(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """(part, mask, good, toxic) of every document.

    The texts are read once: a SHA-256 stands for the whole text when equal ones are sought, and
    only digests that occur again are joined back, over salts.
    """
    given = docs.select(
        F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("_text")
    ).withColumn("_words", words_of(F.col("_text")))
    local = text_filters(F.col("_text"), F.col("_words"))
    rows = stage(
        given.select(
            "doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("_digest"), mask_of(letters, local).alias("_mask_here")
        ).withColumn("_salt", salt(F.xxhash64("doc_id", F.monotonically_increasing_id()))),
        "audit",
    )
    repeated = (
        rows.groupBy("_digest")
        .agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n"), salt_mask("_salt").alias("_mask"))
        .filter("_n > 1")
        .drop("_n")
    )
    known = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    again = mask_of(letters, {REPEATS: F.col("doc_id") > F.col("_first")})
    return (
        give_back(rows, repeated, ["_digest"], "left")
        .select("doc_id", "part", F.col("_mask_here").bitwiseOR(again).alias("mask"))
        .join(known, "doc_id", "left")
        .select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    )


ENUMERATED = """
WITH RECURSIVE prefixes (part, filter_order, applied, metrics) AS (
  SELECT part, '', 0, CAST(array() AS array<struct<letter:string,kept:bigint,removed:bigint,redundant:bigint,
                                                   unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>>)
  FROM {cells}
  UNION ALL
  SELECT e.part, concat(e.filter_order, e.letter), e.applied | e.bit, array_append(e.metrics, named_struct(
    'letter', e.letter,
    'kept', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask & (e.applied | e.bit) = 0, x.n, 0L)),
    'removed', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask & e.bit <> 0 AND x.mask & e.applied = 0, x.n, 0L)),
    'redundant', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask & e.bit <> 0 AND x.mask & e.applied <> 0, x.n, 0L)),
    'unique_fails', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask = e.bit, x.n, 0L)),
    'good_lost', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask & e.bit <> 0 AND x.mask & e.applied = 0, x.good, 0L)),
    'toxic_lost', aggregate(c.cells, 0L, (s, x) -> s + IF(x.mask & e.bit <> 0 AND x.mask & e.applied = 0, x.toxic, 0L))))
  FROM (SELECT part, filter_order, applied, metrics, letter, shiftleft(1, instr({letters}, letter) - 1) AS bit
        FROM prefixes LATERAL VIEW explode(filter(split({letters}, ''), x -> instr(filter_order, x) = 0)) AS letter) e
  JOIN {cells} c ON c.part = e.part
)
SELECT part, filter_order, metrics FROM prefixes WHERE length(filter_order) = length({letters}) LIMIT ALL
"""


def filter_interactions(judged: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of all letters and step, from rows (part, mask, good, toxic).

    The bit of a letter in ``mask`` is its place in ``letters``. Columns: part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley, the filter's removals
    summed over all orders. A part occurs if it has a row, also when no filter fails; no rows give no result.
    """
    if len(letters) > MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"at most {MOST_FILTERS} filters, each with a letter of its own")
    counts = judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("bigint").alias("good"), F.sum("toxic").cast("bigint").alias("toxic")
    )
    # At most 2^n structs in an array.
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    spark = judged.sparkSession
    orders = spark.sql(ENUMERATED, letters=letters, cells=stage(cells, "audit-cells"))
    steps = orders.select("part", "filter_order", F.posexplode("metrics").alias("_at", "_m")).select(
        "part", "filter_order", (F.col("_at") + 1).alias("step"), "_m.*"
    )
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``documents``, split by language.

    NULL texts count as empty, NULL languages as the part ''. A NULL doc_id is never smaller than
    another and has no smaller one. Rows that repeat a doc_id count each and don't repeat each
    other; a document is good or toxic if any of its labels says so. Other columns are ignored.
    """
    return filter_interactions(judged(docs, labels), "ABCDE")


ORACLE = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), failed AS (
  SELECT g.doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM given g
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [a, b, c, d, e][i]) AS fails, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY ALL
), orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || l FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS u(l) WHERE NOT contains(o, l)
), steps AS (
  SELECT o, k, o[k] AS f, string_split(o[1:k - 1], '') AS earlier FROM orders, range(1, 6) AS r(k) WHERE length(o) = 5
), counted AS (
  SELECT part, o AS filter_order, k::INT AS step, f,
         sum(CASE WHEN NOT list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN list_contains(fails, f) AND list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = [f] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted
"""
