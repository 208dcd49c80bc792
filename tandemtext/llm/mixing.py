"""Mixing sources to target weights with Pareto order sampling.

A source's target is a number of words. Whole copies that every document gets are certain; the rest of the
target is a sample without repeats, in which each document has odds of inclusion of its own. A document is
ranked by the odds of a uniform number, which is a hash of the document, divided by its odds of inclusion; the
sample is the start of that order whose words fill the rest. Where the order has to be cut is found
by descent: words are summed in ever narrower ranges of ranks, and only the last range, of
a few rows, is sorted. No source, however large, is in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from ..session import stage
from .common import give_back, salt, salt_mask, words_of

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
# Ranks are whole numbers up to this; ties are broken by another number up to it.
TOP = 1 << 52
# Ranges of one descent, and the rows of a range that is sorted at last.
RANGES = 4096
LEAF = 500


def by_length(size: Column, mean: Column) -> Column:
    """Odds grow with the square root of a document's length: between equal chances of documents and of words."""
    return F.sqrt(size / mean)


def uniform(doc_id: Column, text: Column) -> Column:
    """A whole number below 2^52 from the document's id and text; equal rows have equal ones."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint")


def weighted(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """``sources`` by code point, NULL last, with weights that repeat, and ``_s``, their running number."""
    numbered = with_ordinal(sources, ["_null", "_source"], "_s", start=0)
    given = F.array(*[F.lit(w) for w in weights])
    return numbered.withColumn("_weight", F.get(given, F.pmod("_s", F.lit(len(weights))).cast("int")).cast("bigint"))


def with_targets(sources: DataFrame, most: int) -> DataFrame:
    """Adds ``target``: shares of all words by weight, at most ``most`` times the source's, the excess shared again.

    Each round is one aggregate of two numbers: the words of the sources at their limit, and the weight of
    the others. Sources never come back from the limit, so rounds end, mostly after a few.
    """
    total, free = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    limit = F.col("source_size") * F.lit(most)
    held, before = 0, None
    while (held, free) != before:
        before = (held, free)
        share = F.lit((total or 0) - held) * F.col("_weight") / F.lit(free or 1)
        over = limit < share
        at_limit, others = F.when(over, limit).otherwise(0), F.when(over, 0).otherwise(F.col("_weight"))
        held, free = sources.agg(F.coalesce(F.sum(at_limit), F.lit(0)), F.coalesce(F.sum(others), F.lit(0))).first()
    return sources.withColumn("target", F.when(over, limit.cast("double")).otherwise(share))


def cut_points(ranked: DataFrame, sources: DataFrame, leaf: int, ranges: int) -> DataFrame:
    """(_s, _cut_key, _cut_tie, _gap): the first row of each source's order that no longer fits, and the words left there."""
    # A cell is a range of (_key, _tie) in a source: what lies before fits, and the first row that doesn't is in it.
    cells = stage(
        sources.select(
            "_s", "_mask", "rest", F.lit(0).cast("bigint").alias("_before"), F.col("_docs").alias("_rows"),
            F.lit(0).cast("bigint").alias("_key_low"), F.lit(TOP).alias("_key_high"),
            F.lit(0).cast("bigint").alias("_tie_low"), F.lit(TOP).alias("_tie_high"),
        ),
        "mix-cells",
    )
    in_cell = F.expr("_key BETWEEN _key_low AND _key_high AND _tie BETWEEN _tie_low AND _tie_high")
    by_key = F.col("_key_high") > F.col("_key_low")
    low = F.when(by_key, F.col("_key_low")).otherwise(F.col("_tie_low"))
    high = F.when(by_key, F.col("_key_high")).otherwise(F.col("_tie_high"))
    width = F.call_function("div", high - low, F.lit(ranges)) + 1
    place = F.call_function("div", F.when(by_key, F.col("_key")).otherwise(F.col("_tie")) - low, width)
    kept = ["_s", "_salts", "rest", "_before", "_key_low", "_key_high", "_tie_low", "_tie_high"]

    splits = (F.col("_rows") > leaf) & ((F.col("_key_high") > F.col("_key_low")) | (F.col("_tie_high") > F.col("_tie_low")))
    while cells.filter(splits).limit(1).count():
        wide = cells.filter(splits)
        sums = (
            give_back(ranked.filter("_size > 0"), wide.drop("_rows").withColumn("_salts", F.col("_mask")), ["_s"])
            .filter(in_cell)
            .groupBy(*kept, place.alias("_place"))
            .agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        )
        # At most ``ranges`` + 1 rows of a source.
        upto = Window.partitionBy("_s").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        crossed = (
            sums.withColumn("_sum", F.sum("_words").over(upto) + F.col("_before"))
            .filter("_sum > rest")
            .groupBy(*kept)
            .agg(F.min(F.struct("_place", "_rows", "_words", "_sum")).alias("_c"))
        )
        start = low + F.col("_c._place") * width
        stop = F.least(start + width - 1, high)
        narrow = crossed.select(
            "_s", F.col("_salts").alias("_mask"), "rest", (F.col("_c._sum") - F.col("_c._words")).alias("_before"), F.col("_c._rows").alias("_rows"),
            F.when(by_key, start).otherwise(F.col("_key_low")).alias("_key_low"),
            F.when(by_key, stop).otherwise(F.col("_key_high")).alias("_key_high"),
            F.when(by_key, F.col("_tie_low")).otherwise(start).alias("_tie_low"),
            F.when(by_key, F.col("_tie_high")).otherwise(stop).alias("_tie_high"),
        )
        cells = stage(cells.filter(~splits).unionByName(narrow), "mix-cells")

    order = Window.partitionBy("_s").orderBy("_key", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = give_back(ranked.filter("_size > 0"), cells.drop("_rows").withColumn("_salts", F.col("_mask")), ["_s"]).filter(in_cell)
    return (
        last.withColumn("_sum", F.sum("_size").over(order) + F.col("_before"))
        .filter("_sum > rest")
        .groupBy("_s", "_salts", "rest")
        .agg(F.min(F.struct("_key", "_tie", (F.col("_sum") - F.col("_size")).alias("_full"))).alias("_c"))
        .select(
            "_s", F.col("_salts").alias("_mask"), F.col("_c._key").alias("_cut_key"), F.col("_c._tie").alias("_cut_tie"),
            (F.col("rest") - F.col("_c._full")).alias("_gap"),
        )
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    odds: Callable[[Column, Column], Column] = by_length,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    leaf: int = LEAF,
    ranges: int = RANGES,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, words that the mix takes from it.

    Sources in the order of their code points, NULL last, have ``weights`` in turn and share as many words as
    there are, at most ``most`` times their own. Every document is taken ``target div source_size`` times; in
    the sample of the rest, ``odds(size, mean size of the source's documents that have words)`` multiplies
    the source's odds. The sample is as large as fits into the rest; then one further document
    of the source, if there is one, brings its words closer to the target. Documents are taken
    whole, so a source of few, long documents can't come closer than they allow.

    NULL texts are empty, and empty documents take nothing. Documents that repeat id and text have the same rank and
    can't be told apart in the result, so it is the same in every run. Empty tables give no rows. Other columns are ignored.
    """
    given = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("_given"),
        F.size(words_of(F.col(text_column))).cast("bigint").alias("_size"),
        uniform(F.col(id_column), F.col(text_column)).alias("_uniform"),
    )
    rows = stage(
        given.select(
            "doc_id",
            F.coalesce(F.col("_given").cast("string"), F.lit("")).alias("_source"),
            F.col("_given").isNull().alias("_null"),
            "_size",
            "_uniform",
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mix-rows",
    ).withColumn("_salt", salt(F.xxhash64("_row")))
    # Counts of documents are of those that have words: others can't be in a sample.
    sums = rows.groupBy("_source", "_null").agg(
        F.sum("_size").alias("source_size"),
        F.sum(F.when(F.col("_size") > 0, 1).otherwise(0)).alias("_docs"),
        salt_mask("_salt").alias("_mask"),
    )
    targets = with_targets(stage(weighted(sums, weights), "mix-sources"), most)
    certain = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = stage(
        targets.withColumn("_copies", certain.cast("bigint")).withColumn(
            "rest", F.col("target") - F.col("_copies") * F.col("source_size")
        ),
        "mix-targets",
    )

    share = F.col("rest") / F.col("source_size")
    odds_in = share / (F.lit(1.0) - share) * odds(F.col("_size"), F.col("source_size") / F.col("_docs"))
    chance = (F.col("_uniform") + F.lit(0.5)) / F.lit(float(TOP))
    ratio = chance / (F.lit(1.0) - chance) / odds_in
    key = F.floor(ratio / (F.lit(1.0) + ratio) * F.lit(float(TOP))).cast("bigint")
    sampled = (F.col("_size") > 0) & (F.col("rest") > 0)
    with_source = give_back(rows.withColumn("_place", F.col("_salt")), sources.drop("_weight"), ["_source", "_null"])
    ranked = stage(
        with_source.select(
            "doc_id", "_size", "_s", "source_size", "target", "_copies", F.col("_place").alias("_salt"),
            F.when(sampled, key).alias("_key"),
            F.when(sampled, F.xxhash64("_row").bitwiseAND(F.lit(TOP - 1))).alias("_tie"),
        ),
        "mix-ranked",
    )
    cuts = stage(cut_points(ranked.select("_s", "_size", "_key", "_tie", "_salt"), sources.filter("rest > 0"), leaf, ranges), "mix-cuts")
    before = F.expr("_key < _cut_key OR _key = _cut_key AND _tie < _cut_tie")
    # The document that closes the gap best, if it brings the sum nearer at all.
    distance = F.abs(F.col("_size") - F.col("_gap"))
    closing = (
        give_back(ranked.filter("_size > 0"), cuts, ["_s"])
        .filter(~before & (distance < F.col("_gap")))
        .groupBy("_s")
        .agg(F.min(F.struct(distance.alias("_d"), "_key", "_tie")).alias("_closing"))
    )
    decided = cuts.join(closing, "_s", "left").select("_s", "_mask", "_cut_key", "_cut_tie", "_closing")
    closes = F.expr("_key = _closing._key AND _tie = _closing._tie")
    extra = F.when(before | closes, F.lit(1)).otherwise(F.lit(0))
    return give_back(ranked, decided, ["_s"], "left").select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * (F.col("_copies") + extra)).alias("taken"),
    )


ORACLE = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS u
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS docs,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM rows GROUP BY source
), rounds AS (
  SELECT 0 AS k, 0::BIGINT AS held, sum(w)::BIGINT AS free, sum(source_size)::BIGINT AS total, -1::BIGINT AS before FROM sources
  UNION ALL
  SELECT k + 1, sum(CASE WHEN 3 * source_size < (total - held) * w / free THEN 3 * source_size ELSE 0 END)::BIGINT,
         sum(CASE WHEN 3 * source_size < (total - held) * w / free THEN 0 ELSE w END)::BIGINT, total, held
  FROM rounds, sources WHERE held <> before GROUP BY k, held, free, total
), targets AS (
  SELECT source, source_size, docs,
         CASE WHEN 3 * source_size < (total - held) * w / free THEN (3 * source_size)::DOUBLE ELSE (total - held) * w / free END AS target
  FROM sources, (SELECT * FROM rounds ORDER BY k DESC LIMIT 1)
), certain AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM targets
), chances AS (
  SELECT r.*, source_size, target, docs, copies, target - copies * source_size AS rest, (u + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS c
  FROM rows r JOIN certain s ON r.source IS NOT DISTINCT FROM s.source
), ratios AS (
  SELECT *, CASE WHEN size > 0 AND rest > 0
                 THEN c / (1.0::DOUBLE - c) / (rest / source_size / (1.0::DOUBLE - rest / source_size) * sqrt(size / (source_size / docs))) END AS q
  FROM chances
), ordered AS (
  SELECT *, sum(CASE WHEN q IS NOT NULL THEN size END)
              OVER (PARTITION BY source ORDER BY floor(q / (1.0::DOUBLE + q) * 4503599627370496.0::DOUBLE) NULLS LAST
                    ROWS UNBOUNDED PRECEDING) <= rest AND q IS NOT NULL AS fits
  FROM ratios
), gaps AS (
  SELECT *, rest - coalesce(sum(size) FILTER (fits) OVER (PARTITION BY source), 0) AS gap FROM ordered
), closing AS (
  SELECT *, q IS NOT NULL AND NOT fits AND abs(size - gap) < gap
            AND row_number() OVER (PARTITION BY source ORDER BY q IS NULL, fits, abs(size - gap), q) = 1 AS closes
  FROM gaps
)
SELECT doc_id, size, source_size, target, (size * (copies + (fits OR closes)::INT))::BIGINT AS taken FROM closing
"""
