"""URL filters: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything is column expressions and Spark's own tree trainer, in the JVM. The trees are
fitted on a bounded set of labelled URLs, so model and suffix table have one size at any scale,
and judging is one pass over the URLs without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import ascii_lower, sampled

# (verdict, host and path); the longest that fits wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Labelled URLs to fit on, in expectation, and the shape of the ensemble.
MOST_LABELLED = 20_000
TREES, DEPTH = 20, 4
# URLs that a suffix's share of bad ones counts as having beside its own, and folds of which a row's own is left out.
PRIOR, SUFFIX_FOLDS = 20, 5
FEATURES = (
    "length",
    "depth",
    "digit_ratio",
    "entropy",
    "parameters",
    "host_length",
    "host_labels",
    "host_hyphens",
    "longest_label",
    "suffix_rate",
    "suffix_weight",
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    start = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, NULL if none does.

    One comparison per rule and row: for lists of some hundred rules.
    """
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _entropy(text: str) -> str:
    """Bits per character of a column, from the number of each distinct character."""
    share = f"(length({text}) - length(replace({text}, c, ''))) / length({text})"
    return (
        f"CASE WHEN length({text}) = 0 THEN 0D ELSE aggregate(array_distinct(split({text}, '')), 0D, "
        f"(total, c) -> total + CASE WHEN c = '' THEN 0D ELSE -({share}) * log2({share}) END) END"
    )


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself; needs ``_url``, ``host`` and ``path``."""
    digits = F.length(F.regexp_replace("_url", "[^0-9]", ""))
    labels = F.split("host", r"\.")
    return urls.select(
        "*",
        F.length("_url").cast("double").alias("length"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double").alias("depth"),
        F.when(F.length("_url") > 0, digits / F.length("_url")).otherwise(0.0).alias("digit_ratio"),
        F.expr(_entropy("_url")).alias("entropy"),
        F.size(F.filter(F.split(F.regexp_extract("_url", r"\?([^#]*)", 1), "&"), lambda x: x != ""))
        .cast("double")
        .alias("parameters"),
        F.length("host").cast("double").alias("host_length"),
        F.size(labels).cast("double").alias("host_labels"),
        (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double").alias("host_hyphens"),
        F.array_max(F.transform(labels, F.length)).cast("double").alias("longest_label"),
        F.element_at(labels, -1).alias("_suffix"),
    )


def _parsed(urls: DataFrame, url_column: str, *keep: Column) -> DataFrame:
    return urls.select(
        *keep,
        F.coalesce(F.col(url_column), F.lit("")).alias("_url"),
        host_of(F.col(url_column)).alias("host"),
        path_of(F.col(url_column)).alias("path"),
    )


class UrlModel:
    """Suffix statistics and trees, or one constant score where the labels have no two classes."""

    def __init__(self, labelled: DataFrame, url_column: str = "url", label_column: str = "bad") -> None:
        """``labelled``: URLs with a label of 0 or 1; NULL is none. More than ``MOST_LABELLED`` are thinned by a hash of the URL.

        The chosen rows are written once, with their features: the trainer passes over them for every level of every tree.
        """
        known = labelled.filter(F.col(label_column).isNotNull())
        counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label_column).cast("bigint")).alias("bad")).first()
        n, bad = counts["n"], counts["bad"] or 0
        self.rate = bad / n if n else 0.0
        kept = known.filter(sampled(F.xxhash64(url_column, F.lit("urls")), MOST_LABELLED / n if n else 0.0))
        fold = F.pmod(F.xxhash64(url_column, F.lit("folds")), F.lit(SUFFIX_FOLDS)).cast("int").alias("_fold")
        rows = stage(lexical(_parsed(kept, url_column, F.col(label_column).cast("double").alias("_label"), fold)), "urls")
        # One row per suffix of the bounded sample.
        sums = rows.groupBy("_suffix").agg(F.sum("_label").alias("_bad"), F.count(F.lit(1)).alias("_all"))
        self.suffixes = sums.select("_suffix", *self._statistics(F.col("_bad"), F.col("_all")))
        self.trees = None
        if rows.select("_label").distinct().count() == 2:
            # A training row's statistics are those of the other folds, or it would tell the trees its own label.
            own = rows.groupBy("_suffix", "_fold").agg(F.sum("_label").alias("_b"), F.count(F.lit(1)).alias("_a"))
            others = own.join(sums, "_suffix").select(
                "_suffix", "_fold", *self._statistics(F.col("_bad") - F.col("_b"), F.col("_all") - F.col("_a"))
            )
            vectors = self._vectors(rows.join(F.broadcast(others), ["_suffix", "_fold"], "left")).select("_label", "_features")
            trainer = GBTClassifier(labelCol="_label", featuresCol="_features", maxIter=TREES, maxDepth=DEPTH, seed=7)
            # A bounded table, computed again from the written rows if an executor with a part of it is lost.
            vectors.persist()
            self.trees = trainer.fit(vectors)
            vectors.unpersist()

    def _statistics(self, bad: Column, count: Column) -> list[Column]:
        """Share of bad URLs, drawn towards that of all, and how much there is to go by."""
        rate = (bad + PRIOR * self.rate) / (count + PRIOR)
        return [rate.alias("suffix_rate"), F.log1p(count.cast("double")).alias("suffix_weight")]

    def _vectors(self, rows: DataFrame) -> DataFrame:
        known = rows.fillna({"suffix_rate": self.rate, "suffix_weight": 0.0})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(known)

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``score``, the probability of a bad URL, to rows with the lexical features."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.rate))
        known = rows.join(F.broadcast(self.suffixes), "_suffix", "left")
        scored = self.trees.transform(self._vectors(known))
        return scored.withColumn("score", vector_to_array("probability")[1])


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row.

    A rule's host fits itself and its subdomains, its path the start of the URL's; the longest
    rule wins. Without one, the trees block from ``threshold`` on. NULL URLs and those without ``://``
    have an empty host and path, fit no rule and are scored as they are, NULL as empty. Rows stand
    alone: repeated rows and NULL ids are fine; other columns are ignored.
    """
    model = UrlModel(labelled)
    rows = lexical(_parsed(pages, url_column, F.col(id_column).alias("page_id")))
    scored = model.score(rows).withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", learned).alias("verdict"),
        "score",
    )
