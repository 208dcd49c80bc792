"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts, as a Java and RE2 pattern.
SPACES = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# One bit of a BIGINT for each.
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of the contracts; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def crc_remainder(name: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def sampled(spread: Column, share: float | Column) -> Column:
    """True for a share of the values of a 64-bit hash; no share of a table that exists rounds to none."""
    below = F.least(F.lit(1.0), share if isinstance(share, Column) else F.lit(float(share))) * F.lit(float(1 << 62))
    return spread.bitwiseAND(F.lit((1 << 62) - 1)) < below.cast("bigint")


def salt(spread: Column) -> Column:
    return F.pmod(spread, F.lit(SALTS)).cast("int")


def salt_mask(salt_column: str) -> Column:
    """An aggregate: which salts occur in a group, as the bits of one number."""
    return F.bit_or(F.expr(f"shiftleft(1L, {salt_column})"))


def copies_for(mask: str) -> Column:
    """One row for each salt in the mask."""
    return F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> (shiftrightunsigned({mask}, s) & 1L) = 1L)"))


def give_back(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows that carry ``_salt`` with one row per key that carries ``_mask``, the salts its rows have.

    A key with a third of all rows is met in 64 places. No key here may be NULL.
    """
    copied = groups.withColumn("_salt", copies_for("_mask")).drop("_mask")
    return rows.join(copied, [*keys, "_salt"], how).drop("_salt")
