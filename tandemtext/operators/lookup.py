"""Equi-joins against a dictionary when few keys make up most of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds at least 1/HOT_SHARE of all rows, so no more than HOT_SHARE keys can be.
HOT_SHARE = 5000
# Hot keys are found by two 64-bit hashes, in a table of this many slots; so their length doesn't matter.
SLOTS = 8192
# A table of no more rows and bytes than this is broadcast whole.
SMALL_ROWS, SMALL_BYTES = 500_000, 16_000_000


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have: ``name``, with more underscores where it is taken."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fits_in_memory(table: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """Whether a table may be broadcast: counted, with all its columns' bytes, not estimated."""
    width = F.octet_length(F.to_json(F.struct(*table.columns)))
    found = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


FIXED_WIDTH = ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp")


def split_hot(
    dictionary: DataFrame, key: str, value: str, count: str = "n"
) -> tuple[Callable[[Column], Column], DataFrame]:
    """A look-up of hot keys inside a row, and the cold rest of ``dictionary(key, value, count)``.

    The look-up gives a struct with ``value``, NULL for a key that isn't hot. At most ``HOT_SHARE``
    hashes and values, of a type of fixed width, pass the driver. ``dictionary`` should be a written table, it is read three times.
    """
    if dictionary.schema[value].dataType.typeName() not in FIXED_WIDTH:
        raise ValueError(f"{value} must be of a type of fixed width")
    total = dictionary.agg(F.sum(count)).first()[0] or 0
    first, second = _hashes(F.col(key))
    hot = F.col(count) * HOT_SHARE >= F.lit(total)
    rows = dictionary.filter(hot).select(first.alias("a"), second.alias("b"), F.col(value).alias(value))
    slots: list[list[str]] = [[] for _ in range(SLOTS)]
    for place, entry in rows.select(F.pmod("a", F.lit(SLOTS)), F.to_json(F.struct("*"))).collect():
        slots[place].append(entry)
    kind = dictionary.schema[value].dataType
    entry = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField(value, kind)])
    # Parsed once, when the plan is made.
    held = F.from_json(F.lit(f"[{','.join(f'[{','.join(s)}]' for s in slots)}]"), T.ArrayType(T.ArrayType(entry)))

    def look_up(word: Column) -> Column:
        a, b = _hashes(word)
        slot = F.get(held, F.pmod(a, F.lit(SLOTS)).cast("int"))
        return F.get(F.filter(slot, lambda e: (e["a"] == a) & (e["b"] == b)), F.lit(0))

    return look_up, dictionary.filter(~hot)


def split_flags(
    dictionary: DataFrame, key: str, flag: str, count: str = "n"
) -> tuple[Callable[[Column], Column], Callable[[Column], Column], DataFrame]:
    """Tests for hot keys whose ``flag`` is true and for those whose flag is false, and the cold rest.

    As ``split_hot`` for a yes or no that is never NULL: each test is membership of two 64-bit hashes in sets of
    at most ``HOT_SHARE`` numbers.
    """
    total = dictionary.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT_SHARE >= F.lit(total)
    rows = dictionary.filter(hot).select(flag, *_hashes(F.col(key))).collect()

    def test(wanted: bool) -> Callable[[Column], Column]:
        first, second = ([r[i] for r in rows if r[0] == wanted] for i in (1, 2))

        def member(word: Column) -> Column:
            a, b = _hashes(word)
            return a.isin(first) & b.isin(second) if first else F.lit(False)

        return member

    return test(True), test(False), dictionary.filter(~hot)


def hot_keys(rows: DataFrame, on: list[str], hot_share: int = 1000) -> list[tuple[int, int]]:
    """``(hash, salts)`` of keys that hold more than 1/``hot_share`` of the rows, as many salts as they hold such shares.

    One pass with a sketch of frequent 64-bit hashes, combined map-side, so nothing is shuffled by key. It
    tracks many times as many hashes as can be hot and misses none of those; a clash only salts one more key.
    """
    frequent = F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {hot_share}, {20 * hot_share})")
    total, found = rows.agg(F.count(F.lit(1)), frequent).first()
    return [(e["item"], -(-e["count"] * hot_share // total)) for e in found if e["count"] * hot_share > total]


def salted_left_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], hot_share: int = 1000
) -> DataFrame:
    """Left equi-join that splits keys holding more than 1/``hot_share`` of the left rows.

    Without such keys it is a plain join. A hot key gets as many salts as it holds shares of 1/``hot_share``: left rows spread over them
    by a hash of ``spread_by`` (their row key, so retried tasks agree), and the
    few matching right rows are repeated once per salt. Nothing is dropped.
    ``left`` is evaluated twice.
    """
    found = hot_keys(left, on, hot_share)
    if not found:
        return left.join(right, on, "left")
    # Fewer than ``hot_share`` rows of two numbers.
    hot = F.broadcast(left.sparkSession.createDataFrame(found, "_key bigint, _salts int"))

    def flag(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*on)).join(hot, "_key", "left").drop("_key")

    spread: Column = F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")
    salted = flag(left).withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts")
    copies = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))
    repeated = flag(right).withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], "left").drop("_salt")
