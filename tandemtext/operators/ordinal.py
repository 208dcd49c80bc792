"""Running row numbers over a whole table, without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .lookup import fresh

# Names used on the way; a user's columns of these names are called otherwise meanwhile.
_HELPERS = {"_row", "_rows", "_part", "_offset", "_first", "_last", "_low", "_high", "_n", "_p", "_carry", "_rank"}
# monotonically_increasing_id() keeps the partition in the bits above these.
_ROW_BITS = 33


def arrange(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Range-partition by the order columns and sort inside the partitions."""
    return df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)


# Ids are dense when they fill at least 1/DENSE of their span: no equal-width range is then
# more than DENSE times the mean.
DENSE = 4
IDS_PER_PARTITION = 1000


def whole_div(value: Column | str, by: int) -> Column:
    """Integer division, exact for any BIGINT."""
    return F.call_function("div", F.col(value) if isinstance(value, str) else value, F.lit(by))


def arrange_ids(df: DataFrame, key: str) -> DataFrame:
    """As ``arrange`` for rows with a unique integer id, without sampling where ids are dense.

    Sampling runs everything below the exchange a second time, which for long
    texts is a second scan of them. Dense ids, such as list positions, need only
    their smallest and largest value, from a scan of the id column.
    """
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return arrange(df, [key])
    stats = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n"), F.count(F.lit(1)).alias("rows"))
    low, high, n, rows = stats.first()
    if n == 0 or n < rows or high - low + 1 > DENSE * n:
        return arrange(df, [key])
    # As many partitions as the scan has splits, which follow its bytes; the setting is a floor for large inputs.
    floor = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // IDS_PER_PARTITION))
    parts = max(df.rdd.getNumPartitions(), floor)
    width = -(-(high - low + 1) // parts)
    place = whole_div(F.col(key) - F.lit(low), width).cast("int")
    return df.repartitionById(parts, place).sortWithinPartitions(key)


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "ordinal",
    start: int = 1,
    within: Sequence[str] = (),
    arranged: bool = False,
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``order_by``.

    ``order_by`` (after ``within``) must identify rows: then even one group
    holding most rows is spread over many range partitions. The arranged rows
    are written once, since range bounds are sampled and a second run could
    place rows differently. Offsets are one row per partition, which bounds
    what is broadcast. ``arranged=True`` says that the caller has range-partitioned
    and sorted the input already, possibly before a row-local step that yields many
    rows per input row; costly steps then run once, after the sampling.

    With ``within`` the numbers restart per group. The rank inside a (partition,
    group) piece needs one more shuffle, on pieces no larger than a partition;
    only pieces at a partition's edge can continue a group, so the carried
    offsets are at most two rows per partition. Columns of any name but ``name`` pass through.
    """
    own = {c: fresh(df, f"_own{c}") for c in df.columns if c.lower() in _HELPERS or c.lower().startswith("_w_")}
    if own:
        renamed, keys = df.withColumnsRenamed(own), [[own.get(c, c) for c in cs] for cs in (order_by, within)]
        numbered = with_ordinal(renamed, keys[0], name, start, keys[1], arranged)
        return numbered.withColumnsRenamed({new: old for old, new in own.items()})
    keys = [*within, *order_by]
    numbered = (df if arranged else arrange(df, keys)).withColumn("_row", F.monotonically_increasing_id())
    placed = stage(numbered, "ordinal", compression="zstd").withColumn("_part", F.shiftright("_row", _ROW_BITS))
    if within:
        return _restarting(placed, list(within), name, start).select(*df.columns, name)

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_row") - F.shiftleft("_part", _ROW_BITS)
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (local + F.col("_offset") + F.lit(start)).alias(name)
    )


def _restarting(placed: DataFrame, within: list[str], name: str, start: int) -> DataFrame:
    piece = ["_part", *within]
    edges = placed.groupBy("_part").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))
    counts = placed.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_low"), F.max("_row").alias("_high")
    )
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        counts.join(F.broadcast(edges), "_part")
        .filter((F.col("_low") == F.col("_first")) | (F.col("_high") == F.col("_last")))
        .withColumn("_carry", F.sum("_n").over(earlier))
        .filter("_carry is not null")
        .select(F.col("_part").alias("_p"), *[F.col(w).alias(f"_w_{w}") for w in within], "_carry")
    )
    rank = F.row_number().over(Window.partitionBy(*piece).orderBy("_row")).cast("bigint")
    same_piece = F.col("_part") == F.col("_p")
    for w in within:
        same_piece = same_piece & F.col(w).eqNullSafe(F.col(f"_w_{w}"))
    return placed.withColumn("_rank", rank).join(F.broadcast(carried), same_piece, "left").withColumn(
        name, F.col("_rank") - 1 + F.coalesce("_carry", F.lit(0)) + F.lit(start)
    )
