"""Large JSON documents in any layout, read by many tasks.

Files are cut at closing braces by the text reader, so a file without line breaks is split like any
other. A piece may start inside a string and does not know its depth: quote parity and nesting change of every piece,
for both cases, turn into its state by prefix sums over file blocks. Pieces are then regrouped into segments
that hold whole elements of the wanted depth. The same sums, with their minimum, tell of each file whether its brackets and quotes
balance, from one row per block; a file in which they don't is told apart before anything is gathered, since
its elements might never end. So no task sees more than one block or one element; elements
without any object, such as plain numbers, are cut only where the next object ends.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import stage

_BLOCK = ["file", "block"]


def _times(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _before(order: str, *partition: str):
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _change(text: Column, closed: Column) -> Column:
    """Nesting change of a piece that starts outside strings; ``closed``: whether its brace is outside too."""
    bare = F.regexp_replace(text, r'"[^"]*("|$)', "")
    return _times(bare, "{[") - _times(bare, "]") - closed.cast("int")


def json_segments(spark: SparkSession, path: str, depth: int, arrays: bool = True) -> DataFrame:
    """Runs of pieces that hold whole elements at nesting ``depth``.

    Columns: ``file``, ``segment`` (running per file), ``depth_from``, ``depth_to``, ``body``. A file holds one array,
    or one object if ``arrays`` is false. Of arrays that don't balance there are no segments; an object that doesn't is an error.
    """
    plain = F.regexp_replace("value", r"\\.", "")  # without escapes
    quotes = F.pmod(_times(plain, '"'), F.lit(2))
    scanned = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        "value",
        quotes.alias("quotes"),
        _change(plain, quotes == 0).alias("d_out"),
        _change(F.concat(F.lit('"'), plain), quotes == 1).alias("d_in"),
    )
    # Sums inside a block for both cases: that the block starts outside a string, or inside.
    local = Window.partitionBy(*_BLOCK).orderBy("row")
    inside = F.coalesce(F.sum("quotes").over(_before("row", *_BLOCK)), F.lit(0)) % 2 == 1
    placed = scanned.withColumn("inside", inside)
    placed = placed.withColumn("d_a", F.when(F.col("inside"), F.col("d_in")).otherwise(F.col("d_out"))).withColumn(
        "d_b", F.when(F.col("inside"), F.col("d_out")).otherwise(F.col("d_in"))
    )
    pieces = stage(
        placed.withColumn("s_a", F.sum("d_a").over(local)).withColumn("s_b", F.sum("d_b").over(local)).drop("d_out", "d_in"),
        "json-pieces",
    )

    # One row per block from here on: sums and least sums for both cases.
    blocks = pieces.groupBy(*_BLOCK).agg(
        F.sum("quotes").alias("q"),
        F.sum("d_a").alias("a"),
        F.sum("d_b").alias("b"),
        F.min("s_a").alias("low_a"),
        F.min("s_b").alias("low_b"),
        F.max("row").alias("last"),
        (F.sum(F.octet_length("value") + 1)).alias("bytes"),
        F.max("size").alias("size"),
    )
    parity = F.coalesce(F.sum("q").over(_before("block", "file")), F.lit(0)) % 2 == 1
    turned = (
        blocks.withColumn("odd", parity)
        .withColumn("d", F.when(F.col("odd"), F.col("b")).otherwise(F.col("a")))
        .withColumn("low", F.when(F.col("odd"), F.col("low_b")).otherwise(F.col("low_a")))
        .withColumn("depth", F.coalesce(F.sum("d").over(_before("block", "file")), F.lit(0)))
    )
    whole = Window.partitionBy("file")
    # The reader drops the brace that ends a piece. Whether the end of a file has one follows from its size, which a mark
    # at its start, three bytes, may be part of; of a compressed file, whose size is another, from the sum.
    excess = F.sum("bytes").over(whole) - F.max("size").over(whole)
    bare = F.when(excess.isin(1, -2), True).when(excess.isin(0, -3), False).otherwise(F.sum("d").over(whole) == -1)
    ended = turned.withColumn("bare_end", (F.col("block") == F.max("block").over(whole)) & bare)
    closed = F.sum("d").over(whole) + F.max(F.col("bare_end").cast("int")).over(whole) == 0
    # Before the end is known to have no brace, its sum is one too low.
    never_below = F.min(F.col("depth") + F.col("low")).over(whole) >= -F.max(F.col("bare_end").cast("int")).over(whole)
    sound = closed & never_below & (F.sum("q").over(whole) % 2 == 0)
    unsound = F.raise_error(F.concat(F.lit("brackets or quotes don't balance in "), "file")).cast("boolean")
    starts = (
        ended.withColumn("sound", sound)
        .filter(F.col("sound") if arrays else F.when(F.col("sound"), True).otherwise(unsound))
        .select(*_BLOCK, "odd", "depth", F.when(F.col("bare_end"), F.col("last")).alias("open_row"))
    )
    no_brace = F.col("row").eqNullSafe(F.col("open_row"))
    closes_outside = (F.col("inside") != F.col("odd")).cast("int") + F.col("quotes")
    after = F.col("depth") + F.when(F.col("odd"), F.col("s_b")).otherwise(F.col("s_a")) + no_brace.cast("int")
    change = F.when(F.col("odd"), F.col("d_b")).otherwise(F.col("d_a")) + no_brace.cast("int")
    ends = (after <= depth) & (closes_outside % 2 == 0) & ~no_brace
    deep = pieces.join(starts, _BLOCK).select(
        *_BLOCK,
        "row",
        F.when(no_brace, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("value"),
        change.alias("delta"),
        after.alias("after"),
        ends.cast("int").alias("ends"),
    )

    bases = (
        deep.groupBy(*_BLOCK)
        .agg(F.sum("ends").alias("_ends"))
        .select(*_BLOCK, F.coalesce(F.sum("_ends").over(_before("block", "file")), F.lit(0)).alias("base"))
    )
    segment = F.col("base") + F.coalesce(F.sum("ends").over(_before("row", *_BLOCK)), F.lit(0))
    entry = F.struct("block", "row", "value", "delta", "after")
    return (
        deep.join(bases, _BLOCK)
        .withColumn("segment", segment)
        .groupBy("file", "segment")
        .agg(F.sort_array(F.collect_list(entry)).alias("_l"))
        .select(
            "file",
            "segment",
            (F.element_at("_l", 1)["after"] - F.element_at("_l", 1)["delta"]).alias("depth_from"),
            F.element_at("_l", -1)["after"].alias("depth_to"),
            F.array_join(F.transform("_l", lambda e: e["value"]), "").alias("body"),
        )
    )


_STRICT = {"allowSingleQuotes": "false"}


def _like(pattern: str) -> Column:
    return F.regexp_like("body", F.lit(pattern))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Elements of files that each hold one JSON array: ``(file, segment, item, value VARIANT)``.

    A malformed file yields nothing. Order inside a file is ``(segment, item)``. Every element is parsed once:
    what is parsed is written, and files with a bad segment are left out after.
    """
    segments = json_segments(spark, path, 1)
    starts, closes = (F.col("segment") == 0), F.col("depth_to") == 0
    blank = _like(r"^\s*$")
    good = (
        F.when(starts, (F.col("depth_from") == 0) & (_like(r"^\s*\[") | blank))
        .when(F.col("depth_from") == 0, blank)
        # A comma or the end follows an element, and an element a comma.
        .otherwise(_like(r"^\s*(,|\]\s*$)") & ~_like(r"^\s*,\s*\]\s*$"))
    ) & (~closes | blank | _like(r"\]\s*$"))
    body = F.when(starts, F.regexp_replace("body", r"^\s*\[", "")).otherwise(F.regexp_replace("body", r"^\s*,", ""))
    body = F.when(closes, F.regexp_replace(body, r"\]\s*$", "")).otherwise(body)
    parsed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<variant>", _STRICT)
    read = segments.select("file", "segment", "depth_to", good.alias("_good"), parsed.alias("items"))
    flagged = read.select(
        "file",
        "segment",
        "depth_to",
        (~F.col("_good") | F.col("items").isNull() | (F.col("depth_to") < 0)).alias("_odd"),
        F.posexplode_outer("items").alias("item", "value"),
    )
    held = stage(flagged, "json-elements")
    bad = (
        held.groupBy("file")
        .agg(F.bool_or("_odd").alias("_bad"), F.max_by("depth_to", "segment").alias("_left_open"))
        .filter(F.col("_bad") | (F.col("_left_open") != 0))
        .select("file")
    )
    return held.filter("item IS NOT NULL").join(bad, "file", "left_anti").select("file", "segment", "item", "value")


def read_text_records(spark: SparkSession, path: str, text_field: str = "hiligaynon") -> DataFrame:
    """Objects of a JSON array file that have text; absent indices are 0.

    An index that is no integer is NULL, and ``article_ref`` holds it as it is written.
    """
    kind = F.schema_of_variant("value")

    def index(name: str) -> Column:
        absent = F.try_variant_get("value", f"$.{name}", "string").isNull()
        return F.when(absent, F.lit(0).cast("bigint")).otherwise(F.try_variant_get("value", f"$.{name}", "bigint")).alias(name)

    return (
        read_json_array(spark, path)
        .filter(F.startswith(kind, F.lit("OBJECT")))
        .select(
            "file",
            "segment",
            "item",
            index("article_index"),
            index("sentence_index"),
            F.try_variant_get("value", "$.article_index", "string").alias("article_ref"),
            F.try_variant_get("value", f"$.{text_field}", "string").alias("text"),
        )
        .filter(F.col("text").isNotNull() & (F.col("text") != ""))
    )


_OPENER = r'(?s)^.*?"chunks"\s*:\s*\{'


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Chunk entries of a JSON manifest in any layout, one row per chunk id; absent fields are NULL.

    A missing file is an empty manifest, a malformed entry fails the read. Ids are numbers, so they sort as such.
    """
    entry = f"map<string,struct<{', '.join(f.replace(' ', ':', 1) for f in schemas.MANIFEST_ENTRY.split(', '))}>>"
    try:
        segments = json_segments(spark, path, 2, arrays=False)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in (missing.getCondition() or ""):
            raise
        return spark.createDataFrame([], f"chunk_id BIGINT, {schemas.MANIFEST_ENTRY}")
    # A few segments per file lie at its upper levels: where the entries begin, and where those levels end.
    # A segment that begins by closing an array may come up from deeper.
    upper = (F.col("depth_from") < 2) | _like(r"^\s*\]")
    edges = stage(
        segments.filter(upper | (F.col("depth_to") < 2)).select(
            "file", "segment", "depth_to", (upper & _like(_OPENER)).alias("opens")
        ),
        "json-edges",
    )
    begin = edges.filter("opens").groupBy("file").agg(F.min("segment").alias("begin"))
    end = (
        edges.join(begin, "file")
        .filter("depth_to < 2 AND segment >= begin")
        .groupBy("file")
        .agg(F.min("segment").alias("end"))
    )
    inside = segments.join(begin, "file").join(end, "file", "left").filter(
        (F.col("segment") >= F.col("begin")) & (F.col("end").isNull() | (F.col("segment") < F.col("end")))
    )
    member = F.when(F.col("segment") == F.col("begin"), F.regexp_replace("body", _OPENER, "")).otherwise(
        F.regexp_replace("body", r"^\s*,", "")
    )
    entries = F.from_json(F.concat(F.lit("{"), member, F.lit("}")), entry, {**_STRICT, "mode": "FAILFAST"})
    rows = inside.select(F.explode(entries).alias("id", "entry"))
    return rows.select(F.col("id").cast("bigint").alias("chunk_id"), "entry.*")
