import random

import pytest
from pyspark.sql import functions as F

from tandemtext.operators.lookup import fits_in_memory, salted_left_join, split_flags, split_hot
from tandemtext.operators.ordinal import arrange_ids, with_ordinal


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_ordinals_do_not_depend_on_partitions(spark, partitions):
    rng = random.Random(1)
    # one article holds a third of all rows
    rows = [(0, p) for p in range(1500)] + [(d, p) for d in range(1, 300) for p in range(rng.randint(0, 20))]
    want = {row: i for i, row in enumerate(sorted(rows), 1)}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id BIGINT, pos INT").repartition(partitions)
    got = {(r["doc_id"], r["pos"]): r["ordinal"] for r in with_ordinal(df, ["doc_id", "pos"]).collect()}
    assert got == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordinals_within_groups(spark, partitions):
    rng = random.Random(2)
    rows = [("hot", t) for t in range(2000)] + [(f"g{i}", t) for i in range(200) for t in range(rng.randint(1, 9))]
    rows += [(None, 5), (None, 6)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g STRING, t INT").repartition(partitions)
    got = sorted((r["g"] or "", r["t"], r["k"]) for r in with_ordinal(df, ["t"], "k", within=["g"]).collect())
    want, count = [], {}
    for g, t in sorted((g or "", t) for g, t in rows):
        count[g] = count.get(g, 0) + 1
        want.append((g, t, count[g]))
    assert got == want


def test_hot_groups_are_spread(spark):
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("t"))
    ranked = with_ordinal(df, ["t"], "k", within=["g"])
    assert ranked.filter("k <> t + 1").count() == 0


def test_columns_named_like_helpers(spark):
    rows = [(i, i % 3, f"r{i}", -i, None, i * 2, "p") for i in range(200)]
    df = spark.createDataFrame(rows, "_n INT, _w_g INT, _row STRING, _part INT, _OFFSET STRING, _first INT, _p STRING").repartition(5)
    flat = with_ordinal(df, ["_n"])
    assert flat.columns == [*df.columns, "ordinal"]
    assert sorted(map(tuple, flat.collect())) == [(*r, r[0] + 1) for r in rows]
    grouped = with_ordinal(df, ["_n"], "k", within=["_w_g"])
    assert sorted(map(tuple, grouped.collect())) == [(*r, r[0] // 3 + 1) for r in rows]


def test_empty_input(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, pos INT")
    assert with_ordinal(df, ["doc_id", "pos"]).count() == 0


def test_hot_and_cold_flags_keep_every_word(spark):
    rng = random.Random(3)
    words = ["the"] * 5000 + [f"w{rng.randint(0, 3000)}" for _ in range(5000)] + ["x" * 400] * 2000
    rows = spark.createDataFrame(list(enumerate(words)), "id BIGINT, word STRING")
    dictionary = rows.groupBy("word").agg(F.count("*").alias("n")).withColumn("long", F.length("word") > 3)
    yes, no, cold = split_flags(dictionary, "word", "long")
    rare = {r["word"] for r in cold.collect()}
    assert 1000 < len(rare) and not rare & {"the", "x" * 400}
    for r in rows.select("word", yes(F.col("word")).alias("y"), no(F.col("word")).alias("n")).distinct().collect():
        hot = r["word"] not in rare
        assert (r["y"], r["n"]) == (hot and len(r["word"]) > 3, hot and len(r["word"]) <= 3)


def test_sizes_of_values_count(spark):
    narrow = spark.range(100).withColumn("v", F.lit(1))
    wide = spark.range(100).withColumn("v", F.sequence(F.lit(0), F.lit(1000)))
    assert fits_in_memory(narrow, 100, 10_000) and not fits_in_memory(narrow, 99, 10_000)
    assert not fits_in_memory(wide, 100, 10_000) and fits_in_memory(wide.limit(0), 100, 10)
    with pytest.raises(ValueError):
        split_hot(wide.withColumn("n", F.lit(1)), "id", "v")


def test_salted_join_equals_a_plain_join(spark):
    rng = random.Random(4)
    keys = ["hot"] * 4000 + [f"k{rng.randint(0, 4000)}" for _ in range(4000)] + [None] * 10
    left = spark.createDataFrame(list(enumerate(keys)), "id BIGINT, key STRING")
    right = spark.createDataFrame([(k, f"v-{k}") for k in {k for k in keys if k} if hash(k) % 2 or k == "hot"], "key STRING, v STRING")
    salted = salted_left_join(left, right, ["key"], ["id"], hot_share=100)
    assert sorted(map(tuple, salted.select("id", F.coalesce("v", F.lit(""))).collect())) == sorted(
        map(tuple, left.join(right, "key", "left").select("id", F.coalesce("v", F.lit(""))).collect())
    )


@pytest.mark.parametrize("ids", [list(range(5, 3005)), [i * i * 7919 for i in range(3000)], [3], [], [1, None, 2]])
def test_arranged_ids_are_in_order(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT").repartition(5)
    placed = arrange_ids(df, "id").withColumn("at", F.monotonically_increasing_id()).collect()
    got = [r["id"] for r in sorted(placed, key=lambda r: r["at"])]
    assert got == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_dense_ids_are_spread_evenly(spark):
    placed = arrange_ids(spark.range(10, 8010), "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) == 4 and max(r["count"] for r in placed) == 2000
