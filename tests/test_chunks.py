import random

import pytest
from pyspark.sql import functions as F

from tandemtext.operators.batches import batch_manifest, batch_work, round_robin_batches
from tandemtext.operators.chunking import (
    assign_chunks,
    chunk_count,
    chunk_lines,
    chunk_manifest,
    chunk_status,
    limit_articles,
    mark_translated,
    pack_chunks,
    pending_articles,
    unfinished,
)


def numbered(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("ordinal"), F.concat(F.lit("s"), "id").alias("sentence"))


def counts(manifest):
    return {r["chunk_id"]: r["sentence_count"] for r in manifest.collect()}


def test_chunk_sizes(spark):
    assert counts(chunk_manifest(assign_chunks(numbered(spark, 250)))) == {1: 100, 2: 100, 3: 50}
    assert counts(chunk_manifest(assign_chunks(numbered(spark, 200)))) == {1: 100, 2: 100}
    assert counts(chunk_manifest(assign_chunks(numbered(spark, 0)))) == {}


def test_a_later_run_goes_on_counting(spark):
    first = chunk_manifest(assign_chunks(numbered(spark, 250)))
    assert counts(chunk_manifest(assign_chunks(numbered(spark, 120), base=chunk_count(first)))) == {4: 100, 5: 20}


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        assign_chunks(numbered(spark, 1), 0)


def test_packed_chunks_keep_order_and_reread_as_lines(spark):
    rows = [(1, "a\nb "), (2, " c"), (3, "\r\n"), (4, "d\r\ne\rf"), (5, "g")]
    packed = pack_chunks(assign_chunks(spark.createDataFrame(rows, "ordinal BIGINT, sentence STRING"), 4))
    lines = [(r["chunk_id"], r["line_no"], r["line"]) for r in chunk_lines(packed).orderBy("chunk_id", "line_no").collect()]
    assert lines == [(1, i + 1, ch) for i, ch in enumerate("abcdef")] + [(2, 1, "g")]


def test_status_and_unfinished(spark):
    rows = [(2, True), (10, False), (3, None)]
    manifest = spark.createDataFrame(rows, "chunk_id BIGINT, is_translated BOOLEAN")
    assert [r[0] for r in unfinished(manifest).orderBy("chunk_id").collect()] == [3, 10]
    assert tuple(chunk_status(manifest).first()) == (1, 3)


def test_marking_is_keyed_and_ignores_unknown_ids(spark):
    manifest = chunk_manifest(assign_chunks(numbered(spark, 250)))
    one = mark_translated(manifest, spark.createDataFrame([(1, "t1")], "chunk_id BIGINT, translated_file STRING"))
    two = mark_translated(one, spark.createDataFrame([(3, "t3"), (99, "t99")], "chunk_id BIGINT, translated_file STRING"))
    got = {r["chunk_id"]: (r["is_translated"], r["translated_file"]) for r in two.collect()}
    assert got == {1: (True, "t1"), 2: (False, None), 3: (True, "t3")}


def test_pending_articles(texts):
    articles = texts(["a", "b", "c"])
    assert [r["doc_id"] for r in pending_articles(articles, articles.filter("doc_id = 1")).orderBy("doc_id").collect()] == [0, 2]


@pytest.mark.parametrize("ranges", [1024, 2, 3])
def test_limit_articles(texts, monkeypatch, ranges):
    monkeypatch.setattr("tandemtext.operators.chunking.RANGES", ranges)
    articles = texts(list("edcba"))
    assert sorted(r["text"] for r in limit_articles(articles, 2).collect()) == ["d", "e"]
    assert limit_articles(articles, 0).count() == limit_articles(articles, None).count() == limit_articles(articles, 9).count() == 5


def test_limit_with_null_and_scattered_ids(spark):
    ids = [None, -(2**63), 2**63 - 1, 0, 5, None, 6]
    articles = spark.createDataFrame([(i, "t") for i in ids], "doc_id BIGINT, text STRING")
    ordered = sorted(i for i in ids if i is not None) + [None, None]
    for n in range(1, 9):
        got = [r["doc_id"] for r in limit_articles(articles, n).collect()]
        assert sorted(got, key=lambda i: (i is None, i or 0)) == ordered[:n]


def chunk_ids(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("chunk_id"), F.lit(False).alias("is_translated"))


def by_batch(spark, n, batches):
    dealt = round_robin_batches(chunk_ids(spark, n), batches)
    ids = {b: sorted(r["chunk_id"] for r in dealt.filter(F.col("batch_number") == b).collect()) for b in range(batches)}
    return {r["batch_number"]: r for r in batch_manifest(dealt, batches).collect()}, ids


def test_round_robin(spark):
    got, ids = by_batch(spark, 10, 4)
    assert [ids[b] for b in range(4)] == [[1, 5, 9], [2, 6, 10], [3, 7], [4, 8]]
    assert got[1]["metadata"]["instructions"] == "Translate chunks 2 to 10"
    assert got[1]["metadata"]["purpose"] == "parallel_translation"
    assert (got[1]["chunk_count"], got[1]["total_batches"], got[1]["first_chunk"], got[1]["last_chunk"]) == (3, 4, 2, 10)


def test_more_batches_than_chunks(spark):
    got, ids = by_batch(spark, 2, 3)
    assert [ids[b] for b in range(3)] == [[1], [2], []]
    assert got[2]["metadata"]["instructions"] == "Empty batch" and got[2]["chunk_count"] == 0


def test_batch_count_must_be_positive(spark):
    with pytest.raises(ValueError):
        round_robin_batches(chunk_ids(spark, 1), 0)


def test_work_selection(spark):
    chunks = chunk_ids(spark, 6).withColumn("is_translated", F.col("chunk_id") < 4)
    manifest = round_robin_batches(chunks, 2)
    # ids of a batch are taken as they are, finished or not
    assert sorted(r["chunk_id"] for r in batch_work(chunks, manifest, 0).collect()) == [1, 3, 5]
    assert sorted(r["chunk_id"] for r in batch_work(chunks, manifest).collect()) == [1, 2, 3, 4, 5, 6]
    assert sorted(r["chunk_id"] for r in batch_work(chunks).collect()) == [4, 5, 6]


def test_limit_by_text_ids(spark):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("abé日\U0001f600/") for _ in range(rng.randint(0, 6))) for _ in range(400)} | {"same-long-start-" + str(i) for i in range(300)})
    df = spark.createDataFrame([(n, "x") for n in rng.sample(names, len(names))] + [(None, "x")] * 5, "doc_id STRING, text STRING").repartition(6)
    ordered = sorted(names, key=lambda s: s.encode())
    for n in (1, 2, 77, 350, len(names) - 1, len(names), len(names) + 3, len(names) + 50):
        got = [r["doc_id"] for r in limit_articles(df, n).collect()]
        assert sorted((g for g in got if g is not None), key=lambda s: s.encode()) == ordered[:n]
        assert got.count(None) == min(5, max(0, n - len(names)))
    plan = limit_articles(df, 77)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
    assert limit_articles(df.filter("doc_id IS NULL"), 3).count() == 3 and limit_articles(df.limit(0), 3).count() == 0
