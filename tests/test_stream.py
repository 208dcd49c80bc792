import shutil

import pytest
from pyspark.sql import functions as F

from tandemtext.plans.corpus import chunked_sentences
from tandemtext.streaming.ingest import chunk_sink, ingest_articles, read_ingested

TEXTS = [f"Ang balay {i} sang tawo. Isa ka tawo. The and that with a dog." for i in range(300)]


def articles(spark, low, high):
    return spark.createDataFrame([(i, TEXTS[i]) for i in range(low, high)], "doc_id BIGINT, text STRING")


def rows(df):
    return sorted(tuple(r) for r in df.select("chunk_id", "line_no", "doc_id", "pos", "sentence").collect())


def run(spark, tmp_path, **kwargs):
    ingest_articles(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), **kwargs).awaitTermination()


def test_one_batch_equals_the_batch_job(spark, tmp_path):
    articles(spark, 0, 300).repartition(3).write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    assert rows(read_ingested(spark, str(tmp_path / "out"))) == rows(chunked_sentences(articles(spark, 0, 300)))


def test_runs_go_on_where_the_last_one_stopped(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    articles(spark, 0, 120).coalesce(1).write.parquet(source)
    run(spark, tmp_path)
    run(spark, tmp_path)  # nothing new
    first = rows(chunked_sentences(articles(spark, 0, 120)))
    assert rows(read_ingested(spark, sink)) == first
    # 240 sentences: two whole chunks, and 40 that wait.
    assert rows(read_ingested(spark, sink, with_open=False)) == first[:200]
    for low, high in ((120, 121), (121, 300)):
        articles(spark, low, high).coalesce(1).write.mode("append").parquet(source)
        run(spark, tmp_path)
    assert rows(read_ingested(spark, sink)) == rows(chunked_sentences(articles(spark, 0, 300)))


def test_files_in_several_triggers(spark, tmp_path):
    articles(spark, 0, 300).repartition(3).write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path, max_files_per_trigger=1, size=50)
    got = read_ingested(spark, str(tmp_path / "out"))
    per_chunk = {r["chunk_id"]: r["count"] for r in got.groupBy("chunk_id").count().collect()}
    # No batch ends in a short chunk, and no chunk is in two batches.
    assert got.count() == 600 and per_chunk == dict.fromkeys(range(1, 13), 50)
    assert got.groupBy("chunk_id").agg(F.count_distinct("batch_id").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("size", [7, 100, 1000])
def test_batches_of_any_size_give_the_batch_jobs_chunks(spark, tmp_path, size):
    out = str(tmp_path / "out")
    write = chunk_sink(out, size)
    edges = [0, 1, 1, 3, 60, 61, 100]  # one batch is empty
    for k in range(len(edges) - 1):
        write(articles(spark, edges[k], edges[k + 1]), k)
    assert rows(read_ingested(spark, out)) == rows(chunked_sentences(articles(spark, 0, 100), size=size))
    assert read_ingested(spark, out, with_open=False).count() == 200 - 200 % size


def test_a_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    write = chunk_sink(out, 100)
    write(articles(spark, 0, 120), 0)
    write(articles(spark, 120, 300), 1)
    before = rows(read_ingested(spark, out))
    write(articles(spark, 120, 300), 1)
    assert rows(read_ingested(spark, out)) == before
    write(articles(spark, 0, 120), 0)
    write(articles(spark, 120, 300), 1)
    assert rows(read_ingested(spark, out)) == before


def test_a_batch_that_died_half_way_is_written_again(spark, tmp_path):
    out = str(tmp_path / "out")
    write = chunk_sink(out, 100)
    write(articles(spark, 0, 120), 0)
    write(articles(spark, 120, 300), 1)
    # Everything but its last write: the batch counts for nothing, and what it carries neither.
    shutil.rmtree(f"{out}/state/batch_id=1")
    assert rows(read_ingested(spark, out)) == rows(chunked_sentences(articles(spark, 0, 120)))
    write(articles(spark, 120, 300), 1)
    assert rows(read_ingested(spark, out)) == rows(chunked_sentences(articles(spark, 0, 300)))


def test_a_gap_in_batch_ids_and_another_size(spark, tmp_path):
    out = str(tmp_path / "out")
    chunk_sink(out, 100)(articles(spark, 0, 120), 3)
    chunk_sink(out, 100)(articles(spark, 120, 300), 7)
    assert rows(read_ingested(spark, out)) == rows(chunked_sentences(articles(spark, 0, 300)))
    with pytest.raises(ValueError):
        chunk_sink(out, 50)(articles(spark, 0, 1), 8)


def test_no_task_reads_all_of_a_batch(spark, tmp_path, monkeypatch):
    """Only what is in no file is brought into one partition in place; the open chunk's few sentences are shuffled there."""
    merged, kind = [], type(spark.range(1))
    merge = kind.coalesce
    monkeypatch.setattr(kind, "coalesce", lambda df, n: merged.append(len(df.inputFiles())) or merge(df, n))
    rows = [(i, f"Ang nahauna nga pulong {i}. Ang ikaduha nga pulong {i}.") for i in range(25)]
    sink = str(tmp_path / "sink")
    chunk_sink(sink, size=20)(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), 0)
    assert not any(merged)
    assert spark.read.parquet(f"{sink}/open/batch_id=0").count() == 10 and read_ingested(spark, sink).count() == 50
