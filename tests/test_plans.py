"""What the plans must and must not hold."""

import re

from pyspark.sql import functions as F

from tandemtext.functions.sentences import split_sentences
from tandemtext.operators.filters import filter_english
from tandemtext.operators.ordinal import with_ordinal
from tandemtext.plans import corpus
from tandemtext.plans.demo import DemoTranslator
from tandemtext.sources.articles import read_articles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [(i, f"Ang balay {i}. Isa ka tawo.", "en", "s", 9) for i in range(50)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(path)
    return read_articles(spark, path)


def test_splitting_and_filtering_are_one_stage_without_python(spark, tmp_path):
    df = filter_english(split_sentences(documents(spark, tmp_path)), method="lexicon")
    plan = plan_of(df)
    assert "Exchange" not in plan and "Python" not in plan and "Sort" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_numbering_has_no_window_over_sentences(spark, tmp_path):
    numbered = corpus.numbered_sentences(documents(spark, tmp_path))
    plan = plan_of(numbered)
    # the only window runs over one row per partition, below an aggregate, and is broadcast
    assert re.search(r"BroadcastExchange(.|\n)*Window(.|\n)*HashAggregate", plan)
    assert plan.count("Window [") == 1
    assert "SinglePartition" in plan and plan.count("SinglePartition") == 1


def test_chunk_counts_read_only_row_numbers(spark, tmp_path):
    manifest = corpus.chunk_manifest(corpus.chunked_sentences(documents(spark, tmp_path)))
    assert re.search(r"ReadSchema: struct<_row:bigint>", plan_of(manifest))


def test_filter_runs_before_the_translator(spark, tmp_path):
    plan = plan_of(corpus.article_pairs(documents(spark, tmp_path), DemoTranslator, delay=0))
    assert plan.index("MapInPandas") < plan.index("Generate posexplode") and "Filter" in plan[plan.index("MapInPandas") :]


def test_assembly_moves_each_side_once(spark):
    source = spark.range(100).select(F.col("id").alias("chunk_id"), F.array(F.lit("a")).alias("sentences"))
    translated = spark.range(100).select(F.col("id").alias("chunk_id"), F.array(F.lit("b")).alias("translated_lines"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from tandemtext.operators.assemble import contamination, zip_chunks

        plan = plan_of(contamination(zip_chunks(source, translated)).filter("not contaminated"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_ordinals_survive_recomputation(spark):
    numbered = with_ordinal(spark.range(1000).repartition(13), ["id"])
    first = sorted(map(tuple, numbered.collect()))
    assert first == sorted(map(tuple, numbered.collect()))


def test_one_text_exchange_from_numbered_sentences_to_chunks(spark, tmp_path):
    from tandemtext.operators.chunking import pack_chunks

    plan = plan_of(pack_chunks(corpus.chunked_sentences(documents(spark, tmp_path))))
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning(chunk_id" not in initial


def test_running_ids_make_slices_without_an_exchange(spark):
    from tandemtext.operators.training import training_slices

    pairs = spark.range(5, 3005).select(F.col("id").alias("seq_id"), F.lit("e").alias("english"))
    assert "Exchange" not in plan_of(training_slices(pairs))


def test_a_hot_line_is_spread_by_its_share(spark):
    from tandemtext.operators.lookup import salted_left_join

    left = spark.range(10_000).select("id", F.expr("IF(id % 2 = 0, 'hot', concat('k', id))").alias("key"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "key STRING, v INT")
    joined = salted_left_join(left, right, ["key"], ["id"], hot_share=100)
    assert joined.filter("v = 1").count() == 5000 and joined.count() == 10_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = salted_left_join(left, right, ["key"], ["id"], hot_share=100).filter("v = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2000
