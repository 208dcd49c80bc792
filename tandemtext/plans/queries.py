"""One query per operator over the given tables, each reading them whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.language import function_word_count, indicator_count, is_english_by_lexicon, is_english_by_patterns
from ..functions.sentences import abbreviation_matches, protect_abbreviations, sentence_array, split_sentences
from ..functions.text import text_lines, word_count
from ..operators.assemble import assign_seq_id, contamination, zip_by_rank, zip_chunks
from ..operators.batches import batch_manifest, batch_work, round_robin_batches
from ..operators.chunking import (
    assign_chunks,
    chunk_count,
    chunk_lines,
    chunk_manifest,
    chunk_status,
    limit_articles,
    mark_translated,
    pack_chunks,
    pending_articles,
    reread_lines,
    translated_path,
    unfinished,
)
from ..operators.filters import article_split_stats, filter_english, filter_min_length
from ..operators.language_model import classify_words, distinct_words, flag_english, train_language_model
from ..operators.training import (
    build_vocabulary,
    concat_datasets,
    encode_pairs,
    next_slice,
    pipeline_status,
    progress_log,
    progress_status,
    run_record,
    spot_check_compare,
    spot_check_sample,
    start_records,
    training_batch_summary,
    training_slices,
    write_slices,
)
from ..operators.translate import (
    KEEP_SOURCE,
    RESULT,
    STRICT,
    apply_translator,
    atomic_chunks,
    compact_results,
    memory_translation,
    translate_chunks,
    translate_durably,
)
from ..session import scratch_path, stage
from ..sources.articles import read_articles, spread_rows
from ..sources.files import (
    TRANSLATED,
    default_pairs_path,
    export_chunk_text,
    read_exported_text,
    read_pairs_jsonl,
    write_article_pairs,
    write_json_arrays,
    write_manifest_json,
    write_pairs_jsonl,
    write_spot_check,
)
from ..sources.json_files import read_manifest_json, read_text_records
from ..sources.progress import compact_completed, log_completed, read_completed, read_entries
from ..streaming.ingest import ingest_articles, read_ingested
from . import corpus
from .corpus import load_documents
from .demo import DemoTranslator

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUM_BATCHES = 4
BASE_MS = 1_700_000_000_000
SAMPLE_SEED = 7
# The time of the run, and of everything that it records.
RUN_TIME = 1_767_225_600


def run_ts():
    return F.timestamp_seconds(F.lit(RUN_TIME))


def query(build: Query) -> Query:
    """Register under the function's name; a leading ``run_`` only avoids a clash with the operator."""
    QUERIES[build.__name__.removeprefix("run_")] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _articles(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return spread_rows(load_documents(spark, sf_dir, *keep))


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.chunked_sentences(load_documents(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_lines(pack_chunks(_chunked(spark, sf_dir)))


def _translated(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    return apply_translator(_lines(spark, sf_dir), DemoTranslator, "line", policy, delay=0)


def _finished_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.translate_and_assemble(_chunked(spark, sf_dir), DemoTranslator, BASE_MS, delay=0, run_ts=run_ts())[0]


def _demo_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered pairs without a translator in the way: every kept sentence and a prefixed copy."""
    kept = _chunked(spark, sf_dir)
    return kept.select(
        F.col("ordinal").alias("seq_id"),
        F.concat(F.lit("[en] "), "sentence").alias("english"),
        F.col("sentence").alias("source_text"),
        "chunk_id",
    )


# --- sources and sinks


@query
def scan_articles(spark, sf_dir):
    return load_documents(spark, sf_dir)


@query
def scan_articles_explicit(spark, sf_dir):
    """Articles from a column that only its user knows to hold them."""
    return read_articles(spark, f"{sf_dir}/pages.parquet", text_column="html", id_column="page_id")


@query
def article_pairs_jsonl(spark, sf_dir):
    """Pairs by article and sentence, written as JSON lines below folders that don't exist yet, and read back."""
    path = f"{scratch_path(spark, 'article-pairs')}/deep/{default_pairs_path('documents.json')}"
    sentences = split_sentences(_articles(spark, sf_dir), profile="drop_punct")
    pairs = sentences.select(
        F.col("doc_id").alias("article_index"), F.col("pos").cast("bigint").alias("sentence_index"),
        F.col("sentence").alias("source_text"), F.concat(F.lit("[en] "), "sentence").alias("english"),
    )
    write_article_pairs(pairs, path, "hiligaynon")
    back = spark.read.schema("article_index BIGINT, sentence_index BIGINT, hiligaynon STRING, english STRING").json(path)
    return back.withColumnRenamed("hiligaynon", "source_text")


def _json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as array files with gaps: German without an index, French as non-objects, Spanish without text."""
    docs = load_documents(spark, sf_dir, "lang")
    text = F.col("text").alias("hiligaynon")
    element = (
        F.when(F.col("lang") == "de", F.to_json(F.struct(text)))
        .when(F.col("lang") == "fr", F.to_json(F.array("text")))
        .when(F.col("lang") == "es", F.to_json(F.struct(F.lit("").alias("hiligaynon"))))
        .otherwise(F.to_json(F.struct(text, F.col("doc_id").alias("article_index"))))
    )
    path = scratch_path(spark, "json-arrays")
    write_json_arrays(docs.select(element.alias("value")), path)
    return read_text_records(spark, path)


@query
def scan_json_array(spark, sf_dir):
    return _json_records(spark, sf_dir).select("article_index", "sentence_index", "text")


@query
def scan_json_one_line(spark, sf_dir):
    """Whole documents as array files without any line break."""
    docs = load_documents(spark, sf_dir)
    element = F.to_json(F.struct(F.col("text").alias("hiligaynon"), F.col("doc_id").alias("article_index")))
    path = scratch_path(spark, "json-one-line")
    entry = F.sort_array(F.collect_list(F.struct("doc_id", element.alias("e"))))
    files = docs.groupBy(F.floor(F.col("doc_id") / 100)).agg(F.transform(entry, lambda e: e["e"]).alias("es"))
    files.select(F.concat(F.lit("["), F.array_join("es", ","), F.lit("]")).alias("value")).repartition(16).write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    return read_text_records(spark, path).select("article_index", "sentence_index", "text")


@query
def scan_json_unbalanced(spark, sf_dir):
    """Files in which every French document opens an array too many yield nothing, beside sound ones."""
    docs, path = load_documents(spark, sf_dir, "lang"), scratch_path(spark, "json-unbalanced")
    element = F.to_json(F.struct(F.col("text").alias("hiligaynon"), F.col("doc_id").alias("article_index")))
    french = F.coalesce(F.col("lang") == "fr", F.lit(False))
    write_json_arrays(docs.filter(~french).select(element.alias("value")), f"{path}/sound")
    write_json_arrays(docs.filter(french).select(F.concat(element, F.lit(", [1")).alias("value")), f"{path}/broken")
    return read_text_records(spark, f"{path}/*").select("article_index", "sentence_index", "text")


@query
def record_pairs(spark, sf_dir):
    docs = load_documents(spark, sf_dir)
    element = F.to_json(F.struct(F.col("text").alias("hiligaynon"), F.col("doc_id").alias("article_index")))
    path = scratch_path(spark, "json-records")
    write_json_arrays(docs.select(element.alias("value")), path)
    return corpus.record_pairs(read_text_records(spark, path), DemoTranslator, delay=0)


@query
def scan_pairs_jsonl(spark, sf_dir):
    path = scratch_path(spark, "pairs-jsonl")
    docs = load_documents(spark, sf_dir)
    pairs = docs.select(
        F.col("doc_id").alias("seq_id"),
        F.concat(F.lit("[en] "), "text").alias("english"),
        F.col("text").alias("source_text"),
        F.lit(1).cast("bigint").alias("chunk_id"),
    )
    write_pairs_jsonl(pairs, path)
    return read_pairs_jsonl(spark, path)


@query
def run_chunk_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


@query
def run_chunk_manifest(spark, sf_dir):
    manifest = chunk_manifest(_chunked(spark, sf_dir), run_ts=run_ts())
    return manifest.select("chunk_id", "file_path", "sentence_count", "is_translated", F.unix_seconds("created_at").alias("created_at"))


@query
def manifest_scan(spark, sf_dir):
    path = scratch_path(spark, "manifest-json")
    write_manifest_json(chunk_manifest(_chunked(spark, sf_dir)), path)
    return read_manifest_json(spark, path).select("chunk_id", "file_path", "sentence_count", "is_translated", "translated_file")


@query
def manifest_layouts(spark, sf_dir):
    """A manifest of all chunks on one line, its metadata first, read back with its times."""
    manifest = chunk_manifest(_chunked(spark, sf_dir), run_ts=run_ts())
    entry = F.to_json(F.struct(*[c for c in manifest.columns if c != "chunk_id"]))
    member = F.concat(F.lit('"'), F.col("chunk_id").cast("string"), F.lit('":'), entry).alias("m")
    path = scratch_path(spark, "manifest-line")
    # Files of a thousand chunks each.
    files = manifest.select(F.floor(F.col("chunk_id") / 1000).alias("f"), member).groupBy("f").agg(F.array_join(F.collect_list("m"), ",").alias("ms"))
    line = F.concat(F.lit('{"metadata":{"made":{"by":"a run"}},"chunks":{'), "ms", F.lit("}}"))
    files.select(line.alias("value")).repartition(4, "value").write.option("maxRecordsPerFile", 1).text(path)
    read = read_manifest_json(spark, path)
    return read.select("chunk_id", "sentence_count", F.unix_seconds(F.to_timestamp("created_at")).alias("created_at"))


@query
def chunk_files_roundtrip(spark, sf_dir):
    """Source and translated chunks written to one folder of text files and read back."""
    path = scratch_path(spark, "chunk-text")
    lines = pack_chunks(_chunked(spark, sf_dir)).select("chunk_id", reread_lines("sentences").alias("lines"))
    done = translate_chunks(lines, DemoTranslator, delay=0).filter("ok")
    export_chunk_text(done, path, "lines")
    export_chunk_text(done, path, "translated_lines", TRANSLATED, mode="append")
    return read_exported_text(spark, path)


@query
def extracted_sentences(spark, sf_dir):
    return corpus.sequence_pairs(load_documents(spark, sf_dir), DemoTranslator, BASE_MS, delay=0)[0]


@query
def sequence_pairs(spark, sf_dir):
    return corpus.sequence_pairs(load_documents(spark, sf_dir), DemoTranslator, BASE_MS, delay=0)[1]


# --- filters and predicates


@query
def run_filter_min_length(spark, sf_dir):
    return filter_min_length(split_sentences(_articles(spark, sf_dir)))


@query
def run_filter_english(spark, sf_dir):
    return filter_english(split_sentences(_articles(spark, sf_dir)), method="patterns")


@query
def untranslated_chunks(spark, sf_dir):
    return unfinished(_finished_manifest(spark, sf_dir)).select("chunk_id", "sentence_count")


@query
def english_ratio_patterns(spark, sf_dir):
    return split_sentences(_articles(spark, sf_dir)).select(
        "doc_id",
        "pos",
        function_word_count("sentence").alias("hits"),
        word_count("sentence").alias("n_words"),
        is_english_by_patterns("sentence").alias("is_english"),
    )


@query
def english_ratio_lexicon(spark, sf_dir):
    return split_sentences(_articles(spark, sf_dir), profile="drop_punct").select(
        "doc_id",
        "pos",
        (function_word_count("sentence") + indicator_count("sentence")).alias("hits"),
        is_english_by_lexicon("sentence").alias("is_english"),
    )


# --- sentence splitting


def _split_query(profile: str) -> None:
    QUERIES[f"split_{profile}"] = lambda spark, sf_dir: split_sentences(_articles(spark, sf_dir), profile=profile)


for _profile in ("prod", "drop_punct", "full", "full_lookahead", "simple"):
    _split_query(_profile)


@query
def run_protect_abbreviations(spark, sf_dir):
    docs = _articles(spark, sf_dir)
    profiles = ("simple", "full", "full_lookahead", "drop_punct", "prod")
    return docs.select("doc_id", *[protect_abbreviations("text", p).alias(f"text_{p}") for p in profiles])


@query
def run_abbreviation_matches(spark, sf_dir):
    return abbreviation_matches(_articles(spark, sf_dir))


# --- word-level language detection


def _model(spark: SparkSession, sf_dir: str):
    return train_language_model(_articles(spark, sf_dir, "lang"))


@query
def lang_profile(spark, sf_dir):
    return _model(spark, sf_dir).profile.select("lang", "ngram", "n", "score")


@query
def word_language(spark, sf_dir):
    model = _model(spark, sf_dir)
    return classify_words(distinct_words(split_sentences(_articles(spark, sf_dir)), "sentence"), model)


# A model of two languages meets four: many words are of none that it knows.
LEAST_KNOWN = 0.5


def _two_languages(spark: SparkSession, sf_dir: str):
    return train_language_model(_articles(spark, sf_dir, "lang").filter("lang IN ('de', 'en')"))


@query
def word_language_rejects(spark, sf_dir):
    words_used = distinct_words(split_sentences(_articles(spark, sf_dir)), "sentence")
    return classify_words(words_used, _two_languages(spark, sf_dir), LEAST_KNOWN)


@query
def english_rejects(spark, sf_dir):
    sentences = split_sentences(_articles(spark, sf_dir))
    flagged = flag_english(sentences, _two_languages(spark, sf_dir), least_known=LEAST_KNOWN)
    return flagged.select("doc_id", "pos", "is_english")


@query
def english_all_words(spark, sf_dir):
    flagged = flag_english(split_sentences(_articles(spark, sf_dir)), _model(spark, sf_dir))
    return flagged.select("doc_id", "pos", "is_english")


@query
def english_all_words_null_keys(spark, sf_dir):
    """Every 97th document without its id: no sentence is lost, whatever its keys."""
    sentences = split_sentences(_articles(spark, sf_dir)).withColumn("doc_id", F.expr("IF(doc_id % 97 = 0, NULL, doc_id)"))
    flagged = flag_english(sentences, _model(spark, sf_dir))
    return flagged.groupBy("doc_id", "is_english").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sentence")).alias("chars"))


@query
def chunk_articles_by_words(spark, sf_dir):
    """The whole first phase with the word-level filter."""
    chunked = corpus.default_chunks(_articles(spark, sf_dir), _articles(spark, sf_dir, "lang"))
    return chunked.select("doc_id", "pos", "chunk_id", "line_no")


# --- aggregates


@query
def run_article_split_stats(spark, sf_dir):
    articles = _articles(spark, sf_dir).select("doc_id", sentence_array("text").alias("sentences"))
    stats = article_split_stats(articles)
    return stats.withColumn("skipped_heads", F.array_join("skipped_heads", "|"))


@query
def run_chunk_status(spark, sf_dir):
    return chunk_status(_finished_manifest(spark, sf_dir))


@query
def chunk_atomic_translate(spark, sf_dir):
    good = atomic_chunks(stage(_translated(spark, sf_dir, STRICT), "translated"))
    pairs = F.arrays_zip("source_lines", "translated_lines")
    return good.select("chunk_id", F.posexplode(pairs).alias("_p", "_e")).select(
        "chunk_id",
        (F.col("_p") + 1).alias("line_no"),
        F.col("_e.source_lines").alias("line"),
        F.col("_e.translated_lines").alias("translated"),
    )


@query
def chunk_early_stop(spark, sf_dir):
    packed = pack_chunks(_chunked(spark, sf_dir)).select("chunk_id", reread_lines("sentences").alias("lines"))
    done = translate_chunks(packed, DemoTranslator, delay=0)
    return done.select("chunk_id", "ok", "attempts", F.coalesce(F.size("translated_lines"), F.lit(0)).alias("n_lines"))


def _packed_lines(chunked: DataFrame) -> DataFrame:
    return pack_chunks(chunked).select("chunk_id", reread_lines("sentences").alias("lines"))


@query
def resumed_chunks(spark, sf_dir):
    """A worker does its batch and stops; a second run takes what is left, and failures again, but nothing finished."""
    folder, chunked = scratch_path(spark, "translation"), _chunked(spark, sf_dir)
    packed = stage(_packed_lines(chunked), "packed")
    batches = round_robin_batches(chunk_manifest(chunked), NUM_BATCHES)
    first = packed.join(batches.filter("batch_number = 1"), "chunk_id", "left_semi")
    translate_durably(first, DemoTranslator, folder, delay=0, chunks_per_task=16)
    results = translate_durably(packed, DemoTranslator, folder, delay=0, workers=8, chunks_per_task=64)
    tries = read_entries(spark, folder, RESULT).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("tries"))
    return results.join(tries, "chunk_id").select("chunk_id", "ok", "attempts", "pairs", "tries")


@query
def resumed_pairs(spark, sf_dir):
    """Manifest and pairs of a translation in two runs, its results compacted in between."""
    folder, chunked = scratch_path(spark, "translation"), _chunked(spark, sf_dir)
    half = chunked.filter("chunk_id % 2 = 0")
    corpus.resume_translation(half, DemoTranslator, folder, BASE_MS, delay=0, chunks_per_task=16)
    translate_durably(_packed_lines(chunked), DemoTranslator, folder, delay=0, chunks_per_task=16)
    compact_results(spark, folder)
    manifest, pairs = corpus.resume_translation(chunked, DemoTranslator, folder, BASE_MS, delay=0, chunks_per_task=16)
    finished = manifest.filter("is_translated AND translated_at IS NOT NULL").select("chunk_id")
    return pairs.join(finished, "chunk_id", "left_semi")


@query
def completion_log(spark, sf_dir):
    """Workers record their batches side by side, one of them twice; the log is compacted and grows again."""
    log, manifest = scratch_path(spark, "completed"), stage(chunk_manifest(_chunked(spark, sf_dir)), "manifest")
    done = manifest.select("chunk_id", translated_path("chunk_id").alias("translated_file")).join(_batches(spark, sf_dir), "chunk_id")
    for batch, later in ((1, 0), (2, 10), (1, 20)):
        log_completed(done.filter(F.col("batch_number") == batch), log, F.timestamp_seconds(F.lit(RUN_TIME + later)), f"worker {batch}")
    compact_completed(spark, log)
    log_completed(done.filter("batch_number = 3"), log, run_ts(), "worker 3")
    marked = mark_translated(manifest, read_completed(spark, log))
    return marked.select("chunk_id", "is_translated", "translated_file", F.unix_seconds("translated_at").alias("translated_at"))


@query
def contamination_check(spark, sf_dir):
    lenient = _translated(spark, sf_dir, KEEP_SOURCE)
    entries = F.sort_array(F.collect_list(F.struct("line_no", "line", "translated")))
    packed = lenient.groupBy("chunk_id").agg(entries.alias("e"))
    source = packed.select("chunk_id", F.transform("e", lambda x: x["line"]).alias("sentences"), F.transform("e", lambda x: x["translated"]).alias("translated_lines"))
    written = stage(source, "lenient")
    zipped = zip_chunks(written.select("chunk_id", "sentences"), written.select("chunk_id", "translated_lines"))
    return contamination(zipped).select("chunk_id", "n_lines", "identical", "contaminated")


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_robin_batches(chunk_manifest(_chunked(spark, sf_dir)), NUM_BATCHES)


@query
def run_round_robin_batches(spark, sf_dir):
    return _batches(spark, sf_dir)


@query
def run_batch_manifest(spark, sf_dir):
    manifest = batch_manifest(_batches(spark, sf_dir), NUM_BATCHES)
    return manifest.select(
        "batch_number",
        "total_batches",
        "chunk_count",
        "first_chunk",
        "last_chunk",
        F.col("metadata.instructions").alias("instructions"),
    )


@query
def batch_work_selection(spark, sf_dir):
    chunks = chunk_manifest(_chunked(spark, sf_dir))
    return batch_work(chunks, round_robin_batches(chunks, NUM_BATCHES), 1).select("chunk_id", "sentence_count")


@query
def run_run_totals(spark, sf_dir):
    docs = load_documents(spark, sf_dir)
    flags = split_sentences(docs).agg(
        F.count_if(~is_english_by_patterns("sentence")).alias("sentences"),
        F.count_if(is_english_by_patterns("sentence")).alias("skipped"),
    )
    manifest, pairs = corpus.translate_and_assemble(_chunked(spark, sf_dir), DemoTranslator, BASE_MS, delay=0, run_ts=run_ts())
    path = scratch_path(spark, "totals-jsonl")
    write_pairs_jsonl(pairs, path)
    one = F.lit(1)
    totals = (
        flags.select("sentences", "skipped")
        .unionByName(manifest.agg(F.count(one).alias("chunks")), allowMissingColumns=True)
        .unionByName(pairs.agg(F.count(one).alias("pairs")), allowMissingColumns=True)
        # Samples are what training loads from the written file.
        .unionByName(read_pairs_jsonl(spark, path).agg(F.count("seq_id").alias("samples")), allowMissingColumns=True)
    )
    return totals.agg(*[F.sum(c).alias(c) for c in ("sentences", "skipped", "chunks", "pairs", "samples")])


# --- ordinals


@query
def global_ordinal(spark, sf_dir):
    kept = corpus.numbered_sentences(load_documents(spark, sf_dir), keep=lambda s: filter_english(s, method="patterns"))
    return kept.select("doc_id", "pos", "ordinal")


@query
def run_assign_chunks(spark, sf_dir):
    return _chunked(spark, sf_dir).select("doc_id", "pos", "ordinal", "chunk_id", "line_no")


@query
def run_assign_seq_id(spark, sf_dir):
    kept = filter_english(split_sentences(_articles(spark, sf_dir)), method="patterns")
    return assign_seq_id(kept, ["doc_id", "pos"], BASE_MS).select("seq_id", "doc_id", "pos")


@query
def run_limit_articles(spark, sf_dir):
    return limit_articles(load_documents(spark, sf_dir), 100)


@query
def limit_articles_nulls(spark, sf_dir):
    """Half the articles, and NULL ids that come last."""
    docs = load_documents(spark, sf_dir).withColumn("doc_id", F.expr("IF(doc_id % 10 = 3, NULL, doc_id)"))
    n = docs.count() // 2
    return limit_articles(docs, n).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query
def run_spot_check_sample(spark, sf_dir):
    return spot_check_sample(_table(spark, sf_dir, "benchmark"), "item_id", 10, SAMPLE_SEED)


# --- joins and assembly


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = _table(spark, sf_dir, "conversations")
    user, reply = talk.filter("role = 'user'"), talk.filter("role = 'assistant'")
    return zip_by_rank(user, reply, "conv_id", "turn", "text", "text")


@query
def zip_pairs(spark, sf_dir):
    return _turns(spark, sf_dir)


@query
def run_assemble_pairs(spark, sf_dir):
    return corpus.translate_and_assemble(_chunked(spark, sf_dir), DemoTranslator, BASE_MS, delay=0)[1]


@query
def run_concat_datasets(spark, sf_dir):
    talk = _turns(spark, sf_dir).select("english", "source_text")
    return concat_datasets(_demo_pairs(spark, sf_dir).select("english", "source_text"), talk)


@query
def translation_memory_join(spark, sf_dir):
    """Lines of all documents against a memory built from the labelled ones."""
    docs = load_documents(spark, sf_dir)
    lines = docs.select("doc_id", F.posexplode(text_lines("text")).alias("pos", "line"))
    known = docs.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    memory = known.select(F.explode(text_lines("text")).alias("source_text")).distinct()
    memory = memory.withColumn("translated", F.concat(F.lit("[en] "), "source_text"))
    return memory_translation(lines, memory, ["doc_id", "pos"]).select("doc_id", "pos", "translated", "ok")


@query
def memory_hot_line(spark, sf_dir):
    """One line in every second row: the memory join spreads it."""
    docs = load_documents(spark, sf_dir)
    lines = docs.select("doc_id", F.posexplode(text_lines("text")).alias("pos", "own")).select(
        "doc_id", "pos", F.expr("IF((doc_id + pos) % 2 = 0, 'the one frequent line', own)").alias("line")
    )
    memory = docs.select(F.explode(text_lines("text")).alias("source_text")).filter("length(source_text) % 3 = 0").distinct()
    memory = memory.unionByName(memory.limit(1).select(F.lit("the one frequent line").alias("source_text")))
    memory = memory.withColumn("translated", F.upper("source_text"))
    return memory_translation(lines, memory, ["doc_id", "pos"]).select("doc_id", "pos", "ok")


@query
def encode_concat(spark, sf_dir):
    """Pairs of two runs with the same ids and of conversations, encoded together."""
    runs = _demo_pairs(spark, sf_dir).select("seq_id", "english", "source_text")
    talk = _turns(spark, sf_dir).select(F.col("k").alias("seq_id"), "english", "source_text")
    # Both read tables that are written already, the numbered sentences and the numbered tokens.
    pairs = concat_datasets(runs, runs, talk)
    encoded = encode_pairs(pairs, build_vocabulary(pairs))
    return encoded.groupBy("seq_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("input_sum"),
        F.sum(F.aggregate("labels", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("label_sum"),
        F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)).alias("mask_sum"),
    )


# --- resuming


@query
def resume_chunks(spark, sf_dir):
    """Labelled documents first, then a second run over all documents that takes the rest."""
    docs = load_documents(spark, sf_dir)
    first = docs.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    done = chunk_manifest(corpus.chunked_sentences(first))
    rest = corpus.chunked_sentences(pending_articles(docs, first), base=chunk_count(done))
    return done.unionByName(chunk_manifest(rest)).select("chunk_id", "sentence_count")


@query
def run_mark_translated(spark, sf_dir):
    manifest = _finished_manifest(spark, sf_dir)
    return manifest.select(
        "chunk_id", "sentence_count", "is_translated", "translated_file", F.unix_seconds("translated_at").alias("translated_at")
    )


@query
def run_progress_status(spark, sf_dir):
    """All slices but the last are done, the last has begun."""
    slices = training_slices(_demo_pairs(spark, sf_dir))
    at = F.timestamp_seconds(F.col("batch_index") * 60)
    last = slices.agg(F.max("batch_index")).first()[0]
    done = slices.filter(F.col("batch_index") < F.lit(last))
    folder = F.concat(F.lit("models/batch_"), F.col("batch_index").cast("string"))
    log = run_record(slices, F.timestamp_seconds(F.lit(0))).unionByName(start_records(slices, at)).unionByName(progress_log(done, at, folder))
    status = progress_status(log)
    return status.withColumn("last_update", F.unix_seconds("last_update")).withColumn("start_time", F.unix_seconds("start_time"))


@query
def run_pipeline_status(spark, sf_dir):
    docs = load_documents(spark, sf_dir)
    pairs = stage(_demo_pairs(spark, sf_dir), "pairs")
    log = progress_log(training_slices(pairs), F.timestamp_seconds(F.col("batch_index") * 60))
    status = pipeline_status(split_sentences(docs), pairs, log)
    return status.withColumn("last_training", F.unix_seconds("last_training"))


# --- translation


@query
def translate_strict(spark, sf_dir):
    return _translated(spark, sf_dir, STRICT)


@query
def translate_keep_source(spark, sf_dir):
    return _translated(spark, sf_dir, KEEP_SOURCE).drop("error")


@query
def article_pairs(spark, sf_dir):
    return corpus.article_pairs(_articles(spark, sf_dir), DemoTranslator, delay=0)


# --- training data


@query
def run_training_slices(spark, sf_dir):
    return training_slices(_demo_pairs(spark, sf_dir)).select("seq_id", "batch_index")


@query
def next_training_slice(spark, sf_dir):
    """Half of the slices are done; the log names the next one, and the store gives its pairs alone."""
    path, pairs = scratch_path(spark, "slices"), stage(_demo_pairs(spark, sf_dir), "pairs")
    write_slices(pairs, path, per_folder=4)
    slices = training_slices(pairs)
    half = training_batch_summary(pairs).first()["n_batches"] // 2
    index, rows = next_slice(spark, path, progress_log(slices.filter(F.col("batch_index") < half), run_ts()), per_folder=4)
    return rows.select("seq_id", "english", "batch_index", F.lit(index).cast("bigint").alias("next_index"))


@query
def limit_articles_texts(spark, sf_dir):
    """A third of the articles by an id that is a text, some of them without one."""
    docs = load_documents(spark, sf_dir)
    named = docs.withColumn("doc_id", F.expr("IF(doc_id % 10 = 3, NULL, concat('article-', doc_id * 7919 % 1000003))"))
    return limit_articles(named, docs.count() // 3).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query
def run_training_batch_summary(spark, sf_dir):
    return training_batch_summary(_demo_pairs(spark, sf_dir))


@query
def run_build_vocab(spark, sf_dir):
    return build_vocabulary(_demo_pairs(spark, sf_dir))


@query
def encode_pad(spark, sf_dir):
    # Both read tables that are written already, the numbered sentences and the numbered tokens.
    pairs = _demo_pairs(spark, sf_dir)
    encoded = encode_pairs(pairs, build_vocabulary(pairs))
    return encoded.select("seq_id", *[F.array_join(c, " ").alias(c) for c in ("input_ids", "attention_mask", "labels")])


@query
def spot_check_written(spark, sf_dir):
    """The comparison as the JSON that is kept of it."""
    path, results = scratch_path(spark, "spot-check"), run_spot_check_compare(spark, sf_dir)
    write_spot_check(results, path)
    return spark.read.schema(results.schema).json(path)


@query
def run_spot_check_compare(spark, sf_dir):
    items = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("sample_id"), F.col("text").alias("english"), F.col("text").alias("source_text")
    )
    sample = spot_check_sample(items, "sample_id", 10, SAMPLE_SEED)
    return spot_check_compare(sample, DemoTranslator, retries=3).drop("error")


# --- streaming


@query
def stream_chunk_ingest(spark, sf_dir):
    run = scratch_path(spark, "ingest")
    ingest_articles(spark, f"{sf_dir}/documents*.parquet", f"{run}/sink", f"{run}/state").awaitTermination()
    return read_ingested(spark, f"{run}/sink").select("doc_id", "pos", "chunk_id", "line_no", "sentence")


@query
def stream_open_chunk(spark, sf_dir):
    """The documents arrive in three parts, one run each: chunks go on across runs as if they had come at once."""
    run, docs = scratch_path(spark, "ingest"), _table(spark, sf_dir, "documents")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    part = F.call_function("div", (F.col("doc_id") - low) * 3, F.lit(high - low + 1))
    for k in range(3):
        docs.filter(part == k).write.mode("append").parquet(f"{run}/in")
        ingest_articles(spark, f"{run}/in", f"{run}/sink", f"{run}/state").awaitTermination()
    return read_ingested(spark, f"{run}/sink").select("doc_id", "pos", "chunk_id", "line_no", "sentence")
