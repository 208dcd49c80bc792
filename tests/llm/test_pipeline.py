"""The stages one after the other, each against a plain version on its own input."""

import hashlib

import corpus_pipeline
import pytest
from helpers import FOLDER, empty, in_duckdb, odd
from test_encoding_packing_embeddings import padding, pieces_hold
from test_minhash import brute

from tandemtext.llm import line_dedup, pii
from tandemtext.llm.queries import QUERIES


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs, out)
        docs = out
    return found


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_dedup", "personal_data", "packing"]
    for name, (docs, out) in stages.items():
        assert name == "packing" or out.columns == docs.columns


def test_documents_without_letters_go_and_no_others(stages):
    docs, out = stages["language_id"]
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in out.collect()} == letters


def test_repeated_lines_go(stages):
    docs, out = stages["line_dedup"]
    names, want = in_duckdb(line_dedup.ORACLE, documents=docs.toPandas())
    at = {n: i for i, n in enumerate(names)}
    digests = {r[at["doc_id"]]: r[at["text_sha256"]] for r in want}
    for r in out.collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == digests[r.doc_id] and r.n_chars == len(r.text)
    assert {r.doc_id for r in out.collect()} == set(digests)
    assert sum(r[at["n_removed"]] for r in want) > 0


def test_one_document_of_each_group_stays(stages):
    docs, out = stages["minhash_dedup"]
    kept = {row[0] for row in brute([(r.doc_id, r.text) for r in docs.collect()]) if row[3]}
    assert {r.doc_id for r in out.collect()} == kept and len(kept) < docs.count()


def test_personal_data_is_gone(stages):
    docs, out = stages["personal_data"]
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in out.collect()}
    assert set(before) == set(after) and sum(len(pii.base_spans(t)) for t in before.values()) > 0
    for i, text in after.items():
        assert not any(kind < 3 for _, _, kind in pii.base_spans(text))
        if not pii.base_spans(before[i]) and "<" not in text:
            assert text == before[i]


def test_everything_is_packed(stages):
    docs, out = stages["packing"]
    lengths = pieces_hold(out.collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert padding(lengths) <= 0.03 * sum(lengths)


def test_run_is_all_stages(spark, stages):
    ran = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in ran.select("doc_id").distinct().collect()} == {r.doc_id for r in stages["packing"][0].collect()}


def test_odd_and_empty_documents(spark):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    odd_docs = spark.createDataFrame([(r.doc_id, r.text, r.lang, None, None) for r in odd(spark).collect()], schema)
    for docs in (odd_docs, empty(spark, schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "packing":
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), docs.schema)
        out.collect()


def test_columns_of_any_name_pass_through(spark):
    """Every name that a stage uses inside, as a user's column."""
    names = "n_lines n_removed _kept _row _id _version _text _places _all _i _v _salt _mask _hash _at _key lang_pred score kept component_id node".split()
    made = [(r.doc_id, r.text, r.lang, None, 5, *(f"{n}{k}" for n in names)) for k, r in enumerate(odd(spark).collect())]
    docs = spark.createDataFrame(made, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"{n} STRING" for n in names))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and rows
            was = {tuple(r[n] for n in names) for r in docs.collect()}
            assert {tuple(r[n] for n in names) for r in rows} <= was
            docs = spark.createDataFrame(rows, docs.schema)


def test_queries_are_registered():
    assert [int(name[2:].split("_")[0]) for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
