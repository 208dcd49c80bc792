import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import FOLDER, agree, empty, least_reachable, odd
from tokenizers import Tokenizer

from tandemtext.llm import embedding_dedup, merge_encoding, packing
from tandemtext.llm.queries import BYTE_MODEL, PIECE_MODEL, vocabulary

PIECES = vocabulary(PIECE_MODEL)
BYTES = vocabulary(BYTE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))


def texts():
    random.seed(5)
    letters = list("abcdefghijklmnopqrstuvwxyz  etaoin\n\t\r<>/0x41▁éß日本𝄞ﬁ.,!'\"-#ABCя‍")
    made = ["", " ", "▁", "<s>", "</s><unk>", "ab" * 20_000, "\n" * 50, "=" * 999, " " * 70, "é" * 300]
    made += ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    made += ["".join(random.choice("xaé 1=") for _ in range(random.randint(0, 60))) for _ in range(700)]
    return made


def test_pieces_against_the_library(spark, library):
    made = texts()
    vocab = [library.id_to_piece(i) for i in range(259, 32_000)]
    made += ["".join(random.choice(vocab) for _ in range(6)) for _ in range(700)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id BIGINT, text STRING")
    for r in merge_encoding.encode_texts(docs, PIECES).collect():
        ids = library.encode(made[r.doc_id])
        assert (r.ids, r.decoded) == (ids, library.decode(ids))


def test_piece_digests_of_odd_rows(spark, library):
    got = merge_encoding.encoding_digests(odd(spark), PIECES).collect()
    want = []
    for r in odd(spark).collect():
        ids = library.encode(r.text or "")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert merge_encoding.encoding_digests(empty(spark), PIECES).collect() == []


def test_merging_by_score_against_the_library(library):
    encoder = merge_encoding.Encoder(merge_encoding.Vocabulary(PIECES))
    for word in ["▁unbelievable", "▁aaaaaaaa", "▁Donaudampfschiff", "▁▁▁x"]:
        assert encoder.merge(word) == encoder.known(word) == [library.id_to_piece(i) for i in library.encode(word[1:].replace("▁", " "))]


# --- packing


def pieces_hold(got, docs):
    """Every id in one piece, sequences gapless and short enough; returns lengths of the sequences."""
    library = Tokenizer.from_buffer(BYTES)
    ids = {}
    for doc_id, text in docs:
        ids.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for doc_id, held in ids.items():
        if len(held) > 1:
            continue  # rows that repeat an id
        end = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            part = np.array(held[0][r.start : r.start + r.length], dtype="<u4")
            assert (r.start, r.ids_crc32, r.doc_tokens) == (end, zlib.crc32(part.tobytes()), len(held[0]))
            end += r.length
        assert end == len(held[0])
    lengths = []
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= packing.SIZE
        lengths.append(end)
    assert sum(lengths) == sum(len(x) for held in ids.values() for x in held)
    return lengths


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else packing.SIZE - n for n in lengths)


def test_pieces_of_the_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 9_000)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    lengths = pieces_hold(packing.pack_documents(docs, BYTES).collect(), [tuple(r) for r in docs.collect()])
    assert padding(lengths) <= 0.03 * sum(lengths)


def test_pieces_of_odd_rows(spark):
    docs = odd(spark)
    got = packing.pack_documents(docs.repartition(3), BYTES).collect()
    pieces_hold(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert [r.doc_tokens for r in got if r.doc_id in (4, 6)] == [1, 1]
    assert packing.pack_documents(empty(spark), BYTES).collect() == []


def test_cached_ids_against_the_library():
    cached, library = packing.CachedTokenizer(BYTES), Tokenizer.from_buffer(BYTES)
    random.seed(9)
    for _ in range(4000):
        text = "".join(random.choice("ab c'sdlt  \n\t12é.!?ÀÿĀɏ<|>日¼²ªº× \u0085\xa0\x1c") for _ in range(random.randint(0, 30)))
        assert np.frombuffer(cached.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(cached.encode("a<|endoftext|>b"), "<u4").tolist() == library.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_cuts_are_the_cheapest():
    random.seed(10)
    size = 16
    for _ in range(200):
        gaps = [random.randint(1, 6) for _ in range(random.randint(1, 12))]
        positions = np.cumsum([0, *gaps])
        penalties = np.array([0, *[random.choice([0, 4, 24]) for _ in gaps]])
        n = len(positions)

        def window(i, j):
            d = int(positions[j] - positions[i])
            return (0 if d & (d - 1) == 0 else size - d) + packing.SEQUENCE + int(penalties[j])

        best = [0] + [None] * (n - 1)
        for j in range(1, n):
            best[j] = min(best[i] + window(i, j) for i in range(j) if positions[j] - positions[i] <= size)
        cuts = packing.best_cuts(positions, penalties, size)
        assert (cuts[0], cuts[-1]) == (0, n - 1)
        assert sum(window(i, j) for i, j in zip(cuts, cuts[1:])) == best[-1]


# --- embeddings


def brute(vectors):
    good = {}
    for i, v in vectors:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)))
    pairs, count = [], {}
    for width in {len(u) for u in good.values()}:
        ids = sorted(i for i, u in good.items() if len(u) == width)
        units = np.array([good[i] for i in ids])
        linked = units @ units.T >= 0.9
        np.fill_diagonal(linked, False)
        pairs += [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))]
        count |= {i: int(n) for i, n in zip(ids, linked.sum(axis=1))}
    found = least_reachable(sorted(good), pairs)
    return sorted((i, count.get(i, 0), found.get(i, i), found.get(i, i) == i) for i, _ in vectors)


def clusters():
    random = np.random.default_rng(12)
    rows = []
    for _ in range(60):
        base = random.normal(size=8)
        rows += [(base + random.normal(size=8) * 0.25).tolist() for _ in range(random.integers(1, 15))]
    rows += rows[:20]
    return rows


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    rows = clusters()
    rows += [None, [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [], [1.0] * 3, [1e-30] * 8, [2e30] * 8]
    vectors = list(enumerate(rows))
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in vectors], "vec_id BIGINT, embedding ARRAY<FLOAT>, _mask INT, node STRING")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    assert sorted(map(tuple, embedding_dedup.near_duplicate_vectors(df.repartition(5)).collect())) == brute(single)


def test_one_large_group_of_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 128)
    random = np.random.default_rng(13)
    vectors = [(i, v) for i, v in enumerate((np.ones(8) + random.normal(size=(900, 8)) * 0.3).tolist())]
    df = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert sorted(map(tuple, embedding_dedup.near_duplicate_vectors(df).collect())) == brute(vectors)


def test_a_vector_is_shuffled_once_however_many_lists_it_visits(spark, monkeypatch):
    """Packs are written once and meet by reading them again; results are those of all pairs, whatever the size of a pack."""
    plans, stage = {}, embedding_dedup.stage

    def watched(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(embedding_dedup, "stage", watched)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "PACK_ROWS", 23)
    vectors = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(clusters())]
    df = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, embedding_dedup.near_duplicate_vectors(df.repartition(5)).collect())) == brute(vectors)
    assert not any("FlatMapCoGroups" in p or "explode(visits" in p for ps in plans.values() for p in ps)
    assert "Exchange" not in plans["found"][0] and "Exchange" in plans["packed"][0]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows


def test_signs_of_zeros_do_not_part_equal_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [-0.0, 1.0])]
    got = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_embeddings_against_sql(spark):
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(clusters()[:150])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got, want = agree(embedding_dedup.near_duplicate_vectors(vectors), embedding_dedup.ORACLE, embeddings=vectors.toPandas())
    assert got == want


@pytest.mark.parametrize("width, decay", [(64, 0.0), (256, 0.75), (256, 1.0)])
def test_visits_reach_neighbours_whatever_the_spectrum(width, decay):
    random = np.random.default_rng(14)
    scales = np.arange(1, width + 1) ** -decay
    bases = random.normal(size=(3_000, width)) * scales
    near = bases + random.normal(size=bases.shape) * scales * 0.3
    units = np.concatenate([bases, near])
    units /= np.linalg.norm(units, axis=1)[:, None]
    quantiser = embedding_dedup.Quantiser(units, 250_000)
    own, visits = quantiser.place(units)
    visited = np.zeros((len(units), len(quantiser.coarse)), dtype=bool)
    for i, lists in enumerate(visits):
        visited[i, lists] = True
    a, b = np.nonzero(units @ units.T >= 0.9)
    a, b = a[a != b], b[a != b]
    assert len(a) > 1_000 and visited[a, own[b]].mean() >= 0.97


def test_vectors_of_several_lengths(spark, monkeypatch):
    """A common length and one that is nearly as common go through a quantiser each, rarer ones are compared in place."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    random = np.random.default_rng(4)
    rows = []
    for width, count in ((6, 120), (9, 100), (2, 12), (3, 3), (1, 4), (40, 2)):
        centres = random.normal(size=(1 + count // 5, width))
        rows += [(centres[i % len(centres)] + random.normal(size=width) * 0.1).tolist() for i in range(count)]
    rows += [[], [0.0, 0.0], [1.0, None], None, [1.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    vectors = list(enumerate(rows))
    df = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = sorted(map(tuple, embedding_dedup.near_duplicate_vectors(df.repartition(5)).collect()))
    assert got == brute(vectors)
    linked = {len(rows[i]) for i, n, _, _ in got if n}
    assert linked >= {6, 9, 2, 1}


def test_embeddings_with_null_and_repeated_ids(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    rows = [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [2.0, 0.1]), (5, None)]
    got = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, 0, None, True), (2, 2, 1, False), (2, 2, 1, False), (1, 2, 1, True), (5, 0, 5, True)], key=repr
    )
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], schema)).collect() == []
    assert json.dumps(sorted(r.n_links for r in got)) == "[0, 0, 2, 2, 2]"
