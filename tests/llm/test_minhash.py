import gc
import random
import weakref
from pathlib import Path

import pyarrow as pa
from helpers import COPY, agree, empty, least_reachable, odd

from tandemtext.llm import minhash_dedup, pii
from tandemtext.llm.arrow import kept_in_worker
from tandemtext.llm.components import connected_components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(pairs):
    sets = {i: shingles(t) for i, t in pairs}
    ids = sorted(sets)
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = least_reachable(ids, links)
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in ids)


def near_copies():
    random.seed(4)
    texts = []
    for base in range(12):
        words = [f"w{random.randrange(400)}" for _ in range(60 + 20 * base)]
        texts.append(words)
        for _ in range(8):  # chains: each copy changes the one before
            words = list(words)
            for _ in range(random.randrange(4)):
                words[random.randrange(len(words))] = f"c{random.randrange(10**6)}"
            texts.append(words)
    passage = [f"p{i}" for i in range(80)]  # shared by unlike texts
    texts += [passage + [f"o{i}_{j}" for j in range(30 + 3 * i)] for i in range(40)]
    random.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_links_and_components_against_brute_force(spark):
    pairs = near_copies()
    docs = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING").repartition(7)
    got = sorted(map(tuple, minhash_dedup.near_duplicates(docs).collect()))
    assert got == brute(pairs)
    assert 12 < sum(not r[3] for r in got) < 140


def test_links_the_first_bands_miss(spark, monkeypatch):
    """With one first band, most links come from the blocks of mixed buckets."""
    monkeypatch.setattr(minhash_dedup, "FIRST_BANDS", 1)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    pairs = near_copies()
    docs = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")
    assert sorted(map(tuple, minhash_dedup.near_duplicates(docs).collect())) == brute(pairs)


def test_pairs_of_a_hub_are_checked_in_many_places(spark, monkeypatch):
    """A text in most pairs, texts of one word, a repeated id with two texts, and an id without a text."""
    monkeypatch.setattr(minhash_dedup, "PAIRS_PER_PLACE", 3)
    monkeypatch.setattr(minhash_dedup, "MOST_PLACES", 20)
    words = [f"w{i}" for i in range(60)]
    texts = [(0, " ".join(words))] + [(i, " ".join(words[: 30 + i % 30] + [f"x{i}"] * (i % 4))) for i in range(1, 200)]
    texts += [(300, "one"), (301, "one"), (302, "two"), (0, "one")]
    pairs = [(0, i) for i in range(1, 200)] + [(5, 6), (6, 7), (300, 301), (300, 302), (0, 300), (0, 999), (999, 1)]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = minhash_dedup.confirmed(spark.createDataFrame(pairs, "u BIGINT, v BIGINT"), docs).collect()
    sets = {}
    for i, t in texts:
        sets.setdefault(i, []).append(shingles(t))
    want = [(u, v) for u, v in pairs if any(100 * len(a & b) >= 75 * len(a | b) for a in sets.get(u, []) for b in sets.get(v, []))]
    assert sorted(map(tuple, got)) == sorted(want) and 40 < len(want) < 200


def test_blocks_of_a_key_bring_all_components_together(spark, monkeypatch):
    """Every two members of different components meet, unless the key has one component; the largest isn't dealt to itself."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    rows = [(1, i, 0) for i in range(40)] + [(1, 100 + i, 100 + i % 5) for i in range(15)] + [(2, 200 + i, 200) for i in range(9)] + [(3, 300, 300), (3, 301, 301)]
    df = spark.createDataFrame([(*r, b"") for r in rows], "key BIGINT, node BIGINT, component BIGINT, signature BINARY")
    groups = {}
    for r in minhash_dedup.in_blocks(df, "key").collect():
        groups.setdefault((r.key, r.a, r.b), []).append((r.first, r.node, r.component))
    met = [
        frozenset((x[1], y[1]))
        for (_, a, b), group in groups.items()
        for i, x in enumerate(sorted(group, key=lambda g: g[1]))
        for y in (sorted(group, key=lambda g: g[1])[i + 1 :] if a == b else [g for g in group if not g[0]])
        if x[0] and x[2] != y[2]
    ]
    want = {frozenset((m, n)) for j, m, c in rows for k, n, d in rows if j == k and c != d}
    assert len(met) == len(set(met)) and set(met) == want
    assert not any(len({c for _, _, c in group}) == 1 and group[0][2] == 0 for group in groups.values())


def test_against_sql(spark):
    docs = spark.createDataFrame(near_copies()[:80], "doc_id BIGINT, text STRING")
    got, want = agree(minhash_dedup.near_duplicates(docs), minhash_dedup.ORACLE, documents=docs.toPandas())
    assert got == want


def test_odd_rows(spark):
    got = minhash_dedup.near_duplicates(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    # White space and ASCII case don't count; the repeated row has one component with the others.
    assert {by_id[i].component_id for i in (3, 5, 9)} == {3}
    assert [r.kept for r in got if r.doc_id == 3] == [True, True]
    assert (by_id[8].n_shingles, by_id[11].component_id, by_id[11].kept) == (1, 8, False)
    for i in (4, 6, 7):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert by_id[14].n_shingles == 1 and len(COPY.split()) - 4 == by_id[5].n_shingles


def test_empty(spark):
    assert minhash_dedup.near_duplicates(empty(spark)).collect() == []


def test_components_of_paths_stars_and_null_ends(spark):
    random.seed(8)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(300)]
    links += [(random.randrange(2000, 2600), random.randrange(2000, 2600)) for _ in range(350)] + [(7, 7), (9000, 9000)]
    df = spark.createDataFrame([*links, *links[:50], (None, 4), (4, None)], "u BIGINT, v BIGINT")
    ids = {i for a, b in links for i in (a, b) if a != b}
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == least_reachable(ids, [x for x in links if x[0] != x[1]])


def test_rounds_of_few_edges_have_few_files(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "u BIGINT, v BIGINT")
    changed = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        found = connected_components(df)
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(301)}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "u BIGINT, v BIGINT")).collect() == []


def test_what_earlier_operators_kept_in_a_worker_goes():
    class Kept:
        def __init__(self):
            self.step = self.run  # refers to itself, as caches with a bound method do

        def run(self):
            return 1

    gc.disable()
    try:
        # By the next operator that keeps something, and by those that keep nothing.
        for drop in (
            lambda: kept_in_worker("next", lambda: 0),
            lambda: list(minhash_dedup._by_group(iter([]), 3, list)),
            lambda: list(pii._parts(iter([]))),
        ):
            kept = weakref.ref(kept_in_worker("one", Kept))
            assert kept_in_worker("one", Kept) is kept()
            drop()
            assert kept() is None
    finally:
        gc.enable()


def resident() -> float:
    """MB of this process."""
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


def hundred_megabytes(pins: list) -> list:
    held = []
    for i in range(100_000):
        held.append(bytes(1000))
        if i % 100 == 0:
            pins.append(bytes(1000))  # what lives on among it, as in any worker
    return held


def test_what_operators_drop_goes_back_to_the_system():
    pins = []
    kept_in_worker("one", lambda: hundred_megabytes(pins))
    most = resident()
    list(minhash_dedup._by_group(iter([]), 3, list))
    assert resident() < most - 70


def test_what_a_task_used_goes_back_to_the_system():
    pins, most = [], []

    def batches():
        held = hundred_megabytes(pins)
        most.append(resident())
        yield pa.record_batch({"_key": pa.array(range(len(held))), "text": pa.array(["x"] * len(held))})

    assert sum(len(part) for part in pii._parts(batches())) == 100_000
    assert resident() < most[0] - 20
