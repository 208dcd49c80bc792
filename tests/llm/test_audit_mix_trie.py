"""Filter audit, mixing and the prefix trie against plain Python and SQL, on odd rows and hot keys."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from helpers import agree, empty, odd, rows

from tandemtext.llm import filter_audit, mixing, prefix_trie

WORDS = re.compile("[^ \t-\r]+")
LABELS = "doc_id BIGINT, quality INT, toxic INT, part STRING, mask INT"


# --- filter audit


def brute_audit(docs, labels):
    """All orders, one document after the other."""
    good = {i for i, q, t, *_ in labels if q == 1} - {None}
    toxic = {i for i, q, t, *_ in labels if t == 1} - {None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    judged = []
    for i, text, lang in docs:
        t = text or ""
        words = WORDS.findall(t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and first[t] < i,
        }
        judged.append((lang or "", {f for f, b in fails.items() if b}, i in good, i in toxic))
    out = []
    for part in {j[0] for j in judged}:
        here = [j for j in judged if j[0] == part]
        made, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                earlier = set(order[:k])
                gone = [j for j in here if f in j[1] and not j[1] & earlier]
                total[f] += len(gone)
                kept = sum(not j[1] & (earlier | {f}) for j in here)
                again = sum(f in j[1] and bool(j[1] & earlier) for j in here)
                only = sum(j[1] == {f} for j in here)
                made.append((part, "".join(order), k + 1, kept, len(gone), again, only, sum(j[2] for j in gone), sum(j[3] for j in gone)))
        out += [(*m, total[m[1][m[2] - 1]]) for m in made]
    return sorted(out, key=repr)


def labelled(spark):
    made = [(3, 1, 0), (5, 0, 1), (5, 1, 0), (9, None, 1), (None, 1, 1), (99, 1, 1), (14, 1, None), (11, 0, 0), (11, 0, 0)]
    return spark.createDataFrame([(*r, "x", 7) for r in made], LABELS)


def test_audit_of_odd_rows(spark):
    extra = [
        (20, "a$b " + " ".join(f"w{i}" for i in range(120)), "en", 1, "m", None, 0, "k"),
        (21, "CAPS " * 150, "en", 1, "m", None, 0, "k"),
        (22, "CAPS " * 150, "fr", 1, "m", None, 0, "k"),
        (1, "ONE", "fr", 1, "m", None, 0, "k"),
    ]
    docs = odd(spark).unionByName(spark.createDataFrame(extra, odd(spark).schema))
    labels = labelled(spark)
    want = brute_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = filter_audit.audit(docs, labels)
    assert rows(got) == want
    assert len(want) == 600 * 4 and sum(r[7] for r in want) > 0 and sum(r[8] for r in want) > 0


def test_audit_against_sql(spark):
    docs, labels = odd(spark), labelled(spark)
    got, want = agree(filter_audit.audit(docs, labels), filter_audit.ORACLE, documents=docs.toPandas(), labels=labels.toPandas())
    assert got == want


def test_audit_of_empty_tables(spark):
    assert filter_audit.audit(empty(spark), empty(spark, LABELS)).collect() == []
    assert filter_audit.audit(odd(spark), empty(spark, LABELS)).filter("good_lost + toxic_lost > 0").count() == 0


def test_hot_text_and_many_parts(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text", "concat('l', id % 7) AS lang")
    got = filter_audit.audit(docs.repartition(30), empty(spark, LABELS))
    assert got.count() == 7 * 600
    # 1000 equal texts, all but the first fail; every document has under 100 words.
    assert got.filter("filter_order LIKE 'E%' AND step = 1").agg({"removed": "sum"}).first()[0] == 999 * 24


def test_any_letters(spark):
    judged = spark.createDataFrame([("p", 0, 0, 0), ("p", 3, 1, 0), ("p", 2, 0, 1)], "part STRING, mask INT, good INT, toxic INT")
    got = {(r.filter_order, r.step): r for r in filter_audit.filter_interactions(judged, "XY").collect()}
    assert len(got) == 4 and (got["XY", 2].removed, got["XY", 2].redundant, got["XY", 2].shapley) == (1, 1, 3)
    with pytest.raises(ValueError):
        filter_audit.filter_interactions(judged, "ABCDEFGH")


# --- mixing

MIX = "doc_id BIGINT, text STRING, source STRING, _s INT, _mask STRING, target INT"


def mix_rows(seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "é", "Z", None, ""])
        made.append((i, "w " * int(rng.paretovariate(1.1) * 3), source))
    made += [(7, "same row here", "b")] * 3 + [(None, "no id", "a"), (None, None, None), (500, "", "only empty"), (501, "long " * 20_000, "c")]
    return made


def mixed(spark, made=None, **settings):
    docs = spark.createDataFrame([(*r, 1, "m", 5) for r in (mix_rows() if made is None else made)], MIX)
    return docs, mixing.mix_sources(docs, **settings)


@pytest.mark.parametrize("leaf, ranges", [(500, 4096), (3, 4)])
def test_mix_against_sql(spark, leaf, ranges):
    docs, got = mixed(spark, leaf=leaf, ranges=ranges)
    here, there = agree(got, mixing.ORACLE, documents=docs.toArrow())
    assert here == there and len(here) == 407


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Excess over the limit is shared again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(w[s] for s in order if s not in full)
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * w[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_words(spark):
    docs, got = mixed(spark)
    sizes, taken = {}, {}
    by_row = {}
    for r in docs.collect():
        n = len(WORDS.findall(r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        by_row.setdefault((r.doc_id, n), r.source)
    want = brute_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for r in got.collect():
        source = by_row[r.doc_id, r.size]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] = taken.get(source, 0) + r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(3, 0.02 * target) or source == "c", source


def test_mix_is_repeatable(spark):
    made = mix_rows(2)
    first, again = mixed(spark, made)[1], mixing.mix_sources(spark.createDataFrame([(*r, 1, "m", 5) for r in made[::-1]], MIX).repartition(13))
    assert rows(first) == rows(again)


def test_hot_source_and_repeated_rows(spark):
    # A third of all rows are one document, repeated: its rows can't be told apart, and some of them are taken.
    docs = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, -1, id) AS doc_id", "IF(id % 3 = 0, 'a b c', repeat('w ', 1 + CAST(id % 9 AS INT))) AS text", "IF(id % 5 < 4, 'hot', 'z') AS source"
    )
    got = mixing.mix_sources(docs.repartition(20), leaf=10, ranges=8).collect()
    hot = [r for r in got if r.source_size == max(x.source_size for x in got)]
    assert len(got) == 3000 and abs(sum(r.taken for r in hot) - hot[0].target) <= 1
    assert {r.taken for r in got if r.doc_id == -1} >= {0, 3}


def test_longer_documents_are_likelier(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', IF(id % 2 = 0, 1, 16)) AS text", "IF(id < 12000, 'a', 'b') AS source")
    share = {r.size: r.s for r in mixing.mix_sources(docs).filter("source_size > 90000").groupBy("size").agg({"taken": "avg"}).withColumnRenamed("avg(taken)", "s").collect()}
    assert share[16] / 16 > 1.5 * share[1] > 0
    even = mixing.mix_sources(docs, odds=lambda size, mean: size / size).filter("source_size > 90000")
    share = {r.size: r[1] for r in even.groupBy("size").agg({"taken": "avg"}).collect()}
    assert share[16] / 16 == pytest.approx(share[1], rel=0.1)


def test_mix_of_nothing(spark):
    assert mixed(spark, [])[1].collect() == []
    assert rows(mixed(spark, [(1, " ", "a"), (2, None, None)])[1]) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# --- prefix trie

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, prefix STRING, depth INT, _salt INT"


def brute_trie(turns):
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), role, text))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        # Remainders have the sign of the number, as in SQL.
        rest = abs(c) % 20 * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(c - rest, [])[:h] + ts[h:]
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for p, m in members.items():
        subtree = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in subtree if not any(len(r) == len(q) + 1 and r[:-1] == q for r in subtree)]
        saved = sum((len(members[q]) - 1) * len(WORDS.findall(q[-1][1])) for q in subtree if q)
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        children = sum(len(q) == len(p) + 1 for q in subtree)
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_turns(seed, convs=70):
    rng = random.Random(seed)
    made = []
    for c in rng.sample(range(-30, 130), convs):
        for turn in range(rng.randint(1, 6)):
            role, text = rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "a", "", None, "long " * 50])
            made.append((c, rng.choice([turn, turn, turn, None, 0]), role, text))
    made += [(40, 1, "user", "same"), (40, 1, "user", "same"), (None, 1, "user", "lost"), (None, None, None, None)]
    # A conversation of a single turn whose head is absent, and one that is long.
    return made + [(1001 + k, 0, "user", "x") for k in range(9)] + [(2000, k, "user", "w " * 30) for k in range(300)]


def trie(spark, made, **settings):
    return prefix_trie.prefix_trie(spark.createDataFrame([(*r, "p", 9, 1) for r in made], TURNS).repartition(7), **settings)


@pytest.mark.parametrize("seed, cells", [(1, {}), (2, {}), (3, {"least_cells": 64, "most_cells": 64})])
def test_trie_against_brute_force(spark, seed, cells):
    # A sketch of 64 counters is full of collisions: more is grouped, the result is the same.
    made = some_turns(seed)
    assert rows(trie(spark, made, **cells)) == brute_trie(made)


def test_trie_against_sql(spark):
    made = [t for t in some_turns(4) if t[0] is None or t[0] >= 0]
    docs = spark.createDataFrame(made, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    import pandas as pd

    frame = pd.DataFrame(made, columns=docs.columns).astype({"conv_id": "Int64", "turn": "Int64"})
    got, want = agree(prefix_trie.prefix_trie(docs), prefix_trie.ORACLE, conversations=frame)
    assert got == want


def test_one_conversation_repeated(spark):
    # All conversations of a group are alike, so every prefix has a third of all rows or more.
    made = [(c, k, "user", f"t{k}") for c in range(3000) for k in range(3)]
    got = rows(trie(spark, made))
    assert len(got) == 4 and {r[3] for r in got} == {3000}
    ends = hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [r[7] for r in got] == [nothing] * 3 + [ends]
    assert [r[6] for r in got] == [2999 * 3, 2999 * 3, 2999 * 2, 2999]


def test_trie_of_nothing_and_of_one(spark):
    assert trie(spark, []).collect() == []
    assert trie(spark, [(None, 1, "user", "x")]).collect() == []
    one = rows(trie(spark, [(20, 1, "user", "a b"), (20, 2, "user", "c")]))
    assert [r[:7] for r in one] == [(20, 0, None, 1, 1, 1, 0), (20, 1, 20, 1, 1, 1, 0), (20, 2, 20, 1, 0, 1, 0)]
    # Without turns of its head and with too few of its own, a conversation is a member of the root only.
    turnless = next(c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4)
    assert [r[:7] for r in rows(trie(spark, [(turnless, 1, "user", "a b")]))] == [(turnless, 0, None, 1, 0, 1, 0)]


def test_sketch_never_counts_too_little(spark):
    made = some_turns(5)
    paths = prefix_trie.rebuilt_paths(spark.createDataFrame(made, "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))
    flagged = prefix_trie.screened(paths, 1 << 16).groupBy("prefix").agg({"sole": "max", "conv_id": "count"}).collect()
    assert all(not r["max(sole)"] or r["count(conv_id)"] == 1 for r in flagged)
    assert sum(r["max(sole)"] for r in flagged) > 0.9 * sum(r["count(conv_id)"] == 1 for r in flagged)
