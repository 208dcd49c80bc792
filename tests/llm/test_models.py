"""Trained operators: held-out accuracy, brute-force scores, exact rules."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from helpers import FOLDER, empty, odd
from pyspark.sql import functions as F

from tandemtext.llm import common, language_id, lm_score, pii, queries, url_filter
from tandemtext.llm.bilstm_crf import Tagger


def fold(i, by):
    return zlib.crc32(("" if i is None else str(i)).encode()) % by


# --- language


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language_id.held_out_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if fold(r.doc_id, 5) == 0}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) > 0
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(spark):
    got = language_id.held_out_predictions(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    for r in got:
        if r.doc_id in (4, 6, 7, 15):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got} <= {"und", "en", "fr", "de"}
    assert language_id.held_out_predictions(empty(spark)).collect() == []


def test_language_never_learns_from_the_held_out_fold(spark):
    held = next(i for i in range(100) if fold(i, 5) == 0)
    rest = [i for i in range(100) if fold(i, 5)][:20]
    docs = spark.createDataFrame([(held, "zzz qqq", "xx")] + [(i, "alpha beta", "en") for i in rest], "doc_id BIGINT, text STRING, lang STRING")
    assert {r.lang_pred for r in language_id.held_out_predictions(docs).collect()} == {"en"}


def test_unseen_words_fall_back_to_shorter_grams():
    model = language_id.Model([("a", "kokoko", 5), ("b", "titati", 5)])
    predict = language_id.Predictor(model)
    assert predict("kokok kok")[0] == "a" and predict("tita TAT")[0] == "b"
    # Nothing known at any length, and a tie: the first language.
    assert predict("xyz") == ("a", 0.5)


def test_only_rows_of_a_language_stay(spark):
    docs = odd(spark)
    kept = language_id.keep_identified(docs, language_id.train(docs))
    assert kept.columns == docs.columns
    # Four have no letter to judge; NULL ids and repeated rows are kept like others.
    assert kept.count() == docs.filter("text RLIKE '[A-Za-z]'").count()


def test_a_rare_language_keeps_its_words(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 200)
    random.seed(15)
    common_words = ["".join(random.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(60_000)]
    rare_words = ["".join(random.choice("hijklmnopqrstu") for _ in range(6)) for _ in range(400)]
    rows = [(i, " ".join(random.choices(common_words, k=500)), "en") for i in range(2_000)]
    rows += [(2_000 + i, " ".join(rare_words[40 * i : 40 * i + 40]), "rr") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").repartition(4)
    model = language_id.train(docs)
    assert model.languages == ["en", "rr"]
    predict = language_id.Predictor(model)
    texts = [" ".join(random.sample(rare_words, 5)) for _ in range(50)]
    assert [predict(t)[0] for t in texts] == ["rr"] * 50
    assert all(model.tables[0].mean([w]) is not None for w in rare_words)


def test_texts_of_unknown_letters_go(spark):
    model = language_id.Model([("a", "kokoko", 5), ("b", "titati", 5)])
    rows = [(1, "Привет, мир"), (2, "kokoko"), (3, "привет tat"), (4, "日本"), (5, "xyz"), (6, "k xyz"), (7, "12"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert {r.doc_id for r in language_id.keep_identified(docs, model).collect()} == {2, 3, 6}


def test_texts_without_any_label_stay(spark):
    docs = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = language_id.keep_identified(docs, language_id.train(docs))
    assert kept.count() == docs.filter("text RLIKE '[A-Za-z]'").count() > 0


def test_no_sample_of_a_large_table_is_empty(spark):
    # A table of 2e12 rows: 5,000 of them are a share of 2.5e-9.
    spread = F.xxhash64("id")
    hashes = spark.createDataFrame([(5,), (-(1 << 63) + 5,), (1 << 61,), (-1,)], "h BIGINT")
    assert [r.h for r in hashes.filter(common.sampled(F.col("h"), 2.5e-9)).collect()] == [5, -(1 << 63) + 5]
    assert spark.range(100_000).filter(common.sampled(spread, 1e-3)).count() in range(60, 140)
    assert hashes.filter(common.sampled(F.col("h"), 1.0)).count() == 4


def brute_languages(rows):
    """(language, score) of every text, with plain dictionaries and 64-bit numbers."""
    words_of = lambda t: language_id.LETTERS.findall(t.lower())
    held = {}
    for i, text, lang in rows:
        if fold(i, 5) and text is not None and lang is not None and words_of(text):
            held.setdefault(lang, collections.Counter()).update(words_of(text))
    langs = sorted(held)

    def grams(word, order):
        padded = f" {word} "
        return list(word) if order == 1 else [padded[k : k + order] for k in range(len(padded) - order + 1)]

    def table(counts):
        keys, small = set().union(*counts.values()), language_id.SMOOTHING
        base = {lang: math.log(small / (sum(c.values()) + small * len(keys))) for lang, c in counts.items()}
        return {k: np.array([base[x] + math.log(counts[x][k] / small + 1) for x in langs]) for k in keys}

    tables = [table(held)]
    for order in language_id.ORDERS:
        found = {lang: collections.Counter() for lang in langs}
        for lang, counts in held.items():
            for word, n in counts.items():
                for gram in grams(word, order):
                    found[lang][gram] += n
        tables.append(table(found))

    def row(word):
        if word in tables[0]:
            return tables[0][word]
        for order, known in zip(language_id.ORDERS, tables[1:]):
            rows = [known[g] for g in grams(word, order) if g in known]
            if rows:
                return np.mean(rows, axis=0)
        return np.zeros(len(langs))

    out = {}
    for i, text, _ in rows:
        words = words_of(text or "")
        total = sum((row(w) for w in words), np.zeros(len(langs)))
        best = int(np.argmax(total))
        out[i] = (langs[best], 1 / np.exp(total - total[best]).sum()) if words else ("und", 0.0)
    return out


def test_languages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(10**6, "zzyzx qqq ñandú", "es"), (10**6 + 1, "123 !", "en"), (10**6 + 2, None, "de"), (10**6 + 3, "Straße über größe", None), (10**6 + 4, "漢字", "fr")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    want = brute_languages([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r for r in language_id.held_out_predictions(docs).collect()}
    assert set(got) == set(want)
    for i, (lang, score) in want.items():
        assert (got[i].lang_pred, got[i].held_out) == (lang, fold(i, 5) == 0)
        assert got[i].score == pytest.approx(score, abs=2e-3)


# --- URLs


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [
        (r, v)
        for v, r in url_filter.RULES
        for name, _, tail in [r.partition("/")]
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail)
    ]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, verdict


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y=/de/#z", "http://example.net", "http://example.net/",
    "http://notexample.net/en/", "http://a.example.com/de/", "http://example.com/de", "http://x.org/fr/1", "http://org/fr/",
    "http://xorg/fr/", "http://a://b.net/c", "http://É.net/É", "ftp://u:p@h.net:80/p;q?r", "http://h?x/y", "http://h#x/y",
    "http://example.net/en/é" + "a" * 5000, "http://net/en/", "://net/",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, 1, "r") for i, u in enumerate(URLS)] + [(None, URLS[4], 2, "r"), (3, URLS[3], 1, "r")], "page_id BIGINT, url STRING, score INT, rule STRING")
    got = url_filter.judge_urls(pages, queries.labelled_urls(pages)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = brute_url(URLS[4 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert queries.QUERIES["op2_url_filter"] and url_filter.judge_urls(pages.limit(0), queries.labelled_urls(pages.limit(0))).collect() == []


def test_trees_on_held_out_urls(spark):
    random.seed(6)
    hosts = [f"{'www.' * (i % 2)}{random.choice(['casino-win', 'free-bets', 'news', 'shop', 'garden'])}{i % 7 or ''}.example.{['com', 'org'][i % 2]}" for i in range(1200)]
    pages = spark.createDataFrame([(i, f"https://{h}/{'en' * (i % 3)}/{i}") for i, h in enumerate(hosts)], "page_id BIGINT, url STRING")
    labelled = queries.labelled_urls(pages)
    held = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    judged = url_filter.judge_urls(pages.filter(held), labelled.filter(~held), rules=())
    got = judged.join(pages.filter(held).select("page_id", "url"), "page_id").collect()
    right = [(r.verdict == "block") == any(w in r.host for w in queries.BAD_WORDS) for r in got]
    assert sum(right) >= 0.95 * len(right) > 0
    assert any(r.verdict == "block" for r in got)


def brute_features(url, stats, rate):
    host, path, _, _ = brute_url(url)
    url = url or ""
    query = re.search(r"\?([^#]*)", url)
    labels = host.split(".")
    share = [n / len(url) for n in collections.Counter(url).values()]
    bad, count = stats.get(labels[-1], (None, None))
    return {
        "length": len(url),
        "depth": sum(x != "" for x in path.split("/")),
        "digit_ratio": sum(c in "0123456789" for c in url) / len(url) if url else 0.0,
        "entropy": -sum(p * math.log2(p) for p in share),
        "parameters": sum(x != "" for x in (query.group(1) if query else "").split("&")),
        "host_length": len(host),
        "host_labels": len(labels),
        "host_hyphens": host.count("-"),
        "longest_label": max(map(len, labels)),
        "suffix_rate": rate if bad is None else (bad + url_filter.PRIOR * rate) / (count + url_filter.PRIOR),
        "suffix_weight": 0.0 if bad is None else math.log1p(count),
    }


def test_features_and_suffix_statistics_against_brute_force(spark):
    made = [u for u in URLS if u and "://" in u] + ["http://a-b.c-d.zz/x?a=1&&b=2&c#f", "http://q.zz", "http://r.yy/1/2//3"]
    labelled = [(u, i % 3 % 2 if i % 4 else None) for i, u in enumerate(made)]
    model = url_filter.UrlModel(spark.createDataFrame(labelled, "url STRING, bad INT"))
    known = [(u, b) for u, b in labelled if b is not None]
    rate = sum(b for _, b in known) / len(known)
    stats = {}
    for u, b in known:
        bad, count = stats.get(suffix := brute_url(u)[0].split(".")[-1], (0, 0))
        stats[suffix] = (bad + b, count + 1)
    rows = url_filter.lexical(url_filter._parsed(spark.createDataFrame([(u,) for u in URLS + made], "url STRING"), "url", F.col("url")))
    got = model._vectors(rows.join(model.suffixes, "_suffix", "left")).collect()
    assert len(got) == len(URLS + made) and model.rate == pytest.approx(rate)
    for r in got:
        want = brute_features(r.url, stats, rate)
        assert {n: r[n] for n in url_filter.FEATURES} == pytest.approx(want), r.url
        assert r._features.toArray().tolist() == pytest.approx([want[n] for n in url_filter.FEATURES])


def test_labels_of_unknown_kinds_teach_nothing(spark):
    urls = ["http://a.example.com/", "http://my-site.example.com/", "http://casino-win.x/", "http://x1.org/", "http:none"]
    got = queries.labelled_urls(spark.createDataFrame([(u,) for u in urls], "url STRING"))
    assert [r.bad for r in got.collect()] == [0, None, 1, 0, None]


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(x):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), m.end(), 0) for m in EMAIL.finditer(x)]
    found += [(m.start(), m.end(), 1) for m in IP.finditer(x) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), m.end(), 2) for m in CARD.finditer(x) if 12 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    found += [(m.start(), m.end(), 3) for m in PHONE.finditer(x) if 9 <= len(digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_native_rules_choose_documents_with_spans(spark):
    random.seed(16)
    parts = ["a", "@", ".", "-", " ", "+1 ", "(", "12", "255.", "256.", "4", "0", "x@y.z", "1.2.3.4", "+49 30 1234567", "4111 1111-1111 1111", "4111 1111-1111 1112"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 7))) for _ in range(5_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i BIGINT, text STRING")
    chosen = {r.i for r in df.filter(pii.has_spans(F.col("text"))).collect()}
    exact = {i for i, t in enumerate(texts) if pii.base_spans(t)}
    assert exact <= chosen and len(chosen - exact) < 0.05 * len(texts)


def test_the_tagger_learns_where_spans_are_rare(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 30)
    monkeypatch.setattr(pii, "OTHER_DOCS", 20, raising=False)
    monkeypatch.setattr(pii, "MOST_WINDOWS", 80)
    seen = []
    monkeypatch.setattr(Tagger, "train", lambda self, symbols, labels, rounds: seen.append(labels))
    rows = [(i, f"Page {i} of chapter {i % 7}, printed in 19{i % 90 + 10}") for i in range(8_000)]
    rows += [(9_000 + i, f"Write to name{i}@mail.example.org at once, please") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert pii.train_tagger(docs) is not None
    assert seen[0].any(axis=1).sum() == 20 and len(seen[0]) < 80


def test_rules_on_random_texts():
    random.seed(2)
    parts = ["a", "b1", "@", ".", "-", " ", "+1 ", "(", "12", "255.", "4", "0", "é", "%", "x@y.z", "1.2.3.4", "4111 1111-1111 1111"]
    for _ in range(20_000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 25)))
        assert pii.base_spans(text) == brute_base(text)
    pii.base_spans("a" * 200_000 + "@b" + " 1" * 100_000 + "1" * 200_000 + ".1" * 50_000 + "+1" * 50_000)


def test_tagger_gradients():
    tagger = Tagger(7, 3, np.ones((3, 3), bool), np.ones(3, bool), hidden=3)
    random = np.random.default_rng(0)
    ids, labels = random.integers(0, 7, (4, 6)), random.integers(0, 3, (4, 6))
    _, grown = tagger.gradients(ids, labels)
    for name, value in tagger.p.items():
        at = tuple(random.integers(0, s) for s in value.shape)
        value[at] += 1e-5
        up = tagger.gradients(ids, labels)[0]
        value[at] -= 2e-5
        down = tagger.gradients(ids, labels)[0]
        value[at] += 1e-5
        assert grown[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_best_path_against_all_paths():
    tagger = Tagger(5, 3, np.array([[1, 1, 0], [1, 1, 1], [1, 1, 1]], bool), np.array([1, 1, 0], bool), hidden=2)
    tagger.p["move"] = np.random.default_rng(1).normal(0, 1, (3, 3))
    ids = np.random.default_rng(2).integers(0, 5, (6, 4))
    scores = tagger.emissions(ids)[0]
    move, begin = tagger.p["move"] + tagger.blocked, tagger.p["begin"] + tagger.blocked_first
    paths = np.stack(np.meshgrid(*[range(3)] * 4, indexing="ij"), -1).reshape(-1, 4)
    for row, got in enumerate(tagger.decode(ids)):
        value = [begin[p[0]] + sum(scores[t, row, p[t]] for t in range(4)) + sum(move[p[t - 1], p[t]] for t in range(1, 4)) for p in paths]
        assert (paths[int(np.argmax(value))] == got).all()


def test_overlapping_windows_have_one_best_path():
    """Scores of both windows, weighted by the place in each, and all paths of each stretch tried."""
    allowed = np.array([[1, 1, 0], [1, 1, 1], [1, 1, 1]], bool)
    tagger = Tagger(5, 3, allowed, np.array([1, 1, 0], bool), hidden=2)
    rng = np.random.default_rng(4)
    tagger.p["move"] = rng.normal(0, 1, (3, 3))
    tagger.p["out"] *= 4
    move, begin = tagger.p["move"] + tagger.blocked, tagger.p["begin"] + tagger.blocked_first
    stretches = [2, 1, 3, 1]
    ids = rng.integers(0, 5, (sum(stretches), 4))
    scores = tagger.emissions(ids)[0].transpose(1, 0, 2)
    want, window = [], 0
    for size in stretches:
        total, weight = np.zeros((2 * size + 2, 3)), np.zeros((2 * size + 2, 1))
        for k in range(size):
            share = np.array([0.25, 0.75, 0.75, 0.25])[:, None]
            total[2 * k : 2 * k + 4] += share * scores[window + k]
            weight[2 * k : 2 * k + 4] += share
        mean = total / weight
        window += size
        paths = np.stack(np.meshgrid(*[range(3)] * len(mean), indexing="ij"), -1).reshape(-1, len(mean))
        value = begin[paths[:, 0]] + mean[range(len(mean)), paths].sum(1) + move[paths[:, :-1], paths[:, 1:]].sum(1)
        want.append(paths[value.argmax()])
    follows = np.concatenate([np.arange(size) > 0 for size in stretches])
    for batch in (1, 3, 100):
        got = tagger.decode_overlapping(ids, follows, batch)
        assert got.ravel().tolist() == np.concatenate(want).tolist()
    assert allowed[got.ravel()[:-1], got.ravel()[1:]][[i for i in range(got.size - 1) if i not in (5, 9, 17)]].all()


def test_labels_of_half_windows_become_spans():
    numbers = np.array([1, 2, 5])  # two stretches: halves 1 to 3, and 5 and 6
    labels = np.zeros((5, pii.STRIDE), np.uint8)
    labels[0, -2:], labels[1], labels[2, 0] = (1, 2), 2, 2  # an email over three halves
    labels[3, 0], labels[3, 1], labels[4, -1] = 5, 7, 3  # a card, a phone, and an address past the end of the text
    got = pii._tagged(labels, numbers, 6 * pii.STRIDE - 1)
    assert got == [(30, 65, 0), (128, 129, 2), (129, 130, 3)]


def personal_texts(count):
    random.seed(3)
    words = "the of and to in was for that with this from they have which were".split()
    made = []
    for i in range(count):
        a, b, c = random.randrange(200, 999), random.randrange(200, 999), random.randrange(1000, 9999)
        piece = [f"u{a}.{b}@mail{i % 9}.example.com", f"+1 ({a}) {b}-{c}", f"{a % 256}.{b % 256}.{c % 256}.7", f"item {c}", ""][i % 5]
        half = [" ".join(random.choice(words) for _ in range(12)) for _ in range(2)]
        made.append((i, f"{half[0]} {piece} {half[1]}."))
    return made


def test_tagger_adds_spellings_and_leaves_clean_texts_alone(spark):
    docs = spark.createDataFrame(personal_texts(1500), "doc_id BIGINT, text STRING")
    tagger = pii.train_tagger(docs)
    texts = ["please call (415) 555-2671 today about this", "they have 415-555-2671 in the list for that"]
    assert sum(bool(spans) for _, spans in pii.all_spans(texts, tagger)) >= 1
    clean = ["in 2021 there were 1234567 items and 3.14159 more", "version 1.2.3 at 12:30:45 on 2020-01-02", "a @ b, 4994226020900892"]
    assert [spans for _, spans in pii.all_spans(clean, tagger)] == [[], [], []]
    long = "x" * 70 + " " + texts[0] + " y" * 5000 + " u1@v.example.com"
    base, spans = pii.all_spans([long], tagger)[0]
    assert set(base) <= set(spans) and long[base[-1][0] :] == "u1@v.example.com"


def test_spans_are_found_wherever_windows_begin(spark):
    docs = spark.createDataFrame(personal_texts(1500), "doc_id BIGINT, text STRING")
    tagger = pii.train_tagger(docs)
    number = "(415) 555-2671"
    texts = ["of the to " * 12 + "in " * (k // 3) + "x" * (k % 3) + f" they {number} in the" for k in range(2 * pii.STRIDE)]
    found = [t[a:b].lstrip("(") for t, (_, spans) in zip(texts, pii.all_spans(texts, tagger)) for a, b, _ in spans]
    assert found == [number.lstrip("(")] * len(texts)
    # In one batch or alone, and however long the rest of the text is.
    assert [pii.all_spans([t], tagger)[0] for t in texts[::9]] == pii.all_spans(texts, tagger)[::9]
    began = time.perf_counter()
    assert pii.all_spans(["12 ab 34-5 " * 40_000], tagger)[0][0] == []
    assert time.perf_counter() - began < 60


def test_personal_data_of_odd_rows(spark):
    docs = odd(spark)
    got = pii.find_personal_data(docs, pii.train_tagger(docs)).collect()
    assert len(got) == docs.count()
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) == (0, 0, 0, 0, nothing, "") for r in got)
    clean = pii.redact_personal_data(docs, None)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    assert pii.train_tagger(empty(spark)) is None
    assert pii.find_personal_data(empty(spark), None).collect() == []


def test_redaction_merges_overlaps():
    assert pii.redacted("a 1.2.3.4 b", [(2, 9, 1)]) == "a <IP> b"
    assert pii.redacted("abcdef", [(1, 4, 0), (2, 5, 3)]) == "a<EMAIL>f"


# --- language model


def brute_scores(rows, order):
    tokens = {i: (t or "").encode().lower().split() + [b" "] for i, t in rows}
    counts = [collections.Counter() for _ in range(order)]
    for i, w in tokens.items():
        if fold(i, 7) != 2:
            for n in range(order):
                counts[n].update(tuple(w[k : k + n + 1]) for k in range(len(w) - n))
    total, distinct = sum(counts[0].values()), len(counts[0])

    def p(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 1) / (total + distinct + 1)
        return (counts[len(gram) - 1][gram] + lm_score.MASS * p(gram[1:])) / (counts[len(gram) - 2][gram[:-1]] + lm_score.MASS)

    return {
        i: (
            fold(i, 7) == 2,
            len(w),
            sum(counts[0][(x,)] > 0 for x in w),
            total,
            sum(math.log10(p((x,))) for x in w),
            sum(math.log10(p(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(len(w))),
        )
        for i, w in tokens.items()
    }


@pytest.mark.parametrize("order, block", [(1, 10**6), (2, 12_000_000), (2, 50_000), (3, 90_000), (4, 400_000)])
def test_scores_against_brute_force(spark, order, block):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 3000 OR text IS NULL")
    want = brute_scores([(r.doc_id, r.text) for r in docs.collect()], order)
    got = lm_score.score_texts(docs, order, block).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-12) and r.score == pytest.approx(w[5], rel=1e-12)


@pytest.mark.parametrize("order, piece", [(1, 1), (2, 1), (2, 3), (3, 2), (4, 3), (4, 256)])
def test_pieces_of_a_text_carry_its_state(monkeypatch, order, piece):
    """A text that is walked in pieces has the scores of one walk, whatever the pieces' length from a state's on."""
    monkeypatch.setattr(lm_score, "PIECE", piece)
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("a b c d") for _ in range(rng.choice([0, 1, 2, 5, 40])))) for i in range(60)]
    block = lm_score.Block([t.encode() for _, t in rows], np.array([fold(i, 7) != 2 for i, _ in rows]), order)
    learned, distinct = int(block.counts[0].sum()), int((block.counts[0] > 0).sum())
    walked = lm_score.Automaton(block, block.counts, learned, distinct).walk()
    want = brute_scores(rows, order)
    for i, begin, size in zip(range(60), block.starts, block.lengths):
        assert walked[begin : begin + size].sum() == pytest.approx(want[i][5], rel=1e-12)


def test_a_repeated_row_is_dealt_to_many_blocks(spark):
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "IF(id % 3 = 0, NULL, concat('w', id)) AS text").repartition(6)
    got = lm_score.score_texts(docs, block_chars=1000)
    blocks = docs.groupBy(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(10))).count().collect()
    assert max(r["count"] for r in blocks) < 400
    assert got.count() == 3000 and got.filter("doc_id IS NULL").select("score").distinct().count() == 1


def test_the_model_beats_single_words_and_sums_to_one(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('a b c ', IF(id % 2 = 0, 'd e', 'e d')) AS text")
    held = [r for r in lm_score.score_texts(docs).collect() if r.held_out]
    assert held and all(r.score > r.base_score for r in held)
    counts = [np.array([6, 3, 2]), np.array([4, 2])]  # words x y z; after x: y 4 times, z twice
    mass = lm_score.MASS
    p1 = (counts[0] + 1) / (11 + 3 + 1)
    after = [(c + mass * p) / (6 + mass) for c, p in zip([0, 4, 2], p1)] + [mass / (6 + mass) / 15]
    assert sum(after) == pytest.approx(1)


def test_scores_of_odd_rows(spark):
    got = lm_score.score_texts(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].n_tokens for i in (4, 6, 7, 8, 14)] == [1, 1, 1, 2, 30_001]
    assert len({r.train_tokens for r in got}) == 1 and all(math.isfinite(r.score) for r in got)
    assert lm_score.score_texts(empty(spark)).collect() == []


def test_added_spans_of_many_tagged_and_base_spans():
    """As comparing each with each, and in time that follows the length of the text."""
    rng = random.Random(8)
    text = "".join(rng.choice(["555-123-4567 ", "1.2.3.4 ", "a@b.cd ", "word ", "4111 1111 1111 1111 "]) for _ in range(300))
    base = pii.base_spans(text)
    tagged = sorted({(m.start(), m.end(), 3) for m in re.finditer("[0-9-]{12}", text)} | {(a, b - 1, 2) for a, b, _ in base[::3]})
    plain = [(a, b, k) for a, b, k in pii.added_spans(text, tagged, []) if not any(x < b and a < y for x, y, _ in base)]
    assert pii.added_spans(text, tagged, base) == plain and len(plain) > 30
    many = "555-123-4567 1.2.3.4 " * 50_000
    base = pii.base_spans(many)
    began = time.perf_counter()
    assert len(pii.added_spans(many, [(21 * i, 21 * i + 12, 3) for i in range(50_000)], base)) == 50_000
    assert time.perf_counter() - began < 20
