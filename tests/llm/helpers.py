"""Frames with every odd case, and brute-force versions of the operators."""

import os

import duckdb

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, _salt INT, _mask STRING, _text STRING, node BIGINT, keep_id STRING"

COPY = "one two three four five six seven eight nine ten eleven twelve"


def odd_rows():
    """NULLs in every column, empty and long texts, ties, repeated rows."""
    rows = [
        (5, COPY, "en"),
        (3, COPY.replace(" ", "\n\t "), "en"),
        (3, COPY.replace(" ", "\n\t "), "en"),
        (9, COPY.upper(), None),
        (4, "", "en"),
        (6, None, "fr"),
        (7, "   ", None),
        (8, "one", "en"),
        (11, "ONE", "en"),
        (12, "\n".join(["a b", "c d", "e f", "g"]), "en"),
        (13, "\n".join(["x", "a b", "", "c d", " e f ", "y"]), "en"),
        (14, "word " * 30_000, "en"),
        (15, "12 34 @ .", "en"),
        (16, "x" * 20_000, "en"),
        (None, COPY, "en"),
        (None, None, None),
        (17, "Schöne ßtraße 日本 ▁ <|endoftext|> \x00 \u0085", "de"),
    ]
    return [(*r, 1, "m", None, 0, "k") for r in rows]


def odd(spark, schema=SCHEMA):
    return spark.createDataFrame(odd_rows(), schema)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def in_duckdb(sql, **tables):
    """Rows of ``sql`` over pandas frames."""
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def agree(df, sql, **tables):
    """Both sides' rows with columns by name."""
    names, want = in_duckdb(sql, **tables)
    columns = sorted(df.columns)
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr), sorted(
        (tuple(r[i] for i in order) for r in want), key=repr
    )


def least_reachable(ids, links):
    """Smallest id that each id reaches."""
    found = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            if found[a] != low or found[b] != low:
                found[a] = found[b] = low
                changed = True
    return found
