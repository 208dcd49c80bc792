import hashlib
import re

from helpers import COPY, agree, empty, odd, rows
from pyspark.sql import functions as F

from tandemtext.llm import exact_dedup, line_dedup


def test_exact_groups_of_odd_rows(spark):
    got = exact_dedup.exact_groups(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    groups = {}
    for r in odd(spark).collect():
        norm = re.sub("[ \t-\r]+", " ", r.text or "")
        groups.setdefault(norm, []).append(r.doc_id)
    want = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(norm.encode()).hexdigest()
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert rows(exact_dedup.exact_groups(odd(spark))) == sorted(want, key=repr)
    assert (None, 3, 4, False, hashlib.sha256(COPY.encode()).hexdigest()) in map(tuple, got)


def test_exact_hot_group_over_many_partitions(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text").repartition(40)
    got = exact_dedup.exact_groups(docs)
    assert got.filter("group_size = 1000 AND keep_id = 0").count() == 1000
    assert got.filter("kept").count() == 2001


def test_exact_empty(spark):
    assert exact_dedup.exact_groups(empty(spark)).collect() == []


def test_lines_of_odd_rows(spark):
    got = line_dedup.remove_repeated_lines(odd(spark))
    assert got.columns[: len(odd(spark).columns)] == odd(spark).columns
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    # The first three lines of 12 come again in 13, with a blank line between and spaces around.
    assert (by_id[12].text, by_id[12].n_removed) == ("a b\nc d\ne f\ng", 0)
    assert (by_id[13].text, by_id[13].n_removed) == ("x\n\ny", 3)
    assert by_id[6].text is None and by_id[6].n_lines == 0
    assert by_id[4].text == "" and by_id[14].n_removed == 0
    # Repeated rows hold the same places; neither is later.
    assert [r.n_removed for r in got.filter("doc_id = 3").collect()] == [0, 0]
    assert got.count() == odd(spark).count()


def test_lines_against_sql(spark):
    block = ["l1 a", "l2 b", "l3 c", "l4 d", "l5 e"]
    made = []
    for i in range(60):
        lines = [f"own {i} {j}" for j in range(i % 4)]
        lines[1:1] = block[i % 3 : i % 3 + 3 + i % 2] if i % 5 else []
        lines += ["again"] * (i % 7) + [""] * (i % 2) + block[: i % 6]
        made.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(made, "doc_id BIGINT, text STRING")
    got, want = agree(line_dedup.line_dedup_report(docs), line_dedup.ORACLE, documents=docs.toPandas())
    assert got == want
    assert sum(r[1] for r in got) > 100


def test_lines_empty(spark):
    assert line_dedup.remove_repeated_lines(empty(spark)).collect() == []


def test_lines_shared_by_a_third(spark):
    docs = spark.range(900).selectExpr(
        "id AS doc_id", "concat_ws('\\n', concat('h', id), IF(id % 3 = 0, 'p\\nq\\nr', concat('x', id)), concat('t', id)) AS text"
    )
    got = line_dedup.remove_repeated_lines(docs.repartition(20))
    assert got.filter("n_removed = 3").count() == 299


def test_text_only_variant_adds_nothing(spark):
    docs = odd(spark).withColumn("n_lines", F.lit(7)).withColumn("n_removed", F.lit("x"))
    cut = line_dedup.without_repeated_lines(docs)
    assert cut.columns == docs.columns and {(r.n_lines, r.n_removed) for r in cut.collect()} == {(7, "x")}
    assert {r.doc_id: r.text for r in cut.collect()}[13] == "x\n\ny"


def test_a_row_repeated_very_often(spark):
    text = "\n".join(f"line {i}" for i in range(40))
    docs = spark.range(3000).selectExpr("IF(id < 2900, 7, id) AS doc_id", f"'{text}' AS text")
    got = line_dedup.remove_repeated_lines(docs.repartition(10))
    assert {(r.doc_id == 7, r.n_removed): r["count"] for r in got.groupBy("doc_id", "n_removed").count().collect()} == {(True, 0): 2900, (False, 40): 1}
