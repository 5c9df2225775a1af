"""Null and repeated ids, odd texts, empty tables and further columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from layoutlake.llm import id_pack, line_runs, near_dup, quality, repeats

RNG = random.Random(3)
WORDS = ["".join(RNG.choices("klmnopqr", k=RNG.randint(2, 9))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


def near(text):
    words = text.split()
    words[len(words) // 2] = "another"
    return " ".join(words)


def classes(spark, rows):
    found = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)


def test_near_duplicates_of_rows_that_share_an_id(spark):
    one, two = prose(90), prose(90)
    rows = [(5, one), (5, two), (8, near(one)), (9, near(two)), (3, prose(50))]
    assert [(d, c) for d, _, c in classes(spark, rows)] == [(3, 3), (5, 5), (5, 5), (8, 5), (9, 5)]


def test_near_duplicates_without_ids(spark):
    one, two = prose(90), prose(90)
    rows = [(None, one), (7, near(one)), (None, two), (None, two), (None, near(two)), (None, None), (2, "")]
    got = [(d, c) for d, _, c in classes(spark, rows)]
    assert got.count((None, 7)) == 1 and got.count((7, 7)) == 1 and got.count((None, None)) == 4 and got.count((2, 2)) == 1


def test_one_row_of_each_class_stays(spark):
    one, two = prose(90), prose(90)
    rows = [(5, one, "a"), (5, one, "a"), (8, near(one), "b"), (None, two, "c"), (None, near(two), "d"), (None, None, "e"), (None, "", "f"), (1, "  ", "g"), (4, prose(2000), "h"), (None, two, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string").withColumn("near_key", F.lit(0)).withColumn("bands", F.lit("x"))
    out = near_dup.one_of_each(docs).collect()
    assert sorted(r.component for r in out if r.component not in "cdi") == ["a", "e", "f", "g", "h"]
    assert sum(r.component in "cdi" for r in out) == 1 and {r.bands for r in out} == {"x"}
    assert near_dup.one_of_each(docs.limit(0)).count() == 0


def test_lines_keep_clashing_columns(spark):
    line = prose(12)
    docs = spark.createDataFrame([(k, f"{line}\n{prose(8)}", f"x{k}", k) for k in range(6)], "doc_id long, text string, lost_lines string, its_doc long").withColumn("dropped", F.lit(True)).withColumn("n_lines", F.lit("own"))
    out = line_runs.apply(docs, line_runs.drops(docs), counts=False)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.lost_lines, r.its_doc, r.n_lines, len(r.text.split("\n"))) for r in out.collect()} == {(k, f"x{k}", k, "own", 1 + (k == 5)) for k in range(6)}


@pytest.mark.parametrize("name", ["score", "text_key", "row_id"])
def test_empty_tables(spark, name):
    none = spark.createDataFrame([], f"doc_id long, text string, {name} string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(none, quality.train(none, labels)).count() == 0
    assert near_dup.classes(none).count() == 0 and repeats.apply(none).count() == 0


def test_scores_of_odd_rows(spark):
    rows = [(1, prose(30)), (1, prose(40)), (None, prose(20)), (2, ""), (3, None), (4, prose(20_000)), (5, prose(30).upper()), (7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(k % 9, k % 2) for k in range(40)] + [(None, 1)], "doc_id long, quality int")
    out = quality.score(docs, quality.train(docs, labels), "found").collect()
    assert len(out) == len(rows) and all(0 <= r.found <= 1 and r.score == "own" for r in out)
    twice = quality.score(docs.unionByName(docs).repartition(3), quality.train(docs, labels), "found").collect()
    assert len({(r.text, r.found) for r in twice}) == len({r.text for r in out})


def test_packed_ids_of_repeated_and_null_ids(spark):
    import public_tokenizers as P

    rows = [(2, "two words"), (2, "two words"), (2, None), (None, "none"), (1, ""), (3, prose(30_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).repartition(3)
    out = sorted(id_pack.read_digests(id_pack.write_shards(df, P.path(id_pack.VOCABULARY_FILE), 3)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, 1, 2, 2, 2, 3] and out[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:], strict=False))
    none = df.limit(0)
    assert id_pack.read_digests(id_pack.write_shards(none, P.path(id_pack.VOCABULARY_FILE), 3)).count() == 0
