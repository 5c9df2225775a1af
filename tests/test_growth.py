"""Steps whose cost must follow the rows, not groups, copies of a plan or sizes of values."""

import unicodedata

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from layoutlake.functions import shapes, similarity
from layoutlake.operators import claims, kernels, membership
from layoutlake.plans.catalogue import QUERIES


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_leaders_stream_patterns(spark):
    """Patterns of one page never reach Python, the others come as one stream, whatever its batches."""
    rows = [("d", page, "generic_exact", pattern, 40.0, y) for pattern, places in {"a": [(1, 60.0), (2, 62.0), (3, 900.0), (4, 905.0)], "b": [(1, 60.0), (5, 60.0)], "c": [(1, 60.0), (1, 900.0)]}.items() for page, y in places]
    lines = spark.createDataFrame(rows, "document_id string, pdf_page long, family string, pattern string, x0 double, y0 double").select("*", (F.col("x0") + 240).alias("x1"), (F.col("y0") + 18).alias("y1"), F.lit(600.0).alias("page_width"), F.lit(1400.0).alias("page_height"))
    assert "FlatMapGroupsInPandas" not in plan(claims.leaders(lines))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = sorted((r.pattern, r.leader, r.pages, r.n_pages) for r in claims.leaders(lines).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == [("a", 0, 2, 5), ("a", 1, 2, 5), ("b", 0, 2, 5)]


@pytest.mark.parametrize("name", ["q84_header_zone_roles", "q85_body_seeds", "q86_eligibility"])
def test_classifier_reads_once(spark, name):
    """The classifier's steps never join their own rows, so the tables are read once."""
    assert plan(QUERIES[name](spark, "/root/testdata/sf0.001")).count("Relation [") == 1


@pytest.mark.parametrize("name", ["q70_article_records", "q71_document_report"])
def test_records_run_kernels_once(spark, name):
    """Regions go to Python once, and the table is read for lines, repeated lines and pages only."""
    found = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert found.count("FlatMapGroupsInPandas") == 1 and found.count("Relation [") <= 3


def test_kernels_take_no_frames():
    """Page kernels work on slices of a block; a page of a missing number is one page, an empty box takes no owner."""
    page = pd.DataFrame({"region_ord": [1, 0, 2], "kind": ["body"] * 3, "x0": [20.0, 20.0, None], "y0": [22.0, 0.0, 44.0], "x1": [220.0, 220.0, 220.0], "y1": [42.0, 20.0, 64.0], "article_id": [None, "a", None]})
    assert kernels._members({c: page[c].to_numpy() for c in page})["article_id"] == ["a", "a", None]
    rest = page.assign(page_height=800.0, zone=None, candidate=None, font=10.0, chars=250, seed=True)
    out = membership.spread(rest, membership.REFINEMENT).set_index("region_ord")
    assert out.article_id.tolist() == ["a", "a", None]
    titles = rest.assign(kind=["title", "body", "body"], x0=20.0)
    assert membership.barriers(titles)[2].tolist() == [False, True, False]


def test_dates_need_no_join(spark, tmp_path):
    """One aggregation over both tables: nothing to sort; repeated orders and pages without a date count as in SQL."""
    from layoutlake.plans.resolvers import SQL

    spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    rows = [(1, "2024-01-02"), (1, None), (2, "2024-01-02"), (2, "2023-01-02"), (4, "2024-01-02"), (None, "2024-01-02")]
    spark.createDataFrame(rows, "l_orderkey long, d string").selectExpr("l_orderkey", "timestamp(d) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = QUERIES["q62_unanimous_date"](spark, str(tmp_path))
    assert "Join" not in plan(out)
    duck = duckdb.connect()
    for t in ("orders", "lineitem"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(map(tuple, out.collect())) == sorted(duck.execute(SQL["q62_unanimous_date"]).fetchall()) == [(1, 2, 2024), (2, 4, None)]


def test_punctuation_finds_protected_spans_once(spark):
    """A lambda that reads an array finds it anew for each element, so spans are zipped with the pieces around them."""
    found = plan(spark.range(1).select(shapes.clean_punctuation(F.concat(F.lit("1.5 b"), "id"))))
    assert "zip_with" in found and "transform(" not in found


def test_few_texts_are_composed_in_python(spark):
    """Only texts with characters that composition may change go to Python, and all come out composed."""
    texts = ["plain ’ “ﬁne” è", "é", "Å", "ạ́", "각", "क़", "日本 да", "﻿a b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    want = [t and unicodedata.normalize("NFC", t.replace("ﬁ", "fi").replace(" ", " ").replace("﻿", "")) for t in texts]
    assert [r[0] for r in df.select(similarity.compose(F.col("t"))).collect()] == want
    assert [bool(r[0]) for r in df.select(F.col("t").rlike(similarity.unstable())).collect()] == [False, True, True, True, True, True, False, False, False]


def test_no_stable_character_is_missed(spark):
    """Every character that is other in composed form, or joins an ``a``, is one that goes to Python."""
    chars = [c for c in map(chr, range(1, 0x30000)) if not 0xD800 <= ord(c) < 0xE000 and (unicodedata.normalize("NFC", c) != c or unicodedata.normalize("NFC", "a" + c) != "a" + c)]
    assert spark.createDataFrame([(c,) for c in chars], "c string").filter(~F.col("c").rlike(similarity.unstable())).count() == 0


def test_shingles_are_made_once(spark):
    """No filter asks for shingles that a projection makes again."""
    found = plan(QUERIES["q112_absorbed_fragments"](spark, "/root/testdata/sf0.001"))
    assert found.count("regexp_extract_all(lower(coalesce(") <= 2 and not [line for line in found.split("\n") if "Filter" in line and "xxhash64" in line]
