"""Queries do the whole job: no region, line or block is left out."""

from pathlib import Path

import duckdb
import pytest

from layoutlake.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


def documents(spark, folder, *texts):
    spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)], "doc_id long, source string, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def agrees(spark, name, sql):
    """The query's rows at sf0.001 are those of ``sql``."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    plain = lambda rows: sorted([str(float(v)) if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio") else str(v) for v in r] for r in rows)
    return plain(QUERIES[name](spark, SF).select(*columns).collect()) == plain(cur.fetchall())


def test_geometry_pairs_has_regions_beyond_the_fortieth(spark, tmp_path):
    sf = documents(spark, tmp_path, "\n".join(f"line {k}" for k in range(101)))
    rows = QUERIES["q09_geometry_pairs"](spark, sf).collect()
    # two columns of 51 and 50 lines, 6 points apart: each line pairs with the next only
    assert [(r.n_pairs, r.sum_overlap, r.largest_gap) for r in rows] == [(99, 99.0, 6.0)]


@tables
def test_geometry_pairs_by_sql(spark):
    assert agrees(spark, "q09_geometry_pairs", SQL["q09_geometry_pairs"])


def test_image_coverage_has_all_regions(spark, tmp_path):
    sf = documents(spark, tmp_path, "a\nb\nc")
    # columns 2 to 14 in rows 1 and 2 (lines 0 and 2), columns 16 to 29 in row 1 (line 1)
    assert [round(r.coverage * 1024) for r in QUERIES["q41_image_coverage"](spark, sf).collect()] == [13 * 2 + 14]


@tables
def test_image_coverage_by_sql(spark):
    assert agrees(spark, "q41_image_coverage", SQL["q41_image_coverage"])


def test_pull_quote_has_the_reference_bounds(spark, tmp_path):
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "abcdef"]
    page = lambda n: "\n".join([" ".join(words), "in the " + " ".join(words[:n])])
    short = "\n".join(["four five nine zero long with", "four five nine zero long with more text"])
    sf = documents(spark, tmp_path, page(5), page(6), page(13), page(40), page(41), short)
    rows = QUERIES["q18_pull_quote"](spark, sf).collect()
    assert sorted((r.pdf_page, r.region_ord, r.other, r.shared, r.n) for r in rows) == [(1, 1, 0, 6, 6), (2, 1, 0, 13, 13), (3, 1, 0, 40, 40), (5, 0, 1, 6, 6)]


@tables
def test_pull_quote_by_sql(spark):
    assert agrees(spark, "q18_pull_quote", SQL["q18_pull_quote"])


def test_no_sql_cuts_rows():
    """No SQL of the catalogue has a cap on rows or reads a share of them to be cheap."""
    for cut in ("region_ord < 40", "WHERE region_ord %", "[1:12]", "LIMIT", "USING SAMPLE"):
        assert not [name for name, sql in SQL.items() if cut in sql]


def test_reading_order_has_bands_between_spanning_regions():
    import pandas as pd

    from layoutlake.operators import kernels

    two = [(x, y) for y in (100.0, 130.0, 400.0, 430.0) for x in (40.0, 310.0)]
    rows = [(x, y, x + 240, y + 20, "body") for x, y in two] + [(40.0, 200.0, 550.0, 300.0, "title"), (None, None, None, None, "body"), (40.0, 290.0, 280.0, 310.0, "body"), (120.0, 40.0, 300.0, 60.0, "title"), (310.0, 600.0, 550.0, 620.0, "body")]
    page = pd.DataFrame(rows, columns=["x0", "y0", "x1", "y1", "kind"]).astype({c: float for c in ("x0", "y0", "x1", "y1")}).assign(region_ord=range(len(rows)))
    out = kernels.page_order(page).sort_values("place")
    # above the title (8) both columns, below it both columns, the region without a box (9) last
    assert out.region_ord.tolist() == [11, 0, 2, 1, 3, 8, 10, 4, 6, 5, 7, 12, 9]
    assert dict(zip(out.region_ord, out.confidence)) == {**dict.fromkeys(range(8), 0.85), 8: 0.70, 9: 0.15, 10: 0.40, 11: 0.85, 12: 0.55}
