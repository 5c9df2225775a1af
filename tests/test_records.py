"""The composition from regions to records on the canonical pages."""

from pyspark.sql import functions as F

from layoutlake.plans import records


def page(spark, rows):
    data = [("doc", 1, i, label, t, *map(float, b), 1000.0, 1400.0) for i, (label, t, b) in enumerate(rows)]
    return spark.createDataFrame(data, "document_id string, pdf_page long, region_ord int, raw_label string, text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double")


def test_two_columns_read_left_to_right(spark):
    line = "Riga {} {} del testo che continua con molte parole ancora da leggere."
    rows = [("section_header", "Titolo della pagina", (100, 80, 900, 130))]
    rows += [("text", line.format(side, k), (x, 220 + 30 * k, x + 380, 245 + 30 * k)) for k in range(4) for side, x in (("sinistra", 100), ("destra", 520))]
    rows += [("text", "© Riproduzione riservata", (100, 900, 300, 920))]
    r = records.records(page(spark, rows)).collect()
    assert len(r) == 1 and r[0].title == "Titolo della pagina" and r[0].article_id.startswith("article_")
    body = r[0].body
    assert "riservata" not in body and "sinistra 0" in body
    left = [body.index(f"sinistra {k}") for k in range(4)]
    assert left == sorted(left)
    # the right column is no part of the title's lane: it stays open or follows the whole left one
    assert "destra" not in body or body.index("destra 0") > left[-1]


def test_status_follows_coverage(spark):
    long = "Una riga lunga del corpo dell'articolo, con parole a sufficienza per non essere un titolo."
    rows = [("section_header", "TITOLO", (100, 80, 900, 130))] + [("text", long, (100, 220 + 30 * k, 900, 245 + 30 * k)) for k in range(6)]
    good = records.records(page(spark, rows)).first()
    assert good.finalization_status == "ready" and good.coverage == 1.0 and good.n_parts == 6
    far = rows + [("text", long + long, (100, 1300, 900, 1330))]
    bad = records.records(page(spark, far)).first()
    assert bad.finalization_status == "review_required" and "low_coverage" in bad.warnings
    report = records.document_report(records.records(page(spark, far))).first()
    assert (report.n_articles, report.n_ready) == (1, 0) and report.issues["low_coverage"] == 1


def test_ready_records_have_title_and_body(spark):
    from layoutlake.sources import tables

    r = records.records(tables.regions(spark, "/root/testdata/sf0.001"))
    assert r.filter((F.col("finalization_status") == "ready") & (F.col("title").isNull() | (F.col("body") == ""))).isEmpty()
    assert r.count() > 50
