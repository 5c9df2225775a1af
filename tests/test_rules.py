"""Rules of shapes, index tables, classification, membership and artefacts on literal cases."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from layoutlake.functions import shapes
from layoutlake.operators import classify, finalize, index_tables, membership, profile, stacks, webzones
from layoutlake.sources import artefacts


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_chrome(spark):
    c = lambda t: one(spark, shapes.chrome(F.lit(t)))
    assert all(c(t) for t in ("", "menu", " ab", "Lunedì 15 gennaio 2024", "author: Giovanni Rossi", "12 marzo 2024", "visitatori unici 12"))
    assert not c("Il mercato riapre dopo i lavori")


def test_markers_and_names(spark):
    k = lambda t: one(spark, shapes.marker_kind(F.lit(t)))
    assert (k("Pubblicità"), k("leggi anche: il ponte"), k("il ponte")) == ("advertisement", "related", None)
    n = lambda t: one(spark, shapes.name_like(shapes.byline(F.lit(t))[0]))
    assert n("di Mario Rossi") and n("Anna De Luca") and n("Carlo dell'Orto Bianchi") is False and not n("Mario") and not n("il Sindaco parla oggi qui adesso")
    assert one(spark, shapes.abbreviated_signature(F.lit("M. R."))) and not one(spark, shapes.abbreviated_signature(F.lit("Mario R.")))
    assert one(spark, shapes.font_name(F.lit("ABCDEF+Times-Bold"))) == "times-bold"
    assert one(spark, shapes.font_trait(F.array(F.lit("Times-Bold"), F.lit("Arial")), ("bold", "black"))) == 0.5


def test_cleanup(spark):
    clean, damaged = shapes.clean_characters(F.lit("ﬁ­ne cit­tà “qui” Ã¨ l’ora é"))
    assert one(spark, clean) == 'fi­ne città "qui" è l\'ora é' or one(spark, clean) == 'fine città "qui" è l\'ora é'
    assert one(spark, damaged) is False and one(spark, shapes.clean_characters(F.lit("a�"))[1]) is True
    p = lambda t: one(spark, shapes.clean_punctuation(F.lit(t)))
    assert p("ciao ,mondo.Poi  ( via ) 1,5 su https://a.it/x,y") == "ciao, mondo. Poi (via) 1,5 su https://a.it/x,y"


def test_joined(spark):
    j = lambda a, b: one(spark, F.struct(*shapes.joined(F.lit(a), F.lit(b), F.array(F.lit("mercato")), ("comune",))))
    assert tuple(j("il mer-", "cato oggi")) == ("il mercato oggi", "dehyphenated")
    assert tuple(j("il por-", "to oggi")) == ("il por-to oggi", "hyphen_preserved")
    assert tuple(j("il co­", "mune")) == ("il comune", "dehyphenated") and tuple(j("il com-", "une"))[1] == "dehyphenated"
    assert tuple(j("fine", "Poi")) == ("fine Poi", "spaced")


TABLE = {"label": "document_index", "self_ref": "#/tables/0", "prov": [{"page_no": 1}], "data": {"num_cols": 5, "grid": [[{"text": t} for t in row] for row in (
    ("17/01/2024", "Gazzetta", "5 Riapre la fognaria nel centro", "", "7"), ("17/01/24", "Mattino", "12 Bilancio consuntivo approvato", "Rossi", "9"), ("31/02/2024", "Mattino", "3 Un giorno che non esiste", "", "4"), ("x", "", "", "", ""), ("17/01/2024", "Mattino", "3 corto", "", "4"), ("17/01/2024", "Mattino", "3 Un titolo abbastanza lungo", "", "0"))]}}
SCHEMA = "document_id string, tables array<struct<label:string,self_ref:string,prov:array<struct<page_no:int>>,data:struct<num_cols:int,grid:array<array<struct<text:string>>>>>>"


def test_raw_index(spark):
    late, single, other = (dict(TABLE, self_ref=f"#/tables/{k}") for k in (1, 2, 3))
    late["prov"], single["data"], other["label"] = [{"page_no": 4}], {"num_cols": 5, "grid": TABLE["data"]["grid"][:1]}, "table"
    found = sorted(index_tables.raw_entries(spark.createDataFrame([("d", [TABLE, late, single, other]), ("e", None)], SCHEMA)).collect(), key=lambda r: r.row_number)
    assert [(r.id, r.publication_date, r.source, r.original_page, r.title, r.author, r.review_start_page) for r in found] == [
        ("d:index:#/tables/0:row=0", datetime.date(2024, 1, 17), "Gazzetta", 5, "Riapre la fognaria nel centro", None, 7),
        ("d:index:#/tables/0:row=1", datetime.date(2024, 1, 17), "Mattino", 12, "Bilancio consuntivo approvato", "Rossi", 9),
    ]


def boxes(spark, rows, columns="region_ord int, text string, x0 double, y0 double, x1 double, y1 double"):
    return spark.createDataFrame(rows, columns).select(F.lit("d").alias("document_id"), F.lit(1).cast("long").alias("pdf_page"), "*", F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"))


def test_layout_index_and_fused_rows(spark):
    head = (0, "Rassegna del 17/01/2024", 40.0, 20.0, 200.0, 40.0)
    rows = [head, (1, "17/01/2024 Gazzetta", 40.0, 100.0, 90.0, 112.0), (2, "5 Riapre la fognaria", 160.0, 101.0, 300.0, 113.0), (3, "7", 540.0, 102.0, 550.0, 114.0), (4, "17/01/2024 Mattino", 40.0, 140.0, 90.0, 152.0), (5, "3 Due numeri a destra", 160.0, 141.0, 300.0, 153.0), (6, "7", 540.0, 140.0, 550.0, 152.0), (7, "8", 560.0, 140.0, 570.0, 152.0)]
    found = index_tables.layout_entries(boxes(spark, rows)).collect()
    assert [(r.id, r.source, r.original_page, r.title, r.review_start_page) for r in found] == [("d:layout_index:p1:row0", "Gazzetta", 5, "Riapre la fognaria", 7)]
    fused = index_tables.layout_entries(boxes(spark, [head, (1, "17/01/24 Gazzetta del Sud 5 Riapre la fognaria nel centro ... 7", 40.0, 100.0, 560.0, 112.0)])).collect()
    assert [(r.source, r.original_page, r.title, r.review_start_page) for r in fused] == [("Gazzetta del Sud", 5, "Riapre la fognaria nel centro", 7)]
    assert index_tables.layout_entries(boxes(spark, rows[1:])).count() == 0


def test_index_match_needs_evidence(spark):
    d = datetime.date(2024, 1, 17)
    entries = spark.createDataFrame([("d", "e1", "Riapre la fognaria nel centro", d, "Gazzetta", 5, 1), ("d", "e2", "Bilancio consuntivo approvato", d, "Mattino", 12, 1)], "document_id string, id string, title string, publication_date date, source string, original_page int, index_pdf_page long")
    titles = spark.createDataFrame([("d", 7, 0, "Riapre la fognaria nel centro", d, "GAZZETTA", 5), ("d", 8, 0, "Riapre la fognaria in centro", datetime.date(2024, 1, 18), "Gazzetta", 5), ("d", 9, 0, "Tutt'altro titolo", d, "Mattino", 12), ("d", 1, 0, "Riapre la fognaria nel centro", d, "Gazzetta", 5)], "document_id string, pdf_page long, region_ord int, title string, publication_date date, source string, original_page int")
    out = {r.pdf_page: r for r in index_tables.match(titles, entries).collect()}
    assert out[7].status == "matched" and out[7].entry_id == "e1" and out[7].score == 1.0 and "same_source" in out[7].evidence
    assert out[8].status == "contradicted" and "different_publication_date" in out[8].contradictions
    assert out[9].status == "below_score" and 1 not in out


def test_profile_policies(spark):
    d = lambda w, b, c, p: one(spark, profile.decision(F.lit(w), F.lit(b), F.lit(c), p)[1])
    assert d(0, 0, 0.05, "auto") == "no_pdf_text_with_significant_image" and d(40, 29, 0.05, "auto") == "sparse_body_text_with_significant_image"
    assert d(200, 100, 0.2, "auto").startswith("native") and d(200, 100, 0.2, "aggressive").startswith("aggressive") and d(900, 900, 0.0, "all") == "ocr_policy_all"
    with pytest.raises(ValueError):
        profile.decision(F.lit(1), F.lit(1), F.lit(0.0), "never")


def test_technical_types(spark):
    long = "parola " * 30
    rows = [(0, "© Riproduzione riservata", 10.0, 700.0, 90.0, 710.0), (1, "Data Stampa 1234", 5.0, 5.0, 90.0, 15.0), (2, f"Data Stampa 1234 {long}", 5.0, 300.0, 500.0, 400.0), (3, "Sponsored content", 50.0, 200.0, 300.0, 220.0), (4, None, 480.0, 600.0, 560.0, 720.0), (5, "dentro", 490.0, 610.0, 520.0, 620.0), (6, "Un testo normale", 50.0, 400.0, 300.0, 420.0)]
    r = boxes(spark, rows).withColumns({"raw_label": F.when(F.col("region_ord") == 4, "picture").otherwise("text"), "type": F.when(F.col("region_ord") == 4, "image")})
    out = {x.region_ord: x for x in classify.technical(r).collect()}
    assert [out[k].type for k in range(7)] == ["rights_notice", "watermark", "unknown", "advertisement", "article_position_thumbnail", "unknown", "unknown"]
    assert [out[k].excluded for k in range(7)] == [True, True, False, True, False, True, False] and out[5].in_thumbnail and out[1].watermark_score == 0.79


def test_seeds_zone_and_bodies(spark):
    body = "Il mercato della città riapre domani dopo i lavori durati tre mesi, lo ha detto ieri il sindaco in una lunga conferenza stampa"
    rows = [(0, "da pag. 12 foglio 1/2", 40.0, 10.0, 200.0, 30.0), (1, "Tiratura: 15000 Lettori: 2000", 40.0, 32.0, 200.0, 44.0), (2, "Rubrica", 40.0, 34.0, 200.0, 50.0), (3, body, 40.0, 300.0, 300.0, 360.0), (4, body.upper(), 40.0, 400.0, 300.0, 460.0), (5, f"{body} condividi", 40.0, 500.0, 300.0, 560.0), (6, "Napoli", 40.0, 600.0, 90.0, 612.0)]
    r = boxes(spark, rows).withColumns({"raw_label": F.lit("text"), "entity_kind": F.when(F.col("region_ord") == 6, "location")})
    out = {x.region_ord: x for x in classify.semantic(classify.header_zone(classify.metadata_seeds(classify.technical(r)))).collect()}
    assert [out[k].type for k in range(7)] == ["header_metadata", "header_metadata", "unknown", "article_body", "unknown", "related_content", "location"]
    assert out[2].zone_role == "unresolved_header_content" and out[2].excluded and out[4].seed_veto == "mostly_uppercase" and out[0].zone_role == "seed"


def test_pages_follow_web_pages(spark):
    rows = [("d", k, t, None) for k, t in enumerate(("web", "unknown", "unknown", "press_clipping", "unknown", "web"))] + [("d", 9, "unknown", None)]
    p = spark.createDataFrame(rows, "document_id string, pdf_page long, page_type string, section string").withColumns({"clipping_markers": F.lit(0), "index_like": F.lit(False), "supported": F.lit(True)})
    assert [r.page_type for r in classify.refined_pages(p).orderBy("pdf_page").collect()] == ["web", "web", "web", "press_clipping", "web", "web", "unknown"]


def _page(rows):
    columns = ["region_ord", "kind", "x0", "y0", "article_id", "candidate"]
    p = pd.DataFrame(rows, columns=columns)
    return p.assign(x1=p.x0 + 200, y1=p.y0 + 20, page_height=800.0, zone=None, font=10.0, chars=250, seed=True, document_id="d", pdf_page=1)


def test_membership_rounds():
    out = membership.spread(_page([(0, "body", 20.0, 100.0, "a", "a"), (1, "body", 20.0, 122.0, None, "a"), (2, "body", 20.0, 144.0, None, "b"), (3, "body", 20.0, 700.0, None, None)]), membership.REFINEMENT).set_index("region_ord")
    assert out.article_id.tolist() == ["a", "a", None, None]
    right = membership.spread(_page([(0, "body", 20.0, 100.0, "a", None), (1, "body", 240.0, 100.0, None, None), (2, "body", 460.0, 100.0, None, None), (3, "body", 460.0, 400.0, None, None)]), membership.COLUMNS).set_index("region_ord")
    assert right.article_id.tolist() == ["a", "a", "a", None]
    whole = membership.spread(_page([(0, "title", 20.0, 50.0, "a", None), (1, "body", 20.0, 75.0, None, "a"), (2, "title", 20.0, 300.0, "b", None), (3, "body", 20.0, 325.0, None, "a")]), membership.GLOBAL).set_index("region_ord")
    assert whole.article_id.tolist() == ["a", "a", "b", None]


def test_membership_barrier():
    assert membership.barriers(_page([(0, "body", 20.0, 100.0, "a", None), (1, "title", 20.0, 130.0, "b", None), (2, "body", 20.0, 160.0, None, None), (3, "body", 300.0, 160.0, None, None)]))[[2, 3], 0].tolist() == [True, False]


def test_readiness(spark):
    def status(**x):
        given = {"title": "t", "body": "b", "proximity": False, "links": 0, "warnings": [], "sure": 0.8, "source": "s", "date": "d", "complete": "complete"} | x
        return one(spark, finalize.ready(F.lit(given["title"]), F.lit(given["body"]), F.lit(given["proximity"]), F.lit(given["links"]), F.array(*map(F.lit, given["warnings"])).cast("array<string>"), F.lit(given["sure"]), F.lit(given["source"]), F.lit(given["date"]), F.lit(given["complete"])))

    assert status() == "ready"
    for x in ({"title": " "}, {"body": None}, {"proximity": True}, {"links": 1}, {"warnings": ["Conflicting date"]}, {"sure": 0.64}, {"source": None}, {"complete": "unknown"}):
        assert status(**x) == "review_required"
    c = lambda *n, ocr=False, ret=None, all_ocr=False: one(spark, F.struct(*finalize.completeness(*map(F.lit, n), F.lit(ocr), F.lit(ret).cast("double"), F.lit(all_ocr))))
    assert c(1000, 50, 0, 0)[2] == "complete" and c(1000, 151, 0, 0)[2] == "incomplete" and c(0, 0, 0, 0)[2] == "unknown"
    assert c(1000, 0, 0, 0, ocr=True)[2] == "unknown" and c(1000, 0, 0, 0, ocr=True, ret=0.93)[2] == "incomplete" and c(1000, 0, 0, 0, ocr=True, ret=0.93, all_ocr=True)[2] == "complete"


def test_lists(spark):
    assert one(spark, finalize.distinct_in_order(F.array(F.lit("b"), F.lit("a"), F.lit("b"), F.lit(""), F.lit(None)))) == ["b", "a"]
    assert one(spark, F.size(finalize.capped(F.sequence(F.lit(1), F.lit(500))))) == 200
    assert one(spark, finalize.subset(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2)))) and not one(spark, finalize.subset(F.array(F.lit(3)), F.array(F.lit(1))))


def test_slug_and_marks(spark):
    r = boxes(spark, [(0, "Tiratura: 100 Data Stampa 1234", 40.0, 10.0, 100.0, 30.0), (1, "Il futuro della città data stampa 1234", 40.0, 300.0, 300.0, 320.0), (2, "Altro testo Data Stampa 999", 40.0, 400.0, 300.0, 420.0)])
    found = {x.region_ord: (x.in_header, x.repeated_pages) for x in stacks.marks(r).collect()}
    assert found == {1: (True, 1), 2: (False, 1)}
    far = boxes(spark, [(0, "Tiratura: 100 Data Stampa 1234", 40.0, 10.0, 100.0, 30.0), (1, "Il futuro della città data stampa 1234", 40.0, 100.0, 300.0, 120.0), (2, "Altro testo Data Stampa 999", 40.0, 400.0, 300.0, 420.0)])
    out = {x.region_ord: (x.text, x.cleaned) for x in webzones.cleaned_suffix(far).collect()}
    assert out[1] == ("Il futuro della città", True) and out[2] == ("Altro testo Data Stampa 999", False)


def test_artefacts(spark, tmp_path):
    assert artefacts.read_json(spark, f"{tmp_path}/none.json", "a int").count() == 0
    (tmp_path / "x.json").write_text('{"a": 5}')
    assert artefacts.read_json(spark, f"{tmp_path}/x.json", "a int").first().a == 5
    target = f"{tmp_path}/table"
    artefacts.swap(spark.range(3), target)
    artefacts.swap(spark.range(5), target)
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(Exception):  # noqa: B017
        artefacts.swap(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), target)
    assert spark.read.parquet(target).count() == 5
    assert one(spark, artefacts.safe_name(F.lit("/in/2024/La mia rassegna.pdf"))) == "La_mia_rassegna"
    docs = spark.createDataFrame([("2024", "marzo", "b.pdf", "success", ["x", "y"]), ("2024", "gennaio", "a.pdf", "failed", [])], "year string, month string, pdf string, status string, warnings array<string>").withColumns({c: F.lit(2) for c in artefacts.COUNTERS})
    artefacts.save_reports(docs, docs, f"{tmp_path}/out", ["pdf", "month", "warnings"], ["pdf"], ["title_ok"])
    csv = spark.read.option("header", True).csv(f"{tmp_path}/out/documents").collect()
    assert [(r.pdf, r.warnings) for r in csv] == [("a.pdf", None), ("b.pdf", "x; y")] and spark.read.option("header", True).csv(f"{tmp_path}/out/audit_template").columns == ["pdf", "title_ok"]
    assert spark.read.json(f"{tmp_path}/out/metrics").filter("year is null").first().success_rate == 0.5
    artefacts.write_stage(docs.withColumnRenamed("pdf", "document_id"), f"{tmp_path}/flow", "pages")
    assert spark.read.json(f"{tmp_path}/flow/pages").count() == 2
    issues = spark.createDataFrame([("y", [("a", 2)]), ("y", [("a", 1), ("b", 4)])], "year string, anomalies array<struct<kind:string,count:int>>")
    assert artefacts.issue_counts(issues, "year").first().issues == {"a": 3, "b": 4}


def test_membership_query(spark):
    from layoutlake.plans.catalogue import QUERIES

    rows = QUERIES["q131_membership_rounds"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.n_regions >= 1 and 0 < r.score <= 1 for r in rows)


def test_leaders_by_place(spark):
    from layoutlake.operators import claims

    rows = [("d", page, "generic_exact", "a line", x, y, x + 100.0, y + 10.0) for page, x, y in ((1, 40.0, 20.0), (2, 45.0, 22.0), (3, 40.0, 700.0), (4, 42.0, 24.0), (5, 40.0, 720.0))]
    df = spark.createDataFrame(rows, "document_id string, pdf_page long, family string, pattern string, x0 double, y0 double, x1 double, y1 double").withColumns({"page_width": F.lit(600.0), "page_height": F.lit(800.0)})
    assert sorted((r.leader, r.pages, r.frequency, r.repeated) for r in claims.leaders(df).collect()) == [(0, 3, 0.6, True), (1, 2, 0.4, False)]


def test_media_and_claims(spark):
    from layoutlake.operators import claims

    rows = [("d", "u", "a", True, True), ("d", "u", "b", True, False), ("d", "v", "a", False, False), ("d", "v", "b", True, False), ("d", "w", "a", True, True), ("d", "w", "b", True, True), ("d", "x", "a", False, False)]
    df = spark.createDataFrame(rows, "document_id string, url string, owner string, has_record boolean, titled boolean")
    assert {r.url: (r.owner, r.rule) for r in claims.claimants(df).collect()} == {"u": ("a", "unique_titled"), "v": ("b", "unique_with_record"), "w": (None, "ambiguous"), "x": ("a", "one_owner")}
