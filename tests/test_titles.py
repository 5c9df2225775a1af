"""Titles, boundaries, spans and wrapped addresses."""

from pyspark.sql import functions as F

from layoutlake.functions import titles
from layoutlake.operators import fragments


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_similarities(spark):
    s = lambda f, a, b: one(spark, f(F.lit(a), F.lit(b)))
    assert s(titles.index_similarity, "Bilancio approvato", "Bilancio approvato") == 1.0
    assert s(titles.index_similarity, "Scafati, il Sindaco lascia", "Scafatiil Sindacolascia") > 0.85
    assert s(titles.index_similarity, "", "x") == 0.0 and s(titles.index_similarity, "Mare calmo", "Tasse in aumento") < 0.4
    assert s(titles.web_similarity, "riapre la fognaria nel centro", "Riapre la fognaria nel centro storico") > 0.9
    assert s(titles.web_similarity, "due parole", "due parole") == 0.0
    assert s(titles.slug_similarity, "riapre la fognaria oggi", "Riapre la fognaria oggi") == 1.0
    assert s(titles.same_headline, "Riapre il ponte - sestante.tv", "RIAPRE  il ponte") is True


def test_codes(spark):
    u = lambda t: one(spark, titles.unwrap_codes(F.lit(t)))
    assert u("DS16Tornano il mercato") == "Tornano il mercato"
    assert u("l'ImprenditoreS1667 torna").split() == ["l'Imprenditore", "torna"]
    assert u("FOSSOIMPERATORE667RESIDENTI") == "FOSSOIMPERATORE RESIDENTI"
    clean, done = titles.clean_title(F.lit("Il bilancio bilancio X99991 approvato"))
    assert one(spark, clean) == "Il bilancio approvato" and one(spark, done) == ["dedupe_repeated_token", "strip_registration_code"]


def test_places(spark):
    tokens = spark.createDataFrame([("d", "tavema"), ("d", "roma"), ("d", "scafat")], "document_id string, token string")
    places = spark.createDataFrame([("taverna",), ("scafati",), ("roma",), ("napoli",)], "place string")
    attested = spark.createDataFrame([("d", "taverna"), ("d", "scafati"), ("d", "roma")], "document_id string, word string")
    assert {r.token: r.place for r in titles.corrected_places(tokens, places, attested).collect()} == {"tavema": "taverna", "scafat": "scafati"}


def test_boundary(spark):
    b = lambda x, y: one(spark, titles.open_boundary(F.lit(x), F.lit(y), ("di", "della", "e")))
    assert b("il sindaco parla della", "nuova legge sul mare") is True
    assert b("il sindaco parla della.", "nuova legge sul mare") is False
    assert b("il sindaco parla della", "Nuova legge sul mare") is False


def spans_of(spark, text, orig, spans):
    df = spark.createDataFrame([("i", text, orig, spans)], "item_id string, text string, orig string, spans array<array<int>>")
    return sorted((r.fragment, r.start, r.end, r.status, r.confidence) for r in fragments.recovered(df).collect())


def test_spans(spark):
    text = "hello world again"
    assert spans_of(spark, text, None, [[0, 5], [6, 19]]) == [(0, 0, 5, "exact", 1.0), (1, 6, 17, "offset_adjusted", 0.9)]
    assert spans_of(spark, text, None, [None]) == [(0, 0, 17, "single_provenance", 0.85)]
    assert spans_of(spark, text, None, [[0, 7], [5, 17]])[1] == (1, 7, 17, "exact", 0.85)
    assert spans_of(spark, text, None, [[0, 12], [5, 17]])[1] == (1, None, None, "ambiguous", 0.0)
    assert spans_of(spark, text, None, [[0, 5], [40, 50]])[1] == (1, None, None, "ambiguous", 0.0)
    assert spans_of(spark, text, None, [[6, 11], [0, 5]]) == [(0, 6, 11, "exact", 1.0), (1, 0, 5, "exact", 1.0)]
    assert spans_of(spark, None, None, [[0, 3]]) == [(0, None, None, "ambiguous", 0.0)]
    assert spans_of(spark, "primo pezzo contenuto ignorato secondo pezzo", None, [[0, 11], [31, 44]]) == [(0, 0, 11, "exact", 1.0), (1, 31, 44, "exact", 1.0)]


def test_a_given_up_span_holds_nobody_back(spark):
    assert spans_of(spark, "x" * 40, None, [[0, 20], [10, 30], [21, 40]]) == [(0, 0, 20, "exact", 1.0), (1, None, None, "ambiguous", 0.0), (2, 21, 40, "exact", 1.0)]


def test_moved_spans(spark):
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa quebec romeo sierra"
    orig = words.replace("golf", "gol-f").replace("papa", "pa-pa")
    # the last span lies two characters further in the original than in the text
    end, start = len(orig) - 0, orig.index("quebec")
    assert end > len(words)
    first = spans_of(spark, words, orig, [[start, end], [0, 5]])
    assert first[0] == (0, words.index("quebec"), len(words), "realigned", 0.85)
    assert spans_of(spark, words, "something else" * 9, [[start, end], [0, 5]])[0][3] == "ambiguous"


def test_addresses(spark):
    rows = [
        (0, "Vedi https://esempio.it/a/b. Poi", ["https://esempio.it/a/b"]),
        (1, "vedi www.esempio.it/una-\nstoria/lunga\nfine qui", ["www.esempio.it/una-storia/lungafine"]),
        (2, "vedi www.esempio.it/una,\nstoria", ["www.esempio.it/una"]),
        (3, "https://esempio.it/\narticolo-123", ["https://esempio.it/articolo-123"]),
        (4, "x www.a.it/b y www.a.it/b", ["www.a.it/b"]),
        (5, "posta@www.esempio.it e nessun link", []),
        (6, "https://esempio.it/a\n\nnuovo paragrafo", ["https://esempio.it/a"]),
    ]
    df = spark.createDataFrame([("d", 1, k, t) for k, t, _ in rows], "document_id string, pdf_page long, region_ord long, text string")
    found = {}
    for r in fragments.addresses(df).collect():
        found.setdefault(r.region_ord, []).append(r.url)
    assert found == {k: urls for k, _, urls in rows if urls}
