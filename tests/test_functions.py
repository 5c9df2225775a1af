"""Literal values of the column functions."""

import datetime

from pyspark.sql import functions as F

from layoutlake.functions import dates, geometry, similarity, text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def box(*xs):
    return tuple(F.lit(float(x)) for x in xs)


def test_geometry(spark):
    assert one(spark, geometry.horizontal_overlap(box(0, 0, 10, 1), box(20, 0, 30, 1))) == 0
    assert one(spark, geometry.horizontal_overlap(box(0, 0, 10, 1), box(5, 0, 15, 1))) == 0.5
    assert one(spark, geometry.vertical_gap(box(0, 0, 1, 10), box(0, 25, 1, 30))) == 15
    assert one(spark, geometry.vertical_gap(box(0, 0, 1, 10), box(0, 5, 1, 30))) == 0
    assert one(spark, geometry.valid_box(box(0, 0, 1, 10))) is True
    assert one(spark, geometry.valid_box(box(5, 0, 1, 10))) is False
    assert one(spark, geometry.containment(box(0, 0, 2, 2), box(1, 0, 5, 5))) == 0.5
    r = geometry.relative(box(700, 700, 900, 1300), F.lit(1000.0), F.lit(1400.0))
    assert one(spark, r["rx0"]) == 0.7 and one(spark, r["ry0"]) == 0.5 and one(spark, r["in_right"])
    score, level = geometry.prominence(F.lit(1.0), F.lit(0.5), F.lit(0.5))
    assert one(spark, score) == 0.7 and one(spark, level) == "high"
    assert one(spark, geometry.lane_x(F.lit(59.5), F.lit(0.0))) == 0.1


def test_text(spark):
    assert one(spark, text.entity_key(F.lit("Città di Taverna!"))) == "citta di taverna"
    assert one(spark, text.entity_key(F.lit("FOOO   BAR"))) == "fooo bar"
    assert one(spark, text.squeezed(F.lit("Foo-Bar Baz!"))) == "foobarbaz"
    assert one(spark, text.can_reach(F.lit("abcde"), F.lit("abcdf"), 0.8)) is True
    assert one(spark, text.can_reach(F.lit("abc"), F.lit("abcdefghij"), 0.8)) is False
    assert one(spark, text.can_reach(F.lit(""), F.lit("abc"), 0.8)) is False
    assert one(spark, text.uppercase_ratio(F.lit("TUTTO MAIUSCOLO"))) == 1.0
    assert one(spark, text.visible_chars(F.lit(" a b\n"))) == 2
    assert one(spark, text.stamp_code(F.lit("DS1667 DS1667"))) is True
    assert one(spark, text.stamp_code(F.lit("Miasmi DS1667 dal Sarno"))) is False
    assert one(spark, text.stamp_code(F.lit(""))) is False
    assert one(spark, text.scrub_rights(F.lit("Il testo finisce ©riproduzioneriservata"))) == "Il testo finisce"
    assert one(spark, text.scrub_rights(F.lit("Un  testo pulito"))) == "Un  testo pulito"
    codes = F.array(F.lit("DS1667"))
    assert one(spark, text.scrub_codes(F.lit("Il futuroDS1667 della citta' resta aperto."), codes)) == "Il futuro della citta' resta aperto."
    assert one(spark, text.shingles(F.lit("a b c"), 2)) == ["a b", "b c"]
    assert one(spark, text.shingles(F.lit("a"), 2)) == []
    for said, status, marker in (("© Riproduzione riservata.", "accepted", "riproduzione_riservata"), ("Articolo non cedibile a terzi", "accepted", "articolo_non_cedibile"), ("Tutti i diritti riservati al club", "ambiguous", None), ("testo", "none", None)):
        s, m = text.rights_notice(F.lit(said))
        assert (one(spark, s), one(spark, m)) == (status, marker)
    family, pattern = text.boilerplate_family(F.lit("Articolo non cedibile  12/3/2024"))
    assert (one(spark, family), one(spark, pattern)) == ("rights_candidate", "articolo non cedibile <num>")
    assert one(spark, text.flags(F.lit("Vedi pag. 3"))["index_entry"]) is True


def test_urls(spark):
    norm = lambda u: one(spark, urls.normalize(F.lit(u)))
    assert norm("www.esempio.it/a") == "https://www.esempio.it/a"
    assert norm("https://esempio.it/a).") == "https://esempio.it/a"
    assert norm("https://u:p@esempio.it/a") is None and norm("ftp://esempio.it/a") is None and norm("https://facebook.com/x") is None
    assert one(spark, urls.has_path(F.lit("https://a.it/"))) is False
    assert one(spark, urls.slug(F.lit("https://a.it/x/una-bella_storia.html?q=1"))) == "una bella storia"
    assert one(spark, urls.canonical_key(F.lit("https://www.A.it/x/?q=1"))) == "a.it/x"


def test_dates(spark):
    d = lambda s: one(spark, dates.extract_date(F.lit(s)))
    assert d("del 31-FEB-2024 e 05-GEN-2024") == datetime.date(2024, 1, 5)
    assert d("39/04/2026 poi 3/4/26") == datetime.date(2026, 4, 3)
    assert d("nessuna") is None
    current, total = dates.sheet(F.lit("foglio 2 / 7"))
    assert (one(spark, current), one(spark, total)) == (2, 7)
    assert one(spark, dates.surface_percent(F.lit("Superficie 12,5 %"))) == 12.5


def test_similarity(spark):
    assert one(spark, similarity.ratio(F.lit("abcd"), F.lit("abcd"))) == 1.0
    assert one(spark, similarity.ratio(F.lit(""), F.lit("abcd"))) == 0.0
    assert one(spark, similarity.fold(F.lit("Straße È"))) == "strasse e"
