"""Queries of single functions that the others build on: boxes, keys, addresses, dates, styles, layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from layoutlake.functions import dates, geometry, shapes, text, titles, urls
from layoutlake.operators import fragments, styles
from layoutlake.plans.oracle import LINES, REGIONS, WORDS
from layoutlake.plans.queries import DOC
from layoutlake.sources import layout_json
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {REGIONS}, b AS (SELECT *, CASE WHEN region_ord % 9 = 4 THEN x0 ELSE x1 END AS bx1, CASE WHEN region_ord % 11 = 5 THEN CAST('nan' AS DOUBLE) ELSE y1 END AS by1 FROM regions), v AS (SELECT *, NOT isnan(by1) AND bx1 > x0 AND by1 > y0 AS ok, (x0 + x1) / 2 / 600 AS cx, (y0 + y1) / 2 / 1400 AS cy FROM b)
  SELECT document_id, pdf_page, count_if(ok) AS valid, count_if(y0 / 1400 < 0.15) AS in_top, count_if(y1 / 1400 > 0.80) AS in_bottom, count_if(x0 / 600 < 0.35) AS in_left, count_if(x1 / 600 > 0.60) AS in_right, count_if(cx BETWEEN 0.25 AND 0.75 AND cy BETWEEN 0.25 AND 0.75) AS in_centre, CAST(round(max(x0 / 595), 6) AS DOUBLE) AS lane,
    CAST(round(sum(greatest(0, least(x1, 300) - greatest(x0, 100)) * greatest(0, least(y1, 400) - greatest(y0, 70)) / greatest((x1 - x0) * (y1 - y0), 1.0)), 4) AS DOUBLE) AS contained, CAST(round(sum(greatest(0, least(x1, 300) - greatest(x0, 100)) / greatest(least(x1 - x0, 200), 1.0)), 4) AS DOUBLE) AS over_floor FROM v GROUP BY 1, 2""")
def q134_box_flags(spark, sf):
    """Valid boxes, areas of the page, lanes, containment in a fixed box and overlap with a floor."""
    r = src.regions(spark, sf)
    o = F.col("region_ord")
    odd = (F.col("x0"), F.col("y0"), F.when(o % 9 == 4, F.col("x0")).otherwise(F.col("x1")), F.when(o % 11 == 5, float("nan")).otherwise(F.col("y1")))
    area = geometry.relative(geometry.box(), F.col("page_width"), F.col("page_height"))
    fixed = tuple(F.lit(float(v)) for v in (100, 70, 300, 400))
    return r.groupBy(*DOC).agg(F.count_if(geometry.valid_box(odd)).alias("valid"), *(F.count_if(area[n]).alias(n) for n in ("in_top", "in_bottom", "in_left", "in_right", "in_centre")), F.round(F.max(geometry.lane_x(F.col("x0"), F.lit(0.0))), 6).alias("lane"), F.round(F.sum(geometry.containment(geometry.box(), fixed, 1.0)), 4).alias("contained"), F.round(F.sum(geometry.horizontal_overlap_floor(geometry.box(), fixed)), 4).alias("over_floor"))


PUT_URL = "CASE WHEN region_ord % 4 = 1 THEN text || ' https://a.example.org/x/' || CAST(region_ord AS VARCHAR) || '.' WHEN region_ord % 4 = 2 THEN 'www.b.example.net/y-' || chr(10) || 'z, ' || text ELSE text END"


@query(f"""WITH {LINES} SELECT document_id, pdf_page, region_ord, unnest(CASE WHEN region_ord % 4 = 1 THEN ['https://a.example.org/x/' || CAST(region_ord AS VARCHAR)] WHEN region_ord % 4 = 2 THEN ['www.b.example.net/y-z'] ELSE [] END) AS url FROM lines""")
def q135_wrapped_addresses(spark, sf):
    """Addresses put into lines, some broken over two of them, are found again in one piece."""
    o = F.col("region_ord")
    put = F.when(o % 4 == 1, F.concat("text", F.lit(" https://a.example.org/x/"), o.cast("string"), F.lit("."))).when(o % 4 == 2, F.concat(F.lit("www.b.example.net/y-\nz, "), "text")).otherwise(F.col("text"))
    return fragments.addresses(src.lines(spark, sf).withColumn("text", put))


@query(r"""WITH k AS (SELECT doc_id, replace(strip_accents(lower(string_split(text, chr(10))[1])), 'ß', 'ss') AS f, string_split(text, chr(10))[1] AS t FROM documents)
  SELECT doc_id, regexp_replace(f, '[^a-z0-9]', '', 'g') AS squeezed, trim(regexp_replace(translate(lower(t), 'àáâãäåèéêëìíîïòóôõöùúûüýÿçñ', 'aaaaaaeeeeiiiiooooouuuuyycn'), '\s+', ' ', 'g')) AS with_marks, regexp_matches(trim(t), '^(?:[A-Z]{1,4}\.?[A-Z]?\.?\d{3,8}\s*)+$') AS stamp FROM k""")
def q136_text_keys(spark, sf):
    """Keys of first lines: folded letters and digits, lower case with marks, register codes."""
    t = F.split("text", "\n")[0]
    return src.read(spark, sf, "documents").select("doc_id", titles.name_signature(t).alias("squeezed"), shapes.key_with_marks(t).alias("with_marks"), text.stamp_code(t).alias("stamp"))


@query(r"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS w FROM part) SELECT w AS word, array_to_string(list_sort(list_distinct([w, replace(w, 'm', 'rn'), replace(w, 'rn', 'm'), replace(w, 'ii', 'n'), replace(w, 'n', 'ii')])), ',') AS variants FROM w""")
def q137_scan_variants(spark, sf):
    """Words with what common scanning confusions make of them."""
    w = src.read(spark, sf, "part").select(F.explode(F.regexp_extract_all(F.lower("p_name"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return w.select("word", F.array_join(F.array_sort(titles.ocr_variants(F.col("word"))), ",").alias("variants"))


MONTH_LIST = "['GEN','FEB','MAR','APR','MAG','GIU','LUG','AGO','SET','OTT','NOV','DIC']"


@query(rf"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'invalid' WHEN o_orderkey % 7 = 0 THEN 'none' ELSE 'valid' END AS status, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS found, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(((o_orderkey % 100) + 0.5) AS DOUBLE) END AS surface FROM orders""")
def q138_strict_dates(spark, sf):
    """Printed dates of a region: valid, impossible or none; the printed surface."""
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month(d))
    said = F.when(k % 5 == 0, F.lit("31-FEB-2024")).otherwise(F.concat(F.date_format(d, "dd"), F.lit("-"), month, F.lit("-"), F.date_format(d, "yyyy")))
    line = F.when(k % 7 == 0, F.lit("niente")).otherwise(F.concat(said, F.lit(" Superficie "), (k % 100).cast("string"), F.lit(",5 %")))
    o = src.read(spark, sf, "orders").select("o_orderkey", F.when((k % 7 == 0) & (k % 5 == 0), F.lit("31-FEB-2024")).otherwise(line).alias("line"))
    status, found = dates.strict_date(F.col("line"))
    return o.select("o_orderkey", status.alias("status"), found.cast("string").alias("found"), F.when(k % 7 != 0, dates.surface_percent(F.col("line"))).alias("surface"))


SPANS = """spans AS (SELECT document_id, pdf_page, region_ord AS src, k, x0 + 120 * (k - 1) + CASE WHEN (region_ord + k) % 5 = 0 THEN 200 ELSE 0 END AS x0, y0 + 1 AS y0, x0 + 120 * k + CASE WHEN (region_ord + k) % 5 = 0 THEN 200 ELSE 0 END AS x1, y1 - 1 AS y1, ['ABCDEF+Times-Bold', 'Times-Roman', 'Arial'][1 + (region_ord + k) % 3] AS font, 8.0 + (region_ord + k) % 4 AS size, 10 + length(text) % 7 + k AS n FROM regions, range(1, 3) t(k))"""


@query(rf"""WITH {REGIONS}, {SPANS}, h AS (SELECT r.document_id, r.pdf_page, r.region_ord, s.font, s.size, s.n FROM regions r JOIN spans s ON r.document_id = s.document_id AND r.pdf_page = s.pdf_page AND r.text <> '' AND greatest(0, least(r.x1, s.x1) - greatest(r.x0, s.x0)) * greatest(0, least(r.y1, s.y1) - greatest(r.y0, s.y0)) / ((s.x1 - s.x0) * (s.y1 - s.y0)) > 0.65),
  f AS (SELECT document_id, pdf_page, region_ord, font, row_number() OVER (PARTITION BY document_id, pdf_page, region_ord ORDER BY count(*) DESC, font) AS rn FROM h GROUP BY 1, 2, 3, 4), g AS (SELECT document_id, pdf_page, region_ord, count(*) AS matches, CAST(median(size) AS DOUBLE) AS median_size, CAST(max(size) AS DOUBLE) AS max_size, sum(CASE WHEN contains(lower(font), 'bold') THEN n ELSE 0 END) AS b, sum(CASE WHEN contains(lower(font), 'bold') OR contains(lower(font), 'roman') THEN n ELSE 0 END) AS kn, sum(n) AS tot FROM h GROUP BY 1, 2, 3)
  SELECT g.document_id, g.pdf_page, g.region_ord, font AS dominant_font, matches, median_size, max_size, round(CASE WHEN kn > 0 THEN b / kn END, 6) AS bold_ratio, round(CASE WHEN kn > 0 THEN kn / tot ELSE 0 END, 6) AS bold_evidence FROM g JOIN f ON f.document_id = g.document_id AND f.pdf_page = g.pdf_page AND f.region_ord = g.region_ord AND rn = 1""")
def q139_region_styles(spark, sf):
    """Styles of regions from the text spans that lie in them (two spans for each line)."""
    r = src.regions(spark, sf)
    o, k = F.col("region_ord"), F.col("k")
    s = r.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    moved = F.when((o + k) % 5 == 0, 200).otherwise(0)
    font = F.element_at(F.array(F.lit("ABCDEF+Times-Bold"), F.lit("Times-Roman"), F.lit("Arial")), (1 + (o + k) % 3).cast("int"))
    s = s.select(*DOC, (F.col("x0") + 120 * (k - 1) + moved).alias("x0"), (F.col("y0") + 1).alias("y0"), (F.col("x0") + 120 * k + moved).alias("x1"), (F.col("y1") - 1).alias("y1"), font.alias("font"), (8.0 + (o + k) % 4).alias("size"), F.lit(None).cast("int").alias("flags"), (10 + F.length("text") % 7 + k).alias("chars"), F.lit(None).cast("double").alias("opacity"))
    found = styles.region_styles(r.filter("text <> ''"), s)
    return found.select(*DOC, "region_ord", "dominant_font", F.col("n_spans").alias("matches"), F.col("median_font_size").alias("median_size"), F.col("max_font_size").alias("max_size"), F.round("bold_ratio", 6).alias("bold_ratio"), F.round("bold_evidence", 6).alias("bold_evidence"))


@query("""WITH t AS (SELECT doc_id, text, length(text) AS n, doc_id % 3 AS k FROM documents WHERE length(text) >= 20), p AS (SELECT doc_id, k, unnest([0, 1]) AS fragment, text, n FROM t)
  SELECT 'd' || CAST(doc_id AS VARCHAR) AS document_id, '#/texts/0:page=1:fragment=' || CAST(fragment AS VARCHAR) AS region_id, CASE k WHEN 0 THEN 'unknown' WHEN 1 THEN 'header_metadata' ELSE 'footer' END AS type, md5(CASE WHEN fragment = 0 THEN substring(text, 1, 10) ELSE substring(text, 11) END) AS text_md5, CAST(10 AS DOUBLE) AS x0, CAST(CASE WHEN fragment = 0 THEN 800 - 700 ELSE 20 END AS DOUBLE) AS y0, CAST(CASE WHEN fragment = 0 THEN 800 - 680 ELSE 40 END AS DOUBLE) AS y1 FROM p""")
def q140_layout_regions(spark, sf):
    """Regions of layout documents made from texts: fragments by span, boxes turned to the top left, types by label."""
    k = F.col("doc_id") % 3
    d = src.read(spark, sf, "documents").filter(F.length("text") >= 20)
    box = lambda t, b, origin: F.struct(F.lit(10.0).alias("l"), F.lit(t).alias("t"), F.lit(110.0).alias("r"), F.lit(b).alias("b"), F.lit(origin).alias("coord_origin"))
    span = lambda a, z: F.array(a.cast("int"), z.cast("int"))
    prov = F.array(
        F.struct(F.lit(1).alias("page_no"), span(F.lit(0), F.lit(10)).alias("charspan"), box(700.0, 680.0, "BOTTOMLEFT").alias("bbox")),
        F.struct(F.lit(1).alias("page_no"), span(F.lit(10), F.length("text")).alias("charspan"), box(20.0, 40.0, "TOPLEFT").alias("bbox")),
        F.struct(F.lit(9).alias("page_no"), span(F.lit(0), F.lit(5)).alias("charspan"), box(20.0, 40.0, "TOPLEFT").alias("bbox")),
    )
    item = F.struct(F.lit("#/texts/0").alias("self_ref"), F.when(k == 0, "text").when(k == 1, "page_header").otherwise("page_footer").alias("label"), F.col("text"), F.lit(None).cast("string").alias("orig"), prov.alias("prov"))
    page = F.create_map(F.lit("1"), F.struct(F.lit(1).alias("page_no"), F.struct(F.lit(600.0).alias("width"), F.lit(800.0).alias("height")).alias("size")))
    none = [F.array().cast(layout_json._ITEM).alias(c) for c in layout_json.COLLECTIONS[1:]]
    docs = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), page.alias("pages"), F.array(item).cast(layout_json._ITEM).alias("texts"), *none)
    return layout_json.regions(docs).select("document_id", "region_id", "type", F.md5("text").alias("text_md5"), "x0", "y0", "y1")


ENDINGS = ("the", "and", "of", "der", "die", "und", "el", "la", "de", "le", "et", "que")


@query(rf"""WITH {LINES}, n AS (SELECT *, lead(text) OVER (PARTITION BY document_id, pdf_page ORDER BY region_ord) AS nxt FROM (SELECT * REPLACE (CASE WHEN region_ord % 3 = 0 THEN regexp_replace(text, '[.!?…:;]+$', '') || ' and' ELSE lower(text) END AS text) FROM lines)), w AS (SELECT *, {WORDS.format('text')} AS a, {WORDS.format('nxt')} AS b FROM n WHERE nxt IS NOT NULL)
  SELECT document_id, pdf_page, count(*) AS n, count_if(least(len(a), len(b)) >= 3 AND NOT regexp_matches(trim(text), '[.!?…:;]$') AND coalesce(list_contains([{', '.join(f"'{e}'" for e in ENDINGS)}], a[len(a)]), false) AND regexp_matches(regexp_extract(nxt, '(\p{{L}})', 1), '^\p{{Ll}}$') AND NOT contains(lower(text || ' ' || nxt), 'http://') AND NOT contains(lower(text || ' ' || nxt), 'https://')) AS open FROM w GROUP BY 1, 2""")
def q141_open_boundaries(spark, sf):
    """Lines whose sentence goes on in the next line."""
    from pyspark.sql import Window

    w = Window.partitionBy(*DOC).orderBy("region_ord")
    said = F.when(F.col("region_ord") % 3 == 0, F.concat(F.regexp_replace("text", "[.!?…:;]+$", ""), F.lit(" and"))).otherwise(F.lower("text"))
    n = src.lines(spark, sf).withColumn("text", said).withColumn("nxt", F.lead("text").over(w)).filter("nxt is not null")
    return n.groupBy(*DOC).agg(F.count("*").alias("n"), F.count_if(F.coalesce(titles.open_boundary(F.col("text"), F.col("nxt"), ENDINGS), F.lit(False))).alias("open"))


@query(f"""WITH {REGIONS}, k AS (SELECT *, trim(regexp_replace(lower(text), '[ \\t\\r\\n]+', ' ', 'g')) AS t FROM regions WHERE text <> ''), o AS (SELECT document_id, pdf_page, region_ord, t, x0 + CASE WHEN region_ord % 4 = 0 THEN 150 ELSE 5 END AS x0, y0, x1 + CASE WHEN region_ord % 4 = 0 THEN 150 ELSE 5 END AS x1, y1 FROM k)
  SELECT o.document_id, o.pdf_page, o.region_ord, CASE WHEN EXISTS (SELECT 1 FROM k n WHERE n.document_id = o.document_id AND n.pdf_page = o.pdf_page AND n.t = o.t AND greatest(0, least(n.x1, o.x1) - greatest(n.x0, o.x0)) * greatest(0, least(n.y1, o.y1) - greatest(n.y0, o.y0)) / ((o.x1 - o.x0) * (o.y1 - o.y0)) >= 0.6) THEN 'merged' ELSE 'appended' END AS status FROM o""")
def q142_second_pass(spark, sf):
    """Regions of a second reading that equal one of the first in text and place are merged, others appended."""
    r = src.regions(spark, sf).filter("text <> ''").withColumn("t", text.collapse(F.lower("text")))
    shift = F.when(F.col("region_ord") % 4 == 0, 150).otherwise(5)
    second = r.withColumns({"x0": F.col("x0") + shift, "x1": F.col("x1") + shift})
    return styles.second_pass(r, second)


@query(r"""SELECT page_id, CASE WHEN length(url) <= 2048 AND NOT contains(a, '@') AND (p = '' OR p IN ('80', '443')) AND contains(h, '.') AND NOT regexp_matches(h, '^[0-9.]+$') AND NOT regexp_matches(h, '\.(?:local|localhost|internal|invalid|test|example)$') THEN lower(s) || '://' || h || CASE WHEN path = '' THEN '/' ELSE path END || q END AS safe
  FROM (SELECT page_id, url, regexp_extract(url, '^([A-Za-z]+)://', 1) AS s, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS a, lower(regexp_replace(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1), ':\d+$', '')) AS h, regexp_extract(url, '^[A-Za-z]+://[^/?#:]*:(\d+)', 1) AS p, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(\?[^#]*)', 1) AS q FROM (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'http://10.0.0.1/x' WHEN page_id % 9 = 1 THEN 'https://printer.local/x' WHEN page_id % 9 = 2 THEN 'https://a.example.org:8080/x' WHEN page_id % 9 = 3 THEN 'https://u:p@a.example.org/' WHEN page_id % 9 = 4 THEN 'HTTPS://A.Example.org:443?q=1#f' ELSE url END AS url FROM pages))""")
def q143_safe_addresses(spark, sf):
    """Addresses that may be fetched: usual ports, named public hosts, no credentials."""
    k = F.col("page_id") % 9
    odd = ("http://10.0.0.1/x", "https://printer.local/x", "https://a.example.org:8080/x", "https://u:p@a.example.org/", "HTTPS://A.Example.org:443?q=1#f")
    url = F.when(k < len(odd), F.element_at(F.array(*map(F.lit, odd)), (k + 1).cast("int"))).otherwise(F.col("url"))
    return src.read(spark, sf, "pages").select("page_id", urls.safe_key(url).alias("safe"))


