"""Queries of the classification chain, index scans and links between pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from layoutlake.functions import text
from layoutlake.operators import classify, index_tables
from layoutlake.plans.oracle import LINES, MARKER, NOTICE, REGIONS, UPPER, URL, WORDS, flag
from layoutlake.plans.queries import DOC
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


N_WORDS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+'))"
LOW = "lower(text)"
HAS = {n: rf"regexp_matches({LOW}, '\b{n}\b')" for n in ("foglio", "superficie", "tiratura", "diffusione", "lettori", "quotidiano")}
HAS_DATE = r"(regexp_matches(text, '\b\d{1,2}[-/][a-zA-Z]{3}[-/]\d{4}\b') OR regexp_matches(text, '\b\d{1,2}/\d{1,2}/\d{2,4}\b'))"
INDEX_LIKE = rf"(length(trim({LOW})) <= 180 AND (contains({LOW}, 'pag.') OR regexp_matches({LOW}, '\bpagina\s+\d+\b') OR regexp_matches(trim({LOW}), '\.{{3,}}\s*\d+$')))"
FLAT = rf"trim(regexp_replace({LOW}, '[ \t\r\n]+', ' ', 'g'))"
AUDIENCE = rf"""(y0 >= 0 AND y1 <= least(135.0, 0.16 * 1400) AND (regexp_matches({FLAT}, '\b(?:superficie|tiratura|diffusione|lettori|quotidiano)\b') OR regexp_matches({FLAT}, '\bdir\.?\s*resp\b'))
  AND (regexp_matches({FLAT}, '\b(?:tiratura|diffusione|lettori|superficie)\s*[:=]') OR regexp_matches({FLAT}, '\bdir\.?\s*resp\.?\s*:') OR regexp_matches({FLAT}, '^(?:quotidiano|settimanale|mensile)\s*[-–:]')
    OR (len(list_distinct(regexp_extract_all({FLAT}, '\b(?:tiratura|diffusione|lettori)\b'))) >= 2 AND regexp_matches({FLAT}, '\bnon disponibili\b|\bn\.?d\.?(?:$|[^a-z0-9])|\d'))))"""
#: Lines of clippings are put into the first lines of pages, so that every rule has something to find.
STAMPS = ("Data Stampa 1234", "uso esclusivo del cliente", "da pag. 12 foglio 2/3", "foglio 1", "12/03/2024", "Tiratura: 15000", "Quotidiano - Dir. Resp.: Mario Rossi", "© Riproduzione riservata", "Pubblicità")
STAMPED = REGIONS + ", stamped AS (SELECT * REPLACE (CASE WHEN region_ord < 3 AND (pdf_page + region_ord) % 4 = 0 THEN [" + ", ".join(f"'{s}'" for s in STAMPS) + f"][1 + (pdf_page + region_ord) % {len(STAMPS)}] ELSE text END AS text) FROM regions)"


def stamped(spark, sf):
    """The regions with clipping lines put in."""
    at = F.col("pdf_page") + F.col("region_ord")
    line = F.element_at(F.array(*map(F.lit, STAMPS)), (1 + at % len(STAMPS)).cast("int"))
    return src.regions(spark, sf).withColumn("text", F.when((F.col("region_ord") < 3) & (at % 4 == 0), line).otherwise(F.col("text")))


STRONG = rf"(length(trim(text)) <= 120 AND regexp_matches(lower(trim(text)), '^data\s+stampa(?:$|[^\p{{L}}\p{{N}}_])'))"
WEAK = f"(length(trim(text)) <= 200 AND (contains({LOW}, 'uso esclusivo') OR contains({LOW}, 'cliente che lo riceve')))"
TECHNICAL = STAMPED + rf""", scored AS (SELECT *, CASE WHEN {STRONG} THEN 0.70 ELSE 0 END + CASE WHEN {WEAK} THEN 0.30 ELSE 0 END + CASE WHEN x0 / 600 <= 0.06 OR x1 / 600 >= 0.94 OR y0 / 1400 <= 0.10 OR y1 / 1400 >= 0.90 THEN 0.09 ELSE 0 END
    - CASE WHEN {N_WORDS.replace('text', 'trim(text)')} >= 18 OR length(trim(text)) > 200 THEN 0.35 ELSE 0 END - CASE WHEN region_ord = 0 THEN 0.25 ELSE 0 END AS score, {NOTICE} AS n FROM stamped),
  technical AS (SELECT *, CASE WHEN {flag('rights')} AND {MARKER} IS NOT NULL THEN 'rights_notice' WHEN ({STRONG} OR {WEAK}) AND round(score, 4) >= 0.65 THEN 'watermark' WHEN {flag('ad')} THEN 'advertisement' END AS reason FROM scored)"""


@query(f"WITH {TECHNICAL} SELECT document_id, coalesce(reason, 'none') AS reason, CAST(round(score, 4) AS DOUBLE) AS watermark_score, count(*) AS n FROM technical GROUP BY 1, 2, 3")
def q82_technical_types(spark, sf):
    """Rights notices, watermarks and adverts by the technical classifier, with watermark scores."""
    r = classify.technical(stamped(spark, sf))
    return r.groupBy("document_id", F.coalesce("technical_reason", F.lit("none")).alias("reason"), "watermark_score").agg(F.count("*").alias("n"))


SEED = rf"""CASE WHEN CAST(contains({LOW}, 'da pag') AS INT) + CAST({HAS['foglio']} AS INT) + CAST({HAS_DATE} AS INT) >= 2 THEN 'composite_clipping_metadata' WHEN contains({LOW}, 'da pag') THEN 'original_page_marker' WHEN {HAS['foglio']} THEN 'clipping_sheet_marker'
  WHEN {HAS_DATE} AND length(text) <= 40 THEN 'short_date_marker' WHEN {AUDIENCE} THEN 'audience_metadata_marker' END"""
SEEDS = TECHNICAL + f", seeds AS (SELECT *, CASE WHEN reason IS NULL AND text <> '' THEN {SEED} END AS seed FROM technical)"


@query(f"WITH {SEEDS} SELECT document_id, coalesce(seed, 'none') AS reason, count(*) AS n, count_if(reason IS NOT NULL OR seed IS NOT NULL) AS excluded FROM seeds GROUP BY 1, 2")
def q83_metadata_seeds(spark, sf):
    """Metadata of clippings by marker, after the technical classifier."""
    r = classify.metadata_seeds(classify.technical(stamped(spark, sf)))
    return r.groupBy("document_id", F.coalesce("seed_reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"), F.count_if("excluded").alias("excluded"))


MARKS = " OR ".join(f"contains({LOW}, '{m}')" for m in classify.ZONE_MARKERS)
ZONES = SEEDS + f""", zone AS (SELECT document_id, pdf_page, least(max(y1) + 10, 0.18 * 1400) AS bottom FROM seeds WHERE seed IS NOT NULL AND y0 <= 0.18 * 1400 GROUP BY 1, 2),
  zoned AS (SELECT s.*, bottom, CASE WHEN s.reason IS NULL AND y0 >= 0 AND y1 <= bottom THEN CASE WHEN seed IS NOT NULL THEN 'seed' WHEN {MARKS} THEN 'metadata_marker' ELSE 'unresolved_header_content' END END AS role FROM seeds s LEFT JOIN zone z USING (document_id, pdf_page))"""


@query(f"WITH {ZONES} SELECT document_id, pdf_page, CAST(max(bottom) AS DOUBLE) AS zone_bottom, count_if(coalesce(role, '') = 'seed') AS seeds, count_if(coalesce(role, '') = 'metadata_marker') AS markers, count_if(coalesce(role, '') = 'unresolved_header_content') AS unresolved FROM zoned GROUP BY 1, 2")
def q84_header_zone_roles(spark, sf):
    """The header zone of each page and the roles of what lies in it."""
    r = classify.header_zone(classify.metadata_seeds(classify.technical(stamped(spark, sf))))
    role = lambda name: F.count_if(F.coalesce(F.col("zone_role") == name, F.lit(False)))
    return r.groupBy(*DOC).agg(F.max("zone_bottom").alias("zone_bottom"), role("seed").alias("seeds"), role("metadata_marker").alias("markers"), role("unresolved_header_content").alias("unresolved"))


VETO = f"""CASE WHEN reason IS NOT NULL OR seed IS NOT NULL OR role IS NOT NULL THEN 'protected_or_boilerplate' WHEN text = '' OR region_ord = 0 OR {N_WORDS} < 18 THEN 'insufficient_text_or_label'
  WHEN {URL} OR {flag('navigation')} OR {flag('newsletter')} OR {flag('share')} OR {flag('ad')} OR {flag('rights')} OR {flag('watermark')} THEN 'navigation_or_technical_marker' WHEN {HAS['foglio']} OR contains({LOW}, 'da pag') OR {AUDIENCE} THEN 'clipping_metadata_marker'
  WHEN {INDEX_LIKE} THEN 'index_entry_marker' WHEN {UPPER} > 0.85 THEN 'mostly_uppercase' END"""
KINDS = ZONES + f""", vetoed AS (SELECT *, {VETO} AS veto FROM zoned), typed AS (SELECT *, CASE WHEN reason IS NOT NULL OR seed IS NOT NULL OR role IS NOT NULL THEN 'fixed' WHEN {flag('navigation')} OR ({URL} AND {N_WORDS} <= 8) THEN 'navigation' WHEN {flag('related')} OR {flag('newsletter')} OR {flag('share')} THEN 'related_content'
  WHEN veto IS NULL THEN 'article_body' ELSE 'unknown' END AS kind FROM vetoed)"""


@query(f"WITH {KINDS} SELECT document_id, kind, coalesce(veto, 'none') AS veto, count(*) AS n FROM typed GROUP BY 1, 2, 3")
def q85_body_seeds(spark, sf):
    """Body seeds, navigation and related content by the semantic classifier, with the vetoes."""
    r = classify.semantic(classify.header_zone(classify.metadata_seeds(classify.technical(stamped(spark, sf)))))
    fixed = F.col("excluded") | F.col("in_zone")
    return r.groupBy("document_id", F.when(fixed, "fixed").otherwise(F.col("type")).alias("kind"), F.coalesce("seed_veto", F.lit("none")).alias("veto")).agg(F.count("*").alias("n"))


@query(f"WITH {KINDS} SELECT document_id, pdf_page, count_if(kind <> 'fixed') AS usable, count_if(kind = 'article_body' AND trim(text) <> '') AS open_bodies, count_if(reason IS NULL AND seed IS NULL AND coalesce(role, '') NOT IN ('metadata_marker', 'unresolved_header_content')) AS editorial FROM typed GROUP BY 1, 2")
def q86_eligibility(spark, sf):
    """Regions that later steps may use, bodies without an owner and editorial regions of each page."""
    r = classify.semantic(classify.header_zone(classify.metadata_seeds(classify.technical(stamped(spark, sf))))).withColumn("article_id", F.lit(None).cast("string"))
    return r.groupBy(*DOC).agg(F.count_if(classify.usable()).alias("usable"), F.count_if(classify.open_body() & (F.trim("text") != "")).alias("open_bodies"), F.count_if(classify.editorial()).alias("editorial"))


TURNS = "t AS (SELECT conv_id, turn, CASE WHEN length(text) % 7 = 0 THEN 'web' WHEN length(text) % 5 = 0 THEN 'press_clipping' ELSE 'unknown' END AS pt, CASE WHEN length(text) % 3 = 0 THEN 'A' WHEN length(text) % 3 = 1 THEN 'B' END AS sec, length(text) > 40 AS sup, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations), n AS (SELECT *, lead(pt) OVER w AS npt, lead(turn) OVER w AS nt, lead(sec) OVER w AS nsec FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"


@query(f"""WITH RECURSIVE {TURNS}, c AS (SELECT n.*, CASE WHEN pt = 'unknown' AND sup AND nt = turn + 1 AND npt = 'web' AND (coalesce(sec, '') = coalesce(nsec, '') OR sec IS NULL OR nsec IS NULL) THEN 'web' ELSE pt END AS got FROM n WHERE rn = 1
  UNION ALL SELECT n.*, CASE WHEN n.pt = 'unknown' AND n.sup AND ((n.turn = c.turn + 1 AND c.got = 'web' AND (coalesce(n.sec, '') = coalesce(c.sec, '') OR n.sec IS NULL OR c.sec IS NULL)) OR (n.nt = n.turn + 1 AND n.npt = 'web' AND (coalesce(n.sec, '') = coalesce(n.nsec, '') OR n.sec IS NULL OR n.nsec IS NULL))) THEN 'web' ELSE n.pt END
    FROM c JOIN n ON n.conv_id = c.conv_id AND n.rn = c.rn + 1)
  SELECT conv_id AS document_id, turn AS pdf_page, got AS page_type FROM c""")
def q87_page_refinement(spark, sf):
    """Unknown pages next to web pages of their section become web pages, one after the other (turns stand for pages)."""
    n = F.length("text")
    pages = src.read(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("pdf_page"), F.when(n % 7 == 0, "web").when(n % 5 == 0, "press_clipping").otherwise("unknown").alias("page_type"), F.when(n % 3 == 0, "A").when(n % 3 == 1, "B").alias("section"), F.lit(0).alias("clipping_markers"), F.lit(False).alias("index_like"), (n > 40).alias("supported"))
    return classify.refined_pages(pages).select("document_id", "pdf_page", "page_type")


@query(f"""WITH {LINES}, l AS (SELECT document_id, pdf_page, CASE trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) WHEN 'stampa locale' THEN 'STAMPA_LOCALE' WHEN 'stampa nazionale' THEN 'STAMPA_NAZIONALE' WHEN 'web' THEN 'WEB' WHEN 'radio' THEN 'RADIO' WHEN 'tv' THEN 'TV' WHEN 'televisione' THEN 'TELEVISIONE' END AS s
  FROM (SELECT document_id, pdf_page, CASE WHEN region_ord = 0 THEN ['Stampa  locale', 'WEB', 'x'][1 + pdf_page % 3] WHEN region_ord = 1 AND pdf_page % 5 = 0 THEN 'tv' ELSE text END AS text FROM lines)) SELECT document_id, pdf_page, CASE WHEN count(DISTINCT s) = 1 THEN max(s) END AS section FROM l GROUP BY 1, 2""")
def q88_sections(spark, sf):
    """The section of a page if its labels agree."""
    label = F.element_at(F.array(F.lit("Stampa  locale"), F.lit("WEB"), F.lit("x")), (1 + F.col("pdf_page") % 3).cast("int"))
    r = src.regions(spark, sf).withColumn("text", F.when(F.col("region_ord") == 0, label).when((F.col("region_ord") == 1) & (F.col("pdf_page") % 5 == 0), "tv").otherwise(F.col("text")))
    return classify.sections(r.withColumn("type", F.lit("footer")))


COVERS = r"""cover AS (SELECT item_id // 4 AS doc, item_id % 4 AS k, item_id, regexp_replace(trim(text), '\s+', ' ', 'g') AS title FROM benchmark WHERE length(trim(text)) >= 8)"""


@query(rf"""WITH {COVERS}, r AS (SELECT 'd' || CAST(doc AS VARCHAR) AS document_id, k, item_id, title FROM cover WHERE doc % 3 <> 2)
  SELECT document_id || ':layout_index:p1:row' || CAST(row_number() OVER (PARTITION BY document_id ORDER BY k) - 1 AS VARCHAR) AS id, document_id, '2024-03-' || lpad(CAST(1 + item_id % 28 AS VARCHAR), 2, '0') AS publication_date, 'Gazzetta ' || CAST(item_id % 3 AS VARCHAR) AS source, 1 + item_id % 40 AS original_page, length(title) AS title_chars, 1 + item_id % 50 AS review_start_page
  FROM r WHERE NOT (item_id % 6 = 5)""")
def q89_layout_index(spark, sf):
    """Index rows read from the boxes of a cover (four passages make one; a third of the covers has no heading)."""
    k = F.col("item_id")
    title = F.regexp_replace(F.trim("text"), r"\s+", " ")
    b = src.read(spark, sf, "benchmark").filter(F.length(F.trim("text")) >= 8).select(F.floor(k / 4).alias("doc"), (k % 4).alias("k"), "item_id", title.alias("title"))
    cell = lambda x, t: F.struct(F.lit(float(x)).alias("x0"), t.alias("text"))
    date = F.concat(F.lpad((1 + k % 28).cast("string"), 2, "0"), F.lit("/03/"), F.when(k % 2 == 0, "24").otherwise("2024"), F.lit(" Gazzetta "), (k % 3).cast("string"))
    # every sixth row has two page numbers, so it isn't certain
    cells = F.array_compact(F.array(cell(40, date), cell(160, F.concat((1 + k % 40).cast("string"), F.lit(" "), "title")), cell(540, (1 + k % 50).cast("string")), F.when(k % 6 == 5, cell(550, F.lit("7")))))
    rows = b.select("doc", "k", F.posexplode(cells).alias("n", "c")).select("doc", (1 + F.col("k") * 10 + F.col("n")).alias("region_ord"), F.col("c.text").alias("text"), F.col("c.x0").alias("x0"), (100.0 + 30 * F.col("k") + F.col("n")).alias("y0"))
    head = b.select("doc").distinct().select("doc", F.lit(0).cast("long").alias("region_ord"), F.when(F.col("doc") % 3 != 2, "Rassegna del 01/03/2024").otherwise("Sommario").alias("text"), F.lit(40.0).alias("x0"), F.lit(20.0).alias("y0"))
    cover = head.unionByName(rows).select(F.concat(F.lit("d"), "doc").alias("document_id"), F.lit(1).cast("long").alias("pdf_page"), "region_ord", "text", "x0", "y0", (F.col("x0") + 20).alias("x1"), (F.col("y0") + 12).alias("y1"), F.lit(600.0).alias("page_width"))
    found = index_tables.layout_entries(cover)
    return found.select("id", "document_id", F.col("publication_date").cast("string").alias("publication_date"), "source", F.col("original_page").cast("long").alias("original_page"), F.length("title").cast("long").alias("title_chars"), F.col("review_start_page").cast("long").alias("review_start_page"))


@query(f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN DATE '2024-01-17' WHEN page_id % 3 = 1 THEN DATE '2024-01-18' END AS d, CASE WHEN page_id % 2 = 0 THEN 'Gazzetta' ELSE 'Mattino' END AS s, page_id % 4 AS pg, list_distinct({WORDS.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS a FROM pages),
  e AS (SELECT page_id AS eid, page_id // 5 AS g, DATE '2024-01-17' AS ed, 'gazzetta' AS es, page_id % 3 AS ep, list_distinct({WORDS.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS b FROM pages),
  j AS (SELECT page_id, eid, d, s, pg, ed, ep, CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END AS sim FROM p JOIN e ON page_id // 5 = g),
  x AS (SELECT *, round(least(1.0, 0.6 * sim + CASE WHEN d = ed THEN 0.15 ELSE 0 END + CASE WHEN s = 'Gazzetta' THEN 0.15 ELSE 0 END + CASE WHEN pg = ep THEN 0.10 ELSE 0 END), 4) AS score, (d IS NOT NULL AND d <> ed) OR pg <> ep OR sim < 0.68 AS contra, sim >= 0.5 AND coalesce(d = ed, false) AND s = 'Gazzetta' AND pg = ep AS backed FROM j),
  r AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(score) OVER w, 0) AS nxt FROM x WINDOW w AS (PARTITION BY page_id ORDER BY score DESC, 'e' || CAST(eid AS VARCHAR)))
  SELECT page_id AS pdf_page, 'e' || CAST(eid AS VARCHAR) AS entry_id, CAST(round(sim, 4) AS DOUBLE) AS similarity, CAST(score AS DOUBLE) AS score, CASE WHEN score < 0.72 THEN 'below_score' WHEN score - nxt < 0.10 - 1e-12 THEN 'ambiguous' WHEN contra AND NOT backed THEN 'contradicted' ELSE 'matched' END AS status FROM r WHERE rn = 1""")
def q90_index_match(spark, sf):
    """Headlines of pages against index entries of their document: evidence, contradictions, margin."""
    p = src.read(spark, sf, "pages")
    part = lambda tag: F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1)
    k = F.col("page_id")
    doc = F.floor(k / 5).cast("string")
    titles = p.select(doc.alias("document_id"), k.alias("pdf_page"), F.lit(0).alias("region_ord"), part("h1").alias("title"), F.when(k % 3 == 0, F.lit("2024-01-17")).when(k % 3 == 1, F.lit("2024-01-18")).cast("date").alias("publication_date"), F.when(k % 2 == 0, "Gazzetta").otherwise("Mattino").alias("source"), (k % 4).alias("original_page"))
    entries = p.select(doc.alias("document_id"), F.concat(F.lit("e"), k).alias("id"), part("title").alias("title"), F.lit("2024-01-17").cast("date").alias("publication_date"), F.lit("gazzetta").alias("source"), (k % 3).alias("original_page"), F.lit(-1).cast("long").alias("index_pdf_page"))
    words = lambda c: F.array_distinct(text.words(F.lower(c)))
    found = index_tables.match(titles, entries, similarity=lambda a, b: text.token_jaccard(words(b), words(a)))
    return found.select("pdf_page", "entry_id", "similarity", "score", "status")
