"""Queries of text shapes, index tables and page profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from layoutlake.functions import shapes, text
from layoutlake.operators import index_tables, profile
from layoutlake.plans.oracle import LINES, REGIONS, WORDS
from layoutlake.plans.queries import DOC, QUERIES as BASE
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _quoted(s: str) -> str:
    return s.replace("'", "''")


def _any(column: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, '{_quoted(p)}')" for p in patterns) + ")"


GLYPHS = "length(regexp_replace({c}, '[^-]', '', 'g'))"


@query(rf"""WITH {LINES}, t AS (SELECT document_id, pdf_page, text, trim(text) AS v, lower(trim(text)) AS l FROM lines), f AS (
  SELECT document_id, pdf_page, v = '' OR ({GLYPHS.format(c='v')} > 0 AND {GLYPHS.format(c='v')} >= length(regexp_replace(v, '[^A-Za-zà-ù0-9]', '', 'g'))) OR len(regexp_extract_all(v, '[A-Za-zà-ù]{{2,}}')) < 2 OR {_any('l', shapes.CHROME)} AS chrome,
    CASE WHEN regexp_matches(l, '{_quoted(shapes.ADVERT)}') THEN 'advertisement' WHEN regexp_matches(l, '{_quoted(shapes.RELATED)}') THEN 'related' END AS marker, regexp_matches(lower(text), '{_quoted(shapes.LINK)}') AS link FROM t)
  SELECT document_id, pdf_page, count_if(chrome) AS n_chrome, count_if(coalesce(marker, '') = 'advertisement') AS n_adverts, count_if(coalesce(marker, '') = 'related') AS n_related, count_if(link) AS n_links FROM f GROUP BY 1, 2""")
def q72_chrome_and_markers(spark, sf):
    """Lines of a page that belong to its frame, announce adverts or related articles, or are links."""
    t = F.col("text")
    f = src.lines(spark, sf).select(*DOC, shapes.chrome(t).alias("chrome"), shapes.marker_kind(t).alias("marker"), shapes.link_like(t).alias("link"))
    return f.groupBy(*DOC).agg(F.count_if("chrome").alias("n_chrome"), F.count_if(F.col("marker") == "advertisement").alias("n_adverts"), F.count_if(F.col("marker") == "related").alias("n_related"), F.count_if("link").alias("n_links"))


DAMAGED = "replace(replace(replace(replace(text, 'fi', 'ﬁ'), '''', '’'), 'en', 'e­n'), 'è', 'Ã¨')"
MENDED = r"""replace(regexp_replace(replace(nfc_normalize(replace(regexp_replace({c}, '(\p{{L}})[­​](\p{{L}})', '\1\2', 'g'), 'ﬁ', 'fi')), chr(160), ' '), 'Ã¨', 'è', 'g'), '’', '''')""".replace("\\u00ad", "­").replace("\\u200b", "​")


@query(f"""WITH d AS (SELECT doc_id, {DAMAGED} AS bad FROM documents), c AS (SELECT doc_id, replace(replace(replace(replace({MENDED.format(c='bad')}, '“', '"'), '”', '"'), '„', '"'), '‘', '''') AS good FROM d)
  SELECT doc_id, length(good) AS n_chars, md5(good) AS text_md5, contains(good, chr(65533)) OR regexp_matches(good, 'Ã.|â€') AS damaged FROM c""")
def q73_clean_characters(spark, sf):
    """Texts with ligatures, quotes, soft hyphens and damaged encodings put in are cleaned again."""
    bad = F.col("text")
    for plain, put in (("fi", "ﬁ"), ("'", "’"), ("en", "e­n"), ("è", "Ã¨")):
        bad = F.replace(bad, F.lit(plain), F.lit(put))
    clean, damaged = shapes.clean_characters(F.col("bad"))
    d = src.read(spark, sf, "documents").select("doc_id", bad.alias("bad")).select("doc_id", clean.alias("good"), damaged.alias("damaged"))
    return d.select("doc_id", F.length("good").cast("long").alias("n_chars"), F.md5("good").alias("text_md5"), "damaged")


@query(r"""WITH t AS (SELECT doc_id, replace(replace(text, ', ', ' ,'), '. ', '.') || ' (  x ) 1.5 a.b@c.it' AS bad FROM documents), h AS (SELECT doc_id, regexp_extract_all(bad, '""" + shapes.PROTECTED + r"""') AS held, regexp_replace(bad, '""" + shapes.PROTECTED + r"""', chr(57344), 'g') AS p FROM t),
  c AS (SELECT doc_id, held, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p, '[ \t]{2,}', ' ', 'g'), '\s+([,.;:!?])', '\1', 'g'), '([,;:!?])([^\s\d,;:!?"''»)\]])', '\1 \2', 'g'), '([a-zà-ÿ])\.([A-ZÀ-Ý])', '\1. \2', 'g'), '\(\s+', '(', 'g'), '\s+\)', ')', 'g'), chr(57344)) AS parts FROM h),
  j AS (SELECT doc_id, trim(array_to_string(list_transform(range(1, len(parts) + 1), lambda i: parts[i] || coalesce(held[i], '')), '')) AS good FROM c)
  SELECT doc_id, length(good) AS n_chars, md5(good) AS text_md5 FROM j""")
def q74_clean_punctuation(spark, sf):
    """Texts with displaced punctuation are put right, protected spans stay."""
    bad = F.concat(F.replace(F.replace("text", F.lit(", "), F.lit(" ,")), F.lit(". "), F.lit(".")), F.lit(" (  x ) 1.5 a.b@c.it"))
    d = src.read(spark, sf, "documents").select("doc_id", bad.alias("bad")).select("doc_id", shapes.clean_punctuation(F.col("bad")).alias("good"))
    return d.select("doc_id", F.length("good").cast("long").alias("n_chars"), F.md5("good").alias("text_md5"))


@query(rf"""WITH {LINES}, w AS (SELECT document_id, pdf_page, region_ord, text, {WORDS.format('text')} AS w FROM lines), a AS (SELECT document_id, pdf_page, list_distinct(flatten(list(w))) AS attested FROM w GROUP BY 1, 2),
  c AS (SELECT document_id, pdf_page, region_ord, rtrim(substring(text, 1, length(text) // 2)) || '-' AS l, ltrim(substring(text, length(text) // 2 + 1)) AS r FROM lines),
  s AS (SELECT *, regexp_extract(l, '(\p{{L}}{{2,}})([-‐­])$', 1) AS stem, regexp_extract(r, '^(\p{{L}}+)', 1) AS suffix FROM c),
  k AS (SELECT s.*, CASE WHEN stem <> '' AND regexp_matches(suffix, '^\p{{Ll}}') THEN CASE WHEN list_contains(attested, lower(stem || suffix)) THEN 'dehyphenated' ELSE 'hyphen_preserved' END ELSE 'spaced' END AS action FROM s JOIN a USING (document_id, pdf_page))
  SELECT document_id, pdf_page, action, count(*) AS n, CAST(sum(length(l) + length(r) + CASE action WHEN 'dehyphenated' THEN -1 WHEN 'hyphen_preserved' THEN 0 ELSE 1 END) AS BIGINT) AS n_chars FROM k GROUP BY 1, 2, 3""".replace("\\u2010", "‐").replace("\\u00ad", "­"))
def q75_dehyphenation(spark, sf):
    """Lines cut in their middle by a hyphen are joined again, by the words of their page."""
    lines = src.lines(spark, sf)
    attested = lines.groupBy(*DOC).agg(F.array_distinct(F.flatten(F.collect_list(text.words(F.lower("text"))))).alias("attested"))
    half = F.floor(F.length("text") / 2).cast("int")
    cut = lines.join(attested, DOC).select(*DOC, "attested", F.concat(F.rtrim(F.substring(F.col("text"), F.lit(1), half)), F.lit("-")).alias("l"), F.ltrim(F.substring(F.col("text"), half + 1, F.length("text"))).alias("r"))
    whole, action = shapes.joined(F.col("l"), F.col("r"), F.col("attested"))
    return cut.select(*DOC, whole.alias("whole"), action.alias("action")).groupBy(*DOC, "action").agg(F.count("*").alias("n"), F.sum(F.length("whole")).cast("long").alias("n_chars"))


PARTICLE_LIST = ", ".join(f"'{p}'" for p in shapes.PARTICLES)


@query(rf"""WITH {LINES}, b AS (SELECT document_id, text, trim(regexp_extract(text, '{shapes.BYLINE}', 1)) AS said FROM lines), n AS (SELECT *, CASE WHEN said <> '' THEN said ELSE trim(text) END AS name FROM b),
  t AS (SELECT *, list_filter(regexp_split_to_array(name, '\s+'), lambda t: t <> '') AS tokens FROM n), s AS (SELECT *, list_filter(tokens, lambda t: lower(t) NOT IN ({PARTICLE_LIST})) AS sig FROM t)
  SELECT document_id, count_if(said <> '') AS bylines, count_if(len(tokens) BETWEEN 2 AND 5 AND len(list_filter(tokens, lambda t: NOT regexp_matches(t, '^\p{{L}}+(?:[''’\-]\p{{L}}+)*$'))) = 0 AND len(sig) >= 2 AND len(list_filter(sig, lambda t: NOT regexp_matches(t, '^\p{{Lu}}'))) = 0) AS names, count_if(regexp_matches(trim(text), '{shapes.SIGNATURE}')) AS signatures FROM s GROUP BY 1""")
def q76_names(spark, sf):
    """Bylines, names and abbreviated signatures among the lines of each document."""
    name, said = shapes.byline(F.col("text"))
    return src.lines(spark, sf).groupBy("document_id").agg(F.count_if(said).alias("bylines"), F.count_if(shapes.name_like(name)).alias("names"), F.count_if(shapes.abbreviated_signature(F.col("text"))).alias("signatures"))


NAVIGATION_LIST = ", ".join(f"'{w}'" for w in shapes.NAVIGATION)


@query(rf"""WITH {REGIONS}, w AS (SELECT document_id, pdf_page, region_ord, y0 / page_height AS top, regexp_extract_all(lower(text), '\p{{L}}+') AS w, regexp_matches(lower(text), '{_quoted(shapes.ARTICLE_LINK)}') AS link FROM regions)
  SELECT document_id, pdf_page, count_if(link) AS article_links, count_if(NOT link AND top <= 0.45 AND len(w) BETWEEN 3 AND 18 AND len(list_filter(w, lambda x: x IN ({NAVIGATION_LIST}))) >= 3) AS navigation, count_if(top <= 0.45 AND len(w) BETWEEN 3 AND 18) AS tested FROM w GROUP BY 1, 2""")
def q77_web_chrome(spark, sf):
    """Links to articles and menus in the upper part of a page."""
    n, menu = shapes.navigation_words(F.col("text"))
    link, tested = F.lower("text").rlike(shapes.ARTICLE_LINK), (F.col("y0") / F.col("page_height") <= 0.45) & n.between(3, 18)
    return src.regions(spark, sf).groupBy(*DOC).agg(F.count_if(link).alias("article_links"), F.count_if(~link & tested & (menu >= 3)).alias("navigation"), F.count_if(tested).alias("tested"))


@query(f"""WITH {LINES}, w AS (SELECT document_id, pdf_page, region_ord, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w FROM lines), n AS (SELECT *, lag(w) OVER p AS b, lead(w) OVER p AS a FROM w WINDOW p AS (PARTITION BY document_id, pdf_page ORDER BY region_ord)),
  u AS (SELECT *, list_distinct(list_concat(a, b)) AS x FROM n WHERE a IS NOT NULL AND b IS NOT NULL)
  SELECT document_id, pdf_page, count(*) AS n, count_if(CASE WHEN len(w) > 0 AND len(x) > 0 THEN len(list_intersect(w, x)) / len(list_distinct(list_concat(w, x))) ELSE 0 END <= 0.08) AS alien FROM u GROUP BY 1, 2""")
def q78_lexical_sandwich(spark, sf):
    """Lines between two others by the words that they share with them."""
    w = Window.partitionBy(*DOC).orderBy("region_ord")
    n = src.lines(spark, sf).select(*DOC, "text", F.lag("text").over(w).alias("before"), F.lead("text").over(w).alias("after")).filter("before is not null and after is not null")
    return n.groupBy(*DOC).agg(F.count("*").alias("n"), F.count_if(shapes.lexical_similarity(F.col("text"), F.col("before"), F.col("after")) <= 0.08).alias("alien"))


@query(rf"""WITH p AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style).*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM pages)
  SELECT page_id, length(t) AS n_chars, regexp_matches(lower(substring(t, 1, {shapes.BLOCKED_CHARS})), '{_quoted(shapes.BLOCKED)}') AS blocked FROM p""")
def q79_paywall(spark, sf):
    """Pages whose visible text asks for a subscription."""
    html = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style).*?</(script|style)>", " "), r"<[^>]*>", " ")
    p = src.read(spark, sf, "pages").select("page_id", F.trim(F.regexp_replace(html, r"\s+", " ")).alias("t"))
    return p.select("page_id", F.length("t").cast("long").alias("n_chars"), shapes.blocked_page(F.col("t")).alias("blocked"))


MEDIA = """c AS (SELECT document_id, pdf_page, unnest(range(CAST(greatest(0, floor(32 * x0 / 600)) AS BIGINT), CAST(least(31, floor(32 * x1 / 600)) AS BIGINT) + 1)) AS gx, y0, y1 FROM regions WHERE length(text) < 20),
  d AS (SELECT document_id, pdf_page, gx, unnest(range(CAST(greatest(0, floor(32 * y0 / 1400)) AS BIGINT), CAST(least(31, floor(32 * y1 / 1400)) AS BIGINT) + 1)) AS gy FROM c), m AS (SELECT document_id, pdf_page, count(DISTINCT (gx, gy)) / 1024 AS coverage FROM d GROUP BY 1, 2)"""


@query(f"""WITH {REGIONS}, {MEDIA}, t AS (SELECT document_id, pdf_page, len({WORDS.format('text')}) AS n, y0 >= 0.16 * 1400 AND y1 <= 0.90 * 1400 AS body, length(text) < 20 AS media FROM regions),
  p AS (SELECT document_id, pdf_page, CAST(coalesce(sum(n) FILTER (WHERE NOT media), 0) AS BIGINT) AS words, CAST(coalesce(sum(n) FILTER (WHERE body AND NOT media), 0) AS BIGINT) AS body_words FROM t GROUP BY 1, 2)
  SELECT p.document_id, p.pdf_page, words, body_words, round(coalesce(coverage, 0), 6) AS image_coverage,
    CASE WHEN words = 0 AND coalesce(coverage, 0) >= 0.05 THEN 'no_pdf_text_with_significant_image' WHEN body_words < 30 AND coalesce(coverage, 0) >= 0.05 THEN 'sparse_body_text_with_significant_image' WHEN body_words < 120 AND coalesce(coverage, 0) >= 0.12 THEN 'aggressive_ocr_low_native_body_coverage' ELSE 'native_text_sufficient_or_no_ocr_evidence' END AS reason
  FROM p LEFT JOIN m USING (document_id, pdf_page)""")
def q80_page_profile(spark, sf):
    """Words in the body band, image coverage (short lines stand for images) and the decision on OCR."""
    r = src.regions(spark, sf)
    media = F.length("text") < 20
    words = r.filter(~media).select(*DOC, F.size(text.words(F.lower("text"))).alias("n"), "y0", "y1", "page_height")
    boxes = r.filter(media).select(*DOC, "x0", "y0", "x1", "y1", "page_width", "page_height")
    return profile.profile(r.select(*DOC).distinct(), words, boxes, "aggressive").select(*DOC, "words", "body_words", F.round("image_coverage", 6).alias("image_coverage"), "reason")


INDEX_ROWS = r"""g AS (SELECT item_id, item_id // 5 AS tbl, item_id % 5 AS row_number, trim(lpad(CAST(1 + item_id % 31 AS VARCHAR), 2, '0') || '/' || lpad(CAST(1 + item_id % 13 AS VARCHAR), 2, '0') || CASE WHEN item_id % 2 = 0 THEN '/2024' ELSE '/24' END) AS c0,
    CASE WHEN item_id % 7 = 0 THEN '' ELSE 'Source ' || CAST(item_id % 3 AS VARCHAR) END AS c1, CAST(1 + item_id % 40 AS VARCHAR) || ' ' || trim(regexp_replace(text, '\s+', ' ', 'g')) AS c2, CASE WHEN item_id % 4 = 0 THEN 'Rossi' ELSE '' END AS c3, CASE WHEN item_id % 11 = 0 THEN '0' ELSE CAST(item_id % 50 + 1 AS VARCHAR) END AS c4 FROM benchmark)"""


@query(rf"""WITH {INDEX_ROWS}, p AS (SELECT *, try_cast(strptime(split_part(c0, '/', 1) || '/' || split_part(c0, '/', 2) || '/' || CASE WHEN length(split_part(c0, '/', 3)) = 2 THEN '20' ELSE '' END || split_part(c0, '/', 3), '%d/%m/%Y') AS DATE) AS d FROM (SELECT * FROM g WHERE CAST(split_part(c0, '/', 2) AS INT) <= 12 AND (try_strptime(split_part(c0, '/', 1) || '/' || split_part(c0, '/', 2) || '/2024', '%d/%m/%Y') IS NOT NULL))),
  v AS (SELECT *, regexp_extract(c2, '^\s*(\d{{1,4}})\s+(.+?)\s*$', 1) AS op, regexp_extract(c2, '^\s*(\d{{1,4}})\s+(.+?)\s*$', 2) AS title, count(*) OVER (PARTITION BY tbl) AS valid FROM p WHERE c1 <> '' AND c4 <> '0' AND length(trim(regexp_extract(c2, '^\s*(\d{{1,4}})\s+(.+?)\s*$', 2))) >= 8)
  SELECT 'doc:index:#/tables/' || CAST(tbl AS VARCHAR) || ':row=' || CAST(row_number AS VARCHAR) AS id, CAST(d AS VARCHAR) AS publication_date, c1 AS source, CAST(op AS BIGINT) AS original_page, length(title) AS title_chars, nullif(c3, '') AS author, CAST(c4 AS BIGINT) AS review_start_page FROM v WHERE valid >= 2""")
def q81_index_tables(spark, sf):
    """Rows of five-column index tables (five passages make a table) as index entries."""
    k = F.col("item_id")
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    row = F.array(
        F.concat(pad(1 + k % 31), F.lit("/"), pad(1 + k % 13), F.when(k % 2 == 0, "/2024").otherwise("/24")),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("Source "), (k % 3).cast("string"))),
        F.concat((1 + k % 40).cast("string"), F.lit(" "), F.trim(F.regexp_replace("text", r"\s+", " "))),
        F.when(k % 4 == 0, "Rossi").otherwise(""),
        F.when(k % 11 == 0, "0").otherwise((k % 50 + 1).cast("string")),
    )
    tables = src.read(spark, sf, "benchmark").groupBy(F.floor(k / 5).alias("t")).agg(F.sort_array(F.collect_list(F.struct((k % 5).alias("n"), row.alias("cells")))).alias("rows"))
    grid = F.transform("rows", lambda r: F.transform(r["cells"], lambda c: F.struct(c.alias("text"))))
    data = F.struct(F.lit(5).alias("num_cols"), grid.alias("grid"))
    table = F.struct(F.lit("document_index").alias("label"), F.concat(F.lit("#/tables/"), "t").alias("self_ref"), F.array(F.struct(F.lit(1).alias("page_no"))).alias("prov"), data.alias("data"))
    documents = tables.select(F.lit("doc").alias("document_id"), F.array(table).alias("tables"))
    found = index_tables.raw_entries(documents)
    return found.select("id", F.col("publication_date").cast("string").alias("publication_date"), "source", F.col("original_page").cast("long").alias("original_page"), F.length("title").cast("long").alias("title_chars"), "author", F.col("review_start_page").cast("long").alias("review_start_page"))


assert not set(QUERIES) & set(BASE)
