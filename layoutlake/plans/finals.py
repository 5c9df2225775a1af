"""Queries of drafts, records, audits and of titles and columns that belong together."""

from __future__ import annotations

from pyspark.sql import functions as F

from layoutlake.functions import text
from layoutlake.operators import finalize, stacks
from layoutlake.plans.layouts import TYPED, typed
from layoutlake.plans.oracle import REGIONS, WORDS, gap, overlap
from layoutlake.plans.queries import DOC
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}
ARTICLE = finalize.ARTICLE


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Turns as segments: two articles for each conversation, some turns are titles.
SEGMENTS = "segments AS (SELECT conv_id, 'a' || CAST(turn % 2 AS VARCHAR) AS article_id, turn, CASE WHEN turn < 2 OR length(text) % 11 = 0 THEN 'article_title' WHEN length(text) % 7 = 0 THEN 'caption' ELSE 'article_body' END AS type, text, (50 + length(text) % 50) / 100 AS confidence FROM conversations)"


def segments(spark, sf):
    n = F.length("text")
    return src.read(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.concat(F.lit("a"), (F.col("turn") % 2).cast("string")).alias("article_id"), F.col("turn").alias("pdf_page"), F.lit(0).alias("place"), F.when((F.col("turn") < 2) | (n % 11 == 0), "article_title").when(n % 7 == 0, "caption").otherwise("article_body").alias("type"), "text", ((50 + n % 50) / 100).alias("confidence"))


@query(rf"""WITH {SEGMENTS}, h AS (SELECT conv_id, article_id, turn, trim(text) AS t, array_to_string(regexp_extract_all(translate(lower(text), 'àáâãäåèéêëìíîïòóôõöùúûüýÿçñ', 'aaaaaaeeeeiiiiooooouuuuyycn'), '[\p{{L}}\p{{N}}_]+'), ' ') AS k FROM segments WHERE type = 'article_title'),
  d AS (SELECT conv_id, article_id, count(DISTINCT k) AS n_titles, arg_min(t, turn) AS title FROM h GROUP BY 1, 2), b AS (SELECT conv_id, article_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS body, count(*) AS n_parts, round(avg(confidence), 6) AS reading FROM segments WHERE type = 'article_body' GROUP BY 1, 2), a AS (SELECT conv_id, article_id, count(DISTINCT turn) AS n_pages FROM segments GROUP BY 1, 2)
  SELECT a.conv_id AS document_id, a.article_id, title, coalesce(n_titles, 0) AS n_titles, md5(coalesce(body, '')) AS body_md5, coalesce(n_parts, 0) AS n_parts, coalesce(length(body), 0) AS last_end, n_pages, reading, concat_ws(';', CASE WHEN n_titles IS NULL THEN 'no_title' END, CASE WHEN n_titles > 1 THEN 'several_titles' END, CASE WHEN n_parts IS NULL THEN 'no_body' END) AS warnings, n_parts IS NULL AS skipped
  FROM a LEFT JOIN d USING (conv_id, article_id) LEFT JOIN b USING (conv_id, article_id)""")
def q106_drafts(spark, sf):
    """Drafts: titles once each, bodies joined with their spans, warnings, skipped groups."""
    d = finalize.drafts(segments(spark, sf))
    end = F.coalesce(F.try_element_at("spans", F.lit(-1))["end"], F.lit(0))
    return d.select(*ARTICLE, "title", F.size("titles").cast("long").alias("n_titles"), F.md5("body").alias("body_md5"), F.col("n_parts").cast("long").alias("n_parts"), end.cast("long").alias("last_end"), F.size("pages").cast("long").alias("n_pages"), F.round("reading", 6).alias("reading"), F.array_join("warnings", ";").alias("warnings"), "skipped")


@query("""SELECT l_orderkey AS document_id, 'a' || CAST(l_linenumber % 2 AS VARCHAR) AS article_id, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag) END AS source, CASE WHEN count(DISTINCT year(l_shipdate)) = 1 THEN max(year(l_shipdate)) END AS date, concat_ws(';', CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'Conflicting source' END, CASE WHEN count(DISTINCT year(l_shipdate)) > 1 THEN 'Conflicting date' END) AS warnings FROM lineitem GROUP BY 1, 2""")
def q107_agreed_fields(spark, sf):
    """Fields on which all pages of an article agree, and warnings for the others (order lines stand for pages)."""
    m = src.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.concat(F.lit("a"), (F.col("l_linenumber") % 2).cast("string")).alias("article_id"), F.col("l_returnflag").alias("source"), F.year("l_shipdate").cast("long").alias("date"))
    return finalize.fields(m, ["source", "date"]).select(*ARTICLE, "source", "date", F.array_join("field_warnings", ";").alias("warnings"))


@query("""WITH r AS (SELECT l_orderkey AS d, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag) END AS source, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN max(l_linestatus) END AS category FROM lineitem GROUP BY 1), e AS (SELECT o_orderkey AS d, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS es, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS ec FROM orders)
  SELECT r.d AS document_id, coalesce(source, es) AS source, coalesce(category, ec) AS category, CASE WHEN source IS NOT NULL THEN 'pages' WHEN es IS NOT NULL THEN 'review_index' END AS source_origin, CASE WHEN category IS NOT NULL THEN 'pages' WHEN ec IS NOT NULL THEN 'review_index' END AS category_origin FROM r LEFT JOIN e ON r.d = e.d""")
def q108_index_priors(spark, sf):
    """Fields that pages leave open come from the index entry that matches best."""
    key = [F.lit("a").alias("article_id")]
    li = src.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), *key, F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("category"))
    o = src.read(spark, sf, "orders").select(F.col("o_orderkey").alias("document_id"), *key, F.lit("e").alias("entry_id"), F.lit(0.9).alias("score"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("source"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")).alias("category"))
    out = finalize.with_priors(finalize.fields(li, ["source", "category"]), o, ["source", "category"])
    return out.select("document_id", "source", "category", F.col("field_origins")["source"].alias("source_origin"), F.col("field_origins")["category"].alias("category_origin"))


MEASURES = """m AS (SELECT o_orderkey AS d, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) * 20 AS assigned, CAST(sum(CASE WHEN l_linenumber > 4 THEN l_quantity ELSE 0 END) AS BIGINT) * 4 AS unassigned, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) * 3 AS unresolved, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) * 15 AS unmapped, max(l_linenumber) AS lines, avg(l_discount) AS disc, any_value(o_orderstatus) AS st, any_value(o_custkey) AS ck FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)"""


@query(rf"""WITH {MEASURES}, c AS (SELECT *, assigned / nullif(assigned + unassigned + unresolved + unmapped, 0) AS cov, d % 3 = 0 AS ocr, CASE WHEN d % 6 = 0 THEN 0.90 WHEN d % 9 = 0 THEN 0.93 WHEN d % 15 <> 0 THEN 0.95 END AS ret, d % 9 = 0 AS all_ocr FROM m),
  x AS (SELECT *, concat_ws(';', CASE WHEN cov < 0.90 THEN 'low_body_coverage' END, CASE WHEN unassigned > greatest(150, 0.1 * assigned) THEN 'unassigned_body_text' END, CASE WHEN unmapped > greatest(100, 0.1 * assigned) THEN 'unmapped_text' END, CASE WHEN unresolved > greatest(200, 0.1 * assigned) THEN 'unresolved_editorial_text' END, CASE WHEN ocr AND ret < CASE WHEN all_ocr THEN 0.92 ELSE 0.94 END THEN 'low_ocr_retention' END) AS reasons FROM c),
  y AS (SELECT *, CASE WHEN cov IS NULL OR (ocr AND ret IS NULL) THEN 'unknown' WHEN reasons <> '' THEN 'incomplete' ELSE 'complete' END AS status, round(greatest(0.7 * (0.6 + lines / 20) + 0.3 * 0.8 - CASE WHEN d % 5 = 0 THEN 0.15 ELSE 0 END, 0.0), 4) AS conf FROM x)
  SELECT d AS document_id, round(cov, 6) AS coverage, reasons, status, CAST(conf AS DOUBLE) AS confidence, CASE WHEN coalesce(d % 4 <> 0 AND n > 1 AND d % 7 <> 0 AND d % 5 <> 0 AND st <> 'P' AND conf >= 0.65 AND ck % 10 <> 0 AND status = 'complete', false) THEN 'ready' ELSE 'review_required' END AS finalization FROM y""")
def q109_readiness(spark, sf):
    """Coverage, reasons, confidence and readiness of records (orders stand for records)."""
    j = src.read(spark, sf, "orders").join(src.read(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    total = lambda c: F.sum(c).cast("long")
    m = j.groupBy(F.col("o_orderkey").alias("d")).agg(
        F.count("*").alias("n"), (total("l_quantity") * 20).alias("assigned"), (total(F.when(F.col("l_linenumber") > 4, F.col("l_quantity")).otherwise(0)) * 4).alias("unassigned"), (total(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)) * 3).alias("unresolved"),
        (total(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)) * 15).alias("unmapped"), F.max("l_linenumber").alias("lines"), F.first("o_orderstatus").alias("st"), F.first("o_custkey").alias("ck"),
    )
    d = F.col("d")
    retention = F.when(d % 6 == 0, 0.90).when(d % 9 == 0, 0.93).when(d % 15 != 0, 0.95)
    coverage, reasons, status = finalize.completeness(F.col("assigned"), F.col("unassigned"), F.col("unresolved"), F.col("unmapped"), d % 3 == 0, retention, d % 9 == 0)
    m = m.withColumns({"coverage": coverage, "reasons": reasons, "status": status})
    m = m.withColumn("confidence", finalize.confidence(0.6 + F.col("lines") / 20, F.lit(0.8), F.when(d % 5 == 0, 1).otherwise(0)))
    warnings = F.array_compact(F.array(F.when(F.col("st") == "P", "Conflicting source")))
    done = finalize.ready(F.when(d % 4 != 0, "t"), F.when(F.col("n") > 1, "b"), d % 7 == 0, F.when(d % 5 == 0, 1).otherwise(0), warnings, F.col("confidence"), F.when(F.col("ck") % 10 != 0, "s"), F.lit("d"), F.col("status"))
    return m.select(d.alias("document_id"), F.round("coverage", 6).alias("coverage"), F.array_join("reasons", ";").alias("reasons"), "status", "confidence", done.alias("finalization"))


@query("""WITH r AS (SELECT source AS d, count(*) AS n_records, count_if(coalesce(quality, 0) = 1) AS n_ready, round(avg(least(1.0, n_chars / 2000)), 4) AS coverage, count_if(length(trim(string_split(text, chr(10))[1])) < 20) AS untitled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1), o AS (SELECT source AS d, count(*) AS orphan_pages, CAST(sum(n_chars) AS BIGINT) AS orphan_chars FROM documents WHERE n_chars < 300 GROUP BY 1),
  k AS (SELECT source AS d, count_if(n_chars % 5 = 0) AS open_links FROM documents GROUP BY 1), e AS (SELECT 'src' || CAST(item_id % 25 AS VARCHAR) AS d, count_if(item_id % 3 = 0) AS unmatched_entries FROM benchmark GROUP BY 1)
  SELECT document_id, n_records, n_ready, coverage, untitled, orphan_pages, orphan_chars, open_links, unmatched_entries, concat_ws(';', CASE WHEN orphan_chars > 0 THEN 'orphan_text' END, CASE WHEN open_links > 0 THEN 'open_links' END, CASE WHEN unmatched_entries > 0 THEN 'unmatched_entries' END, CASE WHEN untitled > 0 THEN 'untitled_records' END) AS warnings
  FROM (SELECT coalesce(r.d, o.d, k.d, e.d) AS document_id, coalesce(n_records, 0) AS n_records, coalesce(n_ready, 0) AS n_ready, coalesce(coverage, 0) AS coverage, coalesce(untitled, 0) AS untitled, coalesce(orphan_pages, 0) AS orphan_pages, coalesce(orphan_chars, 0) AS orphan_chars, coalesce(open_links, 0) AS open_links, coalesce(unmatched_entries, 0) AS unmatched_entries FROM r FULL JOIN o ON r.d = o.d FULL JOIN k ON coalesce(r.d, o.d) = k.d FULL JOIN e ON coalesce(r.d, o.d, k.d) = e.d)""")
def q110_document_audit(spark, sf):
    """Audit of each document: records, coverage, orphans, open links, unmatched entries, warnings."""
    docs = src.read(spark, sf, "documents").withColumnRenamed("source", "document_id")
    labels = src.read(spark, sf, "labels").select("doc_id", "quality")
    title = F.split("text", "\n")[0]
    records = docs.join(labels, "doc_id", "left").select("document_id", F.when(F.coalesce("quality", F.lit(0)) == 1, "ready").otherwise("review_required").alias("status"), F.least(F.lit(1.0), F.col("n_chars") / 2000).alias("coverage"), F.when(F.length(F.trim(title)) >= 20, title).alias("title"))
    orphans = docs.filter("n_chars < 300").select("document_id", F.col("doc_id").alias("pdf_page"), F.col("n_chars").alias("chars"))
    links = docs.select("document_id", F.when(F.col("n_chars") % 5 == 0, "candidate").otherwise("accepted").alias("status"))
    entries = src.read(spark, sf, "benchmark").select(F.concat(F.lit("src"), (F.col("item_id") % 25).cast("string")).alias("document_id"), F.col("item_id").alias("id"), (F.col("item_id") % 3 != 0).alias("matched"))
    return finalize.audit(records, orphans, links, entries).withColumn("warnings", F.array_join("warnings", ";"))


@query(r"""WITH r AS (SELECT doc_id AS d, text AS body, CASE WHEN doc_id % 4 <> 0 THEN 'Title ' || CAST(doc_id AS VARCHAR) ELSE '  ' END AS title FROM documents), w AS (SELECT page_id AS d, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS wt, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS wb FROM pages), g AS (SELECT * FROM w WHERE length(wb) >= 650 AND len(string_split(wb, ' ')) >= 90)
  SELECT r.d AS document_id, coalesce(nullif(trim(title), ''), wt) AS title, md5(coalesce(wb, body)) AS body_md5, CASE WHEN wb IS NOT NULL THEN length(body) END AS printed_chars, CASE WHEN wb IS NOT NULL THEN 'review_required' ELSE 'ready' END AS status, CASE WHEN wb IS NOT NULL THEN 'web_html' ELSE 'pdf' END AS method FROM r LEFT JOIN g ON r.d = g.d""")
def q111_web_bodies(spark, sf):
    """Bodies from the web that pass the gate take the place of printed ones."""
    from layoutlake.plans.queries import q20_web_text_gate

    k = F.col("doc_id")
    records = src.read(spark, sf, "documents").select(k.alias("document_id"), F.lit("a").alias("article_id"), F.when(k % 4 != 0, F.concat(F.lit("Title "), k.cast("string"))).otherwise("  ").alias("title"), F.col("text").alias("body"), F.lit("ready").alias("status"))
    w = src.web_pages(spark, sf).select("page_id", F.col("title").alias("web_title"), F.trim(F.regexp_replace(F.regexp_replace("article", r"<[^>]*>", " "), r"[ \t\r\n]+", " ")).alias("web_body"))
    web = w.join(q20_web_text_gate(spark, sf).select("page_id", "reason"), "page_id").select(F.col("page_id").alias("document_id"), F.lit("a").alias("article_id"), "web_title", "web_body", "reason")
    return finalize.with_web_body(records, web).select("document_id", "title", F.md5("body").alias("body_md5"), F.length("body_printed").cast("long").alias("printed_chars"), "status", "method")


SHINGLED = "list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))"


RECORDS = "SELECT source AS d, doc_id AS pg, CAST(doc_id AS VARCHAR) || '{kind}' AS id, {anchor} AS anchor, CASE WHEN doc_id % 5 = 0 THEN 'one, two, three, four' WHEN doc_id % 2 = 0 THEN {title} ELSE 'Common headline here' END AS title, {body} AS body FROM documents"


@query(f"""WITH t AS ({RECORDS.format(kind='-web', anchor='true', title="'Another headline'", body="text")} UNION ALL {RECORDS.format(kind='-print', anchor='false', title="''", body="substring(text, length(text) // 2)")}), s AS (SELECT *, CASE WHEN len(w) >= 8 THEN {SHINGLED} ELSE [] END AS sh FROM (SELECT *, {WORDS.format('body')} AS w FROM t)),
  h AS (SELECT f.d, f.id AS fragment, a.id AS anchor, len(list_intersect(f.sh, a.sh)) / greatest(1, least(len(f.sh), len(a.sh))) AS overlap, abs(f.pg - a.pg) AS distance, f.title AS ft, a.title AS a_t FROM s f JOIN s a ON f.d = a.d AND NOT f.anchor AND a.anchor AND abs(f.pg - a.pg) <= 2 AND len(f.sh) >= 5 AND len(a.sh) > 0),
  g AS (SELECT * FROM h WHERE overlap >= 0.5 AND (trim(ft) = '' OR len(string_split(ft, ',')) >= 4 OR (trim(a_t) <> '' AND (contains(lower(ft), lower(a_t)) OR contains(lower(a_t), lower(ft)))))), b AS (SELECT *, row_number() OVER (PARTITION BY d, fragment ORDER BY anchor) AS rn FROM g)
  SELECT d AS document_id, fragment, anchor, round(overlap, 3) AS overlap, distance FROM b WHERE rn = 1""")
def q112_absorbed_fragments(spark, sf):
    """Printed fragments of articles whose web body is known (second halves of texts stand for fragments)."""
    docs, k = src.read(spark, sf, "documents"), F.col("doc_id")
    body = F.coalesce("text", F.lit(""))

    def records(kind, other, body, method):
        title = F.when(k % 5 == 0, "one, two, three, four").when(k % 2 == 0, other).otherwise("Common headline here")
        return docs.select(F.col("source").alias("document_id"), F.concat(k.cast("string"), F.lit(kind)).alias("article_id"), title.alias("title"), body.alias("body"), F.array(k).alias("pages"), F.lit(method).alias("method"), F.lit("web").alias("article_type"))

    half = F.substring(body, F.floor(F.length(body) / 2).cast("int"), F.length(body))
    r = records("-web", "Another headline", body, "web_html").unionByName(records("-print", "", half, "pdf"))
    return finalize.absorbed(r)


STACKED = REGIONS + """, k AS (SELECT *, CASE WHEN region_ord % 2 = 0 AND region_ord % 12 < 8 THEN 'article_title' WHEN region_ord % 2 = 0 THEN 'article_body' END AS type, CASE WHEN (region_ord // 2) % 5 = 1 THEN y1 + 14 ELSE y1 END AS yy1, CASE WHEN (region_ord // 2 + pdf_page) % 3 = 0 THEN 'e' END AS entry FROM regions)"""


@query(f"""WITH RECURSIVE {STACKED}, t AS (SELECT document_id, pdf_page, region_ord AS u, x0, y0, yy1 AS y1, x1, entry, lead(region_ord) OVER w AS l, lead(y0) OVER w AS ly0, lead(yy1) OVER w AS ly1, lead(entry) OVER w AS le, row_number() OVER w AS n FROM k WHERE type = 'article_title' WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY y0, region_ord)),
  s AS (SELECT t.*, CASE WHEN l IS NOT NULL AND y1 <= ly0 + 0.30 * greatest(ly1 - ly0, 1) AND greatest(0, ly0 - y1) <= 56 AND NOT EXISTS (SELECT 1 FROM k b WHERE b.type = 'article_body' AND b.document_id = t.document_id AND b.pdf_page = t.pdf_page AND b.y0 >= t.y1 AND b.yy1 <= t.ly0) THEN CASE WHEN entry IS NOT NULL AND le IS NULL THEN 'index_supported_upper_headline' WHEN le IS NOT NULL AND entry IS NULL THEN 'index_supported_lower_headline'
    WHEN ly1 - ly0 >= 1.65 * (y1 - y0) AND y1 - y0 <= 56 THEN 'short_upper_kicker' WHEN y1 - y0 >= 1.65 * (ly1 - ly0) AND ly1 - ly0 <= 140 THEN 'upper_prominent_lower_deck' END END AS reason FROM t),
  g AS (SELECT document_id, pdf_page, n, u, l, reason, reason IS NOT NULL AS taken FROM s WHERE n = 1 UNION ALL SELECT s.document_id, s.pdf_page, s.n, s.u, s.l, s.reason, s.reason IS NOT NULL AND NOT g.taken FROM g JOIN s ON s.document_id = g.document_id AND s.pdf_page = g.pdf_page AND s.n = g.n + 1)
  SELECT document_id, pdf_page, u AS upper, l AS lower, CASE WHEN reason IN ('index_supported_lower_headline', 'short_upper_kicker') THEN 'kicker' ELSE 'subtitle' END AS role, reason FROM g WHERE taken""")
def q113_header_stacks(spark, sf):
    """Titles right above each other: which is the headline and what the other is."""
    r = src.regions(spark, sf).filter("region_ord % 2 = 0")
    row = F.floor(F.col("region_ord") / 2)
    r = r.withColumns({"type": F.when(F.col("region_ord") % 12 < 8, "article_title").otherwise("article_body"), "y1": F.when(row % 5 == 1, F.col("y1") + 14).otherwise(F.col("y1")), "index_entry_id": F.when((row + F.col("pdf_page")) % 3 == 0, "e")})
    return stacks.header_stacks(r.filter("type = 'article_title'"), r.filter("type = 'article_body'")).select(*DOC, "upper", "lower", "role", "reason")


@query(rf"""WITH {REGIONS}, c AS (SELECT document_id, pdf_page, region_ord % 2 AS col, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, arg_max(text, region_ord) AS last_text, arg_min(text, region_ord) AS first_text FROM regions WHERE region_ord > 0 GROUP BY 1, 2, 3), p AS (SELECT l.*, r.x0 AS nx0, r.y0 AS ny0, r.x1 AS nx1, r.first_text AS nf FROM c l JOIN c r ON l.document_id = r.document_id AND l.pdf_page = r.pdf_page AND l.col = 0 AND r.col = 1),
  q AS (SELECT *, (nx0 - x1) / 600 AS g, abs((x1 - x0) - (nx1 - nx0)) / 600 AS dw, pdf_page % 4 = 0 AS same_src, pdf_page % 3 <> 0 AS style_known, greatest(0, least((y1 - 60) / greatest(300.0 - 60, 1), 1)) >= 0.70 AS done, ny0 >= hb AND (ny0 - hb) / 1400 <= 0.30 AS near FROM (SELECT *, CASE WHEN pdf_page % 5 <> 0 THEN 50 ELSE 78 END AS hb FROM p)),
  r AS (SELECT *, CASE WHEN NOT (g BETWEEN 0 AND 0.07) THEN 'columns_not_adjacent' WHEN dw > 0.12 THEN 'different_column_width' WHEN pdf_page % 7 = 0 THEN 'competing_title_in_target_column' WHEN pdf_page % 11 = 0 THEN 'target_column_has_other_article' WHEN ny0 < hb THEN 'target_starts_inside_title' WHEN NOT same_src AND NOT (done AND near) THEN 'insufficient_column_transition_evidence' END AS reason FROM q),
  s AS (SELECT *, CASE WHEN reason IS NULL THEN round(least(0.28 + 0.04 * greatest(0, 1 - dw / 0.12) + CASE WHEN same_src THEN 0.32 ELSE 0 END + CASE WHEN done THEN 0.12 ELSE 0 END + CASE WHEN near THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(last_text, '\p{{L}}-$') AND regexp_matches(nf, '^\p{{Ll}}') THEN 0.12 WHEN NOT regexp_matches(last_text, '[.!?…:;]\s*$') AND regexp_matches(nf, '^\p{{Ll}}') THEN 0.08 ELSE 0 END + CASE WHEN style_known THEN 0.10 ELSE 0 END, 1.0), 4) ELSE 0.0 END AS score FROM r)
  SELECT document_id, pdf_page, CAST(score AS DOUBLE) AS score, reason, CASE WHEN score >= 0.70 THEN 'accepted' ELSE 'rejected' END AS status FROM s""")
def q114_column_steps(spark, sf):
    """Whether the left column of a page goes on in the right one."""
    r = src.regions(spark, sf).filter("region_ord > 0")
    page = F.col("pdf_page")
    c = r.groupBy(*DOC, (F.col("region_ord") % 2).alias("column")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max_by("text", "region_ord").alias("last_text"), F.min_by("text", "region_ord").alias("first_text"), F.first("page_width").alias("page_width"), F.first("page_height").alias("page_height"))
    c = c.withColumns({"article_id": F.lit("a"), "owners": F.when(page % 11 == 0, F.array(F.lit("b"))).otherwise(F.array().cast("array<string>")), "competing_title": page % 7 == 0, "style": F.when(page % 3 != 0, "serif"), "source_ref": F.when(page % 4 == 0, F.lit("#/texts/1")).otherwise(F.concat(F.lit("#/texts/"), F.col("column").cast("string"))), "header_bottom": F.when(page % 5 != 0, 50.0).otherwise(78.0), "top": F.lit(60.0), "bottom": F.lit(300.0), "has_match": F.lit(False)})
    return stacks.column_steps(c).select(*DOC, "score", "reason", "status")


@query(f"""WITH {TYPED}, t AS (SELECT *, 'a' || CAST(region_ord AS VARCHAR) AS aid, region_ord % 3 <> 0 AS matched, CASE WHEN region_ord % 4 = 1 THEN pdf_page + 1 WHEN region_ord % 4 = 2 THEN pdf_page END AS es, CASE WHEN region_ord % 5 = 0 THEN 3 WHEN region_ord % 5 = 1 THEN pdf_page % 9 END AS ep, pdf_page % 9 AS op FROM typed WHERE type = 'article_title'), b AS (SELECT * FROM typed WHERE type = 'article_body'),
  q AS (SELECT b.document_id, b.pdf_page, b.region_ord, t.region_ord AS title, t.aid, t.y0 AS ty0, b.y0 AS by0, b.x0 AS bx0, b.x1 AS bx1 FROM b JOIN t ON b.document_id = t.document_id AND b.pdf_page = t.pdf_page AND matched AND coalesce(b.pdf_page >= es, true) AND coalesce(ep = op, true) AND b.y0 >= t.y0 AND {overlap('b.', 't.')} >= 0.2),
  c AS (SELECT * FROM q WHERE NOT EXISTS (SELECT 1 FROM t o WHERE o.document_id = q.document_id AND o.pdf_page = q.pdf_page AND o.region_ord <> q.title AND o.y0 > ty0 AND o.y0 < by0 AND greatest(0, least(o.x1, bx1) - greatest(o.x0, bx0)) / least(o.x1 - o.x0, bx1 - bx0) >= 0.2))
  SELECT document_id, pdf_page, region_ord, CASE WHEN count(*) = 1 THEN max(aid) END AS article_id, CASE WHEN count(*) = 1 THEN 'assigned' ELSE 'ambiguous' END AS status FROM c GROUP BY 1, 2, 3""")
def q115_index_owners(spark, sf):
    """Open bodies that exactly one title with an index entry claims."""
    r = typed(spark, sf)
    o, page = F.col("region_ord"), F.col("pdf_page")
    t = r.filter("type = 'article_title'").withColumns({"article_id": F.concat(F.lit("a"), o.cast("string")), "matched": o % 3 != 0, "entry_start": F.when(o % 4 == 1, page + 1).when(o % 4 == 2, page), "entry_page": F.when(o % 5 == 0, F.lit(3)).when(o % 5 == 1, page % 9), "original_page": page % 9})
    return stacks.index_owners(r.filter("type = 'article_body'"), t)


NOTES = ("Pubblicità scopri https://a.it", "Leggi anche: il mercato", "sponsored content")
INTRUDED = REGIONS + ", noted AS (SELECT * REPLACE (CASE WHEN region_ord % 6 = 4 AND pdf_page % 2 = 0 THEN [" + ", ".join(f"'{n}'" for n in NOTES) + "][1 + (pdf_page + region_ord // 6) % 3] ELSE text END AS text) FROM regions)"


@query(rf"""WITH {INTRUDED}, k AS (SELECT *, CASE WHEN regexp_matches(trim(lower(text)), '(?:^|[^\p{{L}}\p{{N}}_])(?:pubblicità|pubblicita|sponsorizzato|sponsored|adv|advertisement)(?:$|[^\p{{L}}\p{{N}}_])') THEN 'advertisement' WHEN regexp_matches(trim(lower(text)), '^(?:leggi anche|articoli correlati|notizie correlate|approfondimenti|potrebbe interessarti|consigliati per te)(?:$|[^\p{{L}}\p{{N}}_])') THEN 'related' END AS kind, regexp_matches(lower(text), 'https?://|www\.|(?:^|\n)\s*(?:leggi|scopri|vai all''articolo)(?:$|[^\p{{L}}\p{{N}}_])|[→›]\s*$') AS link, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w, len({WORDS.format('text')}) AS n FROM noted),
  g AS (SELECT c.document_id, c.pdf_page, c.region_ord, any_value(c.kind) AS kind, any_value(c.link) AS link, any_value(c.w) AS w, any_value(c.n) AS n, min(struct_pack(d := c.y0 - b.y1, o := b.region_ord)) FILTER (WHERE c.y0 - b.y1 BETWEEN 0 AND 85) AS a, min(struct_pack(d := b.y0 - c.y1, o := b.region_ord)) FILTER (WHERE b.y0 - c.y1 BETWEEN 0 AND 85) AS z FROM k c JOIN k b ON c.document_id = b.document_id AND c.pdf_page = b.pdf_page AND b.region_ord <> c.region_ord AND c.kind IS NOT NULL AND b.region_ord % 6 <> 4 AND {overlap('b.', 'c.')} >= 0.45 GROUP BY 1, 2, 3),
  l AS (SELECT g.*, list_distinct(list_concat(ka.w, kz.w)) AS x FROM g JOIN k ka ON ka.document_id = g.document_id AND ka.pdf_page = g.pdf_page AND ka.region_ord = g.a.o JOIN k kz ON kz.document_id = g.document_id AND kz.pdf_page = g.pdf_page AND kz.region_ord = g.z.o),
  s AS (SELECT *, round(least(1.0, 0.18 + CASE WHEN kind = 'advertisement' THEN 0.70 ELSE 0.55 END + CASE WHEN link THEN 0.22 ELSE 0 END + CASE WHEN n <= 45 THEN 0.10 ELSE 0 END + CASE WHEN greatest(a.d, z.d) <= 42.5 THEN 0.08 ELSE 0 END + CASE WHEN CASE WHEN len(w) > 0 AND len(x) > 0 THEN len(list_intersect(w, x)) / len(list_distinct(list_concat(w, x))) ELSE 0 END <= 0.08 THEN 0.06 ELSE 0 END), 4) AS score FROM l)
  SELECT document_id, pdf_page, region_ord, kind, CAST(score AS DOUBLE) AS score, score >= 0.68 AS accepted FROM s""")
def q116_intrusions(spark, sf):
    """Adverts and links between two bodies of their lane (some lines are put in)."""
    o = F.col("region_ord")
    note = F.element_at(F.array(*map(F.lit, NOTES)), (1 + (F.col("pdf_page") + F.floor(o / 6)) % 3).cast("int"))
    r = src.regions(spark, sf).withColumn("text", F.when((o % 6 == 4) & (F.col("pdf_page") % 2 == 0), note).otherwise(F.col("text"))).withColumn("type", F.when(o % 6 == 4, "unknown").otherwise("article_body"))
    return stacks.intrusions(r)


MARKED = REGIONS + ", marked AS (SELECT * REPLACE (CASE WHEN region_ord = 1 AND pdf_page % 3 = 0 THEN 'Tiratura: 1000 Data Stampa ' || CAST(1000 + pdf_page % 8 AS VARCHAR) WHEN region_ord % 10 = 5 THEN text || ' data  stampa ' || CAST(1000 + (pdf_page + region_ord) % 8 AS VARCHAR) ELSE text END AS text) FROM regions)"


def _marked(spark, sf):
    o, page = F.col("region_ord"), F.col("pdf_page")
    said = F.when((o == 1) & (page % 3 == 0), F.concat(F.lit("Tiratura: 1000 Data Stampa "), (1000 + page % 8).cast("string"))).when(o % 10 == 5, F.concat("text", F.lit(" data  stampa "), (1000 + (page + o) % 8).cast("string"))).otherwise(F.col("text"))
    return src.regions(spark, sf).withColumn("text", said)


@query(rf"""WITH {MARKED}, e AS (SELECT document_id, pdf_page, region_ord, y1, unnest(list_distinct(regexp_extract_all(text, '(?i)data\s+stampa\s*(\d{{3,8}})', 1))) AS number, contains(lower(text), 'tiratura') OR contains(lower(text), 'diffusione') OR contains(lower(text), 'lettori') OR contains(lower(text), 'dir. resp') AS sheet FROM marked), p AS (SELECT document_id, number, count(DISTINCT pdf_page) AS pages FROM e GROUP BY 1, 2)
  SELECT o.document_id, o.pdf_page, o.region_ord, o.number, pages AS repeated_pages, EXISTS (SELECT 1 FROM e h WHERE h.document_id = o.document_id AND h.pdf_page = o.pdf_page AND h.number = o.number AND h.sheet AND h.region_ord <> o.region_ord AND h.y1 <= 0.18 * 1400) AS in_header FROM e o JOIN p ON p.document_id = o.document_id AND p.number = o.number WHERE NOT o.sheet""")
def q117_printed_marks(spark, sf):
    """Printed marks, the pages that repeat them and the technical sheets that back them."""
    return stacks.marks(_marked(spark, sf))


@query(rf"""WITH {MARKED} SELECT document_id, CAST(floor(x0 / 600 / 0.045) AS BIGINT) AS cx, CAST(floor(y0 / 1400 / 0.045) AS BIGINT) AS cy, count(*) AS n_marks, count(DISTINCT pdf_page) AS supporting_pages FROM marked WHERE regexp_matches(text, '(?i)data\s+stampa\s*(\d{{3,8}})') GROUP BY 1, 2, 3""")
def q118_mark_places(spark, sf):
    """Printed marks by place, with the pages that have one there."""
    return stacks.mark_cells(_marked(spark, sf))


@query(f"""WITH {TYPED}, b AS (SELECT *, CASE WHEN coalesce(x0 - lag(x0) OVER w > 0.05 * 600, true) THEN 1 ELSE 0 END AS s FROM typed WHERE type = 'article_body' WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY x0, region_ord)), c AS (SELECT *, sum(s) OVER (PARTITION BY document_id, pdf_page ORDER BY x0, region_ord ROWS UNBOUNDED PRECEDING) AS col FROM b),
  g AS (SELECT document_id, pdf_page, col, median(x0) AS l, median(x1) AS r, CAST(sum(len({WORDS.format('text')})) AS BIGINT) AS n, count(*) AS k FROM c GROUP BY 1, 2, 3), f AS (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page ORDER BY n DESC, col) AS rn FROM g)
  SELECT document_id, pdf_page, CAST(l AS DOUBLE) AS left_edge, CAST(r AS DOUBLE) AS right_edge, n AS n_words, k AS n_bodies FROM f WHERE rn = 1""")
def q119_main_columns(spark, sf):
    """The column of each page with most words."""
    return stacks.main_columns(typed(spark, sf).filter("type = 'article_body'"))


TOKENS = "regexp_extract_all(lower({}), '[a-zà-ÿ0-9]+')"


@query(rf"""WITH {TYPED}, f AS (SELECT document_id, pdf_page, {TOKENS.format('text')} AS slug FROM typed WHERE region_ord = 0), c AS (SELECT t.document_id, t.pdf_page, t.region_ord, t.text, slug, {TOKENS.format('t.text')} AS w, len(regexp_extract_all(lower(t.text), '[\p{{L}}\p{{N}}_]+')) AS n, (t.region_ord * 17) % 200 AS gap, 0.2 + (t.region_ord % 4) / 10 AS base FROM typed t JOIN f ON t.document_id = f.document_id AND t.pdf_page = f.pdf_page WHERE t.type = 'article_title'),
  v AS (SELECT *, CASE WHEN len(slug) >= 4 AND len(w) >= 4 THEN len(list_intersect(slug, w)) / greatest(len(list_distinct(slug)), 1) ELSE 0 END AS rec FROM c WHERE NOT (n <= 1 OR regexp_matches(lower(text), 'https?://|www\.') OR regexp_matches(text, '^\s*\d{{1,2}}[/-]') OR regexp_matches(text, '^\s*\p{{Lu}}\p{{L}}+\s+\p{{Lu}}\p{{L}}+\s*$'))),
  s AS (SELECT *, round(base + CASE WHEN n BETWEEN 3 AND 24 THEN 0.10 ELSE 0 END + CASE WHEN gap BETWEEN 0 AND 120 THEN 0.08 ELSE 0 END + CASE WHEN rec >= 0.52 THEN 0.65 * rec ELSE 0 END, 4) AS score FROM v), r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY score DESC, region_ord))
  SELECT document_id, pdf_page, region_ord, CAST(score AS DOUBLE) AS score, CAST(round(score - coalesce(nxt, 0), 6) AS DOUBLE) AS lead, CASE WHEN score < 0.55 THEN 'rejected' WHEN score - coalesce(nxt, 0) < 0.12 - 1e-12 THEN 'ambiguous' ELSE 'accepted' END AS status FROM r WHERE rn = 1""")
def q120_slug_titles(spark, sf):
    """Titles helped by their page's address (the first line stands for the address)."""
    r = typed(spark, sf)
    o = F.col("region_ord")
    c = r.filter("type = 'article_title'").select(*DOC, "region_ord", "text", ((o * 17) % 200).alias("gap"), (0.2 + (o % 4) / 10).alias("score"))
    return stacks.slug_titles(c, r.filter("region_ord = 0").select(*DOC, F.col("text").alias("slug")))
