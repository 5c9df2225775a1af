"""Queries of owners, web zones, identity, artefact names and batch metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from layoutlake.operators import membership, webzones
from layoutlake.plans.finals import MARKED, _marked
from layoutlake.plans.layouts import TYPED, typed
from layoutlake.plans.oracle import LINES, overlap
from layoutlake.plans.queries import DOC
from layoutlake.sources import artefacts
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""WITH RECURSIVE c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS col, CASE WHEN length(text) % 6 = 0 THEN 'a' || CAST(turn AS VARCHAR) END AS art, length(text) % 4 <> 1 AS step FROM conversations), r AS (SELECT conv_id, col, art AS got, art FROM c WHERE col = 1 UNION ALL SELECT c.conv_id, c.col, coalesce(c.art, CASE WHEN c.step THEN r.got END), c.art FROM r JOIN c ON c.conv_id = r.conv_id AND c.col = r.col + 1)
  SELECT conv_id AS document_id, col AS "column", got AS article_id, art IS NULL AND got IS NOT NULL AS inherited FROM r""")
def q121_spread_columns(spark, sf):
    """Owners that go on from column to column (turns stand for columns)."""
    n = F.length("text")
    c = src.read(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.lit(1).alias("pdf_page"), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("column"), F.when(n % 6 == 0, F.concat(F.lit("a"), F.col("turn").cast("string"))).alias("article_id"), (n % 4 != 1).alias("step"))
    return membership.spread_columns(c).select("document_id", "column", "article_id", "inherited")


@query(f"""WITH {TYPED}, b AS (SELECT *, region_ord % 2 AS col, CASE WHEN region_ord % 3 = 0 THEN 'a' || CAST(region_ord % 2 + CASE WHEN pdf_page % 5 = 0 AND region_ord % 4 < 2 THEN 7 ELSE 0 END AS VARCHAR) END AS art FROM typed WHERE type = 'article_body'), o AS (SELECT document_id, pdf_page, col, max(art) AS owner FROM b WHERE art IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT art) = 1),
  n AS (SELECT b.*, owner, CASE WHEN coalesce(y0 - lag(y1) OVER w BETWEEN -4 AND 24, false) THEN 0 ELSE 1 END AS nw FROM b JOIN o USING (document_id, pdf_page, col) WINDOW w AS (PARTITION BY document_id, pdf_page, col ORDER BY y0, region_ord)), r AS (SELECT *, sum(nw) OVER (PARTITION BY document_id, pdf_page, col ORDER BY y0, region_ord ROWS UNBOUNDED PRECEDING) AS run FROM n),
  f AS (SELECT *, bool_or(art IS NOT NULL) OVER (PARTITION BY document_id, pdf_page, col, run) AS owned FROM r) SELECT document_id, pdf_page, region_ord, owner AS article_id FROM f WHERE art IS NULL AND owned""")
def q122_filled_columns(spark, sf):
    """Open bodies next to those of the one article that owns their column."""
    o = F.col("region_ord")
    shift = F.when((F.col("pdf_page") % 5 == 0) & (o % 4 < 2), 7).otherwise(0)
    b = typed(spark, sf).filter("type = 'article_body'").withColumns({"column": o % 2, "article_id": F.when(o % 3 == 0, F.concat(F.lit("a"), (o % 2 + shift).cast("string")))})
    return membership.fill_columns(b)


@query("""WITH g AS (SELECT l_orderkey AS d, 'a' || CAST(l_linenumber AS VARCHAR) AS art, [l_linenumber % 3, (l_linenumber + 1) % 3] AS cols, (40 + CAST(l_quantity AS INT)) / 100 AS o, (l_suppkey % 20) / 100 AS gp, l_discount * 10 AS adj, l_returnflag = 'R' AS m, l_linestatus = 'O' AS st FROM lineitem),
  s AS (SELECT *, round(0.38 * o + 0.18 * (1 - gp / 0.15) + 0.18 * adj + CASE WHEN m THEN 0.14 ELSE 0 END + CASE WHEN st THEN 0.12 ELSE 0 END, 4) AS score FROM g WHERE o >= 0.45 AND gp BETWEEN 0 AND 0.15), a AS (SELECT DISTINCT * FROM s WHERE score >= 0.72), e AS (SELECT d, art, score, unnest(cols) AS col FROM a)
  SELECT d AS document_id, col AS "column", art AS article_id, CAST(score AS DOUBLE) AS score, CASE WHEN EXISTS (SELECT 1 FROM e x JOIN e y ON x.d = y.d AND x.col = y.col WHERE x.d = e.d AND x.art = e.art AND y.art <> x.art AND x.score - y.score < 0.12 - 1e-12) THEN 'ambiguous' ELSE 'accepted' END AS status FROM e""")
def q123_header_columns(spark, sf):
    """Proposals of column groups below headers that compete for columns (order lines stand for proposals)."""
    n = F.col("l_linenumber")
    g = src.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.lit(1).alias("pdf_page"), F.concat(F.lit("a"), n.cast("string")).alias("article_id"), F.array(n % 3, (n + 1) % 3).alias("columns"), ((40 + F.col("l_quantity").cast("int")) / 100).alias("overlap"), ((F.col("l_suppkey") % 20) / 100).alias("gap"), (F.col("l_discount") * 10).alias("adjacency"), (F.col("l_returnflag") == "R").alias("matched"), (F.col("l_linestatus") == "O").alias("styled")).distinct()
    return membership.bootstrap(g).select("document_id", "column", "article_id", "score", "status")


@query(f"""WITH {TYPED}, b AS (SELECT *, CASE WHEN coalesce(x0 - lag(x0) OVER w > 0.05 * 600, true) THEN 1 ELSE 0 END AS s FROM typed WHERE type = 'article_body' WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY x0, region_ord)), c AS (SELECT *, sum(s) OVER (PARTITION BY document_id, pdf_page ORDER BY x0, region_ord ROWS UNBOUNDED PRECEDING) AS col FROM b),
  g AS (SELECT document_id, pdf_page, col, median(x0) AS l, median(x1) AS r, sum(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'))) AS n FROM c GROUP BY 1, 2, 3), f AS (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page ORDER BY n DESC, col) AS rn FROM g)
  SELECT b.document_id, b.pdf_page, b.region_ord, CASE WHEN greatest(0, least(x1, r) - greatest(x0, l)) / greatest(least(x1 - x0, r - l), 1) >= 0.5 THEN 'main' ELSE 'non_main' END AS scope FROM b JOIN f ON b.document_id = f.document_id AND b.pdf_page = f.pdf_page AND rn = 1""")
def q124_main_content(spark, sf):
    """Bodies in and outside of the main column of their page."""
    return webzones.main_content(typed(spark, sf))


@query(f"""WITH RECURSIVE {TYPED}, b AS (SELECT document_id, pdf_page, region_ord, x0, y0, x1, y1 FROM typed WHERE type = 'article_body'), p AS (SELECT b.document_id, b.pdf_page, b.region_ord, arg_min(a.region_ord, (b.y0 - a.y1, a.region_ord)) AS prev FROM b JOIN b a ON a.document_id = b.document_id AND a.pdf_page = b.pdf_page AND a.region_ord <> b.region_ord AND b.y0 - a.y1 BETWEEN 0 AND 40 AND {overlap('b.', 'a.')} >= 0.55 GROUP BY 1, 2, 3),
  r AS (SELECT document_id, pdf_page, region_ord, region_ord AS run FROM b WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.document_id = b.document_id AND p.pdf_page = b.pdf_page AND p.region_ord = b.region_ord) UNION ALL SELECT p.document_id, p.pdf_page, p.region_ord, r.run FROM r JOIN p ON p.document_id = r.document_id AND p.pdf_page = r.pdf_page AND p.prev = r.region_ord),
  z AS (SELECT b.document_id, b.pdf_page, run AS zone, count(*) AS n_bodies, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b JOIN r USING (document_id, pdf_page, region_ord) GROUP BY 1, 2, 3),
  h AS (SELECT z.document_id, z.pdf_page, z.zone, count(*) AS n FROM z JOIN typed t ON t.document_id = z.document_id AND t.pdf_page = z.pdf_page AND t.type <> 'article_body' AND trim(t.text) <> '' AND trim(lower(t.text)) NOT IN ({', '.join(f"'{c}'" for c in webzones.CONTROLS)}) AND t.y0 >= greatest(0, z.y0 - greatest(120.0, 0.12 * 1400)) AND t.y1 <= z.y0 + 4 AND {overlap('t.', 'z.')} >= 0.30 GROUP BY 1, 2, 3)
  SELECT z.document_id, z.pdf_page, z.zone, n_bodies, CAST(y0 AS DOUBLE) AS top, coalesce(n, 0) AS n_headers FROM z LEFT JOIN h USING (document_id, pdf_page, zone)""")
def q125_web_zones(spark, sf):
    """Zones of bodies and the headers above them."""
    return webzones.zones(typed(spark, sf))


@query(f"""WITH {LINES}, t AS (SELECT document_id, pdf_page, region_ord, CASE WHEN region_ord % 7 = 3 THEN ' Chevron_Right ' WHEN region_ord % 7 = 5 THEN 'Next   article' ELSE text END AS text, CASE WHEN region_ord % 5 = 1 THEN 'related' WHEN region_ord % 5 = 2 THEN 'main' END AS scope, region_ord % 11 = 4 AS ex, region_ord % 3 = 0 AS idx FROM lines),
  r AS (SELECT *, CASE WHEN trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) IN ({', '.join(f"'{c}'" for c in webzones.CONTROLS)}) AND NOT idx THEN 'ui_control_not_headline' WHEN (ex OR coalesce(scope = 'related', false)) AND idx THEN 'index_vs_non_main_scope' WHEN ex OR coalesce(scope = 'related', false) THEN 'non_editorial_scope' END AS reason FROM t)
  SELECT document_id, pdf_page, region_ord, reason, CASE WHEN reason IS NULL THEN 'accepted' WHEN reason = 'index_vs_non_main_scope' THEN 'conflict' ELSE 'rejected' END AS status FROM r""")
def q126_identity(spark, sf):
    """Titles that may name an article: no controls, no blocked scopes."""
    o = F.col("region_ord")
    t = src.lines(spark, sf).withColumns({"text": F.when(o % 7 == 3, " Chevron_Right ").when(o % 7 == 5, "Next   article").otherwise(F.col("text")), "scope": F.when(o % 5 == 1, "related").when(o % 5 == 2, "main"), "excluded": o % 11 == 4, "index_entry_id": F.when(o % 3 == 0, "e")})
    return webzones.identity(t).select(*DOC, "region_ord", "reason", "status")


@query(rf"""WITH {MARKED}, e AS (SELECT document_id, pdf_page, region_ord, y1, unnest(list_distinct(regexp_extract_all(text, '(?i)data\s+stampa\s*(\d{{3,8}})', 1))) AS number, contains(lower(text), 'tiratura') OR contains(lower(text), 'diffusione') OR contains(lower(text), 'lettori') OR contains(lower(text), 'dir. resp') AS sheet FROM marked), p AS (SELECT document_id, number, count(DISTINCT pdf_page) AS pages FROM e GROUP BY 1, 2),
  m AS (SELECT o.document_id, o.pdf_page, o.region_ord, max(pages) AS repeated, bool_or(EXISTS (SELECT 1 FROM e h WHERE h.document_id = o.document_id AND h.pdf_page = o.pdf_page AND h.number = o.number AND h.sheet AND h.region_ord <> o.region_ord AND h.y1 <= 0.18 * 1400)) AS in_header FROM e o JOIN p ON p.document_id = o.document_id AND p.number = o.number WHERE NOT o.sheet GROUP BY 1, 2, 3),
  s AS (SELECT r.document_id, r.pdf_page, r.region_ord, text, repeated, in_header, round(0.60 + CASE WHEN repeated >= 2 THEN 0.15 ELSE 0 END + CASE WHEN in_header THEN 0.10 ELSE 0 END + CASE WHEN y0 / 1400 <= 0.18 THEN 0.10 ELSE 0 END, 4) AS score FROM marked r JOIN m USING (document_id, pdf_page, region_ord) WHERE length(text) <= 240 AND regexp_matches(text, '(?i)(?:\s*[-–—|]?\s*data\s+stampa\s*\d{{3,8}})+\s*$')),
  c AS (SELECT *, (repeated >= 2 OR in_header) AND score >= 0.78 AS cleaned FROM s)
  SELECT document_id, pdf_page, region_ord, md5(CASE WHEN cleaned THEN rtrim(regexp_replace(text, '(?i)(?:\s*[-–—|]?\s*data\s+stampa\s*\d{{3,8}})+\s*$', '')) ELSE text END) AS text_md5, CAST(score AS DOUBLE) AS score, cleaned FROM c""")
def q127_trailing_marks(spark, sf):
    """Texts without printed marks at their end, where other evidence backs those."""
    return webzones.cleaned_suffix(_marked(spark, sf)).select(*DOC, "region_ord", F.md5("text").alias("text_md5"), "score", "cleaned")


@query(r"""SELECT source AS document_id, doc_id AS pdf_page, length(text) AS n_chars, md5(text) AS text_md5, nullif(regexp_extract(text, 'https?://[^\s<>"'']+', 0), '') AS url, nullif(regexp_extract(text, '\p{L}', 0), '') AS first_letter FROM documents""")
def q128_page_texts(spark, sf):
    """Pages put together from their regions, with first address and first letter."""
    p = webzones.page_texts(src.lines(spark, sf))
    return p.select(*DOC, F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"), "url", "first_letter")


@query(r"""WITH p AS (SELECT page_id, '/in/2024/' || replace(host, '.', ' ') || ' ' || CAST(page_id AS VARCHAR) || '.pdf' AS path, url FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS host FROM pages))
  SELECT page_id, replace(regexp_replace(regexp_extract(path, '([^/]+)$', 1), '\.[^.]*$', ''), ' ', '_') AS name, CASE WHEN page_id % 3 = 0 THEN 'b' WHEN page_id % 3 = 1 THEN 'c' WHEN page_id % 2 = 0 THEN 'r' ELSE '' END AS body FROM p""")
def q129_export_names(spark, sf):
    """Folder names of documents and the body that is exported."""
    k = F.col("page_id")
    path = F.concat(F.lit("/in/2024/"), F.replace(F.regexp_extract("url", "^[A-Za-z]+://([^/?#]*)", 1), F.lit("."), F.lit(" ")), F.lit(" "), k.cast("string"), F.lit(".pdf"))
    body = artefacts.export_body(F.when(k % 3 == 0, " b ").otherwise(" "), F.when(k % 3 == 1, "c"), F.when(k % 2 == 0, "r"))
    return src.read(spark, sf, "pages").select("page_id", artefacts.safe_name(path).alias("name"), body.alias("body"))


SUMS = {"articles": "o_custkey % 7", "with_title": "o_custkey % 5", "with_date": "o_custkey % 4", "with_body": "o_custkey % 6", "short_body": "o_custkey % 3", "review_required": "o_custkey % 2", "incomplete": "o_orderkey % 3", "assigned_chars": "o_orderkey % 1000", "orphan_chars": "o_orderkey % 100", "index_entries": "o_orderkey % 9", "index_matched": "o_orderkey % 5"}
RATES = "round(successes / documents, 4) AS success_rate, round(articles / nullif(successes, 0), 2) AS articles_per_document, round(with_title / nullif(articles, 0), 4) AS title_rate, round(with_date / nullif(articles, 0), 4) AS date_rate, round(with_body / nullif(articles, 0), 4) AS body_rate, round(assigned_chars / nullif(assigned_chars + orphan_chars, 0), 4) AS assignment_rate, round(index_matched / nullif(index_entries, 0), 4) AS linkage_rate"


@query("WITH m AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS documents, count_if(o_orderstatus <> 'P') AS successes, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN {e} END), 0) AS BIGINT) AS {c}" for c, e in SUMS.items()) + f" FROM orders GROUP BY ROLLUP (1, 2)) SELECT *, {RATES} FROM m")
def q130_batch_metrics(spark, sf):
    """Batch metrics over all, by year and by month (orders stand for documents)."""
    d = src.read(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"), F.when(F.col("o_orderstatus") != "P", "success").otherwise("failed").alias("status"), *(F.expr(e).alias(c) for c, e in SUMS.items()))
    return artefacts.metrics(d, "year", "month")


@query()
def q131_membership_rounds(spark, sf):
    """Owners after refinement, columns to the right and the global rounds."""
    r = typed(spark, sf)
    o = F.col("region_ord")
    kind = F.when(F.col("type") == "article_body", "body").when(F.col("type") == "article_title", "title").otherwise("other")
    owner = F.when((o < 2) & (kind != "other"), F.concat(F.lit("a"), o.cast("string")))
    page = r.select(*DOC, "region_ord", kind.alias("kind"), "x0", "y0", "x1", "y1", "page_height", owner.alias("article_id"), F.lit(None).cast("string").alias("zone"), F.lit(None).cast("string").alias("candidate"), F.lit(10.0).alias("font"), F.length("text").cast("long").alias("chars"), (F.length("text") > 120).alias("seed"))
    out = membership.rounds(page, membership.REFINEMENT, membership.COLUMNS, membership.GLOBAL)
    return out.filter("article_id is not null").groupBy(*DOC, "article_id").agg(F.count("*").alias("n_regions"), F.round(F.avg("score"), 4).alias("score"))


@query("""WITH g AS (SELECT user_id, ts, value, CASE WHEN coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE, false) THEN 0 ELSE 1 END AS s FROM events), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
  SELECT user_id, count(*) AS n, CAST(round(sum(value), 4) AS DOUBLE) AS total, epoch_us(max(ts)) - epoch_us(min(ts)) AS micros, k AS session FROM i GROUP BY user_id, k""")
def q132_event_sessions(spark, sf):
    """Events of a user in sessions without a break of half an hour."""
    from layoutlake.streaming.resume import event_sessions

    s = event_sessions(src.read(spark, sf, "events"))
    w = Window.partitionBy("user_id").orderBy("started")
    # a session's end is its last event and the gap
    micros = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp")) - 1_800_000_000
    return s.select("user_id", "n", F.round("total", 4).alias("total"), micros.alias("micros"), F.row_number().over(w).cast("long").alias("session"))


@query("""SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, CAST(round(sum(value), 4) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def q133_event_days(spark, sf):
    """Events by day and type in tumbling windows."""
    from layoutlake.streaming.resume import event_windows

    d = event_windows(src.read(spark, sf, "events"))
    return d.select(F.col("window.start").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))
