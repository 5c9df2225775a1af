"""Queries of what belongs to whom: media, addresses, repeated records, quotes, boilerplate by place."""

from __future__ import annotations

from pyspark.sql import functions as F

from layoutlake.functions import text, urls
from layoutlake.operators import claims
from layoutlake.plans.layouts import TYPED, typed
from layoutlake.plans.oracle import HOST, LINES, REGIONS, WORDS, gap, overlap, url_part, winner
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


@query(f"""WITH {TYPED}, s AS (SELECT m.document_id, m.pdf_page, m.region_ord AS medium, 'a' || CAST(b.region_ord % 3 AS VARCHAR) AS article_id, max(0.40 * {overlap('m.', 'b.')} + 0.40 * (1 - {gap('m.', 'b.')} / 1400 / 0.18)) AS sc FROM typed m JOIN typed b ON m.document_id = b.document_id AND m.pdf_page = b.pdf_page AND m.type = 'unknown' AND b.type = 'article_body' AND {overlap('m.', 'b.')} >= 0.25 AND {gap('m.', 'b.')} / 1400 <= 0.18 GROUP BY 1, 2, 3, 4), scored AS (SELECT document_id, pdf_page, medium, article_id, round(sc, 6) AS score FROM s) """ + winner("scored", "document_id, pdf_page, medium", "article_id", 0.62, 0.12))
def q144_media_owners(spark, sf):
    """The article of each medium (short lines stand for media)."""
    r = typed(spark, sf)
    bodies = r.filter("type = 'article_body'").withColumn("article_id", F.concat(F.lit("a"), (F.col("region_ord") % 3).cast("string")))
    return claims.media_owners(r.filter("type = 'unknown'"), bodies)


@query(f"""WITH c AS (SELECT DISTINCT page_id % 3 AS d, {HOST} AS url, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{{2}})/', 1) || CAST(page_id % 4 AS VARCHAR) AS owner, page_id % 2 = 0 AS rec, page_id % 5 < 2 AS ti FROM pages), o AS (SELECT d, url, owner, bool_or(rec) AS rec, bool_or(ti AND rec) AS ti FROM c GROUP BY 1, 2, 3),
  g AS (SELECT d, url, count(*) AS n, max(owner) AS only_, count_if(ti) AS nt, max(CASE WHEN ti THEN owner END) AS t, count_if(rec) AS nr, max(CASE WHEN rec THEN owner END) AS r FROM o GROUP BY 1, 2)
  SELECT d AS document_id, url, n AS n_owners, CASE WHEN n = 1 THEN only_ WHEN nt = 1 THEN t WHEN nr = 1 THEN r END AS owner, CASE WHEN n = 1 THEN 'one_owner' WHEN nt = 1 THEN 'unique_titled' WHEN nr = 1 THEN 'unique_with_record' ELSE 'ambiguous' END AS rule FROM g""")
def q145_reconciled_claimants(spark, sf):
    """Addresses that several records claim (hosts stand for addresses)."""
    k = F.col("page_id")
    owner = F.concat(F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1), (k % 4).cast("string"))
    p = src.read(spark, sf, "pages").select((k % 3).alias("document_id"), urls.host_name(F.col("url")).alias("url"), owner.alias("owner"), (k % 2 == 0).alias("has_record"), (k % 5 < 2).alias("titled"))
    return claims.claimants(p)


KEYS = f"{HOST} || regexp_replace({url_part(3)}, '/+$', '')"


@query(f"""WITH r AS (SELECT page_id % 5 AS d, page_id AS a, page_id // 2 AS pg, unnest(['url', 'index_entry', 'title']) AS rule, unnest([{KEYS}, CASE WHEN page_id % 4 <> 0 THEN CAST(page_id % 37 AS VARCHAR) END, array_to_string({WORDS.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, ' ')]) AS key FROM pages), k AS (SELECT * FROM r WHERE key IS NOT NULL AND key <> ''), c AS (SELECT d, rule, key, min(a) AS first, count(DISTINCT a) AS n_records, count(DISTINCT pg) AS n_pages FROM k GROUP BY 1, 2, 3 HAVING count(DISTINCT a) > 1)
  SELECT DISTINCT k.d AS document_id, k.rule, k.key, k.a AS article_id, first, n_records, n_pages FROM k JOIN c ON k.d = c.d AND k.rule = c.rule AND k.key = c.key""")
def q146_repeated_records(spark, sf):
    """Records of a document with the same address, index entry or title, as classes."""
    k = F.col("page_id")
    r = src.read(spark, sf, "pages").select((k % 5).alias("document_id"), k.alias("article_id"), F.floor(k / 2).alias("pdf_page"), "url", "html")
    title = F.array_join(text.words(F.lower(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))), " ")
    entry = F.when(F.col("article_id") % 4 != 0, (F.col("article_id") % 37).cast("string"))
    return claims.repeated_records(r, {"url": urls.canonical_key(F.col("url")), "index_entry": entry, "title": title})


QUOTED = REGIONS + f""", q AS (SELECT document_id, pdf_page, region_ord, x0, y0, y1, 'a' || CAST(region_ord % 2 AS VARCHAR) AS art, CASE WHEN region_ord % 5 = 0 THEN 'serif' ELSE 'sans' END AS font, CASE WHEN region_ord >= 2 AND region_ord % 6 = 3 THEN lag(text, 2) OVER (PARTITION BY document_id, pdf_page ORDER BY region_ord) ELSE text END AS text FROM regions), b AS (SELECT *, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w FROM q)"""


@query(f"""WITH {QUOTED}, m AS (SELECT s.document_id, s.pdf_page, s.region_ord, o.region_ord AS other, o.font AS ofont, s.font, len(s.w) AS n, len(list_intersect(s.w, o.w)) AS sh FROM b s JOIN b o ON s.document_id = o.document_id AND s.pdf_page = o.pdf_page AND s.art = o.art AND s.region_ord <> o.region_ord WHERE len(s.w) BETWEEN 6 AND 40 AND len(list_intersect(s.w, o.w)) >= 0.78 * len(s.w)),
  f AS (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page, region_ord ORDER BY sh DESC, other) AS rn FROM m),
  i AS (SELECT f.*, NOT EXISTS (SELECT 1 FROM b s JOIN b o ON s.document_id = o.document_id AND s.pdf_page = o.pdf_page AND s.art = o.art AND s.region_ord <> o.region_ord WHERE s.document_id = f.document_id AND s.pdf_page = f.pdf_page AND s.region_ord = f.region_ord AND abs(o.x0 - s.x0) <= 20 AND least(abs(s.y0 - o.y1), abs(o.y0 - s.y1)) < 12) AS isolated FROM f WHERE rn = 1)
  SELECT document_id, pdf_page, region_ord, other, CAST(round(sh / n, 4) AS DOUBLE) AS coverage, isolated, CASE WHEN font <> ofont OR isolated THEN 'accepted' ELSE 'candidate' END AS status FROM i""")
def q147_isolated_quotes(spark, sf):
    """Bodies that repeat another of their article (some lines repeat the one two before)."""
    from pyspark.sql import Window

    o = F.col("region_ord")
    before = F.lag("text", 2).over(Window.partitionBy(*DOC).orderBy("region_ord"))
    r = src.regions(spark, sf).withColumn("text", F.when((o >= 2) & (o % 6 == 3), before).otherwise(F.col("text")))
    r = r.withColumns({"article_id": F.concat(F.lit("a"), (o % 2).cast("string")), "font": F.when(o % 5 == 0, "serif").otherwise("sans")})
    return claims.isolated_quotes(r)


@query(f"""WITH {LINES}, l AS (SELECT document_id, CASE WHEN region_ord = 0 AND pdf_page % 4 = 0 THEN 'Testata giornalistica registrata' WHEN region_ord = 1 AND pdf_page % 4 = 1 THEN 'Copyright © 2024 ' || text ELSE text END AS text FROM lines) SELECT document_id, count_if(length(text) <= {claims.MASTHEAD_CHARS} AND regexp_matches(lower(text), '{claims.MASTHEAD}')) AS n_mastheads, count(*) AS n FROM l GROUP BY 1""")
def q148_mastheads(spark, sf):
    """Lines that are a site's foot (some are put in)."""
    o, page = F.col("region_ord"), F.col("pdf_page")
    said = F.when((o == 0) & (page % 4 == 0), "Testata giornalistica registrata").when((o == 1) & (page % 4 == 1), F.concat(F.lit("Copyright © 2024 "), "text")).otherwise(F.col("text"))
    return src.lines(spark, sf).select("document_id", said.alias("text")).groupBy("document_id").agg(F.count_if(claims.masthead(F.col("text"))).alias("n_mastheads"), F.count("*").alias("n"))


@query()
def q149_boilerplate_places(spark, sf):
    """Repeated lines by pattern and place."""
    r = src.regions(spark, sf)
    named = r.select("*", F.explode(F.filter(F.array(text.boilerplate(F.col("text"))), lambda x: x["family"].isNotNull())).alias("x"))
    return claims.leaders(named.select(*DOC, F.col("x.family").alias("family"), F.col("x.pattern").alias("pattern"), "x0", "y0", "x1", "y1", "page_width", "page_height"))
