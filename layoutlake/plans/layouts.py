"""Queries of what stands around titles, of runs and groups of bodies, and of page geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from layoutlake.functions import geometry, shapes, text
from layoutlake.operators import headers
from layoutlake.plans.oracle import REGIONS, WORDS, gap, overlap
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


#: Lines put in at fixed places, so that authors, places and teasers occur.
PUT = ("di Mario Rossi", "Anna Maria Verdi", "NATION_3", "Cronaca", "segue a pag. 12")
PUT_SQL = "[" + ", ".join(f"'{p}'" for p in PUT) + "]"
TYPED = REGIONS + f""", typed AS (SELECT *, CASE WHEN length(text) < 30 THEN 'unknown' WHEN length(text) < 75 THEN 'article_title' ELSE 'article_body' END AS type FROM (SELECT * REPLACE (CASE WHEN region_ord BETWEEN 1 AND 4 AND pdf_page % 3 = 0 THEN {PUT_SQL}[1 + (pdf_page // 3 + region_ord) % 5] ELSE text END AS text) FROM regions)),
  owned AS (SELECT *, CASE WHEN type = 'article_body' THEN 'a' || CAST(region_ord % 2 AS VARCHAR) END AS article_id FROM typed)"""


def typed(spark, sf):
    """Regions with a type by length, owners of bodies by column, and some lines put in."""
    at = (F.floor(F.col("pdf_page") / 3) + F.col("region_ord")) % len(PUT)
    line = F.element_at(F.array(*map(F.lit, PUT)), (1 + at).cast("int"))
    r = src.regions(spark, sf).withColumn("text", F.when(F.col("region_ord").between(1, 4) & (F.col("pdf_page") % 3 == 0), line).otherwise(F.col("text")))
    n = F.length("text")
    r = r.withColumn("type", F.when(n < 30, "unknown").when(n < 75, "article_title").otherwise("article_body"))
    return r.withColumn("article_id", F.when(F.col("type") == "article_body", F.concat(F.lit("a"), (F.col("region_ord") % 2).cast("string"))))


PARTICLES = ", ".join(f"'{p}'" for p in shapes.PARTICLES)


@query(rf"""WITH {TYPED}, n AS (SELECT *, trim(regexp_extract(text, '{shapes.BYLINE}', 1)) AS said FROM typed WHERE type = 'unknown' AND trim(text) <> ''), m AS (SELECT *, CASE WHEN said <> '' THEN said ELSE trim(text) END AS name FROM n),
  t AS (SELECT *, list_filter(regexp_split_to_array(name, '\s+'), lambda x: x <> '') AS tok FROM m), g AS (SELECT *, list_filter(tok, lambda x: lower(x) NOT IN ({PARTICLES})) AS sig FROM t),
  c AS (SELECT *, said <> '' AS explicit, len(tok) BETWEEN 2 AND 5 AND len(list_filter(tok, lambda x: NOT regexp_matches(x, '^\p{{L}}+(?:[''’\-]\p{{L}}+)*$'))) = 0 AND len(sig) >= 2 AND len(list_filter(sig, lambda x: NOT regexp_matches(x, '^\p{{Lu}}'))) = 0 AS shaped FROM g),
  h AS (SELECT c.document_id, c.pdf_page, c.region_ord, min(struct_pack(g := c.y0 - t.y1, h := t.region_ord, b := t.y1)) AS h FROM c JOIN typed t ON c.document_id = t.document_id AND c.pdf_page = t.pdf_page AND t.type = 'article_title' AND c.y0 - t.y1 BETWEEN 0 AND 110 AND {overlap('c.', 't.')} >= 0.2 WHERE explicit OR shaped GROUP BY 1, 2, 3),
  k AS (SELECT c.*, h.h FROM c LEFT JOIN h USING (document_id, pdf_page, region_ord) WHERE explicit OR shaped),
  s AS (SELECT k.document_id, k.pdf_page, k.region_ord, any_value(name) AS name, any_value(explicit) AS explicit, any_value(shaped) AS shaped, any_value(k.h) AS h, coalesce(bool_or({overlap('k.', 'b.')} >= 0.2 AND b.y0 >= k.y1), false) AS before_body, coalesce(bool_or({overlap('k.', 'b.')} >= 0.2 AND b.y0 >= k.h.b AND b.y1 <= k.y0), false) AS started
    FROM k LEFT JOIN typed b ON b.document_id = k.document_id AND b.pdf_page = k.pdf_page AND b.type = 'article_body' GROUP BY 1, 2, 3),
  r AS (SELECT *, round(CASE WHEN explicit THEN 0.48 ELSE 0 END + CASE WHEN shaped THEN 0.22 ELSE 0 END + CASE WHEN h IS NOT NULL THEN 0.20 ELSE 0 END + CASE WHEN before_body THEN 0.14 ELSE 0 END, 4) AS score FROM s WHERE NOT started AND (explicit OR h IS NOT NULL))
  SELECT document_id, pdf_page, region_ord, name, CASE WHEN explicit THEN 'explicit_byline' ELSE 'implicit_name' END AS method, CAST(score AS DOUBLE) AS score, h.h AS header FROM r WHERE score >= CASE WHEN explicit THEN 0.70 ELSE 0.72 END""")
def q91_authors(spark, sf):
    """Authors by byline or shape, the header above them and the body below."""
    return headers.authors(typed(spark, sf))


@query(rf"""WITH {TYPED}, c AS (SELECT *, len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')) AS words, array_to_string(regexp_extract_all(lower(regexp_replace(trim(text), '\s*[,–—-]\s*$', '')), '[\p{{L}}\p{{N}}_]+'), ' ') AS k FROM typed WHERE type = 'unknown' AND NOT (contains(lower(text), 'data stampa') OR contains(lower(text), 'articolo non cedibile') OR contains(lower(text), 'uso esclusivo'))),
  p AS (SELECT c.document_id, c.pdf_page, c.region_ord, any_value(words) AS words, any_value(k) AS k, count(*) AS n, min(t.region_ord) AS title FROM c JOIN typed t ON c.document_id = t.document_id AND c.pdf_page = t.pdf_page AND t.type = 'article_title' AND t.y0 - c.y1 BETWEEN 0 AND 55 AND {overlap('c.', 't.')} >= 0.35 WHERE words > 0 GROUP BY 1, 2, 3)
  SELECT document_id, pdf_page, region_ord, title, CASE WHEN k IN (SELECT lower(n_name) FROM nation) AND words <= 5 THEN 'dateline' ELSE 'kicker' END AS role FROM p WHERE n = 1 AND (words <= 6 OR (k IN (SELECT lower(n_name) FROM nation) AND words <= 5))""")
def q92_kickers(spark, sf):
    """Kickers and datelines right above exactly one title."""
    return headers.kickers(typed(spark, sf), src.read(spark, sf, "nation").select(F.col("n_name").alias("place")))


@query(rf"""WITH {REGIONS}, first AS (SELECT document_id, pdf_page, text AS head FROM lines WHERE region_ord = 0), m AS (SELECT r.document_id, r.pdf_page, region_ord, y0, CASE WHEN region_ord = 4 THEN y1 + 14 ELSE y1 END AS y1, CASE WHEN region_ord IN (0, 4) THEN 'article_title' ELSE 'article_body' END AS type, CASE WHEN region_ord = 4 THEN head || ' ancora' WHEN region_ord = 2 AND r.pdf_page % 2 = 0 THEN 'segue a pag. 12' ELSE text END AS text FROM regions r JOIN first f ON r.document_id = f.document_id AND r.pdf_page = f.pdf_page),
  t AS (SELECT *, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w FROM m WHERE type = 'article_title' AND trim(text) <> ''),
  two AS (SELECT a.document_id, a.pdf_page, a.region_ord AS upper, b.region_ord AS lower, a.y0 AS ay0, a.y1 AS ay1, b.y0 AS by0, b.y1 AS by1, len(list_intersect(a.w, b.w)) AS shared, len(list_intersect(a.w, b.w)) / greatest(1, least(len(a.w), len(b.w))) AS sim FROM t a JOIN t b ON a.document_id = b.document_id AND a.pdf_page = b.pdf_page AND a.region_ord = 0 AND b.region_ord = 4),
  f AS (SELECT * FROM two WHERE ay1 < by0 AND ay0 < 0.45 * 1400 AND by0 < 0.72 * 1400 AND shared >= 3 AND sim >= 0.46),
  s AS (SELECT f.document_id, f.pdf_page, upper, lower, any_value(shared) AS shared, any_value(sim) AS sim, any_value(ay1 - ay0) AS ah, any_value(by1 - by0) AS bh, bool_or(type = 'article_body' AND y0 >= by1) AS below, bool_or(y0 BETWEEN ay0 AND by0 AND regexp_matches(text, '(?i)(?:^|[^\p{{L}}\p{{N}}_])a\s+pag\.?\s*\d+|(?:^|[^\p{{L}}\p{{N}}_])(?:a|alle|pag\.?|pagina)\s*pag\.?\s*\d+')) AS pointer FROM f JOIN m ON f.document_id = m.document_id AND f.pdf_page = m.pdf_page GROUP BY 1, 2, 3, 4)
  SELECT document_id, pdf_page, upper, lower, shared, round(sim, 3) AS similarity, pointer FROM s WHERE (bh >= 1.12 * ah OR below) AND (pointer OR (sim >= 0.64 AND bh >= 1.5 * ah))""")
def q93_teasers(spark, sf):
    """Pages whose upper title announces the lower one (the fifth line repeats the first)."""
    r = src.regions(spark, sf)
    head = r.filter("region_ord = 0").select(*DOC, F.col("text").alias("head"))
    fifth = F.col("region_ord") == 4
    said = F.when(fifth, F.concat("head", F.lit(" ancora"))).when((F.col("region_ord") == 2) & (F.col("pdf_page") % 2 == 0), "segue a pag. 12").otherwise(F.col("text"))
    m = r.join(head, DOC).withColumns({"text": said, "y1": F.when(fifth, F.col("y1") + 14).otherwise(F.col("y1")), "type": F.when(F.col("region_ord").isin(0, 4), "article_title").otherwise("article_body")})
    return headers.teasers(m)


@query(rf"""WITH {TYPED}, f AS (SELECT *, regexp_matches(trim(text), '^\p{{Ll}}') AS goes_on FROM owned WHERE type = 'unknown' AND region_ord > 0 AND length(trim(text)) >= 24 AND len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')) >= 4),
  e AS (SELECT f.document_id, f.pdf_page, f.region_ord, b.article_id, bool_or({gap('f.', 'b.')} <= 28) AS near, bool_or(f.y0 - b.y1 BETWEEN 0 AND 35) AS before, bool_or(b.y0 - f.y1 BETWEEN 0 AND 35) AS after, any_value(goes_on) AS goes_on FROM f JOIN owned b ON f.document_id = b.document_id AND f.pdf_page = b.pdf_page AND b.type = 'article_body' AND {overlap('f.', 'b.')} >= 0.72 GROUP BY 1, 2, 3, 4)
  SELECT document_id, pdf_page, region_ord, min(article_id) AS article_id FROM e WHERE near AND before AND (after OR goes_on) GROUP BY 1, 2, 3 HAVING count(*) = 1""")
def q94_enclosed_fragments(spark, sf):
    """Open fragments that bodies of one owner enclose."""
    return headers.enclosed_fragments(typed(spark, sf))


@query(f"""WITH {TYPED}, b AS (SELECT *, CASE WHEN coalesce(x0 - lag(x0) OVER (PARTITION BY document_id, pdf_page ORDER BY x0, y0, region_ord) > 18, true) THEN 1 ELSE 0 END AS step FROM typed WHERE type = 'article_body'),
  c AS (SELECT *, CAST(sum(step) OVER (PARTITION BY document_id, pdf_page ORDER BY x0, y0, region_ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS col FROM b),
  d AS (SELECT *, CASE WHEN coalesce(lag(col) OVER w <> col OR y0 - lag(y1) OVER w > 24, true) THEN 1 ELSE 0 END AS cut, row_number() OVER w AS place FROM c WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY col, y0, x0, region_ord))
  SELECT document_id, pdf_page, region_ord, col AS "column", place, CAST(sum(cut) OVER (PARTITION BY document_id, pdf_page ORDER BY place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS body_group FROM d""")
def q95_body_groups(spark, sf):
    """Bodies by column and height; a group ends at a new column or a gap."""
    return headers.body_groups(typed(spark, sf), 24.0)


@query(f"""WITH RECURSIVE {TYPED}, b AS (SELECT document_id, pdf_page, region_ord, x0, y0, x1, y1 FROM typed WHERE type = 'article_body'),
  p AS (SELECT b.document_id, b.pdf_page, b.region_ord, arg_min(a.region_ord, (b.y0 - a.y1, a.region_ord)) AS prev FROM b JOIN b a ON a.document_id = b.document_id AND a.pdf_page = b.pdf_page AND a.region_ord <> b.region_ord AND b.y0 - a.y1 BETWEEN 0 AND 44 AND {overlap('b.', 'a.')} >= 0.52 GROUP BY 1, 2, 3),
  r AS (SELECT document_id, pdf_page, region_ord, region_ord AS run FROM b WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.document_id = b.document_id AND p.pdf_page = b.pdf_page AND p.region_ord = b.region_ord) UNION ALL SELECT p.document_id, p.pdf_page, p.region_ord, r.run FROM r JOIN p ON p.document_id = r.document_id AND p.pdf_page = r.pdf_page AND p.prev = r.region_ord)
  SELECT document_id, pdf_page, run, count(*) AS n_bodies, max(region_ord) AS last FROM r GROUP BY 1, 2, 3""")
def q96_vertical_runs(spark, sf):
    """Runs of bodies below each other, named by their first."""
    return headers.vertical_runs(typed(spark, sf)).groupBy(*DOC, "run").agg(F.count("*").alias("n_bodies"), F.max("region_ord").alias("last"))


@query(f"""WITH {TYPED} SELECT document_id, pdf_page, article_id, CAST(min(x0) AS DOUBLE) AS x0, CAST(min(y0) AS DOUBLE) AS y0, CAST(max(x1) AS DOUBLE) AS x1, CAST(max(y1) AS DOUBLE) AS y1, CAST(median(x0) AS DOUBLE) AS left_edge, CAST(median(x1) AS DOUBLE) AS right_edge FROM owned WHERE article_id IS NOT NULL GROUP BY 1, 2, 3""")
def q97_group_boxes(spark, sf):
    """The box around each article's bodies and the median edges of its column."""
    r = typed(spark, sf).filter("article_id is not null")
    return r.groupBy(*DOC, "article_id").agg(*geometry.union_box(), F.median("x0").alias("left_edge"), F.median("x1").alias("right_edge"))


@query("""WITH p AS (SELECT l_orderkey AS image, l_linenumber AS x, CAST(l_quantity AS BIGINT) AS y, CAST(floor(l_extendedprice) AS BIGINT) % 256 AS v FROM lineitem)
  SELECT image, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, count(*) AS n_dark FROM p WHERE v <= 110 GROUP BY 1""")
def q98_dark_box(spark, sf):
    """The box around the dark pixels of an image (order lines stand for pixels)."""
    p = src.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("x"), F.floor("l_quantity").alias("y"), (F.floor("l_extendedprice") % 256).alias("v"))
    return geometry.dark_box(p, ["image"])


@query(r"""WITH p AS (SELECT page_id, (page_id * 37 % 100) / 100 AS cx, (page_id * 53 % 100) / 100 AS cy, (page_id * 7 % 31) / 100 AS area, page_id % 45 AS pg FROM pages), s AS (SELECT *, CASE WHEN pg <= 1 THEN 1.0 WHEN pg <= 3 THEN 0.85 WHEN pg <= 5 THEN 0.70 WHEN pg <= 10 THEN 0.50 WHEN pg <= 20 THEN 0.30 ELSE 0.20 END AS ps, CASE WHEN area >= 0.35 THEN 1.0 WHEN area >= 0.25 THEN 0.85 WHEN area >= 0.15 THEN 0.65 WHEN area >= 0.08 THEN 0.45 WHEN area >= 0.03 THEN 0.25 ELSE 0.10 END AS ars, CASE WHEN cy < 0.33 THEN 1.0 WHEN cy < 0.66 THEN 0.60 ELSE 0.30 END AS vs FROM p)
  SELECT page_id, CASE WHEN cx < 0.33 THEN 'left' WHEN cx < 0.66 THEN 'center' ELSE 'right' END AS horizontal, CASE WHEN cy < 0.33 THEN 'top' WHEN cy < 0.66 THEN 'middle' ELSE 'bottom' END AS vertical, CAST(round(0.4 * ps + 0.4 * ars + 0.2 * vs, 4) AS DOUBLE) AS prominence FROM s""")
def q99_position_prominence(spark, sf):
    """Position on the page and prominence, from centre, area and page number."""
    k = F.col("page_id")
    p = src.read(spark, sf, "pages").select("page_id", ((k * 37 % 100) / 100).alias("cx"), ((k * 53 % 100) / 100).alias("cy"), ((k * 7 % 31) / 100).alias("area"), (k % 45).alias("pg"))
    horizontal, vertical = geometry.position(F.col("cx"), F.col("cy"))
    score, _ = geometry.prominence_of(F.col("pg"), F.col("area"), F.col("cy"))
    return p.select("page_id", horizontal.alias("horizontal"), vertical.alias("vertical"), score.alias("prominence"))
