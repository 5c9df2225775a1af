"""Queries of the resolvers: headers, authors, zones, links, reports and web text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from layoutlake.functions import geometry, similarity, text
from layoutlake.operators import ranking
from layoutlake.plans.oracle import HOST, LINES, REGIONS, WORDS, flag, gap, overlap, winner
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


TIDY_CODES = r"trim(regexp_replace(text, '[ \t]{2,}', ' ', 'g'))"


@query(rf"""SELECT doc_id, length({TIDY_CODES}) AS n_chars, md5({TIDY_CODES}) AS body_md5, CASE WHEN regexp_matches(text, '^[a-z]+ ') THEN 'fused' ELSE 'alone' END AS place FROM documents""")
def q08_code_scrub(spark, sf):
    """A register code that a page's stamp attests goes from its text, fused to a word or alone."""
    docs = src.read(spark, sf, "documents").select("doc_id", "text", F.concat(F.lit("DS"), 1000 + F.col("doc_id") % 9000).alias("stamp"))
    fused = F.col("text").rlike("^[a-z]+ ")
    body = F.when(fused, F.concat(F.regexp_extract("text", "^([a-z]+) ", 1), "stamp", F.regexp_replace("text", "^[a-z]+", ""))).otherwise(F.concat("text", F.lit(" "), "stamp"))
    attested = F.when(text.stamp_code(F.col("stamp")), F.array_distinct(F.regexp_extract_all("stamp", F.lit(text.CODE_TOKEN), F.lit(0)))).otherwise(F.array().cast("array<string>"))
    clean = text.scrub_codes(body, attested)
    return docs.select("doc_id", F.length(clean).cast("long").alias("n_chars"), F.md5(clean).alias("body_md5"), F.when(fused, "fused").otherwise("alone").alias("place"))


@query()
def q22_index_ratio_match(spark, sf):
    """Page titles against their articles' headlines: .65 ratio and .35 token similarity."""
    w = src.web_pages(spark, sf).select("page_id", "title", F.regexp_extract("article", r"(?s)<h1>(.*?)</h1>", 1).alias("headline"))
    a, b = text.entity_key(F.col("title")), text.entity_key(F.col("headline"))
    score = 0.65 * similarity.ratio(a, b) + 0.35 * text.token_jaccard(F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " ")))
    return w.select("page_id", F.round(score, 4).alias("score"), F.when(score >= 0.72, "accepted").otherwise("rejected").alias("status"))


KIND = "CASE WHEN length(text) < 60 THEN 'title' ELSE 'body' END"


def _kinds(spark, sf):
    return src.regions(spark, sf).withColumn("kind", F.when(F.length("text") < 60, "title").otherwise("body"))


def _side(df, prefix, name):
    return df.select(*DOC, F.col("region_ord").alias(name), *(F.col(c).alias(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")))


SUBTITLES = f"""WITH {REGIONS}, k AS (SELECT *, {KIND} AS kind FROM regions), p AS (
  SELECT t.document_id, t.pdf_page, c.region_ord AS subtitle, t.region_ord AS title, round(0.22 * (1 - {gap('t.', 'c.')} / 80) + 0.18 * {overlap('t.', 'c.')} + 0.08 * least((c.x1 - c.x0) / (t.x1 - t.x0), 1) + CASE WHEN t.region_ord = 0 THEN 0.15 ELSE 0 END, 6) AS score
  FROM k t JOIN k c USING (document_id, pdf_page) WHERE t.kind = 'title' AND c.kind = 'title' AND c.region_ord <> t.region_ord AND c.y0 >= t.y1 AND {overlap('t.', 'c.')} >= 0.25 AND {gap('t.', 'c.')} <= 80),
  best AS ({winner('p', 'document_id, pdf_page, subtitle', 'title', 0.40, 0.08)})
  SELECT document_id, pdf_page, subtitle, title, score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page, title ORDER BY score DESC, subtitle) AS rank FROM best WHERE status = 'accepted') WHERE rank <= 2"""


@query(SUBTITLES)
def q50_subtitles(spark, sf):
    """Subtitles to titles: scored pairs, a winner with margin for each, at most two for a title."""
    k = _kinds(spark, sf).filter("kind = 'title'")
    t, c = _side(k, "t_", "title"), _side(k, "c_", "subtitle")
    over, dist = geometry.horizontal_overlap(geometry.box("t_"), geometry.box("c_")), geometry.vertical_gap(geometry.box("t_"), geometry.box("c_"))
    score = 0.22 * (1 - dist / 80) + 0.18 * over + 0.08 * F.least((F.col("c_x1") - F.col("c_x0")) / (F.col("t_x1") - F.col("t_x0")), F.lit(1.0)) + F.when(F.col("title") == 0, 0.15).otherwise(0.0)
    pairs = t.join(c, DOC).filter((F.col("title") != F.col("subtitle")) & (F.col("c_y0") >= F.col("t_y1")) & (over >= 0.25) & (dist <= 80)).withColumn("score", F.round(score, 6))
    best = ranking.winner(pairs, [*DOC, "subtitle"], "title", "score", 0.40, 0.08).filter("status = 'accepted'")
    return ranking.top(best, [*DOC, "title"], [F.col("score").desc(), F.col("subtitle")], 2).select(*DOC, "subtitle", "title", "score", "rank")


NAME = r"^\p{Lu}[\p{L}'’.]+( \p{Lu}[\p{L}'’.]+){1,4}$"


@query(f"WITH {LINES} SELECT document_id, count_if(regexp_matches(trim(text), '{NAME.replace(chr(39), chr(39) * 2)}')) AS name_like, count_if(regexp_matches(lower(text), '^\\s*(?:di\\s+|da\\s+|a\\s+cura\\s+di\\s+)')) AS byline FROM lines GROUP BY 1")
def q51_author_shapes(spark, sf):
    """Lines of two to five capitalised words, and explicit bylines."""
    t = F.col("text")
    return src.lines(spark, sf).groupBy("document_id").agg(F.count_if(F.trim(t).rlike(NAME)).alias("name_like"), F.count_if(text.flags(t)["has_author"]).alias("byline"))


@query(f"""WITH {REGIONS}, k AS (SELECT *, {KIND} AS kind FROM regions), h AS (
  SELECT s.document_id, s.pdf_page, s.region_ord, arg_max(CASE WHEN b.y1 <= s.y0 THEN b.region_ord END, (b.y1, -b.region_ord)) FILTER (WHERE b.y1 <= s.y0) AS above, arg_min(b.region_ord, (b.y0, b.region_ord)) FILTER (WHERE b.y0 >= s.y1) AS below
  FROM k s JOIN k b USING (document_id, pdf_page) WHERE s.kind = 'title' AND b.kind = 'body' AND {overlap('s.', 'b.')} >= 0.2 GROUP BY 1, 2, 3)
  SELECT document_id, pdf_page, region_ord, above, below FROM h WHERE above IS NOT NULL AND below IS NOT NULL""")
def q52_section_headers(spark, sf):
    """Short lines between a body above and one below in their lane."""
    k = _kinds(spark, sf)
    s, b = _side(k.filter("kind = 'title'"), "s_", "region_ord"), _side(k.filter("kind = 'body'"), "b_", "body")
    pairs = s.join(b, DOC).filter(geometry.horizontal_overlap(geometry.box("s_"), geometry.box("b_")) >= 0.2)
    above = F.max(F.when(F.col("b_y1") <= F.col("s_y0"), F.struct("b_y1", (-F.col("body")).alias("minus"))))
    below = F.min(F.when(F.col("b_y0") >= F.col("s_y1"), F.struct("b_y0", "body")))
    g = pairs.groupBy(*DOC, "region_ord").agg(above.alias("a"), below.alias("b"))
    return g.filter("a is not null and b is not null").select(*DOC, "region_ord", (-F.col("a.minus")).alias("above"), F.col("b.body").alias("below"))


@query(f"""WITH {LINES}, p AS (SELECT document_id, pdf_page, count(*) AS n, sum(length(text)) AS chars, count_if({flag('rights')}) AS rights FROM lines GROUP BY 1, 2)
  SELECT document_id, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_regions, round(avg(chars), 4) AS chars_per_page, count_if(chars < 200) AS short_pages, count_if(rights > 0) AS pages_with_rights, round(count_if(chars < 200) / count(*), 4) AS short_rate,
  concat_ws(';', CASE WHEN count_if(chars < 200) / count(*) > 0.10 THEN 'many_short_pages' END, CASE WHEN count_if(rights > 0) = 0 THEN 'no_rights_notice' END) AS anomalies FROM p GROUP BY 1""")
def q53_document_report(spark, sf):
    """Counters, rates and anomalies of each document."""
    p = src.lines(spark, sf).groupBy(*DOC).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count_if(text.flags(F.col("text"))["has_rights"]).alias("rights"))
    g = p.groupBy("document_id").agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_regions"), F.round(F.avg("chars"), 4).alias("chars_per_page"), F.count_if(F.col("chars") < 200).alias("short_pages"), F.count_if(F.col("rights") > 0).alias("pages_with_rights"))
    rate = F.col("short_pages") / F.col("n_pages")
    return g.withColumn("short_rate", F.round(rate, 4)).withColumn("anomalies", F.concat_ws(";", F.when(rate > 0.10, "many_short_pages"), F.when(F.col("pages_with_rights") == 0, "no_rights_notice")))


@query("""WITH t AS (SELECT conv_id, turn, length(text) AS n FROM conversations), l AS (SELECT a.conv_id, a.turn AS from_turn, b.turn AS to_turn, a.n AS left_n, b.n AS right_n FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
  SELECT conv_id, from_turn, to_turn, CASE WHEN left_n >= 100 AND right_n >= 100 THEN 'accepted' ELSE 'candidate' END AS status FROM l""")
def q54_link_integrity(spark, sf):
    """Links whose ends lack a body are only candidates."""
    t = src.read(spark, sf, "conversations").select("conv_id", "turn", (F.length("text") >= 100).alias("has_body"))
    links = t.select("conv_id", F.col("turn").alias("from_turn"), (F.col("turn") + 1).alias("to_turn")).join(t.select("conv_id", F.col("turn").alias("to_turn")), ["conv_id", "to_turn"])
    body = t.filter("has_body").select("conv_id", "turn")
    left = links.join(body.withColumnRenamed("turn", "from_turn").withColumn("l", F.lit(True)), ["conv_id", "from_turn"], "left")
    both = left.join(body.withColumnRenamed("turn", "to_turn").withColumn("r", F.lit(True)), ["conv_id", "to_turn"], "left")
    return both.select("conv_id", "from_turn", "to_turn", F.when(F.col("l") & F.col("r"), "accepted").otherwise("candidate").alias("status"))


@query(f"""WITH u AS (SELECT page_id % 40 AS bucket, page_id, url, {HOST} AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
  f AS (SELECT bucket, url, min(page_id) AS first_page FROM u GROUP BY 1, 2)
  SELECT bucket, count(*) AS n_urls, min(first_page) AS first_page, arg_min(url, first_page) AS url FROM f GROUP BY 1""")
def q55_url_harvest(spark, sf):
    """Distinct addresses of a group of pages and the first of them."""
    u = src.read(spark, sf, "pages").select((F.col("page_id") % 40).alias("bucket"), "page_id", "url")
    first = u.groupBy("bucket", "url").agg(F.min("page_id").alias("first_page"))
    return first.groupBy("bucket").agg(F.count("*").alias("n_urls"), F.min("first_page").alias("first_page"), F.min_by("url", "first_page").alias("url"))


GRAMS = "list_distinct(list_transform(range(1, len({w}) - 3), lambda i: array_to_string({w}[i:i + 4], ' ')))"


@query(rf"""WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), q AS (SELECT doc_id, l[len(l)] AS tail, array_to_string(l[1:len(l) - 1], ' ') AS head FROM s WHERE len(l) >= 2),
  w AS (SELECT doc_id, length(tail) AS n, {WORDS.format('tail')} AS wt, {WORDS.format('head')} AS wh FROM q WHERE length(tail) BETWEEN 70 AND 400), g AS (SELECT doc_id, n, {GRAMS.format(w='wt')} AS gt, {GRAMS.format(w='wh')} AS gh FROM w WHERE len(wt) >= 5 AND len(wh) >= 5)
  SELECT doc_id, n AS tail_chars, round(len(list_intersect(gt, gh)) / len(gt), 6) AS overlap, len(list_intersect(gt, gh)) / len(gt) < 0.02 AS suspicious FROM g""")
def q56_web_tail(spark, sf):
    """Last paragraphs whose 5-grams don't occur earlier."""
    s = src.read(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("l")).filter(F.size("l") >= 2)
    q = s.select("doc_id", F.element_at("l", -1).alias("tail"), F.array_join(F.slice("l", F.lit(1), F.size("l") - 1), " ").alias("head")).filter(F.length("tail").between(70, 400))
    q = q.select("doc_id", F.length("tail").cast("long").alias("tail_chars"), text.shingles(F.col("tail"), 5).alias("gt"), text.shingles(F.col("head"), 5).alias("gh")).filter((F.size("gt") > 0) & (F.size("gh") > 0))
    share = F.size(F.array_intersect("gt", "gh")) / F.size("gt")
    return q.select("doc_id", "tail_chars", F.round(share, 6).alias("overlap"), (share < 0.02).alias("suspicious"))


@query(f"""WITH {REGIONS}, z AS (SELECT *, max(CASE WHEN length(text) < 40 AND y0 < 0.15 * 1400 THEN y1 END) OVER (PARTITION BY document_id, pdf_page) AS seed FROM regions)
  SELECT document_id, pdf_page, CAST(least(max(seed) + 10, 0.18 * 1400) AS DOUBLE) AS zone_bottom, count_if(y1 <= least(seed + 10, 0.18 * 1400)) AS n_inside FROM z WHERE seed IS NOT NULL GROUP BY 1, 2""")
def q58_header_zone(spark, sf):
    """The header zone of a page from its metadata seeds, and what lies in it."""
    w = Window.partitionBy(*DOC)
    seed = F.max(F.when((F.length("text") < 40) & (F.col("y0") < 0.15 * F.col("page_height")), F.col("y1"))).over(w)
    z = src.regions(spark, sf).withColumn("seed", seed).filter("seed is not null").withColumn("zone", F.least(F.col("seed") + 10, 0.18 * F.col("page_height")))
    return z.groupBy(*DOC).agg(F.max("zone").alias("zone_bottom"), F.count_if(F.col("y1") <= F.col("zone")).alias("n_inside"))


@query(f"""WITH {LINES}, r AS (SELECT document_id, pdf_page, region_ord, text, count(*) OVER (PARTITION BY document_id, text) AS same FROM lines), s AS (SELECT document_id, pdf_page, region_ord, round(
  CASE WHEN contains(lower(text), 'data stampa') AND length(text) <= 120 THEN 0.70 ELSE 0 END + CASE WHEN {flag('watermark')} AND length(text) <= 200 THEN 0.30 ELSE 0 END + CASE WHEN same >= 2 THEN 0.16 ELSE 0 END + CASE WHEN region_ord = 0 THEN 0.09 ELSE 0 END - CASE WHEN length(text) > 240 THEN 0.35 ELSE 0 END, 4) AS score FROM r)
  SELECT document_id, CAST(score AS DOUBLE) AS score, count(*) AS n FROM s GROUP BY 1, 2""")
def q59_watermark_score(spark, sf):
    """Print-watermark score of each region, by document and value."""
    t = F.col("text")
    lines = src.lines(spark, sf)
    # counted and joined back: an empty line may be a third of all lines
    again = lines.groupBy("document_id", "text").agg(F.count("*").alias("same"))
    r = lines.join(again, ["document_id", "text"])
    when = lambda c, v: F.when(c, v).otherwise(0.0)
    score = when(F.contains(F.lower(t), F.lit("data stampa")) & (F.length(t) <= 120), 0.70) + when(text.flags(t)["has_watermark"] & (F.length(t) <= 200), 0.30) + when(F.col("same") >= 2, 0.16) + when(F.col("region_ord") == 0, 0.09) - when(F.length(t) > 240, 0.35)
    return r.select("document_id", F.round(score, 4).alias("score")).groupBy("document_id", "score").agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus = 'O' AND l_returnflag = 'N' AS rejected FROM lineitem)
  SELECT l_orderkey, l_linenumber, CAST(sum(CASE WHEN rejected THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, rejected ROWS UNBOUNDED PRECEDING) AS BIGINT) AS component FROM l""")
def q60_detached_components(spark, sf):
    """Rejected links cut a chain: the running count names its components."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).rowsBetween(Window.unboundedPreceding, 0)
    rejected = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    return src.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.sum(F.when(rejected, 1).otherwise(0)).over(w).alias("component"))


@query("""SELECT o_orderkey, count(*) AS n_lines, CASE WHEN count(DISTINCT year(l_shipdate)) = 1 THEN min(year(l_shipdate)) END AS unanimous_year FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def q62_unanimous_date(spark, sf):
    """A record's date is filled in only if its pages agree."""
    # both tables as one: a single aggregation by key, with nothing to sort or to join
    year = F.year("l_shipdate").cast("long")
    orders = src.read(spark, sf, "orders").select("o_orderkey", F.lit(1).cast("long").alias("records"), F.lit(0).cast("long").alias("pages"), F.lit(None).cast("long").alias("y"))
    both = orders.unionAll(src.read(spark, sf, "lineitem").select("l_orderkey", F.lit(0).cast("long"), F.lit(1).cast("long"), year))
    found = both.filter("o_orderkey is not null").groupBy("o_orderkey").agg(F.sum("records").alias("records"), F.sum("pages").alias("pages"), F.min("y").alias("first"), F.max("y").alias("last"))
    return found.filter("records > 0 and pages > 0").select("o_orderkey", (F.col("records") * F.col("pages")).alias("n_lines"), F.when(F.col("first") == F.col("last"), F.col("first")).alias("unanimous_year"))


@query(f"""WITH w AS (SELECT page_id, list_distinct(list_filter({WORDS.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, lambda w: length(w) >= 3)) AS a, list_distinct(list_filter({WORDS.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, lambda w: length(w) >= 3)) AS b FROM pages)
  SELECT page_id, round(CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b)) ELSE 0 END, 6) AS overlap, len(a) >= 3 AND len(b) >= 3 AS comparable FROM w""")
def q66_title_overlap(spark, sf):
    """Overlap coefficient of titles' tokens of at least three letters."""
    w = src.read(spark, sf, "pages").select("page_id", *(text.content_tokens(F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1), 3).alias(n) for tag, n in (("title", "a"), ("h1", "b"))))
    return w.select("page_id", F.round(text.overlap_coefficient(F.col("a"), F.col("b")), 6).alias("overlap"), ((F.size("a") >= 3) & (F.size("b") >= 3)).alias("comparable"))


@query(f"""WITH n AS (SELECT source AS document_id, doc_id AS pdf_page, md5(trim(regexp_replace(lower(text), '[ \\t\\r\\n]+', ' ', 'g'))) AS k, doc_id % 2 = 0 AS native FROM documents)
  SELECT a.document_id, a.pdf_page, CASE WHEN EXISTS (SELECT 1 FROM n b WHERE b.native AND b.document_id = a.document_id AND b.k = a.k) THEN 'merged' ELSE 'appended' END AS status FROM n a WHERE NOT a.native""")
def q67_extraction_merge(spark, sf):
    """Second-pass texts that equal a first-pass text are merged, others appended."""
    k = F.md5(text.collapse(F.lower("text")))
    n = src.read(spark, sf, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").alias("pdf_page"), k.alias("k"))
    native = n.filter("pdf_page % 2 = 0").select("document_id", "k").distinct().withColumn("hit", F.lit(True))
    return n.filter("pdf_page % 2 <> 0").join(native, ["document_id", "k"], "left").select("document_id", "pdf_page", F.when(F.col("hit"), "merged").otherwise("appended").alias("status"))
