"""What stands around titles: authors, kickers and datelines, teasers, fragments, runs of bodies.

Set-based: nearest neighbours, existence and counts within a page.  ``regions`` has
document_id, pdf_page, region_ord, type, raw_label, text, boxes, page size and article_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import geometry, shapes, text

PAGE = ["document_id", "pdf_page"]
# Markers that keep a short line from being a kicker, and a pointer to another page.
TECHNICAL_MARKERS = ("data stampa", "articolo non cedibile", "uso esclusivo")
PAGE_POINTER = r"(?i)(?:^|[^\p{L}\p{N}_])(?:a|alle|pag\.?|pagina)\s*pag\.?\s*\d+|(?:^|[^\p{L}\p{N}_])a\s+pag\.?\s*\d+"


@dataclass(frozen=True)
class HeaderSettings:
    author_gap: float = 110.0
    author_overlap: float = 0.20
    explicit_score: float = 0.70
    implicit_score: float = 0.72
    kicker_gap: float = 55.0
    kicker_overlap: float = 0.35
    kicker_words: int = 6
    teaser_shared: int = 3
    teaser_similarity: float = 0.46
    fragment_overlap: float = 0.72
    fragment_gap: float = 28.0
    fragment_reach: float = 35.0
    fragment_chars: int = 24
    fragment_words: int = 4


def _boxed(df: DataFrame, prefix: str, *keep: Column) -> DataFrame:
    return df.select(*PAGE, *keep, *(F.col(c).alias(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")))


def _over(a: str, b: str) -> Column:
    return geometry.horizontal_overlap(geometry.box(a), geometry.box(b))


def authors(regions: DataFrame, s: HeaderSettings = HeaderSettings()) -> DataFrame:
    """Lines that name an author: (document_id, pdf_page, region_ord, name, method, score, header)."""
    name, explicit = shapes.byline(F.col("text"))
    own = regions.filter((F.col("type").isin("unknown", "author")) & (F.trim("text") != "")).withColumns({"name": name, "explicit": explicit}).withColumn("shaped", shapes.name_like(F.col("name")))
    own = own.filter("explicit or shaped")
    c = _boxed(own, "c_", F.col("region_ord"), F.col("name"), F.col("explicit"), F.col("shaped"))
    heads = _boxed(regions.filter(F.col("type").isin("article_title", "article_subtitle")), "h_", F.col("region_ord").alias("header"))
    bodies = _boxed(regions.filter(F.col("type") == "article_body"), "b_", F.col("region_ord").alias("body"))
    gap = F.col("c_y0") - F.col("h_y1")
    above = c.join(heads, PAGE).filter(gap.between(0, s.author_gap) & (_over("c_", "h_") >= s.author_overlap))
    near = above.groupBy(*PAGE, "region_ord").agg(F.min(F.struct(gap.alias("gap"), "header", F.col("h_y1").alias("bottom"))).alias("h"))
    c = c.join(near, [*PAGE, "region_ord"], "left")
    pairs = c.join(bodies, PAGE, "left")
    meets = F.coalesce(_over("c_", "b_") >= s.author_overlap, F.lit(False))
    seen = pairs.groupBy(*PAGE, "region_ord").agg(
        F.max(meets & (F.col("b_y0") >= F.col("c_y1"))).alias("before_body"),
        F.max(meets & F.coalesce((F.col("b_y0") >= F.col("h.bottom")) & (F.col("b_y1") <= F.col("c_y0")), F.lit(False))).alias("started"),
    )
    points = lambda x, v: F.when(x, v).otherwise(0.0)
    out = c.join(seen, [*PAGE, "region_ord"]).filter(~F.col("started") & (F.col("explicit") | F.col("h").isNotNull()))
    score = F.round(points(F.col("explicit"), 0.48) + points(F.col("shaped"), 0.22) + points(F.col("h").isNotNull(), 0.20) + points(F.coalesce("before_body", F.lit(False)), 0.14), 4)
    out = out.withColumn("score", score).filter(F.col("score") >= F.when(F.col("explicit"), s.explicit_score).otherwise(s.implicit_score))
    return out.select(*PAGE, "region_ord", "name", F.when(F.col("explicit"), "explicit_byline").otherwise("implicit_name").alias("method"), "score", F.col("h.header").alias("header"))


def kickers(regions: DataFrame, places: DataFrame | None = None, s: HeaderSettings = HeaderSettings()) -> DataFrame:
    """Short lines right above exactly one title: (document_id, pdf_page, region_ord, title, role).

    A line that is a place of ``places`` (place) by itself is a dateline, others of few
    words are kickers.
    """
    low = F.lower("text")
    marked = F.lit(False)
    for m in TECHNICAL_MARKERS:
        marked = marked | F.contains(low, F.lit(m))
    words = F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != ""))
    c = _boxed(regions.filter(F.col("type").isin("unknown", "location") & ~marked & (words > 0)), "c_", F.col("region_ord"), words.alias("words"), text.entity_key(F.regexp_replace(F.trim("text"), r"\s*[,–—-]\s*$", "")).alias("key"))
    t = _boxed(regions.filter(F.col("type") == "article_title"), "t_", F.col("region_ord").alias("title"))
    pairs = c.join(t, PAGE).filter((F.col("t_y0") - F.col("c_y1")).between(0, s.kicker_gap) & (_over("c_", "t_") >= s.kicker_overlap))
    one = pairs.groupBy(*PAGE, "region_ord", "words", "key").agg(F.count("*").alias("n"), F.min("title").alias("title")).filter("n = 1")
    if places is not None:
        known = places.select(text.entity_key(F.col("place")).alias("key")).distinct().withColumn("is_place", F.lit(True))
        one = one.join(known, "key", "left")
    else:
        one = one.withColumn("is_place", F.lit(None).cast("boolean"))
    role = F.when(F.coalesce("is_place", F.lit(False)) & (F.col("words") <= 5), "dateline").when(F.col("words") <= s.kicker_words, "kicker")
    return one.withColumn("role", role).filter("role is not null").select(*PAGE, "region_ord", "title", "role")


def teasers(regions: DataFrame, stop_words: tuple[str, ...] = (), s: HeaderSettings = HeaderSettings()) -> DataFrame:
    """Pages whose upper one of two titles announces the lower: (document_id, pdf_page, upper, lower, shared, similarity, pointer)."""
    t = regions.filter((F.col("type") == "article_title") & (F.trim("text") != ""))
    each = F.struct("y0", "region_ord", "y1", F.filter(text.content_tokens(F.col("text"), 4), lambda w: ~w.isin(*stop_words) if stop_words else F.lit(True)).alias("w"), "page_height")
    two = t.groupBy(*PAGE).agg(F.sort_array(F.collect_list(each)).alias("t")).filter(F.size("t") == 2).select(*PAGE, F.col("t")[0].alias("a"), F.col("t")[1].alias("b"))
    shared = F.size(F.array_intersect("a.w", "b.w"))
    similarity = shared / F.greatest(F.lit(1), F.least(F.size("a.w"), F.size("b.w")))
    two = two.filter((F.col("a.y1") < F.col("b.y0")) & (F.col("a.y0") < 0.45 * F.col("a.page_height")) & (F.col("b.y0") < 0.72 * F.col("a.page_height"))).withColumns({"shared": shared, "similarity": similarity}).filter((F.col("shared") >= s.teaser_shared) & (F.col("similarity") >= s.teaser_similarity))
    inside = regions.select(*PAGE, "y0", "type", F.coalesce("text", F.lit("")).alias("text")).join(two, PAGE)
    seen = inside.groupBy(*PAGE).agg(
        F.max((F.col("type") == "article_body") & (F.col("y0") >= F.col("b.y1"))).alias("body_below"),
        F.max(F.col("y0").between(F.col("a.y0"), F.col("b.y0")) & F.col("text").rlike(PAGE_POINTER)).alias("pointer"),
    )
    high = lambda x: F.col(f"{x}.y1") - F.col(f"{x}.y0")
    out = two.join(seen, PAGE).filter((high("b") >= 1.12 * high("a")) | F.col("body_below")).filter(F.col("pointer") | (F.col("similarity") >= 0.64) & (high("b") >= 1.5 * high("a")))
    return out.select(*PAGE, F.col("a.region_ord").alias("upper"), F.col("b.region_ord").alias("lower"), "shared", F.round("similarity", 3).alias("similarity"), "pointer")


def enclosed_fragments(regions: DataFrame, s: HeaderSettings = HeaderSettings()) -> DataFrame:
    """Open fragments that one owner's bodies enclose or that go on with a sentence: (…, region_ord, article_id)."""
    body = F.trim("text")
    words = F.size(F.filter(F.split(body, r"\s+"), lambda w: w != ""))
    open_ = (F.col("type") == "unknown") & F.col("article_id").isNull() & ~F.coalesce(F.col("raw_label") == "section_header", F.lit(False)) & (F.length(body) >= s.fragment_chars) & (words >= s.fragment_words)
    f = _boxed(regions.filter(open_), "f_", F.col("region_ord"), body.rlike(r"^\p{Ll}").alias("goes_on"))
    b = _boxed(regions.filter((F.col("type") == "article_body") & F.col("article_id").isNotNull()), "b_", F.col("article_id"))
    pairs = f.join(b, PAGE).filter(_over("f_", "b_") >= s.fragment_overlap)
    gap = geometry.vertical_gap(geometry.box("f_"), geometry.box("b_"))
    above, below = F.col("f_y0") - F.col("b_y1"), F.col("b_y0") - F.col("f_y1")
    each = pairs.groupBy(*PAGE, "region_ord", "article_id").agg(F.max(gap <= s.fragment_gap).alias("near"), F.max(above.between(0, s.fragment_reach)).alias("before"), F.max(below.between(0, s.fragment_reach)).alias("after"), F.first("goes_on").alias("goes_on"))
    fits = each.filter(F.col("near") & F.col("before") & (F.col("after") | F.col("goes_on")))
    return fits.groupBy(*PAGE, "region_ord").agg(F.count("*").alias("n"), F.min("article_id").alias("article_id")).filter("n = 1").drop("n")


def body_groups(regions: DataFrame, gap: float, tolerance: float = 18.0) -> DataFrame:
    """Bodies in page order with column, place and group: (…, region_ord, column, place, body_group).

    Columns are runs of left edges no further than ``tolerance`` from the one before; a
    group ends at a new column or a larger gap.
    """
    by_left = Window.partitionBy(*PAGE).orderBy("x0", "y0", "region_ord")
    b = regions.filter((F.col("type") == "article_body") & (F.trim("text") != ""))
    step = F.coalesce(F.col("x0") - F.lag("x0").over(by_left) > tolerance, F.lit(True))
    b = b.withColumn("_step", step.cast("int")).withColumn("column", F.sum("_step").over(by_left.rowsBetween(Window.unboundedPreceding, 0)))
    order = Window.partitionBy(*PAGE).orderBy("column", "y0", "x0", "region_ord")
    cut = F.coalesce((F.lag("column").over(order) != F.col("column")) | (F.col("y0") - F.lag("y1").over(order) > gap), F.lit(True))
    b = b.withColumn("_cut", cut.cast("int")).withColumns({"place": F.row_number().over(order), "body_group": F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return b.select(*PAGE, "region_ord", "column", "place", "body_group")


def vertical_runs(regions: DataFrame, gap: float = 44.0, overlap: float = 0.52) -> DataFrame:
    """Bodies that stand below each other, as runs: (…, region_ord, run).

    A body joins the run of the nearest body above it that is within ``gap`` and overlaps
    enough; runs are named by their first body.  Predecessors make a forest, and pointers
    are doubled until each body points at its run's first.
    """
    b = _boxed(regions.filter(F.col("type") == "article_body"), "b_", F.col("region_ord"))
    a = _boxed(regions.filter(F.col("type") == "article_body"), "a_", F.col("region_ord").alias("before"))
    dist = F.col("b_y0") - F.col("a_y1")
    pairs = b.join(a, PAGE).filter((F.col("before") != F.col("region_ord")) & dist.between(0, gap) & (_over("b_", "a_") >= overlap))
    best = pairs.groupBy(*PAGE, "region_ord").agg(F.min(F.struct(dist.alias("d"), "before")).alias("p")).select(*PAGE, "region_ord", F.col("p.before").alias("run"))
    # a page's pointers as one map, so that doubling needs no join
    maps = b.select(*PAGE, "region_ord").join(best, [*PAGE, "region_ord"], "left").groupBy(*PAGE).agg(F.map_from_entries(F.collect_list(F.struct("region_ord", F.coalesce("run", F.col("region_ord")).alias("run")))).alias("m"))
    doubled = lambda m, _: text.bound(m, lambda x: F.transform_values(x, lambda k, v: F.element_at(x, v)))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("m") + 1)).cast("int"))
    maps = maps.select(*PAGE, F.aggregate(steps, F.col("m"), doubled).alias("m"))
    return maps.select(*PAGE, F.explode("m").alias("region_ord", "run"))
