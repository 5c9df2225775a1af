"""Stacks of titles, columns that go on, owners by index, intrusions, printed marks, web columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import geometry, shapes, text

PAGE = ["document_id", "pdf_page"]
#: A printed clipping mark and its number.
MARK = r"(?i)data\s+stampa\s*(\d{3,8})"
AUDIENCE = ("tiratura", "diffusione", "lettori", "dir. resp")


@dataclass(frozen=True)
class ColumnStepSettings:
    gap: float = 0.07
    width: float = 0.12
    base: float = 0.28
    quality: float = 0.04
    source: float = 0.32
    end: float = 0.12
    header: float = 0.15
    hyphen: float = 0.12
    open_sentence: float = 0.08
    style: float = 0.10
    index: float = 0.06
    end_fraction: float = 0.70
    header_fraction: float = 0.30
    accept: float = 0.70
    margin: float = 0.12


@dataclass(frozen=True)
class IntrusionSettings:
    sandwich: float = 0.18
    advert: float = 0.70
    related: float = 0.55
    link: float = 0.22
    short: float = 0.10
    close: float = 0.08
    alien: float = 0.06
    words: int = 45
    gap: float = 85.0
    overlap: float = 0.45
    lexical: float = 0.08
    accept: float = 0.68


def header_stacks(titles: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs of titles on top of each other with their roles: (…, upper, lower, main, auxiliary, role, reason).

    ``titles`` has region_ord, box, page_height and index_entry_id (null without a match).  A title is
    part of one pair at most: of pairs in a row every second one counts, from the top.
    """
    w = Window.partitionBy(*PAGE).orderBy("y0", "region_ord")
    nxt = lambda c: F.lead(c).over(w)
    t = titles.select(*PAGE, F.col("region_ord").alias("upper"), *(F.col(c).alias(f"u_{c}") for c in ("x0", "y0", "x1", "y1", "index_entry_id")), nxt("region_ord").alias("lower"), *(nxt(c).alias(f"l_{c}") for c in ("x0", "y0", "x1", "y1", "index_entry_id")), F.coalesce(F.nullif("page_height", F.lit(0.0)), F.lit(842.0)).alias("height"), F.row_number().over(w).alias("n"))
    up, low = F.col("u_y1") - F.col("u_y0"), F.col("l_y1") - F.col("l_y0")
    stacked = F.col("lower").isNotNull() & (F.col("u_y1") <= F.col("l_y0") + 0.30 * F.greatest(low, F.lit(1.0))) & (F.greatest(F.lit(0.0), F.col("l_y0") - F.col("u_y1")) <= F.greatest(F.lit(28.0), 0.04 * F.col("height"))) & (geometry.horizontal_overlap(geometry.box("u_"), geometry.box("l_")) >= 0.60)
    t = t.withColumn("stacked", F.coalesce(stacked, F.lit(False)))
    between = t.join(bodies.select(*PAGE, F.col("y0").alias("b_y0"), F.col("y1").alias("b_y1")), PAGE).filter((F.col("b_y0") >= F.col("u_y1")) & (F.col("b_y1") <= F.col("l_y0"))).select(*PAGE, "upper").distinct().withColumn("split", F.lit(True))
    t = t.join(between, [*PAGE, "upper"], "left").withColumn("stacked", F.col("stacked") & F.col("split").isNull())
    u, l = F.col("u_index_entry_id").isNotNull(), F.col("l_index_entry_id").isNotNull()
    reason = (
        F.when(u & ~l, "index_supported_upper_headline").when(l & ~u, "index_supported_lower_headline")
        .when((low >= 1.65 * up) & (up <= 0.04 * F.col("height")), "short_upper_kicker").when((up >= 1.65 * low) & (low <= 0.10 * F.col("height")), "upper_prominent_lower_deck")
    )
    t = t.withColumn("reason", F.when(F.col("stacked"), reason))
    # decided pairs in a row: the first takes both of its titles, so the second falls out, and so on
    v = Window.partitionBy(*PAGE).orderBy("n")
    hit = F.col("reason").isNotNull()
    t = t.withColumn("run", F.sum((~hit).cast("int")).over(v.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.filter(hit).withColumn("k", F.row_number().over(Window.partitionBy(*PAGE, "run").orderBy("n"))).filter(F.col("k") % 2 == 1)
    lower_main = F.col("reason").isin("index_supported_lower_headline", "short_upper_kicker")
    return t.select(*PAGE, "upper", "lower", F.when(lower_main, F.col("lower")).otherwise(F.col("upper")).alias("main"), F.when(lower_main, F.col("upper")).otherwise(F.col("lower")).alias("auxiliary"), F.when(lower_main, "kicker").otherwise("subtitle").alias("role"), "reason")


def column_steps(columns: DataFrame, s: ColumnStepSettings = ColumnStepSettings()) -> DataFrame:
    """Whether a column goes on in the next: (…, from_column, to_column, score, reason, status).

    ``columns`` has column, box, page size, article_id (of the left one), owners (other ids in it), style_ok,
    same_source, header_bottom, top, bottom (of the editorial area), competing_title, last_text, first_text and has_match.
    """
    w = Window.partitionBy(*PAGE).orderBy("column")
    nxt = lambda c: F.lead(c).over(w)
    c = columns.select("*", *(nxt(k).alias(f"n_{k}") for k in ("column", "x0", "y0", "x1", "y1", "owners", "competing_title", "first_text", "style", "source_ref"))).filter("n_column is not null")
    gap = (F.col("n_x0") - F.col("x1")) / F.col("page_width")
    difference = F.abs((F.col("x1") - F.col("x0")) - (F.col("n_x1") - F.col("n_x0"))) / F.col("page_width")
    style = F.coalesce(F.col("style") == F.col("n_style"), F.lit(True))
    known_style = F.coalesce(F.col("style") == F.col("n_style"), F.lit(False))
    source = F.coalesce(F.col("source_ref") == F.col("n_source_ref"), F.lit(False))
    done = F.greatest(F.lit(0.0), F.least((F.col("y1") - F.col("top")) / F.greatest(F.col("bottom") - F.col("top"), F.lit(1.0)), F.lit(1.0))) >= s.end_fraction
    near = F.coalesce((F.col("n_y0") >= F.col("header_bottom")) & ((F.col("n_y0") - F.col("header_bottom")) / F.col("page_height") <= s.header_fraction), F.lit(False))
    foreign = F.size(F.array_except("n_owners", F.array("article_id"))) > 0
    reason = (
        F.when(F.col("article_id").isNull(), "no_owner").when(~gap.between(0, s.gap), "columns_not_adjacent").when(difference > s.width, "different_column_width").when(F.col("n_competing_title"), "competing_title_in_target_column")
        .when(foreign, "target_column_has_other_article").when(~style, "incompatible_body_style").when(F.col("n_y0") < F.col("header_bottom"), "target_starts_inside_title").when(~source & ~(done & near), "insufficient_column_transition_evidence")
    )
    points = lambda x, v: F.when(x, v).otherwise(0.0)
    hyphen = F.col("last_text").rlike(r"\p{L}-$") & F.col("n_first_text").rlike(r"^\p{Ll}")
    open_ = ~F.col("last_text").rlike(r"[.!?…:;]\s*$") & F.col("n_first_text").rlike(r"^\p{Ll}")
    score = s.base + s.quality * F.greatest(F.lit(0.0), 1.0 - difference / s.width) + points(source, s.source) + points(done, s.end) + points(near, s.header) + F.when(hyphen, s.hyphen).when(open_, s.open_sentence).otherwise(0.0) + points(known_style, s.style) + points(F.col("has_match"), s.index)
    c = c.withColumns({"reason": reason, "score": F.when(reason.isNull(), F.round(F.least(score, F.lit(1.0)), 4)).otherwise(0.0)})
    return c.select(*PAGE, F.col("column").alias("from_column"), F.col("n_column").alias("to_column"), "score", "reason", F.when(F.col("score") >= s.accept, "accepted").otherwise("rejected").alias("status"))


def index_owners(bodies: DataFrame, titles: DataFrame, least_overlap: float = 0.20) -> DataFrame:
    """Open bodies that exactly one title with an index entry claims: (…, region_ord, article_id, status).

    ``titles`` has article_id, region_ord, box, entry_start and entry_page (null without an entry), and the
    page's original_page.  Another title between title and body in their lane is a barrier.
    """
    t = titles.select(*PAGE, F.col("region_ord").alias("title"), "article_id", "entry_start", "entry_page", "original_page", "matched", *(F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")))
    b = bodies.select(*PAGE, "region_ord", *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    over = geometry.horizontal_overlap(geometry.box("b_"), geometry.box("t_"))
    fits = F.col("matched") & F.coalesce(F.col("pdf_page") >= F.col("entry_start"), F.lit(True)) & F.coalesce(F.col("entry_page") == F.col("original_page"), F.lit(True)) & (F.col("b_y0") >= F.col("t_y0")) & (over >= least_overlap)
    claims = b.join(t.filter("matched"), PAGE).filter(fits)
    c = titles.select(*PAGE, F.col("region_ord").alias("other"), *(F.col(k).alias(f"o_{k}") for k in ("x0", "y0", "x1", "y1")))
    blocked = claims.join(c, PAGE).filter((F.col("other") != F.col("title")) & (F.col("o_y0") > F.col("t_y0")) & (F.col("o_y0") < F.col("b_y0")) & (geometry.horizontal_overlap(geometry.box("o_"), geometry.box("b_")) >= least_overlap)).select(*PAGE, "region_ord", "title").distinct()
    left = claims.join(blocked, [*PAGE, "region_ord", "title"], "left_anti")
    return left.groupBy(*PAGE, "region_ord").agg(F.when(F.count("*") == 1, F.max("article_id")).alias("article_id"), F.when(F.count("*") == 1, "assigned").otherwise("ambiguous").alias("status"))


def intrusions(regions: DataFrame, s: IntrusionSettings = IntrusionSettings()) -> DataFrame:
    """Regions between two bodies of their lane that are adverts or links: (…, region_ord, kind, score, accepted)."""
    body = F.col("type") == "article_body"
    c = regions.select(*PAGE, "region_ord", "text", *(F.col(k).alias(f"c_{k}") for k in ("x0", "y0", "x1", "y1")))
    b = regions.filter(body).select(*PAGE, F.col("region_ord").alias("body"), F.col("text").alias("b_text"), *(F.col(k).alias(f"b_{k}") for k in ("x0", "y0", "x1", "y1")))
    marker = shapes.marker_kind(F.col("text"))
    # only what has a marker or looks like a link can be an intrusion: the rest needn't be paired
    c = c.withColumns({"kind": marker, "link": shapes.link_like(F.col("text"))}).filter("kind is not null")
    pairs = c.join(b, PAGE).filter((F.col("body") != F.col("region_ord")) & (geometry.horizontal_overlap(geometry.box("b_"), geometry.box("c_")) >= s.overlap))
    above, below = F.col("c_y0") - F.col("b_y1"), F.col("b_y0") - F.col("c_y1")
    g = pairs.groupBy(*PAGE, "region_ord", "text", "kind", "link").agg(F.min(F.when(above.between(0, s.gap), F.struct(above.alias("d"), "body", "b_text"))).alias("a"), F.min(F.when(below.between(0, s.gap), F.struct(below.alias("d"), "body", "b_text"))).alias("z")).filter("a is not null and z is not null")
    lexical = shapes.lexical_similarity(F.col("text"), F.col("a.b_text"), F.col("z.b_text"))
    points = lambda x, v: F.when(x, v).otherwise(0.0)
    score = s.sandwich + F.when(F.col("kind") == "advertisement", s.advert).otherwise(s.related) + points(F.col("link"), s.link) + points(F.size(text.words(F.col("text"))) <= s.words, s.short) + points(F.greatest("a.d", "z.d") <= s.gap / 2, s.close) + points(lexical <= s.lexical, s.alien)
    return g.select(*PAGE, "region_ord", "kind", F.round(F.least(score, F.lit(1.0)), 4).alias("score")).withColumn("accepted", F.col("score") >= s.accept)


def marks(regions: DataFrame) -> DataFrame:
    """Printed marks with what corroborates them: (…, region_ord, number, repeated_pages, in_header).

    A mark is repeated if its number stands on several pages of the document, and backed
    if a technical sheet at the top of its own page has the same number.
    """
    low = F.lower("text")
    sheet = F.lit(False)
    for m in AUDIENCE:
        sheet = sheet | F.contains(low, F.lit(m))
    each = regions.withColumn("number", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(MARK), F.lit(1))))).withColumn("sheet", sheet)
    pages = each.groupBy("document_id", "number").agg(F.countDistinct("pdf_page").alias("repeated_pages"))
    heads = each.filter(F.col("sheet") & (F.col("y1") <= 0.18 * F.col("page_height"))).select(*PAGE, "number", F.col("region_ord").alias("head")).distinct()
    own = each.filter(~F.col("sheet")).select(*PAGE, "region_ord", "number")
    backed = own.join(heads, [*PAGE, "number"]).filter(F.col("head") != F.col("region_ord")).select(*PAGE, "region_ord", "number", F.lit(True).alias("in_header")).distinct()
    return own.join(pages, ["document_id", "number"]).join(backed, [*PAGE, "region_ord", "number"], "left").select(*PAGE, "region_ord", "number", "repeated_pages", F.coalesce("in_header", F.lit(False)).alias("in_header"))


def mark_cells(regions: DataFrame, cell: float = 0.045) -> DataFrame:
    """Printed marks by the place at which they stand: (document_id, cx, cy, n_marks, supporting_pages)."""
    m = regions.filter(F.col("text").rlike(MARK))
    at = lambda c, size: F.floor(F.col(c) / F.col(size) / cell)
    return m.groupBy("document_id", at("x0", "page_width").alias("cx"), at("y0", "page_height").alias("cy")).agg(F.count("*").alias("n_marks"), F.countDistinct("pdf_page").alias("supporting_pages"))


def main_columns(bodies: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """The column of each page that has most words: (…, left_edge, right_edge, n_words, n_bodies).

    Left edges closer than ``tolerance`` of the page width to the one before are one column.
    """
    w = Window.partitionBy(*PAGE).orderBy("x0", "region_ord")
    step = F.coalesce(F.col("x0") - F.lag("x0").over(w) > tolerance * F.col("page_width"), F.lit(True))
    b = bodies.withColumn("_s", step.cast("int")).withColumn("_c", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.size(text.words(F.col("text")))
    g = b.groupBy(*PAGE, "_c").agg(F.median("x0").alias("left_edge"), F.median("x1").alias("right_edge"), F.sum(words).alias("n_words"), F.count("*").alias("n_bodies"))
    best = g.groupBy(*PAGE).agg(F.min(F.struct((-F.col("n_words")).alias("less"), F.col("_c").alias("c"), "left_edge", "right_edge", "n_bodies")).alias("b"))
    return best.select(*PAGE, "b.left_edge", "b.right_edge", (-F.col("b.less")).alias("n_words"), "b.n_bodies")


def slug_titles(regions: DataFrame, pages: DataFrame, base: str = "score", least: float = 0.55, margin: float = 0.12) -> DataFrame:
    """The title of a page's web article, helped by its address: (…, region_ord, score, lead, status).

    ``regions`` has candidates with a base score, text and gap (to the body); ``pages`` a slug.
    """
    words = lambda c: F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-zà-ÿ0-9]+"), F.lit(0)), lambda x: F.length(x) > 0)
    r = regions.join(pages.select(*PAGE, words(F.col("slug")).alias("slug")), PAGE, "left")
    w = words(F.col("text"))
    n = F.size(text.words(F.col("text")))
    recall = F.when((F.size("slug") >= 4) & (F.size(w) >= 4), F.size(F.array_intersect(F.col("slug"), w)) / F.greatest(F.size(F.array_distinct("slug")), F.lit(1))).otherwise(0.0)
    points = F.when(n.between(3, 24), 0.10).otherwise(0.0) + F.when(F.col("gap").between(0, 120), 0.08).otherwise(0.0) + F.when(F.coalesce(recall, F.lit(0.0)) >= 0.52, 0.65 * recall).otherwise(0.0)
    veto = (n <= 1) | F.lower("text").rlike(r"https?://|www\.") | F.col("text").rlike(r"^\s*\d{1,2}[/-]") | F.col("text").rlike(r"^\s*\p{Lu}\p{L}+\s+\p{Lu}\p{L}+\s*$")
    scored = r.filter(~veto).withColumn("score", F.round(F.col(base) + points, 4))
    from layoutlake.operators import ranking

    return ranking.winner(scored, PAGE, "region_ord", "score", least, margin)
