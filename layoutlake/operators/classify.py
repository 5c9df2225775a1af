"""Region types by rules: technical, metadata seeds, header zone, body seeds, page types, scopes.

Each step takes regions and gives them back with ``type``, ``excluded`` and the reason
of the step; a rule is one branch of a ``when`` chain and the first that fits decides.
Thumbnails, the header zone and the font of bodies look beyond a region.  They are windows
over its page, never joins of a step's rows with themselves: each such join would run all
steps before it once more.  A page without a number has no zone, thumbnail or font.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import geometry, text

PAGE = ["document_id", "pdf_page"]
# Groups of region types.
SEEDS = ("source_name", "press_review_provider", "publication_date", "original_page", "clipping_sheet", "header_metadata")
TECHNICAL = ("image", "caption", "article_position_thumbnail", "watermark", "rights_notice", "advertisement", "footer", "table", "infographic", "pull_quote")
BLOCKED_SCOPES = ("related", "advertisement", "boilerplate", "non_main", "navigation")
ZONE_MARKERS = ("da pag", "foglio", "tiratura", "diffusione", "lettori", "dir. resp", "quotidiano", "settimanale", "mensile", "superficie")
UNKNOWN_HINTS = ("pagina", "visitatori unici", "condividi", "newsletter", "cookie")
#: Columns that a layout may lack, with their kinds; they are null or false then.
OPTIONAL = {"type": "string", "raw_label": "string", "excluded": "boolean", "in_zone": "boolean", "in_thumbnail": "boolean", "boilerplate": "boolean", "boilerplate_frequency": "double", "scope": "string", "entity_kind": "string", "entity_ambiguous": "boolean", "median_font_size": "double", "bold_ratio": "double", "bold_evidence": "double", "median_opacity": "double", "pale": "boolean"}


@dataclass(frozen=True)
class WatermarkSettings:
    least: float = 0.65
    strong_chars: int = 120
    weak_chars: int = 200
    opacity: float = 0.55
    repeated: float = 0.50
    edge_x: float = 0.06
    edge_y: float = 0.10
    strip_width: float = 25.0
    strip_height: float = 150.0
    long_words: int = 18
    long_chars: int = 200


@dataclass(frozen=True)
class SeedSettings:
    least_words: int = 18
    least_font: float = 0.75
    most_font: float = 1.30
    most_upper: float = 0.85
    bold_evidence: float = 0.50
    most_bold: float = 0.70
    zone_height: float = 0.18
    zone_padding: float = 10.0
    audience_height: float = 0.16
    audience_points: float = 135.0


def complete(regions: DataFrame) -> DataFrame:
    """``regions`` with every optional column; types are unknown and flags false where they are null."""
    out = regions.withColumns({c: F.lit(None).cast(kind) for c, kind in OPTIONAL.items() if c not in regions.columns})
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c, kind in OPTIONAL.items() if kind == "boolean"} | {"type": F.coalesce("type", F.lit("unknown")), "text": F.coalesce("text", F.lit(""))})


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(text.WORD))


def of_page(aggregate: Column) -> Column:
    """``aggregate`` over a region's page; null without a page."""
    return F.when(F.col("document_id").isNotNull() & F.col("pdf_page").isNotNull(), aggregate.over(Window.partitionBy(*PAGE)))


def blocked() -> Column:
    """Whether a region's scope keeps it out of articles."""
    return F.coalesce(F.col("scope").isin(*BLOCKED_SCOPES), F.lit(False))


def usable() -> Column:
    """What every step that assigns text asks of a region: not excluded, in no zone, thumbnail or blocked scope."""
    return ~F.col("excluded") & ~F.col("in_zone") & ~F.col("in_thumbnail") & ~blocked()


def editorial() -> Column:
    return ~F.col("type").isin(*TECHNICAL) & ~F.col("excluded") & ~F.col("in_thumbnail") & ~blocked()


def open_body() -> Column:
    """A body without an owner."""
    return (F.col("type") == "article_body") & F.col("article_id").isNull() & ~F.col("excluded") & (F.col("text") != "") & geometry.valid_box(geometry.box()) & ~blocked()


def _points(condition: Column, value: float) -> Column:
    return F.when(condition, value).otherwise(0.0)


def watermark_score(pages: Column, s: WatermarkSettings = WatermarkSettings()) -> tuple[Column, Column]:
    """Score of a region as a printed watermark, and whether something other than its look supports it."""
    line = F.trim("text")
    low = F.lower(line)
    strong = (F.length(line) <= s.strong_chars) & low.rlike(r"^data\s+stampa(?:$|[^\p{L}\p{N}_])")
    weak = (F.length(line) <= s.weak_chars) & (F.contains(low, F.lit("uso esclusivo")) | F.contains(low, F.lit("cliente che lo riceve")))
    repeated = F.coalesce((pages >= 2) & (F.col("boilerplate_frequency") >= s.repeated), F.lit(False))
    width, height = F.col("page_width"), F.col("page_height")
    edge = (F.col("x0") / width <= s.edge_x) | (F.col("x1") / width >= 1 - s.edge_x) | (F.col("y0") / height <= s.edge_y) | (F.col("y1") / height >= 1 - s.edge_y)
    strip = (F.col("x1") - F.col("x0") < s.strip_width) & (F.col("y1") - F.col("y0") > s.strip_height)
    sized = (width > 0) & (height > 0)
    sure = lambda c: F.coalesce(c, F.lit(False))
    score = (
        _points(strong, 0.70) + _points(weak, 0.30) + _points(sure(F.col("median_opacity") < s.opacity), 0.12) + _points(F.col("pale"), 0.08) + _points(repeated, 0.16)
        + _points(sure(sized & edge), 0.09) + _points(sure(sized & strip), 0.08)
        - _points((F.length(line) > s.long_chars) | (word_count(line) >= s.long_words), 0.35) - _points(sure(F.col("raw_label") == "section_header"), 0.25)
    )
    return F.round(score, 4), strong | weak | repeated & sure(sized & strip)


def looks_like_thumbnail() -> Column:
    """A small upright picture in the lower right: where an article stood on its page."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    share = w / F.col("page_width") * h / F.col("page_height")
    placed = (F.col("x0") / F.col("page_width") >= 0.70) & (F.col("y0") / F.col("page_height") >= 0.60)
    picture = (F.col("type") == "image") | F.coalesce(F.col("raw_label") == "picture", F.lit(False))
    return picture & F.coalesce((w > 0) & (h > 0) & placed & (h / w >= 1.15) & (h >= 80) & (share <= 0.08) & (w <= 240) & (h <= 320), F.lit(False))


def technical(regions: DataFrame, s: WatermarkSettings = WatermarkSettings()) -> DataFrame:
    """Rights notices, watermarks, adverts and thumbnails; ``technical_reason`` says which rule decided."""
    r = complete(regions)
    if "boilerplate_frequency" in regions.columns:  # without it no line is known as repeated
        pages = regions.groupBy("document_id").agg(F.countDistinct("pdf_page").alias("_pages"))
        r = r.join(pages, "document_id", "left")
    else:
        r = r.withColumn("_pages", F.lit(None).cast("long"))
    status, _ = text.rights_notice(F.col("text"))
    score, supported = watermark_score(F.col("_pages"), s)
    r = r.withColumn("_low", F.lower("text"))
    flags = text.flags(F.col("text"), F.col("_low"))
    reason = (
        F.when(F.col("type") == "caption", "caption")
        .when(looks_like_thumbnail(), "thumbnail")
        .when(F.col("type").isin("table", "infographic", "pull_quote", "image"), "no_text")
        .when(F.col("type").isin("watermark", "rights_notice"), "known")
        .when(flags["has_rights"] & (status == "accepted"), "rights_notice")
        .when(supported & (score >= s.least), "watermark")
        .when(flags["has_ad"], "advertisement")
    )
    kind = F.when(reason == "thumbnail", "article_position_thumbnail").when(reason.isin("rights_notice", "watermark", "advertisement"), reason).otherwise(F.col("type"))
    out = r.withColumn("watermark_score", score).withColumn("technical_reason", reason).withColumn("excluded", F.col("excluded") | F.coalesce(reason.isin("known", "rights_notice", "watermark", "advertisement"), F.lit(False))).withColumn("type", kind).drop("_pages", "_low")
    # what lies in a thumbnail is no text of the page
    box = ("x0", "y0", "x1", "y1")
    inner = F.when(F.col("type") == "article_position_thumbnail", F.struct("region_ord", *box))
    out = out.withColumn("_thumbs", of_page(F.collect_list(inner)))
    within = F.exists("_thumbs", lambda t: (F.col("region_ord") != t["region_ord"]) & (geometry.containment(geometry.box(), tuple(t[c] for c in box), 1.0) >= 0.80))
    out = out.withColumn("_in", within)
    found = F.coalesce("_in", F.lit(False))
    return out.withColumns({"in_thumbnail": F.col("in_thumbnail") | found, "excluded": F.col("excluded") | found, "type": F.when(found & ~F.col("type").isin("watermark", "rights_notice", "article_position_thumbnail"), "unknown").otherwise(F.col("type"))}).drop("_in", "_thumbs")


def audience_metadata(s: SeedSettings = SeedSettings()) -> Column:
    """A technical sheet (circulation, readers, editor) in the band at the top of a page; ``_low`` is the text in lower case."""
    limit = F.least(F.lit(s.audience_points), s.audience_height * F.col("page_height"))
    placed = F.coalesce((F.col("page_height") > 0) & geometry.valid_box(geometry.box()) & (F.col("y0") >= 0) & (F.col("y1") <= limit), F.lit(False))

    def of(low: Column) -> Column:
        labelled = low.rlike(r"\b(?:tiratura|diffusione|lettori|superficie)\s*[:=]") | low.rlike(r"\bdir\.?\s*resp\.?\s*:") | low.rlike(r"^(?:quotidiano|settimanale|mensile)\s*[-–:]")
        labels = F.size(F.array_distinct(F.regexp_extract_all(low, F.lit(r"\b(?:tiratura|diffusione|lettori)\b"), F.lit(0))))
        absent = (labels >= 2) & low.rlike(r"\bnon disponibili\b|\bn\.?d\.?(?:$|[^a-z0-9])|\d")
        marked = low.rlike(r"\b(?:superficie|tiratura|diffusione|lettori|quotidiano)\b") | low.rlike(r"\bdir\.?\s*resp\b")
        return marked & (labelled | absent)

    return placed & text.bound(text.collapse(F.col("_low")), of)


def seed_reason(s: SeedSettings = SeedSettings()) -> Column:
    """Why a region is metadata of a clipping; null if it isn't.  ``_low`` is the text in lower case."""
    low = F.col("_low")
    f = text.flags(F.col("text"), low)
    from_page = F.contains(low, F.lit("da pag"))
    known = lambda kind: F.coalesce((F.col("entity_kind") == kind) & ~F.col("entity_ambiguous"), F.lit(False))
    marks = from_page.cast("int") + f["has_foglio"].cast("int") + f["has_date"].cast("int")
    return (
        F.when(known("source"), "source")
        .when(known("provider"), "provider")
        .when(marks >= 2, "composite_clipping_metadata")
        .when(from_page, "original_page_marker")
        .when(f["has_foglio"], "clipping_sheet_marker")
        .when(f["has_date"] & (F.length("text") <= 40), "short_date_marker")
        .when(F.col("raw_label") == "page_header", "page_header")
        .when(audience_metadata(s), "audience_metadata_marker")
    )


# Reasons and the types that they give.
SEED_TYPES = {"source": "source_name", "provider": "press_review_provider", "composite_clipping_metadata": "header_metadata", "original_page_marker": "original_page", "clipping_sheet_marker": "clipping_sheet", "short_date_marker": "publication_date", "page_header": "header_metadata", "audience_metadata_marker": "header_metadata"}


def metadata_seeds(regions: DataFrame, s: SeedSettings = SeedSettings()) -> DataFrame:
    """Types of metadata for regions that are neither technical nor excluded; ``seed_reason`` says why."""
    r = complete(regions).withColumn("_low", F.lower("text"))
    open_ = ~F.col("type").isin(*TECHNICAL) & ~F.col("excluded") & (F.col("text") != "")
    reason = F.when(open_, F.when(F.col("type").isin(*SEEDS), "preexisting_type").otherwise(seed_reason(s)))
    r = r.withColumn("seed_reason", reason)
    types = F.create_map(*[F.lit(x) for pair in SEED_TYPES.items() for x in pair])
    kind = F.coalesce(F.try_element_at(types, F.col("seed_reason")), F.col("type"))
    return r.withColumn("type", kind).withColumn("excluded", F.col("excluded") | F.coalesce(F.col("seed_reason") != "preexisting_type", F.lit(False))).drop("_low")


def header_zone(regions: DataFrame, s: SeedSettings = SeedSettings()) -> DataFrame:
    """The zone at a page's top that its seeds span; regions wholly in it are metadata or left open."""
    r = complete(regions)
    limit = s.zone_height * F.col("page_height")
    upright = (F.col("x1") - F.col("x0") < 30) & (F.col("y1") - F.col("y0") > 120)
    seed = F.col("type").isin(*SEEDS) & F.coalesce((F.col("y0") <= limit) & ~upright, F.lit(False))
    r = r.withColumns({"_low": F.lower("text"), "_bottom": of_page(F.max(F.when(seed, F.col("y1")))), "_limit": of_page(F.max(F.when(seed, limit)))})
    r = r.withColumn("zone_bottom", F.least(F.col("_bottom") + s.zone_padding, "_limit")).drop("_bottom", "_limit")
    protected = F.col("type").isin(*TECHNICAL) | F.col("excluded") & ~F.col("type").isin(*SEEDS)
    inside = ~protected & F.coalesce(geometry.valid_box(geometry.box()) & (F.col("y0") >= 0) & (F.col("y1") <= F.col("zone_bottom")), F.lit(False))
    low = F.col("_low")
    marked = F.coalesce(F.col("raw_label") == "page_header", F.lit(False))
    for m in ZONE_MARKERS:
        marked = marked | F.contains(low, F.lit(m))
    role = F.when(inside, F.when(F.col("type").isin(*SEEDS), "seed").when(marked, "metadata_marker").otherwise("unresolved_header_content"))
    return r.withColumn("zone_role", role).withColumns({"in_zone": F.col("in_zone") | F.col("zone_role").isNotNull(), "type": F.when(F.col("zone_role") == "metadata_marker", "header_metadata").otherwise(F.col("type")), "excluded": F.col("excluded") | F.coalesce(F.col("zone_role") != "seed", F.lit(False))}).drop("_low")


def like_location() -> Column:
    low = F.col("_low")
    f = text.flags(F.col("text"), low)
    vetoes = f["has_url"] | f["has_foglio"] | f["has_superficie"] | f["has_tiratura"] | f["has_diffusione"] | f["has_lettori"] | f["has_quotidiano"] | f["has_newsletter"] | f["has_related"] | f["has_author"] | low.rlike(r"\bdir\.?\s*resp\b")
    named = F.coalesce((F.col("entity_kind") == "location") & ~F.col("entity_ambiguous"), F.lit(False))
    return named & ~low.rlike("[,:]") & (F.col("_words") <= 5) & (F.length("text") <= 100) & ~vetoes


def seed_veto(body_font: Column, s: SeedSettings = SeedSettings()) -> Column:
    """What speaks against a region as a seed of body text; null if nothing does.  ``_low`` and ``_words`` are its text in lower case and its words' number."""
    low, n = F.col("_low"), F.col("_words")
    f = text.flags(F.col("text"), low)
    ratio = F.col("median_font_size") / body_font
    sure = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when((F.col("type") != "unknown") | F.col("excluded") | F.col("in_zone") | F.col("boilerplate") | F.col("in_thumbnail"), "protected_or_boilerplate")
        .when(blocked(), "external_content_scope")
        .when((F.col("text") == "") | ~sure(F.col("raw_label") == "text") | (n < s.least_words), "insufficient_text_or_label")
        .when(f["has_url"] | f["has_navigation"] | f["has_newsletter"] | f["has_share"] | f["has_ad"] | f["has_rights"] | f["has_watermark"], "navigation_or_technical_marker")
        .when(f["has_foglio"] | F.contains(low, F.lit("da pag")) | audience_metadata(s), "clipping_metadata_marker")
        .when(f["index_entry"], "index_entry_marker")
        .when(sure(F.col("entity_kind").isin("source", "provider")), "source_or_provider_match")
        .when(text.uppercase_ratio(F.col("text")) > s.most_upper, "mostly_uppercase")
        .when(sure((body_font > 0) & (F.col("median_font_size") > 0) & ~ratio.between(s.least_font, s.most_font)), "font_size_unlike_body")
        .when(sure((F.col("bold_evidence") >= s.bold_evidence) & (F.col("bold_ratio") > s.most_bold)), "predominantly_bold")
    )


def semantic(regions: DataFrame, s: SeedSettings = SeedSettings()) -> DataFrame:
    """Locations, navigation, related content and body seeds; ``seed_veto`` says why a text is no seed."""
    r = complete(regions).withColumns({"_low": F.lower("text"), "_words": word_count(F.col("text"))})
    usual = (F.col("raw_label") == "text") & (F.col("text") != "") & ~F.col("excluded") & ~F.col("in_zone") & (F.col("type") == "unknown") & (F.col("_words") >= s.least_words) & (F.col("median_font_size") > 0)
    r = r.withColumn("_body_font", of_page(F.median(F.when(usual, F.col("median_font_size")))))
    r = r.withColumn("seed_veto", seed_veto(F.col("_body_font"), s))
    f, n = text.flags(F.col("text"), F.col("_low")), F.col("_words")
    fixed = F.col("excluded") | F.col("in_zone") | F.col("type").isin(*SEEDS) | F.col("type").isin(*TECHNICAL) | F.col("type").isin("article_section_header", "article_kicker")
    kind = (
        F.when(fixed, F.col("type"))
        .when(like_location(), "location")
        .when(f["has_navigation"] | f["has_url"] & (n <= 8), "navigation")
        .when(f["has_related"] | f["has_newsletter"] | f["has_share"], "related_content")
        .when((F.col("type") == "unknown") & F.col("seed_veto").isNull(), "article_body")
        .otherwise(F.col("type"))
    )
    return r.withColumn("type", kind).drop("_body_font", "_low", "_words")


def refined_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with unknown ones turned into web pages where a web page of their section is next to them.

    ``pages`` has document_id, pdf_page, page_type, section, clipping_markers, index_like and
    supported.  The type found for a page counts for the next one, so unknown pages in a
    row follow the web page before them: a run of such pages is reached from its first.
    """
    w = Window.partitionBy("document_id").orderBy("pdf_page")
    able = (F.col("page_type") == "unknown") & (F.col("clipping_markers") < 1) & ~F.col("index_like") & F.col("supported")
    meets = lambda a, b: (F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))) | F.coalesce(a, F.lit("")).isin("") | F.coalesce(b, F.lit("")).isin("")
    p = pages.withColumns({"_able": able, "_before": F.lag("page_type").over(w), "_gap": F.col("pdf_page") - F.lag("pdf_page").over(w), "_section": F.lag("section").over(w), "_after": F.lead("page_type").over(w), "_ahead": F.lead("pdf_page").over(w) - F.col("pdf_page"), "_later": F.lead("section").over(w)})
    linked = F.coalesce((F.col("_gap") == 1) & meets(F.col("section"), F.col("_section")), F.lit(False))
    start = ~F.col("_able") | ~linked  # a run of able pages goes on while pages are linked
    seeded = F.col("_able") & (linked & (F.coalesce("_before", F.lit("")) == "web") | F.coalesce((F.col("_ahead") == 1) & (F.col("_after") == "web") & meets(F.col("section"), F.col("_later")), F.lit(False)))
    p = p.withColumn("_seeded", seeded).withColumn("_run", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    reached = F.max("_seeded").over(Window.partitionBy("document_id", "_run").orderBy("pdf_page").rowsBetween(Window.unboundedPreceding, 0))
    return p.withColumn("page_type", F.when(F.col("_able") & reached, "web").otherwise(F.col("page_type"))).select(pages.columns)


# Section labels and the names of sections.
SECTIONS = {"stampa locale": "STAMPA_LOCALE", "stampa nazionale": "STAMPA_NAZIONALE", "web": "WEB", "radio": "RADIO", "tv": "TV", "televisione": "TELEVISIONE"}


def sections(regions: DataFrame) -> DataFrame:
    """(document_id, pdf_page, section): the one section that labels in footers and headers name, else null."""
    r = complete(regions)
    names = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    eligible = ~F.col("in_thumbnail") & (F.col("type").isin("footer", "header_metadata") | F.col("in_zone"))
    label = F.when(eligible, F.try_element_at(names, F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))))
    return r.groupBy(*PAGE).agg(F.when(F.countDistinct(label) == 1, F.max(label)).alias("section"))
