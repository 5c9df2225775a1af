"""Web articles on printed pages: main content, zones with their headers, identity, trailing marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import geometry, text
from layoutlake.operators import classify, headers, stacks

PAGE = ["document_id", "pdf_page"]
# Names of icons and controls that a printed page shows as text.
CONTROLS = ("south", "chevron_right", "chevron_left", "keyboard_arrow_down", "menu", "arrow_back", "arrow_forward", "oggi", "next article")
TRAILING = r"(?i)(?:\s*[-–—|]?\s*data\s+stampa\s*\d{3,8})+\s*$"


def main_content(regions: DataFrame, least_overlap: float = 0.5) -> DataFrame:
    """Bodies with their scope: main in the page's widest-read column, non_main elsewhere."""
    bodies = regions.filter(F.col("type") == "article_body")
    main = stacks.main_columns(bodies).select(*PAGE, F.col("left_edge").alias("m_x0"), F.col("right_edge").alias("m_x1"))
    width = F.least(F.col("x1") - F.col("x0"), F.col("m_x1") - F.col("m_x0"))
    over = F.greatest(F.lit(0.0), F.least("x1", "m_x1") - F.greatest("x0", "m_x0")) / F.greatest(width, F.lit(1.0))
    return bodies.join(main, PAGE).select(*PAGE, "region_ord", F.when(over >= least_overlap, "main").otherwise("non_main").alias("scope"))


def zones(regions: DataFrame, gap: float = 40.0, overlap: float = 0.55, lookback: float = 0.12) -> DataFrame:
    """Runs of bodies as zones with the regions that stand as headers above them.

    (…, zone, n_bodies, top, n_headers): a header begins no further above the zone than a
    share of the page (120 points at least) and ends above it.
    """
    runs = headers.vertical_runs(regions, gap, overlap)
    b = regions.filter(F.col("type") == "article_body").join(runs, [*PAGE, "region_ord"])
    z = b.groupBy(*PAGE, F.col("run").alias("zone")).agg(F.count("*").alias("n_bodies"), *(c.alias(f"z_{n}") for c, n in zip((F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")), ("x0", "y0", "x1", "y1"), strict=True)), F.max("page_height").alias("height"))
    low = F.trim(F.lower("text"))
    h = regions.filter((F.col("type") != "article_body") & (F.trim("text") != "") & ~low.isin(*CONTROLS)).select(*PAGE, "region_ord", *(F.col(c).alias(f"h_{c}") for c in ("x0", "y0", "x1", "y1")))
    start = F.greatest(F.lit(0.0), F.col("z_y0") - F.greatest(F.lit(120.0), lookback * F.col("height")))
    found = z.join(h, PAGE).filter((F.col("h_y0") >= start) & (F.col("h_y1") <= F.col("z_y0") + 4) & (geometry.horizontal_overlap(geometry.box("h_"), geometry.box("z_")) >= 0.30)).groupBy(*PAGE, "zone").agg(F.count("*").alias("n_headers"))
    return z.join(found, [*PAGE, "zone"], "left").select(*PAGE, "zone", "n_bodies", F.col("z_y0").alias("top"), F.coalesce("n_headers", F.lit(0)).alias("n_headers"))


def identity(titles: DataFrame) -> DataFrame:
    """``titles`` with status and reason: controls and blocked scopes are no headlines unless the index has them.

    Columns: text, scope, excluded, index_entry_id.
    """
    known = F.col("index_entry_id").isNotNull()
    control = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")).isin(*CONTROLS)
    outside = F.col("excluded") | F.coalesce(F.col("scope").isin(*classify.BLOCKED_SCOPES), F.lit(False))
    reason = F.when(control & ~known, "ui_control_not_headline").when(outside & known, "index_vs_non_main_scope").when(outside, "non_editorial_scope")
    status = F.when(reason.isNull(), "accepted").when(reason == "index_vs_non_main_scope", "conflict").otherwise("rejected")
    return titles.withColumns({"reason": reason, "status": status})


def cleaned_suffix(regions: DataFrame, least: float = 0.78, most_chars: int = 240) -> DataFrame:
    """Texts without the printed marks at their end, where something besides the text itself backs them.

    (…, region_ord, text, score, cleaned): .60, .15 for marks at this place on several pages, .10
    for a sheet with the number on the page, .10 in the upper band.
    """
    m = stacks.marks(regions).groupBy(*PAGE, "region_ord").agg(F.max("in_header").alias("in_header"), F.max("repeated_pages").alias("repeated"))
    r = regions.filter((F.length("text") <= most_chars) & F.col("text").rlike(TRAILING)).join(m, [*PAGE, "region_ord"])
    points = lambda c, v: F.when(c, v).otherwise(0.0)
    score = F.round(0.60 + points(F.col("repeated") >= 2, 0.15) + points(F.col("in_header"), 0.10) + points(F.coalesce(F.col("y0") / F.col("page_height") <= 0.18, F.lit(False)), 0.10), 4)
    cleaned = ((F.col("repeated") >= 2) | F.col("in_header")) & (score >= least)
    return r.select(*PAGE, "region_ord", F.when(cleaned, F.rtrim(F.regexp_replace("text", TRAILING, ""))).otherwise(F.col("text")).alias("text"), score.alias("score"), cleaned.alias("cleaned"))


def first_url(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"https?://[^\s<>\"']+", 0), F.lit(""))


def first_letter(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\p{L}", 0), F.lit(""))


def page_texts(regions: DataFrame) -> DataFrame:
    """(…, text, url, first_letter) of each page: its regions in order, its first address, its first letter."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("region_ord", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"])
    p = regions.groupBy(*PAGE).agg(F.array_join(ordered, "\n").alias("text"))
    return p.select(*PAGE, "text", first_url(F.col("text")).alias("url"), first_letter(F.col("text")).alias("first_letter"))


def words(c: Column) -> Column:
    return F.size(text.words(c))
