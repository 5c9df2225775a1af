"""From regions to audited article records, stage by stage.

Every stage takes regions and returns regions with more columns; what it decided
is kept as rows of ``decisions``.  Keys are (document_id, pdf_page) throughout.  What a
stage decides for a page is a window over it, so a region's text is classified once and
rows go to the kernels and to the records once each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import geometry, text
from layoutlake.operators import kernels
from layoutlake.operators.classify import of_page

PAGE = ["document_id", "pdf_page"]


@dataclass(frozen=True)
class RecordSettings:
    title_chars: int = 60
    title_threshold: float = 0.20
    title_margin: float = 0.0
    least_coverage: float = 0.90
    most_unassigned: int = 150
    least_confidence: float = 0.65
    repeated_pages: float = 0.50


def classify(regions: DataFrame, s: RecordSettings) -> DataFrame:
    """kind: rights, watermark, boilerplate, metadata, title, body; the first that fits."""
    t = F.col("text")
    f = text.flags(t)
    status, _ = text.rights_notice(t)
    marked = regions.withColumn("pattern", text.boilerplate(t)["pattern"])
    groups = marked.filter("pattern is not null").groupBy("document_id", "pattern").agg(F.countDistinct("pdf_page").alias("pages")).filter("pages >= 2")
    total = regions.groupBy("document_id").agg(F.countDistinct("pdf_page").alias("n_pages"))
    often = groups.join(total, "document_id").filter(F.col("pages") / F.col("n_pages") >= s.repeated_pages).select("document_id", "pattern", F.lit(True).alias("repeated"))
    out = marked.join(often, ["document_id", "pattern"], "left")
    kind = (
        F.when(status == "accepted", "rights")
        .when(f["has_watermark"] & (F.length(t) <= 200), "watermark")
        .when(F.coalesce("repeated", F.lit(False)), "boilerplate")
        .when(f["has_foglio"] | f["has_tiratura"] | f["section_label"], "metadata")
        .when(text.stamp_code(t) | (F.trim(t) == ""), "chrome")
        .when(F.length(t) < s.title_chars, "title")
        .otherwise("body")
    )
    return out.withColumn("kind", kind).drop("pattern", "repeated")


def titles(regions: DataFrame, s: RecordSettings) -> DataFrame:
    """``regions`` with ``is_title``: the page's best title by score, if it reaches the threshold and leads the next by the margin."""
    score = F.when(F.col("raw_label") == "section_header", 0.12).otherwise(0.0) + F.when(F.col("x1") - F.col("x0") >= 0.25 * F.col("page_width"), 0.08).otherwise(0.0) + F.when(F.col("y0") <= 0.55 * F.col("page_height"), 0.08).otherwise(0.0) + 0.12 * text.uppercase_ratio(F.col("text"))
    each = F.when(F.col("kind") == "title", F.struct((-F.round(score, 4)).alias("less"), "region_ord"))
    best, next_ = F.get("_titles", F.lit(0)), F.get("_titles", F.lit(1))
    lead = F.coalesce(next_["less"], F.lit(0.0)) - best["less"]
    accepted = (-best["less"] >= s.title_threshold) & (lead >= s.title_margin - 1e-12)
    found = regions.withColumn("_score", each).withColumn("_titles", of_page(F.collect_list("_score"))).withColumn("_titles", F.slice(F.array_sort("_titles"), 1, 2))
    return found.withColumn("is_title", F.coalesce(accepted & (best["region_ord"] == F.col("region_ord")), F.lit(False))).drop("_score", "_titles")


def seeded(regions: DataFrame) -> DataFrame:
    """``regions`` with article_id: that of the page's title for the title and for the body nearest below it."""
    identity = F.concat(F.lit("article_"), F.substring(F.sha2(F.concat(F.col("document_id"), F.lit("\0"), F.concat_ws(":", "pdf_page", F.col("_title.region_ord"))), 256), 1, 16))
    title = F.when(F.col("is_title"), F.struct("region_ord", "x0", "y0", "x1", "y1"))
    r = regions.withColumn("_title", of_page(F.max(title)))
    box = tuple(F.col(f"_title.{c}") for c in ("x0", "y0", "x1", "y1"))
    below = (F.col("kind") == "body") & (F.col("y0") >= F.col("_title.y1")) & (geometry.horizontal_overlap(box, geometry.box()) >= 0.2)
    near = F.when(below, F.struct(geometry.vertical_gap(box, geometry.box()).alias("gap"), "region_ord"))
    r = r.withColumn("_first", of_page(F.min(near)))
    owned = F.col("is_title") | F.coalesce(F.col("region_ord") == F.col("_first.region_ord"), F.lit(False))
    return r.withColumn("article_id", F.when(owned, identity)).drop("is_title", "_title", "_first")


def members(regions: DataFrame) -> DataFrame:
    """Owners spread over bodies, with each region's place in the page's reading order."""
    columns = [*PAGE, "region_ord", "kind", "text", "x0", "y0", "x1", "y1", "page_width", "page_height", "article_id"]
    return kernels.members_in_order(regions.select(*columns))


def records(regions: DataFrame, s: RecordSettings = RecordSettings()) -> DataFrame:
    """One record for each article: title, body, coverage, confidence, warnings, status."""
    kinds = classify(regions, s)
    body, owned = F.col("kind") == "body", F.col("article_id").isNotNull()
    part = F.struct("place", "text")
    grouped = members(seeded(titles(kinds, s))).groupBy(*PAGE, "article_id").agg(
        F.min_by("text", F.when(F.col("kind") == "title", F.col("place"))).alias("title"),
        F.sort_array(F.collect_list(F.when(body & owned, part))).alias("parts"),
        F.round(F.avg(F.when(body, F.col("score"))), 4).alias("clustering"),
        F.sum(F.when(body, text.visible_chars(F.col("text"))).otherwise(0)).alias("chars"),
    )
    chars = lambda of: of_page(F.sum(F.when(of, F.col("chars")).otherwise(0)))
    out = grouped.withColumns({"assigned": chars(owned), "unassigned": chars(~owned)}).filter(owned)
    coverage = F.col("assigned") / F.nullif(F.col("assigned") + F.col("unassigned"), F.lit(0))
    confidence = F.round(0.7 * 0.85 + 0.3 * F.coalesce("clustering", F.lit(0.0)), 4)
    text_ = text.scrub_rights(F.array_join(F.col("parts.text"), "\n\n"))
    warnings = F.array_compact(F.array(F.when(F.size("parts") == 0, "no_body"), F.when(coverage < s.least_coverage, "low_coverage"), F.when(F.col("unassigned") > s.most_unassigned, "unassigned_text"), F.when(confidence < s.least_confidence, "low_confidence")))
    return out.select(*PAGE, "article_id", "title", text_.alias("body"), F.size("parts").alias("n_parts"), F.round(coverage, 4).alias("coverage"), confidence.alias("confidence"), warnings.alias("warnings"), F.when(F.size(warnings) == 0, "ready").otherwise("review_required").alias("finalization_status"))


def document_report(found: DataFrame) -> DataFrame:
    """Articles, ready share and warning counts of each document."""
    # records by their warnings first, so that one pass gives both counts; decimals add up the same in any order
    few = found.groupBy("document_id", "warnings").agg(F.count("*").alias("n"), F.count_if(F.col("finalization_status") == "ready").alias("ready"), F.sum(F.col("coverage").cast("decimal(20,4)")).alias("coverage"), F.count("coverage").alias("covered"))
    each = few.groupBy("document_id").agg(F.sum("n").alias("n_articles"), F.sum("ready").alias("n_ready"), F.round(F.sum("coverage").cast("double") / F.nullif(F.sum("covered"), F.lit(0)), 4).alias("coverage"), F.collect_list(F.struct("warnings", "n")).alias("_w"))
    names = F.array_sort(F.array_distinct(F.flatten("_w.warnings")))
    count = lambda w: F.aggregate("_w", F.lit(0).cast("long"), lambda n, x: n + F.when(F.array_contains(x["warnings"], w), x["n"]).otherwise(0))
    issues = F.when(F.size(names) > 0, F.map_from_arrays(names, F.transform(names, count)))
    return each.select("document_id", "n_articles", "n_ready", "coverage", issues.alias("issues"), F.round(F.col("n_ready") / F.col("n_articles"), 4).alias("ready_rate"))
