"""Page profiles: words in the body band, image coverage and whether a page needs OCR."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = ["document_id", "pdf_page"]
GRID = 32
POLICIES = ("auto", "aggressive", "all")


@dataclass(frozen=True)
class ProfileSettings:
    header: float = 0.16
    footer: float = 0.10
    least_body_words: int = 30
    coverage_without_text: float = 0.05
    coverage_with_sparse_text: float = 0.05
    aggressive_coverage: float = 0.12
    aggressive_body_words: int = 120


def image_coverage(boxes: DataFrame) -> DataFrame:
    """(document_id, pdf_page, image_coverage): share of a grid that the union of the boxes touches."""
    cell = lambda c, size: F.floor(GRID * F.col(c) / F.col(size))
    left, right = F.greatest(F.lit(0), cell("x0", "page_width")), F.least(F.lit(GRID - 1), cell("x1", "page_width"))
    top, bottom = F.greatest(F.lit(0), cell("y0", "page_height")), F.least(F.lit(GRID - 1), cell("y1", "page_height"))
    inside = boxes.filter((left <= right) & (top <= bottom))
    # a grid row's cells are the bits of one number, so that a page has GRID rows at most
    rows = inside.select(*PAGE, (F.pow(F.lit(2.0), right + 1) - F.pow(F.lit(2.0), left)).cast("long").alias("bits"), F.explode(F.sequence(top, bottom)).alias("row"))
    return rows.groupBy(*PAGE, "row").agg(F.bit_or("bits").alias("bits")).groupBy(*PAGE).agg((F.sum(F.bit_count("bits")) / (GRID * GRID)).alias("image_coverage"))


def decision(words: Column, body_words: Column, coverage: Column, policy: str, s: ProfileSettings = ProfileSettings()) -> tuple[Column, Column]:
    """Whether a page is to be read by OCR, and why."""
    if policy not in POLICIES:
        raise ValueError(f"no such policy: {policy}")
    aggressive = F.lit(policy == "aggressive") & (body_words < s.aggressive_body_words) & (coverage >= s.aggressive_coverage)
    reason = (
        F.when(F.lit(policy == "all"), "ocr_policy_all")
        .when((words == 0) & (coverage >= s.coverage_without_text), "no_pdf_text_with_significant_image")
        .when((body_words < s.least_body_words) & (coverage >= s.coverage_with_sparse_text), "sparse_body_text_with_significant_image")
        .when(aggressive, "aggressive_ocr_low_native_body_coverage")
        .otherwise("native_text_sufficient_or_no_ocr_evidence")
    )
    return reason != "native_text_sufficient_or_no_ocr_evidence", reason


def profile(pages: DataFrame, words: DataFrame, boxes: DataFrame, policy: str = "auto", s: ProfileSettings = ProfileSettings()) -> DataFrame:
    """Profiles of ``pages``; ``words`` has n words of a box (y0, y1, page_height), ``boxes`` are images."""
    band = (F.col("y0") >= s.header * F.col("page_height")) & (F.col("y1") <= (1 - s.footer) * F.col("page_height"))
    counted = words.groupBy(*PAGE).agg(F.sum("n").alias("words"), F.sum(F.when(band, F.col("n")).otherwise(0)).alias("body_words"))
    out = pages.join(counted, PAGE, "left").join(image_coverage(boxes), PAGE, "left").na.fill({"words": 0, "body_words": 0, "image_coverage": 0.0})
    run, reason = decision(F.col("words"), F.col("body_words"), F.col("image_coverage"), policy, s)
    return out.withColumn("run_ocr", run).withColumn("reason", reason)
