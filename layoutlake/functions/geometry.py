"""Boxes are (x0, y0, x1, y1) columns in points, origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def valid_box(b) -> Column:
    """Four finite coordinates with positive width and height."""
    finite = F.lit(True)
    for c in b:
        finite = finite & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return finite & (b[2] > b[0]) & (b[3] > b[1])


def horizontal_overlap(a, b) -> Column:
    """Overlap over the narrower width; 0 if either has none."""
    width = F.least(a[2] - a[0], b[2] - b[0])
    return F.when(width > 0, F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) / width).otherwise(0.0)


def horizontal_overlap_floor(a, b) -> Column:
    """As ``horizontal_overlap``, with a least width of one point."""
    width = F.greatest(F.least(a[2] - a[0], b[2] - b[0]), F.lit(1.0))
    return F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) / width


def vertical_gap(a, b) -> Column:
    return F.greatest(F.lit(0.0), a[1] - b[3], b[1] - a[3])


def containment(inner, outer, least_area: float = 0.0) -> Column:
    """Share of ``inner``'s area inside ``outer``; an area below ``least_area`` counts as that."""
    w = F.greatest(F.lit(0.0), F.least(inner[2], outer[2]) - F.greatest(inner[0], outer[0]))
    h = F.greatest(F.lit(0.0), F.least(inner[3], outer[3]) - F.greatest(inner[1], outer[1]))
    area = F.greatest((inner[2] - inner[0]) * (inner[3] - inner[1]), F.lit(least_area))
    return F.when(area > 0, w * h / area).otherwise(0.0)


def relative(b, width: Column, height: Column) -> dict[str, Column]:
    """Page-relative box and the area flags."""
    rx0, ry0, rx1, ry1 = b[0] / width, b[1] / height, b[2] / width, b[3] / height
    cx, cy = (rx0 + rx1) / 2, (ry0 + ry1) / 2
    return {"rx0": rx0, "ry0": ry0, "rx1": rx1, "ry1": ry1, "in_top": ry0 < 0.15, "in_bottom": ry1 > 0.80, "in_left": rx0 < 0.35, "in_right": rx1 > 0.60, "in_centre": cx.between(0.25, 0.75) & cy.between(0.25, 0.75)}


def lane_x(x0: Column, width: Column) -> Column:
    """Left edge as a share of the page width, 595 points where it is unknown."""
    return x0 / F.coalesce(F.nullif(width, F.lit(0.0)), F.lit(595.0))


def position(cx: Column, cy: Column) -> tuple[Column, Column]:
    """Thirds of the page."""
    third = lambda c, names: F.when(c < 0.33, names[0]).when(c < 0.66, names[1]).otherwise(names[2])
    return third(cx, ("left", "center", "right")), third(cy, ("top", "middle", "bottom"))


def prominence(page_score: Column, area_score: Column, vertical_score: Column) -> tuple[Column, Column]:
    score = F.round(0.4 * page_score + 0.4 * area_score + 0.2 * vertical_score, 4)
    return score, F.when(score >= 0.70, "high").when(score >= 0.40, "medium").otherwise("low")


# Upper ends of original page numbers, lower ends of relative areas, and their scores.
PAGE_SCORES = ((1, 1.0), (3, 0.85), (5, 0.70), (10, 0.50), (20, 0.30))
AREA_SCORES = ((0.35, 1.0), (0.25, 0.85), (0.15, 0.65), (0.08, 0.45), (0.03, 0.25))


def prominence_of(original_page: Column, area: Column, cy: Column) -> tuple[Column, Column]:
    """Score and label from the original page, the relative area and the height of the centre."""
    page = F.when(original_page.isNull(), 0.35)
    for last, score in PAGE_SCORES:
        page = page.when(original_page <= last, score)
    size = F.when(F.lit(False), 0.0)
    for least, score in AREA_SCORES:
        size = size.when(area >= least, score)
    high = F.when(cy < 0.33, 1.0).when(cy < 0.66, 0.60).otherwise(0.30)
    return prominence(page.otherwise(0.20), size.otherwise(0.10), high)


def union_box(prefix: str = "") -> list[Column]:
    """Aggregates that give the box around all boxes of a group."""
    return [F.min(f"{prefix}x0").alias("x0"), F.min(f"{prefix}y0").alias("y0"), F.max(f"{prefix}x1").alias("x1"), F.max(f"{prefix}y1").alias("y1")]


def dark_box(pixels: DataFrame, key: list[str], threshold: int = 110) -> DataFrame:
    """The half-open box around the pixels (x, y, v) that are as dark as ``threshold``; no row for an image without any."""
    box_ = [F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1")]
    return pixels.filter(F.col("v") <= threshold).groupBy(*key).agg(*box_, F.count("*").alias("n_dark"))
