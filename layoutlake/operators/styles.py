"""Styles of regions from text spans, and a second reading merged into the first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import geometry

PAGE = ["document_id", "pdf_page"]
# Words of font names that tell a trait, and those that tell its absence; flag bits.
BOLD, ITALIC, PLAIN = ("bold", "black", "semibold", "demibold"), ("italic", "oblique"), ("regular", "normal", "roman", "book")
BOLD_BIT, ITALIC_BIT = 16, 2


@dataclass(frozen=True)
class StyleSettings:
    #: Share of a span's area inside a region.
    inside: float = 0.65
    #: Points of height by which spans and regions are brought together.
    bucket: float = 64.0


def _has(name: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.lower(name), F.lit(w))
    return out


def trait(font: Column, flags: Column, words: tuple[str, ...], bit: int) -> Column:
    """Whether a span has a trait: true, false, or null where neither name nor flags say so."""
    return F.when(_has(font, words) | F.coalesce(flags.bitwiseAND(bit) > 0, F.lit(False)), True).when(_has(font, PLAIN), False)


def region_styles(regions: DataFrame, spans: DataFrame, s: StyleSettings = StyleSettings()) -> DataFrame:
    """Fonts, sizes, traits and opacity of each region that has spans in it.

    ``spans`` has boxes, font, size, flags, chars and opacity.  Spans meet regions of their
    page in bands of height, so a long page isn't compared all with all.  Of equally
    frequent fonts the first by name is dominant.
    """
    band = lambda y: F.floor(y / s.bucket)
    r = regions.select(*PAGE, "region_ord", *(F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1"))).withColumn("band", F.explode(F.sequence(band(F.col("r_y0")), band(F.col("r_y1")))))
    # a span counts in the band of its middle; what lies in it by more than half is met there
    p = spans.select(*PAGE, *(F.col(c).alias(f"s_{c}") for c in ("x0", "y0", "x1", "y1")), "font", "size", "flags", "chars", "opacity").withColumn("band", band((F.col("s_y0") + F.col("s_y1")) / 2))
    hits = r.join(p, [*PAGE, "band"]).filter(geometry.containment(geometry.box("s_"), geometry.box("r_")) > s.inside)
    bold, italic = trait(F.col("font"), F.col("flags"), BOLD, BOLD_BIT), trait(F.col("font"), F.col("flags"), ITALIC, ITALIC_BIT)
    hits = hits.withColumns({"bold": bold, "italic": italic})
    weight = lambda c: F.sum(F.when(c, F.greatest("chars", F.lit(1))).otherwise(0))
    key = [*PAGE, "region_ord"]
    ratios = []
    for name in ("bold", "italic"):
        known = weight(F.col(name).isNotNull())
        ratios += [F.try_divide(weight(F.coalesce(name, F.lit(False))), F.nullif(known, F.lit(0))).alias(f"{name}_ratio"), F.coalesce(F.try_divide(known, F.sum(F.greatest("chars", F.lit(1)))), F.lit(0.0)).alias(f"{name}_evidence")]
    fonts = hits.groupBy(*key, "font").agg(F.count("*").alias("n")).groupBy(*key).agg(F.min(F.struct((-F.col("n")).alias("less"), "font"))["font"].alias("dominant_font"), F.sort_array(F.collect_set("font")).alias("font_names"))
    sums = hits.groupBy(*key).agg(F.count("*").alias("n_spans"), F.median("size").alias("median_font_size"), F.max("size").alias("max_font_size"), F.median("opacity").alias("median_opacity"), *ratios)
    return sums.join(fonts, key)


def second_pass(first: DataFrame, second: DataFrame, overlap: float = 0.60) -> DataFrame:
    """(…, region_ord, status) of the regions of a second reading: merged or appended.

    Both have region_ord, t (the collapsed text) and boxes.  A region is merged if one of the
    first reading has its text and covers enough of it.
    """
    a = first.select(*PAGE, "t", *(F.col(c).alias(f"a_{c}") for c in ("x0", "y0", "x1", "y1")))
    hit = second.join(a, [*PAGE, "t"]).filter(geometry.containment(geometry.box(), geometry.box("a_")) >= overlap).select(*PAGE, "region_ord").distinct().withColumn("hit", F.lit(True))
    return second.join(hit, [*PAGE, "region_ord"], "left").select(*PAGE, "region_ord", F.when(F.col("hit"), "merged").otherwise("appended").alias("status"))
