"""Review-index entries: from tables of the layout, from boxes of a cover page, and matched to titles.

An entry has id, document_id, publication_date, source, original_page, title, author,
review_start_page, index_pdf_page, table_ref and row_number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import shapes, titles

# Patterns of an index row's cells, of a cover, and labels that are no titles.
PAGE_AND_TITLE = r"^\s*(\d{1,4})\s+(.+?)\s*$"
DATE_AND_SOURCE = r"^\s*(\d{1,2}/\d{1,2}/\d{2,4})\s+(.+?)\s*$"
COVER = r"(?i)\brassegna\s+del\s+\d{1,2}/\d{1,2}/\d{2,4}\b"
FUSED_ROW = r"^\s*(\d{1,2}/\d{1,2}/\d{2,4})\s+(.+?)\s+(\d{1,4})\s+(.+?)\s*(?:\.{2,3}|[a-zà-ù]{1,4})?\s*(\d{1,3})\s*$"
SECTION_LABELS = ("stampa locale", "web", "web locale", "stampa nazionale")
ENTRY = ["id", "document_id", "publication_date", "source", "original_page", "title", "author", "review_start_page", "index_pdf_page", "table_ref", "row_number"]


@dataclass(frozen=True)
class IndexSettings:
    first_pages: int = 3
    columns: int = 5
    least_rows: int = 2
    least_title: int = 8
    #: Points by which centres of cells of one row may differ.
    row_reach: float = 9.0
    column_step: float = 65.0
    middle_end: float = 0.78
    right_start: float = 0.84
    page_width: float = 595.0
    last_start_page: int = 60
    last_original_page: int = 120
    label_chars: int = 24


@dataclass(frozen=True)
class MatchSettings:
    title: float = 0.60
    date: float = 0.15
    source: float = 0.15
    page: float = 0.10
    least_similarity: float = 0.68
    strong_similarity: float = 0.84
    least_score: float = 0.72
    margin: float = 0.10
    #: Similarity that is enough where date, source and page agree.
    backed_similarity: float = 0.50


def index_date(c: Column) -> Column:
    """``d/m/yy`` (69 to 99: last century) or ``d/m/yyyy``; null if there is no such day."""
    day, month, year = (F.regexp_extract(F.trim(c), r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$", k) for k in (1, 2, 3))
    full = F.when(F.length(year) == 4, year).when(year >= "69", F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))
    return F.when(year != "", F.try_to_date(F.concat_ws("-", full, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"))


def positive(c: Column) -> Column:
    value = F.when(F.trim(c).rlike(r"^\d+$"), F.trim(c).try_cast("int"))
    return F.when(value > 0, value)


def raw_entries(documents: DataFrame, s: IndexSettings = IndexSettings()) -> DataFrame:
    """Entries of ``document_index`` tables: (document_id, tables array<struct<label, self_ref, prov, data>>)."""
    tables = documents.select("document_id", F.explode("tables").alias("t"))
    page = F.get("t.prov", F.lit(0))["page_no"]
    fits = (F.col("t.label") == "document_index") & (page <= s.first_pages) & (F.col("t.data.num_cols") == s.columns)
    rows = tables.filter(fits).select("document_id", page.alias("index_pdf_page"), F.coalesce("t.self_ref", F.lit("#/tables/unknown")).alias("table_ref"), F.posexplode("t.data.grid").alias("row_number", "row"))
    cell = lambda k: F.trim(F.coalesce(F.get("row", F.lit(k))["text"], F.lit("")))
    title = F.trim(F.regexp_extract(cell(2), PAGE_AND_TITLE, 2))
    rows = rows.filter(F.size("row") == s.columns).withColumns({
        "publication_date": index_date(cell(0)),
        "source": cell(1),
        "original_page": F.regexp_extract(cell(2), PAGE_AND_TITLE, 1).try_cast("int"),
        "title": title,
        "author": F.nullif(cell(3), F.lit("")),
        "review_start_page": positive(cell(4)),
    })
    good = rows.filter(F.col("publication_date").isNotNull() & (F.col("source") != "") & (F.length("title") >= s.least_title) & F.col("review_start_page").isNotNull())
    counted = good.withColumn("_n", F.count("*").over(Window.partitionBy("document_id", "table_ref")))
    named = F.concat("document_id", F.lit(":index:"), "table_ref", F.lit(":row="), "row_number")
    return counted.filter(F.col("_n") >= s.least_rows).withColumn("id", named).select(ENTRY)


def _bounded(s: IndexSettings) -> Column:
    return F.col("review_start_page").between(1, s.last_start_page) & F.col("original_page").between(1, s.last_original_page)


def layout_entries(regions: DataFrame, s: IndexSettings = IndexSettings()) -> DataFrame:
    """Entries read from the boxes of a document's cover: the first of its first pages that has any.

    A row is a date-and-source cell with exactly one page-and-title cell and exactly one
    page number to its right; a page without such rows may have whole rows in one box.
    """
    page = ["document_id", "pdf_page"]
    order = F.dense_rank().over(Window.partitionBy("document_id").orderBy("pdf_page"))
    first = regions.withColumn("_p", order).filter(F.col("_p") <= s.first_pages)
    text = F.trim(F.coalesce("text", F.lit("")))
    covers = first.groupBy(*page).agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("region_ord", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"])).alias("all")).filter(F.col("all").rlike(COVER)).select(page)
    width = F.coalesce(F.nullif("page_width", F.lit(0.0)), F.lit(s.page_width))
    cells = first.join(covers, page).filter((text != "") & F.col("x0").isNotNull()).select(*page, "region_ord", text.alias("text"), "x0", ((F.col("y0") + F.col("y1")) / 2).alias("middle"), width.alias("width"))
    lefts = cells.select(*page, F.col("region_ord").alias("left"), F.col("x0").alias("lx"), F.col("middle").alias("lm"), index_date(F.regexp_extract("text", DATE_AND_SOURCE, 1)).alias("publication_date"), F.trim(F.regexp_extract("text", DATE_AND_SOURCE, 2)).alias("source")).filter("publication_date is not null and source <> ''")
    near = F.abs(F.col("middle") - F.col("lm")) <= s.row_reach
    titled = F.col("text").rlike(rf"^\s*\d{{1,4}}\s+.{{{s.least_title},}}\s*$") & (F.col("x0") > F.col("lx") + s.column_step) & (F.col("x0") < s.middle_end * F.col("width"))
    numbered = F.col("text").rlike(r"^\d+$") & (F.col("x0") >= s.right_start * F.col("width"))
    pairs = lefts.join(cells, page).filter((F.col("region_ord") != F.col("left")) & near & (titled | numbered))
    own = pairs.groupBy(*page, "left", "publication_date", "source").agg(F.count_if(titled).alias("_t"), F.count_if(numbered & ~titled).alias("_n"), F.max(F.when(titled, F.col("text"))).alias("_title"), F.max(F.when(numbered & ~titled, F.col("text"))).alias("_start")).filter("_t = 1 and _n = 1")
    three = own.select(*page, "left", "publication_date", "source", F.regexp_extract("_title", PAGE_AND_TITLE, 1).try_cast("int").alias("original_page"), F.trim(F.regexp_extract("_title", PAGE_AND_TITLE, 2)).alias("title"), F.col("_start").try_cast("int").alias("review_start_page")).filter(_bounded(s))
    part = lambda k: F.regexp_extract("text", FUSED_ROW, k)
    fused = cells.join(three.select(page).distinct(), page, "left_anti").select(*page, F.col("region_ord").alias("left"), index_date(part(1)).alias("publication_date"), F.trim(part(2)).alias("source"), part(3).try_cast("int").alias("original_page"), F.trim(part(4)).alias("title"), part(5).try_cast("int").alias("review_start_page"))
    fused = fused.filter(F.col("publication_date").isNotNull() & (F.length("title") >= s.least_title) & _bounded(s))
    rows = three.unionByName(fused)
    earliest = Window.partitionBy("document_id")
    rows = rows.withColumn("_first", F.min("pdf_page").over(earliest)).filter("pdf_page = _first").withColumn("row_number", F.row_number().over(Window.partitionBy(*page).orderBy("left")) - 1)
    named = F.concat("document_id", F.lit(":layout_index:p"), "pdf_page", F.lit(":row"), "row_number")
    return rows.withColumns({"id": named, "author": F.lit(None).cast("string"), "index_pdf_page": F.col("pdf_page"), "table_ref": F.concat(F.lit("layout_index:page="), "pdf_page")}).select(ENTRY)


def match(titles_: DataFrame, entries: DataFrame, s: MatchSettings = MatchSettings(), similarity: Callable[[Column, Column], Column] = titles.index_similarity) -> DataFrame:
    """Titles with their best entry: (document_id, pdf_page, region_ord, entry_id, score, evidence, contradictions, status).

    ``titles_`` has document_id, pdf_page, region_ord, title and the page's publication_date,
    source and original_page (null where unknown).  Pages with index rows aren't matched.
    """
    index_pages = entries.select("document_id", F.col("index_pdf_page").alias("pdf_page")).distinct()
    open_ = titles_.join(index_pages, ["document_id", "pdf_page"], "left_anti")
    e = entries.select("document_id", F.col("id").alias("entry_id"), *(F.col(c).alias(f"e_{c}") for c in ("title", "publication_date", "source", "original_page")))
    pairs = open_.join(e, "document_id").withColumn("similarity", similarity(F.col("e_title"), F.col("title")))
    both = lambda c: F.col(c).isNotNull() & F.col(f"e_{c}").isNotNull()
    same = lambda c: F.coalesce(both(c) & (F.col(c) == F.col(f"e_{c}")), F.lit(False))
    same_source = F.coalesce(both("source") & (shapes.key_with_marks(F.col("source")) == shapes.key_with_marks(F.col("e_source"))), F.lit(False))
    flag = lambda c, name: F.when(c, F.lit(name))
    evidence = F.array_compact(F.array(
        flag(F.col("similarity") >= s.least_similarity, "fuzzy_title"),
        flag(F.col("similarity") >= s.strong_similarity, "strong_fuzzy_title"),
        flag(same("publication_date"), "same_publication_date"),
        flag(same_source, "same_source"),
        flag(both("source") & ~same_source, "source_not_exactly_comparable"),
        flag(same("original_page"), "same_original_page"),
    ))
    contradictions = F.array_compact(F.array(
        flag(both("publication_date") & ~same("publication_date"), "different_publication_date"),
        flag(both("original_page") & ~same("original_page"), "different_original_page"),
        flag(F.col("similarity") < s.least_similarity, "title_similarity_too_low"),
    ))
    points = lambda c, v: F.when(c, v).otherwise(0.0)
    score = s.title * F.col("similarity") + points(same("publication_date"), s.date) + points(same_source, s.source) + points(same("original_page"), s.page)
    scored = pairs.withColumns({"evidence": evidence, "contradictions": contradictions, "score": F.round(F.least(score, F.lit(1.0)), 4)})
    key = ["document_id", "pdf_page", "region_ord"]
    w = Window.partitionBy(*key).orderBy(F.col("score").desc(), "entry_id")
    best = scored.withColumns({"_rank": F.row_number().over(w), "_next": F.coalesce(F.lead("score").over(w), F.lit(0.0))}).filter("_rank = 1")
    backed = (F.col("similarity") >= s.backed_similarity) & same("publication_date") & same_source & same("original_page")
    status = (
        F.when(F.col("score") < s.least_score, "below_score")
        .when(F.col("score") - F.col("_next") < s.margin - 1e-12, "ambiguous")
        .when((F.size("contradictions") > 0) & ~backed, "contradicted")
        .otherwise("matched")
    )
    return best.select(*key, "entry_id", F.round("similarity", 4).alias("similarity"), "score", "evidence", "contradictions", status.alias("status"))
