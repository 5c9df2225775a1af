"""Links between neighbouring pages, by scores with vetoes, and what follows from them.

A scorer takes a pair of page descriptions as columns with the prefixes ``l_`` and
``r_`` and gives score, veto and the number of independent signals.  Pages are
described once (``describe``-like aggregates of their regions), pairs come from one
equi-join on (document_id, pdf_page = pdf_page + 1), so a chain of scorers costs one
exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GeneralSettings:
    base: float = 0.15
    url: float = 0.36
    source: float = 0.17
    date: float = 0.09
    both_web: float = 0.11
    print_id: float = 0.29
    audience: float = 0.13
    sheets: float = 0.38
    clean_owner: float = 0.05
    lane: float = 0.08
    lane_reach: float = 0.11
    accept: float = 0.72
    signals: int = 2


@dataclass(frozen=True)
class NewspaperSettings:
    base: float = 0.05
    sheet_pair: float = 0.74
    sheet_only: float = 0.30
    source: float = 0.10
    date: float = 0.07
    original_page: float = 0.04
    index: float = 0.05
    repeated_title: float = 0.08
    candidate: float = 0.50
    accept: float = 0.74


@dataclass(frozen=True)
class WebSettings:
    adjacent: float = 0.04
    area: float = 0.18
    prior: float = 0.08
    sheet: float = 0.14
    url: float = 0.30
    source: float = 0.14
    header: float = 0.10
    date: float = 0.08
    other_date: float = -0.15
    column: float = 0.16
    starts_high: float = 0.12
    syntax: float = 0.12
    lexical: float = 0.08
    author: float = 0.09
    accept: float = 0.60
    structural: float = 0.52
    structural_keys: int = 5
    flow_accept: float = 0.82
    flow_boundary: float = 0.12
    flow_signals: int = 2


def pairs(pages: DataFrame) -> DataFrame:
    """Each page with the next one of its document: columns l_* and r_*."""
    left = pages.select("document_id", (F.col("pdf_page") + 1).alias("pdf_page"), *(F.col(c).alias(f"l_{c}") for c in pages.columns if c != "document_id"))
    right = pages.select("document_id", "pdf_page", *(F.col(c).alias(f"r_{c}") for c in pages.columns if c != "document_id"))
    return left.join(right, ["document_id", "pdf_page"]).drop("pdf_page")


def both(c: str) -> Column:
    return F.col(f"l_{c}").isNotNull() & F.col(f"r_{c}").isNotNull()


def same(c: str) -> Column:
    return F.coalesce(F.col(f"l_{c}") == F.col(f"r_{c}"), F.lit(False))


def conflict(c: str) -> Column:
    """Both pages say something and it differs."""
    return both(c) & ~same(c)


def compatible(a: Column, b: Column) -> Column:
    """Equal, or one of both unknown."""
    return a.isNull() | b.isNull() | (a == b)


def _points(c: Column, v: float) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), v).otherwise(0.0)


def _count(*signals: Column) -> Column:
    out = F.lit(0)
    for c in signals:
        out = out + F.coalesce(c, F.lit(False)).cast("int")
    return out


def _first(**vetoes: Column) -> Column:
    """The name of the first veto that holds, else null."""
    out = F.lit(None).cast("string")
    for name, c in reversed(vetoes.items()):
        out = F.when(F.coalesce(c, F.lit(False)), name).otherwise(out)
    return out


def general(p: DataFrame, s: GeneralSettings = GeneralSettings()) -> DataFrame:
    """``p`` with score, signals, veto and status of a continuation of any kind.

    Columns of a page: url, source, date, total (sheets), sheet, print_id, audience, web,
    n_titles, owner, owners (on the page), is_index, lane.
    """
    next_sheet = F.coalesce(F.col("r_sheet") == F.col("l_sheet") + 1, F.lit(False)) & same("total")
    lane = F.abs(F.col("l_lane") - F.col("r_lane")) <= s.lane_reach
    foreign = F.col("r_owner").isNotNull() & ~same("owner")
    veto = _first(
        index_page=F.col("l_is_index") | F.col("r_is_index"), url_conflict=conflict("url"), source_conflict=conflict("source"), date_conflict=conflict("date"),
        total_conflict=conflict("total"), print_id_conflict=conflict("print_id"), title_on_target=F.col("r_n_titles") > 0, foreign_owner=foreign,
    )
    score = (
        s.base + _points(same("url"), s.url) + _points(same("source"), s.source) + _points(same("date"), s.date) + _points(F.col("l_web") & F.col("r_web"), s.both_web) + _points(same("print_id"), s.print_id)
        + _points(same("audience"), s.audience) + _points(next_sheet, s.sheets) + _points(F.col("r_owners") == 0, s.clean_owner) + _points(lane, s.lane)
    )
    signals = _count(same("url"), same("source"), same("print_id"), same("audience"), next_sheet)
    out = p.withColumns({"score": F.round(score, 4), "signals": signals, "veto": veto})
    return out.withColumn("status", F.when(F.col("veto").isNotNull(), "vetoed").when((F.col("score") >= s.accept) & (F.col("signals") >= s.signals), "accepted").otherwise("rejected"))


def newspaper(p: DataFrame, s: NewspaperSettings = NewspaperSettings()) -> DataFrame:
    """``p`` with score, veto and status of the next sheet of a clipping.

    Columns of a page: sheet, total, source, date, original_page, n_titles, owners, owner, index_entry, title.
    """
    step = F.coalesce(F.col("r_sheet") == F.col("l_sheet") + 1, F.lit(False))
    pair = step & same("total")
    repeated = same("title")
    veto = _first(
        sheet_conflict=F.col("l_sheet").isNotNull() & F.col("r_sheet").isNotNull() & ~step | conflict("total"), source_conflict=conflict("source"), date_conflict=conflict("date"),
        new_title=(F.col("r_n_titles") > 0) & ~repeated, several_articles=F.col("l_owners") > 1, foreign_owner=F.col("r_owner").isNotNull() & ~same("owner"),
    )
    score = (
        s.base + F.when(pair, s.sheet_pair).when(step, s.sheet_only).otherwise(0.0) + _points(same("source"), s.source) + _points(same("date"), s.date)
        + _points(same("original_page"), s.original_page) + _points(same("index_entry"), s.index) + _points(repeated, s.repeated_title)
    )
    out = p.withColumns({"score": F.round(score, 4), "veto": veto})
    return out.withColumn("status", F.when(F.col("veto").isNotNull(), "vetoed").when(F.col("score") >= s.accept, "accepted").when(F.col("score") >= s.candidate, "candidate").otherwise("rejected"))


def web(p: DataFrame, s: WebSettings = WebSettings()) -> DataFrame:
    """``p`` with score, veto and status of the next page of a web article, and of the flow link.

    Columns of a page: area, prior, sheet, url, source, header, date, column, starts (share of
    the height), open_end, open_start, words (array), author, n_titles.
    """
    shared = F.size(F.array_intersect("l_words", "r_words")) / F.greatest(F.size(F.array_union("l_words", "r_words")), F.lit(1))
    sheet = F.col("r_sheet") == F.col("l_sheet") + 1
    starts = F.col("r_starts") <= 0.40
    syntax = F.col("l_open_end") & F.col("r_open_start")
    header = ~same("source") & same("header")
    score = (
        s.adjacent + _points(same("area"), s.area) + _points(F.col("l_prior") & F.col("r_prior"), s.prior) + _points(sheet, s.sheet) + _points(same("url"), s.url) + _points(same("source"), s.source) + _points(header, s.header)
        + F.when(same("date"), s.date).when(conflict("date"), s.other_date).otherwise(0.0) + _points(same("column"), s.column) + _points(starts, s.starts_high) + _points(syntax, s.syntax) + _points(shared >= 0.12, s.lexical) + _points(same("author"), s.author)
    )
    keys = _count(same("area"), same("source") | header, same("column"), starts, syntax, sheet, same("url"))
    veto = _first(url_conflict=conflict("url"), source_conflict=conflict("source"))
    out = p.withColumns({"score": F.round(score, 4), "keys": keys, "veto": veto})
    found = (F.col("score") >= s.accept) | (F.col("score") >= s.structural) & (F.col("keys") >= s.structural_keys)
    out = out.withColumn("status", F.when(F.col("veto").isNotNull(), "vetoed").when(found, "candidate").otherwise("rejected"))
    flow = F.round(F.least(F.col("score") + _points(syntax, s.flow_boundary), F.lit(1.0)), 4)
    strong = _count(same("url"), same("source"), sheet, syntax, same("author"))
    return out.withColumn("flow_score", flow).withColumn("flow", F.when((F.col("r_n_titles") > 0) | (F.col("status") != "candidate"), "rejected").when((F.col("flow_score") >= s.flow_accept) & (strong >= s.flow_signals), "accepted").otherwise("candidate"))


def lanes(pages: DataFrame, anchors: DataFrame, reach: int = 5, lane: float = 0.065, least_chars: int = 120) -> DataFrame:
    """Pages that continue an anchored web article: (document_id, anchor, pdf_page, place, confidence).

    ``anchors`` has document_id, pdf_page, lane, date, url; ``pages`` these and chars, n_titles.  The
    pages behind an anchor belong to it until the first that breaks off: a running
    minimum over at most ``reach`` pages.
    """
    a = anchors.select("document_id", F.col("pdf_page").alias("anchor"), *(F.col(c).alias(f"a_{c}") for c in ("lane", "date", "url")))
    steps = a.withColumn("place", F.explode(F.sequence(F.lit(1), F.lit(reach)))).withColumn("pdf_page", F.col("anchor") + F.col("place"))
    near = steps.join(pages, ["document_id", "pdf_page"], "left")
    good = (F.abs(F.col("lane") - F.col("a_lane")) <= lane) & (F.col("chars") >= least_chars) & (F.col("n_titles") == 0) & compatible(F.col("date"), F.col("a_date")) & compatible(F.col("url"), F.col("a_url"))
    w = Window.partitionBy("document_id", "anchor").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    held = near.withColumn("_held", F.min(F.coalesce(good, F.lit(False)).cast("int")).over(w)).filter("_held = 1")
    return held.select("document_id", "anchor", "pdf_page", "place", F.when(F.col("place") == 1, 0.90).otherwise(0.82).alias("confidence"))


def wrappers(pages: DataFrame, least_chars: int = 175, reach: float = 0.065, points: float = 23.0, share: float = 0.70) -> DataFrame:
    """Pages that continue a web article by its printed audience mark and lane: (document_id, from_page, to_page, status).

    ``pages`` has audience, lane (points), page_width, chars, lane_chars (of bodies within the lane) and n_titles.
    """
    p = pairs(pages)
    tolerance = F.greatest(F.lit(points), reach * F.col("l_page_width"))
    fits = (F.abs(F.col("l_lane") - F.col("r_lane")) <= tolerance) & (F.col("r_chars") >= least_chars) & (F.col("r_lane_chars") >= share * F.col("r_chars"))
    status = F.when(~same("audience"), "other_audience").when(F.col("r_n_titles") > 0, "new_title").when(F.coalesce(fits, F.lit(False)), "accepted").otherwise("rejected")
    return p.select("document_id", F.col("l_pdf_page").alias("from_page"), F.col("r_pdf_page").alias("to_page"), status.alias("status"))


def propagated(pages: DataFrame, links: DataFrame, fields: list[str]) -> DataFrame:
    """``pages`` with ``fields`` that accepted links bring from their anchor, where nothing contradicts.

    ``links`` has document_id, anchor, pdf_page.  A field is filled if it is null; if any
    field differs from the anchor's, nothing is.
    """
    a = pages.select("document_id", F.col("pdf_page").alias("anchor"), *(F.col(c).alias(f"a_{c}") for c in fields))
    best = links.groupBy("document_id", "pdf_page").agg(F.min("anchor").alias("anchor")).join(a, ["document_id", "anchor"], "left")
    out = pages.join(best, ["document_id", "pdf_page"], "left")
    agrees = F.col("anchor").isNotNull()
    for c in fields:
        agrees = agrees & compatible(F.col(c), F.col(f"a_{c}"))
    return out.withColumns({c: F.when(agrees, F.coalesce(c, f"a_{c}")).otherwise(F.col(c)) for c in fields} | {"from_anchor": agrees}).select(*pages.columns, "from_anchor")
