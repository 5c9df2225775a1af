"""From drafts to records: segments, fields, readiness, audits, web bodies, absorbed fragments.

Everything is aggregation by (document_id, article_id) and equi-joins; a record's lists
stay in the order of its pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import text

ARTICLE = ["document_id", "article_id"]


@dataclass(frozen=True)
class ReadySettings:
    confidence: float = 0.65
    coverage: float = 0.90
    unassigned: int = 150
    unmapped: int = 100
    unresolved: int = 200
    residual: float = 0.10
    retention: float = 0.94
    retention_all_ocr: float = 0.92
    reading: float = 0.7
    clustering: float = 0.3
    open_link: float = 0.15


@dataclass(frozen=True)
class AbsorbSettings:
    shingle: int = 8
    least_shingles: int = 5
    overlap: float = 0.50
    pages: int = 2


def distinct_in_order(values: Column) -> Column:
    """An array without repeats, the first of each in its place, nulls and empty strings left out."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def capped(values: Column, most: int = 200) -> Column:
    """The first ``most`` recorded actions: what the report keeps, the work isn't bound by it."""
    return F.slice(values, 1, most)


def subset(required: Column, have: Column) -> Column:
    return F.size(F.array_except(required, have)) == 0


def unanimous(c: Column) -> Column:
    """Aggregate: the one value that a group has, null if it has several or none."""
    return F.when(F.countDistinct(c) == 1, F.max(c))


def conflicting(c: Column, name: str) -> Column:
    """Aggregate: a warning if a group has several values."""
    return F.when(F.countDistinct(c) > 1, F.lit(f"Conflicting {name}"))


def drafts(segments: DataFrame, between: str = "\n\n") -> DataFrame:
    """One draft for each article: titles, body, segments with their place, pages, warnings.

    ``segments`` has document_id, article_id, pdf_page, place (reading order), type, text and
    confidence.  Repeated titles count once; an article without body is skipped and named.
    """
    order = Window.partitionBy(*ARTICLE).orderBy("pdf_page", "place")
    body = F.col("type") == "article_body"
    s = segments.filter("article_id is not null").withColumn("_before", F.coalesce(F.sum(F.when(body, F.length("text") + len(between)).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    key = text.entity_key(F.col("text"))
    part = F.struct("pdf_page", "place", F.col("text").alias("text"), F.col("_before").alias("start"))
    title = F.struct("pdf_page", "place", F.trim("text").alias("text"), key.alias("key"))
    g = s.groupBy(*ARTICLE).agg(
        F.sort_array(F.collect_list(F.when(body, part))).alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("type") == "article_title", title))).alias("heads"),
        F.sort_array(F.collect_set("pdf_page")).alias("pages"),
        F.avg(F.when(body, F.col("confidence"))).alias("reading"),
    )
    keys = F.array_distinct(F.transform("heads", lambda h: h["key"]))
    titles = F.transform(keys, lambda k: F.element_at(F.filter("heads", lambda h: h["key"] == k), 1)["text"])
    out = g.withColumns({"titles": titles, "body": F.array_join(F.col("parts.text"), between), "spans": F.transform("parts", lambda p: F.struct(p["start"].alias("start"), (p["start"] + F.length(p["text"])).alias("end")))})
    warnings = F.array_compact(F.array(F.when(F.size("titles") == 0, "no_title"), F.when(F.size("titles") > 1, "several_titles"), F.when(F.size("parts") == 0, "no_body")))
    return out.select(*ARTICLE, F.try_element_at("titles", F.lit(1)).alias("title"), "titles", "body", F.size("parts").alias("n_parts"), "spans", "pages", "reading", warnings.alias("warnings"), (F.size("parts") == 0).alias("skipped"))


def fields(members: DataFrame, names: list[str]) -> DataFrame:
    """Each field of an article if its pages agree on it, and warnings for those on which they don't."""
    warned = F.array_compact(F.array(*(conflicting(F.col(c), c) for c in names)))
    return members.groupBy(*ARTICLE).agg(*(unanimous(F.col(c)).alias(c) for c in names), warned.alias("field_warnings"))


def with_priors(records: DataFrame, matches: DataFrame, names: list[str]) -> DataFrame:
    """``records`` whose null fields come from the index entry that matches best.

    ``matches`` has document_id, article_id, entry_id, score and the entry's fields.
    """
    best = matches.groupBy(*ARTICLE).agg(F.max_by(F.struct("entry_id", *names), F.struct("score", F.col("entry_id"))).alias("e"))
    out = records.join(best, ARTICLE, "left")
    origin = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.when(F.col(c).isNotNull(), "pages").when(F.col(f"e.{c}").isNotNull(), "review_index") for c in names)))
    kept = [c for c in records.columns if c not in names]
    return out.select(*kept, *(F.coalesce(c, f"e.{c}").alias(c) for c in names), F.col("e.entry_id").alias("entry_id"), origin.alias("field_origins"))


def confidence(reading: Column, clustering: Column, open_links: Column, s: ReadySettings = ReadySettings()) -> Column:
    """Reconstruction confidence: both means weighted, less for links that are only candidates."""
    score = s.reading * F.coalesce(reading, F.lit(0.0)) + s.clustering * F.coalesce(clustering, F.lit(0.0)) - F.when(open_links > 0, s.open_link).otherwise(0.0)
    return F.round(F.greatest(score, F.lit(0.0)), 4)


def completeness(assigned: Column, unassigned: Column, unresolved: Column, unmapped: Column, ocr: Column, retention: Column, all_ocr: Column, s: ReadySettings = ReadySettings()) -> tuple[Column, Column, Column]:
    """Coverage, the reasons against completeness and the status (complete, incomplete, unknown)."""
    total = assigned + unassigned + unresolved + unmapped
    coverage = F.try_divide(assigned, F.nullif(total, F.lit(0)))
    # a residue may be a tenth of what was assigned, or a fixed number of characters
    residue = lambda n, most: n > F.greatest(F.lit(most), s.residual * assigned)
    least = F.when(all_ocr, s.retention_all_ocr).otherwise(s.retention)
    reasons = F.array_compact(F.array(
        F.when(coverage < s.coverage, "low_body_coverage"),
        F.when(residue(unassigned, s.unassigned), "unassigned_body_text"),
        F.when(residue(unmapped, s.unmapped), "unmapped_text"),
        F.when(residue(unresolved, s.unresolved), "unresolved_editorial_text"),
        F.when(ocr & (retention < least), "low_ocr_retention"),
    ))
    status = F.when(coverage.isNull() | ocr & retention.isNull(), "unknown").when(F.size(reasons) > 0, "incomplete").otherwise("complete")
    return coverage, reasons, status


def ready(title: Column, body: Column, proximity: Column, open_links: Column, warnings: Column, sure: Column, source: Column, date: Column, complete: Column, s: ReadySettings = ReadySettings()) -> Column:
    """ready or review_required, with every condition that a ready record meets."""
    bad = F.exists(warnings, lambda w: F.contains(w, F.lit("Conflicting")) | F.contains(w, F.lit("not attributable")))
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    good = has(title) & has(body) & ~proximity & (open_links == 0) & ~bad & (sure >= s.confidence) & source.isNotNull() & date.isNotNull() & (complete == "complete")
    return F.when(F.coalesce(good, F.lit(False)), "ready").otherwise("review_required")


def audit(records: DataFrame, orphans: DataFrame, links: DataFrame, entries: DataFrame) -> DataFrame:
    """One row for each document: records, coverage, orphans, unresolved links, unmatched entries, warnings.

    ``orphans`` has document_id, pdf_page, chars; ``links`` document_id, status; ``entries`` document_id, id, matched.
    """
    r = records.groupBy("document_id").agg(F.count("*").alias("n_records"), F.count_if(F.col("status") == "ready").alias("n_ready"), F.round(F.avg("coverage"), 4).alias("coverage"), F.count_if(F.coalesce(F.trim("title"), F.lit("")) == "").alias("untitled"))
    o = orphans.groupBy("document_id").agg(F.countDistinct("pdf_page").alias("orphan_pages"), F.sum("chars").alias("orphan_chars"))
    k = links.groupBy("document_id").agg(F.count_if(F.col("status") != "accepted").alias("open_links"))
    e = entries.groupBy("document_id").agg(F.count_if(~F.col("matched")).alias("unmatched_entries"))
    out = r.join(o, "document_id", "full").join(k, "document_id", "full").join(e, "document_id", "full").na.fill(0)
    warnings = F.array_compact(F.array(F.when(F.col("orphan_chars") > 0, "orphan_text"), F.when(F.col("open_links") > 0, "open_links"), F.when(F.col("unmatched_entries") > 0, "unmatched_entries"), F.when(F.col("untitled") > 0, "untitled_records")))
    return out.withColumn("warnings", warnings)


def with_web_body(records: DataFrame, web: DataFrame) -> DataFrame:
    """``records`` with the body that the web gives, if its quality gate let it through.

    ``web`` has document_id, article_id, web_title, web_body, reason.  The printed body stays beside
    it, a missing title is filled, and the record has to be reviewed.
    """
    w = web.filter(F.col("reason") == "accepted").groupBy(*ARTICLE).agg(F.max_by(F.struct("web_title", "web_body"), F.length("web_body")).alias("w"))
    out = records.join(w, ARTICLE, "left")
    taken = F.col("w").isNotNull()
    kept = [c for c in records.columns if c not in ("title", "body", "status")]
    return out.select(*kept, F.coalesce(F.nullif(F.trim("title"), F.lit("")), "w.web_title").alias("title"), F.coalesce("w.web_body", "body").alias("body"), F.when(taken, F.col("body")).alias("body_printed"), F.when(taken, "review_required").otherwise(F.col("status")).alias("status"), F.when(taken, "web_html").otherwise("pdf").alias("method"))


def absorbed(records: DataFrame, s: AbsorbSettings = AbsorbSettings()) -> DataFrame:
    """Printed fragments of an article whose web body is known: (document_id, fragment, anchor, overlap, distance).

    ``records`` has document_id, article_id, title, body, pages (array), method and article_type.  A
    fragment goes to the first anchor (by id) within two pages that has half of its
    shingles and no title of another article.  Who is near whom is found without shingles, so
    that those of a body are made once.
    """
    web = F.col("method") == "web_html"
    hashed = text.shingle_hashes(F.col("body"), s.shingle)
    with_shingles = lambda r: r.withColumn("shingles", hashed).withColumn("n", F.size("shingles"))
    # pages near an anchor meet fragments by an equi-join, not by comparing all records of a document
    anchors, fragments = records.filter(web), records.filter(~web & (F.col("article_type") == "web"))
    a = with_shingles(anchors).select("document_id", F.col("article_id").alias("anchor"), F.col("title").alias("a_title"), F.col("shingles").alias("a_shingles"), F.col("n").alias("a_n"), F.col("pages").alias("a_pages"))
    reach = F.array_distinct(F.flatten(F.transform("pages", lambda p: F.sequence(p - s.pages, p + s.pages))))
    near = anchors.select("document_id", F.col("article_id").alias("anchor"), F.explode(reach).alias("page"))
    f = with_shingles(fragments).select("document_id", F.col("article_id").alias("fragment"), F.col("title").alias("f_title"), "shingles", "n", "pages")
    met = fragments.select("document_id", F.col("article_id").alias("fragment"), F.explode("pages").alias("page")).join(near, ["document_id", "page"]).select("document_id", "fragment", "anchor").distinct()
    p = met.join(f, ["document_id", "fragment"]).join(a, ["document_id", "anchor"])
    # asked of the pair: a filter on one side would make the shingles of that side once more
    enough = (F.col("n") >= s.least_shingles) & (F.col("a_n") > 0)
    overlap = F.when(enough, F.size(F.array_intersect("shingles", "a_shingles")) / F.greatest(F.lit(1), F.least("n", "a_n")))
    low = lambda c: F.coalesce(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")), F.lit(""))
    left, right = low(F.col("f_title")), low(F.col("a_title"))
    words = lambda c: text.content_tokens(c, 4)
    related = (left == "") | (F.size(F.split(F.col("f_title"), ",")) >= 4) | (right != "") & (F.contains(left, right) | F.contains(right, left) | (F.size(words(right)) > 0) & subset(words(right), words(left)))
    distance = F.array_min(F.flatten(F.transform("pages", lambda x: F.transform("a_pages", lambda y: F.abs(x - y)))))
    hits = p.withColumns({"overlap": overlap, "distance": distance}).filter((F.col("overlap") >= s.overlap) & related)
    first = hits.groupBy("document_id", "fragment").agg(F.min(F.struct("anchor", "overlap", "distance")).alias("h"))
    return first.select("document_id", "fragment", "h.anchor", F.round("h.overlap", 3).alias("overlap"), "h.distance")
