"""Who a medium, an address or a repeated record belongs to, and which quotes stand alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import geometry, text
from layoutlake.operators import ranking

PAGE = ["document_id", "pdf_page"]
# What the foot of a news site says about itself, in lower case, and its longest form.
MASTHEAD = r"testata\s+giornalistica|registrat[\p{L}\p{N}_]+\s+al\s+tribunale|diritti\s+riservati|privacy\s+policy|cookie\s+policy|copyright\s+©?\s*\d{4}|è\s+un\s+quotidiano\s+online\s+di|redazione\s+centrale|web-?magazine|dedicat[\p{L}\p{N}_]+\s+a\s+(?:politica|attualità|attualita|cronaca|cultura|sport|eventi)|newsletter|seguici\s+su"
MASTHEAD_CHARS = 300


@dataclass(frozen=True)
class MediaSettings:
    overlap: float = 0.40
    near: float = 0.40
    gap: float = 0.18
    least_overlap: float = 0.25
    accept: float = 0.62
    margin: float = 0.12


def masthead(c: Column) -> Column:
    """A site's foot: no text of a recovered record."""
    return (F.length(c) <= MASTHEAD_CHARS) & F.lower(c).rlike(MASTHEAD)


def media_owners(media: DataFrame, bodies: DataFrame, s: MediaSettings = MediaSettings()) -> DataFrame:
    """The article of each medium: the best body of each article, then the best article with a lead."""
    m = media.select(*PAGE, F.col("region_ord").alias("medium"), "page_height", *(F.col(c).alias(f"m_{c}") for c in ("x0", "y0", "x1", "y1")))
    b = bodies.select(*PAGE, "article_id", *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    over = geometry.horizontal_overlap(geometry.box("m_"), geometry.box("b_"))
    gap = geometry.vertical_gap(geometry.box("m_"), geometry.box("b_")) / F.col("page_height")
    scored = m.join(b, PAGE).filter((over >= s.least_overlap) & (gap <= s.gap)).withColumn("score", s.overlap * over + s.near * (1 - gap / s.gap))
    best = scored.groupBy(*PAGE, "medium", "article_id").agg(F.round(F.max("score"), 6).alias("score"))
    return ranking.winner(best, [*PAGE, "medium"], "article_id", "score", s.accept, s.margin)


def claimants(claims: DataFrame) -> DataFrame:
    """Who may use an address: its one owner, else the one titled record, else the one record.

    ``claims`` has document_id, url, owner, has_record and titled.  (…, url, owner, rule): the
    owner is null where none is certain.
    """
    c = claims.groupBy("document_id", "url", "owner").agg(F.max("has_record").alias("has_record"), F.max(F.col("titled") & F.col("has_record")).alias("titled"))
    one = lambda flag: F.count_if(flag) == 1
    who = lambda flag: F.max(F.when(flag, F.col("owner")))
    g = c.groupBy("document_id", "url").agg(F.count("*").alias("n"), F.max("owner").alias("only"), one(F.col("titled")).alias("one_titled"), who(F.col("titled")).alias("titled_owner"), one(F.col("has_record")).alias("one_record"), who(F.col("has_record")).alias("record_owner"))
    rule = F.when(F.col("n") == 1, "one_owner").when(F.col("one_titled"), "unique_titled").when(F.col("one_record"), "unique_with_record").otherwise("ambiguous")
    owner = F.when(F.col("n") == 1, F.col("only")).when(F.col("one_titled"), F.col("titled_owner")).when(F.col("one_record"), F.col("record_owner"))
    return g.select("document_id", "url", F.col("n").alias("n_owners"), owner.alias("owner"), rule.alias("rule"))


def repeated_records(records: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Records that share a key with others of their document: (document_id, rule, key, article_id, first, n_records, n_pages).

    One row for each record and rule, with the class' first record; not all pairs.
    """
    each = F.array(*(F.struct(F.lit(name).alias("rule"), key.alias("key")) for name, key in keys.items()))
    r = records.select("document_id", "article_id", "pdf_page", F.explode(each).alias("k")).select("document_id", "article_id", "pdf_page", "k.rule", "k.key").filter(F.col("key").isNotNull() & (F.col("key") != ""))
    classes = r.groupBy("document_id", "rule", "key").agg(F.min("article_id").alias("first"), F.countDistinct("article_id").alias("n_records"), F.countDistinct("pdf_page").alias("n_pages")).filter("n_records > 1")
    return r.join(classes, ["document_id", "rule", "key"]).select("document_id", "rule", "key", "article_id", "first", "n_records", "n_pages").distinct()


def isolated_quotes(bodies: DataFrame, least: float = 0.78, gap: float = 12.0, lane: float = 20.0) -> DataFrame:
    """Bodies that repeat another body of their article on the page: (…, region_ord, other, coverage, isolated, status).

    A body is a quote if most of its words stand in one other body; it is accepted if its font
    is another one or if it keeps a distance from the bodies of its lane.
    """
    tokens = text.content_tokens(F.col("text"), 4)
    b = bodies.select(*PAGE, "article_id", "region_ord", "x0", "y0", "y1", "font", tokens.alias("w")).withColumn("n", F.size("w"))
    row = F.struct("region_ord", "x0", "y0", "y1", "font", "w")
    groups = b.groupBy(*PAGE, "article_id").agg(F.collect_list(row).alias("rows"))
    q = b.filter(F.col("n").between(6, 40)).select(*PAGE, "article_id", row.alias("q")).join(groups, [*PAGE, "article_id"])
    others = F.filter("rows", lambda r: r["region_ord"] != F.col("q.region_ord"))
    covered = F.transform(others, lambda r: F.struct((-F.size(F.array_intersect(F.col("q.w"), r["w"]))).alias("less"), r["region_ord"].alias("other"), r["font"].alias("font")))
    best = F.array_min(F.filter(covered, lambda c: -c["less"] >= least * F.size("q.w")))
    near = F.filter(others, lambda r: F.abs(r["x0"] - F.col("q.x0")) <= lane)
    alone = F.forall(near, lambda r: F.least(F.abs(F.col("q.y0") - r["y1"]), F.abs(r["y0"] - F.col("q.y1"))) >= gap)
    out = q.select(*PAGE, F.col("q.region_ord").alias("region_ord"), best.alias("b"), alone.alias("isolated"), F.size("q.w").alias("n"), F.col("q.font").alias("font")).filter("b is not null")
    distinct = F.coalesce(F.col("font") != F.col("b.font"), F.lit(False))
    return out.select(*PAGE, "region_ord", F.col("b.other").alias("other"), F.round(-F.col("b.less") / F.col("n"), 4).alias("coverage"), "isolated", F.when(distinct | F.col("isolated"), "accepted").otherwise("candidate").alias("status"))


def leaders(lines: DataFrame, position: float = 0.045, size: float = 0.06) -> DataFrame:
    """Repeated lines by pattern and place: (document_id, family, pattern, leader, pages, frequency, repeated).

    A line joins the first leader of its pattern, in the order of pages, whose box is close in
    position and size, else it leads.  A pattern of one page has no result, so most lines leave
    before boxes are looked at.  The others are reduced to distinct boxes, which come sorted by
    pattern, so that many patterns are one stream and a task holds one pattern's leaders.
    """
    import pandas as pd

    key = ["document_id", "family", "pattern"]
    box = ["rx", "ry", "rw", "rh"]
    rel = {"rx": F.col("x0") / F.col("page_width"), "ry": F.col("y0") / F.col("page_height"), "rw": (F.col("x1") - F.col("x0")) / F.col("page_width"), "rh": (F.col("y1") - F.col("y0")) / F.col("page_height")}
    often = lines.groupBy(*key).agg(F.min("pdf_page").alias("low"), F.max("pdf_page").alias("high")).filter("low < high").select(*key)
    r = lines.join(often, key, "left_semi").withColumns({c: F.round(v, 6) for c, v in rel.items()})
    places = r.groupBy(*key, *box).agg(F.min("pdf_page").alias("first_page"))

    def lead(batches):
        pattern, found = None, []
        for batch in batches:
            chosen = []
            for *of, x, y, w, h in batch[[*key, *box]].itertuples(index=False):
                if of != pattern:
                    pattern, found = of, []
                k = next((k for k, (a, b, c, d) in enumerate(found) if abs(a - x) <= position and abs(b - y) <= position and abs(c - w) <= size and abs(d - h) <= size), None)
                if k is None:
                    k = len(found)
                    found.append((x, y, w, h))
                chosen.append(k)
            yield batch[[*key, *box]].assign(leader=pd.Series(chosen, batch.index, "int64"))

    by_place = places.repartition(*key).sortWithinPartitions(*key, F.col("first_page").asc_nulls_last(), "ry", "rx", "rw", "rh")
    led = by_place.mapInPandas(lead, "document_id string, family string, pattern string, rx double, ry double, rw double, rh double, leader long")
    total = lines.groupBy("document_id").agg(F.countDistinct("pdf_page").alias("n_pages"))
    g = r.join(led, [*key, *box]).groupBy(*key, "leader").agg(F.countDistinct("pdf_page").alias("pages")).filter("pages >= 2").join(total, "document_id")
    return g.select(*key, "leader", "pages", "n_pages", F.round(F.col("pages") / F.col("n_pages"), 6).alias("frequency"), (F.col("pages") / F.col("n_pages") >= 0.5).alias("repeated"))
