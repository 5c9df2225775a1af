"""The registered queries: each applies one operator to the tables at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layoutlake.functions import dates, geometry, similarity, text, urls
from layoutlake.operators import intervals, kernels, ranking
from layoutlake.sources import tables as src

DOC = ["document_id", "pdf_page"]
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def lines(spark, sf):
    return src.lines(spark, sf)


@query
def q01_page_features(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and marker sums of each page."""
    t = F.col("text")
    f = text.flags(t)
    return lines(spark, sf).groupBy(*DOC).agg(
        F.count("*").alias("n_regions"),
        F.sum(F.length("text")).cast("long").alias("text_chars"),
        F.count_if(f["has_rights"]).alias("n_rights"),
        F.count_if(f["has_url"]).alias("n_url"),
        F.count_if(F.length("text") >= 80).alias("n_long"),
        F.max(F.length("text")).cast("long").alias("longest"),
    )


@query
def q02_region_flags(spark, sf):
    """Regions by keyword flag."""
    f = text.flags(F.col("text"))
    names = ["has_ad", "has_share", "has_related", "has_navigation", "has_rights", "has_watermark", "has_cookie", "has_newsletter", "has_url", "has_date", "has_author", "has_foglio", "section_label", "index_entry"]
    flagged = lines(spark, sf).select("document_id", *(f[n].cast("int").alias(n) for n in names))
    return flagged.groupBy("document_id").agg(*(F.sum(n).cast("long").alias(n) for n in names))


@query
def q03_uppercase_ratio(spark, sf):
    return lines(spark, sf).select(*DOC, "region_ord", F.round(text.uppercase_ratio(F.col("text")), 6).alias("uppercase_ratio"))


@query
def q04_visible_chars(spark, sf):
    return lines(spark, sf).groupBy(*DOC).agg(F.sum(text.visible_chars(F.col("text"))).cast("long").alias("visible_chars"))


@query
def q05_boilerplate_lines(spark, sf):
    """Lines that stand on at least two pages of a document, with their frequency."""
    rows = lines(spark, sf)
    total = src.read(spark, sf, "documents").groupBy(F.col("source").alias("document_id")).agg(F.countDistinct("doc_id").alias("n_pages"))
    # exploded, so that the filter doesn't evaluate the line once more
    named = rows.select(*DOC, F.explode(F.filter(F.array(text.boilerplate(F.col("text"))), lambda x: x["family"].isNotNull())).alias("x"))
    groups = named.groupBy("document_id", F.col("x.family").alias("family"), F.col("x.pattern").alias("pattern")).agg(F.countDistinct("pdf_page").alias("pages"))
    found = groups.filter("pages >= 2").join(total, "document_id")
    frequency = F.round(F.col("pages") / F.col("n_pages"), 6)
    return found.select("document_id", "family", "pattern", "pages", "n_pages", frequency.alias("frequency"), (F.col("pages") / F.col("n_pages") >= 0.5).alias("repeated"))


@query
def q06_rights_notice(spark, sf):
    status, marker = text.rights_notice(F.col("text"))
    return lines(spark, sf).select("document_id", status.alias("status"), F.coalesce(marker, F.lit("")).alias("marker")).groupBy("document_id", "status", "marker").agg(F.count("*").alias("n"))


@query
def q07_rights_scrub(spark, sf):
    """Bodies with a rights phrase appended lose it again."""
    docs = src.read(spark, sf, "documents").select("doc_id", F.concat("text", F.lit(" © Riproduzione riservata.")).alias("body"))
    return docs.select("doc_id", F.length(text.scrub_rights(F.col("body"))).cast("long").alias("n_chars"), F.md5(text.scrub_rights(F.col("body"))).alias("body_md5"))


@query
def q09_geometry_pairs(spark, sf):
    """Pairs of regions of a page by overlap and gap."""
    r = src.regions(spark, sf)
    a, b = (r.select(*DOC, *(F.col(c).alias(f"{p}{c}") for c in ("region_ord", "x0", "y0", "x1", "y1"))) for p in ("a_", "b_"))
    over, gap = geometry.horizontal_overlap(geometry.box("a_"), geometry.box("b_")), geometry.vertical_gap(geometry.box("a_"), geometry.box("b_"))
    # a is the upper region: it goes to every bucket in which a region within reach can begin, b only to its own
    bucket = lambda y: F.floor(y / 48)
    a = a.withColumn("bucket", F.explode(F.sequence(bucket(F.col("a_y0")), bucket(F.col("a_y1") + 24))))
    pairs = a.join(b.withColumn("bucket", bucket(F.col("b_y0"))), [*DOC, "bucket"]).filter("struct(a_y0, a_region_ord) < struct(b_y0, b_region_ord)")
    return pairs.filter((over >= 0.2) & (gap <= 24)).groupBy(*DOC).agg(F.count("*").alias("n_pairs"), F.round(F.sum(over), 4).alias("sum_overlap"), F.round(F.max(gap), 4).alias("largest_gap"))


def _kinds(spark, sf):
    """Short lines are titles, others bodies."""
    return src.regions(spark, sf).withColumn("kind", F.when(F.length("text") < 60, "title").otherwise("body"))


def _title_bodies(spark, sf):
    r = _kinds(spark, sf)
    titles = r.filter("kind = 'title'").select(*DOC, F.col("region_ord").alias("title"), *(F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")), F.col("page_height"))
    bodies = r.filter("kind = 'body'").select(*DOC, F.col("region_ord").alias("body"), *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")), F.length("text").alias("body_chars"), F.col("page_height").alias("b_height"))
    gap = geometry.vertical_gap(geometry.box("t_"), geometry.box("b_"))
    # bodies within reach begin in the band of the title's lower edge or in the next one
    band = F.floor(F.col("t_y1") / (0.12 * F.col("page_height")))
    titles = titles.withColumn("band", F.explode(F.array(band, band + 1)))
    bodies = bodies.withColumn("band", F.floor(F.col("b_y0") / (0.12 * F.col("b_height")))).drop("b_height")
    pairs = titles.join(bodies, [*DOC, "band"]).drop("band").filter((F.col("b_y0") >= F.col("t_y1")) & (geometry.horizontal_overlap(geometry.box("t_"), geometry.box("b_")) >= 0.2))
    return pairs.withColumn("gap", gap).filter(F.col("gap") <= 0.12 * F.col("page_height"))


@query
def q10_nearest_body(spark, sf):
    """The nearest body below each title."""
    return ranking.nearest(_title_bodies(spark, sf), [*DOC, "title"], "body", "gap")


@query
def q11_title_barrier(spark, sf):
    """Title-body pairs without another title of the lane between them."""
    pairs = _title_bodies(spark, sf)
    t = _kinds(spark, sf).filter("kind = 'title'").select(F.col("document_id").alias("c_doc"), F.col("pdf_page").alias("c_page"), F.col("region_ord").alias("c_ord"), F.col("x0").alias("c_x0"), F.col("y0").alias("c_y0"))
    between = (F.col("document_id") == F.col("c_doc")) & (F.col("pdf_page") == F.col("c_page")) & (F.col("c_ord") != F.col("title")) & (F.col("c_x0") == F.col("t_x0")) & (F.col("c_y0") > F.col("t_y0")) & (F.col("c_y0") < F.col("b_y0"))
    return pairs.join(t, between, "left_anti").groupBy(*DOC).agg(F.count("*").alias("n_pairs"), F.round(F.sum("gap"), 4).alias("sum_gap"))


def _title_scores(spark, sf):
    near = ranking.nearest(_title_bodies(spark, sf), [*DOC, "title"], "body", "gap").select(*DOC, F.col("title").alias("region_ord"), F.col("gap"))
    r = _kinds(spark, sf).filter("kind = 'title'").join(near, [*DOC, "region_ord"], "left")
    parts = [
        F.when(F.col("raw_label") == "section_header", 0.12).otherwise(0.0),
        F.when((F.col("x1") - F.col("x0")) >= 0.25 * F.col("page_width"), 0.08).otherwise(0.0),
        F.when(F.col("y0") / F.col("page_height") <= 0.55, 0.08).otherwise(0.0),
        F.when(F.col("gap").isNotNull(), 0.13).otherwise(0.0),
        0.12 * text.uppercase_ratio(F.col("text")),
    ]
    score = parts[0]
    for p in parts[1:]:
        score = score + p
    return r.withColumn("score", F.round(score + 1e-9, 4))


@query
def q12_title_score(spark, sf):
    return _title_scores(spark, sf).select(*DOC, "region_ord", "score")


@query
def q13_assign_margin(spark, sf):
    """The title of each page, with threshold and margin."""
    return ranking.winner(_title_scores(spark, sf), DOC, "region_ord", "score", 0.38, 0.08)


@query
def q14_orphan_proximity(spark, sf):
    """Bodies with exactly one title above in their lane."""
    pairs = _title_bodies(spark, sf)
    return ranking.alone(pairs, [*DOC, "body"]).select(*DOC, "body", "title", F.lit(0.55).alias("score"))


@query
def q15_media_caption(spark, sf):
    """Every seventh region is a medium; captions are scored by overlap and gap."""
    r = _kinds(spark, sf)
    media = r.filter("region_ord % 7 = 3").select(*DOC, F.col("region_ord").alias("medium"), *(F.col(c).alias(f"m_{c}") for c in ("x0", "y0", "x1", "y1")), "page_height")
    captions = r.filter("region_ord % 7 <> 3").select(*DOC, F.col("region_ord").alias("caption"), *(F.col(c).alias(f"c_{c}") for c in ("x0", "y0", "x1", "y1")), F.col("page_height").alias("c_height"))
    over, gap = geometry.horizontal_overlap(geometry.box("m_"), geometry.box("c_")), geometry.vertical_gap(geometry.box("m_"), geometry.box("c_")) / F.col("page_height")
    # captions within reach begin in the band of the medium's lower edge or in the next one
    band = F.floor(F.col("m_y1") / (0.04 * F.col("page_height")))
    media = media.withColumn("band", F.explode(F.array(band, band + 1)))
    captions = captions.withColumn("band", F.floor(F.col("c_y0") / (0.04 * F.col("c_height")))).drop("c_height")
    scored = media.join(captions, [*DOC, "band"]).filter((over >= 0.25) & (gap <= 0.04) & (F.col("c_y0") >= F.col("m_y1"))).withColumn("score", F.round(0.45 * over + 0.45 * (1 - gap / 0.04), 6))
    return ranking.winner(scored, [*DOC, "medium"], "caption", "score", 0.62, 0.12)


@query
def q16_shingle_overlap(spark, sf):
    """For each benchmark passage the document that shares most of its 8-word shingles."""
    # two hashes stand for a shingle: 96 bits
    hashed = lambda c: F.explode(F.transform(text.shingles(c, 8), lambda s: F.struct(F.xxhash64(s).alias("a"), F.hash(s).alias("b")))).alias("s")
    left = src.read(spark, sf, "benchmark").select("item_id", hashed(F.col("text")))
    right = src.read(spark, sf, "documents").select("doc_id", hashed(F.col("text")))
    sizes = left.groupBy("item_id").agg(F.count("*").alias("n"))
    # most shingles of documents are in no passage: they go before the shuffle
    wanted = left.select("s").distinct()
    shared = left.join(right.join(wanted, "s", "left_semi"), "s").groupBy("item_id", "doc_id").agg(F.count("*").alias("shared")).filter("shared >= 5")
    best = ranking.top(shared, ["item_id"], [F.col("shared").desc(), F.col("doc_id")], 1)
    return best.join(sizes, "item_id").select("item_id", "doc_id", "shared", F.round(F.col("shared") / F.col("n"), 6).alias("share"))


@query
def q17_dup_self_join(spark, sf):
    """Pages of one document that have the same first line: their class, named by its first page."""
    head = src.read(spark, sf, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").alias("pdf_page"), F.array_join(text.words(F.lower(F.split("text", "\n")[0])), " ").alias("title")).filter("title <> ''")
    # classes, not pairs: a title may stand on a third of all pages
    classes = head.groupBy("document_id", "title").agg(F.min("pdf_page").alias("first_page"), F.count("*").alias("n_pages")).filter("n_pages >= 2")
    before = head.select("document_id", "title", (F.col("pdf_page") + 1).alias("pdf_page"), F.lit(True).alias("follows")).distinct()
    found = head.join(classes, ["document_id", "title"]).join(before, ["document_id", "title", "pdf_page"], "left")
    return found.select("document_id", "pdf_page", "first_page", "n_pages", F.coalesce("follows", F.lit(False)).alias("follows"))


@query
def q18_pull_quote(spark, sf):
    """Lines of 6 to 40 words of four letters or more most of which stand in one other line of the page."""
    pages = lines(spark, sf).dropna(subset=DOC).groupBy(*DOC).agg(F.collect_list(F.struct("region_ord", "text")).alias("lines"))
    rows = F.transform("lines", lambda r: F.struct(r["region_ord"], text.content_tokens(r["text"], 4).alias("w")))
    enough = lambda shared, q: shared >= 0.78 * F.size(q["w"])

    def best(q, rows):
        others = F.transform(F.filter(rows, lambda r: r["region_ord"] != q["region_ord"]), lambda r: F.struct((-F.size(F.array_intersect(q["w"], r["w"]))).alias("less"), r["region_ord"].alias("other")))
        return F.struct(q["region_ord"].alias("region_ord"), F.size(q["w"]).alias("n"), F.array_min(F.filter(others, lambda o: enough(-o["less"], q))).alias("best"))

    def quotes(rows):
        # words of one line only are in no other line, so most lines needn't be compared with the others
        every = F.sort_array(F.flatten(F.transform(rows, lambda r: r["w"])))
        again = text.bound(every, lambda t: F.filter(t, lambda w, k: w == F.get(t, k + 1)))
        tested = lambda again: F.filter(rows, lambda q: F.size(q["w"]).between(6, 40) & enough(F.size(F.array_intersect(q["w"], again)), q))
        return F.transform(text.bound(again, tested), lambda q: best(q, rows))

    found = pages.select(*DOC, F.explode(text.bound(rows, quotes)).alias("q")).filter("q.best is not null")
    return found.select(*DOC, "q.region_ord", "q.best.other", (-F.col("q.best.less")).cast("long").alias("shared"), "q.n")


@query
def q19_url_canonical(spark, sf):
    u = F.col("url")
    norm = urls.normalize(u)
    return src.read(spark, sf, "pages").select("page_id", norm.alias("candidate"), urls.has_path(u).alias("has_path"), urls.article_key(u).alias("article_key"), urls.canonical_key(u).alias("canonical_key"), urls.host_name(u).alias("host"), urls.slug(u).alias("slug"))


@query
def q20_web_text_gate(spark, sf):
    """Article text by pattern and the quality gate's reason."""
    w = src.web_pages(spark, sf)
    body = F.trim(F.regexp_replace(F.regexp_replace("article", r"<[^>]*>", " "), r"[ \t\r\n]+", " "))
    w = w.withColumn("body", body).withColumn("n_chars", F.length("body").cast("long")).withColumn("n_words", F.size(F.split("body", " ")).cast("long"))
    reason = F.when(F.col("n_chars") < 650, "too_short").when(F.col("n_words") < 90, "too_few_words").otherwise("accepted")
    return w.select("page_id", "n_chars", "n_words", reason.alias("reason"))


@query
def q21_index_top1_margin(spark, sf):
    """Benchmark passages to pages by token similarity of passage and page title."""
    e = src.read(spark, sf, "benchmark").select("item_id", F.array_distinct(text.words(F.lower("text"))).alias("e"))
    p = src.read(spark, sf, "pages").select("page_id", F.array_distinct(text.words(F.lower(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)))).alias("p"))
    # candidates share a token; the scores are exact
    pairs = e.select("item_id", F.explode("e").alias("t")).join(p.select("page_id", F.explode("p").alias("t")), "t").groupBy("item_id", "page_id").agg(F.count("*").alias("shared"))
    sized = pairs.join(e.select("item_id", F.size("e").alias("ne")), "item_id").join(p.select("page_id", F.size("p").alias("np")), "page_id")
    scored = sized.withColumn("score", F.round(F.col("shared") / (F.col("ne") + F.col("np") - F.col("shared")), 6))
    return ranking.winner(scored, ["item_id"], "page_id", "score", 0.30, 0.10)


@query
def q23_entity_exact_alias(spark, sf):
    """Customers' segments and nations against the lexicon: exact, then alias."""
    lex = src.lexicon(spark, sf).select("kind", "canonical", text.entity_key(F.col("alias")).alias("k"), (F.col("alias") == F.col("canonical")).alias("is_name"))
    keys = src.read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.explode(F.array("n_name", F.substring("n_name", 1, 3))).alias("said"))
    k = keys.select("c_nationkey", "said", text.entity_key(F.col("said")).alias("k"))
    hit = k.join(lex, "k").groupBy("c_nationkey", "said").agg(F.max("is_name").alias("exact"), F.min("canonical").alias("canonical"), F.count("*").alias("n"))
    return hit.select("c_nationkey", "said", F.when(F.col("exact"), "exact").when(F.col("n") > 1, "ambiguous").otherwise("alias").alias("method"), "canonical")


@query
def q24_entity_fuzzy(spark, sf):
    """Nation names with a letter lost against the lexicon by ratio, lengths checked first."""
    names = src.read(spark, sf, "nation").select(F.col("n_name").alias("canonical"))
    said = names.select(F.col("canonical").alias("truth"), F.concat(F.substring("canonical", 1, 2), F.expr("substring(canonical, 4)")).alias("said"))
    # a ratio of .80 needs lengths within two thirds and three halves: names meet by length
    n = F.length("said")
    reach = said.withColumn("n", F.explode(F.sequence(F.ceil(n * 2 / 3).cast("int"), F.floor(n * 3 / 2).cast("int"))))
    pairs = reach.join(names.withColumn("n", F.length("canonical")), "n").drop("n").filter(text.can_reach(F.col("said"), F.col("canonical"), 0.80))
    scored = pairs.withColumn("score", F.round(similarity.ratio(F.lower("said"), F.lower("canonical")), 4))
    return ranking.winner(scored, ["truth", "said"], "canonical", "score", 0.80, 0.04)


@query
def q25_levenshtein_lexicon(spark, sf):
    """Pairs of names of the lexicon by edit distance."""
    a = src.read(spark, sf, "nation").select(F.col("n_name").alias("a"))
    # an edit changes the length by one at most: names meet by length
    near = a.withColumn("n", F.explode(F.sequence(F.length("a") - 4, F.length("a") + 4)))
    b = a.select(F.col("a").alias("b"), F.length("a").alias("n"))
    return near.join(b, "n").drop("n").filter("a < b").withColumn("distance", F.levenshtein("a", "b").cast("long")).filter("distance <= 4")


@query
def q26_adjacent_pages(spark, sf):
    """Turns of a conversation with the one before: gap and shared tokens."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = src.read(spark, sf, "conversations").select("conv_id", "turn", "role", text.content_tokens(F.col("text"), 4).alias("w"))
    t = t.withColumn("before", F.lag("w").over(w)).withColumn("step", F.col("turn") - F.lag("turn").over(w))
    return t.filter("step is not null").select("conv_id", "turn", "step", F.size(F.array_intersect("w", "before")).cast("long").alias("shared"))


@query
def q27_sheet_sequence(spark, sf):
    """Order lines as sheets n of m: runs without a gap."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    s = src.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") - F.lag("l_linenumber").over(w) == 1).alias("next"))
    return s.groupBy("l_orderkey").agg(F.count("*").alias("sheets"), F.count_if(F.coalesce("next", F.lit(False))).alias("pairs"))


@query
def q28_flow_score(spark, sf):
    """Links between adjacent turns with their score and status."""
    t = q26_adjacent_pages(spark, sf)
    score = F.round(0.4 + 0.3 * (F.col("step") == 1).cast("int") + 0.06 * F.least("shared", F.lit(5)), 4)
    status = F.when(score >= 0.82, "accepted").when(score >= 0.60, "candidate").otherwise("rejected")
    return t.select("conv_id", "turn", score.alias("score"), status.alias("status"))


@query
def q29_chain_state(spark, sf):
    """Chains of turns by the document kernel."""
    t = src.read(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("pdf_page"), text.content_tokens(F.col("text"), 4).alias("tokens"))
    return kernels.chains(t)


@query
def q30_columns(spark, sf):
    """Columns of each page by the page kernel."""
    r = src.regions(spark, sf).select(*DOC, "region_ord", "x0", "y0", "page_width")
    return kernels.columns(r).groupBy(*DOC, "column").agg(F.count("*").alias("n_regions"), F.min("region_ord").alias("first_region")).withColumn("first_region", F.col("first_region").cast("long"))


def _ordered(spark, sf):
    w = Window.partitionBy(*DOC).orderBy("column", "y0", "x0", "region_ord")
    return src.regions(spark, sf).withColumn("column", F.when(F.col("x0") < 175, 0).otherwise(1)).withColumn("place", F.row_number().over(w).cast("long"))


@query
def q31_reading_order(spark, sf):
    """Running order of regions: column, then y; the gap to the region before."""
    w = Window.partitionBy(*DOC).orderBy("place")
    gap = F.when(F.lag("column").over(w) == F.col("column"), F.col("y0") - F.lag("y1").over(w))
    return _ordered(spark, sf).select(*DOC, "region_ord", "place", gap.alias("gap"), F.when(gap > 120, 0.55).otherwise(0.85).alias("confidence"))


@query
def q32_running_offsets(spark, sf):
    """Offsets of regions in the assembled text (two characters between them)."""
    w = Window.partitionBy(*DOC).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).cast("long")
    return _ordered(spark, sf).select(*DOC, "region_ord", start.alias("start"), (start + F.length("text")).cast("long").alias("end"))


@query
def q33_draft_bodies(spark, sf):
    """Bodies in reading order, joined by an empty line."""
    parts = _ordered(spark, sf).groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("parts"))
    body = F.array_join(F.col("parts.text"), "\n\n")
    return parts.select(*DOC, F.size("parts").cast("long").alias("n_parts"), F.length(body).cast("long").alias("n_chars"), F.md5(body).alias("body_md5"))


@query
def q34_completeness(spark, sf):
    """Assigned and open characters of each document and the resulting status."""
    r = _kinds(spark, sf).withColumn("visible", text.visible_chars(F.col("text")))
    sums = r.groupBy("document_id").agg(F.sum(F.when(F.col("kind") == "body", F.col("visible")).otherwise(0)).cast("long").alias("assigned"), F.sum(F.when(F.col("kind") == "title", F.col("visible")).otherwise(0)).cast("long").alias("unassigned"))
    coverage = F.col("assigned") / F.nullif(F.col("assigned") + F.col("unassigned"), F.lit(0))
    reasons = F.array_compact(F.array(F.when(coverage < 0.90, "coverage"), F.when(F.col("unassigned") > 150, "unassigned")))
    return sums.select("document_id", "assigned", "unassigned", F.round(coverage, 6).alias("coverage"), F.array_join(reasons, ";").alias("reasons"), F.when(coverage.isNull(), "unknown").when(F.size(reasons) > 0, "incomplete").otherwise("complete").alias("status"))


def _spans(spark, sf):
    li = src.read(spark, sf, "lineitem")
    start = F.col("l_linenumber").cast("long") * 10
    return li.select("l_orderkey", start.alias("start"), (start + F.floor(F.col("l_quantity")).cast("long")).alias("end"), F.lit(120).cast("long").alias("length"))


@query
def q35_interval_coverage(spark, sf):
    """Union of spans: runs and covered length."""
    m = intervals.merged(_spans(spark, sf), ["l_orderkey"])
    return m.groupBy("l_orderkey").agg(F.count("*").alias("runs"), F.sum(F.col("end") - F.col("start")).cast("long").alias("covered"))


@query
def q36_interval_gaps(spark, sf):
    """What spans leave open of [0, 120)."""
    g = intervals.gaps(_spans(spark, sf), ["l_orderkey"], "length")
    return g.groupBy("l_orderkey").agg(F.count("*").alias("n_gaps"), F.sum(F.col("gap_end") - F.col("gap_start")).cast("long").alias("open"))


@query
def q37_corpus_rollup(spark, sf):
    """Orders over all, by year and by month."""
    o = src.read(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"), "o_orderstatus", "o_totalprice")
    r = o.rollup("year", "month").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_success"), F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)), 2).alias("price_success"))
    return r


@query
def q38_audit_rates(spark, sf):
    """Rates of audit verdicts by source, unpivoted."""
    j = src.read(spark, sf, "labels").join(src.read(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    u = j.unpivot(["doc_id", "source"], ["quality", "toxic"], "verdict", "value")
    return u.groupBy("source", "verdict").agg(F.count("value").alias("reviewed"), F.round(F.avg("value"), 6).alias("rate"))


@query
def q39_unmatched_entries(spark, sf):
    """Documents without a verdict."""
    return src.read(spark, sf, "documents").join(src.read(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query
def q40_membership_fixpoint(spark, sf):
    """Owners spread from the first region to bodies of the page."""
    r = _kinds(spark, sf).select(*DOC, "region_ord", "kind", "x0", "y0", "x1", "y1", F.when(F.col("region_ord") < 2, F.concat(F.lit("article_"), F.substring(F.sha2(F.concat(F.col("document_id"), F.lit("\0"), F.col("pdf_page"), F.lit("\0"), F.col("region_ord")), 256), 1, 16))).alias("article_id"))
    return kernels.membership(r).filter("article_id is not null").groupBy(*DOC, "article_id").agg(F.count("*").alias("n_regions"), F.round(F.avg("score"), 4).alias("score"))


@query
def q41_image_coverage(spark, sf):
    """Share of a 32 x 32 grid that regions of a page cover."""
    r = src.regions(spark, sf)
    cell = lambda c, size: F.greatest(F.lit(0), F.least(F.lit(31), F.floor(c / size * 32)))
    left, right = cell(F.col("x0"), F.col("page_width")), cell(F.col("x1") - 1e-6, F.col("page_width"))
    # a grid row's cells are the bits of one number, so that a page has 32 rows at most
    rows = r.select(*DOC, (F.pow(F.lit(2.0), right + 1) - F.pow(F.lit(2.0), left)).cast("long").alias("gx"), F.explode(F.sequence(cell(F.col("y0"), F.col("page_height")), cell(F.col("y1") - 1e-6, F.col("page_height")))).alias("gy"))
    cells = rows.groupBy(*DOC, "gy").agg(F.bit_or("gx").alias("gx"))
    return cells.groupBy(*DOC).agg(F.round(F.sum(F.bit_count("gx")) / 1024, 6).alias("coverage"))


@query
def q42_page_type(spark, sf):
    """Page type by counts of markers."""
    f = text.flags(F.col("text"))
    p = lines(spark, sf).groupBy(*DOC).agg(F.count_if(f["has_foglio"] | f["has_tiratura"]).alias("clip"), F.count_if(f["has_share"] | f["has_navigation"] | f["has_cookie"]).alias("web"), F.sum(F.length("text")).alias("chars"), F.bool_or(f["has_url"]).alias("url"))
    kind = F.when(F.col("clip") >= 2, "press_clipping").when((F.col("web") >= 2) | F.col("url"), "web").when((F.col("chars") >= 500) & (F.col("web") == 0), "pure_text").otherwise("unknown")
    return p.select(*DOC, kind.alias("page_type"))


@query
def q43_date_extract(spark, sf):
    """Dates printed in both notations are read back."""
    o = src.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    named = F.concat(F.lit("foglio 2/7 del 31-FEB-2024 e "), F.date_format("d", "dd"), F.lit("-"), F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month("d")), F.lit("-"), F.date_format("d", "yyyy"))
    slash = F.concat(F.lit("da pag. 12 "), F.day("d"), F.lit("/"), F.month("d"), F.lit("/"), F.date_format("d", "yyyy"))
    said = F.when(F.col("o_orderkey") % 2 == 0, named).otherwise(slash)
    o = o.withColumn("said", said)
    current, total = dates.sheet(F.col("said"))
    return o.select("o_orderkey", dates.extract_date(F.col("said")).cast("string").alias("found"), current.cast("long").alias("sheet"), total.cast("long").alias("sheets"), dates.original_page(F.col("said")).cast("long").alias("original_page"))


@query
def q44_source_continuity(spark, sf):
    """Spans that continue one another within three characters."""
    w = Window.partitionBy("l_orderkey").orderBy("start", "end")
    s = _spans(spark, sf).withColumn("jump", F.col("start") - F.lag("end").over(w))
    return s.filter("jump between 0 and 3").groupBy("l_orderkey").agg(F.count("*").alias("n_continuations"))


@query
def q45_claimants(spark, sf):
    """Hosts claimed by several languages: one owner, or ambiguous."""
    p = src.read(spark, sf, "pages").select("page_id", urls.host_name(F.col("url")).alias("host"), F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1).alias("lang"))
    return p.groupBy("host").agg(F.count("*").alias("n"), F.countDistinct("lang").alias("owners"), F.when(F.countDistinct("lang") == 1, F.max("lang")).otherwise("ambiguous").alias("owner"))


@query
def q46_assembled_text(spark, sf):
    """Body text by the assembly kernel."""
    out = kernels.by_page(lines(spark, sf).filter("text <> ''"), kernels.assemble, "document_id string, pdf_page long, body string, joined long")
    return out.select(*DOC, F.length("body").cast("long").alias("n_chars"), "joined")


@query
def q47_untitled_groups(spark, sf):
    """Runs of turns without a gap or a change to the first role."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = src.read(spark, sf, "conversations").withColumn("break", F.coalesce(F.col("turn") - F.lag("turn").over(w) > 1, F.lit(True)) | (F.length("text") < 200))
    runs = intervals.islands(t, ["conv_id"], ["turn"], "break")
    return runs.groupBy("conv_id", "island").agg(F.min("turn").alias("first_turn"), F.count("*").alias("n_turns"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query
def q48_style_mode(spark, sf):
    """Modal value, median and weighted share per brand: the aggregates of the style join."""
    p = src.read(spark, sf, "part")
    modal = p.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    best = ranking.top(modal, ["p_brand"], [F.col("n").desc(), F.col("p_type")], 1).select("p_brand", F.col("p_type").alias("modal_type"))
    stats = p.groupBy("p_brand").agg(F.round(F.median("p_retailprice"), 4).alias("median_price"), F.max("p_size").cast("long").alias("max_size"), F.round(F.sum(F.when(F.col("p_type").contains("STEEL"), F.col("p_size")).otherwise(0)) / F.sum("p_size"), 6).alias("steel_share"))
    return stats.join(best, "p_brand")
