"""Queries of links between pages (turns of conversations stand for pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import text
from layoutlake.operators import links
from layoutlake.plans.oracle import WORDS
from layoutlake.sources import tables as src

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Descriptions of pages made from the length n and place of a turn: name, SQL expression.
FIELDS = {
    "url": "CASE WHEN n % 5 < 3 THEN 'u' || CAST(conv_id % 7 + (n % 11) // 10 AS VARCHAR) END",
    "source": "CASE WHEN n % 4 < 3 THEN 's' || CAST(conv_id % 5 + (n % 13) // 12 AS VARCHAR) END",
    "date": "CASE WHEN n % 3 < 2 THEN conv_id % 28 + (n % 17) // 16 END",
    "total": "CASE WHEN n % 6 < 4 THEN 3 + conv_id % 2 END",
    "sheet": "CASE WHEN n % 7 < 5 THEN turn + 1 END",
    "print_id": "CASE WHEN n % 8 < 3 THEN conv_id % 9 END",
    "audience": "CASE WHEN n % 9 < 5 THEN conv_id % 3 + (n % 19) // 18 END",
    "web": "n % 2 = 0",
    "n_titles": "CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END",
    "owner": "CASE WHEN n % 11 = 0 THEN 'o' || CAST(turn % 2 AS VARCHAR) END",
    "owners": "CASE WHEN n % 11 = 0 THEN 1 + (n % 23) // 22 ELSE 0 END",
    "is_index": "n % 29 = 0",
    "lane": "(n % 5) / 20",
    "original_page": "CASE WHEN n % 5 < 4 THEN conv_id % 40 END",
    "index_entry": "CASE WHEN n % 6 < 3 THEN conv_id % 40 END",
    "title": "CASE WHEN n % 10 = 0 THEN 't' || CAST(conv_id % 4 AS VARCHAR) END",
    "area": "CASE WHEN n % 3 < 2 THEN conv_id % 4 END",
    "prior": "n % 5 = 1",
    "header": "CASE WHEN n % 4 < 3 THEN 'h' || CAST(conv_id % 6 AS VARCHAR) END",
    "column": "n % 3",
    "starts": "(n % 10) / 10",
    "open_end": "n % 2 = 1",
    "open_start": "n % 3 = 1",
    "author": "CASE WHEN n % 12 < 5 THEN conv_id % 8 END",
    "chars": "n",
}
PAGES = "base AS (SELECT conv_id, turn, length(text) AS n, text FROM conversations), pages AS (SELECT conv_id, turn, " + ", ".join(f'{sql} AS "{c}"' for c, sql in FIELDS.items()) + f", list_distinct({WORDS.format('text')}) AS words FROM base), p AS (SELECT l.conv_id, l.turn AS lt, l.*, r.* FROM pages l JOIN pages r ON l.conv_id = r.conv_id AND r.turn = l.turn + 1)"


def _spark(sql: str) -> str:
    """The expression in Spark's dialect."""
    return sql.replace("//", "div").replace("VARCHAR", "STRING")


def pages(spark, sf) -> DataFrame:
    base = src.read(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"), "text")
    return base.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("pdf_page"), *(F.expr(_spark(sql)).alias(c) for c, sql in FIELDS.items()), F.array_distinct(text.words(F.lower("text"))).alias("words"))


PAIRS = PAGES.rsplit(", p AS", 1)[0]


def _pair(where: str) -> str:
    return f"{PAIRS}, p AS (SELECT l.conv_id, l.turn AS lt, {where} FROM pages l JOIN pages r ON l.conv_id = r.conv_id AND r.turn = l.turn + 1)"


def _same(c: str) -> str:
    return f'coalesce(l."{c}" = r."{c}", false)'


def _conflict(c: str) -> str:
    return f'(l."{c}" IS NOT NULL AND r."{c}" IS NOT NULL AND l."{c}" <> r."{c}")'


def _if(condition: str, v: float) -> str:
    return f"CASE WHEN {condition} THEN {v} ELSE 0 END"


def _n(*conditions: str) -> str:
    return " + ".join(f"CAST(coalesce({c}, false) AS INT)" for c in conditions)


STEP = "coalesce(r.sheet = l.sheet + 1, false)"
NEXT = f"({STEP} AND {_same('total')})"
GENERAL = _pair(f"""round(0.15 + {_if(_same('url'), 0.36)} + {_if(_same('source'), 0.17)} + {_if(_same('date'), 0.09)} + {_if('l.web AND r.web', 0.11)} + {_if(_same('print_id'), 0.29)} + {_if(_same('audience'), 0.13)} + {_if(NEXT, 0.38)} + {_if('r.owners = 0', 0.05)} + {_if('abs(l.lane - r.lane) <= 0.11', 0.08)}, 4) AS score,
  {_n(_same('url'), _same('source'), _same('print_id'), _same('audience'), NEXT)} AS signals,
  CASE WHEN l.is_index OR r.is_index THEN 'index_page' WHEN {_conflict('url')} THEN 'url_conflict' WHEN {_conflict('source')} THEN 'source_conflict' WHEN {_conflict('date')} THEN 'date_conflict' WHEN {_conflict('total')} THEN 'total_conflict' WHEN {_conflict('print_id')} THEN 'print_id_conflict' WHEN r.n_titles > 0 THEN 'title_on_target' WHEN r.owner IS NOT NULL AND NOT {_same('owner')} THEN 'foreign_owner' END AS veto""")


@query(f"WITH {GENERAL} SELECT conv_id AS document_id, lt AS from_page, CAST(score AS DOUBLE) AS score, signals, veto, CASE WHEN veto IS NOT NULL THEN 'vetoed' WHEN score >= 0.72 AND signals >= 2 THEN 'accepted' ELSE 'rejected' END AS status FROM p")
def q100_general_continuation(spark, sf):
    """General continuation of pages: vetoes, then score and independent signals."""
    return links.general(links.pairs(pages(spark, sf))).select("document_id", F.col("l_pdf_page").alias("from_page"), "score", "signals", "veto", "status")


NEWSPAPER = _pair(f"""round(0.05 + CASE WHEN {NEXT} THEN 0.74 WHEN {STEP} THEN 0.30 ELSE 0 END + {_if(_same('source'), 0.10)} + {_if(_same('date'), 0.07)} + {_if(_same('original_page'), 0.04)} + {_if(_same('index_entry'), 0.05)} + {_if(_same('title'), 0.08)}, 4) AS score,
  CASE WHEN (l.sheet IS NOT NULL AND r.sheet IS NOT NULL AND NOT {STEP}) OR {_conflict('total')} THEN 'sheet_conflict' WHEN {_conflict('source')} THEN 'source_conflict' WHEN {_conflict('date')} THEN 'date_conflict' WHEN r.n_titles > 0 AND NOT {_same('title')} THEN 'new_title' WHEN l.owners > 1 THEN 'several_articles' WHEN r.owner IS NOT NULL AND NOT {_same('owner')} THEN 'foreign_owner' END AS veto""")


@query(f"WITH {NEWSPAPER} SELECT conv_id AS document_id, lt AS from_page, CAST(score AS DOUBLE) AS score, veto, CASE WHEN veto IS NOT NULL THEN 'vetoed' WHEN score >= 0.74 THEN 'accepted' WHEN score >= 0.50 THEN 'candidate' ELSE 'rejected' END AS status FROM p")
def q101_newspaper_sheets(spark, sf):
    """Sheets of a clipping that follow each other."""
    return links.newspaper(links.pairs(pages(spark, sf))).select("document_id", F.col("l_pdf_page").alias("from_page"), "score", "veto", "status")


HEADER = f"(NOT {_same('source')} AND {_same('header')})"
SYNTAX = "(l.open_end AND r.open_start)"
SHARED = "(len(list_intersect(l.words, r.words)) / greatest(len(list_distinct(list_concat(l.words, r.words))), 1) >= 0.12)"
WEB = _pair(f"""round(0.04 + {_if(_same('area'), 0.18)} + {_if('l.prior AND r.prior', 0.08)} + {_if(STEP, 0.14)} + {_if(_same('url'), 0.30)} + {_if(_same('source'), 0.14)} + {_if(HEADER, 0.10)} + CASE WHEN {_same('date')} THEN 0.08 WHEN {_conflict('date')} THEN -0.15 ELSE 0 END + {_if(_same('column'), 0.16)} + {_if('r.starts <= 0.40', 0.12)} + {_if(SYNTAX, 0.12)} + {_if(SHARED, 0.08)} + {_if(_same('author'), 0.09)}, 4) AS score,
  {_n(_same('area'), f"({_same('source')} OR {HEADER})", _same('column'), 'r.starts <= 0.40', SYNTAX, STEP, _same('url'))} AS keys, CASE WHEN {_conflict('url')} THEN 'url_conflict' WHEN {_conflict('source')} THEN 'source_conflict' END AS veto, {SYNTAX} AS syntax, r.n_titles AS n_titles, {_n(_same('url'), _same('source'), STEP, SYNTAX, _same('author'))} AS strong""")


@query(f"""WITH {WEB}, s AS (SELECT *, CASE WHEN veto IS NOT NULL THEN 'vetoed' WHEN score >= 0.60 OR (score >= 0.52 AND keys >= 5) THEN 'candidate' ELSE 'rejected' END AS status, round(least(score + CASE WHEN syntax THEN 0.12 ELSE 0 END, 1.0), 4) AS flow_score FROM p)
  SELECT conv_id AS document_id, lt AS from_page, CAST(score AS DOUBLE) AS score, keys, veto, status, CAST(flow_score AS DOUBLE) AS flow_score, CASE WHEN n_titles > 0 OR status <> 'candidate' THEN 'rejected' WHEN flow_score >= 0.82 AND strong >= 2 THEN 'accepted' ELSE 'candidate' END AS flow FROM s""")
def q102_web_chain_scores(spark, sf):
    """Pages of a web article that follow each other, and the flow links between them."""
    return links.web(links.pairs(pages(spark, sf))).select("document_id", F.col("l_pdf_page").alias("from_page"), "score", "keys", "veto", "status", "flow_score", "flow")


COMPATIBLE = "(p.{c} IS NULL OR a.{c} IS NULL OR p.{c} = a.{c})"


@query(f"""WITH {PAIRS}, a AS (SELECT * FROM pages WHERE n_titles > 0), s AS (SELECT a.conv_id, a.turn AS anchor, i AS place, a.lane AS al, a.date AS ad, a.url AS au FROM a, range(1, 6) t(i)),
  g AS (SELECT s.conv_id, anchor, place, s.anchor + place AS pdf_page, coalesce(abs(p.lane - al) <= 0.065 AND p.chars >= 30 AND p.n_titles = 0 AND (p.date IS NULL OR ad IS NULL OR p.date = ad) AND (p.url IS NULL OR au IS NULL OR p.url = au), false) AS good FROM s LEFT JOIN pages p ON p.conv_id = s.conv_id AND p.turn = s.anchor + place),
  h AS (SELECT *, min(CAST(good AS INT)) OVER (PARTITION BY conv_id, anchor ORDER BY place ROWS UNBOUNDED PRECEDING) AS held FROM g)
  SELECT conv_id AS document_id, anchor, pdf_page, place, CAST(CASE WHEN place = 1 THEN 0.90 ELSE 0.82 END AS DOUBLE) AS confidence FROM h WHERE held = 1""")
def q103_anchored_lanes(spark, sf):
    """Pages behind a titled page that stay in its lane, until the first that breaks off."""
    p = pages(spark, sf)
    return links.lanes(p, p.filter("n_titles > 0"), least_chars=30)


@query(f"""WITH {PAIRS}, q AS (SELECT *, 60.0 + 40 * (n % 5) AS lane_pt, n // 2 AS lc, n AS c2 FROM (SELECT pages.*, chars AS n FROM pages)) SELECT l.conv_id AS document_id, l.turn AS from_page, r.turn AS to_page, CASE WHEN NOT coalesce(l.audience = r.audience, false) THEN 'other_audience' WHEN r.n_titles > 0 THEN 'new_title'
  WHEN abs(l.lane_pt - r.lane_pt) <= greatest(23.0, 0.065 * 600) AND r.chars >= 175 AND CASE WHEN r.chars % 3 = 0 THEN r.chars // 2 ELSE r.chars END >= 0.70 * r.chars THEN 'accepted' ELSE 'rejected' END AS status FROM q l JOIN q r ON l.conv_id = r.conv_id AND r.turn = l.turn + 1""")
def q104_cross_page_wrappers(spark, sf):
    """Pages that continue a web article by audience mark and lane."""
    n = F.col("chars")
    p = pages(spark, sf).withColumns({"lane": 60.0 + 40 * (n % 5), "page_width": F.lit(600.0), "lane_chars": F.when(n % 3 == 0, F.floor(n / 2)).otherwise(n)})
    return links.wrappers(p)


@query(f"""WITH {PAIRS}, l AS (SELECT p.conv_id, p.turn, a.turn AS anchor, a.url AS au, a.source AS asrc, a.date AS ad FROM pages p JOIN pages a ON p.conv_id = a.conv_id AND a.turn = p.turn - 1 AND a.n_titles > 0)
  SELECT p.conv_id AS document_id, p.turn AS pdf_page, CASE WHEN ok THEN coalesce(p.url, au) ELSE p.url END AS url, CASE WHEN ok THEN coalesce(p.source, asrc) ELSE p.source END AS source, CASE WHEN ok THEN coalesce(p.date, ad) ELSE p.date END AS date, ok AS from_anchor
  FROM (SELECT p.*, au, asrc, ad, coalesce(anchor IS NOT NULL AND (p.url IS NULL OR au IS NULL OR p.url = au) AND (p.source IS NULL OR asrc IS NULL OR p.source = asrc) AND (p.date IS NULL OR ad IS NULL OR p.date = ad), false) AS ok FROM pages p LEFT JOIN l ON l.conv_id = p.conv_id AND l.turn = p.turn) p""")
def q105_propagated_metadata(spark, sf):
    """Address, source and date that a titled page passes on to the next one."""
    p = pages(spark, sf)
    found = p.filter("n_titles > 0").select("document_id", F.col("pdf_page").alias("anchor"), (F.col("pdf_page") + 1).alias("pdf_page"))
    return links.propagated(p.select("document_id", "pdf_page", "url", "source", "date"), found, ["url", "source", "date"])
