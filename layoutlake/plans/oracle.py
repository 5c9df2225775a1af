"""DuckDB SQL that gives the rows of the registered queries."""

from __future__ import annotations

from layoutlake.functions.text import KEYWORDS, NOTICES
from layoutlake.functions.urls import JUNK_HINTS, JUNK_HOSTS

LINES = "lines AS (SELECT source AS document_id, doc_id AS pdf_page, unnest(range(len(string_split(text, chr(10))))) AS region_ord, unnest(string_split(text, chr(10))) AS text FROM documents)"
REGIONS = LINES + """, regions AS (SELECT *, 40.0 + 270 * (region_ord % 2) AS x0, 60.0 + 24 * (region_ord // 2) AS y0, 280.0 + 270 * (region_ord % 2) AS x1, 78.0 + 24 * (region_ord // 2) AS y1, 600.0 AS page_width, 1400.0 AS page_height FROM lines)"""
KINDS = REGIONS + ", kinds AS (SELECT *, CASE WHEN length(text) < 60 THEN 'title' ELSE 'body' END AS kind FROM regions)"


def overlap(a: str, b: str) -> str:
    return f"(greatest(0, least({a}x1, {b}x1) - greatest({a}x0, {b}x0)) / least({a}x1 - {a}x0, {b}x1 - {b}x0))"


def gap(a: str, b: str) -> str:
    return f"greatest(0, {a}y0 - {b}y1, {b}y0 - {a}y1)"


def flag(name: str) -> str:
    hits = " OR ".join(f"contains(lower(text), '{k}')" for k in KEYWORDS[name])
    extra = {"ad": " OR trim(lower(text)) IN ('adv', 'ads', 'ad')", "navigation": " OR trim(lower(text)) = 'home'"}.get(name, "")
    return f"({hits}{extra})"


URL = "(contains(lower(text), 'http://') OR contains(lower(text), 'https://'))"
WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
UPPER = r"(CASE WHEN length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0 THEN length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) ELSE 0 END)"
PAIRS = KINDS + f""", pairs AS (
  SELECT t.document_id, t.pdf_page, t.region_ord AS title, b.region_ord AS body, t.x0 AS t_x0, t.y0 AS t_y0, b.y0 AS b_y0, {gap('t.', 'b.')} AS gap
  FROM kinds t JOIN kinds b USING (document_id, pdf_page)
  WHERE t.kind = 'title' AND b.kind = 'body' AND b.y0 >= t.y1 AND {overlap('t.', 'b.')} >= 0.2 AND {gap('t.', 'b.')} <= 0.12 * 1400)"""
SCORES = PAIRS + f""", near AS (SELECT document_id, pdf_page, title, min(gap) AS gap FROM pairs GROUP BY ALL), scores AS (
  SELECT k.document_id, k.pdf_page, k.region_ord, round((CASE WHEN k.region_ord = 0 THEN 0.12 ELSE 0 END) + 0.08 + (CASE WHEN y0 / 1400 <= 0.55 THEN 0.08 ELSE 0 END)
    + (CASE WHEN n.gap IS NOT NULL THEN 0.13 ELSE 0 END) + 0.12 * {UPPER} + 1e-9, 4) AS score
  FROM kinds k LEFT JOIN near n ON k.document_id = n.document_id AND k.pdf_page = n.pdf_page AND k.region_ord = n.title WHERE kind = 'title')"""


def winner(source: str, key: str, candidate: str, threshold: float, margin: float) -> str:
    return f"""SELECT {key}, {candidate}, score, round(score - coalesce(nxt, 0), 6) AS lead,
      CASE WHEN score < {threshold} THEN 'rejected' WHEN score - coalesce(nxt, 0) < {margin} - 1e-12 THEN 'ambiguous' ELSE 'accepted' END AS status
      FROM (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS nxt FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY score DESC, {candidate})) WHERE rn = 1"""


ORDERED = REGIONS + ", placed AS (SELECT *, CASE WHEN x0 < 175 THEN 0 ELSE 1 END AS col FROM regions), ordered AS (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page ORDER BY col, y0, x0, region_ord) AS place FROM placed)"
SPANS = "spans AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 10 AS s, CAST(l_linenumber AS BIGINT) * 10 + CAST(floor(l_quantity) AS BIGINT) AS e FROM lineitem)"
ADJACENT = f"turns AS (SELECT conv_id, turn, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w FROM conversations), adjacent AS (SELECT conv_id, turn, turn - lag(turn) OVER x AS step, len(list_intersect(w, lag(w) OVER x)) AS shared FROM turns WINDOW x AS (PARTITION BY conv_id ORDER BY turn))"
PARTS = r"'^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$'"
FAMILY = r"trim(regexp_replace(lower(text), '[ \t\r\n]+', ' ', 'g'))"


def url_part(k: int, url: str = "url") -> str:
    return f"regexp_extract({url}, {PARTS}, {k})"


CANDIDATE = "rtrim(trim(url), '.,;)]}\"''')"
HOST = rf"regexp_replace(lower({url_part(2)}), '^www\.|:\d+$', '', 'g')"
JUNK = " OR ".join(f"contains(lower({CANDIDATE}), '{j}')" for j in (*JUNK_HOSTS, *JUNK_HINTS))
NOTICE = r"regexp_replace(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '^[ .;:!\-–—…]+|[ .;:!\-–—…]+$', '', 'g')"
MARKER = "CASE " + " ".join(f"WHEN regexp_matches(n, '^(?:{p})$') THEN '{m}'" for m, p in NOTICES) + " END"
PART = " OR ".join(f"regexp_matches(n, '{p}')" for _, p in NOTICES)
SHINGLES = "list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))"
TIDY = r"trim(regexp_replace(regexp_replace(regexp_replace(body, '(?i)[\s(@©•_]*riproduzione[\s_]*riservata[\s).]*', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), ' *\n *', chr(10), 'g'))"

SQL = {
    "q01_page_features": f"WITH {LINES} SELECT document_id, pdf_page, count(*) AS n_regions, CAST(sum(length(text)) AS BIGINT) AS text_chars, count_if({flag('rights')}) AS n_rights, count_if({URL}) AS n_url, count_if(length(text) >= 80) AS n_long, max(length(text)) AS longest FROM lines GROUP BY ALL",
    "q02_region_flags": f"WITH {LINES} SELECT document_id, " + ", ".join(f"count_if({flag(n)}) AS has_{n}" for n in ("ad", "share", "related", "navigation", "rights", "watermark", "cookie", "newsletter")) + f""", count_if({URL}) AS has_url,
      count_if(regexp_matches(text, '\\b\\d{{1,2}}[-/][a-zA-Z]{{3}}[-/]\\d{{4}}\\b') OR regexp_matches(text, '\\b\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}\\b')) AS has_date,
      count_if(regexp_matches(lower(text), '^\\s*(?:di\\s+|da\\s+|a\\s+cura\\s+di\\s+)')) AS has_author, count_if(regexp_matches(lower(text), '\\bfoglio\\b')) AS has_foglio,
      count_if(trim(lower(text)) IN ('stampa locale', 'stampa nazionale', 'web', 'radio', 'tv', 'televisione')) AS section_label,
      count_if(length(trim(lower(text))) <= 180 AND (contains(lower(text), 'pag.') OR regexp_matches(lower(text), '\\bpagina\\s+\\d+\\b') OR regexp_matches(trim(lower(text)), '\\.{{3,}}\\s*\\d+$'))) AS index_entry
      FROM lines GROUP BY document_id""",
    "q03_uppercase_ratio": f"WITH {LINES} SELECT document_id, pdf_page, region_ord, round({UPPER}, 6) AS uppercase_ratio FROM lines",
    "q04_visible_chars": rf"WITH {LINES} SELECT document_id, pdf_page, CAST(sum(length(regexp_replace(text, '[ \t\r\n\f\x0B]', '', 'g'))) AS BIGINT) AS visible_chars FROM lines GROUP BY ALL",
    "q05_boilerplate_lines": rf"""WITH {LINES}, t AS (SELECT document_id, pdf_page, {FAMILY} AS p FROM lines), f AS (
      SELECT document_id, pdf_page, CASE WHEN regexp_matches(p, '^data +stampa\b') THEN 'data_stampa' WHEN p IN ('web', 'stampa locale', 'stampa nazionale') THEN 'section_label'
        WHEN regexp_matches(p, '^articolo +non +cedibile\b') OR regexp_matches(p, '^uso +esclusivo\b') THEN 'rights_candidate' WHEN length(p) >= 8 AND len(string_split(p, ' ')) <= 12 THEN 'generic_exact' END AS family, p
      FROM t WHERE p <> '' AND length(p) <= 180), g AS (
      SELECT document_id, family, CASE family WHEN 'data_stampa' THEN 'data stampa <variabile>' WHEN 'rights_candidate' THEN regexp_replace(p, '\b\d+(?:[./:-]\d+)*\b', '<num>', 'g') ELSE p END AS pattern, count(DISTINCT pdf_page) AS pages
      FROM f WHERE family IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT pdf_page) >= 2)
      SELECT document_id, family, pattern, pages, n_pages, round(pages / n_pages, 6) AS frequency, pages / n_pages >= 0.5 AS repeated
      FROM g JOIN (SELECT source AS document_id, count(DISTINCT doc_id) AS n_pages FROM documents GROUP BY 1) USING (document_id)""",
    "q06_rights_notice": f"WITH {LINES}, t AS (SELECT document_id, {NOTICE} AS n FROM lines), m AS (SELECT document_id, {MARKER} AS marker, ({PART}) AS part FROM t) SELECT document_id, CASE WHEN marker IS NOT NULL THEN 'accepted' WHEN part THEN 'ambiguous' ELSE 'none' END AS status, coalesce(marker, '') AS marker, count(*) AS n FROM m GROUP BY 1, 2, 3",
    "q07_rights_scrub": f"WITH b AS (SELECT doc_id, text || ' © Riproduzione riservata.' AS body FROM documents) SELECT doc_id, length({TIDY}) AS n_chars, md5({TIDY}) AS body_md5 FROM b",
    "q09_geometry_pairs": f"WITH {REGIONS} SELECT a.document_id, a.pdf_page, count(*) AS n_pairs, CAST(round(sum({overlap('a.', 'b.')}), 4) AS DOUBLE) AS sum_overlap, CAST(round(max({gap('a.', 'b.')}), 4) AS DOUBLE) AS largest_gap FROM regions a JOIN regions b USING (document_id, pdf_page) WHERE a.region_ord < b.region_ord AND {overlap('a.', 'b.')} >= 0.2 AND {gap('a.', 'b.')} <= 24 GROUP BY ALL",
    "q10_nearest_body": f"WITH {PAIRS} SELECT document_id, pdf_page, title, arg_min(body, (gap, body)) AS body, CAST(min(gap) AS DOUBLE) AS gap FROM pairs GROUP BY ALL",
    "q11_title_barrier": f"WITH {PAIRS} SELECT document_id, pdf_page, count(*) AS n_pairs, CAST(round(sum(gap), 4) AS DOUBLE) AS sum_gap FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM kinds c WHERE c.kind = 'title' AND c.document_id = p.document_id AND c.pdf_page = p.pdf_page AND c.region_ord <> p.title AND c.x0 = p.t_x0 AND c.y0 > p.t_y0 AND c.y0 < p.b_y0) GROUP BY ALL",
    "q12_title_score": f"WITH {SCORES} SELECT * FROM scores",
    "q13_assign_margin": f"WITH {SCORES} " + winner("scores", "document_id, pdf_page", "region_ord", 0.38, 0.08),
    "q14_orphan_proximity": f"WITH {PAIRS} SELECT document_id, pdf_page, body, min(title) AS title, CAST(0.55 AS DOUBLE) AS score FROM pairs GROUP BY 1, 2, 3 HAVING count(*) = 1",
    "q15_media_caption": f"WITH {REGIONS}, scored AS (SELECT m.document_id, m.pdf_page, m.region_ord AS medium, c.region_ord AS caption, round(0.45 * {overlap('m.', 'c.')} + 0.45 * (1 - {gap('m.', 'c.')} / 1400 / 0.04), 6) AS score FROM regions m JOIN regions c USING (document_id, pdf_page) WHERE m.region_ord % 7 = 3 AND c.region_ord % 7 <> 3 AND {overlap('m.', 'c.')} >= 0.25 AND {gap('m.', 'c.')} / 1400 <= 0.04 AND c.y0 >= m.y1) " + winner("scored", "document_id, pdf_page, medium", "caption", 0.62, 0.12),
    "q16_shingle_overlap": f"""WITH l AS (SELECT item_id, unnest({SHINGLES}) AS s FROM (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark) WHERE len(w) >= 8),
      r AS (SELECT doc_id, unnest({SHINGLES}) AS s FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents) WHERE len(w) >= 8),
      h AS (SELECT item_id, doc_id, count(*) AS shared FROM l JOIN r USING (s) GROUP BY 1, 2 HAVING count(*) >= 5), b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS rn FROM h)
      SELECT item_id, doc_id, shared, round(shared / n, 6) AS share FROM b JOIN (SELECT item_id, count(*) AS n FROM l GROUP BY 1) USING (item_id) WHERE rn = 1""",
    "q17_dup_self_join": f"""WITH h AS (SELECT source AS document_id, doc_id AS pdf_page, array_to_string({WORDS.format('string_split(text, chr(10))[1]')}, ' ') AS t FROM documents), c AS (SELECT document_id, t, min(pdf_page) AS first_page, count(*) AS n_pages FROM h WHERE t <> '' GROUP BY 1, 2 HAVING count(*) >= 2)
      SELECT h.document_id, h.pdf_page, first_page, n_pages, EXISTS (SELECT 1 FROM h p WHERE p.document_id = h.document_id AND p.t = h.t AND p.pdf_page = h.pdf_page - 1) AS follows FROM h JOIN c ON h.document_id = c.document_id AND h.t = c.t""",
    "q18_pull_quote": f"""WITH {LINES}, t AS (SELECT document_id, pdf_page, region_ord, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w FROM lines),
      e AS (SELECT document_id, pdf_page, region_ord, len(w) AS n, unnest(w) AS t FROM t),
      c AS (SELECT a.document_id, a.pdf_page, a.region_ord, b.region_ord AS other, a.n, count(*) AS shared FROM e a JOIN e b USING (document_id, pdf_page, t) WHERE a.n BETWEEN 6 AND 40 AND a.region_ord <> b.region_ord GROUP BY ALL HAVING count(*) >= 0.78 * a.n)
      SELECT document_id, pdf_page, region_ord, other, shared, n FROM (SELECT *, row_number() OVER (PARTITION BY document_id, pdf_page, region_ord ORDER BY shared DESC, other) AS rn FROM c) WHERE rn = 1""",
    "q19_url_canonical": rf"""SELECT page_id, CASE WHEN lower({url_part(1, CANDIDATE)}) IN ('http', 'https') AND {url_part(2, CANDIDATE)} <> '' AND NOT contains({url_part(2, CANDIDATE)}, '@') AND NOT ({JUNK}) THEN {CANDIDATE} END AS candidate,
      {url_part(3)} NOT IN ('', '/') AS has_path, lower({url_part(1)}) || '://' || lower({url_part(2)}) || regexp_replace({url_part(3)}, '/+$', '') || {url_part(4)} AS article_key,
      {HOST} || regexp_replace({url_part(3)}, '/+$', '') AS canonical_key, {HOST} AS host,
      trim(regexp_replace(translate(regexp_replace(regexp_extract(regexp_replace({url_part(3)}, '/+$', ''), '([^/]*)$', 1), '\.[A-Za-z]{{2,5}}$', ''), '-_', '  '), ' +', ' ', 'g')) AS slug FROM pages""",
    "q20_web_text_gate": r"""WITH b AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS body FROM pages)
      SELECT page_id, length(body) AS n_chars, len(string_split(body, ' ')) AS n_words, CASE WHEN length(body) < 650 THEN 'too_short' WHEN len(string_split(body, ' ')) < 90 THEN 'too_few_words' ELSE 'accepted' END AS reason FROM b""",
    "q21_index_top1_margin": f"""WITH e AS (SELECT item_id, list_distinct({WORDS.format('text')}) AS e FROM benchmark), p AS (SELECT page_id, list_distinct({WORDS.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS p FROM pages),
      scored AS (SELECT item_id, page_id, round(len(list_intersect(e, p)) / (len(e) + len(p) - len(list_intersect(e, p))), 6) AS score FROM e, p WHERE len(list_intersect(e, p)) > 0) """ + winner("scored", "item_id", "page_id", 0.30, 0.10),
    "q23_entity_exact_alias": r"""WITH lex AS (SELECT 'nation' AS kind, n_name AS canonical FROM nation UNION ALL SELECT 'region', r_name FROM region),
      al AS (SELECT kind, canonical, unnest([canonical, substring(canonical, 1, 3)]) AS alias FROM lex), k AS (SELECT canonical, array_to_string(regexp_extract_all(lower(alias), '[\p{L}\p{N}_]+'), ' ') AS k, alias = canonical AS is_name FROM al),
      s AS (SELECT n_nationkey AS c_nationkey, unnest([n_name, substring(n_name, 1, 3)]) AS said FROM nation)
      SELECT c_nationkey, said, CASE WHEN bool_or(is_name) THEN 'exact' WHEN count(*) > 1 THEN 'ambiguous' ELSE 'alias' END AS method, min(canonical) AS canonical
      FROM s JOIN k ON array_to_string(regexp_extract_all(lower(said), '[\p{L}\p{N}_]+'), ' ') = k GROUP BY 1, 2""",
    "q25_levenshtein_lexicon": "SELECT a.n_name AS a, b.n_name AS b, levenshtein(a.n_name, b.n_name) AS distance FROM nation a JOIN nation b ON a.n_name < b.n_name WHERE levenshtein(a.n_name, b.n_name) <= 4",
    "q26_adjacent_pages": f"WITH {ADJACENT} SELECT conv_id, turn, step, shared FROM adjacent WHERE step IS NOT NULL",
    "q27_sheet_sequence": "WITH s AS (SELECT l_orderkey, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1 AS nxt FROM lineitem) SELECT l_orderkey, count(*) AS sheets, count_if(coalesce(nxt, false)) AS pairs FROM s GROUP BY 1",
    "q28_flow_score": f"WITH {ADJACENT}, c AS (SELECT conv_id, turn, round(0.4 + 0.3 * CAST(step = 1 AS INT) + 0.06 * least(shared, 5), 4) AS score FROM adjacent WHERE step IS NOT NULL) SELECT conv_id, turn, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 0.82 THEN 'accepted' WHEN score >= 0.60 THEN 'candidate' ELSE 'rejected' END AS status FROM c",
    "q29_chain_state": f"""WITH RECURSIVE t AS (SELECT conv_id, turn, list_distinct(list_filter({WORDS.format('text')}, lambda w: length(w) >= 4)) AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
      c AS (SELECT conv_id, turn, w, rn, turn AS chain_start, CAST(1 AS BIGINT) AS place FROM t WHERE rn = 1 UNION ALL
        SELECT t.conv_id, t.turn, t.w, t.rn, CASE WHEN t.turn = c.turn + 1 AND c.place < 6 AND len(list_intersect(t.w, c.w)) >= 2 THEN c.chain_start ELSE t.turn END, CASE WHEN t.turn = c.turn + 1 AND c.place < 6 AND len(list_intersect(t.w, c.w)) >= 2 THEN c.place + 1 ELSE 1 END
        FROM c JOIN t ON t.conv_id = c.conv_id AND t.rn = c.rn + 1)
      SELECT conv_id AS document_id, turn AS pdf_page, chain_start, place FROM c""",
    "q30_columns": f'WITH {ORDERED} SELECT document_id, pdf_page, CAST(dense_rank() OVER (PARTITION BY document_id, pdf_page ORDER BY col) - 1 AS BIGINT) AS "column", n_regions, first_region FROM (SELECT document_id, pdf_page, col, count(*) AS n_regions, min(region_ord) AS first_region FROM ordered GROUP BY ALL)',
    "q31_reading_order": f"WITH {ORDERED}, g AS (SELECT *, CASE WHEN lag(col) OVER w = col THEN y0 - lag(y1) OVER w END AS gap FROM ordered WINDOW w AS (PARTITION BY document_id, pdf_page ORDER BY place)) SELECT document_id, pdf_page, region_ord, place, CAST(gap AS DOUBLE) AS gap, CAST(CASE WHEN gap > 120 THEN 0.55 ELSE 0.85 END AS DOUBLE) AS confidence FROM g",
    "q32_running_offsets": f'WITH {ORDERED}, o AS (SELECT *, CAST(coalesce(sum(length(text) + 2) OVER (PARTITION BY document_id, pdf_page ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS st FROM ordered) SELECT document_id, pdf_page, region_ord, st AS "start", st + length(text) AS "end" FROM o',
    "q33_draft_bodies": f"WITH {ORDERED}, b AS (SELECT document_id, pdf_page, count(*) AS n_parts, string_agg(text, chr(10) || chr(10) ORDER BY place) AS body FROM ordered GROUP BY ALL) SELECT document_id, pdf_page, n_parts, length(body) AS n_chars, md5(body) AS body_md5 FROM b",
    "q34_completeness": rf"""WITH {KINDS}, v AS (SELECT document_id, kind, length(regexp_replace(text, '[ \t\r\n\f\x0B]', '', 'g')) AS v FROM kinds), s AS (SELECT document_id, CAST(sum(CASE WHEN kind = 'body' THEN v ELSE 0 END) AS BIGINT) AS assigned, CAST(sum(CASE WHEN kind = 'title' THEN v ELSE 0 END) AS BIGINT) AS unassigned FROM v GROUP BY 1),
      c AS (SELECT *, assigned / nullif(assigned + unassigned, 0) AS cov FROM s)
      SELECT document_id, assigned, unassigned, round(cov, 6) AS coverage, concat_ws(';', CASE WHEN cov < 0.90 THEN 'coverage' END, CASE WHEN unassigned > 150 THEN 'unassigned' END) AS reasons,
      CASE WHEN cov IS NULL THEN 'unknown' WHEN cov < 0.90 OR unassigned > 150 THEN 'incomplete' ELSE 'complete' END AS status FROM c""",
    "q35_interval_coverage": f"WITH {SPANS}, n AS (SELECT *, CASE WHEN s <= max(e) OVER w THEN 0 ELSE 1 END AS nw FROM spans WINDOW w AS (PARTITION BY l_orderkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), i AS (SELECT *, sum(nw) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM n), m AS (SELECT l_orderkey, isl, min(s) AS s, max(e) AS e FROM i GROUP BY 1, 2) SELECT l_orderkey, count(*) AS runs, CAST(sum(e - s) AS BIGINT) AS covered FROM m GROUP BY 1",
    "q36_interval_gaps": f"WITH {SPANS}, a AS (SELECT * FROM spans UNION ALL SELECT DISTINCT l_orderkey, 120, 120 FROM spans), g AS (SELECT l_orderkey, coalesce(max(e) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f, s FROM a) SELECT l_orderkey, count(*) AS n_gaps, CAST(sum(s - f) AS BIGINT) AS open FROM g WHERE f < s GROUP BY 1",
    "q37_corpus_rollup": "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n, count_if(o_orderstatus = 'F') AS n_success, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS price_success FROM orders GROUP BY ROLLUP (1, 2)",
    "q38_audit_rates": "WITH u AS (SELECT source, unnest(['quality', 'toxic']) AS verdict, unnest([quality, toxic]) AS value FROM labels JOIN documents USING (doc_id)) SELECT source, verdict, count(value) AS reviewed, round(avg(value), 6) AS rate FROM u GROUP BY 1, 2",
    "q39_unmatched_entries": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "q41_image_coverage": f"WITH {REGIONS}, c AS (SELECT document_id, pdf_page, unnest(range(CAST(greatest(0, least(31, floor(x0 / 600 * 32))) AS BIGINT), CAST(greatest(0, least(31, floor((x1 - 1e-6) / 600 * 32))) AS BIGINT) + 1)) AS gx, y0, y1 FROM regions), d AS (SELECT document_id, pdf_page, gx, unnest(range(CAST(greatest(0, least(31, floor(y0 / 1400 * 32))) AS BIGINT), CAST(greatest(0, least(31, floor((y1 - 1e-6) / 1400 * 32))) AS BIGINT) + 1)) AS gy FROM c) SELECT document_id, pdf_page, round(count(DISTINCT (gx, gy)) / 1024, 6) AS coverage FROM d GROUP BY 1, 2",
    "q42_page_type": f"WITH {LINES}, p AS (SELECT document_id, pdf_page, count_if(regexp_matches(lower(text), '\\bfoglio\\b') OR regexp_matches(lower(text), '\\btiratura\\b')) AS clip, count_if({flag('share')} OR {flag('navigation')} OR {flag('cookie')}) AS web, sum(length(text)) AS chars, bool_or({URL}) AS url FROM lines GROUP BY ALL) SELECT document_id, pdf_page, CASE WHEN clip >= 2 THEN 'press_clipping' WHEN web >= 2 OR url THEN 'web' WHEN chars >= 500 AND web = 0 THEN 'pure_text' ELSE 'unknown' END AS page_type FROM p",
    "q43_date_extract": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS found, CASE WHEN o_orderkey % 2 = 0 THEN 2 END AS sheet, CASE WHEN o_orderkey % 2 = 0 THEN 7 END AS sheets, CASE WHEN o_orderkey % 2 <> 0 THEN 12 END AS original_page FROM orders",
    "q44_source_continuity": f"WITH {SPANS}, j AS (SELECT l_orderkey, s - lag(e) OVER (PARTITION BY l_orderkey ORDER BY s, e) AS jump FROM spans) SELECT l_orderkey, count(*) AS n_continuations FROM j WHERE jump BETWEEN 0 AND 3 GROUP BY 1",
    "q45_claimants": f"WITH p AS (SELECT {HOST} AS host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{{2}})/', 1) AS lang FROM pages) SELECT host, count(*) AS n, count(DISTINCT lang) AS owners, CASE WHEN count(DISTINCT lang) = 1 THEN max(lang) ELSE 'ambiguous' END AS owner FROM p GROUP BY 1",
    "q47_untitled_groups": "WITH b AS (SELECT conv_id, turn, text, coalesce(turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) > 1, true) OR length(text) < 200 AS brk FROM conversations), i AS (SELECT *, CAST(sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM b) SELECT conv_id, island, min(turn) AS first_turn, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM i GROUP BY 1, 2",
    "q48_style_mode": "WITH m AS (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn FROM part GROUP BY 1, 2) SELECT p_brand, round(median(p_retailprice), 4) AS median_price, max(p_size) AS max_size, round(sum(CASE WHEN contains(part.p_type, 'STEEL') THEN p_size ELSE 0 END) / sum(p_size), 6) AS steel_share, any_value(m.p_type) AS modal_type FROM part JOIN (SELECT p_brand, p_type AS p_type FROM m WHERE rn = 1) m USING (p_brand) GROUP BY 1",
}
