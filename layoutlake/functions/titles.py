"""Titles: similarity variants, register codes, place names, sentence boundaries.

Token parts are native expressions; only the character ratio runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layoutlake.functions import text
from layoutlake.functions.similarity import fold, ratio

# Patterns of register codes that a scan has run into words, in the order of removal.
FUSED_CODES = (
    (r"\b\d{1,4}(?=[A-Z][a-zà-ù])", ""),
    (r"\b[A-Z]{1,4}\d{2,6}(?=[A-Z])", ""),
    (r"(?<=[a-zà-ù])[A-Z]{1,4}\d{3,6}\b", " "),
    (r"(?<=[A-Za-zà-ù])\d{3,}(?=[A-Za-zà-ù])", " "),
    (r"(?<=,)\d{2,4}(?=\s)", ""),
)
# A repeated word, a code that stands alone, a site's name behind a title.
REPEATED = r"(?i)(?<![\p{L}\p{N}_-])([\p{L}\p{N}_]+)\s+\1(?![\p{L}\p{N}_-])"
STANDING_CODE = r"(?<![\p{L}\p{N}_-])(?:[A-Z]{1,4}\d{3,}|\d{4,})(?![\p{L}\p{N}_-])"
SITE_SUFFIX = r"\s+[-–|]\s+[\p{L}\p{N}.]+\.[a-z]{2,4}$"
# Letters that scans take for each other.
CONFUSIONS = (("m", "rn"), ("rn", "m"), ("ii", "n"), ("n", "ii"))
LEAST_PLACE = 4


def _jaccard(a: Column, b: Column) -> Column:
    return text.token_jaccard(F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " ")))


def index_similarity(left: Column, right: Column) -> Column:
    """.65 ratio and .35 shared tokens, or the ratio of both without spaces if each has ten characters."""
    a, b = (F.array_join(text.words(fold(c)), " ") for c in (left, right))
    sa, sb = (F.regexp_replace(fold(c), "[^a-z0-9]", "") for c in (left, right))
    mixed = 0.65 * ratio(a, b) + 0.35 * _jaccard(a, b)
    squeezed = F.when((F.length(sa) >= 10) & (F.length(sb) >= 10), ratio(sa, sb)).otherwise(0.0)
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.greatest(mixed, squeezed))


def web_tokens(c: Column, least: int = 3) -> Column:
    bare = F.regexp_replace(F.lower(c), r"\bdata\s+stampa\s*\d+(?:\s*[-–]\s*data\s+stampa\s*\d+)?", " ")
    return F.filter(F.regexp_extract_all(bare, F.lit("[a-zà-ÿ0-9]+"), F.lit(0)), lambda w: F.length(w) >= least)


def web_similarity(expected: Column, found: Column) -> Column:
    """Overlap coefficient .65 and ratio .35, or the ratio alone; 0 below three tokens."""
    a, b = web_tokens(expected), web_tokens(found)
    r = ratio(F.array_join(a, " "), F.array_join(b, " "))
    score = F.greatest(0.65 * text.overlap_coefficient(a, b) + 0.35 * r, r)
    return F.when((F.size(a) < 3) | (F.size(b) < 3), 0.0).otherwise(F.round(score, 4))


def slug_similarity(slug: Column, title: Column) -> Column:
    """Recall of the slug's tokens .65 and ratio .35; 0 below four tokens."""
    a, b = web_tokens(slug, 1), web_tokens(title, 1)
    recall = F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.lit(1))
    return F.when((F.size(a) < 4) | (F.size(b) < 4), 0.0).otherwise(0.65 * recall + 0.35 * ratio(F.array_join(a, " "), F.array_join(b, " ")))


def same_headline(left: Column, right: Column) -> Column:
    """Equal but for case, spaces and a site's name at the end, or a ratio of .90."""
    a, b = (F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")), SITE_SUFFIX, "")) for c in (left, right))
    return (a != "") & (b != "") & ((a == b) | (ratio(a, b) >= 0.90))


def unwrap_codes(c: Column) -> Column:
    for pattern, put in FUSED_CODES:
        c = F.regexp_replace(c, pattern, put)
    return c


def clean_title(c: Column) -> tuple[Column, Column]:
    """The title without repeats and register codes, and the names of what was done."""
    title = F.trim(F.coalesce(c, F.lit("")))
    once = F.regexp_replace(title, REPEATED, "$1")
    unfused = unwrap_codes(once)
    bare = F.regexp_replace(unfused, STANDING_CODE, " ")
    done = F.array_compact(F.array(F.when(once != title, "dedupe_repeated_token"), F.when(unfused != once, "unwrap_fused_registration_code"), F.when(F.trim(bare) != F.trim(unfused), "strip_registration_code")))
    clean = F.trim(F.regexp_replace(bare, r"\s+", " "))
    return F.when(clean == "", title).otherwise(clean), done


def ocr_variants(word: Column) -> Column:
    """A word and what common scanning confusions make of it."""
    return F.array_distinct(F.array(word, *(F.replace(word, F.lit(a), F.lit(b)) for a, b in CONFUSIONS)))


def corrected_places(tokens: DataFrame, places: DataFrame, attested: DataFrame) -> DataFrame:
    """(document_id, token, place): unattested tokens that are an attested place but for a confusion or one edit.

    ``tokens`` has (document_id, token) and ``attested`` (document_id, word), both
    folded; ``places`` has (place).  Places meet tokens through what the document
    attests, so no token is compared with the whole lexicon.
    """
    here = attested.join(places, attested.word == places.place).select("document_id", "place").distinct()
    odd = tokens.filter(F.length("token") >= LEAST_PLACE).join(attested.withColumnRenamed("word", "token"), ["document_id", "token"], "left_anti")
    near = F.array_contains(ocr_variants(F.col("token")), F.col("place")) | (F.levenshtein("token", "place") == 1)
    pairs = odd.join(here, "document_id").filter((F.length("place") >= LEAST_PLACE) & near)
    return pairs.groupBy("document_id", "token").agg(F.min("place").alias("place"))


def open_boundary(left: Column, right: Column, endings: tuple[str, ...], least_words: int = 3) -> Column:
    """Whether ``right`` goes on with a sentence that ``left`` leaves open."""
    a, b = text.words(F.lower(left)), text.words(F.lower(right))
    first = F.regexp_extract(right, r"(\p{L})", 1)
    url = F.contains(F.lower(F.concat(left, F.lit(" "), right)), F.lit("http://")) | F.contains(F.lower(F.concat(left, F.lit(" "), right)), F.lit("https://"))
    return (F.least(F.size(a), F.size(b)) >= least_words) & ~F.trim(left).rlike(r"[.!?…:;]$") & F.try_element_at(a, F.lit(-1)).isin(*endings) & first.rlike(r"^\p{Ll}$") & ~url


def name_signature(c: Column) -> Column:
    """A header name's letters and digits, folded."""
    return F.regexp_replace(fold(c), "[^a-z0-9]", "")
