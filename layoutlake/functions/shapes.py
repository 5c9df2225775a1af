"""Shapes of a text: chrome, markers, names, keys, cleaned characters and punctuation.

Every function is a Column expression.  Patterns name letters and digits by their
Unicode classes, so that any engine with the same classes finds the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layoutlake.functions import text
from layoutlake.functions.similarity import compose

# Borders of a word, and days and months in Italian.
BEFORE, AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
DAYS = "lunedì|martedì|mercoledì|giovedì|venerdì|sabato|domenica"
MONTHS = "gennaio|febbraio|marzo|aprile|maggio|giugno|luglio|agosto|settembre|ottobre|novembre|dicembre"
SHORT_MONTHS = "gen|feb|mar|apr|mag|giu|lug|ago|set|ott|nov|dic"
# What only a web page's frame says, in lower case.
CHROME = (
    r"visitatori\s+unici",
    rf"{BEFORE}(?:{DAYS}){AFTER}.*\d{{4}}",
    rf"^\s*\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}",
    rf"^\s*(?:{SHORT_MONTHS})\.?\s*\d{{1,2}},?\s*\d{{4}}",
    r"^\s*author\s*:",
    rf"{BEFORE}min\.?\s*read{AFTER}|{BEFORE}less\s+than\s+\d+\s*min",
)
# Markers of adverts and related articles, and what looks like a link.
ADVERT = rf"{BEFORE}(?:pubblicità|pubblicita|sponsorizzato|sponsored|adv|advertisement){AFTER}"
RELATED = rf"^(?:leggi anche|articoli correlati|notizie correlate|approfondimenti|potrebbe interessarti|consigliati per te){AFTER}"
LINK = rf"https?://|www\.|(?:^|\n)\s*(?:leggi|scopri|vai all'articolo){AFTER}|[→›]\s*$"
# Particles of names.
PARTICLES = ("de", "del", "della", "di", "da", "van", "von")
BYLINE = r"(?i)^\s*(?:(?:di|da)\s+|a\s+cura\s+di\s+)(.+?)\s*$"
SIGNATURE = r"^(?:[A-ZÀ-Ý]\.\s*){2,4}$"
# Words of a site's menu, and the link to an article.
NAVIGATION = ("home", "cronaca", "politica", "economia", "sport", "cultura", "spettacoli", "attualità", "italia", "mondo", "ambiente", "salerno", "napoli", "campania", "provincia")
ARTICLE_LINK = rf"^\s*(?:vai\s+all['’]articolo|leggi\s+l['’]articolo){AFTER}"
# Damaged encodings and typographic quotes, with what they stand for.
MOJIBAKE = (("â€™", "'"), ("â€œ", '"'), ("â€\x9d", '"'), ("Ã¨", "è"), ("Ã©", "é"), ("Ã ", "à"))
QUOTES, PLAIN_QUOTES = "“”„‟‘’", "\"\"\"\"''"
# Spans whose punctuation stays: addresses, decimals, acronyms.
PROTECTED = r"https?://\S+|www\.\S+|[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}|\d+[.,]\d+|(?:[A-Z]\.){2,}"
#: One private character stands for a protected span.
HELD = "\ue000"
#: A paywall's words in Italian and English, in the first BLOCKED_CHARS characters of a page.
BLOCKED = (
    r"(?:abbonati|sottoscrivi|effettua l.accesso|accedi)\s+(?:per|e)\s+(?:continuare|leggere|visualizzare)"
    r"|contenuto\s+(?:riservato|esclusivo)\s+(?:agli\s+)?abbonati|subscribe\s+to\s+(?:continue|read)|sign in to continue reading"
)
BLOCKED_CHARS = 8000


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def chrome(c: Column) -> Column:
    """Text of a page's frame: none, icons, one word, dates, bylines of a site."""
    value = F.trim(F.coalesce(c, F.lit("")))
    glyphs = _count(value, "[\ue000-\uf8ff]")
    hit = F.lit(False)
    for pattern in CHROME:
        hit = hit | F.lower(value).rlike(pattern)
    return (value == "") | (glyphs > 0) & (glyphs >= _count(value, "[A-Za-zà-ù0-9]")) | (_count(value, "[A-Za-zà-ù]{2,}") < 2) | hit


def marker_kind(c: Column) -> Column:
    """advertisement, related or null."""
    low = F.trim(F.lower(c))
    return F.when(low.rlike(ADVERT), "advertisement").when(low.rlike(RELATED), "related")


def link_like(c: Column) -> Column:
    return F.lower(c).rlike(LINK)


def byline(c: Column) -> tuple[Column, Column]:
    """The name that a line gives, and whether a preposition announces it."""
    name = F.regexp_extract(c, BYLINE, 1)
    return F.when(name != "", F.trim(name)).otherwise(F.trim(c)), name != ""


def name_like(c: Column, least: int = 2, most: int = 5) -> Column:
    """Two to five alphabetic words, at least two of them no particles and all of those capitalised."""
    tokens = F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != "")
    significant = F.filter(tokens, lambda t: ~F.lower(t).isin(*PARTICLES))
    alphabetic = F.forall(tokens, lambda t: t.rlike(r"^\p{L}+(?:['’\-]\p{L}+)*$"))
    return F.size(tokens).between(least, most) & alphabetic & (F.size(significant) >= 2) & F.forall(significant, lambda t: t.rlike(r"^\p{Lu}"))


def abbreviated_signature(c: Column) -> Column:
    return F.trim(c).rlike(SIGNATURE)


def navigation_words(c: Column) -> tuple[Column, Column]:
    """Words of a text, and how many of them are words of a menu."""
    words = F.regexp_extract_all(F.lower(text.collapse(c)), F.lit(r"\p{L}+"), F.lit(0))
    return F.size(words), F.size(F.filter(words, lambda w: w.isin(*NAVIGATION)))


def key_with_marks(c: Column) -> Column:
    """Lower case without accents, white space collapsed, punctuation kept."""
    return F.trim(F.regexp_replace(text.strip_accents(c), r"\s+", " "))


def font_name(c: Column) -> Column:
    """A font without its subset prefix, lower case."""
    return F.lower(F.regexp_replace(F.trim(c), r"^[A-Z]{6}\+", ""))


def font_trait(names: Column, words: tuple[str, ...]) -> Column:
    """Share of font names that have one of ``words``; null without names."""
    hits = F.size(F.filter(names, lambda n: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(n), w))))
    return F.when(F.size(names) > 0, hits / F.size(names))


def lexical_similarity(candidate: Column, before: Column, after: Column) -> Column:
    """Shared words of four letters or more with either neighbour, over all of them."""
    own = text.content_tokens(candidate, 4)
    around = F.array_union(text.content_tokens(before, 4), text.content_tokens(after, 4))
    both = F.size(F.array_union(own, around))
    return F.when((F.size(own) > 0) & (F.size(around) > 0), F.size(F.array_intersect(own, around)) / both).otherwise(0.0)


def clean_characters(c: Column) -> tuple[Column, Column]:
    """Composed characters, ligatures, spaces, hidden marks, damaged encodings and quotes put right; whether damage is left."""
    out = F.replace(c, F.lit("\u202f"), F.lit(" "))
    out = F.regexp_replace(out, "(?<=\\p{L})[\u00ad\u200b](?=\\p{L})", "")
    out = compose(out)
    for bad, good in MOJIBAKE:
        out = F.replace(out, F.lit(bad), F.lit(good))
    out = F.translate(out, QUOTES, PLAIN_QUOTES)
    return out, F.contains(out, F.lit("\ufffd")) | out.rlike("Ã.|â€")


def clean_punctuation(c: Column) -> Column:
    """Spaces around punctuation put right, but not inside addresses, decimals and acronyms."""
    plain = F.replace(c, F.lit(HELD), F.lit(" "))
    held = F.regexp_extract_all(plain, F.lit(PROTECTED), F.lit(0))
    out = F.regexp_replace(plain, PROTECTED, HELD)
    for pattern, put in (
        (r"[ \t]{2,}", " "),
        (r"\s+([,.;:!?])", "$1"),
        (r"""([,;:!?])([^\s\d,;:!?"'»)\]])""", "$1 $2"),
        (r"([a-zà-ÿ])\.([A-ZÀ-Ý])", "$1. $2"),
        (r"\(\s+", "("),
        (r"\s+\)", ")"),
    ):
        out = F.regexp_replace(out, pattern, put)
    pieces = F.split(out, HELD)
    # zipped, not looked up: an array that a lambda reads is found anew for each piece
    return F.trim(F.array_join(F.zip_with(pieces, held, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), ""))


def joined(left: Column, right: Column, attested: Column, accepted: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Two parts of a text as one, and what became of a hyphen between them.

    It goes if it is a soft one or the joined word is attested or accepted; otherwise
    only the break goes.
    """
    end, start = r"(\p{L}{2,})([-\u2010\u00ad])$", r"^(\p{L}+)"
    a, b = F.rtrim(left), F.ltrim(right)
    stem, hyphen, suffix = F.regexp_extract(a, end, 1), F.regexp_extract(a, end, 2), F.regexp_extract(b, start, 1)
    word = F.lower(F.concat(stem, suffix))
    open_ = (stem != "") & suffix.rlike(r"^\p{Ll}")
    known = (hyphen == "\u00ad") | F.array_contains(attested, word) | word.isin(*[w.lower() for w in accepted])
    action = F.when(open_ & known, "dehyphenated").when(open_, "hyphen_preserved").otherwise("spaced")
    bare = F.substring(a, F.lit(1), F.length(a) - 1)
    return F.when(action == "dehyphenated", F.concat(bare, b)).when(action == "hyphen_preserved", F.concat(bare, F.lit("-"), b)).otherwise(F.concat_ws(" ", a, b)), action


def blocked_page(c: Column) -> Column:
    """Whether a page's visible text asks for a subscription before anything else."""
    return F.lower(F.substring(c, 1, BLOCKED_CHARS)).rlike(BLOCKED)
