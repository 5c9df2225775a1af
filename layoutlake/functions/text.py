"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their base letters.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿçñ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyycn"
WORD = r"[\p{L}\p{N}_]+"
# The rights phrase in a text, and a register code.
RIGHTS_PHRASE = r"(?i)[\s(@©•_]*riproduzione[\s_]*riservata[\s).]*"
CODE_TOKEN = r"\b[A-Z]{1,4}\.?[A-Z]?\.?\d{3,8}\b"


def strip_accents(c: Column) -> Column:
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def entity_key(c: Column) -> Column:
    """Lower case without accents, words joined by single spaces."""
    return F.array_join(words(strip_accents(c)), " ")


def squeezed(c: Column) -> Column:
    return F.regexp_replace(strip_accents(c), "[^a-z0-9]", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def uppercase_ratio(c: Column) -> Column:
    letters, upper = F.regexp_count(c, F.lit(r"\p{L}")), F.regexp_count(c, F.lit(r"\p{Lu}"))
    return F.coalesce(F.try_divide(upper, letters), F.lit(0.0))


def visible_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[ \t\r\n\f\x0B]", ""))


def can_reach(left: Column, right: Column, threshold: float) -> Column:
    """Whether lengths allow a ratio of ``threshold``; false if either is empty."""
    a, b = F.length(left), F.length(right)
    return (a > 0) & (b > 0) & (2 * F.least(a, b) / (a + b) >= threshold)


def match_coverage(whole: Column, part: Column) -> Column:
    a, b = F.length(F.regexp_replace(entity_key(whole), " ", "")), F.length(F.regexp_replace(entity_key(part), " ", ""))
    return F.when(a > 0, F.least(b / a, F.lit(1.0))).otherwise(0.0)


def token_jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def overlap_coefficient(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def content_tokens(c: Column, least: int) -> Column:
    return F.array_distinct(F.filter(words(F.lower(c)), lambda w: F.length(w) >= least))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often lambdas in ``use`` read it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(c: Column, size: int) -> Column:
    """Distinct word shingles of ``size``; none for shorter texts."""

    def of(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.when(F.size(w) >= size, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    return bound(words(F.lower(c)), of)


def shingle_hashes(c: Column, size: int) -> Column:
    """Distinct hashes of the word shingles of ``size``, each of its words' hashes; none for shorter texts."""

    def of(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
        return F.when(F.size(w) >= size, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(words(F.lower(c)), lambda w: F.xxhash64(w)), of)


def scrub_rights(c: Column) -> Column:
    cleaned = F.regexp_replace(c, RIGHTS_PHRASE, " ")
    tidy = F.regexp_replace(F.regexp_replace(cleaned, r"[ \t]{2,}", " "), r" *\n *", "\n")
    return F.when(cleaned != c, F.trim(tidy)).otherwise(c)


def scrub_codes(c: Column, codes: Column) -> Column:
    """Remove attested codes, longest first, standing alone or fused behind a lower-case letter."""
    by_length = F.array_sort(codes, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    quoted = lambda code: F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), code, F.lit(r"\E(?![\p{L}\p{N}_])|(?<=[a-zà-ù])\Q"), code, F.lit(r"\E(?=\s|$)"))
    return F.trim(F.regexp_replace(F.aggregate(by_length, c, lambda acc, code: F.regexp_replace(acc, quoted(code), F.lit(" "))), r"[ \t]{2,}", " "))


def stamp_code(c: Column) -> Column:
    """Only register codes, repeats allowed."""
    tokens = F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != "")
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: t.rlike(r"^[A-Z]{1,4}\.?[A-Z]?\.?\d{3,8}$"))


def rights_notice(c: Column) -> tuple[Column, Column]:
    """Status (accepted, ambiguous, none) and marker of a rights notice."""
    low = F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))

    def of(line: Column) -> Column:
        marker, part = F.lit(None).cast("string"), F.lit(False)
        for m, p in reversed(NOTICES):
            marker = F.when(line.rlike(f"^(?:{p})$"), m).otherwise(marker)
            part = line.rlike(p) | part
        return bound(marker, lambda m: F.struct(F.when(m.isNotNull(), "accepted").when(part, "ambiguous").otherwise("none").alias("status"), m.alias("marker")))

    found = bound(F.regexp_replace(low, r"^[ .;:!\-–—…]+|[ .;:!\-–—…]+$", ""), of)
    return found["status"], found["marker"]


# Rights notices by name.
NOTICES = (
    ("riproduzione_riservata", r"(?:© ?)?riproduzione riservata"),
    ("riproduzione_vietata", r"(?:© ?)?riproduzione vietata"),
    ("tutti_i_diritti_riservati", r"tutti i diritti riservati"),
    ("all_rights_reserved", r"all rights reserved"),
    ("articolo_non_cedibile", r"articolo non cedibile(?: (?:a terzi|al cliente che lo riceve))?"),
    ("uso_esclusivo", r"uso esclusivo(?: (?:del cliente|del cliente che lo riceve))?"),
)
# Keywords of the region flags.
KEYWORDS = {
    "ad": ("pubblicità", "pubblicita", "advertisement", "sponsored", "sponsorizzato", "annuncio", "banner", "google ads", "adsbygoogle", "promoted"),
    "share": ("condividi", "twitta"),
    "related": ("articoli correlati", "ultimi articoli", "leggi anche"),
    "navigation": ("menu", "chi siamo", "contatti"),
    "rights": ("©", "copyright", "riproduzione riservata", "riproduzione vietata", "tutti i diritti riservati", "all rights reserved", "articolo non cedibile", "uso esclusivo"),
    "watermark": ("data stampa", "articolo non cedibile", "uso esclusivo", "cliente che lo riceve"),
    "cookie": ("cookie", "privacy policy"),
    "newsletter": ("newsletter",),
}


def flags(c: Column, lower: Column | None = None) -> dict[str, Column]:
    """The keyword and pattern flags of a region's text; ``lower`` is that in lower case if a column has it already."""
    lower = F.lower(c) if lower is None else lower
    line = F.trim(lower)
    out = {}
    for name, keys in KEYWORDS.items():
        hit = F.lit(False)
        for k in keys:
            hit = hit | F.contains(lower, F.lit(k))
        out[f"has_{name}"] = hit
    out["has_ad"] = out["has_ad"] | line.isin("adv", "ads", "ad")
    out["has_navigation"] = out["has_navigation"] | (line == "home")
    out["has_url"] = F.contains(lower, F.lit("http://")) | F.contains(lower, F.lit("https://"))
    out["has_date"] = c.rlike(r"\b\d{1,2}[-/][a-zA-Z]{3}[-/]\d{4}\b") | c.rlike(r"\b\d{1,2}/\d{1,2}/\d{2,4}\b")
    out["has_author"] = lower.rlike(r"^\s*(?:di\s+|da\s+|a\s+cura\s+di\s+)")
    for name in ("foglio", "superficie", "tiratura", "diffusione", "lettori", "quotidiano"):
        out[f"has_{name}"] = lower.rlike(rf"\b{name}\b")
    out["section_label"] = line.isin("stampa locale", "stampa nazionale", "web", "radio", "tv", "televisione")
    out["index_entry"] = (F.length(line) <= 180) & (F.contains(line, F.lit("pag.")) | line.rlike(r"\bpagina\s+\d+\b") | line.rlike(r"\.{3,}\s*\d+$"))
    return out


def boilerplate_family(c: Column, longest: int = 180, least: int = 8, most_words: int = 12) -> tuple[Column, Column]:
    """Family and masked pattern of a repeated line; nulls if it has neither."""
    found = boilerplate(c, longest, least, most_words)
    return found["family"], found["pattern"]


def boilerplate(c: Column, longest: int = 180, least: int = 8, most_words: int = 12) -> Column:
    """``boilerplate_family`` as one struct, for which the line is collapsed once."""

    def of(line: Column) -> Column:
        fits = (line != "") & (F.length(line) <= longest)
        rights = line.rlike(r"^articolo +non +cedibile\b") | line.rlike(r"^uso +esclusivo\b")
        generic = (F.length(line) >= least) & (F.size(F.split(line, " ")) <= most_words)
        family = F.when(~fits, None).when(line.rlike(r"^data +stampa\b"), "data_stampa").when(line.isin("web", "stampa locale", "stampa nazionale"), "section_label").when(rights, "rights_candidate").when(generic, "generic_exact")
        return F.struct(family.alias("family"), line.alias("line"))

    def masked(x: Column) -> Column:
        pattern = F.when(x["family"] == "data_stampa", "data stampa <variabile>").when(x["family"] == "rights_candidate", F.regexp_replace(x["line"], r"\b\d+(?:[./:-]\d+)*\b", "<num>")).when(x["family"].isNotNull(), x["line"])
        return F.struct(x["family"].alias("family"), pattern.alias("pattern"))

    return bound(bound(collapse(F.lower(c)), of), masked)
