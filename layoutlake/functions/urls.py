"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a sentence rather than an address.
TRAILING = ".,;)]}\"'"
# Hosts and parts of addresses that are never an article's.
JUNK_HOSTS = ("youtube.com", "youtu.be", "facebook.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "google.", "gstatic.", "doubleclick.", "cedsdigital.", "adnkr.", "cloudflare.", "jsdelivr.", "w3.org")
JUNK_HINTS = ("/img/", "placeholder", ".css", ".js", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico", ".woff", "javascript:", "mailto:", "tel:")
PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, PARTS, k)


def normalize(raw: Column) -> Column:
    """An article's address, null for junk, credentials and other schemes."""
    url = F.rtrim(F.trim(raw), F.lit(TRAILING))
    url = F.when(F.lower(url).startswith("www."), F.concat(F.lit("https://"), url)).otherwise(url)
    lower = F.lower(url)
    junk = F.lit(False)
    for j in (*JUNK_HOSTS, *JUNK_HINTS):
        junk = junk | F.contains(lower, F.lit(j))
    authority = part(url, 2)
    good = F.lower(part(url, 1)).isin("http", "https") & (authority != "") & ~F.contains(authority, F.lit("@")) & ~junk
    return F.when(good, url)


def has_path(url: Column) -> Column:
    return ~part(url, 3).isin("", "/")


def article_key(url: Column) -> Column:
    """Lower-cased scheme and host, path without a closing slash, query kept."""
    return F.concat(F.lower(part(url, 1)), F.lit("://"), F.lower(part(url, 2)), F.regexp_replace(part(url, 3), "/+$", ""), part(url, 4))


def canonical_key(url: Column) -> Column:
    """Host without www and path; scheme and query dropped."""
    return F.concat(host_name(url), F.regexp_replace(part(url, 3), "/+$", ""))


def host_name(url: Column) -> Column:
    return F.regexp_replace(F.lower(part(url, 2)), r"^www\.|:\d+$", "")


def slug(url: Column) -> Column:
    """Words of the last path segment."""
    last = F.regexp_extract(F.regexp_replace(part(url, 3), "/+$", ""), r"([^/]*)$", 1)
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(last, r"\.[A-Za-z]{2,5}$", ""), "-_", "  "), " +", " "))


# Endings of names that aren't public, ports of the web, the longest address.
PRIVATE = r"\.(?:local|localhost|internal|invalid|test|example)$"
PORTS = ("", "80", "443")
LONGEST = 2048


def safe_key(url: Column) -> Column:
    """An address that may be fetched, without fragment and port; null for credentials, number hosts and private names."""
    host = F.lower(F.regexp_replace(part(url, 2), r":\d+$", ""))
    port = F.regexp_extract(part(url, 2), r":(\d+)$", 1)
    good = (F.length(url) <= LONGEST) & F.lower(part(url, 1)).isin("http", "https") & ~F.contains(part(url, 2), F.lit("@")) & port.isin(*PORTS) & F.contains(host, F.lit(".")) & ~host.rlike(r"^[0-9.]+$") & ~host.rlike(PRIVATE)
    path = F.when(part(url, 3) == "", "/").otherwise(part(url, 3))
    return F.when(good, F.concat(F.lower(part(url, 1)), F.lit("://"), host, path, part(url, 4)))
