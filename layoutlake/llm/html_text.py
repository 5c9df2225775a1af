"""Main text of HTML pages from flat text blocks.

A page is cut into flat blocks at block-level tags.  Each block has a word count
and a link density; with those of the blocks before and after it, and a hint
from the containers around it, a small decision tree calls it text or not.  An
article or main element inside a form or wrapper is an article all the same; in
doubtful containers words and links decide.  The
tree is trained here (``grow``) on ``LABELLED``, a small table of labelled blocks.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by one line break.  Null or empty
html gives an empty text.  Unclosed tags, stray ends, attributes with ``>`` and
unclosed comments are read as browsers do, so no page raises an error.  Pages of any
length are read whole.  Each row is handled by itself: ties, repeated rows, null ids and
further columns don't matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import map_batches, table

# Fixed values of HTML.
BLOCK_TAGS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul video audio".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg math select option button object canvas noembed noframes".split())
# Containers whose text is not the article's, nor are articles in them its text.
OUTSIDE_TAGS = frozenset("nav footer aside menu dialog head".split())
OUTSIDE_ROLES = frozenset("navigation contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
OUTSIDE_NAMES = re.compile(r"ads?|adverts?|advertisement|advertising|comments?|comment-?list|disqus|(?:site-|page-)?(?:footer|nav|navigation|menu)|navbar|promo|promoted|recommended|related|reply|replies|respond|sidebar|side-?bar|sponsor|sponsored|teasers?|widget", re.I)
# Containers whose text is not the article's, but that may hold the article.
LOOSE_TAGS = frozenset(["header"])
LOOSE_ROLES = frozenset(["banner"])
LOOSE_NAMES = re.compile(r"banner|breadcrumbs?|byline-share|consent|(?:cookies?|gdpr)(?:-(?:banner|bar|consent|notice))?|copyright|disclaimer|(?:site-|page-)?header|masthead|modal|newsletter|notices?|pagination|paywall|pop-?up|share|sharing|skip-link|social|subscribe|subscription|tags|toolbar", re.I)
# Containers in which words and links decide; names that have one of the above as a part do so too.
DOUBTFUL_TAGS = frozenset("form fieldset".split())
DOUBTFUL_ROLES = frozenset(["form"])
PART = re.compile(rf"(?:^|[-_])(?:{OUTSIDE_NAMES.pattern}|{LOOSE_NAMES.pattern})(?:$|[-_])", re.I)
# Names that say what a page has or lacks, and headers of something.
NO_CONTAINER = re.compile(r"(?:has|with|without|no|not|hide|show|is)[-_].*|.*[-_](?:header|masthead)", re.I)
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_ROLES = frozenset("main article".split())
ARTICLE_NAMES = re.compile(r"article-?body|article|content|entry-?content|main|main-?content|post|post-?body|post-?content|story|story-?body", re.I)

#: What holds inside an element.
HIDDEN, LOOSE, OUTSIDE, DOUBTFUL, NONE, ARTICLE = -2, -1.5, -1, -0.5, 0, 1
#: What only an element itself says.
INNER_ARTICLE, INNER_MAIN = 2, 3

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>?", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WHITE = re.compile(r"[\s ]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Flat:
    """A flat block.  ``hint``: -1 in a container that is no article, 1 in one that is, -0.5 in a doubtful one, else 0."""

    text: str
    words: int
    link_density: float
    hint: float


def _named(names: str) -> float:
    """What a class or id says, each of its names as a whole."""
    said = set()
    for name in names.split():
        if OUTSIDE_NAMES.fullmatch(name):
            said.add(OUTSIDE)
        elif LOOSE_NAMES.fullmatch(name):
            said.add(LOOSE)
        elif ARTICLE_NAMES.fullmatch(name):
            said.add(ARTICLE)
        elif PART.search(name) and not NO_CONTAINER.fullmatch(name):
            said.add(DOUBTFUL)
    if ARTICLE in said:
        return DOUBTFUL if said & {OUTSIDE, LOOSE} else ARTICLE
    return next((s for s in (OUTSIDE, LOOSE, DOUBTFUL) if s in said), NONE)


def _hint(name: str, attributes: str) -> float:
    """What a container's tag and attributes say."""
    hint = OUTSIDE if name in OUTSIDE_TAGS else LOOSE if name in LOOSE_TAGS else DOUBTFUL if name in DOUBTFUL_TAGS else INNER_MAIN if name == "main" else INNER_ARTICLE if name == "article" else NONE
    if attributes:
        for found in ATTRIBUTE.finditer(attributes):
            key = found[1].lower()
            value = found[2] or found[3] or found[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDDEN_STYLE.search(value):
                return HIDDEN
            if key == "role":
                role = value.lower()
                said = OUTSIDE if role in OUTSIDE_ROLES else LOOSE if role in LOOSE_ROLES else DOUBTFUL if role in DOUBTFUL_ROLES else INNER_MAIN if role == "main" else INNER_ARTICLE if role == "article" else NONE
                hint = said if said < NONE else hint or said
            elif key in ("class", "id") and name not in ("body", "html", "article", "main"):
                said = _named(value)
                if said in (OUTSIDE, LOOSE) or hint in (NONE, ARTICLE) and said:
                    hint = said
    return hint


def _inside(own: float, hint: float, header: bool) -> float:
    """What holds inside an element that says ``own`` and stands where ``hint`` holds."""
    if HIDDEN in (own, hint):
        return HIDDEN
    if own == INNER_MAIN or own == INNER_ARTICLE and hint != OUTSIDE:
        return ARTICLE  # a form or wrapper around the article has no say in it
    if own in (NONE, INNER_ARTICLE) or header and hint == ARTICLE:
        return hint  # an article's own headline is its text
    if hint in (OUTSIDE, LOOSE):
        return OUTSIDE if own == OUTSIDE else hint
    if hint == DOUBTFUL and own == ARTICLE:
        return hint
    return own


def blocks(page: str) -> list[Flat]:
    """The flat text blocks of a page in page order."""
    out: list[Flat] = []
    text: list[str] = []
    linked: list[str] = []
    links = 0
    #: Open elements: name, the hint that holds inside, whether it is a link.
    open_: list[tuple[str, float, bool]] = []
    hint: float = NONE

    def close() -> None:
        nonlocal text, linked
        if text:
            joined = WHITE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                words = joined.count(" ") + 1
                inside = WHITE.sub(" ", html.unescape(" ".join(linked))).strip()
                out.append(Flat(joined, words, (inside.count(" ") + 1) / words if inside else 0.0, OUTSIDE if hint == LOOSE else hint))
            text, linked = [], []

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if links:
                linked.append(piece)
        if start == end:
            break
        found = TOKEN.match(page, start)
        if not found:
            text.append("<")
            at = start + 1
            continue
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        ends, attributes = bool(found[1] or found[4]), found[3] or ""
        if name in BLOCK_TAGS:
            close()
        if ends:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close() if any(o[0] in BLOCK_TAGS for o in open_[k:]) else None
                    links -= sum(o[2] for o in open_[k:])
                    del open_[k:]
                    hint = open_[-1][1] if open_ else 0
                    break
            continue
        if name in VOID_TAGS or attributes.endswith("/") and name not in BLOCK_TAGS:
            continue
        if name in RAW_TAGS:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if name == "p" or name in ("li", "td", "tr", "option"):  # these end an open one of their kind
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    links -= sum(o[2] for o in open_[k:])
                    del open_[k:]
                    break
                if open_[k][0] in ("table", "ul", "ol", "div", "article", "section", "body", "blockquote"):
                    break
            hint = open_[-1][1] if open_ else 0
        own = _hint(name, attributes)
        if own == DOUBTFUL and name not in BLOCK_TAGS:
            own = NONE
        inner = _inside(own, hint, name == "header")
        if own in (OUTSIDE, LOOSE) and name not in BLOCK_TAGS and inner != hint:
            close()
        open_.append((name, inner, name == "a"))
        links += name == "a"
        hint = inner
    close()
    return out


#: Labelled blocks.  Words, link density and hint of the block;
#: words and link density of the block before; of the block after; text or not.
LABELLED = (
    (1, 1.00, -1, 0, 0.00, 1, 1.00, 0), (2, 1.00, -1, 1, 1.00, 2, 1.00, 0), (1, 1.00, -1, 2, 1.00, 12, 0.00, 0),
    (3, 1.00, -1, 3, 1.00, 9, 0.00, 0), (10, 0.00, -1, 1, 1.00, 11, 0.00, 0), (24, 0.00, -1, 1, 1.00, 8, 0.00, 0),
    (9, 0.00, -1, 60, 0.00, 0, 0.00, 0), (14, 0.10, -1, 35, 0.00, 0, 0.00, 0), (45, 0.05, -1, 80, 0.00, 20, 0.00, 0),
    (120, 0.00, -1, 15, 0.20, 30, 0.00, 0), (70, 0.02, -1, 90, 0.00, 12, 0.50, 0), (5, 0.40, -1, 40, 0.00, 4, 0.50, 0),
    (30, 0.60, -1, 10, 0.80, 12, 0.90, 0), (8, 0.00, -2, 50, 0.00, 50, 0.00, 0), (90, 0.00, -2, 50, 0.00, 50, 0.00, 0),
    (1, 0.00, 1, 12, 0.00, 60, 0.00, 1), (11, 0.00, 1, 12, 0.00, 30, 0.00, 1), (12, 0.00, 1, 10, 0.00, 1, 0.00, 1),
    (2, 0.00, 1, 60, 0.00, 9, 0.00, 1), (35, 0.00, 1, 11, 0.00, 48, 0.00, 1), (90, 0.02, 1, 40, 0.00, 85, 0.00, 1),
    (150, 0.05, 1, 90, 0.00, 12, 0.00, 1), (60, 0.10, 1, 20, 0.00, 10, 0.00, 1), (6, 0.00, 1, 80, 0.00, 9, 0.00, 1),
    (40, 0.30, 1, 60, 0.00, 70, 0.00, 1), (25, 0.40, 1, 60, 0.00, 70, 0.00, 1), (7, 0.00, 1, 0, 0.00, 0, 0.00, 1),
    (3, 1.00, 1, 50, 0.00, 60, 0.00, 1), (5, 1.00, 1, 60, 0.00, 4, 1.00, 0), (3, 1.00, 1, 4, 1.00, 3, 1.00, 0),
    (6, 0.90, 1, 5, 1.00, 8, 1.00, 0), (8, 0.85, 1, 7, 0.90, 10, 0.00, 0), (4, 1.00, 1, 6, 0.95, 5, 1.00, 0),
    (40, 0.00, 0, 8, 0.00, 55, 0.00, 1), (80, 0.05, 0, 30, 0.00, 40, 0.00, 1), (25, 0.00, 0, 60, 0.00, 50, 0.00, 1),
    (120, 0.10, 0, 5, 0.50, 6, 0.50, 1), (60, 0.00, 0, 12, 0.00, 3, 1.00, 1), (18, 0.00, 0, 40, 0.00, 45, 0.00, 1),
    (8, 0.00, 0, 2, 1.00, 60, 0.00, 1), (7, 0.00, 0, 30, 0.00, 80, 0.00, 1), (16, 0.10, 0, 70, 0.00, 30, 0.00, 1),
    (3, 1.00, 0, 2, 1.00, 3, 1.00, 0), (2, 1.00, 0, 0, 0.00, 1, 1.00, 0), (6, 0.80, 0, 4, 1.00, 5, 0.90, 0),
    (4, 0.50, 0, 3, 1.00, 6, 0.30, 0), (5, 0.00, 0, 2, 1.00, 3, 1.00, 0), (30, 0.70, 0, 10, 0.50, 12, 0.60, 0),
    (9, 0.00, 0, 3, 0.50, 8, 0.20, 0), (10, 0.00, 0, 8, 0.00, 6, 0.00, 0), (12, 0.20, 0, 5, 1.00, 4, 0.50, 0),
    (60, 0.00, -1, 9, 0.00, 12, 0.00, 0), (58, 0.00, -1, 12, 0.00, 30, 0.00, 0), (200, 0.00, -1, 60, 0.00, 90, 0.00, 0),
    (16, 0.00, -1, 50, 0.00, 3, 1.00, 0), (33, 0.05, -1, 0, 0.00, 70, 0.00, 0), (75, 0.12, -1, 0, 0.00, 18, 0.00, 0),
    (12, 0.00, -1, 0, 0.00, 55, 0.00, 0), (20, 0.25, -1, 44, 0.00, 26, 0.00, 0), (48, 0.00, -1, 30, 0.00, 45, 0.00, 0),
    (11, 0.00, -1, 1, 1.00, 10, 0.00, 0), (64, 0.00, -2, 10, 0.00, 8, 0.00, 0), (28, 0.00, -1, 150, 0.00, 130, 0.00, 0),
    (30, 0.20, 1, 40, 0.00, 10, 0.00, 1), (45, 0.35, 1, 20, 0.00, 12, 0.00, 1), (12, 0.25, 1, 60, 0.10, 9, 0.10, 1),
    (4, 0.50, 1, 70, 0.00, 8, 0.00, 1), (20, 0.30, 1, 10, 0.50, 5, 0.80, 1), (55, 0.00, 1, 3, 1.00, 2, 1.00, 1),
    (3, 0.00, 1, 4, 0.00, 11, 0.00, 1), (16, 0.00, 1, 0, 0.00, 0, 0.00, 1), (70, 0.00, 1, 12, 0.00, 0, 0.00, 1),
    (9, 0.55, 1, 80, 0.00, 75, 0.00, 1), (8, 0.00, 1, 30, 0.60, 30, 0.60, 1), (5, 0.00, 1, 3, 0.00, 4, 0.00, 1),
    (60, 0.00, -0.5, 40, 0.00, 50, 0.00, 1), (30, 0.00, -0.5, 60, 0.00, 45, 0.00, 1), (90, 0.05, -0.5, 3, 1.00, 80, 0.00, 1),
    (25, 0.05, -0.5, 70, 0.00, 30, 0.10, 1), (45, 0.00, -0.5, 8, 0.00, 4, 0.50, 1), (120, 0.10, -0.5, 5, 0.50, 6, 0.50, 1),
    (40, 0.20, -0.5, 20, 0.00, 35, 0.00, 1), (200, 0.00, -0.5, 0, 0.00, 0, 0.00, 1), (8, 0.00, -0.5, 1, 1.00, 60, 0.00, 1),
    (1, 0.00, -0.5, 1, 0.00, 9, 0.00, 0), (2, 0.00, -0.5, 60, 0.00, 2, 0.00, 0), (5, 0.00, -0.5, 3, 0.00, 6, 0.00, 0),
    (12, 0.10, -0.5, 4, 0.00, 2, 1.00, 0), (6, 1.00, -0.5, 5, 1.00, 7, 1.00, 0), (30, 0.70, -0.5, 10, 0.50, 12, 0.60, 0),
    (14, 0.00, -0.5, 3, 0.00, 2, 0.00, 0), (5, 0.00, -0.5, 60, 0.00, 1, 0.00, 0), (3, 0.00, -0.5, 5, 0.00, 60, 0.00, 0),
    (6, 0.00, 0, 50, 0.00, 2, 1.00, 0), (4, 0.00, 0, 9, 0.00, 0, 0.00, 0), (25, 0.60, 0, 40, 0.00, 30, 0.00, 0),
)
NAMES = ("words", "link_density", "hint", "words_before", "link_density_before", "words_after", "link_density_after")


@dataclass(frozen=True)
class Node:
    """Rows whose ``feature`` is at most ``limit`` go ``low``; a leaf has ``text``."""

    text: bool
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def says(self, row: tuple) -> bool:
        node = self
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.limit else node.high
        return node.text


def _impurity(labels: list[int]) -> float:
    share = sum(labels) / len(labels)
    return len(labels) * share * (1 - share)


def grow(rows: tuple, depth: int = 6, least: int = 1) -> Node:
    """A classification tree by Gini impurity; ties go to the first feature and limit."""
    labels = [r[-1] for r in rows]
    leaf = Node(2 * sum(labels) >= len(labels))
    if depth == 0 or len(set(labels)) < 2:
        return leaf
    best = (_impurity(labels) - 1e-9, -1, 0.0)
    for feature in range(len(rows[0]) - 1):
        values = sorted({r[feature] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            limit = (low + high) / 2
            left, right = [r[-1] for r in rows if r[feature] <= limit], [r[-1] for r in rows if r[feature] > limit]
            if min(len(left), len(right)) >= least:
                best = min(best, (_impurity(left) + _impurity(right), feature, limit))
    _, feature, limit = best
    if feature < 0:
        return leaf
    return Node(leaf.text, feature, limit, grow(tuple(r for r in rows if r[feature] <= limit), depth - 1, least), grow(tuple(r for r in rows if r[feature] > limit), depth - 1, least))


@lru_cache(maxsize=1)
def tree() -> Node:
    return grow(LABELLED)


def main_text(page: str | None, node: Node | None = None) -> str:
    """The article's text of a page."""
    node = node or tree()
    flat = blocks(page or "")
    out = []
    for k, b in enumerate(flat):
        before, after = flat[k - 1] if k else None, flat[k + 1] if k + 1 < len(flat) else None
        row = (b.words, b.link_density, b.hint, before.words if before else 0, before.link_density if before else 0.0, after.words if after else 0, after.link_density if after else 0.0)
        if node.says(row):
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``."""

    def make():
        node = tree()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h, node) for h in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return each

    return map_batches(pages.select(F.col("page_id").cast("long"), "url", "html"), make, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
