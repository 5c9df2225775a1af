"""Sequential kernels: results depend on the order of rows and on earlier results.

Each takes the regions of one page (or document) as a pandas frame; a page is the
unit and a block of pages the group, so groups stay small however large the corpus.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Neighbouring page numbers of a document that one call of a kernel's worker gets.
PAGES_TOGETHER = 1_024


def by_page(rows: DataFrame, kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``kernel`` on the rows of each page.

    A group costs more to hand over than a page takes, so pages of neighbouring numbers
    are handed over together, PAGES_TOGETHER at most.
    """

    def run(block: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([kernel(page) for _, page in block.groupby("pdf_page", sort=False, dropna=False)])

    return rows.groupBy("document_id", F.floor(F.col("pdf_page") / PAGES_TOGETHER)).applyInPandas(run, schema)


def columns_by_page(rows: DataFrame, kernel: Callable[[dict[str, np.ndarray]], dict[str, list]], names: list[str], added: dict[str, str]) -> DataFrame:
    """``rows`` with the columns ``added`` (name: pandas type) that ``kernel`` finds for each page.

    The kernel gets the columns ``names`` of one page as arrays and gives a list for each
    column.  Pages are slices of their block's arrays: a frame for each page would cost
    more than most pages take.
    """
    kinds = {"Int64": "long", "int64": "long", "float64": "double", "object": "string"}
    kept = [f for f in rows.schema.fields if f.name not in added]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{c}` {kinds[t]}" for c, t in added.items()])

    def run(block: pd.DataFrame) -> pd.DataFrame:
        codes = pd.factorize(block.pdf_page, use_na_sentinel=False)[0]
        order = np.argsort(codes, kind="stable")
        arrays = {c: block[c].to_numpy()[order] for c in names}
        edges = [0, *(np.flatnonzero(np.diff(codes[order])) + 1).tolist(), len(order)]
        found: dict[str, list] = {c: [] for c in added}
        for a, b in zip(edges, edges[1:]):
            for c, values in kernel({n: v[a:b] for n, v in arrays.items()}).items():
                found[c].extend(values)
        return block.iloc[order].assign(**{c: pd.array(found[c], t) if t != "object" else np.array(found[c], object) for c, t in added.items()})[[*(f.name for f in kept), *added]]

    return rows.groupBy("document_id", F.floor(F.col("pdf_page") / PAGES_TOGETHER)).applyInPandas(run, schema)


@dataclass(frozen=True)
class ColumnSettings:
    #: Largest distance of a left edge from a column's median, as a share of the page width.
    tolerance: float = 0.06


@dataclass(frozen=True)
class ContinuationSettings:
    """Weights of a body's similarity to a body that has an owner."""

    alignment: float = 0.17
    overlap: float = 0.14
    proximity: float = 0.22
    width: float = 0.11
    style: float = 0.26
    order: float = 0.10
    largest_shift: float = 30.0
    largest_gap: float = 120.0
    least_overlap: float = 0.45
    threshold: float = 0.70
    margin: float = 0.12


def _middle(ascending: list[float]) -> float:
    """The median of numbers in order."""
    n = len(ascending)
    return (ascending[(n - 1) // 2] + ascending[n // 2]) / 2


COLUMN_INPUT = ["x0", "y0", "page_width", "region_ord"]


def page_columns(page: pd.DataFrame, settings: ColumnSettings = ColumnSettings()) -> pd.DataFrame:
    """``page`` with ``column``: regions by left edge, each to the nearest column within reach."""
    return page.assign(**_columns({c: page[c].to_numpy() for c in COLUMN_INPUT}, settings))


def _columns(page: dict[str, np.ndarray], settings: ColumnSettings = ColumnSettings()) -> dict[str, list]:
    found: list[list[float]] = []  # ascending left edges, as regions come by them
    x0, width = page["x0"].tolist(), page["page_width"].tolist()
    owner = [0] * len(x0)
    for i in np.lexsort((page["region_ord"], page["y0"], page["x0"])).tolist():
        distance = [abs(_middle(c) - x0[i]) for c in found]
        near = [(d, k) for k, d in enumerate(distance) if d <= settings.tolerance * width[i]]
        owner[i] = k = min(near)[1] if near else len(found)
        if not near:
            found.append([])
        found[k].append(x0[i])
    order = {k: n for n, k in enumerate(sorted(range(len(found)), key=lambda k: _middle(found[k])))}
    return {"column": [order[k] for k in owner]}


def columns(regions: DataFrame) -> DataFrame:
    return columns_by_page(regions, _columns, COLUMN_INPUT, {"column": "int64"})


@dataclass(frozen=True)
class OrderSettings:
    left_tolerance: float = 18.0
    width_tolerance: float = 0.12
    least_overlap: float = 0.55
    wide: float = 1.55
    spanning_overlap: float = 0.35
    largest_gap: float = 120.0


def _overlap(a: tuple[float, float], b: tuple[float, float]) -> float:
    width = min(a[1] - a[0], b[1] - b[0])
    return max(0.0, min(a[1], b[1]) - max(a[0], b[0])) / width if width > 0 else 0.0


ORDER_INPUT = ["x0", "y0", "x1", "y1", "region_ord", "kind"]


def page_order(page: pd.DataFrame, s: OrderSettings = OrderSettings()) -> pd.DataFrame:
    """``page`` with ``column``, ``place`` in the reading order and its ``confidence``.

    Columns come from bodies of usual width.  Regions that span two columns cut the page
    into bands; the order is by band, column and height.  Regions without a box come last.
    """
    found = _order({c: page[c].to_numpy() for c in ORDER_INPUT}, s)
    return page.assign(**{**found, "column": pd.array(found["column"], "Int64")})


def _order(page: dict[str, np.ndarray], s: OrderSettings = OrderSettings()) -> dict[str, list]:
    rows = list(zip(*(page[c].tolist() for c in ORDER_INPUT), strict=True))
    boxed = [k for k, (x0, y0, x1, y1, *_) in enumerate(rows) if all(c is not None and abs(c) < float("inf") for c in (x0, y0, x1, y1)) and x1 > x0 and y1 > y0]
    height = lambda k: (rows[k][1], rows[k][0], rows[k][4])
    bodies = [k for k in boxed if rows[k][5] == "body"]
    usual = median(rows[k][2] - rows[k][0] for k in bodies) if bodies else 0.0
    found: list[tuple[list[float], list[float]]] = []  # left and right edges of each column, both in order
    for x0, _, x1 in sorted(rows[k][:3] for k in bodies if len(bodies) < 3 or rows[k][2] - rows[k][0] <= s.wide * usual):
        best, into = 0.0, None
        for column in found:
            left, right = map(_middle, column)
            over = _overlap((x0, x1), (left, right))
            if abs(x0 - left) <= max(s.left_tolerance, s.width_tolerance * (x1 - x0)) and over >= s.least_overlap and over > best:
                best, into = over, column
        if into is None:
            found.append(([x0], [x1]))
        else:
            into[0].append(x0)
            insort(into[1], x1)
    spans = sorted(tuple(map(_middle, column)) for column in found)
    width = median(b - a for a, b in spans) if spans else 0.0
    over = {k: [_overlap((rows[k][0], rows[k][2]), b) for b in spans] for k in boxed}
    spanning = sorted((k for k in boxed if len(spans) > 1 and rows[k][2] - rows[k][0] >= s.wide * width and sum(o >= s.spanning_overlap for o in over[k]) > 1), key=height)
    middle = lambda k: (rows[k][1] + rows[k][3]) / 2
    keyed = [((n, 1, 0, 0.0, 0.0, 0), k, None, 0.70) for n, k in enumerate(spanning)]
    for k in set(boxed) - set(spanning):
        column = max(range(len(spans)), key=lambda c: (over[k][c], -c)) if spans else None
        confidence = 0.35 if column is None else 0.85 if over[k][column] >= s.least_overlap else 0.45
        if any(rows[k][1] < rows[j][3] and rows[k][3] > rows[j][1] for j in spanning):
            confidence = min(confidence, 0.40)
        band = sum(middle(k) > middle(j) for j in spanning)
        keyed.append(((band, 0, column or 0, *height(k)), k, column, confidence))
    keyed.sort(key=lambda x: x[0])
    keyed += [((), k, None, 0.15) for k in sorted(set(range(len(rows))) - set(boxed), key=lambda k: rows[k][4])]
    place, columns_, confidences = ([None] * len(rows) for _ in range(3))
    before = None
    for n, (_, k, column, confidence) in enumerate(keyed):
        if before is not None and column is not None and column == before[1] and rows[k][1] - rows[before[0]][3] > s.largest_gap:
            confidence = min(confidence, 0.55)
        place[k], columns_[k], confidences[k] = n + 1, column, confidence
        before = k, column
    return {"column": columns_, "place": place, "confidence": confidences}


def reading_order(regions: DataFrame) -> DataFrame:
    return columns_by_page(regions, _order, ORDER_INPUT, {"column": "Int64", "place": "int64", "confidence": "float64"})


def _scores(boxes: np.ndarray, a: int | slice, s: ContinuationSettings) -> np.ndarray:
    """How well each box continues box ``a``, or a row for each box of a slice; 0 for a veto."""
    x0, y0, x1, y1 = boxes.T
    own = boxes[a].T[..., None] if isinstance(a, slice) else boxes[a]
    shift = np.abs(own[0] - x0)
    gap = np.maximum(0.0, np.maximum(y0 - own[3], own[1] - y1))
    wide, own_wide = x1 - x0, own[2] - own[0]
    width = np.minimum(wide, own_wide)
    overlap = np.where(width > 0, np.maximum(0.0, np.minimum(own[2], x1) - np.maximum(own[0], x0)) / np.where(width > 0, width, 1), 0.0)
    whole = np.maximum(wide, own_wide)
    score = s.alignment * (1 - shift / s.largest_shift) + s.overlap * overlap + s.proximity * (1 - gap / s.largest_gap) + s.width * width / np.where(whole > 0, whole, 1) + s.style * 0.5 + s.order * (y0 >= own[1])
    return np.where((shift > s.largest_shift) | (gap > s.largest_gap) | (overlap < s.least_overlap), 0.0, np.round(score, 4))


MEMBER_INPUT = ["x0", "y0", "x1", "y1", "region_ord", "kind", "article_id"]
#: Regions up to which all pairs of a page are scored in one expression.
FEW = 64


def page_membership(page: pd.DataFrame, settings: ContinuationSettings = ContinuationSettings()) -> pd.DataFrame:
    """Spread owners to open bodies, best pair first, until nothing more is decided.

    A new owner makes a body a reference for the next ones: only its own pairs are
    scored then, each owner keeps its best score for every body.  A body whose two best
    owners are closer than the margin stays open.
    """
    return page.assign(**_members({c: page[c].to_numpy() for c in MEMBER_INPUT}, settings))


def _members(page: dict[str, np.ndarray], settings: ContinuationSettings = ContinuationSettings()) -> dict[str, list]:
    names = [a if isinstance(a, str) else None for a in page["article_id"]]
    owners = sorted({a for a in names if a is not None})
    place = {o: k for k, o in enumerate(owners)}
    open_ = np.array([a is None and kind == "body" for a, kind in zip(names, page["kind"], strict=True)], bool)
    score = [1.0 if a is not None else None for a in names]
    if owners and open_.any():
        boxes = np.stack([page[c].astype(float) for c in ("x0", "y0", "x1", "y1")], axis=1)
        each = _scores(boxes, slice(None), settings) if len(names) <= FEW else None
        best = np.zeros((len(owners) + 1, len(names)))  # a row of zeros stands for nobody

        def refer(a: int) -> None:
            row = best[place[names[a]]]
            np.maximum(row, _scores(boxes, a, settings) if each is None else each[a], out=row)

        for a in [k for k, name in enumerate(names) if name is not None]:
            refer(a)
        order = np.lexsort((page["region_ord"], boxes[:, 1]))
        while open_.any():
            two = np.partition(best, len(owners) - 1, axis=0)[-2:]
            fits = open_ & (two[1] >= settings.threshold) & (two[1] - two[0] >= settings.margin)
            if not fits.any():
                break
            value = np.where(fits, two[1], -1.0)[order]
            k = int(order[int(np.argmax(value))])
            names[k], score[k] = owners[int(np.argmax(best[:, k]))], float(two[1][k])
            open_[k] = False
            refer(k)
    return {"article_id": names, "score": score}


def membership(regions: DataFrame) -> DataFrame:
    """``regions`` has kind and article_id (null where open); ``score`` is added."""
    return columns_by_page(regions, _members, MEMBER_INPUT, {"article_id": "object", "score": "float64"}).select(*regions.columns, "score")


def members_in_order(regions: DataFrame) -> DataFrame:
    """``membership`` and ``reading_order`` in one pass over the pages."""
    return columns_by_page(regions, lambda page: {**_members(page), **_order(page)}, MEMBER_INPUT, {"article_id": "object", "score": "float64", "column": "Int64", "place": "int64", "confidence": "float64"})


@dataclass(frozen=True)
class ChainSettings:
    longest: int = 6
    least_shared: int = 2


def document_chains(pages: pd.DataFrame, settings: ChainSettings = ChainSettings()) -> pd.DataFrame:
    """Chains of consecutive pages: a page joins if it is next, shares tokens and the chain is short enough."""
    chain, out = None, []
    for row in pages.sort_values("pdf_page").itertuples(index=False):
        tokens = set(row.tokens)
        if chain and row.pdf_page == chain["page"] + 1 and chain["n"] < settings.longest and len(tokens & chain["tokens"]) >= settings.least_shared:
            chain = {"id": chain["id"], "page": row.pdf_page, "n": chain["n"] + 1, "tokens": tokens}
        else:
            chain = {"id": row.pdf_page, "page": row.pdf_page, "n": 1, "tokens": tokens}
        out.append((row.document_id, row.pdf_page, chain["id"], chain["n"]))
    return pd.DataFrame(out, columns=["document_id", "pdf_page", "chain_start", "place"])


def chains(pages: DataFrame) -> DataFrame:
    """(document_id, pdf_page, chain_start, place); ``pages`` has an array ``tokens``."""
    return pages.groupBy("document_id").applyInPandas(lambda pages: document_chains(pages), "document_id long, pdf_page long, chain_start long, place long")


def assemble(parts: pd.DataFrame) -> pd.DataFrame:
    """The text of one article: hyphens at ends of parts are joined if the joined word is attested."""
    ordered = parts.sort_values("region_ord", kind="stable")
    attested = {w.strip(".,;:!?").lower() for t in ordered.text for w in t.split()}
    text, joined = "", 0
    for part in ordered.text:
        part = part.strip()
        if not text:
            text = part
            continue
        left, right = text.rsplit(" ", 1)[-1], part.split(" ", 1)[0]
        if text.endswith("-") and right[:1].islower():
            whole = left[:-1] + right
            keep = whole.strip(".,;:!?").lower() in attested
            text, joined = (text[:-1] if keep else text) + part, joined + keep
        elif text[-1:].isalnum() and part[:1].islower() or text.endswith(","):
            text += " " + part
        else:
            text += "\n\n" + part
    return pd.DataFrame([(ordered.document_id.iloc[0], ordered.pdf_page.iloc[0], text, joined)], columns=["document_id", "pdf_page", "body", "joined"])
