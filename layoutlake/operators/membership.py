"""Who owns a body: owners spread over columns and lanes, and scored rounds on a page.

What only looks at neighbours in a fixed order is a window or a join.  Rounds in which
an owner found makes others possible are a kernel with a page as its unit; there a
score is one numpy expression over all open bodies and all owned ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layoutlake.functions import geometry
from layoutlake.operators.kernels import columns_by_page

PAGE = ["document_id", "pdf_page"]


# ---- set-based ----


def spread_columns(columns: DataFrame) -> DataFrame:
    """Owners go on from column to column as long as steps are accepted: (…, column, article_id, inherited).

    ``columns`` has column, article_id (null where open) and step (whether the column before
    goes on in this one).  Running to the fixpoint is one window: an open column takes the
    owner with which its run of accepted steps began.
    """
    w = Window.partitionBy(*PAGE).orderBy("column")
    start = F.col("article_id").isNotNull() | ~F.coalesce("step", F.lit(False))
    c = columns.withColumn("_run", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.first("article_id").over(Window.partitionBy(*PAGE, "_run").orderBy("column").rowsBetween(Window.unboundedPreceding, 0))
    return c.select(*PAGE, "column", F.coalesce("article_id", first).alias("article_id"), (F.col("article_id").isNull() & first.isNotNull()).alias("inherited"))


def fill_columns(bodies: DataFrame, gap: float = 24.0, overlap: float = 0.55) -> DataFrame:
    """Open bodies in a column that one article owns, next to one of its bodies: (…, region_ord, article_id).

    ``bodies`` has region_ord, column, article_id and boxes.  Runs of open bodies are
    filled from their nearest owned neighbours above or below.
    """
    one = bodies.filter("article_id is not null").groupBy(*PAGE, "column").agg(F.when(F.countDistinct("article_id") == 1, F.max("article_id")).alias("owner")).filter("owner is not null")
    b = bodies.join(one, [*PAGE, "column"])
    w = Window.partitionBy(*PAGE, "column").orderBy("y0", "region_ord")
    near = (F.col("y0") - F.lag("y1").over(w)).between(-4, gap) & (geometry.horizontal_overlap(geometry.box(), tuple(F.lag(c).over(w) for c in ("x0", "y0", "x1", "y1"))) >= overlap)
    b = b.withColumn("_new", (~F.coalesce(near, F.lit(False))).cast("int")).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    owned = F.max(F.col("article_id").isNotNull()).over(Window.partitionBy(*PAGE, "column", "_run"))
    return b.withColumn("_owned", owned).filter(F.col("article_id").isNull() & F.col("_owned")).select(*PAGE, "region_ord", F.col("owner").alias("article_id"))


def bootstrap(groups: DataFrame, least: float = 0.72, margin: float = 0.12) -> DataFrame:
    """Groups of columns below a header: (…, column, article_id, score, status).

    ``groups`` has article_id, columns (array), overlap, gap (share of the height), adjacency (means),
    matched and styled.  A proposal wins over all that share a column with it only with a lead.
    """
    score = 0.38 * F.col("overlap") + 0.18 * (1 - F.col("gap") / 0.15) + 0.18 * F.col("adjacency") + F.when(F.col("matched"), 0.14).otherwise(0.0) + F.when(F.col("styled"), 0.12).otherwise(0.0)
    g = groups.filter((F.col("overlap") >= 0.45) & F.col("gap").between(0, 0.15)).withColumn("score", F.round(score, 4)).filter(F.col("score") >= least)
    each = g.select(*PAGE, "article_id", "score", F.explode("columns").alias("column"))
    rivals = each.select(*PAGE, "column", F.col("article_id").alias("other"), F.col("score").alias("other_score"))
    beaten = each.join(rivals, [*PAGE, "column"]).filter((F.col("other") != F.col("article_id")) & (F.col("score") - F.col("other_score") < margin - 1e-12)).select(*PAGE, "article_id").distinct().withColumn("beaten", F.lit(True))
    out = each.join(beaten, [*PAGE, "article_id"], "left")
    return out.select(*PAGE, "column", "article_id", "score", F.when(F.col("beaten"), "ambiguous").otherwise("accepted").alias("status"))


# ---- kernels ----


@dataclass(frozen=True)
class Round:
    """A scorer with its threshold, its lead and how many rounds it may take (0: until nothing changes)."""

    score: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray]
    threshold: float
    margin: float
    rounds: int = 0
    lone_needs_margin: bool = True
    #: What it adds if a body's candidate owner is the reference's; another candidate is a veto.
    candidate: float = 0.0


def _pairs(boxes: np.ndarray) -> dict[str, np.ndarray]:
    """Relations of all boxes: row i is the open body, column j the reference."""
    x0, y0, x1, y1 = (boxes[:, k][:, None] for k in range(4))
    rx0, ry0, rx1, ry1 = (boxes[:, k][None, :] for k in range(4))
    width, height = np.minimum(x1 - x0, rx1 - rx0), np.minimum(y1 - y0, ry1 - ry0)
    safe = lambda a, b: np.where(b > 0, a / np.where(b > 0, b, 1), 0.0)
    return {
        "overlap": safe(np.maximum(0, np.minimum(x1, rx1) - np.maximum(x0, rx0)), width),
        "vertical": safe(np.maximum(0, np.minimum(y1, ry1) - np.maximum(y0, ry0)), height),
        "below": y0 - ry1, "gap": np.maximum(0, np.maximum(y0 - ry1, ry0 - y1)), "right": x0 - rx1, "left": np.abs(x0 - rx0), "top": np.abs(y0 - ry0),
        "widths": safe(width, np.maximum(x1 - x0, rx1 - rx0)), "shift": x0 - rx0,
    }


def _known(values: np.ndarray) -> np.ndarray:
    return np.array([x is not None and x == x for x in values], bool)


def _same(v: np.ndarray) -> np.ndarray:
    """Known and equal values of both sides."""
    known = _known(v)
    return (v[:, None] == v[None, :]) & known[:, None] & known[None, :] if known.any() else np.zeros((len(v), len(v)), bool)


def _differ(v: np.ndarray) -> np.ndarray:
    known = _known(v)
    return (v[:, None] != v[None, :]) & known[:, None] & known[None, :] if known.any() else np.zeros((len(v), len(v)), bool)


def refinement(boxes: np.ndarray, page: dict[str, np.ndarray]) -> np.ndarray:
    """A body next to an owned one in its lane and of its zone."""
    p, height = _pairs(boxes), float(page["page_height"][0] or 842.0)
    most = min(max(0.13 * height, 56.0), 100.0)
    score = 0.43 * p["overlap"] + 0.29 * (1 - p["gap"] / most) + 0.20 * _same(page["zone"]) + 0.10 * (np.abs(page["font"][:, None] / page["font"][None, :] - 1) <= 0.25)
    return np.where((p["overlap"] < 0.52) | (p["gap"] > most) | _differ(page["zone"]), 0.0, np.round(score, 4))


def columns_right(boxes: np.ndarray, page: dict[str, np.ndarray]) -> np.ndarray:
    """A body beside an owned one, to its right, at its height."""
    p = _pairs(boxes)
    most = max(24.0, 0.45 * float(np.median(boxes[:, 2] - boxes[:, 0])))
    gap = np.maximum(p["right"], 0.0)
    score = 0.32 * (1 - gap / most) + 0.25 * p["widths"] + 0.30 * p["vertical"] + 0.13 * np.maximum(0.0, 1 - p["top"] / np.maximum(boxes[:, 3] - boxes[:, 1], 1.0)[:, None])
    return np.where((p["right"] < -8) | (gap > most) | (p["widths"] < 0.72) | (p["vertical"] < 0.60), 0.0, np.round(score, 4))


def everywhere(boxes: np.ndarray, page: dict[str, np.ndarray]) -> np.ndarray:
    """All evidence of a page at once: zone, header above, column, neighbours."""
    p = _pairs(boxes)
    title = (page["kind"] == "title")[None, :]
    header = np.where(title & (p["below"] >= 0) & (p["below"] <= 320), 0.28 * p["overlap"] + 0.13 * (1 - p["below"] / 320), 0.0)
    lane = np.where(~title, np.where((p["overlap"] >= 0.55) & (p["gap"] <= 44), 0.38, np.where(p["overlap"] >= 0.55, 0.35, 0.0)), 0.0)
    only = title.sum() == 1
    sole = np.where(title & only & (page["chars"] >= 200)[:, None], 0.32, 0.0)
    score = 0.28 * _same(page["zone"]) + header + lane + sole + 0.07 * page["seed"].astype(bool)[:, None]
    structural = (header > 0) | (lane > 0) | (sole > 0) | _same(page["zone"])
    return np.where(_differ(page["zone"]) | ~structural, 0.0, np.round(np.minimum(score, 1.0), 4))


REFINEMENT = Round(refinement, 0.70, 0.14, lone_needs_margin=False, candidate=0.20)
COLUMNS = Round(columns_right, 0.78, 0.12)
GLOBAL = Round(everywhere, 0.68, 0.14, rounds=4, lone_needs_margin=False, candidate=0.25)


BOX = ["x0", "y0", "x1", "y1"]
INPUT = [*BOX, "region_ord", "kind", "article_id", "zone", "candidate", "font", "chars", "seed", "page_height"]


def barriers(page: pd.DataFrame) -> np.ndarray:
    """Whether a title of somebody else stands between an open body (row) and a reference above it (column)."""
    return _barriers(page[BOX].to_numpy(float), np.flatnonzero(page.kind.to_numpy(object) == "title"))


def _barriers(boxes: np.ndarray, titles: np.ndarray) -> np.ndarray:
    """``barriers`` by one product: body below and under the title, reference above it and not itself."""
    t = boxes[titles]
    wide = np.minimum((boxes[:, 2] - boxes[:, 0])[:, None], (t[:, 2] - t[:, 0])[None, :])
    meets = np.maximum(0, np.minimum(boxes[:, 2][:, None], t[:, 2][None, :]) - np.maximum(boxes[:, 0][:, None], t[:, 0][None, :])) >= 0.2 * np.maximum(wide, 1)
    under = meets & (boxes[:, 1][:, None] >= t[:, 3][None, :])
    above = boxes[:, 3][None, :] <= t[:, 1][:, None]
    above[np.arange(len(titles)), titles] = False
    return under.astype(np.float32) @ above.astype(np.float32) > 0


def spread(page: pd.DataFrame, step: Round) -> pd.DataFrame:
    """``page`` with owners after the rounds of ``step``; ``score`` is that of each decision.

    In a round every open body takes its best owner if that reaches the threshold and
    leads the next; what a round decides counts from the next round on.
    """
    page = page.sort_values(["y0", "x0", "region_ord"], kind="stable")
    cols = _typed({c: page[c].to_numpy() for c in INPUT})
    owner, scores = _spread(cols, step)
    return page.assign(article_id=owner, score=scores)


def _typed(page: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    numbers = {"font", "chars", *BOX}
    objects = {"kind", "zone", "candidate"}
    return {c: v.astype(float) if c in numbers else v.astype(object) if c in objects else v for c, v in page.items()} | {"boxes": np.stack([page[c].astype(float) for c in BOX], axis=1)}


def _spread(page: dict[str, np.ndarray], step: Round) -> tuple[list, list]:
    """Owners and scores after the rounds of ``step``; ``page`` is in order."""
    boxes = page["boxes"]
    owner = [a if isinstance(a, str) else None for a in page["article_id"]]
    scores = [1.0 if a is not None else None for a in owner]
    open_ = np.array([a is None and k == "body" for a, k in zip(owner, page["kind"], strict=True)], bool)
    if open_.any() and any(owner):
        if "barriers" not in page:  # titles and boxes are the same for all steps
            page["barriers"] = _barriers(boxes, np.flatnonzero(page["kind"] == "title"))
        pair = np.where(page["barriers"], 0.0, step.score(boxes, page))
        names = sorted({a for a in owner if a})
        place = {n: k for k, n in enumerate(names)}
        owned = np.array([place[a] if a else -1 for a in owner])
        wanted = page["candidate"]
        known = np.array([isinstance(c, str) for c in wanted], bool)
        done = 0
        while open_.any() and (not step.rounds or done < step.rounds):
            each = [pair[:, owned == k].max(axis=1, initial=0.0) for k in range(len(names))]
            each = [np.where((b > 0) & (~known | (wanted == n)), b + step.candidate * (wanted == n), 0.0) for b, n in zip(each, names, strict=True)]
            best = np.round(np.stack([*each, np.zeros(len(owner))], axis=1), 4)
            order = np.argsort(-best, axis=1, kind="stable")
            first, second = np.take_along_axis(best, order[:, :2], axis=1).T
            lead = (first - second >= step.margin - 1e-12) | ((second == 0) & (not step.lone_needs_margin))
            take = np.flatnonzero(open_ & (first >= step.threshold) & lead)
            if not len(take):
                break
            for k in take.tolist():
                owned[k] = order[k, 0]
                owner[k], scores[k] = names[owned[k]], float(first[k])
            open_[take] = False
            done += 1
    return owner, scores


def rounds(regions: DataFrame, *steps: Round) -> DataFrame:
    """``regions`` after each of ``steps`` in turn, with ``score``.

    Columns: region_ord, kind, article_id, zone, candidate, font, chars, seed, boxes and page_height.
    """

    def run(page: dict[str, np.ndarray]) -> dict[str, list]:
        place = np.lexsort((page["region_ord"], page["x0"], page["y0"]))
        cols = _typed({c: v[place] for c, v in page.items()})
        scores: list = [None] * len(place)
        for step in steps:
            cols["article_id"], found = _spread(cols, step)
            scores = [f if s is None else s for s, f in zip(scores, found, strict=True)]
        back = np.argsort(place).tolist()
        return {"article_id": [cols["article_id"][k] for k in back], "score": [scores[k] for k in back]}

    return columns_by_page(regions, run, INPUT, {"article_id": "object", "score": "float64"}).select(*regions.columns, "score")
