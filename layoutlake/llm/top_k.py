"""Exact BM25 top-k search over a sharded inverted index with block-max WAND pruning.

Documents are indexed in shards, closed at SHARD_POSTINGS postings or SHARD_DOCS
documents.  In a shard documents stand by their most frequent term and by length, so
that those of a block are alike; each term has its postings in this order, cut into blocks of BLOCK_DOCS
consecutive documents with the term's greatest weight in the block.

Queries are evaluated shard by shard, in groups of alike ones (by their most frequent
term and length), so that numpy works on a group's cursors at once:

* a block's bound for a query is the sum of its terms' greatest weights; each query
  visits its blocks by descending bound in steps of growing width, its threshold (the
  k-th best score so far) rises after each step, and the first bound below it ends its
  search; the next shard of a task begins with the thresholds that the ones before
  have reached;
* the pivot: terms that many of the group's queries share with many documents are
  scored first, in one matrix product for each block and the queries that visit it;
  the postings of the other terms are added only in blocks where some document can
  still reach the query's threshold.

Pruning works on single-precision weights with a margin for their error that grows
with the query's terms; what may be in the result then is scored anew in double
precision, term by term in one order, so equal documents get equal scores.  Document frequencies, document count and mean
length are those of the whole corpus, so tasks' lists merge exactly.

Queries are rows of the corpus (doc_id divisible by ``EVERY``); their term vectors
are taken in parts of at most QUERY_BYTES (or one query) that are broadcast against
all shards.  Every query row has its own result, also if rows share a doc_id.  A
document isn't a result of its own query: rows with the query's doc_id are left
out.  Terms are runs without ASCII white space, A-Z lower-cased; a term counts as
often as the query has it.  Ties go to the smaller doc_id.  Texts without terms (or
null) are never found and find nothing; texts of any length are taken whole; rows
that share a doc_id are found separately; a null doc_id is found last.  An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layoutlake.llm.common import bounded, released, shared_dir, table, written

K = 10
K1, B = 1.2, 0.75
SHARD_POSTINGS = 3_000_000
#: At most 65,536: documents are numbered in 16 bits.
SHARD_DOCS = 32_768
BLOCK_DOCS = 128
#: Blocks of a query's first step; every step takes twice as many as the one before.
FIRST_BLOCKS = 4
EVERY = 100
QUERY_BYTES = 32 << 20
#: Words kept with their hashes in a task; beyond it the store starts afresh.
STORE_WORDS = 200_000
LAST = np.iinfo(np.int64).max


class Terms:
    """Texts to the hashes of their terms, ascending, with counts."""

    def __init__(self) -> None:
        self.store: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = Counter((text or "").encode().lower().split())
        store = self.store
        if len(store) > STORE_WORDS:
            store.clear()
        for w in found:
            if w not in store:
                store[w] = xxhash.xxh3_64_intdigest(w)
        names = np.fromiter(map(store.__getitem__, found), np.uint64, len(found))
        order = np.argsort(names)
        return names[order], np.fromiter(found.values(), np.int32, len(found))[order]


def _alike(terms: list[np.ndarray], counts: list[np.ndarray], lengths: list[int]) -> np.ndarray:
    """The order of texts by their most frequent term and their length."""
    common = [int(t[np.argmax(c)]) if len(t) else 0 for t, c in zip(terms, counts, strict=True)]
    return np.lexsort((lengths, np.array(common, np.uint64)))


_INDEX = "n long, words long, doc_ids binary, lengths binary, terms binary, starts binary, docs binary, counts binary"
_ARRAYS = {"doc_ids": np.int64, "lengths": np.int64, "terms": np.uint64, "starts": np.int64, "docs": np.uint16, "counts": None}


class _Open:
    """A shard that documents are added to."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc_id: int | None, terms: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(LAST if doc_id is None else doc_id)
        self.lengths.append(int(counts.sum()))
        self.terms.append(terms)
        self.counts.append(counts)
        self.postings += len(terms)

    def full(self) -> bool:
        return self.postings >= SHARD_POSTINGS or len(self.ids) >= SHARD_DOCS

    def close(self) -> pa.RecordBatch:
        order = _alike(self.terms, self.counts, self.lengths)
        lengths = np.array(self.lengths, np.int64)[order]
        flat = np.concatenate([self.terms[k] for k in order])
        counts = np.concatenate([self.counts[k] for k in order])
        docs = np.repeat(np.arange(len(order), dtype=np.uint16), [len(self.terms[k]) for k in order])
        by_term = np.argsort(flat, kind="stable")
        flat, counts, docs = flat[by_term], counts[by_term], docs[by_term]
        starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else np.empty(0, np.int64)
        narrow = counts.astype(np.uint8 if len(counts) and counts.max() < 256 else np.uint32)
        arrays = (np.array(self.ids, np.int64)[order], lengths, flat[starts], np.append(starts, len(flat)).astype(np.int64), docs, narrow)
        columns = [pa.array([len(order)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)]
        return pa.RecordBatch.from_arrays(columns, names=["n", "words", *_ARRAYS])


def build(docs: DataFrame) -> DataFrame:
    """The written index: one row for each shard, its arrays as binary columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, shard = Terms(), _Open()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                shard.add(doc_id.as_py(), *terms(text.as_py()))
                if shard.full():
                    yield shard.close()
                    shard = _Open()
        if shard.ids:
            yield shard.close()

    return written(bounded(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(lambda batches: released(run(batches)), _INDEX), "topk-index")


def _arrays(batch: pa.RecordBatch, k: int, *names: str) -> list[np.ndarray]:
    """Arrays of row ``k``, without a copy; ``counts`` has the width that its shard needs."""
    out = {c: batch.column(c)[k].as_buffer() for c in names}
    wide = lambda c: np.uint8 if out[c].size == out["docs"].size // 2 else np.uint32
    return [np.frombuffer(out[c], _ARRAYS[c] or wide(c)) for c in names]


#: Share by which a single-precision sum may be off for each of its terms (twice the bound).
SLACK = 2.0**-23
#: What rounding to nine places may take from a threshold.
ROUNDING = 1e-9
#: Scores (queries by documents), terms and postings handled at once; they bound a task's memory.
GROUP_CELLS, GROUP_TERMS, ADDED = 2 << 20, 150_000, 1 << 18
#: A term is dense if at least one in so many pairs of a query and a document share it,
#: as long as the dense weights (documents by terms) have no more than DENSE_CELLS.
DENSE, DENSE_CELLS = 1_500, 6 << 20


class Asked(NamedTuple):
    """Queries: each one's doc_id, and its rows of terms (places in ``names``, ascending) with factors."""

    number: np.ndarray
    own: list[int | None]
    starts: np.ndarray
    names: np.ndarray
    terms: np.ndarray
    factors: np.ndarray


class Shard:
    def __init__(self, doc_ids, lengths, terms, starts, docs, counts, mean_length: float = 1.0):
        self.ids, self.terms, self.starts, self.docs, self.counts = doc_ids, terms, starts, docs, counts
        self.norm = K1 * (1 - B + B * lengths / mean_length)
        self.weight = np.empty(len(docs), np.float32)
        for at in range(0, len(docs), ADDED):
            part = slice(at, at + ADDED)
            self.weight[part] = _weighted(counts[part], self.norm[docs[part]])
        self.blocks = -(-len(doc_ids) // BLOCK_DOCS)
        # runs of postings of one term in one block
        block = (docs // BLOCK_DOCS).astype(np.int16)
        new = np.empty(len(docs), bool)
        new[:1] = True
        new[1:] = block[1:] != block[:-1]
        new[starts[:-1]] = True
        self.cell_start = np.flatnonzero(new).astype(np.int32)
        self.cell_size = np.diff(self.cell_start, append=np.int32(len(docs)))
        self.cell_block = block[self.cell_start]
        self.cell_most = np.maximum.reduceat(self.weight, self.cell_start) if len(docs) else np.empty(0, np.float32)
        self.term_cells = np.searchsorted(self.cell_start, starts)
        self.by_id = np.argsort(doc_ids, kind="stable")
        #: Blocks with a term of a query, and those of them that were scored.
        self.met = self.scored = 0

    @cached_property
    def by_doc(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each document's terms begin; their places, ascending; their counts."""
        order = np.argsort(self.docs, kind="stable")
        place = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.diff(self.starts))
        return np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=len(self.ids))))), place[order], self.counts[order]

    def places(self, names: np.ndarray) -> np.ndarray:
        """The place of each term, -1 if the shard hasn't it."""
        if not len(self.terms):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.terms, names), len(self.terms) - 1)
        return np.where(self.terms[at] == names, at, -1)

    def search(self, names: np.ndarray, factors: np.ndarray, own: int | None, k: int = K, least: float = 0.0) -> list[tuple[int, float]]:
        """The best k (doc_id, score) of one query that reach ``least``, highest score first."""
        one = np.zeros(len(names), np.int64), self.places(names), factors.astype(float)
        return self.search_group(*one, [own], k, np.array([least]))[0]

    def search_all(self, asked: Asked, best: list[list[tuple[float, int]]], k: int) -> None:
        """Bring the shard into ``best``, each query's list of (-score, doc_id), group by group."""
        place, at = self.places(asked.names), 0
        while at < len(asked.own):
            width = max(1, GROUP_CELLS // max(1, len(self.ids)))
            stop = min(at + width, max(at + 1, int(np.searchsorted(asked.starts, asked.starts[at] + GROUP_TERMS, "right")) - 1), len(asked.own))
            span = slice(asked.starts[at], asked.starts[stop])
            query = np.repeat(np.arange(stop - at), np.diff(asked.starts[at : stop + 1]))
            least = np.array([-held[-1][0] if len(held) == k else 0.0 for held in best[at:stop]])
            found = self.search_group(query, place[asked.terms[span]], asked.factors[span], asked.own[at:stop], k, least)
            for held, more in zip(best[at:stop], found, strict=True):
                if more:
                    held += [(-s, i) for i, s in more]
                    held.sort()
                    del held[k:]
            at = stop

    def search_group(self, query: np.ndarray, place: np.ndarray, factors: np.ndarray, own: list[int | None], k: int, least: np.ndarray) -> list[list[tuple[int, float]]]:
        """For each of some queries the best k (doc_id, score) that reach its ``least``.

        The queries' terms are rows (query, place, factor), ascending by query and place.
        """
        size, n = len(own), len(self.ids)
        has = place >= 0
        query, place, double = query[has], place[has], factors[has]
        if not len(place):
            return [[] for _ in own]
        slack = ((np.bincount(query, minlength=size) + 8) * SLACK)[:, None]
        factors = double.astype(np.float32)
        # terms that many of the queries share with many documents: dense
        sizes = np.diff(self.starts)
        gain = np.bincount(place, minlength=len(sizes)) * sizes
        dense = np.flatnonzero(gain * DENSE >= size * n)
        most = max(1, DENSE_CELLS // n)
        if len(dense) > most:
            dense = np.sort(dense[np.argpartition(-gain[dense], most)[:most]])
        column = np.full(len(sizes), -1, np.int32)
        column[dense] = np.arange(len(dense))
        is_dense = column[place] >= 0
        asked = np.zeros((size, len(dense)), np.float32)
        asked[query[is_dense], column[place[is_dense]]] = factors[is_dense]
        weights = np.zeros((n, len(dense)), np.float32)
        for a, b in _cuts(sizes[dense]):
            of, at = _spread(self.starts[dense[a:b]], sizes[dense[a:b]])
            weights[self.docs[at], of + a] = self.weight[at]
        cells = np.diff(self.term_cells)
        at = _ranges(self.term_cells[dense], cells[dense])
        highest = np.zeros((len(dense), self.blocks), np.float32)
        highest[np.repeat(np.arange(len(dense)), cells[dense]), self.cell_block[at]] = self.cell_most[at]
        # the others: a row for each query and cell
        query_, place_, factors_ = query[~is_dense], place[~is_dense], factors[~is_dense]
        of, cell = _spread(self.term_cells[place_], cells[place_])
        pair, factor = (query_ * self.blocks)[of] + self.cell_block[cell], factors_[of]  # query and block
        rest = np.bincount(pair, self.cell_most[cell] * factor, minlength=size * self.blocks).reshape(size, self.blocks)
        bound = (asked @ highest + rest) * (1 + slack)
        order = np.argsort(-bound, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(self.blocks)[None, :], axis=1)
        self.met += int((bound > 0).sum())
        score = np.zeros((size, n), np.float32)
        mine = self._own(own)
        best = least.astype(float)[:, None]
        at, width = 0, FIRST_BLOCKS
        while at < self.blocks:
            floor = best * (1 - slack) - ROUNDING
            # what has a lower bound than the k-th best score so far is skipped
            live = (bound > 0) & (bound >= floor) & (rank >= at)
            if not live.any():
                break
            live &= rank < at + width
            self.scored += int(live.sum())
            for b in np.flatnonzero(live.any(axis=0)).tolist():
                rows, docs = np.flatnonzero(live[:, b]), slice(b * BLOCK_DOCS, (b + 1) * BLOCK_DOCS)
                part = asked[rows] @ weights[docs].T
                score[rows, docs] = part
                # the pivot: no document of the block can reach the threshold by the terms left
                live[rows, b] = (part.max(axis=1) + rest[rows, b]) * (1 + slack[rows, 0]) >= floor[rows, 0]
            here = np.flatnonzero(live.ravel()[pair])
            self._add(score, pair[here] // self.blocks, cell[here], factor[here])
            score[mine] = 0
            above, kth = _kth(score, best.astype(np.float32), k)
            best[above, 0] = np.maximum(best[above, 0], kth * (1 - slack[above, 0]))
            at, width = at + width, 2 * width
        floor = ((best * (1 - slack) - ROUNDING) / (1 + slack)).astype(np.float32)
        rows, docs = np.divmod(np.flatnonzero(score >= np.maximum(np.nextafter(floor, np.float32(-1)), np.finfo(np.float32).smallest_subnormal)), n)
        out: list[list[tuple[int, float]]] = [[] for _ in own]
        first = np.searchsorted(query, np.arange(size + 1))
        cuts = np.searchsorted(rows, np.arange(size + 1))
        wanted, by_place = np.zeros(len(sizes), bool), np.zeros(len(sizes))
        for q in np.unique(rows).tolist():
            found, terms = docs[cuts[q] : cuts[q + 1]], slice(first[q], first[q + 1])
            wanted[place[terms]], by_place[place[terms]] = True, double[terms]
            exact = -np.round(self._exact(found, wanted, by_place), 9)
            wanted[place[terms]] = False
            out[q] = [(i, -s) for s, i in sorted(zip(exact.tolist(), self.ids[found].tolist(), strict=True))[:k] if -s >= least[q]]
        return out

    def _add(self, score: np.ndarray, query: np.ndarray, cell: np.ndarray, factor: np.ndarray) -> None:
        """Add the cells' postings to ``score`` (queries by documents)."""
        flat, sizes, row = score.ravel(), self.cell_size[cell], query * score.shape[1]
        for a, b in _cuts(sizes):
            of, at = _spread(self.cell_start[cell[a:b]], sizes[a:b])
            np.add.at(flat, row[a:b][of] + self.docs[at], self.weight[at] * factor[a:b][of])

    def _own(self, own: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        """Queries and documents that have the same doc_id."""
        there = np.flatnonzero([i is not None for i in own])
        ids, wanted = self.ids[self.by_id], np.array([own[q] for q in there], np.int64)
        low, high = np.searchsorted(ids, wanted), np.searchsorted(ids, wanted, "right")
        return np.repeat(there, high - low), self.by_id[_ranges(low, high - low)]

    def _exact(self, found: np.ndarray, wanted: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Scores of documents in ``found``, their terms added up in one order; what is wanted and factors by place."""
        starts, places, counts = self.by_doc
        spans = list(zip(starts[found].tolist(), starts[found + 1].tolist(), strict=True))
        place = np.concatenate([places[a:b] for a, b in spans])
        at = np.flatnonzero(wanted[place])
        row = np.searchsorted(np.cumsum([b - a for a, b in spans]), at, "right")
        taken = np.concatenate([counts[a:b] for a, b in spans])[at]
        return np.bincount(row, _weighted(taken, self.norm[found][row]) * factors[place[at]], minlength=len(found))


def _kth(score: np.ndarray, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with at least ``k`` scores above ``best``, and the k-th highest score of each."""
    at = np.flatnonzero(score > best)
    high, ends = score.ravel()[at], np.cumsum(np.bincount(at // score.shape[1], minlength=len(score)))
    sizes = np.diff(ends, prepend=0)
    rows = np.flatnonzero(sizes >= k)
    kth = [np.partition(high[a:b], -k)[-k] for a, b in zip((ends - sizes)[rows].tolist(), ends[rows].tolist(), strict=True)]
    return rows, np.array(kth, float)


def _weighted(counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return counts * (K1 + 1) / (counts + norm)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers of all ranges from ``starts`` of ``sizes``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _cuts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive parts of ``sizes`` that add up to about ADDED."""
    ends = np.cumsum(sizes, dtype=np.int64)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(ADDED, ends[-1] if len(ends) else 0, ADDED)).tolist(), len(sizes)])
    return pairwise(cuts.tolist())


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_ranges`` of sizes above 0, and for each integer the place of its range."""
    ends = np.cumsum(sizes, dtype=np.int64)
    new = np.zeros(ends[-1] if len(ends) else 0, np.int8)
    new[ends[:-1]] = 1
    of = np.cumsum(new, dtype=np.int64)
    return of, (starts - (ends - sizes))[of] + np.arange(len(of))


def _vectors(queries: DataFrame) -> DataFrame:
    """The written queries: number, doc_id, terms, counts, bytes."""
    schema = "number long, doc_id long, terms binary, counts binary, bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            made = [terms(t.as_py()) for t in batch.column("text")]
            columns = [batch.column("number"), batch.column("doc_id"), pa.array([n.tobytes() for n, _ in made], pa.binary()), pa.array([c.tobytes() for _, c in made], pa.binary()), pa.array([64 + 12 * len(n) for n, _ in made], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    numbered = queries.select(F.monotonically_increasing_id().alias("number"), F.col("doc_id").cast("long"), "text")
    return written(bounded(numbered).mapInArrow(run, schema), "topk-queries")


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, doc_id, score) for the rows (doc_id, text) of ``queries``."""
    spark = index.sparkSession
    n, words = index.agg(F.sum("n"), F.sum("words")).first()
    n, mean = n or 0, max(1.0, (words or 0) / max(1, n or 0))
    vectors = _vectors(queries)
    taken = vectors.agg(F.sum("bytes")).first()[0] or 0
    # hashed numbers fill the parts evenly: a half of QUERY_BYTES on average
    parts = max(1, -(-taken // (QUERY_BYTES // 2)))
    at = f"{shared_dir(spark)}/topk-found-{uuid.uuid4().hex}"
    for part in range(parts):
        rows = vectors.filter(F.pmod(F.xxhash64("number"), F.lit(parts)) == part).select("number", "doc_id", "terms", "counts").toArrow()
        # like queries side by side, as documents stand in a shard
        names, counts = ([np.frombuffer(x, kind) for x in rows.column(c).to_pylist()] for c, kind in (("terms", np.uint64), ("counts", np.int32)))
        rows = rows.take(pa.array(_alike(names, counts, [int(c.sum()) for c in counts]), pa.int64()))
        _search_part(index, rows, n, mean, k).write.mode("append").parquet(at)
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), "doc_id")
    out = spark.read.schema(_FOUND).parquet(at).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"), F.round("score", 6).alias("score"))


_FOUND = "number long, query_id long, doc_id long, score double"


def _search_part(index: DataFrame, rows: pa.Table, n: int, mean: float, k: int) -> DataFrame:
    """Every shard's best k for each of the queries (number, doc_id, terms, counts)."""
    context = index.sparkSession.sparkContext
    flat = np.frombuffer(b"".join(rows.column("terms").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.int32)
    starts = np.concatenate(([0], np.cumsum([len(t) // 8 for t in rows.column("terms").to_pylist()], dtype=np.int64)))
    names, terms = np.unique(flat, return_inverse=True)
    shared_names = context.broadcast(names)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared_names.value
        df = np.zeros(len(names), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own, starts = _arrays(batch, row, "terms", "starts")
                if len(own):
                    at = np.minimum(np.searchsorted(own, names), len(own) - 1)
                    df += np.where(own[at] == names, np.diff(starts)[at], 0)
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(df[has], pa.int64())], names=["term", "df"])

    counted = index.select("terms", "starts").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(names), np.int64)
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    shared = context.broadcast(tuple(Asked(rows.column("number").to_numpy(), rows.column("doc_id").to_pylist(), starts, names, terms.astype(np.int32), counts * idf[terms])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Asked(*shared.value)
        best: list[list[tuple[float, int]]] = [[] for _ in asked.own]
        for batch in batches:
            for row in range(batch.num_rows):
                Shard(*_arrays(batch, row, *_ARRAYS), mean).search_all(asked, best, k)
        for at in range(0, len(best), 1_000):
            found = [(q, own, i, -s) for q, own, held in zip(asked.number[at : at + 1_000].tolist(), asked.own[at : at + 1_000], best[at : at + 1_000], strict=True) for s, i in held]
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.float64())], names=["number", "query_id", "doc_id", "score"])

    # several shards for each task: what it has found prunes the next ones
    tasks = max(1, 2 * context.defaultParallelism)
    return index.select(*_ARRAYS).coalesce(tasks).mapInArrow(lambda batches: released(run(batches)), _FOUND)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(build(docs), docs.filter(F.col("doc_id") % EVERY == 0))
