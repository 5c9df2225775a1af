"""Line deduplication with levelled sorted runs of line hashes.

A run is a table (h1, h2, n, keeper) sorted by a 128-bit line hash: the number of
documents that hold the line and the largest doc_id among them.  ``LineRuns``
takes batches of documents in descending order of doc_id.  A new batch is
merge-anti-joined with the runs: a line that no run has is fresh, and its keeper
is in this batch; for a line that a run has the batch only adds to the count.
Both become the batch's own run on level 0.  When a level has ``FANOUT`` runs
they are merged into one run of the next level.

A key is the line without ASCII white space at both ends, A-Z lower-cased.  Keys
of at least ``LEAST_CHARS`` code points held by at least ``LEAST_DOCS`` documents
lose all their lines but those of the keeper.  A null or empty text is one empty
line.  Each row is a document: repeated rows count separately, and rows that
share the keeper's doc_id all keep the line; a null doc_id is below every other.  Texts of any
length are split whole.  An empty table gives an empty result; further columns pass
through ``apply``, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from layoutlake.llm.common import drop_written, fresh, map_batches, small, table, written

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 4
FANOUT = 3
SPACE = " \t\n\x0b\x0c\r"
LOWEST = -(1 << 63)
_LOWER = {c: c + 32 for c in range(65, 91)}


def key(line: str) -> str:
    line = line.strip(SPACE)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def hash_key(k: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(k.encode())
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2): each long key of each document once."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids: list[int] = []
            first: list[int] = []
            second: list[int] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                keys = {k for line in (text or "").split("\n") if len(line) >= LEAST_CHARS and len(k := key(line)) >= LEAST_CHARS}
                for k in keys:
                    a, b = hash_key(k)
                    ids.append(LOWEST if doc_id is None else doc_id)
                    first.append(a)
                    second.append(b)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["doc_id", "h1", "h2"])

        return each

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, h1 long, h2 long")


class LineRuns:
    """Levels of sorted runs; ``add`` takes batches in descending order of doc_id."""

    def __init__(self) -> None:
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, hashes: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, h1, h2) and return its run."""
        own = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        if runs := self.runs():
            seen = _union(runs).select("h1", "h2")
            fresh = own.join(seen, ["h1", "h2"], "left_anti")
            known = own.join(seen, ["h1", "h2"], "left_semi").withColumn("keeper", F.lit(None).cast("long"))
            own = fresh.unionByName(known)
        run = written(own.sortWithinPartitions("h1", "h2"), "line-run")
        self._put(0, run)
        return run

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FANOUT:
            old, self.levels[level] = self.levels[level], []
            merged = written(_merged(old).sortWithinPartitions("h1", "h2"), "line-run")
            drop_written(*old)
            self._put(level + 1, merged)

    def merged(self) -> DataFrame:
        return _merged(self.runs())


def _union(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


def _merged(runs: list[DataFrame]) -> DataFrame:
    return _union(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))


def drops(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, dropped): per document the hashes of the lines that it loses."""
    spark = docs.sparkSession
    bounds = docs.select(F.col("doc_id").cast("long").alias("doc_id")).approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01)
    batch = F.lit(0)
    for bound in sorted(set(bounds)):
        batch = batch + F.when(F.col("doc_id") <= int(bound), 1).otherwise(0)
    hashes = written(line_hashes(docs).withColumn("batch", batch), "line-hashes", "batch")
    runs = LineRuns()
    for k in range(len(set(bounds)) + 1):
        runs.add(hashes.filter(F.col("batch") == k).drop("batch"))
    often = written(runs.merged().filter(F.col("n") >= LEAST_DOCS), "line-often")
    drop_written(*runs.runs())
    lost = hashes.join(small(often), ["h1", "h2"]).filter(F.col("doc_id") != F.col("keeper"))
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("dropped"))


def apply(docs: DataFrame, dropped: DataFrame, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines and, with ``counts``, n_lines and n_dropped.

    A text that loses all its lines becomes empty; a null one without loss stays null.
    Columns of ``docs`` pass through; n_lines and n_dropped are replaced if they are added.
    """
    new = ("n_lines", "n_dropped") if counts else ()
    kept = [c for c in docs.columns if c not in new]
    own, lost_lines = fresh(docs, "its_doc"), fresh(docs, "lost_lines")
    lost = dropped.select(F.col("doc_id").alias(own), F.col("dropped").alias(lost_lines))
    both = docs.select(kept).join(lost, F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)) == F.col(own), "left").drop(own)
    schema = StructType([docs.schema[c] for c in kept])
    for c in new:
        schema = schema.add(c, LongType())

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, n, gone = [], [], []
            for text, lost in zip(batch.column("text").to_pylist(), batch.column(lost_lines).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                n.append(len(lines))
                if lost:
                    hashes = {(x["h1"], x["h2"]) for x in lost}
                    stay = [line for line in lines if len(line) < LEAST_CHARS or len(k := key(line)) < LEAST_CHARS or hash_key(k) not in hashes]
                    gone.append(len(lines) - len(stay))
                    text = "\n".join(stay)
                else:
                    gone.append(0)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in kept]
            if counts:
                columns += [pa.array(n, pa.int64()), pa.array(gone, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

        return each

    return map_batches(both, make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply(docs, drops(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), often AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), flagged AS (
  SELECT a.doc_id, a.line, a.pos, (o.k IS NOT NULL AND a.doc_id <> o.keeper) AS gone FROM keyed a LEFT JOIN often o ON a.k = o.k
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
