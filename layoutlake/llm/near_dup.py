"""Near-duplicate documents by circulant MinHash, exact verification and components.

A document's set has its distinct shingles of five words (lower-cased A-Z).  Two
permutations give all signature coordinates: the first sends a shingle to a slot
of a universe of 2**22, coordinate k is the least value of the second permutation
over the set's slots, shifted circularly by k.  The second permutation is a table,
so the coordinates of a shingle are a contiguous slice of it.

Exact copies of a set are reduced to one node first.  Bands of five
coordinates are buckets: two sets with similarity 0.75 share none of 48 buckets
with probability 2e-6.  Work in a bucket stays linear in its members:

1. Each bucket's centre is its member that shares most buckets with others.  The
   members are verified against their centres on full sets, and links joined.
2. Members of a bucket that are in different components then are compared by an
   exact prefix and position filter: shingles are ordered from rare to common, and
   sets with similarity 0.75 share one of the first n - ceil(0.75 n) + 1.  So a set
   with many shingles of its own meets nobody, and no link is lost.

Links found are verified on full sets; components come from repeated minimum
labels with pointer jumping.  A null or wordless text has an empty set and no
links; a text of one to four words has one shingle, its whole sequence; texts of
any length are taken whole.  Each row is a document with its own text, whatever its
doc_id: rows that share an id aren't linked by it, and rows without an id take part
(a class of such rows alone has no component_id).  An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import drop_written, fresh, map_batches, small, table, written

WORDS = 5
BANDS = 48
ROWS = 5
SLOTS = 1 << 22
SEED = 11
#: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Words kept with their hashes in a task; beyond it the store starts afresh.
STORE_WORDS = 200_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    def __init__(self) -> None:
        self.store: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The distinct shingles' hashes of each text, ascending."""
        store = self.store
        if len(store) > STORE_WORDS:
            store.clear()
        out = []
        for text in texts:
            words = (text or "").encode().lower().split()
            if not words:
                out.append(np.empty(0, np.uint64))
                continue
            for w in words:
                if w not in store:
                    store[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([store[w] for w in words], np.uint64)
            n = max(1, len(h) - WORDS + 1)
            wide = min(WORDS, len(h))
            with np.errstate(over="ignore"):
                s = np.full(n, wide, np.uint64)
                for k in range(wide):
                    s = _mix(s * _MIX[0] + h[k : k + n])
            out.append(np.unique(s))
        return out


@lru_cache(maxsize=1)
def _circle() -> np.ndarray:
    """The second permutation's values in circular order, as overlapping slices."""
    values = np.random.default_rng(SEED).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((values, values[: BANDS * ROWS])), BANDS * ROWS)


def signature(shingles: np.ndarray) -> np.ndarray:
    circle = _circle()
    slots = (_mix(shingles ^ _MIX[0]) >> np.uint64(64 - 22)).astype(np.int64)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(slots), 2048):
        least = np.minimum(least, circle[slots[at : at + 2048]].min(axis=0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = least.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            keys = _mix(keys * _MIX[0] + bands[:, k])
    return keys.view(np.int64)


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(s.tobytes())
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, h1, h2, bands): set size, hash of the set, band keys."""

    def make():
        shingler = Shingler()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, first, second, bands = [], [], [], []
            for s in shingler.sets(batch.column("text").to_pylist()):
                a, b = _set_hash(s)
                n.append(len(s))
                first.append(a)
                second.append(b)
                bands.append(band_keys(signature(s)) if len(s) else np.empty(0, np.int64))
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(b) for b in bands]))).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], names=["doc_id", "text_key", "n", "h1", "h2", "bands"])

        return each

    return map_batches(_keyed(docs), make, "doc_id long, text_key long, n long, h1 long, h2 long, bands array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node, doc_id, text_key, h1, h2)."""

    def make():
        shingler = Shingler()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingler.sets(batch.column("text").to_pylist())
            # another text can have the same key only by chance
            own = [k for k, (s, a, b) in enumerate(zip(sets, batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True)) if _set_hash(s) == (a, b)]
            sets = [sets[k] for k in own]
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(own, pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], names=["node", "shingles"])

        return each

    named = small(wanted).select("node", F.col("doc_id").alias("its_doc"), F.col("text_key").alias("its_key"), "h1", "h2")
    texts = _keyed(docs).join(named, (F.col("text_key") == F.col("its_key")) & F.col("doc_id").eqNullSafe(F.col("its_doc")))
    # repeated rows give a node's set more than once
    return map_batches(texts.select("node", "h1", "h2", "text"), make, "node long, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * shared >= SIMILAR * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach.

    Every round takes the least label of a node's neighbours and then the label's
    own label, so long chains need few rounds.
    """
    labels = written(nodes.select("node", F.col("node").alias("component")), "near-labels")
    if links.isEmpty():
        return labels
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-links")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        step = labels.join(heard, "node", "left").select("node", F.col("component").alias("old"), F.least("component", F.coalesce("heard", "component")).alias("mid"))
        step = written(step, "near-step")
        # the label's own label, which may have become smaller in the same round
        jump = step.filter(F.col("mid") != F.col("old")).select(F.col("node").alias("mid"), F.col("mid").alias("further"))
        following = written(step.join(jump, "mid", "left").select("node", F.coalesce("further", "mid").alias("component"), "old"), "near-labels")
        changed = not following.filter(F.col("component") != F.col("old")).isEmpty()
        drop_written(labels, step)
        labels = following.drop("old")
        if not changed:
            return labels


def _bucket_pairs(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs of members in different components of a bucket, by an exact prefix filter."""
    placed = members.join(labels, "node")
    split = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket")
    open_ = written(placed.join(split, "bucket").select("node", "component").distinct(), "near-open")
    rows = sets.join(open_, "node").select("node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    rows = written(rows, "near-shingles")
    common = rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    common = written(common, "near-df")
    # a set's shingles from rare to common; a partner shares one of the first of them
    longest = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1
    ranked = rows.join(common, "shingle").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle", "low", "high"))).alias("s"))
    heads = ranked.select("node", "component", "n", F.posexplode(F.slice("s", F.lit(1), longest.cast("int"))).alias("pos", "s"))
    # shingles within one component find no new link
    heads = written(heads.filter("s.df > 1 and s.low <> s.high").select("node", "component", "n", "pos", F.col("s.shingle").alias("shingle")), "near-heads")
    # overlap is at least t/(1+t) (n + n'), so the smaller set needs a shorter prefix
    share = SIMILAR / (100 + SIMILAR)
    left = heads.filter(F.col("pos") <= F.col("n") - F.ceil(2 * share * F.col("n") - 1e-9)).withColumnRenamed("node", "a")
    right = heads.select(F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("pos").alias("pb"), "shingle")
    larger = (F.col("n") < F.col("nb")) | (F.col("n") == F.col("nb")) & (F.col("a") < F.col("b"))
    enough = F.least(F.col("n") - F.col("pos"), F.col("nb") - F.col("pb")) >= share * (F.col("n") + F.col("nb")) - 1e-9
    pairs = left.join(right, "shingle").filter((F.col("component") != F.col("cb")) & larger & enough & (100 * F.col("n") >= SIMILAR * F.col("nb")))
    return pairs.select("a", "b").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, n_shingles, component, component_id.

    ``component`` names the class (null for an empty set), ``component_id`` is its smallest doc_id.
    """
    sketched = written(sketches(docs), "near-sketches")
    # a node is a set; the row with the least id that has it stands for it
    sets_ = sketched.filter("n > 0").groupBy("h1", "h2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("one"))
    copies = written(sets_.select(F.monotonically_increasing_id().alias("node"), "one.doc_id", "one.text_key", "h1", "h2"), "near-copies")
    # band keys of the nodes, one row for each bucket
    named = copies.select("node", F.col("doc_id").alias("its_doc"), F.col("text_key").alias("its_key"), "h1", "h2")
    own = sketched.join(named, ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("its_doc")) & (F.col("text_key") == F.col("its_key"))).select("node", "bands").dropDuplicates(["node"])
    members = own.select("node", F.explode("bands").alias("bucket"))
    members = written(members, "near-members")
    shared = members.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members2 = written(members.join(shared, "bucket"), "near-shared")
    drop_written(members)
    # the member that shares most is the centre of its buckets
    weight = members2.groupBy("node").agg(F.sum("m").alias("weight"))
    weighed = members2.join(weight, "node")
    centre = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("c"))
    stars = members2.join(centre.select("bucket", (-F.col("c.minus")).alias("b")), "bucket").filter(F.col("node") != F.col("b"))
    stars = written(stars.select(F.col("node").alias("a"), "b").distinct(), "near-stars")
    nodes = written(copies.join(members2.select("node").distinct(), "node", "left_semi"), "near-nodes")
    sets = written(_full_sets(docs, nodes).dropDuplicates(["node"]), "near-sets")
    links = written(_verified(stars, sets), "near-links")
    labels = components(nodes, links)
    more = written(_verified(_bucket_pairs(members2.select("bucket", "node"), labels, sets), sets), "near-links")
    if not more.isEmpty():
        labels = components(nodes, links.union(more))
    reach = copies.join(labels, "node", "left").select("h1", "h2", "doc_id", F.coalesce("component", "node").alias("component"))
    least = reach.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    reach = written(reach.join(least, "component").select("h1", "h2", "component", "component_id"), "near-reach")
    drop_written(members2, stars, nodes, sets, links, more, labels, copies)
    out = sketched.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "h1", "h2").join(reach, ["h1", "h2"], "left")
    return out.select("doc_id", "text_key", "n_shingles", "component", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id; rows without words all stay."""
    found = written(classes(docs), "near-classes").filter("component is not null")
    chosen = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("one"))
    times = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("m"))
    keys = chosen.select("one.doc_id", "one.text_key").join(times.withColumnsRenamed({"doc_id": "d", "text_key": "k"}), (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    doc, key, many = (fresh(docs, c) for c in ("near_doc", "near_key", "near_times"))
    keys = written(keys.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("m").alias(many)), "near-kept")
    here = (F.xxhash64("text") == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.join(small(keys), here, "left").filter(F.col(key).isNotNull() | wordless)
    once = kept.filter(F.coalesce(many, F.lit(1)) == 1).select(docs.columns)
    if keys.filter(F.col(many) > 1).isEmpty():
        return once
    return once.unionByName(kept.filter(F.col(many) > 1).dropDuplicates([doc, key]).select(docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
