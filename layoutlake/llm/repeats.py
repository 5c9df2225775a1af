"""Removal of long repeated byte strings by sparse suffix sorting.

Every byte that a WINDOW-byte string covers which also starts anywhere else goes
(same document included, overlaps count; strings never cross documents).

Anchors.  A winnowing rule picks, in every window of WINDOW bytes, the q-grams
(q = GRAM) of least hash; equal windows pick the same ones.  So two equal windows
share an anchor with equal surroundings.  A shuffle of anchors' hashes leaves the
repeated ones; with them the hash of the anchor's context (the WINDOW - GRAM bytes
before it and after it, cut at the document's ends), so that equal contexts are
counted, not compared.

Sorting.  The distinct contexts of an anchor are sorted by what follows the
anchor, and by what precedes it read backwards, with deep-shallow sorting:
multikey quicksort on SHALLOW bytes, then a blind trie for every group that still
ties.  Neighbours' common prefixes then tell for each context, how many of its
windows another context has: window with a bytes before the anchor is repeated if
some other context agrees on a bytes before and WINDOW - GRAM - a bytes after.

Groups with more than GROUP contexts are not taken into one task: they are split
by a longer key (half of the open bytes before or after the anchor), which every
repeated window of the group has in common with its partner, again and again
until groups are small or keys are whole windows, whose equality is decided by
counting alone (by two 64-bit hashes).

Texts are UTF-8 bytes (null: none) of any length.  Each row is a document; repeated
rows repeat each other.  Texts shorter than WINDOW lose nothing.  An empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import bounded, drop_written, map_batches, released, table, written

WINDOW = 400
GRAM = 256
SIDE = WINDOW - GRAM
SHALLOW = 32
#: Contexts of an anchor that one task sorts together (about 4 MB); more are split by longer keys.
GROUP = 8_192

_B = np.uint64(0x5851F42D4C957F2D)
_M = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(_B), -1, 1 << 64)
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _B)))), np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, np.uint64(inverse)))))


class Hashes:
    """Hashes of any substring of a text from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][: len(data)])))
        self.inverse = powers[1]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (self.sums[stop] - self.sums[start]) * self.inverse[start]
            x = (x ^ (x >> np.uint64(30))) * _M[0]
            x = (x ^ (x >> np.uint64(27))) * _M[1]
        return x ^ (x >> np.uint64(31))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` consecutive values, by block prefixes and suffixes."""
    n = len(x) - width + 1
    pad = -len(x) % width
    fill = np.uint64(0xFFFFFFFFFFFFFFFF) if pick is np.minimum else np.uint64(0)
    blocks = np.concatenate((x, np.full(pad, fill))).reshape(-1, width)
    before = pick.accumulate(blocks, axis=1).ravel()
    after = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(after[:n], before[width - 1 : width - 1 + n])


def anchors(hashes: Hashes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the q-grams that some window of the text picks."""
    if n < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    starts = np.arange(n - GRAM + 1)
    grams = hashes.of(starts, starts + GRAM)
    least = _sliding(grams, SIDE + 1, np.minimum)
    # a q-gram is picked if it equals the least of a window that holds it
    spread = np.concatenate((np.zeros(SIDE, np.uint64), least, np.zeros(SIDE, np.uint64)))
    places = np.flatnonzero(_sliding(spread, SIDE + 1, np.maximum) == grams)
    return places, grams[places]


class _Texts:
    """Per task: powers long enough for the texts seen so far."""

    def __init__(self) -> None:
        self.powers = _powers(1 << 16)

    def hashes(self, raw: bytes) -> tuple[np.ndarray, Hashes]:
        if len(raw) >= len(self.powers[0]):
            self.powers = _powers(2 * len(raw))
        data = np.frombuffer(raw, np.uint8)
        return data, Hashes(data, self.powers)


def _contexts(h: Hashes, places: np.ndarray, n: int) -> np.ndarray:
    """A hash of each anchor's context; it differs where a document's end cuts it."""
    low, high = np.maximum(places - SIDE, 0), np.minimum(places + WINDOW, n)
    with np.errstate(over="ignore"):
        return h.of(low, high) * _M[0] ^ ((places - low) * 1024 + high - places).astype(np.uint64) * _M[1]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(row_id, place, gram, context) of every anchor; ``docs`` has (row_id, text)."""

    def make():
        texts = _Texts()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, places, grams, contexts = [], [], [], []
            for row_id, text in zip(batch.column("row_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = (text or "").encode()
                if len(raw) < WINDOW:
                    continue
                _, h = texts.hashes(raw)
                p, g = anchors(h, len(raw))
                ids.append(np.full(len(p), row_id))
                places.append(p)
                grams.append(g)
                contexts.append(_contexts(h, p, len(raw)))
            cat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
            return pa.RecordBatch.from_arrays([pa.array(cat(ids, np.int64), pa.int64()), pa.array(cat(places, np.int64).astype(np.int32)), pa.array(cat(grams, np.uint64).view(np.int64)), pa.array(cat(contexts, np.uint64).view(np.int64))], names=["row_id", "place", "gram", "context"])

        return each

    return map_batches(docs.select("row_id", "text"), make, "row_id long, place int, gram long, context long")


# ---- deep-shallow sorting ----


def multikey_quicksort(strings: list[bytes], order: list[int], depth: int, limit: int) -> list[list[int]]:
    """Groups of ``order`` in ascending order; a group agrees on ``limit`` bytes or is one string."""
    done: list[list[int]] = []
    stack = [(order, depth)]
    while stack:
        rows, d = stack.pop()
        if len(rows) < 2 or d >= limit:
            done.append(rows)
            continue
        pivot = strings[rows[len(rows) // 2]][d : d + 1]
        low, same, high = [], [], []
        for i in rows:
            c = strings[i][d : d + 1]
            (low if c < pivot else high if c > pivot else same).append(i)
        # taken from the stack's end: low, then same, then high
        if high:
            stack.append((high, d))
        stack.append((same, d + 1) if pivot else (same, limit))
        if low:
            stack.append((low, d))
    return done


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that ``known`` bytes agree."""
    top = min(len(a), len(b))
    if a[known:top] == b[known:top]:
        return top
    low, high = known, top  # agrees up to low, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Strings in a trie that keeps only where they branch, each on one byte."""

    __slots__ = ("strings", "root")

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None  # a leaf is [index]; a node is (depth, {byte: child})

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        path, node = [], self.root
        while isinstance(node, tuple):  # blindly down by the branching bytes
            path.append(node)
            node = node[1].get(s[node[0] : node[0] + 1]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        agree = common_prefix(s, other)
        if agree == len(s) == len(other):
            node.append(i)
            return
        parent = None
        node = self.root
        for step in path:  # where the paths part
            if step[0] >= agree:
                break
            parent, node = step, step[1].get(s[step[0] : step[0] + 1])
            if node is None:
                break
        if node is not None and isinstance(node, tuple) and node[0] == agree:
            node[1][s[agree : agree + 1]] = [i]
        elif node is None:
            parent[1][s[parent[0] : parent[0] + 1]] = [i]
        else:
            split = (agree, {other[agree : agree + 1]: node, s[agree : agree + 1]: [i]})
            if parent is None:
                self.root = split
            else:
                parent[1][s[parent[0] : parent[0] + 1]] = split

    def ordered(self) -> list[int]:
        out: list[int] = []
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow_sort(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings and the common prefix of each with the one before it."""
    order: list[int] = []
    for group in multikey_quicksort(strings, list(range(len(strings))), 0, SHALLOW):
        if len(group) > 1:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            group = trie.ordered()
        order += group
    return order, [0, *(common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False))]


def repeated_offsets(before: list[bytes], after: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each context the ranges of a (bytes before the anchor) whose window another one has.

    ``before`` is read backwards from the anchor, ``after`` starts behind the q-gram.
    """
    m = len(before)
    if m == 2:
        low, high = SIDE - common_prefix(*after), common_prefix(*before)
        both = [(low, high)] if low <= high else []
        return [both, both]
    right, _ = deep_shallow_sort(after)
    rank = [0] * m
    for k, i in enumerate(right):
        rank[i] = k
    left, left_lcp = deep_shallow_sort(before)
    found: list[list[tuple[int, int]]] = [[] for _ in range(m)]

    def mark(x: int, y: int, depth: int) -> None:
        """Ranks x and y agree on ``depth`` bytes before the anchor."""
        low = SIDE - common_prefix(after[right[x]], after[right[y]])
        if low <= depth:
            found[right[x]].append((low, depth))
            found[right[y]].append((low, depth))

    def merge(one: list[int], other: list[int], depth: int) -> list[int]:
        """Both rank lists as one.  Pairs that were neighbours before agree on more bytes already."""
        if len(one) < len(other):
            one, other = other, one
        for r in other:
            k = bisect(one, r)
            if k:
                mark(one[k - 1], r, depth)
            if k < len(one):
                mark(r, one[k], depth)
            one.insert(k, r)
        return one

    # The tree of common prefixes of ``left``: open nodes from the root down, with their ranks.
    stack: list[tuple[int, list[int]]] = []
    rows = [rank[left[0]]] if m else []
    for k in range(1, m):
        depth = left_lcp[k]
        while stack and stack[-1][0] >= depth:
            below, more = stack.pop()
            rows = merge(more, rows, below)
        stack.append((depth, rows))
        rows = [rank[left[k]]]
    while stack:
        below, more = stack.pop()
        rows = merge(more, rows, below)
    return [_union(r) for r in found]


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


# ---- the distributed steps ----


def _with_context(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, context, large, b, a): bytes before (backwards) and after the q-gram; ``wanted`` has (row_id, at)."""
    both = docs.select("row_id", "text").join(wanted, "row_id")

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            grams, contexts, large, b, a = [], [], [], [], []
            for text, at in zip(batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True):
                raw = text.encode()
                for x in at:
                    p = x["place"]
                    grams.append(x["gram"])
                    contexts.append(x["context"])
                    large.append(x["large"])
                    b.append(raw[max(0, p - SIDE) : p][::-1])
                    a.append(raw[p + GRAM : p + WINDOW])
            return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(contexts, pa.int64()), pa.array(large, pa.bool_()), pa.array(b, pa.binary()), pa.array(a, pa.binary())], names=["gram", "context", "large", "b", "a"])

        return each

    return map_batches(both.select("text", "at"), make, "gram long, context long, large boolean, b binary, a binary")


_FOUND = "gram long, context long, low int, high int"
_SORTED = ("gram", "key", "context", "b", "a")


def _groups_found(columns: list[list]) -> pa.RecordBatch:
    """The repeated ranges of whole groups of at most GROUP contexts; rows stand by (gram, key)."""
    gram, key, context, b, a = columns
    out: tuple[list, ...] = ([], [], [], [])
    start, n = 0, len(gram)
    while start < n:
        stop = start + 1
        while stop < n and key[stop] == key[start] and gram[stop] == gram[start]:
            stop += 1
        # the same context twice would be its own partner
        rows = list({context[k]: k for k in range(start, stop)}.values())
        if len(rows) > 1:
            for k, ranges in zip(rows, repeated_offsets([b[k] for k in rows], [a[k] for k in rows]), strict=True):
                for low, high in ranges:
                    for values, v in zip(out, (gram[k], context[k], low, high), strict=True):
                        values.append(v)
        start = stop
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=["gram", "context", "low", "high"])


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kernel over rows sorted by (gram, key); a group may cross batches."""
    held: list[list] = [[] for _ in _SORTED]
    for batch in batches:
        for own, name in zip(held, _SORTED, strict=True):
            own += batch.column(name).to_pylist()
        n = len(held[0])
        cut = n - 1  # where the last group begins
        while cut > 0 and held[0][cut - 1] == held[0][-1] and held[1][cut - 1] == held[1][-1]:
            cut -= 1
        if n and cut:
            yield _groups_found([own[:cut] for own in held])
            held = [own[cut:] for own in held]
    yield _groups_found(held)


def _sorted_found(rows: DataFrame, parts: int) -> DataFrame:
    """The ranges found in groups of (gram, key), each of which fits into a task."""
    # a fixed number: few bytes take long here, so Spark isn't to join partitions
    dealt = rows.select(*_SORTED).repartition(parts, "gram", "key").sortWithinPartitions("gram", "key")
    return written(bounded(dealt).mapInArrow(lambda batches: released(_sort_groups(batches)), _FOUND), "repeat-found")


def _split(rows: DataFrame) -> DataFrame:
    """Two rows for each: its window has half of the open bytes before or after the known ones.

    ``known_b`` and ``known_a`` are the bytes before and after the q-gram that ``key``
    covers; the half rounds up, so one of both keys is part of every window.
    """
    half = F.ceil((SIDE - F.col("known_b") - F.col("known_a")) / 2).cast("int")
    longer = F.array(F.struct((F.col("known_b") + half).alias("kb"), F.col("known_a").alias("ka")), F.struct(F.col("known_b").alias("kb"), (F.col("known_a") + half).alias("ka")))
    out = rows.withColumn("next", F.explode(longer)).filter((F.length("b") >= F.col("next.kb")) & (F.length("a") >= F.col("next.ka")))
    # binary substring; a group is named by the q-gram's hash and this one, 128 bits
    key = F.xxhash64("next.kb", "next.ka", F.expr("substring(b, 1, next.kb)"), F.expr("substring(a, 1, next.ka)"))
    return out.select("gram", "context", "b", "a", F.col("next.kb").alias("known_b"), F.col("next.ka").alias("known_a"), key.alias("key"))


def _repeated(contexts: DataFrame) -> DataFrame:
    """(gram, context, low, high) from the distinct contexts of anchors that have several.

    ``large`` marks the contexts of anchors that have more than GROUP of them.
    """
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = [_sorted_found(contexts.filter(~F.col("large")).withColumn("key", F.lit(0).cast("long")), parts)]
    large = contexts.filter("large")
    if large.isEmpty():
        return out[0]
    rows = written(_split(large.withColumns({"known_b": F.lit(0), "known_a": F.lit(0)})), "repeat-rows")
    while True:
        # a context may come to one key by two ways: it counts once
        kinds = rows.groupBy("gram", "key").agg(F.count("*").alias("m"), F.min("context").alias("low"), F.max("context").alias("high"))
        sizes = written(kinds.filter("low <> high").select("gram", "key", "m"), "repeat-sizes")
        out.append(_sorted_found(rows.join(sizes.filter(F.col("m") <= GROUP), ["gram", "key"]), parts))
        many = sizes.filter(F.col("m") > GROUP)
        if many.isEmpty():
            drop_written(rows, sizes)
            break
        open_ = rows.join(many, ["gram", "key"]).drop("m")
        # keys of whole windows: being in a group of several decides
        whole = open_.filter(F.col("known_b") + F.col("known_a") >= SIDE)
        out.append(written(whole.select("gram", "context", F.col("known_b").alias("low"), F.col("known_b").alias("high")), "repeat-found"))
        following = written(_split(open_.filter(F.col("known_b") + F.col("known_a") < SIDE)), "repeat-rows")
        drop_written(rows, sizes)  # only one level's bytes stay on disk
        rows = following
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def spans(docs: DataFrame) -> DataFrame:
    """(row_id, at): per document its repeated anchors with their ranges of a; a written table."""
    rows = written(anchor_rows(docs), "repeat-anchors")
    repeated = rows.groupBy("gram").agg(F.count("*").alias("total")).filter("total > 1").select("gram")
    hits = written(rows.join(repeated, "gram", "left_semi").select("row_id", "place", "gram", "context"), "repeat-hits")
    drop_written(rows)
    by_context = written(hits.groupBy("gram", "context").agg(F.count("*").alias("m"), F.min(F.struct("row_id", "place")).alias("one")), "repeat-contexts")
    kinds = by_context.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    several = by_context.join(kinds, "gram").select("gram", "context", "one.*", (F.col("kinds") > GROUP).alias("large"))
    wanted = several.groupBy("row_id").agg(F.collect_list(F.struct("place", "gram", "context", "large")).alias("at"))
    # a context comes more than once only from rows that share their id and text
    bytes_ = written(_with_context(docs, wanted), "repeat-bytes")
    found = _repeated(bytes_)
    # a context that occurs twice repeats all its windows; the document's ends cut it where ``of`` is applied
    whole = by_context.filter("m > 1").select("gram", "context", F.lit(0).alias("low"), F.lit(SIDE).alias("high"))
    ranges = found.unionByName(whole).groupBy("gram", "context").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    ranges = written(ranges, "repeat-ranges")
    drop_written(bytes_, by_context, found)
    hit = hits.join(ranges, ["gram", "context"])
    out = written(hit.groupBy("row_id").agg(F.collect_list(F.struct("place", "ranges")).alias("at")), "repeat-spans")
    drop_written(hits, ranges)
    return out


def covered(n: int, at: list) -> list[tuple[int, int]]:
    """Maximal removed runs [start, stop) of a text of ``n`` bytes."""
    runs = []
    for x in at:
        p = x["place"]
        for r in x["ranges"]:
            # window [p - a, p - a + WINDOW) for a from low to high, inside the text
            low, high = max(r["low"], p + WINDOW - n), min(r["high"], p)
            if low <= high:
                runs.append((p - high, p - low + WINDOW))
    runs.sort()
    out: list[tuple[int, int]] = []
    for start, stop in runs:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def apply(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of each row of ``docs``."""
    # rows that share an id and a text share their spans
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row_id", F.xxhash64("doc_id", "text"))
    both = rows.join(spans(rows), "row_id", "left")

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, gone, parts, kept = [], [], [], []
            for text, at in zip(batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True):
                raw = (text or "").encode()
                runs = covered(len(raw), at or [])
                n.append(len(raw))
                gone.append(sum(b - a for a, b in runs))
                parts.append(len(runs))
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(parts, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

        return each

    return map_batches(both.select("doc_id", "text", "at"), make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
