"""Line, near-duplicate and repeated-string removal against brute force; mixing; search."""

import collections
import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from layoutlake.llm import line_runs, mixing, near_dup, repeats, top_k

RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def test_lines(spark):
    shared = [prose(12) for _ in range(4)]
    texts = [f"{prose(9)}\n {shared[0].upper()}\t\n{shared[i % 4]}\n{shared[0]}" for i in range(20)] + [None, "", "short\nshort", shared[0]] + [f"{shared[3]}\n"] * 3
    df = frame(spark, texts)
    keys = lambda t: [line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for line in (t or "").split("\n")]
    holders = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for k in keys(t):
            if len(k) >= 40:
                holders[k].add(i)
    out = {r.doc_id: r for r in line_runs.apply(df, line_runs.drops(df)).collect()}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        stay = [x for x, k in zip(lines, keys(t), strict=True) if len(holders[k]) < 5 or max(holders[k]) == i]
        assert (out[i].n_lines, out[i].n_dropped, out[i].text or "") == (len(lines), len(lines) - len(stay), "\n".join(stay))
    assert line_runs.apply(df.limit(0), line_runs.drops(df.limit(0))).count() == 0


def test_levels_compact(spark):
    runs = line_runs.LineRuns()
    for k in range(7):
        runs.add(spark.createDataFrame([(100 - k, 1, 1), (100 - k, 2, k)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 2]
    merged = {(r.h1, r.h2): (r.n, r.keeper) for r in runs.merged().collect()}
    assert merged[1, 1] == (7, 100) and merged[2, 3] == (1, 97)


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def test_near_duplicates(spark):
    base = [prose(120).split() for _ in range(3)]
    texts = [" ".join(b) for b in base] + [None, "", "one two", "One  TWO", "one two three"]
    for _ in range(60):
        w = list(RNG.choice(base))
        for _ in range(RNG.randint(0, 7)):
            w[RNG.randrange(len(w))] = RNG.choice(WORDS)
        texts.append(" ".join(w))
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        n = len(sets[i] & sets[j])
        if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    out = {r.doc_id: r for r in near_dup.classes(frame(spark, texts)).collect()}
    assert [out[i].component_id for i in range(len(texts))] == [find(i) for i in range(len(texts))]
    assert [out[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert near_dup.classes(frame(spark, texts).limit(0)).count() == 0


def brute_repeats(texts):
    count = collections.Counter(x[i : i + 400] for x in texts for i in range(len(x) - 399))
    for x in texts:
        cover = bytearray(len(x))
        for i in range(len(x) - 399):
            if count[x[i : i + 400]] > 1:
                cover[i : i + 400] = b"\1" * 400
        spans = sum(1 for v, _ in itertools.groupby(cover) if v)
        yield len(x), sum(cover), spans, hashlib.sha256(bytes(c for c, v in zip(x, cover, strict=True) if not v)).hexdigest()


@pytest.mark.parametrize("group", [2, 256])
def test_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    passages = [prose(90) for _ in range(3)]
    texts = [prose(60) + passages[i % 3] + prose(RNG.randint(0, 50)) for i in range(15)] + ["a" * 1500, "ab" * 900, prose(200)] + [passages[0][:420]] * 3 + ["x", "", None]
    for _ in range(6):
        t = list(texts[3])
        t[RNG.randrange(len(t))] = "#"
        texts.append("".join(t))
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeats.apply(frame(spark, texts)).collect()}
    assert [out[i] for i in range(len(texts))] == list(brute_repeats([(t or "").encode() for t in texts]))


def test_deep_shallow_sort():
    for _ in range(60):
        strings = [bytes(RNG.choices(b"ab", k=RNG.choice([0, 3, 60, 80]))) for _ in range(RNG.randint(1, 40))]
        strings += [s[:50] + b"z" for s in strings[:5]] + strings[:3]
        order, prefix = repeats.deep_shallow_sort(strings)
        assert [strings[i] for i in order] == sorted(strings)
        assert all(prefix[k] == repeats.common_prefix(strings[order[k - 1]], strings[order[k]]) for k in range(1, len(order)))


def test_mixing(spark):
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", None if i % 50 == 0 else prose(RNG.randint(0, 80))) for i in range(900)]
    docs = mixing.with_size(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    plan = mixing.plan(docs.select("doc_id", "source", "size"))
    out = mixing.apply(docs, plan).collect()
    size = lambda t: len((t or "").split())
    assert all(r.size == size(r.text) and 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies for r in out)
    sums = collections.Counter()
    for r in out:
        sums[r.source] += r.taken
    target, total = {r.source: r.target for r in out}, sum(r.size for r in out)
    assert math.isclose(sum(target.values()), 1.5 * total)
    assert all(abs(sums[s] - t) <= 0.01 * t for s, t in target.items())
    again = mixing.apply(docs.repartition(5), mixing.plan(docs.repartition(7).select("doc_id", "source", "size"))).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in out}
    empty = docs.limit(0)
    assert mixing.apply(empty, mixing.plan(empty.select("doc_id", "source", "size"))).count() == 0


def test_search(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_DOCS", 16)
    monkeypatch.setattr(top_k, "QUERY_BYTES", 4_000)
    monkeypatch.setattr(top_k, "BLOCK_DOCS", 4)
    texts = [prose(RNG.randint(0, 40)) for _ in range(80)] + [None, ""]
    df = frame(spark, texts)
    tf = [collections.Counter((t or "").split()) for t in texts]
    n, mean = len(texts), sum(sum(c.values()) for c in tf) / len(texts)
    df_ = collections.Counter(w for c in tf for w in c)
    got = collections.defaultdict(list)
    for r in top_k.search(top_k.build(df), df.filter("doc_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    for q in range(0, n, 10):
        scores = {i: sum(m * math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, m in tf[q].items() if w in c) for i, c in enumerate(tf) if i != q}
        want = sorted(((i, s) for i, s in scores.items() if s > 0), key=lambda x: (-x[1], x[0]))[:10]
        assert [i for i, _ in got[q]] == [i for i, _ in want] and all(abs(a[1] - b[1]) < 1e-5 for a, b in zip(got[q], want, strict=True))


def test_search_rows_with_one_id_and_odd_rows(spark):
    twin = prose(30)
    rows = [(100, twin + " left"), (100, "right " * 3), (None, twin), (3, "right " + prose(5000)), (4, twin), (200, None), (300, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit(7)).withColumn("number", F.lit("x"))
    out = top_k.search(top_k.build(df), df.filter("doc_id % 100 = 0")).collect()
    lists = collections.Counter((r.query_id, r["rank"]) for r in out)
    assert lists[100, 1] == 2 and {r.query_id for r in out} == {100}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out if r["rank"] == 1) == [(False, 3), (False, 4)]
    assert all(r.doc_id != 100 for r in out) and any(r.doc_id is None and r["rank"] == 2 for r in out)
    none = df.limit(0)
    assert top_k.search(top_k.build(none), none).count() == 0


def test_search_takes_queries_together():
    """A group of queries costs a part of what they cost one by one and finds the same, from shard to shard."""
    rng, terms = np.random.default_rng(5), top_k.Terms()
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 200)) if x < 3_000) for _ in range(1_200)]
    vectors, shards = [terms(t) for t in texts], []
    for at in (0, 600):
        shard = top_k._Open()
        for k in range(at, at + 600):
            shard.add(k, *vectors[k])
        shards.append(top_k.Shard(*top_k._arrays(shard.close(), 0, *top_k._ARRAYS), 90.0))
    asked = list(range(0, 1_200, 4))
    names, places = np.unique(np.concatenate([vectors[q][0] for q in asked]), return_inverse=True)
    factors = np.concatenate([vectors[q][1] * 0.5 for q in asked])
    starts = np.cumsum([0, *(len(vectors[q][0]) for q in asked)])
    best: list[list[tuple[float, int]]] = [[] for _ in asked]
    before = time.process_time()
    for shard in shards:
        shard.search_all(top_k.Asked(np.array(asked), asked, starts, names, places, factors), best, 10)
    together, before = time.process_time() - before, time.process_time()
    for q, held in zip(asked, best, strict=True):
        found = [x for shard in shards for x in shard.search(vectors[q][0], vectors[q][1] * 0.5, q)]
        assert [(i, s) for s, i in sorted((-s, i) for i, s in found)[:10]] == [(i, s) for s, i in held]
    assert sum(map(len, best)) > 2_000 and together < 0.6 * (time.process_time() - before)


def test_search_skips_blocks(monkeypatch):
    """Pruning leaves blocks out and the result alone."""
    monkeypatch.setattr(top_k, "BLOCK_DOCS", 8)
    docs = [[f"{group}{RNG.randint(0, 60)}" for _ in range(RNG.randint(1, 60))] for group in "abcdefgh" * 200]
    shard, terms = top_k._Open(), top_k.Terms()
    for k, words in enumerate(docs):
        shard.add(k, *terms(" ".join(words)))
    made = top_k.Shard(*top_k._arrays(shard.close(), 0, *top_k._ARRAYS), 30.0)
    for q in range(0, len(docs), 40):
        names, counts = terms(" ".join(docs[q]))
        full = np.zeros(len(docs))
        place = made.places(names)
        for p, c in zip(place, counts, strict=True):
            span = slice(made.starts[p], made.starts[p + 1])
            full[made.ids[made.docs[span]]] += c * made.weight[span]
        full[q] = 0
        want = sorted(((i, s) for i, s in enumerate(full) if s > 0), key=lambda x: (-round(x[1], 9), x[0]))[:10]
        got = made.search(names, counts.astype(float), q)
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])
    assert made.scored < 0.7 * made.met
