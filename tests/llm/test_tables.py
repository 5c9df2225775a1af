"""Operators and pipeline stages on whole small tables against brute force."""

import collections
import hashlib
import html.parser
import math
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layoutlake.llm import byte_bpe, html_text, id_pack, line_runs, mixing, mpeg_audio, near_dup, quality

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_byte_bpe_table(spark, docs):
    import tiktoken

    path = P.path(byte_bpe.RANKS_FILE)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    for r in byte_bpe.query(spark, SF).collect():
        ids = np.array(own.encode_ordinary(docs[r.doc_id].text or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id].text or "").encode()).hexdigest()


class Article(html.parser.HTMLParser):
    """Texts of blocks in article elements, by another reader of pages."""

    INLINE = frozenset("a b i em strong span u small sub sup code".split())
    OUT = frozenset("script style nav aside footer form".split())

    def __init__(self) -> None:
        super().__init__()
        self.depth = self.out = 0
        self.blocks: list[str] = [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.out += tag in self.OUT
        if tag not in self.INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.blocks.append("")
        self.depth -= tag == "article"
        self.out -= tag in self.OUT

    def handle_data(self, data):
        if self.depth and not self.out:
            self.blocks[-1] += data


def article_text(page: str) -> str:
    reader = Article()
    reader.feed(page)
    return "\n".join(t for t in (" ".join(b.split()) for b in reader.blocks) if t)


def test_pages_against_their_article_elements(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = html_text.query(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.text == article_text(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_quality_of_the_held_out_fold(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in rows if labels[r.doc_id] == x] for x in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert len(rows) >= 50 and auc > 0.97
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.9


def test_scores_see_nothing_but_the_text(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    a = {r.doc_id: r.score for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    other = docs.select((F.col("doc_id") * 7 + 3).alias("doc_id"), "text", F.lit("x").alias("lang"), F.lit("y").alias("source"))
    b = {r.doc_id: r.score for r in quality.score(other.repartition(5), model).collect()}
    assert all(b[k * 7 + 3] == v for k, v in a.items())
    # labels of the held-out fold have no say
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    c = {r.doc_id: r.score for r in quality.score(docs.select("doc_id", "text"), quality.train(docs, flipped)).collect()}
    assert a == c


def brute_targets(sizes: dict) -> dict:
    """Shares by weight; what is above twice a source's size goes to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mixing_targets(spark, docs):
    sizes = collections.Counter()
    for r in docs.values():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target = brute_targets(dict(sizes))
    taken = collections.Counter()
    for r in mixing.query(spark, SF).collect():
        own = docs[r.doc_id]
        assert r.size == len(WORD.findall(own.text or "")) and r.source_size == sizes[own.source] and 0 <= r.taken <= 2 * r.size
        assert math.isclose(r.target, target[own.source], rel_tol=1e-9)
        taken[own.source] += r.taken
    assert all(abs(taken[s] - t) <= max(0.05 * t, 40) for s, t in target.items())


def test_media_table(spark, docs):
    for r in mpeg_audio.query(spark, SF).collect():
        raw = (docs[r.doc_id].text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes > len(payload) and len(r.offsets) == r.n_frames and r.duration_samples == 1152 * r.n_frames


def test_packed_ids_table(spark, docs):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(P.path(id_pack.VOCABULARY_FILE)), 0
    for r in sorted(id_pack.query(spark, SF).collect(), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def shingle_set(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute_classes(texts: dict) -> dict:
    """The smallest id that links reach, by all pairs that share a shingle."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    at = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            at[x].append(k)
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = collections.Counter((a, b) for ks in at.values() for i, a in enumerate(ks) for b in ks[i + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in texts}


def test_near_duplicates_table(spark, docs):
    want = brute_classes({k: r.text for k, r in docs.items()})
    for r in near_dup.query(spark, SF).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(shingle_set(docs[r.doc_id].text)), want[r.doc_id], r.doc_id == want[r.doc_id])


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def brute_lines(texts: dict) -> dict:
    holders = collections.defaultdict(set)
    for k, t in texts.items():
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 40:
                holders[line_key(line)].add(k)
    gone = {x: max(ks) for x, ks in holders.items() if len(ks) >= 5}
    return {k: "\n".join(x for x in (t or "").split("\n") if gone.get(line_key(x), k) == k) for k, t in texts.items()}


def test_pipeline_stage_by_stage(spark, docs):
    """Each stage against brute force on what the stage before has left."""
    rows = [tuple(r) for r in docs.values()]
    rows += [(None, "a text without an id and of no consequence at all", "en", "src1", 49), (9_999_991, None, "en", "src1", 0), (9_999_992, "", "en", None, 0), rows[0], rows[0]]
    raw = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("own")).withColumn("size", F.lit("s"))
    quality_, lines_, near_, mixed_, tokens_ = (f for _, f in corpus_pipeline.STAGES)
    kept = quality_(spark, raw, SF).cache()
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = [(r, model.score(np.array([quality.features(r.text)]))[0]) for r in raw.collect()]
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r, s in scores if s >= quality.THRESHOLD)

    named = kept.filter("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    lined = lines_(spark, named, SF).cache()
    want = brute_lines({r.doc_id: r.text for r in named.collect()})
    assert lined.columns == raw.columns and {r.doc_id: r.text or "" for r in lined.collect()} == want
    assert all(r.n_chars == len(r.text or "") and (r.score, r.size) == ("own", "s") for r in lined.collect())

    near = near_(spark, lined, SF).cache()
    want = brute_classes({r.doc_id: r.text for r in lined.collect()})
    assert sorted(r.doc_id for r in near.collect()) == sorted(k for k, c in want.items() if k == c)
    twice = near_(spark, near.unionByName(near), SF)
    wordless = near.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).count()
    assert twice.count() == near.count() + wordless

    mixed = mixed_(spark, near, SF).cache()
    assert mixed.columns == raw.columns
    times = collections.Counter(r.doc_id for r in mixed.collect())
    sizes = collections.Counter()
    for r in near.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
    target = brute_targets(dict(sizes))
    assert max(times.values()) <= 2 and all(abs(taken[s] - t) <= max(0.05 * t, 40) for s, t in target.items())

    import tiktoken

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path(byte_bpe.RANKS_FILE)), special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    out = tokens_(spark, mixed, SF).collect()
    assert collections.Counter(r.doc_id for r in out) == times
    assert all(bytes(r.ids) == np.array(own.encode_ordinary(texts[r.doc_id] or ""), "<u4").tobytes() for r in out)


def test_pipeline_of_nothing(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0


def test_lines_table(spark, docs):
    want = brute_lines({k: r.text for k, r in docs.items()})
    for r in line_runs.query(spark, SF).collect():
        lines = (docs[r.doc_id].text or "").split("\n")
        assert r.n_lines == len(lines) and r.kept_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
