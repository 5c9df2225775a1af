"""Byte-level BPE by merge replay over a corpus' distinct words.

The replay keeps one inverted index for all distinct words at hand, from the
rank of a pair of neighbouring tokens to the positions where that pair stands.
Ranks are taken in ascending order, those that stand somewhere from a heap; a merge
touches only its two neighbours.
Words are independent of each other, so each task replays the merges over the
distinct words of its own share of the corpus, BLOCK_WORDS under one index (a word is
replayed once for each task that has it): the ids are those of a single index over
everything, and neither words nor texts are shuffled.

Texts: null counts as empty; an empty text has no tokens.  Special tokens are
not recognised, their strings are ordinary text.  Rows are encoded one by one,
so repeated rows give repeated results and null ids don't matter; texts of any length
are taken whole.  Other columns pass through ``encode`` unless they have the name of a
new column, which is then replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import map_batches, table

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
#: The characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
#: How a pattern begins in which letters are one match, whatever follows them.
LETTERS_MATCH = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|"
#: Words kept with their ids in a task; beyond it the store starts afresh.
STORE_WORDS = 250_000
#: Words under one index.
BLOCK_WORDS = 5_000
#: Characters of text whose new words share one replay.
PORTION = 8_000_000
#: The same where memory counts for more than time: units of a text take about ten times its size.
SMALL_PORTION = 1_000_000


@lru_cache(maxsize=1)
def codec_of(path: str, pattern: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    return Codec(load_ranks(path), pattern)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Encode many words at once; ``ranks`` maps a token's bytes to its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.top = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: By left id and by right id, the other id: the id that they merge to.
        self.by_left: list[dict[int, int]] = [{} for _ in range(self.top)]
        self.by_right: list[dict[int, int]] = [{} for _ in range(self.top)]
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.by_left[left][right] = self.by_right[right][left] = i
        self.byte_pairs = np.array([self.by_left[a].get(b, -1) for a in self.byte_ids.tolist() for b in self.byte_ids.tolist()], np.int64)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, block by block: an index that fits a processor's cache."""
        return [ids for at in range(0, len(words), BLOCK_WORDS) for ids in self.encode_block(words[at : at + BLOCK_WORDS])]

    def encode_block(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word.  ``pair[i]`` is what the pair that begins at i merges to."""
        whole = [self.ranks.get(w, -1) for w in words]
        rest = [w for w, known in zip(words, whole, strict=True) if known < 0]
        text = np.frombuffer(b"".join(rest), np.uint8).astype(np.int64)
        ends = np.cumsum([len(w) for w in rest], dtype=np.int64)
        starts = ends - np.array([len(w) for w in rest], np.int64)
        first = np.full(len(text), -1)
        first[:-1] = self.byte_pairs[text[:-1] * 256 + text[1:]]
        after_, before_ = np.arange(1, len(text) + 1), np.arange(-1, len(text) - 1)
        if len(text):
            some = ends > starts
            first[ends[some] - 1] = after_[ends[some] - 1] = before_[starts[some]] = -1
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranks, begin = np.unique(first[order], return_index=True)
        cuts, order, waiting = [*begin.tolist(), len(order)], order.tolist(), ranks.tolist()
        index = {r: order[a:b] for r, a, b in zip(waiting, cuts, cuts[1:], strict=False)}
        token, pair, after, before = self.byte_ids[text].tolist(), first.tolist(), after_.tolist(), before_.tolist()
        # ranks in ``index``, as a heap
        while waiting:
            r = heappop(waiting)
            places = index.pop(r)
            places.sort()
            with_right, with_left, lowest = self.by_left[r].get, self.by_right[r].get, r
            for n, i in enumerate(places):
                if pair[i] != r:
                    continue
                j = after[i]
                token[i] = r
                token[j] = pair[j] = -1
                after[i] = right = after[j]
                if right >= 0:
                    before[right] = i
                    pair[i] = new = with_right(token[right], -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heappush(waiting, new)
                            if new < lowest:
                                lowest = new
                else:
                    pair[i] = -1
                left = before[i]
                if left >= 0:
                    pair[left] = new = with_left(token[left], -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heappush(waiting, new)
                            if new < lowest:
                                lowest = new
                if lowest < r:  # an earlier merge became possible: it comes first
                    index[r] = places[n + 1 :]
                    heappush(waiting, r)
                    break
        tokens = np.array(token, np.int64)
        alive = tokens >= 0
        counts = np.concatenate(([0], np.cumsum(alive)))
        ids, low, high = tokens[alive].astype("<u4").tobytes(), (4 * counts[starts]).tolist(), (4 * counts[ends]).tolist()
        spans = zip(low, high, strict=True)
        return [known.to_bytes(4, "little") if known >= 0 else ids[slice(*next(spans))] for known in whole]


def portions(texts: list[str], most: int = PORTION) -> Iterator[list[str]]:
    """Consecutive parts of about ``most`` characters, at least one text each."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


class Codec:
    """Texts to ids (little-endian unsigned 32-bit integers) and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.split = regex.compile(pattern).findall
        # A run of other characters with the space before it, or white space:
        # no match of the pattern crosses the end of such a unit.
        self.units = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        # Letters alone, with or without a space before them, then are one match.
        self.letters_match = pattern.startswith(LETTERS_MATCH)
        self.store: dict[str, bytes] = {}
        self.token = self.replay.tokens.__getitem__

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  The replay runs over all new words of ``texts``."""
        if len(self.store) > STORE_WORDS:
            self.store.clear()
        store = self.store
        cut = [self.units(t) for t in texts]
        new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in store]
        whole: list[str] = []
        split: dict[str, list[str]] = {}
        for u in new:
            if self.letters_match and u.removeprefix(" ").isalpha():
                whole.append(u)
            else:
                split[u] = self.split(u)
        words = list(dict.fromkeys(chain(whole, chain.from_iterable(split.values()))))
        ids = dict(zip(words, self.replay.encode([w.encode() for w in words]), strict=True))
        store.update(zip(whole, map(ids.__getitem__, whole), strict=True))
        for unit, part in split.items():
            store[unit] = b"".join([ids[w] for w in part])
        return [b"".join(map(store.__getitem__, units)) for units in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token, np.frombuffer(ids, "<u4").tolist()))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` (binary) and ``decoded`` (binary)."""
    new = ("n_tokens", "ids", "decoded")
    kept = [f for f in df.schema.fields if f.name not in new]
    source = text

    def make():
        codec = codec_of(ranks_path, pattern)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(source).to_pylist()]
            ids: list[bytes] = []
            for part in portions(texts):
                ids += codec.encode(part)
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + list(new))

        return each

    from pyspark.sql.types import BinaryType, LongType, StructType

    schema = StructType(list(kept))
    for name, kind in zip(new, (LongType(), BinaryType(), BinaryType()), strict=True):
        schema = schema.add(name, kind)
    return map_batches(df.select([f.name for f in kept]), make, schema)


def digest(df: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), ids: bool = False, portion: int = PORTION) -> DataFrame:
    """``encode`` reduced in the same pass to counts and digests, beside the columns ``keep`` and, if asked for, the ids.

    Neither texts nor decoded bytes leave the worker.
    """
    from pyspark.sql.types import BinaryType, LongType, StringType, StructType

    schema = StructType([df.schema[c] for c in keep]).add("n_tokens", LongType())
    schema = schema.add("ids", BinaryType()) if ids else schema
    schema = schema.add("ids_sha256", StringType()).add("decoded_sha256", StringType())
    names = schema.names

    def make():
        codec = codec_of(ranks_path, pattern)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n, kept, ids_sha, text_sha = [], [], [], []
            for part in portions(texts, portion):
                for found in codec.encode(part):
                    n.append(len(found) // 4)
                    if ids:
                        kept.append(found)
                    ids_sha.append(hashlib.sha256(found).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(found)).hexdigest())
            columns = [batch.column(c) for c in keep] + [pa.array(n, pa.int64())]
            columns += [pa.array(kept, pa.binary())] if ids else []
            return pa.RecordBatch.from_arrays([*columns, pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=names)

        return each

    return map_batches(df.select(*keep, "text"), make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")), public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN)
