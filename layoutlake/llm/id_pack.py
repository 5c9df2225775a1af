"""Token ids in fixed-width bit-packed shard files.

Format of a shard: a table of blocks in ascending order.  A block starts with a
header of five little-endian 64-bit integers (magic, bits per id, documents,
ids, first id's place in the shard), then the documents' id counts as unsigned
32-bit integers, then the packed ids: id k takes bits k*bits to (k+1)*bits of
the payload, most significant bit first, zero bits up to a full byte.  Every id
takes the least number of bits that holds the vocabulary, so id k is found
without reading those before it, and numpy unpacks a block at once.

The blocks are the ``block`` column of a Parquet table (``shard``, ``number``,
``first_doc``, ``block``): Spark's committer makes the write safe against lost
executors, and any store that Spark reaches will do.

Texts: null counts as empty; an empty text has the end id alone; long texts are taken
whole and may fill a block of their own.  Ties of doc_id: repeated ids are separate
documents and stand next to each other, null ids come first.  An empty table gives
no shard; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import SLICE_ROWS, bounded, map_batches, released, table, written

VOCABULARY_FILE = "word_bpe_49k.json"
END_ID = 1
MAGIC = 0x6B6361_70_6469
HEADER = struct.Struct("<5q")
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 18
#: Distinct words kept with their ids in a task; beyond it the store starts afresh.
STORE_WORDS = 1_000_000
#: Letters (ASCII, Latin-1), then marks other than apostrophes: one or two parts to the tokenizer.
PLAIN = r"\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!#$%&()*+,\-./:;=?@\[\]_|]*)\z"
#: Runs of letters that the tokenizer takes as one text.
TOGETHER = 2_000


def bits_for(ids: int) -> int:
    """The least number of bits that holds ids 0 to ``ids`` - 1."""
    return max(1, (ids - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = (ids.astype(np.uint32)[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)) & 1
    return np.packbits(wide.astype(np.uint8).ravel()).tobytes()


def unpack(payload: bytes | memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a payload, by reading their own bytes only."""
    if stop <= start:
        return np.empty(0, np.uint32)
    low, high = start * bits // 8, -(-stop * bits // 8)
    part = np.frombuffer(payload, np.uint8)[low:high]
    if bits in (8, 16, 32):
        return part.view(f">u{bits // 8}").astype(np.uint32)
    flat = np.unpackbits(part)[start * bits - low * 8 :][: (stop - start) * bits].reshape(-1, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits - 1, -1, -1, dtype=np.uint32))


def make_block(documents: list[np.ndarray], bits: int, first: int) -> bytes:
    counts = np.array([len(d) for d in documents], "<u4")
    ids = np.concatenate(documents) if documents else np.empty(0, np.uint32)
    return HEADER.pack(MAGIC, bits, len(documents), len(ids), first) + counts.tobytes() + pack(ids, bits)


class Block:
    """A block read back; ``document(k)`` reads one document's ids."""

    def __init__(self, data: bytes):
        magic, self.bits, n, self.n_ids, self.first = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of packed ids")
        self.counts = np.frombuffer(data, "<u4", n, HEADER.size).astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.payload = memoryview(data)[HEADER.size + 4 * n :]
        if len(self.payload) != -(-self.n_ids * self.bits // 8) or (n and self.ends[-1] != self.n_ids):
            raise ValueError("block is cut short")

    def document(self, k: int) -> np.ndarray:
        return unpack(self.payload, self.bits, int(self.ends[k] - self.counts[k]), int(self.ends[k]))

    def ids(self) -> np.ndarray:
        return unpack(self.payload, self.bits, 0, self.n_ids)


def strings(values: pa.Array) -> list[str]:
    """As ``to_pylist``, several times as fast."""
    return values.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """The tokenizer, with the ids of white-space separated words kept.

    This vocabulary's tokenizer drops white space and merges nothing across it,
    so a text's ids are its words' ids one after the other.  It lowers capitals, and
    letters and the marks behind them are separate parts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for lower-case letters with spaces between them, which the rest of the rules leave as they are.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.store: dict[str, bytes] = {}
        #: Whether an id ends a letter run or mark run.
        vocabulary = self.tokenizer.get_vocab(True)
        #: One more than the largest id, whatever gaps the vocabulary has.
        self.ids = max(vocabulary.values()) + 1
        self.last = np.zeros(self.ids, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        #: Bytes that an id stands for (a token has a character for each); a special token stands for none that we know.
        self.bytes = np.zeros(len(self.last), np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token.removesuffix("</w>")) if not token.startswith("<|") else -(1 << 40)

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        store = self.store
        if len(store) > STORE_WORDS:
            store.clear()
        # at ASCII white space; an empty word at a text's ends has no ids
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        words = cut.flatten().dictionary_encode()
        distinct = strings(words.dictionary)
        self._add([w for w in distinct if w not in store])
        ids = list(map(store.__getitem__, distinct))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, at = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        # the words' ids one after the other: word by word from where its ids start
        ends = np.concatenate(([0], np.cumsum(sizes[at])))
        places = np.repeat(starts[at] - ends[:-1], sizes[at]) + np.arange(ends[-1])
        every, bounds = np.frombuffer(b"".join(ids), "<u4")[places], ends[cut.offsets.to_numpy()].tolist()
        return [every[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _add(self, words: list[str]) -> None:
        """Store the ids of ``words``; plain ones share those of their letters, in lower case, and of their marks."""
        store = self.store
        every = pa.array(words, pa.string())
        found = pc.extract_regex(every, PLAIN)
        plain, parts = strings(every.filter(found.is_valid())), found.drop_null()
        letters, marks = strings(pc.utf8_lower(pc.struct_field(parts, "letters"))), strings(pc.struct_field(parts, "marks"))
        self._encode_letters([a for a in dict.fromkeys(letters) if a not in store])
        rest = {*letters, *marks, *strings(every.filter(found.is_null()))}.difference(store)
        for word, one in zip(rest, self.tokenizer.encode_batch_fast(list(rest), add_special_tokens=False), strict=True):
            store[word] = np.array(one.ids, "<u4").tobytes()
        for word, a, b in zip(plain, letters, marks, strict=True):
            store[word] = store[a] + store[b] if b else store[a]

    def _encode_letters(self, words: list[str]) -> None:
        """Encode words of letters together; their last ids tell them apart."""
        for at in range(0, len(words), TOGETHER):
            part = words[at : at + TOGETHER]
            ids = np.array(self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.last[ids])
            if len(last) != len(part):
                continue  # not as expected: each by itself
            # every word's ids stand for as many bytes as it has, so no id can have gone to its neighbour
            if (np.cumsum(self.bytes[ids])[last] != np.cumsum(list(map(len, map(str.encode, part))))).any():
                continue
            data = ids.tobytes()
            stops = ((last + 1) * 4).tolist()
            self.store.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_shards(df: DataFrame, tokenizer_path: str, shards: int, end_id: int = END_ID) -> DataFrame:
    """Encode ``text`` and return the written table of blocks.

    Shards take ranges of doc_id: reading them by ``shard`` and ``number`` gives
    the documents in ascending order of their ids.
    """
    docs = df.select(F.col("doc_id").cast("long"), "text")
    ranged = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id").withColumn("shard", F.spark_partition_id())

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = encoder_of(tokenizer_path)
        bits, end = bits_for(encoder.ids), np.array([end_id], np.uint32)
        held: list[np.ndarray] = []
        doc_ids: list[int] = []
        size = first = number = 0
        shard = None

        def close() -> pa.RecordBatch:
            nonlocal held, doc_ids, size, first, number
            out = pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "number": pa.array([number], pa.int64()), "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "n_ids": pa.array([size], pa.int64()), "block": pa.array([make_block(held, bits, first)], pa.binary())})
            first, number = first + size, number + 1
            held, doc_ids, size = [], [], 0
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard")[0].as_py()
            texts, ids = batch.column("text").fill_null(""), batch.column("doc_id").to_pylist()
            for at in range(0, len(texts), SLICE_ROWS):
                for doc_id, found in zip(ids[at : at + SLICE_ROWS], encoder.encode(texts.slice(at, SLICE_ROWS)), strict=True):
                    held.append(np.concatenate((found, end)))
                    doc_ids.append(doc_id)
                    size += len(found) + 1
                    if size >= BLOCK_IDS:
                        yield close()
        if held:
            yield close()

    return written(bounded(ranged).mapInArrow(lambda batches: released(run(batches)), "shard int, number long, doc_ids array<long>, n_ids long, block binary"), "idpack")


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids before it in all shards), n_tokens, ids (binary, unsigned 32-bit)."""
    return _read(blocks, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def read_digests(blocks: DataFrame) -> DataFrame:
    """``read_documents`` with ids_crc32 in place of the ids."""
    return _read(blocks, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _read(blocks: DataFrame, column: str, value, kind: pa.DataType) -> DataFrame:
    # One row for each shard, of which there are as many as partitions were asked for.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    before, total = {}, 0
    for row in sizes:
        before[row["shard"]], total = total, total + row["n"]
    name = column.split()[0]

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = ([], [], [], [])
            for shard, doc_ids, data in zip(batch.column("shard").to_pylist(), batch.column("doc_ids").to_pylist(), batch.column("block").to_pylist(), strict=True):
                block = Block(data)
                starts = before[shard] + block.first + block.ends - block.counts
                out[0].extend(doc_ids)
                out[1].extend(starts.tolist())
                out[2].extend(block.counts.tolist())
                out[3].extend(value(block.document(k)) for k in range(len(doc_ids)))
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], kind)], names=["doc_id", "start", "n_tokens", name])

        return each

    return map_batches(blocks.select("shard", "doc_ids", "block"), make, f"doc_id long, start long, n_tokens long, {column}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_digests(write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY_FILE), shards))
