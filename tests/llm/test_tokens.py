"""Byte-level BPE and packed ids against their libraries."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from layoutlake.llm import byte_bpe, id_pack

ALPHABET = [chr(i) for i in [*range(0x300), *range(0x2000, 0x2070), 0x3000, 0x1F600, 0x301, 0xE01, 0x4E00, 0xAC00, 0x200D, 0xFEFF]]


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec_of(P.path(byte_bpe.RANKS_FILE), P.PATTERN)


def test_letters_are_not_split_again(codec, monkeypatch):
    """Units of letters alone go to the replay as they are, all others by the pattern; ids are the library's."""
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.replay.ranks, special_tokens={})
    seen: list[str] = []
    split = codec.split
    monkeypatch.setattr(codec, "split", lambda u: seen.append(u) or split(u))
    plain = "Zwiebelqvarn éclaterait  qzxünötig ǅungla 漢字かな 𐐀𐐨𝒳 ªºʰ ﬁnqvale"
    odd = "it'sqv e\u0301qv q\u0663v ٣٤ 'tis'llama x1y2 Ⅷa ࢠ़ a\u200db \u3000qa\u3000 ''s q-v"
    for text in (plain, odd):
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)
    assert not any(u.strip() and u.strip().isalpha() for u in seen) and "it'sqv" in seen


def test_ids_equal_the_library(codec):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.replay.ranks, special_tokens={})
    rng = random.Random(0)
    texts = ["".join(rng.choices([*ALPHABET, *[" "] * 60, *["\n"] * 20, *["'s", "'t", "  "] * 10], k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["", " ", "a" * 20000, "ab" * 3000, "\n\n \n x", "<|endoftext|>", "Straße naïve 12345"]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encode_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "ab", "x"), (1, "ab", "x"), (2, None, None), (3, "", "y")], "doc_id long, text string, ids string")
    out = byte_bpe.encode(df, P.path(byte_bpe.RANKS_FILE), P.PATTERN).collect()
    assert [r.n_tokens for r in out if r.doc_id > 1] == [0, 0] and all(bytes(r.decoded) == (r.text or "").encode() for r in out)
    assert byte_bpe.digest(df.limit(0), P.path(byte_bpe.RANKS_FILE), P.PATTERN).count() == 0


def test_tokens_stage_hands_back_no_texts(spark, monkeypatch):
    """The pipeline's workers return ids and digests only, which are those of ``encode``."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    returned: list[list[str]] = []
    real = byte_bpe.map_batches
    monkeypatch.setattr(byte_bpe, "map_batches", lambda df, make, schema: returned.append(schema.names) or real(df, make, schema))
    rows = [(k, "de", "s", k, f"Qvarnel {k} it's  {k * 7}" * k) for k in range(9)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string")
    out = corpus_pipeline.tokens_stage(spark, docs, "")
    assert returned == [["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]] and out.columns == returned[0]
    whole = byte_bpe.encode(docs, P.path(byte_bpe.RANKS_FILE), P.PATTERN).withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)})
    assert sorted(out.collect(), key=str) == sorted(whole.select(out.columns).collect(), key=str)


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17])
def test_pack_round_trip(bits):
    x = np.random.default_rng(1).integers(0, 2**bits, 1001).astype(np.uint32)
    packed = id_pack.pack(x, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (id_pack.unpack(packed, bits, 0, 1001) == x).all() and (id_pack.unpack(packed, bits, 77, 500) == x[77:500]).all()


def test_words_equal_the_library():
    from tokenizers import Tokenizer

    path = P.path(id_pack.VOCABULARY_FILE)
    own, lib = id_pack.encoder_of(path), Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = ["".join(rng.choices([*ALPHABET, *[" "] * 60, *["the", "Erth.", "d'une", "x,y!", "<|endoftext|>", "12"] * 9], k=rng.randint(0, 50))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids


def test_words_share_the_ids_of_their_letters(monkeypatch):
    """Capitals and marks make no new letters, and letters take the short way; ids are the library's."""
    from tokenizers import Tokenizer

    path = P.path(id_pack.VOCABULARY_FILE)
    own, lib = id_pack.WordEncoder(path), Tokenizer.from_file(path)
    seen: list[str] = []
    letters = own._encode_letters
    monkeypatch.setattr(own, "_encode_letters", lambda words: seen.extend(words) or letters(words))
    texts = ["Qvarnel qvarnel, QVARNEL.%%% qvarnel", "Élanqv élanqv; ÉLANQV ßtrÿ [élanqv]", "", " \t ", "x\x1fy\xa0z \u3000 don't"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert sorted(seen) == ["qvarnel", "ßtrÿ", "élanqv"] and own.encode([]) == []
    assert [len(x) for x in own.encode(["", ""])] == [0, 0]


def test_shards_are_in_order(spark, monkeypatch):
    monkeypatch.setattr(id_pack, "BLOCK_IDS", 20)
    rows = [(i * 3 % 40, f"word{i} and more text {i}" if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = id_pack.write_shards(df, P.path(id_pack.VOCABULARY_FILE), 4)
    out = sorted(id_pack.read_digests(blocks).collect(), key=lambda r: r.start)
    ids = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4") for r in id_pack.read_documents(blocks).collect()}
    assert [r.doc_id for r in out] == sorted(d for d, _ in rows) and out[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:]))
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id].tobytes()) and ids[r.doc_id][-1] == 1 for r in out)
