"""The media column is stored, and the result has its durations and frame offsets."""

import hashlib
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

from layoutlake.llm import common, mpeg_audio


def test_stored_media_is_read_back(spark, tmp_path):
    texts = ["a few words", "x" * 5000, None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    folder = re.sub("^file:/*", "/", common.shared_dir(spark))
    before = set(os.listdir(folder))
    rows = {r.doc_id: r for r in mpeg_audio.query(spark, str(tmp_path)).collect()}
    stored = [f for f in set(os.listdir(folder)) - before if f.startswith("mpeg-media-")]
    assert len(stored) == 1 and spark.read.parquet(f"{folder}/{stored[0]}").columns == ["doc_id", "n_bytes", "media"]
    for k, text in enumerate(texts):
        stream = mpeg_audio.parse(mpeg_audio.encode_media(mpeg_audio.padded(text)[0]))
        assert (rows[k].n_frames, rows[k].duration_samples, rows[k].offsets) == (len(stream.offsets), stream.samples, stream.offsets)


def test_crcs_of_other_layers_are_counted():
    frame = bytes((0xFF, 0xFC, 0x80, 0xC0)) + bytes(413)  # MPEG-1 Layer II with CRC, 128 kbit/s, 44.1 kHz, mono
    stream = mpeg_audio.parse(frame * 3)
    assert (len(stream.offsets), stream.crc_unchecked, stream.crc_checked, stream.crc_wrong) == (3, 3, 0, 0)
    assert mpeg_audio.parse(mpeg_audio.encode_media(bytes(64))).crc_unchecked == 0


@pytest.mark.parametrize(("n", "at"), [(128, 29), (192, 65), (256, 137)] + [(n, n - k) for n in (128, 1024, 3000) for k in range(60, 129, 4)])
def test_payload_that_looks_like_a_tag(n, at):
    payload = b"x" * at + b"TAG" + b"y" * n
    payload = payload[:n] + bytes(-n % 64)
    media = mpeg_audio.encode_media(payload)
    assert mpeg_audio.read_payload(media, mpeg_audio.parse(media)) == payload


def test_tag_behind_the_last_frame():
    media = mpeg_audio.encode_media(os.urandom(6400)) + b"TAG" + b"A title".ljust(125, b"\0")
    stream = mpeg_audio.parse(media)
    assert stream.tags["id3v1"] == "A title" and not stream.skipped and not stream.cut


def test_flipped_payload_bit_is_found():
    media = bytearray(mpeg_audio.encode_media(os.urandom(640)))
    media[mpeg_audio.parse(bytes(media)).offsets[0] + mpeg_audio.OVERHEAD + 20] ^= 4
    with pytest.raises(ValueError):
        mpeg_audio.read_payload(bytes(media), mpeg_audio.parse(bytes(media)))


def test_rows_follow_the_definition(spark):
    texts = [None, "", "a", "a" * 63, "b" * 64, "ü" * 40, "\xff\xfb\x90" * 700, "TAG" * 50, "long text " * 40_000]
    rows = [(k if k else None, t, "x") for k, t in enumerate(texts)] + [(3, "a" * 63, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string").withColumn("n_bytes", F.lit("z"))
    out = mpeg_audio.from_media(mpeg_audio.to_media(df)).collect()
    assert len(out) == len(rows)
    for r in out:
        raw = (texts[r.doc_id or 0] or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert mpeg_audio.from_media(mpeg_audio.to_media(df.limit(0))).count() == 0
