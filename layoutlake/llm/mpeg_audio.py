"""MPEG audio columns: a lossless byte carrier and a defensive parser.

``encode_media`` stores bytes in an MPEG-1 Layer III stream.  Every frame has
empty granules (a player hears silence), a CRC over header and side
information, and carries bytes in its ancillary area, which players skip.  The
stream starts with an ID3v2 tag (the payload's length and CRC-32) and an information frame
with a Xing table (frames, bytes, a 100-entry seek table); the last frame takes
the least bit rate that holds the rest, so bit rates may vary.

``parse`` reads any Layer I, II or III stream: it skips tags, finds the next
header that a second header (or the end) confirms, checks the CRCs of Layer III and
counts those of Layers I and II as unchecked, reads Xing, Info and VBRI tables, and
gives the exact duration in samples and the byte offset of every frame.  Damage never
raises there: it is counted (``skipped``, ``crc_wrong``, ``cut``).  ``read_payload``
raises a ValueError if a stream is damaged or isn't one of ``encode_media``'s.

Payload rule: the text's UTF-8 bytes (null: none), then bytes 0 up to a positive
multiple of 64.  Texts of any length are stored whole; equal texts give equal media.
Repeated rows, null ids, ties and further columns don't matter: each row is handled
by itself.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layoutlake.llm.common import map_batches, table, written

# Fixed values of the format: kbit/s by bit-rate index 1 to 14.
RATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
# Fixed values of the format: sampling frequencies of MPEG-1; MPEG-2 has half, MPEG-2.5 a quarter.
FREQUENCIES = (44100, 48000, 32000)
CRC_POLYNOMIAL = 0x8005

UNIT = 64
SAMPLE_RATE = 32000
SIDE_BYTES = 17  # MPEG-1 Layer III, one channel
OVERHEAD = 4 + 2 + SIDE_BYTES


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        out = np.where(out & 0x8000, (out << 1) ^ CRC_POLYNOMIAL, out << 1) & 0xFFFF
    return out


CRC_TABLE = _crc_table()


def crc16(columns: np.ndarray) -> np.ndarray:
    """CRC-16 of each row of a byte matrix, start value all ones."""
    crc = np.full(columns.shape[0], 0xFFFF, np.uint32)
    for k in range(columns.shape[1]):
        crc = ((crc << 8) & 0xFFFF) ^ CRC_TABLE[(crc >> 8) ^ columns[:, k]]
    return crc


@dataclass(frozen=True)
class Header:
    version: float  # 1, 2 or 2.5
    layer: int
    protected: bool
    bit_rate: int
    sample_rate: int
    padding: int
    channels: int

    @property
    def samples(self) -> int:
        return {1: 384, 2: 1152, 3: 1152 if self.version == 1 else 576}[self.layer]

    @property
    def size(self) -> int:
        if self.layer == 1:
            return (12 * self.bit_rate // self.sample_rate + self.padding) * 4
        return self.samples // 8 * self.bit_rate // self.sample_rate + self.padding

    @property
    def side(self) -> int:
        """Bytes of side information (Layer III)."""
        return ((17 if self.channels == 1 else 32) if self.version == 1 else (9 if self.channels == 1 else 17)) if self.layer == 3 else 0


def read_header(data: bytes, at: int) -> Header | None:
    """The frame header at ``at``, None if there is no valid one."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    b, c, d = data[at + 1], data[at + 2], data[at + 3]
    version, layer, rate, frequency = {0: 2.5, 2: 2, 3: 1}.get(b >> 3 & 3), 4 - (b >> 1 & 3), c >> 4, c >> 2 & 3
    if version is None or layer == 4 or rate in (0, 15) or frequency == 3 or d & 3 == 2:
        return None
    divisor = {1: 1, 2: 2, 2.5: 4}[version]
    return Header(version, layer, not b & 1, RATES[min(2, int(version)), layer][rate - 1] * 1000, FREQUENCIES[frequency] // divisor, c >> 1 & 1, 1 if d >> 6 == 3 else 2)


def _header_bytes(rate_index: int) -> bytes:
    # MPEG-1, Layer III, CRC present; 32 kHz; single channel
    return bytes((0xFF, 0xFA, rate_index << 4 | 2 << 2, 0xC0))


def _frame_size(rate_index: int) -> int:
    return 144 * RATES[1, 3][rate_index - 1] * 1000 // SAMPLE_RATE


def _frames(payload: np.ndarray, rate_index: int) -> np.ndarray:
    """Frames of one bit rate that carry the rows of ``payload``, filled with 0."""
    size = _frame_size(rate_index)
    out = np.zeros((payload.shape[0], size), np.uint8)
    out[:, :4] = np.frombuffer(_header_bytes(rate_index), np.uint8)
    out[:, OVERHEAD : OVERHEAD + payload.shape[1]] = payload
    crc = crc16(np.concatenate((out[:1, 2:4], out[:1, 6:OVERHEAD]), axis=1)) if len(out) else np.empty(0, np.uint32)
    out[:, 4], out[:, 5] = (crc[:1] >> 8, crc[:1] & 0xFF) if len(out) else (0, 0)
    return out


def _tag(**values: int) -> bytes:
    """An ID3v2.3 tag with each value in a TXXX frame."""
    frames = b""
    for name, value in values.items():
        body = b"\x00" + name.encode() + b"\x00" + str(value).encode()
        frames += b"TXXX" + struct.pack(">I", len(body)) + b"\x00\x00" + body
    n = len(frames)
    return b"ID3\x03\x00\x00" + bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127)) + frames


def encode_media(payload: bytes) -> bytes:
    """``payload`` in a stream of silent frames."""
    room = _frame_size(14) - OVERHEAD
    data = np.frombuffer(payload, np.uint8)
    whole = len(data) // room
    body = _frames(data[: whole * room].reshape(whole, room), 14).tobytes()
    sizes = [_frame_size(14)] * whole
    if rest := len(data) - whole * room:
        index = next(i for i in range(1, 15) if _frame_size(i) - OVERHEAD >= rest)
        body += _frames(data[whole * room :].reshape(1, rest), index).tobytes()
        sizes.append(_frame_size(index))
    information = bytearray(_frames(np.empty((1, 0), np.uint8), 8).tobytes())
    total, n = len(information) + len(body), len(sizes)
    ends = np.cumsum([len(information), *sizes])
    # Entry k of the seek table: the place, in 256ths of all bytes, at k percent of the time.
    places = ends[np.minimum(np.arange(100) * n // 100, n)]
    seek = np.minimum(places * 256 // total, 255).astype(np.uint8).tobytes()
    table_ = b"Xing" + struct.pack(">3I", 7, n, total) + seek
    # the Xing table stands right behind the side information; its frame has no CRC
    information[1] |= 1
    information[4 : 4 + SIDE_BYTES + len(table_)] = bytes(SIDE_BYTES) + table_
    return _tag(payload=len(payload), crc32=zlib.crc32(payload)) + bytes(information) + body


@dataclass
class Stream:
    """What a stream holds.  ``frames`` and ``offsets`` leave out a table frame."""

    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, int] = field(default_factory=dict)
    seek: bytes = b""
    headers: dict[bytes, Header] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    sample_rate: int = 0
    crc_checked: int = 0
    crc_wrong: int = 0
    crc_unchecked: int = 0  # protected frames of Layers I and II
    skipped: int = 0  # bytes that belong to no frame or tag
    cut: bool = False  # the last frame is not whole

    @property
    def duration_ms(self) -> float:
        return self.samples * 1000 / self.sample_rate if self.sample_rate else 0.0


def _read_tags(data: bytes, out: Stream) -> int:
    """Read ID3v2 tags at the start; where audio begins."""
    at = 0
    while data[at : at + 3] == b"ID3" and at + 10 <= len(data) and max(data[at + 6 : at + 10]) < 128:
        size = int.from_bytes(bytes(4), "big")
        for b in data[at + 6 : at + 10]:
            size = size << 7 | b
        inside, end, version = at + 10, min(at + 10 + size, len(data)), data[at + 3]
        while version >= 3 and inside + 10 <= end and data[inside] != 0:
            name, raw = data[inside : inside + 4], data[inside + 4 : inside + 8]
            n = int.from_bytes(raw, "big") if version == 3 else raw[0] << 21 | raw[1] << 14 | raw[2] << 7 | raw[3]
            body = data[inside + 10 : min(inside + 10 + n, end)]
            if name[:1] == b"T" and body:
                text = body[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[min(body[0], 3)], "replace")
                key, _, value = text.partition("\0") if name == b"TXXX" else (name.decode("latin-1"), "", text)
                out.tags[key] = value.rstrip("\0")
            inside += 10 + n
        at = at + 10 + size + (10 if data[at + 5] & 0x10 else 0)
    return min(at, len(data))


def _read_table(data: bytes, at: int, header: Header, out: Stream) -> bool:
    """Read a Xing, Info or VBRI table in the frame at ``at``."""
    # writers leave out the CRC in the frame of a table, whatever the header says
    for place in (at + 4 + header.side, at + 6 + header.side):
        if data[place : place + 4] in (b"Xing", b"Info") and place + 8 <= len(data):
            flags, p = struct.unpack_from(">I", data, place + 4)[0], place + 8
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit and p + 4 <= len(data):
                    out.table[name], p = struct.unpack_from(">I", data, p)[0], p + 4
            if flags & 4:
                out.seek = data[p : p + 100]
            return True
    place = at + 36
    if data[place : place + 4] == b"VBRI" and place + 26 <= len(data):
        _, _, _, size, frames, entries, scale, width, _ = struct.unpack_from(">HHHIIHHHH", data, place + 4)
        out.table |= {"frames": frames, "bytes": size, "entries": entries}
        out.seek = data[place + 26 : place + 26 + entries * width]
        return True
    return False


def parse(data: bytes) -> Stream:
    """Read a stream; damage is counted, never raised."""
    out = Stream()
    at = _read_tags(data, out)
    end = len(data)
    # the last 128 bytes are an ID3v1 tag only if no frame reaches into them
    tag = end - 128 if end >= 128 and data[-128:-125] == b"TAG" else end
    first, locked = True, False
    while at + 4 <= end:
        if at == tag:
            out.tags["id3v1"] = data[-125:-95].split(b"\0")[0].decode("latin-1")
            at = end
            break
        raw = data[at : at + 4]
        header = out.headers.get(raw) or read_header(data, at)
        good = header is not None
        if good and not locked:  # the next header must confirm what may be chance
            after = at + header.size
            following = read_header(data, after) if after + 4 <= end else None
            good = after == end or following is not None and (following.version, following.layer, following.sample_rate) == (header.version, header.layer, header.sample_rate)
        if not good:
            locked = False
            stop = tag if at < tag else end
            found = data.find(b"\xff", at + 1, stop)
            step = (found if found >= 0 else stop) - at
            out.skipped, at = out.skipped + step, at + step
            continue
        if at + header.size > end:
            out.cut = True
            out.skipped += end - at
            return out
        out.headers[raw] = header
        locked = True
        if first and _read_table(data, at, header, out):
            first = False
        else:
            first = False
            out.offsets.append(at)
            out.sizes.append(header.size)
            out.samples += header.samples
            out.sample_rate = header.sample_rate
        at += header.size
    out.skipped += end - at
    # Layer III: the CRC covers the header's last two bytes and the side information.
    kinds: dict[bytes, list[int]] = {}
    for offset in out.offsets:
        kinds.setdefault(data[offset : offset + 4], []).append(offset)
    flat = np.frombuffer(data, np.uint8)
    for raw, offsets in kinds.items():
        header = out.headers[raw]
        if header.protected and header.layer != 3:
            out.crc_unchecked += len(offsets)
        elif header.protected:
            rows = flat[np.array(offsets)[:, None] + np.array([2, 3, 4, 5, *range(6, 6 + header.side)])]
            wanted = rows[:, 2].astype(np.uint32) << 8 | rows[:, 3]
            out.crc_checked += len(rows)
            out.crc_wrong += int((crc16(np.delete(rows, (2, 3), axis=1)) != wanted).sum())
    return out


def read_payload(data: bytes, stream: Stream) -> bytes:
    """The carried bytes; a ValueError if the stream is damaged."""
    if stream.crc_wrong or stream.skipped or stream.cut or stream.table.get("frames") != len(stream.offsets):
        raise ValueError("damaged stream")
    parts = [data[a + OVERHEAD : a + n] for a, n in zip(stream.offsets, stream.sizes, strict=True)]
    payload = b"".join(parts)[: int(stream.tags["payload"])]
    if zlib.crc32(payload) != int(stream.tags["crc32"]):
        raise ValueError("damaged payload")
    return payload


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    n = max(UNIT, -(-len(raw) // UNIT) * UNIT)
    return raw + bytes(n - len(raw)), len(raw)


def feature(stream: Stream, payload: bytes) -> str:
    """Frames, duration, bit rate, seek places at quarters, level and entropy of the samples."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = counts[counts > 0] / len(payload)
    entropy = float(-(share * np.log2(share)).sum()) + 0.0
    level = float(counts @ np.arange(256)) / len(payload)
    n = len(stream.offsets)
    seek = ",".join(str(stream.offsets[k * n // 4]) for k in range(4)) if n else ""
    rate = round(sum(stream.sizes) * 8 * stream.sample_rate / stream.samples) if stream.samples else 0
    return f"frames={n};samples={stream.samples};ms={stream.duration_ms:.3f};bps={rate};seek={seek};mean={level:.4f};entropy={entropy:.4f}"


def to_media(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the stored form ``media``."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [padded(t) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for _, n in made], pa.int64()), pa.array([encode_media(p) for p, _ in made], pa.binary())], names=["doc_id", "n_bytes", "media"])

        return each

    return map_batches(df.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_bytes long, media binary")


def from_media(df: DataFrame) -> DataFrame:
    """Read ``media`` back: digests of payload and stored form, duration, frame offsets, feature."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_samples long, offsets array<long>"
    names = [x.split()[0] for x in schema.split(", ")]

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, n, media in zip(batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("media").to_pylist(), strict=True):
                stream = parse(media)
                payload = read_payload(media, stream)
                rows.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(stream, payload), len(stream.offsets), stream.samples, stream.offsets))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        return each

    return map_batches(df, make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_media(written(to_media(table(spark, sf_dir, "documents")), "mpeg-media"))
