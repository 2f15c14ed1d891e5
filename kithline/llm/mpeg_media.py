"""MPEG audio media columns: lossless containers of bytes, and a parser of any MPEG audio stream.

:func:`scan` walks a stream: ID3v2 (2.2 to 2.4, also unsynchronised) and ID3v1 tags,
frames of MPEG 1, 2 and 2.5 in layers I to III at listed and free bit rates, the
Xing/Info and VBRI tables of variable bit rates, and the CRC-16 of protected frames,
which covers the side information in layer III, the allocation in layer I, and the
allocation with the scale factors' selection in layer II.  Where a header is not
valid it resynchronises at the next place whose frame is followed by a like header or
the stream's end; a frame that is followed by neither has to have a right checksum,
if any.  It gives the exact duration (samples and rate), and where each frame begins.

:func:`wrap` stores a payload of 576 bytes a frame, which is the number of samples of
an MPEG-2 layer III frame: side information of a silent granule, and the bytes as
ancillary data behind their count.  The payload is stored whole, its fill of 255s
too; the stream begins with a frame that has an Info table.

Defined results: a null text is empty, and an empty text is one frame of fill; a very
long text is one stream; a stream without any frame has zero frames and samples; a
free bit rate's frames are of ``FREE_BYTES`` at most; a null stream is empty; equal
texts give equal values, and repeated rows are stored each; an empty table gives an
empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, slices, stored, text_column

# Fixed values of the MPEG audio standards: kbit/s by index, by (low sampling frequency, layer), and Hz by version.
BITRATES = {
    (False, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (False, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (False, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (True, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (True, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (True, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {"1": (44100, 48000, 32000), "2": (22050, 24000, 16000), "2.5": (11025, 12000, 8000)}
VERSIONS = {0: "2.5", 2: "2", 3: "1"}

UNIT = 576
SIDE = 9  # bytes of side information of a mono MPEG-2 layer III frame
LEAD = 4 + 2 + SIDE + 2  # header, checksum, side information, count
FILL = 255
#: Longest frame of a free bit rate that is looked for.
FREE_BYTES = 1 << 13
# Fixed values of the standards: bits of a subband's allocation in layer II, as (subbands, bits) by table.
ALLOCATION = {"a": ((11, 4), (12, 3), (4, 2)), "b": ((11, 4), (12, 3), (7, 2)), "c": ((2, 4), (6, 3)), "d": ((2, 4), (10, 3)), "low": ((4, 4), (7, 3), (19, 2))}


@dataclass(frozen=True)
class Header:
    version: str
    layer: int
    protected: bool
    kbps: int
    rate: int
    length: int  # 0 at a free bit rate
    samples: int
    mode: int
    extension: int
    padding: int

    @property
    def mono(self) -> bool:
        return self.mode == 3

    @property
    def kind(self) -> tuple[str, int, int]:
        return self.version, self.layer, self.rate

    @property
    def side(self) -> int:
        """Bytes of layer III side information."""
        return (17 if self.mono else 32) if self.version == "1" else (9 if self.mono else 17)


@lru_cache(4096)
def header(word: int) -> Header | None:
    """The header in 32 bits; None if they are none."""
    version, layer, bit, rate = word >> 19 & 3, 4 - (word >> 17 & 3), word >> 12 & 15, word >> 10 & 3
    if word >> 21 != 0x7FF or version == 1 or layer == 4 or bit == 15 or rate == 3 or word & 3 == 2:
        return None
    name = VERSIONS[version]
    low = name != "1"
    kbps, hz, pad = BITRATES[low, layer][bit], RATES[name][rate], word >> 9 & 1
    samples = 384 if layer == 1 else 576 if layer == 3 and low else 1152
    if layer == 1:
        length, padding = (12000 * kbps // hz + pad) * 4, 4 * pad
    else:
        length, padding = samples // 8 * 1000 * kbps // hz + pad, pad
    return Header(name, layer, not word >> 16 & 1, kbps, hz, length if bit else 0, samples, word >> 6 & 3, word >> 4 & 3, padding)


@lru_cache(1 << 16)
def crc16(data: bytes) -> int:
    """CRC-16 of polynomial 0x8005 from 0xFFFF, most significant bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005) & 0xFFFF if crc & 0x8000 else crc << 1
    return crc


def crc16_bits(value: int, n: int) -> int:
    """The same over the ``n`` bits of a number."""
    crc = 0xFFFF
    for k in range(n - 1, -1, -1):
        top = crc >> 15 ^ value >> k & 1
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return crc


@dataclass
class Stream:
    """What :func:`scan` finds; ``offsets`` and ``lengths`` are those of audio frames."""

    tags: dict[str, str] = field(default_factory=dict)
    kind: tuple[str, int, int] | None = None
    offsets: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    kbps: set[int] = field(default_factory=set)
    samples: int = 0
    skipped: int = 0
    bad_checksums: int = 0
    table: tuple[str, int, int, bytes] | None = None  # name, frames, bytes, seek points as they stand

    def feature(self) -> str:
        rate = self.kind[2] if self.kind else 0
        form = f"mpeg{self.kind[0]}-layer{self.kind[1]}-{rate}" if self.kind else "none"
        seek = zlib.crc32(np.array(self.offsets, "<u8").tobytes())
        agrees = self.table is not None and self.table[1] == len(self.offsets)
        return f"{form};{'vbr' if len(self.kbps) > 1 else 'cbr'};frames={len(self.offsets)};samples={self.samples};table={int(agrees)};bad={self.bad_checksums};skipped={self.skipped};seek={seek:08x}"


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3v2(data: bytes, tags: dict[str, str]) -> int:
    """Read a leading ID3v2 tag; where it ends."""
    if data[:3] != b"ID3" or len(data) < 10:
        return 0
    version, flags = data[3], data[5]
    body = data[10 : 10 + _syncsafe(data[6:10])]
    end = min(len(data), 10 + len(body) + 10 * (flags >> 4 & 1))
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    size_of = _syncsafe if version == 4 else lambda b: int.from_bytes(b, "big")
    at = 0
    if flags & 0x40 and version > 2 and len(body) >= 4:  # an extended header; in 2.4 its size counts itself
        at = size_of(body[:4]) + 4 * (version == 3)
    letters, lead = (3, 6) if version == 2 else (4, 10)
    while version in (2, 3, 4) and at + lead <= len(body) and body[at]:
        size = size_of(body[at + letters : at + 2 * letters])
        name, own = body[at : at + letters].decode("latin-1"), body[at + lead : at + lead + size]
        if version == 4 and body[at + 9] & 2:
            own = own.replace(b"\xff\0", b"\xff")
        if name[0] == "T" and own:
            text = own[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[own[0] & 3], "replace")
            key, _, value = text.partition("\0")
            tags.update({f"{name}:{key}": value.rstrip("\0")} if name in ("TXXX", "TXX") else {name: text.rstrip("\0")})
        at += lead + size
    return end


def _seek_table(data: bytes, at: int, length: int, head: Header) -> tuple[str, int, int, bytes] | None:
    number = lambda p, n: int.from_bytes(data[p : p + n], "big")
    if head.layer != 3:
        return None
    begin = at + 36
    if data[begin : begin + 4] == b"VBRI" and begin + 26 <= at + length:
        return "VBRI", number(begin + 14, 4), number(begin + 10, 4), data[begin + 26 : begin + 26 + number(begin + 18, 2) * number(begin + 22, 2)]
    begin = at + 4 + 2 * head.protected + head.side
    name = data[begin : begin + 4]
    if name not in (b"Xing", b"Info") or begin + 8 > at + length:
        return None
    flags, p, got = number(begin + 4, 4), begin + 8, []
    for bit, size in ((1, 4), (2, 4), (4, 100)):
        got.append(data[p : p + size] if flags & bit else b"")
        p += size * bool(flags & bit)
    return name.decode(), int.from_bytes(got[0], "big"), int.from_bytes(got[1], "big"), got[2]


def _bits_of_layer_2(head: Header) -> list[int]:
    """Bits of each subband's allocation."""
    each = head.kbps / (1 if head.mono else 2)
    if head.version != "1":
        table = "low"
    elif 0 < each <= 48:
        table = "d" if head.rate == 32000 else "c"
    else:
        table = "a" if head.rate == 48000 or 0 < each <= 80 else "b"
    return [bits for n, bits in ALLOCATION[table] for _ in range(n)]


def covered_bits(data: bytes, at: int, head: Header) -> int:
    """Bits after the checksum of a protected frame that it covers."""
    if head.layer == 3:
        return 8 * head.side
    channels = 1 if head.mono else 2
    bound = 4 * (head.extension + 1) if head.mode == 1 else 32  # subbands from here on share their allocation
    if head.layer == 1:
        return 4 * (32 if head.mono else bound * 2 + 32 - bound)
    read, word = 0, int.from_bytes(data[at + 6 : at + 6 + 32].ljust(32, b"\0"), "big")
    chosen = 0
    for band, bits in enumerate(_bits_of_layer_2(head)):
        for _ in range(1 if band >= bound else channels):
            allocated = word >> (256 - read - bits) & (1 << bits) - 1
            read += bits
            chosen += bool(allocated) * (channels if band >= bound else 1)
    return read + 2 * chosen


def _checksum(data: bytes, at: int, head: Header) -> bool | None:
    """Whether the checksum of a protected frame is right; ``None``: it has none."""
    if not head.protected:
        return None
    stored_sum, n = int.from_bytes(data[at + 4 : at + 6], "big"), covered_bits(data, at, head)
    body = data[at + 6 : at + 6 + (n + 7) // 8]
    if n % 8 == 0:
        return crc16(data[at + 2 : at + 4] + body) == stored_sum
    return crc16_bits(int.from_bytes(data[at + 2 : at + 4] + body, "big") >> -n % 8, 16 + n) == stored_sum


def _free_length(data: bytes, at: int, head: Header, end: int) -> int:
    """Bytes without padding of a frame at a free bit rate, from where the next two headers of its kind stand; 0: not found."""
    p = data.find(b"\xff", at + 4, min(end, at + FREE_BYTES))
    while p >= 0:
        like = header(int.from_bytes(data[p : p + 4], "big")) if p + 4 <= end else None
        if like is not None and like.kbps == 0 and like.kind == head.kind:
            own = p - at - head.padding
            after = p + own + like.padding
            third = header(int.from_bytes(data[after : after + 4], "big")) if after + 4 <= end else None
            if after == end or third is not None and third.kbps == 0 and third.kind == head.kind:
                return own
        p = data.find(b"\xff", p + 1, min(end, at + FREE_BYTES))
    return 0


def scan(data: bytes) -> Stream:
    out = Stream()
    at, end = _id3v2(data, out.tags), len(data)
    if end - at >= 128 and data[-128:-125] == b"TAG":
        end -= 128
        for name, a, z in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93)):
            out.tags[f"v1:{name}"] = data[end + a : end + z].split(b"\0")[0].decode("latin-1").strip()
    synced, first, free = False, True, 0
    while at + 4 <= end:
        head, length = header(int.from_bytes(data[at : at + 4], "big")), 0
        if head is not None and (out.kind is None or head.kind == out.kind):
            length = head.length
            if not length:
                free = free or _free_length(data, at, head, end)
                length = free + head.padding if free else 0
        fits = 0 < length <= end - at
        if fits:
            after = at + length
            later = header(int.from_bytes(data[after : after + 4], "big")) if after + 4 <= end else None
            fits = after == end or later is not None and later.kind == head.kind or synced and _checksum(data, at, head) is not False
        if not fits:
            synced = False
            onward = data.find(b"\xff", at + 1, end)
            onward = end if onward < 0 else onward
            out.skipped += onward - at
            at = onward
            continue
        synced, out.kind = True, head.kind
        table = _seek_table(data, at, length, head) if first else None
        first = False
        if table:
            out.table = table
        else:
            out.offsets.append(at)
            out.lengths.append(length)
            out.kbps.add(head.kbps)
            out.samples += head.samples
        out.bad_checksums += _checksum(data, at, head) is False
        at += length
    out.skipped += end - at
    return out


@lru_cache(64)
def _frame_lead(kbps: int, protected: bool = True) -> bytes:
    """Header, checksum and silent side information of a mono MPEG-2 layer III frame of 16 kHz."""
    bit = BITRATES[True, 3].index(kbps)
    word = 0x7FF << 21 | 2 << 19 | 1 << 17 | (not protected) << 16 | bit << 12 | 2 << 10 | 3 << 6
    head, side = word.to_bytes(4, "big"), bytes(SIDE)
    return head + (crc16(head[2:] + side).to_bytes(2, "big") if protected else b"") + side


def _smallest(size: int) -> tuple[int, int]:
    """The smallest bit rate whose frame holds so many bytes, and that frame's length."""
    return next((k, 72 * k // 16) for k in BITRATES[True, 3][1:] if 72 * k // 16 >= size)


def padded(text: bytes) -> bytes:
    """The payload of a text: it and 255s up to a positive multiple of 576 bytes."""
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, bytes([FILL]))


def wrap(text: bytes) -> bytes:
    """The stream that stores a text's payload."""
    payload = padded(text)
    units = len(payload) // UNIT
    kbps, length = _smallest(LEAD + UNIT)
    body = np.zeros((units, length), np.uint8)
    body[:, : LEAD - 2] = np.frombuffer(_frame_lead(kbps), np.uint8)
    body[:, LEAD - 2 : LEAD] = UNIT >> 8, UNIT & 255
    body[:, LEAD : LEAD + UNIT] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    info_kbps, info_length = _smallest(4 + SIDE + 120)
    total = info_length + units * length
    points = bytes(min(255, 256 * (info_length + units * p // 100 * length) // total) for p in range(100))
    info = _frame_lead(info_kbps, False) + b"Info" + (7).to_bytes(4, "big") + units.to_bytes(4, "big") + total.to_bytes(4, "big") + points
    count = b"\x03bytes\0" + str(len(text)).encode()
    frame = b"TXXX" + bytes(len(count) >> s & 127 for s in (21, 14, 7, 0)) + b"\0\0" + count
    tag = b"ID3\x04\0\0" + bytes(len(frame) >> s & 127 for s in (21, 14, 7, 0)) + frame
    return tag + info.ljust(info_length, b"\0") + body.tobytes()


def unwrap(data: bytes, stream: Stream) -> bytes:
    """The payload of a wrapped stream, from its frames' bytes alone."""
    parts = []
    for at in stream.offsets:
        n = data[at + LEAD - 2] << 8 | data[at + LEAD - 1]
        parts.append(data[at + LEAD : at + LEAD + n])
    return b"".join(parts)


def media_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and media (the stored stream) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = buffer_of(text_column(part, "text"))
            raw = data.tobytes()
            streams = [wrap(raw[a:z]) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch({"doc_id": part.column(0), "media": pa.array(streams, pa.binary())})

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """Of a table (doc_id, media) what each stream holds, with the exact duration (samples / rate)
    and every frame's place: the bytes before the first, then from each to the next."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "media"):
            rows = [_described(m or b"") for m in part.column(1).to_pylist()]
            columns = zip(*rows, strict=True)
            yield pa.record_batch([part.column(0), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], ["doc_id", *_NAMES])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, " + _SCHEMA)


_SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_samples long, sample_rate int, frame_steps array<int>"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32())]


def _described(data: bytes) -> tuple:
    stream = scan(data)
    payload = unwrap(data, stream) if "TXXX:bytes" in stream.tags else b""
    size = int(stream.tags.get("TXXX:bytes") or 0)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    steps = np.diff(np.array(stream.offsets, np.int64), prepend=0).astype(np.int32)
    return size, len(payload), sha(payload), zlib.crc32(payload[-32:]), len(data), sha(data), stream.feature(), stream.samples, stream.kind[2] if stream.kind else 0, steps


def store_and_read(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every document as a stream in the shared folder, read the streams back and describe them."""
    return describe(stored(media_table(docs, doc_id, text), "media"))
